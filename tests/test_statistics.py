"""Statistics, probabilities, rules, drift and run log against plain Python."""

import datetime as dt
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.functions.significance import kolmogorov_p_value, log_gamma, pearson_p_value, regularised_beta
from roadpulse.operators import drift, metrics, mining, probability, profiles, ranks, runlog, scenarios, stats, trends


def quantile(values, share):
    values = sorted(values)
    rank = share * (len(values) - 1)
    low, high = values[math.floor(rank)], values[math.ceil(rank)]
    return low + (high - low) * (rank - math.floor(rank))


@pytest.mark.parametrize("ranges", [2, 7, 256])
def test_running_totals(spark, ranges):
    rng = random.Random(4)
    # One value holds a third of all rows.
    rows = [(g, 7.5 if rng.random() < 0.33 else round(rng.gauss(0, 50), 1)) for g in "ab" for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = ranks.running_totals(ranks.value_counts(df, "v", ["g"]), "v", ["n"], ["g"], ranges).collect()
    for r in got:
        group = [v for g, v in rows if g == r["g"]]
        assert r["n_total"] == len(group)
        assert r["n"] == group.count(r["v"])
        assert r["n_before"] == sum(v < r["v"] for v in group)
    assert len(got) == len(set(rows))


@pytest.mark.parametrize("size", [1, 2, 3, 10, 999])
def test_quantiles(spark, size):
    rng = random.Random(size)
    values = [rng.choice([rng.random() * 100, 5.0, None]) for _ in range(size)] + [1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    row = ranks.column_quantiles(df, "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}).first()
    known = [v for v in values if v is not None]
    for name, share in zip("abcde", (0.0, 0.25, 0.5, 0.9, 1.0)):
        assert row[name] == pytest.approx(quantile(known, share))


def test_descriptive_stats(spark):
    values = [3, 9, 9, 27, 100, 100, 100]
    row = stats.descriptive_stats(spark.createDataFrame([(v,) for v in values], "traffic_volume bigint")).first()
    mean = sum(values) / len(values)
    variance = sum((v - mean) ** 2 for v in values) / (len(values) - 1)
    assert (row["n"], row["min"], row["max"], row["range"], row["median"]) == (7, 3, 100, 97, 27)
    assert row["mean"] == pytest.approx(mean) and row["variance"] == pytest.approx(variance)
    assert row["std"] == pytest.approx(math.sqrt(variance))


def test_histogram_keeps_the_maximum_and_empty_bins(spark):
    df = spark.createDataFrame([(v,) for v in [0, 0, 5, 40]], "traffic_volume bigint")
    rows = stats.histogram(df, 4).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [3, 0, 0, 1]
    assert rows[0]["bin_start"] == 0.0 and rows[-1]["bin_end"] == 40.0


def test_pearson_p_value(spark):
    def p(r, n):
        df = spark.createDataFrame([(r, n)], "r double, n bigint")
        return df.select(pearson_p_value(F.col("r"), F.col("n"))).first()[0]

    # Published result of the analysis; r is known to four digits only.
    assert 0.6 < p(0.1392, 40565) / 1.54e-174 < 1.7
    assert p(0.5, 4) == pytest.approx(0.5)  # exact for two degrees of freedom
    assert p(-0.5, 3) == pytest.approx(2 / 3)  # and for one: 1 - 2 asin(1/2) / pi
    assert p(0.0, 30) == pytest.approx(1.0)
    assert p(1.0, 30) == 0.0
    assert p(0.5, 2) is None and p(None, 30) is None and p(float("nan"), 30) is None
    # Large samples: the normal distribution.
    for n in (10**6, 10**9):
        assert p(1.96 / math.sqrt(n), n) == pytest.approx(math.erfc(1.96 / math.sqrt(2)), rel=1e-4)


def test_beta_and_gamma_functions(spark):
    cases = [(0.5, 0.5), (2.0, 3.0), (30.0, 0.5), (1.0, 40.0), (7.5, 2.25)]
    rows = [(a, b, x / 10) for a, b in cases for x in range(11)]
    df = spark.createDataFrame(rows, "a double, b double, x double").withColumn("i", regularised_beta(F.col("a"), F.col("b"), F.col("x")))
    found = {(r.a, r.b, r.x): r.i for r in df.collect()}
    assert found[2.0, 3.0, 0.4] == pytest.approx(0.5248)
    for (a, b, x), value in found.items():
        # Midpoint sum after x = sin(t)^2, which takes the poles at both ends away.
        top, n = math.asin(math.sqrt(x)), 4000
        steps = [(i + 0.5) * top / n for i in range(n)]
        area = sum(2 * math.sin(t) ** (2 * a - 1) * math.cos(t) ** (2 * b - 1) for t in steps) * top / n if top else 0.0
        whole = math.exp(math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))
        assert value == pytest.approx(area / whole, abs=1e-5)
    df = spark.createDataFrame([(x,) for x in (0.5, 1.0, 1.5, 10.0, 25_000.0)], "x double")
    for r in df.select("x", log_gamma(F.col("x")).alias("g")).collect():
        assert r.g == pytest.approx(math.lgamma(r.x), abs=1e-10, rel=1e-12)


def test_kolmogorov_p_value(spark):
    # Published drift table: training 32,460 and test 8,115 rows; distances to four digits.
    rows = [(0.0742, 0.0), (0.0271, 0.0001), (0.0177, 0.0331), (0.0121, 0.2948), (0.0104, 0.4828), (0.0058, 0.9795), (0.0, 1.0)]
    df = spark.createDataFrame(rows, "d double, p double").withColumn(
        "q", kolmogorov_p_value(F.col("d"), F.lit(32460), F.lit(8115))
    )
    for r in df.collect():
        assert r["q"] == pytest.approx(r["p"], abs=0.008)


def test_ks_distance(spark):
    rng = random.Random(2)
    rows = [(rng.random() < 0.8, rng.gauss(0, 1) if rng.random() < 0.67 else 0.25) for _ in range(3000)]
    rows = [(t, v if t else v + 0.2) for t, v in rows]
    df = spark.createDataFrame(rows, "is_train boolean, v double").repartition(5)
    a, b = [v for t, v in rows if t], [v for t, v in rows if not t]
    expected = max(
        abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in {v for _, v in rows}
    )
    got = drift.ks_two_sample(df, ["v"]).first()
    assert got["ks_statistic"] == pytest.approx(expected)
    assert (got["n_train"], got["n_test"]) == (len(a), len(b))


def test_injected_fault_raises_the_alert(spark):
    rows = [(i % 5 != 0, i, 1 if i % 3 == 0 else 0, 0, 0) for i in range(5000)]
    df = spark.createDataFrame(
        rows, "is_train boolean, id bigint, weather_Clear int, weather_Thunderstorm int, is_severe_weather int"
    )
    watched = ["weather_Clear", "weather_Thunderstorm", "is_severe_weather"]
    calm = drift.drift_summary(drift.drift_report(df, watched)).first()
    assert (calm["overall_status"], calm["n_alerts"], calm["flagged"]) == ("PASS", 0, "")
    faulty = drift.inject_severe_weather(df, drift.hashed_share(["id"], 600))
    loud = drift.drift_summary(drift.drift_report(faulty, watched)).first()
    assert (loud["overall_status"], loud["n_alerts"]) == ("ALERT", 3)


def hourly(spark, rows):
    return spark.createDataFrame(rows, "traffic_volume bigint, weather_main string, temp double")


def test_empty_cell_gives_no_odds_ratio(spark):
    counts = probability.condition_counts(hourly(spark, [(6000, "Clear", 280.0), (100, "Clouds", 280.0)]))
    row = probability.odds_ratio(counts).first()
    assert row["odds_clear"] is None and row["odds_ratio"] is None and row["effect"] is None


def test_probabilities(spark):
    df = hourly(spark, [(6000, "Clear", 295.0)] * 2 + [(6000, "Clouds", 280.0)] + [(100, "Clear", 280.0)] * 3 + [(100, "Clouds", 280.0)] * 4)
    counts = probability.condition_counts(df)
    p = probability.probabilities(counts).first()
    assert (p["n"], p["p_congested"], p["p_clear"], p["p_both"]) == (10, 0.3, 0.5, 0.2)
    given = probability.conditional_probabilities(counts).first()
    assert given["p_clear_given_congested"] == pytest.approx(2 / 3) == given["p_hot_given_congested"]
    assert probability.odds_ratio(counts).first()["odds_ratio"] == pytest.approx((2 / 3) / (1 / 4))
    assert probability.independence(counts).first()["verdict"] == "not independent"


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    row = df.select(C.ratio(F.col("a"), F.col("b")).alias("r"), C.percent_change(F.col("a"), F.col("b")).alias("p")).first()
    assert row["r"] is None and row["p"] is None


def test_lag_and_difference_agree(spark):
    """Changes by window equal changes between consecutive rows of the totals."""
    rows = [(dt.datetime(y, 5, 1, h), 100 * y % 977 + h) for y in (2012, 2013, 2015) for h in range(y % 7 + 2)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, traffic_volume bigint")
    got = trends.yearly_trends(df, 2012, 2017).collect()
    totals = [r["total_volume"] for r in got]
    assert [r["yr"] for r in got] == [2012, 2013, 2015]
    assert [r["total_volume_change"] for r in got] == [None] + [b - a for a, b in zip(totals, totals[1:])]


def test_strength_bands(spark):
    edges = [(0.09, "negligible"), (-0.1, "weak"), (0.3, "moderate"), (-0.5, "strong"), (0.7, "very strong"), (None, None)]
    df = spark.createDataFrame(edges, "r double, band string")
    assert df.filter(~C.correlation_strength(F.col("r")).eqNullSafe(F.col("band"))).isEmpty()


def test_rules_against_enumeration(spark):
    rng = random.Random(6)
    rows = [
        (rng.choice(["Night", "Evening"]), rng.choice(["Weekday", "Weekend"]), rng.choice(["Clear", "Rain", "Snow"]))
        for _ in range(400)
    ]
    rows = [(t, d, w, "Low" if t == "Night" else rng.choice(["High", "Severe"])) for t, d, w in rows]
    df = spark.createDataFrame(rows, mining.ATTRIBUTES)
    support = {}
    for mask in itertools.product([0, 1], repeat=4):
        for row in rows:
            items = frozenset(f"{a}_{v}" for keep, a, v in zip(mask, mining.ATTRIBUTES, row) if keep)
            if items:
                support[items] = support.get(items, 0) + 1
    support = {k: n / len(rows) for k, n in support.items() if n / len(rows) >= 0.02}
    expected = {}
    for items in support:
        for size in range(1, len(items)):
            for left in map(frozenset, itertools.combinations(sorted(items), size)):
                lift = support[items] / support[left] / support[items - left]
                if lift >= 1:
                    expected[", ".join(sorted(left)), ", ".join(sorted(items - left))] = lift
    itemsets = mining.frequent_itemsets(df)
    assert itemsets.count() == len(support)
    rules = mining.association_rules(itemsets)
    got = {(", ".join(r["antecedents"]), ", ".join(r["consequents"])): r["lift"] for r in rules.collect()}
    assert got == pytest.approx(expected)
    assert any("," in consequents for _, consequents in got)
    top = mining.rules_for_target(rules, ["High", "Severe"], 5).collect()
    assert len(top) == 5 and all("congestion_High" in r["consequents"] or "congestion_Severe" in r["consequents"] for r in top)


def test_classification_metrics(spark):
    rng = random.Random(8)
    rows = [(rng.randint(0, 1), rng.choice([0.1, 0.4, 0.5, 0.8, rng.random()])) for _ in range(500)]
    got = metrics.classification_metrics(spark.createDataFrame(rows, "label int, score double").repartition(4)).first()
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    tp, fp = sum(s >= 0.5 for s in pos), sum(s >= 0.5 for s in neg)
    assert got["roc_auc"] == pytest.approx(auc)
    assert got["precision"] == pytest.approx(tp / (tp + fp)) and got["recall"] == pytest.approx(tp / len(pos))
    assert got["accuracy"] == pytest.approx((tp + len(neg) - fp) / len(rows))


def test_no_positive_predictions(spark):
    got = metrics.classification_metrics(spark.createDataFrame([(1, 0.1), (0, 0.2)], "label int, score double")).first()
    assert (got["precision"], got["recall"], got["f1"], got["roc_auc"]) == (0.0, 0.0, 0.0, 0.0)


def test_scenarios_are_checked(spark):
    rows = [
        (8, "weekday", "Rain", True, None), (24, "weekday", "Rain", False, "hour must be between 0 and 23"),
        (8, "weekday", "Hail", False, "unknown weather"), (8, "holiday", "Rain", False, "day type must be weekday or weekend"),
        (8, "weekend", None, None, None), (None, "weekday", "Rain", False, "hour must be between 0 and 23"),
    ]
    df = spark.createDataFrame(rows, "hour int, day_type string, weather string, is_holiday boolean, expected string")
    checked = scenarios.check_scenarios(df)
    assert checked.filter(~F.col("reason").eqNullSafe(F.col("expected"))).isEmpty()
    row = scenarios.scenario_features(scenarios.valid_scenarios(df)).filter("day_type = 'weekend'").first()
    assert (row["weather_Clear"], row["is_weekend"], row["is_holiday"], row["has_precipitation"]) == (1, 1, 0, 0)
    assert row["dow_sin"] == pytest.approx(math.sin(2 * math.pi * 5 / 7))
    grid = scenarios.scenario_grid(scenarios.valid_scenarios(df))
    assert grid.count() == 48 and set(S.FEATURES) <= set(grid.columns)


def test_best_windows_prefer_the_earlier_hour(spark):
    df = spark.createDataFrame(
        [("weekday", "Clear", False, h, 100.0 if h in (3, 9, 20) else 500.0) for h in range(24)],
        "day_type string, weather string, is_holiday boolean, hour int, predicted_volume double",
    )
    assert [r["hour"] for r in scenarios.best_windows(df).orderBy("place").collect()] == [9, 20, 6]
    assert scenarios.best_windows(df, n=1, allow_overnight=True).first()["hour"] == 3
    text = scenarios.recommendation_messages(scenarios.best_windows(df)).first()["message"]
    assert "09:00-10:00, about 100 vehicles" in text and "holiday" not in text


def test_top_hours_needs_a_positive_count(spark):
    with pytest.raises(ValueError):
        profiles.top_hours(spark.range(1), 0)


def test_run_log(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    rows = [
        ("x", "reg_a", at, {"model": "A", "task": "reg"}, {"MAE": 2.0, "R2": 0.5}),
        ("x", "reg_a", at + dt.timedelta(hours=1), {"model": "A", "task": "reg"}, {"MAE": 2.0, "R2": 0.5}),
        ("x", "reg_a", at, {"model": "A", "task": "reg"}, {"MAE": 2.0, "R2": 0.5000001}),
        ("x", "reg_b", at, {"model": "B", "task": "reg"}, {"MAE": 1.0, "R2": 0.9}),
        ("y", "clf", at, {"model": "C", "task": "clf"}, {"precision": 0.7, "recall": 0.9}),
        ("Default", "try", at, {"model": "A"}, {"R2": 1.0}),
    ]
    path = str(tmp_path / "log")
    for part in (rows[:2], rows[2:]):
        runlog.append_runs(spark.createDataFrame(part, runlog.RUN_LOG_SCHEMA), path)
    runs = runlog.run_comparison(runlog.read_log(spark, path))
    assert [(r["run_name"], r["start_time"].hour, r["R2"]) for r in runs.orderBy("run_name", "R2").collect()] == [
        ("clf", 0, None), ("reg_a", 1, 0.5), ("reg_a", 0, 0.5000001), ("reg_b", 0, 0.9)
    ]
    assert [(r["model"], r["R2"]) for r in runlog.best_run_per_model(runs).collect()] == [("A", 0.5000001), ("B", 0.9)]
    assert runlog.classification_comparison(runs, "clf").count() == 1
    assert runlog.named_like(runs, "reg").count() == 3
    assert runlog.strip_prefixes(spark.range(1).selectExpr("1 AS metrics_R2", "2 AS params_depth", "3 AS run_name")).columns == [
        "R2", "depth", "run_name"
    ]


def test_sample_is_repeatable(spark):
    df = spark.range(500).selectExpr("CAST(id % 3 AS INT) AS corridor", "TIMESTAMP_NTZ'2016-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS ts")
    a, b = (set(map(tuple, drift.sample_rows(df.repartition(n), 40).collect())) for n in (1, 7))
    assert a == b and len(a) == 40
    flips = df.filter(drift.hashed_share(["corridor", "ts"], 600)).count()
    assert 230 < flips < 370


def test_pattern_trees_count_sets_with_items_of_one_kind(spark):
    rows = [(["a", "b", "c"],), (["a", "b", "b"],), (["b", "a"],), (["c"],), ([],), (None,), (["d"],), (["a", "c"],)]
    df = spark.createDataFrame(rows, "items array<string>")
    got = {tuple(r["items"]): (r.n, r.support) for r in mining.pattern_itemsets(df, 0.25).collect()}
    assert got == {("a",): (4, 0.5), ("b",): (3, 0.375), ("c",): (3, 0.375), ("a", "b"): (3, 0.375), ("a", "c"): (2, 0.25)}
    assert mining.pattern_itemsets(df.filter("items IS NULL"), 0.25).collect() == []
    # Attributes of a row become items; a NULL attribute is none.
    named = spark.createDataFrame([("x", None)], "u string, v string")
    assert mining.named_items(named, ["u", "v"]).first()["items"] == ["u_x"]
