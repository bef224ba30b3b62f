"""Series operators against plain Python on small fixtures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import lookup, series

START = dt.datetime(2016, 1, 1)


def make(spark, sizes, seed=1, max_gap=30):
    """Corridors of given lengths with irregular gaps, shuffled."""
    rng, rows = random.Random(seed), []
    for corridor, size in enumerate(sizes):
        at = START
        for _ in range(size):
            at += dt.timedelta(hours=rng.randint(1, max_gap))
            rows.append((corridor, at, rng.randint(0, 5000)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "corridor int, ts timestamp_ntz, traffic_volume bigint").repartition(5)
    by_corridor = {c: sorted((t, v) for k, t, v in rows if k == c) for c in range(len(sizes))}
    return df, by_corridor


SIZES = [1, 2, 5, 24, 25, 26, 137, 400]


def test_position(spark):
    df, expected = make(spark, SIZES)
    got = {(r["corridor"], r["ts"]): (r["position"], r["series_rows"]) for r in series.with_position(df).collect()}
    assert got == {
        (c, t): (i, len(rows)) for c, rows in expected.items() for i, (t, _) in enumerate(rows, 1)
    }


@pytest.mark.parametrize("skip", [0, 24])
def test_split(spark, skip):
    df, expected = make(spark, SIZES)
    got = {(r["corridor"], r["ts"]): r["is_train"] for r in series.chronological_split(df, 0.8, skip).collect()}
    for c, rows in expected.items():
        cut = skip + int(0.8 * (len(rows) - skip)) if len(rows) > skip else 0
        assert [got[c, t] for t, _ in rows] == [i < cut for i in range(len(rows))]


def test_halves(spark):
    df, expected = make(spark, SIZES)
    got = {(r["corridor"], r["ts"]): (r["half"], r["in_first_n"]) for r in series.split_halves(df, first_n=3).collect()}
    wanted = {}
    for c, rows in expected.items():
        test = rows[int(0.8 * len(rows)):]
        wanted.update({(c, t): (1 if i < len(test) // 2 else 2, i < 3) for i, (t, _) in enumerate(test)})
    assert got == wanted


# Blocks down to the look-back itself, so that blocks of a few rows occur.
@pytest.mark.parametrize("lags,block,max_gap", [(24, 4096, 30), (24, 24, 30), (3, 3, 90), (5, 7, 4), (24, 24, 1), (2, 2, 200)])
def test_lags(spark, lags, block, max_gap):
    df, expected = make(spark, SIZES, max_gap=max_gap)
    rows = series.lag_features(df, lags=lags, block=block).collect()
    got = {(r["corridor"], r["ts"]): [r[f"lag_{k}"] for k in range(1, lags + 1)] for r in rows}
    wanted = {
        (c, t): [series_rows[i - k][1] for k in range(1, lags + 1)]
        for c, series_rows in expected.items() for i, (t, _) in enumerate(series_rows) if i >= lags
    }
    assert len(rows) == len(got) and got == wanted


@pytest.mark.parametrize("lookback,block,max_gap", [(24, 4096, 30), (24, 24, 30), (3, 3, 90), (5, 7, 4), (2, 2, 200)])
def test_sequences(spark, lookback, block, max_gap):
    df, expected = make(spark, SIZES, max_gap=max_gap)
    rows = series.sequence_windows(df, lookback=lookback, block=block).collect()
    got = {(r["corridor"], r["ts"]): (r["x"], r["y"]) for r in rows}
    wanted = {
        (c, t): ([float(x) for _, x in s[i - lookback:i]], float(v))
        for c, s in expected.items() for i, (t, v) in enumerate(s) if i >= lookback
    }
    assert len(rows) == len(got) and got == wanted


def test_no_task_sorts_a_whole_corridor(spark):
    """Row-level windows are partitioned by day or block as well as by corridor."""
    df, _ = make(spark, [50])
    for result in (series.with_position(df), series.lag_features(df), series.chronological_split(df)):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if "Window [" in line and "row_number" in line or "lag(" in line:
                assert "_day" in line or "block" in line


def test_nearest(spark):
    df, expected = make(spark, [0, 1, 60], max_gap=80)
    rng, asked = random.Random(3), []
    for c in (1, 2):
        first, last = expected[c][0][0], expected[c][-1][0]
        asked += [(c, first - dt.timedelta(days=9)), (c, last + dt.timedelta(days=9)), (c, first), (c, last)]
        asked += [(c, first + dt.timedelta(minutes=rng.randint(-9000, 200000))) for _ in range(150)]
    a, b = expected[2][10][0], expected[2][11][0]
    asked += [(2, a + (b - a) / 2)] * 3  # equally far: the earlier one
    requests = spark.createDataFrame(asked, "corridor int, target timestamp_ntz")
    got = {
        (r["corridor"], r["target"]): r
        for r in lookup.nearest_record(df, requests, ["traffic_volume"]).collect()
    }
    assert set(got) == set(asked)
    assert sum(r["n_requests"] for r in got.values()) == len(asked)
    for (c, target), row in got.items():
        at, volume = min(expected[c], key=lambda o: (abs(o[0] - target), o[0]))
        assert (row["nearest_ts"], row["traffic_volume"]) == (at, volume)
        assert row["seconds_off"] == abs(at - target).total_seconds()
        assert row["far"] == (abs(at - target) > dt.timedelta(hours=1))


def test_bad_request_times_are_set_aside(spark):
    df = spark.createDataFrame([(0, "2016-01-01 08:00:00"), (0, "tomorrow"), (0, None)], "corridor int, requested string")
    good, bad = lookup.parse_requests(df)
    assert good.count() == 1 and bad.count() == 2 and bad.filter(F.col("reason").isNull()).isEmpty()
