import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.operators import cleaning, features
from roadpulse.sources import files


def raw(spark, rows):
    """Rows as (date_time, weather, volume, temp, rain, holiday)."""
    full = [(0, h, t, r, 0.0, 40, w, f" {w.upper()} ", at, v) for at, w, v, t, r, h in rows]
    return spark.createDataFrame(full, S.RAW_SCHEMA)


AT = "2016-03-01 08:00:00"


def test_min_view_and_first_row_differ(spark):
    """Minima of different rows make a row that never was; the first row stays whole."""
    df = raw(spark, [
        (AT, "Rain", 100, 280.0, 0.0, "None"),
        (AT, "Clear", 300, 290.0, 0.0, "None"),
        (AT, "Mist", 200, 270.0, 0.0, "None"),
    ])
    hour = cleaning.hourly_from_raw(df).first()
    assert (hour["traffic_volume"], hour["temp"], hour["weather_main"]) == (100, 270.0, "Clear")
    first = cleaning.keep_first(cleaning.parse_times(cleaning.standardise_text(df))).first()
    assert (first["traffic_volume"], first["temp"], first["weather_main"]) == (200, 270.0, "Mist")


def test_first_row_does_not_depend_on_partitioning(spark):
    rows = [(AT, w, v, 280.0, 0.0, "None") for w, v in [("Rain", 1), ("Mist", 2), ("Haze", 3), ("Fog", 4)] * 5]
    parsed = cleaning.parse_times(cleaning.standardise_text(raw(spark, rows)))
    found = {tuple(cleaning.keep_first(parsed.repartition(n)).first()) for n in (1, 3, 7)}
    assert len(found) == 1


def test_first_row_keeps_one_row_per_key_before_the_shuffle(spark):
    """A key that fills the table must not travel to one task row by row."""
    parsed = cleaning.parse_times(cleaning.standardise_text(raw(spark, [(AT, "Rain", 1, 280.0, 0.0, "None")])))
    plan = cleaning.keep_first(parsed)._jdf.queryExecution().executedPlan().toString()
    partial, shuffle = plan.index("Partial"), plan.rindex("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan and partial > shuffle  # printed top-down: below the exchange


def test_holiday_is_null_on_ordinary_days(spark):
    df = cleaning.standardise_text(raw(spark, [
        (AT, "Rain", 1, 280.0, 0.0, "None"), (AT, "Rain", 1, 280.0, 0.0, " Labor Day\t"), (AT, "Rain", 1, 280.0, 0.0, None),
    ]))
    assert {(r["holiday"], r["is_holiday"]) for r in df.collect()} == {(None, False), ("Labor Day", True)}
    assert {r["weather_description"] for r in df.collect()} == {"rain"}


def test_malformed_times_are_dropped(spark):
    df = raw(spark, [(AT, "Rain", 1, 280.0, 0.0, "None"), ("soon", "Rain", 1, 280.0, 0.0, "None"), (None, "Rain", 1, 280.0, 0.0, "None")])
    assert [r["ts"] for r in cleaning.parse_times(df).collect()] == [dt.datetime(2016, 3, 1, 8)]


def test_monthly_median(spark):
    df = raw(spark, [
        ("2016-01-01 00:00:00", "Rain", 1, 270.0, 0.0, "None"),
        ("2017-01-01 01:00:00", "Rain", 1, 274.0, 0.0, "None"),
        ("2016-01-01 02:00:00", "Rain", 1, 0.0, 9831.0, "None"),
        ("2016-02-01 00:00:00", "Rain", 1, 0.0, 0.0, "None"),      # no valid reading this month
        ("2016-03-01 00:00:00", "Rain", 1, None, None, "None"),    # unknown is not invalid
    ])
    got = {r["ts"].strftime("%m-%d %H"): (r["temp"], r["rain_1h"]) for r in cleaning.clean(df).collect()}
    assert got["01-01 02"] == (272.0, 0.0)
    assert got["02-01 00"] == (0.0, 0.0)
    assert got["03-01 00"] == (None, None)


def test_audit_adds_up(spark):
    df = raw(spark, [(AT, "Rain", 1, 280.0, 0.0, "None")] * 2 + [
        (AT, "Mist", 1, 280.0, 0.0, "None"), ("soon", "Rain", 1, 280.0, 0.0, "None"),
        ("2016-03-02 08:00:00", "Rain", 1, 0.0, 0.0, "Labor Day"), ("2016-03-03 08:00:00", "Rain", 1, 281.0, 0.0, "None"),
    ])
    steps = {r["step"]: (r["rows_before"], r["rows_after"], r["rows_affected"]) for r in cleaning.clean_audit(df).collect()}
    assert steps["parse_times"] == (6, 5, 1)
    assert steps["drop_exact_copies"] == (5, 4, 1)
    assert steps["keep_first_per_hour"] == (4, 3, 1)
    assert steps["impute_temp"] == (3, 3, 1)
    assert steps["flag_holidays"][2] == 1


def test_quartile_bands_are_right_closed(spark):
    df = raw(spark, [(f"2016-03-01 {h:02d}:00:00", "Rain", v, 280.0, 0.0, "None") for h, v in enumerate([10, 20, 30, 40, 50])])
    got = {
        r["traffic_volume"]: r["congestion_category"]
        for r in features.add_congestion_category(cleaning.clean(df)).collect()
    }
    assert got == {10: "Low", 20: "Low", 30: "Medium", 40: "High", 50: "Severe"}


def test_constant_column_scales_to_null(spark):
    df = raw(spark, [(f"2016-03-01 {h:02d}:00:00", "Rain", 1, 280.0, 0.0, "None") for h in range(3)])
    assert {r["temp_scaled"] for r in features.add_scaled(cleaning.clean(df)).collect()} == {None}


def test_steps_equal_the_whole(spark):
    df = cleaning.clean(raw(spark, [
        (f"2016-03-{d:02d} {h:02d}:00:00", w, 100 * h + d, 270.0 + h, 0.0, "None")
        for d, w in enumerate(S.WEATHER_VALUES, 1) for h in range(0, 24, 6)
    ]))
    steps = features.add_congestion_category(
        features.add_scaled(features.add_weather_features(features.add_time_features(df)))
    )
    whole = features.engineer(df)
    saved = features.engineer(df, features.fit_feature_params(df))
    assert steps.columns == whole.columns == saved.columns
    assert whole.exceptAll(steps).isEmpty() and whole.exceptAll(saved).isEmpty()
    assert all(sum(r[f"weather_{w}"] for w in S.WEATHER_VALUES) == 1 for r in whole.collect())


def test_missing_column_fails_before_any_job(spark, tmp_path):
    (tmp_path / "a.csv").write_text("holiday,temp\nNone,280\n")
    with pytest.raises(S.SchemaError, match="date_time"):
        files.read_raw_csv(spark, str(tmp_path / "a.csv"))


HEADER = ",".join(S.RAW_COLUMNS)
GOOD = f"None,280.5,0.0,0.0,40,Clouds,few clouds,{AT},545"


@pytest.mark.parametrize("text,kind", [
    (None, "missing file"),
    ("", "empty file"),
    (HEADER + "\n", "empty file"),
    (f"{HEADER}\n{GOOD}\nNone,warm,0.0,0.0,40,Clouds,few clouds,{AT},545\n", "parse error"),
    (f"{HEADER}\n{GOOD}\n".replace("few clouds", "few \xe9"), "bad encoding"),
])
def test_load_failures_are_named(spark, tmp_path, text, kind):
    path = Path(tmp_path) / "a.csv"
    if text is not None:
        path.write_bytes(text.encode("latin-1"))
    with pytest.raises(files.LoadError) as failure:
        files.check_load(spark, str(path))
    assert failure.value.kind == kind


def test_csv_round_trip(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(f"{HEADER}\n{GOOD}\n")
    files.check_load(spark, str(path))
    row = files.read_raw_csv(spark, str(path)).first()
    assert (row["corridor"], row["temp"], row["traffic_volume"]) == (0, 280.5, 545)
    files.save_csv(files.read_raw_csv(spark, str(path)), str(tmp_path / "out"))
    assert files.read_raw_csv(spark, str(tmp_path / "out")).first() == row


def test_saved_view_is_used_when_present(spark):
    df = raw(spark, [(AT, "Rain", 100, 280.0, 0.0, "None"), (AT, "Clear", 300, 270.0, 0.0, "None")])
    spark.catalog.dropTempView("traffic_hourly")
    assert files.load_hourly(spark, df).first()["temp"] == 270.0 and "rain_1h" in files.load_hourly(spark, df).columns
    files.create_hourly_view(df)
    assert set(files.load_hourly(spark, df).columns) == {"corridor", "ts", "traffic_volume", "temp", "holiday", "weather_main"}
    assert files.load_hourly(spark, df).select(F.min("traffic_volume")).first()[0] == 100
    spark.catalog.dropTempView("traffic_hourly")


def test_broken_lines_go_to_quarantine(spark, tmp_path):
    path, target = tmp_path / "a.csv", str(tmp_path / "bad")
    short = ",".join(GOOD.split(",")[:3])
    path.write_bytes(f"{HEADER}\n{GOOD}\n{short}\n{GOOD.replace('280.5', 'warm')}\n".encode() + GOOD.replace("few", "f\xff").encode("latin-1") + b"\n")
    good = files.quarantine(spark, str(path), target)
    assert [r.temp for r in good.collect()] == [280.5] and "_broken" not in good.columns
    rows = spark.read.parquet(target).collect()
    assert sorted(r.reason for r in rows) == ["bad encoding", "parse error", "parse error"]
    assert short in {r.line for r in rows} and all(r.source == str(path) for r in rows)
    # A second load adds to the table.
    files.quarantine(spark, str(path), target)
    assert spark.read.parquet(target).count() == 6


def test_only_changed_years_of_a_catalog_table_are_rebuilt(spark, tmp_path):
    path, name = str(tmp_path / "hourly"), "hourly_of_test"
    old = raw(spark, [("2016-05-01 08:00:00", "Rain", 100, 280.0, 0.0, "None"), ("2017-05-01 08:00:00", "Rain", 200, 280.0, 0.0, "None")])
    new = raw(spark, [("2017-05-01 08:00:00", "Rain", 50, 280.0, 0.0, "None"), ("not a date", "Rain", 1, 280.0, 0.0, "None")])
    read = lambda: sorted((r.year, r.traffic_volume) for r in spark.table(name).select("year", "traffic_volume").collect())
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert files.refresh_hourly_table(spark, old, old, path, name) == [2016, 2017]
    assert read() == [(2016, 100), (2017, 200)]
    kept = {p.name for p in (tmp_path / "hourly" / "year=2016").iterdir()}
    both = old.unionByName(new)
    assert files.refresh_hourly_table(spark, both, new, path, name) == [2017]
    assert read() == [(2016, 100), (2017, 50)] and {p.name for p in (tmp_path / "hourly" / "year=2016").iterdir()} == kept
    assert files.refresh_hourly_table(spark, both, new.limit(0), path, name) == []
    spark.sql(f"DROP TABLE {name}")
