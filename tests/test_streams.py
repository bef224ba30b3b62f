"""Streams over several batches."""

import datetime as dt

from roadpulse import schema as S
from roadpulse.operators import cleaning
from roadpulse.streaming import arrivals, ingest, monitoring


def _row(day, hour=8, volume=100):
    return (1, "None", 280.0, 0.0, 0.0, 20, "Clear", "sky is clear", f"2016-05-{day:02d} {hour:02d}:00:00", volume)


def test_late_rows_are_counted(spark, tmp_path):
    batches = [[_row(1), _row(1, 9)], [_row(5), _row(1, 9)], [_row(6)], [_row(7), _row(2), _row(6, 8)]]
    path = str(tmp_path / "raw")
    for rows in batches:
        frame = spark.createDataFrame(rows, ["corridor", *S.RAW_COLUMNS])
        typed = frame.select(*[frame[f.name].cast(f.dataType) for f in S.RAW_SCHEMA])
        typed.coalesce(1).write.mode("append").parquet(path)
    medians = spark.createDataFrame([(5, 281.0, 0.0)], "month int, temp_median double, rain_1h_median double")
    cleaned = ingest.clean_stream(ingest.raw_stream(spark, path, files_per_batch=1), medians, late="1 day")
    query = ingest.write_stream(cleaned, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "out")).count()
    # Six different hours arrive; the second day's comes five days late.
    assert (kept, ingest.late_rows(query)) == (5, 1)


def _typed(spark, rows):
    frame = spark.createDataFrame(rows, ["corridor", *S.RAW_COLUMNS])
    return frame.select(*[frame[f.name].cast(f.dataType) for f in S.RAW_SCHEMA]).coalesce(1)


def _on(date, hour=8, volume=100, temp=280.0):
    return (1, "None", temp, 0.0, 0.0, 20, "Clear", "sky is clear", f"{date} {hour:02d}:00:00", volume)


def test_stream_and_merge_equal_the_batch_job(spark, tmp_path):
    source, path, out, state = (str(tmp_path / n) for n in ("raw", "arrivals", "out", "state"))
    medians = spark.createDataFrame([(m, 281.0, 0.0) for m in range(1, 13)], "month int, temp_median double, rain_1h_median double")
    batches = [
        [_on("2016-05-01"), _on("2016-05-02"), _on("2017-01-01", volume=7), _on("not a date")],
        [_on("2016-05-01", volume=50), _on("2017-01-01", 9, temp=0.0)],
        [_on("2016-05-03", 1)],
        [_on("2018-02-01")],
    ]
    every, touched = [], []
    for rows in batches:
        every += rows
        _typed(spark, rows).write.mode("append").parquet(source)
        arrivals.arrive(ingest.raw_stream(spark, source, files_per_batch=1), path, state).awaitTermination()
        touched.append(arrivals.merge(spark, path, out, medians))
        assert arrivals.merge(spark, path, out, medians) == []
        want = arrivals.repaired(cleaning.keep_first(cleaning.parse_times(cleaning.standardise_text(_typed(spark, every)))), medians)
        columns = ["corridor", "ts", "traffic_volume", "temp", "rain_1h"]
        rows_of = lambda df: sorted(map(tuple, df.select(*columns).collect()))
        assert rows_of(spark.read.parquet(out)) == rows_of(want)
    assert touched == [[2016, 2017], [2016, 2017], [2016], [2018]]
    counts = {r.batch: (r.n_rows, r.n_late) for r in arrivals.late_counts(spark, path).collect()}
    assert counts == {0: (3, 0), 1: (2, 1), 2: (1, 1), 3: (1, 0)}
    assert arrivals.arrived(spark, path).filter("late").count() == 2


def test_merging_before_anything_arrived(spark, tmp_path):
    assert arrivals.merge(spark, str(tmp_path / "none"), str(tmp_path / "out"), spark.createDataFrame([], "month int, temp_median double, rain_1h_median double")) == []


def test_open_days_are_closed_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("rows", "out", "state"))
    schema = "ts timestamp_ntz, hour int"

    def add(days):
        data = [(dt.datetime(2016, 5, d, h), h) for d in days for h in range(0, 24, 6)]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        monitoring.monitor_stream(stream, training, ["hour"], out, state).awaitTermination()
        for _ in range(2):
            monitoring.close_days(spark.read.parquet(source), training, ["hour"], out)
        return sorted(str(r.day) for r in monitoring.daily_results(spark, out).select("day").collect())

    training = spark.createDataFrame([("hour", float(h), 10) for h in range(0, 24, 6)], "feature string, value double, n_train long")
    add([1, 2, 3, 4])
    assert run() == [f"2016-05-0{d}" for d in (1, 2, 3, 4)]
    add([5, 6, 7, 8])
    assert run() == [f"2016-05-0{d}" for d in range(1, 9)]
