"""Loading, load checks, cleaning and the audit trail."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.operators import cleaning, jobs, loading
from roadpulse.operators.series import chronological_split
from roadpulse.plans import inputs
from roadpulse.plans.oracle import r, rounded, sql
from roadpulse.plans.registry import query
from roadpulse.sources import files
from roadpulse.sources.storage import new_path, stage

_RAW_COLS = ", ".join(S.RAW_COLUMNS)


@query("scan_raw", sql("traffic_raw", f"SELECT corridor, {_RAW_COLS} FROM traffic_raw"))
def scan_raw(spark, sf_dir):
    return inputs.raw(spark, sf_dir)


@query("scan_csv", sql("traffic_raw", """
    SELECT corridor, holiday, weather_main, count(*) AS n, CAST(sum(traffic_volume) AS BIGINT) AS volume,
           count(temp) AS temps FROM traffic_raw GROUP BY ALL"""))
def scan_csv(spark, sf_dir):
    path = new_path(spark, "raw_csv")
    inputs.raw(spark, sf_dir).write.option("header", True).csv(path)
    return files.read_raw_csv(spark, path).groupBy("corridor", "holiday", "weather_main").agg(
        F.count(F.lit(1)).alias("n"), F.sum("traffic_volume").alias("volume"), F.count("temp").alias("temps")
    )


@query("sink_replace_table", sql("traffic_raw", """
    SELECT corridor, count(*) AS n, CAST(sum(traffic_volume) AS BIGINT) AS volume FROM traffic_raw GROUP BY corridor"""))
def sink_replace_table(spark, sf_dir):
    """The second load replaces the first instead of adding to it."""
    path = new_path(spark, "traffic_raw")
    df = inputs.raw(spark, sf_dir)
    for _ in range(2):
        files.replace_table(df, path)
    return spark.read.schema(df.schema).parquet(path).groupBy("corridor").agg(
        F.count(F.lit(1)).alias("n"), F.sum("traffic_volume").alias("volume")
    )


@query("sink_cleaned", sql("cleaned", f"""
    SELECT year(ts) AS year, count(*) AS n, {r('avg(temp)')} AS mean_temp FROM cleaned GROUP BY 1"""))
def sink_cleaned(spark, sf_dir):
    """The cleaned table, stored by year so that later readers skip years."""
    path = new_path(spark, "cleaned_by_year")
    files.save_by_year(inputs.cleaned(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.avg("temp").alias("mean_temp")
    )


@query("cleaning_job", sql("cleaned", """
    SELECT year(ts) AS year, count(*) AS cleaned_hours, count(*) AS featured_hours FROM cleaned GROUP BY 1"""))
def cleaning_job(spark, sf_dir):
    """Raw file to both tables in one job; hours of each table by year."""
    source, target = new_path(spark, "raw_csv"), new_path(spark, "tables")
    inputs.raw(spark, sf_dir).write.option("header", True).csv(source)
    jobs.run_pipeline(spark, source, target)
    tables = [files.load_features(spark, f"{target}/{name}").groupBy("year").agg(F.count(F.lit(1)).alias(f"{name}_hours")) for name in ("cleaned", "featured")]
    return tables[0].join(tables[1], "year", "full")


def _planted(spark, sf_dir):
    """Path of a raw CSV in which some lines are broken, by their cloud cover: a cell too many, no number, undecodable bytes."""
    path, clouds = new_path(spark, "raw_planted"), F.col("clouds_all")
    text = inputs.raw(spark, sf_dir)
    text = text.withColumns({
        "temp": F.when(clouds == 14, "warm").otherwise(F.col("temp").cast("string")),
        "weather_description": F.when(clouds == 15, "heavy � rain").otherwise(F.col("weather_description")),
        "traffic_volume": F.when(clouds == 13, "1,2").otherwise(F.col("traffic_volume").cast("string")),
    })
    text.write.option("header", True).option("quote", "\u0000").csv(path)
    return path


@query("quarantined_lines", sql("traffic_raw", """
    SELECT CASE WHEN clouds_all IN (13, 14) THEN 'parse error' WHEN clouds_all = 15 THEN 'bad encoding' ELSE 'good' END AS reason,
      count(*) AS n, count(*) AS with_text FROM traffic_raw GROUP BY 1"""))
def quarantined_lines(spark, sf_dir):
    """Broken lines go to a table with their reason, good ones onward."""
    target = new_path(spark, "quarantine")
    good = files.quarantine(spark, _planted(spark, sf_dir), target)
    bad = spark.read.parquet(target).groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.length("line") > 20).alias("with_text"))
    counted = good.agg(F.lit("good").alias("reason"), F.count(F.lit(1)).alias("n"), F.count("weather_main").alias("with_text"))
    return bad.unionByName(counted)


@query("sink_featured_csv", sql("featured", f"""
    SELECT year(ts) AS year, count(*) AS n, {r('sum(temp)', 2)} AS temp_sum, count(congestion_category) AS with_category FROM featured GROUP BY 1"""), digits=2)
def sink_featured_csv(spark, sf_dir):
    """The featured table of the batch job as CSV, read back."""
    source, target = new_path(spark, "raw_csv"), new_path(spark, "tables")
    inputs.raw(spark, sf_dir).write.option("header", True).csv(source)
    jobs.run_pipeline(spark, source, target, keep_going=True, csv=True)
    table = spark.read.option("header", True).schema(files.load_features(spark, f"{target}/featured").schema).csv(f"{target}/featured_csv")
    return table.groupBy(F.year("ts").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("temp").alias("temp_sum"), F.count("congestion_category").alias("with_category")
    )


@query("refreshed_view", sql("traffic_raw traffic_hourly", """
    , late AS (SELECT DISTINCT year(TRY_CAST(date_time AS TIMESTAMP)) AS year FROM traffic_raw WHERE clouds_all = 77 AND month(TRY_CAST(date_time AS TIMESTAMP)) = 2
      AND year(TRY_CAST(date_time AS TIMESTAMP)) = 1996)
    SELECT year(ts) AS year, count(*) AS hours, CAST(sum(traffic_volume) AS BIGINT) AS volume, year(ts) IN (FROM late) AS rewritten FROM traffic_hourly GROUP BY 1"""))
def refreshed_view(spark, sf_dir):
    """A catalog table of the hourly view after a second load that brings rows of one year: that year's folder alone is new."""
    path, name = new_path(spark, "hourly_table"), f"hourly_{uuid.uuid4().hex}"
    raw, at = inputs.raw(spark, sf_dir), C.parse_time(F.col("date_time"))
    second = F.coalesce((F.col("clouds_all") == 77) & (F.month(at) == 2) & (F.year(at) == 1996), F.lit(False))
    first = raw.filter(~second)
    files.refresh_hourly_table(spark, first, first, path, name)
    before = spark.table(name).select("year", F.col("_metadata.file_path").alias("file")).distinct()
    before = stage(before, "files-before")
    files.refresh_hourly_table(spark, raw, raw.filter(second), path, name)
    kept = F.col("_metadata.file_path").alias("file")
    table = spark.table(name).select("year", "traffic_volume", kept).join(F.broadcast(before.withColumn("old", F.lit(True))), ["year", "file"], "left")  # one row a file
    return table.groupBy("year").agg(
        F.count(F.lit(1)).alias("hours"), F.sum("traffic_volume").alias("volume"), (F.count("old") == 0).alias("rewritten")
    )


@query("verify_load", sql("traffic_raw", """
    SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(10 AS BIGINT) AS column_count,
      'corridor, holiday, temp, rain_1h, snow_1h, clouds_all, weather_main, weather_description, date_time, traffic_volume' AS columns,
      min(TRY_CAST(date_time AS TIMESTAMP)) AS earliest, max(TRY_CAST(date_time AS TIMESTAMP)) AS latest,
      count(*) FILTER (n > 1) AS duplicate_groups, '' AS missing_columns
    FROM (SELECT corridor, date_time, count(*) AS n FROM traffic_raw GROUP BY 1, 2)"""))
def verify_load(spark, sf_dir):
    df = inputs.raw(spark, sf_dir)
    return loading.verify_load(df.select("corridor", *S.RAW_COLUMNS))


_SCHEMA_ROWS = [
    ("corridor", "int"), ("holiday", "string"), ("temp", "double"), ("rain_1h", "double"), ("snow_1h", "double"),
    ("clouds_all", "int"), ("weather_main", "string"), ("weather_description", "string"),
    ("date_time", "string"), ("traffic_volume", "bigint"),
]


@query("schema_report", sql("traffic_raw", " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS position, '{n}' AS column_name, '{t}' AS column_type, count({n}) AS filled_rows FROM traffic_raw"
    for i, (n, t) in enumerate(_SCHEMA_ROWS))))
def schema_report(spark, sf_dir):
    return loading.schema_report(inputs.raw(spark, sf_dir).select("corridor", *S.RAW_COLUMNS))


@query("row_count", sql("traffic_raw", "SELECT count(*) AS row_count FROM traffic_raw"))
def row_count(spark, sf_dir):
    return loading.row_count(inputs.raw(spark, sf_dir))


@query("time_range", sql("parsed", "SELECT min(ts) AS earliest, max(ts) AS latest FROM parsed"))
def time_range(spark, sf_dir):
    return loading.time_range(inputs.parsed(spark, sf_dir))


@query("duplicate_groups", sql("traffic_raw", """
    SELECT count(*) AS duplicate_groups FROM (
      SELECT 1 FROM traffic_raw GROUP BY corridor, date_time HAVING count(*) > 1)"""))
def duplicate_groups(spark, sf_dir):
    return loading.duplicate_groups(inputs.raw(spark, sf_dir))


_PREVIEW = ["date_time", "corridor", "holiday", "temp", "rain_1h", "snow_1h", "clouds_all",
            "weather_main", "weather_description", "traffic_volume"]


@query("preview", sql("traffic_raw", f"""
    SELECT {', '.join(_PREVIEW)} FROM traffic_raw ORDER BY {', '.join(_PREVIEW)} LIMIT 5"""))
def preview(spark, sf_dir):
    return loading.preview(inputs.raw(spark, sf_dir).select(*_PREVIEW), 5)


@query("hourly_min_view", sql("traffic_hourly", "SELECT * FROM traffic_hourly"))
def hourly_min_view(spark, sf_dir):
    return inputs.hourly(spark, sf_dir)


@query("clean_text", sql("traffic_raw", """
    SELECT lower(trim(weather_description)) AS weather_description, count(*) AS n,
           count(*) FILTER (weather_description <> lower(trim(weather_description))) AS changed
    FROM traffic_raw GROUP BY 1"""))
def clean_text(spark, sf_dir):
    before = F.col("weather_description")
    after = C.clean_description(before)
    return inputs.raw(spark, sf_dir).groupBy(after.alias("weather_description")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~before.eqNullSafe(after)).alias("changed")
    )


@query("holiday_flag", sql("parsed", """
    SELECT corridor, ts, holiday, holiday IS NOT NULL AS is_holiday FROM parsed"""))
def holiday_flag(spark, sf_dir):
    return inputs.parsed(spark, sf_dir).select("corridor", "ts", "holiday", "is_holiday")


@query("parse_time", sql("traffic_raw", """
    SELECT corridor, count(*) AS n, count(TRY_CAST(date_time AS TIMESTAMP)) AS parsed,
           count(*) - count(TRY_CAST(date_time AS TIMESTAMP)) AS dropped,
           min(TRY_CAST(date_time AS TIMESTAMP)) AS earliest, max(TRY_CAST(date_time AS TIMESTAMP)) AS latest
    FROM traffic_raw GROUP BY corridor"""))
def parse_time(spark, sf_dir):
    ts = C.parse_time(F.col("date_time"))
    return inputs.raw(spark, sf_dir).groupBy("corridor").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(ts).alias("parsed"),
        F.count_if(ts.isNull()).alias("dropped"),
        F.min(ts).alias("earliest"),
        F.max(ts).alias("latest"),
    )


@query("invalid_masks", sql("parsed", """
    SELECT corridor, ts, temp, rain_1h, coalesce(temp <= 0, false) AS bad_temp, coalesce(rain_1h > 9000, false) AS bad_rain
    FROM parsed WHERE temp <= 0 OR rain_1h > 9000"""))
def invalid_masks(spark, sf_dir):
    return (
        inputs.parsed(spark, sf_dir)
        .select(
            "corridor", "ts", "temp", "rain_1h",
            cleaning.invalid_temp().alias("bad_temp"), cleaning.invalid_rain().alias("bad_rain"),
        )
        .filter("bad_temp OR bad_rain")
    )


@query("dedup_keep_first", sql("first_rows", """
    SELECT corridor, ts, holiday, temp, rain_1h, snow_1h, clouds_all, weather_main, weather_description,
           traffic_volume, is_holiday FROM first_rows"""))
def dedup_keep_first(spark, sf_dir):
    return cleaning.keep_first(inputs.parsed(spark, sf_dir))


@query("distinct_rows", sql("traffic_raw", f"SELECT DISTINCT corridor, {_RAW_COLS} FROM traffic_raw"))
def distinct_rows(spark, sf_dir):
    return cleaning.distinct_rows(inputs.raw(spark, sf_dir))


@query("monthly_median", sql("first_rows", f"""
    SELECT month, {rounded('temp_median rain_1h_median')} FROM
      (SELECT month(ts) AS month, median(temp) AS temp_median FROM first_rows WHERE temp > 0 GROUP BY 1)
      FULL JOIN (SELECT month(ts) AS month, median(rain_1h) AS rain_1h_median FROM first_rows WHERE rain_1h <= 9000 GROUP BY 1)
      USING (month)"""))
def monthly_median(spark, sf_dir):
    df = inputs.first_rows(spark, sf_dir)
    temps = cleaning.monthly_medians(df, "temp", cleaning.invalid_temp())
    rains = cleaning.monthly_medians(df, "rain_1h", cleaning.invalid_rain())
    return temps.join(rains, "month", "full")


@query("monthly_median_impute", sql("cleaned", f"""
    SELECT corridor, ts, {rounded('temp rain_1h')}, traffic_volume, weather_main, is_holiday FROM cleaned"""))
def monthly_median_impute(spark, sf_dir):
    return cleaning.repair_readings(inputs.first_rows(spark, sf_dir)).select(
        "corridor", "ts", "temp", "rain_1h", "traffic_volume", "weather_main", "is_holiday"
    )


@query("conditional_assign", sql("first_rows", f"""
    SELECT corridor, ts, CASE WHEN rain_1h > 9000 THEN 0E0 ELSE rain_1h END AS rain_1h FROM first_rows"""))
def conditional_assign(spark, sf_dir):
    return inputs.first_rows(spark, sf_dir).select(
        "corridor", "ts",
        F.when(cleaning.invalid_rain(), 0.0).otherwise(F.col("rain_1h")).alias("rain_1h"),
    )


@query("clean_audit", sql("first_rows", """
    , months AS (
      SELECT month(ts) AS m, count(*) FILTER (temp <= 0) AS bt, count(*) FILTER (temp > 0) AS gt,
             count(*) FILTER (rain_1h > 9000) AS br, count(*) FILTER (rain_1h <= 9000) AS gr
      FROM first_rows GROUP BY 1),
    k AS (SELECT
      (SELECT count(*) FROM traffic_raw) AS raw_n, (SELECT count(*) FROM parsed) AS parsed_n,
      (SELECT count(*) FROM (SELECT DISTINCT * FROM parsed)) AS distinct_n, (SELECT count(*) FROM first_rows) AS hours_n,
      (SELECT count(*) FROM traffic_raw WHERE weather_description <> lower(trim(weather_description))) AS text_n,
      (SELECT count(*) FROM traffic_raw WHERE holiday <> 'None') AS holiday_n,
      (SELECT CAST(sum(CASE WHEN gt > 0 THEN bt ELSE 0 END) AS BIGINT) FROM months) AS temp_n,
      (SELECT CAST(sum(CASE WHEN gr > 0 THEN br ELSE 0 END) AS BIGINT) FROM months) AS rain_n)
    SELECT CAST(position AS BIGINT) AS position, step, rows_before, rows_after, rows_affected FROM (
      SELECT 1 AS position, 'standardise_text' AS step, raw_n AS rows_before, raw_n AS rows_after, text_n AS rows_affected FROM k
      UNION ALL SELECT 2, 'flag_holidays', raw_n, raw_n, holiday_n FROM k
      UNION ALL SELECT 3, 'parse_times', raw_n, parsed_n, raw_n - parsed_n FROM k
      UNION ALL SELECT 4, 'drop_exact_copies', parsed_n, distinct_n, parsed_n - distinct_n FROM k
      UNION ALL SELECT 5, 'keep_first_per_hour', distinct_n, hours_n, distinct_n - hours_n FROM k
      UNION ALL SELECT 6, 'impute_temp', hours_n, hours_n, temp_n FROM k
      UNION ALL SELECT 7, 'impute_rain', hours_n, hours_n, rain_n FROM k)"""))
def clean_audit(spark, sf_dir):
    return cleaning.clean_audit(inputs.raw(spark, sf_dir))


@query("feature_audit", sql("split params", f"""
    SELECT {r('temp_min')} AS temp_min, {r('temp_max')} AS temp_max,
      CAST(clouds_min AS BIGINT) AS clouds_all_min, CAST(clouds_max AS BIGINT) AS clouds_all_max,
      {rounded('q1 q2 q3')}, n, n_high_risk, {rounded('share_high_risk')}, n_train, train_until, test_from
    FROM params, (SELECT count(*) AS n, CAST(sum(high_risk) AS BIGINT) AS n_high_risk, avg(high_risk) AS share_high_risk,
        count(*) FILTER (is_train) AS n_train, max(ts) FILTER (is_train) AS train_until,
        min(ts) FILTER (NOT is_train) AS test_from FROM split)"""))
def feature_audit(spark, sf_dir):
    """Fitted scalars, label balance and split bounds in one row."""
    from roadpulse.operators.features import fit_feature_params

    labels = chronological_split(inputs.featured(spark, sf_dir).select("corridor", "ts", "high_risk")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("high_risk").alias("n_high_risk"),
        F.avg("high_risk").alias("share_high_risk"),
        F.count_if("is_train").alias("n_train"),
        F.max(F.when(F.col("is_train"), F.col("ts"))).alias("train_until"),
        F.min(F.when(~F.col("is_train"), F.col("ts"))).alias("test_from"),
    )
    return fit_feature_params(inputs.cleaned(spark, sf_dir)).crossJoin(F.broadcast(labels))
