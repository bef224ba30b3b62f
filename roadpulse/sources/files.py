"""CSV and parquet sources and sinks with named load failures."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.operators import cleaning
from roadpulse.sources.storage import stage

_BROKEN = "_broken"


class LoadError(RuntimeError):
    """A raw file could not be loaded; ``kind`` names the reason."""

    def __init__(self, kind: str, detail: str):
        super().__init__(f"{kind}: {detail}")
        self.kind = kind


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line, without a pass over the data."""
    try:
        columns = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise LoadError("missing file", path) from error
        if "UNABLE_TO_INFER_SCHEMA" in str(error):
            raise LoadError("empty file", path) from error
        raise
    if not columns:
        raise LoadError("empty file", path)
    return columns


def read_raw_csv(spark: SparkSession, path: str, corridor: int = 0, keep_broken: bool = False) -> DataFrame:
    """Raw observations with a fixed schema; missing columns fail before any job.

    A file without a corridor column belongs to a single sensor.  With
    ``keep_broken`` malformed lines are kept in ``_broken`` for
    :func:`load_problems`; otherwise the first one fails the job.
    """
    header = _header(spark, path)
    S.require_columns(header)
    types = {**S.RAW_TYPES, "corridor": T.IntegerType()}
    fields = [T.StructField(name, types.get(name, T.StringType())) for name in header]
    reader = spark.read.option("header", True)
    if keep_broken:
        fields.append(T.StructField(_BROKEN, T.StringType()))
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BROKEN)
    else:
        reader = reader.option("mode", "FAILFAST")
    df = reader.schema(T.StructType(fields)).csv(path)
    if "corridor" not in header:
        df = df.withColumn("corridor", F.lit(corridor))
    return df.select("corridor", *S.RAW_COLUMNS, *([_BROKEN] if keep_broken else []))


def load_problems(broken_kept: DataFrame) -> DataFrame:
    """Rows, malformed lines, undecodable characters and filled cells of a permissive load.

    Counting the cells of every column makes the reader convert all of them;
    it would not notice a malformed value in a column nobody asks for.
    """
    return broken_kept.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(_BROKEN).isNotNull()).alias("malformed"),
        F.count_if(_undecodable(broken_kept)).alias("undecodable"),
        *[F.count(c).alias(f"filled_{c}") for c in broken_kept.columns if c != _BROKEN],
    )


def check_load(spark: SparkSession, path: str) -> None:
    """Raise :class:`LoadError` naming what is wrong with a raw file."""
    found = load_problems(read_raw_csv(spark, path, keep_broken=True)).first()
    if found["rows"] == 0:
        raise LoadError("empty file", path)
    if found["malformed"]:
        raise LoadError("parse error", f"{found['malformed']} malformed lines in {path}")
    if found["undecodable"]:
        raise LoadError("bad encoding", f"{found['undecodable']} undecodable lines in {path}")


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_by_year(df: DataFrame, path: str, ts: str = S.TS) -> None:
    """Parquet by year.  Each task writes the years it holds: no shuffle before the sink."""
    df.withColumn("year", F.year(ts)).write.mode("overwrite").partitionBy("year").parquet(path)


def save_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def load_features(spark: SparkSession, path: str) -> DataFrame:
    """A table saved by year.  No global sort: operators state the order they need."""
    return spark.read.parquet(path)


def quarantine(spark: SparkSession, path: str, target: str, corridor: int = 0) -> DataFrame:
    """The good rows of a raw file; broken lines are added to the table at ``target`` with a reason and their text.

    The file is read once and written as a table, from which both parts are taken.
    """
    loaded = stage(read_raw_csv(spark, path, corridor, keep_broken=True), "loaded")
    cells = [c for c in loaded.columns if c != _BROKEN]
    reason = F.when(F.col(_BROKEN).isNotNull(), "parse error").when(_undecodable(loaded), "bad encoding")
    marked = loaded.withColumn("reason", reason)
    line = F.coalesce(F.col(_BROKEN), F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cells]))
    marked.filter("reason IS NOT NULL").select(
        "reason", line.alias("line"), F.lit(path).alias("source"), F.current_timestamp().alias("found_at")
    ).write.mode("append").parquet(target)
    return marked.filter("reason IS NULL").select(*cells)


def _undecodable(df: DataFrame) -> Column:
    """Whether any text of a row holds the character that stands for undecodable bytes."""
    found = F.lit(False)
    for field in df.schema:
        if isinstance(field.dataType, T.StringType) and field.name != _BROKEN:
            found = found | F.coalesce(F.contains(F.col(field.name), F.lit("�")), F.lit(False))
    return found


def create_hourly_view(raw: DataFrame, name: str = "traffic_hourly") -> DataFrame:
    """Register the hourly view, replacing an older one."""
    view = cleaning.hourly_from_raw(raw)
    view.createOrReplaceTempView(name)
    return view


def load_hourly(spark: SparkSession, raw: DataFrame, name: str = "traffic_hourly") -> DataFrame:
    """The saved view if there is one, else whole first rows per hour of the raw table."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return cleaning.keep_first(cleaning.parse_times(cleaning.standardise_text(raw)))


def refresh_hourly_table(spark: SparkSession, raw: DataFrame, changed: DataFrame, path: str, name: str = "traffic_hourly_table") -> list[int]:
    """Bring a catalog table of the hourly view up to date with ``raw``; only years with rows in ``changed`` are rebuilt.

    The table is kept by year at ``path``.  Returns the years that were rewritten, of which there are few.
    """
    year = F.year(C.parse_time(F.col("date_time")))
    years = sorted(r[0] for r in changed.select(year.alias("year")).filter("year IS NOT NULL").distinct().collect())
    if years:
        rebuilt = cleaning.hourly_from_raw(raw.filter(year.isin(years))).withColumn("year", F.year(S.TS))
        rebuilt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path, "parquet")
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return years
