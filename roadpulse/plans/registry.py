"""Named queries, each with the SQL statement that must give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _presentable(df: DataFrame, digits: int | None) -> DataFrame:
    """Plain result types: bigint, rounded double, ISO text for dates."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            column = column.cast("double")
            if digits is not None:
                column = F.round(column, digits) + F.lit(0.0)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, oracle: str | None = None, digits: int | None = 6) -> Callable[[Query], Query]:
    """Register a query; rounding is the last step of its result."""

    def register(build: Query) -> Query:
        @functools.wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _presentable(build(spark, sf_dir), digits)

        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register
