"""Row-position work on time series: splits, lags, sequences.

A series may be one corridor holding a third of the table, so nothing here
sorts a corridor in one task.  Days are counted first; a running sum over the
(few thousand) day counts of a corridor tells at which position each day
starts, and everything else happens inside a day or inside a block of
consecutive days.  Inputs hold one row per ``(key, ts)`` with whole-second
times, which bounds a day at 86,400 rows and a block at that plus its length.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.sources.storage import stage

BLOCK = 4096


def _day_offsets(df: DataFrame, key: Sequence[str], ts: str) -> DataFrame:
    """Per key and day: rows, rows on earlier days, rows in the whole series."""
    days = df.groupBy(*key, F.to_date(ts).alias("_day")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    return days.select(
        *key,
        "_day",
        "_rows",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(*key)).alias("series_rows"),
    )


def with_position(df: DataFrame, key: Sequence[str] = tuple(S.KEY), ts: str = S.TS) -> DataFrame:
    """Add ``position`` (1-based, by time) and ``series_rows``.

    The join and the window share the ``(key, day)`` partitioning.
    """
    in_day = Window.partitionBy("_day", *key).orderBy(ts)
    return (
        df.withColumn("_day", F.to_date(ts))
        .join(_day_offsets(df, key, ts), [*key, "_day"])
        .withColumn("position", F.col("_before") + F.row_number().over(in_day))
        .drop("_day", "_rows", "_before")
    )


def times_at_positions(
    df: DataFrame,
    positions: Mapping[str, Callable[[Column], Column]],
    key: Sequence[str] = tuple(S.KEY),
    ts: str = S.TS,
) -> DataFrame:
    """Per series, the times at given positions, as functions of its length.

    Only the days that contain a wanted position are sorted.  A position of 0
    or beyond the end yields NULL.
    """
    offsets = _day_offsets(df, key, ts)
    wanted = offsets.select(
        *key,
        "_day",
        "_before",
        "_rows",
        F.explode(
            F.array(*[
                F.struct(F.lit(name).alias("name"), at(F.col("series_rows")).cast("bigint").alias("at"))
                for name, at in positions.items()
            ])
        ).alias("_want"),
    ).filter((F.col("_want.at") > F.col("_before")) & (F.col("_want.at") <= F.col("_before") + F.col("_rows")))
    in_day = Window.partitionBy("_day", *key, "_want.name").orderBy(ts)
    found = (
        df.select(*key, ts, F.to_date(ts).alias("_day"))
        .join(wanted, [*key, "_day"])
        .withColumn("_at", F.col("_before") + F.row_number().over(in_day))
        .filter(F.col("_at") == F.col("_want.at"))
        .groupBy(*key)
        .agg(*[F.max(F.when(F.col("_want.name") == name, F.col(ts))).alias(name) for name in positions])
    )
    lengths = offsets.groupBy(*key).agg(F.max("series_rows").alias("series_rows"))
    return lengths.join(found, list(key), "left")


def share(of: float = S.TRAIN_SHARE, skip: int = 0) -> Callable[[Column], Column]:
    """Position of the last row of the first ``of`` share, after ``skip`` lead-in rows."""
    return lambda n: F.when(n > skip, skip + F.floor(F.lit(of) * (n - skip))).otherwise(0)


def written_cuts(
    df: DataFrame,
    positions: Mapping[str, Callable[[Column], Column]],
    key: Sequence[str] = tuple(S.KEY),
    ts: str = S.TS,
) -> DataFrame:
    """Cut times as a written table, so that its true size is known when joining.

    Up to the broadcast threshold the join then leaves ``df`` where it is;
    beyond, it is a shuffle join whose hot series adaptive execution splits.
    """
    return stage(times_at_positions(df, positions, key, ts).drop("series_rows"), "cut_times")


def chronological_split(
    df: DataFrame,
    train_share: float = S.TRAIN_SHARE,
    skip: int = 0,
    key: Sequence[str] = tuple(S.KEY),
    ts: str = S.TS,
) -> DataFrame:
    """Add ``is_train``: the first ``floor(share * n)`` rows of each series.

    ``df`` itself is not sorted for it, only compared with a cut time per
    series.  ``skip`` is the number of lead-in rows that lag building drops, so
    that the share is taken of the remaining rows.
    """
    cuts = written_cuts(df, {"_train_end": share(train_share, skip)}, key, ts)
    return (
        df.join(cuts, list(key), "left")
        .withColumn("is_train", F.coalesce(F.col(ts) <= F.col("_train_end"), F.lit(False)))
        .drop("_train_end")
    )


def split_halves(
    df: DataFrame,
    train_share: float = S.TRAIN_SHARE,
    first_n: int = 200,
    key: Sequence[str] = tuple(S.KEY),
    ts: str = S.TS,
) -> DataFrame:
    """Test rows only, with ``half`` (1 or 2) and ``in_first_n``."""
    train = share(train_share)
    positions = {
        "_train_end": train,
        "_half_end": lambda n: train(n) + F.floor((n - train(n)) / 2),
        "_first_end": lambda n: F.least(n, train(n) + first_n),
    }
    cuts = written_cuts(df, positions, key, ts)
    at = F.col(ts)
    return (
        df.join(cuts, list(key), "left")
        .filter(F.col("_train_end").isNull() | (at > F.col("_train_end")))
        .withColumn("half", F.when(at <= F.col("_half_end"), 1).otherwise(2))
        .withColumn("in_first_n", at <= F.col("_first_end"))
        .drop(*positions)
    )


def _day_blocks(df: DataFrame, lookback: int, block: int, key: Sequence[str], ts: str) -> DataFrame:
    """Which block of consecutive days each day belongs to, and which it leads into.

    A block starts with the first day at or after each multiple of ``block``
    rows.  A day leads into a later block when fewer than ``lookback`` rows lie
    between its end and that block's start; as blocks start at least ``block``
    rows apart on average, only the next two can qualify.
    """
    if block < lookback:
        raise ValueError("block must be at least as long as the look-back")
    days = _day_offsets(df, key, ts).withColumn("_block", F.floor(F.col("_before") / block))
    order = Window.partitionBy(*key).orderBy("_block")
    starts = days.groupBy(*key, "_block").agg(F.min("_before").alias("_start"))
    for step in (1, 2):
        starts = starts.withColumn(f"_next_{step}", F.lead("_block", step).over(order)).withColumn(
            f"_start_{step}", F.lead("_start", step).over(order)
        )
    end = F.col("_before") + F.col("_rows")
    into = [F.struct(F.col("_block").alias("block"), F.lit(True).alias("own"))] + [
        F.when(
            F.col(f"_start_{step}") - end < lookback,
            F.struct(F.col(f"_next_{step}").alias("block"), F.lit(False).alias("own")),
        )
        for step in (1, 2)
    ]
    return days.join(starts, [*key, "_block"]).select(*key, "_day", F.inline(F.array_compact(F.array(*into))))


def _in_blocks(df: DataFrame, lookback: int, block: int, key: Sequence[str], ts: str) -> DataFrame:
    """Rows by block, each block led by at least the last ``lookback`` rows before it."""
    return df.withColumn("_day", F.to_date(ts)).join(
        _day_blocks(df, lookback, block, key, ts), [*key, "_day"]
    ).drop("_day")


def lag_features(
    df: DataFrame,
    value: str = S.VOLUME,
    lags: int = S.LOOKBACK,
    block: int = BLOCK,
    key: Sequence[str] = tuple(S.KEY),
    ts: str = S.TS,
) -> DataFrame:
    """Add ``lag_1 .. lag_n`` by row position; rows without full history go.

    All lags share one window.  Its partitions hold a block and its lead-in,
    however long a series is.
    """
    window = Window.partitionBy("block", *key).orderBy(ts)
    return (
        _in_blocks(df, lags, block, key, ts)
        .select("*", *[F.lag(value, k).over(window).alias(f"lag_{k}") for k in range(1, lags + 1)])
        .filter("own")
        .drop("own", "block")
        .na.drop(subset=[f"lag_{k}" for k in range(1, lags + 1)])
    )


def sequence_windows(
    df: DataFrame,
    value: str = S.VOLUME,
    lookback: int = S.LOOKBACK,
    block: int = BLOCK,
    key: Sequence[str] = tuple(S.KEY),
    ts: str = S.TS,
) -> DataFrame:
    """``(key, ts, x, y)``: the previous values in time order and the next one.

    A block is gathered as one array and cut into overlapping slices, which is
    cheaper than a sliding frame that is rebuilt for every row.
    """
    row = F.struct(F.col(ts).alias("ts"), "own", F.col(value).cast("double").alias("y"))
    blocks = (
        _in_blocks(df.select(*key, ts, value), lookback, block, key, ts)
        .groupBy(*key, "block")
        .agg(F.array_sort(F.collect_list(row)).alias("_rows"))  # a block and its lead-in
        .withColumn("_values", F.transform("_rows", lambda r: r["y"]))
    )
    at = F.sequence(F.lit(lookback + 1), F.size("_rows"))
    cut = F.transform(
        F.when(F.size("_rows") > lookback, at).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            F.element_at("_rows", i).alias("row"), F.slice("_values", i - lookback, lookback).alias("x")
        ),
    )
    return (
        blocks.select(*key, F.explode(cut).alias("_cut"))
        .filter("_cut.row.own")
        .select(*key, F.col("_cut.row.ts").alias(ts), F.col("_cut.x").alias("x"), F.col("_cut.row.y").alias("y"))
    )


def train_scale(df: DataFrame, value: str, is_train: str = "is_train") -> DataFrame:
    """Mean and population deviation over the training rows, as one row."""
    on_train = F.when(F.col(is_train), F.col(value).cast("double"))
    return df.agg(F.avg(on_train).alias("train_mean"), F.stddev_pop(on_train).alias("train_std"))
