"""Exact order statistics without sorting a whole column in one task.

Rows are first counted per distinct value (combined map-side, so a value held
by a third of all rows costs one row per map task).  The distinct values are
then cut into ranges; totals of earlier ranges give each range its starting
rank, and the running sums inside the ranges proceed in parallel.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES = 256


def value_counts(
    df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Rows ``(by..., value, n)``; NULL values are not counted."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(n.alias("n"))


def running_totals(
    counts: DataFrame,
    value: str,
    weights: Sequence[str],
    by: Sequence[str] = (),
    ranges: int = RANGES,
    few_groups: bool = False,
) -> DataFrame:
    """Add ``<w>_before`` (sum over smaller values) and ``<w>_total`` per group.

    ``counts`` has one row per ``(by, value)``.  No task sees more than about
    ``1/ranges`` of a group's distinct values.  ``few_groups`` states that the
    number of groups has a known small bound (months, features), so that their
    range bounds may be broadcast.
    """
    by = list(by)
    cuts = [i / ranges for i in range(1, ranges)]
    # The totals keep the weights in this aggregate, so that it shares the exchange of ``counts``.
    bounds = counts.groupBy(*by).agg(
        F.percentile_approx(value, cuts, 20 * ranges).alias("_bounds"),
        *[F.sum(w).alias(f"{w}_total") for w in weights],
    )
    # Without groups the bounds are a single row, which is a safe broadcast;
    # with any number of groups the join strategy is left to the measured size.
    if not by:
        joined = counts.crossJoin(F.broadcast(bounds))
    else:
        joined = counts.join(F.broadcast(bounds) if few_groups else bounds, by)
    below = F.size(F.filter("_bounds", lambda b: b < F.col(value)))
    ranged = joined.withColumn("_range", F.coalesce(below, F.lit(0))).drop("_bounds")

    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(w).alias(f"_sum_{w}") for w in weights])
    # At most `ranges` rows per group reach this window.
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_sum_{w}").over(earlier), F.lit(0)).alias(f"_start_{w}") for w in weights],
    )
    inside = (
        Window.partitionBy("_range", *by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    return ranged.join(starts, [*by, "_range"]).select(
        *counts.columns,
        *[
            (F.coalesce(F.sum(w).over(inside), F.lit(0)) + F.col(f"_start_{w}")).alias(f"{w}_before")
            for w in weights
        ],
        *[f"{w}_total" for w in weights],
    )


def quantiles(
    counts: DataFrame,
    value: str,
    named: Mapping[str, float],
    by: Sequence[str] = (),
    weight: str = "n",
    few_groups: bool = False,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group."""
    ranked = running_totals(counts, value, [weight], by, few_groups=few_groups)
    before, own, total = F.col(f"{weight}_before"), F.col(weight), F.col(f"{weight}_total")

    def holds(rank: Column) -> Column:
        return (before <= rank) & (rank < before + own)

    picks, results = [], []
    for name, share in named.items():
        rank = F.lit(float(share)) * (total - 1)
        picks += [
            F.max(F.when(holds(F.floor(rank)), F.col(value))).cast("double").alias(f"_lo_{name}"),
            F.max(F.when(holds(F.ceil(rank)), F.col(value))).cast("double").alias(f"_hi_{name}"),
            F.max(rank - F.floor(rank)).alias(f"_part_{name}"),
        ]
        results.append(
            (F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_part_{name}")).alias(name)
        )
    return ranked.groupBy(*by).agg(*picks).select(*by, *results)


def column_quantiles(
    df: DataFrame, value: str, named: Mapping[str, float], by: Sequence[str] = (), few_groups: bool = False
) -> DataFrame:
    return quantiles(value_counts(df, value, by), value, named, by, few_groups=few_groups)
