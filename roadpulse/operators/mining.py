"""Frequent attribute combinations and association rules.

Each hour has exactly one value per attribute, so the cells of a cube over the
attributes are precisely the candidate itemsets.  The cube runs over counts
per combination rather than over rows: the data is read and shuffled once, in
pre-aggregated form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.sources.storage import stage

ATTRIBUTES = ["time_of_day", "day_type", "weather", "congestion"]
_ANY = "*"


def baskets(featured: DataFrame) -> DataFrame:
    """The four categorical items of each hour."""
    return featured.select(
        C.time_of_day(F.col("hour")).alias("time_of_day"),
        C.day_type(F.col("is_weekend")).alias("day_type"),
        F.col("weather_main").alias("weather"),
        F.col("congestion_category").alias("congestion"),
    )


def frequent_itemsets(
    transactions: DataFrame,
    min_support: float = S.MIN_SUPPORT,
    attributes: Sequence[str] = tuple(ATTRIBUTES),
) -> DataFrame:
    """``(mask, attributes..., n, support)``; an attribute outside the set is ``*``.

    Bit values of ``mask`` run from the last attribute (1) to the first.
    """
    whole = 2 ** len(attributes) - 1
    cells = transactions.groupBy(*attributes).agg(F.count(F.lit(1)).alias("n"))
    total = cells.agg(F.sum("n").alias("total"))
    cube = cells.cube(*attributes).agg(F.sum("n").alias("n"), (whole - F.grouping_id()).alias("mask"))
    bits = {a: 2 ** (len(attributes) - 1 - i) for i, a in enumerate(attributes)}
    return (
        cube.filter("mask > 0")
        .crossJoin(F.broadcast(total))  # one row
        .withColumn("support", C.ratio(F.col("n"), F.col("total")))
        .filter(F.col("support") >= min_support)
        .select(
            F.col("mask").cast("int").alias("mask"),
            *[F.when(_has(F.col("mask"), bits[a]), F.col(a)).otherwise(_ANY).alias(a) for a in attributes],
            "n",
            "support",
        )
    )


def named_items(transactions: DataFrame, attributes: Sequence[str] = tuple(ATTRIBUTES)) -> DataFrame:
    """Each row's ``attribute_value`` names as one array, without those of NULL attributes."""
    return transactions.select(F.array_compact(F.array(*[F.concat(F.lit(f"{a}_"), F.col(a)) for a in attributes])).alias("items"))


def pattern_itemsets(baskets: DataFrame, min_support: float = S.MIN_SUPPORT, items: str = "items") -> DataFrame:
    """``(items, n, support)`` of frequent sets by frequent-pattern trees, items in order.

    For baskets of any number of items, several of one kind among them, where a cube has no columns to stand on.  An
    item counts once in a basket; empty and NULL baskets count as baskets.
    """
    listed = stage(baskets.select(F.coalesce(F.array_distinct(items), F.array().cast("array<string>")).alias("items")), "baskets")
    total = listed.count()
    model = FPGrowth(itemsCol="items", minSupport=min_support).fit(listed)
    found = model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("n"))
    return found.withColumn("support", C.ratio(F.col("n"), F.lit(total)))


def _has(mask: Column, bit: int) -> Column:
    return mask.bitwiseAND(F.lit(bit)) != 0


def _items(mask: Column, values: Sequence[tuple[str, int, Column]]) -> Column:
    """Sorted ``attribute_value`` names of the attributes in a mask."""
    named = [F.when(_has(mask, bit), F.concat(F.lit(f"{a}_"), value)) for a, bit, value in values]
    return F.array_sort(F.array_compact(F.array(*named)))


def association_rules(
    itemsets: DataFrame, min_lift: float = 1.0, attributes: Sequence[str] = tuple(ATTRIBUTES)
) -> DataFrame:
    """Every split of every itemset into antecedent and consequent, by lift.

    Consequents may hold several items.  Sets over the same attributes are
    disjoint, so at most ``1 / min_support`` of them are frequent: with the
    defaults the joins below see no more than 750 rows a side.
    """
    bits = [(a, 2 ** (len(attributes) - 1 - i)) for i, a in enumerate(attributes)]
    # A set has at most 2^attributes - 2 proper parts.
    parts = F.filter(
        F.sequence(F.lit(1), F.col("mask") - 1), lambda p: p.bitwiseAND(F.col("mask")) == p
    )
    splits = itemsets.filter("mask > 1").withColumn("_left", F.explode(parts)).withColumn(
        "_right", F.col("mask") - F.col("_left")
    )

    def side(part: str) -> list[Column]:
        return [F.when(_has(F.col(part), bit), F.col(a)).otherwise(_ANY).alias(f"{part}_{a}") for a, bit in bits]

    splits = splits.select("*", *side("_left"), *side("_right"))
    for part in ("_left", "_right"):
        known = itemsets.select(
            F.col("mask").alias(part),
            *[F.col(a).alias(f"{part}_{a}") for a, _ in bits],
            F.col("support").alias(f"{part}_support"),
        )
        splits = splits.join(known, [part, *[f"{part}_{a}" for a, _ in bits]])
    confidence = C.ratio(F.col("support"), F.col("_left_support"))
    values = [(a, bit, F.col(a)) for a, bit in bits]
    return (
        splits.withColumn("confidence", confidence)
        .withColumn("lift", C.ratio(F.col("confidence"), F.col("_right_support")))
        .filter(F.col("lift") >= min_lift)
        .select(
            _items(F.col("_left"), values).alias("antecedents"),
            _items(F.col("_right"), values).alias("consequents"),
            F.col("_left_support").alias("antecedent_support"),
            F.col("_right_support").alias("consequent_support"),
            "support",
            "confidence",
            "lift",
        )
    )


def rules_for_target(
    rules: DataFrame,
    levels: Sequence[str] = tuple(S.CONGESTION_LEVELS),
    top: int = 8,
    attribute: str = "congestion",
) -> DataFrame:
    """The rules with the highest lift that predict one of the given levels."""
    wanted = F.array(*[F.lit(f"{attribute}_{level}") for level in levels])
    return (
        rules.filter(F.arrays_overlap("consequents", wanted))
        .withColumns({
            "antecedents": F.array_join("antecedents", ", "),
            "consequents": F.array_join("consequents", ", "),
        })
        .select(
            "antecedents", "consequents", "support", "confidence", "lift",
        )
        # Equal lifts computed from different counts differ in the last bits;
        # ordering by the rounded value makes ties go by name.
        .orderBy(F.desc(F.round("lift", 9)), "antecedents", "consequents")
        .limit(top)
    )
