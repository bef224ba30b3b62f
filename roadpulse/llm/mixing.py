"""Mixing sources to target weights by Poisson replication.

Each source has a target repetition rate: its share of the mix over its share of the corpus.  A
document's number of copies is the inverse of the Poisson distribution with that mean at a number
drawn from a hash of the document, so any run and any machine draws the same.  Copies are exploded
and dealt out by another hash, which shuffles the whole mix.

Defined cases: a null source is a source of its own; a source without a given weight has weight 0;
a null text counts no characters, and a source without any characters is left out; repeated rows
draw the same count and each is replicated; a null doc_id draws from the text; a text of any length is
measured, hashed and carried along; the order of copies with equal random places is open; columns of the input named
``copy`` or ``position`` are replaced; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.sources.storage import stage

SEED = "mix-1"
#: Default weights: a source's size to this power.
TEMPERATURE = 0.5
#: Means above this are drawn as the sum of several equal parts, each inside double range.
PART_MEAN = 200.0
#: Draws are 52-bit, so terms of the distribution past this many deviations never matter.
_DRAW = 2.0**52


def _uniform(*parts: Column) -> Column:
    """In [0, 1), from the first 52 bits of an MD5 hash."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("bigint") / F.lit(_DRAW)


def _identity(text: str) -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))


def target_rates(
    df: DataFrame, weights: dict[str | None, float] | None = None, budget: float = 1.0, text: str = "text",
    source: str = "source", temperature: float = TEMPERATURE,
) -> DataFrame:
    """source, size in characters, and the mean number of copies of its documents.

    ``weights`` are relative; by default they are sizes to the power ``temperature``.  ``budget`` is
    the size of the mix over that of the corpus.
    """
    sizes = df.groupBy(F.col(source).alias("source")).agg(F.sum(F.length(F.coalesce(text, F.lit("")))).alias("size")).where("size > 0")
    if weights is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(float(temperature)))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    sizes = stage(sizes.withColumn("weight", weight), "source-sizes")
    total, size = sizes.agg(F.sum("weight"), F.sum("size")).first()
    scale = float(budget) * (size or 0) / total if total else 0.0
    return sizes.select("source", "size", (F.col("weight") * F.lit(scale) / F.col("size")).alias("rate"))


def _with_distribution(rates: DataFrame) -> DataFrame:
    """Number of parts and the cumulative distribution of one part, long enough for any 52-bit draw."""
    parts = F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1)).cast("int")
    mean = rates.withColumn("parts", parts).withColumn("mean", F.col("rate") / F.col("parts"))
    terms = F.ceil(F.col("mean") + 10 * F.sqrt("mean") + 30).cast("int")
    zero = F.exp(-F.col("mean"))

    def add(state: Column, k: Column) -> Column:
        p = state["p"] * F.col("mean") / k
        return F.struct(p.alias("p"), F.array_append(state["c"], F.element_at(state["c"], -1) + p).alias("c"))

    cumulative = F.aggregate(F.sequence(F.lit(1), terms), F.struct(zero.alias("p"), F.array(zero).alias("c")), add, lambda s: s["c"])
    return mean.select("source", "parts", cumulative.alias("cumulative"))


def _count(identity: Column, seed: str) -> Column:
    """Copies of a row: for each of its parts, the terms that a draw reaches.

    Identity and draws are elements of arrays: the optimizer writes a column's expression into the
    functions that use it, so a plain column would be hashed anew for every term of the distribution.
    """
    parts = F.sequence(F.lit(0), F.col("__parts") - 1)
    draws = lambda who: F.transform(parts, lambda part: _uniform(F.lit(seed), who, part.cast("string")))
    reached = lambda n, u: n + F.size(F.filter("__cumulative", lambda c: c <= u))
    return F.element_at(F.transform(F.array(identity), lambda who: F.aggregate(draws(who), F.lit(0), reached)), 1)


def replicate(df: DataFrame, rates: DataFrame, text: str = "text", source: str = "source", seed: str = SEED) -> DataFrame:
    """``df`` with each row repeated by its drawn count and ``copy`` from 1; rows that draw 0 are gone."""
    # Written, so that the join knows the size of this side before it deals out documents.
    drawn = stage(_with_distribution(rates), "distributions").select(
        F.col("source").alias("__source"), F.col("parts").alias("__parts"), F.col("cumulative").alias("__cumulative")
    )
    joined = df.join(drawn, F.col(source).eqNullSafe(F.col("__source")))
    # A null explodes to no row; a filter on the count would have the join count every row once more.
    copies = F.when(F.col("__n") > 0, F.sequence(F.lit(1).cast("long"), F.col("__n").cast("long")))
    return (
        joined.withColumn("__n", _count(_identity(text), seed))
        .withColumn("copy", F.explode(copies))
        .drop("__source", "__parts", "__cumulative", "__n")
    )


def mix(
    df: DataFrame, weights: dict[str | None, float] | None = None, budget: float = 1.0, text: str = "text",
    source: str = "source", temperature: float = TEMPERATURE, seed: str = SEED,
) -> DataFrame:
    """The mix in random order: columns of ``df``, ``copy``, and ``position``, the random sort key."""
    copies = replicate(df, target_rates(df, weights, budget, text, source, temperature), text, source, seed)
    place = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(f"{seed}/order"), _identity(text), F.col("copy").cast("string"))), 1, 13), 16, 10)
    return copies.withColumn("position", place.cast("bigint")).repartition("position").sortWithinPartitions("position")


#: The default mix in DuckDB: the distribution by recursion, one row per term.
SQL = f"""
WITH RECURSIVE docs AS (
  SELECT *, coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS identity FROM documents
), sizes AS (
  SELECT source, sum(length(coalesce(text, ''))) AS size FROM documents GROUP BY source
), weighted AS (
  SELECT source, size, pow(CAST(size AS DOUBLE), {TEMPERATURE}) AS weight FROM sizes WHERE size > 0
), rates AS (
  SELECT source, weight * (1.0 * (SELECT sum(size) FROM weighted) / (SELECT sum(weight) FROM weighted)) / size AS rate FROM weighted
), parts AS (
  SELECT source, CAST(greatest(ceil(rate / {PART_MEAN}), 1) AS INT) AS parts, rate / greatest(ceil(rate / {PART_MEAN}), 1) AS mean FROM rates
), terms AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM parts
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM terms WHERE k < ceil(mean + 10 * sqrt(mean) + 30)
), draws AS (
  SELECT doc_id, identity, source, lang, n_chars, text, unnest(range(0, parts)) AS part
  FROM docs JOIN parts USING (source)
), drawn AS (
  SELECT *, CAST('0x' || substr(md5(concat_ws('|', '{SEED}', identity, CAST(part AS VARCHAR))), 1, 13) AS BIGINT) / {_DRAW} AS u FROM draws
), counts AS (
  SELECT doc_id, identity, source, lang, n_chars, text, CAST(sum((SELECT count(*) FROM terms t WHERE t.source = d.source AND t.c <= d.u)) AS BIGINT) AS n
  FROM drawn d GROUP BY ALL
), copies AS (
  SELECT *, unnest(range(1, n + 1)) AS copy FROM counts
)
SELECT doc_id, source, lang, n_chars, text, copy,
       CAST('0x' || substr(md5(concat_ws('|', '{SEED}/order', identity, CAST(copy AS VARCHAR))), 1, 13) AS BIGINT) AS position
FROM copies
"""
