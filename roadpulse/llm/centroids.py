"""Centroid clustering in whole numbers, with nothing but column expressions.

Every component x becomes floor(scale * x).  A vector's distances to the centroids are
``aggregate`` over ``zip_with`` against literal arrays, ``array_min`` over structs (distance, number)
takes the nearest one, and a round ends with one sum for each component, grouped by cluster:
map tasks send one row a cluster, however many vectors they read.  Only those sums, k rows a round,
reach the driver, which divides them and writes the next literals.  Sums, means and distances are
integers, so a result depends neither on the order of rows nor on the number of tasks.

Defined results: vectors null, of another length, or with a null or non-finite component take no part.  Vectors need
not have an id; those without one come last when first centroids are chosen.  Repeated rows count as
often as they occur, and a repeated id may give several first centroids; equal hashes fall to the smaller vector.  Ties of distances go to
the smaller number.  With fewer than k vectors there are as many centroids as vectors, an empty table
gives no rows.  Long vectors only mean more sums (above about 90 components Spark leaves generated
code for the grouping).  Distances are longs: components beyond ``LARGEST`` after scaling stop the
job with a message, since their squares would not fit.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.sources.storage import stage

CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
COMPONENTS = 64
SEED = 3


def largest(components: int) -> int:
    """The greatest magnitude whose squared differences, summed over the components, stay below 2^63."""
    return int((2**61 / max(1, components)) ** 0.5)


def integers(vector: Column, scale: int = SCALE, components: int = COMPONENTS) -> Column:
    """floor(scale * x) of every component; null for a vector that takes no part."""
    value = lambda x: x.cast("double")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(value(x)) | (F.abs(value(x)) == float("inf")))
    limit = largest(components)
    whole = F.transform(vector, lambda x: F.floor(value(x) * scale))
    fits = F.forall(vector, lambda x: F.abs(value(x) * scale) < limit)
    checked = F.when(fits, whole).otherwise(F.raise_error(F.lit(f"a scaled component is not below {limit}")).cast("array<bigint>"))
    return F.when((F.size(vector) == components) & ~bad, checked)


def distance(vector: Column, centroid: list[int]) -> Column:
    """Squared Euclidean distance to a literal centroid."""
    squares = F.zip_with(vector, F.lit(centroid).cast("array<bigint>"), lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, x: total + x)


def nearest(vector: Column, centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid, the smaller number among equals."""
    return F.array_min(F.array(*[
        F.struct(distance(vector, c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)
    ]))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The k vectors whose ids hash lowest, in the order of the hashes."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    chosen = vectors.select(hashed.alias("hash"), "vector").orderBy(F.asc_nulls_last("hash"), "vector").limit(k)
    return [list(r.vector) for r in chosen.collect()]


def round_sums(vectors: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, int, list[int]]]:
    """Of each cluster that has vectors: their number, summed distance and sum of every component."""
    size = len(centroids[0])
    assigned = vectors.select(nearest(F.col("vector"), centroids).alias("near"), "vector")
    sums = assigned.groupBy("near.cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("near.distance").alias("inertia"),
        *[F.sum(F.col("vector")[i]).alias(f"s{i}") for i in range(size)],
    )
    return {r[0]: (r[1], r[2], list(r[3:])) for r in sums.collect()}  # at most k rows


def fit(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> list[list[int]]:
    """Centroids after the given number of rounds; an empty cluster keeps its centroid.

    A round that moves nothing ends the work: further rounds would repeat it.
    """
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        moved = list(centroids)
        for cluster, (n, _, sums) in round_sums(vectors, centroids).items():
            moved[cluster] = [s // n for s in sums]
        if moved == centroids:
            break
        centroids = moved
    return centroids


def cluster(
    df: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE, components: int = COMPONENTS
) -> DataFrame:
    """vec_id, vector (integers), cluster and distance of every vector that takes part, with the inertia
    of its cluster and of all, and its centroid."""
    whole = df.select("vec_id", integers(F.col("embedding"), scale, components).alias("vector")).where(F.col("vector").isNotNull())
    vectors = stage(whole, "integer-vectors")
    centroids = fit(vectors, k, rounds, seed)
    if not centroids:
        centroids = [[0] * components]
    parts = round_sums(vectors, centroids)
    inertias = [parts[i][1] if i in parts else 0 for i in range(len(centroids))]
    at = F.col("near.cluster") + 1
    return vectors.select("vec_id", "vector", nearest(F.col("vector"), centroids).alias("near")).select(
        "vec_id", "vector", "near.cluster", "near.distance",
        F.element_at(F.lit(inertias).cast("array<bigint>"), at).alias("cluster_inertia"),
        F.lit(sum(inertias)).cast("bigint").alias("inertia"),
        F.element_at(F.array(*[F.lit(c).cast("array<bigint>") for c in centroids]), at).alias("centroid"),
    )


def report(df: DataFrame) -> DataFrame:
    """``cluster`` with digests of the centroids in place of the arrays."""
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    return cluster(df).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def sql(k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE, components: int = COMPONENTS) -> str:
    """The same in SQL: one row for each component, one written step for each round."""
    steps = [f"""
      kept AS MATERIALIZED (
        SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE len(embedding) = {components} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {components}),
      cells AS MATERIALIZED (SELECT row, unnest(v) AS x, unnest(range({components})) AS i FROM kept),
      c0 AS MATERIALIZED (
        SELECT k, unnest(v) AS x, unnest(range({components})) AS i FROM (
          SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 AS k, v FROM kept) WHERE k < {k})"""]
    near = """
        SELECT row, k, d FROM (
          SELECT row, k, d, row_number() OVER (PARTITION BY row ORDER BY d, k) AS place FROM (
            SELECT row, k, sum((cells.x - c.x) * (cells.x - c.x)) AS d FROM cells JOIN {c} c USING (i) GROUP BY row, k)) WHERE place = 1"""
    for r in range(rounds):
        steps.append(f"""
      a{r} AS MATERIALIZED ({near.format(c=f'c{r}')}),
      m{r} AS MATERIALIZED (SELECT k, i, sum(x) AS s, count(*) AS n FROM a{r} JOIN cells USING (row) GROUP BY k, i),
      c{r + 1} AS MATERIALIZED (
        SELECT c.k, c.i, coalesce((s - ((s % n) + n) % n) // n, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON c.k = m.k AND c.i = m.i)""")
    steps.append(f"""
      last AS MATERIALIZED ({near.format(c=f'c{rounds}')}),
      digests AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k)""")
    return f"""WITH {','.join(steps)}
      SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
        CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
      FROM last JOIN kept USING (row) JOIN digests USING (k)"""
