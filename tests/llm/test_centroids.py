"""Integer clusters against plain Python."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, vector string"


def plain(rows, k=8, rounds=10, size=4):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(good, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    at = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(at))

    for _ in range(rounds):
        found = [near(v)[1] for _, v in good]
        for c in range(len(at)):
            mine = [v for (_, v), f in zip(good, found) if f == c]
            if mine:
                at[c] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [near(v) for _, v in good]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    whole = sum(d for d, _ in last)
    return sorted(
        (str(i), c, d, sum(x for x, y in last if y == c), whole, digest[c]) for (i, _), (d, c) in zip(good, last)
    )


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "c", "d", "v") for i, v in rows], SCHEMA)
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    found = centroids.cluster(df, components=4, **kw).withColumn("digest", digest)
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.digest) for r in found.collect())


def test_same_as_plain_python(spark):
    import random

    draw = random.Random(4)
    rows = [(i, [draw.choice([-1.0, 0.0, 2.0]) + draw.randrange(-64, 65) / 512 for _ in range(4)]) for i in range(300)]
    rows += [(1000 + i, [0.25, 0.25, -0.25, 0.5]) for i in range(200)]
    rows += [(7, rows[7][1]), (8, rows[9][1]), (None, [0.5] * 4), (None, [0.5] * 4)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 3), (2003, [1.0] * 5), (2004, [1.0, None, 1.0, 1.0])]
    rows += [(2005, [1.0, float("nan"), 1.0, 1.0]), (2006, [1.0, float("-inf"), 1.0, 1.0])]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows[:5], k=8) == plain(rows[:5])
    assert run(spark, [(i, [1.0] * 4) for i in range(20)]) == plain([(i, [1.0] * 4) for i in range(20)])
    assert run(spark, rows[-7:-5] + rows[-5:]) == [] == run(spark, [])


def test_components_too_large_for_a_distance_stop_the_job(spark):
    with pytest.raises(Exception, match="scaled component"):
        run(spark, [(1, [1e30, 0.0, 0.0, 0.0])])


def test_the_nearest_centroid_is_computed_once(spark):
    df = spark.createDataFrame([(1, [1, 2])], "vec_id long, vector array<bigint>")
    near = df.select(centroids.nearest(F.col("vector"), [[0, 0], [5, 5]]).alias("near"), "vector")
    plan = near.groupBy("near.cluster").agg(F.sum("near.distance"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_min") == 1
