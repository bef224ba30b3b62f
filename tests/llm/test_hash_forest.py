"""The forest against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from roadpulse.llm import hash_forest as forest

SCHEMA = "vec_id long, embedding array<float>, label int, entry string, rank string"


def brute(rows, asked, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault(i, []).append(np.asarray(v, np.float32).astype(float))
    out = {}
    for q in good:
        if asked(q):
            hits = {}
            for i, vs in good.items():
                for v in vs:
                    for a in good[q]:
                        if i != q and len(a) == len(v):
                            s = min(1.0, float(a @ v / np.sqrt((a @ a) * (v @ v))))
                            hits[i] = max(hits.get(i, -2.0), s)
            out[q] = sorted(((-round(s, 12), i) for i, s in hits.items()))[:k]
    return out


def test_full_share_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(150)]
    same = rng.standard_normal(8).astype(np.float32).tolist()
    rows += [(200 + i, same) for i in range(30)] + [(250, [2 * x for x in same])]
    rows += [(300, None), (310, []), (320, [0.0] * 8), (330, [1.0] * 7 + [None]), (340, [1.0] * 7 + [float("nan")])]
    rows += [(350, [1.0] * 7 + [float("inf")]), (None, same), (360, [1.0, 2.0]), (370, [2.0, 1.0]), (0, rows[0][1]), (380, [1e-30] * 8)]
    df = spark.createDataFrame([(i, v, 0, "e", "r") for i, v in rows], SCHEMA)
    got = {}
    for r in forest.nearest(df, F.col("vec_id") % 10 == 0, share=1e9, block_rows=64, query_rows=10).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (-round(r.score, 12), r.vec_id)
    want = brute(rows, lambda q: q % 10 == 0)
    assert set(got) == {q for q, hits in want.items() if hits}
    for q, hits in got.items():
        assert [hits[n] for n in range(1, len(hits) + 1)] == want[q], q
    assert forest.nearest(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []


def test_recall_of_the_default_share():
    rng = np.random.default_rng(2)
    unit = rng.standard_normal((4000, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    found = forest.Forest(unit).candidates(unit[::50], 4000)
    score = unit[::50] @ unit.T
    top = np.argsort(-score, axis=1)[:, :6]
    recall = np.mean([np.isin(t, c).mean() for t, c in zip(top, found)])
    assert recall >= 0.9 and np.mean([len(c) for c in found]) < 3200


def test_descent_finds_the_longest_prefix():
    unit = np.eye(64)
    grown = forest.Forest(unit)
    strings = forest.hash_strings(unit[:3])
    assert (grown.longest(strings) == forest.BITS).all()
    assert all(i in c for i, c in enumerate(grown.candidates(unit[:3], 1)))
