"""Poisson replication: counts, shares, order, edge cases."""

import hashlib
import math
import re
from collections import Counter

from roadpulse.llm import mixing

SCHEMA = "doc_id long, text string, source string, copy string, rate string"


def inverse(u, mean):
    k, p = 0, math.exp(-mean)
    c = p
    while c <= u:
        k += 1
        p *= mean / k
        c += p
    return k


def draw(*parts):
    return int(hashlib.md5("|".join(parts).encode()).hexdigest()[:13], 16) / 2**52


def test_counts_follow_the_inverse_distribution(spark):
    rows = [(i, "abcde" * (1 + i % 3), "big" if i % 10 else "small", "c", "r") for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df).collect()
    size = Counter()
    for _, t, s, _, _ in rows:
        size[s] += len(t)
    scale = sum(size.values()) / sum(math.sqrt(v) for v in size.values())
    want = {i: inverse(draw(mixing.SEED, str(i), "0"), scale / math.sqrt(size[s])) for i, _, s, _, _ in rows}
    assert Counter(r.doc_id for r in got) == Counter({k: v for k, v in want.items() if v})
    assert all(sorted(r.copy for r in got if r.doc_id == i) == list(range(1, want[i] + 1)) for i in range(0, 2000, 97))
    chars = Counter()
    for r in got:
        chars[r.source] += len(r.text)
    target = math.sqrt(size["small"]) / (math.sqrt(size["small"]) + math.sqrt(size["big"]))
    assert abs(chars["small"] / sum(chars.values()) - target) < 0.05
    order = [r.doc_id for r in got]
    assert abs(sum(a < b for a, b in zip(order, order[1:])) / len(order) - 0.5) < 0.1


def test_large_means_are_sums_of_parts(spark):
    df = spark.createDataFrame([(1, "x" * 10, "rare", "", ""), (2, "y" * 10_000, "big", "", "")], SCHEMA)
    got = Counter(r.doc_id for r in mixing.mix(df, {"rare": 1.0, "big": 1.0}).collect())
    rate = 10_010 / 2 / 10
    parts = math.ceil(rate / mixing.PART_MEAN)
    assert got[1] == sum(inverse(draw(mixing.SEED, "1", str(j)), rate / parts) for j in range(parts)) and parts > 1


def test_edge_cases(spark):
    rows = [(1, None, "s", "", ""), (None, "text", None, "", ""), (2, "t", "s", "", ""), (2, "t", "s", "", ""), (3, "", "empty", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df, budget=20.0).collect()
    assert {r.source for r in got} == {None, "s"} and not {r.doc_id for r in got} & {3}
    assert Counter(r.doc_id for r in got)[2] % 2 == 0
    assert mixing.mix(df, {"s": 1.0}, budget=20.0).where("source is null").count() == 0
    assert mixing.mix(df.limit(0)).collect() == []


def test_each_row_draws_once(spark):
    df = spark.createDataFrame([(None, "text", "s", "", ""), (2, "t", "s", "", "")], SCHEMA)
    plan = mixing.mix(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(f"concat_ws(|, {mixing.SEED},") == 1
    terms = re.findall(r"filter\(__cumulative#\d+, lambdafunction\((.*?), lambda", plan)
    assert terms and not any("md5" in x for x in terms)


def test_large_means_of_rows_without_id(spark):
    df = spark.createDataFrame([(None, "x" * 10, "rare", "", ""), (2, "y" * 10_000, "big", "", "")], SCHEMA)
    got = Counter(r.doc_id for r in mixing.mix(df, {"rare": 1.0, "big": 1.0}).collect())
    rate, who = 10_010 / 2 / 10, hashlib.md5(b"x" * 10).hexdigest()
    parts = math.ceil(rate / mixing.PART_MEAN)
    assert got[None] == sum(inverse(draw(mixing.SEED, who, str(j)), rate / parts) for j in range(parts))
