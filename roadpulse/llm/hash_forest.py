"""Nearest neighbours by cosine from hash-prefix forests.

Distinct vectors are dealt at random into index blocks of bounded size.  In a block every tree is a
sorted array of hash strings, the sides of random planes a vector lies on.  A query descends in each
tree to the entries with its longest common prefix; then all trees ascend together, one bit at a
time, until they hold enough candidates, which are scored exactly.  Each block returns a few rows a
query, and the nearest of all blocks win.

Equal vectors are one entry that carries its smallest ids, so a vector on a third of all rows costs
no more than any other.  Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part, nor do rows without an id; vectors of different lengths never meet; a
row that repeats an id and its vector counts once, and of one id's different vectors each is a
candidate; ties go to the smaller id; with fewer candidates all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadpulse.sources.storage import stage

TREES = 32
BITS = 64
#: Candidates a query gathers from a block's trees, repeats included, over the block's rows.
CANDIDATE_SHARE = 1.0
BLOCK_ROWS = 8192
QUERY_ROWS = 2048
SEED = 20


def usable(vector: Column) -> Column:
    """True for vectors that can have a direction."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def planes(width: int, trees: int, bits: int) -> np.ndarray:
    return np.random.default_rng([SEED, width]).standard_normal((trees, width, bits))


def hash_strings(unit: np.ndarray, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """(trees, rows): the first plane's side is the highest bit."""
    out = np.zeros((trees, len(unit)), np.uint64)
    for t, plane in enumerate(planes(unit.shape[1], trees, bits)):
        sides = unit @ plane > 0
        for b in range(bits):
            out[t] = (out[t] << np.uint64(1)) | sides[:, b]
    return out


class Forest:
    """Sorted hash strings of one block's unit vectors."""

    def __init__(self, unit: np.ndarray, trees: int = TREES, bits: int = BITS):
        self.unit, self.bits = unit, bits
        hashes = hash_strings(unit, trees, bits)
        self.order = np.argsort(hashes, axis=1, kind="stable")
        self.hashes = np.take_along_axis(hashes, self.order, 1)

    def ranges(self, strings: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(trees, queries): the part of each sorted array that shares the first ``level`` bits."""
        low_bits = np.uint64((1 << (self.bits - level)) - 1)
        low, high = strings & ~low_bits, strings | low_bits
        start = np.stack([np.searchsorted(h, x, "left") for h, x in zip(self.hashes, low)])
        stop = np.stack([np.searchsorted(h, x, "right") for h, x in zip(self.hashes, high)])
        return start, stop

    def longest(self, strings: np.ndarray) -> np.ndarray:
        """Per query, the longest prefix that any tree has in common with it."""
        best = np.zeros(strings.shape[1], np.int64)
        for h, x in zip(self.hashes, strings):
            at = np.searchsorted(h, x)
            for near in (np.clip(at - 1, 0, len(h) - 1), np.clip(at, 0, len(h) - 1)):
                differ = h[near] ^ x
                best = np.maximum(best, self.bits - np.array([int(d).bit_length() for d in differ]))
        return best

    def candidates(self, queries: np.ndarray, wanted: int) -> list[np.ndarray]:
        """Rows of the block for each query, at least ``wanted`` counted over trees if there are as many."""
        strings = hash_strings(queries, len(self.hashes), self.bits)
        level, open_ = self.longest(strings), np.ones(len(queries), bool)
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
        for step in range(int(level.max(initial=0)), -1, -1):
            now = np.flatnonzero(open_ & (level >= step))
            if not len(now):
                continue
            start, stop = self.ranges(strings[:, now], step)
            enough = ((stop - start).sum(axis=0) >= wanted) | (step == 0)
            for j in np.flatnonzero(enough):
                held = np.zeros(len(self.unit), bool)
                for t in range(len(self.order)):
                    held[self.order[t, start[t, j] : stop[t, j]]] = True
                found[now[j]] = np.flatnonzero(held)
            open_[now[enough]] = False
        return found


def _unit(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    raw = np.stack([np.asarray(v, np.float64) for v in vectors])
    # Scaled by the largest component first, so that no square overflows or vanishes.
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw, scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _search(key: tuple, index: pd.DataFrame, queries: pd.DataFrame, k: int, share: float) -> pd.DataFrame:
    columns = ["query", "entry", "first_id", "score"]
    if not len(index) or not len(queries):
        return pd.DataFrame({c: pd.Series(dtype="float64" if c == "score" else "int64" if c == "first_id" else "object") for c in columns})
    index = index.sort_values("entry", ignore_index=True)
    _, unit = _unit(index["vector"])
    _, asked = _unit(queries["vector"])
    first, names = index["first_id"].to_numpy(), index["entry"].to_numpy()
    forest, out = Forest(unit), []
    for name, vector, rows in zip(queries["entry"], asked, forest.candidates(asked, math.ceil(share * len(unit)))):
        score = np.minimum(unit[rows] @ vector, 1.0)
        best = np.lexsort((first[rows], -score))[: k + 1]
        out.append(pd.DataFrame({"query": name, "entry": names[rows[best]], "first_id": first[rows[best]], "score": score[best]}))
    return pd.concat(out, ignore_index=True)


def nearest(
    index: DataFrame, is_query: Column, k: int = 5, id_: str = "vec_id", vector: str = "embedding",
    share: float = CANDIDATE_SHARE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows of ``index`` to each of its rows with ``is_query``."""
    rows = index.where(F.col(id_).isNotNull() & usable(F.col(vector))).select(
        F.col(id_).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double") + F.lit(0.0)).alias("vector"), is_query.alias("asked")
    )
    rows = rows.withColumn("entry", F.sha2(F.array_join(F.transform("vector", lambda x: x.cast("string")), " "), 256))
    ids = stage(rows.groupBy("entry", "id").agg(F.max("asked").alias("asked")), "vector-ids")
    # Of each entry only the k + 1 smallest ids can be among a query's k nearest: a limit per group ahead of the shuffle.
    small = ids.withColumn("n", F.row_number().over(W.partitionBy("entry").orderBy("id"))).where(F.col("n") <= k + 1)
    small = stage(small.groupBy("entry").agg(F.sort_array(F.collect_list("id")).alias("ids")), "entry-ids")
    asked = ids.where("asked").select("entry").distinct()
    vectors = rows.groupBy("entry").agg(F.any_value("vector").alias("vector"))
    entries = vectors.join(small, "entry").select("entry", "vector", F.element_at("ids", 1).alias("first_id"), F.size("vector").alias("width"))
    entries = stage(entries.join(asked.withColumn("asked", F.lit(True)), "entry", "left"), "entries")
    n, m = entries.agg(F.count(F.lit(1)), F.count("asked")).first()
    blocks, parts = max(1, math.ceil(n / block_rows)), max(1, math.ceil(m / query_rows))
    deal = lambda count, salt: F.pmod(F.xxhash64("entry", F.lit(salt)), F.lit(count))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    base = entries.withColumn("block", deal(blocks, 1)).withColumn("part", every(parts))
    queries = entries.where("asked").withColumn("part", deal(parts, 2)).withColumn("block", every(blocks))
    key, pairs = ["width", "block", "part"], blocks * parts
    found = (
        base.repartition(pairs, *key).groupBy(*key)
        .cogroup(queries.select("entry", "vector", *key).repartition(pairs, *key).groupBy(*key))
        .applyInPandas(lambda g, a, b: _search(g, a, b, k, share), "query string, entry string, first_id long, score double")
    )
    best = W.partitionBy("query").orderBy(F.desc("score"), "first_id")
    found = stage(found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n"), "nearest-entries")
    # From entries back to rows: every asking id against the ids of the entries found.
    listed = found.join(small, "entry").groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
    answers = ids.where("asked").join(listed, F.col("entry") == F.col("query")).select(F.col("id").alias("query_id"), "found")
    near = F.flatten(F.transform("found", lambda f: F.transform(f["ids"], lambda i: F.struct((-f["score"]).alias("far"), i.alias("id")))))
    ranked = F.slice(F.array_sort(F.filter(near, lambda x: x["id"] != F.col("query_id"))), 1, k)
    return answers.select("query_id", F.posexplode(ranked).alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.far")).alias("score")
    )
