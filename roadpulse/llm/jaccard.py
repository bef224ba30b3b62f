"""Near-duplicate documents by a Jaccard join on shingles with token-combination prefixes.

Tokens, here shingles, are ordered from rare to frequent.  If two sets are similar enough, one of
them has a prefix in this order of which the other misses at most t tokens, so prefixes must meet.
Frequent tokens make poor keys alone: they are dealt into classes, and the keys of a class are its
combinations of k prefix tokens.  A class of n prefix tokens with k-combinations can have n - k + 1
misses before no key is shared, so the prefix is extended until all classes together allow more
than t.  Rare tokens keep k = 1.  Documents that share a key are candidates; overlaps are counted exactly.

Steps: sets are hashed; a document goes on only if few enough of its tokens are its own; equal
sets become one node; keys join nodes into candidate groups; groups are verified in blocks of
bounded size; links make components.

Defined cases: a null text, or one without words, has size 0 and links with nothing; a row without
doc_id links with nothing and has no component; rows that repeat a doc_id are nodes by their
texts and share the least id of their component, which also settles ties; a text of any length is hashed in one
piece, with some forty bytes of memory a byte, and its set is one value; ``classes`` reads no other column, ``keep_one``
hands all of them on; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import repeats
from roadpulse.llm.batches import pieces, text_buffer
from roadpulse.llm.components import components
from roadpulse.llm.words import Words, mix, shingle_sets
from roadpulse.sources.storage import stage

SHINGLE = 5
PERCENT = 80
#: Of eight hash values, those below this one take part in counting a document's own tokens.
SAMPLE_OF_8 = 3
#: Hashes of one range: a range is one group of binary rows in a task's memory, on both sides of the worker's pipe.
RANGE_HASHES = 1 << 19
#: Bytes of text hashed at once.
HASHED_BYTES = 1 << 18
#: Tokens in more documents than this are keyed by pairs, beyond the second by triples.
PAIRS_ABOVE, TRIPLES_ABOVE = 8, 64
#: Sets from 2 to this power on use combinations; smaller ones key every token alone.
COMBINE_FROM = 4
#: A frequent class takes about this many tokens of a set.
CLASS_TOKENS = 8
#: Tokens of one block of a candidate group, and of one group of small candidate groups.
BLOCK_TOKENS = 400_000
#: Ids that may be broadcast, of 8 bytes each; a longer list meets the texts in a shuffled join.
BROADCAST_IDS = 500_000


def misses(n: int, percent: int = PERCENT) -> int:
    """How many of n tokens a similar set may lack."""
    return n - -(-percent * n // 100)


def _sets(piece: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sets of all texts of a piece; hashing keeps some forty bytes for each byte of text, so it goes by small parts."""
    found, sizes = [], []
    for part in pieces([piece], "text", HASHED_BYTES):
        data, offsets = text_buffer(part.column(part.schema.get_field_index("text")))
        tokens, ends = shingle_sets(Words(data, offsets), k)
        found.append(tokens)
        sizes.append(np.diff(ends))
    offsets = np.cumsum(np.concatenate([np.zeros(1, np.int64), *sizes]))
    return np.concatenate([np.zeros(0, np.uint64), *found]), offsets


def _names(tokens: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """128-bit names of sets: sums of two mixes of their tokens."""
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens, salt), dtype=np.uint64)])[offsets] for salt in (11, 12)]
    both = np.stack([np.diff(s) for s in sums], axis=1)
    return [row.tobytes() for row in both]


def profiles(df: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, text_id, n_shingles, how many of them are sampled, and the name of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            tokens, offsets = _sets(piece, k)
            sampled = np.diff(np.concatenate([[0], np.cumsum(_sampled(tokens))])[offsets])
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), pa.array(np.diff(offsets), pa.int64()), pa.array(sampled, pa.int64()), pa.array(_names(tokens, offsets), pa.binary())],
                names=["doc_id", "text_id", "n_shingles", "n_sampled", "name"],
            )

    keyed = df.select("doc_id", F.md5("text").alias("text_id"), "text")
    return keyed.mapInArrow(run, "doc_id long, text_id string, n_shingles long, n_sampled long, name binary")


def _sampled(tokens: np.ndarray) -> np.ndarray:
    """The low bits choose the sample; ranges go by the high ones."""
    return (tokens & np.uint64(7)) < SAMPLE_OF_8


def _shared_tokens(df: DataFrame, k: int, ranges: int) -> DataFrame:
    """(owner, n): sampled tokens of a set that another document, or an equal one, has too."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", 2 << 20):
            tokens, offsets = _sets(piece, k)
            names = _names(tokens, offsets)
            owner = np.repeat(np.arange(len(names)), np.diff(offsets))
            taken = _sampled(tokens)
            yield repeats.pack(names, owner[taken], tokens[taken], ranges, report_several=True)

    return repeats.repeated_counts(df.select("text"), send, 16, ranges)


def _full_sets(df: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            tokens, offsets = _sets(piece, k)
            tokens = tokens.view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tokens, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(_names(tokens.view(np.uint64), offsets), pa.binary()), lists], names=["name", "tokens"])

    return df.select("text").mapInArrow(run, "name binary, tokens array<long>")


def prefix_keys(n: int, tokens: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of a set of ``n`` tokens, of which ``tokens`` occur in ``counts`` >= 2 sets.

    Classes depend on the power of two of the set's size.  A set whose similar sets may be of the
    power below has keys for both.
    """
    scale = n.bit_length() - 1
    scales = [scale, scale - 1] if scale and -(-percent * n // 100) < 1 << scale else [scale]
    order = np.lexsort((tokens, counts))
    tokens, counts = tokens[order], counts[order]
    out = []
    for s in scales:
        classes = max(1, (1 << s) // CLASS_TOKENS)
        if s < COMBINE_FROM:
            size = np.ones(len(tokens), np.int64)
        else:
            size = 1 + (counts > PAIRS_ABOVE).astype(np.int64) + (counts > TRIPLES_ABOVE)
        group = np.where(size == 1, 0, (mix(tokens, 5) % np.uint64(classes)).astype(np.int64) * 4 + size)
        # Tokens of one set only come first; they allow misses and make no key.
        needed, held, end = misses(n, percent) + 1 - (n - len(tokens)), {}, 0
        while needed > 0 and end < len(tokens):
            g, k = int(group[end]), int(size[end])
            held.setdefault(g, []).append(int(tokens[end]))
            needed -= 1 if k == 1 or len(held[g]) >= k else 0
            end += 1
        for g, members in held.items():
            k = 1 if g == 0 else g % 4
            if len(members) >= k:
                rows = np.array(list(itertools.combinations(sorted(members), k)), np.uint64).reshape(-1, k)
                key = mix(rows[:, 0], 100 + s * 4 + k)
                for c in range(1, k):
                    key = mix(key ^ rows[:, c], 7)
                out.append(key)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _keys(sets: DataFrame, percent: int) -> DataFrame:
    """(key, node) of all sets."""
    exploded = sets.select("node", F.explode("tokens").alias("token"))
    often = stage(exploded.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1"), "shared-tokens")
    shared = exploded.join(often, "token").groupBy("node").agg(F.collect_list(F.struct("token", "sets")).alias("shared"))
    lists = sets.select("node", "n").join(shared, "node").select("node", "n", F.col("shared.token").alias("tokens"), F.col("shared.sets").alias("counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for start in range(0, batch.num_rows, 200):
                keys, nodes = [], []
                for i in range(start, min(start + 200, batch.num_rows)):
                    node, n = columns[0][i].as_py(), columns[1][i].as_py()
                    if misses(n, percent) + 1 <= n - len(columns[2][i]):
                        continue
                    tokens = columns[2][i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    found = prefix_keys(n, tokens, columns[3][i].values.to_numpy(zero_copy_only=False), percent)
                    keys.append(found)
                    nodes.append(np.full(len(found), node))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes), pa.int64())], names=["key", "node"])

    return lists.mapInArrow(run, "key long, node long")


def links_of(nodes: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect every similar pair of a block, or of two blocks (sides 0 and 1), counted exactly.

    Overlaps come from an index of the block's tokens; a link inside one component already is left out.
    """
    sizes = np.array([len(s) for s in sets])
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    crossing = (sides == 1).any()
    root, out = list(range(len(sets))), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, own in enumerate(sets):
        if crossing and sides[i] == 1:
            continue
        low, high = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
        many = high - low
        if (many > 1).sum() * 100 < percent * sizes[i]:
            continue
        places = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        shared = np.bincount(owner[places], minlength=len(sets))
        near = 100 * shared >= percent * (sizes[i] + sizes - shared)
        near[: 0 if crossing else i + 1] = False
        if crossing:
            near &= sides == 1
        for j in np.flatnonzero(near).tolist():
            a, b = find(i), find(j)
            if a != b:
                root[b] = a
                out.append((int(nodes[i]), int(nodes[j])))
    return out


def _links(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) inside candidate groups."""
    members = stage(sets.join(groups, "node"), "members")
    sizes = members.groupBy("component").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("docs"))
    sizes = stage(sizes.withColumn("blocks", F.ceil(F.col("total") / BLOCK_TOKENS).cast("int")), "group-sizes")
    small = sizes.where("blocks = 1").agg(F.sum("total")).first()[0] or 0
    bins = max(1, math.ceil(small / BLOCK_TOKENS))
    placed = members.join(sizes.select("component", "blocks"), "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # Groups of one block share bins; a larger group has a task for every two of its blocks.
    dealt = placed.withColumn("other", other).select(
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(bins))).otherwise(F.col("component")).alias("group"),
        F.when(F.col("blocks") == 1, F.lit(-1)).otherwise(F.least("block", "other")).alias("low"),
        F.when(F.col("blocks") == 1, F.lit(-1)).otherwise(F.greatest("block", "other")).alias("high"),
        "block", "node", "tokens",
    )

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        low, high = group["low"].iloc[0], group["high"].iloc[0]
        sides = (group["block"].to_numpy() == high) & (low != high)
        found = links_of(group["node"].to_numpy(), sides.astype(int), [np.asarray(t, np.int64) for t in group["tokens"]], percent)
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return dealt.groupBy("group", "low", "high").applyInPandas(verify, "a long, b long")


def _classes(df: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """doc_id, text_id, n_shingles, component_id of every row."""
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    sizes = stage(profiles(docs, k), "profiles")
    total = sizes.agg(F.sum("n_sampled")).first()[0] or 0
    shared = _shared_tokens(docs, k, repeats.range_count(total, RANGE_HASHES))
    nodes = (
        sizes.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("name").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("n_sampled").alias("n_sampled"))
        .withColumn("node", F.xxhash64("name"))
    )
    allowed = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("long")
    nodes = nodes.join(shared.select(F.col("owner").alias("name"), F.col("n").alias("shared")), "name", "left")
    # A set with more tokens of its own than a similar set may lack has no similar set.
    nodes = stage(nodes.withColumn("open", F.col("n_sampled") - F.coalesce("shared", F.lit(0)) <= allowed).drop("shared", "n_sampled"), "nodes")
    open_ = nodes.where("open").select("name", "node", "n", "first_id")
    ids = stage(open_.select(F.col("first_id").alias("doc_id")).distinct(), "open-ids")
    texts = docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")
    sets = _full_sets(texts, k).groupBy("name").agg(F.any_value("tokens").alias("tokens")).join(open_.select("name", "node", "n"), "name")
    sets = stage(sets.select("node", "n", "tokens"), "sets")
    keys = stage(_keys(sets, percent), "keys")
    shared = keys.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("key", "a")
    edges = keys.join(shared, "key").select("a", F.col("node").alias("b")).where("a <> b").distinct()
    linked = components(_links(sets, components(edges), percent))
    named = nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = stage(named.select("name", "component", "first_id"), "named")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    found = stage(named.join(least, "component").select("name", "component_id"), "classes")
    answer = sizes.join(found, "name", "left")
    component = F.when((F.col("n_shingles") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return answer.select("doc_id", "text_id", "n_shingles", component.alias("component_id"))


def classes(df: DataFrame, text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``df``."""
    return _classes(df, text, k, percent).drop("text_id")


def keep_one(df: DataFrame, text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``df`` with one row of each class, that of the least doc_id; rows without doc_id or words stay."""
    found = _classes(df, text, k, percent).where("doc_id IS NOT NULL AND n_shingles > 0")
    first = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "text_id")).alias("first")).select("first.*")
    first = stage(first.select(F.col("doc_id").alias("__doc"), F.col("text_id").alias("__text")), "first-rows")
    keyed = df.withColumn("__key", F.md5(text))
    wordless = F.length(F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r", "")) == 0
    alone = F.col("doc_id").isNull() | wordless
    rest = keyed.where(~alone)
    kept = rest.join(first, (rest["doc_id"] == first["__doc"]) & (rest["__key"] == first["__text"]), "left_semi")
    # Rows that repeat an id and a text are one.
    return kept.dropDuplicates(["doc_id", "__key"]).drop("__key").unionByName(df.where(alone))
