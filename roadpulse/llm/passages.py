"""Removing repeated passages with suffix automata of reference shards.

Every window of ``window`` words has an anchor, the least hash among its short word sequences, so
equal windows have equal anchors.  Anchors that occur once are dropped; around each other anchor the
words of its windows, a stretch, are cut out.  Reference shards are the distinct stretches whose
anchors fall into a hash range of bounded size.  A shard's suffix automaton, with the number of
places of each state, is built where its stretches are; they stream through it, and a window is
repeated where the matched state, cut back to the window's length, has more than one place.
Documents then lose the maximal spans of repeated windows.

A shard goes only to the stretches that share its anchors, not to every document: only those can
match.  An anchor with very many different stretches, such as the edge of a passage that is
everywhere, does not fit a shard; windows of these are compared by hash instead, in ranges.

Defined cases: a null text has no words; a text of fewer words than the window loses nothing; rows
with equal texts are different places, so each loses every word a window covers; a text of any length is one
piece of work; ties cannot occur; columns named ``n_words``, ``n_removed`` or ``kept`` are replaced, others are
kept as they are; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm import repeats
from roadpulse.llm.batches import pieces, text_buffer
from roadpulse.llm.words import Words, sequences
from roadpulse.sources.storage import stage

WINDOW = 35
ANCHOR_WORDS = 8
#: Words of the stretches of one reference shard, on average.
SHARD_WORDS = 60_000
#: An anchor with more different stretches than this is compared by window hashes.
SHARD_STRETCHES = 400


def anchors(words: Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """text, first window (from 0), number of windows, and anchor hash of each run of windows with one anchor place."""
    hashes = words.hashes()
    grams = sequences(hashes, gram)
    counts = np.maximum(words.counts - window + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    first = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = first + words.first[:-1][text]
    # Least hash of the window's grams, the leftmost of equals, by doubling spans.
    width = window - gram + 1
    best, span = np.arange(len(grams)), 1
    while span * 2 <= width:
        a, b = best[: len(best) - span], best[span:]
        best, span = np.where(grams[b] < grams[a], b, a), span * 2
    a, b = best[at] if len(at) else at, best[at + width - span] if len(at) else at
    place = np.where(grams[b] < grams[a], b, a) if len(at) else at
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(new)
    return text[start], first[start], np.diff(np.append(start, len(place))), grams[place[start]] if len(start) else np.zeros(0, np.uint64)


def _text_keys(piece: pa.RecordBatch, at: int) -> tuple[Words, list[bytes], bytes]:
    data, offsets = text_buffer(piece.column(at))
    raw = data.tobytes()
    ends = offsets.tolist()
    return Words(data, offsets), [hashlib.md5(raw[a:b]).digest() for a, b in zip(ends, ends[1:])], raw


def _repeated_anchors(texts: DataFrame, window: int, gram: int, ranges: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", 2 << 20):
            words, keys, _ = _text_keys(piece, 0)
            text, _, _, hashes = anchors(words, window, gram)
            yield repeats.pack(keys, text, hashes, ranges, report_several=True)

    return repeats.repeated(texts.select("text"), send, 16, ranges)


def _stretches(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, stretch, key, first, windows) of texts with their repeated anchors; words joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            words, keys, raw = _text_keys(piece, piece.schema.get_field_index("text"))
            lists = piece.column(piece.schema.get_field_index("hashes")).to_pylist()
            wanted = [np.frombuffer(x, np.uint64) for x in lists]
            text, first, windows, hashes = anchors(words, window, gram)
            bounds = np.searchsorted(text, np.arange(len(keys) + 1))
            out: list[list] = [[], [], [], [], []]
            for i in range(len(keys)):
                a, b = bounds[i], bounds[i + 1]
                kept = a + np.flatnonzero(np.isin(hashes[a:b], wanted[i]))
                cut = raw[words.offsets[i] : words.offsets[i + 1]].split()
                for f, w in zip(first[kept].tolist(), windows[kept].tolist()):
                    out[1].append(b" ".join(cut[f : f + w + window - 1]))
                    out[2].append(keys[i])
                    out[3].append(f)
                    out[4].append(w)
                out[0].extend(hashes[kept].view(np.int64).tolist())
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["anchor", "stretch", "key", "first", "windows"])

    return texts.select("text", "hashes").mapInArrow(run, "anchor long, stretch binary, key binary, first int, windows int")


class Automaton:
    """A suffix automaton of several word sequences, with the number of places of each state."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.places = [-1], [0], [0]

    def add(self, symbols: list[int], weight: int) -> None:
        nexts, link, length, places = self.next, self.link, self.length, self.places
        last = 0
        for c in symbols:
            q = nexts[last].get(c)
            if q is not None and length[q] == length[last] + 1:
                last = q
            elif q is not None:
                last = self._split(last, q, c)
            else:
                current = len(nexts)
                nexts.append({})
                length.append(length[last] + 1)
                link.append(0)
                places.append(0)
                p = last
                while p >= 0 and c not in nexts[p]:
                    nexts[p][c] = current
                    p = link[p]
                if p >= 0:
                    q = nexts[p][c]
                    link[current] = q if length[q] == length[p] + 1 else self._split(p, q, c)
                last = current
            places[last] += weight

    def _split(self, p: int, q: int, c: int) -> int:
        """A copy of state q for the shorter sequences that end in it."""
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.places.append(0)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def close(self) -> None:
        """Pass places on to the shorter sequences."""
        for state in np.argsort(-np.array(self.length), kind="stable").tolist():
            if self.link[state] >= 0:
                self.places[self.link[state]] += self.places[state]

    def stream(self, symbols: list[int], window: int) -> int:
        """Bit i is set if the ``window`` symbols from i on have more than one place."""
        nexts, link, length, places = self.next, self.link, self.length, self.places
        state = matched = mask = 0
        for i, c in enumerate(symbols):
            while state and c not in nexts[state]:
                state = link[state]
                matched = length[state]
            following = nexts[state].get(c)
            if following is None:
                continue
            state, matched = following, matched + 1
            # Cut back to the state of the last ``window`` symbols.
            while length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if matched >= window and places[state] > 1:
                mask |= 1 << (i - window + 1)
        return mask


def shard_masks(stretches: list[bytes], weights: list[int], window: int) -> list[int]:
    """For each distinct stretch of a shard, the windows with more than one place."""
    symbols: dict[bytes, int] = {}
    coded = [[symbols.setdefault(w, len(symbols)) for w in s.split(b" ")] for s in stretches]
    automaton = Automaton()
    for sequence, weight in zip(coded, weights):
        automaton.add(sequence, weight)
    automaton.close()
    return [automaton.stream(sequence, window) for sequence in coded]


def _automaton_masks(distinct: DataFrame, window: int, shards: int) -> DataFrame:
    def scan(group: pd.DataFrame) -> pd.DataFrame:
        masks = shard_masks(group["stretch"].tolist(), group["places"].tolist(), window)
        return pd.DataFrame({"stretch_id": group["stretch_id"], "mask": np.array(masks, np.int64)})

    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(scan, "stretch_id string, mask long")


def _hash_masks(distinct: DataFrame, window: int, windows: int) -> DataFrame:
    """Masks for stretches of anchors that do not fit a shard: windows are compared by hash, in ranges."""
    ranges = repeats.range_count(windows)

    def window_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = Words(*text_buffer(column))
        counts = np.maximum(words.counts - window + 1, 0)
        owner = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return owner, place, sequences(words.hashes(), window)[place + words.first[:-1][owner]] if len(owner) else np.zeros(0, np.uint64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "stretch"):
            owner, _, hashes = window_hashes(piece.column(0))
            keys = [bytes.fromhex(x) for x in piece.column(1).to_pylist()]
            # A stretch of several places sends its windows twice.
            twice = np.array(piece.column(2).to_pylist())[owner] > 1 if len(owner) else np.zeros(0, bool)
            yield repeats.pack(keys, np.concatenate([owner, owner[twice]]), np.concatenate([hashes, hashes[twice]]), ranges, report_several=True)

    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "stretch"):
            owner, place, hashes = window_hashes(piece.column(0))
            wanted = [np.frombuffer(x, np.uint64) for x in piece.column(2).to_pylist()]
            out = np.zeros(piece.num_rows, np.int64)
            bounds = np.searchsorted(owner, np.arange(piece.num_rows + 1))
            for i in range(piece.num_rows):
                a, b = bounds[i], bounds[i + 1]
                out[i] = (np.int64(1) << place[a:b][np.isin(hashes[a:b], wanted[i])]).sum()
            yield pa.RecordBatch.from_arrays([piece.column(1), pa.array(out)], names=["stretch_id", "mask"])

    found = repeats.repeated(distinct.select("stretch", "stretch_id", "places"), send, 16, ranges)
    found = found.select(F.lower(F.hex("owner")).alias("stretch_id"), "hashes")
    joined = distinct.select("stretch", "stretch_id").join(found, "stretch_id").select("stretch", "stretch_id", "hashes")
    return joined.mapInArrow(masks, "stretch_id string, mask long")


def repeated_windows(df: DataFrame, text: str = "text", window: int = WINDOW, gram: int = ANCHOR_WORDS) -> DataFrame:
    """(key, spans): by MD5 of a text, the first places and masks of its repeated windows."""
    if window - gram + 1 > 62:
        raise ValueError("a mask holds 62 windows")
    texts = df.select(F.col(text).alias("text")).where("text IS NOT NULL")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # More ranges than anchors need: about one anchor for every hundred bytes of text.
    found = _repeated_anchors(texts, window, gram, repeats.range_count(size // 50))
    found = stage(found.select(F.col("owner").alias("key"), "hashes"), "repeated-anchors")
    keyed = texts.withColumn("key", F.unhex(F.md5("text"))).join(found, "key")
    stretches = _stretches(keyed, window, gram).withColumn("stretch_id", F.md5("stretch"))
    stretches = stage(stretches, "stretches")
    distinct = stage(
        stretches.groupBy("anchor", "stretch_id").agg(F.first("stretch").alias("stretch"), F.count(F.lit(1)).alias("places"), F.first("windows").alias("windows")),
        "distinct-stretches",
    )
    sizes = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("different"), F.sum("windows").alias("total"))
    sizes = stage(sizes, "anchor-sizes")
    totals = sizes.agg(
        F.sum(F.when(F.col("different") <= SHARD_STRETCHES, F.col("total") + (window - 1) * F.col("different"))),
        F.sum(F.when(F.col("different") > SHARD_STRETCHES, F.col("total"))),
    ).first()
    small = distinct.join(sizes.where(F.col("different") <= SHARD_STRETCHES).select("anchor"), "anchor")
    large = distinct.join(sizes.where(F.col("different") > SHARD_STRETCHES).select("anchor"), "anchor")
    masks = _automaton_masks(small, window, max(1, math.ceil((totals[0] or 0) / SHARD_WORDS)))
    masks = masks.union(_hash_masks(large, window, totals[1] or 0))
    masks = stage(masks.where("mask <> 0"), "masks")
    placed = stretches.select("key", "first", "stretch_id").join(masks, "stretch_id")
    return placed.groupBy("key").agg(F.collect_set(F.struct("first", "mask")).alias("spans"))


def remove_repeats(df: DataFrame, text: str = "text", window: int = WINDOW, gram: int = ANCHOR_WORDS) -> DataFrame:
    """``df`` with n_words, n_removed, and ``kept``: the words outside repeated windows, joined by one space."""
    spans = stage(repeated_windows(df, text, window, gram), "spans").select(F.col("key").alias("__key"), F.col("spans").alias("__spans"))
    joined = df.withColumn("__key", F.unhex(F.md5(F.coalesce(text, F.lit(""))))).join(spans, "__key", "left").drop("__key")
    new = ("n_words", "n_removed", "kept")
    names = [f.name for f in joined.schema.fields if f.name not in (*new, "__spans")]
    schema = T.StructType([f for f in joined.schema.fields if f.name in names])
    schema = schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            get = lambda name: piece.column(piece.schema.get_field_index(name))  # noqa: E731, B023
            data, offsets = text_buffer(get(text))
            raw, ends, total, removed, kept = data.tobytes(), offsets.tolist(), [], [], []
            for a, b, found in zip(ends, ends[1:], get("__spans").to_pylist()):
                cut = raw[a:b].split()
                if found:
                    gone = np.zeros(len(cut) + 1, np.int64)
                    for span in found:
                        for i in range(span["mask"].bit_length()):
                            if span["mask"] >> i & 1:
                                gone[span["first"] + i] += 1
                                gone[span["first"] + i + window] -= 1
                    cut_all, cut = len(cut), [w for w, g in zip(cut, np.cumsum(gone).tolist()) if not g]
                    total.append(cut_all)
                else:
                    total.append(len(cut))
                removed.append(total[-1] - len(cut))
                kept.append(b" ".join(cut).decode())
            made = [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([*(get(n) for n in names), *made], names=[*names, *new])

    return joined.mapInArrow(run, schema)


def report(df: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, and the SHA-256 of the kept text."""
    done = remove_repeats(df.select("doc_id", F.col(text).alias("text")))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
