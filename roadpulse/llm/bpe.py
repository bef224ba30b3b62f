"""Byte-level BPE encoding and decoding with padded matrices of distinct pieces.

A text is cut by a split pattern; every distinct piece is encoded once per batch of pieces.
Pieces of similar length share a padded matrix of token ids.  Each round finds, in every row,
the leftmost adjacent pair of least rank by one hashed look-up, merges it, and closes the gap;
rows without a pair that merges leave the matrix.

A null or empty text has no tokens; no other column is looked at, repeated rows give repeated results.  A text of any
length is one value, held with its ids; of pairs of equal rank the leftmost merges; an existing output column is
replaced; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.batches import text_buffer, with_column

#: Distinct pieces whose ids a Python worker remembers.
REMEMBERED = 250_000
#: Pieces beyond this many bytes merge with a heap: a matrix row costs the square of its length.
MATRIX_BYTES = 1024
#: Cells of one matrix.
CELLS = 1 << 20
NO_RANK = np.iinfo(np.int32).max


class PairRanks:
    """Open addressing from a pair of token ids to the id, which is also the rank, of their merge."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        self.bits = max(4, int(len(keys) * 3).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, np.iinfo(np.uint64).max, np.uint64)
        self.ranks = np.full(size, NO_RANK, np.int32)
        slots, todo = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.keys[slots[todo]] == np.iinfo(np.uint64).max
            at, first = np.unique(slots[todo[free]], return_index=True)
            won = todo[free][first]
            self.keys[at], self.ranks[at] = keys[won], merged[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slots[todo] = (slots[todo] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed ^ (mixed >> np.uint64(32))) >> np.uint64(64 - self.bits - 8) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NO_RANK where a pair does not merge or an id is negative."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        keys = (left.astype(np.int64).astype(np.uint64) << np.uint64(32)) | (right.astype(np.int64).astype(np.uint64) & np.uint64(0xFFFFFFFF))
        slots = self._slot(keys)
        out = np.full(len(keys), NO_RANK, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        for _ in range(self.probes):
            found = self.keys[slots[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.ranks[slots[todo[hit]]]
            todo = todo[~hit & (found != np.iinfo(np.uint64).max)]
            if not len(todo):
                break
            slots[todo] = (slots[todo] + 1) & (len(self.keys) - 1)
        return out.reshape(shape)


class Vocabulary:
    """Ranks of a ``.tiktoken`` file: one base64 token and its rank, which is its id, on each line."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}
        self.tokens = {rank: token for token, rank in self.ids.items()}
        self.bytes = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        self.split = regex.compile(pattern).findall
        pairs = [
            (a, b, rank)
            for token, rank in self.ids.items()
            for cut in range(1, len(token))
            if (a := self.ids.get(token[:cut])) is not None and (b := self.ids.get(token[cut:])) is not None
        ]
        left, right, merged = np.array(pairs, np.int64).reshape(-1, 3).T
        self.pairs = PairRanks(left, right, merged.astype(np.int32))
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        found = self.split(text)
        try:
            return b"".join(map(self.known.__getitem__, found))
        except KeyError:
            self.learn([found])
            return b"".join(map(self.known.__getitem__, found))

    def learn(self, cut_texts: list[list[str]]) -> None:
        """Encode the pieces not seen before, all in the same matrices."""
        seen = set().union(*cut_texts)
        fresh = list(seen - self.known.keys())
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known.clear()
            fresh = list(seen)
        self.known.update(zip(fresh, self.merge([p.encode() for p in fresh])))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        cut_texts = [self.split(t) for t in texts]
        self.learn(cut_texts)
        return [b"".join(map(self.known.__getitem__, found)) for found in cut_texts]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def merge(self, raw: list[bytes]) -> list[bytes]:
        """Ids of each piece."""
        out: list[bytes] = [b""] * len(raw)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(raw):
            whole = self.ids.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > MATRIX_BYTES:
                out[i] = self._merge_long(piece)
            else:
                buckets.setdefault(-(-len(piece) // 4) * 4 if len(piece) <= 32 else 1 << (len(piece) - 1).bit_length(), []).append(i)
        for width, members in sorted(buckets.items()):
            rows = max(1, CELLS // width)
            for at in range(0, len(members), rows):
                some = members[at : at + rows]
                for i, ids in zip(some, self._merge_matrix([raw[i] for i in some], width)):
                    out[i] = ids
        return out

    def _merge_matrix(self, raw: list[bytes], width: int) -> list[bytes]:
        """Round by round: every row merges its leftmost pair of least rank and closes the gap."""
        n = np.array([len(x) for x in raw])
        cells = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in raw), np.uint8).reshape(len(raw), width)
        ids = self.bytes[cells]
        ids[np.arange(width) >= n[:, None]] = -1
        ranks = self.pairs.look_up(ids[:, :-1], ids[:, 1:])
        rows, out = np.arange(len(raw)), [b""] * len(raw)
        while len(rows):
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), at]
            done = least == NO_RANK
            if done.any():
                flat, sizes = ids[done].astype("<u4"), (ids[done] >= 0).sum(axis=1)
                for i, row, size in zip(rows[done].tolist(), flat, sizes.tolist()):
                    out[i] = row[:size].tobytes()
                rows, ids, ranks, at, least = rows[~done], ids[~done], ranks[~done], at[~done], least[~done]
                if not len(rows):
                    break
            here, width = np.arange(len(rows)), ids.shape[1]
            ids[here, at] = least
            step = np.arange(width - 1)
            ids = np.take_along_axis(ids, step + (step > at[:, None]), 1)
            if width > 2:
                step = np.arange(width - 2)
                ranks = np.take_along_axis(ranks, step + (step >= at[:, None]), 1)
                for near in (at - 1, at):
                    ok = (near >= 0) & (near < width - 2)
                    ranks[here[ok], near[ok]] = self.pairs.look_up(ids[here[ok], near[ok]], ids[here[ok], near[ok] + 1])
            else:
                ranks = np.full((len(rows), 1), NO_RANK, np.int32)
        return out

    def _merge_long(self, piece: bytes) -> bytes:
        """The same merges for one long piece, by a heap of (rank, place) over a linked list."""
        ids = self.bytes[np.frombuffer(piece, np.uint8)]
        first = self.pairs.look_up(ids[:-1], ids[1:])
        heap = [(r, i) for i, r in enumerate(first.tolist()) if r != NO_RANK]
        heapq.heapify(heap)
        ids, n = ids.tolist(), len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of = self._rank_of
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank_of(ids[i], ids[j]) != rank:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank_of(ids[a], ids[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def _rank_of(self, a: int, b: int) -> int | None:
        return self.ids.get(self.tokens[a] + self.tokens[b])


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One vocabulary per Python worker."""
    return Vocabulary(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """``df`` with ``out``: the ids of ``text`` as little-endian unsigned 32-bit integers.

    ``path`` is a rank file that every executor has; ``pattern`` cuts a text into pieces.
    """

    def make(column: pa.Array) -> pa.Array:
        known = vocabulary(path, pattern)
        return pa.array(known.encode_all([x or "" for x in column.to_pylist()]), pa.binary())

    return with_column(df, text, out, T.BinaryType(), make)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the bytes that the ids stand for; null ids give no bytes."""

    def make(column: pa.Array) -> pa.Array:
        known = vocabulary(path, pattern)
        data, offsets = text_buffer(column)
        raw = data.tobytes()
        return pa.array([known.decode(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.binary())

    return with_column(df, ids, out, T.BinaryType(), make)


def digests(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """doc_id with the number of tokens and the SHA-256 of ids and of decoded bytes."""
    coded = decode(encode(df.select("doc_id", F.col(text).alias("text")), path, pattern).drop("text"), path, pattern)
    return coded.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
