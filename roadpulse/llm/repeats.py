"""Which of very many hashes occur more than once, without a row per hash.

Tasks cut their hashes by value into ranges and send each range as one binary row per piece of
texts.  A hash that a piece holds twice is sent once, without its owners, so a hash that is
everywhere costs a range one entry per piece.  Where owners must learn of it, they are dealt by owner.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

#: Hashes that one range holds on average.
RANGE_HASHES = 1 << 21
_SENT = "range int, owners binary, counts binary, single binary, several binary"
#: What a range answers: repeated hashes, by owner, for one bucket of owners.
_ANSWER = "bucket int, owners binary, counts binary, hashes binary"


def range_count(hashes: int, range_hashes: int = RANGE_HASHES) -> int:
    return max(1, math.ceil(hashes / range_hashes))


def _row(name: int, keys: np.ndarray, owner_of: np.ndarray, hashes: np.ndarray, several: np.ndarray) -> tuple:
    by_owner = np.argsort(owner_of, kind="stable")
    present, counts = np.unique(owner_of, return_counts=True)
    return name, keys[present].tobytes(), counts.astype("<i4").tobytes(), hashes[by_owner].tobytes(), several.tobytes()


def pack(owners: list[bytes], owner_of: np.ndarray, hashes: np.ndarray, ranges: int, report_several: bool = False) -> pa.RecordBatch:
    """Rows for one piece: ``owner_of`` indexes ``owners``, which are keys of equal length.

    With ``report_several`` the owners of hashes that repeat inside the piece go along in rows of
    negative ranges, dealt by owner.
    """
    order = np.argsort(hashes, kind="stable")
    hashes, owner_of = hashes[order], owner_of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    last = np.ones(len(hashes), bool)
    last[:-1] = new[1:]
    once = new & last
    bounds = np.array([(r << 64) // ranges for r in range(1, ranges)], np.uint64)
    single, several, single_of = hashes[once], hashes[new & ~last], owner_of[once]
    cut_single = np.concatenate([[0], np.searchsorted(single, bounds), [len(single)]])
    cut_several = np.concatenate([[0], np.searchsorted(several, bounds), [len(several)]])
    width = len(owners[0]) if owners else 1
    keys = np.frombuffer(b"".join(owners), f"V{width}")
    rows = []
    for r in range(ranges):
        a, b, c, d = cut_single[r], cut_single[r + 1], cut_several[r], cut_several[r + 1]
        if a < b or c < d:
            rows.append(_row(r, keys, single_of[a:b], single[a:b], several[c:d]))
    if report_several and not once.all():
        known, known_of = hashes[~once], owner_of[~once]
        spread = _spread(keys, ranges).astype(np.int64)
        for r in np.unique(spread[known_of]):
            at = spread[known_of] == r
            rows.append(_row(-1 - int(r), keys, known_of[at], known[at], several[:0]))
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["range", "owners", "counts", "single", "several"])


def _gather(group: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """keys, index into keys per single hash, single hashes, and which of them occur only once."""
    keys = np.frombuffer(b"".join(group["owners"]), f"V{width}")
    counts = np.frombuffer(b"".join(group["counts"]), "<i4")
    single = np.frombuffer(b"".join(group["single"]), np.uint64)
    several = np.unique(np.frombuffer(b"".join(group["several"]), np.uint64))
    order = np.argsort(single, kind="stable")
    ordered = single[order]
    alone = np.ones(len(ordered), bool)
    same = ordered[1:] == ordered[:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    if len(several):
        at = np.minimum(np.searchsorted(several, ordered), len(several) - 1)
        alone &= several[at] != ordered
    once = np.zeros(len(single), bool)
    once[order] = alone
    return keys, np.repeat(np.arange(len(keys)), counts), single, once


def _spread(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key, by its first four bytes."""
    width = keys.dtype.itemsize
    return keys.view(np.uint8).reshape(-1, width)[:, :4].copy().view("<u4")[:, 0] % np.uint32(buckets) if len(keys) else np.zeros(0, np.uint32)


def _answer(group: pd.DataFrame, width: int, buckets: int, with_hashes: bool) -> pd.DataFrame:
    """Repeated hashes of one range, as a row for each bucket of owners."""
    keys, owner, hashes, once = _gather(group, width)
    if group["range"].iloc[0] < 0:
        once[:] = False
    # Equal owners from different pieces become one.
    names, same = np.unique(keys, return_inverse=True) if len(keys) else (keys, np.zeros(0, np.int64))
    owner, hashes = same[owner[~once]], hashes[~once]
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    owner, hashes = owner[new], hashes[new]
    present, start, counts = np.unique(owner, return_index=True, return_counts=True)
    names = names[present]
    bucket = _spread(names, buckets)
    of_hash = np.repeat(bucket, counts)
    rows = [
        (int(b), names[bucket == b].tobytes(), counts[bucket == b].astype("<i4").tobytes(), hashes[of_hash == b].tobytes() if with_hashes else b"")
        for b in np.unique(bucket)
    ]
    return pd.DataFrame(rows, columns=["bucket", "owners", "counts", "hashes"])


def _answers(df: DataFrame, send: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], width: int, ranges: int, with_hashes: bool) -> DataFrame:
    sent = df.mapInArrow(send, _SENT).groupBy("range")
    return sent.applyInPandas(lambda group: _answer(group, width, ranges, with_hashes), _ANSWER).groupBy("bucket")


def repeated_counts(df: DataFrame, send: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], width: int, ranges: int) -> DataFrame:
    """(owner, n): how many different hashes of an owner occur elsewhere too, or twice with it; owners without any are left out.

    ``send`` turns batches of ``df`` into rows made by ``pack`` with ``report_several``.
    """

    def add(group: pd.DataFrame) -> pd.DataFrame:
        names, same = np.unique(np.frombuffer(b"".join(group["owners"]), f"V{width}"), return_inverse=True)
        n = np.bincount(same, weights=np.frombuffer(b"".join(group["counts"]), "<i4"), minlength=len(names))
        return pd.DataFrame({"owner": [x.tobytes() for x in names], "n": n.astype(np.int64)})

    return _answers(df, send, width, ranges, False).applyInPandas(add, "owner binary, n long")


def repeated(df: DataFrame, send: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], width: int, ranges: int) -> DataFrame:
    """(owner, hashes): the hashes of an owner that ``repeated_counts`` counts, packed; one row an owner."""

    def join(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(group["owners"]), f"V{width}")
        counts = np.frombuffer(b"".join(group["counts"]), "<i4")
        names, same = np.unique(keys, return_inverse=True)
        owner = np.repeat(same, counts)
        order = np.argsort(owner, kind="stable")
        hashes = np.frombuffer(b"".join(group["hashes"]), np.uint64)[order]
        start = np.searchsorted(owner[order], np.arange(1, len(names)))
        return pd.DataFrame({"owner": [x.tobytes() for x in names], "hashes": [x.tobytes() for x in np.split(hashes, start)]})

    return _answers(df, send, width, ranges, True).applyInPandas(join, "owner binary, hashes binary")
