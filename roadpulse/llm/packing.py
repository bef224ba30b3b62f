"""Packing documents into windows of tokens by non-negative least squares over their lengths.

1. ``pieces``: every document becomes its ids and an end id, cut into full windows and a rest.  A task numbers
   its pieces of each length, so a piece is known by (length, task, number) without any shuffle.
2. ``plan``: the histogram of lengths, one row a length, reaches the driver.  Shallow combinations, one, two or three
   lengths that fill a window exactly, are enumerated; non-negative least squares finds how often to use
   each; counts are rounded, and residual lengths packed greedily, cutting a piece only where no whole one fits.
   The plan speaks of ranges of numbers inside a length, so its size depends on the window and not on the data.
3. ``pack``: pieces join the counts of the tasks before theirs, then the plan by length and number.

Sequences are full windows, except the last few: fewer tokens than a window are left, and they make up
sequences of powers of two, which need no padding.

Defined results: a null or empty text is the end id alone.  Texts of any length are encoded in blocks, their ids are held once.
Repeated rows, repeated and null ids are documents of their own.  Ties cannot show: pieces of one length are interchangeable,
and which of them shares a sequence with which follows the order of rows in the tasks.  An empty table gives no rows.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import bisect
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.batches import pieces as bounded
from roadpulse.llm.tokens import encoder
from roadpulse.sources.storage import stage

WINDOW = 1024
END = 0
#: Gaps below this are left to exact fits: no piece is cut to fill them unless nothing else does.
SLIVER = 64
#: Rounds of the least squares; each adds combinations that share no length.
SOLVER_ROUNDS = 40
#: Rows of a plan (of some 50 bytes) up to which it is broadcast; beyond, the join is left to measured sizes.
PLAN_ROWS = 1_000_000


# -- documents to pieces -----------------------------------------------------------
def pieces(df: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, task and number of each piece."""
    kind = df.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length int, ids binary, doc_tokens long, task int, number long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task, numbers = encoder(path), TaskContext.get().partitionId(), Counter()
        for batch in bounded(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = known.encode(texts) if len(texts) > 1 else [known.text_ids(texts[0])]
            at: list[int] = []
            rows: list[tuple[int, int, bytes, int, int]] = []
            for i, ids in enumerate(found):
                raw = ids.astype("<u4").tobytes() + end.to_bytes(4, "little")
                total = len(raw) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    at.append(i)
                    rows.append((start, length, raw[4 * start : 4 * (start + length)], total, numbers[length]))
                    numbers[length] += 1
            start, length, ids, total, number = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(at, pa.int32())), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(ids, pa.binary()),
                    pa.array(total, pa.int64()), pa.array([task] * len(at), pa.int32()), pa.array(number, pa.int64()),
                ],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "task", "number"],
            )

    return df.select("doc_id", "text").mapInArrow(run, schema)


# -- least squares over combinations ---------------------------------------------------
def combinations(lengths: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Pairs (a, b, 0) and triples (a, b, c) of the given lengths that fill a window, a >= b >= c."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    have[0] = False
    a, b = np.meshgrid(np.flatnonzero(have), np.flatnonzero(have), indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = window - a - b
    fits = (a >= b) & (c >= 0) & (b >= c)
    a, b, c = a[fits], b[fits], c[fits]
    fits = (c == 0) | have[c]
    return np.stack([a[fits], b[fits], c[fits]], axis=1)


def _use(sets: np.ndarray, often: np.ndarray, size: int) -> np.ndarray:
    """Pieces of each length that combinations use."""
    out = np.bincount(sets.ravel(), np.repeat(often, sets.shape[1]), size)
    out[0] = 0
    return out


def _least_squares(sets: np.ndarray, target: np.ndarray, x: np.ndarray, steps: int = 400) -> np.ndarray:
    """Conjugate gradients for the combinations' least squares, signs free, from ``x`` on."""
    rest = target - _use(sets, x, len(target))
    slope = rest[sets].sum(axis=1)
    way, square = slope, slope @ slope
    stop = 1e-18 * (target @ target)
    for _ in range(steps):
        if square <= stop:
            break
        change = _use(sets, way, len(target))
        length = square / (change @ change)
        x = x + length * way
        rest = rest - length * change
        slope = rest[sets].sum(axis=1)
        way, square = slope + (slope @ slope) / square * way, slope @ slope
    return x


def solve(sets: np.ndarray, counts: np.ndarray, rounds: int = SOLVER_ROUNDS) -> np.ndarray:
    """How often to use each combination: least squares to ``counts`` (by length) without negative values.

    An active-set method: a round admits the combinations with the steepest descent that share no
    length, solves for all admitted ones, and sends away those that would be negative until none is.  The best round counts.
    """
    best = np.zeros(len(sets))
    if not len(sets):
        return best
    target = counts.astype(float)
    target[0] = 0
    x, least = best.copy(), target @ target
    small = 1e-6 * max(1.0, target.max())
    for _ in range(rounds):
        rest = target - _use(sets, x, len(target))
        slope = rest[sets].sum(axis=1)
        slope[x > 0] = -1
        steepest = slope.max()
        if steepest <= small:
            break
        taken, fresh = np.zeros(len(target), bool), []
        order = np.argsort(-slope, kind="stable")
        for j in order[slope[order] >= max(steepest / 8, small)].tolist():
            lengths = sets[j]
            if not taken[lengths].any():
                taken[lengths] = True
                taken[0] = False
                fresh.append(j)
        chosen = np.sort(np.concatenate([np.flatnonzero(x > 0), np.array(fresh, int)]))
        z = _least_squares(sets[chosen], target, x[chosen])
        while (z <= 0).any():
            chosen, z = chosen[z > 0], z[z > 0]
            z = _least_squares(sets[chosen], target, z)
        x = np.zeros(len(sets))
        x[chosen] = z
        error = target - _use(sets, x, len(target))
        if error @ error < least:
            best, least = x, error @ error
    return best


class Stock:
    """Pieces by length, as ranges of numbers of the length they had first: (length, first number, count, offset)."""

    def __init__(self, counts: dict[int, int]):
        self.ranges = {size: deque([(size, 0, n, 0)]) for size, n in counts.items() if n}
        self.counts = Counter({size: n for size, n in counts.items() if n})
        self.sizes = sorted(self.counts)

    def put(self, size: int, ranges: list[tuple[int, int, int, int]]) -> None:
        if size not in self.counts:
            bisect.insort(self.sizes, size)
        self.ranges.setdefault(size, deque()).extend(ranges)
        self.counts[size] += sum(r[2] for r in ranges)

    def take(self, size: int, n: int) -> list[tuple[int, int, int, int]]:
        """Ranges that hold n pieces of a size."""
        self.counts[size] -= n
        if not self.counts[size]:
            del self.counts[size]
            self.sizes.remove(size)
        out, line = [], self.ranges[size]
        while n:
            origin, first, count, offset = line.popleft()
            some = min(n, count)
            out.append((origin, first, some, offset))
            if count > some:
                line.appendleft((origin, first + some, count - some, offset))
            n -= some
        return out


class Plan:
    """Rows (length, first number, count, offset in the piece, size, sequence of the first, place in the sequence)."""

    def __init__(self, counts: dict[int, int], window: int = WINDOW):
        self.window, self.stock = window, Stock(counts)
        self.rows: list[tuple[int, int, int, int, int, int, int]] = []
        self.sequences = self.solved = self.cuts = 0
        if self.stock.counts[window]:
            self._fill([(window, window)], self.stock.counts[window])
        self._combine()
        self.solved = self.sequences
        self._greedy()
        self._tail()

    def _fill(self, slots: list[tuple[int, int]], n: int) -> None:
        """n sequences of slots (size taken, size of the piece it is taken from)."""
        place = 0
        for size, whole in slots:
            sequence, rest = self.sequences, []
            for origin, first, count, offset in self.stock.take(whole, n):
                self.rows.append((origin, first, count, offset, size, sequence, place))
                sequence += count
                if whole > size:
                    rest.append((origin, first, count, offset + size))
            if rest:
                self.stock.put(whole - size, rest)
                self.cuts += n
            place += size
        self.sequences += n

    def _combine(self) -> None:
        histogram = np.zeros(self.window + 1)
        for size, n in self.stock.counts.items():
            histogram[size] = n
        sets = combinations(np.array(self.stock.sizes, int), self.window)
        often = solve(sets, histogram)
        for j in np.argsort(-often, kind="stable"):
            n = int(often[j] + 0.5)
            if not n:
                break
            slots = [int(s) for s in sets[j] if s]
            n = min([n, *(self.stock.counts[s] // k for s, k in Counter(slots).items())])
            if n:
                self._fill([(s, s) for s in slots], n)

    def _largest(self, most: int, used: Counter) -> int:
        """The largest size up to ``most`` with a piece not in ``used``; 0 if none."""
        sizes = self.stock.sizes
        for i in range(bisect.bisect_right(sizes, most) - 1, -1, -1):
            if self.stock.counts[sizes[i]] > used[sizes[i]]:
                return sizes[i]
        return 0

    def _greedy(self) -> None:
        """Longest first, the largest whole piece that fits next, and a cut piece where none does.

        Each pass fills as many sequences in the same way as there are pieces for, so passes follow lengths, not pieces.
        """
        while self.stock.sizes:
            slots, used, gap = [], Counter(), self.window
            while gap:
                size = self._largest(gap, used)
                if size and size != gap and gap - size < SLIVER and slots:
                    size = self._largest(gap - SLIVER, used)
                if not size:
                    break
                slots.append((size, size))
                used[size] += 1
                gap -= size
            if gap:
                whole = self._largest(self.window, used)
                if not whole:
                    return  # less than a window is left
                slots.append((min(gap, whole), whole))
                used[whole] += 1
                gap -= min(gap, whole)
                if gap:
                    # Only slivers were passed over; take them as they come.
                    slots, used, gap = self._plain_slots()
            if gap:
                return
            self._fill(slots, min(self.stock.counts[s] // k for s, k in used.items()))

    def _plain_slots(self) -> tuple[list[tuple[int, int]], Counter, int]:
        slots, used, gap = [], Counter(), self.window
        while gap:
            size = self._largest(gap, used)
            whole = size or self._largest(self.window, used)
            if not whole:
                break
            slots.append((size or gap, whole))
            used[whole] += 1
            gap -= size or gap
        return slots, used, gap

    def _tail(self) -> None:
        """What is left, less than a window, as sequences of powers of two."""
        left = sum(s * n for s, n in self.stock.counts.items())
        while left:
            power = 1 << left.bit_length() - 1
            slots, used, gap = [], Counter(), power
            while gap:
                size = self._largest(gap, used)
                whole = size or self._largest(self.window, used)
                slots.append((size or gap, whole))
                used[whole] += 1
                gap -= size or gap
            self._fill(slots, 1)
            left -= power


# -- pieces to sequences -------------------------------------------------------------------
def pack(df: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id and offset of every piece."""
    spark: SparkSession = df.sparkSession
    cut = stage(pieces(df, path, window, end), "token-pieces")
    counts = cut.groupBy("length", "task").agg((F.max("number") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    histogram = {r.length: r.n for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most one row a length
    rows = Plan(histogram, window).rows
    names = "p_length int, p_first long, p_count long, p_offset int, p_size int, p_sequence long, p_place int"
    planned = spark.createDataFrame(rows, names)
    planned = F.broadcast(planned) if len(rows) <= PLAN_ROWS else planned
    at = F.col("before") + F.col("number") - F.col("p_first")
    numbered = cut.join(offsets.select("length", "task", "before"), ["length", "task"])
    joined = numbered.join(planned, (F.col("length") == F.col("p_length")) & (at >= 0) & (at < F.col("p_count")))
    return joined.select(
        "doc_id", (F.col("start") + F.col("p_offset")).alias("start"), F.col("p_size").cast("long").alias("length"),
        F.substring(F.col("ids"), F.col("p_offset") * 4 + 1, F.col("p_size") * 4).alias("ids"), "doc_tokens",
        (F.col("p_sequence") + at).alias("sequence_id"), F.col("p_place").cast("long").alias("offset"),
    )


def sequences(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """sequence_id, ids, length and padded_length; a sequence has at most ``window`` tokens, so a group is small."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(parts, F.lit(b""), lambda ids, part: F.concat(ids, part["ids"]))
    length = (F.octet_length("ids") / 4).cast("int")
    power = F.bit_count(length) == 1
    return packed.groupBy("sequence_id").agg(whole.alias("ids")).select(
        "sequence_id", "ids", length.alias("length"), F.when(power, length).otherwise(window).alias("padded_length")
    )


def report(df: DataFrame, path: str) -> DataFrame:
    """``pack`` with a checksum in place of the ids."""
    return pack(df, path).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
