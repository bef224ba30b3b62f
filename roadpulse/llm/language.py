"""Language identification with bit-sliced Bloom filters over letter n-grams.

A slot of the filter has one bit for each language.  An n-gram sets its language's bit in a few
slots; the AND of those slots is the set of all languages that contain it, found by one look-up.
A text's n-grams are counted by language, each count is corrected for the filter's false positives,
and the language with the largest corrected count wins.

Learned from all labelled texts given: n-grams are counted, and those that make up at least
``MIN_SHARE`` of a language's are kept, so a language has at most 1 / MIN_SHARE of them and the
filter has a proven bound.

Defined cases: a null text, or one without letters, is ``und`` with score 0; so is every text if
nothing was learned; without any known n-gram the most common language is named with score 0; rows
with null text or language teach nothing; repeated rows count as often as they occur; equal counts go to the
language with more learned text, then to the first name; a text of any length is counted in one piece, with some
thirteen bytes of memory a byte; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.batches import pieces
from roadpulse.llm.words import mix
from roadpulse.sources.storage import stage

GRAM = 3
MIN_SHARE = 5e-6
PROBES = 3
#: Slots for each n-gram of the language with most; sets the rate of false positives.
SLOTS_PER_GRAM = 16
UNKNOWN = "und"
#: Distinct n-grams a task gathers before it passes its counts on.
HELD_GRAMS = 1 << 20


@functools.lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """By code point: 0 for other than letters, else the lower-case letter."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        if unicodedata.category(char)[0] == "L":
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-grams of all texts, 21 bits a letter, the text of each, and whether a text has letters.

    Runs of other characters count as one gap; n-grams hold at most their first and last letter as a gap.
    """
    table = letter_table()
    points = np.frombuffer("\0".join(["", *(t or "" for t in texts), ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t or "") for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts) + 1), np.append(sizes + 1, 1))
    letters = table[points]
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
    has = np.zeros(len(texts) + 1, bool)
    has[owner[letters != 0]] = True
    letters, owner = letters[keep].astype(np.uint64), owner[keep]
    n = len(letters) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has[: len(texts)]
    out = np.zeros(n, np.uint64)
    inner = np.ones(n, bool)
    for t in range(GRAM):
        out = (out << np.uint64(21)) | letters[t : t + n]
        if 0 < t < GRAM - 1:
            inner &= letters[t : t + n] != 0
    # The gap between two texts belongs to the next; the owner of a gram is that of its inner letters.
    return out[inner], owner[1 : 1 + n][inner], has[: len(texts)]


@dataclass
class Model:
    """``slots`` (language words of 64 bits, slots), names by learned weight, false-positive rate by language."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """(language words, n-grams): bits of all languages that contain each n-gram."""
        size = np.uint64(self.slots.shape[1] - 1)
        out = self.slots[:, (mix(hashes, 0) & size).astype(np.int64)]
        for probe in range(1, PROBES):
            out &= self.slots[:, (mix(hashes, probe) & size).astype(np.int64)]
        return out

    def decide(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        found, owner, has = grams(texts)
        total = np.bincount(owner, minlength=len(texts))[: len(texts)]
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        held = self.look_up(found)
        counts = np.zeros((len(self.languages), len(texts)))
        for i in range(len(self.languages)):
            bit = (held[i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            seen = np.bincount(owner, weights=bit, minlength=len(texts))[: len(texts)]
            counts[i] = np.maximum(seen - total * self.false_rate[i], 0) / (1 - self.false_rate[i])
        # Languages are in order of learned weight, so the first maximum settles ties.
        best = counts.argmax(axis=0)
        sums = counts.sum(axis=0)
        score = np.where(sums > 0, counts.max(axis=0) / np.maximum(sums, 1e-300), 0.0)
        names = [self.languages[b] if h else UNKNOWN for b, h in zip(best, has)]
        return names, np.where(has, score, 0.0).tolist()


def build(languages: list[str], names: np.ndarray, hashes: np.ndarray) -> Model:
    """The filter of n-grams ``hashes`` whose languages are ``names`` (indices)."""
    per = np.bincount(names, minlength=len(languages)) if len(languages) else np.zeros(1, int)
    size = 1 << max(10, int(per.max(initial=1) * SLOTS_PER_GRAM - 1).bit_length())
    slots = np.zeros((max(1, -(-len(languages) // 64)), size), np.uint64)
    for i in range(len(languages)):
        own = hashes[names == i]
        for probe in range(PROBES):
            at = (mix(own, probe) & np.uint64(size - 1)).astype(np.int64)
            slots[i // 64, at] |= np.uint64(1 << (i % 64))
    fill = np.array([((slots[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
    return Model(languages, slots, fill**PROBES)


def gram_counts(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n) over all labelled texts; a task sums its own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            found, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return found, np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)

        def passed(which: list[str]) -> Iterator[pa.RecordBatch]:
            for name in which:
                found, n = merged(held.pop(name))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

        for piece in pieces(batches, "text"):
            names = np.array(piece.column(1).to_pylist(), object)
            texts = piece.column(0).to_pylist()
            for name in sorted(set(names)):
                found, _, _ = grams([texts[i] for i in np.flatnonzero(names == name)])
                held.setdefault(name, []).append(np.unique(found, return_counts=True))
                if len(held[name]) > 8:
                    held[name] = [merged(held[name])]
            if sum(len(p[0]) for parts in held.values() for p in parts) > HELD_GRAMS:
                yield from passed(sorted(held))
        yield from passed(sorted(held))

    labelled = df.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    return labelled.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, text: str = "text", lang: str = "lang", min_share: float = MIN_SHARE) -> Broadcast:
    """Learn from all rows with a text and a language; at most 1 / min_share n-grams a language come to the driver."""
    spark = df.sparkSession
    counts = stage(gram_counts(df, text, lang), "gram-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    order = [r.lang for r in totals.orderBy(F.desc("total"), "lang").collect()]
    kept = counts.join(totals, "lang").where(F.col("n") >= F.col("total") * min_share).select("lang", "gram").toArrow()
    at = {name: i for i, name in enumerate(order)}
    names = np.array([at[x] for x in kept.column(0).to_pylist()], np.int64)
    return spark.sparkContext.broadcast(build(order, names, kept.column(1).to_numpy().view(np.uint64)))


def predict(df: DataFrame, model: Broadcast, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, the winner's part of all corrected counts; only ``text`` is looked at."""
    new = ("lang_pred", "score")
    names = [c for c in df.columns if c not in new]
    schema = T.StructType([f for f in df.schema.fields if f.name in names]).add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            get = lambda name: piece.column(piece.schema.get_field_index(name))  # noqa: E731, B023
            found, score = model.value.decide(get(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*(get(n) for n in names), pa.array(found, pa.string()), pa.array(score, pa.float64())], names=[*names, *new])

    return df.mapInArrow(run, schema)
