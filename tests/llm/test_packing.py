"""Packing against the tokenizers library and against what a packing must hold."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadpulse.llm import packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = [
    "'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "a", "Zé", "1", "²", "!", "...", " ", "\u0085", "\x1c", "᠎", "​",
    "日本", "<|endoftext|>", "\0", "x" * 30, " word", "😀", "՘", "",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(library):
    draw, known = random.Random(1), tokens.Encoder(PATH)
    for _ in range(1500):
        texts = ["".join(draw.choice(ALPHABET) for _ in range(draw.randrange(14))) for _ in range(5)]
        for text, ids in zip(texts, known.encode(texts)):
            assert ids.tolist() == ids_of(library, text), repr(text)


def test_a_small_memory_and_equal_hashes_change_nothing(library, monkeypatch):
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(30)]
    want = [ids_of(library, t) for t in texts]
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    known = tokens.Encoder(PATH)
    assert [known.encode([t])[0].tolist() for t in texts] == want
    monkeypatch.setattr(tokens, "_MIX", np.zeros(4, np.uint64))
    assert [x.tolist() for x in tokens.Encoder(PATH).encode(texts)] == want


def test_blocks_of_a_long_text(library):
    draw = random.Random(2)
    text = "".join(draw.choice(["word ", "two  ", "it's", " \n", "x", "é, ", "<|endoftext|>"]) for _ in range(20_000))
    for limit in (10, 1000, 1 << 18):
        parts = list(tokens.blocks(text, limit))
        assert "".join(parts) == text
        assert sum((ids_of(library, p) for p in parts), []) == ids_of(library, text)
    assert list(tokens.blocks("x" * 100, 10)) == ["x" * 100] and list(tokens.blocks("", 10)) == [""]


def check_plan(counts, window):
    plan = packing.Plan(dict(counts), window)
    covered, places = defaultdict(list), defaultdict(list)
    for length, first, count, offset, size, sequence, place in plan.rows:
        for k in range(count):
            covered[length, first + k].append((offset, size))
            places[sequence + k].append((place, size))
    assert {(length, k) for length, n in counts.items() for k in range(n)} == set(covered)
    for (length, _), parts in covered.items():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at and size > 0
            at += size
        assert at == length
    filled = []
    for parts in places.values():
        at = 0
        for place, size in sorted(parts):
            assert place == at
            at += size
        filled.append(at)
    assert sorted(places) == list(range(plan.sequences))
    short = [n for n in filled if n != window]
    assert all(n & (n - 1) == 0 for n in short) and sum(short) < window and len(set(short)) == len(short)
    return plan


def test_plans_cover_every_piece_without_padding():
    draw = random.Random(3)
    for _ in range(40):
        counts = Counter(draw.randrange(1, 65) for _ in range(draw.randrange(300)))
        check_plan(counts, 64)
    for counts in ({}, {64: 5}, {63: 40}, {1: 1}, {40: 500, 3: 1}, {33: 64}, {1: 1000}):
        check_plan(counts, 64)


def test_combinations_that_exist_are_found_without_cuts():
    counts = Counter()
    for a, b, c, n in ((30, 20, 14, 40), (50, 14, 0, 25), (33, 31, 0, 10), (40, 12, 12, 7)):
        for size in (a, b, c):
            counts[size] += n if size else 0
    del counts[0]
    plan = check_plan(counts, 64)
    assert plan.cuts == 0 and plan.solved == plan.sequences == 82


def test_most_pieces_stay_whole():
    draw = random.Random(4)
    counts = Counter(min(1023, max(1, int(draw.lognormvariate(5.5, 1)))) for _ in range(20_000))
    plan = check_plan(counts, 1024)
    assert plan.cuts < 0.15 * sum(counts.values()) and plan.solved > 0.5 * plan.sequences


def test_packed_documents(spark, library):
    draw = random.Random(5)
    texts = [None, "", "one", "one", " ".join(f"n{i}" for i in range(9000)), "long " * 400_000]
    texts += [" ".join(draw.choice(["alpha", "beta,", "gamma's", "x\ny"]) for _ in range(draw.randrange(900))) for _ in range(150)]
    texts += ["copy of one text " * 60] * 80
    rows = [(i if i else None, t, "k", 1, 2, 3) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, task int, number int, length int").repartition(5)
    packed = packing.pack(df, PATH).withColumn("crc", F.crc32("ids")).cache()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, text in enumerate(texts):
        ids = np.array([*ids_of(library, text), 0], "<u4")
        at = 0
        for r in sorted(by_doc[i if i else None], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert bytes(r.ids) == ids[at : at + r.length].tobytes() and r.crc == zlib.crc32(r.ids)
            at += r.length
        assert at == len(ids)
    joined = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    padding = 0
    for number, parts in by_sequence.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and bytes(joined[number].ids[4 * at : 4 * (at + r.length)]) == bytes(r.ids)
            at += r.length
        assert at == joined[number].length <= 1024
        padding += joined[number].padded_length - at
    assert padding == 0
    assert packing.pack(df.limit(0), PATH).collect() == []
    packed.unpersist()
