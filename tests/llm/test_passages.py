"""Repeated passages against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from roadpulse.llm import passages
from roadpulse.llm.words import Words


def brute(texts, window=35):
    cut = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    places = {}
    for d, w in enumerate(cut):
        for i in range(len(w) - window + 1):
            places.setdefault(tuple(w[i : i + window]), []).append((d, i))
    gone = [set() for _ in texts]
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                gone[d].update(range(i, i + window))
    return [(len(w), len(g), " ".join(x for i, x in enumerate(w) if i not in g)) for w, g in zip(cut, gone)]


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)] + ["é", "漢字", "#"]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, line, short = some(80), some(12), some(34)
    texts = []
    for i in range(70):
        body = some(rng.randint(0, 150))
        if i % 2:
            body += passage[rng.randint(0, 30) : rng.randint(50, 80)] + some(20)
        if i % 3 == 0:
            body = line + body + line
        if i % 7 == 0:
            body += short + some(3)
        texts.append(rng.choice([" ", "\n", " \t"]).join(body))
    base = some(120)
    for _ in range(30):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(120)] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    return texts + [None, "", " ", "one", "a " * 34, "a " * 35, "b " * 36, " ".join(some(20_000)), " ".join(base), texts[0], texts[1], "  " + texts[1]]


@pytest.mark.parametrize("limit", [400, 3])
def test_same_as_brute_force(spark, limit, monkeypatch):
    monkeypatch.setattr(passages, "SHARD_STRETCHES", limit)
    monkeypatch.setattr(passages, "SHARD_WORDS", 2000)
    monkeypatch.setattr("roadpulse.llm.repeats.RANGE_HASHES", 300)
    texts = corpus(limit)
    df = spark.createDataFrame([(i, t, "x", "k") for i, t in enumerate(texts)], "doc_id long, text string, key string, kept string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in passages.report(df).collect()}
    want = brute(texts)
    assert got == {i: (n, g, hashlib.sha256(k.encode()).hexdigest()) for i, (n, g, k) in enumerate(want)}
    assert sum(g for _, g, _ in want) > 2000


def test_empty_table_and_missing_ids(spark):
    df = spark.createDataFrame([(None, "x y " * 40), (1, None)], "doc_id long, text string")
    assert passages.report(df.limit(0)).collect() == []
    assert {(r.doc_id, r.n_removed) for r in passages.report(df).collect()} == {(None, 80), (1, 0)}


def test_automaton_counts_places():
    rng = random.Random(4)
    stretches = [bytes(" ".join(rng.choice("ab") for _ in range(rng.randint(5, 40))), "ascii") for _ in range(60)]
    stretches = list(dict.fromkeys(stretches))
    weights = [rng.choice([1, 1, 3]) for _ in stretches]
    got = passages.shard_masks(stretches, weights, 5)
    places = {}
    for s, weight in zip(stretches, weights):
        w = s.split()
        for i in range(len(w) - 4):
            places[tuple(w[i : i + 5])] = places.get(tuple(w[i : i + 5]), 0) + weight
    for s, mask in zip(stretches, got):
        w = s.split()
        assert mask == sum(1 << i for i in range(len(w) - 4) if places[tuple(w[i : i + 5])] > 1)


def test_every_window_has_one_anchor():
    raw = (" ".join(f"v{i % 50}" for i in range(200))).encode()
    words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    text, first, windows, _ = passages.anchors(words, 35, 8)
    assert windows.sum() == 200 - 34 and windows.max() <= 28 and (first[1:] == (first + windows)[:-1]).all() and not text.any()
