"""Near-duplicate classes against brute force."""

import random
import re

import numpy as np
import pytest

from roadpulse.llm import jaccard
from roadpulse.llm.words import Words, sequences, shingle_sets

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if rows[i][0] is not None and rows[j][0] is not None and n and 100 * n >= 80 * (len(a) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((d, len(s), None if d is None else least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice("abcdefghij") * rng.randint(1, 4)
    return words


def corpus(seed, groups=12, copies=14):
    rng = random.Random(seed)
    texts = []
    line = [f"common{i}" for i in range(12)]
    for g in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([6, 9, 20, 40, 90, 150, 300]))]
        texts += [" ".join(edited(rng, base, rng.randint(0, max(1, len(base) // 12)))) for _ in range(copies)]
        texts.append(" ".join(line + base[:20]))
    texts += [None, "", " \n", "a", "A", "a b", "a b c d", "A B  c\nd", "a b c d e", " ".join(line), " ".join(line) + " x", "É a b c d e", "é a b c d e"]
    texts += texts[:5] + [" ".join(f"long{i}" for i in range(20_000))] * 2
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    return rows + [(None, "a"), (None, texts[0]), (rows[3][0], rows[7][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_classes_as_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", [400_000, 700][seed - 1])
    monkeypatch.setattr(jaccard, "PAIRS_ABOVE", [8, 3][seed - 1])
    monkeypatch.setattr(jaccard, "TRIPLES_ABOVE", [64, 6][seed - 1])
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", [500_000, 0][seed - 1])
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], "doc_id long, text string, name string, node string")
    assert sorted((tuple(r) for r in jaccard.classes(df).collect()), key=str) == brute(rows)


def test_one_row_of_each_class_stays(spark):
    rows = corpus(3, groups=5, copies=6)
    df = spark.createDataFrame([(d, t, "x", i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, name string, __doc int")
    got = jaccard.keep_one(df).collect()
    want = brute(rows)
    stay = [(d, t) for d, t in rows if d is None or not shingles(t)]
    assert len(got) == len({c for d, n, c in want if d is not None and n}) + len(stay)
    assert {r.doc_id for r in got if r.doc_id is not None and shingles(r.text)} == {c for d, n, c in want if d is not None and n}
    assert jaccard.keep_one(df.limit(0)).columns == df.columns


def test_empty_table(spark):
    assert jaccard.classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_similar_sets_share_a_key():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = rng.integers(1, 1 << 62, n).astype(np.uint64)
        count = {int(x): int(c) for x, c in zip(a, rng.choice([2, 5, 20, 100, 3000], n))}
        b, extra = a.copy(), [int(x) for x in rng.integers(1, 1 << 62, int(n * 0.1))]
        b = np.concatenate([rng.permutation(b)[: max(1, int(np.ceil(n * 0.9)))], np.array(extra, np.uint64)])
        count.update({x: int(rng.choice([2, 20, 100])) for x in extra})
        shared = len(set(a.tolist()) & set(b.tolist()))
        if 100 * shared < 80 * (len(a) + len(b) - shared):
            continue
        keys = [jaccard.prefix_keys(len(s), s, np.array([count[int(x)] for x in s])) for s in (a, b)]
        assert np.isin(*keys).any(), (len(a), len(b), shared)


def test_words_and_sequences():
    texts = ["Ab cd\x0bef  é", "", "x", " y z"]
    raw = [t.encode() for t in texts]
    words = Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))
    assert words.counts.tolist() == [4, 0, 1, 2]
    one = Words(np.frombuffer(b"q ab q", np.uint8), np.array([0, 6]))
    assert words.hashes(lower=True)[0] == one.hashes()[1] != words.hashes()[0] and one.hashes()[0] == one.hashes()[2]
    assert len(sequences(words.hashes(), 8)) == 0
    assert np.diff(shingle_sets(words, 5)[1]).tolist() == [1, 0, 1, 1]
