"""BPE against the tokenizer library, and an exact round trip."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from roadpulse.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library(library):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab cßé漢字 \n\t1234,.!'s<|endoftext|>") for _ in range(rng.randint(0, 200))) for _ in range(400)]
    texts += ["", " ", "a" * 3000, "漢字" * 900, " " * 2500, "x" * bpe.MATRIX_BYTES, "é" * (bpe.MATRIX_BYTES // 2 + 1), "hello" * 700]
    known = bpe.Vocabulary(PATH, public_tokenizers.PATTERN)
    got = known.encode_all(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode_ordinary(x) for x in texts]
    assert [known.decode(x).decode() for x in got] == texts
    assert known.encode("brand-new wörd") == known.encode_all(["brand-new wörd"])[0]


def test_forgetting_pieces_keeps_results(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    known = bpe.Vocabulary(PATH, public_tokenizers.PATTERN)
    texts = ["one two three four five", "six seven one two", "zzzqqq"]
    assert [known.decode(x).decode() for x in known.encode_all(texts) + known.encode_all(texts)] == texts * 2


def test_digests_of_null_repeated_and_extra_columns(spark, library):
    rows = [(1, None, "x"), (2, "", "y"), (3, "word " * 30_000, None), (3, "word " * 30_000, None), (None, "ça va", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    got = {tuple(r) for r in bpe.digests(df, PATH, public_tokenizers.PATTERN).collect()}
    want = set()
    for doc, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        want.add((doc, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == want
    assert bpe.digests(df, PATH, public_tokenizers.PATTERN).count() == len(rows)
    assert bpe.digests(df.limit(0), PATH, public_tokenizers.PATTERN).collect() == []
