"""The pipeline against a plain version on the smallest documents."""

import base64
import hashlib
import math
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import tiktoken
from test_jaccard import brute
from test_mixing import draw, inverse
from test_quality import keepers

from roadpulse.llm import mixing

SF = "/root/testdata/sf0.001"


def test_same_as_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    kept = [docs[i] for i in keepers([(r.text, r.source) for r in docs])]
    first = {c for _, _, c in brute([(r.doc_id, r.text) for r in kept])}
    kept = [r for r in kept if r.doc_id in first]
    secret = re.compile(r"AKIA[0-9A-Z]{16}|(?<=password=)[0-9a-f]{18}|(?<=token = \")[0-9a-f]{40}")
    texts = {r.doc_id: secret.sub("<secret>", r.text) for r in kept}
    sources = {r.doc_id: r.source for r in kept}
    size = Counter()
    for i, t in texts.items():
        size[sources[i]] += len(t)
    scale = sum(size.values()) / sum(math.sqrt(v) for v in size.values())
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for i, t in texts.items():
        ids = np.array(library.encode_ordinary(t), "<u4")
        row = (i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        want[row] = inverse(draw(mixing.SEED, str(i), "0"), scale / math.sqrt(size[sources[i]]))
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == Counter({k: v for k, v in want.items() if v})


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "word " * 60, "en", "s", 1), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, " ".join(map(str, range(99))), "en", "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, apply in corpus_pipeline.STAGES[:-1]:
            out = apply(spark, docs, SF)
            assert out.columns == docs.columns
            out.collect()
        assert len(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()) == len(data)
