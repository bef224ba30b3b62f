"""Language filters: counts, false positives, held-out accuracy."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from roadpulse.llm import language, queries


def plain(text):
    marks = [c.lower() if c.isalpha() else "\0" for c in f" {text} "]
    run = [c for i, c in enumerate(marks) if c != "\0" or i == 0 or marks[i - 1] != "\0"]
    return Counter("".join(run[i : i + 3]) for i in range(len(run) - 2) if run[i + 1] != "\0")


def test_grams_of_each_text():
    texts = ["Ça va, x", None, "", "12 !", "a", "漢字かな", " b  b ", "É" * 5]
    found, owner, has = language.grams(texts)
    for i, t in enumerate(texts):
        got = Counter("".join(chr((int(g) >> s) & 0x1FFFFF) for s in (42, 21, 0)) for g in found[owner == i])
        assert got == plain(t or ""), t
    assert has.tolist() == [True, False, False, False, True, True, True, True]


def test_filter_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(1)
    hashes, names = rng.integers(0, 1 << 63, 70_000).astype(np.uint64), rng.integers(0, 70, 70_000)
    model = language.build([f"l{i}" for i in range(70)], names, hashes)
    held = model.look_up(hashes)
    assert all((held[n // 64, i] >> np.uint64(n % 64)) & np.uint64(1) for i, n in enumerate(names))
    other = model.look_up(rng.integers(0, 1 << 63, 20_000).astype(np.uint64))
    rate = ((other[1] >> np.uint64(3)) & np.uint64(1)).mean()
    assert abs(rate - model.false_rate[67]) < 0.01 and rate < 0.02


def test_edge_cases(spark):
    rows = [(1, "der die das und", "de", "p", 0.5), (2, "the and of that", "en", "p", 0.5), (3, None, "en", "p", None), (4, "x", None, None, None), (5, "", "de", "p", 0.1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")
    model = language.fit(df)
    asked = spark.createDataFrame([(1, "that and"), (1, "that and"), (2, None), (3, "1 2"), (None, "die " * 50_000), (4, "漢字")], "doc_id long, text string")
    got = [(r.doc_id, r.lang_pred, r.score) for r in language.predict(asked, model).collect()]
    assert [g[1] for g in got] == ["en", "en", "und", "und", "de", got[5][1]] and got[5][1] in ("de", "en") and got[5][2] == 0 == got[2][2]
    assert language.predict(df, model).columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert language.predict(asked, language.fit(df.limit(0))).where("lang_pred <> 'und'").count() == 0
    assert language.predict(asked.limit(0), model).collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op5_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = got.where("held_out AND lang IS NOT NULL").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right[0] > 0.97 and right[1] > 150
