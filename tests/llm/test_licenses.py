"""License scans against comparing every text with every template."""

import random

import duckdb
import pytest
from check import compare

from roadpulse.llm import licenses


def rows():
    rng = random.Random(6)
    word = lambda: rng.choice("abcdefgh") + str(rng.randint(0, 400))
    prose = lambda n: " ".join(word() for _ in range(n))
    out = [None, "", "released under the", "License", prose(20_000)]
    for name, text in licenses.TEMPLATES.items():
        out += [text, text.upper(), f"{prose(30)}\n{text.replace(' ', chr(10))} {prose(10)}", text[: len(text) * 9 // 10], text[: len(text) // 2]]
        words = text.split()
        for _ in range(3):
            words[rng.randrange(len(words))] = "other"
        out += [" ".join(words), " ".join(words[::-1])]
    out += out[-3:]
    return [(i, t, "x", "y") for i, t in enumerate(out)] + [(None, licenses.TEMPLATES["mit"], "x", "y"), (1, licenses.TEMPLATES["mit"], "x", "y")]


def test_same_as_every_pair(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, template string, key string")
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    assert compare(licenses.scan(df), con, licenses.sql()) == ""
    assert licenses.scan(df.limit(0)).collect() == []


def test_own_templates(spark):
    df = spark.createDataFrame([(1, "one two three four five six"), (2, "two three four five six")], "doc_id long, text string")
    got = licenses.scan(df, {"a": "One, two: three four five", "b": "x y z u v"}).collect()
    assert [(r.doc_id, r.template, r.n_shared, r.containment) for r in got] == [(1, "a", 1, 1.0)]
    with pytest.raises(Exception, match="too short"):
        licenses.scan(df, {"a": "one two"}).collect()


def test_exact_copies_at_every_offset(spark):
    own = {f"t{n}": " ".join(f"w{n}x{i}" for i in range(n + licenses.SHINGLE - 1)) for n in (1, 4, 5, *range(16, 24))}
    steps = {size: step for size, step, _, _ in licenses.WINDOWS}
    for r in licenses.template_table(spark, own).collect():
        assert len(r.shingles) >= r["size"] + steps[r["size"]] - 1, r.template
    texts = [(k, f"{'a b c d e f g h i '[: 2 * at]}{v} j k l m n o p q r s t") for k, v in own.items() for at in range(9)]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = {(r.doc_id, r.template) for r in licenses.scan(df, own).collect()}
    assert got == {(i, k) for i, (k, _) in enumerate(texts)}
