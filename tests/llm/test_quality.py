"""Quality rules against a plain count, and the host verdicts."""

import random
import re
from collections import Counter

import duckdb
from check import compare

from roadpulse.llm import quality


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


def keepers(docs):
    """Places of the (text, host) rows that rules and verdicts on their hosts keep."""
    counts = [plain(text) for text, _ in docs]
    fails = {
        "base": [c[5] for c in counts], "symbols": [c[2] > quality.MAX_SYMBOLS * c[0] for c in counts],
        "lines": [c[3] > quality.MAX_REPEATED_LINES * c[0] for c in counts],
    }
    size = Counter(host for _, host in docs if host is not None)
    n, bad = sum(size.values()), {}
    for rule, failed in fails.items():
        of = Counter(host for (_, host), f in zip(docs, failed) if f and host is not None)
        mean = sum(of.values()) / n if n else 0
        a = b = 1.0
        noise = (len(size) - 1) / n if n else 0
        between = 1 - sum(v * v for v in size.values()) / n**2 - noise if n else 0
        if len(size) > 1 and 0 < mean < 1 and between > 0:
            spread = sum(size[h] / n * (of[h] / size[h] - mean) ** 2 for h in size)
            rho = (spread / (mean * (1 - mean)) - noise) / between
            strength = 1 / min(max(rho, quality.NO_SPREAD), 1 - quality.NO_SPREAD) - 1
            a, b = mean * strength, (1 - mean) * strength
        limit = quality.MAX_HOST_RATE if rule == "base" else quality.EXCUSED * mean
        bad[rule] = {h for h in size if (of[h] + a) / (size[h] + a + b) > limit}
    return [
        i for i, (_, host) in enumerate(docs)
        if not fails["base"][i] and host not in bad["base"] and not any(fails[r][i] and host in bad[r] for r in ("symbols", "lines"))
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, host string, kept string, __words string")


def rows():
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x\n\nx\n x\ny\r\ny\r\n", "über ß 漢 # $ <b>   \x1c"]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 90))) for _ in range(40)]
    texts += [" ".join(str(i) for i in range(20_000)), "w " * 5000]
    out = [(i, t, rng.choice(["s1", "s2", None]), "h", "k", "w") for i, t in enumerate(texts)]
    return out + out[:3] + [(None, "a b", "s1", None, None, None)]


def test_counts_match_a_plain_count(spark):
    got = quality.document_rules(frame(spark, rows())).collect()
    assert len(got) == len(rows())
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(r.text), r.doc_id


def test_matches_sql_and_empty(spark):
    df = frame(spark, rows())
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    assert compare(quality.report(df), con, quality.SQL) == ""
    assert quality.report(df.limit(0)).collect() == []


def test_bad_host_goes_and_small_host_is_shrunk(spark):
    good, bad = " ".join(str(i) for i in range(60)), "short"
    data = [(i, bad if i % 20 else good, "spam") for i in range(200)]
    data += [(1000 + 100 * h + i, bad if i < h else good, f"h{h}") for h in range(8) for i in range(60)]
    data += [(5000, bad, "tiny"), (5001, good, "tiny"), (5002, good, None)]
    got = {r.doc_id: r for r in quality.verdicts(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()}
    assert not any(got[i].kept for i in range(200))
    assert got[5001].kept and got[5001].host_rate < 0.5 and got[5002].kept and got[5002].host_rate is None
    assert all(got[1000 + 100 * h + 59].kept for h in range(8))


def test_soft_failures_go_unless_their_host_seldom_has_them(spark):
    good = " ".join(str(i) for i in range(60))
    noisy, lines = good + " $$$$$$$", good + "\nx" * 9
    data = [(i, noisy if i % 4 == 0 else lines if i % 4 == 1 else good, f"s{i % 3}") for i in range(1200)]
    data += [(2000 + i, noisy if i == 0 else good, "tidy") for i in range(400)] + [(3000, noisy, None)]
    got = {r.doc_id: r.kept for r in quality.verdicts(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()}
    assert not any(got[i] for i, text, host in data if text is not good and host in ("s0", "s1", "s2"))
    assert all(got[i] for i, text, host in data if text is good or host in ("tidy", None))


def test_prior_takes_sampling_noise_away():
    # Rates that differ as much as chance makes them: everything is shrunk to the mean.
    rng = random.Random(2)
    counts = [(n, sum(rng.random() < 0.2 for _ in range(n))) for n in [20] * 50 + [4000]]
    a, b = quality.beta_prior(len(counts), sum(n for n, _ in counts), sum(n * n for n, _ in counts), sum(f for _, f in counts), sum(f * f / n for n, f in counts))
    mean = sum(f for _, f in counts) / sum(n for n, _ in counts)
    assert abs(a / (a + b) - mean) < 1e-9 and a + b > 50
    counts = [(1000, 900), (1000, 100)] * 5
    a, b = quality.beta_prior(len(counts), 10_000, 10 * 1000.0**2, 5000, 5 * (900**2 + 100**2) / 1000)
    assert a + b < 1.5


def test_hosts_decide_on_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    found = quality.report(docs).collect()
    decided = [r.doc_id for r in found if not r.base_failed and not r.kept]
    assert len(decided) > 500 and not any(labels.get(i) == 1 for i in decided)
