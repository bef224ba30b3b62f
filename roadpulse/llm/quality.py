"""Quality rules with verdicts on hosts.

Rules judge each document alone: too short or too repetitive (``base_failed``), many symbols, many repeated
lines.  Failures are counted by rule and host, and a host's rate for a rule is shrunk towards a beta prior that
is fitted to the rule's rates over all hosts.  Joined back, the verdicts on hosts decide twice:
all documents of a host go whose shrunk rate of the base rule is above a limit; and a document
that fails a soft rule, symbols or lines, goes unless its host's shrunk rate says that such failures are rare there.

Defined cases: a null text has no words, so the word rule rejects it; a null host has no verdict, so only the base rule
rejects its documents; repeated rows count as often as they occur and each gets a row; texts of any length are one row's
arrays; ties cannot occur, a rate equal to a limit keeps; columns of the input with the names of the added ones are replaced;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.sources.storage import stage

MIN_WORDS = 50
#: Rejected with more than this share, in percent, of words in repeated three-word windows.
MAX_REPEAT_PERCENT = 50
#: Hosts whose shrunk failure rate is above this go as a whole.
MAX_HOST_RATE = 0.5
#: Soft rules: more symbols, or more repeated lines, than this share of the words.
MAX_SYMBOLS, MAX_REPEATED_LINES = 0.1, 0.05
#: A soft failure is excused where the host's shrunk rate is at most this share of the rate over all hosts.
EXCUSED = 0.5
#: Correlation inside hosts when their rates differ by no more than chance.
NO_SPREAD = 1e-6
RULES = ("base", "symbols", "lines")
SYMBOLS = "[#*$%&|<>]"
_GAP = "[ \\t-\\r]+"
_BLANK = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Runs of other characters than space and U+0009 to U+000D."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _GAP), lambda w: w != "")


def _with_repeat_words(df: DataFrame) -> DataFrame:
    """``n_repeat_words`` from ``__windows``: words inside windows whose hash occurs twice or more.

    In (hash, place) order equal hashes are neighbours.  Each step is a column of its own, so that no
    step is computed again for every use.
    """
    pairs = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = df.withColumn("__ordered", pairs)
    at = lambda i: F.get("__ordered", i)["h"]
    twice = F.filter("__ordered", lambda x, i: x["h"].eqNullSafe(at(i - 1)) | x["h"].eqNullSafe(at(i + 1)))
    places = ordered.withColumn("__places", F.transform(twice, lambda x: x["i"]))
    covered = F.concat("__places", F.transform("__places", lambda i: i + 1), F.transform("__places", lambda i: i + 2))
    return places.withColumn("n_repeat_words", F.size(F.array_distinct(covered)).cast("long")).drop("__windows", "__ordered", "__places")


def document_rules(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts and ``base_failed``; columns of these names are replaced."""
    body = F.coalesce(F.col(text), F.lit(""))
    cut = df.withColumn("__words", words(F.col(text)))
    lines = F.filter(F.split(body, "\n"), lambda line: F.length(F.btrim(line, F.lit(_BLANK))) > 0)
    cut = cut.withColumn("__lines", lines)
    word = F.col("__words")
    n = F.size(word)
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(1), n - 2),
            lambda i: F.xxhash64(F.get(word, i - 1), F.get(word, i), F.get(word, i + 1)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = cut.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.regexp_replace(body, _GAP, "")).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__windows": windows,
    }).drop("__words", "__lines")
    judged = _with_repeat_words(counted)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return judged.withColumn("base_failed", failed)


def _fails(rule: str) -> Column:
    """Whether a document with its counts fails a rule."""
    return {
        "base": F.col("base_failed"),
        "symbols": F.col("n_symbols") > MAX_SYMBOLS * F.col("n_words"),
        "lines": F.col("n_dup_lines") > MAX_REPEATED_LINES * F.col("n_words"),
    }[rule]


def beta_prior(hosts: int, n: float, squares: float, failed: float, spread: float) -> tuple[float, float]:
    """The beta distribution of hosts' rates by weighted moments; (1, 1) where they say nothing.

    ``n`` documents, ``squares`` the sum of squares of the hosts' counts, ``spread`` the sum of failed^2 / count.  Hosts weigh
    by their documents, and the part of the variance that sampling alone explains is taken away.
    """
    if hosts < 2 or not 0 < failed < n:
        return 1.0, 1.0
    mean, noise = failed / n, (hosts - 1) / n
    between = 1 - squares / n**2 - noise
    if between <= 0:
        return 1.0, 1.0
    chance = mean * (1 - mean)
    within = min(max((spread / n - mean**2 - chance * noise) / (chance * between), NO_SPREAD), 1 - NO_SPREAD)
    strength = 1 / within - 1
    return mean * strength, (1 - mean) * strength


def host_rates(judged: DataFrame, host: str = "source") -> DataFrame:
    """host, n, and for each rule the failures, the shrunk rate and ``<rule>_bad``, the verdict on the host.

    One row of sums comes to the driver.
    """
    counts = [F.sum(_fails(rule).cast("long")).alias(f"{rule}_failed") for rule in RULES]
    hosts = judged.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n"), *counts)
    hosts = stage(hosts, "hosts")
    n = F.col("n").cast("double")
    sums = [F.count(F.lit(1)), F.sum(n), F.sum(n * n)]
    for rule in RULES:
        failed = F.col(f"{rule}_failed").cast("double")
        sums += [F.sum(failed), F.sum(failed * failed / n)]
    k, documents, squares, *moments = hosts.agg(*sums).first()
    out = hosts
    for i, rule in enumerate(RULES):
        failed, spread = moments[2 * i : 2 * i + 2]
        a, b = beta_prior(k, documents, squares, failed, spread) if k else (1.0, 1.0)
        rate = (F.col(f"{rule}_failed") + a) / (n + (a + b))
        limit = MAX_HOST_RATE if rule == "base" else EXCUSED * failed / documents if k else 1.0
        out = out.withColumn(f"{rule}_rate", rate).withColumn(f"{rule}_bad", rate > limit)
    return out


def with_host_verdicts(judged: DataFrame, host: str = "source") -> DataFrame:
    """Judged documents with ``host_rate`` (of the base rule; null without a host) and ``kept``.

    ``judged`` is written once and read for the counts and for the join.  Hosts are counted from
    partial sums, so a host with most documents costs no more; the join splits its rows at run time.
    """
    judged = stage(judged, "judged")
    return _join_rates(judged, _written_rates(judged, host), host)


def _written_rates(judged: DataFrame, host: str) -> DataFrame:
    """Rates in a table, so that the join knows the size of this side before it deals out documents."""
    rates = host_rates(judged, host)
    bad = F.struct(*[F.col(f"{rule}_bad").alias(rule) for rule in RULES])
    return stage(rates.select(F.col("host").alias("__host"), F.col("base_rate").alias("__rate"), bad.alias("__bad")), "host-rates")


def _join_rates(judged: DataFrame, rates: DataFrame, host: str) -> DataFrame:
    joined = judged.join(rates, F.col(host) == F.col("__host"), "left")
    verdict = lambda rule: F.coalesce(F.col("__bad")[rule], F.lit(False))
    kept = ~F.col("base_failed") & ~verdict("base")
    for rule in RULES[1:]:
        kept = kept & ~(_fails(rule) & verdict(rule))
    return joined.withColumn("host_rate", F.col("__rate")).withColumn("kept", kept).drop("__host", "__rate", "__bad")


def verdicts(df: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``df`` with the counts, ``base_failed``, ``host_rate`` and ``kept``.

    Rules are computed once for the hosts and again for the rows: cheaper in memory and disk than to write
    every text next to its counts, most of them only to be written again by the caller.
    """
    rates = _written_rates(document_rules(df.select(text, host), text).drop(text), host)
    judged = _join_rates(document_rules(df, text), rates, host)
    # Through a one-element array: a filter on ``kept`` would otherwise be rewritten to compute every rule again, step inside step.
    return judged.withColumn("kept", F.explode(F.array("kept")))


def report(df: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """doc_id with counts and verdicts, without the texts."""
    judged = document_rules(df.select("doc_id", text, host), text).drop(text)
    return with_host_verdicts(judged, host).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


#: The same verdicts in DuckDB; the window sums replace the join of hosts.
SQL = rf"""
WITH cut AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+') IF x <> ''] AS w
  FROM documents
), lines AS (
  SELECT *, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^ \t-\r]')] AS l FROM cut
), windows AS (
  SELECT r, unnest([[w[i], w[i + 1], w[i + 2]] FOR i IN range(1, greatest(len(w) - 1, 1))]) AS g,
         unnest(range(1, greatest(len(w) - 1, 1))) AS i
  FROM lines
), found AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM windows
), covered AS (
  SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM found WHERE c > 1) GROUP BY r
), judged AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[ \t-\r]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '{SYMBOLS}')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(w) < {MIN_WORDS} OR 100 * coalesce(n, 0) > {MAX_REPEAT_PERCENT} * len(w) AS base_failed
  FROM lines LEFT JOIN covered USING (r)
), fails AS (
  SELECT *, n_symbols > {MAX_SYMBOLS}E0 * n_words AS symbols_failed, n_dup_lines > {MAX_REPEATED_LINES}E0 * n_words AS lines_failed FROM judged
), hosts AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (base_failed) AS DOUBLE) AS base,
         CAST(count(*) FILTER (symbols_failed) AS DOUBLE) AS symbols, CAST(count(*) FILTER (lines_failed) AS DOUBLE) AS lines
  FROM fails WHERE source IS NOT NULL GROUP BY source
), long AS (
  SELECT source, n, rule, failed FROM hosts UNPIVOT (failed FOR rule IN (base, symbols, lines))
), sums AS (
  SELECT rule, count(*) AS k, sum(n) AS docs, sum(n * n) AS squares, sum(failed) AS failed, sum(failed * failed / n) AS spread FROM long GROUP BY rule
), moments AS (
  SELECT *, failed / docs AS m, (k - 1) / docs AS noise, 1 - squares / (docs * docs) - (k - 1) / docs AS between_ FROM sums
), prior AS (
  SELECT rule, failed / docs AS overall, k < 2 OR failed <= 0 OR failed >= docs OR between_ <= 0 AS nothing, m,
         1 / least(greatest((spread / docs - m * m - m * (1 - m) * noise) / nullif(m * (1 - m) * between_, 0), {NO_SPREAD}), 1 - {NO_SPREAD}) - 1 AS strength
  FROM moments
), rates AS (
  SELECT source, rule, (failed + CASE WHEN nothing THEN 1 ELSE m * strength END) / (n + CASE WHEN nothing THEN 2 ELSE strength END) AS rate, overall
  FROM long JOIN prior USING (rule)
), bad AS (
  SELECT source, bool_or(rule = 'base' AND rate > {MAX_HOST_RATE}) AS base, bool_or(rule = 'symbols' AND rate > {EXCUSED} * overall) AS symbols,
         bool_or(rule = 'lines' AND rate > {EXCUSED} * overall) AS lines
  FROM rates GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR coalesce(base, false) OR (symbols_failed AND coalesce(symbols, false)) OR (lines_failed AND coalesce(lines, false))) AS kept
FROM fails LEFT JOIN bad USING (source)
"""
