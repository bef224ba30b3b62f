"""Secret scans: patterns find candidates, a random forest removes the false ones.

Features of a candidate are its length, how usual its character transitions are, how much of it
dictionary pieces cover, marks of paths, and the words beside it.  Transitions and the dictionary
are counted over the words of all texts.  The forest is trained on labelled findings, at most
``LABELLED`` of each label, taken by hash.

Findings depend on the text alone, so equal texts are scanned once.  Defined cases: null and empty
texts have no findings; overlapping candidates do not occur, the leftmost match wins; a named value
runs to the next blank, quote or other mark that ends it; a private key is one finding from BEGIN to
END, after a name too; a text that
repeats a candidate has a finding for each place; a text's rows share its findings; if only one
label was found among the training findings all findings get it; a text of any length is one row, though the work of
placing findings grows with the square of their number in one text; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.sources.storage import stage

_BEGIN = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
#: A private key to its END line; without one, the base64 lines that follow.  Repeated groups are possessive, so long ones take no stack.
_BLOCK = _BEGIN + (
    r"(?:(?:[^-]|-(?!----))*+-----END [A-Z ]{0,20}PRIVATE KEY-----"
    r"|(?:(?:\s*+(?:Proc-Type|DEK-Info): \S++)*+(?:(?:\s|\\[nr])*+[A-Za-z0-9+/=]{40,}+)++"
    r"(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/=]++[ \t]*+(?=\r?\n|\z))?+)?+)"
)
#: Fixed shapes of issued keys.
ISSUED = [
    r"AKIA[0-9A-Z]{16}",
    r"gh[pousr]_[A-Za-z0-9]{36,}",
    r"xox[abprs]-[A-Za-z0-9-]{10,}",
    r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}",
    r"AIza[A-Za-z0-9_-]{35}",
    r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    _BLOCK,
]
#: Words that come before a secret value.
NAMES = "password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|credential"
_SIGN = rf"(?i:(?:{NAMES})[\"']?\s*+(?::=|=|:)\s*+)[\"']?"
#: A value ends before an issued shape inside it, which is a candidate of its own.
_ASSIGNED = rf"{_SIGN}(?:{_BLOCK}|[^\s\"'<>,;](?:(?!{'|'.join(ISSUED)})[^\s\"'<>,;]){{5,}}+)"
_LONG = rf"(?=[A-Za-z0-9+/_=-]{{20}})(?:[A-Za-z0-9+/_=]|(?!{_BEGIN})-){{20,}}+"
CANDIDATE = "(?:" + "|".join([*ISSUED, _ASSIGNED, _LONG]) + ")"
#: Labelled findings used for training, of each label.
LABELLED = 10_000
TREES = 30
NEAR = 40
THRESHOLD = 0.5
REDACTED = "<secret>"
FEATURES = ["length", "transition", "coverage", "digit_share", "upper_share", "symbol_share", "path_marks", "named", "word_beside"]
_VALUE = rf"^{_SIGN}"
#: Pieces of this many letters make the dictionary.
PIECE = 4
#: A piece is in the dictionary if this part of all pieces, or more, is it.
PIECE_SHARE = 2e-6


def findings(df: DataFrame, text: str = "text") -> DataFrame:
    """(text_id, place, size, found, value, before, after) for every candidate of every different text.

    ``place`` and ``size`` are the value's, in characters from 1; ``text_id`` is the MD5 of the text.
    """
    texts = df.select(F.col(text).alias("text")).where(F.col("text").isNotNull())
    hits = texts.withColumn("hits", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))).where(F.size("hits") > 0)
    hits = hits.withColumn("text_id", F.md5("text")).groupBy("text_id").agg(F.any_value("text").alias("text"), F.any_value("hits").alias("hits"))

    # Each hit is looked for after the one before; the list holds places in order.
    places = F.expr(
        """aggregate(hits, named_struct('next', 1, 'found', cast(array() as array<struct<place:int,found:string>>)),
             (s, h) -> named_struct(
               'next', locate(h, text, s.next) + length(h),
               'found', array_append(s.found, named_struct('place', locate(h, text, s.next), 'found', h))),
             s -> s.found)"""
    )
    each = hits.select("text_id", "text", F.explode(places).alias("f")).select("text_id", "text", F.col("f.place").alias("at"), F.col("f.found").alias("found"))
    value = F.regexp_replace("found", _VALUE, "")
    each = each.withColumn("value", value).withColumn("place", F.col("at") + F.length("found") - F.length("value"))
    start = F.greatest(F.col("at") - NEAR, F.lit(1))
    return each.select(
        "text_id", "place", F.length("value").alias("size"), "found", "value",
        F.substring("text", start, F.col("at") - start).alias("before"),
        F.substring("text", F.col("at") + F.length("found"), F.lit(NEAR)).alias("after"),
    )


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) of the letter runs of all texts, lower case."""
    word = F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word")
    return df.where(F.col(text).isNotNull()).select(word).where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _grams(text: Column, k: int) -> Column:
    """All substrings of ``k`` characters, in one pass: substring() counts from the start each time."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{k}}}))."), F.lit(1))


def statistics(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pair, log_p): character transitions; (piece): dictionary pieces; both over all words."""
    # A word's first letter follows a space.
    pairs = words.select(F.explode(_grams(F.concat(F.lit(" "), "word"), 2)).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = stage(pairs, "transitions")
    first = F.substring("pair", 1, 1)
    totals = pairs.groupBy(first.alias("first")).agg(F.sum("n").alias("total"))
    log_p = F.log(F.col("n") / F.col("total")).alias("log_p")
    transitions = stage(pairs.join(totals, first == F.col("first")).select("pair", log_p), "transition-logs")
    pieces = stage(words.select(F.explode(_grams(F.col("word"), PIECE)).alias("piece"), "n").groupBy("piece").agg(F.sum("n").alias("n")), "pieces")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    return transitions, pieces.where(F.col("n") >= PIECE_SHARE * total).select("piece")


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.greatest(F.length("value"), F.lit(1))


def with_features(found: DataFrame, transitions: DataFrame, pieces: DataFrame) -> DataFrame:
    """Findings with the feature columns."""
    # A value's parts are looked up once for each different value; their rows carry its MD5, since values have no bound.
    values = stage(found.select("value").distinct().withColumn("__v", F.md5("value")), "values")
    pair = values.select("__v", F.explode(_grams(F.concat(F.lit(" "), F.lower("value")), 2)).alias("pair"))
    # A transition that no word has is as rare as anything.
    usual = pair.join(transitions, "pair", "left").groupBy("__v").agg(F.avg(F.coalesce("log_p", F.lit(-12.0))).alias("transition"))
    piece = values.select("__v", F.explode(_grams(F.lower("value"), PIECE)).alias("piece"))
    covered = piece.join(pieces.withColumn("known", F.lit(1.0)), "piece", "left").groupBy("__v").agg(F.avg(F.coalesce("known", F.lit(0.0))).alias("coverage"))
    table = stage(values.join(usual, "__v", "left").join(covered, "__v", "left").drop("__v").na.fill({"transition": -12.0, "coverage": 0.0}), "value-features")
    named = (F.col("found") != F.col("value")) | F.col("before").rlike(rf"(?i)(?:{NAMES})\W{{0,12}}$")
    beside = F.regexp_count(F.concat_ws(" ", "before", "after"), F.lit(r"(?i)\b(?:key|login|user|bearer|config|env|export|private|credentials?)\b"))
    return found.join(table, "value").withColumns({
        "length": F.length("value").cast("double"),
        "digit_share": _share("[0-9]"),
        "upper_share": _share("[A-Z]"),
        "symbol_share": _share("[^A-Za-z0-9]"),
        "path_marks": (F.regexp_count("value", F.lit("[/.]")) + F.col("before").rlike(r"[/\\.@]$").cast("int") + F.col("after").rlike(r"^[/\\@]").cast("int")).cast("double"),
        "named": named.cast("double"),
        "word_beside": beside.cast("double"),
    })


def labelled(found: DataFrame) -> DataFrame:
    """``label`` for findings that rules can settle, null for the rest.

    1: a shape that only issued keys have, or a named value of mixed letters and digits.
    0: a place holder, a run of letters of one case, a word list joined by marks.
    """
    issued = F.col("value").rlike("^(?:" + "|".join(ISSUED) + ")$")
    holder = F.col("value").rlike(r"(?i)example|changeme|placeholder|your[_-]|xxxx|\*{3}|^<|^\$\{|0{8}|12345678")
    wordy = F.col("value").rlike(r"^(?:[A-Z]?[a-z]+|[A-Z]+)(?:[-_/+=]+(?:[A-Z]?[a-z]+|[A-Z]+))*[-_/+=]*$")
    random = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]") & (F.length("value") >= 12)
    label = F.when(holder, 0.0).when(issued, 1.0).when(wordy, 0.0).when((F.col("found") != F.col("value")) & random, 1.0)
    return found.withColumn("label", label)


def train(examples: DataFrame, limit: int = LABELLED, seed: int = 7) -> Model | None:
    """A forest from findings with features and ``label``; of each label, ``limit`` values by least hash.

    None if there are not two labels.
    """
    different = examples.where("label IS NOT NULL").groupBy("label", "value").agg(*[F.max(c).alias(c) for c in FEATURES if c != "value"])
    some = [different.where(F.col("label") == v).orderBy(F.xxhash64("value"), "value").limit(limit) for v in (0.0, 1.0)]
    sample = stage(some[0].union(some[1]), "labelled")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=8, seed=seed, featuresCol="features", labelCol="label", subsamplingRate=0.8)
    # The sample is bounded, so one ordered partition makes training repeatable.
    return forest.fit(_vectors(sample.repartition(1).sortWithinPartitions("label", "value")))


def _vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def judge(featured: DataFrame, model: Model | None, only_label: float = 0.0, threshold: float = THRESHOLD) -> DataFrame:
    """Findings with ``probability`` and ``is_secret``."""
    if model is None:
        return featured.withColumn("probability", F.lit(only_label)).withColumn("is_secret", F.col("probability") >= threshold)
    scored = model.transform(_vectors(featured)).withColumn("probability", vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "prediction").withColumn("is_secret", F.col("probability") >= threshold)


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """(text_id, place, size, value, probability, is_secret) for every candidate of every different text."""
    found = stage(findings(df, text), "findings")
    transitions, pieces = statistics(stage(word_counts(df, text), "words"))
    featured = stage(labelled(with_features(found, transitions, pieces)), "featured-findings")
    model = train(featured)
    only = featured.agg(F.max("label")).first()[0] if model is None else 0.0
    return judge(featured, model, only or 0.0).select("text_id", "place", "size", "value", "probability", "is_secret")


def report(df: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, place, size, value, probability, is_secret for each candidate in each document."""
    found = stage(scan(df, text), "judged-findings")
    docs = df.select("doc_id", F.md5(text).alias("text_id"))
    return docs.join(found, "text_id").select("doc_id", "place", "size", "value", F.round("probability", 6).alias("probability"), "is_secret")


def redact(df: DataFrame, text: str = "text", mark: str = REDACTED) -> DataFrame:
    """``df`` with every secret in ``text`` replaced by ``mark``."""
    spans = scan(df, text).where("is_secret").groupBy(F.col("text_id").alias("__id"))
    spans = stage(spans.agg(F.sort_array(F.collect_list(F.struct("place", "size")), asc=False).alias("__spans")), "secret-spans")
    joined = df.withColumn("__key", F.md5(text)).join(spans, F.col("__key") == F.col("__id"), "left")
    # From the last to the first, so that places stay right.
    cut = F.aggregate("__spans", F.col(text), lambda t, s: F.overlay(t, F.lit(mark), s["place"], s["size"]))
    return joined.withColumn(text, F.when(F.col("__spans").isNull(), F.col(text)).otherwise(cut)).drop("__key", "__id", "__spans")
