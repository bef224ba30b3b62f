"""A registry of fitted models that jobs share.

A model is written under the registry's folder first; then one file, its entry, appears under its final name by a
rename that fails if the name is taken.  So readers see whole models only, and two jobs
that publish at once get two versions.  The registry is a table of these entries; the newest version
for a set of training data is the one with the highest number.  Everything goes through Spark's own file
systems: a registry can live wherever tables do.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.operators.runlog import read_log

ENTRIES = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("run", T.StringType()),
    T.StructField("trained_on", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("published", T.StringType()),
])
#: Attempts to take the next version while other jobs publish the same model.
ATTEMPTS = 20


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def table(spark: SparkSession, registry: str) -> DataFrame:
    """All entries of a registry; no rows if nothing was published."""
    _, folder, fs = _files(spark, f"{registry}/entries")
    if not fs.exists(folder):
        return spark.createDataFrame([], ENTRIES)
    return spark.read.schema(ENTRIES).json(f"{registry}/entries")


def newest(spark: SparkSession, registry: str, model: str, trained_on: str) -> dict | None:
    """The entry with the highest version of a model fitted to the given data."""
    found = (
        table(spark, registry)
        .filter((F.col("model") == model) & (F.col("trained_on") == trained_on))
        .orderBy(F.desc("version"))
        .first()
    )
    return found.asDict() if found else None


def publish(
    spark: SparkSession, registry: str, name: str, model: PipelineModel, trained_on: str, params: Mapping[str, object] | None = None
) -> dict:
    """Save a model and make it the newest version; returns its entry."""
    path = f"{registry}/models/{name}-{uuid.uuid4().hex}"
    model.write().save(path)
    entry = {
        "model": name, "path": path, "run": uuid.uuid4().hex, "trained_on": trained_on,
        "params": {k: str(v) for k, v in (params or {}).items()}, "published": dt.datetime.now(dt.timezone.utc).isoformat(),
    }
    for _ in range(ATTEMPTS):
        highest = table(spark, registry).filter(F.col("model") == name).agg(F.max("version")).first()[0]
        entry["version"] = (highest or 0) + 1
        if _put(spark, registry, f"{name}-{entry['version']:08d}.json", json.dumps(entry) + "\n"):
            return entry
    raise RuntimeError(f"no free version of {name} after {ATTEMPTS} attempts")


def _put(spark: SparkSession, registry: str, name: str, text: str) -> bool:
    """Write a file elsewhere, then rename it; false if the name is taken."""
    jvm, draft, fs = _files(spark, f"{registry}/drafts/{uuid.uuid4().hex}")
    final = jvm.org.apache.hadoop.fs.Path(f"{registry}/entries/{name}")
    stream = fs.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.mkdirs(final.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    careful = spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    careful[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), careful)
        return True
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
            return False
        raise


def fit_once(
    spark: SparkSession, registry: str, name: str, trained_on: str, fit: Callable[[], PipelineModel], params: Mapping[str, object] | None = None
) -> tuple[PipelineModel, dict]:
    """The newest model of this name for this data, fitted and published only if there is none."""
    entry = newest(spark, registry, name, trained_on)
    if entry is None:
        entry = publish(spark, registry, name, fit(), trained_on, params)
    return PipelineModel.load(entry["path"]), entry


def runs_logged(spark: SparkSession, path: str) -> set[str]:
    """Registry runs that a run log holds already; one short name for each publication."""
    _, folder, fs = _files(spark, path)
    if not fs.exists(folder):
        return set()
    return {r[0] for r in read_log(spark, path).select(F.try_element_at("params", F.lit("run"))).distinct().collect()}


def fingerprint(spark: SparkSession, path: str, *more: object) -> str:
    """A name for the content of a folder of tables: files with sizes and times, and whatever else a fit depends on."""
    _, folder, fs = _files(spark, path)
    files, found = fs.listFiles(folder, True), []
    while files.hasNext():
        one = files.next()
        found.append((one.getPath().toString(), one.getLen(), one.getModificationTime()))
    return hashlib.sha256(json.dumps([sorted(found), [str(m) for m in more]]).encode()).hexdigest()[:32]
