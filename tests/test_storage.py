"""Staged tables and their end."""

import glob

import pytest

from roadpulse.sources import storage


def folders(spark):
    return set(glob.glob(storage.shared_dir(spark).removeprefix("file:") + "/*"))


def test_staged_tables_go_with_the_work_around_them(spark):
    spark.range(1).write.mode("overwrite").parquet(storage.new_path(spark, "makes-the-folder"))
    before, out = folders(spark), storage.new_path(spark, "result")
    with storage.scratch(spark):
        step = storage.stage(spark.range(10), "step")
        with storage.scratch(spark):
            assert storage.stage(spark.range(3), "inner").count() == 3
        assert step.count() == 10
        kept = storage.save(step.filter("id > 6"), out)
    assert kept.count() == 3
    assert {f.rsplit("/", 1)[1] for f in folders(spark) - before} == {out.rsplit("/", 1)[1]}
    with pytest.raises(ValueError), storage.scratch(spark):
        storage.stage(spark.range(2), "lost")
        raise ValueError
    assert {f.rsplit("/", 1)[1] for f in folders(spark) - before} == {out.rsplit("/", 1)[1]}
    assert storage.stage(spark.range(4), "outside").count() == 4


def test_partitioned_tables_keep_their_columns(spark):
    df = storage.stage(spark.range(4).selectExpr("id % 2 AS part", "id"), "parts", ["part"])
    assert sorted(map(tuple, df.select("part", "id").collect())) == [(0, 0), (0, 2), (1, 1), (1, 3)]
