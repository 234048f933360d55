"""Shared-folder staging and its release."""

import os

from pyspark.sql import functions as F

from mixtape.session import ensure_checkpoint_dir, scratch_path, scratch_scope, stage


def test_checkpoint_dir_and_scratch(spark):
    root = ensure_checkpoint_dir(spark)
    assert root and scratch_path(spark, "x").startswith(root.rstrip("/"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_stage_is_a_stored_table(spark):
    df = spark.range(1000).select((F.col("id") % 37).alias("k"), "id")
    staged = stage(df, "t-stage")
    assert sorted(staged.collect()) == sorted(df.collect())
    assert "FileScan parquet" in staged._jdf.queryExecution().executedPlan().toString()


def test_scope_releases_what_was_stored_inside(spark):
    def folder(df):
        return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    outside = stage(spark.range(3), "t-outside")
    with scratch_scope(spark):
        inside = stage(spark.range(3), "t-inside")
        where = folder(inside)
        assert inside.count() == 3
    assert not os.path.exists(where) and outside.count() == 3
