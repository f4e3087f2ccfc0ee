"""Shuffle files of ended jobs do not stay on disk."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from txloom.sources.staging import staged


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    counts = staged(spark, "counts-by-rest", lambda: spark.range(10_000).groupBy((F.col("id") % 7).alias("rest")).agg(F.count("*").alias("n")))
    until = time.monotonic() + 20  # files are removed beside the next job
    while (left := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left
    assert sum(r.n for r in counts.collect()) == 10_000


def test_rows_are_found_again_after_the_files_are_gone(spark):
    counts = spark.range(1_000).groupBy((F.col("id") % 7).alias("rest")).agg(F.count("*").alias("n"))
    assert [sum(r.n for r in counts.collect()) for _ in range(2)] == [1_000, 1_000]
    kept = counts.cache()
    assert [kept.count(), kept.agg(F.sum("n")).first()[0], counts.count()] == [7, 1_000, 7]
    kept.unpersist()
