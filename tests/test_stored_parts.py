from __future__ import annotations

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from txloom.sources.staging import staged

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_stored_by_a_column_meet_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(100).select(F.col("id").cast("string").alias("hash"), (F.col("id") % 7).alias("n"))
        one, two = (staged(spark, f"by-hash-{n}", lambda: rows, by="hash") for n in (1, 2))
        again = staged(spark, "by-hash-1", lambda: 1 / 0, by="hash")
        met = one.join(two.withColumnRenamed("n", "m"), "hash").groupBy("hash", "m").agg(F.sum("n").alias("n"))
        assert "Exchange" not in plan_of(met)
        assert met.count() == 100 and sorted(map(tuple, again.collect())) == sorted(map(tuple, rows.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_direct_exposure_shuffles_no_pairs(spark):
    """Only spent and following transactions are found by a shuffle on the hash; steps within one need none."""
    plan = plan_of(entry.queries()["taint_all"](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning\(hash", plan)) <= 3
    assert plan.count("Exchange hashpartitioning") <= 14
