"""A part that is stored by transaction stays where it lies when it is joined on the transaction and more."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from txloom.sources.staging import staged


def test_stored_side_is_not_shuffled_for_a_join_on_more_columns(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(200).select((F.col("id") % 50).cast("string").alias("hash"), (F.col("id") % 4).alias("index"), "id")
        stored = staged(spark, "test-stored-side", lambda: rows, by="hash")
        met = stored.join(rows.select("hash", "index", F.col("id").alias("other")), ["hash", "index"])
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning\(hash#\d+, \d+\)", plan)) == 1 == plan.count("Exchange")
        assert met.count() == sum(c * c for c in [r["count"] for r in rows.groupBy("hash", "index").count().collect()])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
