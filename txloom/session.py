"""Session settings the operators count on. All can be set on a running session."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # days are UTC days
    "spark.sql.session.timeZone": "UTC",
    # joins are re-planned by measured sizes, skewed keys are split even if that costs a shuffle
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a side that lies by some of the columns of a join stays where it is, the other side comes to it
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # rows that are sorted by their group are grouped as they are read, not gathered and sorted again
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # a bucket that is one file is read in the order it was written in
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # jobs hand over through stored tables, so shuffle files go when the job that made them ends
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # a day's reload replaces its own partitions only
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark
