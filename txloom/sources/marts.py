"""Marts: catalog tables bucketed by address, so that joins and groupings on the address need no shuffle.

All marts of a chain take the same number of buckets. Bucket k of each holds the addresses whose hash falls to k, so a
join of two marts reads bucket k of both in one task. A heavy bucket is cut by a salt into several files, written by
several tasks; the files keep the bucket's number, so readers still know where every address lies. Files are sorted by
the published bucket number and the cluster columns, and row groups that a filter excludes are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
#: A bucket with more rows than this many times the mean is cut into files of about the mean.
HEAVY = 2


def bucket_of(address: str, buckets: int) -> Column:
    """The bucket Spark's writer gives an address."""
    return F.pmod(F.hash(address), F.lit(buckets))


def _placed(df: DataFrame, address: str, salt_by: Sequence[str], buckets: int) -> DataFrame:
    """Rows dealt to one partition per bucket, or several for a heavy one. Counting reads the address alone."""
    number = bucket_of(address, buckets)
    sizes = {r[0]: r[1] for r in df.groupBy(number.alias("b")).count().collect()}  # a number per bucket
    mean = max(1, -(-sum(sizes.values()) // buckets))
    place, n = number, buckets
    for b, size in sorted(sizes.items()):
        if size > HEAVY * mean:
            more = -(-size // mean)
            piece = F.pmod(F.xxhash64(*salt_by), F.lit(more))
            place = F.when((number == b) & (piece > 0), piece + (n - 1)).otherwise(place)
            n += more - 1
    return df.repartitionById(n, place.cast("int"))


def write_mart(
    df: DataFrame,
    table: str,
    path: str,
    address: str = "address",
    cluster_by: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Store `df` as the catalog table `table` with its files in `path`, bucketed by `address`. Returns the table.

    `cluster_by` sorts the files; its columns also split a heavy bucket, so they should tell apart the rows of one
    address. A mart is derived and replaced as a whole.
    """
    order = [*dict.fromkeys([*(["pt"] if "pt" in df.columns else []), address, *cluster_by])]
    spread = [c for c in order if c != "pt"]
    placed = _placed(df, address, spread, buckets)
    writer = placed.write.mode("overwrite").bucketBy(buckets, address).sortBy(order[0], *order[1:])
    writer.option("path", path).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def open_mart(spark: SparkSession, table: str, path: str, schema: str, address: str = "address", buckets: int = BUCKETS) -> DataFrame:
    """A stored mart under `table`, in a session whose catalog does not know it."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet CLUSTERED BY ({address}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)
