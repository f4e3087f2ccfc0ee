"""Job boundaries: a DataFrame written to a Parquet table and read back.

A staged table cuts lineage, survives lost executors and gives later plans real sizes, column
pruning and filter pushdown.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

_staged: dict[tuple[str, str], tuple[str, object]] = {}


def staging_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it."""
    root = spark.conf.get(SETTING, None)
    if not root:
        raise ValueError(f"{SETTING} is not set: name a folder that driver and executors share")
    return f"{root.rstrip('/')}/txloom/{spark.sparkContext.applicationId}"


def _complete(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def files_key(spark: SparkSession, folder: str) -> str:
    """A short name of a folder and its files with their sizes and times: changed inputs have another."""
    path = spark._jvm.org.apache.hadoop.fs.Path(str(folder))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in fs.listStatus(path)] if fs.exists(path) else []
    return f"{zlib.crc32(chr(10).join([str(folder), *sorted(found)]).encode()):08x}"


def staged(
    spark: SparkSession, name: str, build: Callable[[], DataFrame], by: str | None = None, dealt: bool = False
) -> DataFrame:
    """The table `name` of this application, built and written the first time it is asked for.

    With `by` its rows lie in buckets by this column, as many as a shuffle has partitions, so groupings and joins on
    the column read them without a shuffle; a bucket is one file in the order of the column, so they do not sort them
    either. `dealt` tells that they come as `repartition(<that many>, by)` leaves them, and leaves out the order.
    """
    key = (spark.sparkContext.applicationId, name)
    table = f"staged_{name}".replace("-", "_")
    if key not in _staged or not _complete(spark, _staged[key][0]):
        df = build()
        path = f"{staging_root(spark)}/{name}"
        if by is None:
            df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd").parquet(path)
        else:
            n = int(spark.conf.get("spark.sql.shuffle.partitions"))
            writer = (df if dealt else df.repartition(n, by)).write.mode("overwrite").option("compression", "zstd").bucketBy(n, by)
            writer = writer if dealt else writer.sortBy(by)
            writer.option("path", path).format("parquet").saveAsTable(table)
        _staged[key] = (path, df.schema)
    if by is not None:
        return spark.table(table)
    path, schema = _staged[key]
    return spark.read.schema(schema).parquet(path)
