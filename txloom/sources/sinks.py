"""Writing results: append, full reload, partition reload, versioned snapshots, append-only runs, tables changed by bucket."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def reload(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def reload_partitions(
    df: DataFrame, path: str, partition_by: str, spread: Sequence[str] = (), values: Sequence[object] | None = None
) -> None:
    """Replace whole partitions, so a repeated run leaves the same table.

    `values` are the partitions the run answers for: each is replaced, also by nothing, and rows of any other
    partition are an error. Without them those that `df` has rows for are replaced. A coarse partition (a month of
    old value flow) must be rebuilt whole. Adaptive execution splits and merges the partitions to files of even size.

    The new rows are written beside the table, where readers do not look, and then take the place of the old ones by
    renames: until then the table is as before, and `df` may read it. A run that dies while it renames leaves the old
    partition set aside; the next reload of that partition puts it back first, and so does `recover_partitions`.
    """
    spark = df.sparkSession
    beside = f"{path}/_new-{uuid4().hex}"
    df.hint("rebalance", partition_by, *spread).write.partitionBy(partition_by).parquet(beside)
    made = {n for n in _children(spark, beside) if n.startswith(f"{partition_by}=")}
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    wanted = made if values is None else {named(partition_by, None if v is None else str(v)) for v in values}
    if made - wanted:
        _delete(spark, beside)
        raise ValueError(f"rows outside the partitions of this run: {', '.join(sorted(made - wanted)[:5])}")
    recover_partitions(spark, path, wanted)
    _replace(spark, path, beside, made, wanted)


def _replace(spark: SparkSession, path: str, beside: str, made: set[str], wanted: set[str]) -> None:
    aside = f"{path}/_old-{uuid4().hex}"
    for name in sorted(wanted):
        if _exists(spark, f"{path}/{name}"):
            _move(spark, f"{path}/{name}", f"{aside}/{name}")
        if name in made:
            _move(spark, f"{beside}/{name}", f"{path}/{name}")
    _delete(spark, aside)
    _delete(spark, beside)


def recover_partitions(spark: SparkSession, path: str, names: set[str] | None = None) -> None:
    """Put back the partitions (all, or those with these folder names) that a lost reload had set aside and not replaced."""
    if not _exists(spark, path):
        return
    for aside in [n for n in _children(spark, path) if n.startswith("_old-")]:
        for name in _children(spark, f"{path}/{aside}"):
            if (names is None or name in names) and not _exists(spark, f"{path}/{name}"):
                _move(spark, f"{path}/{aside}/{name}", f"{path}/{name}")


# --- folders, through Hadoop's file systems ---------------------------------------------------------


def _folder(spark: SparkSession, path: str) -> tuple:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder))


def _delete(spark: SparkSession, path: str) -> None:
    fs, folder = _folder(spark, path)
    fs.delete(folder, True)


def _make(spark: SparkSession, path: str) -> None:
    fs, folder = _folder(spark, path)
    fs.mkdirs(folder)


def _mark(spark: SparkSession, path: str) -> None:
    fs, file = _folder(spark, path)
    fs.create(file, True).close()


def _move(spark: SparkSession, old: str, new: str) -> None:
    fs, source = _folder(spark, old)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"could not rename {old} to {new}")


def write_bucketed(df: DataFrame, path: str, cluster_by: Sequence[str], bucket: str = "pt", files: int | None = None) -> None:
    """Write a table laid out by bucket and then by its cluster columns.

    Row groups are sorted, so a read of one bucket or address skips the rest by min/max. With `files` rows are dealt by
    ranges of (bucket, cluster columns): a heavy bucket lies in several files, at the price of a run over the last stage
    of `df` that samples the ranges. Without it they are dealt by bucket, and adaptive execution splits what is larger
    than a partition should be and merges what is smaller.
    """
    keys = [bucket, *cluster_by]
    laid_out = df.repartitionByRange(files, *keys) if files else df.hint("rebalance", bucket)
    laid_out.sortWithinPartitions(*keys).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


# --- snapshots: tables that their own job reads ----------------------------------------------------


def _versions(spark: SparkSession, root: str) -> list[str]:
    """Complete versions below `root`, oldest first."""
    return _complete(spark, root, "v=", "_SUCCESS")


def _complete(spark: SparkSession, root: str, prefix: str, marker: str) -> list[str]:
    """What follows `prefix` in the names of the folders below `root` that hold `marker`, sorted."""
    if not _exists(spark, root):
        return []
    found = [n for n in _children(spark, root) if n.startswith(prefix)]
    return sorted(n.removeprefix(prefix) for n in found if _exists(spark, f"{root}/{n}/{marker}"))


def read_snapshot(spark: SparkSession, root: str, before: str | None = None) -> DataFrame | None:
    """Latest complete version, or the latest one before `before`. None if there is none."""
    versions = [v for v in _versions(spark, root) if before is None or v < before]
    return spark.read.parquet(f"{root}/v={versions[-1]}") if versions else None


def write_snapshot(df: DataFrame, root: str, version: str) -> None:
    """Write `df` as a new version. Readers see it once it is complete; older versions stay.

    A job may read its own table while writing the next version, which overwriting one path forbids.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/v={version}")


def update_snapshot(
    spark: SparkSession, root: str, version: str, job: Callable[[DataFrame | None], DataFrame]
) -> DataFrame:
    """Run `job` on the version before `version` and store its result as `version`.

    Repeating a run starts from the same earlier version and gives the same table.
    """
    write_snapshot(job(read_snapshot(spark, root, before=version)), root, version)
    return spark.read.parquet(f"{root}/v={version}")


# --- append-only runs: tables that grow by what a run finds new --------------------------------------


def read_runs(spark: SparkSession, root: str, before: str | None = None) -> DataFrame | None:
    """All rows of the complete runs (those before `before`). None if there are none."""
    folded = _complete(spark, root, "all=", "_SUCCESS")
    runs = [r for r in _complete(spark, root, "run=", "_SUCCESS") if not folded or r > folded[-1]]
    folders = [f"all={folded[-1]}"] if folded else []
    folders += [f"run={r}" for r in runs if before is None or r < before]
    return spark.read.parquet(*[f"{root}/{f}" for f in folders]) if folders else None


def append_run(spark: SparkSession, root: str, run: str, job: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
    """Run `job` on the rows of the runs before `run` and store its result, the new rows alone, as `run`.

    A run writes its own folder and nothing else, so its cost does not grow with the table, and repeating it gives the
    same table. A run that does not finish leaves a folder that no reader takes.
    """
    folded = _complete(spark, root, "all=", "_SUCCESS")
    if folded and run <= folded[-1]:
        raise ValueError(f"run {run} is folded into the table up to {folded[-1]}")
    fresh = job(read_runs(spark, root, before=run))
    _write_run(fresh, f"{root}/run={run}")
    return read_runs(spark, root)


def _write_run(df: DataFrame, path: str, **options: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**options).parquet(path)


def compact_runs(spark: SparkSession, root: str, upto: str) -> None:
    """Fold the runs up to `upto` into one folder of even files. Readers take the folder once it is complete and the
    single runs until then, so a compaction that dies changes nothing. Addresses get Parquet's Bloom filters there:
    looking one up reads the row groups that may hold it. (Small runs go without, the filters would outweigh them.)"""
    rows = read_runs(spark, root, before=upto + "\0")
    if rows is None:
        return
    bloom = {"parquet.bloom.filter.enabled#address": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    _write_run(rows.hint("rebalance"), f"{root}/all={upto}", **(bloom if "address" in rows.columns else {}))
    old = [f"run={r}" for r in _complete(spark, root, "run=", "_SUCCESS") if r <= upto]
    old += [f"all={r}" for r in _complete(spark, root, "all=", "_SUCCESS") if r < upto]
    for folder in old:
        _delete(spark, f"{root}/{folder}")


# --- tables changed by bucket: a run rewrites the buckets whose rows it changes ----------------------

_WHOLE = "_COMPLETE"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _bucket_folders(spark: SparkSession, root: str, before: str | None) -> dict[int, str]:
    """The newest folder of each bucket, of the versions before `before`."""
    out: dict[int, str] = {}
    for version in _complete(spark, root, "v=", _WHOLE):
        if before is None or version < before:
            for name in _children(spark, f"{root}/v={version}"):
                if name.startswith("b="):
                    out[int(name[2:])] = f"{root}/v={version}/{name}"
    return out


def read_buckets(
    spark: SparkSession, root: str, schema: str, before: str | None = None, only: Sequence[int] | None = None
) -> DataFrame:
    """The table as of the newest version (before `before`), or those of its buckets that are listed."""
    folders = _bucket_folders(spark, root, before)
    chosen = [f for b, f in sorted(folders.items()) if only is None or b in set(only)]
    return spark.read.schema(schema).parquet(*chosen) if chosen else spark.createDataFrame([], schema)


def write_buckets(df: DataFrame, root: str, version: str, key: str, buckets: int, touched: Sequence[int]) -> None:
    """Store the rows of the `touched` buckets as `version`; the others stay in the version that wrote them last.

    A touched bucket may be empty now. Readers see a version once all its buckets are there.
    """
    spark, path = df.sparkSession, f"{root}/v={version}"
    laid_out = df.withColumn("b", bucket_of(key, buckets)).hint("rebalance", "b").sortWithinPartitions("b", key)
    laid_out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("b").parquet(path)
    made = {n for n in _children(spark, path) if n.startswith("b=")}
    if extra := made - {f"b={b}" for b in touched}:
        _delete(spark, path)
        raise ValueError(f"rows outside the buckets of this run: {', '.join(sorted(extra)[:5])}")
    for b in touched:
        _make(spark, f"{path}/b={b}")
    _mark(spark, f"{path}/{_WHOLE}")


def touched_buckets(keys: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that hold the rows of `keys`: at most `buckets` numbers."""
    return sorted(r[0] for r in keys.select(bucket_of(key, buckets).alias("b")).distinct().collect())


def prune_buckets(spark: SparkSession, root: str, before: str) -> None:
    """Delete bucket folders that no version from `before` on reads; versions older than that can no longer be read."""
    needed = set(_bucket_folders(spark, root, before).values())
    for version in [v for v in _complete(spark, root, "v=", _WHOLE) if v < before]:
        for name in _children(spark, f"{root}/v={version}"):
            if name.startswith("b=") and f"{root}/v={version}/{name}" not in needed:
                _delete(spark, f"{root}/v={version}/{name}")
