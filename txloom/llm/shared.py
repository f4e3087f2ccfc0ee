"""What the corpus operators share: stored steps, column choice, word hashing."""

from __future__ import annotations

import gc
import io
import os
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path
from uuid import uuid4

import numpy as np
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words everywhere in this package: runs of bytes other than space and \t \n \v \f \r.
#: bytes.split() cuts at exactly these, bytes.lower() lower-cases exactly A-Z.
MEMO_ENTRIES = 100_000


def _ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which may stand on machines that do not have it."""
    package = Path(__file__).resolve().parents[1]
    name = f"{shared_folder(spark)}/{package.name}.zip"
    if name in _shipped:
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    store, path = fs.FileSystem.from_uri(name)
    store.create_dir(os.path.dirname(path), recursive=True)
    with store.open_output_stream(path) as out:
        out.write(data.getvalue())
    spark.sparkContext.addPyFile(name)
    _shipped.add(name)


_shipped: set[str] = set()


def session(spark: SparkSession) -> SparkSession:
    """Long texts make heavy rows: few of them go to Python at once."""
    _ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: spark.checkpoint.dir, or the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/txloom-llm/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str, bucketed: tuple[int, str] | None = None) -> DataFrame:
    """`df` written to a table of its own in the shared folder and read back: lineage ends here.

    `bucketed` (buckets, column): later groupings by the column need no shuffle of this table.
    """
    spark = df.sparkSession
    unique = uuid4().hex
    path = f"{shared_folder(spark)}/{name}-{unique}"
    writer = df.write.option("compression", "zstd")
    if bucketed:
        named = f"llm_{name.replace('-', '_')}_{unique}"
        writer.bucketBy(*bucketed).option("path", path).saveAsTable(named)
        out = spark.table(named)
        out._llm_table = named
    else:
        writer.parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
    out._llm_folder = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more. Shuffle files of their steps go as the driver collects garbage."""
    for table_ in tables:
        spark = table_.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(table_._llm_folder)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        if hasattr(table_, "_llm_table"):
            spark.sql(f"DROP TABLE IF EXISTS {table_._llm_table}")
    gc.collect()
    if tables:
        tables[0].sparkSession._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The two columns an operator works on, whatever else the table holds; a null text is empty."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ODD = np.uint64(0x9E3779B97F4A7C15)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of `width` words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, width):
        out = out * _ODD + hashes[k : k + n]
    return mix64(out)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def rows(batches: Iterable, *columns: str) -> Iterator[tuple]:
    """Rows of Arrow batches, as Python values."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
