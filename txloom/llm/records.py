"""Token-ID output: length-delimited binary records with a separate offset index.

A file is a run of frames: payload length (u64), masked CRC-32C of the length (u32), payload, masked
CRC-32C of the payload (u32), all little-endian. A payload is a flag byte (bit 0: the document has an
id), a byte with the width of a token id (2 or 4), the document id (i64), then the token ids.

Files are written by executors to the shared folder under new names at each attempt; only what the
index names belongs to the data set, so a lost executor or a repeated task leaves no double record.
The index (Parquet, a row a record) gives file, offset and length: any subset in any order can be read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txloom.llm.crc32c import crc32c, masked
from txloom.llm.shared import rows, stored, texts
from txloom.llm.tokens import encoder

HEADER = "<BBq"
HEADER_BYTES = struct.calcsize(HEADER)
FRAME_BYTES = 16
#: Bytes that are framed or checked together.
AT_ONCE = 4 << 20
INDEX = "part int, record long, doc_id long, file string, offset long, length long, n_tokens long, before long"


def _payload(doc_id: int | None, ids: bytes, width: int) -> bytes:
    body = ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    return struct.pack(HEADER, doc_id is not None, width, doc_id or 0) + body


def frames(payloads: list[bytes]) -> bytes:
    lengths = [struct.pack("<Q", len(x)) for x in payloads]
    sums = masked(crc32c(lengths + payloads)).astype("<u4")
    a, b = sums[: len(payloads)], sums[len(payloads) :]
    return b"".join(y for n, s, x, t in zip(lengths, a, payloads, b, strict=True) for y in (n, s.tobytes(), x, t.tobytes()))


def unframed(blobs: list[bytes]) -> list[bytes]:
    """The payloads of whole frames; raises where a length or checksum does not fit."""
    payloads = [x[12:-4] for x in blobs]
    sums = masked(crc32c([x[:8] for x in blobs] + payloads))
    for k, x in enumerate(blobs):
        if (
            struct.unpack_from("<Q", x)[0] != len(payloads[k])
            or struct.unpack_from("<I", x, 8)[0] != sums[k]
            or struct.unpack_from("<I", x, len(x) - 4)[0] != sums[len(blobs) + k]
        ):
            raise ValueError(f"a record of {len(x)} bytes is damaged")
    return payloads


def write_records(
    docs: DataFrame, folder: str, tokenizer_json: str, end_id: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Encode each text, append `end_id`, write records in ascending id order; returns the stored index.

    Added tokens of the file that stand in a text get their ids. Null texts are empty and give a record with the end id alone. Null ids come first. Rows that share an
    id follow each other in an order fixed by their texts. No rows: no record, an empty index.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_json)  # a vocabulary file: its size is that of the tokenizer
    width = 2 if max(end_id, _largest_id(tokenizer_json)) < 1 << 16 else 4
    end = struct.pack("<I", end_id)

    def write(batches: Iterable) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(shared.value).pack_text, TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name = f"part-{part:06d}-{uuid4().hex}.rec"
        held: list[tuple[int | None, bytes, int]] = []
        done: list[tuple] = []
        at = before = size = n = 0

        with store.open_output_stream(f"{root}/{name}") as out:

            def flush() -> None:
                nonlocal at, before, size, n
                out.write(frames([p for _, p, _ in held]))
                for doc_id, payload, tokens in held:
                    done.append((part, n, doc_id, f"{folder}/{name}", at, len(payload), tokens, before))
                    at, before, n = at + len(payload) + FRAME_BYTES, before + tokens, n + 1
                held.clear()
                size = 0

            for doc_id, text in rows(batches, "doc_id", "text"):
                ids = encode(text) + end
                held.append((doc_id, _payload(doc_id, ids, width), len(ids) // 4))
                size += len(held[-1][1])
                if size >= AT_ONCE:
                    flush()
                    yield _index_batch(done)
                    done.clear()
            flush()
        if done:
            yield _index_batch(done)

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = texts(docs, id_column, text_column).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return stored(ordered.mapInArrow(write, INDEX), "record-index")


def _index_batch(done: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    names = [x.split()[0] for x in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)


def _largest_id(tokenizer_json: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_str(tokenizer_json).get_vocab_size(with_added_tokens=True) - 1


def read_records(index: DataFrame) -> DataFrame:
    """The records that rows of an index name, in the order of these rows: part, record, doc_id, ids (packed u32).

    Lengths and checksums are verified; a damaged record fails the task.
    """

    def read(batches: Iterable) -> Iterator[pa.RecordBatch]:
        stream, opened = None, ""
        for batch in batches:
            wanted = list(rows([batch], "part", "record", "file", "offset", "length"))
            at = 0
            while at < len(wanted):
                upto, size = at, 0
                while upto < len(wanted) and (size == 0 or size + wanted[upto][4] <= AT_ONCE):
                    size += wanted[upto][4]
                    upto += 1
                blobs = []
                for _, _, file, offset, length in wanted[at:upto]:
                    if file != opened:
                        store, path = fs.FileSystem.from_uri(file)
                        stream, opened = store.open_input_file(path), file
                    blobs.append(stream.read_at(length + FRAME_BYTES, offset))
                ids, names = [], []
                for payload in unframed(blobs):
                    has, width, doc_id = struct.unpack_from(HEADER, payload)
                    names.append(doc_id if has else None)
                    body = payload[HEADER_BYTES :]
                    ids.append(body if width == 4 else np.frombuffer(body, "<u2").astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[0] for x in wanted[at:upto]], pa.int32()),
                        pa.array([x[1] for x in wanted[at:upto]], pa.int64()),
                        pa.array(names, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["part", "record", "doc_id", "ids"],
                )
                at = upto

    return index.select("part", "record", "file", "offset", "length").mapInArrow(
        read, "part int, record long, doc_id long, ids binary"
    )


def starts(index: DataFrame) -> DataFrame:
    """part, first: how many ids all earlier files hold. One row a file, so the ordered sum stays small."""
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))


def checksum(ids: bytes) -> int:
    return zlib.crc32(ids)
