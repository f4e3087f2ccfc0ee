"""Packing: shortest-pack-first over the length histogram.

Lengths are placed from the longest down. Each goes into the least filled kind of pack that still has
room, and what is kept is not packs but patterns (which lengths, how many packs), so the work depends
on the number of distinct lengths and not on the number of documents. The patterns are then joined
back: the pieces of a length are ranked, and rank intervals belong to slots of patterns.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txloom.llm.shared import stored, texts
from txloom.llm.tokens import encoder

CAPACITY = 1024
#: Pieces of one length that are ranked together.
RANKED_TOGETHER = 20_000


def token_pieces(
    docs: DataFrame,
    tokenizer_json: str,
    end_id: int,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Each text's ids with `end_id` appended, cut into pieces of `capacity` and a rest.

    A row a piece: doc_id, start, length, doc_tokens, ids_crc32. Added tokens in a text get their ids. Null texts are empty and give a piece of one
    id; rows with a null or repeated id give pieces of their own.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # a vocabulary file

    def cut(batches: Iterable) -> Iterator[pa.RecordBatch]:
        encode, end, step = encoder(shared.value).pack_text, end_id.to_bytes(4, "little"), 4 * capacity
        for batch in batches:
            sizes, sums = [], []
            for text in batch.column("text").to_pylist():
                ids = encode(text) + end
                sizes.append(len(ids) // 4)
                sums.append([zlib.crc32(ids[at : at + step]) for at in range(0, len(ids), step)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sums, pa.list_(pa.int64()))],
                ["doc_id", "doc_tokens", "sums"],
            )

    whole = texts(docs, id_column, text_column).mapInArrow(cut, "doc_id long, doc_tokens long, sums array<long>")
    whole = stored(whole, "token-pieces")
    return whole.select("doc_id", "doc_tokens", F.posexplode("sums").alias("piece", "ids_crc32")).select(
        "doc_id",
        (F.col("piece").cast("long") * capacity).alias("start"),
        F.least(F.lit(capacity).cast("long"), F.col("doc_tokens") - F.col("piece").cast("long") * capacity).alias("length"),
        "doc_tokens",
        "ids_crc32",
    )


def patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Packs by pattern: lengths from the longest, and how many packs hold them."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in sorted(histogram, reverse=True):
        left, placed = histogram[length], []
        for space in sorted((s for s in room if s >= length), reverse=True):
            kinds = room[space]
            while left and kinds:
                held, packs = kinds.pop()
                # a pack takes as many of this length as fit, the last one maybe fewer
                each = min(space // length, left)
                used = min(packs, left // each)
                placed.append((space - each * length, held + (length,) * each, used))
                left -= used * each
                if packs > used:
                    kinds.append((held, packs - used))
            if not left:
                break
        if left:
            each = capacity // length
            if full := left // each:
                placed.append((capacity - each * length, (length,) * each, full))
            if rest := left - full * each:
                placed.append((capacity - rest * length, (length,) * rest, 1))
        for space, held, packs in placed:
            room.setdefault(space, []).append((held, packs))
    return [x for space in sorted(room) for x in room[space]]


def _slots(found: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Rank intervals: the pieces of `length` from `rank` on fill `each` slots a pack from `offset` on, in packs from `pack` on."""
    taken: dict[int, int] = {}
    out = []
    first = 0
    for held, packs in found:
        offset = 0
        for length in dict.fromkeys(held):
            each = held.count(length)
            out.append((length, taken.get(length, 0), each, offset, first))
            taken[length] = taken.get(length, 0) + each * packs
            offset += each * length
        first += packs
    out.sort()
    columns = np.array(out, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "each", "offset", "pack"), columns, strict=True))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (any columns, and length from 1 to `capacity`) with sequence_id and offset added.

    Sequences are numbered from 0 without gaps, pieces lie in them gapless from offset 0. Equal rows may
    trade places, which changes no row. An empty table gives an empty one.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    spark, columns = pieces.sparkSession, pieces.columns
    slots = spark.sparkContext.broadcast(_slots(patterns(counts, capacity)))  # bounded by the number of lengths

    # ranks of a length: it is dealt into chunks of about RANKED_TOGETHER, each is ranked alone
    chunks = spark.createDataFrame([(n, c // RANKED_TOGETHER + 1) for n, c in counts.items()], "length long, _pack_chunks long")
    dealt = pieces.join(F.broadcast(chunks), "length").withColumn("_pack_chunk", F.pmod(F.xxhash64(*columns), "_pack_chunks"))
    sizes = dealt.groupBy("length", "_pack_chunk").agg(F.count("*").alias("_pack_n"))
    earlier = Window.partitionBy("length").orderBy("_pack_chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "_pack_chunk", F.coalesce(F.sum("_pack_n").over(earlier), F.lit(0)).alias("_pack_first"))
    own = Window.partitionBy("length", "_pack_chunk").orderBy(*columns)
    ranked = (
        dealt.withColumn("_pack_own", F.row_number().over(own))
        .join(firsts, ["length", "_pack_chunk"])
        .select(*columns, (F.col("_pack_first") + F.col("_pack_own") - 1).alias("_pack_rank"))
    )

    def place(batches: Iterable) -> Iterator[pa.RecordBatch]:
        s = slots.value
        by = s["length"] << 44 | s["rank"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "_pack_rank"))
            k = np.searchsorted(by, length << 44 | rank, side="right") - 1
            within = rank - s["rank"][k]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(s["pack"][k] + within // s["each"][k]), pa.array(s["offset"][k] + within % s["each"][k] * length)],
                [*columns, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequences, tokens, and the ids of padding when a sequence is filled up unless its size is a power of two."""
    sizes = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    power = F.expr("(n & (n - 1)) = 0")
    return sizes.agg(
        F.count("*").alias("sequences"), F.sum("n").alias("tokens"), F.sum(F.when(power, 0).otherwise(capacity - F.col("n"))).alias("padding")
    )


