"""Byte-level BPE as a join: each distinct word of the corpus is encoded once.

1. A task cuts its texts into pre-tokens and numbers the distinct ones of a block; a text becomes its
   sequence of numbers, that is, its words in order of position. The table of both is stored bucketed by
   block, so the sequences, the bulk of it, are never shuffled.
2. The words of all blocks meet by hash. The first of equal words is encoded, the rest take its ids. A
   word comes at most once a block, so no word is hot.
3. The ids go back to their blocks and take the places of the numbers.

Decoding looks ids up in the table of token bytes, whose size is that of the vocabulary.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from txloom.llm.shared import rows, stored, texts
from txloom.llm.tokens import pieces

#: Bytes of text in a block: what a task holds at once. One longer text is a block of its own.
BLOCK_BYTES = 16 << 20
MEMO_ENTRIES = 200_000
#: kind 0: a text and its numbers. kind 1: a block's words of one share of all hashes, numbered from `first` on.
BLOCKS = "block long, kind int, doc_id long, share int, first int, packed binary"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class _Block:
    """Texts of a block as numbers of their distinct words."""

    def __init__(self, pattern: str, memo: dict[str, list[str]]):
        self.find, self.memo = regex.compile(pattern).findall, memo
        self.number: dict[str, int] = {}
        self.packed: dict[str, bytes] = {"": b""}

    def numbers(self, text: str) -> bytes:
        cut = pieces(text)
        out = list(map(self.packed.get, cut))
        if None in out:
            number, memo = self.number, self.memo
            for k, known in enumerate(out):
                if known is None:
                    piece = cut[k]
                    if piece not in self.packed:
                        if piece not in memo:
                            if len(memo) >= MEMO_ENTRIES:
                                memo.clear()
                            memo[piece] = self.find(piece)
                        self.packed[piece] = array("I", [number.setdefault(w, len(number)) for w in memo[piece]]).tobytes()
                    out[k] = self.packed[piece]
        return b"".join(out)

    def dealt(self, shares: int) -> tuple[np.ndarray, list[tuple[int, int, list[bytes]]]]:
        """New numbers by old, so that words of one share are together; share, first number and words of each."""
        words = [w.encode() for w in self.number]
        share = np.fromiter((xxhash.xxh32_intdigest(w) % shares for w in words), np.int64, len(words))
        order = np.argsort(share, kind="stable")
        new = np.empty(len(words), np.uint32)
        new[order] = np.arange(len(words), dtype=np.uint32)
        cuts = np.flatnonzero(np.diff(share[order], prepend=-1, append=-1))
        return new, [(int(share[order[a]]), int(a), [words[k] for k in order[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def packed(parts: list[bytes]) -> bytes:
    """Byte strings in one compressed string: their number, their sizes, themselves."""
    sizes = np.array([len(parts), *map(len, parts)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(sizes + b"".join(parts))


def unpacked(data: bytes) -> tuple[np.ndarray, bytes]:
    """Sizes of the parts, and the parts end to end."""
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(data[:4], "little")
    return np.frombuffer(data, "<u4", n, 4).astype(np.int64), data[4 + 4 * n :]


def blocks(docs: DataFrame, pattern: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The texts as numbers and the words of the blocks, stored in a table bucketed by block."""
    spark = docs.sparkSession
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def number(batches: Iterable) -> Iterator[pa.RecordBatch]:
        block, press = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=3).compress
        memo: dict[str, list[str]] = {}
        state, held, size = _Block(pattern, memo), [], 0

        def whole() -> Iterator[pa.RecordBatch]:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            names = [x.split()[0] for x in BLOCKS.split(", ")]
            new, words = state.dealt(shares)
            out = [(block, 1, None, share, first, packed(w)) for share, first, w in words]
            out += [(block, 0, doc_id, None, None, press(new[np.frombuffer(x, "<u4")].tobytes())) for doc_id, x in held]
            for at in range(0, len(out), 512):
                columns = zip(*out[at : at + 512], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for doc_id, text in rows(batches, "doc_id", "text"):
            if size and size + len(text) > block_bytes:
                yield from whole()
                block, state, held, size = block + 1, _Block(pattern, memo), [], 0
            held.append((doc_id, state.numbers(text)))
            size += len(text) + 1
        yield from whole()

    return stored(docs.mapInArrow(number, BLOCKS), "bpe-blocks", bucketed=(shares, "block"))


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id and ids (packed little-endian u32) of each row's whole text.

    Null and empty texts have no ids; rows with a null or repeated id are encoded row by row; no rows give no
    rows. A task holds the words and texts of one block.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)  # the vocabulary
    wide = np.dtype("<u2" if max(ranks.values(), default=0) < 1 << 16 else "<u4")
    numbered = blocks(texts(docs, id_column, text_column), pattern, block_bytes)

    def encode_words(batches: Iterable) -> Iterator[pa.RecordBatch]:
        import tiktoken

        piece = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})._core_bpe.encode_single_piece
        known: dict[bytes, bytes] = {}  # the distinct words of this partition
        for batch in batches:
            out = []
            for data in batch.column("packed").to_pylist():
                sizes, words = unpacked(data)
                ends = np.cumsum(sizes).tolist()
                found = []
                for a, b in zip([0, *ends[:-1]], ends, strict=True):
                    word = words[a:b]
                    ids = known.get(word)
                    if ids is None:
                        one = shared.value.get(word)
                        ids = known[word] = np.array([one] if one is not None else piece(word), wide).tobytes()
                    found.append(ids)
                out.append(packed(found))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("first"), pa.array(out, pa.binary())], ["block", "first", "packed"])

    words = numbered.where("kind = 1").select("block", "share", "first", "packed")
    encoded = words.repartition("share").mapInArrow(encode_words, "block long, first int, packed binary")

    def assemble(texts_: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found.column("first").to_numpy())
        parts = [unpacked(found.column("packed")[int(k)].as_py()) for k in order]
        sizes = np.concatenate([np.empty(0, np.int64), *(s for s, _ in parts)]) // wide.itemsize
        data = np.frombuffer(b"".join(x for _, x in parts), wide).astype("<u4")
        firsts = np.cumsum(sizes) - sizes
        unpress = zstandard.ZstdDecompressor().decompress
        out = []
        for pressed in texts_.column("packed").to_pylist():
            at = np.frombuffer(unpress(pressed), "<u4")
            n = sizes[at]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            out.append(data[np.repeat(firsts[at] - (ends - n), n) + np.arange(total)].tobytes())
        return pa.table({"doc_id": texts_.column("doc_id"), "ids": pa.array(out, pa.binary())})

    bodies = numbered.where("kind = 0").select("block", "doc_id", "packed")
    return bodies.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(assemble, "doc_id long, ids binary")


def token_bytes(ranks: dict[bytes, int]) -> tuple[bytes, np.ndarray]:
    """The bytes of all tokens by id, end to end, and where each starts; ids that the ranks lack are empty."""
    by_id = {n: token for token, n in ranks.items()}
    parts = [by_id.get(n, b"") for n in range(max(by_id, default=-1) + 1)]
    return b"".join(parts), np.cumsum([0, *map(len, parts)])


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id, ids and the bytes that the ids stand for. Null ids give null bytes, no ids none.

    An id outside the vocabulary fails the task.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(token_bytes(ranks))  # the vocabulary

    def join_bytes(batches: Iterable) -> Iterator[pa.RecordBatch]:
        data, starts = shared.value
        table = [data[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
        for batch in batches:
            out = [None if x is None else b"".join(map(table.__getitem__, array("I", x))) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(out, pa.binary())], ["doc_id", "ids", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(join_bytes, "doc_id long, ids binary, bytes binary")
