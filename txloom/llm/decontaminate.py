"""Benchmark passages in documents, found by Wu-Manber multi-pattern search.

Patterns are runs of ten words of a benchmark text (the whole text if it has fewer), as bytes with a space before, between
and after the words; texts are searched in the same form, so a match begins and ends at words. Patterns fall into classes
by length. In a class, with m the shortest length, only the first m bytes of each pattern are looked at while skipping:
the shift table says for every block of bytes in them how far its last place is from their end. A text is read by the
block that ends at the current position: a block in no pattern skips the whole of m, a block that ends a prefix is the
suffix hash that selects a bucket, and the bucket's patterns are compared with the text byte by byte.

Patterns are made and dealt to parts of bounded size on the executors, each (pattern, item) pair to one part. A task reads
its documents once, tens of megabytes at a time, and runs all parts over them, one part in memory at a time: nothing grows
with the benchmark but time, and documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txloom.llm.alnum import as_bytes, blocks, words_of
from txloom.llm.shared import stored

WINDOW_WORDS = 10
#: (pattern, item) pairs of a part of the benchmark, about: what a task holds of it at a time.
PART_PATTERNS = 50_000
#: Bytes of text that a task runs one part over before it reads the next part.
BATCH_BYTES = 32 << 20
#: Parts that a worker keeps, so that a benchmark of few parts is read once.
KEPT_PARTS = 2
#: Bytes of a block of the shift table; shorter classes use less.
BLOCK = 8


# --- patterns -----------------------------------------------------------------------------------------------------------
def form(words: list[bytes]) -> bytes:
    """Words as searched and searched for."""
    return b" " + b" ".join(words) + b" " if words else b""


def windows_of(words: list[bytes], width: int) -> list[list[bytes]]:
    if not words:
        return []
    return [words[k : k + width] for k in range(max(1, len(words) - width + 1))]


def patterns(items: DataFrame, width: int = WINDOW_WORDS, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """pattern, item: each window of each item once. A null id stays null."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in blocks(batches, 1 << 20):
            found = {(form(w), i) for i, words in zip(ids, texts, strict=True) for w in windows_of(words, width)}
            yield pa.RecordBatch.from_pydict(
                {"pattern": pa.array([p for p, _ in found], pa.binary()), "item": pa.array([i for _, i in found], pa.string())}
            )

    source = as_bytes(items, id_column, text_column, "string")
    return source.mapInArrow(run, "pattern binary, item string").groupBy("pattern", "item").agg(F.lit(1).alias("_one")).drop("_one")


def parted(made: DataFrame, part_patterns: int = PART_PATTERNS) -> tuple[str, list[int]]:
    """Patterns written by part in the shared folder: the folder and its parts. A part is a bounded number of rows
    whatever the items hold, as the hash that deals them takes in the item."""
    made = stored(made, "benchmark-patterns")
    n = max(1, -(-made.count() // part_patterns))
    part = F.pmod(F.xxhash64("pattern", "item"), F.lit(n)).cast("int").alias("part")
    written = stored(made.select("pattern", "item", part).repartition(n, "part").sortWithinPartitions("part"), "benchmark-parts")
    return written._llm_folder, list(range(n))


# --- Wu-Manber ----------------------------------------------------------------------------------------------------------
class Class:
    """The patterns of one length class: shift table, and buckets by the last block of the first m bytes.

    A bucket keeps its patterns by length, so that a text is compared once a length however many patterns a bucket has.
    """

    def __init__(self, found: dict[bytes, list[str | None]]):
        self.m = m = min(map(len, found))
        self.block = block = min(m, max(2, min(BLOCK, m // 3)))
        self.most = m - block + 1
        shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[int, dict[bytes, list[str | None]]]] = {}
        heads = set()
        for pattern, items in found.items():
            head = pattern[:m]
            self.buckets.setdefault(head[m - block :], {}).setdefault(len(pattern), {})[pattern] = items
            heads.add(head)
        for head in heads:
            for end in range(block, m + 1):
                piece = head[end - block : end]
                if shift.get(piece, self.most) > m - end:
                    shift[piece] = m - end
        self.shift = shift

    def occurrences(self, text: bytes) -> Iterator[tuple[int, int, bytes, list[str | None]]]:
        """(start, end, pattern, items) of every place where a pattern stands."""
        m, block, most, shift_of, buckets, size = self.m, self.block, self.most, self.shift.get, self.buckets, len(text)
        at = m
        while at <= size:
            tail = text[at - block : at]
            step = shift_of(tail, most)
            if step:
                at += step
                continue
            start = at - m
            for length, same in buckets[tail].items():
                piece = text[start : start + length]
                if piece in same:
                    yield start, start + length, piece, same[piece]
            at += 1


def classes_of(found: dict[bytes, list[str | None]]) -> list[Class]:
    """Patterns by the power of two below their length: one short pattern does not shorten the skips of all."""
    by_size: dict[int, dict[bytes, list[str | None]]] = {}
    for pattern, items in found.items():
        by_size.setdefault(len(pattern).bit_length(), {})[pattern] = items
    return [Class(by_size[k]) for k in sorted(by_size)]


class Parts:
    """Parts of the benchmark as read from the shared folder; the last few stay."""

    def __init__(self, folder: str):
        store, path = fs.FileSystem.from_uri(folder)
        self.source = ds.dataset(path, filesystem=store, format="parquet")
        self.kept: dict[int, list[Class]] = {}

    def part(self, number: int) -> list[Class]:
        if number not in self.kept:
            if len(self.kept) >= KEPT_PARTS:
                self.kept.pop(next(iter(self.kept)))
            found: dict[bytes, list[str | None]] = {}
            for batch in self.source.to_batches(columns=["pattern", "item"], filter=ds.field("part") == number):
                for pattern, item in zip(batch.column("pattern").to_pylist(), batch.column("item").to_pylist(), strict=True):
                    found.setdefault(pattern, []).append(item)
            self.kept[number] = classes_of(found)
        return self.kept[number]


class Hits:
    """Words and items found in a document so far."""

    def __init__(self):
        self.spans: set[tuple[int, int]] = set()
        self.items: set[str] = set()

    def add(self, text: bytes, searched: Class, seen: dict[bytes, list[str | None]]) -> None:
        for start, end, pattern, items in searched.occurrences(text):
            self.spans.add((start, end))
            if pattern not in seen:
                seen[pattern] = items
                self.items.update(i for i in items if i is not None)

    def words(self, text: bytes) -> list[tuple[int, int]]:
        """Merged runs of hit words, [first, after)."""
        spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
        runs: list[tuple[int, int]] = []
        for start, end in sorted(self.spans):
            first, after = (int(x) for x in np.searchsorted(spaces, (start, end - 1)))
            if runs and first <= runs[-1][1]:
                runs[-1] = (runs[-1][0], max(after, runs[-1][1]))
            else:
                runs.append((first, after))
        return runs


def contamination(
    docs: DataFrame,
    items: DataFrame,
    width: int = WINDOW_WORDS,
    part_patterns: int = PART_PATTERNS,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, n_words, spans (array of hit word runs: first, after), items (ids as strings, sorted) of every row of `docs`.

    A null or empty text has no words and no hits; an item without words has no window. Each row is searched for
    itself: repeated rows give repeated results, a null id stays null. Items that share an id are one item, with the
    windows of all their texts; an item without an id marks words and is in no list. Empty tables give no rows, or
    no hits. Other columns are not read.
    """
    folder, numbers = parted(patterns(items, width, item_id, item_text), part_patterns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts(folder)
        for ids, texts in blocks(batches, BATCH_BYTES, lambda text: form(words_of(text))):
            hits = [Hits() for _ in ids]
            for number in numbers:
                for class_ in parts.part(number):
                    for text, hit in zip(texts, hits, strict=True):
                        hit.add(text, class_, {})
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids, pa.int64()),
                    "n_words": pa.array([max(0, text.count(b" ") - 1) for text in texts], pa.int64()),
                    "spans": pa.array(
                        [[{"first": a, "after": b} for a, b in hit.words(text)] if hit.spans else [] for text, hit in zip(texts, hits, strict=True)],
                        pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())])),
                    ),
                    "items": pa.array([sorted(hit.items) for hit in hits], pa.list_(pa.string())),
                }
            )

    schema = "doc_id long, n_words long, spans array<struct<first: long, after: long>>, items array<string>"
    return as_bytes(docs, id_column, text_column).mapInArrow(run, schema)


def without_hits(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id is in no row of `found` with a hit."""
    hit = found.where(F.size("spans") > 0).select(F.col("doc_id")).distinct()
    return docs.join(hit, "doc_id", "left_anti")


def duckdb_sql(width: int = 10) -> str:
    """The digest of `contamination` over the views `documents` and `benchmark`, as DuckDB SQL."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    cut = "SELECT {id}, unnest(range(1, greatest(len(w) - {n} + 1, {least}) + 1)) AS k, w, {n} AS n FROM {source}"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS item, {words} AS w FROM benchmark),
windows AS (SELECT DISTINCT item, least(len(w), {width}) AS n, array_to_string(w[k : k + least(len(w), {width}) - 1], ' ') AS p
    FROM ({cut.format(id="item", n=width, least=1, source="items")}) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT r, l.n, unnest(range(1, len(w) - l.n + 2)) AS k, w FROM docs, lengths l WHERE len(w) >= l.n),
found AS (SELECT r, k, x.n, item FROM (SELECT r, n, k, array_to_string(w[k : k + n - 1], ' ') AS p FROM places) x JOIN windows ON windows.n = x.n AND windows.p = x.p),
hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS place FROM found) GROUP BY r),
listed AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""
