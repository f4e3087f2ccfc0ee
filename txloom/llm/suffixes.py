"""Repeated passages by a sparse suffix array.

Of all suffixes (one at each word) only those stay that begin at a minimiser: the smallest hash of CORE words
among the beginnings of any MIN_WORDS words. Equal passages of MIN_WORDS words hold a suffix at the same place,
at most REACH = MIN_WORDS - CORE words after their start. Suffixes with equal cores come together in order of
their cores' hashes, and each is compared with the first of its run (by document id and place):

* the REACH words before and after the core are the same: all passages around it that hold the suffix
  repeat those of the first; the match extends left and right over these words
* they differ somewhere: the passages of MIN_WORDS words that hold the suffix are looked up one by one,
  by hash, among those of the first and of the other suffixes of the run that differ

So the passages found are exactly those of MIN_WORDS words that occur before, in a document with a smaller id
or earlier in the same one. Overlapping ones are joined to spans. The first occurrence is no repeat.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txloom.llm.shared import WordHashes, dropped, mix64, signed, stored, texts

#: Words of the shortest passage that counts, and of the core of a suffix.
MIN_WORDS = 50
CORE = 20
#: Bits of the filters that tell which suffixes are looked at passage by passage, at most.
FILTER_BITS = 1 << 25

_BASE = 0x9E3779B97F4A7C15
ANCHORS = "core long, doc_id long, digest long, at long, left long, right long, before int, after int"
#: Spark's seed of xxhash64.
_SEED = 42


class _Windows:
    """Hashes of all runs of a given width, made from runs of powers of two."""

    def __init__(self, hashes: np.ndarray):
        self.powers = {1: hashes}

    def _power(self, width: int) -> np.ndarray:
        if width not in self.powers:
            half = self._power(width // 2)
            m = max(0, len(half) - width // 2)
            self.powers[width] = half[:m] * np.uint64(pow(_BASE, width // 2, 2**64)) + half[width // 2 : width // 2 + m]
        return self.powers[width]

    def of(self, width: int) -> np.ndarray:
        n = max(0, len(self.powers[1]) - width + 1)
        out, at = np.zeros(n, np.uint64), 0
        for bit in reversed(range(width.bit_length())):
            if width >> bit & 1:
                out = out * np.uint64(pow(_BASE, 1 << bit, 2**64)) + self._power(1 << bit)[at : at + n]
                at += 1 << bit
        return mix64(out)


def text_digest(text: str) -> int:
    """The name of a text beside its id: xxHash64, as Spark's function has it."""
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode(), _SEED)).view(np.int64))


def minimisers(core: np.ndarray, width: int) -> np.ndarray:
    """Places of the smallest hash (the leftmost of equal ones) of every `width` neighbouring ones."""
    if len(core) < width:
        return np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(core, width)
    return np.unique(view.argmin(1) + np.arange(len(view)))


def _suffixes(text: str, hashes: WordHashes, min_words: int, core_words: int) -> dict | None:
    """The retained suffixes of a text: place, core, and what stands within reach left and right of the core."""
    words = text.encode().split()
    n, reach = len(words), min_words - core_words
    if n < min_words:
        return None
    windows = _Windows(hashes.of(words))
    core, side = windows.of(core_words), windows.of(reach)
    at = minimisers(core, reach + 1)
    before, after = np.minimum(at, reach), np.minimum(n - core_words - at, reach)
    # a side cut off by the start or end of the text is hashed with what there is
    left, right = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
    whole = before == reach
    left[whole] = side[at[whole] - reach]
    for k in np.flatnonzero(~whole):
        left[k] = windows.of(int(before[k]))[0] ^ np.uint64(before[k] + 1) if before[k] else np.uint64(1)
    whole = after == reach
    right[whole] = side[at[whole] + core_words]
    for k in np.flatnonzero(~whole):
        right[k] = windows.of(int(after[k]))[-1] ^ np.uint64(after[k] + 1) if after[k] else np.uint64(1)
    return {"at": at, "core": core[at], "left": left, "right": right, "before": before, "after": after, "windows": windows}


def _bits(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = (hashes & np.uint64(FILTER_BITS - 1)).astype(np.int64)
    return (table[place >> 6] >> (place & 63) & 1).astype(bool)


def _filter(hashes: DataFrame) -> np.ndarray:
    """A bit for each low end of the column h."""
    words = hashes.groupBy(F.expr(f"shiftright(h & {FILTER_BITS - 1}, 6)").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(h & 63 AS int)))").alias("bits"))
    found = words.toArrow()  # at most FILTER_BITS / 64 rows
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy()
    return out


def _signature(core: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return core ^ left ^ (right << np.uint64(1))


def _signature_of(core: str, left: str, right: str) -> Column:
    return F.col(core).bitwiseXOR(F.col(left)).bitwiseXOR(F.shiftleft(right, 1))


def _place_hash(doc_id: int | None, digest: int, at: np.ndarray) -> np.ndarray:
    """Of a word of a text (0: of the text). The digest's bits are even already."""
    return (np.int64(digest ^ (doc_id or 0)) ^ at.astype(np.int64)).view(np.uint64)


def _place_hash_of(doc_id: str, digest: str, at: Column | None = None) -> Column:
    document = F.col(digest).bitwiseXOR(F.coalesce(F.col(doc_id), F.lit(0)))
    return document if at is None else document.bitwiseXOR(at.cast("long"))


def repeated_spans(
    docs: DataFrame, min_words: int = MIN_WORDS, core_words: int = CORE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, digest (xxHash64 of the text), start_word, end_word (after the last), first_doc_id: a row a span.

    Words are runs of bytes other than space, \\t \\n \\v \\f \\r. Null, empty and short texts have no spans. Rows
    with the same id and text are one document: they repeat others but not each other. A null id is smaller
    than all others. An empty table gives an empty one.
    """
    spans, steps = _spans(docs, min_words, core_words, id_column, text_column)
    dropped(*steps)
    return spans


def _spans(docs: DataFrame, min_words: int, core_words: int, id_column: str, text_column: str) -> tuple[DataFrame, list[DataFrame]]:
    """The spans, stored, and the stored tables they were made from."""
    spark = docs.sparkSession
    narrow = texts(docs, id_column, text_column)

    def anchors(batches: Iterable) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            out: list[list[np.ndarray]] = []
            owners: list[pa.Array] = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text").to_pylist(), strict=True):
                s = _suffixes(text, hashes, min_words, core_words)
                if s is not None:
                    out.append([signed(s["core"]), np.full(len(s["at"]), text_digest(text), np.int64), s["at"], signed(s["left"]), signed(s["right"]), s["before"].astype(np.int32), s["after"].astype(np.int32)])
                    owners.append(pa.repeat(doc_id, len(s["at"])))
            if out:
                core, digest, at, left, right, before, after = (pa.array(np.concatenate(c)) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([core, pa.concat_arrays(owners), digest, at, left, right, before, after], [x.split()[0] for x in ANCHORS.split(", ")])

    suffixes = stored(narrow.mapInArrow(anchors, ANCHORS), "suffixes")
    place = F.struct("doc_id", "digest", "at")
    runs = suffixes.groupBy("core").agg(F.min(F.struct("doc_id", "digest", "at", "left", "right")).alias("first"), F.max(place).alias("last"))
    runs = runs.where(~F.struct("first.doc_id", "first.digest", "first.at").eqNullSafe(F.struct("last.doc_id", "last.digest", "last.at"))).drop("last")
    same = lambda *names: _all(F.col(n).eqNullSafe(F.col(f"first.{n}")) for n in names)
    matched = stored(
        suffixes.join(runs, "core").select(
            "core", "doc_id", "digest", "at", "left", "right", "before", "after",
            F.col("first.doc_id").alias("first_doc_id"), F.col("first.digest").alias("first_digest"), F.col("first.at").alias("first_at"),
            same("doc_id", "digest", "at").alias("is_first"), same("left", "right").alias("extends"),
        ),
        "suffix-runs",
    )

    extended = matched.where("extends AND NOT is_first").select(
        "doc_id", "digest", (F.col("at") - F.col("before")).alias("start"), (F.col("at") + core_words + F.col("after")).alias("end"), "first_doc_id"
    ).where(F.col("end") - F.col("start") >= min_words)

    # suffixes that differ from the first of their run, and these first ones, by passages
    differing = matched.where("NOT extends")
    documents = differing.select(_place_hash_of("doc_id", "digest").alias("h")).union(differing.select(_place_hash_of("first_doc_id", "first_digest")))
    signatures = differing.select(_signature_of("core", "left", "right").alias("h"))
    firsts = differing.select(_place_hash_of("first_doc_id", "first_digest", F.col("first_at")).alias("h"))
    tables = spark.sparkContext.broadcast((_filter(documents), _filter(signatures), _filter(firsts)))  # at most FILTER_BITS bits each

    def passages(batches: Iterable) -> Iterator[pa.RecordBatch]:
        hashes, (by_document, by_signature, by_place) = WordHashes(), tables.value
        back = np.arange(min_words - core_words + 1)
        for batch in batches:
            found, digests, places, owners = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text").to_pylist(), strict=True):
                digest = text_digest(text)
                if not _bits(by_document, _place_hash(doc_id.as_py(), digest, np.zeros(1, np.int64)))[0]:
                    continue  # none of its suffixes differs from the first of its run, nor is such a first
                s = _suffixes(text, hashes, min_words, core_words)
                if s is None:
                    continue
                wanted = _bits(by_signature, _signature(s["core"], s["left"], s["right"])) | _bits(by_place, _place_hash(doc_id.as_py(), digest, s["at"]))
                starts = np.unique(s["at"][wanted][:, None] - back[None, :])
                if not len(starts):
                    continue
                every = s["windows"].of(min_words)
                starts = starts[(starts >= 0) & (starts < len(every))]
                if len(starts):
                    found.append(signed(every[starts]))
                    digests.append(np.full(len(starts), digest, np.int64))
                    places.append(starts.astype(np.int64))
                    owners.append(pa.repeat(doc_id, len(starts)))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found)), pa.concat_arrays(owners), pa.array(np.concatenate(digests)), pa.array(np.concatenate(places))],
                    ["passage", "doc_id", "digest", "at"],
                )

    single = stored(narrow.mapInArrow(passages, "passage long, doc_id long, digest long, at long"), "passages")
    first = single.groupBy("passage").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(~F.col("first").eqNullSafe(F.col("last")))
    looked_up = (
        single.join(first.select("passage", "first"), "passage")
        .where(~same("doc_id", "digest", "at"))
        .select("doc_id", "digest", F.col("at").alias("start"), (F.col("at") + min_words).alias("end"), F.col("first.doc_id").alias("first_doc_id"))
    )
    return stored(_joined(extended.unionByName(looked_up)), "spans"), [suffixes, matched, single]


def _all(conditions: Iterable[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _joined(parts: DataFrame) -> DataFrame:
    """Overlapping or touching spans of a text joined."""
    plain = parts.select("doc_id", "digest", "start", "end", "first_doc_id").distinct()
    own = Window.partitionBy("doc_id", "digest").orderBy("start", "end", "first_doc_id")
    apart = F.coalesce((F.col("start") > F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(0))
    numbered = plain.withColumn("apart", apart).withColumn("span", F.sum("apart").over(own))
    return numbered.groupBy("doc_id", "digest", "span").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word"), F.min("first_doc_id").alias("first_doc_id")).drop("span")


_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans; the white space before a word goes with it."""
    data = text.encode()
    ends = [m.end() for m in _WORD.finditer(data)]
    out, kept = [], 0
    for start, end in sorted(spans):
        out.append(data[kept : ends[start - 1] if start else 0])
        kept = ends[end - 1]
    return b"".join([*out, data[kept:]]).decode()


def without_repeats(docs: DataFrame, spans: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with the words of `spans` (as repeated_spans gives them) cut out of their texts.

    All rows and columns stay, whatever their names; rows without spans, with null texts among them, are as before.
    """
    lists = spans.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start_word", "end_word")).alias("spans"))  # of one text
    # structs are equal where both have a null
    lists = lists.select(F.struct("doc_id", "digest").alias("_llm_key"), F.col("spans").alias("_llm_spans"))

    @F.udf("string", useArrow=True)
    def shortened(text: str | None, found: list | None) -> str | None:
        return text if not found else cut(text, [(x["start_word"], x["end_word"]) for x in found])

    key = F.struct(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("digest"))
    joined = docs.withColumn("_llm_key", key).join(lists, "_llm_key", "left")
    return joined.withColumn(text_column, shortened(F.col(text_column), F.col("_llm_spans"))).select(*[F.col(f"`{c}`") for c in docs.columns])
