"""Importance resampling towards a target distribution, on hashed one- and two-word features.

Features are hashed by CRC-32 into buckets. The totals of all buckets are counted exactly over the whole corpus
and over the target texts; the log ratio of a bucket's shares is its gain, a document's weight is the mean gain of
its features, and Gumbel noise keyed by the id turns weights into scores whose largest are a draw without replacement.

The vocabulary is split. Head: words and pairs that hold a fixed share of some block of texts, the most counted
first; every task has the CRC state of each such word and the bucket of each such pair. Tail: all other features;
the CRC of a word is computed from its bytes, that of a pair goes on from the state of its first word. The split
changes the work only: both give the same buckets.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txloom.llm.alnum import WORD, as_bytes, blocks
from txloom.llm.shared import stored

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: A feature is a candidate of the head if it holds this share of the words of a block of this many bytes.
HEAD_SHARE = 2.0**-16
BLOCK_BYTES = 4 << 20
#: The head's size, which bounds what is broadcast.
HEAD_WORDS = 1 << 16
HEAD_PAIRS = 1 << 17
#: Words of the tail that a worker remembers.
TAIL_WORDS = 300_000

# --- CRC-32 by states ---------------------------------------------------------------------------------------------------
_ONE = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)  # a state's low byte, moved by one zero byte
#: Second words of a pair up to this length are appended by table, longer ones by zlib.
_BY_TABLE = 48


def _moved_tables(longest: int) -> np.ndarray:
    """[length, byte place, byte]: a state that has only this byte, after `length` more zero bytes. States are linear in their bits."""
    state = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    out = [state]
    for _ in range(longest):
        state = (state >> np.uint32(8)) ^ _ONE[state & np.uint32(255)]
        out.append(state)
    return np.stack(out)


_MOVED = _moved_tables(_BY_TABLE)


def appended(states: np.ndarray, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of A + B from that of A, that of B and the length of B, at most _BY_TABLE."""
    out = crcs.copy()
    for place in range(4):
        out ^= _MOVED[lengths, place, (states >> np.uint32(8 * place)) & np.uint32(255)]
    return out


# --- the vocabulary -----------------------------------------------------------------------------------------------------
@dataclass
class Head:
    """Frequent words with their CRC states, and frequent pairs of them (first << 32 | second, sorted) with their buckets."""

    words: list[bytes] = field(default_factory=list)
    states: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint32))
    pairs: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    buckets: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))


class Features(dict):
    """Numbers of words: those of the head first, then words of the tail in the order they come, up to a bound."""

    def __init__(self, head: Head, buckets: int):
        super().__init__()
        self.head, self.n_buckets = head, buckets
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.update(zip(self.head.words, range(len(self.head.words)), strict=True))
        self.words, self.fresh = list(self.head.words), []
        self.states = self.head.states
        self.spaced = self._with_space(self.states)
        self.lengths = np.array([len(w) for w in self.words], np.int64)

    @staticmethod
    def _with_space(states: np.ndarray) -> np.ndarray:
        return appended(states, np.full(len(states), zlib.crc32(b" "), np.uint32), np.ones(len(states), np.int64))

    def __missing__(self, word: bytes) -> int:
        n = len(self)
        self[word] = n
        self.fresh.append(word)
        return n

    def numbers(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of a block, and how many words each text has."""
        if len(self) > len(self.head.words) + TAIL_WORDS:
            self._forget()
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        found = np.fromiter((n for words in texts for n in map(self.__getitem__, words)), np.int64, int(counts.sum()))
        if self.fresh:
            states = np.fromiter(map(zlib.crc32, self.fresh), np.uint32, len(self.fresh))
            self.states = np.concatenate([self.states, states])
            self.spaced = np.concatenate([self.spaced, self._with_space(states)])
            self.lengths = np.concatenate([self.lengths, np.fromiter(map(len, self.fresh), np.int64, len(self.fresh))])
            self.words += self.fresh
            self.fresh = []
        return found, counts

    def pair_buckets(self, key: np.ndarray) -> np.ndarray:
        """Buckets of pairs: the head's by its table, the others' by going on from the first word's state."""
        out = np.empty(len(key), np.int64)
        place = np.searchsorted(self.head.pairs, key)
        known = place < len(self.head.pairs)
        known[known] = self.head.pairs[place[known]] == key[known]
        out[known] = self.head.buckets[place[known]]
        tail = np.flatnonzero(~known)
        out[tail] = self._pair_crcs(key[tail] >> 32, key[tail] & 0xFFFFFFFF) % self.n_buckets
        return out

    def _pair_crcs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        lengths = self.lengths[second]
        crcs = appended(self.spaced[first], self.states[second], np.minimum(lengths, _BY_TABLE))
        for k in np.flatnonzero(lengths > _BY_TABLE):
            crcs[k] = zlib.crc32(self.words[second[k]], int(self.spaced[first[k]]))
        return crcs

    def buckets(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of the single words and of the pairs of a block, and how many of each a text has."""
        numbers, counts = self.numbers(texts)
        pairs = self.pair_buckets(_pair_numbers(numbers, counts))
        return self.states[numbers].astype(np.int64) % self.n_buckets, pairs, counts, np.maximum(counts - 1, 0)


def _pair_numbers(numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first << 32 | second of all pairs of neighbours in the texts of a block."""
    inside = np.ones(max(len(numbers) - 1, 0), bool)
    ends = np.cumsum(counts)[:-1]
    inside[ends[(ends > 0) & (ends < len(numbers))] - 1] = False
    return ((numbers[:-1] << 32) | numbers[1:])[inside]


def _frequent(size: int, share: float) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Words and pairs that hold a share of a block, with their counts there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features(Head(), BUCKETS)
        for _, texts in blocks(batches, size):
            numbers, counts = known.numbers(texts)
            least = max(2, math.ceil(share * len(numbers)))
            single = np.bincount(numbers, minlength=1)
            often = np.flatnonzero(single >= least)
            pairs, n = np.unique(_pair_numbers(numbers, counts), return_counts=True)
            pairs, n = pairs[n >= least], n[n >= least]
            features = [known.words[k] for k in often] + [
                known.words[a] + b" " + known.words[b] for a, b in zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": pa.array(features, pa.binary()),
                    "pair": pa.array([False] * len(often) + [True] * len(pairs), pa.bool_()),
                    "n": pa.array([*single[often].tolist(), *n.tolist()], pa.int64()),
                }
            )

    return run


def head_of(docs: DataFrame, buckets: int = BUCKETS, id_column: str = "doc_id", text_column: str = "text") -> Head:
    """The frequent words and pairs of a table. Any pair of words with HEAD_SHARE of all words is a candidate, as it has
    that share of some block; of the candidates the HEAD_WORDS and HEAD_PAIRS most counted are kept."""
    source = as_bytes(docs, id_column, text_column)
    counted = source.mapInArrow(_frequent(BLOCK_BYTES, HEAD_SHARE), "feature binary, pair boolean, n long")
    totals = stored(counted.groupBy("pair", "feature").agg(F.sum("n").alias("n")), "resample-head")

    def most(pair: bool, size: int) -> list[bytes]:
        chosen = totals.where(F.col("pair") == pair).orderBy(F.desc("n"), "feature").limit(size).select("feature")
        return chosen.toArrow().column("feature").to_pylist()

    words = most(False, HEAD_WORDS)
    numbers = {w: k for k, w in enumerate(words)}
    split = [feature.split(b" ") for feature in most(True, HEAD_PAIRS)]
    pairs = sorted((numbers[a] << 32 | numbers[b], zlib.crc32(a + b" " + b) % buckets) for a, b in split if a in numbers and b in numbers)
    return Head(
        words,
        np.fromiter(map(zlib.crc32, words), np.uint32, len(words)),
        np.fromiter((k for k, _ in pairs), np.int64, len(pairs)),
        np.fromiter((b for _, b in pairs), np.int64, len(pairs)),
    )


# --- totals, gains, weights ---------------------------------------------------------------------------------------------
def bucket_totals(rows: DataFrame, head, buckets: int = BUCKETS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """bucket, n: features of all texts in each bucket that has any. `head` is a broadcast Head."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, totals = Features(head.value, buckets), np.zeros(buckets, np.int64)
        for _, texts in blocks(batches, BLOCK_BYTES):
            single, pairs, _, _ = known.buckets(texts)
            totals += np.bincount(single, minlength=buckets) + np.bincount(pairs, minlength=buckets)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int64()), "n": pa.array(totals[used], pa.int64())})

    partial = as_bytes(rows, id_column, text_column).mapInArrow(run, "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def _totals(counted: DataFrame, buckets: int) -> list[int]:
    out = [0] * buckets
    found = counted.toArrow()
    for bucket, n in zip(found.column("bucket").to_pylist(), found.column("n").to_pylist(), strict=True):
        out[bucket] = n
    return out


def gains_of(raw: list[int], target: list[int]) -> np.ndarray:
    """A thousand times the log ratio of each bucket's share, one added to each count, rounded down."""
    n, all_raw, all_target = len(raw), float(sum(raw)), float(sum(target))
    ratio = (((t + 1.0) * (all_raw + n)) / ((s + 1.0) * (all_target + n)) for s, t in zip(raw, target, strict=True))
    return np.fromiter((math.floor(1000 * math.log(r)) for r in ratio), np.int64, n)


def weights(docs: DataFrame, head, gains, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight: the mean gain of a text's features, rounded down, 0 without features."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = gains.value
        known = Features(head.value, len(gain))
        for ids, texts in blocks(batches, BLOCK_BYTES):
            single, pairs, n_words, n_pairs = known.buckets(texts)
            total = np.zeros(len(ids), np.int64)
            for found, n in ((single, n_words), (pairs, n_pairs)):
                so_far = np.concatenate([[0], np.cumsum(gain[found])])
                ends = np.cumsum(n)
                total += so_far[ends] - so_far[ends - n]
            n_features = n_words + n_pairs
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids, pa.int64()),
                    "n_words": pa.array(n_words, pa.int64()),
                    "n_features": pa.array(n_features, pa.int64()),
                    "weight": pa.array(total // np.maximum(n_features, 1), pa.int64()),
                }
            )

    return as_bytes(docs, id_column, text_column).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


# --- the draw -----------------------------------------------------------------------------------------------------------
def with_score(weighted: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds score: the weight plus a thousand times Gumbel noise that the id and the seed fix, rounded down."""
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0)))).cast("long")
    return weighted.withColumn("score", F.col("weight") + noise)


def draw(scored: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """Adds rank, from 1, to the `percent` of the rows with at least `min_words` words that score highest; ties go to
    the smaller doc_id. `scored` is a stored table.

    Scores are whole numbers in a range that no size of corpus widens (logs of counts), so their histogram is small:
    it gives each score its first rank, and only rows of one score are ordered among themselves. Equal rows are one
    row with a count there, so that no repeated row makes a score heavy, and are as many again in the result.
    """
    fit = (F.col("n_words") >= min_words) & F.col("doc_id").isNotNull()
    counted = scored.where(fit).groupBy("score").count().toArrow()
    order = sorted(zip(counted.column("score").to_pylist(), counted.column("count").to_pylist(), strict=True), reverse=True)
    size = percent * sum(n for _, n in order) // 100
    starts, before = [], 0
    for score, n in order:
        if before >= size:
            break
        starts.append((score, before))
        before += n
    lowest = F.lit(starts[-1][0] if starts else None).cast("long")
    reached = F.coalesce(fit & (F.col("score") >= lowest), F.lit(False))
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    same = scored.where(reached).groupBy(*columns).agg(F.count("*").alias("copies"))
    first = F.broadcast(scored.sparkSession.createDataFrame(starts, "score long, before long"))
    earlier = Window.partitionBy("score").orderBy("doc_id", "n_words", "n_features", "weight").rowsBetween(Window.unboundedPreceding, -1)
    ranked = same.join(first, "score").withColumn("before", F.col("before") + F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
    ranked = ranked.select(*columns, F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("copies"))).alias("rank"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= size, F.col("rank")))
    return ranked.unionByName(scored.where(~reached).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
    buckets: int = BUCKETS,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row: drawn rows have a rank.

    A null or empty text has no features and weight 0. A row without an id keeps its place in the totals and has a
    weight, but no score and no rank, and is not counted among the documents to draw from. Repeated rows are as many
    rows, each with a rank of its own; rows that share an id share their noise, each has the weight of its own text
    and they are ordered by their counts and weights. An empty table gives no rows, an empty target gains that only
    smooth. Other columns are not read.
    """
    spark = docs.sparkSession
    head = spark.sparkContext.broadcast(head_of(docs, buckets, id_column, text_column))
    raw = _totals(bucket_totals(docs, head, buckets, id_column, text_column), buckets)
    wanted = _totals(bucket_totals(target.select(F.lit(0).alias("id"), F.col(target_text).alias("text")), head, buckets, "id", "text"), buckets)
    gains = spark.sparkContext.broadcast(gains_of(raw, wanted))
    scored = with_score(weights(docs, head, gains, id_column, text_column), seed)
    return draw(stored(scored, "resample-scores"), min_words, percent)


def duckdb_sql(min_words: int = 20, percent: int = 25, seed: int = 7, buckets: int = 10_000) -> str:
    """The same over the views `documents` and `benchmark`, as DuckDB SQL; CRC-32 is taken bit by bit, once per feature."""
    words = rf"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}')"
    runs = "w || CASE WHEN len(w) < 2 THEN [] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END"
    bits = (
        "list_transform(range(0, 8 * octet_length(encode(feature))), lambda i: "
        "(((strpos('0123456789ABCDEF', substr(hex(encode(feature)), 2 * (i // 8) + 2 - (i % 8) // 4, 1)) - 1) >> (i % 4)::INT) & 1)::BIGINT)"
    )
    crc = f"xor(list_reduce([4294967295::BIGINT] || {bits}, lambda c, b: xor(c >> 1, 3988292384::BIGINT * (xor(c, b) & 1))), 4294967295::BIGINT)"
    return f"""
WITH raw_words AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
raw AS (SELECT r, doc_id, len(w) AS n_words, {runs} AS features FROM raw_words),
wanted_words AS (SELECT {words} AS w FROM benchmark),
wanted AS (SELECT {runs} AS features FROM wanted_words),
raw_features AS (SELECT r, unnest(features) AS feature FROM raw),
wanted_features AS (SELECT unnest(features) AS feature FROM wanted),
bucket_of AS (SELECT feature, {crc} % {buckets} AS bucket
    FROM (SELECT feature FROM raw_features UNION SELECT feature FROM wanted_features)),
s AS (SELECT bucket, count(*) AS n FROM raw_features JOIN bucket_of USING (feature) GROUP BY 1),
t AS (SELECT bucket, count(*) AS n FROM wanted_features JOIN bucket_of USING (feature) GROUP BY 1),
gains AS (SELECT bucket, floor(1000 * ln(
        (coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s) + {buckets}.0::DOUBLE)
        / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM t) + {buckets}.0::DOUBLE))))::BIGINT AS gain
    FROM s FULL JOIN t USING (bucket)),
weighed AS (SELECT r, sum(gain) AS total, count(*) AS n FROM raw_features JOIN bucket_of USING (feature) JOIN gains USING (bucket) GROUP BY 1),
weights AS (SELECT r, doc_id, n_words, len(features) AS n_features,
        coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight FROM raw LEFT JOIN weighed USING (r)),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
    FROM weights),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {min_words} AND doc_id IS NOT NULL ORDER BY score DESC, doc_id, n_words, n_features, weight) AS place,
        n_words >= {min_words} AND doc_id IS NOT NULL AS fit FROM scored)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
    CASE WHEN fit AND place <= {percent} * (SELECT count(*) FROM ranked WHERE fit) // 100 THEN place END::BIGINT AS rank
FROM ranked
"""
