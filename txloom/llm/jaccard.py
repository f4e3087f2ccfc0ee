"""N-gram Jaccard join by parity sketches.

The set of a document is its distinct word shingles, as 64-bit hashes. Each shingle flips one bit of a
sketch, so the Hamming distance of two sketches never exceeds the symmetric difference of the sets. For
sizes s <= t and similarity j = N/100, linked sets have s >= j t and a symmetric difference of at most
d = (s + t)(1 - j)/(1 + j).

Pigeonhole: within a size band all sketches are cut into the same segments. d differing shingles leave all
but d segments as they are. So of the segments that hold a bit, ranked by an order on their contents, the
first d + 1 of two linked documents must share one (a document with fewer sends all of them). These segments
are the join keys. Bands are a factor of three wide and a document near a border also joins the next band.

Verification: documents of a key are not paired with each other. First each is paired with one centre of
its key, twice, the second time with the one that has most links so far. Only keys that then still hold
documents of different components are looked at pair by pair, in blocks of bounded size: first by sketches,
which names the documents near one of another component, then by the sets of these. No pairs leave the first
look, and the second sends out only links that join two components not joined in its block before, fewer than
it has rows.

Documents with equal sets are one node of the graph from the start.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txloom.llm.components import components
from txloom.llm.shared import WordHashes, dropped, mix64, signed, stored, texts, windows

SHINGLE = 5
PERCENT = 80
#: A band takes sizes from one border to below the next; the first border is the smallest set that can link to another.
BAND_FACTOR = 3
#: Segments are a third of the sizes that a band ends with: one to three shingles each. Small sets have this many.
LEAST_SEGMENTS = 32
#: Bits of a segment (as a power of two).
CELLS = 16
#: Documents of one key that are compared with each other in a task, and their shingles, about.
BLOCK_ROWS = 1_000
BLOCK_SHINGLES = 2_000_000
#: Rows of several keys that a task compares at once, about.
ROWS_TOGETHER = 20_000
#: Bits of the filter that tells which sets are needed, at most.
FILTER_BITS = 1 << 24

ROWS = "doc_id long, n_shingles long, node long, text_hash long, keys array<long>"


def shingles(text: str, hashes: WordHashes, width: int = SHINGLE) -> np.ndarray:
    """The set of a text in ascending order: distinct runs of `width` words; of fewer words the whole; of none nothing."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(windows(hashes.of(words), min(width, len(words))))


def _node(s: np.ndarray) -> int | None:
    """The name of a set: 64 bits of hash. Null for the empty set."""
    return xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None


def _text_hash(text: str) -> int:
    """xxHash64, as Spark's function has it."""
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).view(np.int64))


def _difference(s: int, t: int, percent: int) -> int:
    """The largest symmetric difference of linked sets of these sizes."""
    return (s + t) * (100 - percent) // (100 + percent)


@cache
def _borders(percent: int) -> np.ndarray:
    """Where bands begin. Below the first border sets link to equal sets only."""
    first = 1
    while _difference(first, first * 100 // percent, percent) < 1:
        first += 1
    return np.array([first * BAND_FACTOR**k for k in range(40) if first * BAND_FACTOR**k < 1 << 60])


def _bands(n: int, borders: np.ndarray, percent: int) -> list[int]:
    """The bands that a set of n joins: its own, and the next if a linked set can lie there."""
    own = int(np.searchsorted(borders, n, side="right")) - 1
    if own < 0:
        return []
    return [own, own + 1] if n * 100 // percent >= borders[own + 1] else [own]


def segment_keys(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The join keys of a set."""
    n, borders = len(s), _borders(percent)
    out = []
    for band in _bands(n, borders, percent):
        # a document of the band before it comes for partners of this band, which are larger
        widest = min(int(borders[band + 1]) - 1, n * 100 // percent)
        needed = _difference(n, widest, percent) + 1
        segments = max(LEAST_SEGMENTS, int(borders[band + 1]) // 3)
        h = mix64(s + np.uint64(0x51ED270B0F5CB1A5 * (band + 1) & (2**64 - 1)))
        bit = ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32) << np.uint64(CELLS)) | (h & np.uint64((1 << CELLS) - 1))
        bit, times = np.unique(bit, return_counts=True)
        bit = bit[times % 2 == 1]
        if len(bit):
            segment = bit >> np.uint64(CELLS)
            starts = np.flatnonzero(np.diff(segment, prepend=np.uint64(2**63)))
            contents = np.bitwise_xor.reduceat(mix64(bit + np.uint64(band + 1 << 56)), starts)
            filled = np.diff(np.append(starts, len(bit)))
            order = np.lexsort((contents, -filled))
            keys = mix64(contents + segment[starts])[order]
        else:
            keys = np.empty(0, np.uint64)
        if len(keys) < needed:
            # so may a linked document be: those that send all they have also meet each other
            keys = np.append(keys, mix64(np.array([band + 1], np.uint64)))
        out.append(keys[:needed] if len(keys) > needed else keys)
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def _sketch_bits(n: int) -> int:
    return 1 << max(6, int(4 * n - 1).bit_length() - 1)


def sketch(s: np.ndarray) -> bytes:
    """A parity sketch of some two to four bits a shingle, at least 64 bits."""
    bits = _sketch_bits(len(s))
    odd = np.bincount((mix64(s) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(data: np.ndarray, size: int) -> np.ndarray:
    """Sketches (one a row) folded to `size` bytes: halves XORed, which keeps parity."""
    while data.shape[1] > size:
        half = data.shape[1] // 2
        data = data[:, :half] ^ data[:, half:]
    return data


def _rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """A stored row for each document; keys only where its set is new to the task and not empty."""

    def describe(batches: Iterable) -> Iterator[pa.RecordBatch]:
        hashes, known = WordHashes(), set()
        for batch in batches:
            sizes, nodes, text_hashes, keys = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, hashes, width)
                node = _node(s)
                new = node is not None and node not in known
                known.add(node)
                sizes.append(len(s))
                nodes.append(node)
                text_hashes.append(_text_hash(text))
                keys.append(signed(segment_keys(s, percent)) if new else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(text_hashes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "node", "text_hash", "keys"],
            )

    return stored(docs.mapInArrow(describe, ROWS), "jaccard-rows")


def _near(n_a: np.ndarray, n_b: np.ndarray, distance: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and sketch distance allow a link."""
    return (distance * (100 + percent) <= (n_a + n_b) * (100 - percent)) & (np.minimum(n_a, n_b) * 100 >= np.maximum(n_a, n_b) * percent)


def _with_both(pairs: DataFrame, nodes: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b) with n_shingles and a column of both nodes, and a stored table that they are read from.

    A node is in no more pairs as `a` than it has keys, so `a` meets the buckets of `nodes`, which are not shuffled.
    `b`, the centre of a key, can be that of very many: the few centres come as a table of their own, and adaptive
    execution splits this join where one has many pairs.
    """
    centres = stored(nodes.join(pairs.select(F.col("b").alias("node")).distinct(), "node", "left_semi").select("node", "n_shingles", column), "jaccard-centres")
    side = lambda of, x: of.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col(column).alias(f"s_{x}"))
    return pairs.join(side(nodes, "a"), "a").join(side(centres, "b"), "b"), centres


def _near_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches are near enough, stored."""
    sketched, centres = _with_both(pairs, nodes, "sketch")

    def measure(batches: Iterable) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            distance = np.zeros(len(n_a), np.int64)
            for k, (x, y) in enumerate(zip(batch.column("s_a").to_pylist(), batch.column("s_b").to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint8)[None, :], np.frombuffer(y, np.uint8)[None, :]
                size = min(x.shape[1], y.shape[1])
                distance[k] = np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()
            keep = pa.array(_near(n_a, n_b, distance, percent))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    near = stored(sketched.mapInArrow(measure, "a long, b long"), "jaccard-near")
    dropped(centres)
    return near


def _candidate_sets(docs: DataFrame, described: DataFrame, live: DataFrame, width: int) -> DataFrame:
    """node, n_shingles, sketch, items (its set), for the nodes that share a key with another. They are made again from their texts.

    Stored in buckets by node, so that the joins that follow do not shuffle the sets again.
    """
    spark = docs.sparkSession
    ends = live.select("node").distinct()
    wanted = described.join(ends, "node", "left_semi").select(F.col("text_hash").alias("h"))
    # a bit for the low end of each hash
    words = wanted.groupBy(F.expr(f"shiftright(h & {FILTER_BITS - 1}, 6)").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(h & 63 AS int)))").alias("bits"))
    found = words.toArrow()  # at most FILTER_BITS / 64 rows
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[found["at"].to_numpy()] = found["bits"].to_numpy()
    shared = spark.sparkContext.broadcast(bits)

    def candidates(batches: Iterable) -> Iterator[pa.RecordBatch]:
        hashes, known, table = WordHashes(), set(), shared.value
        for batch in batches:
            nodes, sizes, sketches, sets = [], [], [], []
            for text in batch.column("text").to_pylist():
                at = _text_hash(text) & (FILTER_BITS - 1)
                if int(table[at >> 6]) >> (at & 63) & 1:
                    s = shingles(text, hashes, width)
                    node = _node(s)
                    if node is not None and node not in known:
                        known.add(node)
                        nodes.append(node)
                        sizes.append(len(s))
                        sketches.append(sketch(s))
                        sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary()), pa.array(sets, pa.binary())],
                ["node", "n_shingles", "sketch", "items"],
            )

    sets = docs.mapInArrow(candidates, "node long, n_shingles long, sketch binary, items binary")
    one = sets.join(ends, "node", "left_semi").groupBy("node").agg(*(F.first(c).alias(c) for c in ("n_shingles", "sketch", "items")))
    return stored(one, "jaccard-sets", bucketed=(int(spark.conf.get("spark.sql.shuffle.partitions")), "node"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough, stored."""
    whole, centres = _with_both(pairs, sets, "items")

    def check(batches: Iterable) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("s_a").to_pylist(), batch.column("s_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    links = stored(whole.mapInArrow(check, "a long, b long"), "jaccard-links")
    dropped(centres)
    return links


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of pairs (node, centre), stored."""
    pairs = stored(pairs, "jaccard-pairs")
    near = _near_pairs(pairs, sets, percent)
    links = _verified(near, sets, percent)
    dropped(pairs, near)
    return links


def _live(described: DataFrame) -> DataFrame:
    """key, node of the keys that two nodes share, stored. Of keys with the same nodes one stays: they ask for the same pairs."""
    every = described.where("keys is not null").select("node", F.explode("keys").alias("key"))
    shared = every.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x < y").select("key")
    met = stored(every.join(shared, "key").distinct(), "jaccard-keys")
    # a set of nodes is told by its size and 128 bits of hash
    alike = met.groupBy("key").agg(
        F.count("*").alias("n"), F.expr("bit_xor(xxhash64(node))").alias("h"), F.expr("bit_xor(xxhash64(node, 1))").alias("g")
    )
    first = alike.groupBy("n", "h", "g").agg(F.min("key").alias("key")).select("key")
    live = stored(met.join(first, "key", "left_semi"), "jaccard-keys")
    dropped(met)
    return live


def _to_centres(live: DataFrame, rank: DataFrame | None) -> DataFrame:
    """Pairs (a, b) of each node with the centre of each of its keys: the node of the highest rank.

    The order by rank and node is the same in all keys, so no pair comes both ways round.
    """
    ranked = live.withColumn("rank", F.lit(0)) if rank is None else live.join(rank, "node", "left").fillna(0, ["rank"])
    centre = ranked.groupBy("key").agg(F.max(F.struct("rank", "node")).alias("centre"))
    pairs = ranked.join(centre.select("key", F.col("centre.node").alias("centre")), "key").where("node <> centre")
    return pairs.select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()


def _apart(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs whose nodes are of different components so far."""
    side = lambda x: members.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where("c_a <> c_b").select("a", "b", "c_a", "c_b")


def _merged(members: DataFrame, links: DataFrame) -> DataFrame:
    """node, component after further links, stored: only the components that these join are gone through again."""
    again = components(_apart(links, members), "c_a", "c_b").select(F.col("node").alias("component"), F.col("component").alias("joined"))
    after = members.join(again, "component", "left").select("node", F.coalesce("joined", "component").alias("component"))
    return stored(after, "jaccard-members")


def _spread(live: DataFrame, members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of the keys that hold more than one component, one for each pair of blocks that the row's block is in.

    A block has some BLOCK_ROWS rows or BLOCK_SHINGLES shingles of a key, whichever is reached first.
    """
    named = live.join(members, "node").join(nodes.select("node", "n_shingles"), "node")
    open_ = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"), F.sum("n_shingles").alias("weight"))
    size = F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("weight") / BLOCK_SHINGLES)).cast("int")
    blocks = stored(open_.where("x < y").select("key", "n", size.alias("blocks")), "jaccard-open")
    placed = named.join(blocks.drop("n"), "key").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    spread = placed.withColumn("other", F.explode(every)).select(
        "key", "node", "component", "block", "n_shingles", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    # tasks of many small keys take these together
    rows_ = blocks.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    return spread.withColumn("task", F.pmod(F.xxhash64("key", "i", "j"), F.lit(rows_ // ROWS_TOGETHER + 1)))


def _by_pair_of_blocks(table: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Each pair of blocks of a task: its rows, and the places of those of the first and of the second block."""
    key, i, j, block = (table.column(c).to_numpy() for c in ("key", "i", "j", "block"))
    order = np.lexsort((block, j, i, key))
    key, i, j, block = (x[order] for x in (key, i, j, block))
    table = table.take(pa.array(order))
    cuts = np.flatnonzero(np.append(True, (np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)))
    for a, b in zip(cuts, np.append(cuts[1:], len(key)), strict=True):
        at = np.arange(b - a)
        first = at[block[a:b] == i[a]]
        yield table.slice(a, b - a), first, first if i[a] == j[a] else at[block[a:b] == j[a]]


def _near_within(sketches: list[bytes], n: np.ndarray, component: np.ndarray, first: np.ndarray, second: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places of near pairs of different components, some rows of the first block at a time."""
    size = min(map(len, sketches))
    bits = np.concatenate([folded(np.frombuffer(x, np.uint8)[None, :], size) for x in sketches]).view(np.uint64)
    step = max(1, (1 << 20) // (len(second) * bits.shape[1] + 1))
    for k in range(0, len(first), step):
        r, c = first[k : k + step, None], second[None, :]
        distance = np.bitwise_count(bits[r] ^ bits[c]).sum(2, dtype=np.int64)
        near = _near(n[r], n[c], distance, percent) & (component[r] != component[c])
        if first is second:
            near &= r < c
        x, y = np.nonzero(near)
        yield first[k + x], second[y]


def _wanted(spread: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The rows of `spread` that are near a row of another component in some pair of blocks, stored."""

    def near(table: pa.Table) -> pa.Table:
        kept = []
        for part, first, second in _by_pair_of_blocks(table):
            n, component = (part.column(c).to_numpy() for c in ("n_shingles", "component"))
            wanted = np.zeros(len(n), bool)
            if (component != component[0]).any():
                for x, y in _near_within(part.column("sketch").to_pylist(), n, component, first, second, percent):
                    wanted[x] = wanted[y] = True
            if wanted.any():
                kept.append(part.drop_columns(["sketch", "task"]).filter(pa.array(wanted)))
        return pa.concat_tables(kept) if kept else table.drop_columns(["sketch", "task"]).slice(0, 0)

    columns = "key long, node long, component long, block int, n_shingles long, i int, j int"
    rows_ = spread.join(nodes.select("node", "sketch"), "node").select("key", "node", "component", "block", "n_shingles", "i", "j", "task", "sketch")
    return stored(rows_.groupBy("task").applyInArrow(near, columns), "jaccard-wanted")


def _rest(live: DataFrame, members: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join all components which a key shows to be linked, stored: of a pair of blocks no more than its rows."""
    wanted = _wanted(_spread(live, members, nodes), nodes, percent)
    shingles_ = wanted.agg(F.sum("n_shingles")).first()[0] or 0
    tasks = F.lit(shingles_ // BLOCK_SHINGLES + 1)

    def link(table: pa.Table) -> pa.Table:
        out: list[tuple[int, int]] = []
        for part, first, second in _by_pair_of_blocks(table):
            node, n, component = (part.column(c).to_numpy() for c in ("node", "n_shingles", "component"))
            items = [np.frombuffer(x, np.uint64) for x in part.column("items").to_pylist()]
            ends = np.cumsum([len(x) for x in items])[:-1]
            local = np.split(np.unique(np.concatenate(items), return_inverse=True)[1], ends)
            mark = np.zeros(max(int(x.max()) for x in local) + 1, bool)
            root = {c: c for c in component.tolist()}

            def top(c: int, root: dict[int, int] = root) -> int:
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            marked = -1
            for rows_, columns in _near_within([sketch(x) for x in items], n, component, first, second, percent):
                for r, c in zip(rows_.tolist(), columns.tolist(), strict=True):
                    x, y = top(int(component[r])), top(int(component[c]))
                    if x == y:
                        continue
                    if marked != r:
                        mark[:] = False
                        mark[local[r]] = True
                        marked = r
                    both = int(np.count_nonzero(mark[local[c]]))
                    if 100 * both >= percent * int(n[r] + n[c] - both):
                        root[max(x, y)] = min(x, y)
                        out.append((int(node[r]), int(node[c])))
        # a pair often shares many keys
        once = np.unique(np.array(out, np.int64).reshape(-1, 2), axis=0)
        return pa.table({"a": once[:, 0], "b": once[:, 1]})

    rows_ = wanted.join(sets.select("node", "items"), "node").withColumn("task", F.pmod(F.xxhash64("key", "i", "j"), tasks))
    return stored(rows_.groupBy("task").applyInArrow(link, "a long, b long").distinct(), "jaccard-links")


def jaccard_components(
    docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """A row for each row of `docs`: doc_id, text_hash (xxHash64 of its text), n_shingles, node (a name of its set),
    class (a name of its component), component_id.

    component_id is the smallest doc_id that links reach. Rows with equal sets are linked; a text without
    words (null, empty, blank) has the empty set and links with nothing: its component_id is its doc_id.
    Rows with a null id keep it as doc_id; a component of such rows only has a null component_id. Of rows that
    share an id each has the component of its own text. An empty table gives an empty one.
    """
    classes, steps = _classes(texts(docs, id_column, text_column), percent, width)
    dropped(*steps)
    return classes


def _classes(narrow: DataFrame, percent: int, width: int) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of jaccard_components, stored, and the stored tables they were made from."""
    described = _rows(narrow, width, percent)
    live = _live(described)
    sets = _candidate_sets(narrow, described, live, width)
    nodes = sets.select("node", "n_shingles", "sketch")

    first = _linked(_to_centres(live, None), sets, percent)
    degree = first.select(F.col("a").alias("node")).union(first.select("b")).groupBy("node").agg(F.count("*").alias("rank"))
    members = [_merged(nodes.select("node", F.col("node").alias("component")), first)]
    second = _linked(_apart(_to_centres(live, degree), members[-1]).select("a", "b"), sets, percent)
    members.append(_merged(members[-1], second))
    third = _rest(live, members[-1], nodes, sets, percent)
    members.append(_merged(members[-1], third))

    named = described.select("doc_id", "text_hash", "n_shingles", "node").join(members[-1], "node", "left")
    named = named.withColumn("class", F.coalesce("component", "node"))
    smallest = named.where("node is not null").groupBy("class").agg(F.min("doc_id").alias("smallest"))
    classes = named.join(smallest, "class", "left").select(
        "doc_id", "text_hash", "n_shingles", "node", "class", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id")
    )
    return stored(classes, "jaccard-classes"), [described, live, sets, first, second, third, *members]
