"""Hard negatives: for an anchor and each of its nearest rows of the same label, the nearest rows of other labels whose
score lies between two shares of the positive's.

Scores are inner products of vectors rounded to whole numbers, so all comparisons are exact. Rows are parted by the
hyperplanes between split points taken from a bounded sample, and cells are cut into blocks of bounded size; every row is
in a block. A block is one row of a stored table, and the task that reads it grows a hyperplane tree over it (`gnat`).
Anchors, and later the windows of scores, are stored too and read by the tasks batch by batch; a block's tree eliminates
what its distance ranges exclude, leaves score the rest, and the first rows of all blocks are ranked.

Of rows with one label and one vector only those with the smallest ids can be among the first, so a crowd of copies
enters the index as a handful of rows; equal anchors are searched for once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txloom.llm.gnat import Best, Tree
from txloom.llm.shared import dropped, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: Shares of the positive's score, in percent, that bound a negative's.
WINDOW = (50, 95)
#: Rows of a block, about, and split points that part the table into cells, at most.
BLOCK_ROWS = 4_096
CELLS = 256
#: Rows that the split points are chosen from, at most: those whose hashes are smallest.
FIT_ROWS = 4_096
#: Anchors or windows that a task holds at once.
BATCH_QUERIES = 4_096
#: Whole numbers stay below this, so that sums of up to 8,192 products are exact in doubles.
LARGEST = 1 << 20

_ROW = "struct<vec_id: long, label: long, key: string, anchor: boolean, vec: binary>"


# --- rows ---------------------------------------------------------------------------------------------------------------
def _whole_vectors(scale: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            ends = np.cumsum(sizes)
            bad = np.concatenate([[0], np.cumsum(~(np.abs(flat) < LARGEST))])
            kept = np.flatnonzero((bad[ends] == bad[ends - sizes]) & (sizes > 0))
            whole = np.where(np.abs(flat) < LARGEST, flat, 0).astype("<i4")
            squares = np.concatenate([[0], np.cumsum(whole.astype(np.int64) ** 2)])
            out = batch.take(pa.array(kept))
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": out.column("vec_id"),
                    "label": out.column("label"),
                    "anchor": out.column("anchor"),
                    "vec": pa.array([whole[ends[k] - sizes[k] : ends[k]].tobytes() for k in kept], pa.binary()),
                    "square": pa.array(squares[ends[kept]] - squares[ends[kept] - sizes[kept]], pa.int64()),
                }
            )

    return run


def whole_rows(vectors: DataFrame, anchors: Column, scale: int, id_column: str, label_column: str, vector_column: str) -> DataFrame:
    """vec_id, label, anchor, vec (whole numbers of 32 bits), square, key: the rows that take part, each once."""
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).cast("long").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    rows = rows.mapInArrow(_whole_vectors(scale), "vec_id long, label long, anchor boolean, vec binary, square long")
    rows = rows.groupBy("vec_id", "label", "vec", "square").agg(F.max("anchor").alias("anchor"))
    return rows.withColumn("key", F.md5(F.concat(F.encode(F.concat(F.col("label").cast("string"), F.lit(":")), "utf-8"), "vec")))


def _matrix(vecs: Iterable[bytes], dimension: int) -> np.ndarray:
    return np.frombuffer(b"".join(vecs), "<i4").reshape(-1, dimension).astype(np.float64)


# --- blocks -------------------------------------------------------------------------------------------------------------
def split_points(rows: DataFrame) -> dict[int, np.ndarray]:
    """By vector length: split points, far apart, chosen from a bounded sample; as many as blocks are needed."""
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("key"), "key").select("vec").limit(FIT_ROWS).toArrow().column("vec").to_pylist()
    by_size: dict[int, list[bytes]] = {}
    for vec in sample:
        by_size.setdefault(len(vec) // 4, []).append(vec)
    out = {}
    for dimension, vecs in by_size.items():
        wanted = min(CELLS, max(1, round(n * len(vecs) / len(sample) / BLOCK_ROWS)))
        x = _matrix(vecs, dimension)
        chosen, far = [0], ((x - x[0]) ** 2).sum(1)
        while len(chosen) < wanted and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
        out[dimension] = x[chosen]
    return out


def blocks(rows: DataFrame) -> DataFrame:
    """dimension, rows: the table in blocks, one row each. Cells with more rows than a block are cut by key."""
    points = rows.sparkSession.sparkContext.broadcast(split_points(rows))

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column("vec").to_pylist()
            cell = np.zeros(len(vecs), np.int32)
            sizes = np.fromiter((len(v) // 4 for v in vecs), np.int64, len(vecs))
            for dimension in np.unique(sizes):
                at = points.value.get(int(dimension))
                if at is not None:
                    here = np.flatnonzero(sizes == dimension)
                    x = _matrix([vecs[k] for k in here], int(dimension))
                    cell[here] = ((at**2).sum(1) - 2 * x @ at.T).argmin(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    columns = ["vec_id", "label", "key", "anchor", "vec"]
    routed = rows.select(*columns).mapInArrow(route, "vec_id long, label long, key string, anchor boolean, vec binary, cell int")
    routed = stored(routed.withColumn("dimension", (F.octet_length("vec") / 4).cast("int")), "negatives-routed")
    # at most CELLS of a vector length, and only those that one block does not hold
    heavy = routed.groupBy("dimension", "cell").count().where(F.col("count") > BLOCK_ROWS)
    salt = F.pmod(F.xxhash64("key"), F.coalesce(F.ceil(F.col("count") / BLOCK_ROWS), F.lit(1)).cast("long"))
    placed = routed.join(F.broadcast(heavy), ["dimension", "cell"], "left").withColumn("salt", salt)
    packed = placed.groupBy("dimension", "cell", "salt").agg(F.collect_list(F.struct(*columns)).alias("rows"))
    out = stored(packed.select("dimension", "rows"), "negatives-blocks")
    dropped(routed)
    return out


class Block:
    """A block of the index in a task: its tree, ids and labels."""

    def __init__(self, dimension: int, rows: pa.StructScalar):
        held = rows.values
        self.dimension = dimension
        self.ids = held.field("vec_id").to_numpy(zero_copy_only=False)
        self.labels = held.field("label").to_numpy(zero_copy_only=False)
        self.anchors = np.flatnonzero(held.field("anchor").to_numpy(zero_copy_only=False))
        self.keys = held.field("key")
        self.vecs = held.field("vec")
        self.tree = Tree(_matrix(self.vecs.to_pylist(), dimension))

    def search(self, queries: np.ndarray, best: Best) -> None:
        best.rows(self.ids, self.labels)
        self.tree.search(queries, best)


def _in_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[list[Block]]:
    for batch in batches:
        yield [Block(d, rows) for d, rows in zip(batch.column("dimension").to_pylist(), batch.column("rows"), strict=True)]


def _queries(folder: str, dimension: int) -> Iterator[pa.RecordBatch]:
    """Stored queries of a vector length, batch by batch."""
    store, path = fs.FileSystem.from_uri(folder)
    source = ds.dataset(path, filesystem=store, format="parquet")
    for batch in source.to_batches(filter=ds.field("dimension") == dimension, batch_size=BATCH_QUERIES):
        if batch.num_rows:
            yield batch


# --- searches -----------------------------------------------------------------------------------------------------------
def _anchor_floors(k: int):
    """The distinct anchors of each block, each with its k-th best score in the block, below which no row matters."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _in_blocks(batches):
            for block in held:
                keys, first = np.unique(block.keys.take(pa.array(block.anchors)).to_pylist(), return_index=True)
                at = block.anchors[first]
                if not len(at):
                    continue
                queries = _matrix(block.vecs.take(pa.array(at)).to_pylist(), block.dimension)
                best = Best(k, np.full(len(at), -np.inf), np.full(len(at), np.inf), block.labels[at], same=True)
                block.search(queries, best)
                floors = best.scores[:, -1]
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(keys.tolist(), pa.string()),
                        "label": pa.array(block.labels[at], pa.int64()),
                        "dimension": pa.array([block.dimension] * len(at), pa.int32()),
                        "vec": block.vecs.take(pa.array(at)).cast(pa.binary()),
                        "low": pa.array(floors, pa.float64()),
                    }
                )

    return run


def _search(folder: str, k: int, same: bool):
    """Every stored query over the blocks of a task: the k first rows they have for it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _in_blocks(batches):
            for dimension in sorted({b.dimension for b in held}):
                for asked in _queries(folder, dimension):
                    low = asked.column("low").to_numpy(zero_copy_only=False)
                    high = np.full(len(low), np.inf) if same else asked.column("high").to_numpy(zero_copy_only=False)
                    labels = asked.column("label").to_numpy(zero_copy_only=False)
                    best = Best(k, low.astype(np.float64), high.astype(np.float64), labels, same)
                    queries = _matrix(asked.column("vec").to_pylist(), dimension)
                    for block in held:
                        if block.dimension == dimension:
                            block.search(queries, best)
                    query, place = np.nonzero(best.scores > -np.inf)
                    score = pa.array(best.scores[query, place].astype(np.int64), pa.int64())
                    found = {"score": score, "vec_id": pa.array(best.ids[query, place], pa.int64())}
                    names = ["key"] if same else ["key", "positive_score"]
                    yield pa.RecordBatch.from_pydict({n: asked.column(n).take(pa.array(query)) for n in names} | found)

    return run


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score (all but rank long).

    `anchors` is a condition on the columns of `vectors`. Rows with a null id, label or vector, an empty vector, or a
    component that is null, not finite or, times `scale`, not below LARGEST take no part. Equal rows are one row; rows that share an
    id but differ are rows of their own, and an anchor's positives are all rows but itself. Vectors of different length
    do not meet. Ties go to the smaller id. A positive without a row in its window gives no rows, nor does an empty
    table. Other columns are not read.
    """
    if not 0 <= window[0] <= window[1]:
        raise ValueError("window: two shares in percent, the smaller first")
    k = positives + 1  # the anchor itself may be among them
    rows = stored(whole_rows(vectors, anchors, scale, id_column, label_column, vector_column), "negatives-rows")
    copies = Window.partitionBy("key", "anchor").orderBy("vec_id")
    few = rows.withColumn("n", F.row_number().over(copies)).where(F.col("n") <= max(k, negatives)).drop("n")
    few = stored(few, "negatives-few")
    index = blocks(few)
    asked = stored(index.mapInArrow(_anchor_floors(k), "key string, label long, dimension int, vec binary, low double"), "negatives-anchors")
    near = index.mapInArrow(_search(asked._llm_folder, k, same=True), "key string, score long, vec_id long")
    near = _first(near, ["key"], k).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("near"))
    near = stored(near, "negatives-positives")

    low, high = F.lit(window[0]) * F.col("positive_score"), F.lit(window[1]) * F.col("positive_score")
    scores = near.select("key", F.explode(F.array_distinct("near.score")).alias("positive_score"))
    windows = asked.drop("low").join(scores, "key").select(
        "key",
        "label",
        "dimension",
        "vec",
        "positive_score",
        ((low + F.pmod(-low, F.lit(100))) / 100).cast("long").alias("low"),
        ((high - F.pmod(high, F.lit(100))) / 100).cast("long").alias("high"),
    )
    windows = stored(windows.where("low <= high"), "negatives-windows")
    found = index.mapInArrow(_search(windows._llm_folder, negatives, same=False), "key string, positive_score long, score long, vec_id long")
    ranked = _first(found, ["key", "positive_score"], negatives)
    listed = ranked.groupBy("key").agg(
        F.collect_list(F.struct("positive_score", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))).alias("far")
    )
    answers = near.join(listed, "key")

    anchor = rows.where("anchor").select("key", F.col("vec_id").alias("anchor_id"), "square").join(answers, "key")
    own = F.array_position(F.transform("near", lambda r: (r["score"] == F.col("square")) & (r["vec_id"] == F.col("anchor_id"))), F.lit(True))
    # the anchor's own entry, where it is among the first, is passed over
    others = F.slice(F.filter("near", lambda r, i: i + 1 != F.col("own")), 1, positives)
    pairs = anchor.withColumn("own", own).select("anchor_id", "far", F.explode(others).alias("positive"))
    matching = F.filter("far", lambda n: n["positive_score"] == F.col("positive.score"))
    made = pairs.select("anchor_id", F.col("positive.vec_id").alias("positive_id"), F.explode(matching).alias("n"))
    return made.select(
        "anchor_id", "positive_id", F.col("n.rank").alias("rank"), "n.negative_id", "n.positive_score", "n.negative_score"
    )


def duckdb_sql(positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> str:
    """The mined negatives of the view `embeddings`, every row against every anchor, as DuckDB SQL."""
    return f"""
WITH whole AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbered AS (SELECT *, row_number() OVER () AS r FROM whole),
scored AS (SELECT a.vec_id AS anchor_id, a.r AS anchor, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM numbered a JOIN numbered b ON a.r <> b.r AND a.vec_id % 50 = 0 AND len(a.v) = len(b.v)),
near AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS n FROM scored WHERE same),
far AS (SELECT p.anchor_id, p.anchor, p.vec_id AS positive_id, p.n, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor, p.n ORDER BY s.score DESC, s.vec_id) AS rank
    FROM near p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
        AND {low} * p.score <= 100 * s.score AND 100 * s.score <= {high} * p.score
    WHERE p.n <= {positives})
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM far WHERE rank <= {negatives}
"""
