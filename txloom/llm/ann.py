"""Nearest neighbours by largest inner product: a forest of random-projection trees.

Trees are fitted on a bounded sample; every row is indexed, that is, routed to a leaf of each tree. A query
opens leaves of all trees in the order of one shared priority queue, keyed by the smallest margin on the way
to a node. Rows and queries meet in parts of the forest with a bounded number of rows, are scored exactly,
and the best of all parts are ranked.

An inner product is made a distance by one more dimension, sqrt(M^2 - |x|^2) with the largest norm M, which
is 0 for queries. The sampled rows in the leaves that a query opens are candidates like any others there, so
the k-th best id of them bounds its k-th best from below: worse rows need not leave their part. All cuts count
ids, each at its best score, as an id may have many rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txloom.llm.shared import dropped, stored

TREES = 8
#: Rows of a leaf, about; sampled rows a leaf must hold bound the number of leaves.
LEAF_ROWS = 100
SAMPLED_LEAF_ROWS = 16
#: Rows that trees are fitted on, at most: those whose hashes are smallest.
FIT_ROWS = 20_000
#: Share of all leaves that a query opens, and how many at least.
OPEN_SHARE = 0.15
OPEN_LEAVES = 64
#: Rows and queries that a task holds at once.
PART_ROWS = 8_192
PART_QUERIES = 20_000
#: Rows that are scored against queries in one product.
_SCORED_AT_ONCE = 1 << 22


@dataclass(frozen=True)
class Forest:
    """Inner nodes: normal, offset, children (>= 0 a node, < 0 a leaf ~child). Roots as children."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    roots: list[int]
    leaves: int
    largest: float
    dimension: int

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0, self.largest**2 - (x * x).sum(1)))
        return np.column_stack([x, rest])

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        x = self.lifted(x)
        out = np.empty((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            todo = [(root, np.arange(len(x)))]
            while todo:
                node, at = todo.pop()
                if node < 0:
                    out[at, t] = ~node
                else:
                    above = x[at] @ self.normals[node] > self.offsets[node]
                    todo += [(int(self.children[node, 0]), at[above]), (int(self.children[node, 1]), at[~above])]
        return out

    def search(self, q: np.ndarray, leaves: int, enough: Callable[[int, list[int]], bool]) -> list[list[int]]:
        """The leaves that each query opens, nearest first: `leaves`, then twice as many until they are `enough` for it or all."""
        margins = np.column_stack([q, np.zeros(len(q))]) @ self.normals.T - self.offsets
        children = self.children.tolist()
        found = []
        for n, margin in enumerate(margins):
            margin, queue, own, limit = margin.tolist(), [(-np.inf, root) for root in self.roots], [], leaves
            while True:
                while queue and len(own) < limit:
                    key, node = heapq.heappop(queue)
                    if node < 0:
                        own.append(~node)
                    else:
                        m, (above, below) = margin[node], children[node]
                        heapq.heappush(queue, (max(key, -m), above))
                        heapq.heappush(queue, (max(key, m), below))
                if enough(n, own) or not queue:
                    break
                limit *= 2
            found.append(own)
        return found


def fit_forest(sample: np.ndarray, leaves: int, largest: float, trees: int = TREES, seed: int = 0) -> Forest:
    """Trees with about `leaves` leaves each. Equal rows are never parted: they share a leaf."""
    rng = np.random.default_rng(seed)
    shape = Forest(np.empty((0, 0)), np.empty(0), np.empty((0, 2)), [], 0, largest, sample.shape[1])
    x = shape.lifted(sample)
    smallest = max(SAMPLED_LEAF_ROWS, len(x) / max(1, leaves))
    normals, offsets, children, n_leaves = [], [], [], 0

    def split(at: np.ndarray) -> tuple[np.ndarray, float, np.ndarray] | None:
        for _ in range(4):
            a, b = x[rng.choice(at, 2, replace=False)]
            for _ in range(3):  # two means
                above = x[at] @ (a - b) > (a @ a - b @ b) / 2
                if above.all() or not above.any():
                    break
                a, b = x[at[above]].mean(0), x[at[~above]].mean(0)
            size = np.linalg.norm(a - b)
            if size > 0:
                normal = (a - b) / size
                p = x[at] @ normal
                middle = np.median(p)
                for offset in (middle, np.nextafter(middle, -np.inf), (a + b) @ normal / 2):
                    above = p > offset
                    if above.any() and not above.all():
                        return normal, float(offset), above
        return None

    def grow(at: np.ndarray) -> int:
        nonlocal n_leaves
        cut = split(at) if len(at) >= 2 * smallest else None
        if cut is None:
            n_leaves += 1
            return ~(n_leaves - 1)
        node = len(normals)
        normals.append(cut[0])
        offsets.append(cut[1])
        children.append([0, 0])
        children[node] = [grow(at[cut[2]]), grow(at[~cut[2]])]
        return node

    roots = [grow(np.arange(len(x))) for _ in range(trees)]
    return Forest(
        np.array(normals).reshape(len(normals), x.shape[1]), np.array(offsets), np.array(children, np.int64).reshape(-1, 2), roots, n_leaves, largest, sample.shape[1]
    )


def _usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id, v: rows with an id and a vector that is not null, not zero, with finite components only."""
    v = F.col(vector_column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(finite & some, F.lit(False))
    )


def _matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _parts(counts: dict[int, int], leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """First part and number of parts of each leaf: leaves share a part up to PART_ROWS rows, a larger one has parts of its own."""
    first, many = np.zeros(leaves, np.int64), np.ones(leaves, np.int64)
    part, held = 0, 0
    for leaf in range(leaves):
        n = counts.get(leaf, 0)
        if held and held + n > PART_ROWS:
            part, held = part + 1, 0
        many[leaf] = max(1, -(-n // PART_ROWS))
        first[leaf] = part
        held += n
        if many[leaf] > 1:
            part, held = part + int(many[leaf]), 0
    return first, many


def _starts(ids: np.ndarray) -> np.ndarray:
    """Where each id begins in sorted ids."""
    return np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])


def neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    fit_rows: int = FIT_ROWS,
    open_share: float = OPEN_SHARE,
) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` best found of each row for which `is_query` holds, itself left out.

    `is_query` is an expression over vec_id. Ties go to the smaller id. Vectors null, zero, with null or non-finite components,
    of another dimension than most of the sample, or without id take no part. Of rows with one id, all are
    candidates for other queries as one id with its best score, and none for a query of that id; equal rows
    are one. A query whose leaves hold fewer than `k` sampled ids opens more. Fewer than `k` candidates give
    fewer rows, an empty table none.
    """
    spark = vectors.sparkSession
    rows = stored(_usable(vectors, id_column, vector_column).dropDuplicates(["vec_id", "v"]), "forest-rows")
    sampled = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(fit_rows).toArrow().to_pandas()  # at most fit_rows rows
    sizes = sampled["v"].map(len) if len(sampled) else None
    dimension = int(sizes.mode()[0]) if len(sampled) else 0
    sampled = sampled[sizes == dimension] if len(sampled) else sampled
    usable = rows.where(F.size("v") == dimension)
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    total, largest = usable.agg(F.count("*"), F.sqrt(F.max(squares))).first()
    if not total:
        dropped(rows)
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.stack(sampled["v"].to_numpy()).astype(np.float64)
    forest = fit_forest(sample, -(-total // LEAF_ROWS), float(largest))
    opened = max(OPEN_LEAVES, round(open_share * forest.leaves))
    kind = usable.schema["v"].dataType.simpleString()
    by_id = np.argsort(sampled["vec_id"].to_numpy(), kind="stable")
    shared = spark.sparkContext.broadcast((forest, sample[by_id], forest.route(sample[by_id]), sampled["vec_id"].to_numpy()[by_id]))  # bounded by fit_rows

    def index(batches: Iterable) -> Iterator[pa.RecordBatch]:
        forest = shared.value[0]
        for batch in batches:
            if batch.num_rows:
                leaves = forest.route(_matrix(batch.column("v"), dimension))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(list(leaves), pa.list_(pa.int64()))], ["vec_id", "v", "leaves"])

    indexed = stored(usable.mapInArrow(index, f"vec_id long, v {kind}, leaves array<long>"), "forest-index")
    dropped(rows)
    placed = indexed.select("vec_id", "v", F.explode("leaves").alias("leaf"))
    # one row a leaf, of which there are at most trees x sampled rows
    counts = {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    layout = spark.sparkContext.broadcast(_parts(counts, forest.leaves))
    queries = indexed.where(is_query).select("vec_id", "v")
    chunks = queries.count() // PART_QUERIES + 1

    def place(batches: Iterable) -> Iterator[pa.RecordBatch]:
        first, many = layout.value
        for batch in batches:
            leaf = batch.column("leaf").to_numpy()
            salt = batch.column("salt").to_numpy() % many[leaf]
            yield pa.RecordBatch.from_arrays([pa.array(first[leaf] + salt), *(batch.column(c) for c in ("leaf", "vec_id", "v"))], ["part", "leaf", "vec_id", "v"])

    salted = placed.withColumn("salt", F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)))
    rows_ = salted.mapInArrow(place, f"part long, leaf long, vec_id long, v {kind}").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def ask(batches: Iterable) -> Iterator[pa.RecordBatch]:
        forest, sample, sample_leaves, names = shared.value
        first, many = layout.value
        starts = _starts(names)
        for batch in batches:
            if not batch.num_rows:
                continue
            q, ids = _matrix(batch.column("v"), dimension), batch.column("vec_id").to_numpy()
            scores = q @ sample.T
            scores[ids[:, None] == names[None, :]] = -np.inf
            bound, open_ = np.full(len(q), -np.inf), np.zeros(forest.leaves, bool)
            part, which, leaf = [], [], []

            def enough(n: int, own: list[int]) -> bool:
                open_[own] = True
                held = open_[sample_leaves].any(1)
                open_[own] = False
                if len(starts) == len(names):
                    met = scores[n][held]
                else:
                    met = np.maximum.reduceat(np.where(held, scores[n], -np.inf), starts)
                kth = np.partition(met, -k)[-k] if len(met) >= k else -np.inf
                bound[n] = kth - 1e-9 * (1 + abs(kth))
                return kth > -np.inf

            for n, own in enumerate(forest.search(q, opened, enough)):
                by_part: dict[int, list[int]] = {}
                for x in own:
                    for p in range(first[x], first[x] + many[x]):
                        by_part.setdefault(int(p), []).append(x)
                part += by_part
                which += [n] * len(by_part)
                leaf += by_part.values()
            take = pa.array(which, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array(leaf, pa.list_(pa.int64())), batch.column("vec_id").take(take), batch.column("v").take(take), pa.array(bound).take(take)],
                ["part", "leaves", "query_id", "q", "bound"],
            )

    asked = queries.mapInArrow(ask, f"part long, leaves array<long>, query_id long, q {kind}, bound double").withColumn(
        "chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int")
    )

    def rank(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not asked.num_rows or not held.num_rows:
            return empty
        q, v = _matrix(asked.column("q"), dimension), _matrix(held.column("v"), dimension)
        q_id, v_id, bound = (t.column(c).to_numpy() for t, c in ((asked, "query_id"), (held, "vec_id"), (asked, "bound")))
        leaf = held.column("leaf").to_numpy()
        # what a product in another order may differ by
        slack = 1e-15 * dimension * np.sqrt((q * q).sum(1)) * np.sqrt((v * v).sum(1).max())
        wanted = asked.column("leaves").combine_chunks()
        q_of, q_leaf = wanted.value_parent_indices().to_numpy(), wanted.flatten().to_numpy()
        q_of = q_of[np.argsort(q_leaf, kind="stable")]
        q_leaf = np.sort(q_leaf)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for x in np.unique(leaf):
            at = np.flatnonzero(leaf == x)
            at = at[np.argsort(v_id[at], kind="stable")]
            starts = _starts(v_id[at])
            repeated = len(starts) < len(at)
            copies = np.diff(np.r_[starts, len(at)])
            mine = q_of[np.searchsorted(q_leaf, x) : np.searchsorted(q_leaf, x, side="right")]
            step = max(1, _SCORED_AT_ONCE // len(at))
            for a in range(0, len(mine), step):
                m = mine[a : a + step]
                scores = q[m] @ v[at].T
                scores[(q_id[m][:, None] == v_id[at][None, :]) | (scores < bound[m][:, None])] = -np.inf
                if repeated or len(starts) > k and np.isneginf(bound[m]).any():
                    top = np.maximum.reduceat(scores, starts, axis=1)
                    least = top - slack[m][:, None]
                    if len(starts) > k:
                        least = np.maximum(least, (np.partition(top, -k, axis=1)[:, -k] - slack[m])[:, None])
                    scores[scores < np.repeat(least, copies, axis=1)] = -np.inf
                r, c = np.nonzero(scores > -np.inf)
                exact = (q[m[r]] * v[at[c]]).sum(1)
                if repeated:
                    order = np.lexsort((-exact, v_id[at[c]], r))
                    r, c, exact = r[order], c[order], exact[order]
                    first = np.r_[True, (r[1:] != r[:-1]) | (v_id[at[c[1:]]] != v_id[at[c[:-1]]])][: len(r)]
                    r, c, exact = r[first], c[first], exact[first]
                order = np.lexsort((v_id[at[c]], -exact, r))
                r, c, exact = r[order], c[order], exact[order]
                firsts = np.searchsorted(r, r)
                best = np.arange(len(r)) - firsts < k
                found.append((q_id[m[r[best]]], v_id[at[c[best]]], exact[best]))
        if not found:
            return empty
        return pa.table({n: np.concatenate(c) for n, c in zip(("query_id", "vec_id", "score"), zip(*found, strict=True), strict=True)})

    scored = asked.groupBy("part", "chunk").cogroup(rows_.groupBy("part", "chunk")).applyInArrow(rank, "query_id long, vec_id long, score double")
    best = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
