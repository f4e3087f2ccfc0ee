from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from txloom.llm import negatives
from txloom.llm.gnat import Best, Tree


def plain(rows, anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    usable = {
        (i, label, tuple(math.floor(scale * c) for c in v))
        for i, label, v in rows
        if i is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v)
    }
    out = []
    for a in usable:
        if not anchor(a[0]):
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1] == a[1]) for b in usable if b is not a and len(a[2]) == len(b[2])]
        for p, positive, _ in sorted(s for s in scored if s[2])[:positives]:
            inside = sorted((n, i) for n, i, same in scored if not same and low * -p <= 100 * -n <= high * -p)
            out += [(a[0], positive, k + 1, i, -p, -n) for k, (n, i) in enumerate(inside[:negatives])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def table_of(spark, rows):
    frame = [(i, label, v, "x", 1.0, 2) for i, label, v in rows]
    return spark.createDataFrame(frame, "vec_id long, label int, embedding array<float>, key string, score double, dimension int")


def sample(n=700, seed=1, clusters=20, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, 8))
    x = (centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, 8)) * 0.3).astype(np.float32)
    return [(k, int(rng.integers(0, labels)), [float(c) for c in v]) for k, v in enumerate(x)]


def test_against_plain_version(spark):
    rows = sample()
    same = rows[50][2]
    rows += [(1000 + k, 1, same) for k in range(30)] + [(2000 + k, 2, same) for k in range(30)]  # a crowd of copies
    rows += [rows[100], rows[100], (150, 3, rows[7][2]), (150, 3, rows[8][2])]  # repeated rows, an id used again
    rows += [(None, 1, same), (1, None, same), (3000, 1, None), (3050, 1, []), (3100, 1, [1.0, None]), (3150, 2, [float("nan")] * 8), (3200, 2, [math.inf] * 8)]
    rows += [(4000, 1, [1.0, 2.0]), (4001, 1, [1.0, 1.0]), (4002, 2, [0.6, 1.0]), (4050, 0, [0.0] * 8), (4051, 0, [-1.0] * 8)]
    made = negatives.hard_negatives(table_of(spark, rows), F.col("vec_id") % 50 == 0)
    expected = plain(rows, lambda i: i % 50 == 0)
    assert rows_of(made) == expected and len(expected) > 100


def test_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 60)
    monkeypatch.setattr(negatives, "BATCH_QUERIES", 7)
    monkeypatch.setattr(negatives, "FIT_ROWS", 100)
    rows = sample(seed=4) + [(5000 + k, k % 3, [1.0] * 8) for k in range(200)]
    made = negatives.hard_negatives(table_of(spark, rows), F.col("vec_id") % 20 == 0, positives=3, negatives=4, window=(20, 90))
    assert rows_of(made) == plain(rows, lambda i: i % 20 == 0, 3, 4, 20, 90)


@pytest.mark.parametrize("rows", [[], [(50, 1, [1.0])], [(50, 1, [1.0]), (51, 1, [1.0])], [(50, 1, None)], [(50, 1, [1.0]), (51, 1, [2.0]), (52, 2, [1.5])]])
def test_small_tables(spark, rows):
    assert rows_of(negatives.hard_negatives(table_of(spark, rows), F.col("vec_id") % 50 == 0)) == plain(rows, lambda i: i % 50 == 0)


def test_copies_enter_the_index_as_a_handful(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(negatives, "blocks", lambda rows, f=negatives.blocks: (seen.append(rows.count()), f(rows))[1])
    rows = [(k, 1, [1.0, 0.5]) for k in range(500)] + [(1000 + k, 2, [0.7, 0.5]) for k in range(500)]
    assert rows_of(negatives.hard_negatives(table_of(spark, rows), F.col("vec_id") % 50 == 0)) == plain(rows, lambda i: i % 50 == 0)
    assert seen[0] <= 2 * 2 * 6


def test_ranges_eliminate_siblings():
    rng = np.random.default_rng(2)
    x = np.repeat(rng.normal(size=(40, 16)), 100, 0) + rng.normal(size=(4000, 16)) * 0.05
    x = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True))
    labels = np.repeat(np.arange(40) % 2, 100)
    tree = Tree(x.copy())
    queries = x[::50]
    best = Best(5, np.full(len(queries), -np.inf), np.full(len(queries), np.inf), labels[::50], same=True)
    best.rows(np.arange(4000), labels)
    tree.search(queries, best)
    leaves = -(-4000 // tree.leaf_rows)  # at least so many
    assert tree.leaves_seen < 0.2 * leaves * len(queries)
    products = queries @ x.T
    for k, row in enumerate(products):
        fit = np.flatnonzero(labels == labels[::50][k])
        assert best.ids[k].tolist() == fit[np.lexsort((fit, -row[fit]))][:5].tolist()


def test_tree_holds_every_row_once():
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(3000, 4)) * 3)
    tree = Tree(x.copy())
    assert sorted(tree.order.tolist()) == list(range(3000)) and (tree.x == x[tree.order]).all()
