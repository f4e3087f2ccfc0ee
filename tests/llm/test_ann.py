from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from txloom.llm import ann
from txloom.llm.queries import op7_neighbours

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, score string, leaf string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)


def brute(rows, k=20):
    """By query: the k best as (score, id)."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        scores = (x[q] * x).sum(1)
        best = sorted((-scores[j], int(ids[j])) for j in range(len(ids)) if ids[j] != ids[q])[:k]
        out[int(ids[q])] = [(-s, i) for s, i in best]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        own = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["score"], r["vec_id"]))
    return out


def recall(got, expected):
    return np.mean([len({i for _, i in got.get(q, [])} & {i for _, i in own}) / max(1, len(own)) for q, own in expected.items()])


def in_order(got):
    return all(own == sorted(own, key=lambda x: (-x[0], x[1])) for own in got.values())


def test_recall_of_spread_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=24).tolist()) for k in range(6000)]
    got = found(ann.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0))
    assert len(got) == 300 and {len(x) for x in got.values()} == {20} and in_order(got)
    assert recall(got, brute(rows)) >= 0.9


def test_a_third_of_the_rows_are_one_vector(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 200)
    monkeypatch.setattr(ann, "PART_QUERIES", 30)
    rng = np.random.default_rng(2)
    same = (rng.integers(-4, 5, 8) / 4).tolist()
    rows = [(k, same if k % 3 == 0 else (rng.integers(-8, 9, 8) / 8).tolist()) for k in range(1500)]
    got = found(ann.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, open_share=1.0))
    assert got == brute(rows)  # all leaves opened: ties and copies as brute force has them


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (40, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]), (8, [1.0]), (None, [1.0, 1.0]), (60, [0.0, 0.0])]
    got = found(ann.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0))
    assert got == {0: [(1.0, 1), (1.0, 2), (0.0, 20)], 20: [(2.0, 1), (2.0, 2), (0.0, 0)]}


def test_no_usable_rows(spark):
    for rows in ([], [(0, None), (20, [0.0])]):
        got = ann.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0)
        assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.count() == 0


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_query(spark, name):
    sf = f"/root/testdata/{name}"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got, expected = found(op7_neighbours(spark, sf)), brute(rows)
    assert set(got) == set(expected) and in_order(got) and recall(got, expected) >= 0.9
    x = {i: np.array(v, np.float64) for i, v in rows}
    assert all(abs(s - x[q] @ x[i]) < 1e-12 for q, own in got.items() for s, i in own)
