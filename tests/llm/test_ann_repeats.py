"""Ids with many rows: every cut counts ids, not rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_ann import found, in_order, table
from txloom.llm import ann


def best_by_id(rows, k=20):
    """By query id: the k best ids as (score, id), each id at the best score of its rows."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        own = out.setdefault(int(ids[q]), {})
        for i, s in zip(ids.tolist(), (x[q] * x).sum(1).tolist(), strict=True):
            if i != ids[q]:
                own[i] = max(s, own.get(i, -np.inf))
    return {q: [(s, i) for i, s in sorted(own.items(), key=lambda p: (-p[1], p[0]))[:k]] for q, own in out.items()}


def eighths(rng, n):
    return (rng.integers(-8, 9, (n, 8)) / 8).tolist()


@pytest.mark.parametrize("rows_of_a_part", [200, 8192])
def test_every_row_twice(spark, monkeypatch, rows_of_a_part):
    monkeypatch.setattr(ann, "PART_ROWS", rows_of_a_part)
    rows = list(enumerate(eighths(np.random.default_rng(3), 600))) * 2
    got = found(ann.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, open_share=1.0))
    assert {len(x) for x in got.values()} == {20} and got == best_by_id(rows)


@pytest.mark.parametrize("fit_rows", [300, 20_000])
def test_one_id_has_most_rows_and_scores_best(spark, monkeypatch, fit_rows):
    monkeypatch.setattr(ann, "PART_ROWS", 400)
    rng = np.random.default_rng(4)
    rows = list(enumerate(eighths(rng, 400))) + [(7, [4 * c for c in v]) for v in eighths(rng, 3000)] + [(20, v) for v in eighths(rng, 50)]
    got = found(ann.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, open_share=1.0, fit_rows=fit_rows))
    assert got == best_by_id(rows)


def test_leaves_of_one_id_alone_are_not_enough(spark, monkeypatch):
    monkeypatch.setattr(ann, "OPEN_LEAVES", 4)
    rng = np.random.default_rng(5)
    near = rng.normal([9, 0, 0, 0, 0, 0], 1, (4000, 6))
    rows = [(7, v) for v in near.tolist()] + [(k, v) for k, v in enumerate(rng.normal([-9, 0, 0, 0, 0, 0], 1, (300, 6)).tolist()) if k != 7]
    rows += [(1000, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    got = found(ann.neighbours(table(spark, rows), F.col("vec_id") == 1000, open_share=0.01))
    assert len(got[1000]) == 20 and got[1000][0][1] == 7 and in_order(got)
