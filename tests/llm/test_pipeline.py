from __future__ import annotations

import re

import corpus_pipeline
import pytest
from test_jaccard import shingles
from test_suffixes import plain as plain_spans
from txloom.llm import pii
from txloom.llm.shared import stored

SF = "/root/testdata/sf0.001"
BY_NAME = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark):
    """The table before and after each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_order_of_stages():
    assert list(BY_NAME) == ["toxicity", "near-copies", "repeats", "personal-data", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_toxic_documents_go_and_clean_ones_stay(spark, steps):
    before, after = steps["toxicity"]
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = set(by_id(before)) - set(by_id(after))
    assert gone and after.columns == before.columns
    assert sum(toxic.get(i) == 0 for i in gone) <= 0.02 * len(toxic)


def test_no_linked_pair_is_left_and_each_gone_document_has_one(steps):
    before, after = (by_id(x) for x in steps["near-copies"])
    sets = {i: shingles(r["text"]) for i, r in before.items()}
    near = lambda a, b: bool(a) and 100 * len(a & b) >= 80 * len(a | b)
    kept = sorted(after)
    assert not [(i, j) for i in kept for j in kept if i < j and near(sets[i], sets[j])]
    assert all(any(near(sets[i], sets[j]) for j in before if j != i) for i in set(before) - set(after))
    assert all(after[i] == before[i] for i in kept)


def test_repeats_are_cut(steps):
    before, after = (by_id(x) for x in steps["repeats"])
    spans = {}
    for i, _, a, b in plain_spans([(i, r["text"]) for i, r in before.items()]):
        spans.setdefault(i, []).append((a, b))
    assert set(before) == set(after)
    for i, r in before.items():
        words = r["text"].split() if i in spans else None
        if words is None:
            assert after[i]["text"] == r["text"]
        else:
            words = r["text"].encode().split()
            gone = {k for a, b in spans[i] for k in range(a, b)}
            assert after[i]["text"].encode().split() == [w for k, w in enumerate(words) if k not in gone]


def test_personal_data_is_hidden(steps):
    before, after = (by_id(x) for x in steps["personal-data"])
    assert set(before) == set(after)
    for i, r in before.items():
        for value in re.findall(pii.IP + "|" + pii.PHONE, r["text"]):
            assert value not in after[i]["text"]


def test_every_document_is_packed(steps):
    before, after = steps["packing"]
    assert {r["doc_id"] for r in after.select("doc_id").collect()} == {r["doc_id"] for r in before.select("doc_id").collect()}


@pytest.mark.parametrize("name", list(BY_NAME))
def test_stage_on_odd_rows_and_on_none(spark, name):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, None), (2, ""), (3, passage), (3, passage), (None, passage), (None, None), (4, "mail a.b@mail1.example.com " + passage), (5, " \n"), (5, " \n")]
    docs = spark.createDataFrame([(i, t, None, "s", None, "e") for i, t in rows], schema)
    out = BY_NAME[name](spark, docs, SF)
    kept = out.collect()
    if name == "packing":
        assert len(kept) == len(rows)
        return
    assert out.columns == docs.columns
    # the join of near copies keeps one row of document 3 and drops document 4, which only adds two words
    assert len(kept) == len(rows) - (2 if name == "near-copies" else 0)
    assert BY_NAME[name](spark, docs.limit(0), SF).count() == 0


def test_near_copies_are_judged_by_row(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    other = " ".join(f"q{k}" for k in range(60))
    rows = [(1, passage), (2, passage + " tail"), (2, other), (3, other), (2, other), (4, None), (4, passage), (5, "single")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    kept = sorted(((r["doc_id"], r["text"]) for r in stages["near-copies"](spark, docs, "").collect()), key=str)
    assert kept == sorted([(1, passage), (2, other), (4, None), (5, "single")], key=str)
