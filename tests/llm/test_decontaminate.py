from __future__ import annotations

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from txloom.llm import decontaminate
from txloom.llm.decontaminate import classes_of

WORDS = re.compile("[0-9a-z\x80-\U0010ffff]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def plain(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - width + 1)) if w else ():
            windows.setdefault(tuple(w[k : k + width]), set()).add(None if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (names := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= names
        out.append((doc_id, len(w), sorted(hit), sorted(found - {None})))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, [k for a, b in r.spans for k in range(a, b)], list(r["items"])) for r in df.collect()), key=repr)


def items_of(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, pattern string, part int")


def sample(seed=5):
    rng = np.random.default_rng(seed)
    text = lambda n: " ".join(rng.choice([f"w{k}" for k in range(300)] + ["é", "漢"], n))
    items = [(k, text(int(rng.integers(8, 60)))) for k in range(30)]
    items += [(40, items[0][1]), (41, "Only! seven, words are in this-one"), (42, None), (43, ""), (44, "..."), (None, text(12)), (2, text(14))]
    docs = []
    for k in range(80):
        a, b = text(int(rng.integers(0, 50))), text(int(rng.integers(0, 50)))
        passage = (items[k % len(items)][1] or "").split(" ")
        cut = passage[int(rng.integers(0, 5)) : 5 + int(rng.integers(0, 40))]
        docs.append((k, f"{a} {'-'.join(cut).upper() if k % 3 else ' '.join(cut)}\n{b}"))
    docs += [(100, None), (101, ""), (102, "?!"), (None, items[5][1]), (7, items[1][1]), (7, items[1][1]), (103, text(20_000) + " " + items[9][1])]
    docs += [(104, " ".join(["w1"] * 400)), (105, "x" * 5000 + " " + items[3][1]), (106, "Xonly seven words are in this one"), (107, "only seven words are in this one")]
    return docs, items + [(50, " ".join(["w1"] * 30))]


def test_against_plain_version(spark, docs_of):
    docs, items = sample()
    found = decontaminate.contamination(docs_of(*docs).withColumnRenamed("key", "items"), items_of(spark, items))
    expected = plain(docs, items)
    assert rows_of(found) == expected and sum(bool(r[2]) for r in expected) > 40


def test_parts_and_batches_change_nothing(spark, docs_of, monkeypatch):
    docs, items = sample(6)
    monkeypatch.setattr(decontaminate, "BATCH_BYTES", 4000)
    found = decontaminate.contamination(docs_of(*docs), items_of(spark, items), part_patterns=40)
    assert rows_of(found) == plain(docs, items)


def test_parts_are_even_under_equal_items(spark):
    items = [(k, " ".join(f"w{j}" for j in range(30))) for k in range(200)]
    made = decontaminate.patterns(items_of(spark, items))
    folder, numbers = decontaminate.parted(made, 500)
    sizes = [sum(len(i) for c in decontaminate.Parts(folder).part(n) for b in c.buckets.values() for s in b.values() for i in s.values()) for n in numbers]
    assert sum(sizes) == 200 * 21 and max(sizes) < 1.3 * 500


def test_short_items_and_repeats(spark, docs_of):
    items = [(1, "a"), (2, "a b"), (10, "B c!"), (3, "漢字")]
    docs = [(1, "a b c a"), (2, "ab ba cab"), (3, "x 漢字 y"), (4, "漢字漢字"), (5, "A-B")]
    assert rows_of(decontaminate.contamination(docs_of(*docs), items_of(spark, items))) == plain(docs, items)


def test_empty_tables(spark, docs_of):
    docs, items = sample()
    assert decontaminate.contamination(docs_of(*docs[:0]), items_of(spark, items)).collect() == []
    assert rows_of(decontaminate.contamination(docs_of(*docs), items_of(spark, items[:0]))) == plain(docs, [])


def test_documents_without_hits_stay(spark, docs_of):
    docs, items = sample()
    df = docs_of(*docs)
    kept = decontaminate.without_hits(df, decontaminate.contamination(df, items_of(spark, items)))
    clean = {r[0] for r in plain(docs, items) if not r[2]} - {r[0] for r in plain(docs, items) if r[2]}
    assert {r.doc_id for r in kept.collect()} - {None} == clean - {None} and kept.columns == df.columns


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab ", min_size=1, max_size=9), max_size=12), st.text("ab ", max_size=60))
def test_search_finds_every_occurrence(patterns, text):
    found = {p.encode(): [p] for p in patterns}
    got = {(a, b, p) for c in classes_of(found) for a, b, p, _ in c.occurrences(text.encode())}
    assert got == {(k, k + len(p), p) for p in found for k in range(len(text)) if text.encode().startswith(p, k)}
