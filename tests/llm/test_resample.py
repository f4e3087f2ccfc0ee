from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from txloom.llm import resample
from txloom.llm.resample import Features, Head

WORDS = re.compile("[0-9a-z\x80-\U0010ffff]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return len(w), w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def plain(docs, target, percent=25, min_words=20, seed=7):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = [0] * 10_000, [0] * 10_000
    for table, counts in ((docs, s), ([(None, x) for x in target], t)):
        for _, text in table:
            for f in features(text)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000)))) for b in range(10_000)]
    rows = []
    for doc_id, text in docs:
        n, found = features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, n, len(found), weight, score))
    order = sorted((r for r in rows if r[1] >= min_words and r[0] is not None), key=lambda r: (-r[4], *r[:4]))
    drawn = order[: percent * len(order) // 100]
    out = [(*r, k + 1) for k, r in enumerate(drawn)]
    for r in drawn:
        rows.remove(r)
    return sorted([*out, *((*r, None) for r in rows)], key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.fixture(scope="module")
def made(spark, docs_of):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(400)] + ["Straße", "漢字" * 30, "été", "A" * 70, "x"]
    share = 1 / np.arange(1, len(vocabulary) + 1)
    text = lambda n: " ".join(rng.choice(vocabulary, n, p=share / share.sum()))
    docs = [(k, text(int(rng.integers(0, 60)))) for k in range(120)]
    docs += [(200, None), (201, ""), (202, "--- !!"), (203, text(30_000)), (None, text(40)), (7, text(25)), (7, text(25))]
    docs += [(300, docs[3][1] + " " + docs[4][1])] * 40  # a hot repeated row
    target = [text(50) for _ in range(5)] + [None, ""]
    return docs, target


def target_of(spark, target):
    return spark.createDataFrame([(k, t, "c") for k, t in enumerate(target)], "item_id long, text string, bucket string")


def test_against_plain_version(spark, docs_of, made):
    docs, target = made
    df = docs_of(*docs).withColumnRenamed("score", "weight").withColumnRenamed("key", "rank").repartition(5)
    assert rows_of(resample.resample(df, target_of(spark, target))) == plain(docs, target)


def test_head_changes_nothing(spark, docs_of, made, monkeypatch):
    docs, target = made
    expected = plain(docs, target)
    monkeypatch.setattr(resample, "HEAD_WORDS", 3)
    monkeypatch.setattr(resample, "HEAD_PAIRS", 2)
    assert rows_of(resample.resample(docs_of(*docs), target_of(spark, target))) == expected
    monkeypatch.setattr(resample, "HEAD_WORDS", 0)
    assert rows_of(resample.resample(docs_of(*docs), target_of(spark, target))) == expected


def test_head_holds_frequent_words_and_pairs(spark, docs_of, made):
    head = resample.head_of(docs_of(*made[0]))
    assert b"w0" in head.words and len(head.pairs) > 50
    for key, bucket in zip(head.pairs.tolist(), head.buckets.tolist(), strict=True):
        assert bucket == zlib.crc32(head.words[key >> 32] + b" " + head.words[key & 0xFFFFFFFF]) % 10_000


def test_empty_tables(spark, docs_of, made):
    docs, target = made
    assert rows_of(resample.resample(docs_of(*docs[:0]), target_of(spark, target))) == []
    assert rows_of(resample.resample(docs_of(*docs), target_of(spark, target[:0]))) == plain(docs, [])
    few = [(1, "one two"), (2, None)]
    assert rows_of(resample.resample(docs_of(*few), target_of(spark, target))) == plain(few, target)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=1, max_size=90), max_size=12), max_size=6), st.integers(0, 4))
def test_crc_of_pairs(texts, n_head):
    words = [w for t in texts for w in t]
    first = list(dict.fromkeys(words))[:n_head]
    numbers = {w: k for k, w in enumerate(first)}
    pairs = {(a, b) for t in texts for a, b in zip(t, t[1:]) if a in numbers and b in numbers}
    known = sorted((numbers[a] << 32 | numbers[b], zlib.crc32(a + b" " + b) % 97) for a, b in pairs)
    head = Head(first, np.array([zlib.crc32(w) for w in first], np.uint32), np.array([k for k, _ in known], np.int64), np.array([b for _, b in known], np.int64))
    single, double, n, m = Features(head, 97).buckets(texts)
    assert single.tolist() == [zlib.crc32(w) % 97 for w in words]
    assert double.tolist() == [zlib.crc32(a + b" " + b) % 97 for t in texts for a, b in zip(t, t[1:])]
    assert n.tolist() == [len(t) for t in texts] and m.tolist() == [max(len(t) - 1, 0) for t in texts]


def test_tail_is_bounded(monkeypatch):
    monkeypatch.setattr(resample, "TAIL_WORDS", 10)
    known = Features(Head(), 1000)
    for k in range(30):
        texts = [[b"%d" % (k * 20 + j) for j in range(20)]]
        single, double, _, _ = known.buckets(texts)
        assert single.tolist() == [zlib.crc32(w) % 1000 for w in texts[0]]
        assert double.tolist() == [zlib.crc32(a + b" " + b) % 1000 for a, b in zip(texts[0], texts[0][1:])]
    assert len(known) <= 30
