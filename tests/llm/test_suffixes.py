from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from txloom.llm import suffixes
from txloom.llm.queries import op10_repeated_spans

SF = "/root/testdata/sf0.001"


def plain(pairs, width=50):
    """Spans of words that lie in a run of `width` words which an earlier place holds too; first come by id, checksum, word."""
    texts = sorted({(i is not None, i or 0, suffixes.text_digest(t or ""), t or "") for i, t in pairs})
    seen, out = set(), []
    for has, i, digest, text in texts:
        words = text.encode().split()
        covered = set()
        for k in range(len(words) - width + 1):
            run = tuple(words[k : k + width])
            if run in seen:
                covered.update(range(k, k + width))
            seen.add(run)
        for k in sorted(covered):
            if out and tuple(out[-1][:2]) == (i if has else None, digest) and out[-1][3] == k:
                out[-1][3] = k + 1
            else:
                out.append([i if has else None, digest, k, k + 1])
    return sorted(map(tuple, out), key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "digest", "start_word", "end_word").collect()), key=str)


def made(seed, n):
    """Texts with shared passages of 40 to 120 words at random places, some cut, some side by side, and whole copies."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    passages = [[word() for _ in range(rng.randrange(40, 120))] for _ in range(5)] + [["la"] * 90]
    pairs = []
    for k in range(n):
        words = [word() for _ in range(rng.randrange(0, 80))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(0, 12)
            words += p[a : len(p) - rng.randrange(0, 12)] + [word() for _ in range(rng.randrange(0, 30))]
        pairs.append((rng.randrange(10**6) - 500, " ".join(words)))
        if k % 9 == 0:
            pairs.append((rng.randrange(10**6), pairs[-1][1]))
    return pairs


def test_spans_of_shared_passages(spark, docs_of):
    pairs = made(3, 90)
    assert found(suffixes.repeated_spans(docs_of(*pairs))) == plain(pairs)


def test_odd_rows(spark, docs_of):
    passage = " ".join(f"p{k}" for k in range(60))
    long = " ".join(f"q{k % 7919} r{k}" for k in range(40_000))
    pairs = [(1, None), (2, ""), (3, passage), (3, passage), (None, "x " + passage), (4, passage + "\n\n" + passage), (5, "short"), (6, long), (7, long), (3, passage + " other text")]
    assert found(suffixes.repeated_spans(docs_of(*pairs))) == plain(pairs)


def test_empty_table(spark, docs_of):
    assert found(suffixes.repeated_spans(docs_of((1, "x")).limit(0))) == []


def test_cut():
    assert suffixes.cut("  a b\nc  d e ", [(1, 3)]) == "  a  d e "
    assert suffixes.cut("a b", [(0, 2)]) == ""
    assert suffixes.cut("é b ñ", [(1, 2)]) == "é ñ"


def test_without_repeats_keeps_rows_and_columns(spark, docs_of):
    passage = " ".join(f"p{k}" for k in range(60))
    docs = docs_of((1, passage), (2, "before " + passage + " after"), (None, passage), (3, None), (4, "clean"))
    out = suffixes.without_repeats(docs, suffixes.repeated_spans(docs))
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.where(F.col("text").isNotNull()).collect()) == [(0, passage), (1, ""), (2, "before after"), (4, "clean")]
    assert out.where("text IS NULL").count() == 1


def test_minimisers_are_content_selected():
    rng = np.random.default_rng(0)
    core = rng.integers(0, 2**63, 500).astype(np.uint64)
    at = suffixes.minimisers(core, 31)
    assert all(((at >= k) & (at < k + 31)).any() for k in range(470))
    inner = suffixes.minimisers(core[100:400], 31) + 100
    assert set(inner) <= set(at)


def test_query(spark):
    pairs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(op10_repeated_spans(spark, SF)) == plain(pairs)


def test_texts_without_id_are_told_apart(spark, docs_of):
    """Two texts with one CRC-32 and no id, one of them with a passage that occurs before."""
    draw, seen = random.Random(1), {}
    vocabulary = [f"v{k}" for k in range(900)]
    shared = " ".join(f"s{k}" for k in range(60))
    while True:
        text = " ".join(draw.choices(vocabulary, k=4))
        other = seen.setdefault(zlib.crc32(text.encode()), text)
        if other != text and len(other) == len(text):
            break
    # equal ends after texts of one length and CRC-32 keep the CRC-32 equal
    a, b = (f"{x} {shared}" for x in (text, other))
    assert a != b and zlib.crc32(a.encode()) == zlib.crc32(b.encode())
    pairs = [(None, a), (None, b), (1, "clean " + " ".join(vocabulary[:70])), (None, "clean too " + " ".join(vocabulary[100:171]))]
    frame = docs_of(*pairs)
    spans = suffixes.repeated_spans(frame)
    assert found(spans) == sorted(plain(pairs), key=str)
    kept = sorted(len(r["text"].split()) for r in suffixes.without_repeats(frame, spans).collect())
    assert kept == [4, 64, 71, 73]
