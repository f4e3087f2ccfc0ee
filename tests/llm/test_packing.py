from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from txloom.llm import packing
from txloom.llm.queries import op9_packed_sequences
from txloom.llm.tokens import read_tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
WHOLE.encode_special_tokens = True
SF = "/root/testdata/sf0.001"


def ids(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 0]


def gapless(rows, capacity):
    """Pieces fill their sequences from 0 on without gaps; sequences are numbered from 0."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(by) == list(range(len(by)))
    for pieces in by.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


@pytest.mark.parametrize("seed", range(5))
def test_patterns_hold_every_length_once(seed):
    rng = random.Random(seed)
    histogram = {rng.randrange(1, 65): rng.randrange(1, 2000) for _ in range(rng.randrange(1, 40))}
    found = packing.patterns(histogram, 64)
    held = Counter()
    for pattern, packs in found:
        assert packs > 0 and sum(pattern) <= 64 and list(pattern) == sorted(pattern, reverse=True)
        for length in pattern:
            held[length] += packs
    assert held == histogram


def test_little_padding():
    histogram = {n: 1000 for n in range(1, 1024)}
    found = packing.patterns(histogram)
    packs = sum(p for _, p in found)
    assert sum(n * c for n, c in histogram.items()) / (1024 * packs) > 0.99


def test_pack_keeps_columns_and_hot_lengths(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 50)
    rows = [(k, None if k % 5 else "x", 7 if k % 3 else k % 20 + 1) for k in range(2000)]
    pieces = spark.createDataFrame(rows, "first long, chunk string, length long")
    got = packing.pack(pieces, 20).collect()
    gapless(got, 20)
    assert sorted((r["first"], r["chunk"] or "", r["length"]) for r in got) == sorted((a, b or "", c) for a, b, c in rows)


def test_odd_rows(spark, docs_of):
    given = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, "word " * 3000)]
    pieces = packing.token_pieces(docs_of(*given), read_tokenizer(PATH), 0)
    got = packing.pack(pieces).collect()
    gapless(got, 1024)
    assert sum(r["length"] for r in got) == sum(len(ids(t)) for _, t in given)
    assert sorted((r["doc_id"] or 0, r["start"], r["length"]) for r in got if r["doc_id"] != 4) == [(0, 0, 2), (1, 0, 1), (2, 0, 1), (3, 0, 3), (3, 0, 3)]


def test_empty_table(spark, docs_of):
    assert packing.pack(packing.token_pieces(docs_of((1, "x")).limit(0), read_tokenizer(PATH), 0)).count() == 0


def test_lengths_out_of_range_are_refused(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(0,)], "length long"))


def test_query(spark):
    got = op9_packed_sequences(spark, SF).collect()
    sequences = gapless(got, 1024)
    pieces = {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(pieces) == len(rows)
    total = 0
    for row in rows:
        every = ids(row["text"])
        total += len(every)
        end = 0
        for r in sorted(pieces[row["doc_id"]], key=lambda r: r["start"]):
            assert r["start"] == end and r["doc_tokens"] == len(every)
            end += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(every[r["start"] : end], "<u4").tobytes())
        assert end == len(every)
    assert total / (1024 * sequences) > 0.95


def test_padding(spark):
    packed = spark.createDataFrame([(0, 600), (0, 424), (1, 512), (2, 100)], "sequence_id long, length long")
    assert tuple(packing.padding(packed).select(F.col("sequences"), "tokens", "padding").first()) == (3, 1636, 924)
