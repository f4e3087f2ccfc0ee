from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from txloom.llm import bpe
from txloom.llm.queries import op3_byte_bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
WHOLE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
SF = "/root/testdata/sf0.001"


def packed(text):
    return np.array(WHOLE.encode_ordinary(text or ""), "<u4").tobytes()


def both(docs, **options):
    return bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, **options), RANKS).collect()


def test_odd_rows_in_small_blocks(spark, docs_of):
    given = [(1, None), (2, ""), (3, "a b  c\n\n d's "), (3, "a b  c\n\n d's "), (None, "日本 😀 é <|endoftext|>"), (4, "y" * 3000 + "  z\0" * 900)]
    got = both(docs_of(*given), block_bytes=10)
    key = lambda i, a, b: (i or 0, a, b)
    assert sorted(key(r["doc_id"], bytes(r["ids"]), bytes(r["bytes"])) for r in got) == sorted(key(i, packed(t), (t or "").encode()) for i, t in given)


def test_empty_table(spark, docs_of):
    assert both(docs_of((1, "x")).limit(0)) == []


def test_null_ids_decode_to_null(spark):
    rows = bpe.decode(spark.createDataFrame([(1, None), (2, b"")], "doc_id long, ids binary"), RANKS).collect()
    assert {r["doc_id"]: r["bytes"] for r in rows} == {1: None, 2: b""}


def test_query(spark):
    got = {r["doc_id"]: r for r in op3_byte_bpe(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    for row in rows:
        data, r = packed(row["text"]), got[row["doc_id"]]
        assert r["n_tokens"] == len(data) // 4
        assert r["ids_sha256"] == hashlib.sha256(data).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()
