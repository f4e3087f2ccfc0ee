from __future__ import annotations

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from txloom.llm import records
from txloom.llm.crc32c import crc32c
from txloom.llm.queries import op1_token_records
from txloom.llm.tokens import read_tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
WHOLE.encode_special_tokens = True
SF = "/root/testdata/sf0.001"


def ids(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 0]


def packed(text):
    return np.array(ids(text), "<u4").tobytes()


def plain_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksums():
    chunks = [b"", b"123456789", b"\0" * 200, *(os.urandom(n) for n in (1, 63, 64, 65, 127, 128, 129, 500))]
    assert crc32c(chunks).tolist() == [plain_crc32c(x) for x in chunks]
    assert crc32c([b"123456789"])[0] == 0xE3069283  # published check value


def test_round_trip_of_odd_rows(spark, docs_of, tmp_path):
    given = [(5, "b c"), (None, "no id"), (3, None), (4, ""), (5, "b c"), (5, "a"), (-1, "x " * 30_000)]
    index = records.write_records(docs_of(*given), f"file://{tmp_path}/r", read_tokenizer(PATH), 0)
    back = records.read_records(index).orderBy("part", "record").collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["ids"])) for r in back) == sorted(
        (i is not None, i or 0, packed(t)) for i, t in given
    )
    assert [r["doc_id"] for r in back] == [None, -1, 3, 4, 5, 5, 5]
    some = records.read_records(index.where("doc_id IN (3, -1)").orderBy(F.desc("doc_id"))).collect()
    assert {r["doc_id"]: bytes(r["ids"]) for r in some} == {3: packed(None), -1: packed("x " * 30_000)}


def test_empty_table(spark, docs_of, tmp_path):
    index = records.write_records(docs_of(*[(1, "x")]).limit(0), f"file://{tmp_path}/r", read_tokenizer(PATH), 0)
    assert index.count() == 0 and records.read_records(index).count() == 0


def test_damage_is_found(spark, docs_of, tmp_path):
    index = records.write_records(docs_of((1, "some words")), f"file://{tmp_path}/r", read_tokenizer(PATH), 0)
    path = index.first()["file"].removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[-6] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        records.read_records(index).collect()


def test_query(spark):
    got = {r["doc_id"]: r for r in op1_token_records(spark, SF).collect()}
    start = 0
    for row in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        data = packed(row["text"])
        r = got.pop(row["doc_id"])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(data) // 4, zlib.crc32(data))
        start += len(data) // 4
    assert not got
