"""Hashes and addresses as bytes."""

from __future__ import annotations

import pytest

from txloom.functions.columns import packed, unpacked


@pytest.mark.parametrize("text", ["", "ab", "AB", "abc", "0xab", "0xAB", "0x", "0xabc", "ab\n", "h1", "é", "00", "\x01ab", None])
def test_packed(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select("t", packed("t").alias("p"))
    assert df.select(unpacked("p")).first()[0] == text


def test_packed_differs_where_texts_differ(spark):
    texts = ["", "ab", "AB", "abc", "0xab", "0xAB", "0x", "0xabc", "ab\n", "h1", "00", "0x00", "\x00", "\x01ab"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.select(packed("t").alias("p")).distinct().count() == len(texts)
