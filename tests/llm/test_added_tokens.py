"""Added tokens inside texts, against the library at its default setting."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from txloom.llm import packing, records
from txloom.llm.tokens import TokenEncoder, read_tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
ENCODER = TokenEncoder(read_tokenizer(PATH))
ADDED = "<|endoftext|>"
ALPHABET = st.sampled_from([*"ab't.é \n", "  ", "don't", ADDED, ADDED, "<|endof", "text|>", "日本"])
TEXTS = ["a <|endoftext|> b", ADDED, ADDED * 2, f"{ADDED} x", f"x  {ADDED}", "plain", "", None]


def packed(text):
    return np.array(WHOLE.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=500, deadline=None)
@given(st.lists(ALPHABET, max_size=25).map("".join))
def test_ids_are_those_of_the_library(text):
    assert ENCODER.pack_text(text) == packed(text)


def test_one_text():
    assert np.frombuffer(ENCODER.pack_text(TEXTS[0]), "<u4").tolist() == [64, 220, 50256, 275]


def test_records_and_pieces(spark, docs_of, tmp_path):
    docs, expected = docs_of(*enumerate(TEXTS)), {k: packed(t) + bytes(4) for k, t in enumerate(TEXTS)}
    index = records.write_records(docs, f"file://{tmp_path}/r", read_tokenizer(PATH), 0)
    assert {r["doc_id"]: bytes(r["ids"]) for r in records.read_records(index).collect()} == expected
    pieces = packing.token_pieces(docs, read_tokenizer(PATH), 0).collect()
    assert {r["doc_id"]: (r["doc_tokens"], r["ids_crc32"]) for r in pieces} == {k: (len(x) // 4, zlib.crc32(x)) for k, x in expected.items()}
