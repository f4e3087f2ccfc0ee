from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from txloom.llm.tokens import TokenEncoder, pieces, read_tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
WHOLE.encode_special_tokens = True
ENCODER = TokenEncoder(read_tokenizer(PATH))
ALPHABET = st.sampled_from([*"ab'stZ9.,!é \n\t", " ", "  ", " ", "\x1c", "\x85", "　", "don't", "<|endoftext|>", "日本", "😀", "é"])


def ids(text: str) -> list[int]:
    return WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=500, deadline=None)
@given(st.lists(ALPHABET, max_size=25).map("".join))
def test_pieces_give_the_ids_of_the_whole_text(text):
    assert "".join(pieces(text)) == text
    assert np.frombuffer(ENCODER.pack(text), "<u4").tolist() == ids(text)


@pytest.mark.parametrize("text", ["", " ", "  ", " a", "a ", "a  b", "a \n b", "\n \n", "a\n ", " \x1c x", "x" * 5000 + "  " + "y z" * 1000])
def test_spaces(text):
    assert np.frombuffer(ENCODER.pack(text), "<u4").tolist() == ids(text)


def test_null_is_empty():
    assert ENCODER.pack(None) == b""
