"""The cheap pre-filter holds wherever a pattern matches."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_pii import plain
from txloom.llm import pii

PATTERNS = [pii.EMAIL.replace(r"\p{L}\p{N}", "a-z0-9"), pii.PHONE, pii.IP, pii.SSN, pii.ISO_DATE, pii.DAY_DATE, pii.CARD, "[0-9A-Fa-f]{32,64}"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_every_match_is_hinted(pattern):
    @settings(max_examples=300, deadline=None)
    @given(st.from_regex(re.compile(pattern, re.ASCII), fullmatch=True))
    def check(value):
        assert re.search(pii.HINT, value)

    check()


def test_mixed_separators(spark, docs_of):
    values = ["+1 (415) 555.0132", "+1.415-555.0132", "+1(415)555-0132"]
    got = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs_of(*[(k, f"call {v} now") for k, v in enumerate(values)])).collect()}
    assert got == {k: f"call {plain(v)} now" for k, v in enumerate(values)}
