from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents from (doc_id, text) pairs, with columns whose names could clash."""

    def make(*pairs):
        rows = [(i, t, "en", "src0", len(t or ""), 1, "x", "k") for i, t in pairs]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, node long, score string, key string"
        )

    return make
