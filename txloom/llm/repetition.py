"""Quality rules on repetition: how many characters lie inside n-grams and lines that occurred before.

Word numbers of a text are hashed in windows of several lengths with numpy; a window whose hash occurred
earlier in the text marks its words, overlapping windows mark them once. A repeated n-gram holds repeated
shorter ones, so the longer lengths are looked at only while shorter ones repeat.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txloom.llm.shared import mix64, texts, windows

#: Largest share of word characters inside repeated n-grams, by n, and inside repeated lines (Rae et al. 2021, table A1).
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_CHARS_LIMIT = 0.20

MIN_WORDS = 50
BASE_WINDOW = 3
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

COLUMNS = (
    ("doc_id", "long"),
    ("n_words", "long"),
    ("word_chars", "long"),
    ("n_symbols", "long"),
    ("n_lines", "long"),
    ("n_dup_lines", "long"),
    ("dup_line_chars", "long"),
    ("n_repeat_words", "long"),
    *((f"dup_chars_{n}", "long") for n in NGRAM_LIMITS),
    ("base_failed", "boolean"),
    ("kept", "boolean"),
)


def _covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n words lie in a window of `width` from one of `starts`."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:n]) > 0


def _seen_before(hashes: np.ndarray) -> np.ndarray:
    """Positions whose value occurs at an earlier position."""
    order = np.argsort(hashes, kind="stable")
    sorted_ = hashes[order]
    return order[1:][sorted_[1:] == sorted_[:-1]]


def _n_repeat_words(hashes: np.ndarray, n: int) -> int:
    h = windows(hashes, BASE_WINDOW)
    _, back, count = np.unique(h, return_inverse=True, return_counts=True)
    return int(_covered(np.flatnonzero(count[back] > 1), BASE_WINDOW, n).sum()) if len(h) else 0


def measure(text: str) -> dict[str, int | bool]:
    """All figures of one text."""
    data = text.encode()
    words = data.split()
    n = len(words)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    sizes = np.fromiter((len(w.decode()) for w in number), np.int64, len(number))[ids]
    out: dict[str, int | bool] = {
        "n_words": n,
        "word_chars": len(text) - sum(data.count(c) for c in SPACES),
        "n_symbols": sum(data.count(c) for c in SYMBOLS),
    }
    seen: set[bytes] = set()
    lines = dup_lines = dup_line_chars = 0
    for line in data.split(b"\n"):
        bare = line.strip(SPACES)
        if bare:
            lines += 1
            if line in seen:
                dup_lines += 1
                dup_line_chars += len(b"".join(bare.split()).decode())
            seen.add(line)
    out |= {"n_lines": lines, "n_dup_lines": dup_lines, "dup_line_chars": dup_line_chars}

    hashes = mix64(ids.astype(np.uint64) + np.uint64(1))
    out["n_repeat_words"] = _n_repeat_words(hashes, n)
    repeats = out["n_repeat_words"] > 0
    for width in NGRAM_LIMITS:
        found = _seen_before(windows(hashes, width)) if repeats else np.empty(0, np.int64)
        repeats = len(found) > 0
        out[f"dup_chars_{width}"] = int(sizes[_covered(found, width, n)].sum()) if repeats else 0

    out["base_failed"] = n < MIN_WORDS or 100 * out["n_repeat_words"] > 50 * n
    out["kept"] = (
        not out["base_failed"]
        and out["dup_line_chars"] <= LINE_CHARS_LIMIT * out["word_chars"]
        and all(out[f"dup_chars_{k}"] <= limit * out["word_chars"] for k, limit in NGRAM_LIMITS.items())
    )
    return out


def repetition(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for each row of `docs`: its figures, base_failed, and kept.

    A null or empty text has no words and fails the base rule; null or repeated ids are judged row by row.
    Nothing is shuffled; a task holds one batch of texts.
    """

    def judge(batches: Iterable) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(x) for x in batch.column("text").to_pylist()]
            kinds = {"long": pa.int64(), "boolean": pa.bool_()}
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([x[c] for x in found], kinds[k]) for c, k in COLUMNS[1:])], [c for c, _ in COLUMNS]
            )

    return texts(docs, id_column, text_column).mapInArrow(judge, ", ".join(f"{c} {k}" for c, k in COLUMNS))
