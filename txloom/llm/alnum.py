"""Words of digits, a-z and characters beyond ASCII, taken from UTF-8 bytes; A-Z are lower-cased."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The same words as a pattern over the lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KEPT = {*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)}
_TO = bytes(b if (b := c | 0x20 if 0x41 <= c <= 0x5A else c) in _KEPT else 0x20 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text, in order. A null or empty text has none."""
    return text.translate(_TO).split() if text else []


def as_bytes(rows: DataFrame, id_column: str, text_column: str, id_type: str = "long") -> DataFrame:
    """The two columns an operator reads, whatever else the table holds: id and the text's UTF-8 bytes."""
    return rows.select(F.col(id_column).cast(id_type).alias("id"), F.col(text_column).cast("binary").alias("text"))


def blocks(batches: Iterable, size: int, make: Callable[[bytes | None], Any] = words_of) -> Iterator[tuple[list, list]]:
    """Ids of successive rows with `size` bytes of text or more, and what `make` makes of their texts; a row is never cut."""
    ids, made, held = [], [], 0
    for batch in batches:
        for row, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
            data = text.as_py()
            ids.append(row)
            made.append(make(data))
            held += len(data or b"")
            if held >= size:
                yield ids, made
                ids, made, held = [], [], 0
    if ids:
        yield ids, made
