"""DataFrame helpers: new-only filter, accumulation, tag normal form, first/last rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAG_COLUMNS = ("address", "feature", "name", "plots", "idx")


def new_only(fresh: DataFrame, stored: DataFrame | None, on: Sequence[str] = ("address",)) -> DataFrame:
    """Rows of `fresh` whose key is not in `stored`."""
    if stored is None:
        return fresh
    return fresh.join(stored.select(*on), list(on), "left_anti")


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Set union with a single shuffle, however many frames come in."""
    return union_all(frames).distinct()


def accumulate(fresh: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Set union of a run's rows with the rows kept by earlier runs."""
    return fresh.distinct() if stored is None else union_distinct(fresh, stored.select(*fresh.columns))


def new_rows(fresh: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Distinct rows of `fresh` that are not in `stored`: what a table that is a set grows by."""
    return fresh.distinct() if stored is None else fresh.subtract(stored.select(*fresh.columns))


def tag_rows(
    df: DataFrame, feature: Column | str, plots: Column | str, idx: Column | int, name: Column | None = None
) -> DataFrame:
    """Bring rows with an `address` to the tag form (address, feature, name, plots, idx)."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.select(
        "address",
        as_col(feature).alias("feature"),
        (F.lit(None) if name is None else name).cast("string").alias("name"),
        as_col(plots).alias("plots"),
        as_col(idx).cast("int").alias("idx"),
    )
