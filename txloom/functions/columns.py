"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZERO_ADDRESS = "0x" + "0" * 40  # token address that stands for the native coin
BUCKETS = 4000
COARSE_BEFORE = date(2016, 1, 1)  # older days share one partition per month
MONTH_COLUMN = "block_timestamp_month"
HEX_TEXT = r"^(?:0x)?(?:[0-9a-f]{2})*+\z"  # even runs of lower-case hex digits
DROPPED_TYPES = ("nulldata", "nonstandard")  # lines of these script types carry no transfer


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(ts: Column | str) -> Column:
    return F.to_date(col(ts))


def day_slice(
    df: DataFrame,
    run_date: date | None,
    days: int = 1,
    column: str = "block_timestamp",
    open_end: bool = False,
) -> DataFrame:
    """Rows of the `days` days before `run_date`; every row when `run_date` is None.

    The bounds are literals, so they reach the Parquet scan. A table partitioned by month is
    pruned on its month column too.
    """
    if run_date is None:
        return df
    first, last = run_date - timedelta(days=days), run_date - timedelta(days=1)
    out = df.where(F.col(column) >= F.lit(first))
    if not open_end:
        out = out.where(F.col(column) < F.lit(run_date))
    if MONTH_COLUMN in df.columns:
        out = out.where(F.col(MONTH_COLUMN) >= F.lit(first.replace(day=1)))
        if not open_end:
            out = out.where(F.col(MONTH_COLUMN) <= F.lit(last.replace(day=1)))
    return out


def flow_partition(ts: Column | str) -> Column:
    """Partition date: the day, or the first of the month for days before 2016."""
    day = day_of(ts)
    return F.when(day < F.lit(COARSE_BEFORE), F.trunc(day, "MM")).otherwise(day)


def flow_day_slice(flow: DataFrame, run_date: date | None) -> DataFrame:
    """The rows of the day before `run_date` in a table partitioned by `flow_partition`; every row without a run date.

    Equality on the partition prunes folders, the bounds on the time pick the day from a month of old flow.
    """
    if run_date is None:
        return flow
    day = run_date - timedelta(days=1)
    partition = day.replace(day=1) if day < COARSE_BEFORE else day
    return flow.where(
        (F.col("partition_date") == F.lit(partition))
        & (F.col("block_timestamp") >= F.lit(day))
        & (F.col("block_timestamp") < F.lit(run_date))
    )


def _hex_tail(text: Column) -> Column:
    return F.conv(F.substring(text, -3, 3), 16, 10).cast("int") % BUCKETS


def md5_bucket(address: Column | str) -> Column:
    """Bucket 0..3999 from the last three hex digits of md5(address)."""
    return _hex_tail(F.md5(col(address)))


def hex_bucket(address: Column | str) -> Column:
    """Bucket 0..3999 from the last three hex digits of the address, NULL if they are not hex."""
    a = col(address)
    return F.when(F.substring(a, -3, 3).rlike("^[0-9a-fA-F]{1,3}$"), _hex_tail(a))


def logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def safe_numeric(text: Column | str) -> Column:
    """Numeric value with 29 integer and 9 fraction digits, NULL if the text is not such a number."""
    return col(text).try_cast("decimal(38,9)")


def packed(text: Column | str) -> Column:
    """The text as bytes, equal where texts are equal: lower-case hex digits, with 0x or without, take half the room.

    Hashes and addresses do not compress, so as keys of a shuffle they travel in this form. It does not keep their order.
    """
    t = col(text)
    digits = F.when(t.startswith("0x"), F.concat(F.lit("01"), F.substring(t, 3, 1 << 30))).otherwise(F.concat(F.lit("00"), t))
    return F.when(t.rlike(HEX_TEXT), F.unhex(digits)).otherwise(F.concat(F.lit(bytearray(b"\2")), t.cast("binary")))


def unpacked(value: Column | str) -> Column:
    """The text of `packed`."""
    v = col(value)
    tag, rest = F.substring(v, 1, 1), F.substring(v, 2, 1 << 30)
    digits = F.lower(F.hex(rest))
    return (
        F.when(tag == F.lit(bytearray(b"\0")), digits)
        .when(tag == F.lit(bytearray(b"\1")), F.concat(F.lit("0x"), digits))
        .otherwise(rest.cast("string"))
    )


def joined(addresses: Column) -> Column:
    """One text key for a set of addresses."""
    return F.array_join(addresses, ",")


def joined_sets(arrays: Column) -> Column:
    """Distinct text keys of an array of address sets, made inside the row."""
    return F.array_distinct(F.transform(arrays, joined))
