"""Coinbase receivers and addresses that spend an output soon after receiving it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txloom.functions.columns import DROPPED_TYPES, day_slice
from txloom.functions.relations import union_all


def coinbase_miners(tx: DataFrame, run_date: date | None = None) -> DataFrame:
    """Distinct (block_number, address) of the outputs of coinbase transactions."""
    return (
        day_slice(tx, run_date)
        .where(F.col("is_coinbase"))
        .select("block_number", F.explode(F.flatten("outputs.addresses")).alias("address"))
        .distinct()
    )


def frequent_io(
    tx: DataFrame, run_date: date | None = None, stored: DataFrame | None = None, max_gap: int = 12
) -> DataFrame:
    """Fewest blocks between receiving and spending an output, for addresses at or below `max_gap`.

    Spends meet their outputs on (transaction, index) with the address arrays still folded; the
    addresses on both ends are intersected inside the row.
    """
    sliced = day_slice(tx, run_date, days=2)
    spends = (
        sliced.select(
            "block_number",
            F.explode(
                F.arrays_zip(
                    F.col("inputs.spent_transaction_hash").alias("origin"),
                    F.col("inputs.spent_output_index").alias("index"),
                    F.col("inputs.addresses").alias("addresses"),
                    F.col("inputs.type").alias("type"),
                )
            ).alias("i"),
        )
        .where(~F.col("i.type").isin(*DROPPED_TYPES))
        .select(
            F.col("block_number").alias("spent_at"),
            F.col("i.origin").alias("hash"),
            F.col("i.index").alias("index"),
            F.col("i.addresses").alias("spenders"),
        )
    )
    outputs = (
        sliced.select(
            "hash",
            "block_number",
            F.explode(
                F.arrays_zip(
                    F.col("outputs.index").alias("index"),
                    F.col("outputs.addresses").alias("addresses"),
                    F.col("outputs.type").alias("type"),
                )
            ).alias("o"),
        )
        .where(~F.col("o.type").isin(*DROPPED_TYPES))
        .select(
            "hash",
            F.col("block_number").alias("received_at"),
            F.col("o.index").alias("index"),
            F.col("o.addresses").alias("receivers"),
        )
    )
    gap = F.col("spent_at") - F.col("received_at")
    gaps = (
        spends.join(outputs, ["hash", "index"])
        .where(gap <= max_gap)
        .select(F.explode(F.array_intersect("spenders", "receivers")).alias("address"), gap.alias("min_gap"))
    )
    rows = gaps if stored is None else union_all([gaps, stored.select("address", "min_gap")])
    return rows.groupBy("address").agg(F.min("min_gap").alias("min_gap"))
