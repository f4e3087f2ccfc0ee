"""Equal-value join transactions, their address scores, and multi-in multi-out addresses.

Everything about one transaction is in one row, so detection works on arrays inside the row and
needs no shuffle. Input contract: `hash` is unique in the transaction table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txloom.functions.columns import day_slice, joined, joined_sets, logistic
from txloom.functions.relations import accumulate
from txloom.operators.value_flow import COIN, with_day_price


def _join_values() -> tuple[Column, Column]:
    """Sorted output values, and of these the values v, not above the smallest input, that exactly input_count address sets received.

    The values of the distinct (address set, value) pairs are sorted; v occurs exactly n times where
    the n-th value from its first position is still v and the next is not.
    """
    outputs = F.arrays_zip(
        F.col("outputs.value").alias("value"),
        F.col("outputs.addresses").alias("addresses"),
    )
    pairs = F.array_distinct(
        F.transform(outputs, lambda x: F.struct(x["value"].alias("value"), joined(x["addresses"]).alias("owner")))
    )
    values = F.array_sort(F.transform(pairs, lambda p: p["value"]))
    lowest = F.array_min("inputs.value")
    n = F.col("input_count").cast("int")

    def starts_run(v: Column, i: Column) -> Column:
        before, last, after = F.get("values", i - 1), F.get("values", i + n - 1), F.get("values", i + n)
        return (
            (v <= lowest)
            & last.eqNullSafe(v)
            & ~before.eqNullSafe(v)
            & ~after.eqNullSafe(v)
        )

    return values, F.filter("values", starts_run)


def _candidates(tx: DataFrame, run_date: date | None) -> DataFrame:
    """Transactions within the count limits, with the values that make them equal-value joins."""
    within = day_slice(tx, run_date).where(
        (F.col("input_count") >= 3)
        & (F.col("output_count") >= 3)
        & (F.col("output_count") <= F.col("input_count") * 3)
        & (F.col("output_count") >= F.col("input_count"))
    )
    values, found = _join_values()
    return within.withColumn("values", values).withColumn("join_values", found).where(F.size("join_values") > 0)


def coinjoin_tx(tx: DataFrame, run_date: date | None = None) -> DataFrame:
    """Hashes of equal-value join transactions."""
    return _candidates(tx, run_date).select(F.col("hash").alias("txhash"))


def coinjoin_address_score(
    tx: DataFrame, price: DataFrame, run_date: date | None = None, stored: DataFrame | None = None
) -> DataFrame:
    """Mixer tag P015 for all addresses of equal-value joins, scored by participants and value in USD.

    The score grows with the value, so the largest join value of a transaction gives its best score.
    """
    usd = F.col("price") * F.col("join_value") * F.lit(COIN)
    score = logistic((F.col("input_count") - 5) / F.lit(5) + (usd - 1000) / F.lit(1000))
    owners = F.array_union(joined_sets(F.col("inputs.addresses")), joined_sets(F.col("outputs.addresses")))
    joins = _candidates(tx, run_date).select(
        "block_timestamp", "input_count", owners.alias("owners"), F.array_max("join_values").alias("join_value")
    )
    scored = (
        with_day_price(joins, price)
        .select(F.explode("owners").alias("address"), score.alias("score"))
        .groupBy("address")
        .agg(F.max("score").alias("score"))
        .select(
            "address",
            F.lit("mixer").alias("feature"),
            F.lit(None).cast("string").alias("name"),
            F.lit("P015").alias("plots"),
            "score",
        )
    )
    return accumulate(scored, stored)


def mimo_addresses(tx: DataFrame, run_date: date | None = None, stored: DataFrame | None = None) -> DataFrame:
    """Tag P109 for every address set on a side of a transaction with 3 or more inputs and outputs."""
    owners = F.array_union(joined_sets(F.col("inputs.addresses")), joined_sets(F.col("outputs.addresses")))
    tags = (
        day_slice(tx, run_date)
        .where((F.col("input_count") >= 3) & (F.col("output_count") >= 3))
        .select(F.explode(owners).alias("address"))
        .select(
            "address",
            F.lit("mimo").alias("feature"),
            F.lit(None).cast("string").alias("name"),
            F.lit("P109").alias("plots"),
        )
    )
    return accumulate(tags, stored)
