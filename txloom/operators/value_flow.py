"""Value flow of UTXO transactions and the prices it is valued with."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txloom.functions.columns import DROPPED_TYPES, day_of, day_slice, flow_partition
from txloom.functions.relations import union_all

COIN = 1e-8  # coins per smallest unit


def daily_close(klines: DataFrame, backfill: DataFrame | None = None, symbol: str = "BTCUSDT") -> DataFrame:
    """Daily closing price of one symbol, followed by the rows of a back-fill table.

    klines: openTimeStamp, close, symbol. Returns (price_timestamp, price decimal(38,9)). A day that
    is in both tables stays twice, as a union of the two gives.
    """
    price = F.col("close").cast("decimal(38,9)")
    closes = (
        klines.where(F.col("symbol") == symbol)
        .groupBy(F.col("openTimeStamp").alias("price_timestamp"))
        .agg(F.max(price).alias("price"))
    )
    if backfill is None:
        return closes
    kept = backfill.select("price_timestamp", F.col("price").cast("decimal(38,9)").alias("price"))
    return union_all([closes, kept])


def with_day_price(df: DataFrame, price: DataFrame, how: str = "left") -> DataFrame:
    """Join the price of the day of `block_timestamp`. The price table has a row per day, so it is sent to all tasks."""
    by_day = price.select(day_of("price_timestamp").alias("_price_day"), F.col("price"))
    return df.join(F.broadcast(by_day), day_of("block_timestamp") == F.col("_price_day"), how).drop("_price_day")


def _shares(side: str, is_output: bool) -> Column:
    """Array of (addresses, value per address, side) of the lines that count.

    arrays_zip of single fields keeps the scan down to these fields of the nested column.
    """
    lines = F.arrays_zip(
        F.col(f"{side}.value").alias("value"),
        F.col(f"{side}.type").alias("type"),
        F.col(f"{side}.addresses").alias("addresses"),
    )
    kept = F.filter(lines, lambda x: ~x["type"].isin(*DROPPED_TYPES))
    return F.transform(
        kept,
        lambda x: F.struct(
            x["addresses"].alias("addresses"),
            # a line without addresses gives no row; it must not fail either
            F.try_divide(x["value"], F.size(x["addresses"])).alias("share"),
            F.lit(is_output).alias("is_output"),
        ),
    )


def utxo_value_flow(tx: DataFrame, price: DataFrame, run_date: date | None = None) -> DataFrame:
    """What each address received, spent and netted in each transaction, in coins and in USD.

    A line's value is shared equally by its addresses. Both sides of a transaction are exploded
    together and meet in one conditional aggregation on (hash, address), which gives what a full
    outer join of two aggregates gives with half the shuffles. A transaction goes to its task as one
    row, before it is exploded; the flow lies by hash then, as many parts as a shuffle has. Exploded outer, as an inner
    one first tests the size of the lines, for which it makes them a second time.
    """
    none = F.array().cast("array<struct<addresses:array<string>,share:double,is_output:boolean>>")
    lines = F.concat(F.coalesce(_shares("outputs", True), none), F.coalesce(_shares("inputs", False), none))
    parts = int(tx.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = (
        day_slice(tx, run_date)
        .select("hash", "block_number", "block_timestamp", lines.alias("lines"))
        .repartition(parts, "hash")
        .select("hash", "block_number", "block_timestamp", F.explode_outer("lines").alias("line"))
        .select(
            "hash",
            "block_number",
            "block_timestamp",
            F.explode("line.addresses").alias("address"),
            F.col("line.share").alias("share"),
            F.col("line.is_output").alias("is_output"),
        )
    )
    received = F.sum(F.when(F.col("is_output"), F.col("share"))) * F.lit(COIN)
    spent = F.sum(F.when(~F.col("is_output"), F.col("share"))) * F.lit(COIN)
    flow = (
        shares.groupBy("hash", "address")
        .agg(
            F.max("block_number").alias("block_number"),
            F.max("block_timestamp").alias("block_timestamp"),
            spent.alias("in_value"),
            received.alias("out_value"),
        )
        .withColumn(
            "net_value",
            F.coalesce(F.col("out_value"), F.lit(0.0)) - F.coalesce(F.col("in_value"), F.lit(0.0)),
        )
    )
    usd = lambda c: (F.col(c) * F.col("price"))
    return with_day_price(flow, price).select(
        "hash",
        "block_number",
        "address",
        "block_timestamp",
        "in_value",
        "out_value",
        "net_value",
        usd("in_value").alias("in_usd_value"),
        usd("out_value").alias("out_usd_value"),
        usd("net_value").alias("net_usd_value"),
        flow_partition("block_timestamp").alias("partition_date"),
    )
