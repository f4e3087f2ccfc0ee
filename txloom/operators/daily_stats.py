"""Per-address daily statistics, one aggregation per table.

First and last transactions are the min / max of a struct instead of windows. In the value flow they
combine before the shuffle, so a busy address costs one partial row per task. Lines of transfers are
narrower than what they would combine to, so they go as they are to the task of their address and day.
Ties in time go by block, hash and amount.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txloom.functions.columns import day_of, day_slice, flow_day_slice, hex_bucket, md5_bucket, packed, unpacked

ENDPOINT_FIELDS = ("hash", "block_timestamp", "block_num", "value", "usd_value")


def _endpoints(side: str, hash_col: str, value: str, usd: str, where: Column) -> list[Column]:
    """First and last transaction of a side: the smallest and largest struct that starts with the time."""
    row = F.struct(
        F.col("block_timestamp"),
        F.col("block_number").alias("block_num"),
        F.col(hash_col).alias("hash"),
        F.col(value).alias("value"),
        F.col(usd).alias("usd_value"),
    )
    return [
        F.min(F.when(where, row)).alias(f"first_{side}_tx"),
        F.max(F.when(where, row)).alias(f"last_{side}_tx"),
    ]


def _unfold(which: str, side: str) -> list[Column]:
    return [F.col(f"{which}_{side}_tx.{f}").alias(f"{which}_{side}_tx_{f}") for f in ENDPOINT_FIELDS]


def _all_endpoints() -> list[Column]:
    return [c for side in ("in", "out") for which in ("first", "last") for c in _unfold(which, side)]


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0)).alias(name)


def utxo_stat_daily(value_flow: DataFrame, run_date: date | None = None) -> DataFrame:
    """Counts, sums, extremes and first/last transactions per address and day, for net flows."""
    net, usd = F.col("net_value"), F.col("net_usd_value")
    is_in, is_out = net > 0, net < 0
    one = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    total = lambda cond, v: F.sum(F.when(cond, v).otherwise(F.lit(0.0)))
    daily = flow_day_slice(value_flow, run_date).where(is_in | is_out)
    stats = daily.groupBy("address", day_of("block_timestamp").alias("block_date")).agg(
        one(is_in).alias("in_tx_cnt"),
        total(is_in, net).alias("in_tx_value"),
        total(is_in, usd).alias("in_tx_value_usd"),
        F.min(F.when(is_in, net)).alias("smallest_inflow"),
        F.min(F.when(is_in, usd)).alias("smallest_inflow_usd"),
        F.max(F.when(is_in, net)).alias("largest_inflow"),
        F.max(F.when(is_in, usd)).alias("largest_inflow_usd"),
        one(is_out).alias("out_tx_cnt"),
        total(is_out, -net).alias("out_tx_value"),
        total(is_out, -usd).alias("out_tx_value_usd"),
        F.min(F.when(is_out, -net)).alias("smallest_outflow"),
        F.min(F.when(is_out, -usd)).alias("smallest_outflow_usd"),
        F.max(F.when(is_out, -net)).alias("largest_outflow"),
        F.max(F.when(is_out, -usd)).alias("largest_outflow_usd"),
        *_endpoints("in", "hash", "net_value", "net_usd_value", is_in),
        *_endpoints("out", "hash", "net_value", "net_usd_value", is_out),
    )
    return stats.select(
        md5_bucket("address").alias("addr_pt"),
        "address",
        "block_date",
        "in_tx_cnt",
        "in_tx_value",
        _zero("smallest_inflow"),
        _zero("largest_inflow"),
        "out_tx_cnt",
        "out_tx_value",
        _zero("smallest_outflow"),
        _zero("largest_outflow"),
        (F.col("in_tx_cnt") + F.col("out_tx_cnt")).alias("tx_cnt"),
        (F.col("in_tx_value") + F.col("out_tx_value")).alias("turnover"),
        (F.col("in_tx_value_usd") + F.col("out_tx_value_usd")).alias("turnover_usd"),
        "in_tx_value_usd",
        _zero("smallest_inflow_usd"),
        _zero("largest_inflow_usd"),
        "out_tx_value_usd",
        _zero("smallest_outflow_usd"),
        _zero("largest_outflow_usd"),
        *_all_endpoints(),
        F.lit("BTC").alias("symbol"),
    )


def token_stat_daily(
    transfers: DataFrame, tx: DataFrame, run_date: date | None = None, turnover: str = "reference"
) -> DataFrame:
    """Statistics per address, day and token over priced transfers, with the address's transaction count.

    `transfers` come from `priced_transfers` for the same day. The published turnover adds the
    incoming value to the outgoing count; `turnover="value"` adds the two values. An address that
    only occurs in `tx` gets one row without token.
    """
    value, usd = F.col("value"), F.col("usd_value")
    is_in, is_out = F.col("is_in"), ~F.col("is_in")
    ends = F.array(
        F.struct(packed("to_address").alias("address"), F.lit(True).alias("is_in")),
        F.struct(packed("from_address").alias("address"), F.lit(False).alias("is_in")),
    )
    day = day_of("block_timestamp")
    keys = {c: packed(c) for c in ("transaction_hash", "token_address")}
    sides = (
        transfers.withColumns(keys)
        .select("transaction_hash", "token_address", "symbol", "block_timestamp", "block_number", "value", "usd_value", F.inline(ends))
        .where(F.col("address").isNotNull())
        # like rows side by side take less room in the shuffle, which serves the grouping and the join with the counts
        .sortWithinPartitions("address", "token_address", "block_timestamp")
        .repartition("address", day)
        .withColumn("transaction_hash", unpacked("transaction_hash"))  # ties go by the text
    )

    def side_stats(side: str, flow: str, cond: Column) -> list[Column]:
        pick = lambda c: F.when(cond, c)
        return [
            F.count(pick(F.lit(1))).alias(f"{side}_tx_cnt"),
            F.coalesce(F.sum(pick(value)), F.lit(0.0)).alias(f"{side}_tx_value"),
            F.coalesce(F.sum(pick(usd)), F.lit(0.0)).alias(f"{side}_tx_value_usd"),
            F.coalesce(F.min(pick(value)), F.lit(0.0)).alias(f"smallest_{flow}"),
            F.coalesce(F.min(pick(usd)), F.lit(0.0)).alias(f"smallest_{flow}_usd"),
            F.coalesce(F.max(pick(value)), F.lit(0.0)).alias(f"largest_{flow}"),
            F.coalesce(F.max(pick(usd)), F.lit(0.0)).alias(f"largest_{flow}_usd"),
            *_endpoints(side, "transaction_hash", "value", "usd_value", cond),
        ]

    stats = sides.groupBy("address", day.alias("block_date"), "token_address").agg(
        F.min("symbol").alias("symbol"), *side_stats("in", "inflow", is_in), *side_stats("out", "outflow", is_out)
    )
    other = F.col("out_tx_cnt") if turnover == "reference" else F.col("out_tx_value")
    counts = (
        day_slice(tx, run_date)
        .select(F.explode(F.array(packed("from_address"), packed("to_address"))).alias("address"), day.alias("block_date"))
        .where(F.col("address").isNotNull())
        .groupBy("address", "block_date")
        .agg(F.count("*").alias("tx_cnt"))
    )
    amounts = [
        f"{which}_{flow}{suffix}"
        for flow in ("inflow", "outflow")
        for which in ("smallest", "largest")
        for suffix in ("", "_usd")
    ]
    return (
        stats.withColumn("turnover", F.col("in_tx_value") + other)
        .withColumn("turnover_usd", F.col("in_tx_value_usd") + F.col("out_tx_value_usd"))
        .join(counts, ["address", "block_date"], "full_outer")
        .withColumns({c: unpacked(c) for c in ("address", "token_address")})
        .select(
            hex_bucket("address").alias("addr_pt"),
            "address",
            "block_date",
            "token_address",
            "symbol",
            "in_tx_cnt",
            "in_tx_value",
            "in_tx_value_usd",
            "out_tx_cnt",
            "out_tx_value",
            "out_tx_value_usd",
            *amounts,
            "turnover",
            "turnover_usd",
            *_all_endpoints(),
            F.coalesce("tx_cnt", F.lit(0)).alias("tx_cnt"),
        )
    )
