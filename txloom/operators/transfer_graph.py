"""Edge lists of who sent what to whom, aggregated over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txloom.functions.columns import ZERO_ADDRESS, hex_bucket, md5_bucket
from txloom.functions.pairing import SIDE_BLOCK, paired
from txloom.functions.relations import union_all
from txloom.operators.token_flow import native_transfers, packed_ends, receipt_status, unpacked_ends, with_native_price

MAX_SIDE = 100  # fixed value: the published guard


def _measures(where: Column | None = None) -> list[Column]:
    pick = (lambda c: F.col(c)) if where is None else (lambda c: F.when(where, F.col(c)))
    return [
        F.sum(pick("value")).alias("to_amount"),
        F.sum(pick("usd_value")).alias("to_amount_usd"),
        F.min(pick("value")).alias("min_value"),
        F.max(pick("value")).alias("max_value"),
        F.min(pick("usd_value")).alias("min_usd_value"),
        F.max(pick("usd_value")).alias("max_usd_value"),
        F.count(F.lit(1) if where is None else F.when(where, 1)).alias("transaction_cnt"),
        F.min(pick("block_number")).alias("first_block_number"),
        F.min(pick("block_timestamp")).alias("first_block_timestamp"),
        F.max(pick("block_number")).alias("last_block_number"),
        F.max(pick("block_timestamp")).alias("last_block_timestamp"),
    ]


# Output columns.
MEASURES = (
    "to_amount",
    "to_amount_usd",
    "min_value",
    "max_value",
    "min_usd_value",
    "max_usd_value",
    "transaction_cnt",
    "first_block_number",
    "first_block_timestamp",
    "first_transaction_hash",
    "last_block_number",
    "last_block_timestamp",
    "last_transaction_hash",
)


def _ends(hash_col: str) -> list[Column]:
    """Hash of the first and last row, as the end of the smallest and largest struct: each is held once."""
    row = F.struct("block_timestamp", "block_number", F.col(hash_col).alias("hash"))
    ends = ((F.min, "first_transaction_hash"), (F.max, "last_transaction_hash"))
    return [of(row)["hash"].alias(name) for of, name in ends]


def _sides(value_flow: DataFrame) -> DataFrame:
    """Per transaction: the addresses that lose and that gain, with what, and the totals of both sides.

    One shuffle by hash serves the guard and the pairs, none where the flow is stored by hash. The lines of a transaction
    are bounded by the block.
    """
    net, usd = F.col("net_value"), F.col("net_usd_value")
    return value_flow.groupBy("hash").agg(
        F.min("block_number").alias("block_number"),
        F.min("block_timestamp").alias("block_timestamp"),
        F.collect_list(F.when(net < 0, F.struct("address", (-net).alias("amount")))).alias("senders"),
        F.collect_list(F.when(net > 0, F.struct("address", net.alias("amount")))).alias("receivers"),
        F.sum(F.when(net < 0, -net).otherwise(F.lit(0.0))).alias("in_total"),
        F.sum(F.when(net > 0, net).otherwise(F.lit(0.0))).alias("out_total"),
        F.sum(F.when(usd > 0, usd).otherwise(F.lit(0.0))).alias("out_usd_total"),
    )


def _within_guard(max_side: int | None) -> Column:
    if max_side is None:
        return F.lit(True)
    sent, received = F.size("senders"), F.size("receivers")
    return (sent == 1) | (received == 1) | ((sent < max_side) & (received < max_side))


def utxo_transfers_left_out(value_flow: DataFrame, max_side: int = MAX_SIDE) -> DataFrame:
    """The transactions that `utxo_transfers` leaves out: hash, both counts, both totals."""
    left_out = _sides(value_flow).where(~_within_guard(max_side))
    counts = [F.size("senders").cast("long").alias("in_cnts"), F.size("receivers").cast("long").alias("out_cnts")]
    return left_out.select("hash", *counts, "in_total", "out_total", "out_usd_total")


def utxo_transfers(value_flow: DataFrame, max_side: int | None = MAX_SIDE) -> DataFrame:
    """Edges between addresses: each sender's net loss split over the receivers by their net gains.

    A transaction takes part if it has one sender, one receiver, or fewer than `max_side` of each, as published;
    `utxo_transfers_left_out` lists the others, None leaves out nothing. A transaction's sides are folded into its row,
    and pairs are made there; without a guard, or with a wide one, wide transactions are paired block by block in many
    tasks.
    """
    sides = _sides(value_flow).where(_within_guard(max_side) & (F.size("senders") > 0) & (F.size("receivers") > 0))
    # the guard is strict, so a side has fewer lines than it says
    wide = max_side is None or max_side > SIDE_BLOCK + 1
    sent, received = F.col("senders.amount"), F.col("receivers.amount")
    value = sent * received / F.col("in_total")
    split = paired(sides, "senders", "receivers", "hash", wide=wide).select(
        "hash",
        "block_number",
        "block_timestamp",
        F.col("senders.address").alias("from_address"),
        F.col("receivers.address").alias("to_address"),
        value.alias("value"),
        (value * F.try_divide("out_usd_total", "out_total")).alias("usd_value"),
    )
    return (
        split.groupBy("from_address", "to_address")
        .agg(*_measures(), *_ends("hash"))
        .select("from_address", "to_address", *MEASURES, md5_bucket("from_address").alias("pt"))
    )


def utxo_transfers_by_receiver(transfers: DataFrame) -> DataFrame:
    """The same edges, bucketed by the receiving address."""
    return transfers.withColumn("pt", md5_bucket("to_address"))


def _native_edges(
    traces: DataFrame, tx: DataFrame, price: DataFrame, backfill: DataFrame | None, rank_after_filter: bool
) -> DataFrame:
    ok = F.coalesce(F.col("receipt_status") == 1, F.lit(False))
    met = packed_ends(native_transfers(traces)).join(
        receipt_status(tx, backfill).withColumnRenamed("hash", "transaction_hash"), "transaction_hash", "left"
    )
    rows = with_native_price(met, price)
    if rank_after_filter:
        rows = rows.where(ok)
    ranked = F.struct("block_timestamp", "block_number", "transaction_hash", ok.alias("ok"))
    edges = unpacked_ends(
        rows.groupBy("from_address", "to_address").agg(
            *_measures(ok), F.min(ranked).alias("first"), F.max(ranked).alias("last")
        )
    )
    named = lambda c: F.when(F.col(f"{c}.ok"), F.col(f"{c}.transaction_hash"))
    return edges.where(F.col("transaction_cnt") > 0).select(
        "from_address",
        "to_address",
        F.lit(ZERO_ADDRESS).alias("token_address"),
        F.lit("eth").alias("symbol"),
        *[
            named(c.split("_")[0]).alias(c) if c.endswith("transaction_hash") else F.col(c)
            for c in MEASURES
        ],
        hex_bucket("from_address").alias("pt"),
    )


def _token_edges(direct: DataFrame, token_price: DataFrame) -> DataFrame:
    """Edges of whitelisted tokens. `direct` comes from `direct_token_transfers(..., scale="divide")`."""
    prices = token_price.select("address", "price_day", "price", "symbol").distinct().select(
        F.col("address").alias("token_address"), F.col("price_day").alias("_day"), "price"
    )
    rows = (
        direct.where(F.col("from_address").isNotNull() & F.col("to_address").isNotNull())
        .withColumn("_day", F.to_date("block_timestamp"))
        .join(prices, ["token_address", "_day"], "left")
        .withColumn("usd_value", F.col("value") * F.coalesce(F.col("price"), F.lit(0.0)))
    )
    return (
        rows.groupBy("from_address", "to_address", "token_address")
        .agg(F.min("symbol").alias("symbol"), *_measures(), *_ends("transaction_hash"))
        .select(
            "from_address", "to_address", "token_address", "symbol", *MEASURES, hex_bucket("from_address").alias("pt")
        )
    )


def token_transfers_graph(
    traces: DataFrame,
    tx: DataFrame,
    direct: DataFrame,
    token_price: DataFrame,
    backfill: DataFrame | None = None,
    rank_after_filter: bool = False,
) -> DataFrame:
    """Edges per (sender, receiver, token): successful native transfers and direct token transfers.

    As published, an edge's first and last hash are looked up before failed transactions are taken
    out and are NULL if that transaction failed; `rank_after_filter` looks among successful ones.
    """
    return union_all(
        [_native_edges(traces, tx, token_price, backfill, rank_after_filter), _token_edges(direct, token_price)]
    )


def token_transfers_by_receiver(transfers: DataFrame) -> DataFrame:
    """The same edges, bucketed by the receiving address."""
    return transfers.withColumn("pt", hex_bucket("to_address"))
