"""Running totals per account and one-column tags of the account chain."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txloom.functions.columns import day_slice
from txloom.functions.relations import accumulate, new_only, union_all

WEI = 1e-18
POOLS_SINCE = date(2018, 10, 10)
# fixed values: event topics of the pool factories
V3_POOL_TOPIC = "0x783cca1c0412dd0d695e784568c96da2e9c22ff989357a2e8b1d9b2b4e6b7118"
V2_POOL_TOPIC = "0x0d3648bd0f6ba80134a33ba9275ac585d9d315f0ad8355cddefde31afa28d0e9"


def address_tx_cnt_and_fee(
    tx: DataFrame,
    run_date: date | None = None,
    stored: DataFrame | None = None,
    null_fee_as_zero: bool = False,
) -> DataFrame:
    """Transactions touched and gas fees paid per address, added to the stored totals.

    As published, the fee becomes NULL for an address that is on one side only;
    `null_fee_as_zero` keeps the known part. New rows and stored rows meet in one aggregation.
    """
    fee = F.lit(WEI) * F.col("receipt_effective_gas_price") * F.col("receipt_gas_used")
    ends = F.array(
        F.struct(F.col("from_address").alias("address"), fee.alias("fee")),
        F.struct(F.col("to_address").alias("address"), F.lit(None).cast("double").alias("fee")),
    )
    fresh = (
        day_slice(tx, run_date)
        .select(F.inline(ends))
        .where(F.col("address").isNotNull())
        .select("address", "fee", F.lit(1).cast("long").alias("cnt"), F.lit(True).alias("is_fresh"))
    )
    if stored is None:
        return fresh.groupBy("address").agg(
            F.sum("cnt").alias("total_tx_cnt"), F.coalesce(F.sum("fee"), F.lit(0.0)).alias("total_fee")
        )
    kept = stored.select(
        "address", F.col("total_fee").alias("fee"), F.col("total_tx_cnt").alias("cnt"), F.lit(False).alias("is_fresh")
    )
    new = F.col("is_fresh")
    merged = union_all([fresh, kept]).groupBy("address").agg(
        F.sum("cnt").alias("total_tx_cnt"),
        F.max(F.when(new, F.lit(0.0))).alias("seen_now"),
        F.sum(F.when(new, F.col("fee"))).alias("new_fee"),
        F.sum(F.when(~new, F.col("fee"))).alias("old_fee"),
    )
    new_fee = F.coalesce(F.col("new_fee"), F.col("seen_now"))
    if null_fee_as_zero:
        total = F.coalesce(F.col("old_fee"), F.lit(0.0)) + F.coalesce(new_fee, F.lit(0.0))
    else:
        total = F.col("old_fee") + new_fee
    return merged.select("address", "total_tx_cnt", total.alias("total_fee"))


def contract_deployers(
    tx: DataFrame, run_date: date | None = None, stored: DataFrame | None = None
) -> DataFrame:
    """Senders of transactions without receiver, with the first such time."""
    found = (
        day_slice(tx, run_date)
        .where(F.col("to_address").isNull())
        .groupBy(F.col("from_address").alias("address"))
        .agg(F.min("block_timestamp").alias("tx_timestamp"))
        .withColumn("tag", F.lit("Contract deployer"))
    )
    return new_only(found, stored)


def nft_users(
    token_transfers: DataFrame, contracts: DataFrame, run_date: date | None = None, stored: DataFrame | None = None
) -> DataFrame:
    """Both ends of transfers of non-fungible tokens (P801, idx 2)."""
    nft = contracts.where(F.col("is_erc721")).select(F.col("address").alias("token_address"))
    users = (
        day_slice(token_transfers, run_date)
        .join(nft, "token_address", "left_semi")
        .select(F.explode(F.array("from_address", "to_address")).alias("address"))
        .select(
            "address",
            F.lit("NFT user").alias("feature"),
            F.lit(None).cast("string").alias("name"),
            F.lit("P801").alias("plots"),
            F.lit(2).alias("idx"),
        )
    )
    return accumulate(users, stored)


def miners(traces: DataFrame, run_date: date | None = None, seed: DataFrame | None = None) -> DataFrame:
    """Receivers of block and uncle rewards, with the rows of a seed table."""
    kind = F.when(F.col("reward_type") == "block", F.lit("miner")).when(
        F.col("reward_type") == "uncle", F.lit("uncle miner")
    )
    found = day_slice(traces, run_date).where(F.col("trace_type") == "reward").select("to_address", kind.alias("tags"))
    return accumulate(found, seed)


def _word_address(start: int) -> Column:
    return F.concat(F.lit("0x"), F.substring("data", start, 40))


def uniswap_pools(logs: DataFrame, stored: DataFrame | None = None, since: date = POOLS_SINCE) -> DataFrame:
    """Pool addresses read out of the factories' creation events."""
    topic = F.get("topics", F.lit(0))
    v3, v2 = topic == V3_POOL_TOPIC, topic == V2_POOL_TOPIC
    pools = logs.where((F.col("block_timestamp") >= F.lit(since)) & (v3 | v2)).select(
        F.when(v3, _word_address(27 + 64)).when(v2, _word_address(27)).alias("address"),
        F.col("block_timestamp").alias("tx_timestamp"),
        F.when(v3, F.lit("uniswap_v3_pool")).when(v2, F.lit("uniswap_v2(1)_pool")).alias("tag"),
    )
    return new_only(pools, stored)
