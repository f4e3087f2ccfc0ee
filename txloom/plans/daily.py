"""The daily runs: raw tables to stored facts, tags, marts and scores.

Each step stores a table and the next one reads it, as the jobs of the reference do. `tables` maps
input names (see `schemas.INPUTS`) to DataFrames, `out` is the folder of the results.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txloom.functions.columns import COARSE_BEFORE, MONTH_COLUMN
from txloom.operators import (
    coinjoin,
    daily_stats,
    fees,
    large_value,
    protocols,
    score,
    tag_views,
    taint,
    token_flow,
    transfer_graph,
    value_flow,
)
from txloom.sources import marts, sinks

Tables = Mapping[str, DataFrame]


def utxo_facts(tables: Tables, out: str, run_date: date | None = None) -> None:
    """Value flow, its daily statistics, large-value tags and block fees for one day (or all days)."""
    tx = tables["utxo_transactions"]
    spark = tx.sparkSession
    if run_date and run_date - timedelta(days=1) < COARSE_BEFORE:
        # the day's partition is its month; it is replaced as a whole, so it is rebuilt as a whole
        month = (run_date - timedelta(days=1)).replace(day=1)
        after = (month + timedelta(days=31)).replace(day=1)
        of_month = (F.col("block_timestamp") >= F.lit(month)) & (F.col("block_timestamp") < F.lit(after))
        if MONTH_COLUMN in tx.columns:
            of_month = of_month & (F.col(MONTH_COLUMN) == F.lit(month))
        flow = value_flow.utxo_value_flow(tx.where(of_month), tables["day_price"])
    else:
        flow = value_flow.utxo_value_flow(tx, tables["day_price"], run_date)
    day = run_date - timedelta(days=1) if run_date else None
    partition = day.replace(day=1) if day and day < COARSE_BEFORE else day
    sinks.reload_partitions(flow, f"{out}/value_flow", "partition_date", ["hash"], [partition] if run_date else None)
    flow = spark.read.parquet(f"{out}/value_flow")
    stats = daily_stats.utxo_stat_daily(flow, run_date)
    sinks.reload_partitions(stats, f"{out}/stat_daily", "block_date", ["addr_pt", "address"], [day] if run_date else None)
    run = run_date.isoformat() if run_date else "0000-00-00"
    sinks.append_run(spark, f"{out}/large_value", run, lambda kept: large_value.utxo_large_value(flow, run_date, kept))
    sinks.append_run(spark, f"{out}/block_fee", run, lambda kept: fees.block_fee_moving_avg(tx, run_date, kept))


def utxo_graph(flow: DataFrame, out: str, table: str = "utxo_transfers") -> None:
    """Transfer edges in both physical orders, as marts `table` and `table`_2."""
    _both_orders(transfer_graph.utxo_transfers(flow), transfer_graph.utxo_transfers_by_receiver, out, table)


def token_graph(tables: Tables, out: str, table: str = "token_transfers") -> None:
    """Native and token edges in both physical orders, as marts `table` and `table`_2."""
    tx, price, late = tables["account_transactions"], tables["token_price"], tables["status_backfill"]
    tokens = token_flow.valid_tokens(price, [tables["token_decimals"]])
    direct = token_flow.direct_token_transfers(tables["token_transfers"], tx, tokens, scale="divide")
    edges = transfer_graph.token_transfers_graph(tables["traces"], tx, direct, price, late)
    _both_orders(edges, transfer_graph.token_transfers_by_receiver, out, table)


def _both_orders(edges: DataFrame, by_receiver: Callable[[DataFrame], DataFrame], out: str, table: str) -> None:
    """Edges are computed once; what deals them to buckets, and the second order, read the stored ones."""
    spark = edges.sparkSession
    sinks.reload(edges, f"{out}/edges")
    stored = spark.read.parquet(f"{out}/edges")
    marts.write_mart(stored, table, f"{out}/transfers", "from_address", ["to_address"])
    marts.write_mart(by_receiver(stored), f"{table}_2", f"{out}/transfers_2", "to_address", ["from_address"])


def utxo_risk(tables: Tables, union_tags: DataFrame, out: str, now: datetime) -> DataFrame:
    """Mixers, seed labels, exposure and score, each stored before the next step reads it."""
    tx, price, curated = tables["utxo_transactions"], tables["day_price"], tables["seed_labels"]
    spark = tx.sparkSession
    mixers = coinjoin.coinjoin_address_score(tx, price)
    sinks.reload(tag_views.utxo_seed_tags(curated, mixers), f"{out}/seed_tags")
    seeds = spark.read.parquet(f"{out}/seed_tags")

    def keep(name: str, frame: DataFrame) -> DataFrame:
        sinks.reload(frame, f"{out}/exposure/{name}")
        return spark.read.parquet(f"{out}/exposure/{name}")

    sinks.reload(taint.taint_propagation(tx, price, seeds, curated, keep), f"{out}/propagated_tags")
    propagated = spark.read.parquet(f"{out}/propagated_tags")
    scores = score.utxo_address_score(propagated, union_tags, tables["risk_weights"], now)
    sinks.reload(scores, f"{out}/scores")
    marts.write_mart(spark.read.parquet(f"{out}/scores"), "utxo_address_score", f"{out}/address_score")
    return spark.read.parquet(f"{out}/address_score")


def account_facts(tables: Tables, out: str, run_date: date | None = None) -> None:
    """Succeeded native transfers and token statistics for one day (or all days)."""
    tx, price, late = tables["account_transactions"], tables["token_price"], tables["status_backfill"]
    moved = token_flow.succeed_transfers(tables["traces"], tx, price, late, run_date)
    days = [run_date - timedelta(days=1)] if run_date else None
    sinks.reload_partitions(moved, f"{out}/succeed_transfers", "pt", ["hash"], days)
    transfers = token_flow.priced_transfers(
        tables["traces"],
        tables["token_transfers"],
        tx,
        price,
        [tables["token_decimals"]],
        run_date,
        successful=token_flow.successful_tx(tx, late, as_bytes=True),
    )
    stats = daily_stats.token_stat_daily(transfers, tx, run_date)
    sinks.reload_partitions(stats, f"{out}/token_stat_daily", "block_date", ["addr_pt", "address"], days)


def account_risk(tables: Tables, union_tags: DataFrame, out: str, now: datetime) -> DataFrame:
    """Exposure over stored transfers, and the score."""
    spark = union_tags.sparkSession
    transfers = spark.read.parquet(f"{out}/succeed_transfers")
    sinks.reload(taint.account_exposure(transfers, tables["account_labels"]), f"{out}/propagated_tags")
    propagated = spark.read.parquet(f"{out}/propagated_tags")
    scores = score.account_address_score(tables["account_labels"], propagated, union_tags, tables["risk_weights"], now)
    sinks.reload(scores, f"{out}/scores")
    marts.write_mart(spark.read.parquet(f"{out}/scores"), "account_address_score", f"{out}/address_score")
    return spark.read.parquet(f"{out}/address_score")


def protocol_tables(tables: Tables, out: str, run_date: date | None = None) -> DataFrame:
    """User tables of all specs in one pass, new addresses only, appended to the stored ones."""
    tx, events = tables["account_transactions"], tables["protocol_events"]
    return sinks.append_run(
        tx.sparkSession,
        f"{out}/protocol_users",
        run_date.isoformat() if run_date else "0000-00-00",
        lambda kept: protocols.protocol_user_tables(tx, events, protocols.PROTOCOLS, run_date, kept),
    )
