"""Daily runs of the tag tables, and the tag views over what they store.

Every tag table is a folder of append-only runs below `out`/tags: a run writes the rows that no earlier run has and
nothing else. Views read the stored tables, one scan each, and never the raw chain.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txloom.functions.relations import new_rows, union_all
from txloom.operators import account_activity, coinjoin, fast_tx, fees, inactivity, large_value, protocols, tag_views, token_flow
from txloom.sources.sinks import append_run, read_runs
from txloom.streaming import incremental

Tables = Mapping[str, DataFrame]
Job = Callable[[DataFrame | None], DataFrame]

# The columns of the stored tag tables.
TAG = "address string, feature string, name string, plots string, idx int"
UTXO_TAGS = {
    "fast_tx": TAG,
    "high_fee": TAG,
    "large_value": "address string, feature string, plots string, idx int",
    "mimo": "address string, feature string, name string, plots string",
}
ACCOUNT_TAGS = {
    "fast_tx": "address string, feature string, plots string, idx int",
    "high_fee": TAG,
    "large_value": "address string, token_address string, symbol string, feature string, plots string, idx int",
    "nft_users": TAG,
    "contract_deployers": "address string, tx_timestamp timestamp, tag string",
}
USERS = "table string, address string, tx_timestamp timestamp, tag string"


def _run(run_date: date | None) -> str:
    return run_date.isoformat() if run_date else "0000-00-00"


def _sets(fresh: DataFrame) -> Job:
    """A table that is a set of rows."""
    return lambda kept: new_rows(fresh, kept)


def _append(spark: SparkSession, out: str, run_date: date | None, jobs: Mapping[str, Job]) -> None:
    for name, job in jobs.items():
        append_run(spark, f"{out}/tags/{name}", _run(run_date), job)


def stored_tag(spark: SparkSession, out: str, name: str, schema: str) -> DataFrame:
    """A stored tag table; empty if no run has written it."""
    found = read_runs(spark, f"{out}/tags/{name}")
    return spark.createDataFrame([], schema) if found is None else found


def utxo_tag_tables(tables: Tables, out: str, run_date: date | None = None) -> None:
    """Tag tables of the UTXO chain for the day before `run_date`, or for all days. Reads the stored value flow and block fees."""
    tx, price = tables["utxo_transactions"], tables["day_price"]
    spark = tx.sparkSession
    flow = spark.read.parquet(f"{out}/value_flow")
    block_fee = append_run(spark, f"{out}/block_fees", _run(run_date), lambda kept: fees.block_fee_moving_avg(tx, run_date, kept))
    _append(
        spark,
        out,
        run_date,
        {
            "mixers": _sets(coinjoin.coinjoin_address_score(tx, price, run_date)),
            "mimo": _sets(coinjoin.mimo_addresses(tx, run_date)),
            "fast_tx": _sets(fast_tx.utxo_fast_tx(tx, run_date)),
            "high_fee": lambda kept: fees.utxo_high_fee(tx, block_fee, run_date, kept),
            "large_value": lambda kept: large_value.utxo_large_value(flow, run_date, kept),
        },
    )


def account_tag_tables(tables: Tables, out: str, run_date: date | None = None) -> None:
    """Tag tables of the account chain for the day before `run_date`, or for all days."""
    tx, events, logs = tables["account_transactions"], tables["protocol_events"], tables["logs"]
    spark = tx.sparkSession
    gas = append_run(spark, f"{out}/gas_means", _run(run_date), lambda kept: fees.block_gas_moving_avg(tx, run_date, kept))
    transfers = token_flow.priced_transfers(
        tables["traces"], tables["token_transfers"], tx, tables["token_price"], [tables["token_decimals"]], run_date,
        least_usd=large_value.TIERS[0],
    )
    specs = {**protocols.PROTOCOLS}
    _append(
        spark,
        out,
        run_date,
        {
            "fast_tx": _sets(fast_tx.account_fast_tx(tx, run_date)),
            "high_fee": lambda kept: fees.account_high_fee(tx, gas, run_date, kept),
            "large_value": lambda kept: large_value.account_large_value(transfers, kept),
            "contract_deployers": lambda kept: account_activity.contract_deployers(tx, run_date, kept),
            "nft_users": _sets(account_activity.nft_users(tables["token_transfers"], tables["contracts"], run_date)),
            "miners": _sets(account_activity.miners(tables["traces"], run_date, tables.get("miner_seed"))),
            "pools": lambda kept: account_activity.uniswap_pools(logs, kept),
            "protocol_users": lambda kept: protocols.protocol_user_tables(tx, events, specs, run_date, kept),
            "tornado_depositor": lambda kept: protocols.tornado_depositors(tx, run_date, kept),
            "uniswap_trader": lambda kept: protocols.uniswap_traders(tx, run_date, kept),
            "curve_trader": lambda kept: protocols.curve_traders(tx, logs, run_date, kept),
            "ens_registrant": lambda kept: protocols.ens_registrants(events, kept),
            "ens_owner": lambda kept: protocols.ens_owners(events, kept),
        },
    )


def inactivity_tables(
    spark: SparkSession, activity: DataFrame, out: str, now: datetime, horizon: inactivity.Horizon = inactivity.UTXO_HORIZON
) -> inactivity.InactivityTables:
    """A run of the inactivity tables below `out`."""
    return incremental.run_inactivity(spark, f"{out}/inactivity", activity, now, horizon)


def utxo_tag_view(spark: SparkSession, out: str) -> DataFrame:
    """The UTXO chain's tags under common codes, from the stored tables: a scan of each and one shuffle."""
    tags = {name: stored_tag(spark, out, name, schema) for name, schema in UTXO_TAGS.items()}
    state = incremental.stored_inactivity(spark, f"{out}/inactivity")
    return tag_views.utxo_union_tags(**tags, inactive=state.inactive, periodic=state.periodic)


def account_tag_view(spark: SparkSession, out: str) -> DataFrame:
    """The account chain's tags under common codes, from the stored tables."""
    tags = {name: stored_tag(spark, out, name, schema) for name, schema in ACCOUNT_TAGS.items()}
    state = incremental.stored_inactivity(spark, f"{out}/inactivity")
    users = user_addresses(spark, out)
    eth2 = users.where(F.col("table") == "eth2_depositor")
    return tag_views.account_union_tags(
        tags["fast_tx"],
        tags["high_fee"],
        tags["large_value"],
        state.inactive,
        state.periodic,
        tag_views.others_tags(tags["contract_deployers"], eth2, tags["nft_users"]),
        tag_views.categories_of(users),
    )


def user_addresses(spark: SparkSession, out: str) -> DataFrame:
    """table, address of all stored protocol users."""
    named = [stored_tag(spark, out, "protocol_users", USERS).select("table", "address")]
    for name in ("uniswap_trader", "curve_trader"):
        named.append(stored_tag(spark, out, name, USERS).select(F.lit(name).alias("table"), "address"))
    return union_all(named)
