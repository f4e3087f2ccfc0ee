"""Every operator as a query over the chain tables derived from the sample data.

All queries read whole tables. Doubles are rounded so that sums taken in another order compare equal.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField

from txloom.functions.columns import day_slice, hex_bucket, md5_bucket, safe_numeric
from txloom.functions.relations import accumulate, new_only, tag_rows, union_all
from txloom.operators import account_activity as activity
from txloom.operators import (
    coinjoin,
    daily_stats,
    fast_tx,
    fees,
    inactivity,
    large_value,
    protocols,
    score,
    spending,
    tag_views,
    taint,
    token_flow,
    transfer_graph,
    value_flow,
)
from txloom.sources import derived as src
from txloom.sources import marts, sinks
from txloom.sources.staging import staged, staging_root

Query = Callable[[SparkSession, str], DataFrame]

COINS, USD, TOKEN_USD, WEIGHT = 6, 2, 4, 6
NOW = datetime(2001, 8, 2)
BATCH_FROM = date(2001, 7, 1)  # inactivity: state from the rows before, batch from the rows since
SHORT = inactivity.Horizon(gap=40, inactive=45, expire_partition=90, expire=100)
SHORT_DAILY = inactivity.Horizon(gap=40, inactive=45, expire_partition=90, expire=100, coarse_partitions=False)
POOLS_SINCE = date(1995, 1, 1)


def portable(df: DataFrame) -> DataFrame:
    """Types that any client shows alike: days as text, block numbers and counts that may be NULL as double."""
    as_double = {"tx_cnt", "in_tx_cnt", "out_tx_cnt", "transaction_cnt"}

    def column(field: StructField) -> Column:
        if isinstance(field.dataType, DateType):
            return F.col(field.name).cast("string")
        if field.name in as_double or field.name.endswith("_block_num"):
            return F.col(field.name).cast("double")
        return F.col(field.name)

    return df.select(*[column(f).alias(f.name) for f in df.schema.fields])


def _portable(query: Query) -> Query:
    return lambda spark, sf: portable(query(spark, sf))


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


# --- stored tables --------------------------------------------------------------------------------


def stored_addresses(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses earlier runs are taken to have stored: every second UTXO address of the ledger."""
    n = F.col("l_partkey") % 500
    return (
        src.table(spark, sf, "lineitem")
        .where(n % 2 == 0)
        .select(F.concat(F.lit("a"), n.cast("string")).alias("address"), n.alias("n"))
        .distinct()
    )


def stored_accounts(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("l_partkey") % 400
    return src.table(spark, sf, "lineitem").where(n % 2 == 0).select(src.account(n).alias("address"), n.alias("n")).distinct()


# --- UTXO chain -----------------------------------------------------------------------------------


def flow(spark: SparkSession, sf: str) -> DataFrame:
    return value_flow.utxo_value_flow(src.utxo_transactions(spark, sf), src.day_price(spark, sf))


def tx_by_hash(spark: SparkSession, sf: str) -> DataFrame:
    """What the jobs read of the transactions, stored by hash by the first of a chain of jobs that each need them so."""
    columns = ("hash", "block_number", "block_timestamp", "input_count", "output_count", "inputs", "outputs")
    return staged(spark, src._key(spark, sf, "tx_by_hash"), lambda: src.utxo_transactions(spark, sf).select(*columns), by="hash")


def stored_flow(spark: SparkSession, sf: str, tx: DataFrame | None = None) -> DataFrame:
    """The value-flow table as its daily job leaves it, by transaction; marts and tags read the stored table.

    A chain of jobs that has the transactions by hash passes them as `tx`.
    """
    build = lambda: flow(spark, sf) if tx is None else value_flow.utxo_value_flow(tx, src.day_price(spark, sf))
    return staged(spark, src._key(spark, sf, "value_flow"), build, by="hash", dealt=True)


def q_utxo_value_flow(spark, sf):
    usd = {f"{s}_usd_value": USD for s in ("in", "out", "net")}
    return rounded(flow(spark, sf), in_value=COINS, out_value=COINS, net_value=COINS, **usd)


def q_price_daily(spark, sf):
    closes = value_flow.daily_close(src.klines(spark, sf), src.price_backfill(spark, sf))
    return closes.select("price_timestamp", F.col("price").cast("double").alias("price"))


def q_block_fee_ma(spark, sf):
    return rounded(fees.block_fee_moving_avg(src.utxo_transactions(spark, sf)), fee_per_byte=4)


def q_coinjoin_tx(spark, sf):
    return coinjoin.coinjoin_tx(src.utxo_transactions(spark, sf))


def _mixers(spark, sf, stored=None):
    return coinjoin.coinjoin_address_score(src.utxo_transactions(spark, sf), src.day_price(spark, sf), stored=stored)


def q_coinjoin_score(spark, sf):
    old = stored_addresses(spark, sf).select(
        "address",
        F.lit("mixer").alias("feature"),
        F.lit(None).cast("string").alias("name"),
        F.lit("P015").alias("plots"),
        F.lit(0.5).alias("score"),
    )
    return rounded(_mixers(spark, sf, old), score=WEIGHT)


def q_mimo(spark, sf):
    old = stored_addresses(spark, sf).select(
        F.concat(F.lit("s"), F.col("n").cast("string")).alias("address"),
        F.lit("mimo").alias("feature"),
        F.lit(None).cast("string").alias("name"),
        F.lit("P109").alias("plots"),
    )
    return coinjoin.mimo_addresses(src.utxo_transactions(spark, sf), stored=old)


def _fast_utxo(spark, sf, gap="reference"):
    keep = lambda frame: staged(spark, src._key(spark, sf, f"fast_tx_rapid_{gap}"), lambda: frame)
    return fast_tx.utxo_fast_tx(src.utxo_transactions(spark, sf), gap=gap, keep=keep)


def q_fast_tx_utxo(spark, sf):
    return _fast_utxo(spark, sf)


def q_fast_tx_utxo_elapsed(spark, sf):
    return _fast_utxo(spark, sf, "elapsed")


def _high_fee_utxo(spark, sf, stored=None):
    """The means of blocks are a table of their own job; its known size decides how it meets the transactions."""
    tx = src.utxo_transactions(spark, sf)
    means = staged(spark, src._key(spark, sf, "block_fees"), lambda: fees.block_fee_moving_avg(tx))
    return fees.utxo_high_fee(tx, means, stored=stored)


def q_high_fee_utxo(spark, sf):
    return _high_fee_utxo(spark, sf, stored_addresses(spark, sf))


def q_large_value_utxo(spark, sf):
    return large_value.utxo_large_value(stored_flow(spark, sf), stored=stored_addresses(spark, sf))


def q_large_value_utxo_by_tier(spark, sf):
    """New tiers of addresses whose first tier is stored."""
    stored = stored_addresses(spark, sf).select("address", F.lit(1).alias("idx"))
    return large_value.utxo_large_value(stored_flow(spark, sf), stored=stored, new_only_on=("address", "idx"))


def q_coinbase_miners(spark, sf):
    return spending.coinbase_miners(src.utxo_transactions(spark, sf))


def q_frequent_io(spark, sf):
    old = stored_addresses(spark, sf).select("address", (F.col("n") % 15).alias("min_gap"))
    return spending.frequent_io(src.utxo_transactions(spark, sf), stored=old)


def _inactivity(
    rows: DataFrame, ts: Column, horizon: inactivity.Horizon, stored: DataFrame, keep: Callable[[DataFrame], DataFrame]
) -> inactivity.InactivityTables:
    before, since = rows.where(ts < F.lit(BATCH_FROM)), rows.where(ts >= F.lit(BATCH_FROM))
    state = keep(inactivity.last_activity_history(before, horizon))
    old = F.lit(NOW.replace(year=2000))
    kept = stored.where(F.col("n") % 10 == 0)
    tables = inactivity.InactivityTables(
        state=state,
        inactive=kept.select("address", old.cast("timestamp_ntz").alias("latest_activate_timestamp"), old.alias("create_time")),
        periodic=kept.select("address", old.alias("create_time")),
    )
    return inactivity.inactivity_step(tables, since, NOW, horizon)


def _utxo_inactivity(spark, sf):
    rows = inactivity.utxo_activity(stored_flow(spark, sf))
    keep = lambda state: staged(spark, src._key(spark, sf, "utxo_last_activity"), lambda: state)
    return _inactivity(rows, F.col("block_timestamp"), SHORT, stored_addresses(spark, sf), keep)


def _account_inactivity(spark, sf):
    rows = inactivity.account_activity(src.account_transactions(spark, sf), backfill=src.status_backfill(spark, sf))
    keep = lambda state: staged(spark, src._key(spark, sf, "account_last_activity"), lambda: state)
    return _inactivity(rows, F.col("block_timestamp"), SHORT_DAILY, stored_accounts(spark, sf), keep)


def q_inactivity_last_activity(spark, sf):
    return _utxo_inactivity(spark, sf).state


def q_inactivity_periodic(spark, sf):
    return _utxo_inactivity(spark, sf).periodic


def q_inactivity_inactive(spark, sf):
    return _utxo_inactivity(spark, sf).inactive


def q_inactivity_bootstrap(spark, sf):
    """The three history builds side by side, one row per address."""
    return _bootstrap(inactivity.utxo_activity(stored_flow(spark, sf)), SHORT)


def _bootstrap(rows: DataFrame, horizon: inactivity.Horizon) -> DataFrame:
    state = inactivity.last_activity_history(rows, horizon)
    back = inactivity.returning_history(rows, NOW, horizon.gap).select("address", F.lit(True).alias("is_periodic"))
    quiet = inactivity.inactive_history(rows, NOW, horizon.inactive).select("address", F.lit(True).alias("is_inactive"))
    return (
        state.join(back, "address", "left")
        .join(quiet, "address", "left")
        .select(
            "address",
            "latest_activate_timestamp",
            "pt",
            F.coalesce("is_periodic", F.lit(False)).alias("is_periodic"),
            F.coalesce("is_inactive", F.lit(False)).alias("is_inactive"),
        )
    )


def q_account_inactivity_last_activity(spark, sf):
    return _account_inactivity(spark, sf).state


def q_account_inactivity_periodic(spark, sf):
    return _account_inactivity(spark, sf).periodic


def q_account_inactivity_inactive(spark, sf):
    return _account_inactivity(spark, sf).inactive


def q_account_inactivity_bootstrap(spark, sf):
    rows = inactivity.account_activity(src.account_transactions(spark, sf), backfill=src.status_backfill(spark, sf))
    return _bootstrap(rows.where(F.col("address").isNotNull()), SHORT_DAILY)


def seed_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Curated labels and mixers; stored, because every relation of the propagation reads it."""
    build = lambda: tag_views.utxo_seed_tags(src.seed_labels(spark, sf), _mixers(spark, sf))
    return staged(spark, src._key(spark, sf, "seed_tags"), build)


def q_tags_seed_view(spark, sf):
    return rounded(tag_views.utxo_seed_tags(src.seed_labels(spark, sf), _mixers(spark, sf)), score=WEIGHT)


def _relation(fn):
    def query(spark, sf):
        labels = taint.labels_of(seed_tags(spark, sf))
        return rounded(fn(src.utxo_transactions(spark, sf), src.day_price(spark, sf), labels), sub_weight=WEIGHT)

    return query


def _distinct_relation(fn):
    """Weights that are equal after rounding are one row, as in the statement."""
    return lambda spark, sf: _relation(fn)(spark, sf).distinct()


def _taint(spark, sf):
    """The relations over stored transactions, totals and leading labels, as the published job has each once.

    What has a transaction's hash is stored by it: the steps within a transaction then need no shuffle. The ledgers are
    read off the transactions, which lie so already.
    """

    def keep(name: str, frame: DataFrame) -> DataFrame:
        if name in ("inputs", "outputs"):
            return frame
        return staged(spark, src._key(spark, sf, f"taint_{name}"), lambda: frame, by="hash" if "hash" in frame.columns else None)

    return taint.taint_propagation(
        tx_by_hash(spark, sf), src.day_price(spark, sf), seed_tags(spark, sf), src.seed_labels(spark, sf), keep
    )


def q_taint_all(spark, sf):
    return rounded(_taint(spark, sf), sub_weight=WEIGHT)


def tag_table(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A tag table, stored once as its daily job leaves it; the views read it."""
    return staged(spark, src._key(spark, sf, f"tag_{name}"), build)


def utxo_tags(spark: SparkSession, sf: str) -> DataFrame:
    tx = src.utxo_transactions(spark, sf)
    flow = stored_flow(spark, sf)
    return tag_views.utxo_union_tags(
        tag_table(spark, sf, "utxo_fast_tx", lambda: _fast_utxo(spark, sf)),
        tag_table(spark, sf, "utxo_high_fee", lambda: _high_fee_utxo(spark, sf)),
        tag_table(spark, sf, "utxo_large_value", lambda: large_value.utxo_large_value(flow)),
        tag_table(spark, sf, "utxo_mimo", lambda: coinjoin.mimo_addresses(tx)),
        tag_table(spark, sf, "utxo_inactive", lambda: _utxo_inactivity(spark, sf).inactive),
        tag_table(spark, sf, "utxo_periodic", lambda: _utxo_inactivity(spark, sf).periodic),
    )


def q_tags_union_utxo(spark, sf):
    return utxo_tags(spark, sf)


def q_stat_daily_utxo(spark, sf):
    df = daily_stats.utxo_stat_daily(stored_flow(spark, sf))
    return _rounded_stats(df, USD)


def _rounded_stats(df: DataFrame, usd: int) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return rounded(df, **{c: usd if "usd" in c else COINS for c in doubles})


def _utxo_edges(spark, sf):
    return transfer_graph.utxo_transfers(stored_flow(spark, sf))


def q_transfers_utxo(spark, sf):
    return _rounded_stats(_utxo_edges(spark, sf), USD)


#: A guard that transactions of the samples reach.
SMALL_GUARD = 3


def q_transfers_utxo_guard(spark, sf):
    return _rounded_stats(transfer_graph.utxo_transfers(stored_flow(spark, sf), max_side=SMALL_GUARD), USD)


def q_transfers_utxo_wide(spark, sf):
    """Edges of transactions that hold the lines of a seventh of all blocks, without a guard."""
    wide = stored_flow(spark, sf).groupBy(F.concat(F.lit("w"), (F.col("block_number") % 7).cast("string")).alias("hash"), "address").agg(
        F.min("block_number").alias("block_number"),
        F.min("block_timestamp").alias("block_timestamp"),
        F.sum("net_value").alias("net_value"),
        F.sum("net_usd_value").alias("net_usd_value"),
    )
    return _rounded_stats(transfer_graph.utxo_transfers(wide, max_side=None), USD)


def q_transfers_utxo_left_out(spark, sf):
    return _rounded_stats(transfer_graph.utxo_transfers_left_out(stored_flow(spark, sf), SMALL_GUARD), USD)


def q_transfers_utxo_2(spark, sf):
    return _rounded_stats(transfer_graph.utxo_transfers_by_receiver(_utxo_edges(spark, sf)), USD)


def _score_columns(df: DataFrame) -> DataFrame:
    weight = lambda p: F.concat(p["plots"], F.lit(":"), F.round(p["weight"] * 1000).cast("long").cast("string"))
    return df.select(
        "address",
        F.round("total_score", 4).alias("total_score"),
        F.round("risk_score", WEIGHT).alias("risk_score"),
        F.array_join(F.transform("plot_weight", weight), ",").alias("plot_weight"),
        F.array_join("plots_list", ",").alias("plots_list"),
        "pt",
    )


def q_score_utxo(spark, sf):
    """Labels, exposure and behaviour tags to score. Tag tables are stored between the jobs."""
    propagated = staged(spark, src._key(spark, sf, "utxo_propagated"), lambda: _taint(spark, sf))
    stored_flow(spark, sf, tx_by_hash(spark, sf))
    tags = staged(spark, src._key(spark, sf, "utxo_union_tags"), lambda: utxo_tags(spark, sf))
    return _score_columns(score.utxo_address_score(propagated, tags, src.risk_weights(spark), NOW))


# --- account chain --------------------------------------------------------------------------------


def q_tx_cnt_fee(spark, sf):
    old = stored_accounts(spark, sf).select(
        "address", F.col("n").alias("total_tx_cnt"), (F.col("n") * 0.001).alias("total_fee")
    )
    return rounded(activity.address_tx_cnt_and_fee(src.account_transactions(spark, sf), stored=old), total_fee=10)


def q_tx_cnt_fee_zero(spark, sf):
    """Fee totals where a missing side counts as nothing."""
    old = stored_accounts(spark, sf).select(
        "address", F.col("n").alias("total_tx_cnt"), (F.col("n") * 0.001).alias("total_fee")
    )
    tx = src.account_transactions(spark, sf)
    return rounded(activity.address_tx_cnt_and_fee(tx, stored=old, null_fee_as_zero=True), total_fee=10)


def q_gas_ma(spark, sf):
    df = fees.block_gas_moving_avg(src.account_transactions(spark, sf))
    return rounded(df, **{f"gas_price_prev{n}_blk": 2 for n in (3, 6, 12)})


def _succeeded(spark, sf):
    return token_flow.succeed_transfers(
        src.traces(spark, sf), src.account_transactions(spark, sf), src.token_price(spark, sf), src.status_backfill(spark, sf)
    )


def q_succeed_transfers(spark, sf):
    return rounded(_succeeded(spark, sf), value=COINS, usd_value=USD)


def q_token_price_daily(spark, sf):
    return token_flow.token_price_daily(src.token_price_history(spark, sf), src.token_price_current(spark, sf))


def q_successful_tx(spark, sf):
    return token_flow.successful_tx(src.account_transactions(spark, sf), src.status_backfill(spark, sf))


def _priced(spark, sf, only_successful=False, least_usd=None):
    tx = src.account_transactions(spark, sf)
    ok = token_flow.successful_tx(tx, src.status_backfill(spark, sf), as_bytes=True) if only_successful else None
    return token_flow.priced_transfers(
        src.traces(spark, sf),
        src.token_transfers(spark, sf),
        tx,
        src.token_price(spark, sf),
        [src.token_decimals(spark, sf)],
        successful=ok,
        least_usd=least_usd,
    )


def _large_priced(spark, sf):
    """The transfers that reach a tier."""
    return _priced(spark, sf, least_usd=large_value.TIERS[0])


def q_stat_daily_token(spark, sf):
    df = daily_stats.token_stat_daily(_priced(spark, sf, True), src.account_transactions(spark, sf))
    return _rounded_stats(df, TOKEN_USD)


def q_stat_daily_token_value(spark, sf):
    """Turnover as value in and value out."""
    df = daily_stats.token_stat_daily(_priced(spark, sf, True), src.account_transactions(spark, sf), turnover="value")
    return _rounded_stats(df, TOKEN_USD)


def _token_edges(spark, sf, rank_after_filter=False):
    tx, price = src.account_transactions(spark, sf), src.token_price(spark, sf)
    tokens = token_flow.valid_tokens(price, [src.token_decimals(spark, sf)])
    direct = token_flow.direct_token_transfers(src.token_transfers(spark, sf), tx, tokens, scale="divide")
    late = src.status_backfill(spark, sf)
    return transfer_graph.token_transfers_graph(src.traces(spark, sf), tx, direct, price, late, rank_after_filter)


def q_transfers_token_ranked(spark, sf):
    """First and last hash among successful transactions."""
    return _rounded_stats(_token_edges(spark, sf, rank_after_filter=True), TOKEN_USD)


def q_transfers_token(spark, sf):
    return _rounded_stats(_token_edges(spark, sf), TOKEN_USD)


def q_transfers_token_2(spark, sf):
    return _rounded_stats(transfer_graph.token_transfers_by_receiver(_token_edges(spark, sf)), TOKEN_USD)


def _fast_account(spark, sf, gap="reference"):
    return fast_tx.account_fast_tx(src.account_transactions(spark, sf), gap=gap)


def q_fast_tx_account(spark, sf):
    return _fast_account(spark, sf)


def q_fast_tx_account_elapsed(spark, sf):
    return _fast_account(spark, sf, "elapsed")


def _high_fee_account(spark, sf, stored=None):
    tx = src.account_transactions(spark, sf)
    means = staged(spark, src._key(spark, sf, "gas_means"), lambda: fees.block_gas_moving_avg(tx))
    return fees.account_high_fee(tx, means, stored=stored)


def q_high_fee_account(spark, sf):
    return _high_fee_account(spark, sf, stored_accounts(spark, sf))


def q_large_value_account(spark, sf):
    return large_value.account_large_value(_large_priced(spark, sf), stored=stored_accounts(spark, sf))


def q_large_value_account_from(spark, sf):
    """Outgoing tags name the sender."""
    return large_value.account_large_value(_large_priced(spark, sf), stored=stored_accounts(spark, sf), out_side="from")


def q_contract_deployers(spark, sf):
    return activity.contract_deployers(src.account_transactions(spark, sf), stored=stored_accounts(spark, sf))


def q_propagated_account(spark, sf):
    return rounded(taint.account_exposure(_succeeded(spark, sf), src.account_labels(spark, sf)), sub_weight=WEIGHT)


def _nft(spark, sf, stored=None):
    return activity.nft_users(src.token_transfers(spark, sf), src.contracts(spark, sf), stored=stored)


def q_nft_users(spark, sf):
    old = stored_accounts(spark, sf).withColumn("address", F.concat(F.lit("0xs"), F.col("n").cast("string")))
    return _nft(spark, sf, tag_rows(old, "NFT user", "P801", 2))


def q_miners(spark, sf):
    return activity.miners(src.traces(spark, sf), seed=src.miner_seed(spark, sf))


def q_pools(spark, sf):
    every_second = src.logs(spark, sf).where(F.col("block_timestamp") < F.lit(date(1998, 1, 1)))
    stored = activity.uniswap_pools(every_second, since=POOLS_SINCE)
    return activity.uniswap_pools(src.logs(spark, sf), stored=stored, since=POOLS_SINCE)


def protocol_table(spark: SparkSession, sf: str, name: str, stored: DataFrame | None = None) -> DataFrame:
    """User table of one protocol."""
    tx = src.account_transactions(spark, sf)
    if name in protocols.PROTOCOLS:
        return protocols.protocol_users(tx, src.protocol_events(spark, sf), protocols.PROTOCOLS[name], stored=stored)
    return {
        "tornado_depositor": lambda: protocols.tornado_depositors(tx, stored=stored),
        "uniswap_trader": lambda: protocols.uniswap_traders(tx, stored=stored),
        "curve_trader": lambda: protocols.curve_traders(tx, src.logs(spark, sf), stored=stored),
        "ens_registrant": lambda: protocols.ens_registrants(src.protocol_events(spark, sf), stored),
        "ens_owner": lambda: protocols.ens_owners(src.protocol_events(spark, sf), stored),
    }[name]()


PROTOCOL_NAMES = (
    *[n for n in protocols.PROTOCOLS if n != "eth2_depositor"],
    "tornado_depositor",
    "uniswap_trader",
    "curve_trader",
    "ens_registrant",
    "ens_owner",
)


def _protocol_query(name: str) -> Query:
    def query(spark, sf):
        out = protocol_table(spark, sf, name, stored_accounts(spark, sf))
        if name == "ens_owner":
            out = out.withColumn("expire_timestamp", F.col("expire_timestamp").cast("timestamp_ntz"))
        return out

    return query


def user_tables(spark: SparkSession, sf: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """User tables by name; those that follow a spec share one pass over the transactions."""
    specs = {n: protocols.PROTOCOLS[n] for n in names if n in protocols.PROTOCOLS}
    tables = {n: protocol_table(spark, sf, n) for n in names if n not in specs}
    if specs:
        found = protocols.protocol_user_tables(
            src.account_transactions(spark, sf), src.protocol_events(spark, sf), specs
        )
        tables |= {n: found.where(F.col("table") == n) for n in specs}
    return tables


def category(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spec = tag_views.CATEGORIES[name]
    return tag_views.category_tags(spec, user_tables(spark, sf, spec.sources))


def protocol_users(spark: SparkSession, sf: str) -> DataFrame:
    """table, address of all user tables the categories read, stored once as the daily jobs leave them."""
    names = sorted({s for spec in tag_views.CATEGORIES.values() for s in spec.sources})
    build = lambda: union_all(
        [df.select("address", F.lit(n).alias("table")) for n, df in user_tables(spark, sf, names).items()]
    )
    return staged(spark, src._key(spark, sf, "protocol_users"), build)


def q_protocol_all_specs(spark, sf):
    """Every spec at once."""
    return protocols.protocol_user_tables(
        src.account_transactions(spark, sf), src.protocol_events(spark, sf), protocols.PROTOCOLS
    )


def others(spark: SparkSession, sf: str) -> DataFrame:
    return tag_views.others_tags(
        activity.contract_deployers(src.account_transactions(spark, sf)),
        protocol_table(spark, sf, "eth2_depositor"),
        _nft(spark, sf),
    )


def account_tags(spark: SparkSession, sf: str) -> DataFrame:
    tx = src.account_transactions(spark, sf)
    stored = lambda name, build: tag_table(spark, sf, f"account_{name}", build)
    return tag_views.account_union_tags(
        stored("fast_tx", lambda: _fast_account(spark, sf)),
        stored("high_fee", lambda: _high_fee_account(spark, sf)),
        stored("large_value", lambda: large_value.account_large_value(_large_priced(spark, sf))),
        stored("inactive", lambda: _account_inactivity(spark, sf).inactive),
        stored("periodic", lambda: _account_inactivity(spark, sf).periodic),
        tag_views.others_tags(
            stored("contract_deployers", lambda: activity.contract_deployers(tx)),
            stored("eth2_depositors", lambda: protocol_table(spark, sf, "eth2_depositor")),
            stored("nft_users", lambda: _nft(spark, sf)),
        ),
        tag_views.categories_of(protocol_users(spark, sf)),
    )


def q_tags_union_account(spark, sf):
    return account_tags(spark, sf)


def q_score_account(spark, sf):
    labels = src.account_labels(spark, sf)
    transfers = staged(spark, src._key(spark, sf, "succeed_transfers"), lambda: _succeeded(spark, sf))
    tags = staged(spark, src._key(spark, sf, "account_union_tags"), lambda: account_tags(spark, sf))
    propagated = taint.account_exposure(transfers, labels)
    return _score_columns(score.account_address_score(labels, propagated, tags, src.risk_weights(spark), NOW))


# --- primitives -----------------------------------------------------------------------------------


def q_hex_bucket(spark, sf):
    df = src.account_transactions(spark, sf).select(F.col("from_address").alias("address")).distinct()
    return df.select("address", hex_bucket("address").alias("hex_pt"), md5_bucket("address").alias("md5_pt"))


def q_safe_cast_numeric(spark, sf):
    df = src.token_transfers(spark, sf).select("value", safe_numeric("value").alias("n"))
    return df.groupBy("value").agg(F.max(F.col("n").cast("double")).alias("amount"), F.count("*").alias("cnt"))


def q_safe_offset(spark, sf):
    return src.logs(spark, sf).groupBy(F.get("topics", F.lit(0)).alias("topic")).agg(F.count("*").alias("cnt"))


def q_new_only(spark, sf):
    seen = src.account_transactions(spark, sf).select(F.col("from_address").alias("address")).distinct()
    return new_only(seen, stored_accounts(spark, sf))


def q_accumulate(spark, sf):
    seen = src.account_transactions(spark, sf).select(F.col("from_address").alias("address"))
    return accumulate(seen, stored_accounts(spark, sf))


def q_day_slice(spark, sf):
    """Two-day run window of the transfers, as the daily jobs cut it."""
    tx = day_slice(src.utxo_transactions(spark, sf), date(1998, 3, 1), days=2)
    return tx.select("hash", "block_number", "block_timestamp", "block_timestamp_month")


# --- sinks: given tables written below the shared folder and read back ------------------------------


def _folder(spark, name):
    return f"{staging_root(spark)}/sinks/{name}-{uuid4().hex}"


def _orders(spark, sf):
    return src.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("price"))


def q_sink_append(spark, sf):
    path, even = _folder(spark, "append"), F.col("o_orderkey") % 2 == 0
    sinks.append(_orders(spark, sf).where(even), path)
    sinks.append(_orders(spark, sf).where(~even), path)
    return spark.read.parquet(path)


def q_sink_partition_reload(spark, sf):
    """Two partitions are loaded again, one of them without rows."""
    path, orders = _folder(spark, "reload"), _orders(spark, sf)
    sinks.reload_partitions(orders, path, "o_orderstatus")
    sinks.reload_partitions(orders.where("o_orderstatus = 'O' AND price > 100000"), path, "o_orderstatus", values=["O", "F"])
    return spark.read.parquet(path).select(*orders.columns)


def q_sink_snapshot(spark, sf):
    """Two versions, the second from the first and new rows; the second run is repeated."""
    root, orders = _folder(spark, "snapshot"), _orders(spark, sf)
    old = F.col("o_orderkey") % 3 == 0
    sinks.update_snapshot(spark, root, "1", lambda kept: orders.where(old))
    for _ in range(2):
        last = sinks.update_snapshot(spark, root, "2", lambda kept: kept.unionByName(orders.where(~old)))
    return last


def _mart(spark, sf, name, df, address, cluster_by=()):
    """The mart `name` of the samples: one per application and input, replaced by each call."""
    table = src._key(spark, sf, f"mart_{name}").replace("-", "_")
    return marts.write_mart(df, table, f"{staging_root(spark)}/marts/{table}", address, cluster_by, buckets=16)


def q_sink_bucketed(spark, sf):
    """Orders as a mart by customer, with the published bucket number."""
    return _mart(spark, sf, "orders", _orders(spark, sf).withColumn("pt", F.col("o_custkey") % 16), "o_custkey", ["o_orderkey"])


def stored_edges(spark, sf):
    return staged(spark, src._key(spark, sf, "utxo_edges"), lambda: _utxo_edges(spark, sf))


def _edges_by_receiver(spark, sf):
    edges = transfer_graph.utxo_transfers_by_receiver(stored_edges(spark, sf))
    return _mart(spark, sf, "edges_2", edges, "to_address", ["from_address"])


def q_sink_second_order(spark, sf):
    """The edges of the transfer graph by receiver, from the stored ones."""
    return _rounded_stats(_edges_by_receiver(spark, sf), USD)


def q_sink_full_reload(spark, sf):
    """A table replaced as a whole, twice: the second rows alone stay."""
    path, orders = _folder(spark, "whole"), _orders(spark, sf)
    for kept in ("O", "F"):
        sinks.reload(orders.where(F.col("o_orderstatus") == kept), path)
    return spark.read.parquet(path)


def q_sink_new_only_runs(spark, sf):
    """Customers by the year of their first order, up to 1995: each run appends those that no earlier run has; one run is repeated,
    and the first runs are folded into one."""
    root = _folder(spark, "runs")
    orders = src.table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))
    for year in (1992, 1993, 1994, 1994, 1995):
        fresh = orders.where(F.col("year") == year).select("o_custkey", "year").distinct()
        sinks.append_run(spark, root, str(year), lambda kept, fresh=fresh: new_only(fresh, kept, ["o_custkey"]))
    sinks.compact_runs(spark, root, "1993")
    return sinks.read_runs(spark, root)


def q_mart_turnover(spark, sf):
    """What each address sent and received, from the two orders of the graph: grouped and joined without a shuffle."""
    sent = _mart(spark, sf, "edges", stored_edges(spark, sf), "from_address", ["to_address"])
    received = _edges_by_receiver(spark, sf)
    out = sent.groupBy(F.col("from_address").alias("address")).agg(F.sum("to_amount").alias("sent"), F.sum("transaction_cnt").cast("double").alias("out_cnt"))
    into = received.groupBy(F.col("to_address").alias("address")).agg(F.sum("to_amount").alias("received"), F.sum("transaction_cnt").cast("double").alias("in_cnt"))
    return rounded(out.join(into, "address", "full_outer"), sent=COINS, received=COINS)


_ALL: dict[str, Query] = {
    **{name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_")},
    "taint_common_input": _distinct_relation(taint.common_input),
    "taint_common_output": _distinct_relation(taint.common_output),
    "taint_direct_source": _relation(taint.direct_source),
    "taint_direct_dest": _relation(taint.direct_dest),
    "taint_indirect_source": _relation(taint.indirect_source),
    "taint_indirect_dest": _relation(taint.indirect_dest),
    **{f"protocol_{name}": _protocol_query(name) for name in PROTOCOL_NAMES},
    "eth2_depositors": _protocol_query("eth2_depositor"),
    **{f"category_{name}": (lambda s, d, n=name: category(s, d, n)) for name in tag_views.CATEGORIES},
    "category_others": others,
}

QUERIES: dict[str, Query] = {name: _portable(query) for name, query in _ALL.items()}
