"""Transfers of the account chain: native coin and whitelisted tokens, with status and price."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txloom.functions.columns import ZERO_ADDRESS, day_of, day_slice, packed, safe_numeric, unpacked
from txloom.functions.relations import union_all, union_distinct

TRANSFER_SELECTOR = "0xa9059cbb"  # fixed value: call of a token's own transfer method
WEI_DIGITS = 18


def token_price_daily(history: DataFrame, current: DataFrame) -> DataFrame:
    """One price and symbol per token and day. Of several, the smallest is taken."""
    columns = ["address", "timestamp", "price", "symbol"]
    return (
        union_all([history.select(*columns), current.select(*columns)])
        .groupBy("address", day_of("timestamp").alias("price_day"))
        .agg(F.min("price").alias("price"), F.min("symbol").alias("symbol"))
    )


def successful_tx(tx: DataFrame, backfill: DataFrame, as_bytes: bool = False) -> DataFrame:
    """Hashes with status 1 in either table, as text or `packed`."""
    ok, form = F.col("receipt_status") == 1, packed if as_bytes else F.col
    return union_distinct(
        tx.where(ok).select(form("hash").alias("hash")), backfill.where(ok).select(form("transaction_hash").alias("hash"))
    )


def receipt_status(tx: DataFrame, backfill: DataFrame | None) -> DataFrame:
    """(hash, receipt_status), a status in the back-fill table going first."""
    own = tx.select("hash", F.col("receipt_status").alias("own_status"))
    if backfill is None:
        return own.select("hash", F.col("own_status").alias("receipt_status"))
    late = backfill.select(F.col("transaction_hash").alias("hash"), F.col("receipt_status").alias("late_status"))
    return own.join(late, "hash", "left").select(
        "hash", F.coalesce("late_status", "own_status").alias("receipt_status")
    )


ENDS = ("from_address", "to_address")  # what a transfer mostly consists of


def packed_ends(transfers: DataFrame) -> DataFrame:
    """Transfers with both addresses as bytes, for the way to the task of their transaction."""
    return transfers.withColumns({c: packed(c) for c in ENDS})


def unpacked_ends(transfers: DataFrame) -> DataFrame:
    return transfers.withColumns({c: unpacked(c) for c in ENDS})


def of_transactions(transfers: DataFrame, hashes: DataFrame) -> DataFrame:
    """The transfers whose transaction is among `hashes` (transaction_hash, as text or `packed`; transfers have text).

    An inner join with distinct hashes, as Spark would move a semi-join, and its shuffle, below the packing.
    """
    key = "transaction_hash"
    as_bytes = dict(hashes.dtypes)[key] == "binary"
    moved = packed_ends(transfers.withColumn(key, packed(key)) if as_bytes else transfers)
    met = unpacked_ends(moved.join(hashes.select(key).distinct(), key))
    return met.withColumn(key, unpacked(key)) if as_bytes else met


def native_transfers(traces: DataFrame, both_ends: bool = True, scale: str = "divide") -> DataFrame:
    """Traces that moved native coin, in coins.

    `scale` picks value / 10^18 or value * 10^-18; the two differ in the last bit.
    """
    amount = F.col("value").cast("double")
    coins = amount / F.lit(1e18) if scale == "divide" else amount * F.lit(1e-18)
    rows = traces.where((F.col("value") > 0) & F.col("to_address").isNotNull())
    if both_ends:
        rows = rows.where(F.col("from_address").isNotNull())
    return rows.select(
        "transaction_hash", "from_address", "to_address", coins.alias("value"), "block_number", "block_timestamp"
    )


def with_native_price(transfers: DataFrame, token_price: DataFrame) -> DataFrame:
    """Add usd_value from the native coin's day price, 0 where there is none."""
    native = token_price.where(F.col("address") == ZERO_ADDRESS).select(F.col("price_day").alias("_day"), "price")
    return (
        transfers.join(F.broadcast(native), day_of("block_timestamp") == F.col("_day"), "left")
        .withColumn("usd_value", F.col("value") * F.coalesce(F.col("price"), F.lit(0.0)))
        .drop("_day", "price")
    )


def succeed_transfers(
    traces: DataFrame,
    tx: DataFrame,
    token_price: DataFrame,
    backfill: DataFrame | None = None,
    run_date: date | None = None,
) -> DataFrame:
    """Native transfers of successful transactions with USD value and partition day.

    Without `run_date` this is the build of the whole history.
    """
    own = day_slice(tx, run_date).withColumn("hash", packed("hash"))
    late = None if backfill is None else backfill.withColumn("transaction_hash", packed("transaction_hash"))
    ok = receipt_status(own, late).where(F.col("receipt_status") == 1)
    done = of_transactions(native_transfers(day_slice(traces, run_date)), ok.select(F.col("hash").alias("transaction_hash")))
    return with_native_price(done, token_price).select(
        F.col("transaction_hash").alias("hash"),
        "from_address",
        "to_address",
        "value",
        "usd_value",
        day_of("block_timestamp").alias("pt"),
    )


def valid_tokens(token_price: DataFrame, decimals: Sequence[DataFrame]) -> DataFrame:
    """(token_address, symbol, decimals) of priced tokens whose decimals are known."""
    known = union_all([d.select("address", "decimals") for d in decimals]).where(F.col("decimals").isNotNull())
    return (
        token_price.select("address", "symbol")
        .distinct()
        .join(known, "address")
        .select(F.col("address").alias("token_address"), "symbol", "decimals")
    )


def listed_token_transfers(
    token_transfers: DataFrame, tokens: DataFrame, run_date: date | None = None, scale: str = "multiply"
) -> DataFrame:
    """Transfers of whitelisted tokens, in token units. The whitelist is small, a row a priced token, so it is sent to all tasks."""
    amount = safe_numeric("value").cast("double")
    digits = F.col("decimals").try_cast("long") if scale == "divide" else F.col("decimals").cast("long")
    units = amount / F.pow(F.lit(10.0), digits) if scale == "divide" else amount * F.pow(F.lit(10.0), -digits)
    return day_slice(token_transfers, run_date).join(F.broadcast(tokens), "token_address").select(
        "transaction_hash",
        "from_address",
        "to_address",
        "token_address",
        "block_timestamp",
        "block_number",
        units.alias("value"),
        "symbol",
    )


def direct_calls(tx: DataFrame, run_date: date | None = None) -> DataFrame:
    """Hashes, `packed`, of the transactions that call a token's own transfer method."""
    return day_slice(tx, run_date).where(F.col("input").startswith(TRANSFER_SELECTOR)).select(
        packed("hash").alias("transaction_hash")
    )


def direct_token_transfers(
    token_transfers: DataFrame,
    tx: DataFrame,
    tokens: DataFrame,
    run_date: date | None = None,
    scale: str = "multiply",
) -> DataFrame:
    """Transfers of whitelisted tokens made by a direct call of the token, in token units.

    The whitelist is joined first: it drops most rows before the join of the two big tables on transaction hash.
    """
    return of_transactions(listed_token_transfers(token_transfers, tokens, run_date, scale), direct_calls(tx, run_date))


def priced_transfers(
    traces: DataFrame,
    token_transfers: DataFrame,
    tx: DataFrame,
    token_price: DataFrame,
    decimals: Sequence[DataFrame],
    run_date: date | None = None,
    successful: DataFrame | None = None,
    least_usd: float | None = None,
) -> DataFrame:
    """Native and direct token transfers that have a price on their day, with usd_value.

    `successful` (hashes, see `successful_tx`) restricts native transfers; token transfers are
    recorded for successful calls only. `least_usd` asks for the transfers of at least this value: token transfers
    are then priced first, so that smaller ones do not travel to their transaction.
    """
    prices = day_slice(token_price, run_date, column="price_day").select(
        F.col("address").alias("token_address"), F.col("price_day").alias("_day"), "price"
    )
    native = native_transfers(day_slice(traces, run_date), both_ends=False, scale="multiply")
    if successful is not None:
        native = of_transactions(native, successful.select(F.col("hash").alias("transaction_hash")))
    # all native transfers share one token address; they join on the day alone, a row per day
    native = native.withColumn("_day", day_of("block_timestamp")).join(
        F.broadcast(prices.where(F.col("token_address") == ZERO_ADDRESS)), "_day"
    ).withColumn("symbol", F.lit("eth"))

    def with_price(transfers: DataFrame) -> DataFrame:
        token_prices = prices.where(F.col("token_address") != ZERO_ADDRESS)
        return transfers.withColumn("_day", day_of("block_timestamp")).join(token_prices, ["token_address", "_day"])

    def in_usd(priced: DataFrame) -> DataFrame:
        return priced.withColumn("usd_value", F.col("value") * F.coalesce(F.col("price"), F.lit(0.0))).drop("_day", "price")

    listed, calls = listed_token_transfers(token_transfers, valid_tokens(token_price, decimals), run_date), direct_calls(tx, run_date)
    if least_usd is None:
        return in_usd(union_all([native, with_price(of_transactions(listed, calls)).select(*native.columns)]))
    large = F.col("usd_value") >= least_usd
    native = in_usd(native).where(large)
    tokens = of_transactions(in_usd(with_price(listed)).where(large), calls)
    return union_all([native, tokens.select(*native.columns)])
