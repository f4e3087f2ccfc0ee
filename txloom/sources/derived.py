"""Chain-shaped tables derived from the sample star-schema tables.

A transaction is one row by contract, as in the chain exports this library reads: its input and
output arrays hold one order's lines. All tables grow with the files they are derived from.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txloom.functions.columns import ZERO_ADDRESS
from txloom.operators.account_activity import V2_POOL_TOPIC, V3_POOL_TOPIC
from txloom.operators.protocols import (
    CURVE_TOPICS,
    ENS_HASH_REGISTERED,
    ENS_REGISTERED,
    ENS_RENEWED,
    PROTOCOLS,
    TORNADO_PROXY,
    UNISWAP_V2_ROUTERS,
)
from txloom.operators.value_flow import daily_close
from txloom.operators.token_flow import token_price_daily
from txloom.sources.staging import files_key, staged

EPOCH = date(1995, 1, 1)  # day of block 0
TOKENS = 20
UNPRICED_TOKEN = 18
EVENT_PAIRS = sorted({(s.protocol, e) for s in PROTOCOLS.values() for e in s.events}) + [
    ("ens", e) for e in (*ENS_REGISTERED, *ENS_RENEWED, ENS_HASH_REGISTERED)
]

# (plots, idx) pairs of the weight table. P002 is left out: labels without weight must not count.
WEIGHTED_CODES = (
    [("P001", i) for i in range(7)]
    + [("P015", i) for i in range(7)]
    + [("P112", i) for i in (11, 12, 13)]
    + [("P121", i) for i in (10, 11)]
    + [("P401", i) for i in range(1, 7)]
    + [("P109", 1), ("P117", 4), ("P118", 5)]
    + [("P701", i) for i in (0, 1, 2, 3, 5, 6)]
    + [("P801", i) for i in (0, 1, 2)]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _key(spark: SparkSession, sf_dir: str, name: str) -> str:
    return f"{name}-{files_key(spark, sf_dir)}"


def _raw(spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """A raw chain table, written once per application as a chain export leaves it."""
    return staged(spark, _key(spark, sf_dir, name), lambda: build(spark, sf_dir))


def _md5(prefix: str, n: Column) -> Column:
    return F.md5(F.concat(F.lit(prefix), n.cast("string")).cast("binary"))


def account(n: Column) -> Column:
    return F.concat(F.lit("0x"), _md5("a", n))


def token(n: Column) -> Column:
    return F.concat(F.lit("0x"), _md5("tok", n))


def _block_number(ts: Column) -> Column:
    return F.datediff(F.to_date(ts), F.lit(EPOCH)).cast("long")


# --- UTXO chain -------------------------------------------------------------------------------


#: Orders whose keys agree but for this many low bits form a span, which one task gets.
SPAN_BITS = 10


def _span(key: Column) -> Column:
    return F.shiftright(key, SPAN_BITS)


def _line_address(n: Column) -> Column:
    return F.concat(F.lit("a"), (n % 500).cast("string"))


def _output(r: Column, i: Column) -> Column:
    """The output that line `r`, the `i`-th of its order, stands for."""
    part = r["l_partkey"]
    return F.struct(
        i.cast("long").alias("index"),
        ((F.floor(r["l_quantity"] / 17) + 1) * 100_000_000).cast("long").alias("value"),
        F.when((r["l_returnflag"] == "R") & (r["l_linestatus"] == "O"), F.lit("nulldata"))
        .otherwise(F.lit("pubkeyhash"))
        .alias("type"),
        F.when(part % 11 == 0, F.array(_line_address(part), _line_address(part + 7)))
        .otherwise(F.array(_line_address(part)))
        .alias("addresses"),
    )


def _orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its own lines and those of the order whose key is one lower, in a fixed order, as outputs.

    One shuffle of the rows as they are: lines and orders of a span of keys go to one task, lines of the span's last key
    also to the next span. There each key is a group, and the lower key is the group before. Sorted rows are grouped
    as they are read, so a task holds the lines of one order and, for the window, the orders of one span.
    """
    fields = [
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_shipdate", "l_returnflag", "l_linestatus",
    ]
    key = F.col("l_orderkey")
    spans = F.array_distinct(F.array(_span(key), _span(key + 1)))
    lines = (
        table(spark, sf_dir, "lineitem")
        .where(key.isNotNull())
        .select(F.explode(spans).alias("span"), key.alias("k"), F.struct(*fields).alias("line"))
    )
    order = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        _span(order).alias("span"), order.alias("k"), F.struct("o_orderdate", "o_totalprice").alias("order")
    )
    per_key = (
        lines.unionByName(orders, allowMissingColumns=True)
        .repartition("span")
        .sortWithinPartitions("span", "k")
        .groupBy("span", "k")
        .agg(F.collect_list("line").alias("rows"), F.collect_list("order").alias("orders"))
        .select("span", "k", "orders", F.transform(F.sort_array("rows"), _output).alias("lines"))
    )
    before = Window.partitionBy("span").orderBy("k")
    spent = F.when(F.lag("k").over(before) == F.col("k") - 1, F.lag("lines").over(before))
    return per_key.withColumn("spent_lines", spent).select("k", F.inline("orders"), "lines", "spent_lines")


def _build_utxo_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    coinbase = k % 50 == 0
    spent = F.transform(
        "spent_lines",
        lambda o: F.struct(
            o["value"].alias("value"),
            o["type"].alias("type"),
            o["addresses"].alias("addresses"),
            _md5("t", k - 1).alias("spent_transaction_hash"),
            o["index"].alias("spent_output_index"),
        ),
    )
    none = F.array().cast("array<struct<value:bigint,type:string,addresses:array<string>,spent_transaction_hash:string,spent_output_index:bigint>>")
    return (
        _orders_with_lines(spark, sf_dir)
        .withColumn("inputs", F.when(~coinbase, F.coalesce(spent, none)).otherwise(none))
        .select(
            _md5("t", k).alias("hash"),
            _block_number(F.col("o_orderdate")).alias("block_number"),
            F.col("o_orderdate").alias("block_timestamp"),
            F.trunc(F.to_date("o_orderdate"), "MM").alias("block_timestamp_month"),
            F.round(F.col("o_totalprice") * 100).cast("long").alias("fee"),
            (100 + (k % 97) * 10).alias("virtual_size"),
            coinbase.alias("is_coinbase"),
            F.size("inputs").cast("long").alias("input_count"),
            F.size("lines").cast("long").alias("output_count"),
            "inputs",
            F.col("lines").alias("outputs"),
        )
    )


def utxo_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested transactions: order k pays its own lines and spends the lines of order k - 1."""
    return _raw(spark, sf_dir, "utxo_transactions", _build_utxo_transactions)


def _close(day: Column) -> Column:
    return (4000 + ((F.dayofmonth(day) * 37) % 50) * 1000).cast("long")


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()


def klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closing prices from 1996 on, two per day and a second symbol, as text."""
    rows = F.array(
        F.struct(_close(F.col("day")).alias("close"), F.lit("BTCUSDT").alias("symbol")),
        F.struct((_close(F.col("day")) - 500).alias("close"), F.lit("BTCUSDT").alias("symbol")),
        F.struct((_close(F.col("day")) + 9000).alias("close"), F.lit("ETHUSDT").alias("symbol")),
    )
    return (
        _days(spark, sf_dir)
        .where(F.col("day") >= F.lit(date(1996, 1, 1)))
        .select(F.col("day").cast("timestamp_ntz").alias("openTimeStamp"), F.inline(rows))
        .withColumn("close", F.col("close").cast("string"))
    )


def price_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of the days before 1996."""
    return (
        _days(spark, sf_dir)
        .where(F.col("day") < F.lit(date(1996, 1, 1)))
        .select(F.col("day").cast("timestamp_ntz").alias("price_timestamp"), _close(F.col("day")).cast("decimal(38,9)").alias("price"))
    )


def day_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = lambda: daily_close(klines(spark, sf_dir), price_backfill(spark, sf_dir))
    return staged(spark, _key(spark, sf_dir, "day_price"), build)


def seed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated labels of UTXO addresses."""
    n = F.col("l_partkey") % 500
    plots = F.when(n % 3 == 0, "P001").when(n % 3 == 1, "P002").otherwise("P015")
    return (
        table(spark, sf_dir, "lineitem")
        .where(n % 25 == 0)
        .select(F.concat(F.lit("a"), n.cast("string")).alias("address"), F.lit("seed").alias("feature"), F.concat(F.lit("n"), n.cast("string")).alias("name"), plots.alias("plots"))
        .distinct()
    )


def risk_weights(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{p}', 10.0D, {i}L, CAST({1 - i * 0.05:.2f} AS DOUBLE))" for p, i in WEIGHTED_CODES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(feature_no, feature_weight, subfeature_no, subfeature_score)")


# --- account chain ----------------------------------------------------------------------------


def _build_account_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    to = (
        F.when(k % 40 == 0, F.lit(None).cast("string"))
        .when(k % 40 == 1, F.lit(UNISWAP_V2_ROUTERS[0]))
        .when(k % 40 == 2, F.lit(UNISWAP_V2_ROUTERS[1]))
        .when(k % 40 == 3, F.lit(TORNADO_PROXY))
        .otherwise(account((k * 7) % 400))
    )
    method = (
        F.when(k % 3 == 0, F.lit("0xa9059cbb00"))
        .when(k % 3 == 1, F.lit("0x7ff36ab500"))
        .when(k % 9 == 2, F.lit("0xf39b5b9b00"))
        .when(k % 9 == 5, F.lit("0x13d98d1300"))
        .otherwise(F.lit("0x414bf38900"))
    )
    ts = F.col("o_orderdate")
    status = F.when(ts < F.lit(date(1996, 1, 1)), F.lit(None).cast("int")).when(F.col("o_orderstatus") == "P", 0).otherwise(1)
    price = F.round(F.col("o_totalprice") * 10000).cast("long") * F.when(k % 37 == 0, 10).otherwise(1)
    return table(spark, sf_dir, "orders").select(
        _md5("e", k).alias("hash"),
        account(F.col("o_custkey") % 400).alias("from_address"),
        to.alias("to_address"),
        method.alias("input"),
        status.alias("receipt_status"),
        price.alias("receipt_effective_gas_price"),
        (21000 + k % 1000).alias("receipt_gas_used"),
        ts.alias("block_timestamp"),
        _block_number(ts).alias("block_number"),
    )


def _lines_with_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderdate").alias("block_timestamp"),
        _block_number(F.col("o_orderdate")).alias("block_number"),
    )
    return table(spark, sf_dir, "lineitem").join(orders, "l_orderkey")


def _build_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    reward = (F.col("l_orderkey") % 20 == 0) & (F.col("l_linenumber") == 1)
    nothing = F.lit(None).cast("string")
    return _lines_with_block(spark, sf_dir).select(
        _md5("e", F.col("l_orderkey")).alias("transaction_hash"),
        F.when(reward, nothing).otherwise(account(F.col("l_suppkey") % 400)).alias("from_address"),
        account(F.col("l_partkey") % 400).alias("to_address"),
        (F.col("l_quantity").cast("long").cast("decimal(20,0)") * F.lit(10**17).cast("decimal(18,0)")).cast("decimal(38,0)").alias("value"),
        F.when(reward, "reward").otherwise("call").alias("trace_type"),
        F.when(reward, F.when(F.col("l_partkey") % 2 == 0, "block").otherwise("uncle")).otherwise(nothing).alias("reward_type"),
        "block_number",
        "block_timestamp",
    )


def _build_token_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.concat(F.round(F.col("l_extendedprice") * 100).cast("long").cast("string"), F.lit("0000"))
    return _lines_with_block(spark, sf_dir).select(
        _md5("e", F.col("l_orderkey")).alias("transaction_hash"),
        token(F.col("l_partkey") % TOKENS).alias("token_address"),
        account(F.col("l_suppkey") % 400).alias("from_address"),
        account(F.col("l_partkey") % 400).alias("to_address"),
        F.when(F.col("l_partkey") % 97 == 0, "bad").otherwise(amount).alias("value"),
        "block_number",
        "block_timestamp",
    )


def _events_with_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("block_timestamp")
    )
    return table(spark, sf_dir, "events").join(orders, "event_id")


def _build_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    topic = (
        F.when(n % 4 == 0, F.lit(CURVE_TOPICS[0]))
        .when(n % 4 == 1, F.lit(V3_POOL_TOPIC))
        .when(n % 4 == 2, F.lit(V2_POOL_TOPIC))
        .otherwise(F.lit("0x00"))
    )
    return _events_with_block(spark, sf_dir).select(
        _md5("e", n).alias("transaction_hash"),
        F.when(n % 10 == 0, F.array().cast("array<string>")).otherwise(F.array(topic)).alias("topics"),
        F.concat(F.lit("0x"), F.repeat(F.md5(n.cast("string").cast("binary")), 6)).alias("data"),
        "block_timestamp",
    )


def _build_protocol_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract events, the event names going round over the event ids."""
    n = F.col("event_id")
    pairs = F.array(*[F.struct(F.lit(p).alias("protocol"), F.lit(e).alias("event")) for p, e in EVENT_PAIRS])
    pair = F.get(pairs, (n % len(EVENT_PAIRS)).cast("int"))
    return _events_with_block(spark, sf_dir).select(
        pair["protocol"].alias("protocol"),
        pair["event"].alias("event"),
        _md5("e", n).alias("transaction_hash"),
        "block_timestamp",
        account(F.col("user_id") % 400).alias("owner"),
        F.concat(F.lit("n"), (F.col("user_id") % 50).cast("string")).alias("name"),
        (1_700_000_000 + n * 1000).cast("string").alias("expires"),
    )


def _build_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_partkey") % TOKENS
    return table(spark, sf_dir, "lineitem").select(n.alias("n")).distinct().select(
        token(F.col("n")).alias("address"), F.col("n").isin(3, 7).alias("is_erc721")
    )


def token_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    decimals = F.when(n == 19, F.lit(None).cast("string")).when(n % 2 == 0, "6").otherwise("8")
    return table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % TOKENS).alias("n")).distinct().select(
        token(n).alias("address"), decimals.alias("decimals")
    )


def status_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderdate") < F.lit(date(1996, 1, 1)))
        .select(_md5("e", F.col("o_orderkey")).alias("transaction_hash"), (F.col("o_orderkey") % 2).cast("int").alias("receipt_status"))
    )


def _token_prices(spark: SparkSession, sf_dir: str, first: date, until: date, extra: int) -> DataFrame:
    """Prices of the native coin (t = -1) and of all tokens but one, for the days of the range."""
    numbers = [-1] + [t for t in range(TOKENS) if t != UNPRICED_TOKEN]
    day, t = F.col("day"), F.col("t")
    native = t < 0
    price = F.when(native, 4000).otherwise((t * 13 + F.dayofmonth(day)) % 50 + 1) + extra
    return (
        _days(spark, sf_dir)
        .where((day >= F.lit(first)) & (day < F.lit(until)))
        .select("day", F.explode(F.array(*[F.lit(n) for n in numbers])).alias("t"))
        .select(
            day.cast("timestamp_ntz").alias("timestamp"),
            F.when(native, F.lit(ZERO_ADDRESS)).otherwise(token(t)).alias("address"),
            price.cast("double").alias("price"),
            F.when(native, F.lit("eth")).otherwise(F.concat(F.lit("T"), t.cast("string"))).alias("symbol"),
        )
    )


def token_price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _token_prices(spark, sf_dir, EPOCH, date(2000, 7, 1), 0)


def token_price_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed that overlaps the history by a month, with prices one higher."""
    return _token_prices(spark, sf_dir, date(2000, 6, 1), date(2100, 1, 1), 1)


def token_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = lambda: token_price_daily(
        token_price_history(spark, sf_dir), token_price_current(spark, sf_dir)
    )
    return staged(spark, _key(spark, sf_dir, "token_price"), build)


def _build_account_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_partkey") % 400
    plots = F.when(n % 3 == 0, "P001").when(n % 3 == 1, "P002").otherwise("P015")
    return table(spark, sf_dir, "lineitem").where(n % 25 == 0).select(account(n).alias("address"), plots.alias("plots")).distinct()


def miner_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(account(s % 400).alias("to_address"), F.lit("pool").alias("tags")).distinct()


# --- raw tables of the account chain ----------------------------------------------------------


def account_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "account_transactions", _build_account_transactions)


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "traces", _build_traces)


def token_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "token_transfers", _build_token_transfers)


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "contracts", _build_contracts)


def account_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated labels of accounts."""
    return _raw(spark, sf_dir, "account_labels", _build_account_labels)


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "logs", _build_logs)


def protocol_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "protocol_events", _build_protocol_events)
