"""What the tag tables of the account chain shuffle."""

from __future__ import annotations

from decimal import Decimal

import pytest
from helpers import T0, account_tx, rows
from test_transfer_parts import TOKEN, TRACE, A, B, below_the_join, executed, optimized

from txloom.functions.columns import ZERO_ADDRESS
from txloom.operators import inactivity, large_value, protocols, token_flow
from txloom.plans import sample_queries as samples
from txloom.sources import derived

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_token_transfers_are_left_out_below_the_join(spark, no_broadcast):
    tx = account_tx(spark, *[{"hash": h, "input": "0xa9059cbb00"} for h in ("t1", "t2")], {"hash": "t3"})
    moved = spark.createDataFrame(
        [(h, B, A, B, units, 1, T0) for h in ("t1", "t3") for units in ("9999", "10000", "50000", "bad")] + [("t2", B, B, A, "1", 1, T0)], TOKEN
    )
    coin = Decimal(10) ** 18
    traces = spark.createDataFrame([("t1", A, B, coin, 1, T0), ("t3", A, B, coin * 5000, 1, T0), ("t3", B, None, coin * 9000, 1, T0)], TRACE)
    price = spark.createDataFrame(
        [(ZERO_ADDRESS, T0.date(), 2.0, "eth"), (B, T0.date(), 1.0, "T")], "address string, price_day date, price double, symbol string"
    )
    decimals = spark.createDataFrame([(B, "0")], "address string, decimals string")
    whole, large = (token_flow.priced_transfers(traces, moved, tx, price, [decimals], least_usd=least) for least in (None, 10_000))
    assert rows(large, "transaction_hash", "from_address", "to_address", "usd_value") == [
        ("t1", A, B, 10000.0), ("t1", A, B, 50000.0), ("t3", A, B, 10000.0)
    ]
    assert set(large.columns) == set(whole.columns)
    assert rows(large_value.account_large_value(large), "*") == rows(large_value.account_large_value(whole), "*")
    plan = optimized(large)
    assert ">= 10000.0" in plan[plan.index("Join Inner, (transaction_hash") :]


def test_transactions_with_status_do_not_look_for_a_late_one(spark, no_broadcast):
    tx = account_tx(
        spark,
        {"hash": "own", "src": A, "dst": None},
        {"hash": "late", "src": A, "dst": B, "status": None},
        {"hash": "undone", "src": "x", "dst": B, "status": 0},
        {"hash": "never", "src": "y", "dst": "y", "status": None},
    )
    late = spark.createDataFrame(
        [("late", 1), ("late", 1), ("own", 1), ("own", 0), ("undone", 1), ("never", 0)], "transaction_hash string, receipt_status int"
    )
    found = inactivity.account_activity(tx, backfill=late)
    assert rows(found, "address") == sorted([(A,), (None,), (A,), (B,), ("x",), (B,)], key=str)
    assert "NOT coalesce((receipt_status" in below_the_join(optimized(found))


def test_hashes_meet_events_as_bytes(spark, no_broadcast):
    spec = protocols.ProtocolSpec("p", ("e",), "user")
    tx = account_tx(spark, {"hash": "0xab", "src": A}, {"hash": "0xcd", "src": "Bob"}, {"hash": "0xef", "src": B})
    events = spark.createDataFrame(
        [("p", "e", "0xab", T0), ("p", "e", "0xab", T0), ("p", "e", "0xcd", T0), ("p", "f", "0xef", T0)],
        "protocol string, event string, transaction_hash string, block_timestamp timestamp",
    )
    logs = spark.createDataFrame([("0xcd", [protocols.CURVE_TOPICS[0]])] * 2, "transaction_hash string, topics array<string>")
    one, every, curve = (
        protocols.protocol_users(tx, events, spec),
        protocols.protocol_user_tables(tx, events, {"t": spec}),
        protocols.curve_traders(tx, logs),
    )
    assert rows(one, "address", "tx_timestamp") == rows(every, "address", "tx_timestamp") == [(A, T0), ("Bob", T0)]
    assert rows(curve, "address") == [("Bob",)]
    for found in (one, every, curve):
        assert "unhex(" in below_the_join(optimized(found))


def test_lists_are_stored_and_their_size_known(spark):
    for build in (derived.contracts, derived.account_labels):
        assert not any("lineitem" in f for f in build(spark, SF).inputFiles())
    assert "Exchange hashpartitioning(token_address" not in executed(samples.q_nft_users(spark, SF))


def test_last_activity_is_built_once(spark):
    tables = samples._account_inactivity(spark, SF)
    for df in (tables.inactive, tables.periodic):
        assert any("account_last_activity" in f for f in df.inputFiles())
