"""What the account chain's transfers carry to the task of their transaction."""

from __future__ import annotations

import re
from decimal import Decimal

import pytest
from helpers import T0, account_tx, rows

from txloom.operators import token_flow, transfer_graph

A, B = "0x" + "ab" * 20, "0x" + "cd" * 20
TRACE = "transaction_hash string, from_address string, to_address string, value decimal(38,0), block_number long, block_timestamp timestamp"
TOKEN = "transaction_hash string, token_address string, from_address string, to_address string, value string, block_number long, block_timestamp timestamp"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below_the_join(plan):
    """The part of a plan that stands below its first join."""
    return plan[plan.index("Join") :]


def test_addresses_are_bytes_below_the_join_on_the_transaction(spark, no_broadcast):
    tx = account_tx(spark, {"hash": "t1"}, {"hash": "t1"}, {"hash": "t2", "status": 0})
    coin = Decimal(10) ** 18
    traces = spark.createDataFrame([("t1", A, B, coin, 1, T0), ("t1", A, "Bob", coin, 1, T0), ("t2", B, A, coin, 1, T0)], TRACE)
    price = spark.createDataFrame(
        [("0x" + "0" * 40, T0.date(), 2.0, "eth")], "address string, price_day date, price double, symbol string"
    )
    done = token_flow.succeed_transfers(traces, tx, price)
    assert "unhex(" in below_the_join(optimized(done))
    assert rows(done, "from_address", "to_address", "value", "usd_value") == [(A, B, 1.0, 2.0), (A, "Bob", 1.0, 2.0)]
    edges = transfer_graph._native_edges(traces, tx.dropDuplicates(["hash"]), price, None, rank_after_filter=True)
    assert "unhex(" in below_the_join(optimized(edges))
    assert rows(edges, "from_address", "to_address", "first_transaction_hash") == [(A, B, "t1"), (A, "Bob", "t1")]


def test_listed_tokens_meet_without_a_shuffle(spark, no_broadcast):
    tx = account_tx(spark, {"hash": "t1", "input": "0xa9059cbb00"}, {"hash": "t2"})
    moved = spark.createDataFrame([(h, B, A, B, "5000000", 1, T0) for h in ("t1", "t1", "t2")], TOKEN)
    tokens = spark.createDataFrame([(B, "T", "6")], "token_address string, symbol string, decimals string")
    direct = token_flow.direct_token_transfers(moved, tx, tokens)
    assert not re.search(r"Exchange hashpartitioning\(token_address", executed(direct))
    assert rows(direct, "from_address", "to_address", "value", "symbol") == [(A, B, 5.0, "T")] * 2
