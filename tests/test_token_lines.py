"""How the lines of transfers reach the statistics of their address and day."""

from __future__ import annotations

import re
from datetime import timedelta

import pytest
from helpers import T0, account_tx

from txloom.operators import daily_stats

A, B = "0x" + "ab" * 20, "0x" + "cd" * 20
TRANSFER = (
    "transaction_hash string, from_address string, to_address string, token_address string, symbol string, "
    "block_timestamp timestamp, block_number long, value double, usd_value double"
)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_shuffle_serves_the_grouping_and_the_join(spark, no_broadcast):
    moved = spark.createDataFrame([("t1", A, B, "0xt", "T", T0, 1, 1.0, 2.0)], TRANSFER)
    stats = daily_stats.token_stat_daily(moved, account_tx(spark, {"hash": "t1"}))
    plan = stats._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)", plan)
    assert len(shuffles) == 2 and not any("token_address" in s for s in shuffles)
    # like rows lie side by side below the shuffle, with their addresses as bytes
    below = plan[plan.index("REPARTITION_BY_COL") :]
    assert "Sort [address" in below and "unhex(" in below


@pytest.mark.parametrize("first,last", [("0xab", "b1"), ("AB", "ab"), ("ab", "abc"), ("0x00", "0xff"), ("", "é")])
def test_ties_go_by_the_text_of_the_hash(spark, first, last):
    moved = spark.createDataFrame([(h, A, "Bob", None, "T", T0, 1, 1.0, 2.0) for h in (last, first, last)], TRANSFER)
    found = {r.address: r for r in daily_stats.token_stat_daily(moved, account_tx(spark, {"hash": "t", "src": A, "dst": None})).collect()}
    assert set(found) == {A, "Bob"}
    into, out = found["Bob"], found[A]
    assert (into.first_in_tx_hash, into.last_in_tx_hash, into.in_tx_cnt, into.tx_cnt) == (first, last, 3, 0)
    assert (out.first_out_tx_hash, out.last_out_tx_hash, out.out_tx_cnt, out.tx_cnt) == (first, last, 3, 1)
    assert into.token_address is None and out.token_address is None


def test_days_and_missing_ends(spark):
    day = timedelta(days=1)
    moved = spark.createDataFrame(
        [("t1", None, A, "0xT", "T", T0, 1, 1.0, 2.0), ("t2", A, None, "0xT", "T", T0 + day, 2, 3.0, 4.0), ("t3", A, A, "0xt", "U", T0, 1, 5.0, 6.0)],
        TRANSFER,
    )
    stats = daily_stats.token_stat_daily(moved, account_tx(spark, {"hash": "x", "src": B, "dst": A, "ts": T0 + day}), turnover="value")
    found = {(r.address, str(r.block_date), r.token_address): (r.in_tx_value, r.out_tx_value, r.turnover, r.tx_cnt) for r in stats.collect()}
    one, two = str(T0.date()), str((T0 + day).date())
    assert found == {
        (A, one, "0xT"): (1.0, 0.0, 1.0, 0),
        (A, one, "0xt"): (5.0, 5.0, 10.0, 0),
        (A, two, "0xT"): (0.0, 3.0, 3.0, 1),
        (B, two, None): (None, None, None, 1),
    }
