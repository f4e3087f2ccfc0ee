"""The daily runs end to end over stored tables."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import COIN, account_tx, inp, out, rows, utxo_tx
from pyspark.sql import functions as F

from txloom.functions import ZERO_ADDRESS
from txloom.plans import daily
from txloom.schemas import DAY_PRICE, PROTOCOL_EVENTS, RISK_WEIGHTS, TOKEN_PRICE, TOKEN_TRANSFERS, TRACES
from txloom.sources import sinks

NOW = datetime(2021, 8, 5)


def _utxo(spark):
    data = []
    for n, ts in enumerate([datetime(2015, 5, 3), datetime(2015, 5, 20), datetime(2021, 8, 1), datetime(2021, 8, 2), datetime(2021, 8, 2, 5)]):
        spent = [inp(20 * COIN, f"a{n - 1}", origin=f"t{n - 1}", index=0)] if n else []
        data.append({"hash": f"t{n}", "block": n, "ts": ts, "inputs": spent, "outputs": [out(0, 20 * COIN, f"a{n}")]})
    tx = utxo_tx(spark, *data)
    days = [datetime(2015, 5, 3), datetime(2015, 5, 20), datetime(2021, 8, 1), datetime(2021, 8, 2)]
    price = spark.createDataFrame([(d, Decimal(1000)) for d in days], DAY_PRICE)
    return {"utxo_transactions": tx, "day_price": price}


def test_utxo_run_by_day_equals_one_run(spark, tmp_path):
    tables = _utxo(spark)
    for run in (date(2015, 5, 21), date(2015, 5, 4), date(2021, 8, 2), date(2021, 8, 3), date(2021, 8, 3)):
        daily.utxo_facts(tables, f"{tmp_path}/days", run)
    daily.utxo_facts(tables, f"{tmp_path}/once")
    read = lambda kind, name: spark.read.parquet(f"{tmp_path}/{kind}/{name}")
    columns = ("hash", "address", "net_usd_value", "partition_date")
    assert rows(read("days", "value_flow"), *columns) == rows(read("once", "value_flow"), *columns)
    assert read("once", "value_flow").count() == 9
    every = rows(read("once", "stat_daily"), "address", "block_date", "tx_cnt")
    assert rows(read("days", "stat_daily"), "address", "block_date", "tx_cnt") == every
    assert {str(r[1])[:4] for r in every} == {"2015", "2021"}
    tags = sinks.read_runs(spark, f"{tmp_path}/days/large_value")
    assert tags.count() == tags.distinct().count() > 0

    daily.utxo_graph(read("once", "value_flow"), f"{tmp_path}/once")
    assert rows(read("once", "transfers"), "from_address", "to_address") == [(f"a{n - 1}", f"a{n}") for n in range(1, 5)]
    assert read("once", "transfers_2").count() == 4


def test_utxo_risk(spark, tmp_path):
    tables = _utxo(spark) | {
        "seed_labels": spark.createDataFrame([("a3", "seed", None, "P001")], "address string, feature string, name string, plots string"),
        "risk_weights": spark.createDataFrame([("P001", 10.0, i, 1.0) for i in range(7)], RISK_WEIGHTS),
    }
    no_tags = spark.createDataFrame([], "address string, plots string, idx int")
    got = dict(rows(daily.utxo_risk(tables, no_tags, str(tmp_path), NOW), "address", "total_score"))
    assert got == pytest.approx({"a3": 10.0, "a2": 10.0, "a1": 10.0, "a4": 10.0})


def test_account_runs(spark, tmp_path):
    ts = datetime(2021, 8, 1, 3)
    tables = {
        "account_transactions": account_tx(spark, {"hash": "n", "src": "a", "dst": "b", "ts": ts}, {"hash": "d", "src": "c", "ts": ts, "input": "0xa9059cbb"}),
        "traces": spark.createDataFrame([("n", "a", "b", "call", None, Decimal(10**18), 1, ts)], TRACES),
        "token_transfers": spark.createDataFrame([("d", "c", "e", "0xt", "500", 1, ts)], TOKEN_TRANSFERS),
        "token_price": spark.createDataFrame([(ZERO_ADDRESS, ts.date(), 2e6, "eth"), ("0xt", ts.date(), 3.0, "T")], TOKEN_PRICE),
        "token_decimals": spark.createDataFrame([("0xt", "2")], "address string, decimals string"),
        "status_backfill": spark.createDataFrame([], "transaction_hash string, receipt_status int"),
        "account_labels": spark.createDataFrame([("b", "P001")], "address string, plots string"),
        "risk_weights": spark.createDataFrame([("P001", 10.0, i, 1.0) for i in range(7)], RISK_WEIGHTS),
        "protocol_events": spark.createDataFrame([("aave", "LendingPool_event_Borrow", "n", ts, None, None, None)], PROTOCOL_EVENTS),
    }
    for _ in range(2):
        daily.account_facts(tables, str(tmp_path), date(2021, 8, 2))
    stats = spark.read.parquet(f"{tmp_path}/token_stat_daily")
    assert rows(stats.where("token_address is not null"), "address", "symbol") == [("a", "eth"), ("b", "eth"), ("c", "T"), ("e", "T")]
    no_tags = spark.createDataFrame([], "address string, plots string, idx int")
    got = dict(rows(daily.account_risk(tables, no_tags, str(tmp_path), NOW), "address", "total_score"))
    assert got == pytest.approx({"a": 10 * 2 / 3, "b": 10.0})
    for run in (date(2021, 8, 2), date(2021, 8, 3)):
        users = daily.protocol_tables(tables, str(tmp_path), run)
    assert rows(users, "table", "address") == [("aave_borrower", "a")]


def test_a_day_that_lost_its_rows_is_emptied(spark, tmp_path):
    tables = _utxo(spark)
    for run in (date(2021, 8, 2), date(2021, 8, 3)):
        daily.utxo_facts(tables, str(tmp_path), run)
    gone = tables | {"utxo_transactions": tables["utxo_transactions"].where(F.col("block_timestamp") < "2021-08-02")}
    daily.utxo_facts(gone, str(tmp_path), date(2021, 8, 3))
    for name, column in (("value_flow", "partition_date"), ("stat_daily", "block_date")):
        stored = spark.read.parquet(f"{tmp_path}/{name}")
        assert {str(r[0]) for r in stored.select(column).distinct().collect()} == {"2021-08-01"}


def test_large_value_before_2016(spark):
    from txloom.operators import large_value, value_flow

    tables = _utxo(spark)
    flow = value_flow.utxo_value_flow(tables["utxo_transactions"], tables["day_price"])
    tags = lambda d: rows(large_value.utxo_large_value(flow, d), "address")
    assert len(tags(date(2015, 5, 21))) > 0
    assert tags(date(2015, 5, 22)) == []
