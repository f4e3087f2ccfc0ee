"""Stored tables: snapshots, partition reload, daily increments against one run, inactivity rules."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from helpers import T0, account_tx, flow_rows, inp, out, rows, utxo_tx
from pyspark.sql import functions as F

from txloom.operators import inactivity
from txloom.operators.account_activity import address_tx_cnt_and_fee
from txloom.operators.spending import frequent_io
from txloom.sources import sinks
from txloom.sources.readers import checked
from txloom.streaming import incremental

NOW = datetime(2021, 8, 2)
HORIZON = inactivity.UTXO_HORIZON


def days_ago(n):
    return NOW - timedelta(days=n)


def state_of(spark, *items):
    return spark.createDataFrame([(a, ts, ts.date()) for a, ts in items], "address string, latest_activate_timestamp timestamp, pt date")


def test_inactivity_step(spark):
    state = state_of(spark, ("back", days_ago(400)), ("soon", days_ago(10)), ("quiet", days_ago(1096)), ("woken", days_ago(1097)), ("gone", days_ago(1111)))
    stored = inactivity.InactivityTables(
        state,
        spark.createDataFrame([("soon", days_ago(1200), NOW)], "address string, latest_activate_timestamp timestamp, create_time timestamp"),
        spark.createDataFrame([("known", NOW)], "address string, create_time timestamp"),
    )
    batch = spark.createDataFrame([(a, days_ago(1)) for a in ("back", "soon", "woken", "fresh")], "address string, block_timestamp timestamp")
    after = inactivity.inactivity_step(stored, batch, NOW)
    assert rows(after.periodic, "address") == [("back",), ("known",), ("woken",)]
    assert rows(after.inactive, "address") == [("quiet",)]
    assert rows(after.state, "address", "latest_activate_timestamp") == [
        ("back", days_ago(1)), ("fresh", days_ago(1)), ("quiet", days_ago(1096)), ("soon", days_ago(1)), ("woken", days_ago(1)),
    ]


def test_account_horizon_follows_gap():
    assert inactivity.account_horizon(100) == inactivity.Horizon(100, 300, 297, 303, False)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_returning_history_equals_lag(spark, seed):
    events = spark.range(4000).select(
        F.concat(F.lit("a"), (F.rand(seed) * 300).cast("int").cast("string")).alias("address"),
        (F.lit("2010-01-01").cast("timestamp") + F.make_dt_interval(days=(F.rand(seed + 10) * 4000).cast("int"))).alias("block_timestamp"),
    ).toPandas()
    df = spark.createDataFrame(events)
    expected = set()
    for a, g in events.groupby("address"):
        times = sorted(g["block_timestamp"])
        if any(b - a_ > timedelta(days=365) for a_, b in zip(times, times[1:])):
            expected.add(a)
    assert {r[0] for r in inactivity.returning_history(df, NOW, 365).select("address").collect()} == expected


def test_pause_of_exactly_the_gap_is_none(spark):
    df = spark.createDataFrame([("a", days_ago(365)), ("a", NOW), ("b", days_ago(366)), ("b", NOW)], "address string, block_timestamp timestamp")
    assert rows(inactivity.returning_history(df, NOW, 365), "address") == [("b",)]


def test_account_activity_statuses(spark):
    tx = account_tx(spark, {"hash": "1", "src": "a", "dst": "b"}, {"hash": "2", "src": "c", "dst": "d", "status": 0}, {"hash": "3", "src": "e", "dst": "f", "status": None})
    late = spark.createDataFrame([("2", 1), ("3", 1)], "transaction_hash string, receipt_status int")
    assert rows(inactivity.account_activity(tx, date(2021, 8, 2)), "address") == [("a",), ("b",)]
    assert len(rows(inactivity.account_activity(tx, backfill=late), "address")) == 6


def test_daily_totals_equal_one_run(spark, tmp_path):
    tx = account_tx(spark, *[{"hash": f"t{d}{i}", "src": f"a{i % 3}", "dst": f"a{(i + d) % 4}", "gas_price": 10**9, "gas": 1000, "ts": T0 + timedelta(days=d)} for d in range(3) for i in range(5)])
    for run in incremental.run_dates(date(2021, 8, 1), date(2021, 8, 3)):
        last = rows(incremental.run_address_totals(spark, f"{tmp_path}/totals", tx, run), "address", "total_tx_cnt")
    again = incremental.run_address_totals(spark, f"{tmp_path}/totals", tx, date(2021, 8, 4))  # repeated run
    columns = ("address", "total_tx_cnt")
    assert last == rows(again, *columns) == rows(address_tx_cnt_and_fee(tx), *columns)
    fees = dict(rows(again, "address", "total_fee"))
    assert fees == pytest.approx(dict(rows(address_tx_cnt_and_fee(tx), "address", "total_fee")))


def test_frequent_io_by_day_equals_one_run(spark, tmp_path):
    rows_ = []
    for n in range(12):
        ts = T0 + timedelta(hours=8 * n)
        spent = [inp(1, f"a{(n - 1) % 3}", origin=f"t{n - 1}", index=0)] if n else []
        rows_.append({"hash": f"t{n}", "block": 10 * n if n % 2 else 10 * n - 7, "ts": ts, "inputs": spent, "outputs": [out(0, 1, f"a{n % 3}")]})
    tx = utxo_tx(spark, *rows_)
    for run in incremental.run_dates(T0.date(), (T0 + timedelta(hours=88)).date()):
        last = incremental.run_frequent_io(spark, f"{tmp_path}/io", tx, run)
    assert rows(last, "address", "min_gap") == rows(frequent_io(tx), "address", "min_gap")


def test_inactivity_runs_over_snapshots(spark, tmp_path):
    make = lambda *r: spark.createDataFrame(list(r), "address string, block_timestamp timestamp")
    incremental.run_inactivity(spark, f"{tmp_path}/i", make(("a", days_ago(800)), ("b", days_ago(800))), days_ago(799))
    after = incremental.run_inactivity(spark, f"{tmp_path}/i", make(("a", days_ago(1))), NOW)
    assert rows(after.periodic, "address") == [("a",)]
    assert rows(after.state, "address", "latest_activate_timestamp") == [("a", days_ago(1)), ("b", days_ago(800))]
    later = incremental.run_inactivity(spark, f"{tmp_path}/i", make(("c", NOW)), NOW + timedelta(days=297))
    assert rows(later.inactive, "address") == [("b",)]


def test_snapshot_reads_complete_versions_only(spark, tmp_path):
    root = f"{tmp_path}/s"
    assert sinks.read_snapshot(spark, root) is None
    sinks.write_snapshot(spark.range(2), root, "1")
    sinks.write_snapshot(spark.range(5), root, "2")
    (tmp_path / "s" / "v=3").mkdir()  # a run that did not finish
    assert sinks.read_snapshot(spark, root).count() == 5
    assert sinks.read_snapshot(spark, root, before="2").count() == 2


def test_partition_reload_is_idempotent(spark, tmp_path):
    path = f"{tmp_path}/p"
    day = lambda d, n: spark.range(n).withColumn("pt", F.lit(d).cast("date"))
    sinks.reload_partitions(day("2021-08-01", 3).unionByName(day("2021-08-02", 4)), path, "pt")
    for _ in range(2):
        sinks.reload_partitions(day("2021-08-02", 9), path, "pt", spread=["id"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).groupBy("pt").count().collect()) == [(date(2021, 8, 1), 3), (date(2021, 8, 2), 9)]
    sinks.append(day("2021-08-03", 1), path, ["pt"])
    assert spark.read.parquet(path).count() == 13
    sinks.reload(day("2021-08-03", 1), path, ["pt"])
    assert spark.read.parquet(path).count() == 1


def test_bucketed_write_splits_a_heavy_bucket(spark, tmp_path):
    df = spark.range(3000).select(F.when(F.col("id") < 2900, 7).otherwise(F.col("id") % 4000).cast("int").alias("pt"), F.md5(F.col("id").cast("string").cast("binary")).alias("address"))
    sinks.write_bucketed(df, f"{tmp_path}/b", ["address"], files=4)
    back = spark.read.parquet(f"{tmp_path}/b")
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert back.count() == 3000 and len(sizes) == 4 and max(sizes) < 1500


def test_missing_columns_are_named(spark):
    tx = utxo_tx(spark, {"hash": "t", "inputs": [inp(1, "a")], "outputs": []})
    assert checked(tx, "utxo_transactions") is tx
    with pytest.raises(ValueError, match="fee"):
        checked(tx.drop("fee"), "utxo_transactions")


def test_flow_slices_use_partition_date(spark):
    flow = flow_rows(spark, ("t", "a", 1, 1, T0, 1), ("u", "b", 1, 1, T0 + timedelta(days=1), 1))
    assert rows(inactivity.utxo_activity(flow, date(2021, 8, 3)), "address") == [("b",)]
