"""Stored tables under replays, lost runs and skew: reload, runs, buckets, marts."""

from __future__ import annotations

import os
import random
from datetime import date, datetime, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from txloom.operators import inactivity
from txloom.schemas import LAST_ACTIVITY
from txloom.sources import marts, sinks
from txloom.streaming import incremental

DAYS = [date(2021, 8, d) for d in range(1, 4)]


def day_rows(spark, *days, n=4):
    return spark.createDataFrame([(f"a{k}", d) for d in days for k in range(n)], "address string, pt date")


def files_below(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


# --- reload -----------------------------------------------------------------------------------------


def test_rows_outside_the_run_are_an_error(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.reload_partitions(day_rows(spark, *DAYS), path, "pt")
    before = files_below(path)
    with pytest.raises(ValueError, match="pt=2021-08-03"):
        sinks.reload_partitions(day_rows(spark, DAYS[1], DAYS[2], n=9), path, "pt", values=[DAYS[1]])
    assert files_below(path) == before


def test_a_table_may_be_rewritten_from_itself(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.reload_partitions(day_rows(spark, *DAYS), path, "pt")
    sinks.reload_partitions(spark.read.parquet(path).where("pt = '2021-08-02' AND address <> 'a0'"), path, "pt", values=DAYS[:2])
    assert rows(spark.read.parquet(path), "address", "pt") == sorted(
        [(f"a{k}", DAYS[1]) for k in (1, 2, 3)] + [(f"a{k}", DAYS[2]) for k in range(4)]
    )


@pytest.mark.parametrize("step", ["write", "set aside", "put in place"])
def test_a_lost_reload_leaves_the_old_day(spark, tmp_path, monkeypatch, step):
    path = f"{tmp_path}/t"
    sinks.reload_partitions(day_rows(spark, *DAYS), path, "pt")
    real, moves = sinks._move, []

    def lost(session, old, new):
        moves.append(new)
        if step == "set aside" or len(moves) == 2:
            raise RuntimeError("lost")
        real(session, old, new)

    if step == "write":
        broken = day_rows(spark, DAYS[0], n=9).withColumn("address", F.raise_error(F.lit("lost")))
    else:
        broken = day_rows(spark, DAYS[0], n=9)
        monkeypatch.setattr(sinks, "_move", lost)
    with pytest.raises(Exception, match="lost"):
        sinks.reload_partitions(broken, path, "pt", values=[DAYS[0]])
    monkeypatch.setattr(sinks, "_move", real)
    if step == "put in place":
        sinks.recover_partitions(spark, path)
    assert spark.read.parquet(path).where(F.col("pt") == F.lit(DAYS[0])).count() == 4
    sinks.reload_partitions(day_rows(spark, DAYS[0], n=9), path, "pt", values=[DAYS[0]])
    assert spark.read.parquet(path).count() == 9 + 8


def test_partition_names_are_those_of_spark(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([(1, "a/b:c"), (2, None)], "n int, k string")
    for _ in range(2):
        sinks.reload_partitions(df, path, "k", values=["a/b:c", None])
    assert rows(spark.read.parquet(path), "n", "k") == [(1, "a/b:c"), (2, None)]


# --- append-only runs -------------------------------------------------------------------------------


def new_addresses(fresh):
    return lambda kept: fresh if kept is None else fresh.join(kept.select("address"), "address", "left_anti")


def addresses(spark, first, after):
    return spark.range(first, after).select(F.concat(F.lit("address-"), F.col("id").cast("string")).alias("address"))


def test_a_run_writes_its_new_rows_alone(spark, tmp_path):
    root = f"{tmp_path}/tags"
    sinks.append_run(spark, root, "2021-08-01", new_addresses(addresses(spark, 0, 20_000)))
    before = files_below(root)
    out = sinks.append_run(spark, root, "2021-08-02", new_addresses(addresses(spark, 19_900, 20_010)))
    after = files_below(root)
    written = {f: n for f, n in after.items() if f not in before}
    assert out.count() == out.distinct().count() == 20_010
    assert {f: after[f] for f in before} == before  # nothing is rewritten
    assert spark.read.parquet(*written).count() == 10 and sum(written.values()) < 0.1 * sum(before.values())


def test_repeated_and_lost_runs(spark, tmp_path):
    root = f"{tmp_path}/tags"
    runs = [("1", 0, 10), ("2", 5, 20), ("2", 5, 20), ("3", 0, 5), ("2", 5, 20)]
    for name, first, after in runs:
        out = sinks.append_run(spark, root, name, new_addresses(addresses(spark, first, after)))
    assert out.count() == out.distinct().count() == 20
    (tmp_path / "tags" / "run=4").mkdir()  # a run that did not finish
    assert sinks.read_runs(spark, root).count() == 20 and sinks.read_runs(spark, root, before="2").count() == 10
    assert sinks.read_runs(spark, f"{tmp_path}/none") is None


def test_compaction_keeps_rows_and_refuses_folded_runs(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/tags"
    for k in range(4):
        sinks.append_run(spark, root, str(k), new_addresses(addresses(spark, 0, 5 * (k + 1))))
    every = rows(sinks.read_runs(spark, root), "address")
    with monkeypatch.context() as m:
        m.setattr(sinks, "_delete", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            sinks.compact_runs(spark, root, "2")  # dies before the old runs are deleted
    assert rows(sinks.read_runs(spark, root), "address") == every
    sinks.compact_runs(spark, root, "2")
    assert rows(sinks.read_runs(spark, root), "address") == every
    assert sorted(n for n in os.listdir(root) if n[0] in "ar") == ["all=2", "run=3"]
    with pytest.raises(ValueError, match="folded"):
        sinks.append_run(spark, root, "1", new_addresses(addresses(spark, 0, 1)))
    assert sinks.append_run(spark, root, "4", new_addresses(addresses(spark, 0, 21))).count() == 21


# --- inactivity by bucket ---------------------------------------------------------------------------


def test_inactivity_by_bucket_equals_whole_state(spark, tmp_path):
    draw, horizon = random.Random(7), inactivity.Horizon(gap=3, inactive=6, expire_partition=8, expire=10)
    start = datetime(2021, 8, 1)
    empty = lambda s: spark.createDataFrame([], s)
    tables = inactivity.InactivityTables(empty(LAST_ACTIVITY), empty(incremental._INACTIVE), empty(incremental._PERIODIC))
    for k in range(6):
        now = start + timedelta(days=2 * k)
        batch = spark.createDataFrame(
            [(f"a{draw.randrange(40)}", now - timedelta(hours=draw.randrange(40))) for _ in range(6)], "address string, block_timestamp timestamp"
        )
        tables = inactivity.inactivity_step(tables, batch, now, horizon)
        tables = inactivity.InactivityTables(*[spark.createDataFrame(t.collect(), t.schema) for t in (tables.state, tables.inactive, tables.periodic)])
        for _ in range(2 if k == 3 else 1):  # a repeated run
            got = incremental.run_inactivity(spark, f"{tmp_path}/i", batch, now, horizon, buckets=8)
        same = lambda a, b, *c: rows(a, *c) == rows(b, *c)
        now_state = inactivity.expire_state(tables.state, now, horizon)
        assert same(got.state, now_state, "address", "latest_activate_timestamp", "pt")
        assert same(got.inactive, tables.inactive, "address", "latest_activate_timestamp", "create_time")
        assert same(got.periodic, tables.periodic, "address", "create_time")
    assert tables.periodic.count() > 3 and tables.inactive.count() > 3


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path):
    root, now = f"{tmp_path}/i", datetime(2021, 8, 1)
    make = lambda n, ts: addresses(spark, 0, n).withColumn("block_timestamp", F.lit(ts))
    incremental.run_inactivity(spark, root, make(500, now), now, buckets=16)
    first = files_below(f"{root}/state")
    got = incremental.run_inactivity(spark, root, make(2, now + timedelta(days=1)), now + timedelta(days=1), buckets=16)
    second = {f for f in files_below(f"{root}/state") if f not in first}
    assert {f for f in files_below(f"{root}/state")} >= set(first) and 1 <= len({os.path.dirname(f) for f in second}) <= 2
    assert got.state.count() == 500 and got.state.where("pt = '2021-08-02'").count() == 2
    assert spark.read.parquet(*second).count() < 120
    latest = "20210803T000000"
    sinks.prune_buckets(spark, f"{root}/state", latest)
    assert sinks.read_buckets(spark, f"{root}/state", LAST_ACTIVITY).count() == 500
    assert len(files_below(f"{root}/state")) < len(first) + len(second)


# --- marts ------------------------------------------------------------------------------------------


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_marts_join_on_address_without_exchange(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = addresses(spark, 0, 3000).withColumn("pt", F.lit(1)).withColumn("score", F.rand(1))
        hot = F.when(F.col("id") < 2000, F.lit("address-7")).otherwise(F.concat(F.lit("address-"), F.col("id").cast("string")))
        right = spark.range(4000).select(hot.alias("from_address"), F.col("id").alias("to_address"), F.lit(2).alias("pt"))
        a = marts.write_mart(left, "mart_scores", f"{tmp_path}/scores", buckets=8)
        b = marts.write_mart(right, "mart_edges", f"{tmp_path}/edges", "from_address", ["to_address"], buckets=8)
        joined = a.join(b, a.address == b.from_address).groupBy("address").agg(F.count("*").alias("n"))
        assert exchanges(joined) == 0
        assert {r.address: r.n for r in joined.collect()} == {"address-7": 2000} | {f"address-{k}": 1 for k in range(2000, 3000)}
        heavy = [n for n in files_below(f"{tmp_path}/edges")]
        sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/edges").groupBy(F.input_file_name()).count().collect()]
        assert len(heavy) > 8 and max(sizes) < 1200 and sum(sizes) == 4000
        spark.sql("DROP TABLE mart_edges")  # external: the files stay
        again = marts.open_mart(spark, "mart_edges", f"{tmp_path}/edges", "from_address STRING, to_address BIGINT, pt INT", "from_address", 8)
        assert again.count() == 4000
        assert exchanges(a.join(again, a.address == again.from_address)) == 0
        spark.sql("DROP TABLE mart_edges")
        assert marts.write_mart(right, "mart_edges", f"{tmp_path}/edges", "from_address", ["to_address"], buckets=8).count() == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
