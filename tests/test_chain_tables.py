"""The chain tables of the samples: one shuffle of the rows they are made of, the same rows on odd keys."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from txloom.sources import derived

SF = "/root/testdata/sf0.001"
DAY = datetime(1997, 3, 4)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_utxo_build_shuffles_lines_once_and_groups_as_it_reads(spark):
    plan = plan_of(derived._build_utxo_transactions(spark, SF))
    assert plan.count("Exchange") == 1
    assert "ObjectHashAggregate" not in plan and plan.count("SortAggregate") == 1


@pytest.mark.parametrize("name", ["traces", "token_transfers", "account_transactions", "utxo_transactions"])
def test_stored_chain_tables_are_not_dealt_out_again(spark, name, monkeypatch):
    written = []
    monkeypatch.setattr(derived, "staged", lambda spark, key, build, **more: written.append((build(), more)))
    getattr(derived, name)(spark, SF)
    (frame, more), = written
    assert not more.get("even") and "REBALANCE" not in plan_of(frame)


def test_utxo_build_on_odd_keys(spark, tmp_path):
    """Keys at the ends of spans, below zero, above 2^53, twice, missing, and orders without lines."""
    big = 2**60 + 1023
    orders = [(k, 100.0 + n, DAY) for n, k in enumerate([-1, 0, 1, 1, 5, 1023, 1024, 2047, 2048, big, big + 1, None])]
    lines = [
        (k, 11 * n + n % 2, n, n % 3, 17.0 * (n % 4), 5.0, DAY, "RNA"[n % 3], "OF"[n % 2])
        for n, k in enumerate([-1, -1, 0, 0, 0, 1, 4, 1022, 1023, 1023, 2047, 2047, big, big, None])
    ]
    spark.createDataFrame(orders, "o_orderkey long, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(
        lines,
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_shipdate timestamp_ntz, l_returnflag string, l_linestatus string",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = {}
    for r in derived._build_utxo_transactions(spark, str(tmp_path)).select(
        "fee", "is_coinbase", F.transform("outputs", lambda o: F.struct(o["index"], o["value"], o["type"], o["addresses"])).alias("outs"),
        F.transform("inputs", lambda o: F.struct(o["spent_output_index"], o["value"], o["type"], o["addresses"])).alias("ins"), "input_count", "output_count",
    ).collect():
        assert r.fee not in rows
        rows[r.fee] = r

    def outputs(k):
        own = sorted((line[3], line[1], *line) for line in lines if k is not None and line[0] == k)
        return [
            (i, (int(quantity // 17) + 1) * 100_000_000, "nulldata" if flag == "R" and status == "O" else "pubkeyhash", [f"a{p % 500}", f"a{(p + 7) % 500}"] if p % 11 == 0 else [f"a{p % 500}"])
            for i, (_, _, _, p, _, _, quantity, _, _, flag, status) in enumerate(own)
        ]

    assert len(rows) == len(orders)
    for k, price, _ in orders:
        r = rows[round(price * 100)]
        coinbase = k is not None and k % 50 == 0
        assert [tuple(o) for o in r.outs] == outputs(k)
        assert [tuple(o) for o in r.ins] == ([] if coinbase or k is None else outputs(k - 1))
        assert (r.input_count, r.output_count) == (len(r.ins), len(r.outs))
