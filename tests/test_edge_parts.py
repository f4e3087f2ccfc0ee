"""Edges of a flow that is stored by transaction are made where its rows lie."""

from __future__ import annotations

import re

from helpers import T0, flow_rows, rows

from txloom.operators import transfer_graph
from txloom.sources.staging import staged


def shuffles(df):
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\), (\w+)", df._jdf.queryExecution().executedPlan().toString())


def test_stored_flow_is_folded_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flow = flow_rows(spark, *[(f"t{i}", a, n, 1, T0, i) for i in range(40) for a, n in (("a", -3), ("b", 1), ("c", 2))])
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        kept = staged(spark, "test-flow-by-hash", lambda: flow.repartition(n, "hash"), by="hash", dealt=True)
        edges = transfer_graph.utxo_transfers(kept)
        assert not [keys for keys, _ in shuffles(edges) if "from_address" not in keys]
        ends = ("from_address", "to_address", "to_amount", "transaction_cnt", "first_transaction_hash", "last_transaction_hash")
        assert rows(edges, *ends) == [("a", "b", 40.0, 40, "t0", "t39"), ("a", "c", 80.0, 40, "t0", "t39")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_edges_carry_a_hash_once_an_end(spark):
    edges = transfer_graph.utxo_transfers(flow_rows(spark, ("t1", "a", -1, 1, T0, 1), ("t1", "b", 1, 1, T0, 1)))
    assert "min_by" not in edges._jdf.queryExecution().executedPlan().toString()
