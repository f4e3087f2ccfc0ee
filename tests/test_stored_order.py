"""Work on a transaction's lines is done once, and what is stored by transaction is read in its order."""

from __future__ import annotations

from decimal import Decimal

import pytest
from helpers import COIN, T0, inp, out, rows, utxo_tx

from pyspark.sql import functions as F

from txloom.operators import taint, value_flow
from txloom.schemas import DAY_PRICE
from txloom.sources.staging import staged


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_stored_by_a_column_are_not_sorted_to_meet(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = spark.range(500).select(F.md5(F.col("id").cast("string").cast("binary")).alias("hash"), (F.col("id") % 7).alias("n"))
        one, two = (staged(spark, f"in-order-{n}", lambda: made, by="hash") for n in (1, 2))
        met = one.join(two.groupBy("hash").agg(F.collect_list("n").alias("m")), "hash")
        assert "Sort [" not in plan_of(met) and "Exchange" not in plan_of(met)
        assert met.count() == 500 and sorted(map(tuple, one.collect())) == sorted(map(tuple, made.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def chain(spark):
    """t1 has no lines that count, t2 an input total of 0, t3 a line without addresses."""
    return utxo_tx(
        spark,
        {"hash": "t0", "inputs": [inp(2 * COIN, "s")], "outputs": [out(0, COIN, "a"), out(1, COIN, "l")]},
        {"hash": "t1", "inputs": [inp(COIN, "a", type="nulldata")], "outputs": [out(0, COIN, "b", type="nonstandard")]},
        {"hash": "t2", "inputs": [inp(0, "a")], "outputs": [out(0, COIN, "l")]},
        {"hash": "t3", "inputs": [inp(COIN, "a", origin="t0")], "outputs": [out(0, COIN), out(1, COIN, "b", "l")]},
    )


def test_lines_are_made_once(spark, chain):
    price = spark.createDataFrame([(T0, Decimal(100))], DAY_PRICE)
    labels = spark.createDataFrame([("l", "P1", 1.0)], "address string, plots string, score double")
    relations = (taint.common_input, taint.common_output, taint.direct_source, taint.direct_dest, taint.indirect_source, taint.indirect_dest)
    made = [relation(chain, price, labels) for relation in relations] + [value_flow.utxo_value_flow(chain, price)]
    for df in made:
        filters = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter " in line]
        assert filters and not any("arrays_zip(" in f for f in filters)
    found = [[(a, p, round(w, 9)) for a, p, w in rows(df, "address", "plots", "sub_weight")] for df in made[:3]]
    # of the 200 USD that s spent, 100 went to l; a line of l is as large as all that a spent, 100 USD
    assert found == [[], [("a", "P1", 1.0), ("b", "P1", 1.0)], [("a", "P1", 0.01), ("s", "P1", 0.005)]]
    assert rows(made[-1], "hash", "address") == [("t0", "a"), ("t0", "l"), ("t0", "s"), ("t2", "a"), ("t2", "l"), ("t3", "a"), ("t3", "b"), ("t3", "l")]
