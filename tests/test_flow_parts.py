"""The value flow goes to its tasks by transaction."""

from __future__ import annotations

import re

import pytest
from helpers import COIN, T0, inp, out, rows, utxo_tx

from txloom.operators import value_flow


def shuffles(df):
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\), (\w+)", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture(scope="module")
def price(spark):
    return spark.createDataFrame([(T0, 10.0)], "price_timestamp timestamp, price double")


def test_flow_shuffles_transactions_not_lines(spark, price):
    tx = utxo_tx(spark, {"hash": "t", "inputs": [inp(COIN, "a")], "outputs": [out(0, COIN, "b", "c")]})
    found = shuffles(value_flow.utxo_value_flow(tx, price))
    assert len(found) == 1 and found[0][0].startswith("hash#") and "address" not in found[0][0]


def test_flow_of_a_hash_that_comes_twice(spark, price):
    twice = {"hash": "t", "inputs": [inp(COIN, "a")], "outputs": [out(0, COIN, "b"), out(1, 2 * COIN, "b")]}
    got = rows(value_flow.utxo_value_flow(utxo_tx(spark, twice, twice), price), "hash", "address", "in_value", "out_value")
    assert got == [("t", "a", 2.0, None), ("t", "b", None, 6.0)]
