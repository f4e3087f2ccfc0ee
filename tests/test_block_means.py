"""Transactions meet the means of their blocks where they lie."""

from __future__ import annotations

import pytest

from txloom.plans import sample_queries as samples

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("query,table", [(samples._high_fee_utxo, "block_fees"), (samples._high_fee_account, "gas_means")])
def test_block_means_are_stored(spark, query, table):
    found = query(spark, SF)
    assert any(f"/{table}-" in f for f in found.inputFiles())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(block_number" not in plan and "SortMergeJoin" not in plan
