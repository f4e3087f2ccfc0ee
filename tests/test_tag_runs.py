"""Tag tables run by run, and the views over what is stored."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from helpers import COIN, inp, out, rows, utxo_tx

from txloom.operators import coinjoin, fees, inactivity, large_value, tag_views
from txloom.plans import daily, sample_queries, tag_runs
from txloom.schemas import DAY_PRICE
from txloom.sources import derived, sinks

DAYS = [datetime(2021, 8, d, 1) for d in (1, 2, 3)]


def chain(spark):
    data = []
    for n, day in enumerate(d for d in DAYS for _ in range(4)):
        spent = [inp(20 * COIN, f"a{(n + k) % 5}", origin=f"o{n}", index=k) for k in range(3)]
        data.append({"hash": f"t{n}", "block": n, "ts": day, "inputs": spent, "outputs": [out(k, 20 * COIN, f"a{(2 * n + k) % 9}") for k in range(3)]})
    price = spark.createDataFrame([(d.replace(hour=0), Decimal(1000)) for d in DAYS], DAY_PRICE)
    return {"utxo_transactions": utxo_tx(spark, *data), "day_price": price}


def test_runs_append_what_is_new(spark, tmp_path):
    tables, out_ = chain(spark), str(tmp_path)
    tx, price = tables["utxo_transactions"], tables["day_price"]
    for run in (date(2021, 8, 2), date(2021, 8, 3), date(2021, 8, 3), date(2021, 8, 4)):
        daily.utxo_facts(tables, out_, run)
        tag_runs.utxo_tag_tables(tables, out_, run)
    stored = lambda name: sinks.read_runs(spark, f"{out_}/tags/{name}")
    for name in ("mixers", "mimo", "fast_tx", "high_fee", "large_value"):
        assert stored(name) is not None and stored(name).count() == stored(name).distinct().count()
    assert rows(stored("mimo"), "address") == rows(coinjoin.mimo_addresses(tx), "address")
    assert rows(stored("mixers"), "address", "score") == rows(coinjoin.coinjoin_address_score(tx, price), "address", "score")
    flow = spark.read.parquet(f"{out_}/value_flow")
    every = {r.address for r in large_value.utxo_large_value(flow).collect()}
    assert {r.address for r in stored("large_value").collect()} == every != set()
    means = sinks.read_runs(spark, f"{out_}/block_fees")
    assert rows(means, "block_number", "fee_per_byte") == rows(fees.block_fee_moving_avg(tx), "block_number", "fee_per_byte")
    tag_runs.inactivity_tables(spark, inactivity.utxo_activity(flow), out_, datetime(2021, 8, 4))
    view = tag_runs.utxo_tag_view(spark, out_)
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 8 and plan.count("Exchange hashpartitioning") == 1
    assert {r.plots for r in view.collect()} >= {"P109", "P401"}


def test_views_of_nothing(spark, tmp_path):
    assert tag_runs.utxo_tag_view(spark, str(tmp_path)).collect() == []
    assert tag_runs.account_tag_view(spark, str(tmp_path)).collect() == []


def test_categories_of_one_table(spark):
    names = sorted({s for spec in tag_views.CATEGORIES.values() for s in spec.sources})
    users = spark.createDataFrame([(n, f"u{k % 4}") for k, n in enumerate(names)] + [("no_source", "x")], "table string, address string")
    by_name = {n: users.where(users.table == n).select("address") for n in names}
    apart = [tag_views.category_tags(spec, by_name) for spec in tag_views.CATEGORIES.values()]
    together = rows(tag_views.categories_of(users).distinct(), "address", "feature", "plots", "idx")
    assert together == sorted({tuple(r) for t in apart for r in t.select("address", "feature", "plots", "idx").collect()})


def test_account_tables_and_view(spark, tmp_path):
    """One run over all days of the sample chain gives the tags of the view query; a repeated run adds nothing."""
    sf, out_ = "/root/testdata/sf0.001", str(tmp_path)
    names = ("account_transactions", "protocol_events", "logs", "traces", "token_transfers", "token_price", "token_decimals", "contracts")
    tables = {name: getattr(derived, name)(spark, sf) for name in names}
    for _ in range(2):
        tag_runs.account_tag_tables(tables, out_)
    columns = ("address", "feature", "name", "plots", "idx")
    key = lambda df: sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    view = tag_runs.account_tag_view(spark, out_)
    expected = sample_queries.account_tags(spark, sf).where("plots NOT IN ('P117', 'P118') OR plots IS NULL")
    assert key(view) == key(expected) and view.count() > 100
    for name in ("miners", "pools", "tornado_depositor", "uniswap_trader", "curve_trader", "ens_registrant", "ens_owner", "protocol_users"):
        assert sinks.read_runs(spark, f"{out_}/tags/{name}") is not None
