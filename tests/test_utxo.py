"""Hand-made cases for the UTXO operators."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from helpers import COIN, T0, flow_rows, inp, out, rows, utxo_tx
from pyspark.sql import functions as F

from txloom.functions import previous_row_means
from txloom.operators import coinjoin, daily_stats, fast_tx, fees, large_value, spending, taint, transfer_graph, value_flow
from txloom.schemas import DAY_PRICE, KLINES

DAY = timedelta(days=1)


@pytest.fixture(scope="module")
def price(spark):
    days = [(datetime(2021, 8, 1) + n * DAY, Decimal(1000)) for n in range(5)]
    return spark.createDataFrame(days, DAY_PRICE)


def test_value_flow_shares_merges_and_drops(spark, price):
    tx = utxo_tx(
        spark,
        {
            "hash": "t1",
            "inputs": [inp(4 * COIN, "a", "b"), inp(COIN, "a"), inp(9 * COIN, "z", type="nulldata"), inp(COIN, "y", type=None)],
            "outputs": [out(0, 3 * COIN, "a"), out(1, COIN, "c"), out(2, 0, type="pubkeyhash")],
        },
    )
    got = rows(value_flow.utxo_value_flow(tx, price, date(2021, 8, 2)), "address", "in_value", "out_value", "net_value", "net_usd_value")
    assert got == [("a", 3.0, 3.0, 0.0, 0.0), ("b", 2.0, None, -2.0, -2000.0), ("c", None, 1.0, 1.0, 1000.0)]
    assert value_flow.utxo_value_flow(tx, price, date(2021, 8, 3)).count() == 0


def test_value_flow_old_days_share_a_month(spark, price):
    tx = utxo_tx(spark, {"hash": "t1", "ts": datetime(2015, 12, 9), "inputs": [], "outputs": [out(0, COIN, "a")]})
    got = rows(value_flow.utxo_value_flow(tx, price), "partition_date", "out_value", "out_usd_value")
    assert got == [(date(2015, 12, 1), 1.0, None)]


def test_daily_close_takes_largest_and_keeps_backfill(spark):
    k = spark.createDataFrame([(T0, "10.5", "BTCUSDT"), (T0, "11", "BTCUSDT"), (T0, "99", "X")], KLINES)
    back = spark.createDataFrame([(T0, Decimal(7))], DAY_PRICE)
    assert [float(r[1]) for r in rows(value_flow.daily_close(k, back), "price_timestamp", "price")] == [11.0, 7.0]


@pytest.mark.parametrize("span", [12, 13, 50, 1000])
def test_means_over_previous_rows_do_not_depend_on_cells(spark, span):
    blocks = [b * b % 997 for b in range(120)]  # gaps between block numbers
    df = spark.createDataFrame([(b, float(b % 17)) for b in sorted(set(blocks))], "block bigint, v double")
    got = {r[0]: r[1:] for r in previous_row_means(df, "block", "v", {"m3": 3, "m12": 12}, span).select("block", "m3", "m12").collect()}
    values = [(b, float(b % 17)) for b in sorted(set(blocks))]
    assert len(got) == len(values)
    for i, (b, _) in enumerate(values):
        for n, value in zip((3, 12), got[b]):
            window = [v for _, v in values[max(0, i - n) : i]]
            assert value == (pytest.approx(sum(window) / len(window)) if window else None)


def test_block_fee_leaves_out_stored_blocks(spark):
    tx = utxo_tx(spark, *[{"hash": f"t{b}", "block": b, "fee": b * 100, "inputs": [], "outputs": []} for b in (1, 2, 3, 4, 5)])
    stored = spark.createDataFrame([(1,), (2,)], "block_number bigint")
    got = rows(fees.block_fee_moving_avg(tx, date(2021, 8, 2), stored), "block_number", "fee_per_byte")
    assert got == [(3, 1.5), (4, 2.0), (5, 3.0)]


def _join_tx(h, values, n=3, lowest=COIN):
    ins = [inp(lowest, f"i{k}") for k in range(n)]
    return {"hash": h, "inputs": ins, "outputs": [out(k, v, a) for k, (v, a) in enumerate(values)]}


def test_coinjoin_rules(spark):
    tx = utxo_tx(
        spark,
        _join_tx("yes", [(COIN, "a"), (COIN, "b"), (COIN, "c"), (5, "d")]),
        _join_tx("same_address_twice", [(COIN, "a"), (COIN, "a"), (COIN, "c")]),
        _join_tx("four_equal", [(COIN, "a"), (COIN, "b"), (COIN, "c"), (COIN, "d")]),
        _join_tx("too_large", [(2 * COIN, "a"), (2 * COIN, "b"), (2 * COIN, "c")]),
        _join_tx("two_values", [(5, "a"), (5, "b"), (5, "c"), (9, "a"), (9, "b"), (9, "e")]),
        _join_tx("too_many_outputs", [(7, f"o{k}") for k in range(10)]),
        _join_tx("few_inputs", [(7, "a"), (7, "b")], n=2),
    )
    assert rows(coinjoin.coinjoin_tx(tx), "txhash") == [("two_values",), ("yes",)]


def test_coinjoin_score_uses_largest_value_and_keeps_stored(spark, price):
    tx = utxo_tx(spark, _join_tx("two", [(COIN, "a"), (COIN, "b"), (COIN, "c"), (5, "a"), (5, "b"), (5, "d")]))
    stored = spark.createDataFrame([("old", "mixer", None, "P015", 0.25)], "address string, feature string, name string, plots string, score double")
    got = dict(rows(coinjoin.coinjoin_address_score(tx, price, stored=stored), "address", "score"))
    best = 1 / (1 + 2.718281828459045 ** -((3 - 5) / 5 + (1000 - 1000) / 1000))
    assert got["a"] == pytest.approx(best) and got["d"] == pytest.approx(best) and got["i0"] == pytest.approx(best)
    assert got["old"] == 0.25


def test_fast_tx_pairs(spark):
    tx = utxo_tx(
        spark,
        *[{"hash": f"t{b}", "block": b, "inputs": [inp(1, "s"), inp(1, f"x{b}")], "outputs": [out(0, 1, "r"), out(1, 1, f"y{b}")]} for b in (1, 50, 100)],
        *[{"hash": f"u{b}", "block": b, "inputs": [inp(1, "p")], "outputs": [out(0, 1, "q")]} for b in (1, 3, 6)],
    )
    reference = rows(fast_tx.utxo_fast_tx(tx), "address", "idx")
    assert reference == [("p", 3), ("q", 1), ("q", 2), ("r", 1), ("r", 2), ("s", 3)]
    assert rows(fast_tx.utxo_fast_tx(tx, gap="elapsed"), "address", "idx") == [("p", 3), ("q", 1), ("q", 2)]


def test_high_fee_and_new_only_key(spark):
    tx = utxo_tx(spark, {"hash": "t", "block": 9, "fee": 5000, "vsize": 100, "inputs": [inp(1, "s")], "outputs": [out(0, 1, "r")]})
    means = spark.createDataFrame([(9, T0, 10.0)], "block_number bigint, block_timestamp timestamp, fee_per_byte double")
    assert rows(fees.utxo_high_fee(tx, means, date(2021, 8, 2)), "address", "idx") == [("r", 1), ("s", 2)]
    stored = spark.createDataFrame([("r", 2)], "address string, idx int")
    assert rows(fees.utxo_high_fee(tx, means, stored=stored), "address") == [("s",)]
    assert rows(fees.utxo_high_fee(tx, means, stored=stored, new_only_on=("address", "idx")), "address") == [("r",), ("s",)]


def test_large_value_tiers(spark):
    flow = flow_rows(spark, ("t", "a", 60, 1000, T0, 1), ("u", "a", -10, 1000, T0, 1), ("v", "b", 9, 1000, T0, 1))
    assert rows(large_value.utxo_large_value(flow, date(2021, 8, 2)), "address", "idx") == [("a", 1), ("a", 4), ("a", 5)]


def test_coinbase_and_frequent_io(spark):
    tx = utxo_tx(
        spark,
        {"hash": "c", "block": 10, "coinbase": True, "inputs": [], "outputs": [out(0, 1, "m"), out(1, 1, "n")]},
        {"hash": "d", "block": 15, "inputs": [inp(1, "m", origin="c", index=0), inp(1, "x", origin="c", index=1)], "outputs": []},
        {"hash": "e", "block": 40, "inputs": [inp(1, "n", origin="c", index=1)], "outputs": []},
    )
    assert rows(spending.coinbase_miners(tx), "block_number", "address") == [(10, "m"), (10, "n")]
    stored = spark.createDataFrame([("m", 3), ("k", 2)], "address string, min_gap bigint")
    assert rows(spending.frequent_io(tx), "address", "min_gap") == [("m", 5)]
    assert rows(spending.frequent_io(tx, stored=stored), "address", "min_gap") == [("k", 2), ("m", 3)]


def test_stat_daily_counts_and_endpoints(spark):
    later = T0 + timedelta(hours=2)
    flow = flow_rows(spark, ("t1", "a", 2, 10, T0, 1), ("t2", "a", 3, 10, later, 2), ("t3", "a", -1, 10, later, 2), ("t0", "b", 0, 10, T0, 1))
    got = daily_stats.utxo_stat_daily(flow, date(2021, 8, 2)).collect()
    assert len(got) == 1  # an address without net flow has no row
    r = got[0]
    assert (r.in_tx_cnt, r.out_tx_cnt, r.in_tx_value, r.turnover, r.smallest_inflow, r.largest_inflow_usd) == (2, 1, 5.0, 6.0, 2.0, 30.0)
    assert (r.first_in_tx_hash, r.last_in_tx_hash, r.first_out_tx_hash, r.last_out_tx_value) == ("t1", "t2", "t3", -1.0)


def test_transfers_conserve_value_and_respect_guard(spark):
    many = [(f"big", f"s{i}", -1, 10, T0, 1) for i in range(100)] + [("big", f"r{i}", 1, 10, T0, 1) for i in range(100)]
    flow = flow_rows(
        spark,
        ("t", "a", -3, 10, T0, 1), ("t", "b", -1, 10, T0, 1), ("t", "c", 2, 10, T0, 1), ("t", "d", 2, 10, T0, 1),
        ("burn", "a", -5, 10, T0, 2),
        *many,
    )
    edges = transfer_graph.utxo_transfers(flow)
    assert rows(edges, "from_address", "to_address", "to_amount", "to_amount_usd") == [
        ("a", "c", 1.5, 15.0), ("a", "d", 1.5, 15.0), ("b", "c", 0.5, 5.0), ("b", "d", 0.5, 5.0),
    ]
    both = transfer_graph.utxo_transfers_by_receiver(edges)
    assert both.count() == 4 and set(r.pt for r in both.collect()) != set(r.pt for r in edges.collect())


def _brute_taint(ins, outs, labels):
    """All pairs, as the published definition forms them: smallest amount for any value."""
    by = {}
    for h, a, v, usd, total in ins:
        for g, ref, w, _, _ in outs:
            if h == g and ref in labels and a != ref:
                key = (h, a, labels[ref][0])
                score = max(by.get(key, (0, 0))[1], labels[ref][1])
                amount = min(by[key][0], usd * (w / total)) if key in by else usd * (w / total)
                by[key] = (amount, score)
    return by


def test_direct_source_equals_all_pairs_on_dense_transactions(spark, price):
    names = [f"l{i}" for i in range(8)]
    tx = utxo_tx(
        spark,
        *[
            {
                "hash": f"t{t}",
                "inputs": [inp((3 + i * t % 5) * COIN, names[(i + t) % 8]) for i in range(6)],
                "outputs": [out(i, (1 + (i * 7 + t) % 4) * COIN, names[(i * 3 + t) % 8]) for i in range(8)],
            }
            for t in range(5)
        ],
    )
    labels = {n: ("P001" if i % 2 else "P015", 0.1 * (i + 1)) for i, n in enumerate(names)}
    tags = spark.createDataFrame([(n, p, s) for n, (p, s) in labels.items()], "address string, plots string, score double")
    ins = [tuple(r) for r in taint.input_ledger(tx, price).select("hash", "address", "value", "spent_usd_value", "total_in").collect()]
    outs = [tuple(r) for r in taint.output_ledger(tx, price).select("hash", "address", "value", "receive_usd_value", "total_out").collect()]
    spent: dict[str, float] = {}
    for _, a, _, usd, _ in ins:
        spent[a] = spent.get(a, 0) + usd
    total: dict[tuple, list] = {}
    for (_, a, p), (usd, score) in _brute_taint(ins, outs, labels).items():
        t = total.setdefault((a, p), [0.0, 0.0])
        t[0] += usd
        t[1] = max(t[1], score)
    expected = {k: u / spent[k[0]] * s * min(u / 10000, 1) for k, (u, s) in total.items() if u > 0}
    got = {(r.address, r.plots): r.sub_weight for r in taint.direct_source(tx, price, taint.labels_of(tags)).collect()}
    assert got == pytest.approx(expected)


def test_two_hops_reach_through_one_transaction(spark, price):
    tx = utxo_tx(
        spark,
        {"hash": "t1", "inputs": [inp(COIN, "far", origin="t0")], "outputs": [out(0, COIN, "mid")]},
        {"hash": "t2", "inputs": [inp(COIN, "mid", origin="t1", index=0)], "outputs": [out(0, COIN, "bad")]},
        {"hash": "t3", "inputs": [inp(COIN, "bad", origin="t2", index=0)], "outputs": [out(0, COIN, "next")]},
        {"hash": "t4", "inputs": [inp(COIN, "next", origin="t3", index=0)], "outputs": [out(0, COIN, "last")]},
    )
    tags = spark.createDataFrame([("bad", "seed", None, "P001", 1.0)], "address string, feature string, name string, plots string, score double")
    got = rows(taint.taint_propagation(tx, price, tags, tags), "address", "relation", "sub_weight")
    assert got == [
        ("bad", "direct", 1.0), ("far", "indirect source", 0.1), ("last", "indirect dest", 0.1),
        ("mid", "direct source", 0.1), ("next", "direct dest", 0.1),
    ]


def test_common_weights(spark, price):
    four = [inp(COIN, a) for a in ("bad", "x", "y", "z")]
    tx = utxo_tx(spark, {"hash": "t1", "inputs": four, "outputs": []}, {"hash": "t2", "inputs": four[:2], "outputs": []})
    labels = spark.createDataFrame([("bad", "P001", 0.8)], "address string, plots string, score double")
    got = rows(taint.common_input(tx, price, labels), "address", "sub_weight")
    assert got == [("x", pytest.approx(0.6)), ("x", 1.0), ("y", pytest.approx(0.6)), ("z", pytest.approx(0.6))]


def test_no_python_in_plans(spark, price):
    tx = utxo_tx(spark, {"hash": "t", "inputs": [inp(1, "a")], "outputs": [out(0, 1, "b")]})
    plan = value_flow.utxo_value_flow(tx.select("*"), price)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None
