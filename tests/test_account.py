"""Hand-made cases for the account-chain operators."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from helpers import T0, account_tx, rows
from pyspark.sql import functions as F

from txloom.functions import ZERO_ADDRESS, hex_bucket, md5_bucket, safe_numeric
from txloom.operators import account_activity, daily_stats, fast_tx, fees, large_value, protocols, score, tag_views, taint, token_flow, transfer_graph
from txloom.schemas import LOGS, PROTOCOL_EVENTS, RISK_WEIGHTS, TOKEN_PRICE, TOKEN_PRICE_FEED, TOKEN_TRANSFERS, TRACES

DAY = date(2021, 8, 1)
WEI = 10**18


def traces(spark, *items):
    """items: (hash, src, dst, coins, block)."""
    data = [(h, s, d, "call", None, Decimal(c) * WEI, b, T0 + timedelta(minutes=b)) for h, s, d, c, b in items]
    return spark.createDataFrame(data, TRACES)


def transfers(spark, *items):
    data = [(h, s, d, t, v, 1, T0) for h, s, d, t, v in items]
    return spark.createDataFrame(data, TOKEN_TRANSFERS)


@pytest.fixture(scope="module")
def price(spark):
    return spark.createDataFrame(
        [(ZERO_ADDRESS, DAY, 2000.0, "eth"), ("0xt", DAY, 3.0, "T"), ("0xu", DAY, 1.0, "U")], TOKEN_PRICE
    )


@pytest.fixture(scope="module")
def decimals(spark):
    return spark.createDataFrame([("0xt", "2"), ("0xu", None)], "address string, decimals string")


def events(spark, *items):
    data = [(p, e, h, ts, o, n, x) for p, e, h, ts, o, n, x in items]
    return spark.createDataFrame(data, PROTOCOL_EVENTS)


def test_buckets(spark):
    df = spark.createDataFrame([("0xabcfff",), ("0xabc001",), ("nothexz",)], "a string")
    assert [r[0] for r in df.select(hex_bucket("a")).collect()] == [0xFFF % 4000, 1, None]
    assert all(0 <= r[0] < 4000 for r in df.select(md5_bucket("a")).collect())


def test_safe_numeric(spark):
    texts = ["12", "bad", "9" * 29, "9" * 30, "0.1234567894", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(safe_numeric("t")).collect()]
    assert got[1] is None and got[3] is None and got[5] is None
    assert got[0] == 12 and got[2] == Decimal("9" * 29) and got[4] == Decimal("0.123456789")


def test_totals_follow_published_null_rule(spark):
    tx = account_tx(spark, {"hash": "t1", "src": "a", "dst": "b", "gas_price": 10**9, "gas": 10**9}, {"hash": "t2", "src": "a", "dst": None})
    stored = spark.createDataFrame([("a", 5, 1.0), ("z", 7, 2.0)], "address string, total_tx_cnt bigint, total_fee double")
    plain = rows(account_activity.address_tx_cnt_and_fee(tx, date(2021, 8, 2)), "address", "total_tx_cnt", "total_fee")
    assert plain == [("a", 2, pytest.approx(1.0)), ("b", 1, 0.0)]
    merged = rows(account_activity.address_tx_cnt_and_fee(tx, stored=stored), "address", "total_tx_cnt", "total_fee")
    assert merged == [("a", 7, pytest.approx(2.0)), ("b", 1, None), ("z", 7, None)]
    kept = rows(account_activity.address_tx_cnt_and_fee(tx, stored=stored, null_fee_as_zero=True), "address", "total_fee")
    assert kept == [("a", pytest.approx(2.0)), ("b", 0.0), ("z", 2.0)]


def test_succeeded_transfers_take_backfilled_status(spark, price):
    tr = traces(spark, ("ok", "a", "b", 1, 1), ("late", "a", "b", 2, 1), ("undone", "a", "b", 3, 1), ("ok", None, "b", 4, 1), ("ok", "a", None, 5, 1), ("ok", "a", "b", 0, 1))
    tx = account_tx(spark, {"hash": "ok"}, {"hash": "late", "status": None}, {"hash": "undone", "status": 1})
    late = spark.createDataFrame([("late", 1), ("undone", 0)], "transaction_hash string, receipt_status int")
    got = rows(token_flow.succeed_transfers(tr, tx, price, late, date(2021, 8, 2)), "hash", "value", "usd_value", "pt")
    assert got == [("late", 2.0, 4000.0, DAY), ("ok", 1.0, 2000.0, DAY)]
    assert rows(token_flow.successful_tx(tx, late), "hash") == [("late",), ("ok",), ("undone",)]


def test_token_price_is_one_row_per_day(spark):
    feed = lambda *r: spark.createDataFrame(list(r), TOKEN_PRICE_FEED)
    got = rows(token_flow.token_price_daily(feed(("t", T0, 2.0, "B")), feed(("t", T0 + timedelta(hours=1), 1.0, "C"))), "price", "symbol")
    assert got == [(1.0, "B")]


def test_priced_transfers_and_statistics(spark, price, decimals):
    tr = traces(spark, ("n", "a", "b", 1, 1), ("failed", "a", "b", 9, 2), ("n", None, "c", 2, 3))
    tt = transfers(spark, ("d", "a", "b", "0xt", "500"), ("d", "a", "b", "0xu", "1"), ("swap", "a", "b", "0xt", "700"), ("d", "b", "a", "0xt", "x"))
    tx = account_tx(
        spark,
        {"hash": "n", "src": "a", "dst": "b"},
        {"hash": "failed", "src": "a", "dst": "b", "status": 0},
        {"hash": "d", "src": "e", "dst": "0xt", "input": "0xa9059cbb000"},
        {"hash": "swap", "src": "a", "dst": "q", "input": "0xdead"},
    )
    none = spark.createDataFrame([], "transaction_hash string, receipt_status int")
    moved = token_flow.priced_transfers(tr, tt, tx, price, [decimals], date(2021, 8, 2), token_flow.successful_tx(tx, none))
    assert rows(moved, "transaction_hash", "token_address", "value", "usd_value") == [
        ("d", "0xt", 5.0, 15.0), ("d", "0xt", None, None), ("n", ZERO_ADDRESS, 1.0, 2000.0), ("n", ZERO_ADDRESS, 2.0, 4000.0),
    ]
    stats = {(r.address, r.token_address): r for r in daily_stats.token_stat_daily(moved, tx, date(2021, 8, 2)).collect()}
    a = stats["a", "0xt"]
    assert (a.in_tx_cnt, a.in_tx_value, a.out_tx_cnt, a.out_tx_value, a.turnover, a.tx_cnt) == (1, 0.0, 1, 5.0, 1.0, 3)
    assert (a.first_out_tx_hash, a.last_out_tx_value, a.first_in_tx_value) == ("d", 5.0, None)
    assert stats["e", None].tx_cnt == 1 and stats["e", None].in_tx_cnt is None  # only in transactions
    fixed = daily_stats.token_stat_daily(moved, tx, turnover="value").where((F.col("address") == "a") & (F.col("token_address") == "0xt"))
    assert rows(fixed, "turnover") == [(5.0,)]


def test_large_value_sides(spark):
    moved = spark.createDataFrame([("a", "b", "0xt", "T", 60_000.0)], "from_address string, to_address string, token_address string, symbol string, usd_value double")
    assert rows(large_value.account_large_value(moved), "address", "idx", "feature") == [
        ("b", 1, "addr_in_tx_10k_usd"), ("b", 2, "addr_in_tx_10k_usd"), ("b", 4, "addr_out_tx_10k_usd"), ("b", 5, "addr_out_tx_10k_usd"),
    ]
    assert rows(large_value.account_large_value(moved, out_side="from"), "address", "idx") == [("a", 4), ("a", 5), ("b", 1), ("b", 2)]


def test_edges_look_up_first_hash_before_status(spark, price, decimals):
    tr = traces(spark, ("bad", "a", "b", 1, 1), ("good", "a", "b", 2, 2), ("bad", "c", "d", 1, 1))
    tx = account_tx(spark, {"hash": "bad", "status": 0}, {"hash": "good"}, {"hash": "d", "input": "0xa9059cbb"})
    tt = transfers(spark, ("d", "a", "b", "0xt", "500"))
    tokens = token_flow.valid_tokens(price, [decimals])
    direct = token_flow.direct_token_transfers(tt, tx, tokens, scale="divide")
    edges = transfer_graph.token_transfers_graph(tr, tx, direct, price)
    assert rows(edges, "from_address", "symbol", "to_amount", "transaction_cnt", "first_transaction_hash", "last_transaction_hash") == [
        ("a", "T", 5.0, 1, "d", "d"), ("a", "eth", 2.0, 1, None, "good"),
    ]
    after = transfer_graph.token_transfers_graph(tr, tx, direct, price, rank_after_filter=True)
    assert rows(after.where("symbol = 'eth'"), "first_transaction_hash") == [("good",)]


def test_fast_tx_counts_receiver_once_per_block(spark):
    tx = account_tx(spark, *[{"hash": f"t{i}", "src": "a", "dst": "b", "block": b} for i, b in enumerate((1, 1, 9))], {"hash": "n", "dst": None})
    assert rows(fast_tx.account_fast_tx(tx), "address", "idx") == [("a", 3), ("b", 2)]
    assert rows(fast_tx.account_fast_tx(tx, gap="elapsed"), "address", "idx") == []


def test_high_fee_keeps_missing_receiver(spark):
    tx = account_tx(spark, {"hash": "t", "src": "a", "dst": None, "block": 5, "gas_price": 50})
    means = spark.createDataFrame([(5, T0, 10.0)], "block_number bigint, block_timestamp timestamp, gas_price_prev6_blk double")
    assert rows(fees.account_high_fee(tx, means), "address", "idx") == [("a", 10), (None, 11)]


def test_deployers_miners_pools_nft(spark):
    tx = account_tx(spark, {"hash": "1", "src": "a", "dst": None, "ts": T0}, {"hash": "2", "src": "a", "dst": None, "ts": T0 - timedelta(hours=1)}, {"hash": "3", "src": "b"})
    assert rows(account_activity.contract_deployers(tx, date(2021, 8, 2)), "address", "tx_timestamp") == [("a", T0 - timedelta(hours=1))]
    tr = spark.createDataFrame([("h", None, "m", "reward", k, Decimal(1), 1, T0) for k in ("block", "block", "uncle", "other")], TRACES)
    seed = spark.createDataFrame([("s", "pool")], "to_address string, tags string")
    assert rows(account_activity.miners(tr, seed=seed), "to_address", "tags") == [("m", "miner"), ("m", "uncle miner"), ("m", None), ("s", "pool")]
    data = "0x" + "0" * 24 + "a" * 40 + "0" * 24 + "b" * 40
    logs = spark.createDataFrame(
        [("1", [account_activity.V3_POOL_TOPIC], data, T0), ("2", [account_activity.V2_POOL_TOPIC, "x"], data, T0), ("3", [], data, T0), ("4", [account_activity.V2_POOL_TOPIC], data, datetime(2018, 1, 1))],
        LOGS,
    )
    assert rows(account_activity.uniswap_pools(logs), "address", "tag") == [("0x" + "a" * 40, "uniswap_v2(1)_pool"), ("0x" + "b" * 40, "uniswap_v3_pool")]
    nft = spark.createDataFrame([("0xn", True), ("0xt", False), ("0xq", None)], "address string, is_erc721 boolean")
    tt = transfers(spark, ("1", "a", "b", "0xn", "1"), ("2", "c", "d", "0xt", "1"), ("3", "e", "f", "0xq", "1"))
    assert rows(account_activity.nft_users(tt, nft, date(2021, 8, 2)), "address") == [("a",), ("b",)]


def test_protocol_users_first_time_and_new_only(spark):
    tx = account_tx(spark, {"hash": "1", "src": "a", "ts": T0}, {"hash": "2", "src": "a", "ts": T0 - timedelta(hours=2)}, {"hash": "3", "src": "b"}, {"hash": "4", "src": "c"})
    ev = events(
        spark,
        *[("aave", "LendingPool_event_Borrow", h, T0, None, None, None) for h in ("1", "1", "2")],
        ("aave", "LendingPool_v2_event_Borrow", "3", T0, None, None, None),
        ("other", "LendingPool_event_Borrow", "4", T0, None, None, None),
        ("compound", "cBAT_event_Mint", "4", T0, None, None, None),
        ("compound", "cREP_event_Mint", "3", T0, None, None, None),
    )
    spec = protocols.PROTOCOLS["aave_borrower"]
    assert rows(protocols.protocol_users(tx, ev, spec, date(2021, 8, 2)), "address", "tx_timestamp", "tag") == [
        ("a", T0 - timedelta(hours=2), "AAVE borrower"), ("b", T0, "AAVE borrower"),
    ]
    stored = spark.createDataFrame([("a",)], "address string")
    assert rows(protocols.protocol_users(tx, ev, spec, stored=stored), "address") == [("b",)]
    assert rows(protocols.protocol_user_tables(tx, ev, protocols.PROTOCOLS), "table", "address") == [
        ("aave_borrower", "a"), ("aave_borrower", "b"), ("compound_supplier", "c"),
    ]


def test_selector_protocols(spark):
    router, mixed = protocols.UNISWAP_V2_ROUTERS
    calls = [("v1", "q", "0xf39b5b9b11"), ("v2", router, "0x7ff36ab5"), ("mixed", mixed.lower(), "0x7ff36ab5"), ("v2else", "q", "0x7ff36ab5"), ("v3", router, "0xac9650d8"), ("t", protocols.TORNADO_PROXY, "0x13d98d13ff"), ("none", None, None)]
    tx = account_tx(spark, *[{"hash": n, "src": n, "dst": d, "input": i} for n, d, i in calls])
    assert rows(protocols.uniswap_traders(tx), "address") == [("v1",), ("v2",), ("v3",)]
    assert rows(protocols.tornado_depositors(tx), "address") == [("t",)]
    logs = spark.createDataFrame([("v1", [protocols.CURVE_TOPICS[1]], "", T0), ("v2", [], "", T0), ("v3", ["x", protocols.CURVE_TOPICS[0]], "", T0)], LOGS)
    assert rows(protocols.curve_traders(tx, logs, date(2021, 8, 2)), "address") == [("v1",)]


def test_ens(spark):
    reg, old, renew = protocols.ENS_REGISTERED[0], protocols.ENS_HASH_REGISTERED, protocols.ENS_RENEWED[2]
    ev = events(
        spark,
        ("ens", reg, "1", T0, "a", "n", "1600000000"),
        ("ens", reg, "2", T0 + timedelta(days=1), "a", "m", "1600000001"),
        ("ens", old, "3", T0, "a", None, None),
        ("ens", renew, "4", T0, "z", "n", "1700000000"),
    )
    assert rows(protocols.ens_registrants(ev), "address", "tx_timestamp") == [("a", T0), ("a", T0)]
    got = rows(protocols.ens_owners(ev).withColumn("s", F.unix_timestamp("expire_timestamp")), "name", "s")
    assert got == [("m", 1600000001), ("n", 1700000000)]


def test_account_exposure(spark):
    moved = spark.createDataFrame([("a", "bad", 500_000.0), ("a", "c", 500_000.0), ("bad", "d", 100.0)], "from_address string, to_address string, usd_value double")
    labels = spark.createDataFrame([("bad", "P001"), ("bad", "P001")], "address string, plots string")
    assert rows(taint.account_exposure(moved, labels), "address", "idx", "sub_weight") == [("a", 3, 0.25), ("d", 4, pytest.approx(100 / 1_000_100))]


def test_union_tags_and_categories(spark):
    tag = lambda *r: spark.createDataFrame(list(r), "address string, feature string, name string, plots string, idx int")
    users = {n: spark.createDataFrame([("u",), (n,)], "address string") for n in ("aave_flashloan_user", "balancer_flashloan_user")}
    flash = tag_views.category_tags(tag_views.CATEGORIES["decentralised_flashloan_user"], users)
    assert rows(flash, "address", "feature", "plots", "idx")[-1] == ("u", "Decentralised loan depositor", "P701", 3)
    assert flash.count() == 3
    empty = spark.createDataFrame([], "address string, feature string, name string, plots string, idx int")
    out = tag_views.account_union_tags(
        tag(("f", "x", None, "P111", 2), ("f", "x", None, "P111", 2)), tag(("h", "y", None, "P121", 11)), tag(("l", "z", None, "P401", 6)),
        spark.createDataFrame([("i",)], "address string"), empty, empty, {n: (flash if "flash" in n else empty) for n in tag_views.CATEGORIES},
    )
    assert rows(out.where("plots <> 'P701'"), "address", "plots", "idx") == [("f", "P112", 12), ("h", "P121", 10), ("i", "P117", 4), ("l", "P401", 6)]


def test_score(spark):
    weights = spark.createDataFrame([("P001", 10.0, 0, 1.0), ("P001", 10.0, 3, 0.5), ("P112", 20.0, 11, 1.0)], RISK_WEIGHTS)
    exposed = spark.createDataFrame([("a", "P001", "r", 0, 1.0), ("a", "P001", "r", 3, 0.2), ("a", "P001", "r", 3, 0.4), ("b", "P002", "r", 0, 1.0)], "address string, plots string, relation string, idx int, sub_weight double")
    tags = spark.createDataFrame([("a", "one", None, "P112", 11), ("a", "two", None, "P112", 11), ("a", "x", None, "P999", 1)], "address string, feature string, name string, plots string, idx int")
    got = score.utxo_address_score(exposed, tags, weights, T0).collect()
    assert [r.address for r in got] == ["a"]  # b has no weighted label
    r = got[0]
    assert r.total_score == pytest.approx(32.0) and 0 < r.risk_score < 1
    assert r.risk_score == pytest.approx(1 / (1 + 2.718281828459045 ** (28 / 30)))
    assert r.plots_list == ["P001_0", "P001_3", "P112_11", "P999_1"]
    assert r.plot_weight_text == ["P001_12.000000", "P112_20.000000"]
