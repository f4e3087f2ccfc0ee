"""Two-hop exposure: what a transaction sends to the next, and the weights against plain loops over all lines."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import Decimal

import pytest
from helpers import COIN, T0, inp, out, utxo_tx

from txloom.operators import taint
from txloom.plans import sample_queries as samples
from txloom.schemas import DAY_PRICE

SF = "/root/testdata/sf0.001"
PRICE = 1000


def test_only_leading_labels_are_stored_beside_the_transactions(spark):
    """Ledgers are read off the transactions, pairs of lines and labels are neither stored nor sent."""
    files = " ".join(samples._taint(spark, SF).inputFiles())
    assert "/tx_by_hash-" in files and "/taint_source_refs-" in files and "/taint_dest_refs-" in files
    assert not any(f"/taint_{name}-" in files for name in ("inputs", "outputs", "source_pairs", "dest_pairs"))


def test_a_row_goes_to_each_linked_transaction(spark):
    """20 lines with 2 labels to one spent transaction travel as one row, not as 40."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = [out(k, COIN, f"a{k}") for k in range(20)]
        spent = [inp(COIN, f"a{k}", origin="t0", index=k) for k in range(20)]
        tx = utxo_tx(spark, {"hash": "t0", "inputs": [inp(COIN, "s")], "outputs": lines}, {"hash": "t1", "inputs": spent, "outputs": [out(0, COIN, "l0"), out(1, COIN, "l1")]})
        price = spark.createDataFrame([(T0, Decimal(PRICE))], DAY_PRICE)
        labels = spark.createDataFrame([("l0", "P1", 1.0), ("l1", "P1", 1.0)], "address string, plots string, score double")
        plan = taint.indirect_source(tx, price, labels)._jdf.queryExecution().optimizedPlan().toString()
        sent = plan[plan.index("RepartitionByExpression [hash") :].splitlines()[1]
        assert "spent#" in sent and "refs#" in sent and "ref_address" not in sent
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")



def _loops(transactions, labels, source):
    """Weights of the indirect relations, each line with each label."""
    ins, outs, total = {}, {}, {}
    for t in transactions:
        ins[t["hash"]] = [(v, a, o, k) for v, kind, a, o, k in t["inputs"] if kind != "nulldata"]
        outs[t["hash"]] = [(k, v, a) for k, v, kind, a in t["outputs"] if kind != "nulldata"]
        total[t["hash"]] = sum(v * len(a) for v, a, *_ in ins[t["hash"]])
    reached, totals = defaultdict(list), defaultdict(float)
    for h in ins:
        for v, addresses in [(v, a) for v, a, *_ in ins[h]] if source else [(v, a) for _, v, a in outs[h]]:
            for a in addresses:
                totals[a] += v / COIN * PRICE
        if not total[h]:
            continue
        held = defaultdict(list)
        for v, addresses in [(v, a) for _, v, a in outs[h]] if source else [(v, a) for v, a, *_ in ins[h]]:
            for a in addresses:
                for plots, s in labels.get(a, ()):
                    held[plots, a].append((v, s))
        for (plots, ref), found in held.items():
            share = min(v for v, _ in found) / total[h]
            base = max(s for _, s in found)
            if source:
                for v, addresses, origin, index in ins[h]:
                    if origin in outs and any(k == index and a for k, _, a in outs[origin]) and any(a not in (ref, None) for a in addresses):
                        reached[origin, plots, ref].append((v * share, base))
            else:
                for k, v, addresses in outs[h]:
                    if any(a not in (ref, None) for a in addresses):
                        for n in ins:
                            if any(o == h and i == k and a for _, a, o, i in ins[n]):
                                reached[n, plots, ref].append((v * share, base))
    best = defaultdict(list)
    for (h, plots, ref), found in reached.items():
        for v, addresses in [(v, a) for v, a, *_ in ins[h]] if source else [(v, a) for _, v, a in outs[h]]:
            for a in addresses:
                if a not in (ref, None) and total[h]:
                    usd = v / COIN * PRICE * min(x for x, _ in found) / total[h]
                    best[h, a, plots].append((usd, max(s for _, s in found)))
    sums = defaultdict(list)
    for (_, a, plots), found in best.items():
        sums[a, plots].append((min(u for u, _ in found), max(s for _, s in found)))
    usd = {key: sum(u for u, _ in found) for key, found in sums.items()}
    return {k: u / totals[k[0]] * max(s for _, s in sums[k]) * min(1.0, u / taint.FULL_WEIGHT_USD) for k, u in usd.items() if u > 0}


@pytest.mark.parametrize("source", [True, False])
def test_indirect_relations_are_those_of_all_lines(spark, source):
    rng = random.Random(5)
    names = [f"a{k}" for k in range(12)]
    some = lambda: rng.choice([[], [rng.choice(names)], [rng.choice(names)], rng.sample(names, 2), [rng.choice(names)] * 2, [rng.choice(names), None], [None]])
    kind = lambda: rng.choice(["pubkeyhash"] * 4 + ["nulldata"])
    transactions = [
        {
            "hash": f"t{n}",
            "block": n,
            "inputs": [inp(rng.randrange(1, 9) * COIN, *some(), origin=f"t{max(0, n - rng.randrange(1, 4))}", index=rng.randrange(7), type=kind()) for _ in range(rng.randrange(1, 7))] if n else [],
            "outputs": [out(k, rng.randrange(1, 9) * COIN, *some(), type=kind()) for k in range(6)],
        }
        for n in range(25)
    ]
    labels = {a: {(f"P{rng.randrange(2)}", rng.choice([0.5, 1.0])), ("P9", 0.7)} for a in names[:8]}
    price = spark.createDataFrame([(T0, Decimal(PRICE))], DAY_PRICE)
    table = spark.createDataFrame([(a, p, s) for a, found in labels.items() for p, s in found], "address string, plots string, score double")
    relation = taint.indirect_source if source else taint.indirect_dest
    got = {(r["address"], r["plots"]): r["sub_weight"] for r in relation(utxo_tx(spark, *transactions), price, table).collect()}
    assert got == pytest.approx(_loops(transactions, labels, source)) and len(got) > 15
