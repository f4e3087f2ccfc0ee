"""Streams from files: batches against one run, and replayed batches."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from helpers import T0, account_tx, inp, out, rows, utxo_tx

from txloom.operators import inactivity
from txloom.operators.account_activity import address_tx_cnt_and_fee
from txloom.operators.coinjoin import mimo_addresses
from txloom.sources import sinks
from txloom.streaming import incremental, stream


def replay(root):
    """Forget that the last batch was finished, as a driver that died at that moment would."""
    done = f"{root}/_checkpoint/commits"
    last = max((f for f in os.listdir(done) if f.isdigit()), key=int)
    os.remove(f"{done}/{last}")
    crc = f"{done}/.{last}.crc"
    if os.path.exists(crc):
        os.remove(crc)


def fed(spark, folder, batches, start):
    """Batches delivered one by one, the second and the last one twice."""
    for k, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(batch.schema).parquet(folder)
        start(source).awaitTermination()
        if k in (1, len(batches) - 1):
            replay(start.root)
            start(source).awaitTermination()


def starter(root, job, **options):
    def start(source):
        return job(source, root, **options)

    start.root = root
    return start


def test_totals_of_a_stream_equal_one_run(spark, tmp_path):
    batches = [
        account_tx(spark, *[{"hash": f"t{d}{i}", "src": f"a{i % 3}", "dst": f"a{(i + d) % 4}", "gas_price": 10**9, "gas": 1000, "ts": T0 + timedelta(days=d)} for i in range(5)])
        for d in range(3)
    ]
    root = f"{tmp_path}/totals"
    fed(spark, f"{tmp_path}/in", batches, starter(root, stream.stream_address_totals, null_fee_as_zero=True))
    every = batches[0].unionByName(batches[1]).unionByName(batches[2])
    got, expected = sinks.read_snapshot(spark, root), address_tx_cnt_and_fee(every)
    assert rows(got, "address", "total_tx_cnt") == rows(expected, "address", "total_tx_cnt")
    assert dict(rows(got, "address", "total_fee")) == pytest.approx(dict(rows(expected, "address", "total_fee")))


def test_appended_tags_of_a_stream(spark, tmp_path):
    make = lambda n: utxo_tx(spark, *[{"hash": f"t{n}", "block": n, "inputs": [inp(1, f"a{(n + k) % 6}", origin="o", index=k) for k in range(3)], "outputs": [out(k, 1, f"b{k}") for k in range(3)]}])
    batches, root = [make(n) for n in range(3)], f"{tmp_path}/mimo"
    fed(spark, f"{tmp_path}/in", batches, starter(root, stream.stream_mimo))
    got = sinks.read_runs(spark, root)
    every = batches[0].unionByName(batches[1]).unionByName(batches[2])
    assert rows(got, "address") == rows(mimo_addresses(every), "address") and got.count() == got.distinct().count() > 5


def test_inactivity_of_a_stream_survives_replays(spark, tmp_path):
    horizon = inactivity.Horizon(gap=3, inactive=6, expire_partition=8, expire=10)
    start = datetime(2021, 8, 1)
    make = lambda day, *a: spark.createDataFrame([(x, start + timedelta(days=day)) for x in a], "address string, block_timestamp timestamp")
    batches = [make(0, "a", "b", "c"), make(2, "b"), make(7, "a", "d"), make(9, "c")]
    root = f"{tmp_path}/i"
    fed(spark, f"{tmp_path}/in", batches, starter(root, stream.stream_inactivity, horizon=horizon, buckets=4))
    for k, batch in enumerate(batches):
        now = batch.first()["block_timestamp"]
        plain = incremental.run_inactivity(spark, f"{tmp_path}/plain", batch, now, horizon, buckets=4, version=stream.version_of(k))
    got = incremental.stored_inactivity(spark, root)
    assert rows(got.periodic, "address") == rows(plain.periodic, "address") == [("a",), ("c",)]
    assert rows(got.inactive, "address") == rows(plain.inactive, "address")
    assert rows(inactivity.expire_state(got.state, now, horizon), "address", "pt") == rows(plain.state, "address", "pt")
