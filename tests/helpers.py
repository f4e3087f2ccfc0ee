from __future__ import annotations

from datetime import datetime

from txloom.schemas import ACCOUNT_TRANSACTIONS, UTXO_TRANSACTIONS, VALUE_FLOW

T0 = datetime(2021, 8, 1, 12)
COIN = 100_000_000


def out(index, value, *addresses, type="pubkeyhash"):
    return (index, value, type, list(addresses))


def inp(value, *addresses, origin="t0", index=0, type="pubkeyhash"):
    return (value, type, list(addresses), origin, index)


def utxo_tx(spark, *rows):
    """rows: dicts with hash, inputs, outputs and any other column."""
    data = []
    for r in rows:
        ts = r.get("ts", T0)
        data.append(
            (
                r["hash"],
                r.get("block", 100),
                ts,
                ts.date().replace(day=1),
                r.get("fee", 1000),
                r.get("vsize", 100),
                r.get("coinbase", False),
                r.get("n_in", len(r["inputs"])),
                r.get("n_out", len(r["outputs"])),
                r["inputs"],
                r["outputs"],
            )
        )
    return spark.createDataFrame(data, UTXO_TRANSACTIONS)


def flow_rows(spark, *rows):
    """rows: (hash, address, net, usd per coin, ts, block)."""
    data = []
    for h, address, net, price, ts, block in rows:
        spent, got = (-net, None) if net < 0 else (None, net)
        usd = lambda v: None if v is None else v * price  # noqa: B023,E731
        data.append((h, block, address, ts, spent, got, float(net), usd(spent), usd(got), net * price, ts.date()))
    data = [tuple(float(v) if isinstance(v, int) and i not in (1,) else v for i, v in enumerate(r)) for r in data]
    return spark.createDataFrame(data, VALUE_FLOW)


def account_tx(spark, *rows):
    data = []
    for r in rows:
        data.append(
            (
                r["hash"],
                r.get("src", "0xaaa"),
                r.get("dst", "0xbbb"),
                r.get("input", "0x"),
                r.get("block", 1),
                r.get("ts", T0),
                r.get("status", 1),
                r.get("gas_price", 10),
                r.get("gas", 100),
            )
        )
    return spark.createDataFrame(data, ACCOUNT_TRANSACTIONS)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
