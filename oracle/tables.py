"""Common table expressions for the derived chain tables, as text DuckDB runs on the sample views.

`statement(body)` puts in front of a body the expressions it names, directly or through others.
"""

from __future__ import annotations

import re

from oracle.specs import CURVE_TOPICS, EVENT_PAIRS, TORNADO_PROXY, UNISWAP_V2_ROUTERS, V2_POOL_TOPIC, V3_POOL_TOPIC, WEIGHTED_CODES

ZERO = "0x" + "0" * 40


def acct(n: str) -> str:
    return f"concat('0x', md5(concat('a', {n})))"


def tok(n: str) -> str:
    return f"concat('0x', md5(concat('tok', {n})))"


CLOSE = "4000 + ((day(d) * 37) % 50) * 1000"
_protocols = ", ".join(f"'{p}'" for p, _ in EVENT_PAIRS)
_events = ", ".join(f"'{e}'" for _, e in EVENT_PAIRS)
_weights = ", ".join(f"('{p}', {i}, 10.0 * {1 - i * 0.05:.2f})" for p, i in WEIGHTED_CODES)

CTES: dict[str, str] = {
    # --- UTXO chain ---
    "led": """
        select l_orderkey as k,
          row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity,
            l_extendedprice, l_shipdate, l_returnflag, l_linestatus) - 1 as idx,
          case when l_partkey % 11 = 0 then [concat('a', l_partkey % 500), concat('a', (l_partkey + 7) % 500)]
               else [concat('a', l_partkey % 500)] end as addresses,
          (cast(floor(l_quantity / 17) as bigint) + 1) * 100000000 as value,
          case when l_returnflag = 'R' and l_linestatus = 'O' then 'nulldata' else 'pubkeyhash' end as type
        from lineitem""",
    "led_n": "select k, count(*) as n from led group by k",
    "tx": """
        select o_orderkey as k, md5(concat('t', o_orderkey)) as hash,
          date_diff('day', date '1995-01-01', cast(o_orderdate as date)) as bn, o_orderdate as ts,
          cast(date_trunc('month', o_orderdate) as date) as mon,
          cast(round(o_totalprice * 100) as bigint) as fee, 100 + (o_orderkey % 97) * 10 as vs,
          o_orderkey % 50 = 0 as cb,
          case when o_orderkey % 50 = 0 then 0 else coalesce(p.n, 0) end as n_in, coalesce(q.n, 0) as n_out
        from orders left join led_n p on p.k = o_orderkey - 1 left join led_n q on q.k = o_orderkey""",
    "out_line": "select tx.*, idx, addresses, value, type from tx join led on led.k = tx.k",
    "in_line": """
        select tx.*, idx, addresses, value, type, md5(concat('t', tx.k - 1)) as origin
        from tx join led on led.k = tx.k - 1 where not cb""",
    "out_addr": """
        select * exclude (addresses), len(addresses) as owners, unnest(addresses) as address
        from out_line where type <> 'nulldata'""",
    "in_addr": """
        select * exclude (addresses), len(addresses) as owners, unnest(addresses) as address
        from in_line where type <> 'nulldata'""",
    "days": "select distinct cast(o_orderdate as date) as d from orders",
    "price": f"""
        select d, cast(max(c) as double) as price from (
          select d, {CLOSE} as c from days union all select d, {CLOSE} - 500 from days where d >= date '1996-01-01')
        group by d""",
    "flow_out": """
        select hash, address, max(bn) as bn, max(ts) as ts, sum(value / owners) * 1e-8 as v
        from out_addr group by hash, address""",
    "flow_in": """
        select hash, address, max(bn) as bn, max(ts) as ts, sum(value / owners) * 1e-8 as v
        from in_addr group by hash, address""",
    "flow": """
        select hash, coalesce(o.bn, i.bn) as bn, address, coalesce(o.ts, i.ts) as ts, i.v as in_v, o.v as out_v,
          coalesce(o.v, 0) - coalesce(i.v, 0) as net, price
        from flow_out o full join flow_in i using (hash, address)
          left join price on d = cast(coalesce(o.ts, i.ts) as date)""",
    "old_addr": "select distinct concat('a', l_partkey % 500) as address, l_partkey % 500 as n from lineitem where l_partkey % 500 % 2 = 0",
    "curated": """
        select distinct concat('a', n) as address, concat('n', n) as name,
          case n % 3 when 0 then 'P001' when 1 then 'P002' else 'P015' end as plots
        from (select l_partkey % 500 as n from lineitem) where n % 25 = 0""",
    # --- equal-value joins ---
    "ev_lowest": "select hash, min(value) as lowest from in_line group by hash",
    "ev_owner": """
        select distinct hash, n_in, ts, value, array_to_string(addresses, ',') as owner from out_line
        where n_in >= 3 and n_out between greatest(3, n_in) and n_in * 3""",
    "ev": """
        select hash, n_in, ts, value from ev_owner join ev_lowest using (hash)
        where value <= lowest group by hash, n_in, ts, value having count(*) = n_in""",
    "ev_scored": """
        select hash, 1 / (1 + exp(-((n_in - 5) / 5 + (price * value * 1e-8 - 1000) / 1000))) as score
        from ev left join price on d = cast(ts as date)""",
    "set_addr": """
        select hash, n_in, n_out, array_to_string(addresses, ',') as address from in_line
        union select hash, n_in, n_out, array_to_string(addresses, ',') from out_line""",
    "mixers": "select address, max(score) as score from ev_scored join set_addr using (hash) group by address",
    "mimo": "select distinct address from set_addr where n_in >= 3 and n_out >= 3",
    # --- UTXO behaviour ---
    "fast_rows": "select distinct hash, bn, array_to_string(addresses, ',') as receiver from out_line",
    "fast_pairs": """
        select distinct i.hash, i.bn, array_to_string(i.addresses, ',') as sender, array_to_string(o.addresses, ',') as receiver
        from in_line i join out_line o on i.hash = o.hash""",
    "fast1": "select receiver, bn - lag(bn, 2) over (partition by receiver order by bn) as gap from fast_rows",
    "fast2": "select sender, receiver, bn - lag(bn, 2) over (partition by receiver, sender order by bn) as gap from fast_pairs",
    "block_fee": """
        select bn, min(ts) as ts, min(mon) as mon, sum(fee) / sum(vs) as rate from tx group by bn""",
    "block_ma": """
        select bn, ts, mon, avg(rate) over (order by bn rows between 3 preceding and 1 preceding) as fee_per_byte from block_fee""",
    "high_tx": "select hash from tx join block_ma using (bn) where fee / vs >= 5 * fee_per_byte",
    "high_fee": """
        select unnest(addresses) as address, 'address_high_fee_in_tx' as feature, 1 as idx from out_line where hash in (from high_tx)
        union select unnest(addresses), 'address_high_fee_out_tx', 2 from in_line where hash in (from high_tx)""",
    "large": """
        select distinct address, concat('addr_', side, '_tx_', name, '_usd') as feature, base + rank as idx
        from (select address, 'in' as side, in_v * price as usd, 0 as base from flow
              union all select address, 'out', out_v * price, 3 from flow)
          join (values (10000, '10k', 1), (50000, '50k', 2), (100000, '100k', 3)) t(tier, name, rank) on usd >= tier""",
    # --- inactivity ---
    "act": "select address, ts from flow",
    "act_state": "select address, max(ts) as last from act where ts < '2001-07-01' group by address",
    "act_live": """
        select * from act_state where not (
          case when last < '2016-01-01' then cast(date_trunc('month', last) as date) else cast(last as date) end
            <= date '2001-08-02' - 90 and epoch(timestamp '2001-08-02' - last) > 100 * 86400)""",
    "act_batch": "select address, min(ts) as first, max(ts) as last from act where ts >= '2001-07-01' group by address",
    "act_periodic": """
        select address, timestamp '2000-08-02' as create_time from old_addr where n % 10 = 0
        union all
        select address, timestamp '2001-08-02' from act_batch b join act_live s using (address)
        where b.first - interval 40 day > s.last and address not in (select address from old_addr where n % 10 = 0)""",
    "act_inactive": """
        select * from (
          select address, timestamp '2000-08-02' as last, timestamp '2000-08-02' as create_time from old_addr where n % 10 = 0
          union all
          select address, last, timestamp '2001-08-02' from act_live
          where last < timestamp '2001-08-02' - interval 45 day and address not in (select address from old_addr where n % 10 = 0))
        where address not in (select address from act_batch)""",
    # --- taint ---
    "seeds": """
        select address, 'seed' as feature, name, plots, 1.0::double as score from curated
        union select address, 'mixer', null, 'P015', score from mixers""",
    "labels": "select address, plots, max(score) as score from seeds group by all",
    "tin": """
        select hash, address, value, value / 100000000 * price as usd, sum(value) over (partition by hash) as total,
          n_in, origin, idx from in_addr join price on d = cast(ts as date)""",
    "tout": """
        select hash, address, value, value / 100000000 * price as usd, sum(value) over (partition by hash) as total,
          n_out, idx from out_addr join price on d = cast(ts as date)""",
    "spent": "select address, sum(usd) as usd from tin group by address",
    "received": "select address, sum(usd) as usd from tout group by address",
    "lin": "select tin.*, plots, score from tin join labels using (address)",
    "lout": "select tout.*, plots, score from tout join labels using (address)",
    "t1": """
        select distinct a.address, plots, 'common input' as relation, 1 as idx,
          case when n_in <= 3 then 1.0::double else 3 / n_in * base end as sub_weight
        from tin a join (select hash, plots, min(address) as ref, max(score) as base from lin group by all) b using (hash)
        where a.address <> ref""",
    "t2": """
        select distinct a.address, plots, 'common output' as relation, 2 as idx,
          case when n_out <= 3 then 1.0::double else 3 / n_out * base end as sub_weight
        from tout a join (select hash, plots, min(address) as ref, max(score) as base from lout group by all) b using (hash)
        where a.address <> ref""",
    "ds": """
        select a.hash, a.address, b.plots, b.address as ref, b.score as base, a.usd * (b.value / a.total) as usd,
          a.value * (b.value / a.total) as amount, a.origin, a.idx
        from tin a join lout b on a.hash = b.hash and a.address <> b.address where a.total > 0""",
    "dd": """
        select a.hash, a.address, b.plots, b.address as ref, b.base, a.usd, a.value * (b.value / b.total) as amount, a.idx
        from tout a join (
          select hash, address, plots, min(value) as value, min(total) as total, max(score) as base from lin group by all) b
          on a.hash = b.hash and a.address <> b.address""",
    "is_": """
        select c.hash, c.address, r.plots, r.base, c.usd * r.amount / c.total as usd
        from tin c join ds r on r.origin = c.hash
        where c.address <> r.ref and c.total > 0
          and exists (from tout o where o.hash = r.origin and o.idx = r.idx)""",
    "id_": """
        select c.hash, c.address, r.plots, r.base, c.usd * r.amount / n.total as usd
        from dd r join tin n on n.origin = r.hash and n.idx = r.idx join tout c on c.hash = n.hash
        where c.address <> r.ref and c.total > 0""",
    # --- UTXO marts ---
    "edge_tx": """
        select hash, count(*) filter (net < 0) as ni, count(*) filter (net > 0) as no,
          sum(-net) filter (net < 0) as sent, sum(net) filter (net > 0) as gained,
          sum(net * price) filter (net * price > 0) as gained_usd
        from flow group by hash
        having count(*) filter (net < 0) = 1 or count(*) filter (net > 0) = 1
          or (count(*) filter (net < 0) < 100 and count(*) filter (net > 0) < 100)""",
    "edge_part": """
        select s.hash, s.bn, s.ts, s.address as src, r.address as dst, -s.net * r.net / t.sent as v,
          -s.net * r.net / t.sent * (t.gained_usd / t.gained) as usd
        from edge_tx t join flow s on s.hash = t.hash and s.net < 0 join flow r on r.hash = t.hash and r.net > 0""",
    "weights": f"select * from (values {_weights}) t(plots, idx, unit)",
    # --- account chain ---
    "etx": f"""
        select o_orderkey as k, md5(concat('e', o_orderkey)) as hash, {acct("o_custkey % 400")} as src,
          case o_orderkey % 40 when 0 then null when 1 then '{UNISWAP_V2_ROUTERS[0]}' when 2 then '{UNISWAP_V2_ROUTERS[1]}'
            when 3 then '{TORNADO_PROXY}' else {acct("(o_orderkey * 7) % 400")} end as dst,
          case o_orderkey % 3 when 0 then '0xa9059cbb00' when 1 then '0x7ff36ab500' else
            case o_orderkey % 9 when 2 then '0xf39b5b9b00' when 5 then '0x13d98d1300' else '0x414bf38900' end end as input,
          case when o_orderdate < '1996-01-01' then null when o_orderstatus = 'P' then 0 else 1 end as status,
          cast(round(o_totalprice * 10000) as bigint) * case when o_orderkey % 37 = 0 then 10 else 1 end as gas_price,
          21000 + o_orderkey % 1000 as gas, o_orderdate as ts,
          date_diff('day', date '1995-01-01', cast(o_orderdate as date)) as bn
        from orders""",
    "late": "select md5(concat('e', o_orderkey)) as hash, o_orderkey % 2 as late_status from orders where o_orderdate < '1996-01-01'",
    "status": "select hash, coalesce(late_status, status) as status from etx left join late using (hash)",
    "trace": f"""
        select md5(concat('e', l_orderkey)) as hash,
          case when l_orderkey % 20 = 0 and l_linenumber = 1 then null else {acct("l_suppkey % 400")} end as src,
          {acct("l_partkey % 400")} as dst,
          cast(cast(l_quantity as bigint) as decimal(38, 0)) * cast(100000000000000000 as decimal(38, 0)) as value,
          l_orderkey % 20 = 0 and l_linenumber = 1 as reward, l_partkey % 2 = 0 as whole,
          o_orderdate as ts, date_diff('day', date '1995-01-01', cast(o_orderdate as date)) as bn
        from lineitem join orders on o_orderkey = l_orderkey""",
    "xfer": f"""
        select md5(concat('e', l_orderkey)) as hash, {tok("l_partkey % 20")} as token, {acct("l_suppkey % 400")} as src,
          {acct("l_partkey % 400")} as dst,
          case when l_partkey % 97 = 0 then 'bad' else concat(cast(round(l_extendedprice * 100) as bigint), '0000') end as value,
          o_orderdate as ts, date_diff('day', date '1995-01-01', cast(o_orderdate as date)) as bn
        from lineitem join orders on o_orderkey = l_orderkey""",
    "log": f"""
        select md5(concat('e', event_id)) as hash, o_orderdate as ts,
          case when event_id % 10 = 0 then null else
            ['{CURVE_TOPICS[0]}', '{V3_POOL_TOPIC}', '{V2_POOL_TOPIC}', '0x00'][event_id % 4 + 1] end as topic,
          concat('0x', repeat(md5(cast(event_id as varchar)), 6)) as data
        from events join orders on o_orderkey = event_id""",
    "pev": f"""
        select [{_protocols}][event_id % {len(EVENT_PAIRS)} + 1] as protocol, [{_events}][event_id % {len(EVENT_PAIRS)} + 1] as event,
          md5(concat('e', event_id)) as hash, o_orderdate as ts, {acct("user_id % 400")} as owner,
          concat('n', user_id % 50) as name, cast(1700000000 + event_id * 1000 as varchar) as expires
        from events join orders on o_orderkey = event_id""",
    "feed": f"""
        select * from (
          select '{ZERO}' as token, d, 4000.0 as price, 'eth' as symbol from days
          union all
          select {tok("t")}, d, cast((t * 13 + day(d)) % 50 + 1 as double), concat('T', t)
          from days, (select unnest(range(20)) as t) where t <> 18)""",
    "tprice": """
        select token, d, min(price) as price, min(symbol) as symbol from (
          select * from feed where d < date '2000-07-01'
          union all select token, d, price + 1, symbol from feed where d >= date '2000-06-01') group by token, d""",
    "decimals": f"""
        select {tok("n")} as token, case when n % 2 = 0 then 6 else 8 end as digits
        from (select distinct l_partkey % 20 as n from lineitem) where n <> 19""",
    "good": "select token, symbol, digits from (select distinct token, symbol from tprice) join decimals using (token)",
    "direct": """
        select x.hash, src, dst, token, try_cast(value as decimal(38, 9)) as amount, digits, symbol, ts, bn
        from xfer x join good using (token) where hash in (select hash from etx where input like '0xa9059cbb%')""",
    "moved": """
        select hash, src, dst, value, ts, bn, coalesce(price, 0) as price
        from trace left join tprice on token = '""" + ZERO + """' and d = cast(ts as date) where value > 0""",
    "ok_union": "select hash from etx where status = 1 union select hash from late where late_status = 1",
    "succeeded": """
        select hash, src, dst, value / 1e18 as v, value / 1e18 * price as usd, cast(ts as date) as pt
        from moved join status using (hash) where status = 1 and src is not null""",
    "native": f"select hash, src, dst, '{ZERO}' as token, value * 1e-18 as v, 'eth' as symbol, ts, bn from trace where value > 0",
    "tokens": "select hash, src, dst, token, amount::double * pow(10, -digits) as v, symbol, ts, bn from direct",
    "priced_all": """
        select m.*, v * coalesce(price, 0) as usd
        from (from native union all by name from tokens) m join tprice p on p.token = m.token and p.d = cast(m.ts as date)""",
    "priced_ok": f"from priced_all where token <> '{ZERO}' or hash in (from ok_union)",
    "old_acct": f"select distinct {acct('n')} as address, n from (select l_partkey % 400 as n from lineitem) where n % 2 = 0",
    "acct_labels": f"""
        select distinct {acct("n")} as address, case n % 3 when 0 then 'P001' when 1 then 'P002' else 'P015' end as plots
        from (select l_partkey % 400 as n from lineitem) where n % 25 = 0""",
    "gas_block": "select bn, min(ts) as ts, avg(gas_price) as rate from etx group by bn",
    "gas_ma": """
        select bn, ts,
          avg(rate) over (order by bn rows between 3 preceding and 1 preceding) as p3,
          avg(rate) over (order by bn rows between 6 preceding and 1 preceding) as p6,
          avg(rate) over (order by bn rows between 12 preceding and 1 preceding) as p12
        from gas_block""",
    "high_acct": """
        select dst as address, 'address_high_fee_in_tx' as feature, 11 as idx from etx join gas_ma using (bn) where gas_price >= 5 * p6
        union select src, 'address_high_fee_out_tx', 10 from etx join gas_ma using (bn) where gas_price >= 5 * p6""",
    "efast1": """
        select dst, bn - lag(bn, 2) over (partition by dst order by bn) as gap
        from (select distinct dst, bn from etx where dst is not null)""",
    "efast2": "select src, dst, bn - lag(bn, 2) over (partition by src, dst order by bn) as gap from etx where dst is not null",
    "large_acct": """
        select distinct dst as address, token, symbol, concat('addr_', side, '_tx_10k_usd') as feature, base + rank as idx
        from priced_all, (values ('in', 0), ('out', 3)) s(side, base),
          (values (10000, 1), (50000, 2), (100000, 3)) t(tier, rank)
        where usd >= tier and dst is not null""",
    "eact": """
        select address, ts from (
          select hash, src as address, ts, status from etx union all select hash, dst, ts, status from etx)
          left join late using (hash) where status = 1 or late_status = 1""",
    "eact_state": "select address, max(ts) as last from eact where ts < '2001-07-01' group by address",
    "eact_live": """
        select * from eact_state where not (
          cast(last as date) <= date '2001-08-02' - 90 and epoch(timestamp '2001-08-02' - last) > 100 * 86400)""",
    "eact_batch": "select address, min(ts) as first, max(ts) as last from eact where ts >= '2001-07-01' group by address",
    "eact_old": "select address from old_acct where n % 10 = 0",
    "eact_periodic": """
        select address, timestamp '2000-08-02' as create_time from eact_old
        union all
        select address, timestamp '2001-08-02' from eact_batch b join eact_live s using (address)
        where b.first - interval 40 day > s.last and address not in (from eact_old)""",
    "eact_inactive": """
        select * from (
          select address, timestamp '2000-08-02' as last, timestamp '2000-08-02' as create_time from eact_old
          union all
          select address, last, timestamp '2001-08-02' from eact_live
          where last < timestamp '2001-08-02' - interval 45 day and not exists (from eact_old o where o.address = eact_live.address)) q
        where not exists (from eact_batch b where b.address = q.address)""",
    "deployer": "select src as address, min(ts) as tx_timestamp from etx where dst is null group by src",
    "nft": f"""
        select src as address from xfer where token in ({tok("3")}, {tok("7")})
        union select dst from xfer where token in ({tok("3")}, {tok("7")})""",
    "share3": "select src as address, sum(usd) as total from succeeded group by src",
    "share4": "select dst as address, sum(usd) as total from succeeded group by dst",
    "exposure": """
        select src as address, plots, 3 as idx, sum(usd) / (max(total) + 1e6) as sub_weight
        from succeeded t join acct_labels l on t.dst = l.address join share3 s on s.address = t.src group by src, plots
        union all
        select dst, plots, 4, sum(usd) / (max(total) + 1e6)
        from succeeded t join acct_labels l on t.src = l.address join share4 s on s.address = t.dst group by dst, plots""",
}

_SOURCE = re.compile(r"(?:from|join)\s+(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


def _needed(text: str, extra: dict[str, str], seen: list[str]) -> None:
    for name in dict.fromkeys(_SOURCE.findall(text)):
        if name not in seen and name not in extra:
            _needed(CTES[name], extra, seen)
            if name not in seen:
                seen.append(name)


def statement(body: str, extra: dict[str, str] | None = None) -> str:
    """`body` with the expressions it reads. `extra` adds expressions for this statement alone."""
    extra = extra or {}
    seen: list[str] = []
    for text in (*extra.values(), body):
        _needed(text, extra, seen)
    parts = [f"{n} as ({CTES[n]})" for n in seen] + [f"{n} as ({t})" for n, t in extra.items()]
    return (f"with {', '.join(parts)} " if parts else "") + body
