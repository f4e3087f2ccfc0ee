"""One DuckDB statement per query."""

from __future__ import annotations

from oracle.specs import (
    CATEGORIES,
    CURVE_TOPICS,
    ENS_HASH_REGISTERED,
    ENS_REGISTERED,
    ENS_RENEWED,
    PROTOCOLS,
    TORNADO_DEPOSIT,
    TORNADO_PROXY,
    UNISWAP_V1_METHODS,
    UNISWAP_V2_METHODS,
    UNISWAP_V2_ROUTERS,
    UNISWAP_V3_METHODS,
    UNISWAP_V3_ROUTER,
    V2_POOL_TOPIC,
    V3_POOL_TOPIC,
)
from oracle.tables import CTES, ZERO, statement

NO_NAME = "null::varchar as name"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _hex(text: str) -> str:
    return f"cast(cast(concat('0x', right({text}, 3)) as integer) % 4000 as integer)"


def _md5_pt(column: str) -> str:
    return _hex(f"md5({column})")


def _coarse(ts: str) -> str:
    return f"case when {ts} < '2016-01-01' then cast(date_trunc('month', {ts}) as date) else cast({ts} as date) end"


# --- tags in common form, used by views and scores ------------------------------------------------

FAST = """
    select receiver as address, 'addr_fast_incoming_tx' as feature, 1 as idx from fast1 where {test}
    union select receiver, 'addr_fast_incoming_tx_from_same_addr', 2 from fast2 where {test}
    union select sender, 'addr_fast_outgoing_tx_to_same_addr', 3 from fast2 where {test}"""
EFAST = """
    select dst as address, 'addr_fast_incoming_tx' as feature, 1 as idx from efast1 where {test}
    union select dst, 'addr_fast_incoming_tx_from_same_addr', 2 from efast2 where {test}
    union select src, 'addr_fast_outgoing_tx_to_same_addr', 3 from efast2 where {test}"""
ANY_THIRD, WITHIN_FIVE = "gap is not null", "gap <= 5"

UTXO_TAGS = {
    "fast": FAST.format(test=ANY_THIRD),
    "utags": """
        select address, feature, null::varchar as name, 'P112' as plots, idx + 10 as idx from fast
        union select address, feature, null, 'P121', idx + 9 from high_fee
        union select address, feature, null, 'P401', idx from large
        union select address, 'mimo', null, 'P109', 1 from mimo
        union select address, 'inactive', null, 'P117', 4 from act_inactive
        union select address, 'periodic inactive', null, 'P118', 5 from act_periodic""",
}


def _users(name: str) -> str:
    """Address, first time and tag of a protocol's users."""
    if name in PROTOCOLS:
        s = PROTOCOLS[name]
        return f"""select src as address, min(ts) as tx_timestamp, '{s.tag}' as tag from etx
            where hash in (select hash from pev where protocol = '{s.protocol}' and event in {_in(s.events)}) group by src"""
    return {
        "tornado_depositor": f"""select src as address, min(ts) as tx_timestamp, 'Tornado depositor' as tag from etx
            where dst = '{TORNADO_PROXY}' and starts_with(input, '{TORNADO_DEPOSIT}') group by src""",
        "uniswap_trader": f"""select src as address, min(ts) as tx_timestamp, 'uniswap_trader' as tag from etx
            where left(input, 10) in {_in(UNISWAP_V1_METHODS)}
              or dst in {_in(UNISWAP_V2_ROUTERS)} and left(input, 10) in {_in(UNISWAP_V2_METHODS)}
              or dst = '{UNISWAP_V3_ROUTER}' and left(input, 10) in {_in(UNISWAP_V3_METHODS)} group by src""",
        "curve_trader": f"select distinct src as address from etx where hash in (select hash from log where topic in {_in(CURVE_TOPICS)})",
        "ens_registrant": f"""select owner as address, min(ts) as tx_timestamp, 'ens_registor' as tag from pev
            where protocol = 'ens' and event in {_in(ENS_REGISTERED)} group by owner
            union all select owner, min(ts), 'ens_registor' from pev
            where protocol = 'ens' and event = '{ENS_HASH_REGISTERED}' group by owner""",
        "ens_owner": f"""select owner as address, ts as tx_timestamp, 'ens_owner' as tag, name,
              make_timestamp(cast(coalesce(later, expires) as bigint) * 1000000) as expire_timestamp
            from pev left join (select name, max(expires) as later from pev
              where protocol = 'ens' and event in {_in(ENS_RENEWED)} group by name) using (name)
            where protocol = 'ens' and event in {_in(ENS_REGISTERED)}""",
    }[name]


PROTOCOL_NAMES = [*[n for n in PROTOCOLS if n != "eth2_depositor"], "tornado_depositor", "uniswap_trader", "curve_trader", "ens_registrant", "ens_owner"]


def _category(name: str) -> str:
    spec = CATEGORIES[name]
    users = " union ".join(f"select address from ({_users(s)})" for s in spec.sources)
    return f"select address, '{spec.feature}' as feature, {NO_NAME}, 'P701' as plots, {spec.idx} as idx from ({users})"


OTHERS = f"""
    select address, 'Contract deployer' as feature, {NO_NAME}, 'P801' as plots, 0 as idx from deployer
    union select address, 'ETH2.0 staker', null, 'P801', 1 from ({_users("eth2_depositor")})
    union select address, 'NFT user', null, 'P801', 2 from nft"""

ACCOUNT_TAGS = {
    "efast": EFAST.format(test=ANY_THIRD),
    "others": OTHERS,
    "etags": f"""
        select address, feature, {NO_NAME}, 'P112' as plots, idx + 10 as idx from efast
        union select address, feature, null, 'P121', 21 - idx from high_acct
        union select address, feature, null, 'P401', idx from large_acct
        union select address, 'inactive', null, 'P117', 4 from eact_inactive
        union select address, 'periodic inactive', null, 'P118', 5 from eact_periodic
        union from others
        union """
    + " union ".join(f"from ({_category(c)})" for c in CATEGORIES),
}

# --- taint ------------------------------------------------------------------------------------------


def _score_of(pairs: str, totals: str, relation: str, idx: int) -> str:
    return f"""
        select address, plots, '{relation}' as relation, {idx} as idx,
          round(a.usd / t.usd * base * least(a.usd / 10000, 1), 6) as sub_weight
        from (select address, plots, sum(usd) as usd, max(base) as base
              from (select hash, address, plots, min(usd) as usd, max(base) as base from {pairs} group by hash, address, plots)
              group by address, plots) a join {totals} t using (address) where a.usd > 0"""


RELATIONS = {
    "taint_direct_source": _score_of("ds", "spent", "direct source", 3),
    "taint_direct_dest": _score_of("dd", "received", "direct dest", 4),
    "taint_indirect_source": _score_of("is_", "spent", "indirect source", 5),
    "taint_indirect_dest": _score_of("id_", "received", "indirect dest", 6),
}
COMMON = "select distinct address, plots, relation, idx, round(sub_weight, 6) as sub_weight from {0}"
TAINT = " union all ".join(
    [
        "select address, plots, 'direct' as relation, 0 as idx, 1.0::double as sub_weight from (select distinct address, plots from curated)",
        "select address, plots, relation, idx, round(sub_weight, 6) as sub_weight from t1",
        "select address, plots, relation, idx, round(sub_weight, 6) as sub_weight from t2",
        *[f"from ({r})" for r in RELATIONS.values()],
    ]
)


def _score(all_tags: str, extra: dict[str, str]) -> str:
    return statement(
        f"""select address, round(total, 4) as total_score,
          round(1 / (1 + pow(2.718281828459045, -(total - 60) / 30)), 6) as risk_score,
          plot_weight, plots_list, {_md5_pt("address")} as pt
        from (select address, sum(points) as total,
                string_agg(concat(plots, ':', cast(round(points * 1000) as bigint)), ',' order by plots) as plot_weight
              from (select address, plots, sum(w * unit) as points from labelled join weights using (plots, idx) group by address, plots)
              group by address)
          join (select address, string_agg(concat(plots, '_', idx), ',' order by concat(plots, '_', idx)) as plots_list
                from labelled group by address) using (address)""",
        {**extra, "labelled": all_tags},
    )


# --- marts --------------------------------------------------------------------------------------------


def _ends(side: str, where: str, value: str, usd: str, hash_: str, digits: int) -> str:
    out = []
    for which, fn in (("first", "arg_min_null"), ("last", "arg_max_null")):
        pick = lambda e: f"{fn}({e}, {{'a': ts, 'b': bn, 'c': {hash_}, 'd': coalesce({value}, -1)}}) filter ({where})"  # noqa: B023,E731
        p = f"{which}_{side}_tx"
        out += [
            f"{pick(hash_)} as {p}_hash",
            f"{pick('ts')} as {p}_block_timestamp",
            f"{pick('bn')} as {p}_block_num",
            f"round({pick(value)}, 6) as {p}_value",
            f"round({pick(usd)}, {digits}) as {p}_usd_value",
        ]
    return ", ".join(out)


STAT_UTXO = f"""
    select {_md5_pt("address")} as addr_pt, address, cast(ts as date) as block_date,
      count(*) filter (net > 0) as in_tx_cnt, round(coalesce(sum(net) filter (net > 0), 0), 6) as in_tx_value,
      round(coalesce(min(net) filter (net > 0), 0), 6) as smallest_inflow, round(coalesce(max(net) filter (net > 0), 0), 6) as largest_inflow,
      count(*) filter (net < 0) as out_tx_cnt, round(coalesce(sum(-net) filter (net < 0), 0), 6) as out_tx_value,
      round(coalesce(min(-net) filter (net < 0), 0), 6) as smallest_outflow, round(coalesce(max(-net) filter (net < 0), 0), 6) as largest_outflow,
      count(*) as tx_cnt, round(sum(abs(net)), 6) as turnover, round(sum(abs(net) * price), 2) as turnover_usd,
      round(coalesce(sum(net * price) filter (net > 0), 0), 2) as in_tx_value_usd,
      round(coalesce(min(net * price) filter (net > 0), 0), 2) as smallest_inflow_usd,
      round(coalesce(max(net * price) filter (net > 0), 0), 2) as largest_inflow_usd,
      round(coalesce(sum(-net * price) filter (net < 0), 0), 2) as out_tx_value_usd,
      round(coalesce(min(-net * price) filter (net < 0), 0), 2) as smallest_outflow_usd,
      round(coalesce(max(-net * price) filter (net < 0), 0), 2) as largest_outflow_usd,
      {_ends("in", "net > 0", "net", "net * price", "hash", 2)}, {_ends("out", "net < 0", "net", "net * price", "hash", 2)},
      'BTC' as symbol
    from flow where net <> 0 group by address, cast(ts as date)"""


def _side(side: str, flow: str, where: str) -> str:
    agg = lambda f, v, d: f"round(coalesce({f}({v}) filter ({where}), 0), {d})"
    return f"""count(*) filter ({where}) as {side}_tx_cnt, {agg("sum", "v", 6)} as {side}_tx_value, {agg("sum", "usd", 4)} as {side}_tx_value_usd,
      {agg("min", "v", 6)} as smallest_{flow}, {agg("min", "usd", 4)} as smallest_{flow}_usd,
      {agg("max", "v", 6)} as largest_{flow}, {agg("max", "usd", 4)} as largest_{flow}_usd"""


STAT_TOKEN = statement(
    f"""
    select case when regexp_matches(right(address, 3), '^[0-9a-fA-F]+$') then {_hex("address")} end as addr_pt,
      s.* exclude (block_date, address), address, block_date, coalesce(tx_cnt, 0) as tx_cnt
    from stat s full join (
      select address, cast(ts as date) as block_date, count(*) as tx_cnt from (
        select src as address, ts from etx union all select dst, ts from etx) where address is not null
      group by address, cast(ts as date)) c using (address, block_date)""",
    {
        "ends": "select *, dst as address, true as is_in from priced_ok union all select *, src, false from priced_ok",
        "stat": f"""
          select address, cast(ts as date) as block_date, token as token_address, min(symbol) as symbol,
            {_side("in", "inflow", "is_in")}, {_side("out", "outflow", "not is_in")},
            round(coalesce(sum(v) filter (is_in), 0) + count(*) filter (not is_in), 6) as turnover,
            round(coalesce(sum(usd) filter (is_in), 0) + coalesce(sum(usd) filter (not is_in), 0), 4) as turnover_usd,
            {_ends("in", "is_in", "v", "usd", "hash", 4)}, {_ends("out", "not is_in", "v", "usd", "hash", 4)}
          from ends where address is not null group by address, cast(ts as date), token""",
    },
)


def _edge_columns(digits: int, where: str = "true") -> str:
    f = f"filter ({where})"
    return f"""round(sum(v) {f}, 6) as to_amount, round(sum(usd) {f}, {digits}) as to_amount_usd,
      round(min(v) {f}, 6) as min_value, round(max(v) {f}, 6) as max_value,
      round(min(usd) {f}, {digits}) as min_usd_value, round(max(usd) {f}, {digits}) as max_usd_value,
      count(*) {f} as transaction_cnt, min(bn) {f} as first_block_number, min(ts) {f} as first_block_timestamp,
      max(bn) {f} as last_block_number, max(ts) {f} as last_block_timestamp"""


_ORDER = "{'a': ts, 'b': bn, 'c': hash}"


def _utxo_edges(pt: str) -> str:
    return statement(
        f"""select src as from_address, dst as to_address, {_edge_columns(2)},
          arg_min(hash, {_ORDER}) as first_transaction_hash, arg_max(hash, {_ORDER}) as last_transaction_hash,
          {_md5_pt(pt)} as pt from edge_part group by src, dst"""
    )


#: Transactions with the lines of a seventh of all blocks, so that hundreds of senders meet hundreds of receivers.
_WIDE = {
    "wflow": """select concat('w', bn % 7) as hash, address, sum(net) as net, sum(net * price) as usd, min(bn) as bn, min(ts) as ts
        from flow group by 1, 2""",
    "wtx": """select hash, min(bn) as bn, min(ts) as ts, sum(-net) filter (net < 0) as sent, sum(net) filter (net > 0) as gained,
        coalesce(sum(usd) filter (usd > 0), 0) as gained_usd from wflow group by hash""",
    "wpart": """select t.hash, t.bn, t.ts, s.address as src, r.address as dst, -s.net * r.net / t.sent as v,
        -s.net * r.net / t.sent * (t.gained_usd / t.gained) as usd
        from wtx t join wflow s on s.hash = t.hash and s.net < 0 join wflow r on r.hash = t.hash and r.net > 0""",
}


def _wide_edges() -> str:
    return statement(
        f"""select src as from_address, dst as to_address, {_edge_columns(2)},
          arg_min(hash, {_ORDER}) as first_transaction_hash, arg_max(hash, {_ORDER}) as last_transaction_hash,
          {_md5_pt("src")} as pt from wpart group by src, dst""",
        _WIDE,
    )


def _token_edges(pt: str) -> str:
    return statement(
        f"""select src as from_address, dst as to_address, '{ZERO}' as token_address, 'eth' as symbol,
          {_edge_columns(4, "status = 1")},
          case when arg_min(coalesce(status, 0), {_ORDER}) = 1 then arg_min(hash, {_ORDER}) end as first_transaction_hash,
          case when arg_max(coalesce(status, 0), {_ORDER}) = 1 then arg_max(hash, {_ORDER}) end as last_transaction_hash,
          {_hex(pt)} as pt
        from (select m.*, m.value / 1e18 as v, m.value / 1e18 * price as usd, status from moved m left join status using (hash))
        where src is not null group by src, dst having count(*) filter (status = 1) > 0
        union all by name
        select src as from_address, dst as to_address, token as token_address, min(symbol) as symbol,
          {_edge_columns(4)},
          arg_min(hash, {_ORDER}) as first_transaction_hash, arg_max(hash, {_ORDER}) as last_transaction_hash, {_hex(pt)} as pt
        from (select x.*, amount::double / pow(10, digits) as v, amount::double / pow(10, digits) * coalesce(price, 0) as usd
              from direct x left join (select token, d, price from tprice) p on p.token = x.token and p.d = cast(x.ts as date))
        group by src, dst, token"""
    )


_ORDERS = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice::double as price from orders"


def _utxo_new_only(source: str, plots: str) -> str:
    return f"select address, feature, '{plots}' as plots, idx from {source} where address not in (select address from old_addr)"


DAY_COLUMNS = {
    "utxo_value_flow": ["partition_date"],
    "block_fee_ma": ["block_timestamp_month"],
    "inactivity_last_activity": ["pt"],
    "inactivity_bootstrap": ["pt"],
    "account_inactivity_last_activity": ["pt"],
    "account_inactivity_bootstrap": ["pt"],
    "stat_daily_utxo": ["block_date"],
    "stat_daily_token": ["block_date"],
    "stat_daily_token_value": ["block_date"],
    "gas_ma": ["block_date"],
    "succeed_transfers": ["pt"],
    "token_price_daily": ["price_day"],
    "day_slice": ["block_timestamp_month"],
}
_BLOCKS = [f"{w}_{s}_tx_block_num" for w in ("first", "last") for s in ("in", "out")]
NUMBER_COLUMNS = {
    "stat_daily_utxo": [*_BLOCKS, "tx_cnt", "in_tx_cnt", "out_tx_cnt"],
    "stat_daily_token": [*_BLOCKS, "tx_cnt", "in_tx_cnt", "out_tx_cnt"],
    "transfers_utxo": ["transaction_cnt"],
    "transfers_utxo_2": ["transaction_cnt"],
    "sink_second_order": ["transaction_cnt"],
    "transfers_utxo_guard": ["transaction_cnt"],
    "transfers_utxo_wide": ["transaction_cnt"],
    "transfers_utxo_left_out": ["in_cnts", "out_cnts"],
    "transfers_token_ranked": ["transaction_cnt"],
    "stat_daily_token_value": [*_BLOCKS, "tx_cnt", "in_tx_cnt", "out_tx_cnt"],
    "transfers_token": ["transaction_cnt"],
    "transfers_token_2": ["transaction_cnt"],
}


def _portable(name: str, sql: str) -> str:
    """Days as text and numbers that may be NULL as double, as the queries give them."""
    casts = [f"cast({c} as varchar) as {c}" for c in DAY_COLUMNS.get(name, [])]
    casts += [f"cast({c} as double) as {c}" for c in NUMBER_COLUMNS.get(name, [])]
    return f"select * replace ({', '.join(casts)}) from ({sql})" if casts else sql


def oracle_sql() -> dict[str, str]:
    old_acct = "not exists (from old_acct o where o.address = q.address)"
    bodies: dict[str, str] = {
        "price_daily": statement("select cast(d as timestamp) as price_timestamp, price from ("
                                 f"select d, max(price) as price from price group by d)"),
        "utxo_value_flow": statement(f"""
            select hash, bn as block_number, address, ts as block_timestamp, round(in_v, 6) as in_value, round(out_v, 6) as out_value,
              round(net, 6) as net_value, round(in_v * price, 2) as in_usd_value, round(out_v * price, 2) as out_usd_value,
              round(net * price, 2) as net_usd_value, {_coarse("ts")} as partition_date from flow"""),
        "block_fee_ma": statement("""
            select bn as block_number, ts as block_timestamp, mon as block_timestamp_month, round(fee_per_byte, 4) as fee_per_byte from block_ma"""),
        "coinjoin_tx": statement("select distinct hash as txhash from ev"),
        "coinjoin_score": statement(f"""
            select address, 'mixer' as feature, {NO_NAME}, 'P015' as plots, round(score, 6) as score from mixers
            union all select address, 'mixer', null, 'P015', 0.5 from old_addr"""),
        "mimo": statement(f"""
            select address, 'mimo' as feature, {NO_NAME}, 'P109' as plots from mimo
            union select concat('s', n), 'mimo', null, 'P109' from old_addr"""),
        "fast_tx_utxo": statement(f"select address, feature, {NO_NAME}, 'P111' as plots, idx from ({FAST.format(test=ANY_THIRD)})"),
        "fast_tx_utxo_elapsed": statement(f"select address, feature, {NO_NAME}, 'P111' as plots, idx from ({FAST.format(test=WITHIN_FIVE)})"),
        "high_fee_utxo": statement(_utxo_new_only("high_fee", "P113")),
        "large_value_utxo": statement(_utxo_new_only("large", "401")),
        "large_value_utxo_by_tier": statement("""
            select address, feature, '401' as plots, idx from large where idx <> 1 or address not in (select address from old_addr)"""),
        "coinbase_miners": statement("select distinct bn as block_number, unnest(addresses) as address from out_line where cb"),
        "frequent_io": statement("""
            select address, min(gap) as min_gap from (
              select i.address, i.bn - o.bn as gap from in_addr i join out_addr o
                on o.hash = i.origin and o.idx = i.idx and o.address = i.address where i.bn - o.bn <= 12
              union all select address, n % 15 from old_addr) group by address"""),
        "inactivity_last_activity": statement(f"""
            select address, last as latest_activate_timestamp, {_coarse("last")} as pt from act_live where address not in (select address from act_batch)
            union all select address, last, {_coarse("last")} from act_batch"""),
        "inactivity_periodic": statement("select * from act_periodic"),
        "inactivity_inactive": statement("select address, last as latest_activate_timestamp, create_time from act_inactive"),
        "inactivity_bootstrap": statement(f"""
            select address, max(ts) as latest_activate_timestamp, {_coarse("max(ts)")} as pt,
              coalesce(bool_or(ts - interval 40 day > before), false) as is_periodic,
              max(ts) < timestamp '2001-08-02' - interval 45 day as is_inactive
            from (select address, ts, lag(ts) over (partition by address order by ts) as before from (select distinct address, ts from act))
            group by address"""),
        "account_inactivity_last_activity": statement("""
            select address, last as latest_activate_timestamp, cast(last as date) as pt from eact_live s
            where not exists (from eact_batch b where b.address = s.address)
            union all select address, last, cast(last as date) from eact_batch"""),
        "account_inactivity_periodic": statement("select * from eact_periodic"),
        "account_inactivity_inactive": statement("select address, last as latest_activate_timestamp, create_time from eact_inactive"),
        "account_inactivity_bootstrap": statement("""
            select address, max(ts) as latest_activate_timestamp, cast(max(ts) as date) as pt,
              coalesce(bool_or(ts - interval 40 day > before), false) as is_periodic,
              max(ts) < timestamp '2001-08-02' - interval 45 day as is_inactive
            from (select address, ts, lag(ts) over (partition by address order by ts) as before from eact where address is not null)
            group by address"""),
        "tags_seed_view": statement("select address, feature, name, plots, round(score, 6) as score from seeds"),
        "taint_common_input": statement(COMMON.format("t1")),
        "taint_common_output": statement(COMMON.format("t2")),
        **{name: statement(body) for name, body in RELATIONS.items()},
        "taint_all": statement(TAINT),
        "tags_union_utxo": statement("select * from utags", UTXO_TAGS),
        "stat_daily_utxo": statement(STAT_UTXO),
        "transfers_utxo": _utxo_edges("src"),
        "transfers_utxo_2": _utxo_edges("dst"),
        "sink_second_order": _utxo_edges("dst"),
        "transfers_utxo_guard": _utxo_edges("src").replace("< 100 and count(*) filter (net > 0) < 100", "< 3 and count(*) filter (net > 0) < 3"),
        "transfers_utxo_wide": _wide_edges(),
        "transfers_utxo_left_out": statement("""
            select hash, count(*) filter (net < 0) as in_cnts, count(*) filter (net > 0) as out_cnts,
              round(coalesce(sum(-net) filter (net < 0), 0), 6) as in_total, round(coalesce(sum(net) filter (net > 0), 0), 6) as out_total,
              round(coalesce(sum(net * price) filter (net * price > 0), 0), 2) as out_usd_total
            from flow group by hash
            having count(*) filter (net < 0) <> 1 and count(*) filter (net > 0) <> 1
              and (count(*) filter (net < 0) >= 3 or count(*) filter (net > 0) >= 3)"""),
        "score_utxo": _score(
            """select address, plots, idx, max(sub_weight) as w from taint group by address, plots, idx
               union all select distinct address, plots, idx, 1.0::double from utags""",
            {**UTXO_TAGS, "taint": TAINT.replace("round(sub_weight, 6)", "sub_weight").replace("least(a.usd / 10000, 1), 6)", "least(a.usd / 10000, 1), 15)")},
        ),
        # --- account chain ---
        "tx_cnt_fee": statement("""
            select address, coalesce(a.cnt, 0) + coalesce(b.cnt, 0) as total_tx_cnt, round(a.fee + b.fee, 10) as total_fee
            from (select address, n as cnt, n * 0.001::double as fee from old_acct) a full join (
              select address, count(*) as cnt, coalesce(sum(fee), 0) as fee from (
                select src as address, 1e-18 * gas_price * gas as fee from etx union all select dst, null from etx)
              where address is not null group by address) b using (address)"""),
        "tx_cnt_fee_zero": statement("""
            select address, coalesce(a.cnt, 0) + coalesce(b.cnt, 0) as total_tx_cnt, round(coalesce(a.fee, 0) + coalesce(b.fee, 0), 10) as total_fee
            from (select address, n as cnt, n * 0.001::double as fee from old_acct) a full join (
              select address, count(*) as cnt, coalesce(sum(fee), 0) as fee from (
                select src as address, 1e-18 * gas_price * gas as fee from etx union all select dst, null from etx)
              where address is not null group by address) b using (address)"""),
        "gas_ma": statement("""
            select bn as block_number, ts as block_timestamp, cast(ts as date) as block_date, round(p3, 2) as gas_price_prev3_blk,
              round(p6, 2) as gas_price_prev6_blk, round(p12, 2) as gas_price_prev12_blk from gas_ma"""),
        "succeed_transfers": statement("""
            select hash, src as from_address, dst as to_address, round(v, 6) as value, round(usd, 2) as usd_value, pt from succeeded"""),
        "token_price_daily": statement("select token as address, d as price_day, price, symbol from tprice"),
        "successful_tx": statement("select hash from ok_union"),
        "stat_daily_token": STAT_TOKEN,
        "stat_daily_token_value": STAT_TOKEN.replace("count(*) filter (not is_in), 6) as turnover", "coalesce(sum(v) filter (not is_in), 0), 6) as turnover"),
        "transfers_token": _token_edges("src"),
        "transfers_token_2": _token_edges("dst"),
        "transfers_token_ranked": _token_edges("src")
        .replace(f"case when arg_min(coalesce(status, 0), {_ORDER}) = 1 then arg_min(hash, {_ORDER}) end", f"arg_min(hash, {_ORDER}) filter (status = 1)")
        .replace(f"case when arg_max(coalesce(status, 0), {_ORDER}) = 1 then arg_max(hash, {_ORDER}) end", f"arg_max(hash, {_ORDER}) filter (status = 1)"),
        "score_account": _score(
            """select address, plots, 0 as idx, 1.0::double as w from acct_labels
               union all select address, plots, idx, sub_weight from exposure
               union all select address, plots, idx, 1.0::double from etags where address is not null""",
            ACCOUNT_TAGS,
        ),
        "tags_union_account": statement("select * from etags", ACCOUNT_TAGS),
        "fast_tx_account": statement(f"select address, feature, 'P111' as plots, idx from ({EFAST.format(test=ANY_THIRD)})"),
        "fast_tx_account_elapsed": statement(f"select address, feature, 'P111' as plots, idx from ({EFAST.format(test=WITHIN_FIVE)})"),
        "high_fee_account": statement(f"select address, feature, {NO_NAME}, 'P121' as plots, idx from high_acct q where {old_acct}"),
        "large_value_account": statement(f"""
            select address, token as token_address, symbol, feature, 'P401' as plots, idx from large_acct q where {old_acct}"""),
        "large_value_account_from": statement(
            f"select address, token as token_address, symbol, feature, 'P401' as plots, idx from large_acct q where {old_acct}",
            {"large_acct": CTES["large_acct"].replace("dst as address", "case side when 'in' then dst else src end as address").replace("dst is not null", "case side when 'in' then dst else src end is not null")},
        ),
        "contract_deployers": statement(f"select address, tx_timestamp, 'Contract deployer' as tag from deployer q where {old_acct}"),
        "propagated_account": statement("select address, plots, idx, round(sub_weight, 6) as sub_weight from exposure"),
        "nft_users": statement(f"""
            select address, 'NFT user' as feature, {NO_NAME}, 'P801' as plots, 2 as idx from nft
            union select concat('0xs', n), 'NFT user', null, 'P801', 2 from old_acct"""),
        "miners": statement("""
            select dst as to_address, case when whole then 'miner' else 'uncle miner' end as tags from trace where reward
            union select concat('0x', md5(concat('a', s_suppkey % 400))), 'pool' from supplier"""),
        "pools": statement(
            "select * from pool q where not exists (from pool o where o.address = q.address and o.tx_timestamp < '1998-01-01')",
            {
                "pool": f"""select concat('0x', substr(data, case when topic = '{V3_POOL_TOPIC}' then 91 else 27 end, 40)) as address, ts as tx_timestamp,
                  case when topic = '{V3_POOL_TOPIC}' then 'uniswap_v3_pool' else 'uniswap_v2(1)_pool' end as tag
                  from log where topic in ('{V3_POOL_TOPIC}', '{V2_POOL_TOPIC}')"""
            },
        ),
        **{f"protocol_{n}": statement(f"select * from ({_users(n)}) q where {old_acct}") for n in PROTOCOL_NAMES},
        "protocol_all_specs": statement(
            " union all ".join(f"select '{n}' as \"table\", * from ({_users(n)})" for n in PROTOCOLS)
        ),
        "eth2_depositors": statement(f"select * from ({_users('eth2_depositor')}) q where {old_acct}"),
        **{f"category_{n}": statement(_category(n)) for n in CATEGORIES},
        "category_others": statement(OTHERS),
        # --- sinks ---
        "sink_append": _ORDERS,
        "sink_snapshot": _ORDERS,
        "sink_partition_reload": f"select * from ({_ORDERS}) where o_orderstatus = 'P' or o_orderstatus = 'O' and price > 100000",
        "sink_bucketed": f"select *, o_custkey % 16 as pt from ({_ORDERS})",
        "sink_full_reload": f"select * from ({_ORDERS}) where o_orderstatus = 'F'",
        "sink_new_only_runs": "select o_custkey, min(year(o_orderdate)) as year from orders group by o_custkey having min(year(o_orderdate)) between 1992 and 1995",
        "mart_turnover": statement("""
            select address, round(sent, 6) as sent, out_cnt::double as out_cnt, round(received, 6) as received, in_cnt::double as in_cnt
            from (select src as address, sum(v) as sent, count(*) as out_cnt from edge_part group by src)
            full join (select dst as address, sum(v) as received, count(*) as in_cnt from edge_part group by dst) using (address)"""),
        # --- primitives ---
        "hex_bucket": statement(f"""
            select address, {_hex("address")} as hex_pt, {_md5_pt("address")} as md5_pt from (select distinct src as address from etx)"""),
        "safe_cast_numeric": statement("""
            select value, max(cast(try_cast(value as decimal(38, 9)) as double)) as amount, count(*) as cnt from xfer group by value"""),
        "safe_offset": statement("select topic, count(*) as cnt from log group by topic"),
        "new_only": statement("select distinct src as address from etx where src not in (select address from old_acct)"),
        "accumulate": statement("select src as address from etx union select address from old_acct"),
        "day_slice": statement("""
            select hash, bn as block_number, ts as block_timestamp, mon as block_timestamp_month from tx
            where cast(ts as date) between date '1998-02-27' and date '1998-02-28'"""),
    }
    return {name: _portable(name, body) for name, body in bodies.items()}
