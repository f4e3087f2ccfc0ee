"""Users of on-chain protocols.

Most protocols follow one pattern: transactions that emitted one of some contract events, the first
time per sender, a constant tag, new addresses only. Those are specs. The others have a function.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txloom.functions.columns import day_slice, packed, unpacked
from txloom.functions.relations import new_only, union_all


@dataclass(frozen=True)
class ProtocolSpec:
    protocol: str
    events: tuple[str, ...]
    tag: str


# Contract events per compound market. The REP market reads the BAT events.
COMPOUND_MARKETS = (
    "cBAT", "cCOMP", "cDAI", "cETH", "cLINK", "cBAT", "cSAI", "cTUSD", "cUNI", "cUSDT", "cWBTC2", "cWBTC", "cZRX",
)


def _markets(event: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(f"{market}_event_{event}" for market in COMPOUND_MARKETS))


# The event names and tags of each protocol
PROTOCOLS: dict[str, ProtocolSpec] = {
    "aave_borrower": ProtocolSpec(
        "aave", ("LendingPool_event_Borrow", "LendingPool_v2_event_Borrow"), "AAVE borrower"
    ),
    "aave_depositor": ProtocolSpec(
        "aave", ("LendingPool_event_Deposit", "LendingPool_v2_event_Deposit"), "AAVE depositor"
    ),
    "aave_staker": ProtocolSpec("aave", ("StakedAave_event_Staked", "StakedTokenV2_event_Staked"), "AAVE staker"),
    "aave_flashloan_user": ProtocolSpec(
        "aave", ("LendingPool_event_FlashLoan", "LendingPool_v2_event_FlashLoan"), "AAVE flashloan user"
    ),
    "balancer_trader": ProtocolSpec("balancer", ("BPool_event_LOG_SWAP", "V2_Vault_event_Swap"), "Balancer trader"),
    "balancer_investor": ProtocolSpec(
        "balancer", ("BPool_event_LOG_JOIN", "V2_Vault_event_PoolBalanceChanged"), "Balancer investor"
    ),
    "balancer_flashloan_user": ProtocolSpec("balancer", ("V2_Vault_event_FlashLoan",), "Balancer flashloan user"),
    "compound_supplier": ProtocolSpec("compound", _markets("Mint"), "Compound supplier"),
    "compound_borrower": ProtocolSpec("compound", _markets("Borrow"), "Compound borrower"),
    "dydx_user": ProtocolSpec("dydx", ("SoloMargin_event_LogDeposit", "PerpetualV1_event_LogDeposit"), "Dydx user"),
    "opyn_user": ProtocolSpec(
        "opyn", ("oToken_event_VaultOpened", "oToken_event_Transfer", "oToken_event_Exercise"), "Opyn user"
    ),
    "yearn_user": ProtocolSpec(
        "yearn",
        (
            "YearnGovernance_call_voteAgainst",
            "YearnGovernance_call_voteFor",
            "YearnGovernance_event_OwnershipTransferred",
            "YearnGovernance_event_RewardAdded",
            "YearnGovernance_event_RewardPaid",
            "YearnGovernance_event_Staked",
            "YearnGovernance_event_Withdrawn",
        ),
        "Yearn user",
    ),
    "tornado_user": ProtocolSpec("tornado", ("TornadoCash_event_Deposit",), "Tornado user"),
    "eth2_depositor": ProtocolSpec("eth2", ("DepositContract_event_DepositEvent",), "ETH2.0 depositor"),
}

# Events of the name service
ENS_REGISTERED = (
    "ETHRegistrarController_event_NameRegistered",
    "ETHRegistrarController2_event_NameRegistered",
    "ETHRegistrarController3_event_NameRegistered",
)
ENS_RENEWED = (
    "ETHRegistrarController_event_NameRenewed",
    "ETHRegistrarController2_event_NameRenewed",
    "ETHRegistrarController3_event_NameRenewed",
)
ENS_HASH_REGISTERED = "Registrar0_event_HashRegistered"

# Proxy contract and method of the mixer's deposits
TORNADO_PROXY = "0x722122df12d4e14e13ac3b6895a86e84145b6967"
TORNADO_DEPOSIT = "0x13d98d13"

# Method selectors of the exchange, per version; an address in mixed case never matches
UNISWAP_V1_METHODS = (
    "0xf39b5b9b", "0x6b1d4db7", "0xad65d76d", "0x0b573638", "0xddf7e1a7", "0xb040d545",
    "0xf552d91b", "0xf3c0efe9", "0x013efd8b", "0x95e3c50b", "0x7237e031", "0xd4e4841d",
)
UNISWAP_V2_ROUTERS = ("0x7a250d5630b4cf539739df2c5dacb4c659f2488d", "0xf164fC0Ec4E93095b804a4795bBe1e041497b92a")
UNISWAP_V2_METHODS = (
    "0x7ff36ab5", "0xfb3bdb41", "0xb6f9de95", "0x8803dbee", "0x38ed1739",
    "0x5c11d795", "0x18cbafe5", "0x4a25d94a", "0x791ac947",
)
UNISWAP_V3_ROUTER = "0x7a250d5630b4cf539739df2c5dacb4c659f2488d"
UNISWAP_V3_METHODS = ("0xc04b8d59", "0x414bf389", "0xdb3e2198", "0xf28c0498", "0xac9650d8")

# Topics of the exchange events
CURVE_TOPICS = (
    "0x8b3e96f2b889fa771c53c981b40daf005f63f637f1869f707052d15a3dd97140",
    "0x0bcc4c97732e47d9946f229edb95f5b6323f601300e4690de719993f3c371129",
)


def _senders(tx: DataFrame, address: str, *more: str) -> DataFrame:
    """Hash and sender of transactions as bytes, for the way to their events."""
    return tx.select(packed("hash").alias("hash"), packed("from_address").alias(address), *more)


def _first_seen(rows: DataFrame, tag: str) -> DataFrame:
    return (
        rows.groupBy(F.col("from_address").alias("address"))
        .agg(F.min("block_timestamp").alias("tx_timestamp"))
        .withColumn("tag", F.lit(tag))
    )


def protocol_users(
    tx: DataFrame,
    events: DataFrame,
    spec: ProtocolSpec,
    run_date: date | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Senders of transactions that emitted an event of the spec, with the first time.

    events: protocol, event, transaction_hash, block_timestamp. Hashes and senders meet as bytes.
    """
    emitted = (
        day_slice(events, run_date)
        .where((F.col("protocol") == spec.protocol) & F.col("event").isin(*spec.events))
        .select(packed("transaction_hash").alias("hash"))
        .distinct()
    )
    sent = _senders(day_slice(tx, run_date), "from_address", "block_timestamp").join(emitted, "hash")
    first = _first_seen(sent, spec.tag)
    return new_only(first.withColumn("address", unpacked("address")), stored)


def protocol_user_tables(
    tx: DataFrame,
    events: DataFrame,
    specs: Mapping[str, ProtocolSpec],
    run_date: date | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """`protocol_users` for many specs in one pass, with the spec's name in the column `table`.

    One scan and one shuffle of the transactions serve all specs.
    """
    names: dict[str, list[str]] = {}
    for name, spec in specs.items():
        for event in spec.events:
            names.setdefault(f"{spec.protocol}.{event}", []).append(name)
    tables = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    tags = F.create_map(*[F.lit(v) for name, spec in specs.items() for v in (name, spec.tag)])
    event = F.concat_ws(".", "protocol", "event")
    emitted = (
        day_slice(events, run_date)
        .where(event.isin(*names))
        .select(packed("transaction_hash").alias("hash"), F.explode(F.try_element_at(tables, event)).alias("table"))
    )
    found = (
        _senders(day_slice(tx, run_date), "address", "block_timestamp")
        .join(emitted, "hash")
        .groupBy("table", "address")
        .agg(F.min("block_timestamp").alias("tx_timestamp"))
        .select("table", unpacked("address").alias("address"), "tx_timestamp", F.try_element_at(tags, F.col("table")).alias("tag"))
    )
    return new_only(found, stored, on=("table", "address"))


def tornado_depositors(tx: DataFrame, run_date: date | None = None, stored: DataFrame | None = None) -> DataFrame:
    """Senders of deposit calls to the mixer's proxy."""
    calls = day_slice(tx, run_date).where(
        (F.col("to_address") == TORNADO_PROXY) & F.col("input").startswith(TORNADO_DEPOSIT)
    )
    return new_only(_first_seen(calls, "Tornado depositor"), stored)


def uniswap_traders(tx: DataFrame, run_date: date | None = None, stored: DataFrame | None = None) -> DataFrame:
    """Senders of swap calls: version 1 by method alone, later versions by router and method."""
    method, to = F.substring("input", 1, 10), F.col("to_address")
    calls = day_slice(tx, run_date).where(
        method.isin(*UNISWAP_V1_METHODS)
        | (to.isin(*UNISWAP_V2_ROUTERS) & method.isin(*UNISWAP_V2_METHODS))
        | ((to == UNISWAP_V3_ROUTER) & method.isin(*UNISWAP_V3_METHODS))
    )
    return new_only(_first_seen(calls, "uniswap_trader"), stored)


def curve_traders(
    tx: DataFrame, logs: DataFrame, run_date: date | None = None, stored: DataFrame | None = None
) -> DataFrame:
    """Senders of transactions that logged one of the two exchange topics."""
    swaps = (
        day_slice(logs, run_date)
        .where(F.get("topics", F.lit(0)).isin(*CURVE_TOPICS))
        .select(packed("transaction_hash").alias("hash"))
        .distinct()
    )
    senders = (
        _senders(day_slice(tx, run_date), "address")
        .join(swaps, "hash")
        .select("address")
        .distinct()
        .select(unpacked("address").alias("address"))
    )
    return new_only(senders, stored)


def _ens(events: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return events.where((F.col("protocol") == "ens") & F.col("event").isin(*names))


def ens_registrants(events: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """First registration per owner, for each of the two generations of the registrar.

    An owner known to both has two rows.
    """
    old = F.col("event") == ENS_HASH_REGISTERED
    found = (
        _ens(events, (*ENS_REGISTERED, ENS_HASH_REGISTERED))
        .groupBy(F.col("owner").alias("address"), old.alias("_old"))
        .agg(F.min("block_timestamp").alias("tx_timestamp"))
        .select("address", "tx_timestamp", F.lit("ens_registor").alias("tag"))
    )
    return new_only(found, stored)


def ens_owners(events: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Registered names with owner and expiry, the latest renewal going before the original expiry."""
    renewed = _ens(events, ENS_RENEWED).groupBy("name").agg(F.max("expires").alias("renewed"))
    expires = F.coalesce("renewed", "expires").cast("long")
    found = (
        _ens(events, ENS_REGISTERED)
        .select(F.col("owner").alias("address"), F.col("block_timestamp").alias("tx_timestamp"), "name", "expires")
        .join(renewed, "name", "left")
        .select(
            "address",
            "tx_timestamp",
            F.lit("ens_owner").alias("tag"),
            "name",
            F.timestamp_seconds(expires).alias("expire_timestamp"),
        )
    )
    return new_only(found, stored)


def stack_events(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Stack one table per (protocol, event) into the long form the functions above read."""
    columns = {"transaction_hash": "string", "block_timestamp": "timestamp", "owner": "string", "name": "string", "expires": "string"}
    frames = []
    for (protocol, event), df in tables.items():
        present = [F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()]
        frames.append(df.select(F.lit(protocol).alias("protocol"), F.lit(event).alias("event"), *present))
    return union_all(frames)
