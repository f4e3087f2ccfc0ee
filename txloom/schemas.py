"""Schemas of the input tables as DDL text. Types are the ones the operators expect after a Parquet read."""

from __future__ import annotations

UTXO_TRANSACTIONS = """
    hash string, block_number bigint, block_timestamp timestamp, block_timestamp_month date, fee bigint,
    virtual_size bigint, is_coinbase boolean, input_count bigint, output_count bigint,
    inputs array<struct<value: bigint, type: string, addresses: array<string>,
        spent_transaction_hash: string, spent_output_index: bigint>>,
    outputs array<struct<index: bigint, value: bigint, type: string, addresses: array<string>>>
    """
VALUE_FLOW = """
    hash string, block_number bigint, address string, block_timestamp timestamp, in_value double,
    out_value double, net_value double, in_usd_value double, out_usd_value double, net_usd_value double,
    partition_date date
    """
DAY_PRICE = "price_timestamp timestamp, price decimal(38,9)"
KLINES = "openTimeStamp timestamp, close string, symbol string"
ACCOUNT_TRANSACTIONS = """
    hash string, from_address string, to_address string, input string, block_number bigint,
    block_timestamp timestamp, receipt_status int, receipt_effective_gas_price bigint, receipt_gas_used bigint
    """
TRACES = """
    transaction_hash string, from_address string, to_address string, trace_type string, reward_type string,
    value decimal(38,0), block_number bigint, block_timestamp timestamp
    """
TOKEN_TRANSFERS = """
    transaction_hash string, from_address string, to_address string, token_address string, value string,
    block_number bigint, block_timestamp timestamp
    """
LOGS = "transaction_hash string, topics array<string>, data string, block_timestamp timestamp"
PROTOCOL_EVENTS = """
    protocol string, event string, transaction_hash string, block_timestamp timestamp, owner string,
    name string, expires string
    """
CONTRACTS = "address string, is_erc721 boolean"
TOKEN_DECIMALS = "address string, decimals string"
STATUS_BACKFILL = "transaction_hash string, receipt_status int"
TOKEN_PRICE_FEED = "address string, timestamp timestamp, price double, symbol string"
TOKEN_PRICE = "address string, price_day date, price double, symbol string"
RISK_WEIGHTS = "feature_no string, feature_weight double, subfeature_no bigint, subfeature_score double"
SEED_LABELS = "address string, feature string, name string, plots string"
TAGS = "address string, feature string, name string, plots string, idx int"
PROTOCOL_USERS = "address string, tx_timestamp timestamp, tag string"
LAST_ACTIVITY = "address string, latest_activate_timestamp timestamp, pt date"

INPUTS: dict[str, str] = {
    "utxo_transactions": UTXO_TRANSACTIONS,
    "value_flow": VALUE_FLOW,
    "day_price": DAY_PRICE,
    "klines": KLINES,
    "account_transactions": ACCOUNT_TRANSACTIONS,
    "traces": TRACES,
    "token_transfers": TOKEN_TRANSFERS,
    "logs": LOGS,
    "protocol_events": PROTOCOL_EVENTS,
    "contracts": CONTRACTS,
    "token_decimals": TOKEN_DECIMALS,
    "status_backfill": STATUS_BACKFILL,
    "token_price_feed": TOKEN_PRICE_FEED,
    "token_price": TOKEN_PRICE,
    "risk_weights": RISK_WEIGHTS,
    "seed_labels": SEED_LABELS,
}
