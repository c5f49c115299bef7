"""Canonical schemas and the fixed name tables of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference for equal results)
# ---------------------------------------------------------------------------
EVENT_TYPES = ["Mint", "Redeem", "Borrow", "RepayBorrow", "LiquidateBorrow"]

# Title-cased raw event name -> canonical event name.
EVENT_SYNONYMS = {
    "Mint": "Mint",
    "Supply": "Mint",
    "Deposit": "Mint",
    "Redeem": "Redeem",
    "Withdraw": "Redeem",
    "Borrow": "Borrow",
    "Repayborrow": "RepayBorrow",
    "Repay": "RepayBorrow",
    "Repayment": "RepayBorrow",
    "Liquidateborrow": "LiquidateBorrow",
    "Liquidate": "LiquidateBorrow",
}

# Source column name -> canonical column name.  Order is precedence: the first
# present source fills a canonical column that does not exist yet.
COLUMN_ALIASES = [
    ("timestamp", "timestamp"),
    ("block_timestamp", "timestamp"),
    ("time", "timestamp"),
    ("date", "timestamp"),
    ("block_number", "block_number"),
    ("block", "block_number"),
    ("blocknumber", "block_number"),
    ("transaction_hash", "transaction_hash"),
    ("tx_hash", "transaction_hash"),
    ("txhash", "transaction_hash"),
    ("hash", "transaction_hash"),
    ("event_type", "event_type"),
    ("event", "event_type"),
    ("type", "event_type"),
    ("account", "account"),
    ("user", "account"),
    ("wallet", "account"),
    ("from", "account"),
    ("minter", "account"),
    ("borrower", "account"),
    ("payer", "account"),
    ("liquidator", "liquidator"),
    ("to", "liquidator"),
    ("amount", "amount"),
    ("amount_raw", "amount_raw"),
    ("amount_decimal", "amount"),
    ("asset_amount", "amount"),
    ("collateral_amount", "collateral_amount"),
    ("token", "token"),
    ("c_token", "ctoken"),
    ("ctoken", "ctoken"),
    ("asset", "token"),
    ("underlying", "token"),
    ("collateral", "collateral_token"),
]

# Columns a transaction table must have (padded with NULL when absent).
REQUIRED_COLUMNS = ["timestamp", "transaction_hash", "account", "event_type"]

# Columns a CSV is expected to carry; fewer than half found -> re-sniff.
EXPECTED_COLUMNS = ["event_type", "timestamp", "block_number", "transaction_hash",
                    "account", "amount", "token"]

# Event implied by an event-specific column, tried in this order when the
# event_type column is entirely NULL.
EVENT_HINT_COLUMNS = [
    ("Mint", ["minter", "mint_amount"]),
    ("Redeem", ["redeemer", "redeem_amount"]),
    ("Borrow", ["borrower", "borrow_amount"]),
    ("RepayBorrow", ["payer", "repay_amount"]),
    ("LiquidateBorrow", ["liquidator", "seized_amount"]),
]

# Columns holding addresses (normalised: one leading "0x" removed, lower case).
ADDRESS_COLUMNS = ["account", "liquidator", "token", "ctoken", "collateral_token"]

# Keys of a nested event file and the event each array holds.
NESTED_EVENT_KEYS = [
    ("deposits", "Mint"),
    ("withdraws", "Redeem"),
    ("borrows", "Borrow"),
    ("repays", "RepayBorrow"),
    ("liquidations", "LiquidateBorrow"),
]

# Critical columns: rows with NULL in any of them are dropped.
CRITICAL_COLUMNS = ["timestamp", "account", "event_type"]
# ---------------------------------------------------------------------------

TRANSACTIONS = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("block_number", T.LongType()),
    T.StructField("transaction_hash", T.StringType()),
    T.StructField("account", T.StringType()),
    T.StructField("liquidator", T.StringType()),
    T.StructField("token", T.StringType()),
    T.StructField("ctoken", T.StringType()),
    T.StructField("collateral_token", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("amount_raw", T.StringType()),
    T.StructField("collateral_amount", T.DoubleType()),
    T.StructField("amountusd", T.DoubleType()),
    T.StructField("token_symbol", T.StringType()),
])

SUMMARY_COLUMNS = ["wallet", "first_tx_timestamp", "last_tx_timestamp", "tx_count",
                   "wallet_age_days", "mint_count", "redeem_count", "borrow_count",
                   "repay_count", "liquidation_count", "market_count"]

ACTIVITY_COLUMNS = ["borrow_to_supply_ratio_count", "borrow_to_supply_ratio_vol", "repay_ratio",
                    "liquidation_count_borrower", "liquidation_count_liquidator"]

TEMPORAL_COLUMNS = ["avg_time_between_tx_days", "max_time_between_tx_days",
                    "min_time_between_tx_days", "activity_consistency_stddev",
                    "activity_consistency_cv"]

FEATURE_COLUMNS = SUMMARY_COLUMNS + ACTIVITY_COLUMNS + ["days_since_last_tx"] + TEMPORAL_COLUMNS

# Nested event element as read from a raw JSON file.  Amount and timestamp are
# read as strings so that 22+ digit integers keep every digit.
NESTED_EVENT = T.StructType([
    T.StructField("account", T.StructType([T.StructField("id", T.StringType())])),
    T.StructField("asset", T.StructType([T.StructField("id", T.StringType()),
                                         T.StructField("symbol", T.StringType())])),
    T.StructField("amount", T.StringType()),
    T.StructField("amountUSD", T.StringType()),
    T.StructField("hash", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("liquidator", T.StructType([T.StructField("id", T.StringType())])),
])
NESTED_FILE = T.StructType([T.StructField(k, T.ArrayType(NESTED_EVENT)) for k, _ in NESTED_EVENT_KEYS])
