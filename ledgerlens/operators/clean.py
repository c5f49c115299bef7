"""Cleaning of canonical transactions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import coerce_amount, normalize_event_type, parse_timestamp
from ledgerlens.schema import CRITICAL_COLUMNS, EVENT_TYPES


def coerce_amount_columns(df: DataFrame) -> DataFrame:
    """Every string column whose name contains ``amount`` becomes a double."""
    casts = {c: coerce_amount(c) for c, t in df.dtypes if "amount" in c.lower() and t == "string"}
    return df.withColumns(casts) if casts else df


def ensure_timestamp(df: DataFrame) -> DataFrame:
    if "timestamp" not in df.columns:
        return df
    t = dict(df.dtypes)["timestamp"]
    if t == "timestamp":
        return df
    if t == "timestamp_ntz":
        return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return df.withColumn("timestamp", parse_timestamp("timestamp"))


def clean_transactions(tx: DataFrame) -> DataFrame:
    """Drop rows missing a critical value, normalise event names, keep the five
    canonical events, coerce amounts.  No sort: every consumer aggregates or
    orders per wallet itself (``sortWithinPartitions`` is applied on write)."""
    df = ensure_timestamp(tx)
    present = [c for c in CRITICAL_COLUMNS if c in df.columns]
    if present:
        df = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in present]))
    if "event_type" in df.columns:
        df = (df.withColumn("event_type", normalize_event_type("event_type"))
                .where(F.col("event_type").isin(EVENT_TYPES)))
    return coerce_amount_columns(df)


def null_profile(tx: DataFrame, columns=None) -> DataFrame:
    """Missing-value counter per critical column, one aggregation."""
    cols = [c for c in (columns or CRITICAL_COLUMNS) if c in tx.columns]
    return tx.agg(*[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in cols],
                  F.count(F.lit(1)).alias("row_count"))
