"""Driver tables -> canonical transactions.

``events`` stands in for the protocol's event log (mapping fixed in
FIXTURES.md); ``orders`` joined to ``lineitem`` is a second, larger source with
many (account, timestamp) ties.  Both return the canonical transaction columns
and nothing else, so Catalyst prunes every unused parquet column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import use_utc

# FIXED VALUES of the adapter (FIXTURES.md): driver event name -> protocol event.
EVENTS_EVENT_MAP = {
    "signup": "Mint",
    "view": "Redeem",
    "purchase": "Borrow",
    "click": "RepayBorrow",
    "error": "LiquidateBorrow",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _event_map(col):
    expr = None
    for raw, canon in EVENTS_EVENT_MAP.items():
        expr = (F.when(col == raw, canon) if expr is None else expr.when(col == raw, canon))
    return expr


def events_account(user_id, event_id, mode: str = "sparse"):
    if mode == "dense":
        return user_id.cast("string")
    if mode == "sparse":
        return (user_id * 31 + event_id % 31).cast("string")
    raise ValueError(f"unknown account mode {mode!r}")


def events_transactions(spark: SparkSession, sf_dir: str, account: str = "sparse") -> DataFrame:
    """Canonical transactions from the driver ``events`` table."""
    use_utc(spark)
    return adapt_events(read_table(spark, sf_dir, "events"), account)


def adapt_events(e: DataFrame, account: str = "sparse") -> DataFrame:
    """The adapter as pure column expressions (works on batch and streams)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    uid, eid = F.col("user_id"), F.col("event_id")
    acct = events_account(uid, eid, account)
    other = events_account(uid + 1, eid, account)
    return e.select(
        _event_map(F.col("event_type")).alias("event_type"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("bigint").alias("block_number"),
        eid.cast("string").alias("transaction_hash"),
        acct.alias("account"),
        F.when(F.col("event_type") == "error",
               F.when(eid % 5 == 0, acct).otherwise(other)).alias("liquidator"),
        (k % 8).cast("string").alias("token"),
        F.concat(F.lit("c"), (k % 5).cast("string")).alias("ctoken"),
        F.col("value").alias("amount"),
        (F.col("value") * (F.lit(1) + (k % 8) / F.lit(10))).alias("amountusd"),
    )


def orders_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical transactions from ``lineitem`` joined to ``orders``.

    Own mapping: N/O and R/O lines supply (Mint), N/F redeem, A/O borrow, A/F
    repay, R/F lines are liquidations when discounted 10 %, else redeem.
    Both sides are large; the join is an equi-join on the order key that
    Catalyst plans as a shuffle (sort-merge) join at scale.
    """
    use_utc(spark)
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    ev = (F.when((rf == "N") & (ls == "O"), "Mint")
          .when((rf == "R") & (ls == "O"), "Mint")
          .when((rf == "N") & (ls == "F"), "Redeem")
          .when((rf == "A") & (ls == "O"), "Borrow")
          .when((rf == "A") & (ls == "F"), "RepayBorrow")
          .when((rf == "R") & (ls == "F") & (F.col("l_discount") >= 0.1), "LiquidateBorrow")
          .otherwise("Redeem"))
    acct = F.col("o_custkey").cast("string")
    return j.select(
        ev.alias("event_type"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("bigint").alias("block_number"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
         .alias("transaction_hash"),
        acct.alias("account"),
        F.when(ev == "LiquidateBorrow", (F.col("o_custkey") + 1).cast("string")).alias("liquidator"),
        (F.col("l_partkey") % 8).cast("string").alias("token"),
        F.concat(F.lit("c"), (F.col("l_suppkey") % 5).cast("string")).alias("ctoken"),
        F.col("l_extendedprice").alias("amount"),
        (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("amountusd"),
    )


def transactions(spark: SparkSession, sf_dir: str, source: str = "events_sparse") -> DataFrame:
    if source == "events_sparse":
        return events_transactions(spark, sf_dir, "sparse")
    if source == "events_dense":
        return events_transactions(spark, sf_dir, "dense")
    if source == "orders":
        return orders_transactions(spark, sf_dir)
    raise ValueError(source)
