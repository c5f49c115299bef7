"""Per-wallet transaction sequences for sequence models.

The last ``length`` events of a wallet, and the one before them for the first
gap, come from ``ordered.last_rows``: each chunk of a wallet's time keeps as many
at most, so no step sees a hot wallet whole and the log is read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.columns import day_diff
from ledgerlens.operators.ordered import last_rows

EVENT_CODES = {"Mint": 1, "Redeem": 2, "Borrow": 3, "RepayBorrow": 4, "LiquidateBorrow": 5}


def tx_sequences(tx: DataFrame, length: int = 10) -> DataFrame:
    """Long form (wallet, pos, event_code, amount, gap_days), pos 1..length,
    zero-padded at the front for wallets with fewer events."""
    code = None
    for ev, c in EVENT_CODES.items():
        code = F.when(F.col("event_type") == ev, c) if code is None else code.when(F.col("event_type") == ev, c)
    t = last_rows(tx.select("account", "timestamp", "transaction_hash", "event_type", "amount"), "account", length + 1, tiebreak=("transaction_hash",))
    t = t.withColumn("_prev", F.lag("timestamp").over(Window.partitionBy("account").orderBy(F.desc("_from_end"))))
    step = F.struct((F.lit(length) - F.col("_from_end") + 1).alias("pos"), code.cast("int").alias("event_code"),
                    F.coalesce("amount", F.lit(0.0)).alias("amount"), F.coalesce(day_diff("_prev", "timestamp"), F.lit(0.0)).alias("gap_days"))
    steps = t.where(F.col("_from_end") <= length).groupBy(F.col("account").alias("wallet")).agg(F.collect_list(step).alias("_s"))
    pos = F.explode(F.sequence(F.lit(1), F.lit(length))).alias("pos")
    out = steps.select("wallet", "_s", pos).select("wallet", "pos", F.get(F.filter("_s", lambda x: x["pos"] == F.col("pos")), F.lit(0)).alias("_e"))
    return out.select("wallet", "pos", F.coalesce("_e.event_code", F.lit(0)).alias("event_code"),
                      F.coalesce("_e.amount", F.lit(0.0)).alias("amount"), F.coalesce("_e.gap_days", F.lit(0.0)).alias("gap_days"))
