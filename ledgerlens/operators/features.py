"""Per-wallet aggregation and behavioural features.

Plan shape: one hash aggregation by account for the summary, counts, volumes
and ratios (partial aggregation on the map side, so a hot wallet costs one
row per task before the shuffle); one two-level distinct for the market
count; interval statistics from ``adjacent`` (chunked, skew-safe, one scan).
All parts are hash-partitioned by account, so their joins add no exchange.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.config import DEFAULT_AS_OF
from ledgerlens.functions.columns import day_diff, guarded_ratio, ts_literal
from ledgerlens.operators.ordered import DEFAULT_CHUNK_SECONDS, adjacent, gap_us
from ledgerlens.operators.ranking import exact_medians
from ledgerlens.schema import FEATURE_COLUMNS, SUMMARY_COLUMNS
from ledgerlens.session import stage

def _ev():
    return F.col("event_type")


def _count(ev: str):
    return F.count_if(_ev() == ev)


def _volume(ev: str, has_amount: bool):
    if not has_amount:
        return F.lit(0.0)
    return F.coalesce(F.sum(F.when(_ev() == ev, F.col("amount"))), F.lit(0.0))


def market_counts(tx: DataFrame) -> DataFrame:
    """Distinct non-NULL values over the union of ``token`` and ``ctoken``."""
    cols = [c for c in ("token", "ctoken") if c in tx.columns]
    if not cols:
        return tx.select(F.col("account").alias("wallet")).distinct().withColumn("market_count", F.lit(0).cast("long"))
    m = (tx.select("account", F.explode(F.array(*[F.col(c) for c in cols])).alias("market"))
           .where(F.col("market").isNotNull()))
    return m.groupBy(F.col("account").alias("wallet")).agg(F.countDistinct("market").alias("market_count"))


def liquidator_counts(tx: DataFrame) -> DataFrame:
    """Corrected J9: liquidations performed, counted on the liquidator's side."""
    return (tx.where((_ev() == "LiquidateBorrow") & F.col("liquidator").isNotNull())
              .groupBy(F.col("liquidator").alias("wallet"))
              .agg(F.count(F.lit(1)).alias("liquidation_count_liquidator")))


def wallet_activity(tx: DataFrame, liquidation_mode: str = "compat") -> DataFrame:
    """Summary (A1-A3) and activity features (A4, A5, A6) in one aggregation.

    Each row is exploded into its (token, ctoken) markets with a flag on the
    first copy; counts and sums read only flagged copies, min/max are
    unaffected by the copy, and ``countDistinct(market)`` gives the market
    count.  One scan and one single-distinct aggregation (partial on
    (account, market), final on account) replace a second scan and a join.

    ``liquidation_mode``: ``compat`` counts, like the reference, only the
    account's own liquidation rows (liquidator = self for the liquidator count;
    both 0 when the table has no liquidator column); ``corrected`` counts
    liquidations performed on other accounts' rows."""
    has_amount = "amount" in tx.columns
    has_liq = "liquidator" in tx.columns
    mk = [c for c in ("token", "ctoken") if c in tx.columns]
    keep = ["account", "timestamp", "event_type"] + (["amount"] if has_amount else []) + \
        (["liquidator"] if has_liq else [])
    if mk:
        copies = F.array(*[F.struct(F.col(c).cast("string").alias("m"), F.lit(i == 0).alias("w"))
                           for i, c in enumerate(mk)])
        x = tx.select(*keep, F.explode(copies).alias("_e")).select(*keep, "_e.m", "_e.w")
    else:
        x = tx.select(*keep, F.lit(None).cast("string").alias("m"), F.lit(True).alias("w"))
    w = F.col("w")
    ev = _ev()

    def cnt(cond=None):
        return F.count_if(w if cond is None else (w & cond))

    def vol(e):
        if not has_amount:
            return F.lit(0.0)
        return F.coalesce(F.sum(F.when(w & (ev == e), F.col("amount"))), F.lit(0.0))

    aggs = [
        F.min("timestamp").alias("first_tx_timestamp"),
        F.max("timestamp").alias("last_tx_timestamp"),
        cnt().alias("tx_count"),
        cnt(ev == "Mint").alias("mint_count"),
        cnt(ev == "Redeem").alias("redeem_count"),
        cnt(ev == "Borrow").alias("borrow_count"),
        cnt(ev == "RepayBorrow").alias("repay_count"),
        cnt(ev == "LiquidateBorrow").alias("liquidation_count"),
        vol("Mint").alias("supply_volume"),
        vol("Borrow").alias("borrow_volume"),
        vol("RepayBorrow").alias("repay_volume"),
        F.countDistinct("m").alias("market_count"),
    ]
    if has_liq:
        aggs.append(cnt((ev == "LiquidateBorrow") & (F.col("liquidator") == F.col("account"))).alias("_self_liq"))
    a = x.groupBy(F.col("account").alias("wallet")).agg(*aggs)
    zero = F.lit(0).cast("long")
    a = a.select(
        "wallet", "first_tx_timestamp", "last_tx_timestamp", "tx_count",
        day_diff("first_tx_timestamp", "last_tx_timestamp").alias("wallet_age_days"),
        "mint_count", "redeem_count", "borrow_count", "repay_count", "liquidation_count", "market_count",
        guarded_ratio("borrow_count", "mint_count").alias("borrow_to_supply_ratio_count"),
        guarded_ratio("borrow_volume", "supply_volume").alias("borrow_to_supply_ratio_vol"),
        guarded_ratio("repay_volume", "borrow_volume").alias("repay_ratio"),
        (F.col("liquidation_count") if has_liq else zero).alias("liquidation_count_borrower"),
        (F.col("_self_liq") if has_liq else zero).alias("liquidation_count_liquidator"),
    )
    if liquidation_mode == "corrected" and has_liq:
        a = (a.drop("liquidation_count_liquidator")
              .join(liquidator_counts(tx), "wallet", "left")
              .withColumn("liquidation_count_liquidator",
                          F.coalesce("liquidation_count_liquidator", zero)))
    elif liquidation_mode not in ("compat", "corrected"):
        raise ValueError(liquidation_mode)
    return a


def wallet_summary(tx: DataFrame) -> DataFrame:
    """The 11-column summary table."""
    return wallet_activity(tx).select(*SUMMARY_COLUMNS)


def temporal_features(tx: DataFrame, optimize: bool = True,
                      chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Interval statistics over each wallet's sorted timeline.

    optimize=True: population stddev and CV (CV only when the mean > 0);
    optimize=False: sample stddev, no CV column.  Wallets with one row get no
    row here (NULL after the left join)."""
    day = F.lit(86_400_000_000.0)
    us = lambda p, r: gap_us(p["timestamp"], r["timestamp"])
    wide = lambda p, r: us(p, r).cast("decimal(19,0)")
    # Sums of whole microseconds and of their squares are exact, so wallets with
    # the same gaps get the same statistics whatever order the rows come in.
    t = adjacent(tx.select("account", "timestamp"), "account", {
        "_n": ("sum", lambda p, r: F.lit(1)), "_s": ("sum", us), "_q": ("sum", lambda p, r: wide(p, r) * wide(p, r)),
        "_max": ("max", us), "_min": ("min", us)}, chunk_seconds=chunk_seconds)
    t = t.where(F.col("_n").isNotNull()).withColumnRenamed("account", "wallet")
    n = F.col("_n").cast("decimal(19,0)")
    s = F.col("_s").cast("decimal(19,0)")
    spread = (F.col("_q") * n).cast("decimal(38,0)") - (s * s).cast("decimal(38,0)")
    k = F.col("_n").cast("double")
    square = k * (k if optimize else F.nullif(k - 1, F.lit(0.0)))
    t = t.select("wallet", (F.col("_s") / k / day).alias("avg_time_between_tx_days"),
                 (F.col("_max") / day).alias("max_time_between_tx_days"),
                 (F.col("_min") / day).alias("min_time_between_tx_days"),
                 (F.sqrt(spread.cast("double") / square) / day).alias("activity_consistency_stddev"))
    if optimize:
        t = t.withColumn("activity_consistency_cv",
                         F.when(F.col("avg_time_between_tx_days") > 0,
                                F.col("activity_consistency_stddev") / F.col("avg_time_between_tx_days")))
    return t


def raw_wallet_features(tx: DataFrame, as_of: _dt.datetime = DEFAULT_AS_OF, optimize: bool = True,
                        liquidation_mode: str = "compat",
                        chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Summary + activity + recency + temporal features, before imputation."""
    a = wallet_activity(tx, liquidation_mode)
    a = a.withColumn("days_since_last_tx", day_diff("last_tx_timestamp", ts_literal(as_of)))
    t = temporal_features(tx, optimize, chunk_seconds)
    out = a.join(t, "wallet", "left")
    cols = [c for c in FEATURE_COLUMNS if c in out.columns]
    return out.select(*cols)


def imputation_plan(dtypes) -> dict:
    """Column -> rule ('zero' or 'median') following the reference's order:
    names with ratio/pct -> 0, count -> 0, time/days -> median, other numeric
    -> median.  Integer and floating columns only; timestamps untouched."""
    numeric = [c for c, t in dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint")]
    plan = {}
    for c in numeric:
        if "ratio" in c or "pct" in c or "count" in c:
            plan[c] = "zero"
        else:
            plan[c] = "median"
    return plan


def impute_features(df: DataFrame, nullable=None, how: str = "none") -> DataFrame:
    """Median / zero imputation (A10).  ``nullable`` restricts the median
    computation to columns that can hold NULL (filling a column without NULL is
    a no-op); by default every median-rule column is considered.  Medians are
    exact (distributed order statistics); ``how`` stages their one row, so that
    each use of the result reads it instead of computing them again."""
    plan = imputation_plan(df.dtypes)
    zero_cols = [c for c, r in plan.items() if r == "zero"]
    med_cols = [c for c, r in plan.items() if r == "median" and (nullable is None or c in nullable)]
    out = df
    if med_cols:
        med = stage(exact_medians(df, med_cols).select(*[F.col(c).alias(f"_med_{c}") for c in med_cols]), how)
        out = out.crossJoin(F.broadcast(med))  # one row
        out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_med_{c}"), F.lit(0.0)) for c in med_cols})
        out = out.drop(*[f"_med_{c}" for c in med_cols])
    fills = {c: F.coalesce(F.col(c), F.lit(0).cast(dict(df.dtypes)[c])) for c in zero_cols}
    return out.withColumns(fills) if fills else out


def wallet_features(tx: DataFrame, as_of: _dt.datetime = DEFAULT_AS_OF, optimize: bool = True,
                    liquidation_mode: str = "compat",
                    chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """The 22-column feature table (summary + 11 engineered), imputed."""
    raw = raw_wallet_features(tx, as_of, optimize, liquidation_mode, chunk_seconds)
    from ledgerlens.schema import TEMPORAL_COLUMNS
    return impute_features(raw, nullable=set(TEMPORAL_COLUMNS))
