"""Reporting tables over final scores.

Everything here is an aggregation or a bounded top-k; the only broadcast is
the top/bottom selection, whose size is fixed by ``n``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.functions.columns import safe_corr

CORR_FEATURES = ["tx_count", "wallet_age_days", "borrow_count", "repay_count", "market_count",
                 "liquidation_count_borrower"]
KEY_FEATURES = ["tx_count", "wallet_age_days", "market_count", "liquidation_count_borrower"]


def score_distribution(final: DataFrame) -> DataFrame:
    """Histogram of final scores."""
    return final.groupBy("final_score").agg(F.count(F.lit(1)).alias("wallets"))


def score_overall(final: DataFrame) -> DataFrame:
    """n, min, max, mean and exact median of the final score (A12), all from the
    histogram of the 101 possible scores."""
    h = score_distribution(final.where(F.col("final_score").isNotNull()))
    w = Window.orderBy("final_score").rowsBetween(Window.unboundedPreceding, -1)   # at most 101 rows
    h = h.withColumn("_below", F.coalesce(F.sum("wallets").over(w), F.lit(0)))
    n = F.sum("wallets").over(Window.partitionBy())
    h = h.withColumn("_n", n)
    holds = lambda k: (F.col("_below") <= k) & (k < F.col("_below") + F.col("wallets"))
    low, high = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    middle = lambda k: F.max(F.when(holds(k), F.col("final_score")))
    s, k = F.col("final_score"), F.col("wallets")
    return h.agg(F.coalesce(F.sum(k), F.lit(0)).alias("wallets"), F.min(s).alias("min_score"), F.max(s).alias("max_score"),
                 (F.sum(s * k) / F.sum(k)).alias("mean_score"), ((middle(low) + middle(high)) / 2).alias("median_score"))


def score_feature_corr(final: DataFrame, features: DataFrame | None = None, names=CORR_FEATURES) -> DataFrame:
    """Pearson correlation of the final score with features, long form (A13,
    J6).  Constant columns give NULL (the reference prints nan).  Without
    ``features`` they are columns of ``final`` and nothing is joined."""
    names = [n for n in names if n in (features or final).columns]
    j = final if features is None else \
        features.select("wallet", *names).join(final.select("wallet", "final_score"), "wallet", "inner")
    wide = j.agg(*[safe_corr("final_score", n).alias(n) for n in names])
    stack = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("correlation"))
                                for n in names]))
    return wide.select(stack.alias("s")).select("s.feature", "s.correlation")


def top_and_bottom(final: DataFrame, n: int = 5) -> DataFrame:
    """Top-n and bottom-n wallets tagged by group (T2, W3, U3).  Bottom = the
    tail of the descending (score, wallet) order."""
    top = final.orderBy(F.col("final_score").desc(), F.col("wallet").asc()).limit(n) \
               .withColumn("group", F.lit("top"))
    bottom = final.orderBy(F.col("final_score").asc(), F.col("wallet").desc()).limit(n) \
                  .withColumn("group", F.lit("bottom"))
    return top.unionByName(bottom)


def top_bottom_analysis(final: DataFrame, features: DataFrame | None = None, n: int = 5,
                        feature_names=KEY_FEATURES) -> DataFrame:
    """Analysis table (H14, J4): the 2n selected wallets with their features,
    which are columns of ``final`` or, if given, joined from ``features`` (the
    selection is bounded by ``n``, so it is broadcast)."""
    cols = [c for c in feature_names if c in (features or final).columns]
    if features is None:
        sel = top_and_bottom(final.select("wallet", "final_score", "raw_score", *cols), n)
    else:
        sel = features.select("wallet", *cols).join(
            F.broadcast(top_and_bottom(final.select("wallet", "final_score", "raw_score"), n)), "wallet", "inner")
    return (sel.withColumn("wallet_prefix", F.substring("wallet", 1, 10))
                 .select("wallet", "wallet_prefix", "group", "final_score", "raw_score", *cols))


def full_analysis(final: DataFrame, n: int = 5) -> DataFrame:
    """The whole analysis table (H14) in long form: for the 2n selected wallets every
    feature and the anomaly score, every contribution and every adjustment:
    ``wallet, group, final_score, raw_score, part, name, value``."""
    skip = ("wallet", "final_score", "raw_score", "group")
    names = [c for c, t in final.dtypes if c not in skip and t in ("int", "bigint", "double")]
    sel = top_and_bottom(final, n)
    part = lambda kind, entries: F.transform(entries, lambda e: F.struct(F.lit(kind).alias("part"), e["key"].alias("name"), e["value"].cast("double").alias("value")))
    features = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in names])
    rows = F.concat(part("feature", features), part("contribution", F.map_entries("feature_contributions")), part("adjustment", F.map_entries("adjustments")))
    return sel.select("wallet", "group", "final_score", "raw_score", F.explode(rows).alias("r")).select("wallet", "group", "final_score", "raw_score", "r.*").where(F.col("value").isNotNull())


def dedup_wallets(df: DataFrame) -> DataFrame:
    """Keep one row per wallet (U4)."""
    return df.dropDuplicates(["wallet"])


def score_bands(final: DataFrame, high: int = C.BAND_HIGH, medium: int = C.BAND_MEDIUM,
                grades=((80, "A"), (60, "B"), (40, "C"), (20, "D"))) -> DataFrame:
    """Band (high/medium/low) and a letter grade with configurable cut-offs."""
    s = F.col("final_score")
    band = F.when(s >= high, "high").when(s >= medium, "medium").otherwise("low")
    g = None
    for cut, letter in grades:
        g = F.when(s >= cut, letter) if g is None else g.when(s >= cut, letter)
    grade = g.otherwise("F") if g is not None else F.lit("F")
    return final.select("wallet", "final_score", band.alias("band"), grade.alias("grade"))
