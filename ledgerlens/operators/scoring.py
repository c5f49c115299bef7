"""Heuristic scoring.

Statistics of the weighted columns are one global aggregation (partial on
the map side) whose single row is broadcast; everything per wallet is one
codegen'd projection.  The percentile transform uses the distributed rank of
``ranking.py`` instead of a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.functions.columns import round_half_even_int
from ledgerlens.operators.ranking import percentile_rank_min

ADJUSTMENT_KEYS = ["liquidation_penalty", "good_repayer_bonus", "high_ltv_penalty",
                   "consistency_bonus", "inactivity_penalty"]


def prepare_scoring(features: DataFrame, anomaly: DataFrame | None = None) -> DataFrame:
    """Attach ``anomaly_score``; wallets without one (or no table) get 0.5."""
    if anomaly is None:
        return features.withColumn("anomaly_score", F.lit(C.NEUTRAL_ANOMALY))
    a = anomaly.select("wallet", F.col("anomaly_score").cast("double").alias("anomaly_score"))
    return (features.join(a, "wallet", "left")
                    .withColumn("anomaly_score", F.coalesce("anomaly_score", F.lit(C.NEUTRAL_ANOMALY))))


def available_weights(df: DataFrame, weights: dict | None = None) -> dict:
    """Weights whose column exists (plan-time, F7)."""
    w = weights if weights is not None else C.FEATURE_WEIGHTS
    return {f: float(x) for f, x in w.items() if f in df.columns}


def missing_weighted_features(df: DataFrame, weights: dict | None = None) -> list:
    w = weights if weights is not None else C.FEATURE_WEIGHTS
    return [f for f in w if f not in df.columns]


def feature_stats(df: DataFrame, features) -> DataFrame:
    """One row: min, max, mean of each weighted feature."""
    aggs = []
    for f in features:
        aggs += [F.min(f).cast("double").alias(f"min__{f}"), F.max(f).cast("double").alias(f"max__{f}"),
                 F.avg(f).alias(f"mean__{f}")]
    return df.agg(*aggs)


def contribution_columns(df: DataFrame, weights: dict, optimize: bool = True) -> tuple:
    """Return (df with stats columns, {feature: contribution Column}).

    optimize=True (vector mode): constant feature -> no contribution.
    optimize=False (row mode): constant feature -> 0.5, NULL feature skipped."""
    stats = feature_stats(df, weights)
    out = df.crossJoin(F.broadcast(stats))   # one row
    contrib = {}
    for f, w in weights.items():
        x, lo, hi = F.col(f).cast("double"), F.col(f"min__{f}"), F.col(f"max__{f}")
        norm = (x - lo) / (hi - lo)
        if w < 0:
            norm = F.lit(1.0) - norm
        if optimize:
            c = F.when(hi > lo, norm * F.lit(abs(w)))
        else:
            half = F.lit(0.5) if w >= 0 else (F.lit(1.0) - F.lit(0.5))
            c = F.when(x.isNull(), F.lit(None).cast("double")).when(hi > lo, norm * F.lit(abs(w))) \
                 .otherwise(half * F.lit(abs(w)))
        contrib[f] = c
    return out, contrib


def weighted_score(df: DataFrame, weights: dict | None = None, optimize: bool = True) -> DataFrame:
    """``raw_score`` = sum of contributions / sum |w| of available weights, plus
    ``feature_contributions`` map (H1 / H2, P15)."""
    w = available_weights(df, weights)
    base_cols = df.columns
    out, contrib = contribution_columns(df, w, optimize)
    out = out.withColumns({f"_c__{f}": c for f, c in contrib.items()})
    total = F.lit(0.0)
    for f in w:
        total = total + F.coalesce(F.col(f"_c__{f}"), F.lit(0.0))
    sum_w = sum(abs(x) for x in w.values())
    raw = total / F.lit(sum_w) if sum_w > 0 else total
    names = F.array(*[F.lit(f) for f in w]) if w else F.array().cast("array<string>")
    vals = F.array(*[F.col(f"_c__{f}") for f in w]) if w else F.array().cast("array<double>")
    fc = F.map_filter(F.map_from_arrays(names, vals), lambda k, v: v.isNotNull())
    return out.select(*base_cols, raw.alias("raw_score"), fc.alias("feature_contributions"))


def apply_adjustments(df: DataFrame, optimize: bool = True) -> DataFrame:
    """Rule multipliers in the reference order H3 -> H4 -> H5 -> H6 -> H7
    (optimize=False: H3 -> H5 only, no ``adjustments`` map)."""
    cols = set(df.columns)
    raw = F.col("raw_score")
    adj = {}
    if "liquidation_count_borrower" in cols:
        n = F.col("liquidation_count_borrower")
        pen = F.least(n * F.lit(C.LIQUIDATION_STEP), F.lit(C.LIQUIDATION_CAP))
        raw = F.when(n > 0, raw * (F.lit(1.0) - pen)).otherwise(raw)
        adj["liquidation_penalty"] = F.when(n > 0, -pen)
    if {"repay_ratio", "liquidation_count_borrower"} <= cols:
        good = (F.col("repay_ratio") > C.GOOD_REPAY_RATIO) & (F.col("liquidation_count_borrower") == 0)
        raw = F.when(good, raw * F.lit(1.0 + C.GOOD_REPAY_BONUS)).otherwise(raw)
        adj["good_repayer_bonus"] = F.when(good, F.lit(C.GOOD_REPAY_BONUS))
    if "max_ltv_alltime" in cols:
        high = F.col("max_ltv_alltime") > C.HIGH_LTV_LIMIT
        raw = F.when(high, raw * F.lit(1.0 - C.HIGH_LTV_PENALTY)).otherwise(raw)
        adj["high_ltv_penalty"] = F.when(high, F.lit(-C.HIGH_LTV_PENALTY))
    if optimize:
        if {"account_age_days", "activity_consistency_stddev"} <= cols:
            steady = ((F.col("account_age_days") > C.CONSISTENT_AGE_DAYS)
                      & (F.col("activity_consistency_stddev") < C.CONSISTENT_STDDEV))
            raw = F.when(steady, raw * F.lit(1.0 + C.CONSISTENCY_BONUS)).otherwise(raw)
            adj["consistency_bonus"] = F.when(steady, F.lit(C.CONSISTENCY_BONUS))
        if "days_since_last_tx" in cols:
            d = F.col("days_since_last_tx")
            pen = F.least(F.lit(C.INACTIVE_STEP) * (d / F.lit(C.INACTIVE_PERIOD_DAYS)), F.lit(C.INACTIVE_CAP))
            raw = F.when(d > C.INACTIVE_DAYS, raw * (F.lit(1.0) - pen)).otherwise(raw)
            adj["inactivity_penalty"] = F.when(d > C.INACTIVE_DAYS, -pen)
    out = df.withColumn("raw_score", raw)
    if optimize:
        keys = [k for k in ADJUSTMENT_KEYS if k in adj]
        if keys:
            m = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]),
                                  F.array(*[adj[k].cast("double") for k in keys]))
            m = F.map_filter(m, lambda k, v: v.isNotNull())
        else:
            m = F.create_map().cast("map<string,double>")
        out = out.withColumn("adjustments", m)
    return out


def score_wallets(features: DataFrame, anomaly: DataFrame | None = None,
                  weights: dict | None = None, optimize: bool = True) -> DataFrame:
    """Orchestrated scoring (H13): prepare -> weight -> adjust."""
    s = prepare_scoring(features, anomaly)
    s = weighted_score(s, weights, optimize)
    return apply_adjustments(s, optimize)


def final_score(scored: DataFrame, method: str = C.SCORING_METHOD, reverse: bool = C.SCORING_REVERSE,
                k: float = C.SIGMOID_K, x0: float = C.SIGMOID_X0, tie_digits: int | None = None,
                buckets: int | None = None) -> DataFrame:
    """0-100 integer ``final_score``.

    percentile: rank(min, pct) of raw_score, ascending when ``reverse`` (so a
    high raw score gets a high score, as in the reference); min_max and sigmoid
    invert when ``reverse``.  Raw scores are ranked as they are; ``tie_digits``
    rounds them first, for sources whose equal wallets differ in the last bits."""
    if "credit_score" in scored.columns:
        return scored.withColumn("final_score", F.col("credit_score"))
    raw = F.col("raw_score")
    if method == "percentile":
        key = F.round(raw, tie_digits) if tie_digits is not None else raw
        s = scored.withColumn("_rank_key", key)
        s = percentile_rank_min(s, "_rank_key", "_pct", ascending=reverse, buckets=buckets)
        val = F.col("_pct") * F.lit(100.0)
        return s.withColumn("final_score", round_half_even_int(val)).drop("_rank_key", "_pct")
    if method == "min_max":
        st = scored.agg(F.min(raw).alias("_mn"), F.max(raw).alias("_mx"))
        s = scored.crossJoin(F.broadcast(st))
        mn, mx = F.col("_mn"), F.col("_mx")
        norm = (raw - mn) / (mx - mn)
        val = F.when(mx > mn, F.lit(100.0) * ((F.lit(1.0) - norm) if reverse else norm)).otherwise(F.lit(50.0))
        return s.withColumn("final_score", round_half_even_int(val)).drop("_mn", "_mx")
    if method == "sigmoid":
        sig = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-k) * (raw - F.lit(x0))))
        val = F.lit(100.0) * ((F.lit(1.0) - sig) if reverse else sig)
        return scored.withColumn("final_score", round_half_even_int(val))
    raise ValueError(f"Unsupported scoring method: {method}")


def top_wallets(final: DataFrame, n: int = C.TOP_N) -> DataFrame:
    """Top-N (wallet, score); ties broken by wallet (TakeOrdered, no full sort)."""
    return (final.orderBy(F.col("final_score").desc(), F.col("wallet").asc()).limit(n)
                 .select("wallet", F.col("final_score").alias("score")))


def weight_availability(df: DataFrame, weights: dict | None = None) -> DataFrame:
    """F7 as a table: (feature, weight, available) for every configured weight,
    decided on the schema at plan time."""
    w = weights if weights is not None else C.FEATURE_WEIGHTS
    rows = [(f, float(x), f in df.columns) for f, x in w.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, weight double, available boolean")
