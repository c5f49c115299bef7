"""Features the reference declares (weights, rules, methodology) but never
computes (D1-D16).  Each is a Spark job over the cleaned transactions or the
score tables; every per-wallet ordered step goes through ``ordered.py``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.functions.columns import day_diff, guarded_ratio, safe_corr, ts_literal
from ledgerlens.operators.ordered import adjacent, consecutive_gaps, gap_us, last_known, min_at_or_after, rolling_sums
from ledgerlens.operators.ranking import exact_quantile_long, value_positions
from ledgerlens.operators.steps import EXACT, accruals, market_rates, marked_balances, moves
from ledgerlens.session import stage

# Running balances are rounded to this many decimals so that the order of a
# distributed floating sum cannot flip a sign test or blow up a ratio.
BALANCE_DIGITS = 9

EV = ["Mint", "Redeem", "Borrow", "RepayBorrow", "LiquidateBorrow"]
_SHORT = {"Mint": "mint", "Redeem": "redeem", "Borrow": "borrow", "RepayBorrow": "repay",
          "LiquidateBorrow": "liquidation"}


def _ev(name):
    return F.col("event_type") == name


# ------------------------------------------------------------------ D1
def windowed_features(tx: DataFrame, as_of: _dt.datetime = C.DEFAULT_AS_OF, windows=None) -> DataFrame:
    """Lifetime / 90d / 30d variants (suffix ``_<window>``) of the summary's counts,
    volumes and market count and of the interval statistics, by wallet.

    One aggregation per (account, market) and one over pairs of neighbours serve
    all windows: a market counts in a window if its last event lies in it, a gap
    by the event that ends it, if the one before lies in the window too."""
    windows = windows or C.TIME_WINDOWS
    stop = ts_literal(as_of)
    start = {n: None if days is None else ts_literal(as_of - _dt.timedelta(days=days)) for n, days in windows.items()}
    since = lambda n, t: (t <= stop) if start[n] is None else ((t <= stop) & (t >= start[n]))

    aggs = []
    for n in windows:
        inside = since(n, F.col("timestamp"))
        aggs.append(F.count_if(inside).alias(f"tx_count_{n}"))
        aggs += [F.count_if(inside & _ev(e)).alias(f"{_SHORT[e]}_count_{n}") for e in EV]
        aggs += [F.sum(F.when(inside & _ev(e), F.col("amount"))).alias(f"_{_SHORT[e]}_{n}") for e in ("Mint", "Borrow", "RepayBorrow")]
        aggs += [F.min(F.when(inside, F.col("timestamp"))).alias(f"_first_{n}"), F.max(F.when(inside, F.col("timestamp"))).alias(f"_last_{n}")]
    counts = tx.groupBy(F.col("account").alias("wallet")).agg(*aggs)

    markets = tx.where(F.col("timestamp") <= stop).select("account", "timestamp", F.explode(F.array_distinct(F.array(*[c for c in ("token", "ctoken") if c in tx.columns]))).alias("_m"))
    markets = markets.where(F.col("_m").isNotNull()).groupBy("account", "_m").agg(F.max("timestamp").alias("_t")) \
        .groupBy(F.col("account").alias("wallet")).agg(*[F.count_if(since(n, F.col("_t"))).alias(f"_markets_{n}") for n in windows])

    gap = lambda p, r: gap_us(p["timestamp"], r["timestamp"])
    wide = lambda p, r: gap(p, r).cast("decimal(19,0)")
    within = lambda n, f: lambda p, r: F.when(since(n, r["timestamp"]) & since(n, p["timestamp"]), f(p, r))
    metrics = {}
    for n in windows:
        metrics |= {f"_n_{n}": ("sum", within(n, lambda p, r: F.lit(1))), f"_s_{n}": ("sum", within(n, gap)),
                    f"_q_{n}": ("sum", within(n, lambda p, r: wide(p, r) * wide(p, r))),
                    f"_max_{n}": ("max", within(n, gap)), f"_min_{n}": ("min", within(n, gap))}
    gaps = adjacent(tx.select("account", "timestamp"), "account", metrics).withColumnRenamed("account", "wallet")

    day, cols = F.lit(86_400_000_000.0), []
    for n in windows:
        k = F.col(f"_n_{n}").cast("double")
        cols += [F.col(f"tx_count_{n}"), *[F.col(f"{_SHORT[e]}_count_{n}") for e in EV]]
        cols += [F.coalesce(F.col(f"_{_SHORT[e]}_{n}"), F.lit(0.0)).alias(f"{_SHORT[e]}_volume_{n}") for e in ("Mint", "Borrow", "RepayBorrow")]
        cols += [F.coalesce(f"_markets_{n}", F.lit(0).cast("long")).alias(f"market_count_{n}"), day_diff(f"_first_{n}", f"_last_{n}").alias(f"age_days_{n}"),
                 (F.col(f"_s_{n}") / k / day).alias(f"avg_gap_days_{n}"), (F.col(f"_max_{n}") / day).alias(f"max_gap_days_{n}"),
                 (F.col(f"_min_{n}") / day).alias(f"min_gap_days_{n}"), (spread(f"_n_{n}", f"_s_{n}", f"_q_{n}") / k / day).alias(f"stddev_gap_days_{n}")]
    return counts.join(markets, "wallet", "left").join(gaps, "wallet", "left").select("wallet", *cols)


# ------------------------------------------------------------------ D2
def weight_aliases(features: DataFrame, as_of: _dt.datetime = C.DEFAULT_AS_OF) -> DataFrame:
    """Columns named by weights: tx_count_total, account_age_days (first tx to
    the clock, unlike wallet_age_days), market_diversity_count."""
    return features.withColumns({
        "tx_count_total": F.col("tx_count"),
        "account_age_days": day_diff("first_tx_timestamp", ts_literal(as_of)),
        "market_diversity_count": F.col("market_count")})


def declared_features(tx: DataFrame, features: DataFrame, as_of: _dt.datetime = C.DEFAULT_AS_OF) -> DataFrame:
    """``features`` with every column that a weight or rule names and the tables
    can give (D2, D6, D9, D11), one row per wallet."""
    out = weight_aliases(features, as_of)
    ltv = ltv_path(tx, as_of).select("wallet", "avg_ltv_90d", "min_ltv_alltime", "max_ltv_alltime", "time_near_liquidation_pct")
    rewards = reward_estimate(tx, as_of).select("wallet", "comp_earned_estimate_ratio")
    actions = complex_actions(tx).select("wallet", "complex_action_freq")
    for more in (ltv, rewards, actions):
        out = out.join(more, "wallet", "left")
    return out


# ------------------------------------------------------------------ D3
def activity_rates(tx: DataFrame) -> DataFrame:
    """Average value per event type, transactions per day/week/month of the
    active span (span floored at one day) and the exact median interval."""
    aggs = [F.avg(F.when(_ev(e), F.col("amount"))).alias(f"avg_{_SHORT[e]}_amount") for e in EV]
    base = tx.groupBy(F.col("account").alias("wallet")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("timestamp").alias("_a"), F.max("timestamp").alias("_b"), *aggs)
    span = F.greatest(F.lit(1.0), day_diff("_a", "_b"))
    base = base.select("wallet", *[f"avg_{_SHORT[e]}_amount" for e in EV],
                       (F.col("_n") / span).alias("tx_per_day"),
                       (F.col("_n") / (span / F.lit(7.0))).alias("tx_per_week"),
                       (F.col("_n") / (span / F.lit(30.0))).alias("tx_per_month"))
    gaps = consecutive_gaps(tx).select(F.col("account").alias("wallet"), "gap_days")
    med = exact_quantile_long(gaps, "wallet", "gap_days", 0.5, many_groups=True) \
        .withColumnRenamed("quantile", "median_interval_days")
    return base.join(med, "wallet", "left")


# ------------------------------------------------------------------ D4
def borrow_to_repay(tx: DataFrame) -> DataFrame:
    """Per wallet: borrows followed by a repayment of the same token (at or
    after the borrow), and the mean / max days until it."""
    t = tx.select("account", "token", "timestamp", "event_type",
                  F.when(_ev("RepayBorrow"), F.col("timestamp")).alias("_repay_ts"))
    t = min_at_or_after(t, ["account", "token"], "_repay_ts", "next_repay_ts")
    b = t.where(_ev("Borrow")).withColumn("_d", day_diff("timestamp", "next_repay_ts"))
    return b.groupBy(F.col("account").alias("wallet")).agg(
        F.count(F.lit(1)).alias("borrows"), F.count("_d").alias("borrows_repaid"),
        F.avg("_d").alias("avg_days_to_repay"), F.max("_d").alias("max_days_to_repay"))


# ------------------------------------------------------------------ D5
def wallet_sessions(tx: DataFrame, gap_seconds: int = 3600) -> DataFrame:
    """Gaps-and-islands sessions: a new session starts after more than
    ``gap_seconds`` without activity.  Per wallet: sessions, actions per
    session, mean session duration (days), longest inactivity (days),
    burstiness (sigma - mu) / (sigma + mu) of the gaps, and the population
    stddev of the counts per active day."""
    limit = gap_seconds * 1_000_000
    gap = lambda p, r: gap_us(p["timestamp"], r["timestamp"])
    wide = lambda p, r: gap(p, r).cast("decimal(19,0)")
    g = adjacent(tx.select("account", "timestamp"), "account", {
        "n": ("sum", lambda p, r: F.lit(1)), "s": ("sum", gap), "q": ("sum", lambda p, r: wide(p, r) * wide(p, r)), "longest": ("max", gap),
        "breaks": ("sum", lambda p, r: F.when(gap(p, r) > limit, 1)), "inside": ("sum", lambda p, r: F.when(gap(p, r) <= limit, gap(p, r)))})
    day, n = F.lit(86_400_000_000.0), F.col("n").cast("double")
    mu, sd = F.col("s") / n, spread("n", "s", "q") / n
    sessions = F.coalesce("breaks", F.lit(0)) + 1
    g = g.select(F.col("account").alias("wallet"), sessions.alias("sessions"), ((F.coalesce("n", F.lit(0)) + 1) / sessions).alias("actions_per_session"),
                 (F.coalesce("inside", F.lit(0)) / sessions / day).alias("avg_session_days"), (F.col("longest") / day).alias("longest_inactivity_days"),
                 F.try_divide(sd - mu, sd + mu).alias("burstiness"))
    daily = tx.groupBy("account", F.to_date("timestamp").alias("_day")).agg(F.count(F.lit(1)).alias("_c")) \
              .groupBy(F.col("account").alias("wallet")).agg(F.stddev_pop("_c").alias("daily_count_stddev"))
    return g.join(daily, "wallet")


def spread(n: str, s: str, q: str):
    """``sqrt(n q - s s)`` of exact sums: ``n`` times the population deviation."""
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    return F.sqrt(((F.col(q) * wide(n)).cast("decimal(38,0)") - (wide(s) * wide(s)).cast("decimal(38,0)")).cast("double"))


# ------------------------------------------------------------------ D6
def asof_price(tx: DataFrame) -> DataFrame:
    """Per event: the last observed USD price (amountusd / amount of a Mint) of
    its token at or before the event (as-of join by union + carry-forward)."""
    t = tx.select("transaction_hash", "token", "timestamp", "event_type",
                  F.when(_ev("Mint") & (F.col("amount") != 0), F.col("amountusd") / F.col("amount")).alias("_px"))
    return last_known(t, "token", "_px", "price", tiebreak=("transaction_hash",)) \
        .select("transaction_hash", "token", "event_type", "price")


def ltv_path(tx: DataFrame, as_of: _dt.datetime = C.DEFAULT_AS_OF, near: float = 0.8) -> DataFrame:
    """LTV after each event of a wallet: what it has borrowed over what it has
    supplied (when positive), all its tokens at the prices of that moment
    (:func:`asof_price`), so LTV moves with prices too.  Per wallet: avg, min, max,
    stddev of LTV, time-weighted average LTV (weight = time to the next event,
    the last event to the clock), share of time with LTV > ``near`` and the
    average LTV over the last 90 days."""
    t = marked_balances(moves(tx))
    t = t.withColumns({c: F.round(c, BALANCE_DIGITS) for c in ("supplied", "borrowed")})
    t = t.withColumn("ltv", F.when(F.col("supplied") > 0, F.col("borrowed") / F.col("supplied")))
    dt = F.greatest(F.lit(0.0), day_diff("timestamp", F.coalesce("next_ts", ts_literal(as_of))))
    recent = F.col("timestamp") >= ts_literal(as_of - _dt.timedelta(days=90))
    w_ltv = F.when(F.col("ltv").isNotNull(), dt)
    return t.groupBy(F.col("account").alias("wallet")).agg(
        F.avg("ltv").alias("avg_ltv_alltime"), F.min("ltv").alias("min_ltv_alltime"),
        F.max("ltv").alias("max_ltv_alltime"), F.stddev_pop("ltv").alias("ltv_stddev"),
        F.try_divide(F.sum(F.col("ltv") * w_ltv), F.sum(w_ltv)).alias("time_weighted_ltv"),
        F.try_divide(F.sum(F.when(F.col("ltv") > near, dt)), F.sum(w_ltv)).alias("time_near_liquidation_pct"),
        F.avg(F.when(recent, F.col("ltv"))).alias("avg_ltv_90d"))


# ------------------------------------------------------------------ D7
def liquidation_history(tx: DataFrame) -> DataFrame:
    """Liquidations suffered (own rows) and performed (as liquidator of any
    row), with value, average size and the performed / suffered ratio."""
    usd = F.coalesce(F.col("amountusd"), F.col("amount"))
    liq = tx.where(_ev("LiquidateBorrow"))
    suffered = liq.groupBy(F.col("account").alias("wallet")).agg(
        F.count(F.lit(1)).alias("suffered_count"), F.sum(usd).alias("suffered_value"))
    performed = liq.where(F.col("liquidator").isNotNull()).groupBy(F.col("liquidator").alias("wallet")).agg(
        F.count(F.lit(1)).alias("performed_count"), F.sum(usd).alias("performed_value"))
    j = suffered.join(performed, "wallet", "full_outer")
    zl, zd = F.lit(0).cast("long"), F.lit(0.0)
    j = j.select("wallet", F.coalesce("suffered_count", zl).alias("suffered_count"),
                 F.coalesce("suffered_value", zd).alias("suffered_value"),
                 F.coalesce("performed_count", zl).alias("performed_count"),
                 F.coalesce("performed_value", zd).alias("performed_value"))
    return j.withColumns({
        "avg_suffered_size": F.try_divide(F.col("suffered_value"), F.col("suffered_count")),
        "performed_to_suffered": guarded_ratio("performed_count", "suffered_count")})


# ------------------------------------------------------------------ D8, D9
def interest_estimate(tx: DataFrame, as_of: _dt.datetime = C.DEFAULT_AS_OF, rates: DataFrame | None = None,
                      reserve_factor: float = 0.1, seize_share: float = 0.028) -> DataFrame:
    """Interest paid and earned per wallet: its positive USD balance in each
    market at the market's rate, which changes with time (``rates``: steps of
    ``token, timestamp, borrow, supply, reward``; by default :func:`market_rates`).
    Reserves get ``reserve_factor`` of the interest paid and ``seize_share`` of what
    liquidations of the wallet seized."""
    m = moves(tx)
    rates = stage(market_rates(m, reserve_factor=reserve_factor)) if rates is None else rates
    seized = m.groupBy(F.col("account").alias("wallet")).agg(F.coalesce(F.sum("seized"), F.lit(0.0)).alias("_seized"))
    a = accruals(m, rates, as_of).join(seized, "wallet")
    return a.select("wallet", F.col("paid").alias("interest_paid_estimate"), F.col("earned").alias("interest_earned_estimate"),
                    (F.col("paid") * F.lit(reserve_factor) + F.col("_seized") * F.lit(seize_share)).alias("reserve_contribution_estimate"))


def reward_estimate(tx: DataFrame, as_of: _dt.datetime = C.DEFAULT_AS_OF, rates: DataFrame | None = None) -> DataFrame:
    """Reward tokens (USD) accrued on supplied balances at each market's daily
    reward rate, and their ratio to the wallet's USD volume."""
    m = moves(tx)
    rates = stage(market_rates(m)) if rates is None else rates
    volume = m.groupBy(F.col("account").alias("wallet")).agg(F.sum(F.abs("usd")).alias("_vol"))
    return accruals(m, rates, as_of).join(volume, "wallet").select(
        "wallet", F.col("reward").alias("comp_earned_estimate"), guarded_ratio("reward", "_vol").alias("comp_earned_estimate_ratio"))


# ------------------------------------------------------------------ D10
def gas_relative(tx: DataFrame, gas: str = "gas_price", block: str = "block_number") -> DataFrame:
    """Gas price relative to its block mean and to the dataset mean, averaged
    per wallet (needs a gas price column; the driver tables have none)."""
    blk = tx.groupBy(block).agg(F.avg(gas).alias("_bm"))
    allm = tx.agg(F.avg(gas).alias("_am"))
    t = tx.join(blk, block).crossJoin(F.broadcast(allm))    # one-row mean
    return t.groupBy(F.col("account").alias("wallet")).agg(
        F.avg(F.try_divide(F.col(gas), F.col("_bm"))).alias("avg_gas_price_relative_block"),
        F.avg(F.try_divide(F.col(gas), F.col("_am"))).alias("avg_gas_price_relative"))


# ------------------------------------------------------------------ D11
def complex_actions(tx: DataFrame, window: str = "10 minutes") -> DataFrame:
    """Share of a wallet's active tumbling windows with >= 2 distinct actions
    over >= 2 distinct markets."""
    w = tx.groupBy("account", F.window("timestamp", window).alias("_w")).agg(
        F.countDistinct("event_type").alias("_e"), F.countDistinct("token").alias("_m"))
    return w.groupBy(F.col("account").alias("wallet")).agg(
        F.count(F.lit(1)).alias("active_windows"),
        F.count_if((F.col("_e") >= 2) & (F.col("_m") >= 2)).alias("complex_windows")) \
        .withColumn("complex_action_freq", F.col("complex_windows") / F.col("active_windows"))


# ------------------------------------------------------------------ D12
def behaviour_flags(tx: DataFrame, cycle_seconds: int = 3600, flash_seconds: int = 600,
                    repeat_seconds: int = 60) -> DataFrame:
    """Pattern counts per wallet: rapid supply->redeem cycles on one market,
    flash-loan-like borrow->repay on one market, bot-like repeats of the
    same action within ``repeat_seconds``, and churn (:func:`net_to_gross`)."""
    base = tx.select("account", "token", "timestamp", "transaction_hash", "event_type")

    def follows(first, second, seconds):
        return lambda p, r: F.when((p["event_type"] == first) & (r["event_type"] == second)
                                   & (gap_us(p["timestamp"], r["timestamp"]) <= seconds * 1_000_000), 1)

    same = lambda p, r: F.when((p["event_type"] == r["event_type"]) & (gap_us(p["timestamp"], r["timestamp"]) <= repeat_seconds * 1_000_000), 1)
    m = adjacent(base, ["account", "token"], {"rapid_cycles": ("sum", follows("Mint", "Redeem", cycle_seconds)),
                                              "flash_like": ("sum", follows("Borrow", "RepayBorrow", flash_seconds))},
                 tiebreak=("transaction_hash",), carry=("event_type",), by="account")
    r = adjacent(base, "account", {"repeats": ("sum", same)}, tiebreak=("transaction_hash",), carry=("event_type",))
    zero = F.lit(0).cast("long")
    both = m.join(r, "account").select(F.col("account").alias("wallet"), *[F.coalesce(c, zero).alias(c) for c in ("rapid_cycles", "flash_like", "repeats")])
    return both.join(net_to_gross(tx), "wallet")


def net_to_gross(tx: DataFrame, seconds: int = 3600, churn: float = 0.1) -> DataFrame:
    """Per wallet, over the hours that end at its events, by market: ``churn_hours``,
    those in which value went both in (supplied, repaid) and out (redeemed,
    borrowed) and the net flow is at most ``churn`` of the gross flow, and
    ``min_net_to_gross``, the least such ratio of hours with flow both ways."""
    m = moves(tx)
    zero = F.lit(0).cast(EXACT)
    put = F.greatest(F.col("supply_usd"), zero) + F.greatest(-F.col("debt_usd"), zero)
    took = F.greatest(-F.col("supply_usd"), zero) + F.greatest(F.col("debt_usd"), zero)
    h = rolling_sums(m.select("account", "token", "timestamp", put.alias("_in"), took.alias("_out")), ["account", "token"], {"inflow": F.col("_in"), "outflow": F.col("_out")}, seconds)
    net, gross = F.abs(F.col("inflow") - F.col("outflow")).cast("double"), (F.col("inflow") + F.col("outflow")).cast("double")
    ratio = F.when((F.col("inflow") > 0) & (F.col("outflow") > 0), net / gross)
    return h.withColumn("_r", ratio).groupBy(F.col("account").alias("wallet")).agg(
        F.count_if(F.col("_r") <= churn).alias("churn_hours"), F.min("_r").alias("min_net_to_gross"))


# ------------------------------------------------------------------ D13
def wallet_clusters(z: DataFrame, cols, k: int = 4, seed: int = C.SEED):
    """KMeans on standardised features: ``wallet, cluster`` and the clustering's
    ``silhouette`` on each row."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler
    v = VectorAssembler(inputCols=list(cols), outputCol="features").transform(z)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(v)
    pred = model.transform(v)
    sil = ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(pred)
    return pred.select("wallet", "cluster", F.lit(float(sil)).alias("silhouette"))


# ------------------------------------------------------------------ D15
def weight_sensitivity(weighted: DataFrame, weights: dict, step: float = 0.1) -> DataFrame:
    """For each weighted feature, scale its weight by (1 +/- step) and compare the
    scores with the base ones: rank correlation (Spearman, ties share their mean
    rank), correlation of the scores and mean absolute change.  ``weighted``
    carries ``wallet``, ``raw_score`` and ``feature_contributions`` (vector mode).

    All perturbed scores are one long (name, value) table, ranked in one pass by
    ``value_positions``: no window or sort over all wallets."""
    avail = {f: w for f, w in weights.items() if w != 0}
    total = sum(abs(w) for w in weights.values())
    c = lambda f: F.coalesce(F.col("feature_contributions").getItem(f), F.lit(0.0))
    base_sum = F.col("raw_score") * F.lit(total)
    scores = {("", ""): F.col("raw_score")}
    for f, w in avail.items():
        for sign, tag in ((1, "up"), (-1, "down")):
            s = 1 + sign * step
            scores[f, tag] = (base_sum - c(f) + c(f) * F.lit(s)) / F.lit(total - abs(w) + abs(w) * s)
    each = F.explode(F.array(*[F.struct(F.lit(f"{f}/{t}").alias("name"), v.alias("v")) for (f, t), v in scores.items()])).alias("e")
    # Ranked by 12 digits, so that two ways to the same score tie.
    long = stage(weighted.select("raw_score", each).select(F.round("raw_score", 12).alias("base"), "e.name", "e.v", F.round("e.v", 12).alias("value")))
    ranks = stage(value_positions(long.select("name", "value"), "value", ["name"]).select("name", "value", (F.col("pos") + (F.col("cnt") - 1) / 2.0).alias("rank")))
    base = ranks.where(F.col("name") == "/").select(F.col("value").alias("base"), F.col("rank").alias("base_rank"))
    both = long.where(F.col("name") != "/").join(ranks, ["name", "value"]).join(base, "base")
    out = both.groupBy("name").agg(safe_corr("base_rank", "rank").alias("rank_correlation"), F.avg(F.abs(F.col("rank") - F.col("base_rank"))).alias("mean_rank_change"),
                                   safe_corr("base", "v").alias("correlation"), F.avg(F.abs(F.col("v") - F.col("base"))).alias("mean_abs_change"))
    name = F.split("name", "/")
    return out.select(name[0].alias("feature"), name[1].alias("direction"), "rank_correlation", "mean_rank_change", "correlation", "mean_abs_change")


def score_drift(before: DataFrame, after: DataFrame, bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """Population stability index between two final-score distributions over
    ``bins`` equal-width score bins, plus the L1 histogram distance."""
    b = lambda df, tag: df.select(F.least(F.lit(bins - 1), (F.col("final_score") * bins / 101).cast("int")).alias("bin")) \
        .groupBy("bin").agg(F.count(F.lit(1)).alias(tag))
    h = b(before, "nb").join(b(after, "na"), "bin", "full_outer").fillna(0, ["nb", "na"])
    tot = h.agg(F.sum("nb").alias("tb"), F.sum("na").alias("ta"))
    h = h.crossJoin(F.broadcast(tot)).select(
        (F.col("nb") / F.col("tb") + F.lit(eps)).alias("p"), (F.col("na") / F.col("ta") + F.lit(eps)).alias("q"))
    return h.agg(F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))).alias("psi"),
                 F.sum(F.abs(F.col("q") - F.col("p"))).alias("l1_distance"))
