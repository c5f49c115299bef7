"""Scoring settings.

The numbers in the FIXED VALUES block must equal the reference's for the
scores to match; they are stated as plain data.  Everything else is a
parameter with the reference's value as default.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference for equal results)
# ---------------------------------------------------------------------------
# Feature weights of the heuristic score, in the reference's order.  Nine of
# them name columns the reference never produces; absent names are ignored.
FEATURE_WEIGHTS = {
    "tx_count_total": 0.2,
    "borrow_to_supply_ratio_vol": -0.3,
    "repay_ratio": 0.4,
    "account_age_days": 0.3,
    "days_since_last_tx": -0.2,
    "activity_consistency_stddev": -0.2,
    "avg_ltv_90d": -0.5,
    "min_ltv_alltime": -0.3,
    "liquidation_count_borrower": -0.8,
    "liquidation_count_liquidator": 0.0,
    "time_near_liquidation_pct": -0.6,
    "market_diversity_count": 0.3,
    "comp_earned_estimate_ratio": -0.1,
    "avg_gas_price_relative": 0.1,
    "complex_action_freq": 0.1,
    "anomaly_score": -0.7,
}
# Rule adjustments: liquidation penalty 0.1 per liquidation capped at 0.5;
# good repayer bonus 0.1 when repay_ratio > 0.9 and no liquidation; high LTV
# penalty 0.1 when max_ltv_alltime > 0.9; consistency bonus 0.05 when
# account_age_days > 180 and activity_consistency_stddev < 5; inactivity
# penalty 0.05 per 30 days capped at 0.25 when days_since_last_tx > 90.
LIQUIDATION_STEP, LIQUIDATION_CAP = 0.1, 0.5
GOOD_REPAY_RATIO, GOOD_REPAY_BONUS = 0.9, 0.1
HIGH_LTV_LIMIT, HIGH_LTV_PENALTY = 0.9, 0.1
CONSISTENT_AGE_DAYS, CONSISTENT_STDDEV, CONSISTENCY_BONUS = 180, 5, 0.05
INACTIVE_DAYS, INACTIVE_STEP, INACTIVE_PERIOD_DAYS, INACTIVE_CAP = 90, 0.05, 30, 0.25
# Neutral anomaly score for wallets without one.
NEUTRAL_ANOMALY = 0.5
# Anomaly detection: contamination 0.05, 100 trees, seed 42, PCA to <= 10 dims.
CONTAMINATION, N_TREES, SEED, MAX_PCA_COMPONENTS = 0.05, 100, 42, 10
#: Spark ML forests keep the node that a row has reached in each tree instead of going
#: there from the root on every level: the same trees, in half the time at depth 10.
FOREST_PASSES = {"cacheNodeIds": True, "checkpointInterval": -1}
# Final score: percentile method, reverse flag on, sigmoid k=1 x0=0, top 1000.
SCORING_METHOD, SCORING_REVERSE, SIGMOID_K, SIGMOID_X0, TOP_N = "percentile", True, 1.0, 0.0, 1000
# Time windows named by the reference (days; None = lifetime).
TIME_WINDOWS = {"lifetime": None, "90d": 90, "30d": 30}
# Score bands of the methodology: high >= 80, medium >= 40, else low.
BAND_HIGH, BAND_MEDIUM = 80, 40
# ---------------------------------------------------------------------------

# Explicit clock used instead of "now" (FIXTURES: literal as_of).
DEFAULT_AS_OF = _dt.datetime(2024, 4, 15, 0, 0, 0)


@dataclass(frozen=True)
class ScoringConfig:
    weights: dict = field(default_factory=lambda: dict(FEATURE_WEIGHTS))
    method: str = SCORING_METHOD
    reverse: bool = SCORING_REVERSE
    sigmoid_k: float = SIGMOID_K
    sigmoid_x0: float = SIGMOID_X0
    top_n: int = TOP_N
    optimize: bool = True          # vector mode + full rule set (reference default)
    as_of: _dt.datetime = DEFAULT_AS_OF
