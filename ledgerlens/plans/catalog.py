"""Registered queries: Spark implementation + DuckDB oracle SQL per key.

Every query reads the driver tables (through the FIXTURES adapter) and runs
over whole tables.  ``QUERIES[name](spark, sf_dir) -> DataFrame``;
``ORACLES[name]`` is the SQL that DuckDB runs on the same parquet views.
Floating columns are rounded to 6 digits and timestamps are emitted as
TIMESTAMP_NTZ on both sides.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.functions.columns import (coerce_amount, normalize_event_type, parse_timestamp,
                                          standardize_address)
from ledgerlens.operators import clean as CL
from ledgerlens.operators import features as FE
from ledgerlens.operators import scoring as SC
from ledgerlens.operators.ordered import with_neighbors
from ledgerlens.operators.ranking import exact_medians
from ledgerlens.plans import oracle as O
from ledgerlens.plans import pipeline as P
from ledgerlens.sources.adapters import read_table, transactions
from ledgerlens.session import use_utc

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = O.count_filter(sql)
        return fn
    return deco


def out(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, emit timestamps as TIMESTAMP_NTZ (engine-neutral output)."""
    conv = {}
    for c, t in df.dtypes:
        if t in ("double", "float"):
            conv[c] = F.round(F.col(c), digits)
        elif t == "timestamp":
            conv[c] = F.col(c).cast("timestamp_ntz")
    return df.withColumns(conv) if conv else df


# ---------------------------------------------------------------- helpers
def _tx(spark, sf, source="events_sparse"):
    return P.cleaned(spark, sf, source)


def _feats(spark, sf, source="events_sparse", optimize=True, liquidation_mode="compat"):
    return P.features(_tx(spark, sf, source), optimize=optimize, liquidation_mode=liquidation_mode)


def _scored(spark, sf, source="events_sparse", optimize=True):
    return P.scores(_feats(spark, sf, source, optimize), optimize=optimize)


def _final(spark, sf, method="percentile", source="events_sparse", optimize=True):
    """Final scores, staged: a query that uses them several times computes them once."""
    return P.stage(SC.final_score(_scored(spark, sf, source, optimize), method), P.STAGE_MODE)


FEATURE_DOUBLES = ["wallet_age_days", "borrow_to_supply_ratio_count", "borrow_to_supply_ratio_vol",
                   "repay_ratio", "days_since_last_tx"] + O.TEMPORAL
TX_COLS = ["event_type", "timestamp", "transaction_hash", "account", "liquidator", "token", "ctoken",
           "amount", "amountusd"]


def _fsel(cols_double, all_cols):
    return ", ".join(f"round({c}, 6) AS {c}" if c in cols_double else c for c in all_cols)


# ---------------------------------------------------------------- S9 / U1
@register("scan_transactions", O.with_ctes(
    f"tx AS ({O.tx_sql()})", f"SELECT {_fsel(['amount', 'amountusd'], TX_COLS)} FROM tx"))
def q_scan_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return out(transactions(spark, sf, "events_sparse").select(*TX_COLS))


@register("union_sources", O.with_ctes(
    f"a AS ({O.tx_sql('events_sparse')}), b AS ({O.tx_sql('orders')})",
    "SELECT account, event_type, round(amount, 6) AS amount, round(amountusd, 6) AS amountusd, source FROM ("
    "SELECT account, event_type, amount, amountusd, 'events' AS source FROM a UNION ALL "
    "SELECT account, event_type, amount, NULL AS amountusd, 'orders' AS source FROM b)"))
def q_union_sources(spark, sf):
    a = transactions(spark, sf, "events_sparse").select("account", "event_type", "amount", "amountusd") \
        .withColumn("source", F.lit("events"))
    b = transactions(spark, sf, "orders").select("account", "event_type", "amount") \
        .withColumn("source", F.lit("orders"))
    return out(a.unionByName(b, allowMissingColumns=True).select("account", "event_type", "amount",
                                                                  "amountusd", "source"))


# ---------------------------------------------------------------- P5, P6, P8, P9
_ADDR_RAW_SPARK = lambda: F.concat(
    F.when(F.col("event_id") % 3 == 0, F.lit("0X")).otherwise(F.lit("0x")),
    F.upper(F.md5(F.col("event_id").cast("string"))))


@register("standardize_address", """SELECT event_id, raw, lower(regexp_replace(raw, '^0x', '')) AS address FROM (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '0X' ELSE '0x' END || upper(md5(CAST(event_id AS VARCHAR))) AS raw
  FROM events)""")
def q_standardize_address(spark, sf):
    e = read_table(spark, sf, "events").select("event_id", _ADDR_RAW_SPARK().alias("raw"))
    return e.select("event_id", "raw", standardize_address("raw").alias("address"))


@register("parse_timestamp", """SELECT event_id, raw,
  COALESCE(make_timestamp(CAST(TRY_CAST(raw AS DOUBLE) * 1000000 AS BIGINT)), TRY_CAST(raw AS TIMESTAMP)) AS parsed
FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'n/a'
  WHEN event_id % 2 = 0 THEN CAST(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS VARCHAR)
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS raw FROM events)""")
def q_parse_timestamp(spark, sf):
    use_utc(spark)
    e = read_table(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    raw = (F.when(F.col("event_id") % 7 == 0, F.lit("n/a"))
            .when(F.col("event_id") % 2 == 0, F.floor(F.unix_micros(ts) / 1000000).cast("bigint").cast("string"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")))
    e = e.select("event_id", raw.alias("raw"))
    return out(e.select("event_id", "raw", parse_timestamp("raw").alias("parsed")))


def _raw_event_spark():
    from ledgerlens.sources.adapters import _event_map
    c = _event_map(F.col("event_type"))
    return (F.when(F.col("event_id") % 3 == 0, F.upper(c))
             .when(F.col("event_id") % 3 == 1, F.concat(F.lit(" "), F.lower(c), F.lit("\t")))
             .otherwise(F.col("event_type")))


@register("normalize_event_type", f"""SELECT event_id, raw, {O.norm_event_sql('raw')} AS event_type FROM (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN upper({O.ev_case('event_type')})
    WHEN event_id % 3 = 1 THEN ' ' || lower({O.ev_case('event_type')}) || chr(9)
    ELSE event_type END AS raw FROM events)""")
def q_normalize_event_type(spark, sf):
    e = read_table(spark, sf, "events").select("event_id", _raw_event_spark().alias("raw"))
    return e.select("event_id", "raw", normalize_event_type("raw").alias("event_type"))


@register("coerce_amounts", """SELECT event_id, round(TRY_CAST(raw AS DOUBLE), 6) AS amount FROM (
  SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'n/a' ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || 'e-2' END AS raw
  FROM events)""")
def q_coerce_amounts(spark, sf):
    e = read_table(spark, sf, "events")
    raw = F.when(F.col("event_id") % 11 == 0, F.lit("n/a")).otherwise(
        F.concat(F.round(F.col("value") * 100).cast("bigint").cast("string"), F.lit("e-2")))
    return out(e.select("event_id", coerce_amount(raw).alias("amount")))


# ---------------------------------------------------------------- F1, F2, F9
@register("clean_transactions", O.with_ctes(
    f"tx AS ({O.tx_sql()}), clean AS ({O.clean_sql('tx')})",
    f"SELECT {_fsel(['amount', 'amountusd'], TX_COLS)} FROM clean"))
def q_clean_transactions(spark, sf):
    return out(_tx(spark, sf).select(*TX_COLS))


@register("null_profile", """SELECT CAST(count_if(raw_ts IS NULL) AS BIGINT) AS missing_timestamp, CAST(count_if(account IS NULL) AS BIGINT) AS missing_account,
  CAST(count_if(event_type IS NULL) AS BIGINT) AS missing_event_type, count(*) AS row_count FROM (
  SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS raw_ts,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS account,
    CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type FROM events)""")
def q_null_profile(spark, sf):
    e = read_table(spark, sf, "events").select(
        F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("ts")).alias("timestamp"),
        F.when(F.col("event_id") % 13 == 0, F.lit(None)).otherwise(F.col("user_id").cast("string")).alias("account"),
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("event_type")).alias("event_type"))
    return CL.null_profile(e)


# ---------------------------------------------------------------- A1-A6, J9
_ACT_CTES = f"tx AS ({O.tx_sql()}), clean AS ({O.clean_sql('tx')}), act AS ({O.activity_sql('clean')})"
SUMMARY = ["wallet", "first_tx_timestamp", "last_tx_timestamp", "tx_count", "wallet_age_days", "mint_count",
           "redeem_count", "borrow_count", "repay_count", "liquidation_count", "market_count"]


@register("wallet_summary", O.with_ctes(_ACT_CTES, f"SELECT {_fsel(FEATURE_DOUBLES, SUMMARY)} FROM act"))
def q_wallet_summary(spark, sf):
    return out(FE.wallet_summary(_tx(spark, sf)))


@register("market_count", O.with_ctes(_ACT_CTES, "SELECT wallet, market_count FROM act"))
def q_market_count(spark, sf):
    return FE.market_counts(_tx(spark, sf))


ACTIVITY = ["wallet", "borrow_to_supply_ratio_count", "borrow_to_supply_ratio_vol", "repay_ratio",
            "liquidation_count_borrower", "liquidation_count_liquidator"]


@register("wallet_activity", O.with_ctes(_ACT_CTES, f"SELECT {_fsel(FEATURE_DOUBLES, ACTIVITY)} FROM act"))
def q_wallet_activity(spark, sf):
    return out(FE.wallet_activity(_tx(spark, sf)).select(*ACTIVITY))


@register("liquidation_roles", O.with_ctes(
    f"tx AS ({O.tx_sql('events_dense')}), clean AS ({O.clean_sql('tx')}), "
    f"a AS ({O.activity_sql('clean')}), b AS ({O.activity_sql('clean', 'corrected')})",
    "SELECT a.wallet, a.liquidation_count_borrower, a.liquidation_count_liquidator, "
    "b.liquidation_count_liquidator AS liquidation_count_liquidator_corrected FROM a JOIN b USING (wallet)"))
def q_liquidation_roles(spark, sf):
    tx = _tx(spark, sf, "events_dense")
    a = FE.wallet_activity(tx, "compat").select("wallet", "liquidation_count_borrower",
                                                "liquidation_count_liquidator")
    # The corrected mode differs in this count alone, so the activity is aggregated once.
    b = FE.liquidator_counts(tx).withColumnRenamed("liquidation_count_liquidator", "_performed")
    return a.join(b, "wallet", "left").select(
        *a.columns, F.coalesce("_performed", F.lit(0).cast("long")).alias("liquidation_count_liquidator_corrected"))


# ---------------------------------------------------------------- W1, A7, A8, P10
@register("tx_intervals", O.with_ctes(
    f"tx AS ({O.tx_sql()}), clean AS ({O.clean_sql('tx')})",
    f"""SELECT account, transaction_hash, round({O.days('"timestamp"', 'nxt')}, 6) AS gap_days FROM (
  SELECT account, transaction_hash, "timestamp",
    lead("timestamp") OVER (PARTITION BY account ORDER BY "timestamp", transaction_hash) AS nxt FROM clean)"""))
def q_tx_intervals(spark, sf):
    from ledgerlens.functions.columns import day_diff
    t = with_neighbors(_tx(spark, sf).select("account", "transaction_hash", "timestamp"),
                       "account", "timestamp", tiebreak=("transaction_hash",))
    return out(t.select("account", "transaction_hash", day_diff("timestamp", "next_ts").alias("gap_days")))


@register("wallet_temporal", O.with_ctes(
    f"tx AS ({O.tx_sql()}), clean AS ({O.clean_sql('tx')}), t AS ({O.temporal_sql('clean')})",
    f"SELECT wallet, {O.r6(O.TEMPORAL)} FROM t"))
def q_wallet_temporal(spark, sf):
    return out(FE.temporal_features(_tx(spark, sf), optimize=True))


@register("wallet_temporal_samp", O.with_ctes(
    f"tx AS ({O.tx_sql()}), clean AS ({O.clean_sql('tx')}), t AS ({O.temporal_sql('clean', False)})",
    f"SELECT wallet, {O.r6(O.TEMPORAL[:4])} FROM t"))
def q_wallet_temporal_samp(spark, sf):
    return out(FE.temporal_features(_tx(spark, sf), optimize=False))


@register("wallet_recency", O.with_ctes(
    _ACT_CTES, f"SELECT wallet, round(wallet_age_days, 6) AS wallet_age_days, "
               f"round({O.days('last_tx_timestamp', O.AS_OF_SQL)}, 6) AS days_since_last_tx FROM act"))
def q_wallet_recency(spark, sf):
    from ledgerlens.functions.columns import day_diff, ts_literal
    s = FE.wallet_summary(_tx(spark, sf))
    return out(s.select("wallet", "wallet_age_days",
                        day_diff("last_tx_timestamp", ts_literal(C.DEFAULT_AS_OF)).alias("days_since_last_tx")))


# ---------------------------------------------------------------- A10, J1, J2
@register("wallet_features", O.with_ctes(
    O.features_ctes(), f"SELECT {_fsel(FEATURE_DOUBLES, O.FEATURE_COLS)} FROM feat"))
def q_wallet_features(spark, sf):
    return out(_feats(spark, sf))


@register("impute_features", O.with_ctes(
    O.features_ctes(), "SELECT " + ", ".join(f"round(m_{c}, 6) AS {c}" for c in O.TEMPORAL) + " FROM med"))
def q_impute_features(spark, sf):
    raw = P.stage(FE.raw_wallet_features(_tx(spark, sf)), P.STAGE_MODE)
    return out(exact_medians(raw, O.TEMPORAL))


# ---------------------------------------------------------------- A9, J3, H1, H2, P15
_W_COLS = O.FEATURE_COLS + ["anomaly_score"]
_AVAIL = O.available(_W_COLS)


@register("feature_profile", O.with_ctes(
    f"{O.features_ctes()}, sc0 AS (SELECT *, {O.d(O.C.NEUTRAL_ANOMALY)} AS anomaly_score FROM feat)",
    "SELECT " + ", ".join(f"round(CAST(min({f}) AS DOUBLE), 6) AS min__{f}, round(CAST(max({f}) AS DOUBLE), 6) AS max__{f}, "
                          f"round(avg({f}), 6) AS mean__{f}" for f in _AVAIL) + " FROM sc0"))
def q_feature_profile(spark, sf):
    s = SC.prepare_scoring(_feats(spark, sf))
    return out(SC.feature_stats(s, SC.available_weights(s)))


@register("prepare_scoring", O.with_ctes(
    f"{O.features_ctes()}, sc0 AS (SELECT *, {O.d(O.C.NEUTRAL_ANOMALY)} AS anomaly_score FROM feat)",
    f"SELECT {_fsel(FEATURE_DOUBLES + ['anomaly_score'], _W_COLS)} FROM sc0"))
def q_prepare_scoring(spark, sf):
    return out(SC.prepare_scoring(_feats(spark, sf)))


_SC_CTES = (f"{O.features_ctes()}, sc0 AS (SELECT *, {O.d(O.C.NEUTRAL_ANOMALY)} AS anomaly_score FROM feat), "
            f"{O.scoring_ctes(_W_COLS)}")


@register("score_weighted", O.with_ctes(_SC_CTES, "SELECT wallet, round(raw_score, 6) AS raw_score FROM weighted"))
def q_score_weighted(spark, sf):
    return out(SC.weighted_score(SC.prepare_scoring(_feats(spark, sf))).select("wallet", "raw_score"))


@register("score_weighted_rowmode", O.with_ctes(
    f"{O.features_ctes()}, sc0 AS (SELECT *, {O.d(O.C.NEUTRAL_ANOMALY)} AS anomaly_score FROM feat), "
    f"{O.scoring_ctes(_W_COLS, optimize=False)}",
    "SELECT wallet, round(raw_score, 6) AS raw_score FROM weighted"))
def q_score_weighted_rowmode(spark, sf):
    s = SC.weighted_score(SC.prepare_scoring(_feats(spark, sf)), optimize=False)
    return out(s.select("wallet", "raw_score"))


@register("score_contributions", O.with_ctes(
    _SC_CTES, "SELECT wallet, feature, round(contribution, 6) AS contribution FROM ("
    + " UNION ALL ".join(f"SELECT wallet, '{f}' AS feature, c_{f} AS contribution FROM weighted" for f in _AVAIL)
    + ") WHERE contribution IS NOT NULL"))
def q_score_contributions(spark, sf):
    s = SC.weighted_score(SC.prepare_scoring(_feats(spark, sf)))
    e = s.select("wallet", F.explode("feature_contributions").alias("feature", "contribution"))
    return out(e)


# ---------------------------------------------------------------- H3-H8
_ADJ_KEYS = ["liquidation_penalty", "good_repayer_bonus", "consistency_bonus", "inactivity_penalty"]


@register("score_adjustments", O.with_ctes(
    f"{_SC_CTES}, {O.adjust_ctes(_W_COLS)}",
    "SELECT wallet, round(raw_score, 6) AS raw_score, "
    + ", ".join(f"round(a_{k}, 6) AS {k}" if O.rule_applies(k, _W_COLS) else f"CAST(NULL AS DOUBLE) AS {k}"
                for k in _ADJ_KEYS) + " FROM adjusted"))
def q_score_adjustments(spark, sf):
    s = _scored(spark, sf)
    return out(s.select("wallet", "raw_score",
                        *[F.col("adjustments").getItem(k).alias(k) for k in _ADJ_KEYS]))


_BASIC_COLS = [c for c in _W_COLS if c != "activity_consistency_cv"]


@register("score_adjustments_basic", O.with_ctes(
    f"{O.features_ctes(optimize=False)}, sc0 AS (SELECT *, {O.d(O.C.NEUTRAL_ANOMALY)} AS anomaly_score FROM feat), "
    f"{O.scoring_ctes(_BASIC_COLS, optimize=False)}, {O.adjust_ctes(_BASIC_COLS, optimize=False)}",
    "SELECT wallet, round(raw_score, 6) AS raw_score FROM adjusted"))
def q_score_adjustments_basic(spark, sf):
    s = _scored(spark, sf, optimize=False)
    return out(s.select("wallet", "raw_score"))


# ---------------------------------------------------------------- H9-H11, H13, H15, W2, P13, P14
@register("score_percentile", O.with_ctes(O.pipeline_ctes(), "SELECT wallet, final_score FROM fin"))
def q_score_percentile(spark, sf):
    return _final(spark, sf, "percentile").select("wallet", "final_score")


@register("score_minmax", O.with_ctes(O.pipeline_ctes(method="min_max"), "SELECT wallet, final_score FROM fin"))
def q_score_minmax(spark, sf):
    return _final(spark, sf, "min_max").select("wallet", "final_score")


@register("score_sigmoid", O.with_ctes(O.pipeline_ctes(method="sigmoid"), "SELECT wallet, final_score FROM fin"))
def q_score_sigmoid(spark, sf):
    return _final(spark, sf, "sigmoid").select("wallet", "final_score")


@register("wallet_scores", O.with_ctes(
    O.pipeline_ctes(), f"SELECT {_fsel(FEATURE_DOUBLES + ['anomaly_score', 'raw_score'], _W_COLS + ['raw_score'])} "
                       "FROM adjusted"))
def q_wallet_scores(spark, sf):
    return out(_scored(spark, sf).drop("feature_contributions", "adjustments"))


@register("final_scores", O.with_ctes(
    O.pipeline_ctes(), "SELECT wallet, round(raw_score, 6) AS raw_score, final_score FROM fin"))
def q_final_scores(spark, sf):
    return out(_final(spark, sf).select("wallet", "raw_score", "final_score"))


@register("top_wallets", O.with_ctes(
    O.pipeline_ctes(), f"SELECT wallet, final_score AS score FROM fin ORDER BY final_score DESC, wallet ASC "
                       f"LIMIT {O.C.TOP_N}"))
def q_top_wallets(spark, sf):
    return SC.top_wallets(_final(spark, sf), C.TOP_N)


# ---------------------------------------------------------------- A11-A13, H14, U4, D14
from ledgerlens.operators import analysis as AN  # noqa: E402


@register("score_distribution", O.with_ctes(
    O.pipeline_ctes(), "SELECT final_score, count(*) AS wallets FROM fin GROUP BY final_score"))
def q_score_distribution(spark, sf):
    return AN.score_distribution(_final(spark, sf))


@register("score_overall", O.with_ctes(
    O.pipeline_ctes(), "SELECT count(*) AS wallets, min(final_score) AS min_score, max(final_score) AS max_score, "
                       "round(avg(final_score), 6) AS mean_score, round(CAST(median(final_score) AS DOUBLE), 6) "
                       "AS median_score FROM fin"))
def q_score_overall(spark, sf):
    return out(AN.score_overall(_final(spark, sf)))


def _corr_sql(a, b):
    return (f"covar_pop(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) / "
            f"NULLIF(stddev_pop(CAST({a} AS DOUBLE)) * stddev_pop(CAST({b} AS DOUBLE)), 0)")


@register("score_feature_corr", O.with_ctes(
    O.pipeline_ctes(), "SELECT feature, round(correlation, 6) AS correlation FROM (" + " UNION ALL ".join(
        f"SELECT '{n}' AS feature, {_corr_sql('final_score', n)} AS correlation FROM fin"
        for n in AN.CORR_FEATURES) + ")"))
def q_score_feature_corr(spark, sf):
    return out(AN.score_feature_corr(_final(spark, sf)))


_TB_COLS = ["wallet", "wallet_prefix", "group", "final_score", "raw_score"] + AN.KEY_FEATURES


@register("top_bottom_wallets", O.with_ctes(
    O.pipeline_ctes(),
    "SELECT wallet, substr(wallet, 1, 10) AS wallet_prefix, \"group\", final_score, round(raw_score, 6) AS raw_score, "
    "tx_count, round(wallet_age_days, 6) AS wallet_age_days, market_count, liquidation_count_borrower FROM ("
    "(SELECT *, 'top' AS \"group\" FROM fin ORDER BY final_score DESC, wallet ASC LIMIT 5) UNION ALL "
    "(SELECT *, 'bottom' AS \"group\" FROM fin ORDER BY final_score ASC, wallet DESC LIMIT 5))"))
def q_top_bottom_wallets(spark, sf):
    return out(AN.top_bottom_analysis(_final(spark, sf), n=5))


def _full_analysis_sql():
    cols = [c for c in _W_COLS if c not in ("wallet", "first_tx_timestamp", "last_tx_timestamp")]
    item = lambda kind, name, value: f"SELECT wallet, \"group\", final_score, raw_score, '{kind}' AS part, '{name}' AS name, CAST({value} AS DOUBLE) AS value FROM sel"
    rows = [item("feature", c, c) for c in cols] + [item("contribution", f, f"c_{f}") for f in _AVAIL]
    rows += [item("adjustment", k, f"a_{k}") for k in _ADJ_KEYS if O.rule_applies(k, _W_COLS)]
    return O.with_ctes(O.pipeline_ctes() + """, sel AS ((SELECT *, 'top' AS "group" FROM fin ORDER BY final_score DESC, wallet ASC LIMIT 5) UNION ALL
  (SELECT *, 'bottom' AS "group" FROM fin ORDER BY final_score ASC, wallet DESC LIMIT 5))""",
        "SELECT wallet, \"group\", final_score, round(raw_score, 6) AS raw_score, part, name, round(value, 6) AS value FROM (" + " UNION ALL ".join(rows) + ") WHERE value IS NOT NULL")


@register("analysis_table", _full_analysis_sql())
def q_analysis_table(spark, sf):
    """H14 whole: all features, both maps and the anomaly score of the selected wallets."""
    return out(AN.full_analysis(_final(spark, sf)))


@register("score_passthrough", O.with_ctes(O.pipeline_ctes(), "SELECT wallet, final_score AS credit_score, final_score FROM fin"))
def q_score_passthrough(spark, sf):
    """Scores that are there already are passed through."""
    given = _final(spark, sf).select("wallet", F.col("final_score").alias("credit_score"))
    return SC.final_score(given)


@register("weight_availability", "SELECT * FROM (VALUES " + ", ".join(f"('{f}', {O.d(w)}, {'TRUE' if f in _W_COLS else 'FALSE'})" for f, w in O.C.FEATURE_WEIGHTS.items())
          + ") v(feature, weight, available)")
def q_weight_availability(spark, sf):
    """which weights find their feature in the table of this data."""
    return SC.weight_availability(SC.prepare_scoring(_feats(spark, sf)))


@register("run_counters", O.with_ctes(
    O.pipeline_ctes(), "SELECT 'load' AS stage, 'rows' AS counter, count(*) AS value FROM clean UNION ALL SELECT 'load', 'rows_' || e, count(clean.event_type) FROM (VALUES "
    + ", ".join(f"('{e}')" for e in O.EVENT_TYPES) + ") v(e) LEFT JOIN clean ON event_type = e GROUP BY e "
    + " ".join(f"UNION ALL SELECT '{s}', 'rows', count(*) FROM fin" for s in ("features", "scores", "final"))))
def q_run_counters(spark, sf):
    """What each stage of a run counts while it writes its table."""
    seen = P.run_stages(spark, sf, _scratch(spark, "run"), with_anomaly=False)["counters"]
    return spark.createDataFrame([(stage, k, int(v)) for stage, c in seen.items() for k, v in c.items()], "stage string, counter string, value long")


@register("dedup_wallets", O.with_ctes(
    O.pipeline_ctes(), "SELECT DISTINCT wallet, final_score FROM (SELECT wallet, final_score FROM fin UNION ALL "
                       "(SELECT wallet, final_score FROM fin ORDER BY final_score DESC, wallet LIMIT 5))"))
def q_dedup_wallets(spark, sf):
    fin = _final(spark, sf).select("wallet", "final_score")
    both = fin.unionByName(AN.top_and_bottom(fin, 5).where(F.col("group") == "top").drop("group"))
    return AN.dedup_wallets(both)


@register("score_bands", O.with_ctes(
    O.pipeline_ctes(), f"SELECT wallet, final_score, CASE WHEN final_score >= {O.C.BAND_HIGH} THEN 'high' "
                       f"WHEN final_score >= {O.C.BAND_MEDIUM} THEN 'medium' ELSE 'low' END AS band, "
                       "CASE WHEN final_score >= 80 THEN 'A' WHEN final_score >= 60 THEN 'B' "
                       "WHEN final_score >= 40 THEN 'C' WHEN final_score >= 20 THEN 'D' ELSE 'F' END AS grade FROM fin"))
def q_score_bands(spark, sf):
    return AN.score_bands(_final(spark, sf))


@register("final_scores_orders", O.with_ctes(
    O.pipeline_ctes("orders"), "SELECT wallet, round(raw_score, 6) AS raw_score, final_score FROM fin"))
def q_final_scores_orders(spark, sf):
    """Whole pipeline on the lineitem x orders source (many timestamp ties)."""
    return out(_final(spark, sf, source="orders").select("wallet", "raw_score", "final_score"))


# ---------------------------------------------------------------- S1-S8, S10-S12 (files derived from the tables)
from ledgerlens.sources import files as FI  # noqa: E402
from ledgerlens.sources import sinks as SK  # noqa: E402
from ledgerlens.sources.layouts import few_listing_tasks  # noqa: E402
from ledgerlens.session import ensure_checkpoint_dir  # noqa: E402


def _scratch(spark, tag):
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/raw/{tag}-{uuid.uuid4().hex}"


def _list_files(spark, path, suffix):
    with few_listing_tasks(spark):
        return sorted(r["path"] for r in spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}")
                      .option("recursiveFileLookup", "true").load(path).select("path").collect())


_RT_COLS = ["event_type", "timestamp", "transaction_hash", "account", "token", "amount", "amountusd"]


@register("nested_json_roundtrip", O.with_ctes(
    f"tx AS ({O.tx_sql()}), clean AS ({O.clean_sql('tx')})",
    f"SELECT {_fsel(['amount', 'amountusd'], _RT_COLS)} FROM clean"))
def q_nested_json_roundtrip(spark, sf):
    """Tables -> raw nested JSON files -> format inference, nested parse,
    standardisation, multi-file union -> cleaning (S2, S5, S8, P1-P7, U1, U2)."""
    path = _scratch(spark, "nested")
    SK.write_nested_event_files(_tx(spark, sf), path)
    tx, _rejected = FI.load_and_process(spark, _list_files(spark, path, ".json"))
    return out(CL.clean_transactions(tx).select(*_RT_COLS))


@register("load_with_rejects", O.with_ctes(
    f"tx AS ({O.tx_sql()}), clean AS ({O.clean_sql('tx')})",
    "SELECT 'broken.json' AS rejected, count(*) AS transactions FROM clean"))
def q_load_with_rejects(spark, sf):
    """A file that is no JSON among good ones is skipped and reported, the
    others are loaded whole."""
    path = _scratch(spark, "rejects")
    t = _tx(spark, sf)
    SK.write_nested_event_files(t, f"{path}/good")
    t.select(F.lit("neither an array nor an object").alias("value")).limit(1).coalesce(1).write.text(f"{path}/bad/broken.json")
    tx, rejected = FI.load_and_process(spark, [*_list_files(spark, f"{path}/good", ".json"), f"{path}/bad/broken.json"])
    names = rejected.select(F.element_at(F.split("path", "/"), -1).alias("rejected"))
    return names.crossJoin(CL.clean_transactions(tx).agg(F.count(F.lit(1)).alias("transactions")))   # two one-row tables


_CSV_COLS = ["event_type", "timestamp", "transaction_hash", "account", "token", "ctoken", "amount"]


@register("csv_roundtrip", O.with_ctes(
    f"""tx AS (SELECT * REPLACE (CASE WHEN CAST(transaction_hash AS BIGINT) % 3 = 0 THEN upper(event_type)
        WHEN CAST(transaction_hash AS BIGINT) % 3 = 1 THEN ' ' || lower(event_type) || chr(9)
        ELSE lower(event_type) || 'x' END AS event_type) FROM ({O.tx_sql()})), clean AS ({O.clean_sql('tx')})""",
    f"SELECT {_fsel(['amount'], _CSV_COLS)} FROM clean"))
def q_csv_roundtrip(spark, sf):
    """Tables -> ';'-separated CSV with aliased headers and messy event names
    -> separator sniffing, alias resolution, per-row timestamp parsing,
    event normalisation (S3, P2, P6, P8, P9, F1, F2)."""
    t = transactions(spark, sf, "events_sparse")
    h = F.col("transaction_hash").cast("bigint")
    ev = (F.when(h % 3 == 0, F.upper("event_type"))
           .when(h % 3 == 1, F.concat(F.lit(" "), F.lower("event_type"), F.lit("\t")))
           .otherwise(F.concat(F.lower("event_type"), F.lit("x"))))
    raw = t.select(SK.epoch_seconds_text("timestamp").alias("block_timestamp"), F.col("account").alias("user"),
                   ev.alias("event"), F.col("transaction_hash").alias("tx_hash"), F.col("token").alias("asset"),
                   F.col("ctoken").alias("c_token"), F.col("amount").cast("string").alias("amount_decimal"))
    path = _scratch(spark, "csv")
    raw.write.option("header", True).option("sep", ";").csv(path)
    tx, _rejected = FI.load_and_process(spark, _list_files(spark, path, ".csv"))
    return out(CL.clean_transactions(tx).select(*_CSV_COLS))


_FLAT_SQL = O.with_ctes(f"tx AS ({O.tx_sql()}), clean AS ({O.clean_sql('tx')})", f"SELECT {_fsel(['amount'], _CSV_COLS)} FROM clean")


@register("json_arrays_roundtrip", _FLAT_SQL)
def q_json_arrays_roundtrip(spark, sf):
    """JSON arrays of flat events with aliased columns, in files whose name
    says nothing (S2)."""
    path = _scratch(spark, "arrays")
    SK.write_json_arrays(_tx(spark, sf), path, 2_000)
    tx, _ = FI.load_and_process(spark, _list_files(spark, path, ".txt"))
    return out(CL.clean_transactions(tx).select(*_CSV_COLS))


@register("json_by_event_roundtrip", _FLAT_SQL)
def q_json_by_event_roundtrip(spark, sf):
    """Objects keyed by event names."""
    path = _scratch(spark, "keyed")
    SK.write_json_by_event(_tx(spark, sf), path, 2_000)
    tx, _ = FI.load_and_process(spark, _list_files(spark, path, ".txt"))
    return out(CL.clean_transactions(tx).select(*_CSV_COLS))


@register("json_objects_roundtrip", O.with_ctes(
    f"tx AS ({O.tx_sql()}), clean AS ({O.clean_sql('tx')})",
    f"SELECT {_fsel(['amount'], _CSV_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY CAST(\"timestamp\" AS DATE), event_type ORDER BY \"timestamp\" DESC, transaction_hash DESC) AS k FROM clean) WHERE k = 1"))
def q_json_objects_roundtrip(spark, sf):
    """Files of one flat object each, the last event of each kind and day."""
    path = _scratch(spark, "objects")
    t = _tx(spark, sf)
    last = t.groupBy(F.to_date("timestamp"), "event_type").agg(F.max_by(F.struct(*t.columns), F.struct("timestamp", "transaction_hash")).alias("r")).select("r.*")
    SK.write_json_objects(last, path, "transaction_hash")
    tx, _ = FI.load_and_process(spark, _list_files(spark, path, ".txt"))
    return out(CL.clean_transactions(tx).select(*_CSV_COLS))


#: For files that name no event: what tells each kind, its account's column and one of its own.
_BY_COLUMN = {"Mint": ("minter", "mint_amount"), "Redeem": ("user", "redeem_amount"), "Borrow": ("borrower", "borrow_amount"),
              "RepayBorrow": ("payer", "repay_amount"), "LiquidateBorrow": ("user", "seized_amount")}


@register("csv_without_events", O.with_ctes(
    f"tx AS ({O.tx_sql()}), clean AS ({O.clean_sql('tx')})", f"SELECT {_fsel(['amount'], ['event_type', 'timestamp', 'account', 'token', 'amount'])} FROM clean"))
def q_csv_without_events(spark, sf):
    """Files without event names and hashes; the events come from the
    columns that only they have, file by file, in one load."""
    path = _scratch(spark, "by-column")
    t = _tx(spark, sf)
    for i, (ev, (account, own)) in enumerate(_BY_COLUMN.items()):
        part = t.where(F.col("event_type") == ev).select(SK.epoch_seconds_text("timestamp").alias("date"), F.col("account").alias(account), F.col("token").alias("underlying"),
                                                         F.col("amount").cast("string").alias("asset_amount"), F.lit("0").alias(own))
        part.write.option("header", True).option("sep", "|").csv(f"{path}/{i}")
    tx, _ = FI.load_and_process(spark, _list_files(spark, path, ".csv"))
    return out(CL.clean_transactions(tx).select("event_type", "timestamp", "account", "token", "amount"))


@register("csv_malformed_rows", O.with_ctes(
    f"tx AS ({O.tx_sql()}), clean AS ({O.clean_sql('tx')})",
    "SELECT transaction_hash, CAST(transaction_hash AS BIGINT) % 97 = 5 AS rejected, CASE WHEN CAST(transaction_hash AS BIGINT) % 97 <> 5 AND "
    "CAST(transaction_hash AS BIGINT) % 89 <> 7 THEN token END AS token FROM clean"))
def q_csv_malformed_rows(spark, sf):
    """Rows with a field too many are rejected one by one, rows with a field
    too few are filled; the rest of their files stays."""
    path = _scratch(spark, "malformed")
    h = F.col("transaction_hash").cast("bigint")
    line = F.concat_ws(",", "transaction_hash", "event_type", SK.epoch_seconds_text("timestamp"), "account", "amount",
                       F.when(h % 97 == 5, F.concat("token", F.lit(",surplus"))).when(h % 89 == 7, None).otherwise(F.col("token")))
    lines = _tx(spark, sf).repartition(4, "transaction_hash").select(line.alias("value"))

    def headed(rows):
        for i, b in enumerate(rows):
            if not i:
                yield pa.RecordBatch.from_arrays([pa.array(["transaction_hash,event_type,timestamp,account,amount,token"])], schema=b.schema)
            yield b

    lines.mapInArrow(headed, "value string").write.text(path)
    tx, rejected = FI.load_and_process(spark, _list_files(spark, path, ".txt"))
    kept = tx.select("transaction_hash", F.lit(False).alias("rejected"), "token")
    return kept.unionByName(rejected.select(F.split("record", ",")[0].alias("transaction_hash"), F.lit(True).alias("rejected"), F.lit(None).cast("string").alias("token")))


@register("sinks_roundtrip", O.with_ctes(
    _ACT_CTES, f"SELECT sink, {_fsel(['wallet_age_days'], ['wallet', 'tx_count', 'wallet_age_days'])} FROM act, (VALUES ('csv'), ('json'), ('parquet')) v(sink)"))
def q_sinks_roundtrip(spark, sf):
    """The summary as CSV, JSON and Parquet, read back."""
    path = _scratch(spark, "sinks")
    s = P.stage(FE.wallet_summary(_tx(spark, sf)).select("wallet", "tx_count", "wallet_age_days"), P.STAGE_MODE)
    SK.save_dataframe(s, f"{path}/summary.csv")
    SK.save_dataframe(s, f"{path}/summary.parquet")
    SK.write_json(s, f"{path}/summary.json")
    back = {"csv": FI.load_dataframe(spark, f"{path}/summary.csv"), "parquet": FI.load_dataframe(spark, f"{path}/summary.parquet"), "json": spark.read.json(f"{path}/summary.json")}
    parts = [d.select(F.lit(k).alias("sink"), F.col("wallet").cast("string").alias("wallet"), F.col("tx_count").cast("bigint").alias("tx_count"), "wallet_age_days") for k, d in back.items()]
    return out(parts[0].unionByName(parts[1]).unionByName(parts[2]))


# ---------------------------------------------------------------- M1-M5, J3 with a real anomaly table
from ledgerlens.operators import anomaly as AM  # noqa: E402

_ANOM_COLS = [c for c in O.FEATURE_COLS if c not in ("wallet", "first_tx_timestamp", "last_tx_timestamp")]


def _z_sql(c):
    return (f"CASE WHEN stddev_pop({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () "
            f"ELSE {O.d(0)} END")


@register("standardize_features", O.with_ctes(
    O.features_ctes(), "SELECT wallet, " + ", ".join(f"round({_z_sql(c)}, 6) AS {c}" for c in _ANOM_COLS)
    + " FROM feat"))
def q_standardize_features(spark, sf):
    f = _feats(spark, sf)
    return out(AM.standardize(f, AM.anomaly_feature_columns(f)))


_DIST_SQL = "-sqrt(" + " + ".join(f"pow(z_{c}, 2)" for c in _ANOM_COLS) + ")"


@register("anomaly_rescale", O.with_ctes(
    O.features_ctes() + ", z AS (SELECT wallet, " + ", ".join(f"{_z_sql(c)} AS z_{c}" for c in _ANOM_COLS)
    + " FROM feat), s AS (SELECT wallet, " + _DIST_SQL + " AS score FROM z), "
    "dd AS (SELECT wallet, score - (SELECT quantile_cont(score, 0.05) FROM s) AS decision FROM s)",
    f"SELECT wallet, round({O.d(1)} - (decision - mn) / (mx - mn + 1e-10), 6) AS anomaly_score, decision < 0 "
    "AS is_anomaly FROM dd CROSS JOIN (SELECT min(decision) AS mn, max(decision) AS mx FROM dd)"))
def q_anomaly_rescale(spark, sf):
    """M5 on a deterministic score (minus the norm of the standardised
    features): contamination quantile offset, rescale, flag."""
    f = _feats(spark, sf)
    cols = AM.anomaly_feature_columns(f)
    z = AM.standardize(f, cols)
    s = z.select("wallet", (-F.sqrt(sum((F.pow(F.col(c), 2) for c in cols[1:]), F.pow(F.col(cols[0]), 2))))
                 .alias("score"))
    return out(AM.rescale_decision(AM.decision_from_scores(s)))


_DD_SQL = (O.features_ctes() + ", z AS (SELECT wallet, " + ", ".join(f"{_z_sql(c)} AS z_{c}" for c in _ANOM_COLS)
           + " FROM feat), s AS (SELECT wallet, " + _DIST_SQL + " AS score FROM z), "
           "dd AS (SELECT wallet, score - (SELECT quantile_cont(score, 0.05) FROM s) AS decision FROM s)")


def _distance_decision(spark, sf):
    f = _feats(spark, sf)
    cols = AM.anomaly_feature_columns(f)
    z = AM.standardize(f, cols)
    s = z.select("wallet", (-F.sqrt(sum((F.pow(F.col(c), 2) for c in cols[1:]), F.pow(F.col(cols[0]), 2)))).alias("score"))
    return AM.decision_from_scores(s)


@register("anomaly_from_labels", O.with_ctes(
    _DD_SQL, f"SELECT wallet, CASE WHEN decision < 0 THEN {O.d(0.9)} ELSE {O.d(0.1)} END AS anomaly_score, decision < 0 AS is_anomaly FROM dd"))
def q_anomaly_from_labels(spark, sf):
    """P18's fallback, on the labels of the deterministic decision."""
    d = _distance_decision(spark, sf)
    return out(AM.scores_from_labels(d.select("wallet", F.when(F.col("decision") < 0, -1).otherwise(1).alias("label"))))


@register("anomaly_counts", O.with_ctes(
    _DD_SQL, "SELECT count(*) AS wallets, (count(*) FILTER (decision < 0)) AS anomalies FROM dd"))
def q_anomaly_counts(spark, sf):
    """A14 on the deterministic decision."""
    return AM.anomaly_counts(AM.rescale_decision(_distance_decision(spark, sf)))


def _anomaly_table(spark, sf):
    f = _feats(spark, sf)
    n = f.count()
    return f, P.stage(AM.detect_anomalies(f, n), P.STAGE_MODE)


@register("isolation_forest")
def q_isolation_forest(spark, sf):
    """M1 -> M2 -> M3 -> M5: isolation-forest anomaly score per wallet."""
    return out(_anomaly_table(spark, sf)[1])


@register("anomaly_model_loaded")
def q_anomaly_model_loaded(spark, sf):
    """The fitted chain (scaler, PCA, forest, cut) is written, read back and
    scores the wallets."""
    f = P.stage(_feats(spark, sf), P.STAGE_MODE)
    path = _scratch(spark, "anomaly-model")
    AM.fit_anomaly_model(f, f.count()).save(path)
    return out(AM.AnomalyModel.load(spark, path).score(f))


def _spectrum_sql():
    z = ", ".join(f"{_z_sql(c)} AS z_{c}" for c in _ANOM_COLS)
    cov = ", ".join(f"covar_samp(z_{a}, z_{b})" for a in _ANOM_COLS for b in _ANOM_COLS)
    var = " + ".join(f"var_samp(z_{c})" for c in _ANOM_COLS)
    return O.with_ctes(O.features_ctes() + f", z AS (SELECT {z} FROM feat)",
                       f"SELECT {len(_ANOM_COLS)} AS components, round({var}, 6) AS total, round(list_sum(list_transform([{cov}], lambda x: x * x)), 6) AS squares FROM z")


@register("pca_spectrum", _spectrum_sql())
def q_pca_spectrum(spark, sf):
    """M2: variances of the components against the covariances of the columns."""
    f = _feats(spark, sf)
    cols = AM.anomaly_feature_columns(f)
    return out(AM.pca_spectrum(AM.standardize(f, cols), cols))


def _distance_anomaly(spark, sf, f):
    """The deterministic anomaly table (minus the norm of the standardised
    features, rescaled) without the wallets whose id ends in 7."""
    cols = AM.anomaly_feature_columns(f)
    z = AM.standardize(f, cols)
    s = z.select("wallet", (-F.sqrt(sum((F.pow(F.col(c), 2) for c in cols[1:]), F.pow(F.col(cols[0]), 2)))).alias("score"))
    return P.stage(AM.rescale_decision(AM.decision_from_scores(s)).where(~F.col("wallet").endswith("7")), P.STAGE_MODE)


@register("final_scores_distance_anomaly", O.with_ctes(
    O.features_ctes() + ", z AS (SELECT wallet, " + ", ".join(f"{_z_sql(c)} AS z_{c}" for c in _ANOM_COLS)
    + " FROM feat), s AS (SELECT wallet, " + _DIST_SQL + " AS score FROM z), "
    "dd AS (SELECT wallet, score - (SELECT quantile_cont(score, 0.05) FROM s) AS decision FROM s), "
    f"an AS (SELECT wallet, {O.d(1)} - (decision - mn) / (mx - mn + 1e-10) AS anomaly_score "
    "FROM dd CROSS JOIN (SELECT min(decision) AS mn, max(decision) AS mx FROM dd) WHERE NOT ends_with(wallet, '7')), "
    f"sc0 AS (SELECT feat.*, COALESCE(an.anomaly_score, {O.d(O.C.NEUTRAL_ANOMALY)}) AS anomaly_score FROM feat LEFT JOIN an USING (wallet)), "
    f"{O.scoring_ctes(_W_COLS)}, {O.adjust_ctes(_W_COLS)}, fin AS ({O.percentile_sql('adjusted')})",
    "SELECT wallet, round(anomaly_score, 6) AS anomaly_score, round(raw_score, 6) AS raw_score, final_score FROM fin"))
def q_final_scores_distance_anomaly(spark, sf):
    """The whole pipeline with an anomaly table that SQL can compute too and
    that lacks some wallets (J3 left join with misses, H13, H15)."""
    f = P.stage(_feats(spark, sf), P.STAGE_MODE)
    s = P.scores(f, _distance_anomaly(spark, sf, f))
    return out(SC.final_score(s).select("wallet", "anomaly_score", "raw_score", "final_score"))


@register("final_scores_with_anomaly")
def q_final_scores_with_anomaly(spark, sf):
    """Whole reference pipeline including the anomaly stage (J3 left join)."""
    f, a = _anomaly_table(spark, sf)
    s = P.scores(f, a)
    return out(SC.final_score(s).select("wallet", "anomaly_score", "raw_score", "final_score"))


# ---------------------------------------------------------------- D1-D16
import datetime as _dt  # noqa: E402

from ledgerlens.operators import declared as DE  # noqa: E402

_CLEAN = f"tx AS ({O.tx_sql()}), clean AS ({O.clean_sql('tx')})"
_CLEAN_DENSE = f"tx AS ({O.tx_sql('events_dense')}), clean AS ({O.clean_sql('tx')})"


def _ts_sql(dt):
    return "TIMESTAMP '" + dt.strftime("%Y-%m-%d %H:%M:%S") + "'"


def _window_sql(as_of=O.C.DEFAULT_AS_OF):
    """Each window on its own: its rows, then summary and gaps between neighbours among them."""
    parts, cols = [], ["wallet"]
    for name, days in O.C.TIME_WINDOWS.items():
        inside = "TRUE" if days is None else f'"timestamp" >= {_ts_sql(as_of - _dt.timedelta(days=days))}'
        evs = ", ".join(f"count(*) FILTER (event_type = '{e}') AS {s}_count_{name}" for e, s in _EVS)
        vols = ", ".join(f"round(COALESCE(sum(amount) FILTER (event_type = '{e}'), {O.d(0)}), 6) AS {s}_volume_{name}" for e, s in _EVS if s in ("mint", "borrow", "repay"))
        parts.append(f"""r_{name} AS (SELECT *, {O.days('lag("timestamp") OVER (PARTITION BY account ORDER BY "timestamp", transaction_hash)', '"timestamp"')} AS g
  FROM clean WHERE {inside} AND "timestamp" <= {_ts_sql(as_of)}),
w_{name} AS (SELECT account AS wallet, count(*) AS tx_count_{name}, {evs}, {vols}, round({O.days('min("timestamp")', 'max("timestamp")')}, 6) AS age_days_{name},
  round(avg(g), 6) AS avg_gap_days_{name}, round(max(g), 6) AS max_gap_days_{name}, round(min(g), 6) AS min_gap_days_{name}, round(stddev_pop(g), 6) AS stddev_gap_days_{name}
  FROM r_{name} GROUP BY account),
m_{name} AS (SELECT account AS wallet, count(DISTINCT m) AS market_count_{name} FROM (SELECT account, unnest([token, ctoken]) AS m FROM r_{name}) GROUP BY account)""")
        zero = [f"{s}_count_{name}" for _, s in _EVS] + [f"tx_count_{name}", f"market_count_{name}"]
        cols += [f"COALESCE({c}, 0) AS {c}" for c in zero] + [f"COALESCE({s}_volume_{name}, 0) AS {s}_volume_{name}" for s in ("mint", "borrow", "repay")]
        cols += [f"{c}_days_{name}" for c in ("age", "avg_gap", "max_gap", "min_gap", "stddev_gap")]
    joins = " ".join(f"LEFT JOIN w_{n} USING (wallet) LEFT JOIN m_{n} USING (wallet)" for n in O.C.TIME_WINDOWS)
    return O.with_ctes(_CLEAN + ", " + ", ".join(parts), f"SELECT {', '.join(cols)} FROM (SELECT DISTINCT account AS wallet FROM clean) {joins}")


_EVS = [("Mint", "mint"), ("Redeem", "redeem"), ("Borrow", "borrow"), ("RepayBorrow", "repay"),
        ("LiquidateBorrow", "liquidation")]


@register("windowed_features", _window_sql())
def q_windowed_features(spark, sf):
    return out(DE.windowed_features(_tx(spark, sf)))


#: A clock for which the 30-day window begins inside the events.
_CLOCK_IN = _dt.datetime(2024, 2, 15)


@register("windowed_features_recent", _window_sql(_CLOCK_IN))
def q_windowed_features_recent(spark, sf):
    return out(DE.windowed_features(_tx(spark, sf), _CLOCK_IN))


@register("weight_aliases", O.with_ctes(
    O.features_ctes(), f"SELECT wallet, tx_count AS tx_count_total, round({O.days('first_tx_timestamp', O.AS_OF_SQL)}, 6) "
                       "AS account_age_days, market_count AS market_diversity_count FROM feat"))
def q_weight_aliases(spark, sf):
    f = DE.weight_aliases(_feats(spark, sf))
    return out(f.select("wallet", "tx_count_total", "account_age_days", "market_diversity_count"))


@register("activity_rates", O.with_ctes(
    _CLEAN + f", g AS ({O.gaps_sql('clean')}), med AS (SELECT account AS wallet, median(gap) AS m FROM g GROUP BY account), "
    "b AS (SELECT account AS wallet, count(*) AS n, greatest(" + O.d(1) + ", " + O.days('min("timestamp")', 'max("timestamp")')
    + ") AS span, " + ", ".join(f"avg(CASE WHEN event_type = '{e}' THEN amount END) AS avg_{s}_amount" for e, s in _EVS)
    + " FROM clean GROUP BY account)",
    "SELECT b.wallet, " + ", ".join(f"round(avg_{s}_amount, 6) AS avg_{s}_amount" for _, s in _EVS)
    + f", round(n / span, 6) AS tx_per_day, round(n / (span / {O.d(7)}), 6) AS tx_per_week, "
      f"round(n / (span / {O.d(30)}), 6) AS tx_per_month, round(m, 6) AS median_interval_days "
      "FROM b LEFT JOIN med USING (wallet)"))
def q_activity_rates(spark, sf):
    return out(DE.activity_rates(_tx(spark, sf)))


@register("borrow_to_repay", O.with_ctes(
    _CLEAN + ", t AS (SELECT account, token, \"timestamp\", event_type, min(CASE WHEN event_type = 'RepayBorrow' "
    "THEN \"timestamp\" END) OVER (PARTITION BY account, token ORDER BY \"timestamp\" RANGE BETWEEN CURRENT ROW "
    "AND UNBOUNDED FOLLOWING) AS nr FROM clean)",
    f"SELECT account AS wallet, count(*) AS borrows, count(d) AS borrows_repaid, round(avg(d), 6) AS avg_days_to_repay, "
    f"round(max(d), 6) AS max_days_to_repay FROM (SELECT account, {O.days('\"timestamp\"', 'nr')} AS d FROM t "
    "WHERE event_type = 'Borrow') GROUP BY account"))
def q_borrow_to_repay(spark, sf):
    return out(DE.borrow_to_repay(_tx(spark, sf)))


_SESS = (_CLEAN + """, t AS (SELECT account, "timestamp", transaction_hash,
  lag("timestamp") OVER (PARTITION BY account ORDER BY "timestamp", transaction_hash) AS p FROM clean),
t2 AS (SELECT *, (epoch_us("timestamp") - epoch_us(p)) / 1e6 AS gap,
  CASE WHEN p IS NULL OR (epoch_us("timestamp") - epoch_us(p)) / 1e6 > 3600 THEN 1 ELSE 0 END AS nw FROM t),
t3 AS (SELECT *, gap / 86400.0 AS gd, sum(nw) OVER (PARTITION BY account ORDER BY "timestamp", transaction_hash
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM t2),
s AS (SELECT account, session, count(*) AS a, """ + O.days('min("timestamp")', 'max("timestamp")') + """ AS d
  FROM t3 GROUP BY account, session),
per AS (SELECT account AS wallet, count(*) AS sessions, avg(a) AS actions_per_session, avg(d) AS avg_session_days
  FROM s GROUP BY account),
g AS (SELECT account AS wallet, max(gd) AS longest_inactivity_days,
  (stddev_pop(gd) - avg(gd)) / NULLIF(stddev_pop(gd) + avg(gd), 0) AS burstiness FROM t3 GROUP BY account),
daily AS (SELECT wallet, stddev_pop(c) AS daily_count_stddev FROM (SELECT account AS wallet,
  CAST("timestamp" AS DATE) AS day, count(*) AS c FROM clean GROUP BY ALL) GROUP BY wallet)""")


@register("wallet_sessions", O.with_ctes(
    _SESS, "SELECT wallet, sessions, round(actions_per_session, 6) AS actions_per_session, round(avg_session_days, 6) "
           "AS avg_session_days, round(longest_inactivity_days, 6) AS longest_inactivity_days, round(burstiness, 6) "
           "AS burstiness, round(daily_count_stddev, 6) AS daily_count_stddev FROM per JOIN g USING (wallet) "
           "JOIN daily USING (wallet)"))
def q_wallet_sessions(spark, sf):
    return out(DE.wallet_sessions(_tx(spark, sf)))


@register("asof_price", O.with_ctes(
    _CLEAN, "SELECT transaction_hash, token, event_type, round(last_value(px IGNORE NULLS) OVER (PARTITION BY token "
            "ORDER BY \"timestamp\", transaction_hash ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS price "
            "FROM (SELECT *, CASE WHEN event_type = 'Mint' AND amount <> 0 THEN amountusd / amount END AS px FROM clean)"))
def q_asof_price(spark, sf):
    return out(DE.asof_price(_tx(spark, sf)))


def _moves_sql():
    """The cleaned log as signed amounts, exact; ``rn`` numbers all events by time."""
    usd = "COALESCE(amountusd, amount)"
    sup = lambda v: f"CAST(COALESCE(CASE WHEN event_type = 'Mint' THEN {v} WHEN event_type = 'Redeem' THEN -{v} END, 0) AS DECIMAL(28,9))"
    debt = lambda v: f"CAST(COALESCE(CASE WHEN event_type = 'Borrow' THEN {v} WHEN event_type IN ('RepayBorrow', 'LiquidateBorrow') THEN -{v} END, 0) AS DECIMAL(28,9))"
    return f"""mv AS (SELECT account, token, "timestamp", transaction_hash, {usd} AS usd, {sup('amount')} AS ds, {debt('amount')} AS db,
  {sup(usd)} AS dsu, {debt(usd)} AS dbu, CASE WHEN event_type = 'LiquidateBorrow' THEN {usd} END AS seized,
  CASE WHEN event_type = 'Mint' AND amount <> 0 THEN amountusd / amount END AS px,
  row_number() OVER (ORDER BY "timestamp", transaction_hash) AS rn FROM clean)"""


def _marked_sql():
    """Balances of each event at the prices of that moment: all tokens of the wallet, as-of prices."""
    return """ev AS (SELECT *, lead("timestamp") OVER (PARTITION BY account ORDER BY rn) AS next_ts FROM mv),
held AS (SELECT DISTINCT account, token AS k FROM mv),
grid AS (SELECT account, k, rn, "timestamp", next_ts,
  CAST(sum(CASE WHEN token = k THEN ds ELSE 0 END) OVER w AS DOUBLE) AS qs, CAST(sum(CASE WHEN token = k THEN db ELSE 0 END) OVER w AS DOUBLE) AS qb
  FROM ev JOIN held USING (account) WINDOW w AS (PARTITION BY account, k ORDER BY rn)),
seen AS (SELECT token, rn, px FROM mv WHERE px IS NOT NULL),
bal AS (SELECT account, grid.rn, any_value("timestamp") AS "timestamp", any_value(next_ts) AS next_ts,
  round(sum(qs * COALESCE(px, 0)), 9) AS supplied, round(sum(qb * COALESCE(px, 0)), 9) AS borrowed
  FROM grid ASOF LEFT JOIN seen ON grid.k = seen.token AND grid.rn >= seen.rn GROUP BY account, grid.rn)"""


def _accrual_sql(clock):
    """Rate steps of each market and day, and the balances' steps: every pair that overlaps."""
    part = O.days("greatest(a, t0)", "least(z, t1)") + " / 365.0"
    return f"""dy AS (SELECT token, CAST("timestamp" AS DATE) AS d, sum(dsu) AS s, sum(dbu) AS b FROM mv GROUP BY ALL),
cu AS (SELECT token, CAST(d + 1 AS TIMESTAMP) AS t0, CAST(sum(s) OVER w AS DOUBLE) AS s, CAST(sum(b) OVER w AS DOUBLE) AS b FROM dy WINDOW w AS (PARTITION BY token ORDER BY d)),
uu AS (SELECT *, CASE WHEN s > 0 THEN least({O.d(1)}, greatest({O.d(0)}, b / s)) ELSE {O.d(0)} END AS u FROM cu WHERE t0 < {clock}),
rt AS (SELECT token, t0, COALESCE(lead(t0) OVER (PARTITION BY token ORDER BY t0), {clock}) AS t1, 0.02 + {O.d(0.2)} * u AS rb,
  (0.02 + {O.d(0.2)} * u) * u * 0.9 AS rs, CASE WHEN s > 0 THEN 36500 / s ELSE {O.d(0)} END AS rr FROM uu),
bi AS (SELECT account, token, "timestamp" AS a, least({clock}, COALESCE(lead("timestamp") OVER (PARTITION BY account, token ORDER BY rn), {clock})) AS z,
  greatest({O.d(0)}, CAST(sum(dsu) OVER w AS DOUBLE)) AS qs, greatest({O.d(0)}, CAST(sum(dbu) OVER w AS DOUBLE)) AS qb
  FROM mv WINDOW w AS (PARTITION BY account, token ORDER BY rn)),
ac AS (SELECT account, sum(qb * rb * {part}) AS paid, sum(qs * rs * {part}) AS earned, sum(qs * rr * {part}) AS reward
  FROM bi JOIN rt ON bi.token = rt.token AND a < t1 AND z > t0 GROUP BY account),
vo AS (SELECT account, sum(abs(usd)) AS vol, COALESCE(sum(seized), 0) AS seized FROM mv GROUP BY account),
acc AS (SELECT vo.account AS wallet, COALESCE(paid, 0) AS paid, COALESCE(earned, 0) AS earned, COALESCE(reward, 0) AS reward, vol, seized FROM vo LEFT JOIN ac USING (account))"""


_LTV_SQL = (_CLEAN + ", " + _moves_sql() + ", " + _marked_sql() + f""", l AS (SELECT *, CASE WHEN supplied > 0 THEN borrowed / supplied END AS ltv,
  greatest({O.d(0)}, {O.days('"timestamp"', f'COALESCE(next_ts, {O.AS_OF_SQL})')}) AS dt FROM bal),
l2 AS (SELECT *, CASE WHEN ltv IS NOT NULL THEN dt END AS wl FROM l)""")


@register("ltv_path", O.with_ctes(
    _LTV_SQL, "SELECT account AS wallet, round(avg(ltv), 6) AS avg_ltv_alltime, round(min(ltv), 6) AS min_ltv_alltime, "
              "round(max(ltv), 6) AS max_ltv_alltime, round(stddev_pop(ltv), 6) AS ltv_stddev, "
              "round(sum(ltv * wl) / NULLIF(sum(wl), 0), 6) AS time_weighted_ltv, "
              "round(sum(CASE WHEN ltv > 0.8 THEN dt END) / NULLIF(sum(wl), 0), 6) AS time_near_liquidation_pct, "
              f"round(avg(CASE WHEN \"timestamp\" >= {_ts_sql(O.C.DEFAULT_AS_OF - _dt.timedelta(days=90))} THEN ltv END), 6) "
              "AS avg_ltv_90d FROM l2 GROUP BY account"))
def q_ltv_path(spark, sf):
    return out(DE.ltv_path(_tx(spark, sf)))


#: A clock at which accounts are old enough for the consistency rule.
_CLOCK_LATE = _dt.datetime(2024, 9, 1)
_DECLARED = ["tx_count_total", "account_age_days", "market_diversity_count", "avg_ltv_90d", "min_ltv_alltime", "max_ltv_alltime",
             "time_near_liquidation_pct", "comp_earned_estimate_ratio", "complex_action_freq"]
_DECLARED_COLS = O.FEATURE_COLS + _DECLARED + ["anomaly_score"]
_ALL_RULES = ["liquidation_penalty", "good_repayer_bonus", "high_ltv_penalty", "consistency_bonus", "inactivity_penalty"]


def _declared_sql():
    clock = _ts_sql(_CLOCK_LATE)
    held = O.days('"timestamp"', f"COALESCE(next_ts, {clock})")
    recent = _ts_sql(_CLOCK_LATE - _dt.timedelta(days=90))
    ctes = f"""{O.features_ctes('events_dense', as_of=clock)}, {_moves_sql()}, {_marked_sql()}, {_accrual_sql(clock)},
l AS (SELECT *, CASE WHEN supplied > 0 THEN borrowed / supplied END AS ltv, greatest({O.d(0)}, {held}) AS dt FROM bal),
lt AS (SELECT account AS wallet, avg(CASE WHEN "timestamp" >= {recent} THEN ltv END) AS avg_ltv_90d, min(ltv) AS min_ltv_alltime,
  max(ltv) AS max_ltv_alltime, sum(CASE WHEN ltv > 0.8 THEN dt END) / NULLIF(sum(CASE WHEN ltv IS NOT NULL THEN dt END), 0) AS time_near_liquidation_pct
  FROM l GROUP BY account),
ca AS (SELECT wallet, (count(*) FILTER (e >= 2 AND m >= 2)) / count(*) AS complex_action_freq FROM (SELECT account AS wallet,
  count(DISTINCT event_type) AS e, count(DISTINCT token) AS m FROM clean GROUP BY account, floor(epoch_us("timestamp") / 600000000)) GROUP BY wallet),
sc0 AS (SELECT feat.*, tx_count AS tx_count_total, {O.days('first_tx_timestamp', clock)} AS account_age_days, market_count AS market_diversity_count,
  lt.* EXCLUDE (wallet), reward / greatest({O.d(1)}, vol) AS comp_earned_estimate_ratio, complex_action_freq, {O.d(O.C.NEUTRAL_ANOMALY)} AS anomaly_score
  FROM feat LEFT JOIN lt USING (wallet) LEFT JOIN ca USING (wallet) LEFT JOIN acc USING (wallet)),
{O.scoring_ctes(_DECLARED_COLS)}, {O.adjust_ctes(_DECLARED_COLS)}, fin AS ({O.percentile_sql('adjusted')})"""
    return O.with_ctes(ctes, "SELECT wallet, round(raw_score, 6) AS raw_score, " + ", ".join(f"round(a_{k}, 6) AS {k}" for k in _ALL_RULES)
                       + ", final_score FROM fin")


@register("final_scores_declared", _declared_sql())
def q_final_scores_declared(spark, sf):
    """Scores with every declared column that the tables can give, on dense
    accounts: the extra weights count and all five rules fire (F4, H3-H7)."""
    tx = _tx(spark, sf, "events_dense")
    f = P.stage(DE.declared_features(tx, P.features(tx, _CLOCK_LATE), _CLOCK_LATE), P.STAGE_MODE)
    s = SC.final_score(P.scores(f))
    return out(s.select("wallet", "raw_score", *[F.col("adjustments").getItem(k).alias(k) for k in _ALL_RULES], "final_score"))


@register("liquidation_history", O.with_ctes(
    _CLEAN_DENSE + """, liq AS (SELECT *, COALESCE(amountusd, amount) AS usd FROM clean WHERE event_type = 'LiquidateBorrow'),
su AS (SELECT account AS wallet, count(*) AS sc, sum(usd) AS sv FROM liq GROUP BY account),
pe AS (SELECT liquidator AS wallet, count(*) AS pc, sum(usd) AS pv FROM liq WHERE liquidator IS NOT NULL GROUP BY liquidator),
j AS (SELECT COALESCE(su.wallet, pe.wallet) AS wallet, COALESCE(sc, 0) AS sc, COALESCE(sv, 0.0) AS sv,
  COALESCE(pc, 0) AS pc, COALESCE(pv, 0.0) AS pv FROM su FULL OUTER JOIN pe ON su.wallet = pe.wallet)""",
    f"SELECT wallet, sc AS suffered_count, round(sv, 6) AS suffered_value, pc AS performed_count, round(pv, 6) AS "
    f"performed_value, round(sv / NULLIF(sc, 0), 6) AS avg_suffered_size, round(pc / greatest({O.d(1)}, CAST(sc AS DOUBLE)), 6) "
    "AS performed_to_suffered FROM j"))
def q_liquidation_history(spark, sf):
    return out(DE.liquidation_history(_tx(spark, sf, "events_dense")))


@register("interest_estimate", O.with_ctes(
    _CLEAN + ", " + _moves_sql() + ", " + _accrual_sql(O.AS_OF_SQL),
    "SELECT wallet, round(paid, 6) AS interest_paid_estimate, round(earned, 6) AS interest_earned_estimate, "
    "round(paid * 0.1 + seized * 0.028, 6) AS reserve_contribution_estimate FROM acc"))
def q_interest_estimate(spark, sf):
    """Interest at rates that change by market and day, reserve shares."""
    return out(DE.interest_estimate(_tx(spark, sf)))


@register("reward_estimate", O.with_ctes(
    _CLEAN_DENSE + ", " + _moves_sql() + ", " + _accrual_sql(O.AS_OF_SQL),
    f"SELECT wallet, round(reward, 6) AS comp_earned_estimate, round(reward / greatest({O.d(1)}, vol), 6) AS comp_earned_estimate_ratio FROM acc"))
def q_reward_estimate(spark, sf):
    """Reward tokens by market and day, on dense accounts."""
    return out(DE.reward_estimate(_tx(spark, sf, "events_dense")))


@register("market_rates", O.with_ctes(
    _CLEAN + ", " + _moves_sql() + ", " + _accrual_sql("TIMESTAMP '2100-01-01'"),
    'SELECT token, t0 AS "timestamp", round(u, 6) AS u, round(rb, 6) AS borrow, round(rs, 6) AS supply, round(rr, 6) AS reward FROM uu JOIN rt USING (token, t0)'))
def q_market_rates(spark, sf):
    """The rate steps of D8 and D9: utilisation of each market by day."""
    return out(DE.market_rates(DE.moves(_tx(spark, sf))))


@register("complex_actions", O.with_ctes(
    _CLEAN, "SELECT wallet, count(*) AS active_windows, CAST(count_if(e >= 2 AND m >= 2) AS BIGINT) AS complex_windows, "
            "round(count_if(e >= 2 AND m >= 2) / count(*), 6) AS complex_action_freq FROM (SELECT account AS wallet, "
            "floor(epoch_us(\"timestamp\") / 600000000) AS b, count(DISTINCT event_type) AS e, count(DISTINCT token) AS m "
            "FROM clean GROUP BY ALL) GROUP BY wallet"))
def q_complex_actions(spark, sf):
    return out(DE.complex_actions(_tx(spark, sf)))


@register("behaviour_flags", O.with_ctes(
    _CLEAN + """, a AS (SELECT *, lag(event_type) OVER (PARTITION BY account, token ORDER BY "timestamp", transaction_hash) AS pe,
  (epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (PARTITION BY account, token ORDER BY "timestamp", transaction_hash))) / 1e6 AS g
  FROM clean),
b AS (SELECT *, lag(event_type) OVER (PARTITION BY account ORDER BY "timestamp", transaction_hash) AS pe2,
  (epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (PARTITION BY account ORDER BY "timestamp", transaction_hash))) / 1e6 AS g2
  FROM clean),
m AS (SELECT account AS wallet, CAST(count_if(event_type = 'Redeem' AND pe = 'Mint' AND g <= 3600) AS BIGINT) AS rapid_cycles,
  CAST(count_if(event_type = 'RepayBorrow' AND pe = 'Borrow' AND g <= 600) AS BIGINT) AS flash_like FROM a GROUP BY account),
r AS (SELECT account AS wallet, CAST(count_if(pe2 = event_type AND g2 <= 60) AS BIGINT) AS repeats FROM b GROUP BY account), """ + _moves_sql() + """,
fl AS (SELECT DISTINCT account, token, "timestamp", sum(greatest(dsu, 0) + greatest(-dbu, 0)) OVER h AS i, sum(greatest(-dsu, 0) + greatest(dbu, 0)) OVER h AS o FROM mv
  WINDOW h AS (PARTITION BY account, token ORDER BY "timestamp" RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)),
nr AS (SELECT account AS wallet, CASE WHEN i > 0 AND o > 0 THEN CAST(abs(i - o) AS DOUBLE) / CAST(i + o AS DOUBLE) END AS x FROM fl),
n AS (SELECT wallet, count(*) FILTER (x <= 0.1) AS churn_hours, min(x) AS min_net_to_gross FROM nr GROUP BY wallet)""",
    "SELECT m.*, repeats, churn_hours, round(min_net_to_gross, 6) AS min_net_to_gross FROM m JOIN r USING (wallet) JOIN n USING (wallet)"))
def q_behaviour_flags(spark, sf):
    return out(DE.behaviour_flags(_tx(spark, sf)))


@register("wallet_clusters")
def q_wallet_clusters(spark, sf):
    """KMeans (k=4) on the standardised anomaly features."""
    f = _feats(spark, sf)
    cols = AM.anomaly_feature_columns(f)
    return DE.wallet_clusters(AM.standardize(f, cols), cols)


_SENS_W = {f: w for f, w in _AVAIL.items()}


def _sens_sql():
    total = sum(abs(w) for w in _SENS_W.values())
    rows, avg_rank = [], "rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2.0"
    for f, w in _SENS_W.items():
        if w == 0:
            continue
        for sgn, tag in ((1, "up"), (-1, "down")):
            s = 1 + sgn * 0.1
            c = f"COALESCE(c_{f}, {O.d(0)})"
            expr = (f"(raw_score * {O.d(total)} - {c} + {c} * {O.d(s)}) / {O.d(total - abs(w) + abs(w) * s)}")
            ranked = f"(SELECT raw_score, {expr} AS v, {avg_rank.format('round(raw_score, 12)')} AS br, {avg_rank.format(f'round({expr}, 12)')} AS r FROM weighted)"
            rows.append(f"SELECT '{f}' AS feature, '{tag}' AS direction, round({_corr_sql('br', 'r')}, 6) AS rank_correlation, round(avg(abs(r - br)), 6) AS mean_rank_change, "
                        f"round({_corr_sql('raw_score', 'v')}, 6) AS correlation, round(avg(abs(v - raw_score)), 6) AS mean_abs_change FROM {ranked}")
    return " UNION ALL ".join(rows)


@register("weight_sensitivity", O.with_ctes(_SC_CTES, _sens_sql()))
def q_weight_sensitivity(spark, sf):
    s = SC.weighted_score(SC.prepare_scoring(_feats(spark, sf)))
    return out(DE.weight_sensitivity(s, SC.available_weights(s)))


def _cut_final(spark, sf, cutoff):
    tx = _tx(spark, sf).where(F.col("timestamp") < F.lit(cutoff.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"))
    f = P.features(tx, as_of=cutoff)
    return P.stage(SC.final_score(P.scores(f)), P.STAGE_MODE)


_CUTOFF = _dt.datetime(2024, 1, 16)


_CUT_SQL = _ts_sql(_CUTOFF)
_BEFORE = f"(WITH {O.pipeline_ctes(cutoff=_CUT_SQL, as_of=_CUT_SQL)} SELECT wallet, final_score FROM fin)"
_AFTER = f"(WITH {O.pipeline_ctes()} SELECT wallet, final_score FROM fin)"


@register("score_backtest", f"""SELECT COALESCE(b.wallet, a.wallet) AS wallet, CAST(b.final_score AS DOUBLE) AS score_before,
  CAST(a.final_score AS DOUBLE) AS score_after, CAST(a.final_score - b.final_score AS DOUBLE) AS change
FROM {_BEFORE} b FULL OUTER JOIN {_AFTER} a ON a.wallet = b.wallet""")
def q_score_backtest(spark, sf):
    """Scores with the clock at a cut-off date (history before it only) against
    the full-history scores, per wallet (D15)."""
    before = _cut_final(spark, sf, _CUTOFF).select("wallet", F.col("final_score").alias("score_before"))
    after = _final(spark, sf).select("wallet", F.col("final_score").alias("score_after"))
    j = before.join(after, "wallet", "full_outer").withColumn("change", F.col("score_after") - F.col("score_before"))
    # Nullable integers are emitted as doubles (wallets without history before the cut-off).
    return j.select("wallet", *[F.col(c).cast("double").alias(c) for c in ("score_before", "score_after", "change")])


def _hist_sql(src, tag):
    return (f"(SELECT least(9, CAST(floor(final_score * 10 / 101) AS INTEGER)) AS bin, count(*) AS {tag} "
            f"FROM {src} GROUP BY 1)")


@register("score_drift", f"""WITH h AS (SELECT COALESCE(x.bin, y.bin) AS bin, COALESCE(nb, 0) AS nb, COALESCE(na, 0) AS na
  FROM {_hist_sql(_BEFORE, 'nb')} x FULL OUTER JOIN {_hist_sql(_AFTER, 'na')} y ON x.bin = y.bin),
pq AS (SELECT nb / (SELECT sum(nb) FROM h) + 1e-6 AS p, na / (SELECT sum(na) FROM h) + 1e-6 AS q FROM h)
SELECT round(sum((q - p) * ln(q / p)), 6) AS psi, round(sum(abs(q - p)), 6) AS l1_distance FROM pq""")
def q_score_drift(spark, sf):
    """Population stability index of the score distribution between the
    cut-off clock and the full history (D15)."""
    return out(DE.score_drift(_cut_final(spark, sf, _CUTOFF), _final(spark, sf)))


def _timeline(final, tx, n=2):
    sel_top = final.orderBy(F.col("final_score").desc(), F.col("wallet").asc()).limit(n).select("wallet", F.lit("top").alias("group"))
    sel_bot = final.orderBy(F.col("final_score").asc(), F.col("wallet").desc()).limit(n).select("wallet", F.lit("bottom").alias("group"))
    med = exact_medians(final, ["final_score"]).select(F.col("final_score").alias("_med"))
    mid = (final.crossJoin(F.broadcast(med)).orderBy(F.abs(F.col("final_score") - F.col("_med")).asc(), F.col("wallet").asc())
                .limit(n).select("wallet", F.lit("middle").alias("group")))
    sel = P.stage(sel_top.unionByName(sel_bot).unionByName(mid), P.STAGE_MODE)          # 3n rows: bounded broadcast
    t = tx.join(F.broadcast(sel), tx.account == sel.wallet, "inner").drop("wallet")
    usd = F.coalesce(F.col("amountusd"), F.col("amount"))
    sup = F.when(F.col("event_type") == "Mint", usd).when(F.col("event_type") == "Redeem", -usd).otherwise(F.lit(0.0))
    debt = (F.when(F.col("event_type") == "Borrow", usd)
             .when(F.col("event_type").isin("RepayBorrow", "LiquidateBorrow"), -usd).otherwise(F.lit(0.0)))
    from ledgerlens.operators.ordered import running_sums
    t = running_sums(t, "account", ["timestamp", "transaction_hash"],
                     {"seq": F.lit(1), "running_supplied": sup, "running_borrowed": debt})
    return t.select(F.col("account").alias("wallet"), "group", "seq", "timestamp", "transaction_hash", "event_type",
                    F.round("running_supplied", DE.BALANCE_DIGITS).alias("running_supplied"),
                    F.round("running_borrowed", DE.BALANCE_DIGITS).alias("running_borrowed"))


def _timeline_sql():
    usd = "COALESCE(amountusd, amount)"
    sup = f"CASE WHEN event_type = 'Mint' THEN {usd} WHEN event_type = 'Redeem' THEN -{usd} ELSE {O.d(0)} END"
    debt = (f"CASE WHEN event_type = 'Borrow' THEN {usd} WHEN event_type IN ('RepayBorrow', 'LiquidateBorrow') "
            f"THEN -{usd} ELSE {O.d(0)} END")
    w = 'OVER (PARTITION BY account ORDER BY "timestamp", transaction_hash ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)'
    return O.with_ctes(
        O.pipeline_ctes() + """, sel AS (
  (SELECT wallet, 'top' AS "group" FROM fin ORDER BY final_score DESC, wallet ASC LIMIT 2) UNION ALL
  (SELECT wallet, 'bottom' AS "group" FROM fin ORDER BY final_score ASC, wallet DESC LIMIT 2) UNION ALL
  (SELECT wallet, 'middle' AS "group" FROM fin ORDER BY abs(final_score - (SELECT median(final_score) FROM fin)) ASC,
   wallet ASC LIMIT 2))""",
        f"""SELECT account AS wallet, "group", count(*) {w} AS seq, "timestamp", transaction_hash, event_type,
  round(round(sum({sup}) {w}, {DE.BALANCE_DIGITS}), 6) AS running_supplied,
  round(round(sum({debt}) {w}, {DE.BALANCE_DIGITS}), 6) AS running_borrowed
FROM clean JOIN sel ON clean.account = sel.wallet""")


@register("wallet_timeline", _timeline_sql())
def q_wallet_timeline(spark, sf):
    """Ordered event timeline with running counts and balances for the top,
    bottom and middle-scored wallets (D16)."""
    return out(_timeline(_final(spark, sf), _tx(spark, sf)))


# ---------------------------------------------------------------- M6-M26
from ledgerlens.operators import ensemble as EN  # noqa: E402
from ledgerlens.operators import selection as SE  # noqa: E402
from ledgerlens.operators import sequences as SQ  # noqa: E402
from ledgerlens.operators import tuning as TU  # noqa: E402

_TF_COLS = [c for c in O.FEATURE_COLS if c not in ("wallet", "first_tx_timestamp", "last_tx_timestamp")]
_TF_CTES = (O.pipeline_ctes() + ", tf AS (SELECT f.wallet, " + ", ".join(f"COALESCE(CAST(f.{c} AS DOUBLE), {O.d(0)}) AS {c}"
            for c in _TF_COLS) + ", a.raw_score AS label FROM feat f JOIN adjusted a USING (wallet))")


def _train(spark, sf):
    f = _feats(spark, sf)
    s = P.scores(f, how="none")     # read once, of it the score alone
    return P.stage(SE.training_frame(f, s), P.STAGE_MODE)


@register("training_frame", O.with_ctes(_TF_CTES, f"SELECT wallet, {O.r6(_TF_COLS + ['label'])} FROM tf"))
def q_training_frame(spark, sf):
    return out(_train(spark, sf))


_CORR_CTE = ("cr AS (SELECT feature, correlation, abs(correlation) AS abs_correlation FROM ("
             + " UNION ALL ".join(f"SELECT '{c}' AS feature, {_corr_sql(c, 'label')} AS correlation FROM tf" for c in _TF_COLS)
             + ")), crr AS (SELECT *, row_number() OVER (ORDER BY round(abs_correlation, 12) DESC NULLS LAST, feature) AS rank, "
             "COALESCE(abs_correlation >= 0.1, FALSE) AS selected FROM cr)")


@register("feature_correlation", O.with_ctes(
    _TF_CTES + ", " + _CORR_CTE, "SELECT feature, round(correlation, 6) AS correlation, round(abs_correlation, 6) "
                                 "AS abs_correlation, rank, selected FROM crr"))
def q_feature_correlation(spark, sf):
    return out(SE.correlation_ranking(_train(spark, sf)))


def _bin_sql(c, bins=10):
    return f"CAST(floor((rank() OVER (ORDER BY {c}) - 1) * {bins} / count(*) OVER ()) AS INTEGER)"


_MI_CTE = ("lg AS (" + " UNION ALL ".join(
               f"SELECT '{c}' AS feature, {_bin_sql(c)} AS xb, {_bin_sql('label')} AS yb FROM tf" for c in _TF_COLS)
           + "), jt AS (SELECT feature, xb, yb, count(*) AS nxy FROM lg GROUP BY ALL), "
           "jt2 AS (SELECT *, sum(nxy) OVER (PARTITION BY feature) AS n, sum(nxy) OVER (PARTITION BY feature, xb) AS nx, "
           "sum(nxy) OVER (PARTITION BY feature, yb) AS ny FROM jt), "
           "mi AS (SELECT feature, sum((nxy / n) * ln((nxy * n) / (nx * ny))) AS mutual_info FROM jt2 GROUP BY feature), "
           "mir AS (SELECT *, row_number() OVER (ORDER BY round(mutual_info, 12) DESC, feature) AS rank FROM mi)")


@register("feature_mutual_info", O.with_ctes(
    _TF_CTES + ", " + _MI_CTE, "SELECT feature, round(mutual_info, 6) AS mutual_info, rank FROM mir"))
def q_feature_mutual_info(spark, sf):
    return out(SE.mutual_info_ranking(_train(spark, sf)))


def _pairs_sql():
    from itertools import combinations
    pairs = list(combinations(_TF_COLS, 2))
    return ("pw AS (" + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {_corr_sql(a, b)} AS correlation FROM tf" for a, b in pairs) + ")")


@register("redundant_pairs", O.with_ctes(
    _TF_CTES + ", " + _pairs_sql(), "SELECT feature_a, feature_b, round(correlation, 6) AS correlation FROM pw "
                                    "WHERE correlation > 0.8"))
def q_redundant_pairs(spark, sf):
    return out(SE.redundant_pairs(_train(spark, sf)))


@register("feature_matrix", O.with_ctes(
    _TF_CTES, " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round({_corr_sql(a, b)}, 6) AS correlation FROM tf"
                                 for a in _TF_COLS for b in _TF_COLS)))
def q_feature_matrix(spark, sf):
    """The full feature correlation matrix."""
    return out(SE.correlation_matrix(_train(spark, sf)))


@register("feature_votes", O.with_ctes(
    _TF_CTES + ", " + _CORR_CTE + ", " + _MI_CTE,
    "SELECT feature, count(*) AS votes, CAST(min(m * 1000 + pos) // 1000 AS INTEGER) AS first_method, "
    "CAST(min(m * 1000 + pos) % 1000 AS INTEGER) AS first_pos FROM ("
    "SELECT feature, 0 AS m, rank - 1 AS pos FROM crr WHERE rank <= 15 UNION ALL "
    "SELECT feature, 1 AS m, rank - 1 AS pos FROM mir WHERE rank <= 15) GROUP BY feature "
    "ORDER BY votes DESC, min(m * 1000 + pos) LIMIT 15"))
def q_feature_votes(spark, sf):
    """Combined vote over the correlation and mutual-information top-15 lists."""
    t = _train(spark, sf)
    c = SE.correlation_ranking(t).where(F.col("rank") <= 15).select(F.lit(0).alias("method"),
                                                                   (F.col("rank") - 1).cast("int").alias("pos"), "feature")
    m = SE.mutual_info_ranking(t).where(F.col("rank") <= 15).select(F.lit(1).alias("method"),
                                                                    (F.col("rank") - 1).cast("int").alias("pos"), "feature")
    return SE.votes_from_long(c.unionByName(m), 15)


@register("feature_votes_all")
def q_feature_votes_all(spark, sf):
    """The combined selection: votes of all four methods."""
    names = SE.select_features(_train(spark, sf))
    return spark.createDataFrame([(i + 1, f) for i, f in enumerate(names)], "position int, feature string")


@register("training_frame_selected", O.with_ctes(_TF_CTES, f"SELECT wallet, {O.r6(['wallet_age_days', 'tx_count', 'repay_ratio', 'label'])} FROM tf"))
def q_training_frame_selected(spark, sf):
    """F8: restricted to selected features, one of which doesn't exist."""
    f = P.stage(_feats(spark, sf), P.STAGE_MODE)
    return out(SE.training_frame(f, P.scores(f), selected=["tx_count", "repay_ratio", "wallet_age_days", "no_such_feature"]))


@register("rf_importance")
def q_rf_importance(spark, sf):
    """Random-forest importances (100 trees, depth 10, seed 42); sums to 1."""
    return SE.rf_importance(_train(spark, sf))


@register("rfe_selection")
def q_rfe_selection(spark, sf):
    """Recursive feature elimination down to 10 features (step 1)."""
    keep = SE.recursive_elimination(_train(spark, sf), 10)
    return spark.createDataFrame([(i + 1, f) for i, f in enumerate(keep)], "position int, feature string")


@register("kfold_assignment", O.with_ctes(
    O.features_ctes(), "SELECT wallet, CAST(CAST('0x' || substr(md5(wallet), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold FROM feat"))
def q_kfold_assignment(spark, sf):
    return TU.fold_column(_feats(spark, sf).select("wallet"), 5)


_HO = ("ho AS (SELECT *, CASE WHEN CAST('0x' || substr(md5(wallet), 1, 8) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' "
       "END AS split FROM tf), hs AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _TF_COLS)
       + " FROM ho WHERE split = 'train')")


@register("holdout_split", O.with_ctes(
    _TF_CTES + ", " + _HO, "SELECT wallet, split, " + ", ".join(
        f"round(CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE {O.d(0)} END, 6) AS {c}" for c in _TF_COLS)
    + ", round(label, 6) AS label FROM ho CROSS JOIN hs"))
def q_holdout_split(spark, sf):
    t = _train(spark, sf)
    return out(EN.holdout_split(t, SE.feature_columns(t)))


@register("tune_models")
def q_tune_models(spark, sf):
    """Grid search of the linear zoo (ridge, lasso, elastic net) with the
    reference grids and 5 deterministic folds: one row per candidate."""
    t = _train(spark, sf)
    return TU.tune(t, SE.feature_columns(t), ("ridge", "lasso", "elastic_net"), ("grid",))


@register("best_method")
def q_best_method(spark, sf):
    """Best method and parameters per linear model from grid and random search
    (30 draws) (T4, M18)."""
    t = _train(spark, sf)
    return TU.best_per_model(TU.tune(t, SE.feature_columns(t), ("ridge", "lasso", "elastic_net"), ("grid", "random")))


@register("tune_trees")
def q_tune_trees(spark, sf):
    """Forest and boosting in 5-fold search: each is fitted once per fold, at the
    largest number of trees, and scored at all three (M13, M15).  The reference's
    grids (200 trees, depth 30) run by ``tune`` but take an hour on these tables."""
    t = _train(spark, sf)
    cols = SE.feature_columns(t)
    rows = TU.search(t, cols, "random_forest", [{"n_estimators": n, "max_depth": 10, "min_samples_leaf": 2} for n in (5, 10, 20)], "grid_search")
    rows += TU.search(t, cols, "gradient_boosting", [{"n_estimators": n, "max_depth": 3, "learning_rate": 0.1} for n in (5, 10, 20)], "grid_search")
    return spark.createDataFrame(rows, "model string, method string, params string, mse double")


@register("tune_space")
def q_tune_space(spark, sf):
    """Search of a continuous space: 100 draws for the ridge model."""
    t = _train(spark, sf)
    return TU.tune(t, SE.feature_columns(t), ("ridge",), ("space",))


@register("ensemble_predictions")
def q_ensemble_predictions(spark, sf):
    """All five models, the linear ones with the parameters that a grid search
    finds best; hybrid table with row statistics and the voting ensemble (M19, M21, M22)."""
    t = _train(spark, sf)
    cols = SE.feature_columns(t)
    tuned = EN.best_params_from(TU.tune(t, cols, ("ridge", "lasso", "elastic_net"), ("grid",)))
    models = EN.fit_models(t, cols, {**EN.DEFAULT_BEST, **tuned})
    pred = EN.voting(EN.predict_all(models, t), list(models))
    pc = [f"score_{m}" for m in models]
    return out(EN.row_stats(pred, pc, "pred_").select("wallet", "label", *pc, "ensemble_voting", "pred_mean",
                                                      "pred_median", "pred_min", "pred_max"))


#: Five models with few trees, since they are fitted many times.
_FIVE = {**EN.DEFAULT_BEST, "random_forest": {"n_estimators": 20, "max_depth": 8}, "gradient_boosting": {"n_estimators": 20, "learning_rate": 0.1, "max_depth": 3}}


@register("stacking_ensemble")
def q_stacking_ensemble(spark, sf):
    """Stacking of all five models: bases refitted on all rows under a ridge
    meta-model fitted on out-of-fold predictions (M20)."""
    t = _train(spark, sf)
    return out(EN.stacked_predictions(t, SE.feature_columns(t), _FIVE))


def _holdout(spark, sf):
    t = _train(spark, sf)
    return P.stage(EN.holdout_predictions(t, SE.feature_columns(t), _FIVE), P.STAGE_MODE)


@register("holdout_metrics")
def q_holdout_metrics(spark, sf):
    """MSE and MAE of five fitted models on held-out rows, the best one marked."""
    m = EN.regression_metrics(_holdout(spark, sf), "label", [f"score_{x}" for x in _FIVE])
    best = EN.best_model(m)     # one row
    return out(m.crossJoin(F.broadcast(best)).select("model", "mse", "mae", (F.col("model") == F.col("best_model")).alias("best")))


@register("prediction_pairs")
def q_prediction_pairs(spark, sf):
    """Pairs of the five models whose held-out predictions have |r| > 0.8."""
    return out(EN.strong_pairs(_holdout(spark, sf), [f"score_{x}" for x in _FIVE]))



_MULTI = (O.pipeline_ctes() + f", mm AS ({O.minmax_sql('adjusted')}), sg AS ({O.sigmoid_sql('adjusted')}), "
          "ms AS (SELECT fin.wallet, fin.final_score AS score_percentile, mm.final_score AS score_minmax, "
          "sg.final_score AS score_sigmoid FROM fin JOIN mm USING (wallet) JOIN sg USING (wallet))")
_MCOLS = ["score_percentile", "score_minmax", "score_sigmoid"]


def _multi_scores(spark, sf):
    s = _scored(spark, sf).select("wallet", "raw_score")
    for method, name in (("percentile", "score_percentile"), ("min_max", "score_minmax"), ("sigmoid", "score_sigmoid")):
        s = SC.final_score(s, method).withColumnRenamed("final_score", name)
    return P.stage(s.select("wallet", *_MCOLS), P.STAGE_MODE)


@register("prediction_stats", O.with_ctes(
    _MULTI, "SELECT wallet, score_percentile, score_minmax, score_sigmoid, round((CAST(score_percentile AS DOUBLE) + "
            "score_minmax + score_sigmoid) / 3.0, 6) AS pred_mean, CAST(median([score_percentile, score_minmax, "
            "score_sigmoid]) AS DOUBLE) AS pred_median, CAST(least(score_percentile, score_minmax, score_sigmoid) AS DOUBLE) "
            "AS pred_min, CAST(greatest(score_percentile, score_minmax, score_sigmoid) AS DOUBLE) AS pred_max FROM ms"
    .replace("median([score_percentile, score_minmax, score_sigmoid])",
             "list_sort([score_percentile, score_minmax, score_sigmoid])[2]")))
def q_prediction_stats(spark, sf):
    """Row statistics over the three score transforms as prediction columns."""
    return out(EN.row_stats(_multi_scores(spark, sf), _MCOLS, "pred_"))


@register("model_correlation", O.with_ctes(
    _MULTI, " UNION ALL ".join(f"SELECT '{a}' AS model_a, '{b}' AS model_b, round({_corr_sql(a, b)}, 6) AS correlation FROM ms"
                               for a in _MCOLS for b in _MCOLS)))
def q_model_correlation(spark, sf):
    """Correlation matrix of prediction columns."""
    return out(EN.correlation_matrix(_multi_scores(spark, sf), _MCOLS))


@register("regression_metrics", O.with_ctes(
    _MULTI, " UNION ALL ".join(f"SELECT '{p}' AS model, round(avg(pow({p} - score_percentile, 2)), 6) AS mse, "
                               f"round(avg(abs({p} - score_percentile)), 6) AS mae FROM ms"
                               for p in ["score_minmax", "score_sigmoid"])))
def q_regression_metrics(spark, sf):
    """MSE / MAE of prediction columns against a label column."""
    return out(EN.regression_metrics(_multi_scores(spark, sf), "score_percentile", ["score_minmax", "score_sigmoid"]))


@register("tx_sequences", O.with_ctes(
    _CLEAN + """, r AS (SELECT account, "timestamp", event_type, amount,
  lag("timestamp") OVER (PARTITION BY account ORDER BY "timestamp", transaction_hash) AS p,
  row_number() OVER (PARTITION BY account ORDER BY "timestamp" DESC, transaction_hash DESC) AS fe FROM clean),
ev AS (SELECT account AS wallet, 10 - fe + 1 AS pos, CASE event_type WHEN 'Mint' THEN 1 WHEN 'Redeem' THEN 2
  WHEN 'Borrow' THEN 3 WHEN 'RepayBorrow' THEN 4 WHEN 'LiquidateBorrow' THEN 5 END AS event_code,
  COALESCE(amount, 0.0) AS amount, COALESCE(""" + O.days("p", '"timestamp"') + """, 0.0) AS gap_days FROM r WHERE fe <= 10),
grid AS (SELECT DISTINCT account AS wallet, pos FROM clean, range(1, 11) t(pos))""",
    "SELECT g.wallet, CAST(g.pos AS INTEGER) AS pos, CAST(COALESCE(event_code, 0) AS INTEGER) AS event_code, "
    "round(COALESCE(amount, 0.0), 6) AS amount, round(COALESCE(gap_days, 0.0), 6) AS gap_days "
    "FROM grid g LEFT JOIN ev ON g.wallet = ev.wallet AND g.pos = ev.pos"))
def q_tx_sequences(spark, sf):
    return out(SQ.tx_sequences(_tx(spark, sf), 10))


# ---------------------------------------------------------------- X1-X6 (streams over the events table)
from ledgerlens.streaming import incremental as ST  # noqa: E402


@register("stream_wallet_summary", O.with_ctes(
    _CLEAN, "SELECT account AS wallet, min(\"timestamp\") AS first_tx_timestamp, max(\"timestamp\") AS last_tx_timestamp, "
            "count(*) AS tx_count, " + ", ".join(
                f"CAST(count_if(event_type = '{e}') AS BIGINT) AS {n}" for e, n in
                (("Mint", "mint_count"), ("Redeem", "redeem_count"), ("Borrow", "borrow_count"),
                 ("RepayBorrow", "repay_count"), ("LiquidateBorrow", "liquidation_count")))
            + ", round(sum(CASE WHEN event_type = 'Mint' THEN amount END), 6) AS supply_volume, "
              "round(sum(CASE WHEN event_type = 'Borrow' THEN amount END), 6) AS borrow_volume FROM clean GROUP BY account"))
def q_stream_wallet_summary(spark, sf):
    """X1 + X3: streamed, cleaned events -> stateful wallet summary, upserted by
    bucket; equals the batch summary once the stream has consumed the table."""
    return out(ST.summary_table(spark, ST.running_summary(ST.event_stream(spark, sf))).read())


@register("stream_dedup", O.with_ctes(_CLEAN, "SELECT transaction_hash, account, event_type FROM clean"))
def q_stream_dedup(spark, sf):
    """Replay-safe ingestion with watermark-bounded dedup state: a second file
    holds a third of the events again."""
    path = _scratch(spark, "replays")
    e = read_table(spark, sf, "events")
    e.coalesce(1).write.parquet(f"{path}/events_a.parquet")
    e.where(F.col("event_id") % 3 == 0).coalesce(1).write.parquet(f"{path}/events_b.parquet")
    s = ST.dedup_events(ST.event_stream(spark, path), "60 days").select("transaction_hash", "account", "event_type")
    return ST.run_to_table(spark, s, "append")


@register("stream_window_activity", O.with_ctes(
    _CLEAN, "SELECT account AS wallet, to_timestamp(floor(epoch_us(\"timestamp\") / 3600000000) * 3600)::TIMESTAMP AS "
            "window_start, count(*) AS events, round(sum(amount), 6) AS volume FROM clean GROUP BY ALL"))
def q_stream_window_activity(spark, sf):
    """Hourly tumbling windows per wallet with a watermark."""
    t = ST.run_to_table(spark, ST.windowed_activity(ST.event_stream(spark, sf)), "update")
    return out(ST.latest(t.select("wallet", F.col("w.start").alias("window_start"), "events", "volume", "batch_id"),
                         ["wallet", "window_start"]))


@register("stream_sliding_activity", O.with_ctes(
    _CLEAN, "SELECT account AS wallet, to_timestamp((floor(epoch_us(\"timestamp\") / 900000000) - k) * 900)::TIMESTAMP AS window_start, count(*) AS events, "
            "round(sum(amount), 6) AS volume FROM clean, range(4) r(k) GROUP BY ALL"))
def q_stream_sliding_activity(spark, sf):
    """Hours that begin at each quarter of an hour."""
    t = ST.run_to_table(spark, ST.sliding_activity(ST.event_stream(spark, sf)), "update")
    return out(ST.latest(t.select("wallet", F.col("w.start").alias("window_start"), "events", "volume", "batch_id"), ["wallet", "window_start"]))


def _out_of_order(spark, sf):
    """The events as two files: a tenth of them comes after all others."""
    import time
    path = _scratch(spark, "late")
    e = read_table(spark, sf, "events")
    e.where(F.col("event_id") % 10 != 3).coalesce(1).write.parquet(f"{path}/a")
    time.sleep(0.05)    # files are read in the order of their times
    e.where(F.col("event_id") % 10 == 3).coalesce(1).write.parquet(f"{path}/b")
    use_utc(spark)
    raw = spark.readStream.schema(ST.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)
    return CL.clean_transactions(ST.adapt_events(raw, "dense"))


_LATE = (_CLEAN_DENSE + """, m AS (SELECT max("timestamp") - INTERVAL 20 DAY AS mark FROM clean WHERE CAST(transaction_hash AS BIGINT) % 10 <> 3),
la AS (SELECT clean.*, CAST(transaction_hash AS BIGINT) % 10 = 3 AND "timestamp" < mark AS late FROM clean CROSS JOIN m)""")


@register("stream_sessions", O.with_ctes(
    _LATE + """, g AS (SELECT account, "timestamp", CASE WHEN epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (PARTITION BY account ORDER BY "timestamp")) <= 21600000000
  THEN 0 ELSE 1 END AS nw FROM la WHERE NOT late),
i AS (SELECT *, sum(nw) OVER (PARTITION BY account ORDER BY "timestamp" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM g)""",
    """SELECT account AS wallet, min("timestamp") AS "start", max("timestamp") AS "end", count(*) AS events FROM i GROUP BY account, k"""))
def q_stream_sessions(spark, sf):
    """Sessions (gaps over six hours end them) of two files out of order, late
    rows (over 20 days) left out."""
    closed, still, _ = ST.sessions_to_tables(spark, _out_of_order(spark, sf), 21_600, 20 * 86_400)
    return out(closed.unionByName(still))


@register("stream_late_rows", O.with_ctes(_LATE, 'SELECT transaction_hash, account, "timestamp", late FROM la'))
def q_stream_late_rows(spark, sf):
    """Kept and late rows are together the input."""
    stream = _out_of_order(spark, sf)
    _, _, late = ST.sessions_to_tables(spark, stream, 21_600, 20 * 86_400)
    late = late.select("transaction_hash").distinct().withColumn("late", F.lit(True))
    return out(_tx(spark, sf, "events_dense").join(late, "transaction_hash", "left").select("transaction_hash", "account", "timestamp", F.coalesce("late", F.lit(False)).alias("late")))


@register("stream_interval_stats", O.with_ctes(
    _CLEAN + f", g AS ({O.gaps_sql('clean')}), w AS (SELECT DISTINCT account FROM clean)",
    "SELECT w.account AS wallet, count(g.gap) AS gaps, round(avg(g.gap), 6) AS avg_gap_days, "
    "round(stddev_pop(g.gap), 6) AS stddev_gap_days FROM w LEFT JOIN g USING (account) GROUP BY w.account"))
def q_stream_interval_stats(spark, sf):
    """Running inter-event gap statistics kept in applyInPandasWithState."""
    t = ST.run_to_table(spark, ST.interval_stats(ST.event_stream(spark, sf)), "update")
    return out(ST.latest(t, "wallet").drop("last_tx_us", "late_events"))


_RESCORE = {"tx_count": 0.5, "mint_count": 1.0, "borrow_count": -0.7, "liquidation_count": -2.0}


def _rescore_sql():
    part = lambda c, w: f"(({c} - mn_{c}) / CAST(mx_{c} - mn_{c} AS DOUBLE))" if w >= 0 else f"({O.d(1)} - ({c} - mn_{c}) / CAST(mx_{c} - mn_{c} AS DOUBLE))"
    total = " + ".join(f"CASE WHEN mx_{c} > mn_{c} THEN {part(c, w)} * {O.d(abs(w))} ELSE 0 END" for c, w in _RESCORE.items())
    raw = f"round(({total}) / {O.d(sum(abs(w) for w in _RESCORE.values()))}, 12)"
    return O.with_ctes(
        _ACT_CTES + ", st AS (SELECT " + ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in _RESCORE)
        + f" FROM act), rs AS (SELECT wallet, {raw} AS raw_score FROM act CROSS JOIN st), fin AS ({O.percentile_sql('rs')})",
        "SELECT wallet, round(raw_score, 6) AS raw_score, final_score FROM fin")


@register("stream_rescore", _rescore_sql())
def q_stream_rescore(spark, sf):
    """Touched wallets scored again per micro-batch, raw and 0-100, against
    minima, maxima and score cuts that were frozen from the batch table."""
    summary = P.stage(FE.wallet_summary(_tx(spark, sf)), P.STAGE_MODE)
    frozen = P.stage(SC.feature_stats(summary, list(_RESCORE)), P.STAGE_MODE)
    cuts = P.stage(ST.frozen_cuts(SC.final_score(P.stage(ST.rescore_batch(summary, frozen, _RESCORE), P.STAGE_MODE))), P.STAGE_MODE)
    return out(ST.rescored_stream(spark, ST.running_summary(ST.event_stream(spark, sf)), frozen, _RESCORE, cuts))


@register("one_class_svm")
def q_one_class_svm(spark, sf):
    """M1 -> M2 -> M4 (random-feature one-class SVM, nu = 0.05) -> rescale."""
    f = _feats(spark, sf)
    return out(AM.detect_anomalies_svm(f, f.count()))
