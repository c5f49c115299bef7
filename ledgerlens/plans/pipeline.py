"""The scoring pipeline as stages.

Each stage is ``fn(spark, inputs) -> DataFrame``; the boundaries are where the
reference writes a table.  Stage tables are materialised with
``session.stage`` (checkpoint to the shared folder by default), so the
per-wallet tables are computed once and each later stage starts from them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.config import DEFAULT_AS_OF
from ledgerlens.operators.clean import clean_transactions
from ledgerlens.operators.features import impute_features, raw_wallet_features
from ledgerlens.operators.scoring import final_score, score_wallets
from ledgerlens.schema import TEMPORAL_COLUMNS
from ledgerlens.session import stage
from ledgerlens.sources.adapters import transactions

STAGE_MODE = "table"


def cleaned(spark: SparkSession, sf_dir: str, source: str = "events_sparse") -> DataFrame:
    return clean_transactions(transactions(spark, sf_dir, source))


def observed(df: DataFrame, name: str):
    """Attach run counters to a stage (A15): rows and rows per event type are
    collected by the job that materialises the stage, no extra pass.  Returns
    (df, Observation); ``observation.get`` is available after that job."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("rows")]
    if "is_anomaly" in df.columns:
        aggs.append(F.count_if("is_anomaly").alias("anomalies"))
    if "event_type" in df.columns:
        aggs += [F.count_if(F.col("event_type") == e).alias(f"rows_{e}") for e in
                 ("Mint", "Redeem", "Borrow", "RepayBorrow", "LiquidateBorrow")]
    return df.observe(obs, *aggs), obs


def features(tx: DataFrame, as_of: _dt.datetime = DEFAULT_AS_OF, optimize: bool = True,
             liquidation_mode: str = "compat", how: str | None = None) -> DataFrame:
    raw = stage(raw_wallet_features(tx, as_of, optimize, liquidation_mode), how or STAGE_MODE)
    return impute_features(raw, nullable=set(TEMPORAL_COLUMNS), how=how or STAGE_MODE)


def scores(feats: DataFrame, anomaly: DataFrame | None = None, optimize: bool = True,
           weights: dict | None = None, how: str | None = None) -> DataFrame:
    return stage(score_wallets(feats, anomaly, weights, optimize), how or STAGE_MODE)


def run(spark: SparkSession, sf_dir: str, source: str = "events_sparse",
        as_of: _dt.datetime = DEFAULT_AS_OF, optimize: bool = True, method: str = "percentile",
        anomaly: DataFrame | None = None, how: str | None = None) -> DataFrame:
    """Whole pipeline: load -> clean -> features -> score -> final score."""
    tx = cleaned(spark, sf_dir, source)
    f = features(tx, as_of, optimize, how=how)
    s = scores(f, anomaly, optimize, how=how)
    return final_score(s, method)


STAGES = ["load", "features", "anomaly", "scores", "final"]


def run_stages(spark: SparkSession, sf_dir: str, out_dir: str, skip_to: str | None = None,
               source: str = "events_sparse", as_of: _dt.datetime = DEFAULT_AS_OF, optimize: bool = True,
               method: str = "percentile", with_anomaly: bool = True, top_n: int = 1000) -> dict:
    """Stage-resumable run (S15): each stage writes its table under
    ``out_dir`` (a shared folder); ``skip_to`` starts from a named stage and
    reads the previous stage's table instead of recomputing it.  Returns the
    stage tables as DataFrames plus ``counters``: what each stage that ran counted
    while it was written (A15)."""
    from ledgerlens.operators import anomaly as AM
    from ledgerlens.operators.scoring import top_wallets
    from ledgerlens.sources.sinks import write_csv, write_stage
    start = STAGES.index(skip_to) if skip_to else 0
    path = lambda name: f"{out_dir.rstrip('/')}/{name}"
    out, seen = {}, {}

    def counted(df, name):
        df, seen[name] = observed(df, name)
        return df

    if start <= 0:
        write_stage(counted(cleaned(spark, sf_dir, source), "load"), path("cleaned_transactions"), sort_by=["account", "timestamp"])
    tx = spark.read.parquet(path("cleaned_transactions"))
    if start <= 1:
        raw_wallet_features(tx, as_of, optimize).write.mode("overwrite").parquet(path("wallet_features_raw"))
    raw = spark.read.parquet(path("wallet_features_raw"))
    feats = impute_features(raw, nullable=set(TEMPORAL_COLUMNS))
    if start <= 1:
        counted(feats, "features").write.mode("overwrite").parquet(path("wallet_features"))
    feats = spark.read.parquet(path("wallet_features"))
    anomaly = None
    if with_anomaly:
        if start <= 2:
            counted(AM.detect_anomalies(feats, feats.count()), "anomaly").write.mode("overwrite").parquet(path("anomaly_scores"))
        anomaly = spark.read.parquet(path("anomaly_scores"))
    if start <= 3:
        counted(score_wallets(feats, anomaly, None, optimize), "scores").write.mode("overwrite").parquet(path("wallet_scores"))
    scored = spark.read.parquet(path("wallet_scores"))
    fin = final_score(scored, method)
    counted(fin, "final").write.mode("overwrite").parquet(path("all_wallet_scores"))
    fin = spark.read.parquet(path("all_wallet_scores"))
    write_csv(top_wallets(fin, top_n), path("wallet_scores_csv"))
    out.update(transactions=tx, features=feats, anomaly=anomaly, scores=scored, final=fin,
               counters={name: obs.get for name, obs in seen.items()})
    return out
