"""Paths that only large or awkward inputs take, on small ones."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators import ensemble as EN
from ledgerlens.operators import ordered as OR
from ledgerlens.operators import scoring as SC
from ledgerlens.operators import selection as SE
from ledgerlens.operators import tuning as TU
from ledgerlens.streaming import incremental as ST


def _hot_day(spark, n=6000):
    """Half of the rows are one account's on one day, half of these within a second."""
    t0 = dt.datetime(2024, 1, 5)
    us = F.when(F.col("id") % 4 == 0, F.col("id") * 13_000_000).when(F.col("id") % 4 == 1, F.col("id") * 7) \
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(40 * 86_400_000_000)))
    return spark.range(n).select(
        F.when(F.col("id") % 4 < 2, F.lit("hot")).otherwise(F.concat(F.lit("w"), F.col("id") % 50)).alias("account"),
        F.timestamp_micros(F.lit(int(t0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)) + us).alias("timestamp"),
        F.col("id").cast("string").alias("transaction_hash"), F.rand(3).alias("v"))


def test_a_hot_day_is_cut_by_the_data(spark, monkeypatch):
    monkeypatch.setattr(OR, "CHUNK_ROWS", 100)
    df = _hot_day(spark).cache()
    sizes = OR.with_chunks(df, "account", "timestamp").groupBy("account", "_chunk").count()
    whole = df.groupBy("account", F.to_date("timestamp")).count().agg(F.max("count")).first()[0]
    assert whole >= 2900 and sizes.agg(F.max("count")).first()[0] <= 250
    w = Window.partitionBy("account").orderBy("timestamp", "transaction_hash")
    plain = df.withColumns({"p": F.lag("timestamp").over(w), "s": F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)),
                            "n": F.lead("timestamp").over(w)})
    got = OR.with_neighbors(df, tiebreak=("transaction_hash",))
    got = OR.running_sums(got, "account", ["timestamp", "transaction_hash"], {"rs": F.col("v")})
    bad = got.join(plain.select("transaction_hash", "p", "n", "s"), "transaction_hash").where(
        ~F.col("p").eqNullSafe(F.col("prev_ts")) | ~F.col("n").eqNullSafe(F.col("next_ts")) | (F.abs(F.col("rs") - F.col("s")) > 1e-9))
    assert bad.count() == 0
    gaps = OR.consecutive_gaps(df).groupBy("account").agg(F.count("gap_us").alias("k"), F.sum("gap_us").alias("t"))
    want = plain.where("n is not null").groupBy("account").agg(F.count("n").alias("k"), F.sum(OR.gap_us("timestamp", "n")).alias("t"))
    assert gaps.exceptAll(want).count() == 0 == want.exceptAll(gaps).count()


def test_no_row_is_cut_where_nothing_is_hot(spark):
    df = _hot_day(spark, 400)
    assert OR.with_chunks(df, "account", "timestamp").where(F.col("_chunk") % (1 << OR.PART_BITS) != 0).count() == 0


def _split_by_time(spark, folder, parts=2):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("part", F.ntile(parts).over(Window.orderBy("ts")))
    for i in range(parts):
        e.where(F.col("part") == i + 1).drop("part").coalesce(1).write.parquet(os.path.join(folder, f"events_{i}.parquet"))


def test_streams_over_two_files_in_order(spark, tmp_dir):
    from ledgerlens.operators.features import temporal_features
    from ledgerlens.plans.pipeline import cleaned
    _split_by_time(spark, tmp_dir)
    rows = ST.run_to_table(spark, ST.interval_stats(ST.event_stream(spark, tmp_dir)), "update")
    got = ST.latest(rows, "wallet")
    assert got.count() == got.select("wallet").distinct().count() < rows.count()
    batch = temporal_features(cleaned(spark, SF_SMALL)).select("wallet", "avg_time_between_tx_days", "activity_consistency_stddev")
    both = got.where("gaps > 0").join(batch, "wallet")
    assert both.count() == batch.count()
    assert both.where((F.abs(F.col("avg_gap_days") - F.col("avg_time_between_tx_days")) > 1e-9)
                      | (F.abs(F.col("stddev_gap_days") - F.col("activity_consistency_stddev")) > 1e-6)).count() == 0
    assert got.agg(F.sum("late_events")).first()[0] == 0
    report = {}
    windows = ST.latest(ST.run_to_table(spark, ST.windowed_activity(ST.event_stream(spark, tmp_dir)), "update", report=report)
                        .select("wallet", F.col("w.start").alias("at"), "events", "volume", "batch_id"), ["wallet", "at"])
    total = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert windows.agg(F.sum("events")).first()[0] + report["late_rows"] == total


def test_interval_groups_hold_many_wallets_and_arrow_may_cut_them(spark, tmp_dir, monkeypatch):
    """A call per wallet took milliseconds each."""
    from ledgerlens.operators.features import temporal_features
    from ledgerlens.plans.pipeline import cleaned
    _split_by_time(spark, tmp_dir)
    batch = temporal_features(cleaned(spark, SF_SMALL)).select("wallet", "avg_time_between_tx_days", "activity_consistency_stddev")
    calls = spark.sparkContext.accumulator(0)
    real = ST._interval_update

    def counted(key, batches, state):
        calls.add(1)
        yield from real(key, batches, state)

    monkeypatch.setattr(ST, "_interval_update", counted)
    monkeypatch.setattr(ST, "INTERVAL_BUCKETS", 4, raising=False)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = ST.latest(ST.run_to_table(spark, ST.interval_stats(ST.event_stream(spark, tmp_dir))), "wallet")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert 0 < calls.value <= 8
    assert got.agg(F.sum("late_events")).first()[0] == 0
    both = got.where("gaps > 0").join(batch, "wallet")
    assert both.count() == batch.count() == got.where("gaps > 0").count()
    assert both.where((F.abs(F.col("avg_gap_days") - F.col("avg_time_between_tx_days")) > 1e-9)
                      | (F.abs(F.col("stddev_gap_days") - F.col("activity_consistency_stddev")) > 1e-6)).count() == 0


def test_late_events_are_counted_not_misplaced(spark):
    import pandas as pd

    class State:
        exists, get = False, None

        def update(self, v):
            self.exists, self.get = True, v

    s = State()
    day = 86_400_000_000
    for us in ([0, 3 * day, day], [2 * day, 5 * day]):
        out = next(ST._interval_update(("w",), [pd.DataFrame({"us": us})], s))
    r = out.iloc[0]
    assert (r["gaps"], r["late_events"]) == (3, 1)
    assert r["avg_gap_days"] == pytest.approx(5 / 3) and r["stddev_gap_days"] == pytest.approx(np.std([1, 2, 2]))


def test_ridge_penalty_is_that_of_the_fold(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = x @ [1.0, 2.0, -1.0] + rng.normal(size=200)
    train = spark.createDataFrame([(f"w{i}", *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))],
                                  "wallet string, a double, b double, c double, label double")
    folds = {r.wallet: r.fold for r in TU.fold_column(train, 5).collect()}
    fold = np.array([folds[f"w{i}"] for i in range(200)])
    want = 0.0
    for k in range(5):
        fit = fold != k
        mean, sd = x[fit].mean(axis=0), x[fit].std(axis=0, ddof=1)
        z, t = (x - mean) / sd, y[fit].mean()
        w = np.linalg.solve(z[fit].T @ z[fit] + 50.0 * np.eye(3), z[fit].T @ (y[fit] - t))
        want += float(((z[~fit] @ w + t - y[~fit]) ** 2).mean()) / 5
    assert TU.cv_mse(train, ["a", "b", "c"], "ridge", {"alpha": 50.0}) == pytest.approx(want, rel=1e-6)


def test_search_rows_name_what_took_effect():
    assert TU.effective("random_forest", {"max_depth": None, "min_samples_split": 5, "n_estimators": 50}) == {"max_depth": 30, "n_estimators": 50}
    draws = TU.draw(TU.RANDOM["ridge"], 30)
    assert len(draws) == 20 == len({d["alpha"] for d in draws}) and min(d["alpha"] for d in draws) == pytest.approx(1e-3)
    assert all(d["n_estimators"] % 10 == 0 for d in TU.draw(TU.RANDOM["random_forest"], 30))


def _train(spark):
    rows = spark.range(1000).select(F.concat(F.lit("w"), "id").alias("wallet"), F.col("id").cast("double").alias("x"),
                                    F.exp(F.col("id") / 50).alias("steep"), (-F.col("id")).cast("double").alias("down"),
                                    F.rand(1).alias("noise"), F.col("id").cast("double").alias("label"))
    return rows


def test_mutual_information_ignores_a_monotone_change(spark):
    got = {r.feature: r.mutual_info for r in SE.mutual_info_ranking(_train(spark)).collect()}
    assert got["x"] == pytest.approx(got["steep"]) == pytest.approx(got["down"]) == pytest.approx(np.log(10))
    assert got["noise"] < 0.2


def test_redundant_pairs_are_signed(spark):
    pairs = {(r.feature_a, r.feature_b) for r in SE.redundant_pairs(_train(spark).drop("steep")).collect()}
    assert pairs == set()
    both = _train(spark).withColumn("twice", F.col("x") * 2)
    assert ("x", "twice") in {(r.feature_a, r.feature_b) for r in SE.redundant_pairs(both).collect()}
    m = {(r.feature_a, r.feature_b): r.correlation for r in SE.correlation_matrix(both).collect()}
    assert len(m) == 25 and m["x", "x"] == pytest.approx(1) and m["x", "down"] == pytest.approx(-1) == pytest.approx(m["down", "x"])


def test_stacked_prediction_comes_from_refitted_bases(spark):
    t = _train(spark).limit(300)
    out = EN.stacked_predictions(t, ["x", "noise"], {"ridge": {"alpha": 1.0}, "lasso": {"alpha": 0.01}})
    assert out.count() == 300
    full = EN.predict_all(EN.fit_models(t, ["x", "noise"], {"ridge": {"alpha": 1.0}}), t)
    assert out.join(full.select("wallet", F.col("score_ridge").alias("r")), "wallet").where(F.abs(F.col("r") - F.col("score_ridge")) > 1e-9).count() == 0


def test_constant_scores_and_pass_through(spark):
    same = spark.createDataFrame([("a", 0.3), ("b", 0.3)], "wallet string, raw_score double")
    assert {r.final_score for r in SC.final_score(same, "min_max").collect()} == {50}
    given = spark.createDataFrame([("a", 17), ("b", 80)], "wallet string, credit_score int")
    assert {r.wallet: r.final_score for r in SC.final_score(given).collect()} == {"a": 17, "b": 80}


def test_every_declared_rule_fires(spark):
    from ledgerlens.plans.catalog import _ALL_RULES, q_final_scores_declared
    got = q_final_scores_declared(spark, "/root/testdata/sf0.01")
    counts = got.agg(*[F.count(k).alias(k) for k in _ALL_RULES], F.min("liquidation_penalty").alias("least")).first()
    assert counts["least"] == -0.5
    assert {k for k in _ALL_RULES if counts[k]} >= {"liquidation_penalty", "high_ltv_penalty", "consistency_bonus", "inactivity_penalty"}


def test_final_scores_are_computed_once(spark, monkeypatch):
    from ledgerlens.plans import catalog as CA
    made = []
    real = SC.final_score
    monkeypatch.setattr(CA.SC, "final_score", lambda *a, **k: made.append(1) or real(*a, **k))
    for name in ("score_overall", "score_feature_corr", "top_bottom_wallets", "dedup_wallets", "wallet_timeline"):
        made.clear()
        plan = CA.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert len(made) == 1
        # The aggregation of the log is behind the staged table, not in the query that reads it.
        assert "events.parquet" not in plan or name == "wallet_timeline"
