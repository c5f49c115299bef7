"""Work that is done once, whatever uses its result, and spread over tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators import anomaly as AM
from ledgerlens.operators import selection as SE
from ledgerlens.operators import tuning as TU
from ledgerlens.operators.ranking import value_positions
from ledgerlens.plans import pipeline as P


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def plain(spark):
    """Plans as they are written down, without sizes measured at run time."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(keep, ("false", "-1")):
        spark.conf.set(k, v)
    yield spark
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_one_group_is_ranked_by_many_tasks(plain):
    df = plain.range(5000).select(F.lit("all").alias("g"), (F.col("id") * 7 % 4001).cast("double").alias("v"))
    p = value_positions(df, "v", ["g"])
    assert p.select(F.spark_partition_id()).distinct().count() > 4
    want, at = {}, 1
    for v, c in zip(*np.unique([i * 7 % 4001 for i in range(5000)], return_counts=True)):
        want[float(v)], at = at, at + int(c)
    assert {r.v: r.pos for r in p.collect()} == want


def test_medians_are_computed_once(spark):
    assert "percentile_approx" not in _plan(P.features(P.cleaned(spark, SF_SMALL)))


def test_scores_are_computed_once(spark):
    pts = spark.range(50).select(F.concat(F.lit("w"), "id").alias("wallet"), F.array(F.col("id").cast("double")).alias("features"))
    sc = AM.score_isolation_forest(pts, AM.fit_isolation_forest(pts, 50, n_trees=5), 50)
    assert "MapInPandas" not in _plan(AM.rescale_decision(AM.decision_from_scores(sc)))


def test_pairs_are_compiled_and_skip_missing_values(plain):
    n = SE.PAIR_BLOCK + 3
    t = plain.range(300).select(*[F.when(F.col("id") % (7 + i) > 0, F.sin(F.col("id") * (i + 1)) + F.col("id") / (50 + i)).alias(f"c{i}") for i in range(n)], F.lit(2.0).alias("same"))
    pairs = SE.pair_correlations(t)
    lines = [x.strip(" :+-") for x in _plan(pairs).splitlines() if "HashAggregate" in x]
    assert lines and all(x.startswith("*") for x in lines)
    pdf = t.toPandas()
    got = {(r.feature_a, r.feature_b): r.correlation for r in pairs.collect()}
    assert len(got) == (n + 1) * n // 2 and got["c0", "same"] is None
    full = t.dropna()
    assert {(r.feature_a, r.feature_b): r.correlation for r in SE.pair_correlations(full).collect()}["c1", "c12"] == pytest.approx(full.toPandas()[["c1", "c12"]].corr().iloc[0, 1])
    assert pdf.shape[0] == 300


def test_linear_candidates_use_moments(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    t = spark.range(400).selectExpr("(id * 37 % 101) / 50.0 AS x", "(id * 53 % 89) / 40.0 AS z", "0.0 AS same", "sin(id) + (id * 37 % 101) / 30.0 + 5 AS label")
    t = VectorAssembler(inputCols=["x", "z", "same"], outputCol="scaled").transform(t).select("scaled", "label")
    small = TU.moment_rows(t)
    assert small.count() == 8 and small.agg(F.sum("weight")).first()[0] == pytest.approx(400)
    for model, params in (("ridge", {"alpha": 3.0}), ("lasso", {"alpha": 0.05}), ("elastic_net", {"alpha": 0.1, "l1_ratio": 0.5})):
        est = TU.make_estimator(model, params, 400, 1.0)
        m, q = est.fit(t), est.copy().setWeightCol("weight").fit(small)
        assert q.coefficients.toArray() == pytest.approx(m.coefficients.toArray(), abs=1e-5) and q.intercept == pytest.approx(m.intercept, abs=1e-5)
        ev = RegressionEvaluator(labelCol="label", metricName="mse")
        assert ev.copy().setWeightCol("weight").evaluate(m.transform(small)) == pytest.approx(ev.evaluate(m.transform(t)))


def test_elimination_starts_from_known_importances(spark, monkeypatch):
    t = spark.range(200).select(F.concat(F.lit("w"), "id").alias("wallet"), *[F.rand(i).alias(f"c{i}") for i in range(4)], F.rand(9).alias("label"))
    made, real = [], SE.rf_importance
    monkeypatch.setattr(SE, "rf_importance", lambda *a, **k: made.append(1) or real(*(a[:2] or ()), n_trees=3, max_depth=3))
    SE.select_features(t, "rfe", 3)
    assert len(made) == 1


def test_forests_keep_the_nodes_of_rows(spark, monkeypatch):
    """The same trees as without, and the same settings wherever a forest is fitted."""
    from pyspark.ml.regression import RandomForestRegressor
    t = spark.range(400).select(F.concat(F.lit("w"), "id").alias("wallet"), F.sin("id").alias("a"), F.cos(F.col("id") * 3).alias("b"), (F.sin("id") * F.cos(F.col("id") * 3)).alias("label"))
    want = RandomForestRegressor(numTrees=4, maxDepth=6, seed=42, labelCol="label").fit(SE._assemble(t, ["a", "b"])).featureImportances.toArray()
    seen, real = [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda est, *a: seen.append(est.getCacheNodeIds()) or real(est, *a))
    assert {r.feature: r.importance for r in SE.rf_importance(t, n_trees=4, max_depth=6).collect()} == dict(zip("ab", want.tolist(), strict=True))
    TU.search(t, ["a", "b"], "random_forest", [{"n_estimators": 2, "max_depth": 3}], "grid_search", k=2)
    assert seen == [True] * 3


def test_forests_read_alike_rows_one_after_the_other(spark, monkeypatch):
    """Within partitions, for elimination and the votes; a single partition keeps its order."""
    from pyspark.ml.regression import RandomForestRegressor
    t = spark.range(600).selectExpr("concat('w', id) AS wallet", "sin(id) AS many", "CAST(id * 37 % 3 AS DOUBLE) AS few", "cos(id) + id * 37 % 3 AS label")
    many, one = (t.repartition(n, "wallet").cache() for n in (3, 1))
    seen, real = [], RandomForestRegressor.fit

    def places(d, col):
        return [[float(x) for x in part] for part in d.select(col).rdd.map(lambda r: r[0]).glom().collect()]

    def fit(est, d, *a):
        seen.append(places(d, "label"))
        return real(est.copy({est.numTrees: 2, est.maxDepth: 2}), d, *a)

    monkeypatch.setattr(RandomForestRegressor, "fit", fit)
    keys = lambda df: [sorted(map(tuple, p)) for p in df.select("few", "many", "label").rdd.glom().collect()]
    for df, want in ((many, [[float(r[2]) for r in p] for p in keys(many)]), (one, places(one, "label"))):
        seen.clear()
        SE.recursive_elimination(df, 1)
        SE.select_features(df, "rfe", 1)
        assert len(seen) == 2 and all(s == want for s in seen)


def test_models_share_one_scaled_table(spark, monkeypatch):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from ledgerlens.operators import ensemble as EN
    t = spark.range(300).selectExpr("concat('w', id) AS wallet", "(id * 37 % 101) / 50.0 AS x", "(id * 53 % 89) / 40.0 AS z", "sin(id) + id % 7 AS label").cache()
    best = {"ridge": {"alpha": 1.0}, "lasso": {"alpha": 0.01}, "random_forest": {"n_estimators": 3, "max_depth": 4}, "gradient_boosting": {"n_estimators": 3, "max_depth": 2}}
    n, sd = TU.label_stats(t)
    alone = {m: Pipeline(stages=[VectorAssembler(inputCols=["x", "z"], outputCol="features"), StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
                                 TU.make_estimator(m, p, n, sd)]).fit(t) for m, p in best.items()}
    made, real = [], StandardScaler.fit
    monkeypatch.setattr(StandardScaler, "fit", lambda est, *a: made.append(1) or real(est, *a))
    models = EN.fit_models(t, ["x", "z"], best)
    assert len(made) == 1 and list(models) == list(best)
    rows = lambda ms: sorted(map(tuple, EN.predict_all(ms, t).select("wallet", *[f"score_{m}" for m in best]).collect()))
    for got, want in zip(rows(models), rows(alone), strict=True):
        assert got[0] == want[0] and got[1:] == pytest.approx(want[1:])


def test_statistics_of_standardised_features_are_computed_once(spark):
    t = spark.range(50).selectExpr("concat('w', id) AS wallet", "CAST(id AS DOUBLE) AS a")
    assert "stddev_pop" not in _plan(AM.standardize(t))
