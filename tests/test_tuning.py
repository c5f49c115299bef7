"""Forests and boosting scored at every length from one fit."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerlens.operators import tuning as TU


def _data(spark, n=300):
    t = spark.range(n).selectExpr("concat('w', id) AS wallet", "(id * 37 % 101) / 50.0 AS x", "(id * 53 % 89) / 40.0 AS z")
    return t.withColumn("label", F.sin("x") + F.col("z") * F.col("x"))


def test_prefixes_are_smaller_models(spark):
    t = VectorAssembler(inputCols=["x", "z"], outputCol="scaled").transform(_data(spark)).cache()
    ev = RegressionEvaluator(labelCol="label", metricName="mse")
    gb = lambda n: TU.make_estimator("gradient_boosting", {"n_estimators": n, "max_depth": 3}, 300, 1.0).fit(t)
    got = TU.prefix_mse("gradient_boosting", gb(6), t, [2, 4, 6])
    assert got == {n: pytest.approx(ev.evaluate(gb(n).transform(t))) for n in (2, 4, 6)}
    rf = TU.make_estimator("random_forest", {"n_estimators": 5, "max_depth": 4}, 300, 1.0).fit(t)
    rows = t.collect()
    for n, mse in TU.prefix_mse("random_forest", rf, t, [1, 3, 5]).items():
        own = sum((sum(tree.predict(r.scaled) for tree in rf.trees[:n]) / n - r.label) ** 2 for r in rows) / len(rows)
        assert mse == pytest.approx(own)


def test_candidates_share_fits():
    grid = [TU.effective("random_forest", c) for c in TU._grid(TU.RF_GRID)]
    distinct = [dict(x) for x in {tuple(sorted(c.items())) for c in grid}]
    jobs = TU.fits("random_forest", distinct)
    assert len(distinct) == 27 and len(jobs) == 9 and all(p["n_estimators"] == 200 for p, _ in jobs)
    assert sorted(j for _, places in jobs for j in places.values()) == list(range(27))
    assert TU.fits("ridge", [{"alpha": 1.0}, {"alpha": 2.0}]) == [({"alpha": 1.0}, {None: 0}), ({"alpha": 2.0}, {None: 1})]


@pytest.mark.parametrize("model", ["random_forest", "gradient_boosting"])
def test_search_over_trees_equals_single_runs(spark, model):
    t = _data(spark, 120).cache()
    some = [{"n_estimators": n, "max_depth": d} for n in (2, 5) for d in (2, 4)]
    rows = TU.search(t, ["x", "z"], model, some, "grid_search", k=2)
    assert len(rows) == 4 and all(m > 0 for *_, m in rows)
    if model == "gradient_boosting":
        for p, (*_, m) in zip(some, rows, strict=True):
            assert m == pytest.approx(TU.cv_mse(t, ["x", "z"], model, p, k=2))


def test_a_loaded_anomaly_model_scores_as_before(spark, tmp_dir):
    from conftest import SF_SMALL
    from ledgerlens.operators import anomaly as AM
    from ledgerlens.plans import pipeline as P
    f = P.stage(P.features(P.cleaned(spark, SF_SMALL)))
    n = f.count()
    model = AM.fit_anomaly_model(f, n, n_trees=20)
    rows = lambda df: {r.wallet: (round(r.anomaly_score, 8), r.is_anomaly) for r in df.collect()}
    want = rows(model.score(f))
    model.save(tmp_dir)
    loaded = AM.AnomalyModel.load(spark, tmp_dir)
    assert rows(loaded.score(f)) == want == rows(AM.detect_anomalies(f, n, n_trees=20))
    far = f.limit(1).withColumn("tx_count", F.lit(10**9))
    assert 0 <= loaded.score(far).first().anomaly_score <= 1
