"""Operator 6: held-out accuracy, the chain's parts, and defined results at the edges."""

import math

import numpy as np
import pytest

from ledgerlens.llm import toxicity_chain as T

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    chain = T.train(docs, labels.filter("doc_id % 4 != 0"))
    out = T.score(docs, chain).join(labels, "doc_id").filter("doc_id % 4 = 0").join(docs.select("doc_id", "lang"), "doc_id").collect()
    clean = [r for r in out if r.toxic == 0]
    assert len(out) > 80 and sum(r.rejected for r in clean) <= 0.02 * len(clean)
    english = [r for r in out if r.toxic == 1 and r.lang == "en"]
    assert sum(r.rejected for r in english) >= 0.7 * len(english)
    assert chain.names == ["low_quality", "toxic"] and len(chain.models) == 2
    # The second model has a coefficient for the first category, the first none for either.
    k = 2 * len(chain.features)
    assert chain.models[1][k] != 0 == chain.models[1][k + 1] and not chain.models[0][k:k + 2].any()
    again = T.train(docs.repartition(5), labels.filter("doc_id % 4 != 0").repartition(3))
    assert all(np.allclose(a, b) for a, b in zip(chain.models, again.models, strict=True))


def planted(spark, n=300):
    rows = [(i, f"some plain words number {i} here" + (" awful nastyword stuff" if i % 3 == 0 else " and more"), "x") for i in range(n)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, toxic string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_filter_and_odd_rows(spark):
    docs, labels = planted(spark)
    more = docs.unionByName(spark.createDataFrame([(None, "nastyword awful", "x"), (1000, None, "x"), (1001, "", "x"), (1002, "plain " * 50_000, "x"), (0, "some plain words and more", "x")], docs.schema))
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 1), (5, None, 1), (6, 1, None), (7, 1, 0), (7, 1, 0), (10**9, 0, 1)], labels.schema))
    chain = T.train(more, odd)
    out = T.score(more, chain)
    assert out.count() == more.count()
    verdict = {(r.doc_id, r.rejected) for r in out.collect()}
    assert {(i, i % 3 == 0) for i in range(1, 300)} <= verdict
    assert (None, True) in verdict and {(1000, False), (1001, False), (1002, False), (0, False), (0, True)} <= verdict
    kept = T.drop_toxic(more, chain)
    assert kept.columns == more.columns and kept.count() == out.filter("not rejected").count()
    assert T.score(more.limit(0), chain).count() == 0


@pytest.mark.parametrize("where", ["false", "toxic = 0", "toxic = 1"])
def test_without_two_classes_nothing_breaks(spark, where):
    docs, labels = planted(spark, 60)
    out = T.score(docs, T.train(docs, labels.filter(where))).collect()
    assert {r.rejected for r in out} == {where == "toxic = 1"}


def test_sample_is_bounded_and_weighted_back(spark):
    docs, labels = planted(spark)
    rows = T.training_sample(docs, labels, rows=40).collect()
    assert len(rows) < 140
    for c, n in ((1, 100), (0, 200)):
        mine = [r.weight for r in rows if r.y[1] == c]
        assert mine and abs(sum(mine) - n) < 0.5 * n
    assert {r["_id"] for r in T.training_sample(docs, labels).collect()} == set(range(300))


def test_documents_of_one_id_count_once(spark):
    docs, labels = planted(spark, 40)
    many = docs.unionByName(spark.range(3000).selectExpr("1L AS doc_id", "concat('words number ', id) AS text", "'x' AS toxic"))
    sample = T.training_sample(many, labels, rows=10)
    assert sample.count() == sample.select("_id").distinct().count() <= 40
    assert T.training_sample(many, labels).count() == 40


def test_chain_by_hand():
    """Probabilities of a fitted chain against the models applied one by one, and
    the columns the later models were fitted on against refits without the fold."""
    rng = np.random.default_rng(1)
    names, features = ["a", "b"], ["f", "g", "h"]
    vectors = [(np.array([0, 1, 2, 3, 4, 5]), rng.normal(size=6)) for _ in range(200)]
    chain = T.Chain(features, names)
    x = chain.matrix(vectors)
    plain = x.astype(float).copy()
    y = np.column_stack([(plain[:, 0] + rng.normal(size=200) > 0), (plain[:, 0] + plain[:, 1] + rng.normal(size=200) > 0)]).astype(float)
    fold, weight = rng.integers(0, T.FOLDS, 200), np.ones(200)
    scales = [{"f": 1.0, "g": 1.0}, {"g": 1.0, "h": 1.0}]
    chain.fit(x, y, weight, fold, scales)
    scale = np.array([1, 1, 0, 1, 1, 0, 0, 0, 1.0])
    for k in range(T.FOLDS):
        w = T.fit_logistic(plain.astype(np.float32)[fold != k], y[fold != k, 0], weight[fold != k], scale)
        want = np.clip(plain[fold == k] @ w, -20, 20) / 4
        assert np.abs(x[fold == k, 6] - want).max() < 1e-3
    for (_, v), p in zip(vectors, chain.probabilities(vectors), strict=True):
        first = float(chain.models[0][:6] @ v + chain.models[0][8])
        second = float(chain.models[1][:6] @ v + chain.models[1][6] * first / 4 + chain.models[1][8])
        assert np.abs(p - [1 / (1 + math.exp(-first)), 1 / (1 + math.exp(-second))]).max() < 1e-5


def test_newton_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.normal(size=(400, 5)), np.ones(400)]).astype(np.float32)
    y = (rng.random(400) < 1 / (1 + np.exp(-x[:, 0] + 0.5))).astype(float)
    weight, scale = rng.random(400), np.array([1, 2, 0, 1, 0.5, 1])
    w = T.fit_logistic(x, y, weight, scale)
    p = 1 / (1 + np.exp(-x.astype(float) @ w))
    slope = (x.astype(float).T @ (weight * (p - y))) * scale
    back = np.divide(w, scale, out=np.zeros(6), where=scale > 0)
    assert w[2] == 0 and np.abs(slope + np.array([1, 1, 0, 1, 1, 0]) * back).max() < 1e-3
