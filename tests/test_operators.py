"""Operator semantics on hand-made edge fixtures (FIXTURES.md section 3)."""

import datetime as dt
import json
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.columns import normalize_event_type, parse_timestamp, standardize_address
from ledgerlens.operators import clean as CL
from ledgerlens.operators import features as FE
from ledgerlens.operators import scoring as SC
from ledgerlens.operators.ranking import exact_medians, percentile_rank_min


def test_event_names(spark):
    raw = [" mint", "\tSupply ", "WITHDRAW", "Repayment", "repayborrow", "Liquidation", "liquidate_borrow", "",
           "Borrow", "LIQUIDATEBORROW", None]
    df = spark.createDataFrame([(r,) for r in raw], "e string")
    got = [r[0] for r in df.select(normalize_event_type("e")).collect()]
    assert got[:5] == ["Mint", "Mint", "Redeem", "RepayBorrow", "RepayBorrow"]
    assert got[8:10] == ["Borrow", "LiquidateBorrow"]
    tx = df.select(F.col("e").alias("event_type"), F.lit("a").alias("account"),
                   F.current_timestamp().alias("timestamp"))
    kept = sorted(r[0] for r in CL.clean_transactions(tx).select("event_type").collect())
    assert kept == ["Borrow", "LiquidateBorrow", "Mint", "Mint", "Redeem", "RepayBorrow", "RepayBorrow"]


def test_timestamps_and_addresses(spark):
    df = spark.createDataFrame([("1600000000",), ("1600000000.5",), ("2020-09-13 12:26:40",), ("garbage",), (None,)],
                               "t string")
    got = [r[0] for r in df.select(parse_timestamp("t").cast("string")).collect()]
    assert got[0] == "2020-09-13 12:26:40" and got[1] == "2020-09-13 12:26:40.5"
    assert got[2] == "2020-09-13 12:26:40" and got[3] is None and got[4] is None
    a = spark.createDataFrame([("0xAbC",), ("0XAB",), ("abc",), (None,)], "a string")
    assert [r[0] for r in a.select(standardize_address("a")).collect()] == ["abc", "0xab", "abc", None]


def test_amount_coercion_keeps_big_numbers(spark):
    df = spark.createDataFrame([("1234567890123456789012", "x")], "amount string, s string")
    r = CL.coerce_amount_columns(df).first()
    assert r["amount"] == pytest.approx(1.234567890123456789012e21)
    assert r["s"] == "x"


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_nested_json_and_fallbacks(spark, tmp_dir):
    from ledgerlens.sources.files import UnsupportedFile, load_and_process, read_json
    ev = lambda acct, amt, h: {"account": {"id": acct} if acct else None, "asset": {"id": "0xTok", "symbol": "T"},  # noqa
                               "amount": amt, "amountUSD": "1.5", "hash": h, "timestamp": "1600000000"}
    doc = {"deposits": [ev("0xA", "1234567890123456789012", "h1"), ev(None, "5", "h2")],
           "borrows": [ev("0xB", 7, "h3")], "withdraws": [], "repays": [], "liquidations": []}
    p1 = _write(os.path.join(tmp_dir, "nested.json"), json.dumps(doc, indent=2))
    empty = {"deposits": [], "withdraws": [], "borrows": [], "repays": [], "liquidations": [],
             "Mint": [{"account": "0xC", "amount": 3, "timestamp": 1600000100, "hash": "h4"}]}
    p2 = _write(os.path.join(tmp_dir, "empty.json"), json.dumps(empty))
    p3 = _write(os.path.join(tmp_dir, "flat.json"), json.dumps([{"event_type": "Borrow", "account": "0xD",
                                                                   "amount": 1, "timestamp": 1600000200}] * 3))
    p4 = _write(os.path.join(tmp_dir, "single.json"), json.dumps({"event_type": "Redeem", "account": "0xE",
                                                                   "amount": 2, "timestamp": 1600000300}))
    p5 = _write(os.path.join(tmp_dir, "scalar.json"), "42")
    assert read_json(spark, p1).count() == 3
    tx, rejected = load_and_process(spark, [p1, p2, p3, p4, p5])
    c = CL.clean_transactions(tx)
    got = sorted((r["account"], r["event_type"]) for r in c.collect())
    assert got == [("a", "Mint"), ("b", "Borrow"), ("c", "Mint"), ("d", "Borrow"), ("d", "Borrow"), ("d", "Borrow"),
                   ("e", "Redeem")]
    big = c.where(F.col("transaction_hash") == "h1").first()["amount"]
    assert big == pytest.approx(1.234567890123456789012e21)
    assert [r["path"].endswith("scalar.json") for r in rejected.collect()] == [True]
    with pytest.raises(UnsupportedFile):
        load_and_process(spark, [p5])


def test_csv_sniffing_aliases_and_event_inference(spark, tmp_dir):
    from ledgerlens.sources.files import load_and_process
    p = _write(os.path.join(tmp_dir, "semi.csv"),
               "block_timestamp;minter;tx_hash;asset;amount_decimal\n"
               "1600000000;0xAA;h1;0xT;1.5\n1600000060;0xAA;h2;0xT;2.5\n")
    tx, _ = load_and_process(spark, [p])
    rows = CL.clean_transactions(tx).orderBy("transaction_hash").collect()
    assert [r["event_type"] for r in rows] == ["Mint", "Mint"]          # inferred from the minter column
    assert [r["account"] for r in rows] == ["aa", "aa"] and rows[1]["amount"] == 2.5
    assert str(rows[0]["timestamp"]) == "2020-09-13 12:26:40"


def _tx(spark, rows):
    return spark.createDataFrame(
        [(e, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), a, liq, tok, amt) for e, h, a, liq, tok, amt in rows],
        "event_type string, timestamp timestamp, account string, liquidator string, token string, amount double")


def test_liquidation_roles_compat_and_corrected(spark):
    tx = _tx(spark, [("LiquidateBorrow", 1, "a", "a", "t", 1.0), ("LiquidateBorrow", 2, "a", "b", "t", 1.0),
                     ("Mint", 3, "b", None, "t", 5.0)])
    c = {r["wallet"]: r for r in FE.wallet_activity(tx, "compat").collect()}
    k = {r["wallet"]: r for r in FE.wallet_activity(tx, "corrected").collect()}
    assert (c["a"]["liquidation_count_borrower"], c["a"]["liquidation_count_liquidator"]) == (2, 1)
    assert c["b"]["liquidation_count_liquidator"] == 0 and k["b"]["liquidation_count_liquidator"] == 1
    assert k["a"]["liquidation_count_liquidator"] == 1
    no_liq = FE.wallet_activity(tx.drop("liquidator")).where("wallet = 'a'").first()
    assert (no_liq["liquidation_count_borrower"], no_liq["liquidation_count_liquidator"]) == (0, 0)


def test_single_tx_wallet_and_ratio_guards(spark):
    tx = _tx(spark, [("Borrow", 1, "x", None, "t", 0.5), ("Mint", 1, "y", None, "t", 2.0),
                     ("Mint", 1, "y", None, "u", 2.0)])
    f = {r["wallet"]: r for r in FE.raw_wallet_features(tx).collect()}
    assert f["x"]["avg_time_between_tx_days"] is None and f["x"]["borrow_to_supply_ratio_vol"] == 0.5
    assert f["y"]["activity_consistency_stddev"] == 0.0 and f["y"]["activity_consistency_cv"] is None
    assert f["y"]["market_count"] == 2 and f["x"]["wallet_age_days"] == 0.0


def test_constant_feature_vector_and_row_mode(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0)], "wallet string, repay_ratio double, "
                                                                     "days_since_last_tx double")
    w = {"repay_ratio": 0.4, "days_since_last_tx": -0.2}
    vec = {r["wallet"]: r for r in SC.weighted_score(df, w, True).collect()}
    row = {r["wallet"]: r for r in SC.weighted_score(df, w, False).collect()}
    assert vec["b"]["raw_score"] == pytest.approx(0.4 / 0.6)
    assert "days_since_last_tx" not in vec["b"]["feature_contributions"]
    assert row["b"]["raw_score"] == pytest.approx((0.4 + 0.1) / 0.6)


def test_half_even_rounding_and_percentile_ties(spark):
    df = spark.createDataFrame([(f"w{i}", v) for i, v in enumerate([0.1, 0.2, 0.2, 0.3])], "wallet string, raw_score double")
    got = {r["wallet"]: r["final_score"] for r in SC.final_score(df).collect()}
    assert got == {"w0": 25, "w1": 50, "w2": 50, "w3": 100}
    half = spark.createDataFrame([("a", 2.5), ("b", 3.5)], "wallet string, x double")
    from ledgerlens.functions.columns import round_half_even_int
    assert [r[0] for r in half.select(round_half_even_int("x")).collect()] == [2, 4]


def test_distributed_rank_and_median_match_pandas(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.integers(0, 50, 3000).astype(float), np.full(2000, 7.0)])   # one hot value
    pdf = pd.DataFrame({"wallet": [f"w{i}" for i in range(len(vals))], "v": vals})
    df = spark.createDataFrame(pdf)
    got = percentile_rank_min(df, "v", "p", buckets=16).toPandas().set_index("wallet")["p"]
    exp = pdf.set_index("wallet")["v"].rank(method="min", pct=True)
    assert np.allclose(got.sort_index(), exp.sort_index())
    med = exact_medians(df, ["v"], buckets=16).first()["v"]
    assert med == pytest.approx(float(np.median(vals)))
    even = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert exact_medians(even, ["v"]).first()["v"] == 2.5


def test_chunked_helpers_equal_plain_windows_on_a_hot_wallet(spark):
    from pyspark.sql import Window
    from ledgerlens.operators.ordered import (consecutive_gaps, last_known, min_at_or_after, running_sums,
                                              with_previous)
    rng = np.random.default_rng(2)
    n = 3000
    secs = np.sort(rng.integers(0, 40 * 86400, n))
    acct = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", "c"], n))
    pdf = pd.DataFrame({"account": acct, "timestamp": pd.to_datetime(secs, unit="s"),
                        "transaction_hash": [f"h{i:05d}" for i in range(n)], "v": rng.random(n),
                        "px": np.where(rng.random(n) < 0.2, rng.random(n), np.nan)})
    df = spark.createDataFrame(pdf).withColumn("px", F.when(~F.isnan("px"), F.col("px")))
    ch = 3600    # one-hour chunks: the hot wallet spans ~900 chunks
    w = Window.partitionBy("account").orderBy("timestamp", "transaction_hash")
    plain = df.withColumn("run", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))) \
              .withColumn("prev", F.lag("timestamp").over(w)) \
              .withColumn("lk", F.last("px", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    got = running_sums(df, "account", ["timestamp", "transaction_hash"], {"run": F.col("v")}, ch)
    got = with_previous(got, "account", tiebreak=("transaction_hash",), chunk_seconds=ch)
    got = last_known(got, "account", "px", "lk", tiebreak=("transaction_hash",), chunk_seconds=ch)
    a = plain.toPandas().set_index("transaction_hash").sort_index()
    b = got.toPandas().set_index("transaction_hash").sort_index()
    assert np.allclose(a["run"], b["run"])
    assert (a["prev"].fillna(pd.Timestamp(0)) == b["prev_ts"].fillna(pd.Timestamp(0))).all()
    assert np.allclose(a["lk"].fillna(-1), b["lk"].fillna(-1))
    gaps = consecutive_gaps(df, chunk_seconds=ch).groupBy("account").agg(F.sum("gap_days").alias("s"),
                                                                         F.count("*").alias("n"))
    span = df.groupBy("account").agg(((F.unix_seconds(F.max("timestamp")) - F.unix_seconds(F.min("timestamp")))
                                      / 86400.0).alias("s"), (F.count("*") - 1).alias("n"))
    g = {r["account"]: (r["s"], r["n"]) for r in gaps.collect()}
    for r in span.collect():
        assert g[r["account"]][1] == r["n"] and g[r["account"]][0] == pytest.approx(r["s"])
    nxt = min_at_or_after(df.withColumn("rv", F.when(F.col("v") > 0.9, F.col("timestamp"))), "account", "rv", "nr", chunk_seconds=ch)
    ref = df.withColumn("rv", F.when(F.col("v") > 0.9, F.col("timestamp"))).withColumn(
        "nr", F.min("rv").over(Window.partitionBy("account").orderBy("timestamp")
                               .rangeBetween(Window.currentRow, Window.unboundedFollowing)))
    x = nxt.toPandas().set_index("transaction_hash").sort_index()["nr"]
    y = ref.toPandas().set_index("transaction_hash").sort_index()["nr"]
    assert (x.fillna(pd.Timestamp(0)) == y.fillna(pd.Timestamp(0))).all()


def test_isolation_forest_finds_planted_outliers(spark):
    from ledgerlens.operators import anomaly as AM
    rng = np.random.default_rng(3)
    X = np.vstack([rng.normal(0, 1, (500, 4)), rng.normal(12, 0.5, (5, 4))])
    df = spark.createDataFrame([(f"w{i:03d}", [float(v) for v in row]) for i, row in enumerate(X)],
                               "wallet string, features array<double>")
    nodes = AM.fit_isolation_forest(df, 505, n_trees=50)
    sc = AM.score_isolation_forest(df, nodes, 256)
    res = AM.rescale_decision(AM.decision_from_scores(sc)).toPandas().sort_values("anomaly_score", ascending=False)
    assert set(res["wallet"].head(5)) == {f"w{i}" for i in range(500, 505)}
    assert res["is_anomaly"].sum() <= 30 and res["anomaly_score"].between(0, 1).all()


def test_golden_rows_raw_score(spark):
    """Published rows: raw = sum(contributions) / 2.6, then the rule
    multipliers reproduce the published raw score."""
    rows = json.load(open(os.path.join(os.path.dirname(__file__), "fixtures", "golden_rows.json")))
    data = [(r["wallet"], sum(r["feature_contributions"].values()) / 2.6, r["repay_ratio"],
             r["liquidation_count_borrower"], r["days_since_last_tx"], r["activity_consistency_stddev"])
            for r in rows]
    df = spark.createDataFrame(data, "wallet string, raw_score double, repay_ratio double, "
                                     "liquidation_count_borrower long, days_since_last_tx double, "
                                     "activity_consistency_stddev double")
    got = {r["wallet"]: r for r in SC.apply_adjustments(df).collect()}
    for r in rows:
        g = got[r["wallet"]]
        assert g["raw_score"] == pytest.approx(r["raw_score"], rel=1e-12)
        pub = {k: v for k, v in r["adjustments"].items() if v is not None}
        assert {k: pytest.approx(v) for k, v in pub.items()} == dict(g["adjustments"])


def test_stacking_covers_each_wallet_once(spark):
    from ledgerlens.plans.catalog import q_stacking_ensemble
    from conftest import SF_SMALL
    d = q_stacking_ensemble(spark, SF_SMALL)
    assert d.count() == d.select("wallet").distinct().count()


def test_rf_importance_sums_to_one(spark):
    from ledgerlens.plans.catalog import _train
    from ledgerlens.operators.selection import rf_importance
    from conftest import SF_SMALL
    imp = rf_importance(_train(spark, SF_SMALL), n_trees=10, max_depth=5).toPandas()
    assert imp["importance"].sum() == pytest.approx(1.0)


def test_one_class_svm_flags_planted_outliers(spark):
    from ledgerlens.operators import anomaly as AM
    rng = np.random.default_rng(4)
    X = np.vstack([rng.normal(0, 1, (400, 3)), rng.normal(8, 0.3, (4, 3))])
    df = spark.createDataFrame([(f"w{i:03d}", [float(v) for v in row]) for i, row in enumerate(X)],
                               "wallet string, features array<double>")
    z = AM.fourier_features(df, AM.rbf_gamma_scale(df), 100).persist()
    w, _rho = AM.fit_one_class_svm(z, 0.05, 40)
    res = AM.rescale_decision(AM.one_class_svm_decision(z, w)).toPandas()
    top = set(res.sort_values("anomaly_score", ascending=False)["wallet"].head(10))
    assert {f"w{i}" for i in range(400, 404)} <= top
    assert 0 < res["is_anomaly"].sum() < 60


def test_stage_counters_and_model_persistence(spark, tmp_dir):
    from conftest import SF_SMALL
    from ledgerlens.plans import pipeline as P
    from ledgerlens.session import stage
    from ledgerlens.sources.sinks import load_models, save_models
    tx, obs = P.observed(P.cleaned(spark, SF_SMALL), "clean")
    staged = stage(tx)
    counts = obs.get
    assert counts["rows"] == staged.count() and counts["rows_Mint"] > 0
    from ledgerlens.operators import ensemble as EN, selection as SE
    t = P.stage(SE.training_frame(P.features(staged), P.scores(P.features(staged))))
    models = EN.fit_models(t, SE.feature_columns(t), {"ridge": {"alpha": 1.0}})
    save_models(models, tmp_dir)
    back = load_models(["ridge"], tmp_dir)["ridge"]
    a = models["ridge"].transform(t).select("prediction").collect()
    b = back.transform(t).select("prediction").collect()
    assert a == b


def test_stage_resume(spark, tmp_dir):
    from conftest import SF_SMALL
    from ledgerlens.plans.pipeline import run_stages
    a = run_stages(spark, SF_SMALL, tmp_dir, with_anomaly=False)
    assert a["counters"]["load"]["rows"] == a["transactions"].count() and a["counters"]["final"]["rows"] == a["final"].count()
    first = sorted(map(tuple, a["final"].select("wallet", "final_score").collect()))
    b = run_stages(spark, SF_SMALL, tmp_dir, skip_to="scores", with_anomaly=False)
    assert sorted(map(tuple, b["final"].select("wallet", "final_score").collect())) == first
    top = spark.read.option("header", True).csv(f"{tmp_dir}/wallet_scores_csv")
    assert top.columns == ["wallet", "score"] and top.count() == min(1000, len(first))


def test_weight_availability_table(spark):
    from conftest import SF_SMALL
    from ledgerlens.plans import pipeline as P
    s = SC.prepare_scoring(P.features(P.cleaned(spark, SF_SMALL)))
    t = {r["feature"]: r["available"] for r in SC.weight_availability(s).collect()}
    assert sum(t.values()) == 7 and not t["tx_count_total"] and t["anomaly_score"]
    assert sorted(f for f, a in t.items() if not a) == sorted(SC.missing_weighted_features(s))
