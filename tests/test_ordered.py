"""Ordered helpers and step functions against plain windows and by hand."""

import datetime as dt
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators import declared as DE
from ledgerlens.operators import ordered as OR
from ledgerlens.operators import steps as ST
from ledgerlens.plans import pipeline as P

T0 = dt.datetime(2024, 1, 1)


def _log(spark, n=4000):
    """A hot key on a hot day, a NULL key, ties in time, sparse keys."""
    us = F.when(F.col("id") % 4 == 0, F.col("id") * 5_000_000).when(F.col("id") % 4 == 1, (F.col("id") % 40) * 1_000_000) \
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(20 * 86_400_000_000)))
    return spark.range(n).select(
        F.when(F.col("id") % 4 < 2, "hot").when(F.col("id") % 4 == 2, F.concat(F.lit("w"), F.col("id") % 30)).alias("account"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + us).alias("timestamp"), F.format_string("%05d", "id").alias("h"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 17).alias("v")).cache()


def _plain():
    return Window.partitionBy("account").orderBy("timestamp", "h")


def _same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


@pytest.mark.parametrize("rows", [100, 10**6])
def test_ordered_equals_plain_windows(spark, monkeypatch, rows):
    monkeypatch.setattr(OR, "CHUNK_ROWS", rows)
    df, w = _log(spark), _plain()
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("account").orderBy("timestamp").rangeBetween(0, Window.unboundedFollowing)
    want = df.withColumns({"s": F.sum(F.coalesce("v", F.lit(0))).over(upto), "l": F.last("v", True).over(upto), "f": F.min("v").over(ahead),
                           "p": F.lag("v").over(w), "q": F.lag("timestamp").over(w), "n": F.lead("h").over(w)})
    got = OR.ordered(df, "account", tiebreak=("h",), prev={"p": "v", "q": "timestamp"}, next={"n": "h"},
                     sums={"s": F.coalesce("v", F.lit(0))}, last={"l": "v"}, following={"f": "v"})
    _same(got.select(*want.columns), want)


@pytest.mark.parametrize("rows", [100, 10**6])
def test_adjacent_last_rows_and_rolling_sums(spark, monkeypatch, rows):
    monkeypatch.setattr(OR, "CHUNK_ROWS", rows)
    df, w = _log(spark), _plain()
    pairs = df.withColumns({"pt": F.lag("timestamp").over(w), "pv": F.lag("v").over(w)})
    want = pairs.groupBy("account").agg(F.sum(OR.gap_us("pt", "timestamp")).alias("s"), F.max(OR.gap_us("pt", "timestamp")).alias("m"),
                                        F.min(F.when(F.col("pt").isNotNull(), F.col("pv") - F.col("v"))).alias("d"))
    got = OR.adjacent(df, "account", {"s": ("sum", lambda p, r: OR.gap_us(p["timestamp"], r["timestamp"])), "m": ("max", lambda p, r: OR.gap_us(p["timestamp"], r["timestamp"])),
                                      "d": ("min", lambda p, r: p["v"] - r["v"])}, tiebreak=("h",), carry=("v",))
    _same(got, want)
    at = F.row_number().over(Window.partitionBy("account").orderBy(F.desc("timestamp"), F.desc("h")))
    _same(OR.last_rows(df, "account", 7, tiebreak=("h",)), df.withColumn("_from_end", at).where("_from_end <= 7"))
    amount = F.coalesce("v", F.lit(0)).cast("decimal(28,9)")
    us = Window.partitionBy("account").orderBy(F.unix_micros("timestamp")).rangeBetween(-3_600_000_000, 0)
    _same(OR.rolling_sums(df, "account", {"r": amount}, 3600), df.withColumn("r", F.sum(amount).over(us)).select("account", "timestamp", "r").distinct())


def test_a_log_is_read_twice_at_most(spark):
    from ledgerlens.operators.features import raw_wallet_features, temporal_features, wallet_features
    from ledgerlens.operators.sequences import tx_sequences
    tx = P.cleaned(spark, SF_SMALL)

    def scans(df):
        return len(re.findall(r"FileScan parquet[^\n]*events\.parquet", df._jdf.queryExecution().executedPlan().toString()))

    by = {"account": OR.with_neighbors(tx.select("account", "timestamp")), "temporal": temporal_features(tx), "raw": raw_wallet_features(tx),
          "features": wallet_features(tx), "sequences": tx_sequences(tx), "sessions": DE.wallet_sessions(tx), "repay": DE.borrow_to_repay(tx),
          "rates": DE.activity_rates(tx), "ltv": DE.ltv_path(tx), "interest": DE.interest_estimate(tx), "price": DE.asof_price(tx)}
    found = {k: scans(v) for k, v in by.items()}
    assert max(found["temporal"], found["sequences"]) == 1
    assert found["raw"] == 2
    # features: the table and its medians; both read the summary and the intervals.
    assert {k: n for k, n in found.items() if n > 2 and k != "features"} == {}


def _moves(spark, rows):
    """(account, token, hours, event, amount, usd)"""
    df = [(a, t, T0 + dt.timedelta(hours=h), f"h{i:03d}", ev, float(amt), float(usd)) for i, (a, t, h, ev, amt, usd) in enumerate(rows)]
    return spark.createDataFrame(df, "account string, token string, timestamp timestamp, transaction_hash string, event_type string, amount double, amountusd double")


def test_ltv_moves_when_only_the_price_does(spark):
    tx = _moves(spark, [("a", "x", 0, "Mint", 10, 10), ("a", "y", 1, "Mint", 4, 8), ("a", "y", 2, "Borrow", 3, 6),
                        ("b", "x", 3, "Mint", 1, 5),                 # x now costs 5
                        ("a", "x", 4, "Redeem", 1, 99), ("a", "z", 5, "Borrow", 7, 7)])
    got = {r.timestamp: (r.supplied, r.borrowed) for r in ST.marked_balances(ST.moves(tx)).where("account = 'a'").collect()}
    h = lambda n: T0 + dt.timedelta(hours=n)
    assert got == {h(0): (10, 0), h(1): (18, 0), h(2): (18, 6), h(4): (9 * 5 + 8, 6), h(5): (9 * 5 + 8, 6)}     # z has no price
    ltv = DE.ltv_path(tx, T0 + dt.timedelta(hours=6)).where("wallet = 'a'").first()
    assert ltv.max_ltv_alltime == pytest.approx(6 / 18) and ltv.min_ltv_alltime == 0
    assert ltv.time_weighted_ltv == pytest.approx((2 * 6 / 18 + 2 * 6 / 53) / 6)


def test_rates_change_between_two_events(spark):
    tx = _moves(spark, [("a", "x", 0, "Mint", 100, 100), ("a", "x", 24, "Borrow", 40, 40), ("a", "x", 24 * 11, "RepayBorrow", 50, 50)])
    days = lambda n: T0 + dt.timedelta(days=n)
    rates = spark.createDataFrame([("x", days(0.5), 0.1, 0.01, 0.5), ("x", days(3), 0.2, 0.02, 0.0), ("x", days(5), 0.4, 0.0, 1.0), ("x", days(400), 9.0, 9.0, 9.0)],
                                  "token string, timestamp timestamp, borrow double, supply double, reward double")
    got = DE.interest_estimate(tx, days(15), rates).first()
    assert got.interest_paid_estimate == pytest.approx(40 * (0.1 * 2 + 0.2 * 2 + 0.4 * 6) / 365)     # paid back more than owed: nothing after
    assert got.interest_earned_estimate == pytest.approx(100 * (0.01 * 2.5 + 0.02 * 2) / 365)
    assert got.reserve_contribution_estimate == pytest.approx(0.1 * got.interest_paid_estimate)
    reward = DE.reward_estimate(tx, days(15), rates).first()
    assert reward.comp_earned_estimate == pytest.approx(100 * (0.5 * 2.5 + 1.0 * 10) / 365)
    assert reward.comp_earned_estimate_ratio == pytest.approx(reward.comp_earned_estimate / 190)


def test_seized_collateral_and_markets_without_rates(spark):
    tx = _moves(spark, [("a", "x", 0, "Borrow", 10, 10), ("a", "x", 5, "LiquidateBorrow", 10, 20)])
    none = spark.createDataFrame([], "token string, timestamp timestamp, borrow double, supply double, reward double")
    got = DE.interest_estimate(tx, T0 + dt.timedelta(days=1), none).first()
    assert (got.interest_paid_estimate, got.interest_earned_estimate) == (0, 0)
    assert got.reserve_contribution_estimate == pytest.approx(0.028 * 20)


def test_net_to_gross_crosses_midnight(spark):
    tx = _moves(spark, [("a", "x", 23.75, "Mint", 100, 100), ("a", "x", 24.25, "Redeem", 95, 95), ("a", "x", 30, "Mint", 1, 1), ("b", "x", 1, "Mint", 5, 5)])
    got = {r.wallet: r for r in DE.net_to_gross(tx).collect()}
    assert got["a"].churn_hours == 1 and got["a"].min_net_to_gross == pytest.approx(5 / 195)
    assert got["b"].churn_hours == 0 and got["b"].min_net_to_gross is None
