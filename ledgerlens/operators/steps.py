"""Step functions of time: balances that change at events, rates and prices that
change on their own days, and what the two give together.

A step function is a table ``(key, timestamp, values)``: each value holds from
its row's time to the key's next one.  The integral of a balance times a rate over
time is a sum over the balance's steps of balance x (I(end) - I(start)), where I
is the rate's running integral: it holds every rate change between the two
times, however many there are, so steps are neither split nor multiplied.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.columns import day_diff, ts_literal
from ledgerlens.operators.ordered import ordered
from ledgerlens.session import stage

#: Amounts are summed as decimals, so a balance that was paid back is exactly 0.
EXACT = "decimal(28,9)"
YEAR_DAYS = 365.0


def moves(tx: DataFrame) -> DataFrame:
    """The log as signed amounts: ``supply`` and ``debt`` in token units, ``supply_usd``
    and ``debt_usd`` in USD, ``usd`` moved, ``seized`` (USD of a liquidation) and ``price``
    where a supply shows one (USD per unit)."""
    ev = F.col("event_type")
    usd = F.coalesce(F.col("amountusd"), F.col("amount"))
    zero = F.lit(0).cast(EXACT)
    sign_s = lambda v: F.when(ev == "Mint", v).when(ev == "Redeem", -v)
    sign_d = lambda v: F.when(ev == "Borrow", v).when(ev.isin("RepayBorrow", "LiquidateBorrow"), -v)
    exact = lambda v: F.coalesce(v.cast(EXACT), zero)
    return tx.select(
        "account", "token", "timestamp", "transaction_hash", usd.alias("usd"),
        exact(sign_s(F.col("amount"))).alias("supply"), exact(sign_d(F.col("amount"))).alias("debt"),
        exact(sign_s(usd)).alias("supply_usd"), exact(sign_d(usd)).alias("debt_usd"),
        F.when(ev == "LiquidateBorrow", usd).alias("seized"),
        F.when((ev == "Mint") & (F.col("amount") != 0), F.col("amountusd") / F.col("amount")).alias("price"))


def years(start, end):
    return day_diff(start, end) / F.lit(YEAR_DAYS)


def with_integral(rates: DataFrame, names, key: str = "token", ts: str = "timestamp") -> DataFrame:
    """Add ``<name>_area`` for each rate: its integral over the key's earlier steps,
    up to this one.  Rates a year, areas without unit.  One row per key and
    change, far fewer than events, so a window by key will do."""
    w = Window.partitionBy(key).orderBy(ts)
    length = years(ts, "_next")
    t = rates.withColumn("_next", F.lead(ts).over(w))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return t.withColumns({f"{n}_area": F.coalesce(F.sum(F.col(n) * length).over(before), F.lit(0.0)) for n in names}).drop("_next")


def integral_at(points: DataFrame, rates: DataFrame, names, until: _dt.datetime, key: str = "token", ts: str = "timestamp") -> DataFrame:
    """As-of join: add ``<name>_at`` to ``points``, the integral of the key's rate up
    to the point's time (``until`` at the latest); 0 before the first step.

    Points and steps are united and each point carries the last step forward
    (``ordered``), so a market with a third of all points spreads over tasks."""
    stop = ts_literal(until)
    area = with_integral(rates.where(F.col(ts) < stop), names, key, ts)
    step = F.struct(F.col(ts).alias("since"), *names, *[f"{n}_area" for n in names])
    kind = step_type(area.select(step.alias("s")))
    steps = area.select(F.col(key), F.col(ts), F.lit(0).alias("_kind"), step.alias("_step"))
    both = points.withColumns({"_kind": F.lit(1), "_step": F.lit(None).cast(kind)}).unionByName(steps, allowMissingColumns=True)
    both = ordered(both, key, ts, ("_kind",), last={"_step": "_step"}).where(F.col("_kind") == 1)
    end = F.least(F.col(ts), stop)
    at = {f"{n}_at": F.coalesce(F.col(f"_step.{n}_area") + F.col(f"_step.{n}") * F.greatest(F.lit(0.0), years("_step.since", end)), F.lit(0.0)) for n in names}
    return both.withColumns(at).drop("_kind", "_step")


def step_type(df: DataFrame) -> str:
    return df.schema.fields[0].dataType.simpleString()


def integral_until(rates: DataFrame, names, until: _dt.datetime, key: str = "token", ts: str = "timestamp") -> DataFrame:
    """``key`` and ``<name>_end``: the integral of each key's rates up to ``until``."""
    stop = ts_literal(until)
    area = with_integral(rates.where(F.col(ts) < stop), names, key, ts)
    last = F.max_by(F.struct(ts, *names, *[f"{n}_area" for n in names]), ts).alias("_s")
    return area.groupBy(key).agg(last).select(
        key, *[(F.col(f"_s.{n}_area") + F.col(f"_s.{n}") * years(f"_s.{ts}", stop)).alias(f"{n}_end") for n in names])


def market_rates(m: DataFrame, base: float = 0.02, slope: float = 0.2, reserve_factor: float = 0.1, reward_per_day: float = 100.0) -> DataFrame:
    """Rate steps of each market, from its balances at the end of each day on
    which it moved; they hold from the next midnight on.

    Utilisation ``u`` = borrowed / supplied, held within 0 and 1; ``borrow`` = base +
    slope u; ``supply`` = borrow u (1 - reserve_factor); ``reward``: a market gives its
    suppliers ``reward_per_day`` USD a day, in proportion to their balances."""
    day = m.groupBy("token", F.to_date("timestamp").alias("_day")).agg(F.sum("supply_usd").alias("s"), F.sum("debt_usd").alias("b"))
    w = Window.partitionBy("token").orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)     # a row per market and day
    day = day.select("token", F.date_add("_day", 1).cast("timestamp").alias("timestamp"),
                     F.sum("s").over(w).cast("double").alias("supplied"), F.sum("b").over(w).cast("double").alias("borrowed"))
    u = F.when(F.col("supplied") > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("borrowed") / F.col("supplied")))).otherwise(F.lit(0.0))
    day = day.withColumn("u", u).withColumn("borrow", F.lit(base) + F.lit(slope) * F.col("u"))
    return day.select("token", "timestamp", "u", "borrow", (F.col("borrow") * F.col("u") * F.lit(1 - reserve_factor)).alias("supply"),
                      F.when(F.col("supplied") > 0, F.lit(reward_per_day * YEAR_DAYS) / F.col("supplied")).otherwise(F.lit(0.0)).alias("reward"))


def accruals(m: DataFrame, rates: DataFrame, until: _dt.datetime) -> DataFrame:
    """Per wallet: ``paid``, ``earned`` and ``reward`` on its positive USD balances in
    each market, at rates that change between its events as well."""
    names = ["borrow", "supply", "reward"]
    points = m.select("account", "token", "timestamp", "transaction_hash", F.col("supply_usd").alias("_ds"), F.col("debt_usd").alias("_db"))
    at = stage(integral_at(points, rates, [*names], until))
    nexts = {f"_{n}_next": f"{n}_at" for n in names}
    t = ordered(at, ["account", "token"], tiebreak=("transaction_hash",), sums={"_s": "_ds", "_b": "_db"}, next=nexts)
    t = t.join(integral_until(rates, names, until), "token", "left")
    grown = lambda n: F.coalesce(F.col(f"_{n}_next"), F.greatest(F.col(f"{n}_end"), F.col(f"{n}_at")), F.col(f"{n}_at")) - F.col(f"{n}_at")
    held = lambda c: F.greatest(F.lit(0.0), F.col(c).cast("double"))
    return t.groupBy(F.col("account").alias("wallet")).agg(
        F.sum(held("_b") * grown("borrow")).alias("paid"), F.sum(held("_s") * grown("supply")).alias("earned"),
        F.sum(held("_s") * grown("reward")).alias("reward"))


def marked_balances(m: DataFrame) -> DataFrame:
    """Each event of a wallet with ``supplied`` and ``borrowed`` after it: all its
    token quantities at the last prices seen by then, of any wallet's supplies
    (tokens without a price yet count nothing), and ``next_ts``.

    Every event meets each token of its wallet; quantities are running sums by
    (wallet, token), prices are carried forward by token.  Rows: events times tokens
    of a wallet, which a protocol's list of markets bounds."""
    order = ("transaction_hash",)
    events = stage(ordered(m.select("account", "token", "timestamp", "transaction_hash", "supply", "debt", "price"), "account", tiebreak=order, next={"next_ts": "timestamp"}))
    held = events.select("account", F.col("token").alias("_held")).distinct()
    grid = events.join(held, "account")
    own = F.col("token").eqNullSafe(F.col("_held"))
    zero = F.lit(0).cast(EXACT)
    grid = grid.select("account", F.col("_held").alias("token"), "timestamp", "transaction_hash", "next_ts",
                       F.when(own, F.col("supply")).otherwise(zero).alias("_ds"), F.when(own, F.col("debt")).otherwise(zero).alias("_db"))
    grid = stage(ordered(grid, ["account", "token"], tiebreak=order, sums={"_s": "_ds", "_b": "_db"}).select(
        "account", "token", "timestamp", "transaction_hash", "next_ts", F.col("_s").cast("double").alias("_s"), F.col("_b").cast("double").alias("_b")))
    seen = events.where(F.col("price").isNotNull()).select("token", "timestamp", "transaction_hash", "price")
    both = grid.withColumn("_kind", F.lit(1)).unionByName(seen.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    both = ordered(both, "token", "timestamp", (*order, "_kind"), last={"_p": "price"}).where(F.col("_kind") == 1)
    worth = lambda c: F.sum(F.col(c) * F.coalesce("_p", F.lit(0.0)))
    return both.groupBy("account", "timestamp", "transaction_hash").agg(
        worth("_s").alias("supplied"), worth("_b").alias("borrowed"), F.max("next_ts").alias("next_ts"))
