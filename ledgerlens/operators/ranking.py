"""Distributed order statistics: global rank and exact quantiles without a
single-partition window and without collecting values on the driver.

1. distinct values per group with their multiplicity (partial aggregation, so a
   value held by a third of all rows is one row after the map side);
2. ``percentile_approx`` cut points split each group's values into buckets of
   similar size (a bounded array per group, broadcast);
3. bucket totals (groups x buckets rows) get exclusive prefix sums;
4. a window per (group, bucket) gives the exclusive prefix inside the bucket.

position(v) = 1 + number of rows with a smaller value = pandas rank(method='min').
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import stage

DEFAULT_BUCKETS = 64


def _buckets(df: DataFrame, buckets: int | None) -> int:
    if buckets:
        return buckets
    try:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover
        n = DEFAULT_BUCKETS
    return max(DEFAULT_BUCKETS, n)


def _cuts_below(cuts: str, v, size: int):
    """How many of the ``size`` ascending values in the array ``cuts`` are less than
    ``v``, by halving: a handful of comparisons a row."""
    steps = [1 << i for i in reversed(range(max(1, size.bit_length())))]
    return F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0),
                       lambda at, x: F.when(F.get(cuts, at + x - 1) < v, at + x).otherwise(at))


def value_positions(df: DataFrame, value: str, groups=(), buckets: int | None = None,
                    many_groups: bool = False) -> DataFrame:
    """(groups..., value, cnt, pos, n): distinct non-null values with their
    1-based minimum rank ``pos`` and the group's non-null row count ``n``.

    Few groups: cut points per group, broadcast (groups x ``buckets`` doubles), so
    that values are dealt by group and bucket: dealt by group alone, a group would
    be one task.  Many groups (e.g. one per wallet): one global set of cut points (a
    row of ``buckets`` doubles, broadcast).  Rows and distinct values are unbounded
    either way."""
    g = list(groups)
    b = _buckets(df, buckets)
    v = F.col(value)
    base = df.where(v.isNotNull())
    dv = base.groupBy(*g, value).agg(F.count(F.lit(1)).alias("_cnt"))
    probs = [i / b for i in range(1, b)]
    if many_groups:
        dv = stage(dv)      # used three times below; what it comes from is read once
        cuts = dv.agg(F.percentile_approx(v, probs, 10 * b).alias("_cuts"))
        dvb = dv.crossJoin(F.broadcast(cuts))      # one row of bounded size
    else:
        # Cut points over the distinct values: buckets get similar numbers of
        # distinct values, which is what the per-bucket window processes.
        # (Read with the counts, so that both come from one shuffle.)
        cuts = dv.where(F.col("_cnt") > 0).groupBy(*g).agg(F.percentile_approx(v, probs, 10 * b).alias("_cuts"))
        dvb = dv.join(F.broadcast(cuts), g, "inner") if g else dv.crossJoin(F.broadcast(cuts))
    dvb = dvb.withColumn("_bucket", _cuts_below("_cuts", v, b - 1)).drop("_cuts")
    tot = dvb.groupBy(*g, "_bucket").agg(F.sum("_cnt").alias("_bc"))
    wo = Window.partitionBy(*g).orderBy("_bucket")
    tot = tot.select(*g, "_bucket",
                     F.coalesce(F.sum("_bc").over(wo.rowsBetween(Window.unboundedPreceding, -1)),
                                F.lit(0)).alias("_off"),
                     F.sum("_bc").over(Window.partitionBy(*g)).alias("n"))
    wb = Window.partitionBy(*g, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    dvb = dvb.withColumn("_pre", F.coalesce(F.sum("_cnt").over(wb), F.lit(0)))
    return (dvb.join(tot, [*g, "_bucket"], "inner")
               .select(*g, value, F.col("_cnt").alias("cnt"),
                       (F.col("_off") + F.col("_pre") + 1).alias("pos"), "n"))


def percentile_rank_min(df: DataFrame, value: str, out: str = "pct_rank",
                        ascending: bool = True, buckets: int | None = None) -> DataFrame:
    """Append ``out`` = rank(method='min', pct=True) of ``value`` over all rows
    (NULL values get NULL).  The per-value table is joined back on the value;
    a hot value is handled by AQE's skew-join split."""
    key = "_rk"
    src = df.withColumn(key, F.col(value) if ascending else -F.col(value))
    pos = value_positions(src.select(key), key, (), buckets)
    pos = pos.select(key, (F.col("pos") / F.col("n")).alias(out))
    return src.join(pos, key, "left").drop(key)


def exact_quantile_long(long_df: DataFrame, group: str, value: str, q: float = 0.5,
                        buckets: int | None = None, many_groups: bool = False) -> DataFrame:
    """Exact interpolated quantile per group (``percentile`` / ``quantile_cont``
    semantics) from a long (group, value) table."""
    p = value_positions(long_df, value, [group], buckets, many_groups)
    h = (F.col("n") - 1) * F.lit(q)           # 0-based fractional position
    lo = F.floor(h) + 1
    hi = F.ceil(h) + 1
    inside = lambda k: (F.col("pos") <= k) & (k < F.col("pos") + F.col("cnt"))
    agg = p.groupBy(group).agg(
        F.max(F.when(inside(lo), F.col(value))).alias("_lo"),
        F.max(F.when(inside(hi), F.col(value))).alias("_hi"),
        F.first(h - F.floor(h)).alias("_f"))
    return agg.select(group, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f")).alias("quantile"))


def exact_medians(df: DataFrame, columns: list, buckets: int | None = None) -> DataFrame:
    """One-row DataFrame with the exact median of each column (NULL if the
    column has no value): one distributed pass over all columns, stacked into a
    long (name, value) table, at every size."""
    if not columns:
        return df.sparkSession.range(1).select()
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v"))
                                for c in columns])).alias("s")
    long_df = df.select(stack).select("s.name", "s.v")
    med = exact_quantile_long(long_df, "name", "v", 0.5, buckets)
    return (med.groupBy().pivot("name", list(columns)).agg(F.first("quantile"))
               .select(*[F.col(c).cast("double").alias(c) for c in columns]))
