"""Per-key ordered computations that survive a hot key.

A plain ``Window.partitionBy("account").orderBy("timestamp")`` sends all rows
of one account to one task; a bot wallet holding a third of the data would
then sort a third of the data in one task.  These helpers split each key's
timeline into chunks of time: row-level windows run per (key, chunk), and one
summary row per chunk carries what crosses chunk borders.  Results are exact.

Chunks are days.  A (key, day) that holds a large share of the rows is cut at
times found in a bounded sample of the log (:func:`cut_times`), so the plan
holds no counting of its own: :func:`ordered` and the helpers on top of it read
their input twice (rows and chunk summaries), :func:`adjacent` and
:func:`last_rows` once.  Do several things in one call of :func:`ordered`
rather than one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.columns import chunk_of, day_diff
from ledgerlens.session import stage

DEFAULT_CHUNK_SECONDS = 86400

#: A chunk is cut if it seems to have more than twice CHUNK_ROWS rows and more
#: than twice CHUNK_SHARE of all; it is looked for in about SAMPLE_ROWS rows.
CHUNK_ROWS, CHUNK_SHARE, SAMPLE_ROWS = 50_000, 1 / 4_096, 1 << 18
#: Bits of ``_chunk`` below the fixed chunk: the part within it.
PART_BITS = 20
_CUTS: dict = {}


def _sample_step(df: DataFrame) -> int:
    """Every how many rows one is enough: from the optimizer's size of ``df``
    (an estimate; a bad one makes chunks uneven, not results wrong)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, size // (32 * SAMPLE_ROWS))


def cut_times(df: DataFrame, keys, ts: str, chunk_seconds: int, rows: int) -> list:
    """Chunks that hold too much, with the times (microseconds) to cut them at:
    ``(*keys, chunk, times)``.

    A sample is grouped by (key, chunk); the few groups over the limit give the
    sample's own times, one per limit.  What is collected is bounded by the sample's
    rows over the limit.  Kept per plan, so a query that uses one log several times
    samples it once."""
    narrow = df.select(*keys, ts)
    try:
        place = (narrow.semanticHash(), tuple(keys), ts, chunk_seconds, rows)
    except Exception:   # a plan that can't be compared
        place = None
    if place in _CUTS:
        return _CUTS[place]
    step = _sample_step(narrow)
    part = narrow.sample(fraction=1 / step, seed=7) if step > 1 else narrow
    limit = max(1, rows // step, int(SAMPLE_ROWS * CHUNK_SHARE) if step > 1 else 0)
    t = part.where(F.col(ts).isNotNull()).select(*keys, chunk_of(ts, chunk_seconds).alias("_base"), F.unix_micros(ts).alias("_us"))
    hot = t.groupBy(*keys, "_base").agg(F.sort_array(F.collect_list("_us")).alias("_v")).where(F.size("_v") > 2 * limit)
    times = F.array_distinct(F.transform(F.sequence(F.lit(limit), F.size("_v") - 1, F.lit(limit)), lambda i: F.get("_v", i)))
    found = hot.select(*keys, "_base", times.alias("_cuts")).collect()
    if place:
        while len(_CUTS) > 256:
            _CUTS.pop(next(iter(_CUTS)))
        _CUTS[place] = found
    return found


def with_chunks(df: DataFrame, keys, ts: str, chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
                rows: int | None = None) -> DataFrame:
    """Add ``_chunk``, which rises with time within a key: the fixed chunk of
    ``chunk_seconds``, and within one that holds many rows the part between two
    of its times.  Rows of one time stay together."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    base = chunk_of(ts, chunk_seconds)
    found = cut_times(df, keys, ts, chunk_seconds, rows or CHUNK_ROWS)
    whole = F.shiftleft(base.cast("bigint"), PART_BITS)
    if not found:
        return df.withColumn("_chunk", whole)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"_k{i} {types[k]}" for i, k in enumerate(keys)] + ["_base bigint", "_cuts array<bigint>"])
    cuts = df.sparkSession.createDataFrame([tuple(r) for r in found], schema)
    t = df.withColumns({"_base0": base, "_us": F.unix_micros(ts)})
    met = F.col("_base0") == F.col("_base")
    for i, k in enumerate(keys):
        met = met & t[k].eqNullSafe(F.col(f"_k{i}"))
    t = t.join(F.broadcast(cuts), met, "left")      # at most a few thousand times
    step = 32
    coarse = F.size(F.filter("_cuts", lambda c, i: ((i + 1) % step == 0) & (c < F.col("_us")))) * step
    t = t.withColumn("_c", coarse)
    fine = F.size(F.filter(F.slice("_cuts", F.col("_c") + 1, step), lambda c: c < F.col("_us")))
    part = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(F.col("_c") + fine)
    return t.withColumn("_chunk", whole + part.cast("bigint")).select(*df.columns, "_chunk")


def gap_us(start, end):
    """Microseconds from one timestamp column to another."""
    return F.unix_micros(end) - F.unix_micros(start)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _keyed(df: DataFrame, keys) -> tuple[DataFrame, list, list]:
    """``df`` with a non-null copy of each key to deal and join by, so rows
    whose key is NULL are a timeline of their own."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    copies = {f"_key{i}": F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for i, k in enumerate(keys)}
    return df.withColumns(copies), keys, list(copies)


def ordered(df: DataFrame, keys, ts: str = "timestamp", tiebreak=(), prev=None, next=None, sums=None,
            last=None, following=None, chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Add columns that depend on the order (ts, \\*tiebreak) within ``keys``.
    Each argument maps names to columns (names or expressions over a row):

    ``prev`` / ``next``: the value in the row before / after;
    ``sums``: running sum, the row included;
    ``last``: last non-NULL value at or before the row (as-of carry-forward);
    ``following``: least value at or after the row's ``ts`` (ties included)."""
    prev, next, sums, last, following = ({n: _col(c) for n, c in (x or {}).items()} for x in (prev, next, sums, last, following))
    if not (prev or next or sums or last or following):
        return df
    t, keys, k = _keyed(with_chunks(df, keys, ts, chunk_seconds), keys)
    inputs = {f"_{kind}_{n}": c for kind, x in (("p", prev), ("n", next), ("s", sums), ("l", last), ("f", following)) for n, c in x.items()}
    t = t.withColumns(inputs)
    order = [ts, *tiebreak]
    by = F.struct(*[F.col(c) for c in order])
    row = {kind: F.struct(*[F.col(f"_{kind}_{n}").alias(n) for n in x]) for kind, x in (("p", prev), ("n", next)) if x}

    # Within the chunk.
    w = Window.partitionBy(*k, "_chunk").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*k, "_chunk").orderBy(ts).rangeBetween(Window.currentRow, Window.unboundedFollowing)
    local = {f"_in_s_{n}": F.sum(f"_s_{n}").over(upto) for n in sums}
    local |= {f"_in_l_{n}": F.last(f"_l_{n}", ignorenulls=True).over(upto) for n in last}
    local |= {f"_in_f_{n}": F.min(f"_f_{n}").over(ahead) for n in following}
    if prev:
        local["_in_p"] = F.lag(row["p"]).over(w)
    if next:
        local["_in_n"] = F.lead(row["n"]).over(w)
    inside = t.withColumns(local)

    # One row per chunk, and what it gets from the chunks around it.
    aggs = [F.sum(f"_s_{n}").alias(f"_t_s_{n}") for n in sums]
    aggs += [F.max_by(F.col(f"_l_{n}"), F.when(F.col(f"_l_{n}").isNotNull(), by)).alias(f"_t_l_{n}") for n in last]
    aggs += [F.min(f"_f_{n}").alias(f"_t_f_{n}") for n in following]
    if prev:
        aggs.append(F.max_by(row["p"], by).alias("_t_p"))
    if next:
        aggs.append(F.min_by(row["n"], by).alias("_t_n"))
    wc = Window.partitionBy(*k).orderBy("_chunk")
    earlier, later = wc.rowsBetween(Window.unboundedPreceding, -1), wc.rowsBetween(1, Window.unboundedFollowing)
    out = [F.coalesce(F.sum(f"_t_s_{n}").over(earlier), F.lit(0)).alias(f"_out_s_{n}") for n in sums]
    out += [F.last(f"_t_l_{n}", ignorenulls=True).over(earlier).alias(f"_out_l_{n}") for n in last]
    out += [F.min(f"_t_f_{n}").over(later).alias(f"_out_f_{n}") for n in following]
    if prev:
        out.append(F.lag("_t_p").over(wc).alias("_out_p"))
    if next:
        out.append(F.lead("_t_n").over(wc).alias("_out_n"))
    around = t.groupBy(*k, "_chunk").agg(*aggs).select(*k, "_chunk", *out)

    both = inside.join(around, [*k, "_chunk"], "left")
    adds = {n: F.coalesce(F.col(f"_in_s_{n}"), F.lit(0)) + F.col(f"_out_s_{n}") for n in sums}
    adds |= {n: F.coalesce(f"_in_l_{n}", f"_out_l_{n}") for n in last}
    adds |= {n: F.least(f"_in_f_{n}", f"_out_f_{n}") for n in following}
    for kind, x in (("p", prev), ("n", next)):
        for n in x:     # a missing struct is a missing row; a NULL in it is that row's NULL
            adds[n] = F.when(F.col(f"_in_{kind}").isNotNull(), F.col(f"_in_{kind}.{n}")).otherwise(F.col(f"_out_{kind}.{n}"))
    kept = [F.col(c) for c in df.columns if c not in adds]
    return both.select(*kept, *[c.alias(n) for n, c in adds.items()])


def adjacent(df: DataFrame, keys, metrics: dict, ts: str = "timestamp", tiebreak=(), carry=(), by=None,
             chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Aggregates over all pairs of neighbouring rows, one row per ``by``
    (default: per key), in one pass over ``df``: no row is joined back.

    ``metrics`` maps a name to ``(how, value)``: ``how`` is ``sum``, ``min`` or
    ``max``, ``value(before, row)`` gives a column from two structs of ``ts``,
    ``tiebreak`` and ``carry`` (NULL: no contribution).  Keys with one row get NULL.
    """
    t, keys, k = _keyed(with_chunks(df, keys, ts, chunk_seconds), keys)
    by = keys if by is None else [by] if isinstance(by, str) else list(by)
    fields = list(dict.fromkeys([ts, *tiebreak, *carry]))
    # Ordered by its first fields; with the same ones twice either order is right.
    t = t.select(*by, *k, "_chunk", F.struct(*[F.col(c) for c in fields]).alias("_r"))
    agg = {"sum": F.sum, "min": F.min, "max": F.max}
    w = Window.partitionBy(*k, "_chunk").orderBy(*[f"_r.{c}" for c in [ts, *tiebreak]])
    t = t.withColumn("_p", F.lag("_r").over(w))
    pair = lambda f, a, b: F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), f(F.col(a), F.col(b)))
    place = F.struct(*[F.col(f"_r.{c}") for c in [ts, *tiebreak]])
    part = t.groupBy(*k, "_chunk").agg(
        *[F.first(c).alias(f"_by_{c}") for c in by], F.min_by("_r", place).alias("_first"), F.max_by("_r", place).alias("_last"),
        *[agg[how](pair(f, "_p", "_r")).alias(f"_in_{n}") for n, (how, f) in metrics.items()])
    part = part.withColumn("_before", F.lag("_last").over(Window.partitionBy(*k).orderBy("_chunk")))
    two = {"sum": lambda a, b: F.coalesce(a + b, a, b), "min": F.least, "max": F.greatest}
    cross = {n: two[how](F.col(f"_in_{n}"), pair(f, "_before", "_first")) for n, (how, f) in metrics.items()}
    part = part.select(*[F.col(f"_by_{c}").alias(c) for c in by], *[c.alias(n) for n, c in cross.items()])
    return part.groupBy(*by).agg(*[agg[how](n).alias(n) for n, (how, _) in metrics.items()])


def rolling_sums(df: DataFrame, keys, values: dict, seconds: int, ts: str = "timestamp",
                 chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """``keys, ts`` (each time of a key once) and, for each of ``values`` (name to a
    decimal column), its sum over the key's rows of the ``seconds`` up to that
    time, both ends included (a RANGE frame), across chunk borders.

    The frame is a difference of two running sums, the second one looked up as of
    just before the frame; rows and look-ups are united, so the data doubles
    whatever the frame's length."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    times = df.groupBy(*keys, ts).agg(*[F.sum(c).alias(f"_v_{n}") for n, c in values.items()])
    times = stage(ordered(times, keys, ts, sums={f"_r_{n}": f"_v_{n}" for n in values}, chunk_seconds=chunk_seconds).select(
        *keys, ts, F.struct(*[F.col(f"_r_{n}").alias(n) for n in values]).alias("_run")))
    before = F.timestamp_micros(F.unix_micros(ts) - F.lit(seconds * 1_000_000 + 1))
    asked = times.select(*keys, before.alias(ts), F.col(ts).alias("_of"), F.col("_run").alias("_now"), F.lit(1).alias("_kind"))
    both = times.withColumn("_kind", F.lit(0)).unionByName(asked, allowMissingColumns=True)
    both = ordered(both, keys, ts, ("_kind",), last={"_old": "_run"}, chunk_seconds=chunk_seconds).where(F.col("_kind") == 1)
    return both.select(*keys, F.col("_of").alias(ts), *[(F.col(f"_now.{n}") - F.coalesce(F.col(f"_old.{n}"), F.lit(0))).alias(n) for n in values])


def last_rows(df: DataFrame, keys, n: int, ts: str = "timestamp", tiebreak=(), chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """The last ``n`` rows of each key, with ``_from_end`` (1: the last).  Each
    chunk keeps ``n`` rows at most before a key's rows meet."""
    t, keys, k = _keyed(with_chunks(df, keys, ts, chunk_seconds), keys)
    order = [F.desc(c) for c in [ts, *tiebreak]]
    t = t.withColumn("_in", F.row_number().over(Window.partitionBy(*k, "_chunk").orderBy(*order))).where(F.col("_in") <= n)
    t = t.withColumn("_from_end", F.row_number().over(Window.partitionBy(*k).orderBy(*order))).where(F.col("_from_end") <= n)
    return t.select(*df.columns, "_from_end")


def consecutive_gaps(tx: DataFrame, key: str = "account", ts: str = "timestamp",
                     chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """All next-minus-current intervals of each key's sorted timeline: (key,
    gap_us, gap_days), in whole microseconds and in days.  Ties give 0."""
    t = ordered(tx.select(F.col(key), F.col(ts).alias("_ts")), key, "_ts", next={"_next": "_ts"}, chunk_seconds=chunk_seconds)
    return (t.where(F.col("_next").isNotNull())
             .select(key, gap_us("_ts", "_next").alias("gap_us"), day_diff("_ts", "_next").alias("gap_days")))


def with_neighbors(df: DataFrame, key: str = "account", ts: str = "timestamp",
                   tiebreak=(), chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Add ``prev_ts`` and ``next_ts``: the key's previous / next timestamp in
    (ts, *tiebreak) order, across chunk borders."""
    return ordered(df, key, ts, tiebreak, prev={"prev_ts": ts}, next={"next_ts": ts}, chunk_seconds=chunk_seconds)


def running_sums(df: DataFrame, key, order: list, values: dict,
                 chunk_seconds: int = DEFAULT_CHUNK_SECONDS, ts: str = "timestamp") -> DataFrame:
    """Inclusive running sums per key in ``order`` (``ts`` first); ``values``
    maps output name to a numeric Column."""
    return ordered(df, key, ts, [c for c in order if c != ts], sums=values, chunk_seconds=chunk_seconds)


def with_previous(df: DataFrame, key, ts: str = "timestamp", carry=(), tiebreak=(),
                  chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Add ``prev_ts`` and ``prev_<c>`` for ``c`` in ``carry``: the values of
    the previous row of the same key in (ts, *tiebreak) order."""
    return ordered(df, key, ts, tiebreak, prev={"prev_ts": ts, **{f"prev_{c}": c for c in carry}}, chunk_seconds=chunk_seconds)


def min_at_or_after(df: DataFrame, key, value: str, out: str, ts: str = "timestamp",
                    chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """``out`` = min of ``value`` over rows of the same key with a timestamp at
    or after the row's (ties included), e.g. the next repayment time."""
    return ordered(df, key, ts, following={out: value}, chunk_seconds=chunk_seconds)


def last_known(df: DataFrame, key, value: str, out: str, ts: str = "timestamp", tiebreak=(),
               chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """As-of carry-forward: ``out`` = the last non-NULL ``value`` of the same key
    at or before the row in (ts, *tiebreak) order."""
    return ordered(df, key, ts, tiebreak, last={out: value}, chunk_seconds=chunk_seconds)
