"""Incremental ingestion and running wallet state.

The reference is batch only; these are the same column functions applied to
a file stream.  State is keyed by wallet and bounded by watermarks where the
output is windowed; custom running statistics use
``applyInPandasWithState``.  Checkpoints and result tables go to the shared
folder named by ``spark.checkpoint.dir``; no result is held by the driver.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ledgerlens.operators.clean import clean_transactions
from ledgerlens.operators.ordered import gap_us, ordered
from ledgerlens.session import ensure_checkpoint_dir, stage, use_utc
from ledgerlens.sources.adapters import adapt_events

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """File stream of the ``events`` table, adapted and cleaned with the
    batch column functions."""
    use_utc(spark)
    raw = (spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
                .parquet(f"{sf_dir.rstrip('/')}/events*.parquet"))
    return clean_transactions(adapt_events(raw, "sparse"))


def dedup_events(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop replayed events; state is bounded by the watermark."""
    return (stream.withWatermark("timestamp", delay)
                  .dropDuplicatesWithinWatermark(["transaction_hash", "event_type", "account", "token"]))


def running_summary(stream: DataFrame) -> DataFrame:
    """Stateful per-wallet summary (update / complete mode)."""
    ev = F.col("event_type")
    return stream.groupBy(F.col("account").alias("wallet")).agg(
        F.min("timestamp").alias("first_tx_timestamp"), F.max("timestamp").alias("last_tx_timestamp"),
        F.count(F.lit(1)).alias("tx_count"),
        *[F.count_if(ev == e).alias(n) for e, n in (("Mint", "mint_count"), ("Redeem", "redeem_count"),
                                                       ("Borrow", "borrow_count"), ("RepayBorrow", "repay_count"),
                                                       ("LiquidateBorrow", "liquidation_count"))],
        F.sum(F.when(ev == "Mint", F.col("amount"))).alias("supply_volume"),
        F.sum(F.when(ev == "Borrow", F.col("amount"))).alias("borrow_volume"))


def windowed_activity(stream: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Tumbling-window counts per wallet with a watermark; rows later than
    the watermark are dropped."""
    return (stream.withWatermark("timestamp", delay)
                  .groupBy(F.col("account").alias("wallet"), F.window("timestamp", width).alias("w"))
                  .agg(F.count(F.lit(1)).alias("events"), F.sum("amount").alias("volume")))


def sliding_activity(stream: DataFrame, width: str = "1 hour", slide: str = "15 minutes", delay: str = "1 hour") -> DataFrame:
    """Sliding-window counts per wallet."""
    return (stream.withWatermark("timestamp", delay)
                  .groupBy(F.col("account").alias("wallet"), F.window("timestamp", width, slide).alias("w"))
                  .agg(F.count(F.lit(1)).alias("events"), F.sum("amount").alias("volume")))


SESSION = "wallet string, start timestamp, end timestamp, events long"


def merge_sessions(sessions: DataFrame, events: DataFrame, gap_seconds: int) -> DataFrame:
    """Sessions (``wallet, start, end, events``) after ``events`` (``wallet, timestamp``)
    came in: an event extends or joins the sessions it is within ``gap_seconds`` of.

    A session stands for its events by its two ends; what lies between them is
    inside, however far from either.  Two ordered passes, so a wallet with a third
    of a batch spreads over tasks."""
    point = lambda ts, n, step: F.struct(F.col(ts).alias("timestamp"), n.cast("long").alias("n"), F.lit(step).alias("step"))
    ends = sessions.select("wallet", F.explode(F.array(point("start", F.col("events"), 1), point("end", F.lit(0), -1))).alias("p")).select("wallet", "p.*")
    all_points = events.select("wallet", "timestamp", F.lit(1).cast("long").alias("n"), F.lit(0).alias("step")).unionByName(ends)
    # At one time a session opens before and closes after what else happens.
    t = ordered(all_points.withColumn("_o", -F.col("step")), "wallet", tiebreak=("_o",), prev={"_before": "timestamp"}, sums={"_depth": "step"})
    apart = F.col("_before").isNull() | ((F.col("_depth") - F.col("step") == 0) & (gap_us("_before", "timestamp") > gap_seconds * 1_000_000))
    t = ordered(t.withColumn("_new", F.when(apart, 1).otherwise(0)), "wallet", tiebreak=("_o",), sums={"_island": "_new"})
    return t.groupBy("wallet", "_island").agg(F.min("timestamp").alias("start"), F.max("timestamp").alias("end"), F.sum("n").alias("events")).drop("_island")


def sessions_to_tables(spark: SparkSession, stream: DataFrame, gap_seconds: int = 3600, delay_seconds: int = 3600, timeout_s: int = 600) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Session windows per wallet with merging state, in append mode.  Returns the
    tables ``closed`` (sessions that no event can extend any more), ``open`` and
    ``late``: the rows older than the watermark, whole, instead of a count of them.

    The watermark is the latest time in earlier micro-batches less ``delay_seconds``.
    Each batch writes its closed sessions, its late rows, the open sessions after it
    and the latest time, all under its id; one that is run again starts from the
    tables of the batch before it and replaces its own."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/sessions-{uuid.uuid4().hex[:12]}"
    kind = stream.schema
    empty = spark.createDataFrame([], SESSION)
    first = {"closed": empty, "open": empty, "late": spark.createDataFrame([], kind), "clock": spark.createDataFrame([], "latest timestamp")}
    for name, table in first.items():
        write_batch(table, f"{root}/{name}", -1)
    read = lambda name, i, like: spark.read.schema(like.schema).parquet(f"{root}/{name}/batch_id={i}")

    def step(batch: DataFrame, i: int) -> None:
        seen = read("clock", i - 1, first["clock"]).agg(F.max("latest").alias("latest")).first().latest
        rows = stage(batch)
        mark = None if seen is None else F.lit(seen) - F.expr(f"INTERVAL {delay_seconds} SECONDS")
        late = rows.where(F.lit(False) if mark is None else F.col("timestamp") < mark)
        write_batch(late, f"{root}/late", i)
        kept = rows if mark is None else rows.where(F.col("timestamp") >= mark)
        now = stage(merge_sessions(read("open", i - 1, empty), kept.select(F.col("account").alias("wallet"), "timestamp"), gap_seconds))
        latest_now = rows.agg(F.max("timestamp").alias("t")).first().t
        latest_now = max([t for t in (seen, latest_now) if t is not None], default=None)
        done = F.lit(False) if latest_now is None else F.col("end") < F.lit(latest_now) - F.expr(f"INTERVAL {delay_seconds + gap_seconds} SECONDS")
        write_batch(now.where(done).select(*empty.columns), f"{root}/closed", i)
        write_batch(now.where(~done).select(*empty.columns), f"{root}/open", i)
        write_batch(spark.createDataFrame([(latest_now,)], "latest timestamp"), f"{root}/clock", i)
        _done.append(i)

    _done: list = [-1]
    query = stream.writeStream.queryName(f"ll_{uuid.uuid4().hex[:12]}").trigger(availableNow=True) \
        .option("checkpointLocation", f"{root}/state").foreachBatch(step).start()
    _finish(query, timeout_s, None)
    table = lambda name: spark.read.schema(first[name].schema).parquet(f"{root}/{name}").drop("batch_id")
    return table("closed"), read("open", max(_done), empty), table("late")


#: Wallets share a group of ``applyInPandasWithState`` by hash: a call for each wallet takes
#: milliseconds, one for a bucket not many more.
INTERVAL_BUCKETS = 2048
INTERVAL_STATE = "wallets binary"
INTERVAL_OUT = "wallet string, gaps long, avg_gap_days double, stddev_gap_days double, last_tx_us long, late_events long"
_NUMBERS = {"n": "int64", "mean": "float64", "m2": "float64", "last_us": "int64", "late": "int64"}


def _pack(wallets, numbers: dict) -> bytes:
    """A bucket's running numbers as one Arrow stream."""
    sink = pa.BufferOutputStream()
    table = pa.table({"wallet": pa.array(wallets, pa.string()), **numbers})
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(state) -> tuple:
    """Wallets and running numbers of a bucket; empty ones without a state."""
    if not state.exists:
        return np.empty(0, object), {c: np.empty(0, t) for c, t in _NUMBERS.items()}
    table = pa.ipc.open_stream(state.get[0]).read_all()
    return table["wallet"].to_numpy(), {c: table[c].to_numpy() for c in _NUMBERS}


def _interval_update(key, batches, state):
    """Merge a batch's inter-event gaps into the count, mean and sum of squared
    deviations of each wallet of a bucket (without a column ``wallet`` the group is
    one wallet, the key).  Only an event's time is kept, so one that is older than
    its wallet's last cannot be placed any more: it is counted as late.  A group may
    come in several parts, which are put in order together: a task holds the times
    of one bucket and micro-batch."""
    parts = [(b["wallet"].to_numpy(object) if "wallet" in b else np.full(len(b), key[0], object), b["us"].to_numpy()) for b in batches]
    us = np.concatenate([p[1] for p in parts]).astype("int64")
    known, was = _unpack(state)
    code, names = pd.factorize(np.concatenate([known, *(p[0] for p in parts)]), use_na_sentinel=False)
    old, code = len(known), code[len(known):]     # a known wallet's code is its place
    size = len(names)
    n, mean, m2, last, late = (np.concatenate([was[c], np.zeros(size - old, t)]) for c, t in _NUMBERS.items())
    touched = np.unique(code)

    missed = (code < old) & (us < last[code])
    late += np.bincount(code[missed], minlength=size)
    before = touched[touched < old]
    of, ts = np.concatenate([before, code[~missed]]), np.concatenate([last[before], us[~missed]])
    order = np.lexsort((ts, of))
    of, ts = of[order], ts[order]
    same = of[1:] == of[:-1]
    gaps, at = np.diff(ts)[same] / 86400e6, of[1:][same]
    m = np.bincount(at, minlength=size)
    own = np.bincount(at, gaps, size) / np.maximum(m, 1)
    delta, both = own - mean, np.maximum(n + m, 1)
    m2 += np.bincount(at, (gaps - own[at]) ** 2, size) + delta**2 * n * m / both
    mean += delta * m / both
    n += m
    ends = np.append(~same, True)
    last[of[ends]] = ts[ends]

    state.update((_pack(names, {"n": n, "mean": mean, "m2": m2, "last_us": last, "late": late}),))
    n, mean, m2 = n[touched], mean[touched], m2[touched]
    yield pd.DataFrame({"wallet": names[touched], "gaps": n, "avg_gap_days": np.where(n > 0, mean, None),
                        "stddev_gap_days": np.where(n > 0, np.sqrt(m2 / np.maximum(n, 1)), None), "last_tx_us": last[touched],
                        "late_events": late[touched]})


def interval_stats(stream: DataFrame, buckets: int | None = None) -> DataFrame:
    """Running count, mean and deviation of inter-event gaps per wallet in user
    state: a row per wallet and micro-batch that touches it (see
    :func:`latest`).  Events that are older than the last one of an
    earlier batch of the wallet are counted in ``late_events``, not in the gaps.
    State is kept per bucket of wallets; a micro-batch writes the buckets it touches."""
    from ledgerlens.session import ship_package
    ship_package(stream.sparkSession)
    bucket = F.pmod(F.xxhash64(F.col("account")), F.lit(buckets or INTERVAL_BUCKETS)).cast("int").alias("bucket")
    s = stream.select(bucket, F.col("account").alias("wallet"), F.unix_micros("timestamp").alias("us"))
    return s.groupBy("bucket").applyInPandasWithState(_interval_update, INTERVAL_OUT, INTERVAL_STATE, "update",
                                                     GroupStateTimeout.NoTimeout)


def rescore_batch(batch: DataFrame, frozen: DataFrame, weights: dict) -> DataFrame:
    """Weighted score of the wallets touched by a micro-batch against frozen
    min/max statistics (one broadcast row ``min__f``/``max__f``); rounded to 12 digits."""
    j = batch.crossJoin(F.broadcast(frozen))
    total = F.lit(0.0)
    for f, w in weights.items():
        if f not in batch.columns:
            continue
        lo, hi = F.col(f"min__{f}"), F.col(f"max__{f}")
        norm = (F.least(F.greatest(F.col(f).cast("double"), lo), hi) - lo) / (hi - lo)
        norm = F.lit(1.0) - norm if w < 0 else norm
        total = total + F.coalesce(F.when(hi > lo, norm * F.lit(abs(w))), F.lit(0.0))
    s = sum(abs(w) for f, w in weights.items() if f in batch.columns) or 1.0
    return j.select("wallet", F.round(total / F.lit(s), 12).alias("raw_score"))


def _finish(query, timeout_s: int, report: dict | None) -> None:
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError(f"stream {query.name} did not finish in {timeout_s}s")
    if query.exception():
        raise query.exception()
    if report is not None:
        report["late_rows"] = sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress
                                  for op in (p if isinstance(p, dict) else p.jsonValue).get("stateOperators", []))


def run_to_table(spark: SparkSession, query_df: DataFrame, mode: str = "update", name: str | None = None,
                 timeout_s: int = 600, report: dict | None = None) -> DataFrame:
    """Run a streaming query over everything available (availableNow) into a
    Parquet table under the shared checkpoint folder and read it back.

    ``append`` uses the file sink.  ``update`` writes each micro-batch's rows to a
    folder of its own, so a batch that is run again replaces itself; column
    ``batch_id`` tells them apart (:func:`latest` keeps the last row of a key).
    ``report`` gets ``late_rows``, the rows that a watermark dropped."""
    if mode not in ("append", "update"):
        raise ValueError(mode)
    name = name or f"ll_{uuid.uuid4().hex[:12]}"
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    out = f"{root}/rows"
    writer = query_df.writeStream.queryName(name).outputMode(mode).trigger(availableNow=True) \
        .option("checkpointLocation", f"{root}/state")
    if mode == "append":
        _finish(writer.format("parquet").start(out), timeout_s, report)
        return spark.read.schema(query_df.schema).parquet(out)
    schema = query_df.schema
    write_batch(spark.createDataFrame([], schema), out, -1)   # so that the table exists without a batch
    _finish(writer.foreachBatch(lambda batch, i: write_batch(batch, out, i)).start(), timeout_s, report)
    return spark.read.schema(schema.add("batch_id", "long")).parquet(out)


def write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """Write a micro-batch's rows as the partition of its id."""
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def latest(rows: DataFrame, keys) -> DataFrame:
    """The last row of each key of an ``update`` table."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in rows.columns if c not in (*keys, "batch_id")]
    last = F.max_by(F.struct(*rest), "batch_id").alias("_last")
    return rows.groupBy(*keys).agg(last).select(*keys, "_last.*")


def frozen_cuts(final: DataFrame) -> DataFrame:
    """One row, ``cuts``: for each score k from 1 to 100 the largest raw score that
    stays below k.  A raw score's final score is the number of cuts below it,
    equal to its percentile score where the frozen table has it."""
    top = final.groupBy("final_score").agg(F.max("raw_score").alias("top"))     # 101 rows at most
    below = [F.coalesce(F.max(F.when(F.col("final_score") < k, F.col("top"))), F.lit(float("-inf"))) for k in range(1, 101)]
    return top.agg(F.array(*below).alias("cuts"))


def rescored_stream(spark: SparkSession, summaries: DataFrame, frozen: DataFrame, weights: dict,
                    cuts: DataFrame | None = None, timeout_s: int = 600) -> DataFrame:
    """The wallets that a micro-batch touches are scored again from their
    running summaries against frozen statistics (and, with ``cuts``, get their
    0-100 score): a table with one row per wallet."""
    table = KeyedTable(spark, "wallet string, raw_score double" + (", final_score int" if cuts is not None else ""), "wallet")

    def scored(batch: DataFrame) -> DataFrame:
        s = rescore_batch(batch, frozen, weights)
        if cuts is None:
            return s
        return s.crossJoin(F.broadcast(cuts)).select("wallet", "raw_score", F.size(F.filter("cuts", lambda c: c < F.col("raw_score"))).alias("final_score"))   # a row of 100 numbers

    query = (summaries.writeStream.queryName(f"ll_{uuid.uuid4().hex[:12]}").outputMode("update").trigger(availableNow=True)
             .option("checkpointLocation", f"{table.root}/state")
             .foreachBatch(lambda batch, i: table.upsert(scored(batch), i)).start())
    _finish(query, timeout_s, None)
    return table.read()


def summary_table(spark: SparkSession, summaries: DataFrame, timeout_s: int = 600) -> KeyedTable:
    """Running summaries upserted into a table with one row per wallet."""
    table = KeyedTable(spark, summaries.schema, "wallet")
    query = (summaries.writeStream.queryName(f"ll_{uuid.uuid4().hex[:12]}").outputMode("update").trigger(availableNow=True)
             .option("checkpointLocation", f"{table.root}/state").foreachBatch(table.upsert).start())
    _finish(query, timeout_s, None)
    return table


class KeyedTable:
    """A Parquet table with one row per key, upserted copy-on-write.

    Rows lie in ``buckets`` by hash of the key.  A batch rewrites the buckets it
    touches under its own id and then publishes a manifest that names the
    version of every bucket; readers take the last manifest, so they see all of a
    batch or nothing.  A batch that is run again starts from the manifest before its
    own and replaces what it wrote.  Only bucket numbers pass through the driver."""

    def __init__(self, spark: SparkSession, schema, key: str, buckets: int = 32, root: str | None = None):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/table-{uuid.uuid4().hex[:12]}"
        self.schema = spark.createDataFrame([], schema).schema

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self, before: int | None = None) -> dict:
        """Bucket to version, by the last manifest (of those before batch ``before``)."""
        fs, folder = self._path("manifest")
        if not fs.exists(folder):
            return {}
        found = [int(f.getPath().getName()) for f in fs.listStatus(folder)
                 if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
        found = [i for i in found if before is None or i < before]
        if not found:
            return {}
        return {r.bucket: r.version for r in self.spark.read.schema("bucket int, version long").parquet(f"{self.root}/manifest/{max(found)}").collect()}

    def _rows(self, versions: dict) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/v={v}/bucket={b}" for b, v in sorted(versions.items())])

    def read(self) -> DataFrame:
        return self._rows(self.versions())

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Replace or add the rows of ``batch``'s keys (each key once)."""
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("bucket")
        batch = stage(batch.select(*self.schema.names))
        now = self.versions(batch_id)
        touched = [r.bucket for r in batch.select(bucket).distinct().collect()]
        old = self._rows({b: now[b] for b in touched if b in now})
        kept = old.join(batch.select(self.key), self.key, "left_anti")
        (kept.unionByName(batch).select("*", bucket).repartition(max(1, len(touched)), "bucket")
             .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/v={batch_id}"))
        now |= {b: batch_id for b in touched}
        self.spark.createDataFrame([(b, v) for b, v in now.items()], "bucket int, version long").coalesce(1) \
            .write.mode("overwrite").parquet(f"{self.root}/manifest/{batch_id}")

    def vacuum(self) -> list:
        """Remove the versions of buckets that the last manifest doesn't name; their paths."""
        keep = {f"v={v}/bucket={b}" for b, v in self.versions().items()}
        fs, root = self._path("")
        gone = []
        for v in fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(root, "v=*/bucket=*")) or []:
            name = f"{v.getPath().getParent().getName()}/{v.getPath().getName()}"
            if name not in keep:
                fs.delete(v.getPath(), True)
                gone.append(name)
        return sorted(gone)
