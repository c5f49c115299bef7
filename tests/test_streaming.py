"""Replay and ordering behaviour of the streaming operators."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.streaming import incremental as ST


def _two_files(spark, tmp_dir):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    e.write.mode("overwrite").parquet(os.path.join(tmp_dir, "events_a.parquet"))
    # the second file replays 100 events of the first (same ids, same payload)
    e.orderBy("event_id").limit(100).write.mode("overwrite").parquet(os.path.join(tmp_dir, "events_b.parquet"))
    return e


def test_replayed_events_are_dropped(spark, tmp_dir):
    e = _two_files(spark, tmp_dir)
    s = ST.dedup_events(ST.event_stream(spark, tmp_dir)).select("transaction_hash")
    got = ST.run_to_table(spark, s, "append")
    assert got.count() == e.count() == got.distinct().count()


def test_running_summary_over_two_batches_equals_batch(spark, tmp_dir):
    _two_files(spark, tmp_dir)
    stream = ST.dedup_events(ST.event_stream(spark, tmp_dir))
    got = ST.latest(ST.run_to_table(spark, ST.running_summary(stream), "update"), "wallet")
    from ledgerlens.operators.features import wallet_summary
    from ledgerlens.plans.pipeline import cleaned
    batch = wallet_summary(cleaned(spark, SF_SMALL)).select("wallet", "tx_count")
    diff = got.select("wallet", "tx_count").exceptAll(batch).count() + batch.exceptAll(got.select("wallet", "tx_count")).count()
    assert diff == 0
    assert got.agg(F.sum("tx_count")).first()[0] == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_rescore_against_frozen_statistics(spark):
    from ledgerlens.operators import scoring as SC
    from ledgerlens.plans import pipeline as P
    feats = SC.prepare_scoring(P.features(P.cleaned(spark, SF_SMALL)))
    w = SC.available_weights(feats)
    frozen = SC.feature_stats(feats, w)
    batch = SC.weighted_score(feats, w).select("wallet", F.col("raw_score").alias("expected"))
    got = ST.rescore_batch(feats, frozen, w).join(batch, "wallet")
    assert got.where(F.abs(F.col("raw_score") - F.col("expected")) > 1e-12).count() == 0


def test_keyed_table_is_upserted_by_bucket_and_replay_safe(spark):
    table = ST.KeyedTable(spark, "wallet string, n long", "wallet", buckets=8)
    rows = lambda lo, hi, n: spark.range(lo, hi).selectExpr("concat('w', id) AS wallet", f"{n}L AS n")
    assert table.read().count() == 0
    table.upsert(rows(0, 100, 1), 0)
    first = table.versions()
    table.upsert(rows(3, 4, 2), 1)
    table.upsert(rows(100, 100, 9), 2)          # an empty batch
    assert {v for b, v in table.versions().items() if first[b] != v} == {1}
    assert sum(first[b] != v for b, v in table.versions().items()) == 1      # one bucket was written again
    want = sorted([(f"w{i}", 2 if i == 3 else 1) for i in range(100)])
    assert sorted(map(tuple, table.read().collect())) == want
    table.upsert(rows(3, 4, 2), 1)              # the batch is run again, and so is the next
    table.upsert(rows(100, 100, 9), 2)
    assert sorted(map(tuple, table.read().collect())) == want
    assert len(table.vacuum()) == 1 and table.vacuum() == []
    assert sorted(map(tuple, table.read().collect())) == want


def test_summary_table_follows_wallets_not_batches(spark, tmp_dir):
    _two_files(spark, tmp_dir)
    table = ST.summary_table(spark, ST.running_summary(ST.event_stream(spark, tmp_dir)))
    got = table.read()
    assert got.count() == got.select("wallet").distinct().count()
    assert got.agg(F.sum("tx_count")).first()[0] == spark.read.parquet(f"{SF_SMALL}/events.parquet").count() + 100


def _sessions(points, gap):
    out = {}
    for w, t in sorted(points):
        own = out.setdefault(w, [])
        if own and t - own[-1][1] <= gap:
            own[-1] = (own[-1][0], t, own[-1][2] + 1)
        else:
            own.append((t, t, 1))
    return sorted((w, *x) for w, xs in out.items() for x in xs)


def test_merge_sessions_equals_gaps_and_islands(spark):
    import random
    import datetime as dt
    rng, gap = random.Random(5), 100
    t0 = dt.datetime(2024, 1, 1)
    points = [(f"w{rng.randrange(4)}", rng.randrange(0, 20_000)) for _ in range(400)] + [("w0", 5000)] * 5
    rng.shuffle(points)
    sessions = spark.createDataFrame([], ST.SESSION)
    for k in range(0, len(points), 150):
        events = spark.createDataFrame([(w, t0 + dt.timedelta(seconds=t)) for w, t in points[k:k + 150]], "wallet string, timestamp timestamp")
        sessions = ST.stage(ST.merge_sessions(sessions, events, gap).select("wallet", "start", "end", "events"))
    s = lambda t: int((t - t0).total_seconds())
    assert sorted((r.wallet, s(r.start), s(r.end), r.events) for r in sessions.collect()) == _sessions(points, gap)


def test_late_rows_are_kept_aside(spark, tmp_dir):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    mark = e.agg(F.expr("max(ts) - INTERVAL 10 DAYS")).first()[0]
    for name, part in (("events_0", "event_id % 5 <> 1"), ("events_1", "event_id % 5 = 1")):
        e.where(part).coalesce(1).write.parquet(os.path.join(tmp_dir, f"{name}.parquet"))
    closed, still, late = ST.sessions_to_tables(spark, ST.event_stream(spark, tmp_dir), 3600, 10 * 86_400)
    n = e.count()
    assert late.count() == e.where("event_id % 5 = 1").where(F.col("ts") < F.lit(mark)).count() > 0
    assert closed.unionByName(still).agg(F.sum("events")).first()[0] + late.count() == n


def test_frozen_cuts_give_the_batch_score(spark):
    from ledgerlens.operators import scoring as SC
    raw = spark.range(997).selectExpr("concat('w', id) AS wallet", "round(pow((id * 37 % 211) / 211.0, 2), 3) AS raw_score")
    final = SC.final_score(raw)
    cuts = ST.frozen_cuts(final).first().cuts
    assert all(sum(c < r.raw_score for c in cuts) == r.final_score for r in final.collect())
    assert len(cuts) == 100 and sum(c < 5.0 for c in cuts) == 100
