"""Operator 13: places of all rows, mixture of each shard, odd input."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import stratified_shards as S

SCHEMA = "doc_id long, text string, source string, shard string, row int, key string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, "k") for r in rows], SCHEMA)


def sharded(spark, df, **more):
    return S.read_shards(spark, S.write_shards(df, **more), df.schema).collect()


def brute(rows, shards):
    """Places by the definition: ids are unique here."""
    import hashlib
    groups = {}
    for i, _, s in rows:
        groups.setdefault(s, []).append((hashlib.md5(f"{S.SEED}:{i}".encode()).hexdigest(), i))
    order = []
    for s, g in groups.items():
        order += [((2 * r + 1) / (2 * len(g)), s is not None, s or "", r, i) for r, (_, i) in enumerate(sorted(g))]
    n, out = len(order), {}
    for at, (*_, i) in enumerate(sorted(order)):
        shard = at * shards // n
        out[i] = (shard, at - -(-shard * n // shards))
    return out


@pytest.mark.parametrize("n, shards", [(1, 16), (15, 16), (500, 16), (333, 7)])
def test_equals_the_definition(spark, n, shards):
    rng = random.Random(n)
    rows = [(i * 7 - 20, f"text {i}" * (i % 5), rng.choice(["a"] * 6 + ["b", "c", None, ""])) for i in range(n)]
    got = sharded(spark, docs(spark, rows).repartition(5), shards=shards)
    assert {r.row.doc_id: (r.shard, r.slot) for r in got} == brute(rows, shards)
    assert Counter((r.row.doc_id, r.row.text, r.row.source) for r in got) == Counter(rows)


def test_each_shard_has_the_mixture(spark):
    rows = [(i, "x", "hot" if i % 3 else f"s{i % 15}") for i in range(3000)]
    count = Counter((r.shard, r.row.source) for r in sharded(spark, docs(spark, rows)))
    for source in {s for _, _, s in rows}:
        own = [count[k, source] for k in range(16)]
        assert max(own) - min(own) <= 2
    total = Counter()
    for (shard, _), c in count.items():
        total[shard] += c
    assert max(total.values()) - min(total.values()) <= 1


def test_repeated_rows_nulls_and_no_rows(spark):
    rows = [(1, "same", "a")] * 70 + [(None, None, None)] * 40 + [(1, "other", "a"), (2, "", "a"), (3, None, "b")]
    got = sharded(spark, docs(spark, rows).repartition(4))
    assert Counter((r.row.doc_id, r.row.text, r.row.source) for r in got) == Counter(rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(by) == 16
    assert sharded(spark, docs(spark, [])) == []


def test_digests_come_from_the_files(spark):
    text = "é" * 100_000 + "\U0001f600"
    df = docs(spark, [(5, text, "a"), (6, None, "a")])
    got = S.digests(S.read_shards(spark, S.write_shards(df), df.schema)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in got] == [(5, 200_005, zlib.crc32(text.encode()), "rows", None), (6, 1, 0, "rows", None)]


def test_ranks_do_not_depend_on_partitions(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("g"), F.col("id").alias("v"))
    want = None
    for n in (1, 4, 13):
        got = {r.v: (r._rank, r._size) for r in S.rank_in_groups(df, "g", ["v"], n).collect()}
        assert want in (None, got) and len(got) == 1000
        want = got
    assert want[999] == (333, 334) and want[998] == (332, 333)
