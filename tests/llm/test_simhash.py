"""Operator 4 against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import simhash as S

TEXTS = [(5, "a b c d e f g"), (1, "a b c d e f g"), (9, None), (3, ""), (7, "  one\ttwo "), (2, "é" * 999 + " x"), (-8, " ".join(f"w{i % 700}" for i in range(40_000))), (4, "\n\n")]


def word_hash(spark, words):
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).collect()
    return {r.w: r.h for r in rows}


def test_votes(spark):
    """Each bit is the majority of the term hashes, which Spark gives for runs of five word hashes."""
    texts = {i: (t or "").split() for i, t in TEXTS}
    hashes = word_hash(spark, {w for ws in texts.values() for w in ws})
    terms = [(i, *(ws[k + j] if k + j < len(ws) else None for j in range(5))) for i, ws in texts.items() for k in range(max(1, len(ws) - 4)) if ws]
    rows = [(t[0], *(hashes.get(w) for w in t[1:])) for t in terms]
    got = spark.createDataFrame(rows, "i long, a long, b long, c long, d long, e long").select("i", F.xxhash64("a", "b", "c", "d", "e").alias("h")).collect()
    want = {}
    for i in texts:
        votes = [r.h & (2**64 - 1) for r in got if r.i == i]
        want[i] = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))
    made = S.add_fingerprint(spark.createDataFrame([(i, t, 0) for i, t in TEXTS], "id long, text string, _n int").drop("_n")).collect()
    assert {r.id: r.fingerprint & (2**64 - 1) for r in made} == want
    assert want[9] == want[3] == want[4] == 0 and want[5] == want[1]


@pytest.mark.parametrize("radius, blocks", [(0, 1), (3, 6), (2, 3), (5, 7)])
def test_search_finds_all_in_the_radius(spark, radius, blocks):
    rng = random.Random(radius)
    some = [rng.getrandbits(64) for _ in range(60)]
    some += [x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for x in some for _ in range(4)]
    signed = [x - (1 << 64) if x >> 63 else x for x in some]
    table = spark.createDataFrame([(x,) for x in signed] + [(None,)], "fingerprint long")
    got = sorted((r["query"], r.found, r.distance) for r in S.near(table.limit(100), table, radius, blocks).collect())
    asked = {r.fingerprint for r in table.limit(100).collect()} - {None}
    want = sorted((a, b, d) for a in asked for b in set(signed) if (d := ((a ^ b) & (2**64 - 1)).bit_count()) <= radius)
    assert got == want


def test_edited_texts(spark):
    docs = spark.createDataFrame([(*t, "x") for t in TEXTS], "doc_id long, text string, id string")
    order = sorted((i, t or "") for i, t in TEXTS)
    got = {r.doc_id: r for r in S.compare_edited(docs, query_step=3).collect()}
    assert len(got) == len(TEXTS)
    for k, (i, t) in enumerate(order):
        n, after = len(t), order[(k + 1) % len(order)][1]
        edit = t[:n - n // 2] + after[:n // 2]
        assert got[i].n_chars == n and got[i].edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        a, b = int(got[i].fingerprint, 16), int(got[i].edited_fingerprint, 16)
        assert got[i].near_edited == 1 - (a ^ b).bit_count() / 64
        c = int(got[order[(k + 1) % len(order)][0]].fingerprint, 16)
        assert got[i].near_next == 1 - (a ^ c).bit_count() / 64
        assert (got[i].n_near is None) == (i % 3 != 0)
    assert got[9].n_near == 3  # the three without words


def test_columns_with_clashing_names(spark):
    df = spark.createDataFrame([("a b c d e f", 1, 2, 3, 4)], "text string, _n int, _terms int, _Votes int, _word_hashes int")
    got = S.add_fingerprint(df).first()
    assert tuple(got)[:5] == tuple(df.first()) and got.fingerprint == S.add_fingerprint(df.select("text")).first().fingerprint


def test_repeated_null_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b c"), (None, "x y"), (None, "x y")], "doc_id long, text string")
    got = S.compare_edited(docs).collect()
    assert sorted((r.doc_id is None, r.n_chars) for r in got) == [(False, 1), (False, 3), (True, 3)]
    assert S.compare_edited(docs.limit(0)).count() == 0
    one = S.compare_edited(docs.limit(1)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_no_python_on_the_executors(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    plan = S.compare_edited(docs)._jdf.queryExecution().toString() + S.splice_next(docs)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "MapInArrow", "ArrowEval"))
