"""Operator 9 against all pairs, and its trees against themselves."""

import random
from itertools import combinations

import numpy as np
import pytest

from ledgerlens.llm import signature_join as J
from ledgerlens.llm.components import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_set(text):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(id, size, smallest id reachable) for each row."""
    sets, up = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        s, t = sets[a], sets[b]
        if s and t and 100 * len(s & t) >= 80 * len(s | t):
            up[top(a)] = top(b)
    small = {}
    key = lambda i: -2**63 if i is None else i
    for k, (i, _) in enumerate(rows):
        small[top(k)] = min(small.get(top(k), i), i, key=key)
    return sorted(((i, len(sets[k]), small[top(k)]) for k, (i, _) in enumerate(rows)), key=str)


def corpus(seed, n=160):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnopqrst") + rng.choice("xyz")
    common = " ".join(word() for _ in range(30))
    base = [" ".join(word() for _ in range(rng.choice([1, 3, 5, 7, 20, 60, 200]))) for _ in range(n // 5)]
    out = []
    for i in range(n):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            words[rng.randrange(len(words))] = word()
        text = " ".join(words)
        if rng.random() < 0.3:
            text = f"{common}\n{text}"
        out.append((i * 7 % n - 3, text.upper() if rng.random() < 0.2 else text))
    return out


def result(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int").repartition(3)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.link_components(df).collect()), key=str)


@pytest.mark.parametrize("seed", [0, 1])
def test_all_links_are_found(spark, seed):
    rows = corpus(seed) + [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "é b"), (1004, "É b"), (1005, "x " * 30_000), (1006, "x " * 30_001)]
    assert result(spark, rows) == brute(rows)


def test_trees_alone_find_all(spark, monkeypatch):
    """Without the first traversal and with tiny trees and groups the second finds every link by itself."""
    monkeypatch.setattr(J, "_plausible", lambda pairs, light: pairs.limit(0))
    monkeypatch.setattr(J, "GROUP", 8)
    monkeypatch.setattr(J, "LEAF", 2)
    monkeypatch.setattr(J, "FANOUT", 2)
    rows = corpus(5, 120)
    assert result(spark, rows) == brute(rows)


def test_repeated_and_null_ids(spark):
    rows = [(4, "a b c d e f"), (4, "a b c d e f"), (2, "A b c\td e f"), (2, "other words"), (None, "a b c d e f"), (9, "q r"), (9, "q r"), (8, "q  r")]
    assert result(spark, rows) == brute(rows)


def test_a_set_meets_its_own_text_only(spark, monkeypatch):
    common = " ".join(f"w{k}" for k in range(80))
    rows = [(None if i % 2 else 7, f"{common} number{i}") for i in range(60)] + [(9, f"{common} nine")] * 3
    met, plain = [], J._sets
    monkeypatch.setattr(J, "_sets", lambda texts: met.append(texts.count()) or plain(texts))
    assert result(spark, rows) == brute(rows)
    assert 0 < met[0] <= len(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert J.link_components(df).count() == 0 == J.keep_one(df).count()
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, J.link_components(only).drop("part").collect())) == [(1, 0, 1), (2, 0, 2)]


def test_keep_one(spark):
    rows = corpus(3, 80) + [(500, None), (501, "")]
    df = spark.createDataFrame([(t, i, "en", "p") for i, t in rows], "text string, doc_id long, lang string, n string")
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    want = {c for _, n, c in brute(rows) if n} | {500, 501}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert {(r.doc_id, r.text) for r in kept.collect()} <= {(i, t) for i, t in rows}


def test_columns_with_clashing_names(spark):
    rows = [(1, "a b c d e f g", 77, 5), (2, "a b c d e f g", 78, 6), (3, "other words are here now", 79, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id int, _PART int")
    assert sorted(map(tuple, J.keep_one(df).collect())) == [rows[0], rows[2]]


@pytest.mark.parametrize("batch", [1, 2, 3, 1000])
def test_shared_postings_over_batches(spark, batch):
    rng = random.Random(batch)
    rows = [(rng.randrange(40), 0, rng.randrange(3), 9) for _ in range(150)] + [(50, 0, 7, 9)] * 40 + [(60, 1 + k % 3, k, 9) for k in range(9)] + [(70, 0, k // 5, 9) for k in range(60)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = sorted((r.token, r.key) for r in J._shared(spark.createDataFrame(rows, "token long, salt int, key long, n long")).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    keys = {}
    for t, _, k, _ in rows:
        keys.setdefault(t, set()).add(k)
    assert got == sorted((t, k) for t, ks in keys.items() for k in ks if len(ks) > 1)


@pytest.mark.parametrize("seed", range(5))
def test_no_pair_that_could_link_is_pruned(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(40):
        base = np.unique(rng.integers(0, 2**63, rng.integers(1, 400), dtype=np.uint64))
        for _ in range(3):
            sets.append(np.unique(np.concatenate([base[rng.random(len(base)) > 0.05], rng.integers(0, 2**63, 2, dtype=np.uint64)])))
    n = np.array([len(s) for s in sets])
    component, side = rng.integers(0, 60, len(sets)), rng.integers(0, 2, len(sets))
    groups = J.by_width(np.arange(len(sets)), n, component, [J.signature(s).tobytes() for s in sets], side)
    assert len(groups) > 1
    for cross in (False, True):
        got = {tuple(sorted(p)) for p in J.traverse(groups, cross)}
        for a, b in combinations(range(len(sets)), 2):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (n[a] + n[b] - both) and component[a] != component[b] and not (cross and side[a] == side[b]):
                assert (a, b) in got
        assert len(got) < 400


def test_linked_sets_share_a_prefix_token():
    rng = np.random.default_rng(3)
    order = J.Order({int(t): int(n) for t, n in zip(rng.integers(-2**62, 2**62, 50), rng.integers(1, 99, 50), strict=True)})
    frequent = order.token
    for _ in range(300):
        a = np.unique(np.concatenate([rng.integers(0, 2**63, rng.integers(1, 260), dtype=np.uint64), rng.choice(frequent, 20)]))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.1], rng.integers(0, 2**63, rng.integers(0, 6), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            shared = len(np.intersect1d(order.prefix(a)[0], order.prefix(b)[0]))
            assert all(shared >= max(1, 80 * len(s) // 100 // J.MORE) for s in (a, b))


@pytest.mark.parametrize("shape", ["chain", "random", "stars", "none"])
def test_components(spark, shape):
    rng = random.Random(1)
    edges = {"chain": [(i, i + 1) for i in range(60)], "random": [(rng.randrange(120), rng.randrange(120)) for _ in range(80)],
             "stars": [(i % 5, i) for i in range(5, 80)] + [(79, 78)], "none": []}[shape]
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for s in sorted(near):
        todo = [s] if s not in want else []
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = s
                todo += near[x]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in want.items() if near[k] - {k}}
