"""Operator 12 against brute force."""

import math
import random

import numpy as np
import pytest

from ledgerlens.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, id string, rank int"


def brute(rows, step=100, positives=5, negatives=10):
    valid = {}
    for i, v, label, *_ in sorted((r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None), key=lambda r: (r[0], r[2])):
        if all(x is not None and math.isfinite(x) for x in v):
            valid.setdefault(i, (label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for a, (label, q) in valid.items():
        if a % step:
            continue
        score = {i: sum(x * y for x, y in zip(q, v[1])) for i, v in valid.items()}
        ranked = sorted(valid, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if i != a and valid[i][0] == label][:positives]:
            fits = [i for i in ranked if valid[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(fits[:negatives])]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r[:3], "x", 7) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in H.mine(df, **more).collect())


def clustered(n, d, seed, labels=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(12)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((i, [x + rng.gauss(0, 0.4) for x in c], rng.randrange(labels)))
    return rows


@pytest.mark.parametrize("d", [1, 5, 64])
def test_equals_brute_force(spark, d, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 64)
    rows = clustered(500, d, d)
    assert mined(spark, rows, anchor_step=50) == brute(rows, 50)


def test_copies_ties_and_a_label_with_most_rows(spark):
    rows = clustered(300, 8, 1)
    hot = rows[0][1]
    rows += [(1000 + i, hot, 0 if i % 3 else 1) for i in range(400)]
    assert mined(spark, rows, anchor_step=100) == brute(rows, 100)


def test_odd_rows(spark):
    rows = clustered(120, 4, 2)
    rows += [(None, [1.0] * 4, 1), (201, None, 1), (202, [1.0] * 4, None), (203, [1.0, None, 0.0, 0.0], 1), (204, [float("nan")] * 4, 1), (205, [float("inf"), 0.0, 0.0, 0.0], 2),
             (300, [], 1), (301, [2.0], 0), (302, [2.0, 1.0, 0.0, 0.0, 0.0, 3.0], 1), (7, rows[7][1], rows[7][2]), (400, [0.0] * 4, 2), (-100, [1.0, -1.0, 1.0, -1.0], 0)]
    assert mined(spark, rows, anchor_step=20) == brute(rows, 20)
    assert mined(spark, []) == []
    assert mined(spark, rows[:1]) == []


def test_scores_beyond_double_precision_are_exact(spark):
    rows = [(i, [float(2**18 + i * 17), float(i % 5), -1.0, float(2**17 + i)], i % 2) for i in range(40)]
    assert mined(spark, rows, anchor_step=10) == brute(rows, 10)


def test_bounds_hold_and_rule_pairs_out():
    rng = np.random.default_rng(0)
    q = np.floor(256 * (rng.normal(size=(12, 1, 64)) + 0.2 * rng.normal(size=(12, 80, 64))).reshape(-1, 64))
    s = H.Summaries(q)
    score = q[:40] @ q.T
    for m, sums, dev in s.levels:
        mid, wide = sums[:40] @ sums.T, dev[:40] @ dev.T
        assert (score <= (mid + wide) / m + 1).all() and (score >= (mid - wide) / m - 1).all()
    find = H.Search(np.arange(len(q)), rng.integers(0, 3, len(q)), q, 5, True)
    free = np.full((40, 1), np.inf)
    find.find(np.arange(40), find.labels[:40], q[:40], -free, free)
    first = find.scored
    find.find(np.arange(40), find.labels[:40], q[:40], np.sort(score, axis=1)[:, -30:-29], free)
    assert find.scored - first < first / 3
