"""Operator 11 against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlens.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, phrase string, n int, seg string"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[\x20\x09]+", p) if w] for p in re.split("[.,;:!?\x0a-\x0d]", low)]


def brute(rows, least=30, top=2000, longest=4):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        for ws in words(text):
            n["und" if lang is None else lang] += len(ws)
            for m in range(1, longest + 1):
                f.update((lang if lang is not None else "und", tuple(ws[i:i + m])) for i in range(len(ws) - m + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in cand.items():
        inside = any(lg == lang and len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (lg, q), b in cand.items())
        if not inside:
            score, _, le, r = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), le, r))
    return sorted((lang, i + 1, p.decode(), -a, le, r, n[lang], -s) for lang, v in out.items() for i, (s, a, p, le, r) in enumerate(sorted(v)[:top]))


def mined(spark, rows, parts=3, **more):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(parts)
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in C.mine(df, **more).collect())


def corpus(n, seed, length=60):
    rng = random.Random(seed)
    vocabulary = [f"W{i}é" if i % 7 == 0 else f"w{i}" for i in range(60)]
    fixed = ["new York city hall", "in order to", "by\tand by", "no no no no", "a.b", "x \x00 y"]
    rows = []
    for i in range(n):
        ws = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(vocabulary[:10] if rng.random() < 0.5 else vocabulary) for _ in range(rng.randrange(length))]
        rows.append((i % 50, "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "! "]) for w in ws), rng.choice(["en", "en", "fr", None, "und", ""])))
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_brute_force(spark, seed):
    rows = corpus(400, seed)
    assert mined(spark, rows, least=8) == brute(rows, 8)
    assert mined(spark, rows, least=8, top=5) == brute(rows, 8, 5)


def test_chunks_parts_segments_and_full_filters(spark, monkeypatch):
    """Small chunks that end within texts, hot prefixes in segments, and a filter that says yes to nearly all."""
    monkeypatch.setattr(C, "CHUNK", 37)
    monkeypatch.setattr(C, "PART", 16)
    monkeypatch.setattr(C, "SHARES", 32)
    monkeypatch.setattr(C, "FILTER_BITS", 64)
    monkeypatch.setattr(C, "BITS_EACH", 0)
    rows = corpus(300, 3, 200)
    assert mined(spark, rows, least=5) == brute(rows, 5)


def test_odd_input(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, None, "en"), (None, "", None), (2, " .\n", None)]) == []
    rows = [(1, "only one", None)] * 40 + [(None, None, "en"), (2, "a" * 300_000, "en"), (3, "y z " * 100_000, "en"), (4, "q " * 29, "en")]
    assert mined(spark, rows) == brute(rows)


def test_products_beyond_64_bits(spark):
    big = 10**16
    found = [(2, spark.createDataFrame([("en", "a b", big)], "lang string, phrase string, n long"))]
    known = spark.createDataFrame([("en", "a", big), ("en", "b", 2 * big)], "lang string, phrase string, n long")
    got = C.rank_phrases(found, [known], spark.createDataFrame([("en", 5 * big)], "lang string, n long"), 10, 80).collect()
    assert [(r.a, r.l, r.r, r.n, r.score) for r in got] == [(big, big, 2 * big, 5 * big, 666_666)]


def test_filter_has_no_false_negatives(spark):
    phrases = [("en", f"a{i} b{i % 7}") for i in range(5000)]
    made = C.make_filter(spark.createDataFrame(phrases, "lang string, phrase string"))
    h = np.array([C.join_hashes([np.array([C.word_hash(lang, w.encode())], np.uint64) for w in p.split()])[0] for lang, p in phrases])
    assert made.has(h).all()
    assert made.has(h + np.uint64(12345)).mean() < 0.2
