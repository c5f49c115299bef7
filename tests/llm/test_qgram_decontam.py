"""Operator 3 against a plain edit distance search."""

import random

import numpy as np
import pytest

from ledgerlens.llm import qgram_decontam as Q


def plain(item, text):
    """Fewest edits from item to a part of text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i - 1] + (x != c), row[i] + 1, new[i - 1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def edited(rng, text, letters, n):
    out = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(out) + 1), rng.random()
        if kind < 0.4 and at < len(out):
            out[at] = rng.choice(letters)
        elif kind < 0.7 and at < len(out):
            del out[at]
        else:
            out.insert(at, rng.choice(letters))
    return "".join(out)


@pytest.mark.parametrize("seed", range(4))
def test_all_regions_in_budget_are_found(seed):
    rng, hits = random.Random(seed), 0
    for _ in range(80):
        letters = rng.choice(["abc ", "abcdefghijklmnop ", "aé漢 \U0001f600b"])
        word = lambda lo, hi: "".join(rng.choice(letters) for _ in range(rng.randint(lo, hi)))  # noqa: B023, E731
        items = [(j, word(*rng.choice([(1, 9), (5, 70), (10, 15), (20, 23), (30, 31)]))) for j in range(3)]
        texts = [word(0, 60) + edited(rng, rng.choice(items)[1], letters, rng.randint(0, 7)) + word(0, 60) for _ in range(4)]
        finder = Q.Finder(Q.indexes(items))
        forms = [c for x in finder.indexes for c in x.items]
        assert sorted(finder.ids) == [j for j, t in items if t.strip()]
        for text, found in zip(texts, finder.in_texts(texts), strict=True):
            least = {}
            for item, start, end, edits in found:
                least[item] = min(edits, least.get(item, 99))
                assert 0 <= start < end <= len(text)
            form = finder.normal.form(text)[0].tolist()
            for j, item in enumerate(forms):
                best = plain(item.tolist(), form)
                hits += best <= len(item) // 10
                assert least.get(j) == (best if best <= len(item) // 10 else None)
    assert hits > 40


def test_short_items_have_their_whole_budget():
    item, text = "abcdefgh ijklmnop qrstuvw xyzab", "zz abXdefgh ijklmXop qrstuvw xXzab yy"
    assert len(item) == 31
    assert [(m[0], m[3]) for m in Q.Finder(Q.indexes([(0, item)])).in_texts([text])[0]] == [(0, 3)]
    finder = Q.Finder(Q.indexes([(1, "cat"), (2, "!?"), (3, "a b c d e f"), (4, "tiny one")]))
    assert [finder.ids[m[0]] for m in finder.in_texts(["The Cat sat", "a b c X e f", "a tiny--one"])[0]] == [1]
    assert [[finder.ids[m[0]] for m in x] for x in finder.in_texts(["no", "a b c X e f", "a tiny--one"])] == [[], [3], [4]]


def test_long_texts_are_cut_without_loss(monkeypatch):
    rng = random.Random(9)
    item = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(12))
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    text = noise(997) + item + "%%%" * 50 + noise(480) + item.upper() + noise(2000) + item[:40] + "x" + item[40:]
    whole = Q.Finder(Q.indexes([(0, item)])).in_texts([text])[0]
    monkeypatch.setattr(Q, "WINDOW", 128)
    assert Q.Finder(Q.indexes([(0, item)])).in_texts([text])[0] == whole
    assert [e for *_, e in whole] == [0, 0, 1] and text[whole[0][1]:whole[0][2]] == item


def test_runs_longer_than_windows(monkeypatch):
    rng = random.Random(3)
    texts = [ITEM + " " * 500 + ITEM, " " * 500 + ITEM, ITEM + "\0" * 500, "-" * 500, ITEM[:20] + "-" * 384 + ITEM[20:]]
    texts += ["".join(rng.choice(["ab", "c", "\u6f22", "\U0001f600"]) + rng.choice(" -\0") * rng.randint(0, 60) for _ in range(9)) for _ in range(50)]
    index, normal = Q.indexes([(0, ITEM)]), Q.Normal()
    whole = [normal.form(t) for t in texts]
    found = Q.Finder(index).in_texts(texts)
    assert [len(m) for m in found[:5]] == [2, 1, 1, 0, 1]
    for n in (1, 7, 128):
        monkeypatch.setattr(Q, "WINDOW", n)
        for t, (codes, places) in zip(texts, whole, strict=True):
            c, p = normal.form(t)
            assert c.tolist() == codes.tolist() and p.tolist() == places.tolist()
        if n == 128:
            assert Q.Finder(index).in_texts(texts) == found


ITEM = "the quick brown fox jumps over the lazy dog and runs away"


def test_table(spark):
    docs = spark.createDataFrame([(1, f"so -- {ITEM.upper()}!", "en"), (2, None, "en"), (3, "", "en"), (None, f"x {ITEM.replace('fox', 'fax')} y", "en"), (5, "clean text of the lazy dog", "en"),
                                  (1, f"so -- {ITEM.upper()}!", "en"), (6, "word " * 60_000 + ITEM, "en")], "doc_id long, text string, edits string")
    bench = spark.createDataFrame([(10, ITEM), (11, None), (12, ""), (13, "short"), (10, ITEM)], "item_id long, text string")
    got = sorted((str(r.doc_id), r.item_id, r.start, r.end, r.edits) for r in Q.find_passages(docs, bench).collect())
    n = len(ITEM)
    assert got == sorted([("1", 10, 6, 6 + n, 0), ("1", 10, 6, 6 + n, 0), ("None", 10, 2, 2 + n, 1), ("6", 10, 300_000, 300_000 + n, 0)])
    kept = Q.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]
    assert Q.find_passages(docs.limit(0), bench).count() == 0 == Q.find_passages(docs, bench.limit(0)).count()
    assert Q.drop_contaminated(docs, bench.limit(0)).count() == 7


def test_items_in_several_indexes(spark):
    docs = spark.createDataFrame([(i, f"before {ITEM} number {i} of all") for i in range(6)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, f"number {i} of all") for i in range(6)] + [(9, ITEM)], "item_id long, text string")
    one = sorted(map(tuple, Q.find_passages(docs, bench).collect()))
    assert sorted(map(tuple, Q.find_passages(docs, bench, index_chars=40).collect())) == one and len(one) >= 12


def test_hash_of_grams_tells_places():
    codes = np.array([ord(c) for c in "abcdefghijabcdefgh"], np.uint32)
    for q in Q.QS:
        h = Q.gram_hashes(codes, q)
        assert len(h) == 19 - q and all(h[i] == h[i + 10] for i in range(9 - q)) and len(set(h.tolist())) == 10
