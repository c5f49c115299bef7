"""Operator 7: planted templates, the winnowing guarantee, and a full alignment table."""

import random

import numpy as np
import pytest

from ledgerlens.llm import license_scan as L

NAMES = dict((t, n) for n, t in L.TEMPLATES)


def full(template, text):
    """Fewest word edits that turn the template into a part of the text."""
    row = list(range(len(template) + 1))
    best = row[-1]
    for w in text:
        new = [0]
        for i, x in enumerate(template, 1):
            new.append(min(row[i - 1] + (x != w), row[i] + 1, new[i - 1] + 1))
        row = new
        best = min(best, row[-1])
    return best


@pytest.mark.parametrize("n", [0, 1, 3, 8, 9, 20, 300])
def test_winnowing_takes_the_least_of_each_window(n):
    h = np.random.default_rng(n).integers(0, 40, n).astype(np.uint32)
    want = set()
    for j in range(max(1, n - L.WINNOW + 1)) if n else ():
        window = h[j:j + L.WINNOW]
        want |= {j + i for i in np.flatnonzero(window == window.min()).tolist()}
    assert set(L.winnow(h).tolist()) == want


def test_a_shared_run_shares_a_fingerprint():
    rng = random.Random(0)
    word = lambda n: np.array([ord(rng.choice("abcde")) for _ in range(n)], np.uint32)
    for _ in range(200):
        run = word(L.GRAM + L.WINNOW - 1)
        a, b = (np.concatenate([word(rng.randint(0, 40)), run, word(rng.randint(0, 40))]) for _ in range(2))
        ha, hb = L.gram_hashes(a), L.gram_hashes(b)
        assert set(ha[L.winnow(ha)].tolist()) & set(hb[L.winnow(hb)].tolist())


def test_alignment_in_a_wide_band_is_the_full_one():
    rng = random.Random(1)
    for _ in range(200):
        t = [rng.choice("abcdef") for _ in range(rng.randint(1, 12))]
        r = [rng.choice("abcdef") for _ in range(rng.randint(1, 20))]
        pairs = L.align(t, r, 40)
        assert all(t[i] == r[j] for i, j in pairs) and pairs == sorted(pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) >= len(t) - full(t, r)


@pytest.mark.parametrize("name, template", L.TEMPLATES)
def test_every_template_is_found_whole_and_edited(name, template):
    scanner = L.Scanner(L.Index(L.TEMPLATES), L.COVERAGE)
    text = f"Some words of a page.\n// {template.upper()}\nAnd what follows it, (C) 2020 somebody."
    (found,) = scanner.in_texts([text])
    assert len(found) >= 1
    best = max(found, key=lambda m: m[1])
    assert scanner.index.names[best[0]] == name and best[1] == len(scanner.index.words[best[0]])
    assert text[best[2]:best[3]].upper() in text and abs((best[3] - best[2]) - len(template)) <= 2
    words = template.split()
    if len(words) > 30:
        rng = random.Random(len(words))
        for _ in range(len(words) // 12):
            words[rng.randrange(len(words))] = "changed"
        (found,) = scanner.in_texts([f"before {' '.join(words)} after"])
        assert name.split("-")[0] in {scanner.index.names[m[0]].split("-")[0] for m in found}


def test_clean_texts_have_none():
    scanner = L.Scanner(L.Index(L.TEMPLATES), L.COVERAGE)
    texts = ["", "The software of the license was under the table.", "permission is granted to nobody", "Licensed under", "x" * 100]
    assert scanner.in_texts(texts) == [[]] * 5


AGPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""
LGPL = """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."""
DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE REGENTS OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


@pytest.mark.parametrize("name, text", [
    ("AGPL-3.0", AGPL), ("LGPL-2.1", LGPL), ("LGPL-3.0", LGPL.replace("2.1", "3").replace("library", "program")), ("GPL-3.0", AGPL.replace("Affero ", "")),
    ("BSD-disclaimer", DISCLAIMER), ("CC-BY-4.0", "Licensed through CC BY 4.0"), ("CC-BY-4.0", "licensed, gladly, under CC-BY v 4.0"),
    ("MIT", "released with the MIT license")])
def test_headers_and_notices_go_by_their_own_name(name, text):
    scanner = L.Scanner(L.Index(L.TEMPLATES), L.COVERAGE)
    for around in ("", "it and the word " * 30):
        (found,) = scanner.in_texts([f"{around} {text} {around}"])
        assert [scanner.index.names[m[0]] for m in found] == [name]


def test_bodies_are_told_apart():
    scanner = L.Scanner(L.Index(L.TEMPLATES), L.COVERAGE)
    for name, text in L.BODIES:
        words = text.split()
        words[::9] = ["edited"] * len(words[::9])
        found = scanner.in_texts(["some words " * 200 + " ".join(words) + " more words" * 200])[0]
        assert scanner.index.names[max(found, key=lambda m: m[1])[0]] == name


def test_every_region_of_a_notice_is_a_candidate():
    rng, hits = random.Random(5), 0
    templates = [(str(i), " ".join(rng.choice(["ab", "cd", "efg", "h", "ij", "klm"]) for _ in range(n))) for i, n in enumerate((5, 6, 8, 12, 20))]
    for t in templates:
        scanner = L.Scanner(L.Index([t]), L.COVERAGE)
        words, spare = t[1].split(), len(t[1].split()) // 5
        for _ in range(60):
            edited = list(words)
            for at in rng.sample(range(len(words)), rng.randint(0, spare + 2)):
                edited[at] = rng.choice(["xx", "ab", "yy"])
            text = [rng.choice(["xx", "zz", "ab", "h"]) for _ in range(30)] + edited + ["zz"] * 30
            hit = full(words, text) <= spare
            hits += hit
            found = scanner.in_texts([" ".join(text)])[0]
            assert found or not hit
            assert all(k >= L.COVERAGE * len(words) for _, k, _, _ in found)
    assert hits > 100


def test_copies_and_long_texts(monkeypatch):
    template = "This work is licensed under the GNU General Public License, version 3."
    text = (template + "\n") * 40 + "noise " * 3000 + template
    whole = L.Scanner(L.Index(L.TEMPLATES), L.COVERAGE).in_texts([text])[0]
    assert len(whole) == 41 and all(text[s:e] + "." == template for _, _, s, e in whole)
    monkeypatch.setattr(L, "WINDOW", 200)
    assert L.Scanner(L.Index(L.TEMPLATES), L.COVERAGE).in_texts([text])[0] == whole


def test_table(spark):
    line = "Released under the MIT License."
    docs = spark.createDataFrame([(1, f"a {line}", "x"), (None, line, "x"), (2, None, "x"), (3, "", "x"), (1, f"a {line}", "x"),
                                  (4, "word " * 50_000 + line, "x")], "doc_id long, text string, license string")
    got = sorted((str(r.doc_id), r.license, r.coverage, r.start, r.end) for r in L.scan(docs).collect())
    n = len(line) - 1
    assert got == sorted([("1", "MIT", 1.0, 2, 2 + n)] * 2 + [("None", "MIT", 1.0, 0, n), ("4", "MIT", 1.0, 250_000, 250_000 + n)])
    assert L.scan(docs.limit(0)).count() == 0 == L.scan(docs, templates=()).count()
    with pytest.raises(ValueError):
        L.Index([("long", "x" * (L.MAX_TEMPLATE_CHARS + 1))])
