"""Operator 8: round trips, code properties, and the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import huffman_ids as H

PATH = P.path("word_bpe_49k.json")
TOK = Tokenizer.from_file(PATH)
TOK.encode_special_tokens = True


def ids_of(text):
    return [*TOK.encode(text or "", add_special_tokens=False).ids, 1]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(0, 5000), st.integers(1, 10**12), min_size=1, max_size=200), st.integers(8, 20))
def test_code_is_complete_and_limited(counts, limit):
    lengths = H.code_lengths(counts, limit)
    used = lengths[lengths > 0].astype(int)
    assert len(used) == len(counts) and used.max() <= limit
    if len(counts) > 1:
        assert sum(2.0**-n for n in used) == 1
        by = sorted(counts, key=lambda i: counts[i])
        assert all(lengths[a] >= lengths[b] for a, b in zip(by, by[1:], strict=False) if counts[a] < counts[b])


def test_lengths_are_optimal_without_a_limit():
    import heapq
    rng = random.Random(5)
    for _ in range(30):
        counts = {i: rng.randint(1, 1000) for i in range(rng.randint(2, 40))}
        heap, cost = list(counts.values()), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            s = heapq.heappop(heap) + heapq.heappop(heap)
            cost += s
            heapq.heappush(heap, s)
        lengths = H.code_lengths(counts, 40)
        assert sum(counts[i] * int(lengths[i]) for i in counts) == cost


def test_too_many_ids_for_the_limit():
    with pytest.raises(ValueError):
        H.code_lengths({i: 1 for i in range(5)}, 2)


def test_canonical_words_are_ordered_and_prefix_free():
    lengths = H.code_lengths({3: 5, 1: 1, 7: 1, 2: 9, 9: 2}, 8)
    words = sorted((f"{int(c):0{n}b}", i) for i, (c, n) in enumerate(zip(H.canonical_codes(lengths), lengths, strict=True)) if n)
    assert not any(b.startswith(a) for (a, _), (b, _) in zip(words, words[1:], strict=False))
    assert [(len(w), i) for w, i in words] == sorted((len(w), i) for w, i in words)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=2500), max_size=8), st.randoms())
def test_files_round_trip(docs, rng):
    flat = [i for d in docs for i in d]
    lengths = H.code_lengths({i: flat.count(i) for i in set(flat)})
    codes = H.canonical_codes(lengths)
    streams = H.encode_bits([np.array(d, np.int64) for d in docs], lengths, codes)
    assert [s[0] for s in streams] == [H.encode_bits([np.array(d, np.int64)], lengths, codes)[0][0] for d in docs]
    names = [rng.choice([None, -5, k, 2**60]) for k in range(len(docs))]
    data = H.pack_file(names, [len(d) for d in docs], streams, lengths, H.MAX_BITS, 17)
    ids, counts, start, out = H.FileReader().read(data)
    assert ids == names and counts.tolist() == [len(d) for d in docs] and start == 17 and out.tolist() == flat


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcXYZéÈßΣσİıŉÖ'srtel12!?-~ \t\n\x0b\x85\xa0\u2003\u3000\u200b\x1c\u0301漢字"), max_size=40))
def test_words_are_tokenised_as_the_whole_text(text):
    memo = H.WordMemo(TOK)
    got = memo.ids([text] if H.ODD.search(text) else text.split())
    assert np.frombuffer(got, "<u4").tolist() == ids_of(text)[:-1]


def test_table(spark):
    texts = {7: "Zwei Wörter, und mehr.", 3: None, 12: "", 5: "<|endoftext|> x", -4: "long " * 30_000, 100: "Zwei Wörter, und mehr."}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, n_tokens int").repartition(3)
    out = {r.doc_id: r for r in H.read_files(H.write_token_files(docs, PATH, 49_408), with_ids=True).collect()}
    start = 0
    for i in sorted(texts):
        ids = ids_of(texts[i])
        assert (out[i].start, out[i].n_tokens, out[i].ids) == (start, len(ids), ids)
        assert out[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert H.read_files(H.write_token_files(docs.limit(0), PATH, 49_408)).count() == 0


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "b"), (None, "a"), (1, "c d")], "doc_id long, text string")
    out = sorted((r.start, r.doc_id, r.n_tokens) for r in H.read_files(H.write_token_files(docs, PATH, 49_408)).collect())
    assert [(d, n) for _, d, n in out] == [(None, 2), (1, 2), (1, 2), (1, 3)]
    assert [s for s, _, _ in out] == [0, 2, 4, 6]


def test_small_files_keep_the_order(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 50) AS text")
    width = H.id_width(49_408)
    ids = H.tokenize(docs, PATH)
    lengths = H.code_lengths({r.id: r.n for r in H.count_ids(ids, width).collect()})
    files = H.stage(H.write_files(ids, lengths, width, file_bytes=2000))
    assert files.count() > 8
    out = sorted((r.doc_id, r.start, r.n_tokens) for r in H.read_files(files).collect())
    assert [d for d, _, _ in out] == list(range(300))
    assert [s for _, s, _ in out] == np.cumsum([0, *(n for _, _, n in out)])[:-1].tolist()
