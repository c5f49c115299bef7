"""Operator 5 against the tiktoken library."""

import hashlib

import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import bpe_codec
from ledgerlens.llm.common import load_ranks

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = load_ranks(PATH)
BPE = bpe_codec.ByteBpe(RANKS)
TIK = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
SPLIT = regex.compile(P.PATTERN)


def encode(text):
    return [i for p in SPLIT.findall(text) for i in BPE.encode_piece(p.encode())]


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("abeinrst éèüñß漢字かな\U0001f600'!?-_= \n\t0123\u200d\u0301"), max_size=60))
def test_ids_are_the_librarys(text):
    ids = encode(text)
    assert ids == TIK.encode_ordinary(text)
    assert BPE.decode(ids).decode() == text


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=40))
def test_any_bytes_round_trip(piece):
    ids = BPE.encode_piece(piece)
    assert BPE.decode(ids) == piece
    assert all(BPE.fits(a, b) for a, b in zip(ids, ids[1:], strict=False)) or len(ids) < 2


@pytest.mark.parametrize("text", ["a" * 50_000, " " * 40_000, "ab" * 20_000, "=" * 30_001])
def test_long_pieces_take_linear_time(text):
    assert encode(text) == TIK.encode_ordinary(text)


def test_a_vocabulary_that_merging_does_not_explain_is_refused():
    with pytest.raises(ValueError):
        bpe_codec.ByteBpe({**{bytes([i]): i for i in range(256)}, b"abc": 256})
    with pytest.raises(ValueError):
        bpe_codec.ByteBpe({b"a": 0})


def test_table(spark):
    texts = ["The end. été", None, "", "x" * 30_000 + " y", "The end. été", "<|endoftext|>"]
    docs = spark.createDataFrame([(i if i else None, t, "decoded") for i, t in enumerate(texts)], "doc_id long, text string, decoded string")
    out = bpe_codec.encode_documents(docs, PATH, P.PATTERN, ("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")).collect()
    assert len(out) == len(texts)
    for row in out:
        text = texts[row.doc_id or 0] or ""
        ids = TIK.encode_ordinary(text)
        assert row.ids == ids and row.n_tokens == len(ids) and bytes(row.decoded) == text.encode()
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe_codec.encode_documents(docs.limit(0), PATH, P.PATTERN).count() == 0
    back = bpe_codec.decode_documents(bpe_codec.encode_documents(docs, PATH, P.PATTERN), PATH).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for t in texts)
