"""Byte-level BPE encoding and decoding in linear time (operator 5).

A piece of text is encoded by backtracking instead of by merging.  Two tokens
may stand next to each other in a BPE encoding exactly when encoding the bytes
of both together gives these two tokens, and a whole encoding is right exactly
when each adjacent pair is.  So: take the longest token at the current place;
if it does not fit the token before it, try its next shorter prefix; if none
fits, mark the place as a dead end and take back the token before it.  A place
is marked once, so the work is linear in the piece.  Tokens are found with one
Aho-Corasick pass over the bytes, read as Latin-1 characters, and what is
learned about a pair of tokens is kept.

The vocabulary must be one where each token of two or more bytes is made by
merging two tokens of lower rank; :class:`ByteBpe` checks that and raises.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerlens.llm.common import load_ranks, ship_package, slices

#: Memo sizes in a worker; beyond them the memo starts anew (results are the same).
MAX_PAIRS = 200_000
MAX_PIECES = 300_000


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.vocab = {i: b for b, i in ranks.items()}
        missing = [i for i in range(256) if bytes([i]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the single bytes {missing[:5]}")
        self.parts = {i: self._parts(b, i) for b, i in ranks.items() if len(b) > 1}
        self.length = {i: len(b) for b, i in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for b, i in ranks.items():
            self.automaton.add_word(b.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.shorter = {i: self._shorter(b) for b, i in ranks.items()}
        self.pairs: dict[int, bool] = {}

    def _parts(self, token: bytes, rank: int) -> tuple[int, int]:
        """The two tokens whose merge makes ``token``: what the merges below its rank leave of its bytes."""
        left = [token[i:i + 1] for i in range(len(token))]
        while len(left) > 2:
            r, i = min(((self.ranks.get(left[i] + left[i + 1], rank), i) for i in range(len(left) - 1)))
            if r >= rank:
                break
            left[i:i + 2] = [left[i] + left[i + 1]]
        ids = tuple(self.ranks[x] for x in left)
        if len(ids) != 2 or max(ids) >= rank:
            raise ValueError(f"token {rank} is not a merge of two tokens of lower rank")
        return ids

    def _shorter(self, token: bytes) -> int | None:
        """The longest token that is a proper prefix of ``token``."""
        return next((self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ranks), None)

    def fits(self, a: int, b: int) -> bool:
        """Whether encoding the bytes of tokens a and b together gives a, b."""
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._fits(a, b)
        return known

    def _fits(self, a: int, b: int) -> bool:
        """Undo the merges of a and b, latest first.  While the inner edges of
        what remains could merge earlier than the merge just undone on either
        side, BPE would have merged across the border."""
        vocab, ranks, parts = self.vocab, self.ranks, self.parts
        bound = float("inf")
        while True:
            across = ranks.get(vocab[a] + vocab[b])
            if across is not None and across < bound:
                return False
            a_merged, b_merged = a in parts, b in parts
            if not a_merged and not b_merged:
                return True
            # Undo the later of the two merges.  Of equal ones the left was made first, so the right one goes.
            if a_merged and (not b_merged or a > b):
                bound, a = a, parts[a][1]
            else:
                # A merge across of b's own rank starts further left, hence comes first.
                bound, b = b + 1, parts[b][0]

    def longest(self, piece: bytes) -> list[int]:
        """For each place of the piece the longest token that starts there."""
        best = [0] * len(piece)
        size, length = [0] * len(piece), self.length
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            n = length[token]
            start = end - n + 1
            if n > size[start]:
                size[start], best[start] = n, token
        return best

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if not piece:
            return []
        longest, length, shorter = self.longest(piece), self.length, self.shorter
        dead = bytearray(len(piece) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + length[token]
            if not dead[end] and (not out or self.fits(out[-1], token)):
                out.append(token)
                if end == len(piece):
                    return out
                at, token = end, longest[end]
                continue
            token = shorter[token]
            while token is None:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
                token = shorter[token]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids))


class PieceMemo(dict):
    """Piece of text to the bytes of its ids (little-endian unsigned 32-bit)."""

    def __init__(self, bpe: ByteBpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.bpe.encode_piece(piece.encode("utf-8", "surrogatepass")), "<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= MAX_PIECES:
                self.clear()
            self[piece] = ids
        return ids


#: A worker's codecs by vocabulary, kept from task to task with what they have learned.
_WORKER: dict[str, PieceMemo] = {}


def worker_memo(ranks: dict[bytes, int], key: str) -> PieceMemo:
    if key not in _WORKER:
        _WORKER[key] = PieceMemo(ByteBpe(ranks))
    return _WORKER[key]


def ranks_key(ranks: dict[bytes, int]) -> str:
    """A digest of the vocabulary."""
    return hashlib.sha256(b"".join(b"%d %d " % (i, len(b)) + b for b, i in sorted(ranks.items()))).hexdigest()


OUTPUTS = {"ids": pa.list_(pa.int32()), "decoded": pa.binary(), "n_tokens": pa.int64(), "ids_sha256": pa.string(),
           "decoded_sha256": pa.string()}
DDL = {"ids": "array<int>", "decoded": "binary", "n_tokens": "bigint", "ids_sha256": "string",
       "decoded_sha256": "string"}


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, outputs: tuple[str, ...] = ("ids",),
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each whole text and decode its ids again.

    ``outputs`` names what to return beside ``id_col``: ``ids`` (array of int),
    ``decoded`` (the bytes that decoding the ids gives), ``n_tokens``, and
    ``ids_sha256`` / ``decoded_sha256`` (lower-case hex of the decimal ids
    joined by commas / of the decoded bytes).

    The text is split by ``pattern`` and each match is encoded on its own;
    characters that no match covers are left out, as the tiktoken library does.
    A null text counts as empty: no ids, and the digests of nothing.  Repeated
    rows and null ids give a row each; other columns are ignored.  There is no
    shuffle, and a task holds one Arrow batch and two bounded memos.  The ranks
    file must be at ``ranks_path`` on the driver; executors get its content (1
    MB) by broadcast."""
    spark = docs.sparkSession
    ship_package(spark)
    vocabulary = load_ranks(ranks_path)
    ranks, key = spark.sparkContext.broadcast(vocabulary), ranks_key(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, split = worker_memo(ranks.value, key), regex.compile(pattern)
        bpe = memo.bpe
        decimal = {i: b"%d" % i for i in bpe.vocab}
        for b in slices(batches):
            got: dict[str, list] = {k: [] for k in outputs}
            for text in b.column(1).to_pylist():
                flat = np.frombuffer(b"".join(map(memo.__getitem__, split.findall(text or ""))), "<u4")
                ids = flat.tolist()
                for k in outputs:
                    if k == "ids":
                        got[k].append(flat.astype(np.int32))
                    elif k == "decoded":
                        got[k].append(bpe.decode(ids))
                    elif k == "n_tokens":
                        got[k].append(len(ids))
                    elif k == "ids_sha256":
                        got[k].append(hashlib.sha256(b",".join(map(decimal.__getitem__, ids))).hexdigest())
                    else:
                        got[k].append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, OUTPUTS[k]) for k, v in got.items())],
                                             [id_col, *outputs])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, ", ".join([f"`{id_col}` {kind}", *(f"{k} {DDL[k]}" for k in outputs)]))


def decode_documents(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Turn arrays of ids back into bytes (``decoded``); null counts as no ids."""
    ship_package(encoded.sparkSession)
    vocab = encoded.sparkSession.sparkContext.broadcast({i: b for b, i in load_ranks(ranks_path).items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocab.value.__getitem__
        for b in slices(batches):
            texts = [b"".join(map(get, ids or ())) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary())], [id_col, "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, decoded binary")
