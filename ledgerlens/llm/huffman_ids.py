"""Token-id files under a canonical length-limited Huffman code (operator 8).

1. Each text is tokenised and its ids are written as a stage table.
2. Ids are counted over all documents; the counts (at most one per vocabulary
   entry) give code lengths of at most ``MAX_BITS`` bits by the package-merge
   method, and the lengths alone give the canonical code.
3. The rows are range-partitioned by document id and packed into files of about
   ``FILE_BYTES``.  A file holds whole documents in blocks of at most
   ``BLOCK_IDS`` ids; the bit offset of each block is a checkpoint in its header,
   so any block is decoded on its own.
4. Reading decodes all blocks of a file side by side, one id of each per step,
   through one table with an entry for each ``MAX_BITS``-bit window.

A file is a value of the binary column ``data`` of a Parquet table, so that any
store Spark can write to can hold it; its layout is that of :func:`pack_file`.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import ship_package, slices, stage

MAX_BITS = 18
BLOCK_IDS = 1024
FILE_BYTES = 1 << 20
END_ID = 1
MAX_WORDS, MAX_CORES = 1_000_000, 500_000
MAGIC = b"HIDS0001"

# --------------------------------------------------------------------------- tokenising


def byte_letters() -> dict[int, int]:
    """Byte to the character that stands for it in a byte-level vocabulary:
    itself where that is a visible Latin-1 character, the others in order from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: b if b in shown else 256 + hidden.index(b) for b in range(256)}


class WordMemo:
    """Text without white space to the bytes of its ids (little-endian unsigned
    32-bit).  The first ``MAX_WORDS`` are remembered, so the frequent ones are, and
    the first ``MAX_CORES`` without case and marks, which many words share.

    A word of Latin letters, with or without ASCII marks behind it, goes to the
    library's model at once: for such a word the normalizer only lowers it and
    the pattern only cuts off the marks.  All others take the library's whole way."""

    #: Marks that may follow a word; not the apostrophe, with which the pattern has plans.
    MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.letters = byte_letters()
        self.known: dict[str, bytes] = {}
        #: Words without case and marks, which many words share.
        self.cores: dict[str, bytes] = {}
        self.behind: dict[str, bytes] = {}

    def encode(self, word: str) -> bytes:
        core = word.lower().rstrip(self.MARKS)
        got = self.cores.get(core)
        if got is None:
            if not (core.isalpha() and max(core) < "\u0250" and "\u03a3" not in word and unicodedata.is_normalized("NFC", core)):
                return _bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)
            plain = core if core.isascii() else core.encode().decode("latin-1").translate(self.letters)
            got = _bytes([t.id for t in self.model.tokenize(plain)])
            if len(self.cores) < MAX_CORES and len(core) <= 64:
                self.cores[core] = got
        return got + self._behind(word[len(core):]) if len(core) < len(word) else got

    def _behind(self, marks: str) -> bytes:
        got = self.behind.get(marks)
        if got is None:
            got = _bytes(self.tokenizer.encode(marks, add_special_tokens=False).ids)
            if len(self.behind) < 10_000 and len(marks) <= 16:
                self.behind[marks] = got
        return got

    def ids(self, parts: list[str]) -> bytes:
        known = self.known
        got = list(map(known.get, parts))
        if None in got:
            for i, v in enumerate(got):
                if v is None:
                    w = parts[i]
                    v = got[i] = known.get(w) or self.encode(w)
                    if len(known) < MAX_WORDS and len(w) <= 64:
                        known[w] = v
        return b"".join(got)


def _bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


#: A worker's memos by tokenizer, kept from task to task.
_WORKER: dict[str, WordMemo] = {}


def worker_memo(source: str, key: str) -> WordMemo:
    if key not in _WORKER:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        tok = Tokenizer.from_str(source)
        tok.encode_special_tokens = True
        _WORKER[key] = WordMemo(tok)
    return _WORKER[key]


#: White space to ``str.split`` but not to the tokenizer's patterns, or a mark whose case or
#: composition could depend on what stands before it.
ODD = re.compile("[\x1c-\x1f\ud800-\udfff]")


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
             end_id: int | None = END_ID) -> DataFrame:
    """``(id_col, n_tokens, ids)``: each whole text through the ``tokenizers``
    library (no special tokens are added, and their strings in a text are
    ordinary text), then ``end_id``.

    Only for tokenizers that drop white space and never join across it, as the
    file's normalizer and pattern say; then the ids of a text are those of its
    space-separated parts in order, and the ids of a part are remembered.  Texts
    with one of the few characters on which that would depend go to the library
    whole.  ``ids`` holds little-endian unsigned integers, of 16 bits where the
    vocabulary allows and of 32 bits else.  A null text counts as empty."""
    ship_package(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        content = f.read()
    source, key = docs.sparkSession.sparkContext.broadcast(content), hashlib.sha256(content.encode()).hexdigest()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = worker_memo(source.value, key)
        width = id_width(max(memo.tokenizer.get_vocab_size(), (end_id or 0) + 1))
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        for b in slices(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            parts = [[t] if ODD.search(t) else t.split() for t in texts]
            flat = [np.frombuffer(memo.ids(p) + end, "<u4") for p in parts]
            n, out = [len(x) for x in flat], [x.astype(width).tobytes() for x in flat]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(out, pa.binary())],
                                             [id_col, "n_tokens", "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids binary")


def id_width(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


# --------------------------------------------------------------------------- the code


def count_ids(ids: DataFrame, width: str) -> DataFrame:
    """``(id, n)`` over all rows: a task sends one row for each id it has seen."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in slices(batches):
            got = np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), width).astype(np.int64))
            if len(got) > len(total):
                total, got = got.astype(np.int64), total
            total[:len(got)] += got
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    return ids.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths (0: no code) of an optimal prefix code with none over ``max_bits``
    (package-merge); indexed by id.  Ties go to the smaller id."""
    out = np.zeros(max(counts, default=-1) + 1, np.uint8)
    ids = sorted(counts, key=lambda i: (counts[i], i))
    if len(ids) <= 1:
        out[ids] = 1
        return out
    if len(ids) > 1 << max_bits:
        raise ValueError(f"{len(ids)} ids have no code of at most {max_bits} bits")
    own = np.array([counts[i] for i in ids], object if sum(counts.values()) >= 1 << 57 else np.int64)
    levels, row = [], own
    is_own = np.ones(len(own), bool)
    for _ in range(max_bits - 1):
        levels.append(is_own)
        pairs = row[:len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([own, pairs])
        order = np.argsort(both, kind="stable")
        row, is_own = both[order], (order < len(own))
    levels.append(is_own)
    lengths, take = np.zeros(len(ids), np.uint8), 2 * len(ids) - 2
    for is_own in reversed(levels):
        singles = int(is_own[:take].sum())
        lengths[:singles] += 1
        take = 2 * (take - singles)
    out[ids] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The canonical code's words: by length, then by id, counting upwards."""
    codes = np.zeros(len(lengths), np.uint64)
    code, last = 0, 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)):
        n = int(lengths[i])
        if n:
            code <<= n - last
            codes[i], last = code, n
            code += 1
    return codes


def decode_table(lengths: np.ndarray, max_bits: int) -> np.ndarray:
    """For each window of ``max_bits`` bits: id * 64 + length of the code that it begins with."""
    table = np.zeros(1 << max_bits, np.uint64)
    codes = canonical_codes(lengths)
    for i in np.flatnonzero(lengths):
        n = int(lengths[i])
        first = int(codes[i]) << (max_bits - n)
        table[first:first + (1 << (max_bits - n))] = int(i) * 64 + n
    return table


def encode_bits(texts: list[np.ndarray], lengths: np.ndarray, codes: np.ndarray) -> list[tuple[bytes, np.ndarray]]:
    """For each text its ids' code words one after the other, first bit highest,
    padded to whole bytes; and the bit offset of each ``BLOCK_IDS``-th id."""
    size = np.array([len(t) for t in texts], np.int64)
    ids = np.concatenate([np.zeros(0, np.int64), *texts]).astype(np.int64)
    n = lengths[ids].astype(np.int64)
    last = np.cumsum(size)
    ends = np.concatenate([[0], np.cumsum(n)])
    bits = ends[last] - ends[last - size]
    room = -(-bits // 8) * 8
    base = np.cumsum(room) - room  # where each text begins
    starts = ends[:-1] + np.repeat(base - ends[last - size], size)
    words = np.zeros((int(room.sum()) + 63) // 64 + 1, np.uint64)
    word, off = starts >> 6, starts & 63
    code = codes[ids]
    free = 64 - off - n  # bits left in the first word; below 0 the code goes on in the next
    here = np.where(free >= 0, code << np.maximum(free, 0).astype(np.uint64), code >> np.maximum(-free, 0).astype(np.uint64))
    over = np.flatnonzero(free < 0)
    if len(ids):
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] = np.bitwise_or.reduceat(here, first)
        words[word[over] + 1] |= code[over] << (64 + free[over]).astype(np.uint64)
    raw = words.astype(">u8").tobytes()
    return [(raw[b // 8:(b + r) // 8], starts[z - k:z:BLOCK_IDS] - b)
            for b, r, z, k in zip(base.tolist(), room.tolist(), last.tolist(), size.tolist(), strict=True)]


# --------------------------------------------------------------------------- files


def pack_file(doc_ids: list, counts: list[int], streams: list[tuple[bytes, np.ndarray]], lengths: np.ndarray,
              max_bits: int, start: int) -> bytes:
    """One file: magic; six unsigned 64-bit numbers (documents, blocks, bytes of
    the packed code lengths, ids per block, longest code, ids before this file in
    its part); document ids (signed 64-bit) and a byte each that is 1 where the
    id is null; ids of each document, bit offset of each block (unsigned
    64-bit); the code lengths (deflated bytes); the bits.  All little-endian.  A
    document's bits begin on a whole byte, and it has a block for each
    ``BLOCK_IDS`` ids begun."""
    at, offsets = 0, []
    for data, marks in streams:
        offsets.append(marks + at * 8)
        at += len(data)
    offsets = np.concatenate(offsets) if offsets else np.zeros(0)
    packed = zlib.compress(lengths.tobytes(), 6)
    return b"".join([
        MAGIC, struct.pack("<6Q", len(doc_ids), len(offsets), len(packed), BLOCK_IDS, max_bits, start),
        np.array([i or 0 for i in doc_ids], "<i8").tobytes(), bytes(i is None for i in doc_ids),
        np.array(counts, "<u8").tobytes(), offsets.astype("<u8").tobytes(), packed, *(d for d, _ in streams)])


class FileReader:
    """Reads files of one part; the decode table of a code is kept from file to file."""

    def __init__(self):
        self.packed, self.table = None, None

    def read(self, data: bytes) -> tuple[list, np.ndarray, int, np.ndarray]:
        """Document ids, ids of each document, ids before the file, all ids."""
        if data[:8] != MAGIC:
            raise ValueError("not a token-id file")
        docs, blocks, packed, block_ids, max_bits, start = struct.unpack_from("<6Q", data, 8)
        at = 56
        doc_ids = np.frombuffer(data, "<i8", docs, at).tolist()
        at += 8 * docs
        doc_ids = [None if null else i for i, null in zip(doc_ids, data[at:at + docs], strict=True)]
        at += docs
        counts = np.frombuffer(data, "<u8", docs, at).astype(np.int64)
        at += 8 * docs
        offsets = np.frombuffer(data, "<u8", blocks, at).astype(np.int64)
        at += 8 * blocks
        if data[at:at + packed] != self.packed:
            self.packed = data[at:at + packed]
            self.table = decode_table(np.frombuffer(zlib.decompress(self.packed), np.uint8), max_bits)
        bits = np.frombuffer(data[at + packed:] + bytes(8), np.uint8)
        return doc_ids, counts, start, self.decode(bits, counts, offsets, block_ids, max_bits)

    def decode(self, bits: np.ndarray, counts: np.ndarray, offsets: np.ndarray, block_ids: int,
               max_bits: int) -> np.ndarray:
        """All blocks at once: step k reads the k-th id of each block that has one."""
        per_doc = -(-counts // block_ids)
        last = np.cumsum(per_doc) - 1
        sizes = np.full(len(offsets), block_ids, np.int64)
        sizes[last[per_doc > 0]] = (counts - (per_doc - 1) * block_ids)[per_doc > 0]
        firsts = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.int64)
        order = np.argsort(-sizes, kind="stable")
        at, put, left = offsets[order].copy(), firsts[order].copy(), sizes[order]
        # Big-endian 32-bit windows at every byte.
        b = bits.astype(np.uint64)
        windows = (b[:-4] << np.uint64(32)) | (b[1:-3] << np.uint64(24)) | (b[2:-2] << np.uint64(16)) | (b[3:-1] << np.uint64(8)) | b[4:]
        mask, table = np.uint64((1 << max_bits) - 1), self.table
        live = np.searchsorted(-left, -np.arange(int(left[0]) if len(left) else 0), side="left")
        for k in range(int(left[0]) if len(left) else 0):
            m = live[k]  # the blocks with more than k ids stand first
            pos = at[:m]
            got = table[(windows[pos >> 3] >> (40 - max_bits - (pos & 7)).astype(np.uint64)) & mask]
            out[put[:m] + k] = got >> np.uint64(6)
            pos += (got & np.uint64(63)).astype(np.int64)
        return out


def write_files(ids: DataFrame, lengths: np.ndarray, width: str, id_col: str = "doc_id",
                file_bytes: int = FILE_BYTES) -> DataFrame:
    """Pack ``(id_col, n_tokens, ids)`` in ascending ``id_col`` order (nulls
    first, equal ids by content) into files ``(part, file, n_ids, data)``; read in
    the order of part and file they hold all documents in order.  Parts are range
    partitions, so no task sees more than one."""
    if ids.schema[id_col].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"{id_col} must be an integer column")
    sc = ids.sparkSession.sparkContext
    code = sc.broadcast((lengths, canonical_codes(lengths)))
    max_bits = max(MAX_BITS, int(lengths.max(initial=0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, codes = code.value
        part, file, start = TaskContext.get().partitionId(), 0, 0
        doc_ids, counts, streams, held = [], [], [], 0

        def flush():
            nonlocal file, start, held
            data = pack_file(doc_ids, counts, streams, bits, max_bits, start)
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([file], pa.int64()), pa.array([sum(counts)], pa.int64()), pa.array([data], pa.binary())], ["part", "file", "n_ids", "data"])
            file, start, held = file + 1, start + sum(counts), 0
            doc_ids.clear(), counts.clear(), streams.clear()
            return row

        for b in slices(batches):
            texts = [np.frombuffer(raw, width) for raw in b.column(1).to_pylist()]
            for doc_id, ids, stream in zip(b.column(0).to_pylist(), texts, encode_bits(texts, bits, codes), strict=True):
                doc_ids.append(doc_id)
                counts.append(len(ids))
                streams.append(stream)
                held += len(stream[0]) + 32
                if held >= file_bytes:
                    yield flush()
        if doc_ids:
            yield flush()

    order = [F.col(id_col).asc_nulls_first(), "n_tokens", F.xxhash64("ids")]
    return (ids.repartitionByRange(*order).sortWithinPartitions(*order).select(id_col, "ids")
            .mapInArrow(run, "part int, file bigint, n_ids bigint, data binary"))


def read_files(files: DataFrame, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Per document of the files: ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids_crc32`` (of its ids as little-endian unsigned 32-bit
    integers) and, if asked for, ``ids`` themselves."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part, however many files a part has.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = FileReader()
        for b in slices(batches, 1):
            doc_ids, counts, start, ids = reader.read(b.column(1)[0].as_py())
            flat = ids.astype("<u4")
            ends = np.cumsum(counts)
            begins = ends - counts
            crc = [zlib.crc32(flat[s:e]) for s, e in zip(begins.tolist(), ends.tolist(), strict=True)]
            cols = [pa.array(doc_ids, pa.int64()), pa.array(begins + start + b.column(0)[0].as_py()), pa.array(counts), pa.array(crc, pa.int64())]
            if with_ids:
                cols.append(pa.array([flat[s:e].astype(np.int64) for s, e in zip(begins.tolist(), ends.tolist(), strict=True)], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(cols)])

    return (files.join(F.broadcast(parts), "part").select("base", "data")
            .mapInArrow(run, f"`{id_col}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids))


def write_token_files(docs: DataFrame, tokenizer_path: str, vocabulary: int, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int | None = END_ID) -> DataFrame:
    """Tokenise, count, code and pack; returns the written file table.  Empty
    input gives no file.  Ids and file table are written under the shared folder,
    so nothing is tokenised or packed twice."""
    width = id_width(max(vocabulary, (end_id or 0) + 1))
    ids = stage(tokenize(docs, tokenizer_path, id_col, text_col, end_id))
    counts = {r.id: r.n for r in count_ids(ids, width).collect()}  # at most one row per vocabulary entry
    return stage(write_files(ids, code_lengths(counts), width, id_col))
