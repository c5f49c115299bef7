"""Operator 11: collocations from stripes.

A stripe is a prefix of one to three words with a counter of the words that
follow it.  Each task builds the stripes of a chunk of text (``CHUNK`` words) and
gives one row per prefix, with lists of next words and of counts; the rows of a
prefix are merged elementwise.  A merged stripe yields what scoring needs: its
total is the prefix's frequency, its entries are the extensions, and its largest
entry is the longest shadow a longer phrase throws on the prefix.

Stripes are built for prefixes of one, two and three words in turn.  A phrase that
occurs ``least`` times has only parts that do, so a next word is kept only if the
last words, taken with it, may be that frequent; others go to the stripe's
nameless rest (:class:`Filter`, a Bloom filter of at most ``FILTER_BITS`` bits: one
that fills up prunes less and loses nothing).

Hot prefixes: one with more than ``1 / SHARES`` of all words (there are fewer than
``SHARES`` of them, so they are broadcast) has its stripe dealt in segments by the
hash of the next word, each about as large as that share.  Words counted with
numpy inside tasks, merging and scoring are DataFrame operations.

Defined results: null texts are empty, null languages ``und``; rows with equal ids
are rows of their own; texts of any length are read in parts and chunks that
overlap by the words a phrase needs; an empty table gives no rows; other columns
are not read."""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow_rows, give_back, ship_package, stage

LEAST, LONGEST, TOP = 30, 4, 2000
#: Words of a chunk, bytes of a text tokenised at a time, shares of all words that make a prefix hot.
CHUNK, PART, SHARES = 4_000_000, 1 << 20, 4_096
#: Bits of a filter: per phrase, and at most.
BITS_EACH, FILTER_BITS = 16, 1 << 27

_BREAKS = b".,;:!?\n\x0b\x0c\r"
#: Lower-cases A-Z and turns every end of a piece into a full stop.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 46 if c in _BREAKS else c for c in range(256))
_GAP = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_STRIPES = "lang string, prefix string, seg int, next array<string>, n array<long>"


class Filter:
    """Phrases (as hashes) that may be frequent: false positives, no false negatives."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h & self.mask
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang))


def join_hashes(h: list) -> np.ndarray:
    """Hash of a phrase from those of its words (arrays)."""
    out = h[0].astype(np.uint64)
    for x in h[1:]:
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + x
    return out ^ (out >> np.uint64(32))


class Chunk:
    """Words of consecutive texts as numbers; 0 ends a piece.  A word has another
    number in each language, so numbers alone make keys."""

    def __init__(self):
        self.next, self.words, self.parts, self.size = itertools.count(1), {}, [], 0

    def add(self, lang: str, data: bytes) -> None:
        if lang not in self.words:
            self.words[lang] = defaultdict(self.next.__next__, {b".": 0})
        words = data.translate(_FOLD).replace(b".", b" . ").split()
        ids = np.fromiter(map(self.words[lang].__getitem__, words), np.int64, len(words))
        self.parts.append(ids)
        self.size += len(ids)

    def end_piece(self) -> None:
        self.parts.append(np.zeros(1, np.int64))

    def names(self) -> tuple[np.ndarray, list, np.ndarray]:
        """By number: language (its place in the list after), word, hash."""
        total = 1 + sum(len(w) - 1 for w in self.words.values())
        langs, names, hashes = np.zeros(total, np.int32), [None] * total, np.zeros(total, np.uint64)
        for i, (lang, words) in enumerate(self.words.items()):
            seed = xxhash.xxh64_intdigest(lang)
            for w, k in words.items():
                if k:
                    langs[k], names[k], hashes[k] = i, w, xxhash.xxh64_intdigest(w, seed)
        return langs, names, hashes


def _parts(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` cut before blanks or ends of pieces into parts of about ``size`` bytes."""
    at = 0
    while len(data) - at > size:
        gap = _GAP.search(data, at + size)
        if not gap:
            break
        yield data[at:gap.start()]
        at = gap.start()
    yield data[at:] if at else data


def _count(ids: np.ndarray, starts: int, size: int, hashes: np.ndarray, words: int, known: Filter) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Stripe entries of the phrases that begin at the first ``starts`` of ``ids``
    (which has ``words`` more): the prefix's words (a list of arrays), its number,
    the next word (0: the rest) and the count, by prefix."""
    at = [ids[j:starts + j] for j in range(words + 1)]
    if words == 1:
        may = known.has(join_hashes([hashes]))
        may[0] = False
        live = np.flatnonzero(may[at[0]])
        following = at[1][live]
        keys, count = np.unique(at[0][live] * size + np.where(may[following], following, 0), return_counts=True)
        return [keys // size], keys // size, keys % size, count
    # The first and the last `words` words must be frequent.
    part = [ids[j:starts + 1 + j] for j in range(words)]
    may = np.logical_and.reduce([p != 0 for p in part])
    some = np.flatnonzero(may)
    may[some] = known.has(join_hashes([hashes[p[some]] for p in part]))
    live = np.flatnonzero(may[:-1] & may[1:])
    prefix = at[0][live]
    for p in at[1:words]:
        _, prefix = np.unique(prefix * size + p[live], return_inverse=True)
    keys, first, count = np.unique(prefix * size + at[words][live], return_index=True, return_counts=True)
    return [p[live[first]] for p in at[:words]], keys // size, keys % size, count


def _emit(chunk: Chunk, words: int, known: Filter, hot: dict, carry: bool) -> tuple[list[pa.RecordBatch], list]:
    """The stripes of a chunk; with ``carry`` the text goes on, so the last words
    begin no phrase here and are returned, to begin the next chunk."""
    langs, names, hashes = chunk.names()
    languages = list(chunk.words)
    ids = np.concatenate([*chunk.parts, np.zeros(0 if carry else words, np.int64)])
    starts = max(0, len(ids) - words)
    left = [(languages[langs[i]], names[i]) if i else None for i in ids[starts:]] if carry else []
    heads, number, following, count = _count(ids, starts, len(names), hashes, words, known)
    if not len(number):
        return [], left
    changes = np.r_[True, number[1:] != number[:-1]]
    new, run = np.flatnonzero(changes), np.cumsum(changes) - 1
    texts = pa.array(names, pa.binary()).cast(pa.string())
    prefix = texts.take(pa.array(heads[0][new]))
    for h in heads[1:]:
        prefix = pc.binary_join_element_wise(prefix, texts.take(pa.array(h[new])), " ")
    lang = pa.array(languages, pa.string()).take(pa.array(langs[heads[0][new]]))
    seg = np.zeros(len(run), np.int64)
    if hot:
        pieces = np.array([hot.get(x, 1) for x in zip(lang.to_pylist(), prefix.to_pylist(), strict=True)], np.uint64)[run]
        seg = (hashes[following] % pieces).astype(np.int64)
        order = np.lexsort((seg, run))
        run, seg, following, count = run[order], seg[order], following[order], count[order]
    cut = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (seg[1:] != seg[:-1])])
    offsets = pa.array(np.r_[cut, len(run)].astype(np.int32))
    table = pa.RecordBatch.from_arrays(
        [lang.take(pa.array(run[cut])), prefix.take(pa.array(run[cut])), pa.array(seg[cut].astype(np.int32)),
         pa.ListArray.from_arrays(offsets, texts.take(pa.array(following))), pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int64)))],
        ["lang", "prefix", "seg", "next", "n"])
    return [table.slice(i, 20_000) for i in range(0, table.num_rows, 20_000)], left


def _word_counts(chunk: Chunk, carry: bool) -> tuple[list[pa.RecordBatch], list]:
    langs, names, _ = chunk.names()
    count = np.bincount(np.concatenate([np.zeros(0, np.int64), *chunk.parts]), minlength=len(names))
    seen = np.flatnonzero(count[1:]) + 1
    texts = pa.array(names, pa.binary()).cast(pa.string())
    lang = pa.array(list(chunk.words), pa.string())
    table = pa.RecordBatch.from_arrays([lang.take(pa.array(langs[seen])), texts.take(pa.array(seen)), pa.array(count[seen].astype(np.int64))], ["lang", "word", "n"])
    return [table.slice(i, 20_000) for i in range(0, table.num_rows, 20_000)], []


def _over_chunks(counted):
    """Read texts (``lang, text``) into chunks and give each to ``counted``."""
    words, size = CHUNK, PART

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for part in _parts(text.as_buffer().to_pybytes(), size):
                    chunk.add(lang, part)
                    if chunk.size >= words:
                        out, left = counted(chunk, True)
                        yield from out
                        chunk = Chunk()
                        for x in left:
                            if x is None:
                                chunk.end_piece()
                            else:
                                chunk.add(x[0], x[1])
                chunk.end_piece()
        if chunk.size:
            yield from counted(chunk, False)[0]
        give_back()

    return run


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")).filter("text <> ''")


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang, word, n`` for all words."""
    with arrow_rows(texts.sparkSession, 256):
        pieces = texts.mapInArrow(_over_chunks(lambda chunk, carry: _word_counts(chunk, carry)), "lang string, word string, n long")
        return stage(pieces.groupBy("lang", "word").agg(F.sum("n").alias("n")))


def make_filter(phrases: DataFrame) -> Filter:
    """Filter of ``phrases`` (``lang, phrase``).  What reaches the driver are the
    set words of at most ``FILTER_BITS`` bits."""
    n = phrases.count()
    bits = min(FILTER_BITS, 1 << max(16, (n * BITS_EACH - 1).bit_length()))

    def run(batches):
        for batch in batches:
            rows = [[word_hash(lang, w) for w in phrase.encode().split(b" ")] for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            h = np.array([join_hashes([np.array([x], np.uint64) for x in row])[0] for row in rows], np.uint64) & np.uint64(bits - 1)
            yield pa.RecordBatch.from_arrays([pa.array((h >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (h & np.uint64(63))).view(np.int64))], ["at", "bits"])

    words = phrases.select("lang", "phrase").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return Filter(out.view(np.uint8))


def hot_prefixes(counts: DataFrame, total: int) -> dict:
    """(lang, prefix) of more than ``1 / SHARES`` of all words, and into how many
    segments its stripe goes.  Fewer than ``SHARES`` prefixes of a length can be."""
    rows = counts.filter(F.col("n") > total // SHARES).select("lang", "phrase", "n").collect() if total >= SHARES else []
    return {(r.lang, r.phrase): 1 + r.n * SHARES // total for r in rows}


def stripes(texts: DataFrame, words: int, known: Filter, hot: dict, least: int) -> DataFrame:
    """Merged stripes of prefixes of ``words`` words: ``lang, prefix, seg, total,
    extensions`` (``next`` and its count ``n``, those of at least ``least``)."""
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast((known, hot))   # bounded by FILTER_BITS and SHARES

    def counted(chunk, carry):
        return _emit(chunk, words, *sent.value, carry)

    with arrow_rows(spark, 256):
        pieces = texts.mapInArrow(_over_chunks(counted), _STRIPES)
        keys = ["lang", "prefix", "seg"]
        # Dealt by stripe, so neither sum moves rows again.
        entries = pieces.repartition(*keys).select(*keys, F.explode(F.arrays_zip("next", "n")).alias("e")).select(*keys, "e.next", "e.n")
        merged = entries.groupBy(*keys, "next").agg(F.sum("n").alias("n"))
        kept = F.when(F.col("next").isNotNull() & (F.col("n") >= least), F.struct("next", "n"))
        return stage(merged.groupBy(*keys).agg(F.sum("n").alias("total"), F.collect_list(kept).alias("extensions")))


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, shadow_pct: int = 80, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top``
    phrases of 2 to ``longest`` words that occur ``least`` times.

    Of a phrase's cuts into two parts with frequencies ``l`` and ``r`` the lowest
    score ``floor(2000000 a / (l + r))`` counts; phrases inside a longer one that
    has ``shadow_pct`` percent of their occurrences are left out."""
    ship_package(docs.sparkSession)
    texts = _texts(docs, text, lang)
    counts = word_counts(texts)
    sizes = stage(counts.groupBy("lang").agg(F.sum("n").alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    frequent = counts.filter(F.col("n") >= least).select("lang", F.col("word").alias("phrase"), "n")
    levels, found = [frequent], []
    for words in range(1, longest):
        s = stripes(texts, words, make_filter(frequent), hot_prefixes(frequent, total), least)
        frequent = stage(s.select("lang", "prefix", F.explode("extensions").alias("e")).select("lang", F.concat_ws(" ", "prefix", "e.next").alias("phrase"), "e.n"))
        found.append((words + 1, frequent))
        if words == 1:
            levels = [s.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.sum("total").alias("n"))]
        levels.append(frequent)
    return rank_phrases(found, levels[:-1], sizes, top, shadow_pct)


def rank_phrases(found: list, levels: list, sizes: DataFrame, top: int, shadow_pct: int) -> DataFrame:
    """Scores of the candidates ``found`` (pairs: words, table ``lang, phrase, n``)
    from the frequencies of their parts, ``levels``."""
    known = levels[0]
    for more in levels[1:]:
        known = known.unionByName(more)
    cuts = None
    for words, phrases in found:
        w = F.split("phrase", " ")
        k = F.explode(F.sequence(F.lit(1), F.lit(words - 1))).alias("k")
        own = phrases.select("lang", "phrase", F.col("n").alias("a"), k, w.alias("w"))
        own = own.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"), F.array_join(F.slice("w", F.col("k") + 1, F.lit(words)), " ").alias("right"))
        cuts = own if cuts is None else cuts.unionByName(own)
    left = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    score = F.expr("cast(cast(a as decimal(20, 0)) * 2000000 div cast(l + r as decimal(20, 0)) as bigint)")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    # A phrase inside a longer one is inside one that is a word longer and at least as frequent, so one word more is enough.
    shadows = None
    for words, phrases in found:
        if words > 2:
            w = F.split("phrase", " ")
            ends = F.explode(F.array(F.slice(w, 1, words - 1), F.slice(w, 2, words - 1))).alias("w")
            one = phrases.select("lang", "n", ends).select("lang", F.array_join("w", " ").alias("phrase"), "n")
            shadows = one if shadows is None else shadows.unionByName(one)
    best = best.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    if shadows is not None:
        shadows = shadows.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
        shown = F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * shadow_pct)
        best = best.join(shadows, ["lang", "phrase"], "left").filter(shown).drop("longer")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # A language's phrases are ranked in parts first; at most `top` of a part go on.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = best.withColumn("part", part).withColumn("at", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("at") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
