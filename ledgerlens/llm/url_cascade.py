"""URL filter on a Bloom filter cascade (operator 1).

A cascade answers "is this key listed?" exactly for every key of a known
universe, from a few bits per key and without a join.  Level 1 is a Bloom filter
of the listed keys; level 2 holds the unlisted keys of the universe that level 1
lets through, level 3 the listed keys that level 2 lets through, and so on until
nothing is let through wrongly.  A key is listed exactly if the first level that
rejects it is an even one.

The universe is every key that the corpus can ask for, so it is gathered from
the corpus itself.  Keys are dealt into shards by hash, each with a cascade of
its own of at most about ``SHARD_BYTES``: one shard's filters are broadcast at a
time, however long the list is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import ship_package, slices, stage

#: Share of wrong keys that a level lets through; hash functions of a level.
PASS_RATE = 1 / 16
N_HASHES = 4
SHARD_BYTES = 64 << 20
SHARD_SEED = 97


def level_bits(n: int) -> int:
    """Bits of a level that holds n keys."""
    return 64 * max(1, math.ceil(n * N_HASHES / math.log(2) / 64))


def positions(keys: Sequence[str], level: int, bits: int) -> np.ndarray:
    """A row of bit positions for each key: two hashes of this level, combined."""
    raw = [xxhash.xxh128_intdigest(k.encode("utf-8", "surrogatepass"), seed=level) for k in keys]
    a = np.array([x & 0xFFFFFFFFFFFFFFFF for x in raw], np.uint64)
    b = np.array([x >> 64 for x in raw], np.uint64) | np.uint64(1)
    return (a[:, None] + b[:, None] * np.arange(N_HASHES, dtype=np.uint64)) % np.uint64(bits)


def passes(words: np.ndarray, keys: Sequence[str], level: int) -> np.ndarray:
    """Which keys a level's filter lets through."""
    at = positions(keys, level, 64 * len(words))
    return ((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


class Cascade:
    """The levels of one shard."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels

    def listed(self, keys: Sequence[str]) -> np.ndarray:
        out = np.zeros(len(keys), bool)
        live = np.arange(len(keys))
        for i, words in enumerate(self.levels):
            if not len(live):
                break
            through = passes(words, [keys[k] for k in live], i)
            out[live[~through]] = i % 2 == 1
            live = live[through]
        out[live] = len(self.levels) % 2 == 1  # let through by all: it belongs to the last level
        return out


def shard_of(keys: Sequence[str], shards: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(k.encode("utf-8", "surrogatepass"), seed=SHARD_SEED) % shards for k in keys], np.int64)


def _words(keys: DataFrame, level: int, bits: int) -> np.ndarray:
    """The filter of ``keys``: a task ORs its batch, the words meet in a bit_or.
    What the driver gets is the filter itself, at most ``SHARD_BYTES``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 8192):
            at = np.unique(positions(b.column(0).to_pylist(), level, bits))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            mask = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(mask.view(np.int64))], ["word", "mask"])

    out = np.zeros(bits // 64, np.uint64)
    got = keys.select("key").mapInArrow(run, "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    rows = got.toPandas()
    out[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64).view(np.uint64)
    return out


def _through(keys: DataFrame, words: np.ndarray, level: int) -> DataFrame:
    """The keys that a level lets through."""
    filt = keys.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 8192):
            yield b.filter(pa.array(passes(filt.value, b.column(0).to_pylist(), level)))

    return keys.select("key").mapInArrow(run, "key string")


def build(listed: DataFrame, universe: DataFrame, shard_bytes: int = SHARD_BYTES) -> list[Cascade]:
    """The cascades (one per shard) for the keys of ``listed`` over those of
    ``universe``, both a column ``key`` of distinct non-null strings.  Listed keys
    outside the universe are left out: nothing will ask for them."""
    ship_package(universe.sparkSession)
    marked = stage(universe.withColumn("in", F.lit(False)).unionByName(listed.withColumn("in", F.lit(True)))
                   .groupBy("key").agg(F.max("in").alias("listed"), F.min("in").alias("only"))
                   .filter(~F.col("only")).select("key", "listed"))
    n = {r.listed: r.n for r in marked.groupBy("listed").agg(F.count(F.lit(1)).alias("n")).collect()}
    shards = max(1, math.ceil(level_bits(n.get(True, 0)) / 8 / shard_bytes))
    out = []
    for s in range(shards):
        mine = marked
        if shards > 1:
            def pick(batches, s=s):
                for b in slices(batches, 8192):
                    yield b.filter(pa.array(shard_of(b.column(0).to_pylist(), shards) == s))
            mine = stage(marked.mapInArrow(pick, "key string, listed boolean"))
        inside, other = mine.filter("listed").select("key"), mine.filter(~F.col("listed")).select("key")
        levels: list[np.ndarray] = []
        size = inside.count()
        while size:
            words = _words(inside, len(levels), level_bits(size))
            wrong = stage(_through(other, words, len(levels)))
            levels.append(words)
            inside, other, size = wrong, inside, wrong.count()
        out.append(Cascade(levels))
    return out


def contains(df: DataFrame, keys_col: str, hits_col: str, cascades: list[Cascade]) -> DataFrame:
    """Add ``hits_col``, an array of booleans that say which of the keys in the
    array column ``keys_col`` are listed.  Shard by shard, so a worker holds the
    filters of one."""
    ship_package(df.sparkSession)
    df = df.withColumn(hits_col, F.transform(keys_col, lambda _: F.lit(False)))
    names = df.columns
    at_keys, at_hits = names.index(keys_col), names.index(hits_col)
    for s, cascade in enumerate(cascades):
        filt = df.sparkSession.sparkContext.broadcast(cascade)

        def run(batches, s=s, filt=filt):
            for b in slices(batches, 4096):
                keys, hits = b.column(at_keys).to_pylist(), b.column(at_hits).to_pylist()
                flat = [k for row in keys for k in row]
                pick = np.flatnonzero(shard_of(flat, len(cascades)) == s) if len(cascades) > 1 else np.arange(len(flat))
                got = np.array([h for row in hits for h in row], bool)
                got[pick] = filt.value.listed([flat[i] for i in pick])
                ends = np.cumsum([len(row) for row in keys])
                cut = np.split(got, ends[:-1]) if len(keys) else []
                cols = list(b.columns)
                cols[at_hits] = pa.array(list(cut), pa.list_(pa.bool_()))
                yield pa.RecordBatch.from_arrays(cols, names)

        df = df.mapInArrow(run, df.schema)
        if len(cascades) > 1:
            df = stage(df)
    return df


# --------------------------------------------------------------------------- addresses and rules


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.instr(url, "://") > 0, lowered).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    rest = F.substr(url, F.instr(url, "://") + 3)
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def rule_candidates(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Every rule that could fit the address, longest first (of equal length the
    one with the longer host): its host's last labels and its path's first
    characters, of the label counts and path lengths that occur in the rules."""
    labels = sorted({split_rule(r)[0].count(".") + 1 for r, _ in rules})
    lengths = sorted({len(split_rule(r)[1]) for r, _ in rules})
    names = F.split(host, "\\.")
    cand = F.array(*(
        F.when((F.size(names) >= n) & (F.length(path) >= k) & (host != ""),
               F.concat(F.array_join(F.slice(names, F.greatest(F.size(names) - n + 1, F.lit(1)), n), "."), F.substring(path, 1, k)))
        for n in sorted(labels, reverse=True) for k in lengths))
    by = lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).otherwise(0)
    return F.array_sort(F.array_distinct(F.filter(cand, lambda x: x.isNotNull())), by)


def repeat_addresses(pages: DataFrame) -> DataFrame:
    """``address`` (host and path) of which the crawl holds several urls, that
    differ only in query or fragment: the mark of a crawler trap."""
    return (pages.filter(F.col("host") != "").select(F.concat("host", "path").alias("address"), "url").distinct()
            .groupBy("address").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("address"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], blocked: DataFrame, id_col: str = "page_id",
          url_col: str = "url", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(id_col, host, path, rule, verdict)`` for each row of ``pages``.

    ``rules`` are ``(rule, allow or block)``, a small list; ``blocked`` is a
    table of any size with a column ``address``.  A rule fits its host and the
    host's subdomains if the path starts with the rule's; the longest decides.
    Without one an address in ``blocked`` is blocked and any other allowed.
    Both lists, and which rules allow, live in one cascade, whose universe is
    every key these pages can ask for.

    A null url, or one without ``://``, has empty host and path, no rule, and is
    allowed.  Repeated rows give a row each.  Other columns are ignored."""
    spark = pages.sparkSession
    for r, verdict in rules:
        if verdict not in ("allow", "block") or "/" not in r:
            raise ValueError(f"not a rule: {r!r}, {verdict!r}")
    url = F.col(url_col)
    split = pages.select(F.col(id_col).alias("id"), url.alias("url"), F.coalesce(url_host(url), F.lit("")).alias("host"), F.coalesce(url_path(url), F.lit("")).alias("path"))
    split = split.withColumn("candidates", rule_candidates(F.col("host"), F.col("path"), rules))
    address = F.concat(F.lit("address "), "host", "path")
    asked = (split.select(F.explode("candidates").alias("c")).distinct()
             .select(F.explode(F.array(F.concat(F.lit("rule "), "c"), F.concat(F.lit("allows "), "c"))).alias("key"))
             .unionByName(split.select(address.alias("key")).distinct()))
    known = [("rule " + r,) for r, _ in rules] + [("allows " + r,) for r, v in rules if v == "allow"]
    listed = (spark.createDataFrame(sorted(set(known)), "key string")
              .unionByName(blocked.select(F.concat(F.lit("address "), "address").alias("key")).filter("key is not null").distinct()))
    cascades = build(listed, asked, shard_bytes)
    keys = F.concat(F.array(address), F.transform("candidates", lambda c: F.concat(F.lit("rule "), c)), F.transform("candidates", lambda c: F.concat(F.lit("allows "), c)))
    got = contains(split.select("id", "host", "path", "candidates", keys.alias("keys")), "keys", "hits", cascades)
    n = F.size("candidates")
    fits = F.zip_with("candidates", F.slice("hits", 2, n), lambda c, hit: F.when(hit, c))
    allows = F.slice("hits", n + 2, n)
    first = F.array_position(F.transform(fits, lambda c: c.isNotNull()), True).cast("int")
    found = got.select(F.col("id").alias(id_col), "host", "path", F.when(first > 0, F.get("candidates", first - 1)).alias("rule"),
                       F.when(first > 0, F.get(allows, first - 1)).otherwise(~F.get("hits", F.lit(0))).alias("ok"))
    return found.select(id_col, "host", "path", "rule", F.when(F.col("ok"), "allow").otherwise("block").alias("verdict"))
