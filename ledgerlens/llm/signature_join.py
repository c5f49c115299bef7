"""N-gram Jaccard self-join on signature trees (operator 9).

Sets are the distinct five-word shingles of whole texts; two sets are linked if
their Jaccard similarity is at least ``PERCENT``.  The result is exact:

1. Equal sets become one node (the group of copies is reduced in each task
   before it is shuffled).
2. Tokens have one global order: rare ones first, by hash.  Of its first n -
   ceil(t * n) + k tokens a set shares k with any set that it is linked with, or
   as many as that one's k.  So a token that is in the prefix of one set only
   leads nowhere, and neither does a set with fewer shared tokens than that;
   without it others may fall, so it is tried again.  Which tokens count as
   frequent comes from counts over all documents; it only shifts work, any order
   is right.
3. Under each shared token stands a signature tree: leaves hold sets as bitmaps
   of their tokens, inner nodes the OR of the bitmaps below, the range of sizes,
   the most tokens that share a bit, and the component if it is one.  A dual
   traversal goes down pairs of nodes and drops a pair whose sizes or whose
   largest possible overlap rule out a link, or that is inside one component.
4. The pairs of sets that remain are verified on the whole token sets.

The traversal runs twice.  First only from each set to the leaders (the smallest
set) of three of its token groups: that joins copies of one text, so that the second,
complete traversal has nothing to do inside their groups, however large.  Groups
that are still large are cut into chunks, and pairs of chunks are traversed.

Shingles are 64-bit hashes; a set is known by a 64-bit hash and its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ledgerlens.llm.common import TEXT_ROWS, add_row_index, arrow_rows, fresh, ship_package, slices, stage
from ledgerlens.llm.components import components

WORDS = 5
PERCENT = 80
#: A token is frequent if it is in at least this many sets of a lot, which is this many slices of documents.
FREQUENT_ROWS, LOT = 8, 8
#: Rows of an Arrow batch of pairs with both sets.
PAIR_ROWS = 128
#: Rows of groups of one leader that are traversed one after the other, and of all groups in a task.
LEADER_ROWS, TASK_ROWS = 16_384, 8_192
#: Frequent tokens that the order knows (the most frequent; 1.6 MB); others keep their place by hash.
FREQUENT_TOKENS = 200_000
#: A prefix goes on by one token for each so many of the set.
MORE = 20
#: A signature has twice as many bits as the set has tokens, rounded up to a power of two, in this range.
FEWEST_BITS, MOST_BITS = 256, 1 << 16
#: How often sets without enough shared tokens are taken out.
PRUNINGS = 2
LEAF, FANOUT = 16, 8
#: Sets of a token group that are traversed as one.
GROUP = 2048
NULL_ID = -(1 << 63)

_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes | None) -> np.ndarray:
    """The sorted distinct hashes of the five-word runs of a UTF-8 text, A-Z in
    lower case; words are what bytes 9-13 and 32 separate.  With fewer words, of
    the whole sequence; without words, none."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    if len(w) < WORDS:
        words += [b""] * (WORDS - len(w))
        w = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, WORDS)
    n = len(w) - WORDS + 1
    h = w[:n] * _ODD[0]
    for k in range(1, WORDS):
        h += w[k:k + n] * _ODD[k]
    return np.unique(_mix(h))


def set_key(tokens: np.ndarray) -> int:
    return xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def prefix_length(n: int) -> int:
    """So many first tokens of a set of n hold max(1, n // MORE) of any linked set, or
    as many as the same makes for that one."""
    return n - -(-PERCENT * n // 100) + max(1, n // MORE) if n else 0


def least_shared(n: Column) -> Column:
    """Tokens that the prefix of a set of n shares with that of a linked set, which
    has at least PERCENT of n tokens."""
    return F.greatest(F.lit(1), F.floor(F.floor(n * PERCENT / 100) / MORE))


def least_overlap(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Shared tokens that sets of n and m need: 100 * s >= PERCENT * (n + m - s)."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)).alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"))


def _distinct_sets(batch: pa.RecordBatch, seen: set) -> list[np.ndarray]:
    """The sets of a slice that aren't in ``seen``, which gets their keys: a task's copies count once."""
    out = []
    for t in batch.column(1).to_pylist():
        s = shingles(t)
        if len(s) and (key := (set_key(s), len(s))) not in seen:
            seen.add(key)
            out.append(s)
    return out


def _survey(texts: DataFrame) -> DataFrame:
    """Of each document ``id, hash, part`` (hashes of the text, Spark's and ours), ``key, n`` (its set);
    and, in rows of their own, ``token, count`` of tokens that are frequent in a lot."""
    kinds = [pa.int64()] * 7
    names = ["id", "hash", "part", "key", "n", "token", "count"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], np.ndarray] = {}

        def frequent() -> pa.RecordBatch:
            token, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *seen.values()]), return_counts=True)
            seen.clear()
            keep = n >= FREQUENT_ROWS
            none = pa.nulls(int(keep.sum()), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, none, none, pa.array(token[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))], names)

        for i, b in enumerate(slices(batches), 1):
            raw = b.column(1).to_pylist()
            sets = [shingles(t) for t in raw]
            keys = [set_key(s) for s in sets]
            seen.update(((k, len(s)), s) for k, s in zip(keys, sets, strict=True) if len(s))
            none = pa.nulls(b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([xxh3_64_intdigest(t) - (1 << 63) for t in raw], pa.int64()), pa.array(keys, pa.int64()),
                                              pa.array([len(s) for s in sets], pa.int64()), none, none], names)
            if i % LOT == 0:
                yield frequent()
        yield frequent()

    return texts.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


class Order:
    """The global order of tokens: not frequent ones, then by size class of the count; each by hash."""

    def __init__(self, frequent: dict[int, int]):
        token = np.array(list(frequent), np.int64).view(np.uint64)
        by = np.argsort(token)
        self.token = token[by]
        self.level = np.array([n.bit_length() for n in frequent.values()], np.int64)[by]

    def levels(self, tokens: np.ndarray) -> np.ndarray:
        """0 for tokens that aren't frequent, else the class."""
        if not len(self.token):
            return np.zeros(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(self.token, tokens), len(self.token) - 1)
        return np.where(self.token[at] == tokens, self.level[at], 0)

    def prefix(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        level = self.levels(tokens)
        first = np.argsort(level, kind="stable")[:prefix_length(len(tokens))]
        return tokens[first], level[first]


def _postings(texts: DataFrame, order) -> DataFrame:
    """``token, salt, key, n``: the prefix of each set.  Salt spreads a frequent token's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in slices(batches):
            sets = _distinct_sets(b, seen)
            pre = [order.value.prefix(s) for s in sets]
            size = [len(p) for p, _ in pre]
            token = np.concatenate([np.zeros(0, np.uint64), *(p for p, _ in pre)]).view(np.int64)
            level = np.concatenate([np.zeros(0, np.int64), *(x for _, x in pre)])
            key = np.repeat(np.array([set_key(s) for s in sets], np.int64), size)
            n = np.repeat(np.array([len(s) for s in sets], np.int64), size)
            salt = np.where(level > 0, 1 + (key & 255), 0)
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(salt.astype(np.int32)), pa.array(key), pa.array(n)], ["token", "salt", "key", "n"])

    return texts.mapInArrow(run, "token bigint, salt int, key bigint, n bigint")


def _shared(postings: DataFrame) -> DataFrame:
    """Postings without repeats whose token is frequent or has two different sets.

    Rows are sorted, so one row is held back at most: the first of a token, until
    a different one comes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, many = np.zeros((0, 4), np.int64), None, None
        for b in batches:
            rows = np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
            rows = np.concatenate([held, rows])
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
            if len(rows) and last is not None:
                new[0] = (rows[0] != last).any()
            rows = rows[new]
            if not len(rows):
                continue
            first = np.ones(len(rows), bool)
            first[1:] = rows[1:, 0] != rows[:-1, 0]
            group = np.cumsum(first) - 1
            keep = (np.bincount(group)[group] > 1) | (rows[:, 1] > 0)
            if many is not None:
                keep |= rows[:, 0] == many
            if keep[-1]:
                held, last, many = rows[:0], rows[-1], rows[-1, 0]
            else:
                held, last, many = rows[-1:], None, None
            rows = rows[keep]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in (0, 2, 3)], ["token", "key", "n"])

    return (postings.repartition("token", "salt").sortWithinPartitions("token", "salt", "key", "n")
            .mapInArrow(run, "token bigint, key bigint, n bigint"))


def _different_groups(shared: DataFrame) -> DataFrame:
    """One token of those with the same sets: the others' trees would be the same
    trees.  Groups are told apart by size, ends and two sums over hashes of their sets."""
    h = F.xxhash64("node")
    groups = shared.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("first"), F.max("node").alias("last"),
                                         F.bit_xor(h).alias("x"), F.sum(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 24))).alias("s"))
    one = groups.groupBy("size", "first", "last", "x", "s").agg(F.min("token").alias("token"))
    return shared.join(stage(one.select("token")), "token", "left_semi")


def signature(tokens: np.ndarray) -> np.ndarray:
    bits = min(max(FEWEST_BITS, 1 << (2 * len(tokens) - 1).bit_length()), MOST_BITS)
    out = np.zeros(bits // 64, np.uint64)
    bit = np.unique(tokens & np.uint64(bits - 1))
    np.bitwise_or.at(out, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Signatures as they would be with ``words`` words."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def shared_bits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    words = min(x.shape[-1], y.shape[-1])
    return np.bitwise_count(fold(x, words) & fold(y, words)).sum(axis=-1).astype(np.int64)


def _sets(texts: DataFrame) -> DataFrame:
    """``node, n, tokens, signature`` of the rows ``text, key, n, node`` whose text
    has that set; another text may share the id and hash that brought them together.
    A task's copies of a row count once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in slices(batches):
            raw, key, n, node = (c.to_pylist() for c in b.columns)
            sets = [(i, s) for t, k, m, i in zip(raw, key, n, node, strict=True)
                    if i not in seen and len(s := shingles(t)) == m and set_key(s) == k and not seen.add(i)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in sets], pa.int64()), pa.array([len(s) for _, s in sets], pa.int64()), pa.array([s.tobytes() for _, s in sets], pa.binary()),
                                              pa.array([signature(s).tobytes() for _, s in sets], pa.binary())], ["node", "n", "tokens", "signature"])

    return texts.select("text", "key", "n", "node").mapInArrow(run, "node bigint, n bigint, tokens binary, signature binary")


def _pruned(shared: DataFrame) -> DataFrame:
    """``token, node, n`` without sets that share too few tokens of their prefix
    with others to be linked, and without tokens that are then alone."""
    enough = shared.groupBy("node").agg(F.count(F.lit(1)).alias("shared"), F.first("n").alias("n")).filter(F.col("shared") >= least_shared(F.col("n"))).select("node")
    # Written, as the joins are then of plain shuffles, which Spark splits where a token is hot.
    left = shared.join(enough, "node", "left_semi")
    several = left.groupBy("token").agg(F.min("node").alias("x"), F.max("node").alias("y")).filter("x < y").select("token")
    return stage(left.join(stage(several), "token", "left_semi"))


# --------------------------------------------------------------------------- trees


class Members:
    """Sets of one token group with signatures of one width, in an order that
    keeps components and sizes together."""

    def __init__(self, node: np.ndarray, n: np.ndarray, component: np.ndarray, bits: np.ndarray, side: np.ndarray):
        by = np.lexsort((n, component))
        self.node, self.n, self.component, self.bits, self.side = node[by], n[by], component[by], bits[by], side[by]
        self.slack = self.n - np.bitwise_count(self.bits).sum(axis=1).astype(np.int64)


class Tree:
    """A node over members ``a`` to ``z``."""

    def __init__(self, m: Members, a: int, z: int):
        self.m, self.a, self.z = m, a, z
        step = LEAF
        while step * FANOUT < z - a:
            step *= FANOUT
        self.children = [Tree(m, i, min(i + step, z)) for i in range(a, z, step)] if z - a > LEAF else []
        below = self.children
        self.bits = np.bitwise_or.reduce([c.bits for c in below]) if below else np.bitwise_or.reduce(m.bits[a:z])
        self.low, self.high = int(m.n[a:z].min()), int(m.n[a:z].max())
        self.slack = int(m.slack[a:z].max())
        self.component = m.component[a] if m.component[a] == m.component[z - 1] else None  # sorted by it


def spare(x: Tree, y: Tree, slack_x, slack_y):
    """Shared tokens beyond shared bits: those of a set that share a bit with
    another of its own.  A folded signature has more of them than its set's slack
    says, so then only the narrower one's counts."""
    a, b = x.bits.shape[-1], y.bits.shape[-1]
    return np.minimum(slack_x, slack_y) if a == b else slack_x if a < b else slack_y


def may_link(x: Tree, y: Tree) -> bool:
    """Whether some set under x and another under y could be linked and aren't in one component."""
    if x.component is not None and x.component == y.component:
        return False
    if 100 * x.high < PERCENT * y.low or 100 * y.high < PERCENT * x.low:
        return False
    most = int(shared_bits(x.bits, y.bits)) + int(spare(x, y, x.slack, y.slack))
    return min(most, x.high, y.high) >= -(-PERCENT * (x.low + y.low) // (100 + PERCENT))


def traverse(groups: list[Members], cross: bool) -> list[tuple[int, int]]:
    """Pairs of members that could be linked; if ``cross``, of different sides only."""
    roots = [Tree(m, 0, len(m.node)) for m in groups]
    out, todo = [], [(x, y) for k, x in enumerate(roots) for y in roots[k:]]
    while todo:
        x, y = todo.pop()
        if not may_link(x, y):
            continue
        if x.children or y.children:
            if x is y:
                todo += [(c, d) for i, c in enumerate(x.children) for d in x.children[i:]]
            elif x.children and (not y.children or x.z - x.a >= y.z - y.a):
                todo += [(c, y) for c in x.children]
            else:
                todo += [(x, c) for c in y.children]
            continue
        i, j = np.arange(x.a, x.z)[:, None], np.arange(y.a, y.z)[None, :]
        i, j = (v[i < j] if x is y else v.ravel() for v in np.broadcast_arrays(i, j))
        keep = x.m.component[i] != y.m.component[j]
        if cross:
            keep &= x.m.side[i] != y.m.side[j]
        i, j = i[keep], j[keep]
        most = shared_bits(x.m.bits[i], y.m.bits[j]) + spare(x, y, x.m.slack[i], y.m.slack[j])
        n, k = x.m.n[i], y.m.n[j]
        keep = np.minimum(most, np.minimum(n, k)) >= least_overlap(n, k)
        out += zip(x.m.node[i[keep]].tolist(), y.m.node[j[keep]].tolist(), strict=True)
    return out


def by_width(node, n, component, signatures: list[bytes], side) -> list[Members]:
    """Members grouped by the width of their signatures."""
    width = np.array([len(s) for s in signatures])
    out = []
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        bits = np.frombuffer(b"".join(signatures[i] for i in at), np.uint64).reshape(len(at), -1)
        out.append(Members(node[at], n[at], component[at], bits, side[at]))
    return out


def _candidates(rows: DataFrame, tasks: int) -> DataFrame:
    """``a < b``: pairs that the trees of the groups ``(token, i, j)`` let through.
    ``rows``: ``token, leader, salt, i, j, side, node, n, component, signature``.
    Groups of one leader have much the same sets, so they go to one task, one after
    the other, where a pair counts once; salt spreads those of a busy leader."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last, seen = None, set()

        def close():
            t = pa.Table.from_batches(held)
            held.clear()
            if t.num_rows < 2:
                return
            num = {c: t.column(c).to_numpy().astype(np.int64) for c in ("i", "j", "side", "node", "n", "component")}
            groups = by_width(num["node"], num["n"], num["component"], t.column("signature").to_pylist(), num["side"])
            pairs = traverse(groups, bool(num["i"][0] != num["j"][0]))
            seen.update((min(p), max(p)) for p in pairs)

        def send():
            a, b = zip(*seen, strict=True)
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            keys = np.column_stack([b.column(c).to_numpy().astype(np.int64) for c in ("token", "i", "j")])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), b.num_rows]
            for s, e in zip(cuts, cuts[1:], strict=False):
                key = tuple(keys[s])
                if key != last and held:
                    close()
                last = key
                held.append(b.slice(s, e - s))
                if len(seen) > 200_000:
                    yield send()
        if held:
            close()
        if seen:
            yield send()

    return (rows.repartition(tasks, "leader", "salt", "i", "j").sortWithinPartitions("leader", "salt", "i", "j", "token", "component", "n", "node")
            .mapInArrow(run, "a bigint, b bigint").distinct())


def _plausible(pairs: DataFrame, light: DataFrame) -> DataFrame:
    """The pairs that pass the trees' test of two leaves' sets.  ``light``: ``node, n, signature``."""
    x = light.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
    y = light.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 4096):
            keep = []
            for n, k, s, t in zip(*(c.to_pylist() for c in b.columns[2:]), strict=True):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                words = min(len(s), len(t))
                spare = min(size - int(np.bitwise_count(v).sum()) for size, v in ((n, s), (k, t)) if len(v) == words)
                keep.append(min(int(shared_bits(s, t)) + spare, n, k) >= -(-PERCENT * (n + k) // (100 + PERCENT)))
            yield pa.RecordBatch.from_arrays(b.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    close = (F.col("na") * 100 >= F.col("nb") * PERCENT) & (F.col("nb") * 100 >= F.col("na") * PERCENT)
    return (pairs.join(x, "a").join(y, "b").filter(close).select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a bigint, b bigint"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are linked, by their whole sets."""
    x = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    y = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            keep = []
            for s, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays(b.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(y, "b").join(x, "a").select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint")


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, part, n_shingles, component_id`` for each row of ``docs``:
    ``part`` is a hash of the text, ``component_id`` the smallest id reachable by
    links, its own included.

    A null text is empty; a document without words has no shingles and is linked
    with nothing.  Repeated rows and texts that share an id are documents of
    their own.  A null id counts as smaller than any other.  Other columns are ignored."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = _texts(docs, id_col, text_col)
    with arrow_rows(spark, TEXT_ROWS):
        survey = stage(_survey(texts))
    sizes = survey.filter("n is not null").select("id", "part", "key", "n")
    frequent = (survey.filter("token is not null").groupBy("token").agg(F.sum("count").alias("n"))
                .orderBy(F.desc("n"), "token").limit(FREQUENT_TOKENS).collect())
    order = spark.sparkContext.broadcast(Order({r.token: r.n for r in frequent}))
    # A set's text is found again by id and hash: ids, null ones too, may have many texts.
    reps = survey.filter("n > 0").groupBy("key", "n").agg(F.min(F.struct("id", "hash")).alias("first")).select("key", "n", "first.*")
    reps = stage(add_row_index(reps, ["id", "key", "n"], "node"))
    with arrow_rows(spark, TEXT_ROWS):
        postings = stage(_shared(_postings(texts, order)))
    shared = stage(postings.join(reps.select("key", "n", "node"), ["key", "n"]).select("token", "node", "n"))
    for _ in range(PRUNINGS):
        shared = _pruned(shared)
    shared = stage(_different_groups(shared.select("token", "node")))
    wanted = shared.select("node").distinct().join(reps, "node")
    with arrow_rows(spark, TEXT_ROWS):
        sets = stage(_sets(texts.join(wanted, ["id", "hash"])))
    light = sets.select("node", "n", "signature")

    # First traversal: each set against the leaders of three of its groups.
    chosen = shared.groupBy("node").agg(F.min("token").alias("x"), F.max("token").alias("y"), F.min_by("token", F.xxhash64("token")).alias("z"))
    mine = chosen.select("node", F.explode(F.array_distinct(F.array("x", "y", "z"))).alias("token"))
    # Written, so that the join with it is one of two plain shuffles, which Spark splits where a token is hot.
    leaders = stage(mine.groupBy("token").agg(F.min("node").alias("a")))
    stars = mine.join(leaders, "token").filter("a < node").select("a", F.col("node").alias("b")).distinct()
    stars = stage(_plausible(stars, light))
    with arrow_rows(spark, PAIR_ROWS):
        linked = stage(_verified(stars, sets))
    of = stage(components(linked))

    # Second, complete traversal, where a group has several components.
    labelled = shared.join(of, "node", "left").select("token", "node", F.coalesce("component", "node").alias("component"))
    mixed = labelled.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("size"), F.min("node").alias("leader")).filter("x < y")
    chunks = F.ceil(F.col("size") / GROUP).cast("int")
    busy = mixed.groupBy("leader").agg(F.ceil(F.sum("size") / LEADER_ROWS).alias("salts"))
    salt = F.pmod(F.xxhash64("token"), F.col("salts")).cast("int")
    mixed = stage(mixed.join(busy, "leader").select("token", "leader", "size", salt.alias("salt"), chunks.alias("chunks")))
    rows = labelled.join(mixed.drop("size"), "token").join(light, "node")
    rows = rows.withColumn("side", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("token", "leader", "salt", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node", "n", "component", "signature")
    # Work follows rows, not bytes, so Spark isn't left to join small tasks.
    total = mixed.agg(F.sum(F.col("size") * F.col("chunks"))).first()[0] or 0
    most = 50 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = stage(_candidates(rows, max(1, min(most, math.ceil(total / TASK_ROWS)))))
    with arrow_rows(spark, PAIR_ROWS):
        more = stage(_verified(pairs, sets))
    joined = components(_across(more, of))
    root = of.join(joined.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left").select("node", F.coalesce("root", "component").alias("root"))
    alone = joined.join(of.select("node"), "node", "left_anti").select("node", F.col("component").alias("root"))
    roots = root.unionByName(alone)
    # Nodes are numbered by their smallest id, so the smallest node has the smallest id.
    named = (reps.join(roots, "node", "left").select("key", "n", F.coalesce("root", "node").alias("root"))
             .join(reps.select(F.col("node").alias("root"), F.col("id").alias("component_id")), "root").select("key", "n", "component_id"))
    out = sizes.join(named, ["key", "n"], "left").select("id", "part", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(back("id").alias(id_col), "part", "n_shingles", back("component_id").alias("component_id"))


def _across(links: DataFrame, of: DataFrame) -> DataFrame:
    """Links between sets as links between their components."""
    def name(c: str) -> Column:
        return F.coalesce(F.col(f"c{c}"), F.col(c))
    x, y = (of.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in "ab")
    return links.join(x, "a", "left").join(y, "b", "left").select(name("a").alias("a"), name("b").alias("b"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, with one of each component: that with the
    smallest id (of several, by hash of the text).  Documents without words all
    stay; rows equal in id and text are one document."""
    found = stage(link_components(docs, id_col, text_col))
    ident = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(NULL_ID))
    first = found.filter("n_shingles > 0").groupBy(ident("component_id").alias("_c")).agg(F.min(F.struct(ident(id_col).alias("_id"), F.col("part").alias("_part"))).alias("k")).select("k.*")
    empty = found.filter("n_shingles = 0").select(ident(id_col).alias("_id"), F.col("part").alias("_part")).distinct()
    return _pick(docs, first.unionByName(empty), id_col, text_col)


def _pick(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows with ``_id`` and ``_part`` in ``keys`` (distinct), each once."""
    names = docs.columns
    pt, ident = fresh(names, "_part"), fresh(names, "_id")

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for b in slices(batches):
            raw = b.column(at).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([xxh3_64_intdigest(t or b"") - (1 << 63) for t in raw], pa.int64())], [*names, pt])

    ddl = docs.withColumn(pt, F.lit(0).cast("bigint")).schema
    marked = docs.mapInArrow(part, ddl).withColumn(ident, F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)))
    keys = keys.select(F.col("_id").alias(ident), F.col("_part").alias(pt))
    return marked.join(keys, [ident, pt], "left_semi").dropDuplicates([ident, pt]).select(*names)
