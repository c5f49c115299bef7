"""Operator 12: hard negatives by segment summaries.

Components are turned into integers, ``floor(scale * x)``, so scores (inner
products) are exact.  Of each vector the sums and deviations of its segments are
kept, for 1, 2, 4, ... segments.  With ``m`` components in a segment, sums ``S`` and
deviations ``D`` (``D * D = m * sum of squares - S * S``), the inner product of two
segments lies within ``(S S' - D D') / m`` and ``(S S' + D D') / m``.  Pairs whose
bounds can't reach the best rows found so far, or can't enter the range of scores
asked for, are dropped level by level; what is left is scored exactly
(:class:`Search`).

Anchors are a stated part of the rows, searched against all rows in blocks: rows
are dealt by a hash of their id into ranges, each range meets all anchors, anchors
streaming through one at a time in blocks of ``ANCHORS``.  A task holds one range
(``RANGE_ROWS`` at most on average) and gives the best ``k`` of it per anchor and
score window; those few are merged by a ranked window per (anchor, positive).
Nothing is broadcast or collected.  Many equal vectors are many ties, kept by
smallest id.

Defined results: rows with a null id, label or vector, or a null or non-finite
component take no part; of rows with one id the least by (label, vector) counts;
missing components of shorter vectors are 0; scores beyond 64 bits are held at the
largest long; an empty table gives no rows; other columns are not read."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow_rows, ship_package, stage

#: Rows of a range at most (on average), anchors scored at a time, rows scored at a time.
RANGE_ROWS, ANCHORS, BLOCK = 262_144, 128, 4_096
#: Rows of an Arrow batch; each is a whole vector.
BATCH = 2_048
_TOP = (1 << 63) - 1


def prepare(embeddings: DataFrame, id_column: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``id, label, q``: valid rows, components as whole numbers in doubles."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.filter(F.col(id_column).isNotNull() & F.col(label).isNotNull() & v.isNotNull() & ~bad)
    rows = rows.select(F.col(id_column).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.transform(v, lambda x: F.floor(x * scale).cast("double")).alias("q"))
    return rows.groupBy("id").agg(F.min(F.struct("label", "q")).alias("r")).select("id", "r.label", "r.q")


class Summaries:
    """Sums and deviations of the segments of integer vectors, level by level."""

    def __init__(self, q: np.ndarray):
        self.q = q
        self.norms = np.sqrt((q * q).sum(axis=1))
        self.levels = []
        n, d = q.shape
        for parts in segment_counts(d):
            m = d // parts
            cut = q.reshape(n, parts, m)
            s = cut.sum(axis=2)
            dev = np.sqrt(np.maximum(0.0, m * (cut * cut).sum(axis=2) - s * s))
            self.levels.append((m, s, dev))


def segment_counts(d: int) -> list[int]:
    """1, 2, 4, ... segments of ``d`` components, down to two components each."""
    out = [1]
    while out[-1] * 4 <= d and d % (out[-1] * 2) == 0:
        out.append(out[-1] * 2)
    return out


def padded(d: int) -> int:
    """Components after padding with zeros: a multiple of the largest power of two up to ``d / 2``, of 32 at most."""
    unit = min(32, 1 << max(0, d.bit_length() - 2))
    return -(-max(1, d) // unit) * unit


def as_matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of doubles as rows, padded with zeros."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == sizes[0]).all():
        out[:, :sizes[0]] = flat[offsets[0]:offsets[-1]].reshape(len(column), -1)
    else:
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            out[i, :b - a] = flat[a:b]
    return out


class Search:
    """The best ``k`` rows of one range for each anchor and score window.

    ``same``: rows with the anchor's label (without itself) or with another one."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, k: int, same: bool):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.k, self.same = ids[order], labels[order], k, same
        self.rows = q[order]
        self.blocks = [Summaries(self.rows[i:i + BLOCK]) for i in range(0, len(ids), BLOCK)]
        self.largest = max([0.0, *(b.norms.max(initial=0.0) for b in self.blocks)])
        self.scored = self.paired = 0

    def find(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``low`` and ``high``: scores asked for, one row per anchor, one column per
        window.  Returns arrays (anchor's place, window, row's id, score)."""
        anchors = Summaries(q)
        n, windows = low.shape
        exact = self.largest * anchors.norms.max(initial=0.0) < 2.0**52
        found = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)]   # (anchor, window), score, place of the row
        need = low.astype(float).copy()     # what a score must reach to change the result
        for at, block in enumerate(self.blocks):
            place = at * BLOCK
            labels_here, ids_here = self.labels[place:place + BLOCK], self.ids[place:place + BLOCK]
            live = labels[:, None] == labels_here[None, :]
            live = live & (ids[:, None] != ids_here[None, :]) if self.same else ~live
            self.paired += int(live.sum())
            a, r = self._refine(anchors, block, live, need.min(axis=1), high.max(axis=1))
            if not len(a):
                continue
            self.scored += len(a)
            scores = self._exact(anchors, block, a, r, exact)
            keys, values, places = [found[0]], [found[1]], [found[2]]
            for w in range(windows):
                fits = (scores >= need[a, w]) & (scores <= high[a, w])
                keys.append(a[fits] * windows + w)
                values.append(scores[fits])
                places.append(r[fits] + place)
            found = self._best(np.concatenate(keys), np.concatenate(values), np.concatenate(places))
            key, count = np.unique(found[0], return_counts=True)
            full = key[count == self.k]
            last = np.searchsorted(found[0], full, side="right") - 1
            need[full // windows, full % windows] = found[1][last]
        return found[0] // windows, found[0] % windows, self.ids[found[2]], found[1]

    def _refine(self, anchors: Summaries, block: Summaries, live: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (anchor, row) that the bounds of no level rule out."""
        if np.isneginf(least).all() and np.isposinf(most).all():
            return np.nonzero(live)
        a = r = None
        for (m, s, d), (_, rs, rd) in zip(anchors.levels, block.levels, strict=True):
            if a is None and np.count_nonzero(live) * 8 < live.size:
                a, r = np.nonzero(live)
            if a is None:
                mid, wide = s @ rs.T, d @ rd.T
                slack = 1 + 1e-9 * anchors.norms[:, None] * block.norms[None, :]
                live &= ((mid + wide) / m + slack >= least[:, None]) & ((mid - wide) / m - slack <= most[:, None])
            elif len(a):
                mid, wide = np.einsum("ij,ij->i", s[a], rs[r]), np.einsum("ij,ij->i", d[a], rd[r])
                slack = 1 + 1e-9 * anchors.norms[a] * block.norms[r]
                keep = ((mid + wide) / m + slack >= least[a]) & ((mid - wide) / m - slack <= most[a])
                a, r = a[keep], r[keep]
        return np.nonzero(live) if a is None else (a, r)

    def _exact(self, anchors: Summaries, block: Summaries, a: np.ndarray, r: np.ndarray, exact: bool) -> np.ndarray:
        if exact and len(a) * 8 >= len(anchors.q) * len(block.q):
            return (anchors.q @ block.q.T)[a, r].astype(np.int64)
        if exact:
            return np.einsum("ij,ij->i", anchors.q[a], block.q[r]).astype(np.int64)
        whole = [[[int(x) for x in v] for v in side.q] for side in (anchors, block)]
        return np.array([max(-_TOP, min(_TOP, sum(map(int.__mul__, whole[0][i], whole[1][j])))) for i, j in zip(a, r, strict=True)], np.int64)

    def _best(self, key: np.ndarray, score: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
        """The first ``k`` of each key by score, ties by place (rows lie by id)."""
        order = np.lexsort((place, -score, key))
        key, score, place = key[order], score[order], place[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
        rank = np.arange(len(key)) - np.repeat(starts, np.diff(np.r_[starts, len(key)]))
        keep = rank < self.k
        return [key[keep], score[keep], place[keep]]


_FOUND = "anchor_id long, window int, id long, score long"


def _searcher(k: int, same: bool, width: int):
    """A function over sorted rows of ranges: first a range's rows, then the anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        search, now = None, None
        for batch in batches:
            part, kind = batch.column("range").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])])
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                if part[a] != now:
                    rows, search, now = [], None, part[a]
                piece = batch.slice(a, b - a)
                ids, labels = piece.column("id").to_numpy(), piece.column("label").to_numpy()
                q = as_matrix(piece.column("q"), width)
                if kind[a] == 0:
                    rows.append((ids, labels, q))
                    continue
                if search is None:
                    if not rows:
                        continue    # a range without rows
                    search = Search(*(np.concatenate(x) for x in zip(*rows, strict=True)), k, same)
                    rows = []
                windows = piece.column("windows")
                wide = max(1, max((len(w) for w in windows), default=1))
                low, high = np.full((len(ids), wide), np.inf), np.full((len(ids), wide), -np.inf)
                for i, w in enumerate(windows.to_pylist()):
                    for j, x in enumerate(w):
                        low[i, j], high[i, j] = (-np.inf if x["low"] is None else x["low"]), (np.inf if x["high"] is None else x["high"])
                for i in range(0, len(ids), ANCHORS):
                    j = slice(i, i + ANCHORS)
                    at, window, found, score = search.find(ids[j], labels[j], q[j], low[j], high[j])
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array(ids[j][at]), pa.array(window.astype(np.int32)), pa.array(found), pa.array(score)], ["anchor_id", "window", "id", "score"])

    return run


def search(rows: DataFrame, anchors: DataFrame, k: int, same: bool, width: int, ranges: int) -> DataFrame:
    """``anchor_id, window, id, score, rank``: for each of ``anchors`` (``id, label, q,
    windows``: lists of the lowest and highest score asked for, null: any) and window the first
    ``k`` of ``rows``."""
    spark = rows.sparkSession
    ship_package(spark)
    no_windows = F.lit(None).cast("array<struct<low: long, high: long>>")
    dealt = rows.select(F.pmod(F.xxhash64("id"), F.lit(ranges)).cast("int").alias("range"), F.lit(0).alias("kind"), "id", "label", "q", no_windows.alias("windows"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("range"), F.lit(1).alias("kind"), "id", "label", "q", "windows")
    both = dealt.unionByName(asked).repartition(ranges, "range").sortWithinPartitions("range", "kind", "id")
    with arrow_rows(spark, BATCH):
        best = stage(both.mapInArrow(_searcher(k, same, width), _FOUND))
    w = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def mine(embeddings: DataFrame, anchor_step: int = 100, positives: int = 5, negatives: int = 10, low_pct: int = 30, high_pct: int = 90,
         id_column: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is divisible by ``anchor_step``; their positives
    the first ``positives`` others of their label; the negatives of a positive the
    first ``negatives`` rows of other labels with ``low_pct * p <= 100 * n <= high_pct * p``."""
    rows = stage(prepare(embeddings, id_column, label, vector, scale))
    known = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("d")).first()
    width = padded(known.d or 1)
    ranges = max(1, math.isqrt(known.n) // 16, -(-known.n // RANGE_ROWS))
    any_score = F.array(F.struct(F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high")))
    anchors = rows.filter(F.col("id") % anchor_step == 0)
    best = stage(search(rows, anchors.withColumn("windows", any_score), positives, True, width, ranges))
    p = F.col("score").cast("decimal(38,0)")
    low = F.ceil(p * low_pct / 100).cast("long")
    high = F.floor(p * high_pct / 100).cast("long")
    asked = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score", low.alias("low"), high.alias("high")))).alias("p"))   # at most `positives` of them
    windows = F.transform("p", lambda x: F.struct(x["low"].alias("low"), x["high"].alias("high")))
    asked = asked.select(F.col("anchor_id").alias("id"), windows.alias("windows"))
    found = search(rows, anchors.join(asked, "id"), negatives, False, width, ranges)
    of = best.select("anchor_id", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(of, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
