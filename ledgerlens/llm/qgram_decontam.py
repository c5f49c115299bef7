"""Benchmark decontamination by q-gram lemma filtering (operator 3).

Texts are compared in a normal form: letters and digits in lower case, every run
of other characters as one space.  An item of m characters occurs in a document
if some region is within e = floor(RATE * m) edits of it.  By the q-gram lemma
such a region shares at least m - q + 1 - q*e q-grams with the item, on diagonals
(place in document minus place in item) that lie at most e apart.  So shared
q-grams are counted in bands of 2e + 1 diagonals, each e after the one before: a
span of e + 1 diagonals is always inside one of them.  Bands with too few are
dropped; the regions of the others are verified by banded alignment.

The lemma says something only if q * (e + 1) <= m.  So items have the largest q
of ``QS`` for which that holds (8 for all of 32 characters and more at a RATE of
0.1), and each q has an index of its own; with q = 1 the shortest items are
searched exactly.

The items are indexed on the driver in groups of bounded size and broadcast; a
larger benchmark takes more passes.  Documents are read whole and not shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import ship_package, slices, stage

QS = (8, 4, 2, 1)
RATE = 0.1
#: Characters of items that one broadcast holds (about 24 bytes each).
INDEX_CHARS = 2 << 20
#: Characters that are looked at together in a task.
WINDOW = 2 << 20
TABLE_BITS = 22
BREAK = np.uint32(0xFFFFFFFF)


def _letters() -> np.ndarray:
    """Code point below 2^16 to its lower case, or 0 if neither letter nor digit."""
    out = np.zeros(1 << 16, np.uint32)
    for i in range(1 << 16):
        if 0xD800 <= i < 0xE000:
            continue
        c = chr(i)
        if c.isalnum():
            out[i] = ord(c.lower()[0])
    return out


class Normal:
    """Texts to normal form, with the place in the text of each character."""

    def __init__(self):
        self.letters = _letters()

    def form(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        codes, places = [], []
        before = 1  # the code of the last window's last character, kept or not
        for at in range(0, len(text), WINDOW):
            raw = np.frombuffer(text[at:at + WINDOW].encode("utf-32-le", "surrogatepass"), np.uint32)
            c = self.letters[np.minimum(raw, 0xFFFF)]
            if len(raw) and raw.max() >= 1 << 16:
                c = np.where(raw >= 1 << 16, raw, c)
            keep = c != 0
            # A run's first character stays, as a space; so does a run's that goes on from the last window.
            keep[1:] |= c[:-1] != 0
            keep[0] |= before != 0
            before = c[-1]
            codes.append(c[keep])
            places.append(np.flatnonzero(keep) + at)
        if not codes:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        c, p = np.concatenate(codes), np.concatenate(places)
        return c, p


def strip(codes: np.ndarray) -> np.ndarray:
    """Without a space at either end."""
    real = np.flatnonzero(codes)
    return codes[real[0]:real[-1] + 1] if len(real) else codes[:0]


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 32-bit hash of the q-gram (q: 1, 2, 4 or 8) that begins at each place."""
    if len(codes) < q:
        return np.zeros(0, np.uint32)
    h = codes * np.uint32(0xC2B2AE3D) if q == 1 else codes[:-1] * np.uint32(0x9E3779B1) + codes[1:]
    if q >= 4:
        h = h[:-2] * np.uint32(0x85EBCA77) + h[2:]
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE3D)
    if q == 8:
        h = h[:-4] * np.uint32(0x27D4EB2F) + h[4:]
    return h ^ (h >> np.uint32(13))


def align(item: np.ndarray, text: np.ndarray, lo: int, hi: int, edits: int) -> tuple[int, int, int] | None:
    """Fewest edits that turn ``item`` into a part of ``text``, and that part's
    start and end; None if over ``edits``.  Only cells on diagonals (place in
    text minus place in item) lo..hi are filled.  Of equal parts the first end
    wins, then the last start."""
    m, n, width = len(item), len(text), hi - lo + 1
    big = m + n + 1
    place = np.arange(lo, hi + 1)  # cell j of row i is at place lo + i + j of the text
    letters = np.full(m + width, BREAK)  # letters[k]: the text's at place lo + k
    a, z = max(0, lo), min(n, lo + m + width)
    letters[a - lo:max(z, a) - lo] = text[a:max(z, a)]
    inside = lambda i: (place + i >= 0) & (place + i <= n)
    step = np.arange(width)
    cost, start = np.where(inside(0), 0, big), place.copy()
    for i in range(1, m + 1):
        # Diagonal comes from cell j of the row above, up from its cell j + 1, left from cell j - 1 here.
        new = cost + (letters[i - 1:i - 1 + width] != item[i - 1])
        up = np.append(cost[1:], big) + 1
        use = up < new
        if use.any():
            new = np.where(use, up, new)
            start = np.where(use, np.append(start[1:], 0), start)
        # Left moves: the least of (cost at k) + (j - k) over k <= j.
        slope = new - step
        best = np.minimum.accumulate(slope)
        source = np.maximum.accumulate(np.where(slope == best, step, 0))
        cost, start = np.where(inside(i), best + step, big), start[source]
        if cost.min() > edits:
            return None
    j = int(np.argmin(cost))
    return (int(cost[j]), int(start[j]), lo + m + j) if cost[j] <= edits else None


def same(item: np.ndarray, text: np.ndarray, lo: int, hi: int) -> tuple[int, int, int] | None:
    """As :func:`align` for the first unchanged copy on diagonals lo..hi, the common case."""
    part, whole = text[max(0, lo):max(0, hi) + len(item)].tobytes(), item.tobytes()
    at = part.find(whole)
    while at >= 0 and at % 4:
        at = part.find(whole, at + 1)
    return (0, max(0, lo) + at // 4, max(0, lo) + at // 4 + len(item)) if at >= 0 else None


def budget(m: int, rate: float) -> int:
    """Edits allowed in an item of ``m`` characters; one of them at least stays."""
    return min(int(rate * m), m - 1)


def gram_length(m: int, rate: float) -> int:
    return next(q for q in QS if q * (budget(m, rate) + 1) <= m)


def indexes(items: list[tuple[int | None, str]], rate: float = RATE) -> list[Index]:
    """One index for each q that items need; items without a letter or digit need none."""
    normal = Normal()
    forms = [(i, strip(normal.form(t or "")[0])) for i, t in items]
    need = [gram_length(len(c), rate) if len(c) else 0 for _, c in forms]
    return [Index([f for f, n in zip(forms, need, strict=True) if n == q], q, rate) for q in QS if q in need]


class Index:
    """Items with the places of their q-grams."""

    def __init__(self, forms: list[tuple[int | None, np.ndarray]], q: int, rate: float = RATE):
        self.q, self.ids, self.items = q, [i for i, _ in forms], [c for _, c in forms]
        m = np.array([len(c) for c in self.items], np.int64)
        self.edits = np.array([budget(len(c), rate) for c in self.items], np.int64)
        self.least = m - q + 1 - q * self.edits
        hashes = [gram_hashes(c, q) for c in self.items]
        flat = np.concatenate([np.zeros(0, np.uint32), *hashes])
        order = np.argsort(flat, kind="stable")
        self.hash, first = np.unique(flat[order], return_index=True)
        self.first = np.append(first, len(flat))
        self.item = np.repeat(np.arange(len(m), dtype=np.int32), m - q + 1)[order]
        self.place = np.concatenate([np.zeros(0, np.int32), *(np.arange(len(h), dtype=np.int32) for h in hashes)])[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.hash >> np.uint32(32 - TABLE_BITS)] = True
        self.longest = int((m + 4 * self.edits).max(initial=0)) + q
        self.smallest = int(self.least.min(initial=1))

    @property
    def window(self) -> int:
        """Characters to look at together: short grams are in many places."""
        return WINDOW if self.q == 8 else max(1, WINDOW // 16)

    def regions(self, codes: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
        """(document, item, band) of each band of diagonals in which a document,
        of those that begin at ``starts``, shares enough q-grams with an item."""
        h = gram_hashes(codes, self.q)
        at = np.flatnonzero(self.table[h >> np.uint32(32 - TABLE_BITS)])
        h = h[at]
        k = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        known = self.hash[k] == h
        at, k = at[known], k[known]
        if not len(at):
            return []
        doc = np.searchsorted(starts, at, side="right") - 1
        # A document needs as many hits as the least that any item asks for.
        keep = np.bincount(doc, minlength=len(starts))[doc] >= self.smallest
        at, k, doc = at[keep], k[keep], doc[keep]
        n = self.first[k + 1] - self.first[k]
        entry = np.repeat(self.first[k] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        item, doc = self.item[entry].astype(np.int64), np.repeat(doc, n)
        # An item's q-gram counts once, however often the region repeats it: the lemma is about the item's.
        keep = enough(doc * len(self.ids) + item, self.place[entry], self.least[item])
        item, doc, entry = item[keep], doc[keep], entry[keep]
        diagonal = np.repeat(at, n)[keep] - starts[doc] - self.place[entry]
        stride = np.maximum(self.edits[item], 1)
        band = diagonal // stride
        # Band b holds diagonals b * stride .. b * stride + 2 * edits.
        last = (diagonal == band * stride) & (self.edits[item] > 0)
        bands = 2 * (len(codes) + self.longest) + 4
        base = (doc * len(self.ids) + item) * bands + band + bands // 2
        key = np.concatenate([base, base[self.edits[item] > 0] - 1, base[last] - 2])
        place = self.place[entry]
        place = np.concatenate([place, place[self.edits[item] > 0], place[last]])
        key, count = distinct_places(key, place)
        pair, band = key // bands, key % bands - bands // 2
        good = count >= self.least[pair % len(self.ids)]
        return list(zip((pair // len(self.ids))[good].tolist(), (pair % len(self.ids))[good].tolist(), band[good].tolist(), strict=True))

    def matches(self, codes: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(document, item, start, end, edits), places in the document's normal
        form.  All that pass verification, overlapping ones too."""
        out = set()
        ends = np.append(starts[1:] - 1, len(codes))  # less the break between two documents
        for doc, item, band in self.regions(codes, starts):
            e = int(self.edits[item])
            lo = band * max(e, 1)
            text = codes[starts[doc]:ends[doc]]
            # The path's diagonals lie at most e from those of the q-grams.
            got = same(self.items[item], text, lo - e, lo + 3 * e) or align(self.items[item], text, lo - e, lo + 3 * e, e)
            if got:
                out.add((doc, item, got[1], got[2], got[0]))
        return sorted(out)


def distinct_places(key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys, and with how many different places each occurs."""
    order = np.lexsort((place, key))
    k, p = key[order], place[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    first = np.flatnonzero(new)
    new[1:] |= p[1:] != p[:-1]
    return k[first], np.add.reduceat(new.astype(np.int64), first) if len(k) else first


def enough(key: np.ndarray, place: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which entries' key occurs with at least as many places as asked."""
    keys, count = distinct_places(key, place)
    return count[np.searchsorted(keys, key)] >= least


class Finder:
    def __init__(self, found: list[Index]):
        self.indexes, self.normal = found, Normal()
        self.ids = [i for x in found for i in x.ids]
        self.lengths = [len(c) for x in found for c in x.items]

    def in_texts(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """(item's place in ``ids``, start, end, edits) for each text, places in the
        text as it is; of overlapping ones of an item that with fewest edits, then
        the first.  Texts are looked at together, up to a window of characters at a time."""
        out: list[list] = [[] for _ in texts]
        base = 0
        for index in self.indexes:
            group: list[int] = []
            size = 0
            for i, t in enumerate([*texts, None]):
                if group and (t is None or size + len(t) > index.window):
                    self._group(index, base, texts, group, out)
                    group, size = [], 0
                if t is not None:
                    group.append(i)
                    size += len(t) + 1
            base += len(index.ids)
        return [best(x) for x in out]

    def _group(self, index: Index, base: int, texts: list[str], group: list[int], out: list[list]) -> None:
        forms = [self.normal.form(texts[i]) for i in group]
        if len(group) == 1:
            # A long text goes window by window; windows overlap by the longest region.
            codes, places = forms[0]
            overlap = index.longest
            step = max(index.window, 2 * overlap)
            for at in range(0, max(len(codes), 1), step):
                for _, item, s, t, e in index.matches(codes[at:at + step + overlap], np.zeros(1, np.int64)):
                    out[group[0]].append((base + item, int(places[s + at]), int(places[t + at - 1]) + 1, e))
            return
        gap = np.array([BREAK], np.uint32)
        codes = np.concatenate([x for c, _ in forms for x in (c, gap)])
        starts = np.cumsum([0, *(len(c) + 1 for c, _ in forms[:-1])])
        for doc, item, s, t, e in index.matches(codes[:-1], starts):
            places = forms[doc][1]
            out[group[doc]].append((base + item, int(places[s]), int(places[t - 1]) + 1, e))


def best(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    out: list[tuple[int, int, int, int]] = []
    for m in sorted(set(found), key=lambda m: (m[0], m[3], m[1], m[2])):
        if all(m[0] != o[0] or m[2] <= o[1] or m[1] >= o[2] for o in out):
            out.append(m)
    return sorted(out)


def item_groups(benchmark: DataFrame, index_chars: int, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items in groups of about ``index_chars`` characters, by hash of the text."""
    items = benchmark.select(F.col(id_col).alias("i"), F.coalesce(text_col, F.lit("")).alias("t")).distinct()
    total = items.agg(F.sum(F.length("t")).alias("n")).first().n or 0
    groups = max(1, math.ceil(total / index_chars))
    if groups > 1:
        items = stage(items.withColumn("g", F.pmod(F.xxhash64("t"), F.lit(groups))))
    for g in range(groups):
        mine = items.filter(F.col("g") == g) if groups > 1 else items
        yield [(r.i, r.t) for r in mine.select("i", "t").orderBy("i", "t").collect()]


def find_passages(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, doc_id: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", index_chars: int = INDEX_CHARS) -> DataFrame:
    """Each region of a text within ``rate`` edits per character of a whole item:
    ``doc_id, item_id, start, end`` (code points of the text as it is), ``edits``
    and ``item_chars`` (in normal form).  Overlapping regions of one item count
    once, the one with fewest edits.

    Null texts are empty; items without a letter or digit say nothing and match
    nowhere.  Repeated documents give repeated rows, repeated items one; null ids
    are kept."""
    ship_package(docs.sparkSession)
    doc_type, item_type = docs.schema[doc_id].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    schema = f"`{doc_id}` {doc_type}, `{item_id}` {item_type}, start bigint, end bigint, edits bigint, item_chars bigint"
    out = None
    for items in item_groups(benchmark, index_chars, item_id, item_text):
        index = docs.sparkSession.sparkContext.broadcast(indexes(items, rate))

        def run(batches, index=index):
            finder = Finder(index.value)
            ids, lengths = finder.ids, finder.lengths
            for b in slices(batches):
                names = b.column(0).to_pylist()
                got = finder.in_texts([t or "" for t in b.column(1).to_pylist()])
                rows = [(names[k], ids[m[0]], *m[1:], lengths[m[0]]) for k, ms in enumerate(got) for m in ms]
                if rows:
                    cols = list(zip(*rows, strict=True))
                    types = [b.schema.types[0], pa.infer_type(list(cols[1])) if any(v is not None for v in cols[1]) else pa.int64(), *[pa.int64()] * 4]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [doc_id, item_id, "start", "end", "edits", "item_chars"])

        part = docs.select(doc_id, text_col).mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text",
                      item_id: str = "item_id", item_text: str = "text", index_chars: int = INDEX_CHARS) -> DataFrame:
    """The documents, all columns, in which :func:`find_passages` finds nothing.  No shuffle."""
    ship_package(docs.sparkSession)
    at = docs.columns.index(text_col)
    for items in item_groups(benchmark, index_chars, item_id, item_text):
        index = docs.sparkSession.sparkContext.broadcast(indexes(items, rate))

        def run(batches, index=index):
            finder = Finder(index.value)
            for b in slices(batches):
                clean = [not m for m in finder.in_texts([t or "" for t in b.column(at).to_pylist()])]
                yield b.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
