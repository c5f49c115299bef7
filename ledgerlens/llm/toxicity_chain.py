"""Toxicity by a classifier chain (operator 6).

Categories are predicted one after the other by logistic models.  Each model
sees the text's features and the log-odds of the categories before it.  While
training, those come from models that were fitted without the row's fold, so a
later model meets the errors it will meet on new texts; for use, each category's
model is then fitted on all training rows.

Features are words and their first 4 to 7 characters, in lower case.  Those whose
presence differs most between a category's classes are kept for its model; each
gives two numbers, whether it occurs and log(1 + occurrences per 100 words), since
in a long text a part of a word may be there by chance.  Both are scaled by the
log ratio of the feature's shares in the two classes, so that the penalty weighs
less on features that tell the classes apart; that helps where labels are few.

Fitting uses a bounded sample of the labelled rows, ``SAMPLE_ROWS`` for each
class of the last category, weighted back to the classes' shares.  All documents
are scored, whole, in one pass without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import ship_package, slices, stage

#: (name, label column, value that means yes), in the order of the chain; the last one decides.
CATEGORIES = (("low_quality", "quality", 0), ("toxic", "toxic", 1))
SAMPLE_ROWS = 5_000
FEATURES = 150
MIN_DOCS = 3
FOLDS = 5
RIDGE = 1.0
THRESHOLD = 0.4
MAX_WORDS = 100_000
WORD = re.compile(r"\w+")


def word_features(word: str) -> list[str]:
    return [f"={word}", *(f"^{word[:k]}" for k in (4, 5, 6, 7) if len(word) >= k)]


class Extractor(dict):
    """Word to the numbers of the kept features it has; what a word has is remembered."""

    def __init__(self, features: list[str]):
        super().__init__()
        self.number = {f: i for i, f in enumerate(features)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        got = tuple(self.number[f] for f in word_features(word) if f in self.number)
        if len(self) >= MAX_WORDS:
            self.clear()
        self[word] = got
        return got

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of the text's entries that aren't 0."""
        words = WORD.findall((text or "").lower())
        count = Counter(i for has in map(self.__getitem__, words) if has for i in has)
        if not count:
            return np.zeros(0, np.int64), np.zeros(0)
        at = np.array(sorted(count), np.int64)
        n = np.array([count[i] for i in at.tolist()], float)
        return np.concatenate([at, at + len(self.number)]), np.concatenate([np.ones(len(at)), np.log1p(100 * n / len(words))])


def _blocks(x: np.ndarray, rows: int = 1024):
    for i in range(0, len(x), rows):
        yield slice(i, i + rows), x[i:i + rows].astype(np.float64)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, scale: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Coefficients for the columns of ``x`` by Newton's method, with a ridge
    penalty on those of the columns times ``scale``; columns of scale 0 get none.
    The last column is all ones, and its coefficient, the intercept, isn't
    penalised.  Rows of weight 0 don't count.  Besides ``x`` it holds a block of
    rows and a square of columns."""
    used = np.flatnonzero(scale)
    s = scale[used]
    penalty = np.full(len(used), ridge)
    penalty[-1] = 1e-6
    w = np.zeros(len(used))

    def loss(w):
        z = np.concatenate([b[:, used] @ (w * s) for _, b in _blocks(x)])
        return float(weight @ (np.logaddexp(0, z) - y * z) + penalty @ w**2 / 2)

    now = loss(w)
    for _ in range(50):
        gradient, hessian = penalty * w, np.diag(penalty)
        for at, b in _blocks(x):
            b = b[:, used] * s
            p = 1 / (1 + np.exp(-np.clip(b @ w, -30, 30)))
            gradient += b.T @ (weight[at] * (p - y[at]))
            hessian += (b * (weight[at] * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ b
        step, rate = np.linalg.solve(hessian, gradient), 1.0
        while (new := loss(w - rate * step)) > now and rate > 1e-6:
            rate /= 2
        if rate <= 1e-6:
            break
        w, done, now = w - rate * step, now - new < 1e-7 * (1 + abs(now)), new
        if done:
            break
    out = np.zeros(x.shape[1])
    out[used] = w * s
    return out


def log_odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(np.concatenate([b @ w for _, b in _blocks(x)] or [np.zeros(0)]), -20, 20)


@dataclass
class Chain:
    """``models[c]``: coefficients of the features, of the log-odds (a quarter of
    them, to be of the features' size) of the categories before c, and the intercept."""

    features: list[str]
    names: list[str]
    models: list[np.ndarray] = field(default_factory=list)

    @property
    def width(self) -> int:
        return 2 * len(self.features) + len(self.names) + 1

    def matrix(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Features first, then a column for each category, then ones."""
        x = np.zeros((len(vectors), self.width), np.float32)
        for row, (at, value) in zip(x, vectors, strict=True):
            row[at] = value
        x[:, -1] = 1
        return x

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, fold: np.ndarray, scales: list[dict[str, float]]) -> Chain:
        """``scales``: for each category its features and their scales."""
        for c in range(len(self.names)):
            own = np.array([scales[c].get(f, 0.0) for f in self.features])
            before = np.arange(len(self.names)) < c
            scale = np.concatenate([own, own, before.astype(float), [1.0]])
            self.models.append(fit_logistic(x, y[:, c], weight, scale))
            for k in range(FOLDS):
                out = fold == k
                if out.any() and (~out).any():
                    w = fit_logistic(x, y[:, c], weight * ~out, scale)
                    x[out, c - len(self.names) - 1] = log_odds(x[out], w) / 4
        return self

    def probabilities(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        x, out = self.matrix(vectors), np.zeros((len(vectors), len(self.names)))
        for c, w in enumerate(self.models):
            out[:, c] = log_odds(x, w)
            x[:, c - len(self.names) - 1] = out[:, c] / 4
        return 1 / (1 + np.exp(-out))


def training_sample(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, rows: int = SAMPLE_ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, text, y (array), weight, fold``: labelled documents, by hash of the id about ``rows`` of
    each class of the last category at most.  Rows without an id, text or one of
    the labels are left out; of repeated labels one is taken, the least, of documents with
    one id that whose text has the least hash."""
    y = [F.when(F.col(c).isNotNull(), (F.col(c) == v).cast("int")) for _, c, v in categories]
    # 1e9 buckets: fine enough for any share.
    lab = (labels.select(F.col(id_col).alias("_id"), F.array(*y).alias("y"))
           .filter(F.col("_id").isNotNull() & F.forall("y", lambda v: v.isNotNull()))
           .groupBy("_id").agg(F.min("y").alias("y"))
           .withColumn("_hash", F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1_000_000_000))))
    last = F.element_at("y", -1)
    n = {r.c: r.n for r in lab.groupBy(last.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {c: min(1.0, rows / n[c]) if n.get(c) else 1.0 for c in (0, 1)}
    rate = F.when(last == 1, F.lit(share[1])).otherwise(F.lit(share[0]))
    picked = (lab.filter(F.col("_hash") < rate * 1_000_000_000)
              .select("_id", "y", (1 / rate).alias("weight"), F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(FOLDS)).alias("fold")))
    # About 2 * rows rows of a few numbers, whatever the tables' size.
    joined = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).filter("text is not null")
              .join(F.broadcast(picked), "_id"))
    # Documents that share an id count once, so the sample is bounded in rows too.
    return (joined.groupBy("_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), *[F.first(c).alias(c) for c in ("y", "weight", "fold")]))


def choose_features(sample: DataFrame, n_categories: int, per_category: int = FEATURES) -> list[dict[str, float]]:
    """For each category the features whose presence differs most between its
    classes, by the score of a two-sample test of proportions (equal scores by
    name), and their scales."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        yes: list[Counter] = [Counter() for _ in range(n_categories)]

        def rows():
            keys = list(total)
            out = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([total[k] for k in keys], pa.int64()),
                                              pa.array([[c[k] for c in yes] for k in keys], pa.list_(pa.int64()))], ["feature", "n", "yes"])
            total.clear(), [c.clear() for c in yes]
            return out

        for b in slices(batches):
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                has = {f for w in set(WORD.findall(text.lower())) for f in word_features(w)}
                total.update(has)
                for c, v in zip(yes, y, strict=True):
                    if v:
                        c.update(has)
            if len(total) > 500_000:
                yield rows()
        yield rows()

    counts = stage(sample.select("text", "y").mapInArrow(run, "feature string, n bigint, yes array<bigint>")
                   .groupBy("feature").agg(F.sum("n").alias("n"), *(F.sum(F.col("yes")[c]).alias(f"y{c}") for c in range(n_categories)))
                   .filter(F.col("n") >= MIN_DOCS))
    totals = sample.agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col("y")[c]).alias(f"y{c}") for c in range(n_categories))).first()
    out: list[dict[str, float]] = []
    for c in range(n_categories):
        out.append({})
        n1, n0 = totals[f"y{c}"] or 0, totals.n - (totals[f"y{c}"] or 0)
        if n1 and n0:
            a, b, p = F.col(f"y{c}") / n1, (F.col("n") - F.col(f"y{c}")) / n0, F.col("n") / totals.n
            score = F.abs(a - b) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / n1 + 1 / n0))
            best = counts.select("feature", "n", f"y{c}", F.round(score, 9).alias("s")).orderBy(F.desc("s"), "feature").limit(5 * per_category).collect()
            # A word and its beginnings that have the same counts say the same: the first by name stands for them.
            alike = dict.fromkeys((r.n, r[f"y{c}"], r.feature[1:5]) for r in best)
            for k in list(alike)[:per_category]:
                f = next(r.feature for r in best if (r.n, r[f"y{c}"], r.feature[1:5]) == k)
                out[c][f] = abs(math.log((k[1] + 1) / (n1 + 2) * (n0 + 2) / (k[0] - k[1] + 1)))
    return out


def train(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, rows: int = SAMPLE_ROWS, features: int = FEATURES,
          id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """Fit a chain.  Without labelled documents all probabilities are 0; a
    category with one class only is always near that class."""
    ship_package(docs.sparkSession)
    names = [n for n, _, _ in categories]
    sample = stage(training_sample(docs, labels, categories, rows, id_col, text_col))
    scales = choose_features(sample, len(names), features)
    kept = sorted({f for own in scales for f in own})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Extractor(kept)
        for b in slices(batches):
            got = [extract.vector(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([a for a, _ in got], pa.list_(pa.int64())), pa.array([v for _, v in got], pa.list_(pa.float64())), *b.columns[2:]],
                                             ["_id", "at", "value", "y", "weight", "fold"])

    kind = docs.schema[id_col].dataType.simpleString()
    data = (sample.select("_id", "text", "y", "weight", "fold")
            .mapInArrow(run, f"_id {kind}, at array<bigint>, value array<double>, y array<int>, weight double, fold bigint").toArrow())
    # Rows arrive in any order; a set order gives the same model each time.
    columns = [data.column(c).to_pylist() if c in ("_id", "y", "weight", "fold") else [v.values.to_numpy() for v in data.column(c)]
               for c in ("_id", "at", "value", "y", "weight", "fold")]
    rows = sorted(zip(*columns, strict=True), key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))
    if not rows:
        return Chain([], names, [np.append(np.zeros(len(names)), -20.0) for _ in names])
    chain = Chain(kept, names)
    x = chain.matrix([(r[1], r[2]) for r in rows])
    y = np.array([r[3] for r in rows], float).reshape(len(rows), len(names))
    return chain.fit(x, y, np.array([r[4] for r in rows], float), np.array([r[5] for r in rows]), scales)


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``id_col``, a probability ``p_<category>`` each, and ``rejected`` (the
    last category's is at least ``threshold``), a row for each document.  A null
    text has no features, like an empty one."""
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{n}" for n in chain.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Extractor(model.value.features)
        for b in slices(batches):
            p = model.value.probabilities([extract.vector(t) for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(p[:, c]) for c in range(len(names))), pa.array(p[:, -1] >= threshold)], [id_col, *names, "rejected"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{n} double" for n in names) + ", rejected boolean")


def drop_toxic(docs: DataFrame, chain: Chain, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, that the chain doesn't reject."""
    ship_package(docs.sparkSession)
    model, at = docs.sparkSession.sparkContext.broadcast(chain), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Extractor(model.value.features)
        for b in slices(batches):
            p = model.value.probabilities([extract.vector(t) for t in b.column(at).to_pylist()])
            yield b.filter(pa.array(p[:, -1] < threshold))

    return docs.mapInArrow(run, docs.schema)
