"""Anomaly detection (M1-M5).

M1 standardisation is one aggregation plus a broadcast one-row table.  M2 is
Spark ML PCA (the d x d covariance is tree-aggregated; d <= ~20).  M3, the
isolation forest (Liu, Ting & Zhou 2008), is not in Spark ML:

* sampling: wallet w belongs to tree t's candidate set when a seeded hash
  u(t, w) < p, p sized so each tree gets about 3 x psi candidates; the psi
  smallest u per tree are kept (a window over a bounded set per tree);
* build: ``groupBy("tree").applyInPandas`` grows one tree per group from at
  most ~3 x psi rows (numpy, seeded per tree);
* score: the forest (trees x <= 2 psi nodes, bounded) is broadcast and every
  partition of wallets is scored with ``mapInPandas`` in Arrow batches.

M5 turns decision values into a 0..1 anomaly score and a flag at the
contamination quantile (exact, distributed).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import config as C
from ledgerlens.operators.ranking import exact_quantile_long
from ledgerlens.session import stage

NON_FEATURES = ("wallet", "first_tx_timestamp", "last_tx_timestamp")


def anomaly_feature_columns(df: DataFrame) -> list:
    """All numeric columns except wallet and the two timestamps (19 of 22)."""
    return [c for c, t in df.dtypes if c not in NON_FEATURES
            and t in ("int", "bigint", "double", "float", "smallint", "tinyint")]


def standardize(df: DataFrame, cols=None, key: str = "wallet") -> DataFrame:
    """(x - mean) / population std per column; constant column -> 0 (M1).  The row of
    statistics is staged, so that each read of the result reads it."""
    cols = cols or anomaly_feature_columns(df)
    st = stage(df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols]))
    j = df.select(key, *cols).crossJoin(F.broadcast(st))   # one row
    z = [F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}"))
          .otherwise(F.lit(0.0)).alias(c) for c in cols]
    return j.select(key, *z)


def pca_components(n_rows: int, n_cols: int, max_components: int = C.MAX_PCA_COMPONENTS) -> int:
    return min(max_components, n_rows - 1, n_cols)


def pca_project(z: DataFrame, cols, k: int, key: str = "wallet"):
    """PCA of standardised columns to ``k`` components -> (key, features
    array<double>), plus the fitted model.  k <= 0 keeps the columns."""
    from pyspark.ml.feature import PCA, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    v = VectorAssembler(inputCols=list(cols), outputCol="_v").transform(z.select(key, *cols))
    if k <= 0:
        return v.select(key, vector_to_array("_v").alias("features")), None
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(v)
    return model.transform(v).select(key, vector_to_array("_p").alias("features")), model


def average_path_length(n) -> float:
    """c(n): average path length of an unsuccessful BST search."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + np.euler_gamma) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.IntegerType()), T.StructField("depth", T.IntegerType())])


def _grow(pdf: pd.DataFrame, seed: int, height_limit: int) -> pd.DataFrame:
    tree = int(pdf["tree"].iloc[0])
    X = np.vstack(pdf.sort_values("u")["features"].to_numpy())
    rng = np.random.default_rng([seed, tree])
    rows = []

    def node(idx, depth):
        nid = len(rows)
        rows.append(None)
        sub = X[idx]
        if depth >= height_limit or len(idx) <= 1:
            rows[nid] = (tree, nid, -1, 0.0, -1, -1, len(idx), depth)
            return nid
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if cand.size == 0:
            rows[nid] = (tree, nid, -1, 0.0, -1, -1, len(idx), depth)
            return nid
        f = int(rng.choice(cand))
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < thr
        left = node(idx[go_left], depth + 1)
        right = node(idx[~go_left], depth + 1)
        rows[nid] = (tree, nid, f, thr, left, right, -1, depth)
        return nid

    node(np.arange(len(X)), 0)
    return pd.DataFrame(rows, columns=[f.name for f in NODE_SCHEMA.fields])


def fit_isolation_forest(points: DataFrame, n_rows: int, n_trees: int = C.N_TREES, max_samples: int = 256,
                         seed: int = C.SEED, key: str = "wallet") -> DataFrame:
    """Node table of an isolation forest over (key, features array)."""
    psi = min(max_samples, n_rows)
    p = min(1.0, 3.0 * psi / max(n_rows, 1))
    height = int(math.ceil(math.log2(max(psi, 2))))
    u = lambda t: (F.pmod(F.xxhash64(F.lit(seed), t, F.col(key)), F.lit(1 << 53))
                   .cast("double") / F.lit(float(1 << 53)))
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: u(t) < F.lit(p))
    cand = points.select(key, "features", F.explode(trees).alias("tree")).withColumn("u", u(F.col("tree")))
    from pyspark.sql import Window
    w = Window.partitionBy("tree").orderBy("u", key)
    sample = cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= psi).drop("_r")
    from ledgerlens.session import ship_package
    ship_package(points.sparkSession)
    return (sample.select("tree", "u", "features")
                  .groupBy("tree").applyInPandas(lambda pdf: _grow(pdf, seed, height), NODE_SCHEMA))


def _forest_arrays(nodes: pd.DataFrame):
    trees = []
    for _, g in nodes.groupby("tree"):
        g = g.sort_values("node")
        trees.append((g["feature"].to_numpy(), g["threshold"].to_numpy(), g["left"].to_numpy(),
                      g["right"].to_numpy(), g["size"].to_numpy(), g["depth"].to_numpy()))
    return trees


def score_isolation_forest(points: DataFrame, nodes: DataFrame, psi: int, key: str = "wallet") -> DataFrame:
    """(key, score) with score = -2^(-E[h]/c(psi)) (higher = more normal, like
    scikit-learn's ``score_samples``).  The forest is collected (bounded:
    trees x <= 2 psi nodes) and broadcast."""
    spark = points.sparkSession
    from ledgerlens.session import ship_package
    ship_package(spark)
    forest = spark.sparkContext.broadcast(_forest_arrays(nodes.toPandas()))
    c_psi = float(average_path_length([psi])[0])

    def run(batches):
        trees = forest.value
        for pdf in batches:
            X = np.vstack(pdf["features"].to_numpy()) if len(pdf) else np.zeros((0, 1))
            depth_sum = np.zeros(len(pdf))
            for feat, thr, left, right, size, dep in trees:
                cur = np.zeros(len(pdf), dtype=np.int64)
                while True:
                    inner = feat[cur] >= 0
                    if not inner.any():
                        break
                    i = np.flatnonzero(inner)
                    go_left = X[i, feat[cur[i]]] < thr[cur[i]]
                    cur[i] = np.where(go_left, left[cur[i]], right[cur[i]])
                depth_sum += dep[cur] + average_path_length(size[cur])
            eh = depth_sum / len(trees)
            yield pd.DataFrame({key: pdf[key].to_numpy(), "score": -np.power(2.0, -eh / c_psi)})

    return points.select(key, "features").mapInPandas(run, f"{key} string, score double")


def rescale_decision(dec: DataFrame, decision: str = "decision", key: str = "wallet") -> DataFrame:
    """anomaly_score = 1 - (d - min) / (max - min + 1e-10);
    is_anomaly = d < 0."""
    st = dec.agg(F.min(decision).alias("_mn"), F.max(decision).alias("_mx"))
    d = F.col(decision)
    return (dec.crossJoin(F.broadcast(st))
               .select(key, (F.lit(1.0) - (d - F.col("_mn")) / (F.col("_mx") - F.col("_mn") + F.lit(1e-10)))
                       .alias("anomaly_score"), (d < 0).alias("is_anomaly")))


def scores_from_labels(labels: DataFrame, label: str = "label", key: str = "wallet") -> DataFrame:
    """P18's fallback for a model that only says -1 (anomalous) or 1: score 0.9 or 0.1."""
    bad = F.col(label) == -1
    return labels.select(key, F.when(bad, F.lit(0.9)).otherwise(F.lit(0.1)).alias("anomaly_score"), bad.alias("is_anomaly"))


def anomaly_counts(anomalies: DataFrame) -> DataFrame:
    """One row: wallets and flagged wallets."""
    return anomalies.agg(F.count(F.lit(1)).alias("wallets"), F.count_if("is_anomaly").alias("anomalies"))


def decision_from_scores(scores: DataFrame, contamination: float = C.CONTAMINATION,
                         score: str = "score", key: str = "wallet") -> DataFrame:
    """decision = score - offset, offset = the contamination quantile of the
    scores (exact, linear interpolation, distributed).  The scores are read
    several times, so they and the offset are staged: a forest scores once."""
    scores = stage(scores.select(key, score))
    q = stage(exact_quantile_long(scores.select(F.lit("all").alias("_g"), F.col(score).alias("_v")), "_g", "_v",
                                  contamination))
    return (scores.crossJoin(F.broadcast(q.select(F.col("quantile").alias("_off"))))   # one row
                  .select(key, (F.col(score) - F.col("_off")).alias("decision")))


def detect_anomalies(features: DataFrame, n_rows: int, n_trees: int = C.N_TREES, seed: int = C.SEED,
                     contamination: float = C.CONTAMINATION, key: str = "wallet") -> DataFrame:
    """Whole M1 -> M2 -> M3 -> M5 chain: (wallet, anomaly_score, is_anomaly).
    ``n_rows`` is the wallet count (from the staged feature table)."""
    cols = anomaly_feature_columns(features)
    z = standardize(features, cols, key)
    pts, _ = pca_project(z, cols, pca_components(n_rows, len(cols)), key)
    pts = stage(pts)
    nodes = fit_isolation_forest(pts, n_rows, n_trees, 256, seed, key)
    psi = min(256, n_rows)
    sc = score_isolation_forest(pts, nodes, psi, key)
    return rescale_decision(decision_from_scores(sc, contamination, "score", key), "decision", key)


def pca_spectrum(z: DataFrame, cols, key: str = "wallet") -> DataFrame:
    """One row, from the variances of all principal components: ``components``
    (their number), ``total`` (their sum, the trace of the covariance matrix) and
    ``squares`` (the sum of their squares, that of all its entries)."""
    pts, _ = pca_project(z, cols, len(cols), key)
    wide = pts.agg(F.array(*[F.var_samp(F.col("features")[i]) for i in range(len(cols))]).alias("v"))
    add = lambda f: F.aggregate("v", F.lit(0.0), lambda a, x: a + f(x))
    return wide.select(F.size("v").alias("components"), add(lambda x: x).alias("total"), add(lambda x: x * x).alias("squares"))


# ---------------------------------------------------------------------- S16
@dataclass
class AnomalyModel:
    """A fitted M1 -> M2 -> M3 -> M5 chain that scores wallets it was not fitted on.

    ``scale``: one row of means and deviations; ``pca``: Spark ML model or None;
    ``nodes``: the forest; ``cut``: one row, the contamination quantile of the
    scores and the range of the decisions it was fitted on."""

    columns: list
    scale: DataFrame
    pca: object
    nodes: DataFrame
    psi: int
    cut: DataFrame

    def decisions(self, features: DataFrame, key: str = "wallet") -> DataFrame:
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array
        j = features.select(key, *self.columns).crossJoin(F.broadcast(self.scale))   # one row
        z = [F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).otherwise(F.lit(0.0)).alias(c) for c in self.columns]
        v = VectorAssembler(inputCols=list(self.columns), outputCol="_v").transform(j.select(key, *z))
        v = v.withColumnRenamed("_v", "_p") if self.pca is None else self.pca.transform(v)
        scores = score_isolation_forest(v.select(key, vector_to_array("_p").alias("features")), self.nodes, self.psi, key)
        return scores.crossJoin(F.broadcast(self.cut)).withColumn("decision", F.col("score") - F.col("offset"))   # one row

    def score(self, features: DataFrame, key: str = "wallet") -> DataFrame:
        """``wallet, anomaly_score, is_anomaly``; wallets beyond the fitted range are held at 0 and 1."""
        part = (F.col("decision") - F.col("low")) / (F.col("high") - F.col("low") + F.lit(1e-10))
        return self.decisions(features, key).select(key, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - part)).alias("anomaly_score"),
                                                    (F.col("decision") < 0).alias("is_anomaly"))

    def save(self, path: str) -> None:
        """One folder: statistics, nodes and settings as Parquet, the PCA by Spark ML's writer."""
        path = path.rstrip("/")
        spark = self.scale.sparkSession
        settings = spark.createDataFrame([(list(self.columns), self.psi, self.pca is not None)], "columns array<string>, psi int, pca boolean")
        for name, table in (("scale", self.scale), ("nodes", self.nodes), ("cut", self.cut), ("settings", settings)):
            table.write.mode("overwrite").parquet(f"{path}/{name}")
        if self.pca is not None:
            self.pca.write().overwrite().save(f"{path}/pca")

    @classmethod
    def load(cls, spark, path: str) -> AnomalyModel:
        from pyspark.ml.feature import PCAModel
        path = path.rstrip("/")
        read = lambda name: spark.read.parquet(f"{path}/{name}")
        s = read("settings").first()
        return cls(list(s.columns), read("scale"), PCAModel.load(f"{path}/pca") if s.pca else None, read("nodes"), s.psi, read("cut"))


def fit_anomaly_model(features: DataFrame, n_rows: int, n_trees: int = C.N_TREES, seed: int = C.SEED,
                      contamination: float = C.CONTAMINATION, key: str = "wallet") -> AnomalyModel:
    """Fit the chain of :func:`detect_anomalies` and keep it."""
    cols = anomaly_feature_columns(features)
    scale = stage(features.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols]))
    pts, pca = pca_project(standardize(features, cols, key), cols, pca_components(n_rows, len(cols)), key)
    pts = stage(pts)
    nodes = stage(fit_isolation_forest(pts, n_rows, n_trees, 256, seed, key))
    psi = min(256, n_rows)
    scores = stage(score_isolation_forest(pts, nodes, psi, key))
    q = exact_quantile_long(scores.select(F.lit("all").alias("_g"), F.col("score").alias("_v")), "_g", "_v", contamination)
    cut = scores.agg(F.min("score").alias("_lo"), F.max("score").alias("_hi")).crossJoin(F.broadcast(q.select(F.col("quantile").alias("offset"))))   # one row each
    cut = stage(cut.select("offset", (F.col("_lo") - F.col("offset")).alias("low"), (F.col("_hi") - F.col("offset")).alias("high")))
    return AnomalyModel(cols, scale, pca, nodes, psi, cut)


# ---------------------------------------------------------------------- M4
def rbf_gamma_scale(points: DataFrame) -> float:
    """gamma='scale' = 1 / (d * variance of all feature entries), one aggregation."""
    s = points.select(F.size("features").alias("d"),
                      F.aggregate("features", F.lit(0.0), lambda a, x: a + x).alias("s1"),
                      F.aggregate("features", F.lit(0.0), lambda a, x: a + x * x).alias("s2")) \
              .agg(F.first("d").alias("d"), F.sum("d").alias("m"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2")).first()
    var = s["s2"] / s["m"] - (s["s1"] / s["m"]) ** 2
    return 1.0 / (s["d"] * var) if var > 0 else 1.0


def fourier_features(points: DataFrame, gamma: float, n_components: int = 100, seed: int = C.SEED,
                     key: str = "wallet") -> DataFrame:
    """Random Fourier features of the RBF kernel (Rahimi & Recht 2007):
    z(x) = sqrt(2/D) cos(x W + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi)."""
    from ledgerlens.session import ship_package
    ship_package(points.sparkSession)
    d = len(points.select("features").first()[0])
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, math.sqrt(2.0 * gamma), (d, n_components))
    b = rng.uniform(0.0, 2.0 * math.pi, n_components)
    scale = math.sqrt(2.0 / n_components)

    def run(batches):
        for pdf in batches:
            X = np.vstack(pdf["features"].to_numpy()) if len(pdf) else np.zeros((0, d))
            Z = scale * np.cos(X @ W + b)
            yield pd.DataFrame({key: pdf[key].to_numpy(), "z": list(Z)})

    return points.select(key, "features").mapInPandas(run, f"{key} string, z array<double>")


def fit_one_class_svm(z: DataFrame, nu: float = C.CONTAMINATION, steps: int = 40, lr: float = 0.5):
    """Primal one-class SVM on random features:
    min 1/2 |w|^2 + 1/(nu n) sum max(0, rho - w.z) - rho, by subgradient
    descent.  Each step is one distributed pass (per-partition numpy partial
    sums of the violators, a bounded #partitions x (D+2) result).  Returns
    (w, rho)."""
    from ledgerlens.session import ship_package
    ship_package(z.sparkSession)
    first = z.select("z").first()
    D = len(first[0])
    w, rho = np.zeros(D), 0.0
    n = z.count()

    def partial(w_, rho_):
        def run(batches):
            s, c = np.zeros(D), 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                Z = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, D)
                viol = Z @ w_ < rho_
                s += Z[viol].sum(axis=0)
                c += int(viol.sum())
            yield pa.RecordBatch.from_pydict({"s": [s.tolist()], "c": [c]}, pa.schema([("s", pa.list_(pa.float64())), ("c", pa.int64())]))
        return run

    for t in range(1, steps + 1):
        parts = z.select("z").mapInArrow(partial(w.copy(), rho), "s array<double>, c long").collect()
        s = np.sum([np.asarray(p["s"]) for p in parts], axis=0)
        c = sum(p["c"] for p in parts)
        gw = w - s / (nu * n)
        grho = -1.0 + c / (nu * n)
        eta = lr / math.sqrt(t)
        w, rho = w - eta * gw, rho - eta * grho
    return w, rho


def one_class_svm_decision(z: DataFrame, w, rho: float | None = None, nu: float = C.CONTAMINATION,
                           key: str = "wallet") -> DataFrame:
    """decision = w.z - rho (negative = outlier), like ``decision_function``.
    With ``rho=None`` the offset is set by its optimality condition: the exact
    nu-quantile of w.z (so a nu share of the wallets are outliers)."""
    wl = F.array(*[F.lit(float(x)) for x in w])
    dot = F.aggregate(F.zip_with("z", wl, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    scores = z.select(key, dot.alias("score"))
    if rho is not None:
        return scores.select(key, (F.col("score") - F.lit(float(rho))).alias("decision"))
    return decision_from_scores(scores, nu, "score", key)


def detect_anomalies_svm(features: DataFrame, n_rows: int, nu: float = C.CONTAMINATION, n_components: int = 100,
                         steps: int = 40, seed: int = C.SEED, key: str = "wallet") -> DataFrame:
    """M1 -> M2 -> M4 -> P18: (wallet, anomaly_score, is_anomaly)."""
    cols = anomaly_feature_columns(features)
    pts, _ = pca_project(standardize(features, cols, key), cols, pca_components(n_rows, len(cols)), key)
    pts = stage(pts)
    z = stage(fourier_features(pts, rbf_gamma_scale(pts), n_components, seed, key))
    w, _rho = fit_one_class_svm(z, nu, steps)
    return rescale_decision(one_class_svm_decision(z, w, None, nu, key), "decision", key)
