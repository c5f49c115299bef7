"""Feature selection.

Rankings are single aggregations over the training frame (one row of
statistics, then stacked to long form); model-based rankings use Spark ML.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.functions.columns import safe_corr
from ledgerlens.operators.ranking import value_positions
from ledgerlens.session import stage

#: Columns that a pass over pairs takes at a time.
PAIR_BLOCK = 10
TIMESTAMPS = ("first_tx_timestamp", "last_tx_timestamp")


def training_frame(features: DataFrame, scored: DataFrame, label: str = "raw_score",
                   selected=None, key: str = "wallet") -> DataFrame:
    """Features INNER JOIN target (J5, M6): NULL -> 0, timestamps dropped,
    optionally restricted to selected features that exist (F8)."""
    cols = [c for c, t in features.dtypes if c != key and c not in TIMESTAMPS
            and t in ("int", "bigint", "double", "float", "smallint", "tinyint")]
    if selected is not None:
        cols = [c for c in cols if c in set(selected)]
    f = features.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    y = scored.select(key, F.col(label).cast("double").alias("label"))
    return f.join(y, key, "inner").fillna(0.0, ["label"])


def feature_columns(train: DataFrame, key: str = "wallet", label: str = "label") -> list:
    return [c for c in train.columns if c not in (key, label)]


def _stack(wide: DataFrame, names, value: str) -> DataFrame:
    st = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias(value)) for n in names]))
    return wide.select(st.alias("s")).select("s.*")


def correlation_ranking(train: DataFrame, threshold: float = 0.1) -> DataFrame:
    """(feature, correlation, abs_correlation, rank, selected) by |r|."""
    cols = feature_columns(train)
    wide = train.agg(*[safe_corr(c, "label").alias(c) for c in cols])
    long = _stack(wide, cols, "correlation").withColumn("abs_correlation", F.abs("correlation"))
    # d rows; ranked on 12 digits so last-bit noise of floating sums cannot split ties
    w = Window.orderBy(F.round("abs_correlation", 12).desc_nulls_last(), F.col("feature"))
    return long.withColumn("rank", F.row_number().over(w).cast("long")) \
               .withColumn("selected", F.coalesce(F.col("abs_correlation") >= threshold, F.lit(False)))


def rank_bins(long: DataFrame, bins: int) -> DataFrame:
    """(feature, value, bin) from a long (feature, value) table: ``bins`` bins of
    equal counts by minimum rank, so a monotone change of a feature changes
    nothing and equal values share a bin."""
    p = value_positions(long, "value", ["feature"])
    return p.select("feature", "value", F.floor((F.col("pos") - 1) * bins / F.col("n")).cast("int").alias("bin"))


def mutual_info_ranking(train: DataFrame, bins: int = 10) -> DataFrame:
    """Mutual information with the label (M8) over bins of equal counts:
    MI = sum p(x,y) ln(p(x,y) / (p(x) p(y)))."""
    cols = feature_columns(train)
    stacked = lambda df, names, *keep: df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in names])).alias("s")).select(*keep, "s.*")
    binned = stage(rank_bins(stacked(train, [*cols, "label"]), bins))
    label = binned.where(F.col("feature") == "label").select(F.col("value").alias("label"), F.col("bin").alias("yb"))
    t = stacked(train.join(label, "label"), cols, "yb")
    long = t.join(binned, ["feature", "value"]).select("feature", F.col("bin").alias("xb"), "yb")
    joint = long.groupBy("feature", "xb", "yb").agg(F.count(F.lit(1)).alias("nxy"))
    wf = Window.partitionBy("feature")
    joint = (joint.withColumn("n", F.sum("nxy").over(wf))
                  .withColumn("nx", F.sum("nxy").over(Window.partitionBy("feature", "xb")))
                  .withColumn("ny", F.sum("nxy").over(Window.partitionBy("feature", "yb"))))
    term = (F.col("nxy") / F.col("n")) * F.log((F.col("nxy") * F.col("n")) / (F.col("nx") * F.col("ny")))
    mi = joint.groupBy("feature").agg(F.sum(term).alias("mutual_info"))
    w = Window.orderBy(F.round("mutual_info", 12).desc(), F.col("feature"))
    return mi.withColumn("rank", F.row_number().over(w).cast("long"))


def _assemble(train: DataFrame, cols):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(train)


def rf_importance(train: DataFrame, cols=None, n_trees: int = 100, max_depth: int = 10,
                  seed: int = C.SEED) -> DataFrame:
    """Random-forest feature importances (M9): (feature, importance, rank)."""
    from pyspark.ml.regression import RandomForestRegressor
    cols = cols or feature_columns(train)
    m = RandomForestRegressor(numTrees=n_trees, maxDepth=max_depth, seed=seed, labelCol="label", **C.FOREST_PASSES) \
        .fit(_assemble(train, cols))
    imp = m.featureImportances.toArray().tolist()       # d numbers
    spark = train.sparkSession
    df = spark.createDataFrame([(c, float(v)) for c, v in zip(cols, imp)], "feature string, importance double")
    return df.withColumn("rank", F.row_number().over(Window.orderBy(F.col("importance").desc(), F.col("feature")))
                         .cast("long"))


def alike_rows(train: DataFrame, cols) -> DataFrame:
    """``train`` with the rows of each partition sorted by ``cols``, those of few values
    first.  A forest adds a row to one node of each of its trees; rows that are alike
    go the same ways, so the next one meets nodes that are still in the processor's
    cache.  No row changes its partition; a table of one partition stays as it is,
    and so do its bootstrap samples, which are drawn by the place of a row."""
    if train.rdd.getNumPartitions() == 1:
        return train
    values = train.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    return train.sortWithinPartitions(*sorted(cols, key=lambda c: values[c]), "label")


def _forest_rows(train: DataFrame) -> DataFrame:
    """Label and features as forests read them, persisted: sorted once for all fits."""
    from pyspark import StorageLevel
    cols = feature_columns(train)
    return alike_rows(train.select("label", *cols), cols).persist(StorageLevel.MEMORY_AND_DISK)


def recursive_elimination(train: DataFrame, n_features: int = 10, n_trees: int = 100, max_depth: int = 10,
                          seed: int = C.SEED, first: DataFrame | None = None) -> list:
    """RFE with step 1 (M11): refit the forest, drop the least important, until
    ``n_features`` remain.  Driver loop of d - k distributed fits; ``first`` is the
    importances of all columns with these settings where they are known already."""
    base = _forest_rows(train)      # read once for all fits
    try:
        return _eliminate(base, n_features, n_trees, max_depth, seed, first)
    finally:
        base.unpersist()


def _eliminate(base: DataFrame, n_features: int, n_trees: int = 100, max_depth: int = 10, seed: int = C.SEED,
               first: DataFrame | None = None) -> list:
    cols = feature_columns(base)
    while len(cols) > n_features:
        ranked, first = first if first is not None else rf_importance(base, cols, n_trees, max_depth, seed), None
        imp = ranked.orderBy("importance", F.col("feature").desc()).first()
        cols = [c for c in cols if c != imp["feature"]]
    return cols


def pair_correlations(train: DataFrame, cols=None) -> DataFrame:
    """(feature_a, feature_b, correlation) for each pair of columns, a before b
    in column order: per block of ``PAIR_BLOCK`` columns b an aggregation by the
    name of a.  (All pairs as one row of aggregates have more fields than Spark
    compiles, and take ten times as long.)"""
    cols = list(cols or feature_columns(train))
    if len(cols) < 2:
        return train.sparkSession.createDataFrame([], "feature_a string, feature_b string, correlation double")
    place = {c: i for i, c in enumerate(cols)}
    at = F.create_map(*[x for c, i in place.items() for x in (F.lit(c), F.lit(i))])
    parts = []
    for i in range(0, len(cols), PAIR_BLOCK):
        block = cols[i:i + PAIR_BLOCK]
        firsts = cols[:i + len(block)]
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("feature_a"), F.col(c).cast("double").alias("_x")) for c in firsts])).alias("_s")
        wide = train.select(*block, each).select("_s.*", *block).groupBy("feature_a").agg(*[safe_corr("_x", c).alias(c) for c in block])
        st = F.explode(F.array(*[F.struct(F.lit(c).alias("feature_b"), F.col(c).alias("correlation")) for c in block]))
        parts.append(wide.select("feature_a", st.alias("s")).select("feature_a", "s.*").where(at[F.col("feature_a")] < at[F.col("feature_b")]))
    return reduce(DataFrame.unionByName, parts)


def correlation_matrix(train: DataFrame, cols=None) -> DataFrame:
    """The full correlation matrix in long form (M10): both orders of each pair
    and the diagonal (1, or NULL for a constant column)."""
    cols = cols or feature_columns(train)
    pairs = pair_correlations(train, cols)
    own = train.agg(*[safe_corr(c, c).alias(c) for c in cols])
    diagonal = own.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature_a"), F.lit(c).alias("feature_b"), F.col(c).alias("correlation"))
                                              for c in cols])).alias("s")).select("s.*")
    return pairs.unionByName(pairs.select(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"), "correlation")) \
        .unionByName(diagonal)


def redundant_pairs(train: DataFrame, threshold: float = 0.8) -> DataFrame:
    """All feature pairs (i < j) with r > threshold, strongest first."""
    return (pair_correlations(train).where(F.col("correlation") > threshold)
            .orderBy(F.round("correlation", 12).desc(), "feature_a", "feature_b"))


def feature_votes(lists: dict, n_features: int = 15, spark=None) -> DataFrame:
    """Votes across method lists (A16, M12): count per feature, ties kept in
    order of first appearance (method order, then rank)."""
    rows = [(m_i, r, f) for m_i, (m, fs) in enumerate(lists.items()) for r, f in enumerate(fs)]
    df = spark.createDataFrame(rows, "method int, pos int, feature string")
    return votes_from_long(df, n_features)


def votes_from_long(long: DataFrame, n_features: int = 15) -> DataFrame:
    """(method, pos, feature) -> (feature, votes, first_seen) top-n."""
    v = long.groupBy("feature").agg(F.count(F.lit(1)).alias("votes"),
                                    F.min(F.struct("method", "pos")).alias("_first"))
    return (v.orderBy(F.col("votes").desc(), F.col("_first")).limit(n_features)
             .select("feature", "votes", F.col("_first.method").alias("first_method"),
                     F.col("_first.pos").alias("first_pos")))


def select_features(train: DataFrame, method: str = "combined", n_features: int = 15) -> list:
    """The reference's selection entry point; returns a bounded list of names."""
    base = _forest_rows(train)
    try:
        forest = rf_importance(base)        # what elimination starts from too
        lists = {
            "correlation": [r["feature"] for r in correlation_ranking(train).orderBy("rank").limit(n_features).collect()],
            "mutual_info": [r["feature"] for r in mutual_info_ranking(train).orderBy("rank").limit(n_features).collect()],
            "rf_importance": [r["feature"] for r in forest.orderBy("rank").limit(n_features).collect()],
            "rfe": _eliminate(base, min(n_features, len(feature_columns(train))), first=forest),
        }
    finally:
        base.unpersist()
    if method in lists:
        return lists[method]
    if method != "combined":
        raise ValueError(method)
    return [r["feature"] for r in feature_votes(lists, n_features, train.sparkSession).collect()]
