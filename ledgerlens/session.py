"""Session construction and cluster-safe helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  The clock of the data is UTC: epoch seconds in
# raw files are interpreted as UTC wall time, like the reference's
# ``pd.to_datetime(unit='s')``.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "ledgerlens",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects.

    On a cluster ``master`` stays ``None`` so spark-submit decides; locally it
    is ``local[N]``.  The UI is off: nothing here opens a web server.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(CORE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    use_utc(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (timestamps are UTC wall clock)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder (HDFS/S3/...); it is read,
    never replaced.  Only where it is unset (local tests) ``fallback`` -- or a
    fresh folder under the system temp dir in local mode -- is installed.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if fallback is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir is unset; set it to a shared folder")
            fallback = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
        d = fallback
        spark.conf.set("spark.checkpoint.dir", d)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(d)
    return d


def _stage_root(spark: SparkSession, root: str) -> str:
    """The application's folder for stage tables; Hadoop removes it when the
    application ends."""
    sc = spark.sparkContext
    path = f"{root.rstrip('/')}/stages/{sc.applicationId}"
    if path not in _STAGE_ROOTS:
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
        _STAGE_ROOTS.add(path)
    return path


_STAGE_ROOTS: set = set()


def stage(df, how: str = "table"):
    """Materialise a stage table and cut its lineage.

    ``table`` (default) writes the rows as parquet under the shared folder
    named by ``spark.checkpoint.dir`` and reads them back: one job, survives
    executor loss, and later stages get column pruning.  ``checkpoint`` uses
    ``DataFrame.checkpoint`` (same folder); ``persist`` keeps the rows in
    executor memory/disk; ``none`` keeps the lazy plan.  Stage tables here are
    per-wallet, so they are small next to the transaction log they summarise."""
    if how == "none":
        return df
    if how == "persist":
        from pyspark import StorageLevel
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    if how == "table":
        import uuid
        path = f"{_stage_root(spark, root)}/{uuid.uuid4().hex}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    raise ValueError(how)


_SHIPPED: set = set()


def ship_package(spark) -> None:
    """Make ``ledgerlens`` importable in Python workers (pandas UDF paths).

    The package is zipped once per SparkContext and registered with
    ``addPyFile``; Spark distributes it to every executor.  On a cluster this
    matches ``--py-files``; it is a no-op when already shipped."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import os
    import zipfile
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="ledgerlens-pkg-"), "ledgerlens.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _dirs, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(out)
    _SHIPPED.add(app)
