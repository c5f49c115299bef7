"""Raw event files -> canonical transactions.

The work is in :mod:`ledgerlens.sources.layouts`: files of one layout are read
together, so a plan grows with the layouts, not with the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources import layouts as LA
from ledgerlens.sources.layouts import UnsupportedFile

__all__ = ["UnsupportedFile", "infer_file_format", "largest_files", "load_and_process", "load_dataframe", "read_json"]


# ------------------------------------------------------------------ S1
def largest_files(spark: SparkSession, directory: str, n: int = 3, pattern: str | None = None) -> DataFrame:
    """(path, length) of the ``n`` largest files; the content column is pruned,
    so only file metadata is read."""
    r = spark.read.format("binaryFile")
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    files = r.option("recursiveFileLookup", "true").load(directory).select("path", "length")
    return files.orderBy(F.col("length").desc(), F.col("path").asc()).limit(n)


# ------------------------------------------------------------------ S2
def infer_file_format(spark: SparkSession, paths: list) -> DataFrame:
    """(path, format): by extension, else by the first line (``{``/``[`` ->
    json, a comma -> csv, otherwise unknown)."""
    heads = LA.first_lines(spark, list(paths))
    return spark.createDataFrame([(p, LA.file_format(p, heads.get(LA.plain(p)))) for p in paths], "path string, format string")


# ------------------------------------------------------------------ S4-S7
def read_json(spark: SparkSession, path: str, keep_liquidator: bool = False) -> DataFrame:
    """The events of one JSON file, whatever its layout, as text columns."""
    groups, bad = LA.layouts(spark, [path])
    if bad:
        raise UnsupportedFile(bad[0][1])
    return LA.parse(spark, groups, keep_liquidator).where(F.col(LA.BAD).isNull()).drop(LA.BAD, LA.PATH)


# ------------------------------------------------------------------ S8, S10
def load_and_process(spark: SparkSession, paths: list, keep_liquidator: bool = False, partitions: int | None = None):
    """Read every file, standardise, union by name: (transactions, rejected),
    where ``rejected`` is (path, error, record): files and records that don't
    parse are skipped and reported.  All files bad -> error."""
    tx, rejected = LA.load_files(spark, paths, keep_liquidator)
    tx = tx.drop(LA.PATH)
    return (tx.repartition(partitions) if partitions else tx), rejected


def load_dataframe(spark: SparkSession, path: str) -> DataFrame:
    """Stage table by extension (csv or parquet)."""
    if path.lower().endswith(".csv"):
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    if path.lower().endswith(".parquet") or "." not in path.rsplit("/", 1)[-1]:
        return spark.read.parquet(path)
    raise UnsupportedFile(f"Unsupported file format: {path}")
