"""Helpers shared by the training-data operators."""

from __future__ import annotations

import base64
import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir, ship_package, stage

__all__ = ["add_row_index", "arrow_rows", "fresh", "load_ranks", "read_table", "running_total", "ship_package", "slices", "stage", "stage_path", "text_batches"]

#: Rows of an Arrow batch that are turned into Python objects at a time.
SLICE_ROWS = 512
#: Rows of an Arrow batch where each is a whole text.
TEXT_ROWS = 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until none of ``columns`` is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches, so that Python objects exist for few rows at a time.  At
    a task's end what it has freed goes back to the system: workers live on, and
    share their executor's memory with others."""
    try:
        for b in batches:
            for i in range(0, b.num_rows, rows):
                yield b.slice(i, rows)
    finally:
        give_back()


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """From now on Arrow batches of the session have at most ``rows`` rows: for
    jobs whose rows are whole texts and that are run later by someone else."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Within it, Arrow batches of jobs that run have at most ``rows`` rows: for
    rows so wide that Spark's default number of them would not fit a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a ``.tiktoken`` file (``base64 rank`` lines)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _placed(df: DataFrame, order: list, partitions: int | None) -> DataFrame:
    """``df`` range-partitioned and sorted, with its partition ``_pid`` and place
    ``_at`` there.  Written to the shared folder, since range bounds are sampled:
    places must not change if a partition is computed again."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mid = F.monotonically_increasing_id()
    return stage(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_mid", mid)
                 .select(*df.columns, F.shiftright("_mid", 33).alias("_pid"), F.col("_mid").bitwiseAND((1 << 33) - 1).alias("_at")))


def _before(sums: DataFrame) -> DataFrame:
    """``_pid`` and the sum of ``_n`` over the partitions before it.  The window
    sees one row per partition of the sort, however large the input is."""
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))


def add_row_index(df: DataFrame, order: list, name: str = "row_index", partitions: int | None = None) -> DataFrame:
    """Number rows 0..n-1 in ``order`` with no single-task sort: a row's number is
    its place in its range partition plus the row counts of those before.  Keep
    ``df`` narrow."""
    placed = _placed(df, order, partitions)
    offsets = _before(placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")))
    return placed.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_before") + F.col("_at")).drop("_pid", "_at", "_before")


def running_total(df: DataFrame, order: list, value: str, name: str, partitions: int | None = None) -> DataFrame:
    """Add the sum of ``value`` over all rows before this one in ``order``; a
    window per range partition, and one sum per partition on top."""
    placed = _placed(df, order, partitions)
    offsets = _before(placed.groupBy("_pid").agg(F.sum(value).alias("_n")))
    w = Window.partitionBy("_pid").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("_sum", F.coalesce(F.sum(value).over(w), F.lit(0)))
    return inside.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_before") + F.col("_sum")).drop("_pid", "_at", "_before", "_sum")
