"""Operator 13: shards that all hold the same mixture of sources.

Rows of each source are shuffled by a seeded hash and ranked; row ``r`` of ``n``
gets the fraction ``(2 r + 1) / (2 n)``.  Sorting all rows by their fraction
interleaves the sources in proportion, and cutting that order into equal pieces
gives shards whose row counts, in all and of each source, are at most one (per
source: about one) apart.  The law that holds is ``rows``.

Ranks need no window over a source: rows are range-partitioned by (source,
hash), and a rank is the place in the partition plus the source's rows in the
partitions before it (:func:`rank_in_groups`), so a source with a third of all
rows spreads over a third of the tasks.  Both sorts carry hashes, never texts;
texts are shuffled once, to meet their places.

Defined results: a null source is a source of its own; null ids, null and empty
texts are rows like others; rows that are equal in every column get a place
each; an empty table gives no rows.  Columns of the input may have any name,
since rows travel as one struct."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from ledgerlens.llm.common import add_row_index, stage, stage_path

SHARDS, SEED = 16, 20240229


def rank_in_groups(df: DataFrame, group: str, order: list, partitions: int | None = None) -> DataFrame:
    """Add ``_rank``, the place (from 0) of a row among those of its ``group`` in
    ``order``, and ``_size``, how many those are.  Keep ``df`` narrow.

    One range partitioning by (group, order); what crosses partitions is a count
    per (partition, group).  Rows meet those counts by both, so no key is hot."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group), *order]
    placed = stage(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                     .withColumn("_mid", F.monotonically_increasing_id())
                     .select(*df.columns, F.shiftright("_mid", 33).alias("_pid"), F.col("_mid").bitwiseAND((1 << 33) - 1).alias("_at")))
    counts = placed.groupBy("_pid", group).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # A group has one row here for each partition it reaches into.
    w = Window.partitionBy(group).orderBy("_pid")
    before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    size = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    counts = counts.select("_pid", F.col(group).alias("_group"), "_first", before.alias("_before"), size.alias("_size"))
    met = placed.join(counts, (placed["_pid"] == counts["_pid"]) & placed[group].eqNullSafe(counts["_group"]))
    return met.select(*[placed[c] for c in df.columns], (F.col("_before") + F.col("_at") - F.col("_first")).alias("_rank"), "_size")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _identity(docs: DataFrame) -> DataFrame:
    """``row`` (all columns) and ``key``, equal for rows that are equal in every column."""
    row = F.struct(*[F.col(_quoted(c)) for c in docs.columns])
    return docs.select(row.alias("row")).withColumn("key", F.sha2(F.to_json("row"), 256))


def places(docs: DataFrame, strata: str = "source", id_column: str = "doc_id", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``key, shard, slot``: one row for each of ``docs`` (rows equal in every
    column have the same key).  Slots follow the fractional rank."""
    u = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"row.{_quoted(id_column)}").cast("string"), F.lit("null"))))
    narrow = _identity(docs).select(F.col(f"row.{_quoted(strata)}").cast("string").alias("stratum"), u.alias("u"), F.col(f"row.{_quoted(id_column)}").alias("id"), "key")
    # Equal rows are interchangeable; a number keeps many of them from being one range.
    narrow = narrow.withColumn("tie", F.monotonically_increasing_id())
    ranked = rank_in_groups(narrow, "stratum", ["u", "id", "key", "tie"])
    fraction = (2 * F.col("_rank") + 1) / (2 * F.col("_size")).cast("double")
    ranked = ranked.select("key", "stratum", "_rank", fraction.alias("fraction"))
    placed = stage(add_row_index(ranked, ["fraction", "stratum", "_rank"], "at"))
    total = placed.agg(F.count(F.lit(1)).alias("total"))
    placed = placed.crossJoin(F.broadcast(total))   # one row of one number
    shard = F.expr(f"at * {shards} div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select("key", F.col("shard").cast("int").alias("shard"), (F.col("at") - first).alias("slot"))


def write_shards(docs: DataFrame, strata: str = "source", id_column: str = "doc_id", shards: int = SHARDS, seed: int = SEED, folder: str | None = None) -> str:
    """Write ``docs`` as Parquet under ``folder``: ``shard=<s>/`` with files of
    ``slot`` and ``row``, each sorted by slot.  Returns the folder."""
    folder = folder or stage_path(docs.sparkSession, "shards")
    at = stage(places(docs, strata, id_column, shards, seed))
    rows = _identity(docs)
    repeated = stage(at.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"))
    if repeated.isEmpty():
        out = rows.join(at, "key")
    else:
        # Of rows equal in every column one text meets all their places; a semi join on their keys finds them.
        single = rows.join(repeated, "key", "left_anti").join(at.join(repeated, "key", "left_anti"), "key")
        copies = rows.join(repeated, "key", "left_semi").groupBy("key").agg(F.first("row").alias("row"))
        out = single.unionByName(copies.join(at, "key"))
    out.select("slot", "row", "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    return folder


def read_shards(spark: SparkSession, folder: str, columns: StructType) -> DataFrame:
    """``shard, slot, row`` of all shards, where ``row`` has ``columns``; a shard's
    rows in the order of ``slot`` are its sequence."""
    schema = StructType().add("slot", LongType()).add("row", columns).add("shard", IntegerType())
    return spark.read.schema(schema).parquet(folder).select("shard", "slot", "row")


def digests(shards: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of shards as read back.
    A size is the text's UTF-8 bytes (null: none) and one more; the law is ``rows``."""
    text = F.coalesce(F.col(f"row.{_quoted(text_column)}"), F.lit(""))
    return shards.select(F.col(f"row.{_quoted(id_column)}").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
