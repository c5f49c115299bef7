"""Writers for stage tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.schema import NESTED_EVENT_KEYS


def write_stage(df: DataFrame, path: str, sort_by=None, partitions: int | None = None) -> None:
    """Parquet stage table; optional clustering of rows inside files (no
    global sort)."""
    if partitions:
        df = df.repartition(partitions, *(sort_by or []))
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_dataframe(df: DataFrame, path: str) -> None:
    """Save by extension (csv or parquet)."""
    if path.lower().endswith(".csv"):
        write_csv(df, path)
    else:
        df.write.mode("overwrite").parquet(path)


def epoch_seconds_text(ts):
    """Epoch seconds with the microsecond fraction, as exact decimal text."""
    return (F.unix_micros(F.col(ts)).cast("decimal(24,0)") / F.lit(1000000)).cast("decimal(24,6)").cast("string")


def write_nested_event_files(tx: DataFrame, path: str, rows_per_file: int = 25_000) -> None:
    """Write canonical transactions in the nested raw layout: one JSON object
    per file with the five event arrays.  The number of files follows the number
    of rows, and a hash of the transaction hash deals rows to them, so an object
    holds about ``rows_per_file`` rows at most, whatever the size of the table."""
    files = max(1, -(-tx.count() // rows_per_file))
    ev_key = {ev: k for k, ev in NESTED_EVENT_KEYS}
    elem = F.struct(
        F.struct(F.col("account").alias("id")).alias("account"),
        F.struct(F.col("token").alias("id"), F.col("token_symbol").alias("symbol")).alias("asset"),
        F.col("amount").cast("string").alias("amount"),
        F.col("amountusd").cast("string").alias("amountUSD"),
        F.col("transaction_hash").alias("hash"),
        epoch_seconds_text("timestamp").alias("timestamp"))
    t = (tx.withColumn("token_symbol", F.concat(F.lit("T"), F.col("token")))
           .withColumn("_b", F.pmod(F.xxhash64("transaction_hash"), F.lit(files))))
    aggs = [F.collect_list(F.when(F.col("event_type") == ev, elem)).alias(k) for ev, k in ev_key.items()]
    doc = t.groupBy("_b").agg(*aggs)
    doc.write.mode("overwrite").partitionBy("_b").json(path)    # a row per file: no task of its own for each


def _dealt(tx: DataFrame, rows_per_file: int) -> DataFrame:
    """``_b``: the file of a row.  A file is a row of what is written, so tasks write
    as many files as Spark deals to them."""
    files = max(1, -(-tx.count() // rows_per_file))
    return tx.withColumn("_b", F.pmod(F.xxhash64("transaction_hash"), F.lit(files)))


def _flat_event(*more):
    return F.struct("event_type", epoch_seconds_text("timestamp").alias("block_timestamp"), F.col("account").alias("user"), F.col("transaction_hash").alias("tx_hash"),
                    F.col("token").alias("asset"), F.col("ctoken").alias("c_token"), F.col("amount").alias("amount_decimal"), *more)


def write_json_arrays(tx: DataFrame, path: str, rows_per_file: int = 25_000) -> None:
    """The flat raw layout: one JSON array of events per file (of ``rows_per_file`` or so)."""
    t = _dealt(tx, rows_per_file)
    doc = t.groupBy("_b").agg(F.to_json(F.collect_list(_flat_event())).alias("value"))
    doc.write.mode("overwrite").partitionBy("_b").text(path)


def write_json_by_event(tx: DataFrame, path: str, rows_per_file: int = 25_000) -> None:
    """The layout keyed by event names: one object of arrays per file."""
    t = _dealt(tx, rows_per_file)
    bare = F.struct(epoch_seconds_text("timestamp").alias("time"), F.col("account").alias("wallet"), F.col("transaction_hash").alias("hash"), "token", "ctoken", "amount")
    events = ["Mint", "Redeem", "Borrow", "RepayBorrow", "LiquidateBorrow"]
    doc = t.groupBy("_b").agg(*[F.collect_list(F.when(F.col("event_type") == e, bare)).alias(e) for e in events])
    doc.select("_b", F.to_json(F.struct(*events)).alias("value")).write.mode("overwrite").partitionBy("_b").text(path)


def write_json_objects(tx: DataFrame, path: str, key: str) -> None:
    """One flat object per file, a file for each value of ``key`` (each once in ``tx``)."""
    tx.select(F.col(key).alias("_b"), F.to_json(_flat_event()).alias("value")).repartition("_b").write.mode("overwrite").partitionBy("_b").text(path)


def save_models(models: dict, path: str) -> None:
    """Fitted Spark ML pipelines, one folder per model."""
    for name, m in models.items():
        m.write().overwrite().save(f"{path.rstrip('/')}/{name}")


def load_models(names, path: str) -> dict:
    from pyspark.ml import PipelineModel
    return {n: PipelineModel.load(f"{path.rstrip('/')}/{n}") for n in names}


def save_forest(nodes: DataFrame, path: str) -> None:
    """Isolation-forest node table as parquet."""
    nodes.write.mode("overwrite").parquet(path)
