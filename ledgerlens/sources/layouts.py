"""Raw files by layout: many files, few plans.

The first line of every file says what it is: parquet, CSV with a separator and a
header, a JSON array or a JSON object.  Files of one layout are read together
(:func:`layouts`, :func:`parse`), so the number of plans follows the layouts, not
the files, and each file is parsed once: all events are written as one table of text
columns with the path they came from.  What the reference decides for a file (which
alias fills a column, which event a file without event names holds) is decided
from that table by path (:func:`standardize_by_file`).

Records that don't parse go to a table of rejects, with path and reason; the other
rows of their file stay."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.columns import parse_timestamp, standardize_address
from ledgerlens.schema import (ADDRESS_COLUMNS, COLUMN_ALIASES, EVENT_HINT_COLUMNS, EVENT_TYPES, EXPECTED_COLUMNS,
                               NESTED_EVENT, NESTED_EVENT_KEYS, REQUIRED_COLUMNS)
from ledgerlens.session import stage

CSV_SEPARATORS = [",", ";", "\t", "|"]
BAD, PATH = "_corrupt_record", "_path"
BLANK = "\ufeff \t\r\n"
HEAD_CHARS = 65_536
#: Records of a file that are looked at for its first; all of them, where those are blank.
HEAD_RECORDS = 64
#: Tasks that list files (Spark's default is one for each path that is named).
LISTING_TASKS = 64
REJECT = "path string, error string, record string"


class UnsupportedFile(ValueError):
    pass


def plain(path: str) -> str:
    """A path as users write it, from a URI."""
    return re.sub(r"^file:/+", "/", unquote(path))


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _one_file_a_task(spark: SparkSession):
    return _setting(spark, "spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))


def few_listing_tasks(spark: SparkSession):
    """Reads of many named paths list them in a bounded number of tasks."""
    return _setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(LISTING_TASKS))


def _first_records(spark: SparkSession, paths: list, separator: str, early: bool) -> dict:
    """The first record with something in it of each file; ``early``: among its first
    ``HEAD_RECORDS``, which need no Python (a worker that stops before the end of its
    file is not used again, so each file would start one)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in batches:
            rows = [(p, v) for p, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if v.strip(BLANK)]
            first = {p: v for p, v in reversed(rows) if p not in seen}
            seen |= set(first)
            if first:
                yield pa.RecordBatch.from_arrays([pa.array(list(first)), pa.array(list(first.values()))], ["path", "head"])

    with _one_file_a_task(spark), few_listing_tasks(spark):
        t = spark.read.option("lineSep", separator).text(paths)
        t = t.where(F.col("_metadata.file_block_start") == 0).select(F.col("_metadata.file_path").alias("path"), F.substring("value", 1, HEAD_CHARS).alias("head"))
        if early:
            at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))   # place in the task, so in its file
            t = t.withColumn("at", at).where((F.col("at") < HEAD_RECORDS) & (F.btrim("head", F.lit(BLANK)) != ""))
            t = t.groupBy("path").agg(F.min_by("head", "at").alias("head"))
        else:
            t = t.mapInArrow(run, "path string, head string")
        return {plain(r.path): r.head for r in t.collect()}    # a line per file


def first_lines(spark: SparkSession, paths: list) -> dict:
    """The first line of each file, in one job per line end: up to a comma for
    names that end in .json, whose first sign is enough.  Empty files have none."""
    out = {}
    text = [p for p in paths if not p.lower().endswith(".parquet")]
    for separator, some in ((",", [p for p in text if p.lower().endswith(".json")]), ("\n", [p for p in text if not p.lower().endswith(".json")])):
        if some:
            out |= _first_records(spark, some, separator, True)
            left = [p for p in some if plain(p) not in out]
            if left:    # files that begin with many blank records
                out |= _first_records(spark, left, separator, False)
    return out


def file_format(path: str, head: str | None) -> str:
    """By extension, else by the first line: ``{`` or ``[`` is JSON, a comma CSV."""
    for ext in ("csv", "json", "parquet"):
        if path.lower().endswith("." + ext):
            return ext
    line = (head or "").lstrip("﻿ \t\r\n")
    return "json" if line[:1] in ("{", "[") else "csv" if "," in line else "unknown"


def _fields(line: str, sep: str) -> list:
    return next(csv.reader([line.rstrip("\r\n")], delimiter=sep), [])


def csv_layout(line: str) -> tuple:
    """S3: separator and column names.  A comma, unless fewer than half of the
    expected columns are found with it; then what splits the line into most."""
    line = line.lstrip("﻿")
    sep = ","
    found = {c.strip().lower() for c in _fields(line, sep)}
    if sum(c in found for c in EXPECTED_COLUMNS) < len(EXPECTED_COLUMNS) / 2:
        sep = max(CSV_SEPARATORS, key=lambda s: len(_fields(line, s)))
    return sep, tuple(_fields(line, sep))


def unique_lower(names) -> list:
    """Lower case; of equal names the later ones get a number."""
    seen: dict = {}
    out = []
    for n in names:
        n = n.strip().lower() or "_c"
        seen[n] = seen.get(n, -1) + 1
        out.append(n if not seen[n] else f"{n}_{seen[n]}")
    return out


def layouts(spark: SparkSession, paths: list) -> tuple[dict, list]:
    """Files by layout, ``("csv", separator, columns)``, ``("json", "array")``,
    ``("json", "object")`` or ``("parquet",)``, and the rejected (path, error, record)."""
    heads = first_lines(spark, paths)
    groups: dict = {}
    bad = []
    for p in paths:
        head = heads.get(plain(p))
        kind = file_format(p, head)
        sign = (head or "").lstrip("﻿ \t\r\n")[:1]
        if kind == "unknown":
            bad.append((p, f"Unsupported file format for {p}", (head or "")[:500]))
        elif kind != "parquet" and head is None:
            bad.append((p, "empty file", None))
        elif kind == "json" and sign not in ("{", "["):
            bad.append((p, f"not a JSON array or object: {p}", head[:500]))
        else:
            key = ("parquet",) if kind == "parquet" else ("json", "array" if sign == "[" else "object") if kind == "json" else ("csv", *csv_layout(head))
            groups.setdefault(key, []).append(p)
    return groups, bad


def _text(name: str, kind: T.DataType):
    c = F.col(f"`{name}`")
    return F.to_json(c) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else c.cast("string")


def _texts(df: DataFrame, fields, prefix: str = "") -> list:
    names = unique_lower([f.name for f in fields])
    return [_text(prefix + f.name, f.dataType).alias(n) for f, n in zip(fields, names, strict=True) if f.name not in (BAD, PATH)]


def parse_csv(spark: SparkSession, paths: list, sep: str, columns: tuple) -> DataFrame:
    """Rows with more fields than the header are corrupt; shorter ones end in nulls."""
    names = unique_lower(columns)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BAD]])
    df = (spark.read.schema(schema).option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", BAD).csv(paths))
    fields = F.size(F.split(F.regexp_replace(BAD, '"[^"]*"', ""), re.escape(sep)))
    bad = F.when(F.col(BAD).isNotNull() & (fields > len(names)), F.col(BAD))
    return df.select(*[F.col(f"`{n}`") for n in names], bad.alias(BAD), F.col("_metadata.file_path").alias(PATH))


#: In no JSON text: a control character stands there escaped.
NEVER = "\u0000\u0000ledgerlens\u0000\u0000"


def _read_json(spark: SparkSession, paths: list, schema: T.StructType | None = None) -> DataFrame:
    # A file is one record.  (In ``multiLine`` mode Spark goes back to the file for the exact text of each number.)
    r = spark.read.option("lineSep", NEVER).option("primitivesAsString", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD)
    return (r.schema(schema) if schema else r).json(paths)


def parse_arrays(spark: SparkSession, paths: list) -> DataFrame:
    """Arrays of flat events, one row each."""
    schema = _with_bad(_read_json(spark, paths).schema)
    df = _read_json(spark, paths, schema)
    return df.select(*_texts(df, [f for f in schema if f.name not in (BAD, NOTHING)]), _bad(), F.col("_metadata.file_path").alias(PATH))


#: A field that no file has: Spark wants a query to read one beside the corrupt record.
NOTHING = "_nothing"


def _with_bad(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema if f.name != BAD] + [T.StructField(NOTHING, T.StringType()), T.StructField(BAD, T.StringType())])


def _bad():
    return F.when(F.col(NOTHING).isNull(), F.col(BAD)).alias(BAD)


def parse_objects(spark: SparkSession, paths: list, keep_liquidator: bool = False) -> DataFrame:
    """An object of five nested event arrays, else one keyed by event names,
    else a single flat event; each object is told apart by what it holds, and all
    its events come from one explode."""
    nested = dict(NESTED_EVENT_KEYS)
    found = _read_json(spark, paths).schema
    fields = [T.StructField(f.name, T.ArrayType(NESTED_EVENT)) if f.name in nested else f for f in found]
    schema = _with_bad(T.StructType(fields))
    df = _read_json(spark, paths, schema)
    keyed = [f for f in schema if f.name in EVENT_TYPES and isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)]
    flat = [f for f in schema if f.name not in nested and f.name not in (BAD, NOTHING) and f not in keyed]

    own = {"event_type": None, "account": "account.id", "token": "asset.id", "token_symbol": "asset.symbol", "amount": "amount",
           "amountusd": "amountUSD", "transaction_hash": "hash", "timestamp": "timestamp"}
    if keep_liquidator:
        own["liquidator"] = "liquidator.id"
    flat_names = dict(zip(unique_lower([f.name for f in flat]), flat, strict=True))
    keyed_names = {f.name: dict(zip(unique_lower([g.name for g in f.dataType.elementType]), f.dataType.elementType, strict=True)) for f in keyed}
    names = list(dict.fromkeys([*own, *(n for g in keyed_names.values() for n in g), *flat_names]))
    null = F.lit(None).cast("string")

    def event(values: dict):
        return F.struct(*[values.get(n, null).alias(n) for n in names])

    def at(e, dotted: str):
        return reduce(lambda x, k: x[k], dotted.split("."), e)

    def text(c, kind):
        return F.to_json(c) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else c.cast("string")

    none = F.array().cast("array<" + T.StructType([T.StructField(n, T.StringType()) for n in names]).simpleString() + ">")
    here = [k for k, _ in NESTED_EVENT_KEYS if k in found.names]

    def of_nested(k: str):
        return F.transform(F.coalesce(k, F.array().cast(T.ArrayType(NESTED_EVENT))),
                           lambda e: event({n: F.lit(nested[k]) if path is None else at(e, path) for n, path in own.items()}))

    def of_keyed(f: T.StructField):
        return F.transform(F.coalesce(f.name, F.array().cast(f.dataType)),
                           lambda e: event({**{n: text(e[g.name], g.dataType) for n, g in keyed_names[f.name].items()}, "event_type": F.lit(f.name)}))

    all_nested = F.concat(none, *[of_nested(k) for k in here])
    all_keyed = F.concat(none, *[of_keyed(f) for f in keyed])
    has = lambda cols: reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols], F.lit(False))
    single = F.array(event({n: text(F.col(f"`{f.name}`"), f.dataType) for n, f in flat_names.items()}))
    events = (F.when(F.col(BAD).isNotNull(), F.array(event({}))).when(F.size(all_nested) > 0, all_nested)
              .when(has([f.name for f in keyed]), all_keyed).when(has(here), none).otherwise(single))
    return df.select(_bad(), F.col("_metadata.file_path").alias(PATH), F.explode(events).alias("e")).select("e.*", BAD, PATH)


def parse_parquet(spark: SparkSession, paths: list) -> DataFrame:
    df = spark.read.option("mergeSchema", True).parquet(*paths)
    return df.select(*_texts(df, df.schema.fields), F.lit(None).cast("string").alias(BAD), F.col("_metadata.file_path").alias(PATH))


def parse(spark: SparkSession, groups: dict, keep_liquidator: bool = False) -> DataFrame:
    """All events of all groups as text columns, with ``_path`` and, where a record
    doesn't parse, ``_corrupt_record``."""
    parts = []
    with few_listing_tasks(spark):
        for (kind, *of), paths in groups.items():
            parts.append(parse_csv(spark, paths, *of) if kind == "csv" else parse_parquet(spark, paths) if kind == "parquet"
                         else parse_arrays(spark, paths) if of == ["array"] else parse_objects(spark, paths, keep_liquidator))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def standardize_by_file(raw: DataFrame) -> DataFrame:
    """P2-P6 on parsed events, decided for each file: a canonical column that the
    file lacks is filled from the first alias it has; where a file has no event
    name at all, the first event with a column of its own fills every row.  A
    file has a column if any row has a value there."""
    names = [c for c in raw.columns if c != PATH]
    asked = [n for n in dict.fromkeys([*(s for s, _ in COLUMN_ALIASES), *(d for _, d in COLUMN_ALIASES), *(c for _, cs in EVENT_HINT_COLUMNS for c in cs)]) if n in names]
    has = raw.groupBy(PATH).agg(*[F.max(F.col(f"`{c}`").isNotNull()).alias(f"_has_{c}") for c in asked])
    t = raw.join(has, PATH)     # a row per file: Spark goes by its size
    null = F.lit(None).cast("string")
    adds = {}
    for dst in dict.fromkeys(d for _, d in COLUMN_ALIASES):
        sources = [s for s, d in COLUMN_ALIASES if d == dst and s in names and s != dst]
        if not sources:
            continue
        value = F.when(F.col(f"_has_{dst}"), F.col(f"`{dst}`")) if dst in names else F.when(F.lit(False), null)
        for s in sources:
            value = value.when(F.col(f"_has_{s}"), F.col(f"`{s}`"))
        adds[dst] = value
    t = t.withColumns(adds) if adds else t
    t = t.withColumns({c: null for c in REQUIRED_COLUMNS if c not in t.columns})
    hint = F.when(F.lit(False), null)
    for ev, cols in EVENT_HINT_COLUMNS:
        here = [F.col(f"_has_{c}") for c in cols if c in names]
        if here:
            hint = hint.when(reduce(lambda a, b: a | b, here), F.lit(ev))
    named = [F.col(f"_has_{s}") for s, d in COLUMN_ALIASES if d == "event_type" and s in names]
    any_name = reduce(lambda a, b: a | b, named, F.lit(False))
    t = t.withColumn("event_type", F.when(any_name, F.col("event_type")).otherwise(hint))
    t = t.withColumns({c: standardize_address(F.col(c)) for c in ADDRESS_COLUMNS if c in t.columns})
    return t.withColumn("timestamp", parse_timestamp("timestamp")).drop(*[f"_has_{c}" for c in asked])


def load_files(spark: SparkSession, paths: list, keep_liquidator: bool = False) -> tuple[DataFrame, DataFrame]:
    """Events of all files, standardised, with the ``_path`` they came from, and
    the rejects (``path, error, record``): files that are nothing known, records that
    don't parse.  All files rejected -> error."""
    groups, bad = layouts(spark, list(paths))
    rejected = spark.createDataFrame(bad, REJECT)
    if not groups:
        raise UnsupportedFile("no file could be parsed")
    parsed = stage(parse(spark, groups, keep_liquidator))
    wrong = parsed.where(F.col(BAD).isNotNull()).select(F.col(PATH).alias("path"), F.lit("malformed record").alias("error"), F.substring(BAD, 1, 500).alias("record"))
    good = parsed.where(F.col(BAD).isNull()).drop(BAD)
    if len(bad) + wrong.select("path").distinct().count() >= len(paths) and good.isEmpty():
        raise UnsupportedFile("no file could be parsed")
    return standardize_by_file(good), rejected.unionByName(wrong)
