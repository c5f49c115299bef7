"""SimHash fingerprints and their search in permuted block tables (operator 4).

All of it is DataFrame code: no Python runs on the executors.

A text's terms are its runs of five words, words being what white space
separates; a term weighs as often as it occurs.  The 64-bit hash of each term
votes for or against each bit.  The votes are counted in 16 sums of four 16-bit
lanes each; terms are cut into chunks of ``CHUNK`` before, so that no lane can
run over, whatever the length of the text.  A text stays in its row: nothing is
exploded or shuffled to fingerprint it.

Search: the 64 bits are cut into ``blocks`` blocks.  Two fingerprints at most
``radius`` bits apart agree on ``blocks - radius`` whole blocks at least.  For
each choice of that many blocks there is a table keyed by their bits (the leading
bits of a permuted fingerprint).  Rows that meet in a table are compared in full,
in the first table only in which they can meet.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import add_row_index, fresh, stage

WORDS = 5
BITS = 64
#: Terms whose votes one set of 16-bit lanes can hold, with room to spare.
CHUNK = 16_384
RADIUS = 3
BLOCKS = 6
LANES = 0x0001000100010001
#: White space: as a Java pattern, and its characters.
SPACE, SPACES = "[\\x09-\\x0D\\x20]+", "\t\n\x0b\x0c\r "
#: Stands for a null document id inside joins.
NULL_ID = -(1 << 63)


def add_fingerprint(df: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """Add the fingerprint (bigint) of ``text_col``: a bit is set if more than
    half of the terms vote for it.  Fewer than five words are one term; a text
    without words (null ones too) has fingerprint 0; equal texts have equal
    fingerprints."""
    keep = [c for c in df.columns if c != name]
    h, t, v, size = (fresh(df.columns, c) for c in ("_word_hashes", "_terms", "_votes", "_n"))
    words = F.split(F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(SPACES)), SPACE)
    hashes = F.transform(words, lambda w: F.when(w != "", F.xxhash64(w)))
    n = F.size(h)
    at = F.sequence(F.lit(1), F.greatest(n - WORDS + 1, F.lit(1)))
    # F.get counts from 0 and is null past the end, which xxhash64 passes over.
    runs = F.transform(at, lambda i: F.xxhash64(*(F.get(h, i + (k - 1)) for k in range(WORDS))))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(t) - 1) / CHUNK).cast("int")), lambda c: F.slice(t, c * CHUNK + 1, CHUNK))
    zero = F.lit(0).cast("bigint")

    def lane_sum(part: Column, i: int) -> Column:
        return F.aggregate(part, zero, lambda s, x: s + F.shiftrightunsigned(x, i).bitwiseAND(LANES))

    def ones(b: int) -> Column:
        """Bit i + 16 * l is in lane l of sum i."""
        return F.aggregate(v, zero, lambda s, x: s + F.shiftrightunsigned(F.get(x, F.lit(b % 16)), 16 * (b // 16)).bitwiseAND(0xFFFF))

    votes = F.transform(chunks, lambda part: F.array(*(lane_sum(part, i) for i in range(16))))
    bit = lambda b: F.when(ones(b) * 2 > F.col(size), F.lit(1 << b if b < 63 else -(1 << 63)).cast("bigint")).otherwise(zero)
    out = reduce(lambda a, b: a.bitwiseOR(b), (bit(b) for b in range(BITS)))
    return (df.select(*keep, hashes.alias(h))
            .select(*keep, F.when(F.get(h, F.lit(0)).isNotNull(), runs).otherwise(F.array().cast("array<bigint>")).alias(t))
            .select(*keep, F.size(t).alias(size), F.when(F.size(t) > 0, votes).otherwise(F.array().cast("array<array<bigint>>")).alias(v))
            .select(*keep, out.alias(name)))


def digits(fingerprint: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    """1 less the share of bits that differ."""
    return 1 - distance(a, b) / BITS


def _masks(blocks: int, radius: int) -> list[int]:
    """The bits of each table's key."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(block[i] for i in c) for c in combinations(range(blocks), blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def near(queries: DataFrame, table: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All pairs ``(query, found, distance)`` of a fingerprint of ``queries`` and
    one of ``table`` (columns ``fingerprint``) at most ``radius`` bits apart,
    equal ones included.  Fingerprints are made distinct on both sides first."""
    masks = [_signed(m) for m in _masks(blocks, radius)]
    tables = lambda df, name: df.select(F.col("fingerprint").alias(name)).filter(F.col(name).isNotNull()).distinct().select(
        name, F.posexplode(F.array(*(F.col(name).bitwiseAND(m) for m in masks))).alias("_table", "_key"))
    q, t = tables(queries, "query"), tables(table, "found")
    x = F.col("query").bitwiseXOR(F.col("found"))
    # The first table in which the two meet; later ones find them again.
    first = reduce(lambda later, im: F.when(x.bitwiseAND(im[1]) == 0, F.lit(im[0])).otherwise(later), reversed(list(enumerate(masks))), F.lit(-1))
    close = (F.bit_count(x) <= radius) & (first == q["_table"])
    # Merged, not broadcast: the planner would take the few rows of a side for its size before they are exploded.
    return (q.join(t.hint("merge"), (q["_table"] == t["_table"]) & (q["_key"] == t["_key"]) & close)
            .select("query", "found", distance(F.col("query"), F.col("found")).alias("distance")))


def near_counts(table: DataFrame, is_query: Column, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``fingerprint, near``: for each fingerprint with a row in ``table`` for
    which ``is_query`` holds, the number of rows at most ``radius`` bits away."""
    sizes = table.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("rows"))
    pairs = near(table.filter(is_query), table, radius, blocks)
    return (pairs.join(sizes.withColumnRenamed("fingerprint", "found"), "found").groupBy(F.col("query").alias("fingerprint"))
            .agg(F.sum("rows").alias("near")))


def splice_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, part, n_chars, next_id, next_part, text, edited``: each text, and
    the text whose last floor(n / 2) characters are replaced by the first as many
    (or all) of the next document's, ascending by id, the first following the last.

    Null texts are empty.  Rows equal in id and text are one document; texts that
    share an id (null is one, the smallest) are documents of their own, told
    apart and ordered by ``part``, a hash of the text.

    The order is found on ids and lengths alone.  Texts are then shuffled once, and
    of each the part that is needed goes to the document before it."""
    base = (docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .withColumn("part", F.xxhash64("text")))
    keys = ["id", "part"]
    order = add_row_index(base.select(*keys, F.length("text").cast("bigint").alias("n")).distinct(), keys, "at")
    order = stage(order)
    n_docs = order.agg(F.max("at").alias("last"))
    # One row of one number is attached to the one row of the first document.
    first = order.filter("at = 0").crossJoin(F.broadcast(n_docs)).select(F.col("last").alias("at"), F.col("id").alias("next_id"), F.col("part").alias("next_part"))
    after = order.filter("at > 0").select((F.col("at") - 1).alias("at"), F.col("id").alias("next_id"), F.col("part").alias("next_part")).unionByName(first)
    links = order.join(after, "at").drop("at")
    before = links.select(F.col("next_id").alias("id"), F.col("next_part").alias("part"), F.col("id").alias("to_id"), F.col("part").alias("to_part"),
                          F.floor(F.col("n") / 2).cast("int").alias("take"))
    texts = base.groupBy(*keys).agg(F.first("text").alias("text"))
    both = texts.join(links.join(before, keys), keys)
    heads = both.select(F.col("to_id").alias("id"), F.col("to_part").alias("part"), F.substr("text", F.lit(1), "take").alias("head"))
    own = both.select(*keys, F.col("n").alias("n_chars"), "next_id", "next_part", "text")
    kept = F.substr("text", F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int"))
    return own.join(heads, keys).select(*keys, "n_chars", "next_id", "next_part", "text", F.concat(kept, "head").alias("edited"))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
                   blocks: int = BLOCKS, query_step: int = 20) -> DataFrame:
    """Fingerprint every text and its edited text (:func:`splice_next`):
    ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` (likeness to the edited text's and to the next
    document's fingerprint), and for ids divisible by ``query_step``
    ``n_near``, the number of documents within ``radius`` bits, itself
    included, from the block tables."""
    spliced = splice_next(docs, id_col, text_col)
    made = add_fingerprint(spliced.withColumn("edited_sha256", F.sha2("edited", 256)), "text", "fingerprint").drop("text")
    made = add_fingerprint(made, "edited", "edited_fingerprint").drop("edited")
    rows = stage(made)
    following = rows.select(F.col("id").alias("next_id"), F.col("part").alias("next_part"), F.col("fingerprint").alias("_next"))
    asks = (F.col("id") % query_step == 0) & (F.col("id") != NULL_ID)
    near_by = near_counts(rows, asks, radius, blocks)
    return (rows.join(following, ["next_id", "next_part"]).join(near_by, "fingerprint", "left")
            .select(F.when(F.col("id") != NULL_ID, F.col("id")).alias(id_col), "n_chars", "edited_sha256",
                    digits(F.col("fingerprint")).alias("fingerprint"), digits(F.col("edited_fingerprint")).alias("edited_fingerprint"),
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"), F.when(asks, F.col("near")).alias("n_near")))
