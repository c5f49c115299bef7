"""Chat formatting as a prefix tree of turns (operator 2).

Conversations that begin with the same turns share tree nodes.  A node is one
turn after a given history; its tokens are emitted once, trees depth first.  A
token's position id is its place in its conversation, and it may attend to the
tokens of its node's ancestors, given as intervals of the emitted order.

How the order is found without a walk: let a node's *run* be the smallest id of
a conversation through it.  The nodes of one run follow each other, and the
distinct runs on a conversation's path, in order, are a sort key whose
lexicographic order is depth first.  A key is as long as its path has branches,
not as it has turns.  So the order comes from a minimum per node, a range-
partitioned sort of the keys and a running total of token counts, and no task
ever holds a tree.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.bpe_codec import ByteBpe, PieceMemo
from ledgerlens.llm.common import load_ranks, running_total, ship_package, slices, stage

START, END = "<|im_start|>", "<|im_end|>"
#: Stands for a null conversation id inside the operator.
NULL_ID = -(1 << 63)


def escape(text: str) -> str:
    """No ``<|`` is left, so a text can't hold a control string; see :func:`unescape`."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\([\\|])", r"\1", text)


def escape_role(role: str) -> str:
    """As :func:`escape`, and on one line."""
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\([\\|n])", lambda m: "\n" if m[1] == "n" else m[1], role)


class TurnCodec:
    """A turn's formatted text to token ids and back; the two control strings have the ids after the vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe = ByteBpe(ranks)
        self.memo, self.split = PieceMemo(self.bpe), regex.compile(pattern)
        self.start, self.end = max(ranks.values()) + 1, max(ranks.values()) + 2

    def ids(self, text: str) -> list[int]:
        return [i for p in self.split.findall(text) for i in memoryview(self.memo[p]).cast("I")]

    def encode(self, role: str, text: str) -> tuple[list[int], int, int]:
        """Ids, and from where to where they are the text's."""
        head, body = [self.start, *self.ids(escape_role(role) + "\n")], self.ids(escape(text))
        return [*head, *body, self.end, *self.ids("\n")], len(head), len(head) + len(body)

    def text(self, ids: list[int]) -> str:
        out, run = [], []
        for i in [*ids, None]:
            if i is None or i in (self.start, self.end):
                out += [self.bpe.decode(run).decode("utf-8"), "" if i is None else START if i == self.start else END]
                run = []
            else:
                run.append(i)
        return "".join(out)

    def parse(self, formatted: str) -> tuple[str, str]:
        """Role and text of a formatted turn."""
        m = re.fullmatch(re.escape(START) + r"([^\n]*)\n(.*)" + re.escape(END) + "\n", formatted, re.S)
        if not m or "<|" in m[1] + m[2]:
            raise ValueError("not a formatted turn")
        return unescape_role(m[1]), unescape(m[2])


def _turns(conversations: DataFrame, ranks, pattern: str, loss_roles: tuple[str, ...]) -> DataFrame:
    """A row per turn: ``cid, depth, node`` (digest of the turn and all before
    it), ``pos`` (tokens before it), ``ids`` and the loss interval in them.
    Conversations stream through sorted partitions, whatever their length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TurnCodec(ranks.value, pattern)
        last, node, depth, pos = None, b"", 0, 0
        for b in slices(batches):
            out: list[list] = [[] for _ in range(8)]
            for cid, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if cid != last:
                    last, node, depth, pos = cid, b"", 0, 0
                raw = role.encode()
                node = hashlib.sha256(node + b"%d:" % len(raw) + raw + text.encode()).digest()[:16]
                ids, at, to = codec.encode(role, text)
                learn = role in loss_roles
                for column, v in zip(out, (cid, depth, node, pos, len(ids), ids, at if learn else 0, to if learn else 0), strict=True):
                    column.append(v)
                depth, pos = depth + 1, pos + len(ids)
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
                                             ["cid", "depth", "node", "pos", "n_tokens", "ids", "loss_from", "loss_to"])

    rows = conversations.select(F.coalesce(F.col("conv_id").cast("bigint"), F.lit(NULL_ID)).alias("cid"), "turn",
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (rows.repartition("cid").sortWithinPartitions("cid", "turn", "role", "text").select("cid", "role", "text")
            .mapInArrow(run, "cid bigint, depth bigint, node binary, pos bigint, n_tokens bigint, ids array<int>, loss_from int, loss_to int"))


def format_tree(conversations: DataFrame, ranks_path: str, pattern: str,
                loss_roles: tuple[str, ...] = ("assistant",)) -> tuple[DataFrame, DataFrame]:
    """Format all conversations (columns ``conv_id, turn, role, text``; others
    are ignored) and return two tables.

    ``blocks``, one row per tree node: ``tree`` and ``run`` (ids), ``start`` (of
    its tokens in its tree), ``position`` (position id of its first token),
    ``ids``, ``loss_from`` and ``loss_to`` (the tokens under the loss mask, from
    the node's first), ``attends`` (ancestor intervals, in order).

    ``members``, one row per conversation: ``conv_id, n_turns, tree, spans``
    (intervals that hold the whole conversation, in order).

    A turn reads ``<|im_start|>role\\n text <|im_end|>\\n`` (without the spaces)
    with backslashes doubled and ``<|`` written ``<\\|`` inside role and text.
    Null roles and texts are empty; a null conversation id is one conversation;
    null turns come first, equal turns are ordered by role and text, and repeated
    rows are turns of their own.  Empty input gives empty tables."""
    spark = conversations.sparkSession
    ship_package(spark)
    ranks = spark.sparkContext.broadcast(load_ranks(ranks_path))
    turns = stage(_turns(conversations, ranks, pattern, loss_roles))
    # Written, so that the join below is one of two plain shuffles, which Spark splits where a node is hot.
    runs_of = stage(turns.groupBy("node").agg(F.min("cid").alias("run")))
    path = stage(turns.select("cid", "depth", "node", "pos", "n_tokens").join(runs_of, "node"))
    sizes = path.filter("cid = run").groupBy("run").agg(F.min("pos").alias("first_pos"), F.sum("n_tokens").alias("total"))
    convs = path.groupBy("cid").agg(F.sort_array(F.collect_set("run")).alias("key"), F.max("run").alias("run"),
                                    F.max(F.col("pos") + F.col("n_tokens")).alias("end_pos"), F.count(F.lit(1)).alias("n_turns"))
    ordered = convs.filter("cid = run").select("run", "key").join(sizes, "run")
    runs = running_total(ordered, ["key"], "total", "start").select("run", "key", "first_pos", "start")
    at = runs.select(F.col("run").alias("m"), F.col("first_pos").alias("p"), F.col("start").alias("s"))
    # The path through each run it passes: from that run's start as far as the next one branches off.
    steps = F.sort_array(F.collect_list(F.struct("i", "m", "p", "s")))
    lines = (runs.select("run", F.posexplode("key").alias("i", "m")).join(at, "m").groupBy("run").agg(steps.alias("steps")))
    tree_start = F.col("steps")[0]["s"]
    above = F.transform(F.slice("steps", 1, F.size("steps") - 1), lambda x, i: F.struct(
        x["m"].alias("run"), (x["s"] - tree_start).alias("from"), (x["s"] - tree_start + F.get("steps", i + 1)["p"] - x["p"]).alias("to")))
    own = F.element_at("steps", -1)
    lines = stage(lines.select("run", F.col("steps")[0]["m"].alias("tree"), above.alias("above"), (own["s"] - tree_start).alias("start"), own["p"].alias("first_pos")))
    span = lambda to: F.concat("above", F.array(F.struct(F.col("run"), F.col("start").alias("from"), to.alias("to"))))
    here = F.col("start") + F.col("pos") - F.col("first_pos")
    # The narrow tables meet first, so that ids are shuffled once.
    homes = path.filter("cid = run").select("node", "cid", "run").join(lines, "run")
    blocks = (turns.join(homes, ["node", "cid"])
              .select("tree", "run", here.alias("start"), F.col("pos").alias("position"), "ids", "loss_from", "loss_to", span(here).alias("attends")))
    end = F.col("start") + F.col("end_pos") - F.col("first_pos")
    members = convs.drop("key").join(lines, "run").select(
        F.when(F.col("cid") != NULL_ID, F.col("cid")).alias("conv_id"), "n_turns", "tree", span(end).alias("spans"))
    return stage(blocks), stage(members)


def read_back(blocks: DataFrame, members: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Decode every conversation from the emitted tokens: ``conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars``.  Its blocks are
    found by its spans and stream past in order of position."""
    ship_package(blocks.sparkSession)
    ranks = blocks.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TurnCodec(ranks.value, pattern)
        state: list = []

        def rows(done: list[list]) -> pa.RecordBatch:
            cols = [[c for c, *_ in done], [n for _, n, *_ in done], [x[2].hexdigest() for x in done], [x[3] for x in done], [x[4].hexdigest() for x in done], [x[5] for x in done]]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, kinds, strict=True)],
                                              ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in slices(batches):
            done = []
            for cid, ids, at, to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not state or state[0] != cid:
                    if state:
                        done.append(state)
                    state = [cid, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                formatted = codec.text(ids)
                role, text = codec.parse(formatted)
                learned = unescape(codec.text(ids[at:to]))
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(learned)
                state[4].update(learned.encode())
                state[5] += len(formatted)
            if done:
                yield rows(done)
        if state:
            yield rows([state])

    spans = members.select("conv_id", "tree", F.explode("spans").alias("span")).select("conv_id", F.col("span.run").alias("run"), F.col("span.from").alias("a"), F.col("span.to").alias("z"))
    found = spans.join(blocks, "run").filter("start >= a and start < z")
    return (found.repartition("conv_id").sortWithinPartitions("conv_id", "position").select("conv_id", "ids", "loss_from", "loss_to")
            .mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"))
