"""Chat formatting of reply trees.

A message table holds trees of replies (tree, message, parent, role, text, score). Messages with a
single reply form chains: pointer doubling (self-joins, as many as the logarithm of the longest
chain) gives every message the top of its chain and its place there. Further self-joins, one for
each level of branching, enumerate the chains of every root-to-leaf path. Branches are ranked by
the sum of their scores, and each chosen path is formatted as one conversation.

The template marks turns and escapes control strings inside of roles and texts, so that a
formatted conversation can be read back exactly.

Defined results: a null text or role is empty; null trees are one tree; a message whose parent is
missing begins a tree of its own below the same tree id; messages on a cycle have no root and no
path; repeated (tree, message) rows raise no error but make repeated turns; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veraz.llm.shared import checkpoint

# The strings that steer a chat model of the usual instruction format.
CONTROL = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>")


@dataclass(frozen=True)
class Template:
    """``<s>`` then for every turn ``[INST]role[/INST]text</s>``; ``~`` is the escape sign."""

    control: tuple[str, ...] = CONTROL

    def escape(self, text: str) -> str:
        text = text.replace("~", "~0")
        for c in self.control:
            text = text.replace(c, f"{c[0]}~1{c[1:]}")
        return text

    def unescape(self, text: str) -> str:
        return text.replace("~1", "").replace("~0", "~")

    def format(self, turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
        """The formatted conversation and the spans (code points, end exclusive) of what is learnt."""
        out, at, spans = ["<s>"], 3, []
        for role, text in turns:
            head, body = f"[INST]{self.escape(role)}[/INST]", self.escape(text)
            if role == learn:
                spans.append((at + len(head), at + len(head) + len(body)))
            out += (head, body, "</s>")
            at += len(head) + len(body) + 4
        return "".join(out), spans

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """The turns of a formatted conversation."""
        if not formatted.startswith("<s>"):
            raise ValueError("not a formatted conversation")
        turns = []
        for part in formatted[3:].split("</s>")[:-1]:
            role, text = part.removeprefix("[INST]").split("[/INST]")
            turns.append((self.unescape(role), self.unescape(text)))
        return turns


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def chains(messages: DataFrame) -> DataFrame:
    """(tree, node, parent, score) -> (tree, node, score, top, place): the first message of the
    chain that the message is in and its distance from it. A chain goes on while a message has one reply."""
    only = messages.where(F.col("parent").isNotNull()).groupBy("tree", "parent").agg(F.count("*").alias("replies")).where("replies = 1").select(F.col("tree").alias("t"), F.col("parent").alias("p"))
    known = messages.select(F.col("tree").alias("t"), F.col("node").alias("p")).distinct()
    steps = only.alias("o").join(known.alias("k"), _same(F.col("o.t"), F.col("k.t")) & (F.col("o.p") == F.col("k.p")), "left_semi")
    m, s = messages.alias("m"), steps.alias("s")
    state = m.join(s, _same(F.col("m.tree"), F.col("s.t")) & (F.col("m.parent") == F.col("s.p")), "left").select("m.tree", "m.node", "m.score", F.col("s.p").alias("ptr"), F.coalesce("s.p", "m.node").alias("top"), F.when(F.col("s.p").isNotNull(), 1).otherwise(0).cast("long").alias("place"))
    state = checkpoint(state)
    ended, going = [state.where("ptr is null")], state.where("ptr is not null")
    before = -1
    while (pending := going.count()) not in (0, before):
        # Each round ends the pointers of more messages, and only the others go on. Those on a
        # cycle never end.
        before = pending
        reached = reduce(DataFrame.unionByName, [*ended, going]).select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("ptr").alias("next"), F.col("top").alias("above"), F.col("place").alias("more"))
        a, b = going.alias("a"), reached.alias("b")
        moved = checkpoint(a.join(b, _same(F.col("a.tree"), F.col("b.t")) & (F.col("a.ptr") == F.col("b.n"))).select("a.tree", "a.node", "a.score", F.col("b.next").alias("ptr"), F.col("b.above").alias("top"), (F.col("a.place") + F.col("b.more")).alias("place")))
        ended.append(moved.where("ptr is null"))
        going = moved.where("ptr is not null")
    return reduce(DataFrame.unionByName, ended).drop("ptr")


def paths(messages: DataFrame, per_tree: int | None = 1) -> DataFrame:
    """The ``per_tree`` best root-to-leaf paths of every tree (None: all of them) as rows
    (tree, leaf, rank, path_score, node, position). Ties go to the smaller leaf."""
    messages = messages.groupBy("tree", "node").agg(F.max(F.struct("parent", "score")).alias("m")).select("tree", "node", "m.parent", "m.score")
    state = checkpoint(chains(messages))
    parents = messages.where("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    segments = state.groupBy("tree", "top").agg(F.count("*").alias("n"), F.sum("score").alias("total"), F.max_by("node", "place").alias("end"))
    up = messages.select(F.col("tree").alias("mt"), F.col("node").alias("mn"), F.col("parent").alias("mp"))
    place = state.select(F.col("tree").alias("st"), F.col("node").alias("sn"), F.col("top").alias("stop"))
    # What stands above a chain: the chain of its top's parent.
    linked = segments.join(up, _same(F.col("tree"), F.col("mt")) & (F.col("top") == F.col("mn")), "left").join(place, _same(F.col("tree"), F.col("st")) & (F.col("mp") == F.col("sn")), "left").select("tree", "top", "n", "total", "end", F.col("stop").alias("above"))
    linked = checkpoint(linked)
    leaves = linked.join(parents, _same(F.col("tree"), F.col("t")) & (F.col("end") == F.col("p")), "left_anti")
    open_ = leaves.select("tree", F.col("end").alias("leaf"), F.col("top").alias("segment"), "above", F.lit(0).alias("level"), "n", "total")
    found = [open_ := checkpoint(open_)]
    step = linked.select(F.col("tree").alias("lt"), F.col("top").alias("segment"), F.col("above").alias("next"), "n", "total")
    while open_.where("above is not null").limit(1).count():
        open_ = checkpoint(open_.drop("segment", "n", "total").join(step, _same(F.col("tree"), F.col("lt")) & (F.col("above") == F.col("segment"))).select("tree", "leaf", "segment", F.col("next").alias("above"), (F.col("level") + 1).alias("level"), "n", "total"))
        found.append(open_)
    on_path = reduce(DataFrame.unionByName, found)
    branches = on_path.groupBy("tree", "leaf").agg(F.sum("total").alias("path_score"))
    best = W.partitionBy("tree").orderBy(F.desc_nulls_last("path_score"), "leaf")
    ranked = branches.withColumn("rank", F.row_number().over(best))
    if per_tree is not None:
        ranked = ranked.where(F.col("rank") <= per_tree)
    chosen = ranked.select(F.col("tree").alias("rt"), F.col("leaf").alias("rl"), "rank", "path_score")
    upward = W.partitionBy("tree", "leaf").orderBy(F.desc("level")).rowsBetween(W.unboundedPreceding, -1)
    placed = on_path.join(chosen, _same(F.col("tree"), F.col("rt")) & (F.col("leaf") == F.col("rl"))).withColumn("before", F.coalesce(F.sum("n").over(upward), F.lit(0)))
    nodes = state.select(F.col("tree").alias("nt"), "node", F.col("top").alias("ntop"), "place")
    return placed.join(nodes, _same(F.col("tree"), F.col("nt")) & (F.col("segment") == F.col("ntop"))).select("tree", "leaf", "rank", "path_score", "node", (F.col("before") + F.col("place")).alias("position"))


def format_trees(df: DataFrame, tree_col: str, message_col: str, parent_col: str, role_col: str = "role", text_col: str = "text", score: Column | None = None, per_tree: int | None = 1, template: Template = Template(), learn: str = "assistant") -> DataFrame:
    """One row per chosen path: tree (named ``tree_col``), leaf, rank, path_score, n_turns long,
    formatted string, loss array<struct<begin: int, end: int>> (code points, end exclusive)."""
    messages = df.select(F.col(tree_col).alias("tree"), F.col(message_col).alias("node"), F.col(parent_col).alias("parent"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), (F.lit(0.0) if score is None else score).cast("double").alias("score"))
    kinds = dict(messages.dtypes)
    chosen = paths(messages.select("tree", "node", "parent", "score"), per_tree)
    words = messages.select(F.col("tree").alias("wt"), F.col("node").alias("wn"), "role", "text")
    turns = chosen.join(words, _same(F.col("tree"), F.col("wt")) & (F.col("node") == F.col("wn"))).groupBy("tree", "leaf", "rank", "path_score").agg(F.sort_array(F.collect_list(F.struct("position", "role", "text"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [template.format([(t["role"], t["text"]) for t in turns], learn) for turns in batch.column(4).to_pylist()]
            n = [len(t) for t in batch.column(4).to_pylist()]
            spans = pa.array([[{"begin": a, "end": b} for a, b in s] for _, s in done], pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))
            yield pa.record_batch([*(batch.column(i) for i in range(4)), pa.array(n, pa.int64()), pa.array([f for f, _ in done], pa.string()), spans], ["tree", "leaf", "rank", "path_score", "n_turns", "formatted", "loss"])

    schema = f"tree {kinds['tree']}, leaf {kinds['node']}, rank int, path_score double, n_turns long, formatted string, loss array<struct<begin: int, end: int>>"
    return turns.mapInArrow(run, schema).withColumnRenamed("tree", tree_col)


def read_back(df: DataFrame, id_col: str, formatted_col: str = "formatted", loss_col: str = "loss", template: Template = Template()) -> DataFrame:
    """``id_col``, turns array<struct<role: string, text: string>>, learnt string (the text under
    the loss mask, unescaped) and formatted string, all read from formatted conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            formatted, loss = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            turns = [[{"role": r, "text": t} for r, t in template.parse(f)] for f in formatted]
            learnt = ["".join(template.unescape(f[s["begin"] : s["end"]]) for s in spans) for f, spans in zip(formatted, loss, strict=True)]
            yield pa.record_batch([batch.column(0), pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), pa.array(learnt, pa.string()), batch.column(1)], ["id", "turns", "learnt", "formatted"])

    rows = df.select(F.col(id_col).alias("id"), F.col(formatted_col).alias("formatted"), F.col(loss_col).alias("loss"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, turns array<struct<role: string, text: string>>, learnt string, formatted string").withColumnRenamed("id", id_col)


def linear_trees(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees without branches: message numbers by
    turn (ties: by role and text), each message a reply to the one before."""
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("message", F.row_number().over(order))
    return rows.withColumn("parent", F.when(F.col("message") > 1, F.col("message") - 1))
