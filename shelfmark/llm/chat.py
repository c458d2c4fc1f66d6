"""Conversations as training text: paths of reply trees, a template, a loss mask.

``reply_paths`` finds every path from a root to a leaf by iterative self-joins over
ids alone: a table of jumps doubles its length in each round, and each leaf collects the
ancestors a jump away from those it has, so a chain of ``n`` replies takes ``log2 n``
rounds. Branches are ranked by the mean score of their messages; text is joined once, to
the chosen ones.

The template marks a turn as ``<|im_start|>role``, a line break, the text and
``<|im_end|>``. Control strings begin with ``<|``; inside a role or a text a backslash
is put between the two characters (one more if there are some), and taken out when
read, so any text comes back as it was. The loss mask covers the texts of assistant
turns, without marks.

Defined cases: a null text or role is empty. Rows of a conversation with equal turns
follow each other by role and text; null turns come first; rows with a null ``conv_id``
are one conversation. A message whose parent is not in the table is a root. Messages
that reply to each other in a circle have no root and belong to no path. Extra columns
are not looked at.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import record_batch, stored

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

SCHEMA = "conv_id long, formatted string, loss_start array<int>, loss_end array<int>"
READ_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
    "loss_sha256 string, formatted_chars long"
)

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turns(
    turns: list[tuple[str, str]], loss_role: str = LOSS_ROLE
) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and the code points of it that the loss counts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == loss_role:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def reply_paths(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """``tree_id, leaf_id, node_id, depth, rank`` of the nodes on the ``best`` branches
    of each tree (all of them for None). ``messages`` has ``tree_id, node_id, parent_id,
    score``; a node id is unique in its tree."""
    nodes = stored(messages.select("tree_id", "node_id", "parent_id", "score"), "messages")
    named = nodes.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"))
    jumps = stored(
        nodes.join(named, _same("tree_id", "t") & (F.col("parent_id") == F.col("n")))
        .select("tree_id", "node_id", F.col("parent_id").alias("above")),
        "jumps",
    )
    parents = jumps.select(F.col("tree_id").alias("t"), F.col("above").alias("n")).distinct()
    reached = (
        nodes.join(parents, _same("tree_id", "t") & (F.col("node_id") == F.col("n")), "left_anti")
        .select("tree_id", F.col("node_id").alias("leaf_id"), "node_id", F.lit(0).alias("up"))
    )
    roots = nodes.join(
        jumps.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n")),
        _same("tree_id", "t") & (F.col("node_id") == F.col("n")), "left_anti",
    ).select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"))
    largest = nodes.groupBy("tree_id").count().agg(F.max("count")).first()[0] or 0
    length = 1
    while length < largest and not jumps.isEmpty():
        hop = jumps.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), "above")
        reached = stored(
            reached.unionByName(
                reached.join(hop, _same("tree_id", "t") & (F.col("node_id") == F.col("n")))
                .select("tree_id", "leaf_id", F.col("above").alias("node_id"), (F.col("up") + length).alias("up"))
            ),
            "reached",
        )
        two = hop.withColumnRenamed("above", "beyond")
        jumps = stored(
            jumps.join(two, _same("tree_id", "t") & (F.col("above") == F.col("n")))
            .select("tree_id", "node_id", F.col("beyond").alias("above")),
            "jumps",
        )
        length *= 2
    # a branch that reaches no root runs into a circle
    depths = (
        reached.join(roots, _same("tree_id", "t") & (F.col("node_id") == F.col("n")))
        .select(F.col("tree_id").alias("t"), F.col("leaf_id").alias("l"), F.col("up").alias("far"))
    )
    scored = (
        reached.join(
            nodes.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), "score"),
            _same("tree_id", "t") & (F.col("node_id") == F.col("n")),
        )
        .groupBy("tree_id", "leaf_id").agg(F.avg("score").alias("score"))
        .join(depths, _same("tree_id", "t") & (F.col("leaf_id") == F.col("l")))
        .select("tree_id", "leaf_id", "score", "far")
    )
    order = Window.partitionBy("tree_id").orderBy(
        F.desc_nulls_last("score"), F.desc("far"), "leaf_id"
    )
    ranked = scored.withColumn("rank", F.row_number().over(order))
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    ranked = ranked.select(
        F.col("tree_id").alias("t"), F.col("leaf_id").alias("l"), "far", "rank"
    )
    return reached.join(ranked, _same("tree_id", "t") & (F.col("leaf_id") == F.col("l"))).select(
        "tree_id", "leaf_id", "node_id", (F.col("far") - F.col("up")).alias("depth"), "rank"
    )


def chained(conversations: DataFrame) -> DataFrame:
    """Rows of conversations as messages of reply trees: each replies to the row before."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        F.col("conv_id").alias("tree_id"),
        F.row_number().over(order).cast("long").alias("node_id"),
        "role", "text",
    ).select(
        "*", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"),
        F.lit(1.0).alias("score"),
    )


def format_trees(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """``SCHEMA``: the chosen branches of each tree, each as one conversation."""
    messages = stored(messages.select("tree_id", "node_id", "parent_id", "score", "role", "text"), "trees")
    texts = messages.select(
        F.col("tree_id").alias("t"), F.col("node_id").alias("n"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = (
        reply_paths(messages, best)
        .join(texts, _same("tree_id", "t") & (F.col("node_id") == F.col("n")))
        .groupBy("tree_id", "leaf_id")
        .agg(F.array_sort(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))
        .select(F.col("tree_id").alias("conv_id"), "turns.role", "turns.text")
    )

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                ids, roles, texts = (c.to_pylist() for c in batch.slice(k, 200).columns)
                found = [format_turns(list(zip(r, t))) for r, t in zip(roles, texts)]
                yield record_batch(
                    SCHEMA, ids, [f for f, _ in found],
                    [[a for a, _ in s] for _, s in found], [[b for _, b in s] for _, s in found],
                )

    return turns.mapInArrow(run, SCHEMA)


def read_back(formatted: DataFrame) -> DataFrame:
    """``READ_SCHEMA`` of formatted conversations, from their text and mask alone."""

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                rows = []
                for conv, text, starts, ends in zip(*(c.to_pylist() for c in batch.slice(k, 200).columns)):
                    turns = read_turns(text)
                    loss = "".join(unescape(text[a:b]) for a, b in zip(starts, ends))
                    whole = "".join(f"{role}\n{body}\n" for role, body in turns)
                    rows.append((
                        conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(),
                        len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text),
                    ))
                if rows:
                    yield record_batch(READ_SCHEMA, *zip(*rows))

    columns = formatted.select("conv_id", "formatted", "loss_start", "loss_end")
    return columns.mapInArrow(run, READ_SCHEMA)
