"""The prefix tree of conversations, by burst tries.

A conversation is the sequence of its turns, a turn is the digest of its role and text.
Equal conversations are folded first: one of them, the one with the smallest id, stands
for all. Containers then hold suffixes under trie heads. At the start one container holds
every conversation under the root. A container of more than ``limit`` turns bursts: its
suffixes are dealt by their next turn, which makes the heads of the next level. What is
left are containers of bounded size (or with a single suffix, of any length). Each is
sorted and swept into nodes by one task; a single suffix is walked from its end, row by
row, and never held. The heads get their sums from the containers, level by level.

* A burst moves the next turns of oversized containers only. One turn that most
  conversations begin with costs one more round and no large group; the number of rounds
  is the depth down to which more than ``limit`` turns share a prefix.
* The ids that end at a node are hashed in order. They are dealt to ranges, joined there
  to runs of text, and only the runs of one node meet, in order, in one task.

Defined cases: rows without a ``conv_id`` are left out. A null role or text is empty, and
null turns come first; rows of one turn number follow each other by their digest. A
conversation without turns ends at the root. Repeated rows are turns of their own. Other
columns are not looked at. Without conversations there are no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import record_batch, stored

#: Turns in a container, at most.
LIMIT = 8192
ROOT = b"\0" * 16
_EMPTY = hashlib.sha256(b"").hexdigest()
_RUN = 1 << 20  # bytes of joined ids in a row
_ROWS = 10_000  # nodes in a batch


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, id, words``: the turns in order, from 1; a turn is the digest of
    its role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id",
        "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("id"),
        F.regexp_count(text, F.lit("[^ \\t-\\r]+")).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id")
    return rows.withColumn("pos", F.row_number().over(order).cast("long")).drop("turn")


def with_borrowed_heads(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like others: (all ids, their turns). The first ``h`` turns
    of conversation ``c`` are those of the last multiple of ``every``, ``h`` being the
    CRC of its id modulo ``most``; its own turns follow from the one after its first ``h``."""
    turns = stored(turns, "turns")
    lengths = stored(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "lengths")
    c = F.col("conv_id")
    convs = lengths.select(
        c, (c - c % every).alias("base"), (F.crc32(c.cast("string").cast("binary")) % most).alias("h")
    )
    bases = lengths.select(c.alias("base"), F.col("n").alias("base_n"))
    convs = stored(
        convs.join(bases, "base", "left")
        .select(c, "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")),
        "conversations",
    )
    borrowed = (
        turns.where(F.col("pos") < most).withColumnRenamed("conv_id", "base")
        .join(convs.where("taken > 0"), "base").where("pos <= taken")
        .select(c, "pos", "id", "words")
    )
    own = (
        turns.join(convs.select("conv_id", "h", "taken").hint("merge"), "conv_id").where("pos > h")
        .select(c, (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id", "words")
    )
    return convs.select("conv_id"), borrowed.unionByName(own)


def folded(ids: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Equal conversations as one: (``rep, n, len`` of each group, ``rep, conv_id`` of
    every conversation)."""
    print_ = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("len"),
        F.bit_xor(F.xxhash64("pos", "id")).alias("x"),
        F.bit_xor(F.xxhash64("id", F.lit("second"), "pos")).alias("y"),
    )
    zero = F.lit(0).cast("long")
    known = stored(
        ids.join(print_, "conv_id", "left")
        .select("conv_id", *[F.coalesce(k, zero).alias(k) for k in ("len", "x", "y")]),
        "digests",
    )
    groups = stored(
        known.groupBy("len", "x", "y").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n")),
        "groups",
    )
    members = known.join(groups.select("len", "x", "y", "rep").hint("merge"), ["len", "x", "y"])
    return groups.select("rep", "n", "len"), members.select("rep", "conv_id")


def _joined_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``rep, conv_id`` to the ids of each ``rep`` in runs of bounded text."""
    rep, first, parts, size, out = None, None, [], 0, []

    def run():
        return (rep, first, ",".join(parts).encode())

    schema = "rep long, first long, ids binary"
    for batch in batches:
        for r, c in zip(*(col.to_pylist() for col in batch.columns)):
            if parts and (r != rep or size > _RUN):
                out.append(run())
                parts, size = [], 0
            if not parts:
                rep, first = r, c
            parts.append(str(c))
            size += len(parts[-1]) + 1
        if len(out) >= _ROWS or sum(len(o[2]) for o in out) > 8 * _RUN:
            yield record_batch(schema, *zip(*out))
            out = []
    if parts:
        out.append(run())
    if out:
        yield record_batch(schema, *zip(*out))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs to the digest of all ids of each ``rep``."""
    rep, digest, out = None, None, []
    schema = "rep long, ends_sha256 string"
    for batch in batches:
        for r, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if digest is not None and r == rep:
                digest.update(b"," + ids)
                continue
            if digest is not None:
                out.append((rep, digest.hexdigest()))
            rep, digest = r, hashlib.sha256(ids)
        if len(out) >= _ROWS:
            yield record_batch(schema, *zip(*out))
            out = []
    if digest is not None:
        out.append((rep, digest.hexdigest()))
    if out:
        yield record_batch(schema, *zip(*out))


def end_digests(members: DataFrame) -> DataFrame:
    """``rep, ends_sha256``: the hash of the ids of each group, ascending, joined by
    commas."""
    runs = (
        members.repartitionByRange("rep", "conv_id").sortWithinPartitions("rep", "conv_id")
        .mapInArrow(_joined_runs, "rep long, first long, ids binary")
    )
    return runs.repartition("rep").sortWithinPartitions("rep", "first").mapInArrow(
        _digests, "rep long, ends_sha256 string"
    )


def burst(groups: DataFrame, turns: DataFrame, limit: int = LIMIT) -> tuple[list[DataFrame], DataFrame]:
    """Deal suffixes until no container is oversized: (per level the containers, the
    suffixes that stay in one).

    Containers: ``head, parent, words`` (of the last turn), ``conv_id`` (the smallest),
    ``n_convs, end_rep`` (the group that ends here) and ``burst``. Suffixes: ``head,
    depth, rep, n`` and ``alone``."""
    entries = groups.select(
        "rep", "n", "len", F.lit(ROOT).alias("head"), F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("words"),
    )
    levels, settled, depth = [], [], 0
    while True:
        entries = stored(entries, "suffixes")
        left = F.col("len") - depth
        containers = stored(
            entries.groupBy("head", "parent", "words").agg(
                F.min("rep").alias("conv_id"), F.sum("n").alias("n_convs"),
                F.max(F.when(left == 0, F.col("rep"))).alias("end_rep"),
                ((F.sum(left) > limit) & (F.count(F.lit(1)) > 1)).alias("burst"),
                (F.count(F.lit(1)) == 1).alias("alone"),
            ),
            "containers",
        )
        levels.append(containers)
        kinds = containers.select("head", "burst", "alone")
        marked = entries.join(kinds, "head")
        settled.append(
            marked.where(~F.col("burst")).select("head", F.lit(depth).cast("long").alias("depth"), "rep", "n", "alone")
        )
        if containers.where("burst").isEmpty():
            return levels, reduce(DataFrame.unionByName, settled)
        depth += 1
        following = turns.where(F.col("pos") == depth).select("rep", "id", F.col("words").alias("_words"))
        entries = (
            marked.where(F.col("burst") & (F.col("len") >= depth)).join(following, "rep")
            .select(
                "rep", "n", "len", F.unhex(F.md5(F.concat("head", "id"))).alias("head"),
                F.col("head").alias("parent"), F.col("_words").alias("words"),
            )
        )


#: ``head`` is null but for the top of a container; ``saved`` of a top is that below it.
_NODES = (
    "head binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, end_rep long"
)


class _Node:
    __slots__ = ("words", "n", "least", "children", "leaves", "saved", "end")

    def __init__(self, words: int):
        self.words, self.n, self.least, self.children = words, 0, None, []
        self.leaves, self.saved, self.end = 0, 0, None


def sweep(head: bytes, depth: int, suffixes: list[tuple[int, int, list[tuple[bytes, int]]]]) -> list[list]:
    """The nodes of a container out of its ``(rep, n, turns)``, sorted so that every
    node's conversations follow each other."""
    out: list[list] = []
    path = [_Node(0)]
    keys: list[bytes] = []

    def close() -> None:
        node, level = path.pop(), depth + len(path)
        top = not path
        if not node.children:
            node.leaves = 1
        if not top:
            node.saved += (node.n - 1) * node.words
        for child in node.children:
            out[child][3] = node.least
        out.append([
            head if top else None, level, node.least, None, node.n, len(node.children), node.leaves,
            node.saved, node.end,
        ])
        if not top:
            up = path[-1]
            up.n += node.n
            up.least = node.least if up.least is None else min(up.least, node.least)
            up.children.append(len(out) - 1)
            up.leaves += node.leaves
            up.saved += node.saved

    for rep, n, turns in sorted(suffixes, key=lambda s: [k for k, _ in s[2]]):
        shared = 0
        while shared < min(len(keys), len(turns)) and keys[shared] == turns[shared][0]:
            shared += 1
        while len(path) > shared + 1:
            close()
        path += [_Node(words) for _, words in turns[shared:]]
        keys = [k for k, _ in turns]
        last = path[-1]
        last.n += n
        last.least = rep if last.least is None else min(last.least, rep)
        last.end = rep
    while path:
        close()
    return out


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by container and suffix, last turn first, to nodes."""
    here, level, held, out = None, 0, [], []
    chain = [0, 0]  # turns so far and tokens saved of a single suffix
    for batch in batches:
        for head, depth, rep, n, alone, pos, key, words in zip(*(c.to_pylist() for c in batch.columns)):
            if alone:
                if pos == depth:
                    out.append([head, depth, rep, None, n, int(chain[0] > 0), 1, chain[1], None if chain[0] else rep])
                    chain = [0, 0]
                else:
                    chain[1] += (n - 1) * words
                    out.append([None, pos, rep, rep, n, int(chain[0] > 0), 1, chain[1], None if chain[0] else rep])
                    chain[0] += 1
            else:
                if head != here:
                    if held:
                        out += sweep(here, level, [(r, m, t[::-1]) for r, m, t in held])
                    here, level, held = head, depth, []
                if not held or held[-1][0] != rep:
                    held.append((rep, n, []))
                if pos > depth:
                    held[-1][2].append((key, words))
            if len(out) >= _ROWS:
                yield record_batch(_NODES, *zip(*out))
                out = []
    if held:
        out += sweep(here, level, [(r, m, t[::-1]) for r, m, t in held])
    if out:
        yield record_batch(_NODES, *zip(*out))


def swept(settled: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of all containers, each container in one task."""
    tops = settled.select("*", F.col("depth").alias("pos"), F.lit(None).cast("binary").alias("id"), F.lit(0).cast("long").alias("words"))
    rows = settled.join(turns, "rep").where("pos > depth").select(*tops.columns)
    return (
        tops.unionByName(rows).repartition("head")
        .sortWithinPartitions("head", "rep", F.desc("pos"))
        .select("head", "depth", "rep", "n", "alone", "pos", "id", "words")
        .mapInArrow(_swept, _NODES)
    )


COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def prefix_trie(ids: DataFrame, turns: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node: ``conv_id`` (the smallest member), ``depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``ids`` has every ``conv_id``, also those without a turn; ``turns`` has ``conv_id,
    pos`` (from 1, without gaps), ``id`` and ``words``."""
    turns = stored(turns, "rebuilt")
    groups, members = folded(ids, turns)
    # of equal conversations only the turns of the first go on
    kept = stored(
        turns.withColumnRenamed("conv_id", "rep").join(groups.select("rep").hint("merge"), "rep", "left_semi"),
        "distinct-turns",
    )
    ends = stored(end_digests(members), "ends")
    levels, settled = burst(groups, kept, limit)
    found = stored(swept(settled, kept), "swept")
    tops = found.where(F.col("head").isNotNull()).select("head", "n_children", "n_leaves", "saved_tokens")

    nodes = [found.where(F.col("head").isNull()).drop("head")]
    below = None  # the heads of the level below, with their sums
    own = (F.col("n_convs") - 1) * F.col("words")
    for depth in reversed(range(len(levels))):
        containers = levels[depth]
        sums = tops
        if below is not None:
            dealt = below.groupBy("parent").agg(
                F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
                F.sum("saved_tokens").alias("saved_tokens"),
            )
            sums = tops.unionByName(dealt.withColumnRenamed("parent", "head"))
            named = containers.where("burst").select(F.col("head").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
            nodes.append(below.join(named, "parent").select(*nodes[0].columns))
        below = stored(
            containers.join(sums, "head").select(
                "head", "parent", F.lit(depth).cast("long").alias("depth"), "conv_id", "n_convs", "n_children",
                "n_leaves", (F.col("saved_tokens") + own).alias("saved_tokens"), "end_rep",
            ),
            "heads",
        )
    nodes.append(below.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*nodes[0].columns))
    every = reduce(DataFrame.unionByName, nodes)
    # most nodes end no conversation: they take no part in the join
    ended = every.where(F.col("end_rep").isNotNull()).join(ends, F.col("end_rep") == F.col("rep"))
    other = every.where(F.col("end_rep").isNull()).withColumn("ends_sha256", F.lit(_EMPTY))
    return ended.select(*COLUMNS).unionByName(other.select(*COLUMNS))
