"""Near-duplicate documents by SimHash fingerprints and pivot distances.

A fingerprint has a bit for each majority among the hashes of a text's word shingles.
Two fingerprints link when they differ in few bits. Equal texts and equal fingerprints
are one node from the start, so a group of copies is one row.

* Reference fingerprints (pivots) are fixed and shared by all tasks. If two
  fingerprints differ in ``r`` bits, their distances to any pivot differ by at most
  ``r``: a pair whose largest coordinate difference exceeds the radius is discarded
  from the table of distances alone, what is left is verified on the bits.
* A distance table has no equality to join on, so the pairs it looks at come from
  blocks: of ``radius + 3`` blocks of bits at least three agree within the radius, and
  every choice of three is a key. No linked pair is missed.
* Inside a key, nodes already reached are not compared again: the links given out are a
  forest, never all pairs. A key with more than ``GROUP`` nodes is cut into parts and
  every pair of parts is a group of its own, so no task holds an unbounded group.
* Components come from star steps over the links (``components``).

Defined cases: a null text is empty; a text without words has fingerprint zero, linked
like any other. A null ``doc_id`` gets a fingerprint and a component, but is never
the smallest of one that has other ids. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.arrays import U, bit_counts, packed_bits
from shelfmark.llm.common import map_chunks, record_batch, stored, utf8
from shelfmark.llm.components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
PIVOTS = 24
GROUP = 50_000

_pivots = np.random.default_rng(64).integers(0, 2**64, PIVOTS, dtype=U, endpoint=False)


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of each run of ``size`` words, words joined by a space."""
    words = text.lower().split()
    if not words:
        return []
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    return [
        digest(flat[s:e], SEED)
        for s, e in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    ]


def fingerprints_of(texts: list[bytes], size: int) -> np.ndarray:
    lists = [shingle_hashes(t, size) for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    out = np.zeros(len(texts), U)
    full = counts > 0
    if full.any():
        flat = np.fromiter((h for hs in lists for h in hs), U, int(counts.sum()))
        offsets = np.concatenate([[0], np.cumsum(counts[full])])
        out[full] = packed_bits(bit_counts(flat, offsets) * 2 > counts[full][:, None])
    return out


def fingerprints(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint`` (a signed 64-bit value) of every row."""
    schema = "doc_id long, fingerprint long"

    def run(ids, texts):
        return record_batch(schema, ids, fingerprints_of(texts, size).view(np.int64))

    return map_chunks(documents.select("doc_id", utf8("text").alias("text")), run, schema, text=1)


def block_masks(radius: int) -> list[int]:
    """Masks of three of ``radius + 3`` blocks, as signed values."""
    edges = [64 * i // (radius + 3) for i in range(radius + 4)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(three) for three in combinations(blocks, 3)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def link_forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what lies within ``radius`` of each other, one for each
    value that is reached from another."""
    table = np.bitwise_count(values[:, None] ^ _pivots).astype(np.int16)
    rest = np.arange(len(values))
    reached = np.zeros(len(values), bool)
    links = []
    while len(rest):
        stack, rest = [rest[0]], rest[1:]
        while stack and len(rest):
            at = stack.pop()
            near = rest
            for p in range(0, PIVOTS, 8):  # most pairs go with the first pivots
                apart = np.abs(table[near, p : p + 8] - table[at, p : p + 8]).max(axis=1)
                near = near[apart <= radius]
                if not len(near):
                    break
            near = near[np.bitwise_count(values[near] ^ values[at]) <= radius]
            if len(near):
                links += [(int(values[at]), int(values[i])) for i in near]
                stack += near.tolist()
                reached[near] = True
                rest = rest[~reached[rest]]
    return links


def _groups(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links inside each run of rows with an equal key; rows come sorted by key."""

    def linked(values: list[np.ndarray]):
        found = link_forest(np.unique(np.concatenate(values)).view(U), radius)
        pairs = np.array(found, U).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"]
        )

    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:-1]])
        values = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(values)]):
            now = tuple(keys[:, a])
            if now != key and held:
                yield linked(held)
                held = []
            key = now
            held.append(values[a:b])
    if held:
        yield linked(held)


def fingerprint_links(values: DataFrame, radius: int = RADIUS, group: int = GROUP) -> DataFrame:
    """Links ``a, b`` between the distinct ``fingerprint`` values of ``values`` that
    connect everything within ``radius``."""
    masks = block_masks(radius)
    fp = F.col("fingerprint")
    keyed = values.select(
        fp,
        F.posexplode(F.array(*[fp.bitwiseAND(F.lit(m)) for m in masks])).alias("choice", "key"),
    )
    sizes = keyed.groupBy("choice", "key").count().where("count > 1")
    parts = F.ceil(F.col("count") / group).cast("int")
    mine = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    keyed = (
        keyed.join(sizes, ["choice", "key"])
        .select("choice", "key", "fingerprint", parts.alias("parts"))
        .withColumn("mine", mine)
        # a part meets every part, itself included
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "choice", "key",
            F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
            "fingerprint",
        )
    )
    names = ["choice", "key", "low", "high"]
    return (
        keyed.repartition(*names).sortWithinPartitions(*names)
        .mapInArrow(lambda it: _groups(it, radius), "a long, b long")
        .distinct()
    )


def hex16(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def near_duplicates(
    documents: DataFrame, size: int = SHINGLE, radius: int = RADIUS, group: int = GROUP
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``documents``;
    ``component_id`` is the smallest id reachable over links."""
    prints = stored(fingerprints(documents, size), "fingerprints")
    distinct = stored(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")), "distinct"
    )
    links = stored(fingerprint_links(distinct, radius, group), "fingerprint-links")
    named = stored(
        distinct.join(components(links), F.col("fingerprint") == F.col("node"), "left")
        .select("fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root")),
        "named",
    )
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    # stored: a fingerprint that very many documents share may then be split in the join
    classes = stored(named.join(least, "root").select("fingerprint", "component_id"), "classes")
    return prints.join(classes, "fingerprint").select(
        "doc_id", hex16(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )
