"""Document fingerprints: weighted SimHash, and search within a Hamming radius.

Every term of a text, a word or a pair of neighbouring words, is hashed; each bit of
its hash votes plus or minus the term's weight, and a bit of the fingerprint is the sign
of its votes. Pairs are rarer than words and weigh more. A fingerprint has ``LANES`` * 64
bits, written as hexadecimal digits.

``within`` finds all fingerprints in a radius with permuted block tables: bits are cut
into blocks, and for every choice of blocks that must agree the fingerprint is permuted
so that those blocks come first; a join on that prefix gives the candidates, which are
verified on all bits. Equal fingerprints are one row of the tables, so copies cost
nothing and are counted, not paired.

``edited`` gives each text with its second half replaced by the beginning of the next
text in descending order of the id. Texts are dealt to ranges of ids once; the first of
a range is also given to the range before it, so each task reads its neighbours in order
and no task holds more than two texts.

Defined cases: a null text is empty. A text without words has one term, itself; its
fingerprint depends on its blanks. Rows that repeat a ``doc_id`` follow each other in
the order of their texts; rows without one come last. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.arrays import (
    U,
    bit_counts,
    joined,
    mix,
    pair,
    per_text,
    span_hashes,
    word_spans,
)
from shelfmark.llm.common import CHUNK_BYTES, map_chunks, record_batch, stored, utf8
from shelfmark.llm.sharding import range_number

LANES = 2
WORD_WEIGHT = 1
PAIR_WEIGHT = 3
RADIUS = 6

# A range of ids is read by one task, row after row. There are more of them the more rows
# there are; their first ids are known to the driver, which bounds their number.
RANGE_ROWS = 50_000
RANGES = (1024, 16_384)

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def fingerprint_bits(texts: list[bytes], lanes: int = LANES) -> np.ndarray:
    """One row of ``lanes * 64`` flags for each text."""
    out = np.zeros((len(texts), lanes * 64), bool)
    if not texts:
        return out
    texts = [t.lower() for t in texts]
    buf, offsets = joined(texts)
    starts, ends = word_spans(buf)
    words = span_hashes(buf, starts, ends)
    first = per_text(starts, offsets)
    counts = np.diff(first)
    full = counts > 0
    for k in np.flatnonzero(~full):
        blank = hashlib.blake2b(texts[k], digest_size=8 * lanes).digest()
        out[k] = np.unpackbits(np.frombuffer(blank, np.uint8), bitorder="little")
    if not full.any():
        return out
    edges = np.concatenate([first[:-1][full], [len(words)]])
    pairs = pair(words[:-1], words[1:])
    inside = np.ones(len(pairs), bool)
    inside[edges[1:-1] - 1] = False
    pairs = pairs[inside]
    sizes = np.diff(edges)
    two = sizes > 1
    pair_edges = np.concatenate([[0], np.cumsum(sizes[two] - 1)])
    for lane in range(lanes):
        salt = U(0x2545F4914F6CDD1D * (lane + 1) & (1 << 64) - 1)
        votes = WORD_WEIGHT * (2 * bit_counts(mix(words ^ salt), edges) - sizes[:, None])
        if two.any():
            votes[two] += PAIR_WEIGHT * (
                2 * bit_counts(mix(pairs ^ salt), pair_edges) - (sizes[two] - 1)[:, None]
            )
        out[np.flatnonzero(full), lane * 64 : lane * 64 + 64] = votes > 0
    return out


def hex_of(bits: np.ndarray) -> list[str]:
    """Hexadecimal digits of rows of flags, the first flag the highest bit."""
    return [row.tobytes().hex() for row in np.packbits(bits, axis=1)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal bits."""
    return 1.0 - (a != b).mean(axis=1)


def fingerprints(documents: DataFrame, lanes: int = LANES) -> DataFrame:
    """``doc_id, fingerprint`` of every row."""
    schema = "doc_id long, fingerprint string"

    def run(ids, texts):
        return record_batch(schema, ids, hex_of(fingerprint_bits(texts, lanes)))

    return map_chunks(documents.select("doc_id", utf8("text").alias("text")), run, schema, text=1)


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by the first ones of another text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edited_fingerprints(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """``SCHEMA`` for every row: its fingerprint, that of its edited text, and how like
    its fingerprint is to that one and to the next row's."""
    if ranges is None:
        ranges = min(max(documents.count() // RANGE_ROWS, RANGES[0]), RANGES[1])
    # descending ids as ascending keys; rows without an id come last
    key = F.bitwise_not(F.col("doc_id"))
    cuts = documents.agg(
        F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 20 * ranges)
    ).first()[0]
    bounds = sorted(set(cuts or []))
    number = F.coalesce(range_number(key, bounds), F.lit(len(bounds) + 1))
    # bounded: one row per range
    heads = documents.select(number.alias("range"), "doc_id").groupBy("range").agg(
        F.max("doc_id").alias("head")
    ).collect()
    used = sorted(r.range for r in heads)
    before = {r: used[i - 1] for i, r in enumerate(used)}  # the first follows the last
    head = {r.range: r.head for r in heads}

    texts = packed(documents.select("doc_id", "text", number.cast("int").alias("range")))
    # each row in its range, and the rows with a range's first id in the range before
    every = range(len(bounds) + 2)
    tops = F.from_json(F.lit(json.dumps([head.get(r) for r in every])), "array<bigint>")
    befores = F.from_json(F.lit(json.dumps([before.get(r) for r in every])), "array<int>")
    place = F.col("range") + 1
    is_head = F.col("doc_id").eqNullSafe(F.element_at(tops, place))
    own = F.struct(F.col("range").alias("to"), F.lit(0).alias("next"))
    other = F.struct(F.element_at(befores, place).alias("to"), F.lit(1).alias("next"))
    dealt = texts.select(
        F.explode(F.when(is_head, F.array(own, other)).otherwise(F.array(own))).alias("at"),
        "doc_id", "packed", "tie",
    ).select("at.to", "at.next", "doc_id", "packed", "tie")
    # the tie puts rows with equal ids in one order in both ranges
    order = ["to", "next", F.col("doc_id").desc_nulls_last(), "tie"]
    return (
        dealt.repartition("to").sortWithinPartitions(*order)
        .select("to", "next", "doc_id", "packed").mapInArrow(_neighbours, SCHEMA)
    )


def packed(rows: DataFrame) -> DataFrame:
    """``doc_id, range, packed, tie``: compressed texts, and a hash of each."""
    schema = "doc_id long, range int, packed binary, tie string"

    def run(ids, texts, ranges):
        press = zstandard.ZstdCompressor(level=1)
        return record_batch(
            schema, ids, ranges, [press.compress(t) for t in texts],
            [hashlib.sha256(t).hexdigest() for t in texts],
        )

    return map_chunks(
        rows.select("doc_id", utf8("text").alias("text"), "range"), run, schema, text=1
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order; the rows marked ``next`` of a range only end its chain."""
    press = zstandard.ZstdDecompressor()
    waiting: list[tuple[int, bytes]] = []  # rows of a range whose next is not yet known
    size = 0
    at, closed = None, False

    def flush(following: bytes) -> pa.RecordBatch:
        texts = [t for _, t in waiting] + [following]
        return _rows([i for i, _ in waiting], texts)

    for batch in batches:
        for to, later, doc, blob in zip(*(c.to_pylist() for c in batch.columns)):
            if to != at:
                at, closed, waiting, size = to, False, [], 0
            if closed:
                continue
            text = press.decompress(blob)
            if later:
                if waiting:
                    yield flush(text)
                waiting, size, closed = [], 0, True
                continue
            if size > CHUNK_BYTES:
                yield flush(text)
                waiting, size = [], 0
            waiting.append((doc, text))
            size += len(text)


def _rows(ids: list[int], texts: list[bytes]) -> pa.RecordBatch:
    plain = [t.decode("utf-8", "replace") for t in texts]
    changed = [edited_text(a, b).encode() for a, b in zip(plain, plain[1:])]
    bits = fingerprint_bits(texts)
    own, following = bits[:-1], bits[1:]
    edited = fingerprint_bits(changed)
    return record_batch(
        SCHEMA, ids, [len(t) for t in plain[:-1]],
        [hashlib.sha256(t).hexdigest() for t in changed],
        hex_of(own), hex_of(edited), likeness(own, edited), likeness(own, following),
    )


def _lanes(fingerprint: str, bits: int) -> list[Column]:
    """The digits of a fingerprint as numbers of 64 bits."""

    def half(i: int) -> Column:
        return F.conv(F.substring(fingerprint, 1 + 8 * i, 8), 16, 10).cast("long")

    return [F.shiftleft(half(2 * i), 32).bitwiseOR(half(2 * i + 1)) for i in range(bits // 64)]


def _digits(lanes: list[Column]) -> Column:
    return F.concat(*[F.lower(F.lpad(F.hex(lane), 16, "0")) for lane in lanes])


def _blocks(lanes: list[Column], blocks: int) -> list[list[Column]]:
    """The bits of each block; one that reaches over a lane's end comes in pieces."""
    bits = 64 * len(lanes)
    out = []
    for begin, end in ((bits * i // blocks, bits * (i + 1) // blocks) for i in range(blocks)):
        pieces = []
        for lane, column in enumerate(lanes):
            a, b = max(begin, 64 * lane), min(end, 64 * lane + 64)
            if a < b:
                up = F.shiftleft(column, a - 64 * lane)
                pieces.append(F.shiftrightunsigned(up, 64 - (b - a)))
        out.append(pieces)
    return out


def within(
    fingerprints: DataFrame,
    queries: DataFrame,
    radius: int = RADIUS,
    bits: int = LANES * 64,
    agree: int = 2,
) -> DataFrame:
    """``query, fingerprint, distance, rows``: every distinct fingerprint within
    ``radius`` bits of a distinct query, and how many rows carry it.

    What is moved is a key and the bits, once for each table. A pair that meets in several
    tables counts in the first of them, so pairs need not be made distinct afterwards.
    """
    blocks = radius + agree
    tables = list(combinations(range(blocks), agree))
    lanes = range(bits // 64)

    def keyed(df: DataFrame, name: str, *others: str) -> DataFrame:
        parts = _blocks([F.col(f"{name}{i}") for i in lanes], blocks)
        keys = F.array(*[
            F.xxhash64(F.lit(k), *(piece for i in chosen for piece in parts[i]))
            for k, chosen in enumerate(tables)
        ])
        return df.select(F.posexplode(keys).alias("table", "key"), *[f"{name}{i}" for i in lanes], *others)

    def split(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[lane.alias(f"{name}{i}") for i, lane in enumerate(_lanes("fingerprint", bits))])

    held = split(fingerprints, "b").groupBy(*[f"b{i}" for i in lanes]).agg(F.count("*").alias("rows"))
    asked = split(queries, "a").distinct()
    apart = [F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}")) for i in lanes]
    # the blocks a pair agrees in as bits of a number, and the first table for each such
    # number: one small expression, where a case for every table would be a large one
    agreed = F.lit(0)
    for i, pieces in enumerate(_blocks(apart, blocks)):
        differs = pieces[0]
        for piece in pieces[1:]:
            differs = differs.bitwiseOR(piece)
        agreed = agreed + F.when(differs == 0, 1 << i).otherwise(0)
    masks = [sum(1 << i for i in chosen) for chosen in tables]
    first = F.element_at(
        F.array(*[
            F.lit(next((k for k, m in enumerate(masks) if m & own == m), -1)) for own in range(1 << blocks)
        ]),
        agreed + 1,
    )
    distance = sum((F.bit_count(x) for x in apart), F.lit(0)).cast("int")
    return (
        keyed(held, "b", "rows").drop("table").join(keyed(asked, "a"), "key")
        .where((distance <= radius) & (first == F.col("table")))
        .select(
            _digits([F.col(f"a{i}") for i in lanes]).alias("query"),
            _digits([F.col(f"b{i}") for i in lanes]).alias("fingerprint"),
            distance.alias("distance"), "rows",
        )
    )


def with_neighbours(rows: DataFrame, asked: Column, radius: int = RADIUS) -> DataFrame:
    """``rows`` with ``n_within``: for a row that is ``asked`` how many rows have a
    fingerprint within ``radius`` bits of its own, itself included; null for others.

    Equal fingerprints are searched for once, whatever number of rows carry them."""
    held = stored(rows, "fingerprints")
    asked = F.coalesce(asked, F.lit(False))
    queries = held.where(asked)
    # stored, so that a fingerprint of very many rows can be split in the join
    counts = stored(
        within(held, queries, radius).groupBy(F.col("query").alias("fingerprint"))
        .agg(F.sum("rows").alias("n_within")),
        "neighbours",
    )
    found = queries.join(counts, "fingerprint").select(*rows.columns, "n_within")
    return found.unionByName(held.where(~asked).withColumn("n_within", F.lit(None).cast("long")))
