"""Benchmark items inside documents, by the q-gram lemma and banded alignment.

Texts are folded first: letters in lower case, everything but letters and digits one
blank. An item of ``n`` folded characters is found where a region of a document is
within ``e = n * RATE`` edits of it.

* An edit destroys at most ``q`` of the item's ``n - q + 1`` q-grams, so such a region
  shares at least ``n - q + 1 - q * e`` of them, all on neighbouring diagonals.
* Shared q-grams are counted in bands of diagonals that overlap by half, wide enough
  that every such region lies in one band whole. Bands that meet the count are kept.
* Each kept region is verified by an alignment inside its band.

The item index holds a block of benchmark items of bounded size (``BLOCK_CHARS``) and
is broadcast; a larger benchmark is gone through block by block. Documents are read
where they lie, nothing of them is shuffled. Texts longer than ``SLICE`` characters are
searched in overlapping slices.

Items with fewer than ``q`` folded characters have no q-gram. They are found where their
folded words stand one after another, letter by letter.

Shared q-grams are expanded to bands in runs of bounded size, counted first and kept
after, so frequent words cost time and no memory.

Defined cases: a null or empty text holds no item, and an item without letters and digits
is nowhere; where ``RATE`` asks for more edits than
the lemma can bear, the budget is the most it can. Items with equal folded texts are all
reported. Rows that repeat a ``doc_id`` are each reported. Extra columns are not looked
at.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import map_chunks, record_batch, utf8
from shelfmark.llm.folding import fold

Q = 8
RATE = 0.1
BLOCK_CHARS = 4_000_000
SLICE = 1 << 20
_BITS = 20
_LOW = np.uint32((1 << _BITS) - 1)
_SPREAD = 1 << 20
_RUN = 1 << 21  # shared q-grams expanded at once

SCHEMA = "doc_id long, item_id long, start long, end long, edits int, item_chars int"


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 32-bit hash of every ``q`` consecutive characters (``q`` a power of two)."""
    h = codes.astype(np.uint32) * np.uint32(0x9E3779B1)
    width, base = 1, np.uint32(0x01000193)
    while width < q:
        if len(h) <= width:
            return h[:0]
        h = (h[:-width] * base) ^ (h[width:] * np.uint32(0x85EBCA6B)) ^ (h[:-width] >> np.uint32(15))
        base = np.uint32((int(base) * int(base) + 2 * width) & 0xFFFFFFFF)
        width *= 2
    return h


@dataclass
class Index:
    """The q-grams of a block of items, in the order of the low bits of their hash."""

    ids: list[list[int]]  # item ids with this folded text
    texts: list[np.ndarray]
    budget: np.ndarray
    needed: np.ndarray
    first: np.ndarray  # where the grams with these low bits begin
    hashes: np.ndarray
    item: np.ndarray
    position: np.ndarray
    q: int
    short: dict[str, int]  # the number of each text without a q-gram
    words: list[int]  # how many words such texts have


def edit_budget(n: int, q: int, rate: float) -> int:
    """Edits allowed for ``n`` characters: at least one shared q-gram must remain."""
    return max(0, min(int(n * rate), (n - q) // q))


def build_index(items: list[tuple[int, str]], q: int = Q, rate: float = RATE) -> Index | None:
    by_text: dict[bytes, list[int]] = {}
    for item_id, text in items:
        codes, _ = fold(text or "")
        if len(codes):
            by_text.setdefault(codes.tobytes(), []).append(item_id)
    if not by_text:
        return None
    texts = [np.frombuffer(t, np.uint32) for t in by_text]
    found = [grams(t, q) for t in texts]
    hashes = np.concatenate(found)
    item = np.repeat(np.arange(len(texts)), [len(g) for g in found])
    position = np.concatenate([np.arange(len(g)) for g in found])
    low = hashes & _LOW
    order = np.argsort(low, kind="stable")
    first = np.searchsorted(low[order], np.arange((1 << _BITS) + 1)).astype(np.int32)
    short = {t.tobytes().decode("utf-32-le"): i for i, t in enumerate(texts) if len(t) < q}
    budget = np.array([edit_budget(len(t), q, rate) for t in texts])
    needed = np.array([len(t) for t in texts]) - q + 1 - q * budget
    return Index(list(by_text.values()), texts, budget, needed, first,
                 hashes[order], item[order], position[order], q, short,
                 sorted({t.count(" ") + 1 for t in short}))


def banded_distances(
    item: np.ndarray, codes: np.ndarray, low: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each band of ``width`` diagonals from ``low[i]``: the fewest edits that turn
    ``item`` into a part of ``codes``, and where that part ends. It may begin anywhere."""
    far = len(item) + width
    steps = np.arange(width)
    diagonal = low[:, None] + steps
    # what lies outside the text is no part of it
    lead = max(0, -int(low.min()))
    tail = max(0, int(low.max()) + width + len(item) - len(codes))
    padded = np.concatenate([np.zeros(lead, np.uint32), codes, np.zeros(tail + 1, np.uint32)])
    row = np.where((diagonal < 0) | (diagonal > len(codes)), far, 0)
    edge = np.full((len(low), 1), far)
    for j, c in enumerate(item):
        turn = row + (padded[diagonal + (j + lead)] != c)
        row = np.minimum(turn, np.concatenate([row[:, 1:] + 1, edge], axis=1))
        row = np.minimum.accumulate(row - steps, axis=1) + steps
    row = np.where((diagonal + len(item) < 0) | (diagonal + len(item) > len(codes)), far, row)
    best = np.argmin(row, axis=1)
    at = np.arange(len(low))
    return row[at, best], diagonal[at, best] + len(item)


def _begins(item: np.ndarray, codes: np.ndarray, end: int, edits: int) -> int:
    """Where a region of ``edits`` edits that ends at ``end`` begins: the longest of
    the best alignments read backwards from its end."""
    back = codes[max(0, end - len(item) - edits) : end][::-1]
    row = np.arange(len(back) + 1)
    for j, c in enumerate(item[::-1]):
        turn = row[:-1] + (back != c)
        new = np.empty_like(row)
        new[0] = j + 1
        new[1:] = np.minimum(turn, row[1:] + 1)
        steps = np.arange(len(row))
        row = np.minimum.accumulate(new - steps) + steps
    return end - int(np.flatnonzero(row == row.min())[-1])


def _bands(codes: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Items and band numbers of every band that shares enough q-grams; band ``b`` of an
    item with budget ``e`` holds the diagonals from ``b * (e + 1)``, ``2 * (e + 1)`` of them."""
    none = np.empty(0, np.int64)
    hashed = grams(codes, index.q)
    low = hashed & _LOW
    left = index.first[low]
    size = index.first[low + np.uint32(1)] - left
    at = np.flatnonzero(size)
    if not len(at):
        return none, none
    left, size = left[at], size[at]
    def expanded():
        """Items and bands of the shared q-grams, some ``_RUN`` at a time."""
        run = (np.cumsum(size) - size) // _RUN
        for k in range(int(run[-1]) + 1):
            part = slice(*np.searchsorted(run, [k, k + 1]))
            ends = np.cumsum(size[part])
            if not len(ends):
                continue
            rows = np.repeat(left[part] - (ends - size[part]), size[part]) + np.arange(ends[-1])
            here = np.repeat(at[part], size[part])
            same = index.hashes[rows] == hashed[here]
            rows, here = rows[same], here[same]
            item = index.item[rows]
            band = (here - index.position[rows]) // (index.budget[item] + 1)
            # a gram counts for its band and for the one before, which overlaps
            yield np.concatenate([item, item]), np.concatenate([band, band - 1])

    def mixed(item, band):
        return ((item * 0x9E3779B1 + band) * 0x85EBCA6B) & (_SPREAD - 1)

    # most bands hold a few grams only: drop them by a count over mixed keys
    counts = np.zeros(_SPREAD, np.int64)
    runs = expanded()
    if size.sum() <= _RUN:
        runs = list(runs)
    for item, band in runs:
        counts += np.bincount(mixed(item, band), minlength=_SPREAD)
    keys, times = [np.empty((0, 2), np.int64)], [none]
    for item, band in runs if isinstance(runs, list) else expanded():
        full = counts[mixed(item, band)] >= index.needed[item]
        key, n = np.unique(np.stack([item[full], band[full]], axis=1), axis=0, return_counts=True)
        keys.append(key)
        times.append(n)
    # a band may lie in several runs
    keys, inverse = np.unique(np.concatenate(keys), axis=0, return_inverse=True)
    sums = np.bincount(inverse.reshape(-1), weights=np.concatenate(times), minlength=len(keys))
    kept = sums >= index.needed[keys[:, 0]]
    return keys[kept, 0], keys[kept, 1]


def _short_items(codes: np.ndarray, index: Index) -> dict[int, tuple[int, int]]:
    """The first place of every item without a q-gram in a folded text."""
    text = codes.astype(np.uint32).tobytes().decode("utf-32-le")
    spans = [m.span() for m in re.finditer("[^ ]+", text)]
    found: dict[int, tuple[int, int]] = {}
    for n in index.words:
        for first, last in zip(spans, spans[n - 1 :]):
            item = index.short.get(text[first[0] : last[1]])
            if item is not None:
                found.setdefault(item, (first[0], last[1]))
    return found


def find_items(texts: list[str], index: Index) -> list[tuple[int, int, int, int, int]]:
    """``text number, item, start, end, edits`` of the best region of each item in
    each text."""
    gap = int(index.budget.max()) + 1  # no region bridges it
    found = [fold(t) for t in texts]
    bar = np.full(gap, sys.maxunicode, np.uint32)
    codes = np.concatenate([x for c, _ in found for x in (c, bar)])
    offsets = np.cumsum([0] + [len(c) + gap for c, _ in found])
    overlap = 2 * max(map(len, index.texts)) + 2
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for base in range(0, len(codes), SLICE):
        part = codes[base : base + SLICE + overlap]
        if len(part) < index.q:
            continue
        items, bands = _bands(part, index)
        for i in np.unique(items).tolist():
            item, budget = index.texts[i], int(index.budget[i])
            low = bands[items == i] * (budget + 1) - budget  # edits may leave the band
            for k in range(0, len(low), 256):
                some = low[k : k + 256]
                edits, ends = banded_distances(item, part, some, 4 * budget + 2)
                for d, end in zip(edits.tolist(), ends.tolist()):
                    if d > budget:
                        continue
                    text = int(np.searchsorted(offsets, base + end - 1, "right")) - 1
                    if (text, i) not in best or (d, base + end) < best[text, i][:2]:
                        best[text, i] = (d, base + end, _begins(item, part, end, d) + base)
    out = []
    if index.short:
        for text, (codes, where) in enumerate(found):
            for i, (begin, end) in sorted(_short_items(codes, index).items()):
                out.append((text, i, int(where[begin]), int(where[end - 1]) + 1, 0))
    for (text, i), (edits, end, begin) in sorted(best.items()):
        where = found[text][1]
        begin, end = begin - offsets[text], min(end - offsets[text], len(where))
        out.append((text, i, int(where[max(0, begin)]), int(where[end - 1]) + 1, edits))
    return out


def _blocks(benchmark: DataFrame, block_chars: int) -> DataFrame:
    """``item_id, text, block``: blocks of about ``block_chars`` characters. The running
    size is that of a hash bucket, so no task orders the whole benchmark."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 2 * (total // block_chars) + 1
    size = F.sum(F.length("text")).over(
        Window.partitionBy("bucket").orderBy("item_id", "text").rowsBetween(Window.unboundedPreceding, -1)
    )
    return items.withColumn("bucket", F.pmod(F.xxhash64("item_id", "text"), F.lit(buckets))).select(
        "item_id", "text", "bucket",
        F.coalesce((size / block_chars).cast("long"), F.lit(0)).alias("block"),
    )


def leaked_items(
    documents: DataFrame,
    benchmark: DataFrame,
    q: int = Q,
    rate: float = RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id, item_id, start, end, edits, item_chars``: the best region of each
    benchmark item in each document that holds it, in code points of the text."""
    spark = documents.sparkSession
    items = _blocks(benchmark, block_chars)
    texts = documents.select("doc_id", utf8("text").alias("text"))
    found = None
    for block in items.select("bucket", "block").distinct().collect():
        rows = items.where((F.col("bucket") == block.bucket) & (F.col("block") == block.block))
        index = build_index([(r.item_id, r.text) for r in rows.collect()], q, rate)
        if index is None:
            continue
        shared = spark.sparkContext.broadcast(index)

        def run(ids, texts, shared=shared):
            index = shared.value
            texts = [t.decode("utf-8", "replace") for t in texts]
            rows = [
                (ids[text], item, start, end, edits, len(index.texts[i]))
                for text, i, start, end, edits in find_items(texts, index)
                for item in index.ids[i]
            ]
            return record_batch(SCHEMA, *zip(*rows)) if rows else None

        part = map_chunks(texts, run, SCHEMA, text=1)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], SCHEMA) if found is None else found
