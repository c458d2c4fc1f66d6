"""The best documents of every query text, by exact scores behind hashed max-sketches.

A document's sketch has ``2 ** 16`` coordinates. Each term of the document falls on one of
them by its hash, and a coordinate holds the largest impact of the terms that fall there.
What is stored is the term count behind that impact, as the impact of a count is known
only with the totals of the corpus and grows with it; the coordinates without a term are
left out, so a sketch takes three bytes per distinct term. The sketches do not depend on
the queries.

Queries come in blocks of bounded size. For a block:

1. One pass counts the documents of each of its terms, confirmed on the bytes of the word.
2. One pass looks the whole block up in every sketch. The weighted sum over a query's
   terms is at least the score of the document. Each task keeps the best bounds of each
   query, and the best of all are the next to be scored.
3. These documents are scored exactly, from their texts. A query's last place so far is
   its threshold. Documents are taken in descending order of their bounds, in growing
   batches, until no bound that is left can pass the threshold of its query.

So no (query, document) pair is made but those that a task holds as its best, and the
number of passes grows with the logarithm of the documents whose bounds pass.

Copies: of texts that are equal but for the case of ASCII letters only the ``k`` smallest
ids can be among the best ``k``. A task that has met that many in a group marks the later
ones in their sketch, and they are not looked up. They count in the totals.

Defined cases: a null or blank text has no terms. Documents without an id count in the
totals and are never a result. Rows that repeat an id are documents of their own. Items
are told apart by their row, so a repeated or missing ``item_id`` gives a result per row.
Counts above 254 in a sketch are taken for endless, which keeps the bound a bound. Other
columns are not looked at. Without documents or items there are no rows.
"""

from __future__ import annotations

import math
import re
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.arrays import joined, per_text, span_hashes
from shelfmark.llm.common import chunks, map_chunks, record_batch, stored, utf8

K = 20
#: A block of queries: at most so many items and bytes (a longer item is one block).
BLOCK_ITEMS, BLOCK_BYTES = 512, 1 << 20
#: Documents scored per query in the first batch, as a multiple of ``k``; each further
#: batch is four times as large, up to so many pairs in all.
FIRST, GROWTH, MAX_PAIRS = 2, 4, 1 << 20
#: Coordinates of a sketch, at most; a parameter, a power of two.
COORDINATES = 1 << 16
_ENDLESS = 255
_TASK_BYTES = 64 << 20  # of sketches that one task looks up

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(128, 256)]] = True


def terms_of(text: bytes) -> list[bytes]:
    return _TERM.findall(text.lower())


class Tokens(NamedTuple):
    """The terms of many texts: their bytes, their places, and the text of each."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    text: np.ndarray
    counts: np.ndarray


def tokens(texts: list[bytes]) -> Tokens:
    buf, offsets = joined([t.lower() for t in texts])
    inside = _IN_TERM[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    counts = np.diff(per_text(starts, offsets))
    return Tokens(
        buf, starts, ends, span_hashes(buf, starts, ends),
        np.repeat(np.arange(len(texts)), counts), counts,
    )


def _runs(keys: list[np.ndarray]) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    fresh = np.ones(len(keys[0]), bool)
    if len(fresh):
        fresh[1:] = reduce(np.logical_or, [k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(fresh)


def _spot(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    return (hashes & np.uint64(coordinates - 1)).astype(np.int64)


def fold(t: Tokens, coordinates: int = COORDINATES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The coordinates in use of every text, in order: text, coordinate and the largest
    count of the terms on it."""
    order = np.lexsort((t.hashes, t.text))
    text, hashes = t.text[order], t.hashes[order]
    at = _runs([text, hashes])
    count = np.diff(np.concatenate([at, [len(hashes)]]))
    spot = text[at] * COORDINATES + _spot(hashes[at], coordinates)
    order = np.argsort(spot, kind="stable")
    spot, count = spot[order], np.minimum(count[order], _ENDLESS)
    at = _runs([spot])
    most = np.maximum.reduceat(count, at) if len(at) else count
    return spot[at] // COORDINATES, spot[at] % COORDINATES, most


_SKETCH = "doc_id long, n long, spots binary, counts binary, spare boolean"


def sketches(documents: DataFrame, k: int = K, coordinates: int = COORDINATES) -> DataFrame:
    """``doc_id, n, spots, counts, spare`` of every row: its number of terms, its sketch,
    and whether ``k`` copies of it with smaller ids are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copies: dict[bytes, list[int]] = {}  # of this task's documents
        for batch in batches:
            for piece in chunks(batch, 1):
                ids, texts = (c.to_pylist() for c in piece.columns)
                t = tokens(texts)
                text, spots, counts = fold(t, coordinates)
                cuts = np.searchsorted(text, np.arange(len(texts) + 1))
                spots, counts = spots.astype("<u2"), counts.astype(np.uint8)
                rows = []
                for j, (i, body) in enumerate(zip(ids, texts)):
                    part = slice(cuts[j], cuts[j + 1])
                    known = copies.setdefault(xxhash.xxh3_128_digest(body.lower()), [])
                    spare = i is None or len(known) == k and i > known[-1]
                    if not spare:
                        insort(known, i)
                        del known[k:]
                    rows.append((i, int(t.counts[j]), spots[part].tobytes(), counts[part].tobytes(), spare))
                yield record_batch(_SKETCH, *zip(*rows))

    return documents.select("doc_id", utf8("text").alias("text")).mapInArrow(run, _SKETCH)


class Block(NamedTuple):
    """Queries and their distinct terms."""

    items: list  # the items' ids
    terms: list[dict[bytes, int]]  # of each query: how often it holds a term
    vocabulary: list[bytes]


def blocks(items: DataFrame) -> Iterator[Block]:
    """The items in blocks of bounded size; items without terms have no result."""
    held: list[tuple] = []
    size = 0

    def block() -> Block:
        counts = [Counter(terms) for _, terms in held]
        return Block([i for i, _ in held], counts, sorted(set().union(*counts)))

    for row in items.select("item_id", utf8("text").alias("text")).toLocalIterator():
        terms = terms_of(bytes(row.text))
        if not terms:
            continue
        if held and (len(held) == BLOCK_ITEMS or size + len(row.text) > BLOCK_BYTES):
            yield block()
            held, size = [], 0
        held.append((row.item_id, terms))
        size += len(row.text)
    if held:
        yield block()


def document_frequencies(documents: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``term, df`` (the term by its number) over all documents."""
    buf, offsets = joined(vocabulary)
    starts, sizes = offsets[:-1], np.diff(offsets) - 1
    hashes = span_hashes(buf, starts, starts + sizes)
    order = np.argsort(hashes)
    asked = documents.sparkSession.sparkContext.broadcast((buf, starts[order], sizes[order], hashes[order], order))

    def count(texts: list[bytes]):
        words, at, size, hashed, number = asked.value
        t = tokens(texts)
        near = np.minimum(np.searchsorted(hashed, t.hashes), len(hashed) - 1)
        hit = np.flatnonzero((hashed[near] == t.hashes) & (size[near] == t.ends - t.starts))
        if not len(hit):
            return None
        # the same hash is not yet the same word
        near, lengths = near[hit], size[near[hit]]
        first = np.cumsum(lengths) - lengths
        inner = np.arange(lengths.sum()) - np.repeat(first, lengths)
        equal = t.buf[np.repeat(t.starts[hit], lengths) + inner] == words[np.repeat(at[near], lengths) + inner]
        same = np.logical_and.reduceat(equal, first)
        pairs = np.unique(t.text[hit][same] * len(hashed) + near[same])
        found, n = np.unique(pairs % len(hashed), return_counts=True)
        return record_batch("term int, n long", number[found].astype(np.int32), n.astype(np.int64))

    parts = map_chunks(documents.select(utf8("text").alias("text")), count, "term int, n long", text=0)
    return parts.groupBy("term").agg(F.sum("n").alias("df"))


class Totals(NamedTuple):
    documents: int
    terms: int

    def dampers(self, n):
        """``m`` of documents with ``n`` terms, a number or an array."""
        return 75 + (25 * n * self.documents) // max(1, self.terms)


def impacts(count, damper):
    return (1_000_000_000 * count) // (1000 * count + 12 * damper)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Lookup(NamedTuple):
    """A block by coordinate: the column of each coordinate (or -1), and per column the
    queries that use it with the summed weights of their terms there."""

    column: np.ndarray
    first: np.ndarray
    query: np.ndarray
    weight: np.ndarray


def lookup(block: Block, weights: dict[bytes, int], coordinates: int = COORDINATES) -> Lookup:
    buf, offsets = joined(block.vocabulary)
    hashes = span_hashes(buf, offsets[:-1], offsets[1:] - 1)
    spots = dict(zip(block.vocabulary, _spot(hashes, coordinates).tolist()))
    sums: Counter = Counter()
    for q, terms in enumerate(block.terms):
        for term, n in terms.items():
            sums[spots[term], q] += n * weights[term]
    entries = sorted(sums.items())
    spot = np.array([s for (s, _), _ in entries], np.int64)
    used, first = np.unique(spot, return_index=True)
    column = np.full(COORDINATES, -1, np.int32)
    column[used] = np.arange(len(used))
    return Lookup(
        column, np.concatenate([first, [len(entries)]]),
        np.array([q for (_, q), _ in entries], np.int64), np.array([w for _, w in entries], np.float64),
    )


def bounds(n: np.ndarray, spots: list[bytes], counts: list[bytes], look: Lookup, queries: int, totals: Totals):
    """A row of bounds per document, a column per query. Sums stay below ``2 ** 53``, so
    they are exact."""
    sizes = np.fromiter(map(len, counts), np.int64, len(counts))
    spot = np.frombuffer(b"".join(spots), "<u2")
    column = look.column[spot]
    use = np.flatnonzero(column >= 0)
    column, doc = column[use], np.repeat(np.arange(len(n)), sizes)[use]
    count = np.frombuffer(b"".join(counts), np.uint8)[use].astype(np.int64)
    impact = np.where(count < _ENDLESS, impacts(count, totals.dampers(n)[doc]), 1_000_000)
    times = look.first[column + 1] - look.first[column]
    entry = np.repeat(look.first[column] - (np.cumsum(times) - times), times) + np.arange(times.sum())
    sums = np.bincount(
        np.repeat(doc, times) * queries + look.query[entry],
        weights=look.weight[entry] * np.repeat(impact, times),
        minlength=len(n) * queries,
    )
    return sums.astype(np.int64).reshape(len(n), queries)


class Reach(NamedTuple):
    """Per query: the place (bound, id) up to which documents have been scored, and the
    place (score, id) that a further one has to beat."""

    done: np.ndarray
    done_id: np.ndarray
    beat: np.ndarray
    beat_id: np.ndarray


_BOUND = "query int, bound long, doc_id long"
_ROWS = 512


def next_best(
    index: DataFrame, look: Lookup, queries: int, totals: Totals, reach: Reach, batch: int
) -> DataFrame:
    """``query, bound, doc_id``: the next ``batch`` documents of each query in descending
    order of the bounds, ties by id, as far as they can still be among the best."""
    shared = index.sparkSession.sparkContext.broadcast((look, reach))

    def best(rows: list[np.ndarray]) -> list[np.ndarray]:
        query, bound, ids = (np.concatenate(c) for c in zip(*rows)) if rows else [np.empty(0, np.int64)] * 3
        order = np.lexsort((ids, -bound, query))
        query, bound, ids = query[order], bound[order], ids[order]
        starts = np.searchsorted(query, np.arange(queries))
        keep = np.arange(len(query)) - starts[query] < batch
        return [query[keep], bound[keep], ids[keep]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, reach = shared.value
        held, size = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                ids, n, spots, counts = (c.to_pylist() for c in whole.slice(at, _ROWS).columns)
                sums = bounds(np.array(n, np.int64), spots, counts, look, queries, totals)
                doc, query = np.nonzero(sums)
                bound, ids = sums[doc, query], np.array(ids, np.int64)[doc]
                later = (bound < reach.done[query]) | ((bound == reach.done[query]) & (ids > reach.done_id[query]))
                hope = (bound > reach.beat[query]) | ((bound == reach.beat[query]) & (ids < reach.beat_id[query]))
                keep = later & hope
                held.append([query[keep], bound[keep], ids[keep]])
                size += int(keep.sum())
                if size > 4 * queries * batch:
                    held = [best(held)]
                    size = len(held[0][0])
        query, bound, ids = best(held)
        yield record_batch(_BOUND, query.astype(np.int32), bound, ids)

    found = index.select("doc_id", "n", "spots", "counts").mapInArrow(run, _BOUND)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("bound"), "doc_id"))
    # several rows of one id may have several bounds; the best one stands for the id
    return found.withColumn("_place", place).where(F.col("_place") <= batch).drop("_place")


_SCORE = "query int, doc_id long, score long"


def exact_scores(
    documents: DataFrame, pairs: list[tuple[int, int]], block: Block, weights: dict[bytes, int], totals: Totals
) -> DataFrame:
    """``query, doc_id, score`` of the (query, id) pairs, a bounded list, from the whole
    texts."""
    spark = documents.sparkSession
    asked: dict[int, list[int]] = {}
    for q, i in pairs:
        asked.setdefault(i, []).append(q)
    wanted = spark.createDataFrame(list(asked.items()), "doc_id long, queries array<int>")
    shared = spark.sparkContext.broadcast((block.terms, weights))

    def score(ids: list[int], texts: list[bytes], queries: list[list[int]]):
        terms, weights = shared.value
        out = []
        for i, text, asking in zip(ids, texts, queries):
            held = Counter(terms_of(text))
            damper = totals.dampers(held.total())
            for q in asking:
                out.append((q, i, sum(
                    n * weights[t] * impacts(held[t], damper) for t, n in terms[q].items() if t in held
                )))
        return record_batch(_SCORE, *zip(*out))

    rows = documents.select("doc_id", utf8("text").alias("text")).join(F.broadcast(wanted), "doc_id")
    return map_chunks(rows, score, _SCORE, text=1)


def search_block(
    documents: DataFrame, index: DataFrame, totals: Totals, block: Block, k: int, coordinates: int = COORDINATES
) -> list[tuple]:
    """``(item_id, rank, doc_id, score)`` of one block."""
    found = {r.term: r.df for r in document_frequencies(documents, block.vocabulary).collect()}
    weights = {t: weight(totals.documents, found.get(j, 0)) for j, t in enumerate(block.vocabulary)}
    look, queries = lookup(block, weights, coordinates), len(block.items)
    most = np.iinfo(np.int64).max
    reach = Reach(
        np.full(queries, most), np.full(queries, most), np.zeros(queries, np.int64), np.full(queries, -most - 1),
    )
    best: list[list[tuple]] = [[] for _ in range(queries)]  # (-score, id), at most k
    batch = FIRST * k
    while True:
        rows = next_best(index, look, queries, totals, reach, batch).collect()  # batch * queries
        if not rows:
            break
        pairs = sorted({(r.query, r.doc_id) for r in rows})
        # another row of an id that is held already: all rows of it have been scored
        known = [{i for _, i in held} for held in best]
        for r in exact_scores(documents, pairs, block, weights, totals).collect():
            if r.score > 0 and r.doc_id not in known[r.query]:
                insort(best[r.query], (-r.score, r.doc_id))
                del best[r.query][k:]
        for r in rows:
            q = r.query
            if (-r.bound, r.doc_id) > (-reach.done[q], reach.done_id[q]) or reach.done[q] == most:
                reach.done[q], reach.done_id[q] = r.bound, r.doc_id
        for q, held in enumerate(best):
            if len(held) == k:
                reach.beat[q], reach.beat_id[q] = -held[-1][0], held[-1][1]
        batch = max(batch, min(GROWTH * batch, MAX_PAIRS // queries))
    return [
        (block.items[q], rank, i, -minus) for q, held in enumerate(best) for rank, (minus, i) in enumerate(held, 1)
    ]


def search(documents: DataFrame, items: DataFrame, k: int = K, coordinates: int = COORDINATES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item with a
    score above zero, equal scores by ascending id."""
    spark = documents.sparkSession
    index = stored(sketches(documents, k, coordinates), "sketches")
    one = index.agg(
        F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms"),
        F.coalesce(F.sum(F.length("spots") + F.length("counts")), F.lit(0)).alias("bytes"),
    ).first()
    totals = Totals(one.documents, one.terms)
    # few tasks over small sketches: each task names its own best
    tasks = max(2 * spark.sparkContext.defaultParallelism, one.bytes // _TASK_BYTES)
    alive = index.where("not spare and n > 0").coalesce(tasks)
    schema = "item_id long, rank int, doc_id long, score long"
    parts = [
        stored(spark.createDataFrame(search_block(documents, alive, totals, block, k, coordinates), schema), "ranked")
        for block in (blocks(items) if totals.documents else ())
    ]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)
