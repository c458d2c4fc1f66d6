"""Long passages that were seen before are cut out of the later document.

A De Bruijn graph over words: its edges are the windows of ``WINDOW`` consecutive
words, its nodes their overlaps. A window is removed where the same edge starts
earlier (smaller ``doc_id``, or earlier in the same document).

Edges are not handled one by one. Each has an anchor, the word run of ``ANCHOR``
words with the smallest hash inside it, so equal edges have equal anchors in the same
place. The consecutive edges of a document that share one anchor are a path; a path is
one row with a hash of its words and its source coordinates.

1. Paths through an anchor that occurs once hold no repeated edge; they are left out by
   a join with the counted anchors.
2. Equal paths compact into one. If an anchor has one path only, the graph does not
   branch there, and every occurrence but the first is a repeat as a whole.
3. Where paths differ around an anchor, the first occurrence of each is read again at
   its coordinates and opened into edges, which are compared one by one.

So the rows that move are a fraction of the words, and only the borders of repeated
passages are compared edge by edge. A frequent passage is counted before it is joined,
and the joined sides are stored tables, which adaptive execution may split.

Defined cases: null and empty texts have no words. A row without ``doc_id`` has no
place in the order; it is kept whole and makes no other window a repeat. Rows that
repeat a ``doc_id`` share their coordinates, so equal rows do not remove each other.
Blanks between words are not kept: the text left is its words joined by one space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.arrays import (
    U,
    joined,
    leftmost_minimum,
    mix,
    pair,
    per_text,
    run_hashes,
    signed,
    span_hashes,
    word_spans,
)
from shelfmark.llm.common import map_chunks, map_rows, record_batch, stored, utf8

WINDOW = 20
ANCHOR = 5

# A place is position << 24 | edges << 16 | tag of the text, so places of one document
# are ordered by position; the tag tells apart texts that share an id.
_POSITION = 1 << 24


def _tags(texts: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(t) & 0xFFFF for t in texts), np.int64, len(texts))


def _edges(texts: list[bytes], window: int, anchor: int):
    """Of all texts at once: text number, position in the text, edge hash, anchor
    hash and anchor position of every edge."""
    buf, offsets = joined(texts)
    starts, ends = word_spans(buf)
    first = per_text(starts, offsets)
    counts = np.diff(first)
    if len(starts) < window:
        return None
    hashes = span_hashes(buf, starts, ends)
    whole = run_hashes(hashes, window)
    anchors = mix(run_hashes(hashes, anchor) ^ U(0x5851F42D4C957F2D))
    spot = leftmost_minimum(anchors, window - anchor + 1)
    text = np.repeat(np.arange(len(texts)), counts)[: len(whole)]
    position = np.arange(len(whole)) - first[text]
    inside = position + window <= counts[text]
    if not inside.any():
        return None
    spot = spot[inside]
    return text[inside], position[inside], whole[inside], anchors[spot], spot


def _paths(texts: list[bytes], window: int, anchor: int):
    """Runs of edges with one anchor: text number, position, edges, anchor, hash."""
    found = _edges(texts, window, anchor)
    if found is None:
        return None
    text, position, whole, anchors, spot = found
    new = np.ones(len(text), bool)
    new[1:] = (spot[1:] != spot[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    end = np.concatenate([begin[1:], [len(text)]]) - 1
    edges = end - begin + 1
    hashed = pair(pair(whole[begin], whole[end]), edges.astype(U))
    return text[begin], position[begin], edges, anchors[begin], hashed


def paths(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``anchor, path, doc_id, place`` of every path of every document."""
    schema = "anchor long, path long, doc_id long, place long"

    def run(ids, texts):
        found = _paths(texts, window, anchor)
        if found is None:
            return None
        text, position, edges, anchors, hashed = found
        place = position * _POSITION + (edges << 16) + _tags(texts)[text]
        return record_batch(
            schema, signed(anchors), signed(hashed), np.array(ids, np.int64)[text], place
        )

    return map_chunks(documents.select("doc_id", utf8("text").alias("text")), run, schema, text=1)


def packed_texts(documents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, packed``: texts compressed before they are shuffled."""
    pack = zstandard.ZstdCompressor

    def run(ids, texts):
        press = pack(level=1)
        return record_batch("doc_id long, packed binary", ids, [press.compress(t) for t in texts])

    rows = documents.select("doc_id", utf8("text").alias("text"), *carry)
    return map_rows(rows, run, "doc_id long, packed binary", text=1, carry=carry)


def _opened(packed: DataFrame, places: DataFrame, window: int, anchor: int) -> DataFrame:
    """``anchor, edge, doc_id, place`` of the edges of the paths at ``places``."""
    schema = "anchor long, edge long, doc_id long, place long"

    def run(ids, blobs, wanted):
        press = zstandard.ZstdDecompressor()
        texts = [press.decompress(b) for b in blobs]
        found = _edges(texts, window, anchor)
        if found is None:
            return None
        text, position, whole, anchors, _ = found
        tags = _tags(texts)
        first = np.searchsorted(text, np.arange(len(texts) + 1))
        rows = []
        for i, places in enumerate(wanted):
            at = np.array(places, np.int64)
            at = at[(at & 0xFFFF) == tags[i]]
            size = (at >> 16) & 0xFF
            ends = np.cumsum(size)
            rows.append(
                np.repeat(first[i] + at // _POSITION - (ends - size), size)
                + np.arange(ends[-1] if len(ends) else 0)
            )
        rows = np.concatenate(rows)
        return record_batch(
            schema, signed(anchors[rows]), signed(whole[rows]),
            np.array(ids, np.int64)[text[rows]],
            position[rows] * _POSITION + (1 << 16) + tags[text[rows]],
        )

    wanted = places.groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    rows = packed.join(wanted, "doc_id").select("doc_id", "packed", "places")
    return map_chunks(rows, run, schema, text=1)


def _later(rows: DataFrame, key: str, purpose: str) -> DataFrame:
    """The rows whose (anchor, ``key``) has an earlier row: ``doc_id, place``."""
    first = stored(
        rows.groupBy("anchor", key)
        .agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("anchor", key, F.col("first.doc_id").alias("first_id"),
                F.col("first.place").alias("first_place")),
        purpose,
    )
    return (
        rows.join(first, ["anchor", key])
        .where("doc_id != first_id OR shiftright(place, 24) != shiftright(first_place, 24)")
        .select("doc_id", "place")
    )


def repeated_places(
    documents: DataFrame, packed: DataFrame, window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """``doc_id, place`` of the paths and edges that started earlier elsewhere."""
    every = paths(documents, window, anchor)
    # what is counted is stored before it is joined: a join whose side is an aggregate
    # on the same key could not be split where one anchor holds a third of all paths
    again = stored(every.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    met = stored(every.join(again, "anchor"), "paths")
    whole = _later(met, "path", "first-paths")

    kinds = stored(
        met.groupBy("anchor", "path").agg(F.min(F.struct("doc_id", "place")).alias("first")), "kinds"
    )
    branching = stored(kinds.groupBy("anchor").count().where("count > 1").select("anchor"), "branching")
    places = kinds.join(branching, "anchor").select("first.doc_id", "first.place")
    edges = stored(_opened(packed, places, window, anchor), "edges")
    return whole.unionByName(_later(edges, "edge", "first-edges"))


def drop_repeated_passages(
    documents: DataFrame,
    window: int = WINDOW,
    anchor: int = ANCHOR,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, text, n_words, n_removed, kept_sha256`` for every row of ``documents``;
    ``text`` is its remaining words. Columns named in ``carry`` follow unchanged."""
    known = documents.where(F.col("doc_id").isNotNull())
    lost = (
        repeated_places(known, packed_texts(known), window, anchor)
        .groupBy("doc_id")
        .agg(F.collect_list("place").alias("places"))
    )
    rows = packed_texts(documents, carry).join(lost, "doc_id", "left")
    schema = "doc_id long, text string, n_words long, n_removed long, kept_sha256 string"

    def apply(ids, blobs, lost):
        press = zstandard.ZstdDecompressor()
        out = []
        for i, blob, places in zip(ids, blobs, lost):
            text = press.decompress(blob)
            words = text.split()
            n = len(words)
            if places:
                words = _kept(text, words, np.array(places, np.int64), window)
            rest = b" ".join(words)
            out.append((
                i, rest.decode("utf-8", "replace"), n, n - len(words),
                hashlib.sha256(rest).hexdigest(),
            ))
        return record_batch(schema, *zip(*out))

    rows = rows.select("doc_id", "packed", "places", *carry)
    return map_rows(rows, apply, schema, text=1, carry=carry)


def _kept(text: bytes, words: list[bytes], places: np.ndarray, window: int) -> list[bytes]:
    """The words outside the windows that begin at ``places``."""
    places = places[(places & 0xFFFF) == _tags([text])[0]]
    begin = places // _POSITION
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, begin, 1)
    np.add.at(depth, begin + ((places >> 16) & 0xFF) + window - 1, -1)
    keep = np.cumsum(depth)[: len(words)] == 0
    return [w for w, k in zip(words, keep.tolist()) if k]
