"""Lines that several documents share stay in the first document only.

Two Bloom filters over the keys of all lines, one for keys met once and one for keys
met again, say which lines may be repeats. Only those are shuffled, as 128-bit
hashes, to be confirmed exactly and to find the document that keeps them.

* A filter of a part of the documents is the list of its set bits. Two parts merge
  by ``once = once1 | once2`` and ``twice = twice1 | twice2 | (once1 & once2)``, so the
  merge runs in any order, a stretch of the filter per row, over the whole cluster.
* The merged second filter has a fixed size (``2 ** bits`` bits, 16 MB by default) and
  is the only thing broadcast. With more lines than it was made for it lets more lines
  through to the exact step; the result stays the same.

Defined cases: a null text is empty. A row without ``doc_id`` has no place in the
order; it is kept whole and makes no line of another document a repeat. Rows with the
same ``doc_id`` are one document. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import chunks, map_chunks, map_rows, record_batch, stored, utf8

MIN_CHARS = 10
FILTER_BITS = 27
PROBES = 2
_STRETCH = 19  # bits of the filter in one row, as a power of two


def line_key(line: bytes) -> bytes:
    """The line without blanks around it, ASCII letters in lower case."""
    return line.strip(b" \t\n\v\f\r").lower()


def _chars(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def keys_of(text: bytes, min_chars: int) -> dict[bytes, bytes]:
    """The distinct keys of a text that are long enough, with their hashes."""
    found = {line_key(line) for line in text.split(b"\n")}
    return {k: _hash(k) for k in found if len(k) >= min_chars and _chars(k) >= min_chars}


def _positions(hashes: list[bytes], bits: int) -> np.ndarray:
    """``PROBES`` bits of the filter for each hash, one row per hash."""
    halves = np.frombuffer(b"".join(hashes), "<u8").reshape(-1, 2)
    step = np.arange(PROBES, dtype=np.uint64)
    mixed = halves[:, :1] + step * (halves[:, 1:] | np.uint64(1))
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def _part_filters(batches: Iterator[pa.RecordBatch], min_chars: int, bits: int):
    """The set bits of both filters for this task's documents, by stretch."""
    size = (1 << bits) // 8
    once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
    for batch in batches:
        for piece in chunks(batch, 0):
            seen = [h for t in piece.column(0).to_pylist() for h in keys_of(t, min_chars).values()]
            if not seen:
                continue
            # a bit that two keys of this piece share counts as met again
            flat = np.sort(_positions(seen, bits), axis=1)
            flat = flat[np.concatenate([np.ones((len(flat), 1), bool), flat[:, 1:] != flat[:, :-1]], axis=1)]
            spots, counts = np.unique(flat, return_counts=True)
            byte, mask = spots >> 3, (1 << (spots & 7)).astype(np.uint8)
            again = (once[byte] & mask != 0) | (counts > 1)
            np.bitwise_or.at(twice, byte[again], mask[again])
            np.bitwise_or.at(once, byte, mask)
    stretch = (1 << _STRETCH) // 8
    rows = []
    for i in range(max(1, size // stretch)):
        part = once[i * stretch : (i + 1) * stretch]
        if part.any():
            rows.append((i, _set_bits(part), _set_bits(twice[i * stretch : (i + 1) * stretch])))
    yield record_batch("stretch int, once binary, twice binary", *(zip(*rows) if rows else ((), (), ())))


def _set_bits(part: np.ndarray) -> bytes:
    return np.flatnonzero(np.unpackbits(part, bitorder="little")).astype("<u4").tobytes()


def _merged(batches: Iterator[pa.RecordBatch]):
    """The union of the second filter and of the overlaps of the first, by stretch."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for i, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
            if i not in held:
                held[i] = (np.zeros(1 << _STRETCH, bool), np.zeros(1 << _STRETCH, bool))
            first, second = held[i]
            spots = np.frombuffer(once, "<u4")
            second[spots[first[spots]]] = True
            second[np.frombuffer(twice, "<u4")] = True
            first[spots] = True
    rows = [(i, np.packbits(s, bitorder="little").tobytes()) for i, (_, s) in held.items()]
    yield record_batch("stretch int, twice binary", *(zip(*rows) if rows else ((), ())))


def repeat_filter(
    documents: DataFrame, min_chars: int = MIN_CHARS, bits: int = FILTER_BITS
) -> np.ndarray:
    """The bytes of the filter of keys that were met again (``2 ** bits`` bits)."""
    bits = max(bits, _STRETCH)
    parts = documents.select(utf8("text").alias("text")).mapInArrow(
        lambda it: _part_filters(it, min_chars, bits),
        "stretch int, once binary, twice binary",
    )
    merged = parts.repartition("stretch").mapInArrow(_merged, "stretch int, twice binary")
    out = np.zeros((1 << bits) // 8, np.uint8)
    stretch = (1 << _STRETCH) // 8
    for row in merged.collect():  # 2 ** bits bits in all
        out[row.stretch * stretch : (row.stretch + 1) * stretch] = np.frombuffer(row.twice, np.uint8)
    return out


def shared_lines(
    documents: DataFrame, min_chars: int = MIN_CHARS, bits: int = FILTER_BITS
) -> DataFrame:
    """``doc_id, hash`` of the keys a document loses: those another one had first."""
    spark = documents.sparkSession
    bits = max(bits, _STRETCH)
    documents = documents.where(F.col("doc_id").isNotNull())
    again = spark.sparkContext.broadcast(repeat_filter(documents, min_chars, bits))

    def suspects(ids: list[int], texts: list[bytes]):
        rows = [(i, h) for i, t in zip(ids, texts) for h in keys_of(t, min_chars).values()]
        if not rows:
            return None
        spots = _positions([h for _, h in rows], bits)
        hit = (again.value[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1
        keep = hit.all(axis=1)
        kept = [r for r, k in zip(rows, keep) if k]
        return record_batch("doc_id long, hash binary", *zip(*kept)) if kept else None

    met = stored(
        map_chunks(
            documents.select("doc_id", utf8("text").alias("text")),
            suspects, "doc_id long, hash binary", text=1,
        ),
        "suspects",
    )
    # stored first: the join below then has plain inputs, and adaptive execution may
    # split the rows of a very common line
    first = stored(
        met.groupBy("hash")
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
        .where("first_id < last_id")
        .select("hash", "first_id"),
        "first-lines",
    )
    return met.join(first, "hash").where("doc_id > first_id").select("doc_id", "hash")


def drop_shared_lines(
    documents: DataFrame,
    min_chars: int = MIN_CHARS,
    bits: int = FILTER_BITS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped, kept_sha256`` for every row of ``documents``;
    ``text`` is what is left of it. Columns named in ``carry`` follow unchanged."""
    # a set, so rows of one id need no distinct on the hash, which would keep the join
    # above from being split
    lost = (
        shared_lines(documents, min_chars, bits)
        .groupBy("doc_id")
        .agg(F.collect_set("hash").alias("lost"))
    )
    rows = documents.select("doc_id", "text", *carry).join(lost, "doc_id", "left")
    schema = "doc_id long, text string, n_lines long, n_dropped long, kept_sha256 string"

    def apply(ids, texts, lost):
        out = []
        for i, text, gone in zip(ids, texts, lost):
            lines = text.split(b"\n")
            if gone:
                gone = set(gone)
                keys = map(line_key, lines)
                kept = [line for line, k in zip(lines, keys) if len(k) < min_chars or _hash(k) not in gone]
            else:
                kept = lines
            rest = b"\n".join(kept)
            out.append((
                i, rest.decode("utf-8", "replace"), len(lines), len(lines) - len(kept),
                hashlib.sha256(rest).hexdigest(),
            ))
        return record_batch(schema, *zip(*out))

    rows = rows.select("doc_id", utf8("text").alias("text"), "lost", *carry)
    return map_rows(rows, apply, schema, text=1, carry=carry)
