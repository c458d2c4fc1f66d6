"""Documents as token ids, cut and packed into sequences of equal length.

A document is the ids of its text and an end id. Its full lengths of ``capacity`` ids are
sequences of their own; the rest is cut into pieces of at most ``piece`` ids. The
pieces of a batch are dealt to windows by Karmarkar-Karp differencing: partial
partitions merge with opposing imbalances (the fullest window of one takes the
emptiest of the other), which leaves windows of nearly equal size. The number of
windows is the least that could hold the batch, and rises by one whenever a window
exceeds the capacity.

Batches are formed inside a task from its own stream of documents, so nothing is
shuffled, memory is that of one batch, and a lost task is run again on its own. The
last batch of a task is smaller; its last window may hold more padding.

Strings that the vocabulary lists as added tokens have ids of their own wherever they
stand in a text, as its tokenizer has it; ``added={}`` makes them ordinary text.

Defined cases: a null text is empty and becomes the end id alone. Rows with equal or
null ``doc_id`` are packed each on their own. Extra columns are not looked at.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from shelfmark.llm.common import chunks, record_batch, utf8

CAPACITY = 2048
PIECE = 512
END = 1
BATCH = 320  # pieces dealt at once
MEMO = 400_000  # words whose ids a task remembers

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)

# White space other than the blank: where one of these stands beside a blank, a text
# is not cut at blanks.
_BLANKS = "\t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B))
)


class Tokens(dict):
    """Ids of a text as little-endian 32-bit integers.

    A blank between two characters that are no white space begins a new piece of the
    tokenizer's own pattern, so the ids of a text are those of its parts. Parts
    come again and again; their ids are remembered, up to ``memo`` of them.
    """

    def __init__(self, ranks: str, pattern: str, memo: int = MEMO, added: Mapping[str, int] | None = None):
        import tiktoken

        self._added = {t: np.array([i], "<u4").tobytes() for t, i in (added or {}).items()}
        # of tokens that begin alike the longer one
        tokens = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._cut = re.compile(f"({'|'.join(tokens)})") if tokens else None

        with open(ranks, "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encode = tiktoken.Encoding(
            "texts", pat_str=pattern, mergeable_ranks=known, special_tokens={}
        ).encode_ordinary
        self._memo = memo

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self._memo:
            self.clear()
        ids = self[part] = self._whole(" " + part)
        return ids

    def _whole(self, text: str) -> bytes:
        return np.array(self._encode(text), "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if self._cut and any(t in text for t in self._added):
            parts = [p for p in self._cut.split(text) if p]
            return b"".join(self._added.get(p) or self._plain(p) for p in parts)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if "  " in text or any(b + " " in text for b in _BLANKS if b in text):
            return self._whole(text)
        first, *rest = text.split(" ")
        if rest and not rest[-1]:
            return self._whole(text)
        return self._whole(first) + b"".join(map(self.__getitem__, rest))


def added_tokens(vocabulary: str) -> dict[str, int]:
    """The added tokens that a vocabulary file of ``tokenizers`` lists."""
    with open(vocabulary, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Deal items to windows by multiway differencing; returns item numbers."""
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[-1] = size
        heap.append((-size, i, sums, [[] for _ in range(windows - 1)] + [[i]]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, a, held_a = heapq.heappop(heap)
        _, _, b, held_b = heapq.heappop(heap)
        sums = a + b[::-1]
        held = [x + y for x, y in zip(held_a, reversed(held_b))]
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        sums = sums - sums[0]
        heapq.heappush(heap, (-int(sums[-1]), i, sums, [held[k] for k in order]))
    return heap[0][3] if heap else []


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of nearly equal size, none above ``capacity``."""
    count = max(1, -(-sum(sizes) // capacity))
    while sizes:
        dealt = differencing(sizes, count)
        if max(sum(sizes[i] for i in w) for w in dealt) <= capacity:
            return [w for w in dealt if w]
        count += 1
    return []


def cuts(n: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the full lengths, then of equal parts of what is left."""
    full = n // capacity
    out = [(i * capacity, capacity) for i in range(full)]
    rest = n - full * capacity
    parts = -(-rest // piece)
    at = full * capacity
    for i in range(parts):
        size = rest * (i + 1) // parts - rest * i // parts
        out.append((at, size))
        at += size
    return out


def pack(
    documents: DataFrame,
    ranks: str | None = None,
    pattern: str | None = None,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    end: int = END,
    batch: int = BATCH,
    added: Mapping[str, int] | None = None,
) -> DataFrame:
    """One row per piece of a document (``SCHEMA``): where it lies in its document and
    in its sequence. ``ranks`` is a file of byte ranks, ``pattern`` what splits a text
    before merges, ``added`` the ids of added tokens; by default those of the public
    byte-level vocabulary."""
    if added is None:
        import public_tokenizers

        added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers as public

        tokens = Tokens(
            ranks or public.path("byte_bpe_50k.tiktoken"), pattern or public.PATTERN, added=added
        )
        last = np.array([end], "<u4").tobytes()
        number = TaskContext.get().partitionId() << 32
        open_pieces: list[tuple] = []

        def close():
            nonlocal number
            rows = []
            for window in windows_of([p[2] for p in open_pieces], capacity):
                at = 0
                for i in window:
                    rows.append((*open_pieces[i], number, at))
                    at += open_pieces[i][2]
                number += 1
            open_pieces.clear()
            return rows

        for whole in batches:
            for part in chunks(whole, 1):
                rows = []
                for doc, text in zip(*(c.to_pylist() for c in part.columns)):
                    ids = tokens.ids(text.decode("utf-8", "replace")) + last
                    n = len(ids) // 4
                    for start, length in cuts(n, capacity, piece):
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        if length == capacity:
                            rows.append((doc, start, length, crc, n, number, 0))
                            number += 1
                        else:
                            open_pieces.append((doc, start, length, crc, n))
                    if len(open_pieces) >= batch:
                        rows += close()
                if rows:
                    yield record_batch(SCHEMA, *zip(*rows))
        rows = close()
        if rows:
            yield record_batch(SCHEMA, *zip(*rows))

    return documents.select("doc_id", utf8("text").alias("text")).mapInArrow(run, SCHEMA)
