"""Toxicity scores from bags of subword embeddings and a linear softmax.

A word is the bag of its character n-grams (``GRAMS``), a mark at each of its ends
included; n-grams are hashed into a table of embeddings. A text is the average of the
vectors of all its n-grams, and a linear softmax over that average says how likely each
label is. Embeddings and softmax are trained jointly, in numpy. A misspelt or unseen
word shares most n-grams with words the model has met, so it moves the average alike.

The model is fitted on the driver to a bounded sample of labelled rows: at most
``SAMPLE`` of each label (a documented parameter), drawn by a hash of the id. Tasks
turn sampled texts into n-gram counts; the driver gets those. Once embeddings and
softmax are multiplied out, the model is one number per table entry, ``2 ** BITS`` of
them, and that is what is broadcast. Every document is scored whole, where it lies.

Defined cases: null and empty texts, and texts without a letter or digit, have no
n-gram and get the score of the bias alone. Rows that repeat a ``doc_id`` are scored
each; a null ``doc_id`` is scored and not held out. Labels that are null are not used,
and a document labelled twice counts as toxic if one label says so. Without labelled
rows of both kinds every score is 0. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import map_chunks, map_rows, record_batch, utf8
from shelfmark.llm.folding import fold

BITS = 18
GRAMS = (4, 6)
SAMPLE = (2200, 800)  # rows with label 0, with label 1
DIMENSIONS = 8
EPOCHS = 8
BATCH = 64
RATE = 0.1
SHRINK = 2e-5
LEAST_TEXTS = 20  # n-grams in fewer sampled texts are left at zero
WEIGHT = 4.0  # of a toxic text in training
THRESHOLD = 0.7

_BAR = np.array([32], np.uint32)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def gram_rows(codes: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length: where n-grams begin, and their place in the table. ``codes``
    are folded texts with a blank at both ends; an n-gram holds no blank inside."""
    blank = codes == 32
    plain = codes * np.uint32(0x9E3779B1)
    h, inside = plain, np.zeros(len(codes), bool)
    out = []
    for n in range(2, GRAMS[1] + 1):
        if len(h) < 2:
            break
        h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + plain[n - 1 :]
        inside = inside[:-1].copy()
        if n > 2:
            inside |= blank[n - 2 : n - 2 + len(inside)]
        if n >= GRAMS[0]:
            at = np.flatnonzero(~inside)
            g = h[at]
            g = (g ^ (g >> np.uint32(13))) * np.uint32(0xC2B2AE35)
            out.append((at, (g >> np.uint32(32 - bits)).astype(np.int32)))
    return out


def gram_counts(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    codes, _ = fold(text)
    rows = gram_rows(np.concatenate([_BAR, codes, _BAR]), bits) if len(codes) else []
    if not rows:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    grams, counts = np.unique(np.concatenate([g for _, g in rows]), return_counts=True)
    return grams, counts.astype(np.int32)


@dataclass
class Model:
    """What an n-gram adds to the log odds of label 1, and the bias."""

    table: np.ndarray
    bias: float
    bits: int

    def scores(self, texts: list[str]) -> np.ndarray:
        folded = [fold(t)[0] for t in texts]
        codes = np.concatenate([_BAR, *(x for c in folded for x in (c, _BAR))])
        ends = np.cumsum([len(c) + 1 for c in folded])
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        sums = np.zeros(len(codes))
        hits = np.zeros(len(codes), np.int64)
        for at, grams in gram_rows(codes, self.bits):
            sums[at] += self.table[grams]
            hits[at] += 1
        starts = np.concatenate([[0], ends[:-1]])
        full = np.array([len(c) > 0 for c in folded], bool)
        if full.any():
            # an n-gram belongs to the text whose blank or letter it begins with
            total = np.add.reduceat(sums[:-1], starts)
            count = np.add.reduceat(hits[:-1], starts)
        odds = np.where(full & (count > 0), total / np.maximum(count, 1), 0.0) + self.bias
        return 1 / (1 + np.exp(-odds))


def fit(
    labels: list[int],
    texts: list[tuple[np.ndarray, np.ndarray]],
    bits: int = BITS,
    dimensions: int = DIMENSIONS,
    epochs: int = EPOCHS,
    least_texts: int = LEAST_TEXTS,
    seed: int = 7,
) -> Model | None:
    """Train embeddings and softmax together on texts given as n-gram counts."""
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    seen = np.zeros(1 << bits, np.int32)
    for grams, _ in texts:
        seen[grams] += 1
    known = seen >= min(least_texts, max(1, len(texts) // 50))
    vectors = rng.normal(0, 0.1, (1 << bits, dimensions)).astype(np.float32)
    vectors[~known] = 0
    softmax = rng.normal(0, 0.1, (2, dimensions)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    moments = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in
               (("vectors", vectors), ("softmax", softmax), ("bias", bias))}
    batches = [b for b in _batches(labels, texts, known, rng) if b is not None]

    done, steps = 0, epochs * len(batches)
    for _ in range(epochs):
        for k in rng.permutation(len(batches)):
            y, grams, share, first, used, order, begin = batches[k]
            text = np.repeat(np.arange(len(y)), np.diff(first, append=len(grams)))
            rate = RATE * (1 - done / steps)
            done += 1
            mean = np.add.reduceat(vectors[grams] * share[:, None], first)
            z = mean @ softmax.T + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p *= np.where(y == 1, WEIGHT, 1.0).astype(np.float32)[:, None] / len(y)
            slope = p @ softmax
            down = np.add.reduceat(slope[text[order]] * share[order][:, None], begin)
            down += SHRINK * vectors[used]
            _step(softmax, p.T @ mean, moments["softmax"], slice(None), rate)
            _step(bias, p.sum(axis=0), moments["bias"], slice(None), rate)
            _step(vectors, down, moments["vectors"], used, rate)
    table = vectors @ (softmax[1] - softmax[0])
    return Model(table.astype(np.float32), float(bias[1] - bias[0]), bits)


def _step(values, slope, moments, at, rate) -> None:
    """An adaptive gradient step on the entries ``at``."""
    mean, square = moments
    mean[at] = 0.9 * mean[at] + 0.1 * slope
    square[at] = 0.99 * square[at] + 0.01 * slope * slope
    values[at] -= rate * mean[at] / (np.sqrt(square[at]) + 1e-8)


def _batches(labels, texts, known, rng):
    """Texts in fixed batches, with what a step needs in both directions."""
    order = rng.permutation(len(texts))
    for k in range(0, len(order), BATCH):
        picked = []
        for i in order[k : k + BATCH]:
            (grams, counts), texts[i] = texts[i], None  # given up as it is taken over
            keep = known[grams]
            if keep.any():
                picked.append((labels[i], grams[keep], (counts[keep] / counts.sum()).astype(np.float32)))
        if not picked:
            yield None
            continue
        sizes = [len(g) for _, g, _ in picked]
        grams = np.concatenate([g for _, g, _ in picked])
        by_gram = np.argsort(grams, kind="stable").astype(np.int32)
        used, begin = np.unique(grams[by_gram], return_index=True)
        yield (
            np.array([y for y, _, _ in picked]),
            grams,
            np.concatenate([s for _, _, s in picked]),
            np.concatenate([[0], np.cumsum(sizes)[:-1]]),
            used, by_gram, begin.astype(np.int32),
        )


def train(
    documents: DataFrame,
    labels: DataFrame,
    sample: tuple[int, int] = SAMPLE,
    bits: int = BITS,
) -> Model | None:
    """Fit to at most ``sample`` labelled rows of each label that are not held out."""
    usable = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    picked = None
    for label, most in enumerate(sample):
        some = (
            usable.where(F.col("toxic") == label)
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        )
        picked = some if picked is None else picked.unionByName(some)
    texts = documents.select("doc_id", utf8("text").alias("text")).join(
        F.broadcast(picked), "doc_id"  # at most sum(sample) rows
    )
    schema = "doc_id long, toxic int, grams binary, counts binary"

    def run(ids, texts, toxic):
        found = [gram_counts(t.decode("utf-8", "replace"), bits) for t in texts]
        return record_batch(
            schema, ids, toxic, [g.tobytes() for g, _ in found], [c.tobytes() for _, c in found]
        )

    rows = map_chunks(texts.select("doc_id", "text", "toxic"), run, schema, text=1)
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sum(sample)).collect()
    marks = [r.toxic for r in rows]
    counts = [(np.frombuffer(r.grams, np.int32), np.frombuffer(r.counts, np.int32)) for r in rows]
    del rows  # fitting gives up each text's counts as it takes them over
    return fit(marks, counts, bits)


def score(
    documents: DataFrame,
    model: Model | None,
    threshold: float = THRESHOLD,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, score, predicted`` of every row; columns of ``carry`` follow unchanged."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, score double, predicted int"

    def run(ids, texts):
        if shared.value is None:
            scores = np.zeros(len(ids))
        else:
            scores = shared.value.scores([t.decode("utf-8", "replace") for t in texts])
        return record_batch(schema, ids, scores, (scores >= threshold).astype(np.int32))

    # the text is carried under its own name, so what is scored gets another
    rows = documents.select("doc_id", utf8("text").alias("_scored"), *carry)
    return map_rows(rows, run, schema, text=1, carry=carry)
