"""Near copies by SimHash fingerprints and exact shingle similarity: every pair of texts
whose sets of word shingles have a Jaccard similarity of at least ``SIMILARITY`` is linked.

* Texts with equal sets are one node from the start, named by a 64-bit hash of the set.
* Candidates are first what ``simhash_dups.near_duplicates`` puts into one component:
  fingerprints of the same shingles, found by blocks, discarded by pivot distances. Where
  asked for (``alike``), its components are links themselves, whatever the similarity.
* A pair at the threshold differs in some ten of 64 bits, beyond any radius that blocks
  can serve. So that no link is lost, candidates come from ``BANDS`` keys as well, each
  of ``ROWS`` minima of the shingles under hashes of their own. A pair at the threshold
  shares no key with a probability of 5e-8, a pair above it with less. All nodes of a
  component or key are tied to its smallest one: one row each, never pairs.
* Components of these ties hold every similar pair. Texts of components of two nodes or
  more are moved once, and their sets compared inside the component, all shingles of
  both, no estimate. A node already reached is not compared again as a neighbour. A
  component of more than ``PART`` bytes is cut into parts that meet in pairs.

Defined cases: a null text is empty; texts without words are one node. A text of fewer
than ``SHINGLE`` words is one shingle. Letters A-Z count as lower case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.arrays import U, joined, mix, per_text, run_hashes, span_hashes, word_spans
from shelfmark.llm.common import map_chunks, map_rows, record_batch, stored, utf8
from shelfmark.llm.components import components
from shelfmark.llm.simhash_dups import RADIUS, near_duplicates

SHINGLE = 5
SIMILARITY = (4, 5)  # at least four fifths
BANDS = 32
ROWS = 4
PART = 32 << 20

_rng = np.random.default_rng(5080)
_salts = _rng.integers(0, 2**64, BANDS * ROWS, dtype=U, endpoint=False)
_factors = _rng.integers(0, 2**64, BANDS * ROWS, dtype=U, endpoint=False) | U(1)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of ``size`` words."""
    buf, offsets = joined([t.lower() for t in texts])
    starts, ends = word_spans(buf)
    words = span_hashes(buf, starts, ends)
    first = per_text(starts, offsets)
    runs = run_hashes(words, size)
    return [
        np.unique(runs[a : b - size + 1] if b - a >= size else run_hashes(words[a:b], b - a))
        if b > a else np.empty(0, U)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist())
    ]


def node_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


WORDLESS = node_of(np.empty(0, U))


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """``BANDS`` keys of each set; none is empty."""
    flat = np.concatenate(sets)
    edges = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), BANDS), U)
    for band in range(BANDS):
        key = np.full(len(sets), band, U)
        for i in range(band * ROWS, band * ROWS + ROWS):
            key = mix(key + np.minimum.reduceat((flat ^ _salts[i]) * _factors[i], edges))
        out[:, band] = key
    return out.view(np.int64)


def similar_forest(sets: list[np.ndarray], similarity: tuple[int, int] = SIMILARITY) -> list[tuple[int, int]]:
    """Links that connect what is similar, one for each set reached from another."""
    over, under = similarity
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    edges = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    marked = np.zeros(int(flat.max()) + 1, bool)
    rest = np.argsort(sizes, kind="stable")
    links = []
    while len(rest):
        stack, rest = [rest[0]], rest[1:]
        while stack and len(rest):
            at = stack.pop()
            n, others = int(sizes[at]), sizes[rest]
            fits = np.arange(  # sizes ascend; similar sets have similar sizes
                np.searchsorted(others * under, n * over, "left"),
                np.searchsorted(others * over, n * under, "right"),
            )
            if not len(fits):
                continue
            marked[flat[edges[at] : edges[at + 1]]] = True
            near = rest[fits]
            shared = np.fromiter(
                (np.count_nonzero(marked[flat[edges[i] : edges[i + 1]]]) for i in near),
                np.int64, len(near),
            )
            marked[flat[edges[at] : edges[at + 1]]] = False
            hit = shared * (over + under) >= over * (n + sizes[near])
            links += [(int(at), int(i)) for i in near[hit]]
            stack += near[hit].tolist()
            rest = np.delete(rest, fits[hit])
    return links


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside each run of rows with equal ``root, low, high``."""

    def linked(held: list[tuple[int, bytes]]):
        pairs = similar_forest([np.frombuffer(s, U) for _, s in held])
        a, b = ([held[p[side]][0] for p in pairs] for side in (0, 1))
        return record_batch("a long, b long", a, b)

    at, held = None, []
    for batch in batches:
        for *key, node, shingles in zip(*(c.to_pylist() for c in batch.columns)):
            if key != at:
                if len(held) > 1:
                    yield linked(held)
                at, held = key, []
            held.append((node, shingles))
    if len(held) > 1:
        yield linked(held)


def ties(keyed: DataFrame) -> DataFrame:
    """Links ``a, b`` of every node to the smallest one that shares a key with it;
    ``keyed`` has columns ``node`` and ``keys``."""
    keyed = keyed.select("node", F.explode("keys").alias("key"))
    heads = keyed.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z"))
    tied = keyed.join(heads.where("a < z"), "key").where("node <> a")
    return tied.select("a", F.col("node").alias("b")).distinct()


def candidate_groups(keyed: DataFrame) -> DataFrame:
    """``node, root`` of every node that shares a key with another."""
    return components(stored(ties(keyed), "ties"))


def similar_links(texts: DataFrame, part: int = PART) -> DataFrame:
    """Links ``a, b`` that connect all similar nodes; ``texts`` has columns ``node``,
    ``root`` and ``text``."""

    def run(nodes, roots, texts):
        return record_batch(
            "node long, root long, shingles binary", nodes, roots,
            [s.tobytes() for s in shingle_sets(texts)],
        )

    sets = stored(
        map_chunks(
            texts.select("node", "root", utf8("text").alias("text")), run,
            "node long, root long, shingles binary", text=2,
        ),
        "shingle-sets",
    )
    sizes = sets.groupBy("root").agg(
        F.ceil(F.sum(F.length("shingles")) / part).cast("int").alias("parts")
    )
    mine = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    names = ["root", "low", "high"]
    return (
        sets.join(sizes, "root").withColumn("mine", mine)
        # a part meets every part, itself included
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "root", F.least("mine", "other").alias("low"),
            F.greatest("mine", "other").alias("high"), "node", "shingles",
        )
        .repartition(*names).sortWithinPartitions(*names, "node")
        .mapInArrow(_verified, "a long, b long")
        .distinct()
    )


def fingerprint_keys(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``node, keys`` with one key for each component of fingerprints that the node has a
    row in; ``rows`` has columns ``row``, ``node`` and ``text``."""
    found = near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"), SHINGLE, radius)
    # a hash of two values is no key of a band but by chance, and then one more candidate
    key = F.xxhash64(F.lit("fingerprint"), "component_id")
    alike = rows.select("row", "node").join(found, F.col("row") == F.col("doc_id"))
    return alike.select("node", F.array(key).alias("keys")).distinct()


def near_copies(
    documents: DataFrame, part: int = PART, bands: int = BANDS, alike: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``documents`` with a number each, ``row``, stored; and ``row,
    component``, where rows share a component that are connected by similar texts. With
    fewer ``bands`` some links may be missed; with none the fingerprints alone name
    candidates. With ``alike`` the texts that the fingerprints put together are connected
    as well, however little they share. A text without words has no likeness of its own:
    fingerprint zero links it to short texts by chance, which does not count."""
    columns = documents.columns
    schema = "node long, keys array<long>"

    def run(texts):
        sets = shingle_sets(texts)
        full = [k for k, s in enumerate(sets) if len(s)]
        keys = [[] for _ in sets]
        if full:
            for k, own in zip(full, band_keys([sets[k] for k in full]).tolist()):
                keys[k] = own[:bands]
        return record_batch(schema, [node_of(s) for s in sets], keys)

    rows = documents.select(
        utf8("text").alias("_utf8"), *columns, F.monotonically_increasing_id().alias("row")
    )
    # the row numbers hold because this is stored
    named = stored(map_rows(rows, run, schema, text=0, carry=[*columns, "row"]), "shingled")
    prints = stored(fingerprint_keys(named), "fingerprint-keys")
    keyed = named.select("node", "keys").unionByName(prints)
    groups = stored(candidate_groups(keyed), "candidates")
    texts = named.select("node", "text").join(groups, "node").dropDuplicates(["node"])
    links = stored(similar_links(texts, part), "similar")
    if alike:
        links = links.unionByName(ties(prints.where(F.col("node") != WORDLESS)))
    found = named.select("row", "node").join(components(links), "node", "left")
    return named.select(*columns, "row"), found.select(
        "row", F.coalesce("root", "node").alias("component")
    )
