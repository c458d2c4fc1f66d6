"""Shards of nearly equal bytes by sampled splitters, in column expressions only.

A row's key is a hash of its text, so equal texts are neighbours; its size is its text's
bytes and one more.

1. A sample of ``SAMPLE`` keys is drawn with weight by size (the smallest
   ``-ln(u) / size``, with ``u`` from a hash of the row). Its sorted keys are the
   quantile boundaries: every range between two of them holds about the same bytes.
2. Ranges and the few keys that are large by themselves are measured. A range over the
   bound is subdivided by a second hash of the key, so equal texts stay together; a
   group of equal texts over the bound is a range of its own.
3. Ranges go to shards, largest first, each to the shard with the fewest bytes. A
   group of equal texts larger than ``GROUP_SHARE`` of a shard is dealt in parts, or no
   law of equal bytes could hold.
4. A row's slot is its number inside its range plus the rows of the shard's ranges
   before it. Ranges are small, also where one text fills a third of the table, since a
   large group is numbered in parts.

The driver sees the sample and one row per range, both of bounded number. The join of
rows with ranges broadcasts that bounded table.

Defined cases: a null text has size 1 and the checksum of no bytes. Rows that repeat a
``doc_id`` or are equal in all are put in one place after the other. A null ``doc_id`` is
placed like any other row. An empty table gives no rows. Extra columns are not looked
at.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import stored

SHARDS = 16
SAMPLE = 1023
GROUP_SHARE = 1.0
_STEP = 32  # boundaries of the first level; SAMPLE + 1 is its square


def keyed(documents: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, key`` of every row."""
    text = F.col("text")
    return documents.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit("")), F.octet_length(text).isNull()).alias("key"),
    )


def _unit(*columns: str | Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.pmod(F.xxhash64(*columns), F.lit((1 << 52) - 1)) + 1) / F.lit(float(1 << 52))


def splitters(rows: DataFrame, sample: int = SAMPLE) -> list[int]:
    """The sorted keys of a sample of rows, drawn with weight by size."""
    drawn = (
        rows.select("key", (-F.log(_unit("key", "doc_id")) / F.col("size")).alias("order"))
        .orderBy("order", "key").limit(sample).collect()
    )
    return sorted(r.key for r in drawn)


def range_number(key: Column, bounds: list[int]) -> Column:
    """How many boundaries are at or below the key, by two levels of search."""
    blocks = [bounds[i : i + _STEP] for i in range(0, len(bounds), _STEP)] or [[]]
    listed = F.from_json(F.lit(json.dumps(blocks)), "array<array<bigint>>")
    heads = F.from_json(F.lit(json.dumps([b[0] for b in blocks if b])), "array<bigint>")
    block = F.aggregate(heads, F.lit(0), lambda n, b: n + (b <= key).cast("int"))
    inside = F.aggregate(
        F.element_at(listed, F.greatest(block, F.lit(1))),
        F.lit(0), lambda n, b: n + (b <= key).cast("int"),
    )
    return F.when(block == 0, 0).otherwise((block - 1) * _STEP + inside)


def _table(spark, rows: list[dict], schema: str) -> DataFrame:
    """A small table as a constant of the plan."""
    return spark.range(1).select(
        F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>"))
    )


def deal(sizes: list[tuple[int, object]], shards: int) -> dict:
    """Largest first, each to the shard with the fewest bytes so far."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for size, name in sorted(sizes, key=lambda x: (-x[0], str(x[1]))):
        filled, shard = heapq.heappop(heap)
        out[name] = shard
        heapq.heappush(heap, (filled + size, shard))
    return out


def shard(documents: DataFrame, shards: int = SHARDS, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row."""
    spark = documents.sparkSession
    rows = stored(keyed(documents), "sizes")
    bounds = splitters(rows, sample)
    ranged = stored(rows.withColumn("range", range_number(F.col("key"), bounds)), "ranges")
    measured = ranged.groupBy("range").agg(F.sum("size").alias("bytes")).collect()
    total = sum(r.bytes for r in measured)
    bound = max(1, 2 * total // (sample + 1))

    # keys over half the bound, at most 2 * total / bound of them
    over = [r.range for r in measured if r.bytes > bound]
    groups = (
        ranged.where(F.col("range").isin(over))
        .groupBy("key").agg(F.sum("size").alias("bytes"))
        .where(F.col("bytes") > bound // 2).collect()
        if over else []
    )
    share = GROUP_SHARE * total / shards
    large = _table(
        spark,
        [
            {"key": r.key, "parts": 2 * r.bytes // bound + 1, "whole": r.bytes <= share}
            for r in groups
        ],
        "key:bigint,parts:bigint,whole:boolean",
    )
    cut = _table(
        spark,
        [{"range": r.range, "cuts": 2 * r.bytes // bound + 1} for r in measured if r.bytes > bound],
        "range:int,cuts:bigint",
    )
    placed = (
        ranged.join(F.broadcast(large), "key", "left")
        .join(F.broadcast(cut), "range", "left")
        .select(
            "doc_id", "size", "text_crc32", "key",
            F.when(F.col("parts").isNull(), F.col("range")).otherwise(-1).alias("range"),
            F.when(F.col("parts").isNull(), 0).otherwise(F.col("key")).alias("group"),
            F.coalesce("whole", F.lit(False)).alias("whole"),
            F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("doc_id", "text_crc32"), "parts"))
            .otherwise(F.pmod(F.xxhash64("key", F.lit("cut")), F.coalesce("cuts", F.lit(1))))
            .alias("part"),
        )
    )
    names = ["range", "group", "part"]
    pieces = (
        placed.groupBy(*names)
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.first("whole").alias("whole"))
        .collect()
    )
    # what stays together goes to one shard
    units: dict[tuple, int] = {}
    unit_of = {}
    for p in pieces:
        unit = (p.range, p.group) if p.whole else (p.range, p.group, p.part)
        unit_of[p.range, p.group, p.part] = unit
        units[unit] = units.get(unit, 0) + p.bytes
    dealt = deal([(b, u) for u, b in units.items()], shards)
    ahead = [0] * shards
    listed = []
    for p in sorted(pieces, key=lambda p: (p.range, p.group, p.part)):
        to = dealt[unit_of[p.range, p.group, p.part]]
        listed.append({"range": p.range, "group": p.group, "part": p.part, "shard": to, "ahead": ahead[to]})
        ahead[to] += p.rows
    places = _table(spark, listed, "range:int,group:bigint,part:bigint,shard:int,ahead:bigint")
    number = F.row_number().over(Window.partitionBy(*names).orderBy("key", "doc_id", "text_crc32"))
    return (
        placed.withColumn("number", number)
        .join(F.broadcast(places), names)
        .select(
            "doc_id", "size", "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("ahead") + F.col("number") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
