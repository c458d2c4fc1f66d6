"""The four tables in buckets: a merge reads and writes only the buckets it touches.

A project and its children lie in the bucket of the project's id. Every write gets a
folder of its own, with a sub-folder per bucket; a manifest says for every table and
bucket which write holds it. So the next version shares the files of all buckets that a
batch leaves alone, and a write that failed half way is in no manifest. A commit, written
last, makes a version visible; the names of the batches merged so far go with it, and a
batch that is offered again is not merged again.

    root/projects/write=…/bucket=…      root/manifests/version=…/{buckets,batches}
    root/files/write=…/bucket=…         root/commits/version=…
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.plans.tables import (
    ARRIVAL_KEY,
    ID_BITS,
    SCHEMAS,
    Arrivals,
    Tables,
    id_choice,
    merge_folded,
    no_rows,
    place,
    rejected_children,
    split_batch,
)
from shelfmark.session import stored

BUCKETS = 64
_MANIFEST = "table string, bucket int, write string, n_rows bigint"


class Version(NamedTuple):
    """A committed version: its number, and into how many buckets its tables are split
    (the same for all versions of a root)."""

    number: int
    buckets: int


def bucket_of(id_: Column, buckets: int) -> Column:
    return F.pmod(id_, F.lit(buckets)).cast("int")


def create(spark: SparkSession, root: str, buckets: int = BUCKETS) -> Version:
    """An empty version 0. At scale choose the buckets so that one holds some hundred
    megabytes: too few are rewritten for little, too many are small files. Their number
    is a power of two, so a bucket is some low bits of an id."""
    if buckets < 1 or buckets & (buckets - 1) or buckets > 1 << ID_BITS:
        raise ValueError(f"buckets must be a power of two up to {1 << ID_BITS}")
    _commit(spark, root, Version(0, buckets), [], [])
    return Version(0, buckets)


def latest(spark: SparkSession, root: str) -> Version:
    """The last committed version."""
    commits = spark.read.schema("value string, version bigint").text(f"{root}/commits")
    last = commits.agg(F.max_by(F.struct("version", F.col("value").cast("int")), "version")).first()[0]
    return Version(*last)


def _manifest(spark: SparkSession, root: str, version: Version) -> list[tuple]:
    """(table, bucket, write, rows) of every bucket with rows: four per bucket at most."""
    return [tuple(r) for r in spark.read.schema(_MANIFEST).parquet(f"{root}/manifests/version={version.number}/buckets").collect()]


def _batches(spark: SparkSession, root: str, version: Version) -> DataFrame:
    return spark.read.schema("batch string").parquet(f"{root}/manifests/version={version.number}/batches")


def _commit(spark: SparkSession, root: str, version: Version, manifest: list[tuple], batches: list[str]) -> None:
    folder = f"{root}/manifests/version={version.number}"
    # of two writers of one version the second fails here or at the commit
    spark.createDataFrame(manifest, _MANIFEST).coalesce(1).write.parquet(f"{folder}/buckets")
    names = spark.createDataFrame([(b,) for b in batches], "batch string")
    if version.number:
        names = names.unionByName(_batches(spark, root, version._replace(number=version.number - 1)))
    names.coalesce(1).write.parquet(f"{folder}/batches")
    spark.sql(f"SELECT '{version.buckets}' AS value").write.text(f"{root}/commits/version={version.number}")


def _load(spark: SparkSession, root: str, table: str, manifest: Iterable[tuple]) -> DataFrame:
    paths = [f"{root}/{table}/write={w}/bucket={b}" for t, b, w, _ in manifest if t == table]
    if not paths:
        return no_rows(spark, SCHEMAS[table])
    reader = spark.read.schema(SCHEMAS[table]).option("basePath", f"{root}/{table}")
    return reader.parquet(*paths).select(*SCHEMAS[table].names)


def read(
    spark: SparkSession, root: str, version: Version | None = None, buckets: Iterable[int] | None = None
) -> Tables:
    """The tables of a version (the last one); with ``buckets`` only their files are
    listed and opened."""
    manifest = _manifest(spark, root, version or latest(spark, root))
    if buckets is not None:
        wanted = set(buckets)
        manifest = [row for row in manifest if row[1] in wanted]
    return Tables(*[_load(spark, root, name, manifest) for name in Tables._fields])


def _write(df: DataFrame, root: str, table: str, buckets: int, write: str) -> list[tuple]:
    """Write the rows by bucket; a large bucket becomes several files."""
    folder = f"{root}/{table}/write={write}"
    key = F.col("id" if table == "projects" else "project_id")
    rows = df.withColumn("bucket", bucket_of(key, buckets)).hint("rebalance", "bucket")
    rows.write.partitionBy("bucket").parquet(folder)
    written = df.sparkSession.read.schema("bucket int").parquet(folder)
    counts = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return [(table, r.bucket, write, r.n) for r in counts.collect()]


def merge_batch(
    spark: SparkSession,
    root: str,
    arrived: Arrivals,
    batch: str,
    choose_id: Callable[[Column, Column, int], Column] = id_choice,
) -> Version:
    """Merge a named batch of arrivals into the last version and commit the next one.
    A batch merged before changes nothing. Rejected rows go to ``root/quarantine``.

    Projects whose hashes are equal get different ids. All choices of an id lie in one
    bucket, so the ids in use that matter are those of the touched buckets."""
    version = latest(spark, root)
    if not _batches(spark, root, version).where(F.col("batch") == batch).isEmpty():
        return version
    manifest = _manifest(spark, root, version)
    folded, rejected = split_batch(arrived)
    id_ = choose_id(F.col("project_url"), F.col("version"), 0)
    keys = stored(folded.select(*ARRIVAL_KEY, "last_seq"), "folded")
    touched = {r[0] for r in keys.select(bucket_of(id_, version.buckets)).distinct().collect()}
    current = Tables(*[
        _load(spark, root, name, [row for row in manifest if row[1] in touched]) for name in Tables._fields
    ])
    placed = place(current.projects, keys, stored, choose_id)
    write = uuid.uuid4().hex
    bad = {"projects": rejected, **rejected_children(placed.where("newest"), arrived)}
    merged = merge_folded(current, folded, arrived, placed)
    after = [row for row in manifest if row[1] not in touched]
    # the writes are jobs of their own; side by side they fill the cluster
    with ThreadPoolExecutor(len(Tables._fields) + len(bad)) as pool:
        kept = [
            pool.submit(_write, rows, root, name, version.buckets, write) for name, rows in merged._asdict().items()
        ]
        aside = [
            pool.submit(rows.write.parquet, f"{root}/quarantine/{name}/write={write}") for name, rows in bad.items()
        ]
        for job in aside:
            job.result()
        for job in kept:
            after += job.result()
    following = version._replace(number=version.number + 1)
    _commit(spark, root, following, after, [batch])
    return following
