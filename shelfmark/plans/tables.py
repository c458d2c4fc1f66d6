"""Accepted records and transfer outcomes to the four linked tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import schemas
from shelfmark.functions.files import (
    base_name,
    file_ext,
    file_type,
    is_archive,
    is_project_file,
    safe_filename,
)
from shelfmark.functions.records import keyword_set, person_roles
from shelfmark.operators.joins import repository_id
from shelfmark.schemas import (
    PROJECT_KEPT,
    PROJECT_KEY,
    PROJECT_ORDER,
    PROJECT_UPDATED,
    REQUIRED_COLUMNS,
    conform,
)


class Tables(NamedTuple):
    projects: DataFrame
    files: DataFrame
    keywords: DataFrame
    person_role: DataFrame


SCHEMAS = {
    "projects": schemas.PROJECTS,
    "files": schemas.FILES,
    "keywords": schemas.KEYWORDS,
    "person_role": schemas.PERSON_ROLE,
}

DOWNLOAD_METHOD = "SCRAPING | API"
NAMELESS_FILE = "unknown"


class Arrivals(NamedTuple):
    """A batch of arrivals: project rows and child rows, all with ``project_url``,
    ``version``, ``seq`` and ``ingest_date``. ``seq`` orders the arrivals of a project by
    time. Children stay rows, however many a project has."""

    projects: DataFrame
    files: DataFrame
    keywords: DataFrame
    person_role: DataFrame


def project_id(url: Column, version: Column) -> Column:
    """Surrogate key: a hash of the natural one, equal on every run."""
    return F.xxhash64(url, F.coalesce(version, F.lit("")))


#: The low bits of an id, which no other choice of it changes.
ID_BITS = 16


def id_choice(url: Column, version: Column, attempt: int) -> Column:
    """The id a project asks for: its hash, and where that belongs to another project,
    a further hash with the same low bits, so the project stays in its bucket."""
    first = project_id(url, version)
    if not attempt:
        return first
    low = (1 << ID_BITS) - 1
    again = F.xxhash64(url, F.coalesce(version, F.lit("")), F.lit(attempt))
    return again.bitwiseAND(F.lit(~low)).bitwiseOR(first.bitwiseAND(F.lit(low)))


def own_id(projects: DataFrame) -> Column:
    """The id of folded projects: that in the table or the one given by
    :func:`assign_ids`, else the hash."""
    hashed = project_id(F.col("project_url"), F.col("version"))
    return F.coalesce("id", hashed) if "id" in projects.columns else hashed


ARRIVAL_KEY = [*PROJECT_KEY, "seq"]

#: The hash of a project's key, put before the key in groupings and joins: addresses begin
#: alike, so sorting by them compares whole texts, and a number tells them apart at once.
KEY_HASH = "_key_hash"


def _hashed(df: DataFrame) -> DataFrame:
    if KEY_HASH in df.columns:
        return df
    return df.withColumn(KEY_HASH, F.xxhash64(*PROJECT_KEY))
_ARRIVED = ["project_url", "seq", "ingest_date"]
_RECORD_KEY = ["context_repository", "project_identifier", "version"]


def transferred_files(
    wanted: DataFrame, outcomes: DataFrame, members: DataFrame | None = None
) -> DataFrame:
    """The files of ``wanted`` that arrived: its columns, every row once.

    ``wanted`` has the record key and ``file_name``. ``outcomes`` is the transfer
    manifest: the same and ``bytes``. A readable archive gives way to its
    ``members`` (the record key, ``archive`` = its file name, ``member``).
    """
    moved = outcomes.filter(F.col("bytes") > 0).select(*_RECORD_KEY, "file_name").distinct()
    arrived = wanted.join(moved, [*_RECORD_KEY, "file_name"], "left_semi")
    if members is None:
        return arrived.distinct()
    inner = members.filter(
        F.col("member").isNotNull() & is_archive(file_ext(F.col("archive")))
    ).select(*_RECORD_KEY, F.col("archive").alias("file_name"), "member")
    at = [*_RECORD_KEY, "file_name"]
    # files that are no archives have no members to look for
    archive = is_archive(file_ext(F.col("file_name")))
    plain, archives = arrived.filter(~archive), arrived.filter(archive)
    closed = plain.unionByName(archives.join(inner.select(*at).distinct(), at, "left_anti"))
    # an inner join, so that the members of one huge archive can be split up
    opened = archives.join(inner, at).withColumn("file_name", F.col("member")).drop("member")
    # a file of the same name out of two archives is one file on disk
    return closed.unionByName(opened).distinct()


def arrivals(
    records: DataFrame,
    outcomes: DataFrame,
    download_date: str | dt.datetime | Column,
    members: DataFrame | None = None,
    strict: bool = False,
    legacy: bool = False,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> Arrivals:
    """Records that have a file to show, ready to be merged.

    A record counts with a transferred or a restricted file; in strict mode
    only with a transferred analysis-project file, and only those are listed.
    ``legacy`` ignores the license and people that some sources deliver under
    other names. ``store`` keeps the file rows, which are used more than once, and the
    records that only a look at them lets count; it spares the others (in strict mode none)
    the join with the file rows. ``download_date`` is the time of the whole batch, or a column with that of each record (as ISO text):
    a log may hold several arrivals of one project.
    """
    if isinstance(download_date, dt.datetime):
        download_date = download_date.isoformat()
    when = download_date if isinstance(download_date, Column) else F.lit(download_date)
    repo, ident = F.col("context_repository"), F.col("project_identifier")
    records = records.withColumn("version", F.coalesce("version", F.lit("v1"))).withColumns(
        {
            "project_url": F.coalesce(
                F.when(F.trim("project_url") != "", F.col("project_url")), F.concat(F.lit("https://"), repo, F.lit(".org/record/"), ident)
            ),
            "_when": when,
            # later arrivals come last; should two records of one time share a URL,
            # the order of their folders settles which of them does
            "seq": F.concat_ws("/", when, repo, ident),
        }
    )
    records = records.withColumn("ingest_date", F.substring("_when", 1, 10))
    listed = records.select(*_RECORD_KEY, *_ARRIVED, F.explode("files").alias("f"))
    restricted = F.coalesce(F.col("f.restricted"), F.lit(False))
    wanted = listed.filter(~restricted & (F.coalesce(F.col("f.file_url"), F.lit("")) != "")).select(
        *_RECORD_KEY, *_ARRIVED, safe_filename(F.col("f.file_key")).alias("file_name")
    )
    there = transferred_files(wanted, outcomes, members)
    if strict:
        there = there.filter(is_project_file(file_ext(base_name(F.col("file_name")))))
    done = there.select(
        *ARRIVAL_KEY, "ingest_date", "file_name", F.lit("SUCCEEDED").alias("status"), F.lit("").alias("failure_reason")
    )
    failed = listed.filter(restricted).select(
        *ARRIVAL_KEY,
        "ingest_date",
        F.coalesce(F.when(F.trim("f.file_key") != "", F.col("f.file_key")), F.lit(NAMELESS_FILE)).alias("file_name"),
        F.lit("FAILED").alias("status"),
        F.coalesce("f.failure_reason", F.lit("Restricted access")).alias("failure_reason"),
    )
    files = done.unionByName(failed).withColumn("file_type", file_type(F.col("file_name")))
    if store:
        files = store(files)
    evidence = files.filter(F.col("status") == "SUCCEEDED") if strict else files
    evidence = evidence.select(*ARRIVAL_KEY).distinct()
    if strict:
        evidence = store(evidence) if store else evidence
        files = files.join(evidence, ARRIVAL_KEY, "left_semi")
    if store and not strict:
        # a record with a restricted file counts by itself; its text need not move
        restricts = F.coalesce(F.array_contains("files.restricted", True), F.lit(False))
        itself = restricts & F.col("project_url").isNotNull()
        rest = records.filter(~itself)
        waiting = store(rest.select(*ARRIVAL_KEY).distinct())
        if waiting.isEmpty():
            shown = records
        else:
            found = store(waiting.join(evidence, ARRIVAL_KEY, "left_semi"))
            shown = records.filter(itself).unionByName(rest.join(found, ARRIVAL_KEY, "left_semi"))
    else:
        shown = records.join(evidence, ARRIVAL_KEY, "left_semi")

    given = F.when(F.col("license") != "", F.col("license"))
    projects = shown.select(
        *ARRIVAL_KEY,
        "ingest_date",
        F.coalesce("query_string", F.lit("")).alias("query_string"),
        repository_id(repo).alias("repository_id"),
        F.coalesce("repository_url", F.concat(F.lit("https://"), repo, F.lit(".org"))).alias("repository_url"),
        F.coalesce("title", F.lit("Unknown Title")).alias("title"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce("language", F.lit("")).alias("language"),
        F.coalesce("doi", F.lit("")).alias("doi"),
        (F.col("license") if legacy else F.coalesce(given, "license_id")).alias("license"),
        F.coalesce("upload_date", F.lit("")).alias("upload_date"),
        F.col("_when").alias("download_date"),
        repo.alias("download_repository_folder"),
        ident.alias("download_project_folder"),
        F.col("version").alias("download_version_folder"),
        F.lit(DOWNLOAD_METHOD).alias("download_method"),
    )
    people = F.col("creators") if legacy else F.coalesce("creators", "persons")
    return Arrivals(
        projects,
        files,
        shown.select(*ARRIVAL_KEY, "ingest_date", F.explode(keyword_set(F.col("keywords"))).alias("keyword")),
        shown.select(*ARRIVAL_KEY, "ingest_date", F.inline(person_roles(people))),
    )


def _place(df: DataFrame, seq: str) -> Column:
    """The order of arrivals as text that sorts like it."""
    if dict(df.dtypes)[seq] == "string":
        return F.col(seq)
    shifted = F.col(seq).cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    return F.lpad(shifted.cast("string"), 20, "0")


def fold(projects: DataFrame, seq: str = "seq") -> DataFrame:
    """Arrivals of one project to one row, as if applied in ``seq`` order: kept
    columns from the first arrival, refreshed ones and ``seq`` from the last, and the
    places of both as ``first_seq`` and ``last_seq``. Rows come dealt by :data:`KEY_HASH`
    and the key."""
    updated = [c for c in PROJECT_UPDATED if c in projects.columns]
    kept = [c for c in PROJECT_KEPT if c in projects.columns]
    placed = _hashed(projects.withColumn("_place", _place(projects, seq)))
    return (
        placed.groupBy(KEY_HASH, *PROJECT_KEY)
        .agg(
            F.min_by(F.struct(*kept), F.col(seq)).alias("_kept"),
            F.max_by(F.struct(*updated), F.col(seq)).alias("_updated"),
            F.max(seq).alias(seq),
            F.min("_place").alias("first_seq"),
            F.max("_place").alias("last_seq"),
        )
        .select(KEY_HASH, *PROJECT_KEY, seq, "first_seq", "last_seq", "_kept.*", "_updated.*")
    )


def upsert(current: DataFrame, folded: DataFrame) -> DataFrame:
    """Projects after the merge, as if all arrivals had been applied in their order,
    however they were dealt to merges: kept columns from the earlier first arrival,
    refreshed ones from the later last one, unknown projects added. Both sides are
    unique by key. Table rows without a place are older than any arrival."""
    new = _hashed(folded).withColumn("_touched", F.lit(True))
    placed = _hashed(current)
    for c in PROJECT_ORDER:
        if c not in current.columns:
            placed = placed.withColumn(c, F.lit(None).cast("string"))
    joined = placed.alias("t").join(
        new.alias("b"),
        [F.col(f"t.{c}") == F.col(f"b.{c}") for c in (KEY_HASH, *PROJECT_KEY)],
        "full_outer",
    )
    added = F.col("t.project_url").isNull()
    touched = F.coalesce(F.col("b._touched"), F.lit(False))
    earlier = added | (touched & F.coalesce(F.col("b.first_seq") < F.col("t.first_seq"), F.lit(False)))
    later = added | (touched & F.coalesce(F.col("b.last_seq") >= F.col("t.last_seq"), F.lit(True)))

    def pick(c: str) -> Column:
        from_batch = later if c in PROJECT_UPDATED or c == "last_seq" else earlier
        return F.when(from_batch, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}"))

    columns = [c for c in schemas.PROJECTS.names if c in placed.columns and c != "id"]
    # a project keeps the id it has
    ids = [F.col(f"{side}.id") for side, df in (("t", current), ("b", folded)) if "id" in df.columns]
    merged = joined.select(*[pick(c).alias(c) for c in columns], F.coalesce(*ids, F.lit(None).cast("long")).alias("id"))
    return merged.withColumn("id", own_id(merged))


def mark_newest(current: DataFrame, folded: DataFrame) -> DataFrame:
    """Folded projects with ``newest``: whether the table has no later arrival. Only
    then do their children replace those of the table. ``id`` is that of the table, null
    for new projects."""
    known = current.select(*PROJECT_KEY, "id", F.col("last_seq").alias("_known"))
    newest = F.coalesce(F.col("last_seq") >= F.col("_known"), F.lit(True))
    return folded.join(known, PROJECT_KEY, "left").withColumn("newest", newest).drop("_known")


def assign_ids(
    current: DataFrame,
    marked: DataFrame,
    store: Callable[[DataFrame], DataFrame],
    choose: Callable[[Column, Column, int], Column] = id_choice,
) -> DataFrame:
    """Marked projects with an ``id`` that no other project has, in the table or the batch.

    Two projects may have one hash. The one in the table keeps it; of several new ones the
    first in the order of their keys takes it, and the others ask for their next choice,
    until all have one. Every attempt is one anti join with the ids in use and one
    aggregate, both over keys alone; almost always the first is the last.
    """
    key = [F.col(c) for c in PROJECT_KEY]
    waiting = marked.where(F.col("id").isNull()).select(*PROJECT_KEY)
    taken, given = current.select("id"), None
    attempt = 0
    while True:
        asked = waiting.select(*PROJECT_KEY, choose(*key, attempt).alias("id"))
        free = asked.join(taken, "id", "left_anti")
        first = free.groupBy("id").agg(F.min(F.struct(*PROJECT_KEY)).alias("first"))
        won = store(first.select("first.*", "id"))
        given = won if given is None else given.unionByName(won)
        waiting = store(waiting.join(won, PROJECT_KEY, "left_anti"))
        if waiting.isEmpty():
            break
        taken = taken.unionByName(won.select("id"))
        attempt += 1
    new = given.withColumnRenamed("id", "_given")
    joined = marked.join(new, PROJECT_KEY, "left")
    return joined.withColumn("id", F.coalesce("id", "_given")).drop("_given")


def replace_children(current: DataFrame, touched: DataFrame, fresh: DataFrame) -> DataFrame:
    """All children of the touched projects give way to the fresh ones."""
    ids = touched.select("project_id")
    return current.join(ids, "project_id", "left_anti").unionByName(fresh)


def child_rows(folded: DataFrame, arrived: Arrivals) -> dict[str, DataFrame]:
    """Children of the last arrival of every folded project; those of earlier
    arrivals and of rejected projects drop out."""
    last = _hashed(folded.select(*ARRIVAL_KEY, own_id(folded).alias("project_id")))
    rows = {}
    for name in ("files", "keywords", "person_role"):
        # folded projects are unique, so no child is met twice
        of_all = _hashed(_null_safe(getattr(arrived, name)))
        rows[name] = _with_id(of_all.join(last, [KEY_HASH, *ARRIVAL_KEY]), name)
    return rows


def _null_safe(df: DataFrame) -> DataFrame:
    """The version is part of the key, so it is never null there."""
    return df.withColumn("version", F.coalesce("version", F.lit("")))


def _with_id(rows: DataFrame, table: str) -> DataFrame:
    """Ids from the natural columns and, for equal rows, their number."""
    natural = [c for c in SCHEMAS[table].names if c != "id"]
    copy = F.row_number().over(Window.partitionBy(*natural).orderBy(F.lit(0)))
    numbered = rows.withColumn("_copy", copy)
    return conform(numbered.withColumn("id", F.xxhash64(*natural, "_copy")), SCHEMAS[table])


def required_present(df: DataFrame, table: str) -> Column:
    ok = F.lit(True)
    for c in REQUIRED_COLUMNS[table]:
        if c in df.columns:
            ok = ok & F.col(c).isNotNull()
    return ok


def quarantine(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows by the required columns of the table."""
    ok = required_present(df, table)
    return df.filter(ok), df.filter(~ok)


def split_batch(arrived: Arrivals) -> tuple[DataFrame, DataFrame]:
    """(folded good projects, rejected ones) of a batch."""
    good, bad = quarantine(_null_safe(arrived.projects), "projects")
    return fold(good), bad


def _split_children(arrived: Arrivals) -> tuple[Arrivals, Arrivals]:
    """The arrivals with their good children and with their bad ones. Told apart before
    they meet their projects, so that each side moves only its own rows; equal rows are on
    one side, so they get the ids they would get together."""
    split = {name: quarantine(getattr(arrived, name), name) for name in ("files", "keywords", "person_role")}
    good, bad = ({name: both[side] for name, both in split.items()} for side in (0, 1))
    return arrived._replace(**good), arrived._replace(**bad)


def rejected_children(folded: DataFrame, arrived: Arrivals) -> dict[str, DataFrame]:
    """Child rows of accepted projects that lack a required column."""
    return child_rows(folded, _split_children(arrived)[1])


def place(
    current: DataFrame,
    folded: DataFrame,
    store: Callable[[DataFrame], DataFrame],
    choose: Callable[[Column, Column, int], Column] = id_choice,
) -> DataFrame:
    """The keys of folded projects with ``newest`` (:func:`mark_newest`) and ``id``
    (:func:`assign_ids`). Neither needs another column, so the texts stay where they are:
    they move once, when the merged projects are written."""
    keys = folded.select(*ARRIVAL_KEY, "last_seq")
    return store(assign_ids(current, store(mark_newest(current, keys)), store, choose))


def merge_folded(
    current: Tables, folded: DataFrame, arrived: Arrivals, placed: DataFrame | None = None
) -> Tables:
    """The four tables after arrivals whose projects :func:`fold` has reduced. With
    ``placed`` what :func:`place` found out about them. An arrival that comes after a later
    one of its project changes none of what the later one gave."""
    if placed is None:
        placed = folded = mark_newest(current.projects, folded)
    else:
        # folding has dealt the rows by this key, so only the ids move
        ids = _hashed(placed.select(*PROJECT_KEY, "id"))
        folded = _hashed(folded).join(ids, [KEY_HASH, *PROJECT_KEY])
    newest = placed.where("newest")
    touched = newest.select(own_id(newest).alias("project_id"))
    children = {
        name: replace_children(getattr(current, name), touched, rows)
        for name, rows in child_rows(newest, _split_children(arrived)[0]).items()
    }
    projects = conform(upsert(current.projects, folded.drop("seq", "newest")), schemas.PROJECTS)
    return Tables(projects, **children)


def merge(current: Tables, arrived: Arrivals) -> Tables:
    """The four tables after a batch of arrivals; a second time changes nothing, and
    batches may be merged in any order.

    Lazy; to write the result use ``pipeline.merge_into``, which folds once."""
    return merge_folded(current, split_batch(arrived)[0], arrived)


def no_rows(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows, known as such when a query is planned: a join with them costs no job."""
    return spark.createDataFrame([], schema).where("false")


def empty_tables(spark: SparkSession) -> Tables:
    return Tables(*[no_rows(spark, SCHEMAS[name]) for name in Tables._fields])


def read_tables(spark: SparkSession, folder: str) -> Tables:
    """The snapshot in ``folder``; one whose last table was not written is refused."""
    spark.read.text(f"{folder}/{_COMPLETE}").head()
    return Tables(
        *[spark.read.schema(SCHEMAS[n]).parquet(f"{folder}/{n}") for n in Tables._fields]
    )


#: Written after all tables of a snapshot.
_COMPLETE = "complete"


def _mark(spark: SparkSession, folder: str, mode: str) -> None:
    spark.sql("SELECT 'complete' AS value").write.mode(mode).text(f"{folder}/{_COMPLETE}")


def write_all(rows: dict[str, DataFrame], mode: str) -> None:
    """Write rows to their folders. The writes are jobs of their own; side by side they
    fill the cluster."""
    with ThreadPoolExecutor(len(rows)) as pool:
        for job in [pool.submit(df.write.mode(mode).parquet, folder) for folder, df in rows.items()]:
            job.result()


def write_tables(tables: Tables, folder: str) -> None:
    """Write a snapshot into a new folder; never the one being read. Parquet has
    no row update, so a merge writes the next snapshot and readers move on. A mark
    comes last, so half a snapshot is never read."""
    write_all({f"{folder}/{name}": df for name, df in tables._asdict().items()}, "errorifexists")
    _mark(tables.projects.sparkSession, folder, "errorifexists")


def create_tables(spark: SparkSession, folder: str) -> None:
    """Empty tables where there are none; existing ones stay as they are."""
    for name, df in empty_tables(spark)._asdict().items():
        df.write.mode("ignore").parquet(f"{folder}/{name}")
    _mark(spark, folder, "ignore")
