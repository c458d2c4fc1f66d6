"""Records to tables, merges, telemetry, streams."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import joins
from shelfmark.plans import telemetry
from shelfmark.plans.pipeline import merge_into, run
from shelfmark.plans.tables import (
    ARRIVAL_KEY,
    Arrivals,
    Tables,
    arrivals,
    create_tables,
    empty_tables,
    fold,
    merge,
    quarantine,
    read_tables,
)
from shelfmark.schemas import LANDING, RECORD, conform
from shelfmark.session import shared_folder
from shelfmark.streaming import append_log, drain, first_in_log, merge_log, read_stream

PROJECT = (
    "query_string string, repository_id int, repository_url string, project_url string, version string, "
    "title string, description string, language string, doi string, license string, upload_date string, "
    "download_date string, download_repository_folder string, download_project_folder string, "
    "download_version_folder string, download_method string, seq bigint, names array<string>"
)


def arrival(url, seq, title, language="en", version="v1", files=("a.qdpx",), repo=1):
    return (
        f"q{seq}", repo, "https://r", url, version, title, "d", language, "", "cc0", "", f"2024-01-{seq:02d}",
        "r", f"f{seq}", "v1", "SCRAPING | API", seq, list(files),
    )


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), PROJECT)


def arrived(df):
    """Project rows with their children; other columns such as a date go along."""
    extra = [c for c in df.columns if c in ("at", "ingest_date")]
    key = [*ARRIVAL_KEY, *extra]
    files = df.select(*key, F.explode("names").alias("file_name")).withColumns(
        {"file_type": F.substring_index("file_name", ".", -1), "status": F.lit("SUCCEEDED"), "failure_reason": F.lit("")}
    )
    keywords = df.select(*key, F.concat(F.lit("k"), F.col("seq").cast("string")).alias("keyword"))
    people = df.select(*key, F.lit("A").alias("name"), F.lit("AUTHOR").alias("role"))
    return Arrivals(df.drop("names"), files, keywords, people)


def batch(spark, *rows):
    return arrived(rows_of(spark, *rows))


def content(tables: Tables):
    return [sorted(map(str, df.collect())) for df in tables]


def test_upsert_keeps_and_refreshes(spark):
    first = merge(empty_tables(spark), batch(spark, arrival("u", 1, "old", "de", files=("a.qdpx", "b.txt"))))
    after = merge(first, batch(spark, arrival("u", 3, "new", "fr"), arrival("u", 2, "mid", "it"), arrival("w", 2, "w")))
    rows = {r.project_url: r for r in after.projects.collect()}
    assert (rows["u"].title, rows["u"].language, rows["u"].query_string) == ("new", "de", "q1")
    assert rows["u"].download_project_folder == "f3" and rows["w"].title == "w"
    files = {r.project_id: r.file_name for r in after.files.collect()}
    assert files == {rows["u"].id: "a.qdpx", rows["w"].id: "a.qdpx"}
    assert {r.keyword for r in after.keywords.collect()} == {"k3", "k2"}
    for children in after[1:]:
        assert joins.orphans(children, after.projects).count() == 0


def test_upsert_twice_is_once(spark):
    rows = batch(spark, arrival("u", 1, "a"), arrival("u", 2, "b", version=None), arrival("v", 3, "c"))
    once = merge(empty_tables(spark), rows)
    assert content(merge(once, rows)) == content(once)
    assert {(r.project_url, r.version) for r in once.projects.collect()} == {("u", "v1"), ("u", ""), ("v", "v1")}


def test_two_batches_are_one(spark):
    early = [arrival("u", 1, "a", "de"), arrival("v", 2, "b")]
    late = [arrival("u", 4, "c", "fr", files=("x.txt",)), arrival("w", 3, "d")]
    apart = merge(merge(empty_tables(spark), batch(spark, *early)), batch(spark, *late))
    assert content(apart) == content(merge(empty_tables(spark), batch(spark, *early, *late)))


def test_quarantine_and_snapshots(spark, tmp_path):
    old, new = str(tmp_path / "t1"), str(tmp_path / "t2")
    create_tables(spark, old)
    create_tables(spark, old)
    rows = batch(spark, arrival("u", 1, "a"), arrival("v", 2, None), arrival("w", 3, "c", repo=None))
    assert [df.count() for df in quarantine(rows.projects, "projects")] == [1, 2]
    merge_into(read_tables(spark, old), rows, new)
    after = read_tables(spark, new)
    assert [r.project_url for r in after.projects.collect()] == ["u"]
    assert spark.read.parquet(new + "/quarantine/projects").count() == 2
    assert joins.known_project_urls(after.projects).count() == 1


def record(spark, **given):
    values = {f.name: None for f in RECORD.fields}
    values |= {"context_repository": "zenodo", "recid": "1", "project_identifier": "p", "title": "T", "files": []}
    values |= given
    return spark.createDataFrame([tuple(values[n] for n in RECORD.names)], RECORD).withColumn("query_string", F.lit("q"))


OUTCOMES = "context_repository string, project_identifier string, version string, file_name string, bytes bigint"


def file(name, url="u", restricted=False, reason=None):
    return (name, url, 1, True, True, restricted, reason)


def test_arrivals(spark):
    files = [file("a.qdpx"), file("..b.txt"), file("lost.txt"), file("nourl.txt", ""), file("r.qdpx", "", True)]
    rec = record(spark, files=files, license_id="odd", persons=[("P", "PRODUCER")], keywords=["a, b", "a"])
    done = spark.createDataFrame(
        [("zenodo", "p", "v1", n, b) for n, b in [("a.qdpx", 5), ("b.txt", 2), ("lost.txt", 0), ("nourl.txt", 9)]], OUTCOMES
    )
    got = arrivals(rec, done, "2024")
    named = lambda batch: sorted((f.file_name, f.file_type, f.status, f.failure_reason) for f in batch.files.collect())
    assert named(got) == [
        ("a.qdpx", "qdpx", "SUCCEEDED", ""), ("b.txt", "txt", "SUCCEEDED", ""),
        ("r.qdpx", "qdpx", "FAILED", "Restricted access"),
    ]
    row = got.projects.first()
    assert (row.repository_id, row.repository_url, row.project_url) == (1, "https://zenodo.org", "https://zenodo.org/record/p")
    assert row.license == "odd"
    assert [(p.name, p.role) for p in got.person_role.collect()] == [("P", "OTHER")]
    assert sorted(k.keyword for k in got.keywords.collect()) == ["a", "b"]
    old = arrivals(rec, done, "2024", legacy=True)
    assert (old.projects.first().license, old.person_role.count()) == (None, 0)
    strict = arrivals(rec, done, "2024", strict=True)
    assert [f[0] for f in named(strict)] == ["a.qdpx", "r.qdpx"]
    none = done.withColumn("bytes", F.lit(0).cast("bigint"))
    lost = arrivals(rec, none, "2024", strict=True)
    assert (lost.projects.count(), lost.files.count(), lost.keywords.count()) == (0, 0, 0)
    assert [f[2] for f in named(arrivals(rec, none, "2024"))] == ["FAILED"]


def test_run_from_landing_to_tables(spark, tmp_path):
    def response(kind, key, body, term=None):
        return (kind, term, 0, 0, key, 0, json.dumps(body))

    meta = {"title": "MAXQDA", "description": "d", "license": "cc0", "creators": [{"name": "A"}]}
    zenodo = [
        response("search", None, {"hits": {"hits": [{"id": 1}, {"id": 2}]}}, "maxqda"),
        response("detail", "1", {"id": 1, "metadata": meta, "files": [{"key": "x.zip", "href": "u"}]}),
        response("detail", "2", {"id": 2, "metadata": meta, "files": [{"key": "y.pdf", "href": "u"}]}),
    ]
    cessda = [response("search", None, {"Results": [{"id": "9", "titleStudy": "S", "studyUrl": "https://s"}]}, "nvp")]
    for name, rows in {"zenodo": zenodo, "cessda": cessda}.items():
        spark.createDataFrame(rows, LANDING).write.partitionBy("kind").parquet(str(tmp_path / "landing" / name))
    done = spark.createDataFrame([("zenodo", "maxqda-1", "v1", "x.zip", 7)], OUTCOMES)
    members = spark.createDataFrame(
        [("zenodo", "maxqda-1", "v1", "x.zip", "in/z.mx22", 3)],
        "context_repository string, project_identifier string, version string, archive string, member string, size bigint",
    )
    old, new = str(tmp_path / "t0"), str(tmp_path / "t1")
    create_tables(spark, old)
    tables = run(spark, str(tmp_path / "landing"), ["zenodo", "cessda"], done, old, new, "2024-01-01", members)
    projects = {r.download_project_folder: r for r in tables.projects.collect()}
    # record 2 has nothing that arrived and nothing restricted
    assert set(projects) == {"maxqda-1", "9"}
    assert projects["9"].repository_id == 13 and projects["9"].project_url == "https://s"
    assert sorted((r.file_name, r.file_type, r.status) for r in tables.files.collect()) == [
        ("EXTERNAL_REPOSITORY_NOTICE.txt", "txt", "FAILED"), ("in/z.mx22", "mx22", "SUCCEEDED"),
    ]
    totals = telemetry.totals(tables.projects, tables.files).first()
    assert (totals.total_files, totals.total_projects) == (1, 2)
    again = run(spark, str(tmp_path / "landing"), ["zenodo", "cessda"], done, new, str(tmp_path / "t2"), "2024-01-01", members)
    assert content(again) == content(tables)


def test_recent_drops_after_the_limit(spark):
    rows = [(i, f"2024-01-{i:02d}", "" if i == 9 else f"p{i}") for i in range(1, 10)]
    df = spark.createDataFrame(rows, "id int, download_date string, download_project_folder string")
    assert [r.id for r in telemetry.recent_projects(df).collect()] == [8, 7, 6, 5]


def test_types_and_run_totals(spark):
    files = spark.createDataFrame(
        [("pdf", "SUCCEEDED"), ("PDF", "SUCCEEDED"), ("", "SUCCEEDED"), (None, "SUCCEEDED"), ("qdpx", "FAILED")],
        "file_type string, status string",
    )
    assert [tuple(r) for r in telemetry.files_by_type(files).collect()] == [("PDF", 2), ("UNKNOWN", 2)]
    outcomes = spark.createDataFrame([("a", 1048576), ("a", 0), ("b", 0)], "p string, bytes bigint")
    row = telemetry.run_totals(outcomes, ["p"]).first()
    assert (row.total_bytes, row.total_projects, row.total_mb) == (1048576, 1, 1.0)


def test_ghost_folders(spark):
    projects = spark.createDataFrame(
        [(1, "r", "a", "v1"), (2, "r", "b", "v1")],
        "id int, download_repository_folder string, download_project_folder string, download_version_folder string",
    )
    files = spark.createDataFrame([(1, "SUCCEEDED"), (2, "FAILED")], "project_id int, status string")
    folders = spark.createDataFrame(
        [("r", "a", "v1"), ("r", "b", "v1"), ("r", "c", "v1")],
        "repository_folder string, project_folder string, version_folder string",
    )
    assert sorted(r.project_folder for r in joins.ghost_folders(folders, projects, files).collect()) == ["b", "c"]


def test_stream_equals_batch(spark, tmp_path):
    """Arrivals that trickle in, one file at a time, end as one merge would."""
    rows = [arrival("u", 1, "a"), arrival("u", 2, "b"), arrival("v", 3, "c"), arrival("u", 2, "b")]
    landing = str(tmp_path / "landing")
    whole = rows_of(spark, *rows).withColumn("at", F.to_timestamp("download_date"))
    for i, row in enumerate(rows):
        rows_of(spark, row).withColumn("at", F.to_timestamp("download_date")).coalesce(1).write.parquet(f"{landing}/f{i}")
    stream = read_stream(spark, f"{landing}/*", whole.schema, files_per_trigger=1)
    log = drain(stream.withColumn("ingest_date", F.date_format("at", "yyyy-MM-dd")), "log")
    log = first_in_log(log, ["seq"], ["at"])
    assert log.count() == 3
    expected = content(merge(empty_tables(spark), arrived(rows_of(spark, *rows[:3]))))
    assert content(merge_log(empty_tables(spark), arrived(log))) == expected
    # starting over from some earlier date repeats arrivals and changes nothing
    done = merge_log(empty_tables(spark), arrived(log))
    assert content(merge_log(done, arrived(log), since="2024-01-02")) == expected


def test_log_continues(spark, tmp_path):
    source, log, progress = (str(tmp_path / n) for n in ("in", "log", "progress"))
    df = spark.createDataFrame([(1, "x")], "i int, d string")
    for expected in (1, 2):
        df.write.mode("append").parquet(source)
        append_log(read_stream(spark, source, df.schema), log, progress, ["d"]).awaitTermination()
        assert spark.read.parquet(log).count() == expected


def test_fold_is_partial(spark):
    """One key in every row still needs no more than a partial aggregate."""
    plan = fold(rows_of(spark, arrival("u", 1, "a")))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_shared_folder_follows_the_session(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(base)


def test_a_cluster_needs_a_shared_folder():
    """Without the setting only a local session may use a folder of its own."""

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            getConf = staticmethod(Conf)
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(), "x")
    Session.sparkContext.master = "local[4]"
    assert "shelfmark-" in shared_folder(Session(), "x")


def test_half_a_snapshot_is_refused(spark, tmp_path):
    folder = str(tmp_path / "half")
    for name, df in empty_tables(spark)._asdict().items():
        df.write.parquet(f"{folder}/{name}")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_tables(spark, folder)


def test_arrivals_of_one_project_in_one_log(spark):
    """The later arrival wins, whatever the order of the rows; its children replace."""
    files = "array<struct<file_key string, file_url string, tier int, is_qda boolean, " \
            "is_required_qda boolean, restricted boolean, failure_reason string>>"
    rows = [
        (when, f"t-{when}", [(f"f-{when}", "", None, None, None, True, None), (None, "", None, None, None, True, None)])
        for when in ("2024-02-01", "2024-01-01")
    ]
    log = spark.createDataFrame(rows, f"at string, title string, files {files}")
    log = log.withColumns({"context_repository": F.lit("zenodo"), "project_identifier": F.lit("p")})
    records = conform(log.withColumn("description", F.col("at")), RECORD).withColumn("query_string", F.lit(""))
    none = spark.createDataFrame(
        [], "context_repository string, project_identifier string, version string, file_name string, bytes bigint"
    )
    batch = arrivals(records, none, F.col("description"))
    once = merge(empty_tables(spark), batch)
    twice = merge(once, batch)
    for done in (once, twice):
        assert [r.title for r in done.projects.collect()] == ["t-2024-02-01"]
        assert sorted(r.file_name for r in done.files.collect()) == ["f-2024-02-01", "unknown"]
    assert {r.ingest_date for r in batch.projects.collect()} == {"2024-01-01", "2024-02-01"}
