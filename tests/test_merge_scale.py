"""What a merge moves: texts once, and only where a record needs it."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.plans import pipeline
from shelfmark.plans.tables import arrivals, create_tables, empty_tables, no_rows, read_tables
from shelfmark.schemas import RECORD
from shelfmark.session import stored

OUTCOMES = "context_repository string, project_identifier string, version string, file_name string, bytes bigint"
MEMBERS = "context_repository string, project_identifier string, version string, archive string, member string, size bigint"


def file(name, url="u", restricted=False):
    return (name, url, 1, True, True, restricted, None)


def batch(spark, store):
    """A restricted file, a transferred one and a closed archive, an opened archive, a lost
    file; no files; a record that lands twice, once without its restricted file."""
    listed = {
        "a": [file("r.pdf", "", True), file("lost.csv")],
        "b": [file("x.csv"), file("x.csv"), file("closed.zip")],
        "c": [file("open.zip"), file("open.tar")],
        "d": [file("lost.csv")],
        "e": None,
        "f": [file("r.pdf", "", True)],
    }
    rows = []
    for ident, files in [*listed.items(), ("f", [])]:
        values = dict.fromkeys(RECORD.names) | {
            "context_repository": "zenodo", "recid": ident, "project_identifier": ident, "title": ident,
            "description": "text", "keywords": [ident, "k"], "persons": [("P", "PRODUCER")], "files": files,
        }
        rows.append(tuple(values[n] for n in RECORD.names))
    found = spark.createDataFrame(rows, RECORD).withColumn("query_string", F.lit("q"))
    done = [("zenodo", "b", "v1", "x.csv", 3), ("zenodo", "b", "v1", "closed.zip", 3)]
    done += [("zenodo", "c", "v1", f"open.{e}", 3) for e in ("zip", "tar")]
    inner = [("zenodo", "c", "v1", f"open.{e}", m, 1) for e in ("zip", "tar") for m in ("y.csv", "both.csv")]
    return arrivals(
        found, spark.createDataFrame(done, OUTCOMES), "2024", spark.createDataFrame(inner, MEMBERS), store=store
    )


def content(rows):
    return {name: sorted(map(str, df.collect())) for name, df in rows._asdict().items()}


def test_arrivals_of_stored_files_are_the_same(spark):
    got, lazy = content(batch(spark, stored)), content(batch(spark, None))
    assert got == lazy
    files = [(r.seq[-1], r.file_name, r.status) for r in batch(spark, stored).files.collect()]
    assert sorted(files) == [
        ("a", "r.pdf", "FAILED"), ("b", "closed.zip", "SUCCEEDED"), ("b", "x.csv", "SUCCEEDED"),
        ("c", "both.csv", "SUCCEEDED"), ("c", "y.csv", "SUCCEEDED"), ("f", "r.pdf", "FAILED"),
    ]
    assert [len(got[k]) for k in ("projects", "keywords")] == [5, 10]


def test_a_merge_stores_keys_and_no_texts(spark, tmp_path, monkeypatch):
    kept = []
    monkeypatch.setattr(pipeline, "stored", lambda df: kept.append(df.columns) or stored(df))
    old, new = str(tmp_path / "t0"), str(tmp_path / "t1")
    create_tables(spark, old)
    pipeline.merge_into(read_tables(spark, old), batch(spark, stored), new)
    assert kept and not any("description" in columns for columns in kept)
    after = read_tables(spark, new)
    assert sorted(r.title for r in after.projects.collect()) == ["a", "b", "c", "f"]
    assert {r.description for r in after.projects.collect()} == {"text"}
    assert (after.files.count(), after.person_role.count()) == (6, 5)


def test_no_rows_cost_no_job(spark):
    rows = spark.range(5).withColumnRenamed("id", "project_id")
    met = rows.join(empty_tables(spark).files, "project_id", "left_anti")
    assert "Join" not in met._jdf.queryExecution().optimizedPlan().toString()
    assert no_rows(spark, OUTCOMES).count() == 0


def test_the_log_is_read_and_kept_once(spark, monkeypatch):
    from workload import stream_queries

    kept = []
    monkeypatch.setattr(
        stream_queries, "stored", lambda df, purpose="stored": kept.append(purpose) or stored(df, purpose)
    )
    rows = stream_queries.stream_upsert_late(spark, "/root/testdata/sf0.001")
    assert kept.count("log") == 1
    users = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id").distinct()
    assert rows.count() == users.count()
