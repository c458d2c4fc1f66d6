"""The cleaning run, and what a source is searched for."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.plans.acquire import Search, searched, terms_for
from shelfmark.plans.clean import best_copies, clean, project_copies
from shelfmark.plans.tables import Tables, empty_tables
from shelfmark.schemas import conform
from shelfmark.sources.landing import Harvest


def projects(spark, *rows):
    df = spark.createDataFrame(
        list(rows), "id bigint, title string, doi string, download_repository_folder string, description string, language string"
    )
    return conform(df, schemas.PROJECTS)


ROWS = [
    (1, "A Study: of things", "", "zenodo", "d", "en"),
    (2, "a study  of THINGS", "10.1/X", "cessda", None, None),
    (3, "A study of things!", "https://doi.org/10.1/x", "qdr", " ", ""),
    (4, "Untitled", "10.1/y", "cessda", "die der und", None),
    (5, None, "doi:10.1/Y", "zenodo", "x", "fr"),
    (6, "Unknown Title", None, "zenodo", None, None),
    (7, "Unknown Title", " ", "zenodo", None, None),
]


def test_best_copies(spark):
    got = {r.id: r.n_versions for r in best_copies(projects(spark, *ROWS)).collect()}
    # with a DOI before without, a host before an aggregator; missing titles are no title
    assert got == {3: 3, 5: 2, 6: 1, 7: 1}


def test_two_dois_are_two_projects(spark):
    rows = [
        (1, "Interview transcripts", "10.1/a", "zenodo", "d", None), (2, "Interview transcripts", "10.1/b", "zenodo", "d", None),
        (3, "One title", "10.1/c", "cessda", "d", None), (4, "One tittle", "doi:10.1/C", "zenodo", "d", None),
        (5, "interview transcripts!", None, "qdr", "d", None), (6, "one title", None, "qdr", "d", None),
    ]
    # 5 might be a copy of 1 or of 2 and stays; 6 can be a copy of one project only
    got = {(r.id, r.n_versions) for r in best_copies(projects(spark, *rows)).collect()}
    assert got == {(1, 1), (2, 1), (4, 3), (5, 1)}


def test_chains_without_a_doi(spark):
    """Links over titles and addresses join what shares neither directly, at any length;
    a chain between two DOIs belongs to none of them."""
    n = 40
    rows = [(i, f"title {i // 2}", None, f"u{(i + 1) // 2}") for i in range(n)]
    rows += [(100, "title 0", "10.1/a", "x"), (200, "other", "10.1/b", f"u{n // 2}"), (300, "title 0", "10.1/a", "y")]
    for claimed, want in ((rows, {"i:0"}), ([r for r in rows if r[0] != 200], {"d:10.1/a"})):
        df = spark.createDataFrame(claimed, "id bigint, title string, doi string, project_url string")
        got = {r.id: r.copy_of for r in project_copies(conform(df, schemas.PROJECTS)).collect()}
        assert {got[i] for i in range(n)} == want and got[100] == got[300] == "d:10.1/a"


def test_clean(spark):
    empty = empty_tables(spark)
    files = conform(
        spark.createDataFrame(
            [(1, 3, "v1.2/README", "2/readme", "SUCCEEDED", ""), (2, 1, "a.csv", "csv", "SUCCEEDED", ""),
             (3, 5, "N.txt", "txt", "FAILED", "Study hosted externally. Resource access: u"), (4, 99, "b", "", "FAILED", None)],
            "id bigint, project_id bigint, file_name string, file_type string, status string, failure_reason string",
        ),
        schemas.FILES,
    )
    words = conform(
        spark.createDataFrame([(1, 3, "k"), (2, 98, "k")], "id bigint, project_id bigint, keyword string"), schemas.KEYWORDS
    )
    done = clean(Tables(projects(spark, *ROWS), files, words, empty.person_role))
    kept = {r.id: (r.description, r.language) for r in done.tables.projects.collect()}
    assert kept[3][0] == "A study of things!" and kept[5] == ("x", "fr") and set(kept) == {3, 5, 6, 7}
    assert {(r.project_id, r.file_name, r.file_type, r.status) for r in done.tables.files.collect()} == {
        (3, "v1.2/README", "", "SUCCEEDED"), (5, "external_study.url", "url", "SUCCEEDED")
    }
    assert {tuple(r) for r in done.orphans.collect()} == {("files", 99, 1), ("keywords", 98, 1)}
    assert done.ghosts is None and done.duplicates.agg(F.sum("n_versions")).first()[0] == 7
    again = clean(done.tables)
    assert again.tables.projects.count() == 4 and again.orphans.count() == 0


@pytest.mark.parametrize(
    ("source", "query", "want"),
    [
        ("zenodo", None, ["one two three"]),
        ("dryad", None, ["one two three", "NVivo", "x"]),
        ("cessda", None, None),
        ("cessda", "a b OR c", ["a b", "c"]),
    ],
)
def test_terms_for_a_source(source, query, want):
    assert terms_for(source, ['"one two three"', "NVivo"], ["x", "NVivo"], query) == want


def test_a_search_leaves_what_it_did_not_ask_for(spark):
    hits = spark.createDataFrame(
        [("1", '"one two three"'), ("2", "NVivo"), ("3", "x"), ("4", None)], "recid string, term string"
    )
    day = '{"created": "2024-05-%s", "metadata": {"access_right": "%s"}}'
    records = spark.createDataFrame(
        [("1", day % ("20", "open")), ("2", day % ("01", "open")), ("3", day % ("20", "closed")), ("4", None)],
        "recid string, record_raw string",
    )
    whole = Harvest(hits, records)

    def left(source, **options):
        kept = searched(whole, source, Search(['"one two three"'], ["NVivo"], **options))
        return [sorted(r.recid for r in df.collect()) for df in kept]

    every = ["1", "2", "3", "4"]
    assert left("zenodo") == [["1"], every]
    assert left("zenodo", run_date="2024-06-01") == [["1"], ["1"]]
    assert left("dryad", run_date="2024-06-01") == [["1", "2"], every]
    assert left("cessda") == [every, every]
    assert left("cessda", query="x OR NVivo") == [["2", "3"], every]
