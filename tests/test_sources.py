"""Readers on hand-written responses with every shape their fields take."""

from __future__ import annotations

import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from shelfmark.plans.acquire import Policy, accept, mark_strict, policy_for, search_terms
from shelfmark.schemas import HITS, LANDING, RECORD
from shelfmark.sources import READERS, archive_members, known_sources, read_source
from shelfmark.sources.archives import read_blobs
from shelfmark.sources.oai import read_oai
from shelfmark.taxonomy import BROAD_TERMS, STRICT_TERMS


def landing(spark, *responses):
    rows = []
    for seq, r in enumerate(responses):
        body = r["body"] if isinstance(r["body"], str) else json.dumps(r["body"])
        rows.append(
            (r.get("kind", "search"), r.get("term"), r.get("rank", 0), r.get("page", 0), r.get("key"), seq, body)
        )
    return spark.createDataFrame(rows, LANDING)


def by_id(df):
    return {r.recid: r for r in df.collect()}


TEXT = "A study with NVivo and grounded theory"


def zenodo_hits(*ids, **more):
    return {"body": {"hits": {"hits": [{"id": i} for i in ids]}}, **more}


def zenodo_record(rid, files, **meta):
    meta = {"title": "Grounded Theory", "description": TEXT, **meta}
    return {"kind": "detail", "key": str(rid), "body": {"id": rid, "metadata": meta, "files": files}}


FILE = {"key": "a.qdpx", "links": {"self": "https://z/a"}}


def test_zenodo_shapes(spark):
    harvest = READERS["zenodo"](
        landing(
            spark,
            zenodo_hits(1, 2, 3, 4, 5, term="NVivo"),
            zenodo_hits(1, 6, term="MAXQDA", rank=1),
            zenodo_record(1, [FILE, {"filename": "n.txt", "href": "h"}, {"key": "abstract", "href": "h"}], license={"id": "cc-by"},
                          creators=[{"name": "A"}, {"person_or_org": {"name": "B"}}, {}], version="v3", keywords=["k"]),
            zenodo_record(2, {"entries": [FILE]}, license="cc0"),
            zenodo_record(3, {"one": FILE, "two": {"key": "x"}, "count": 2}, license=None),
            zenodo_record(4, {"entries": []}),
            zenodo_record(6, [FILE], title="plain", description="nothing of note"),
        ),
        "zenodo",
    )
    assert harvest.hits.columns == HITS.names and harvest.records.columns == RECORD.names
    records = by_id(harvest.records)
    assert set(records) == {"1", "2", "3", "4", "6"}
    one = records["1"]
    assert [(f.file_key, f.file_url, f.tier) for f in one.files] == [("a.qdpx", "https://z/a", 1), ("n.txt", "h", 2)]
    assert (one.license, one.version, one.project_url) == ("cc-by", "v3", "https://zenodo.org/records/1")
    assert [c.name for c in one.creators] == ["A", "B"] and one.keywords == ["k"]
    assert one.project_identifier == "grounded-theory-1"
    assert (records["2"].license, records["3"].license, records["2"].version) == ("cc0", None, "v1")
    assert [f.file_key for f in records["3"].files] == ["a.qdpx"]
    kept = by_id(accept(harvest, policy_for("zenodo")))
    assert {k: r.query_string for k, r in kept.items()} == {"1": "NVivo", "2": "NVivo", "3": "NVivo"}
    assert accept(harvest, policy_for("zenodo"), 1).count() == 1


def test_latest_response_wins(spark):
    harvest = READERS["zenodo"](
        landing(spark, zenodo_hits(1), zenodo_record(1, [FILE], title="old"), zenodo_record(1, [FILE], title="new")),
        "zenodo",
    )
    assert [r.title for r in harvest.records.collect()] == ["new"]


def test_dryad_chain(spark):
    def dataset(did, href):
        links = {"stash:version": {"href": href}} if href else {}
        return {"identifier": did, "title": "T", "abstract": TEXT, "license": None, "_links": links}

    version = {"title": "V/1", "license": "https://x/CC-BY", "authors": [{"firstName": "F", "lastName": "L"}],
               "_links": {"stash:files": {"href": "/f/1"}}}
    files = [
        {"path": "d/a.NVP", "_links": {"stash:download": {"href": "/dl/a"}}},
        {"name": "b.pdf", "links": {"download": "https://o/b"}},
        {"path": "c.csv", "_links": {"stash:download": {"href": "/dl/c"}}},
        {"path": "e.pdf"},
    ]
    harvest = READERS["dryad"](
        landing(
            spark,
            {"body": {"_embedded": {"stash:datasets": [dataset("doi:1/2", "/v/1"), dataset("doi:3", None), dataset("doi:4", "/v/9")]}}},
            {"kind": "version", "key": "https://datadryad.org/v/1", "body": version},
            {"kind": "files", "key": "https://datadryad.org/f/1", "body": {"_embedded": {"stash:files": files}}},
        ),
        "dryad",
    )
    rows = by_id(harvest.records)
    assert set(rows) == {"doi:1/2"}
    row = rows["doi:1/2"]
    assert [(f.file_key, f.file_url, f.tier, f.is_qda) for f in row.files] == [
        ("a.NVP", "https://datadryad.org/dl/a", 1, True), ("b.pdf", "https://o/b", 2, False),
    ]
    assert (row.license_id, row.creators_text, row.project_identifier) == ("cc-by", "L, F", "v1-1-2")


def test_dataverse_restrictions(spark):
    item = {"global_id": "doi:10/AB", "name": "Name", "description": ["x", "y"], "authors": [{"name": "A"}, "B"],
            "license_url": "lic", "published_at": "2024"}
    files = [
        {"restricted": True, "embargoDate": "2031-01-01", "dataFile": {"id": 1, "filename": "a.qdpx"}},
        {"restricted": True, "label": "b.csv", "dataFile": {}},
        {"dataFile": {"id": 3}},
        {"dataFile": {"filename": "noid.txt"}},
        {"dataFile": {"id": 4, "filename": "Easy-Migration.zip"}},
    ]
    harvest = READERS["qdr"](
        landing(
            spark,
            {"term": "grounded theory", "body": {"data": {"items": [item, {"global_id": "", "name": "n"}]}}},
            {"kind": "detail", "key": "doi:10/AB", "body": {"data": {"latestVersion": {"files": files}}}},
        ),
        "qdr",
    )
    row = by_id(accept(harvest, policy_for("qdr")))["doi:10/AB"]
    assert [(f.file_key, f.file_url, f.tier, f.failure_reason) for f in row.files] == [
        ("a.qdpx", "", 1, "Embargoed until 2031-01-01"),
        ("b.csv", "", 2, "Restricted access"),
        ("unknown_file", "https://data.qdr.syr.edu/api/access/datafile/3", 2, None),
    ]
    assert (row.description, row.project_identifier) == ("x y", "name-doi-10-AB")
    assert [c.name for c in row.creators] == ["A"] and row.score == 0


def test_icpsr_page(spark):
    docs = [
        {"ID": 5, "STUDYQ": 9, "TITLE": "T", "SUMMARY": [TEXT], "AUTHOR": ["A", "B"], "DATEUPDATED": "2024-01-02T03"},
        {"STUDYQ": 7, "TITLE": "U", "NOTES": [TEXT], "URL": "https://u"},
        {"TITLE": "no id"},
    ]
    html = "<html>\nsearchResults : " + json.dumps({"response": {"numFound": 3, "docs": docs}}) + " ,\n searchConfig: 1"
    harvest = READERS["icpsr"](landing(spark, {"body": html}, {"body": "<html></html>", "page": 1}), "icpsr")
    rows = by_id(accept(harvest, policy_for("icpsr")))
    assert set(rows) == {"5", "7"}
    assert rows["5"].files[0].file_key.endswith("/studies/5") and rows["7"].files[0].file_url == "https://u"
    assert (rows["5"].upload_date, rows["5"].creators_text, rows["7"].upload_date) == ("2024-01-02", "A, B", "")


def test_nada_optional_resources(spark):
    rows = [{"idno": "X/1", "title": "T", "subtitle": "S"}, {"idno": "X2", "title": "T2"}, {"idno": "X3"}]
    producers = {"metadata": {"doc_desc": {"producers": [{"name": "P"}, {"role": "R"}]}}}
    harvest = READERS["ihsn"](
        landing(
            spark,
            {"term": "Codebook", "body": {"result": {"rows": rows}}},
            {"kind": "detail", "key": "X/1", "body": {"dataset": {"abstract": TEXT, **producers}}},
            {"kind": "detail", "key": "X2", "body": {"dataset": {"abstract": TEXT}}},
            {"kind": "resources", "key": "X/1", "body": {"resources": [
                {"title": "t.pdf", "url": "u"}, {"filename": "f.qdpx", "title": "x", "url": "v"}, {"filename": "g.csv", "url": "w"}, {"title": "h.pdf"}]}},
        ),
        "ihsn",
    )
    records = by_id(harvest.records)
    assert set(records) == {"X/1", "X2"} and records["X2"].files == []
    row = by_id(accept(harvest, policy_for("ihsn")))["X/1"]
    assert [(f.file_key, f.is_qda) for f in row.files] == [("t.pdf", False), ("f.qdpx", True)]
    assert [tuple(p) for p in row.persons] == [("P", "PRODUCER"), ("", "R")]
    assert (row.creators_text, row.description, row.license_id) == ("P", "S", "IHSN-Standard-Terms")
    assert "t.pdf" in row.score_text and row.project_identifier == "t-X-1"


def test_cessda_placeholder(spark):
    items = [
        {"id": "doi:1", "titleStudy": "T", "abstract": TEXT, "creators": [{"name": "A"}, "B", {}], "studyUrl": "https://s"},
        {"id": "2", "titleStudy": "T", "abstract": "none", "keywords": [{"term": "MAXQDA"}, {}], "studyXmlSourceUrl": "https://x"},
        {"id": "3", "titleStudy": "T"},
    ]
    harvest = READERS["cessda"](landing(spark, {"term": "Codebook", "body": {"Results": items}}), "cessda")
    rows = by_id(accept(harvest, policy_for("cessda")))
    assert set(rows) == {"doi:1", "2"}
    assert (rows["doi:1"].doi, rows["doi:1"].creators_text, rows["2"].doi) == ("doi:1", "A | B", "")
    assert rows["2"].files[0].failure_reason.endswith("https://x") and rows["2"].files[0].restricted
    # a query typed by the user vouches for all its hits
    assert accept(harvest, policy_for("cessda", user_query=True)).count() == 3


OAI = '<?xml version="1.0"?><OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/">{}</OAI-PMH>'


def dc_record(oid, rights, *links):
    tags = "".join(f"<dc:identifier>{u}</dc:identifier>" for u in links)
    return (
        f"<record><header><identifier>{oid}</identifier></header><metadata>"
        f'<oai_dc:dc xmlns:oai_dc="o" xmlns:dc="d"><dc:title xml:lang="en"> T {oid}</dc:title>{tags}'
        f"<dc:rights>{rights}</dc:rights></oai_dc:dc></metadata></record>"
    )


def test_oai(spark):
    page = OAI.format(
        "<ListRecords>"
        + dc_record("o:1", "CC0", "https://o/a.qdpx", "https://o/a.qdpx", "ftp://o/b.zip", "https://o/page")
        + dc_record("o:2", "closed", "https://o/c.qdpx")
        + dc_record("o:3", "CC BY", "https://o/a.qdpx")
        + dc_record("o:4", "CC BY", "https://o/a.qdpx", "https://o/d.zip?x=1")
        + '<record><header status="deleted"><identifier>o:5</identifier></header></record>'
        + "</ListRecords>"
    )
    error = OAI.format('<error code="noRecordsMatch"/>')
    harvest = read_oai(
        landing(spark, {"body": page}, {"body": error, "page": 1}, {"body": "<broken", "page": 2}), "x", "oai_dc"
    )
    rows = by_id(accept(harvest, Policy(by_license=True)))
    assert {k: [f.file_url for f in r.files] for k, r in rows.items()} == {
        "o:1": ["https://o/a.qdpx", "https://o/a.qdpx"], "o:4": ["https://o/d.zip?x=1"],
    }
    assert rows["o:4"].title == "T o:4" and rows["o:4"].files[0].file_key == "d.zip"
    assert rows["o:1"].project_identifier == "t-o1-o1"
    assert accept(harvest, Policy(by_license=True), 1).count() == 1


def test_retry_and_seen(spark):
    """A weak record listed first under a broad, then under a strict term."""
    weak = {"idno": "w", "title": "weak"}
    common = [
        {"term": "Codebook", "rank": 0, "body": {"result": {"rows": [weak]}}},
        {"term": "NVivo", "rank": 1, "body": {"result": {"rows": [weak]}}},
        {"kind": "detail", "key": "w", "body": {"dataset": {}}},
        {"kind": "resources", "key": "w", "body": {"resources": [{"title": "a.pdf", "url": "u"}]}},
    ]
    harvest = READERS["ihsn"](landing(spark, *common), "ihsn")
    assert accept(harvest, policy_for("ihsn")).count() == 0
    retried = accept(harvest, Policy(strict_terms=True)).collect()
    assert [(r.recid, r.query_string) for r in retried] == [("w", "NVivo")]


def test_strict_marks(spark):
    hits = spark.createDataFrame([("nvp",), ("*",), ("Codebook",), ('"NVivo"',), (None,)], "term string")
    marked = lambda p: [r.is_strict for r in mark_strict(hits, p).collect()]
    assert marked(policy_for("ihsn")) == [True, False, False, True, False]
    assert marked(policy_for("sada")) == [True, True, False, True, False]
    assert marked(policy_for("zenodo")) == [False] * 5


def test_terms_and_registry(spark, tmp_path):
    assert len(search_terms(STRICT_TERMS, BROAD_TERMS)) == 145
    assert len(search_terms(STRICT_TERMS, BROAD_TERMS, 3)) == 44
    assert len(known_sources()) == 16
    with pytest.raises(ValueError, match="no reader"):
        read_source(spark, "ada", str(tmp_path))
    folder = str(tmp_path / "landing")
    landing(spark, zenodo_hits(1), zenodo_record(1, [FILE])).write.partitionBy("kind").parquet(folder)
    harvest = read_source(spark, " Zenodo ", folder)
    assert harvest.records.count() == 1 and harvest.hits.count() == 1
    landing(spark, zenodo_hits(1), zenodo_record(1, [FILE])).write.json(folder + "-json")
    assert read_source(spark, "zenodo", folder + "-json", "json").records.count() == 1


def test_archives(spark, tmp_path):
    def zipped(name, members):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for member, text in members.items():
                z.writestr(member, text)

    zipped("one.zip", {"root/a.qdpx": "xx", "root/sub/b.txt": "y"})
    zipped("two.zip", {"root/a.txt": "x", "c.txt": "zzz"})
    zipped("empty.zip", {})
    with tarfile.open(tmp_path / "three.tgz", "w:gz") as t:
        info = tarfile.TarInfo("d/e.txt")
        info.size = 4
        t.addfile(info, io.BytesIO(b"abcd"))
    (tmp_path / "junk.zip").write_bytes(b"not an archive")
    blobs = read_blobs(spark, str(tmp_path)).withColumn("path", F.substring_index("path", "/", -1))
    got = {tuple(r) for r in archive_members(blobs).collect()}
    assert got == {
        ("one.zip", "a.qdpx", 2, True), ("one.zip", "sub/b.txt", 1, True),
        ("two.zip", "root/a.txt", 1, True), ("two.zip", "c.txt", 3, True),
        ("empty.zip", None, None, True), ("three.tgz", "e.txt", 4, True), ("junk.zip", None, None, False),
    }
    plain = {r.member for r in archive_members(blobs, flatten=False).collect()}
    assert "root/a.qdpx" in plain and "d/e.txt" in plain


def test_bodies_are_parsed_once(spark):
    """No filter carries a parse or a score along."""
    harvest = READERS["zenodo"](landing(spark, zenodo_hits(1), zenodo_record(1, [FILE])), "zenodo")
    kept = accept(harvest, policy_for("zenodo")).filter("score > 20 AND title <> ''")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line.split("[")[0]]
    assert filters and not any("from_json" in line or "Contains(" in line for line in filters)


def test_only_the_needed_responses_are_opened(spark, tmp_path):
    folder = str(tmp_path / "landing")
    landing(spark, zenodo_hits(1), zenodo_record(1, [FILE])).write.partitionBy("kind").parquet(folder)
    plan = read_source(spark, "zenodo", folder).hits._jdf.queryExecution().executedPlan().toString()
    assert "(kind#" in plan.split("PartitionFilters")[1].split("]")[0] and "key" not in plan.split("ReadSchema")[1]
