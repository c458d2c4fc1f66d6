"""Schemas of landed responses, conformed records and the four tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
}


def _struct(columns: str) -> T.StructType:
    """``name type, ...`` of primitive types; unlike a DDL string it needs no session."""
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# One landed response per row. ``kind`` says which call it answers (search,
# detail, files, ...), ``key`` what was asked for (record id or href), ``seq``
# the landing order; a later response for the same key replaces an earlier one.
LANDING = _struct(
    "kind string, term string, term_rank int, page int, key string, seq bigint, body string"
)

FILE_ENTRY = _struct(
    "file_key string, file_url string, tier int, is_qda boolean, "
    "is_required_qda boolean, restricted boolean, failure_reason string"
)

PERSON = _struct("name string, role string")

HITS = _struct(
    "context_repository string, recid string, term string, term_rank int, page int, pos int"
)

RECORD = T.StructType(
    [
        T.StructField("context_repository", T.StringType(), False),
        T.StructField("recid", T.StringType(), False),
        T.StructField("project_identifier", T.StringType(), False),
        *[
            T.StructField(name, T.StringType())
            for name in (
                "title", "description", "doi", "language", "version", "license",
                "license_id", "upload_date", "project_url", "repository_url",
                "creators_text",
            )
        ],
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("creators", T.ArrayType(PERSON)),
        T.StructField("persons", T.ArrayType(PERSON)),
        T.StructField("files", T.ArrayType(FILE_ENTRY)),
        T.StructField("record_raw", T.StringType()),
        T.StructField("score_text", T.StringType()),
    ]
)

PROJECT_KEY = ["project_url", "version"]
# columns an upsert refreshes; the others keep the value of the first arrival
PROJECT_UPDATED = [
    "title", "description", "license", "upload_date", "download_date",
    "download_repository_folder", "download_project_folder", "download_version_folder",
]
PROJECT_KEPT = [
    "query_string", "repository_id", "repository_url", "language", "doi", "download_method",
]

PROJECT_ORDER = ["first_seq", "last_seq"]

PROJECTS = _struct(
    "id bigint, query_string string, repository_id int, repository_url string, "
    "project_url string, version string, title string, description string, "
    "language string, doi string, license string, upload_date string, "
    "download_date string, download_repository_folder string, "
    "download_project_folder string, download_version_folder string, "
    # the places of the first and the last arrival in the order of all arrivals
    "download_method string, first_seq string, last_seq string"
)
FILES = _struct(
    "id bigint, project_id bigint, file_name string, file_type string, "
    "status string, failure_reason string"
)
KEYWORDS = _struct("id bigint, project_id bigint, keyword string")
PERSON_ROLE = _struct("id bigint, project_id bigint, name string, role string")

REQUIRED_COLUMNS = {
    "projects": [
        "repository_id", "repository_url", "project_url", "title", "download_date",
        "download_repository_folder", "download_project_folder", "download_method",
    ],
    "files": ["project_id", "file_name", "file_type", "status"],
    "keywords": ["project_id", "keyword"],
    "person_role": ["project_id", "name", "role"],
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types, missing ones as nulls."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
