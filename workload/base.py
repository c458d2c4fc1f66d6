"""Registry, table access and the vocabularies the queries use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where plain SQL can say the same, that SQL."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# The default taxonomy matches nothing in the driver's invented prose.
WEIGHTS = {
    "license": 10,
    "mit license": 10,
    "apache": 5,
    "tion": 5,
    "the ": 3,
    "for ": 3,
}
STRICT = ["MIT License", "Apache"]
BROAD = ["License", "tion", "Version 2.0"]
TERMS = STRICT + BROAD


def sql_score(text: str) -> str:
    """The score of a lower-cased text as SQL."""
    return "(" + " + ".join(
        f"CASE WHEN contains({text}, '{p}') THEN {w} ELSE 0 END" for p, w in WEIGHTS.items()
    ) + ")"


def sql_terms() -> str:
    """The search terms as an inline table (term_rank, term, is_strict)."""
    rows = ", ".join(
        f"({i}, '{t}', {'true' if t in STRICT else 'false'})" for i, t in enumerate(TERMS)
    )
    return f"(VALUES {rows}) AS t(term_rank, term, is_strict)"


def sql_walk(hits: str, n: int) -> str:
    """The walk over the terms, written out: each takes up to ``n`` records that no
    earlier one took. ``hits``: context_repository, recid, term_rank, place. The
    result is the table ``taken``."""
    steps = [f"hits AS ({hits})"]
    for i in range(len(TERMS)):
        gone = "".join(
            f" AND NOT EXISTS (SELECT 1 FROM t{j} g WHERE"
            f" g.context_repository = h.context_repository AND g.recid = h.recid)"
            for j in range(i)
        )
        steps.append(
            f"""t{i} AS (SELECT context_repository, recid, term_rank, place FROM (
                SELECT h.*, row_number() OVER (PARTITION BY context_repository ORDER BY place) AS rn
                FROM hits h WHERE term_rank = {i}{gone}) WHERE rn <= {n})"""
        )
    union = " UNION ALL ".join(f"SELECT * FROM t{i}" for i in range(len(TERMS)))
    return "WITH " + ", ".join([*steps, f"taken AS ({union})"])


# File names of the FILES stand-in: the part number picks the extension.
EXTENSIONS = [
    ".qdpx", ".nvpx", ".mx24", ".qpd", ".hpr7", ".loa", ".zip", ".tar.gz",
    ".PDF", ".txt", ".mp3", ".csv", "",
]


def files_table(spark: SparkSession, folder: str) -> DataFrame:
    """Line items seen as FILES rows (project, name, type, status, size)."""
    from shelfmark.functions import file_ext

    items = table(spark, folder, "lineitem")
    picked = F.element_at(
        F.array(*[F.lit(e) for e in EXTENSIONS]),
        (F.col("l_partkey") % len(EXTENSIONS) + 1).cast("int"),
    )
    return items.select(
        F.col("l_orderkey").alias("project_id"),
        F.concat(F.lit("f"), F.col("l_partkey").cast("string"), picked).alias("file_name"),
        F.when(F.col("l_returnflag") == "R", "FAILED").otherwise("SUCCEEDED").alias("status"),
        (F.col("l_linestatus") == "F").alias("restricted"),
        (F.col("l_quantity") * 1000).cast("bigint").alias("bytes"),
        F.col("l_shipdate").alias("finished"),
    ).withColumn("file_type", F.ltrim(file_ext(F.col("file_name")), F.lit(".")))


_PICKED = "['" + "', '".join(EXTENSIONS) + "']"

SQL_FILES = f"""(
    SELECT project_id, file_name, status, restricted, bytes, finished,
           CASE WHEN contains(file_name, '.')
                THEN '.' || lower(split_part(file_name, '.', -1)) ELSE '' END AS ext,
           CASE WHEN contains(file_name, '.')
                THEN lower(split_part(file_name, '.', -1)) ELSE '' END AS file_type
    FROM (SELECT l_orderkey AS project_id,
                 'f' || l_partkey::VARCHAR || ({_PICKED})[(l_partkey % {len(EXTENSIONS)} + 1)::INT] AS file_name,
                 CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
                 l_linestatus = 'F' AS restricted,
                 (l_quantity * 1000)::BIGINT AS bytes,
                 l_shipdate AS finished
          FROM lineitem))"""


def projects_table(spark: SparkSession, folder: str) -> DataFrame:
    """Orders seen as PROJECTS rows."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("repository_url"),
        F.when(F.col("o_orderstatus") == "P", "")
        .otherwise(F.concat(F.lit("p-"), F.col("o_orderkey").cast("string")))
        .alias("download_project_folder"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("download_date"),
        F.col("o_orderstatus").alias("status"),
    )


SQL_PROJECTS = """(
    SELECT o_orderkey AS id, o_orderpriority AS repository_url,
           CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'p-' || o_orderkey::VARCHAR END AS download_project_folder,
           strftime(o_orderdate, '%Y-%m-%d') AS download_date, o_orderstatus AS status
    FROM orders)"""
