"""Run queries on Spark and their SQL on DuckDB and compare the rows.

    python tests/oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: [str(v) for v in r]
    )


def compare(spark, con, name: str, folder: str) -> tuple[bool, str]:
    import workload

    start = time.time()
    df = workload.QUERIES[name](spark, folder)
    mine = _sorted(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if name not in workload.ORACLE:
        return False, f"{len(mine[1])} rows, no SQL to compare with, {took:.1f}s"
    rel = con.execute(workload.ORACLE[name])
    columns = [d[0] for d in rel.description]
    theirs = _sorted(columns, rel.fetchall())
    if mine[0] != theirs[0]:
        return False, f"columns {mine[0]} / {theirs[0]}"
    if mine[1] != theirs[1]:
        odd = [p for p in zip(mine[1], theirs[1]) if p[0] != p[1]][:2]
        return False, f"{len(mine[1])} / {len(theirs[1])} rows, e.g. {str(odd)[:700]}"
    kinds = {tuple(type(v).__name__ for v in r) for r in mine[1][:50]} ^ {
        tuple(type(v).__name__ for v in r) for r in theirs[1][:50]
    }
    if kinds:
        return False, f"types differ: {kinds}"
    return True, f"{len(mine[1])} rows, {took:.1f}s"


def main(argv: list[str]) -> int:
    from shelfmark.session import get_session

    import workload

    folder = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        folder, argv = argv[1], argv[2:]
    spark = get_session(
        "oracle", "local[8]", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="16g", spark__checkpoint__dir=tempfile.mkdtemp(prefix="shelfmark-oracle-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in argv or list(workload.QUERIES):
        try:
            ok, note = compare(spark, con, name, folder)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:900]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
