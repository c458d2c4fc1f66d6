"""First rows as the state of a stream."""

from __future__ import annotations

from shelfmark.session import shared_folder
from shelfmark.streaming import first_in_log, read_stream, seen_rows, update_seen

SCHEMA = "key string, at int, body string"


def test_a_later_run_reads_the_delta(spark):
    landing, state = shared_folder(spark, "landing"), shared_folder(spark, "state")
    runs = [
        [("a", 5, "x"), ("b", 1, "y"), (None, 2, "n"), ("a", 5, "w")],
        [("a", 1, "early"), ("c", 9, None), ("b", 3, "late")],
        [("c", 9, "tie"), (None, 2, "n")],
    ]
    for n, rows in enumerate(runs):
        df = spark.createDataFrame(rows, SCHEMA)
        df.coalesce(1).write.mode("append").parquet(landing)
        query = update_seen(read_stream(spark, landing, df.schema), ["key"], ["at"], state)
        query.awaitTermination()
        assert sum(p["numInputRows"] for p in query.recentProgress) == len(rows)
        whole = spark.createDataFrame([r for run in runs[: n + 1] for r in run], SCHEMA)
        got = {tuple(r) for r in seen_rows(spark, df.schema, ["key"], state).collect()}
        assert got == {tuple(r) for r in first_in_log(whole, ["key"], ["at", "body"]).collect()}
    assert ("a", 1, "early") in got and (None, 2, "n") in got and len(got) == 4
