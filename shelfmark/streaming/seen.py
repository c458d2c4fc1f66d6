"""The first row of every id, kept up to date by a stream.

``first_in_log`` regroups a whole log at every read. Here the first rows are the state of
a stream: each run reads what has landed since the last one, compares it with the state
of the ids it holds, and stops. The state has one row per id, lies on disk (RocksDB) with
its checkpoints in the shared folder, and has no watermark: an id counts however late it
comes, and an earlier row that lands later takes the place of the one before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A stream started in here keeps its state on disk; the session is left as it was."""
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    try:
        for k, v in STATE_SETTINGS.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _columns(schema: T.StructType, key: Sequence[str], order: Sequence[str]) -> list[str]:
    """The columns besides the key, those of the order first: so they compare."""
    return [*order, *(c for c in schema.names if c not in key and c not in order)]


def update_seen(
    stream: DataFrame, key: Sequence[str], order: Sequence[str], folder: str
) -> StreamingQuery:
    """Take in what has landed since the last call for ``folder`` and stop. ``order`` has
    no column of the key; rows of one place are told apart by their other columns. An id
    that fills a third of the rows is one row per task before the shuffle."""
    rest = _columns(stream.schema, key, order)
    first = stream.groupBy(*key).agg(F.min(F.struct(*rest)).alias("first"))
    with state_on_disk(stream.sparkSession):
        return (
            first.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", folder).trigger(availableNow=True).start()
        )


def seen_rows(
    spark: SparkSession, schema: T.StructType, key: Sequence[str], folder: str
) -> DataFrame:
    """The first row of every id so far, with the columns of ``schema``."""
    state = spark.read.format("statestore").load(folder)
    held = state.select("key.*", "value.min.*")
    return held.select(*schema.names)
