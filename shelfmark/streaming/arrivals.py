"""From a landing folder to the tables, as a stream.

The stream itself only appends: it reads new files and adds their rows to a log with
exactly-once file commits. Repeated ids are dropped when the log is read, by an
aggregate, so a row counts however late it comes and no state grows with the ids. The
log is merged into the tables by a batch job, every so often. Merging once per
micro-batch would rewrite a table snapshot each time, and a merge that ran twice
changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.dedupe import first_rows
from shelfmark.plans.tables import Arrivals, Tables, merge
from shelfmark.session import shared_folder


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format: str = "parquet",
    glob: str | None = None,
    files_per_trigger: int = 100,
) -> DataFrame:
    """A folder as an unbounded table; the bound per trigger is the back-pressure."""
    reader = (
        spark.readStream.format(format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def first_in_log(log: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key, also where it arrived after later ones."""
    return first_rows(log, list(key), list(order))


def append_log(
    stream: DataFrame, folder: str, checkpoint: str, partition_by: list[str] | None = None
) -> StreamingQuery:
    """Write what is there and stop; call again to continue from the checkpoint."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(folder)


def drain(stream: DataFrame, purpose: str) -> DataFrame:
    """Run an append stream over all that has landed and read the result."""
    spark = stream.sparkSession
    base = shared_folder(spark, purpose)
    append_log(stream, f"{base}/rows", f"{base}/progress").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def merge_log(
    current: Tables, log: Arrivals, since: str | None = None, date: str = "ingest_date"
) -> Tables:
    """The tables after the arrivals in the logs. With ``since`` only the log
    partitions from that date on are opened; going back too far does no harm."""
    if since is not None:
        log = Arrivals(*[df.filter(F.col(date) >= since) for df in log])
    return merge(current, log)
