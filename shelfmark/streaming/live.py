"""Telemetry that keeps itself up to date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

REFRESH = "30 seconds"


def live_counts(stream: DataFrame, by: Sequence[str], total: str | None = None) -> DataFrame:
    """Running counts (and the sum of ``total``) per group."""
    sums = [F.count(F.lit(1)).alias("n")]
    if total:
        sums.append(F.sum(total).alias("total"))
    return stream.groupBy(*by).agg(*sums)


def telemetry_query(
    counts: DataFrame, folder: str, checkpoint: str, once: bool = False, refresh: str = REFRESH
) -> StreamingQuery:
    """Publish the whole result below ``folder``, every ``refresh`` or once.

    Each result is a snapshot of its own, written by the executors; the driver holds
    none of it. A batch that runs again after a failure writes the same snapshot.
    """

    def publish(result: DataFrame, batch: int) -> None:
        result.write.mode("overwrite").parquet(f"{folder}/batch={batch:09d}")

    writer = (
        counts.writeStream.foreachBatch(publish)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if once else {"processingTime": refresh}
    return writer.trigger(**trigger).start()


def latest_telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """The newest complete snapshot below ``folder``."""
    every = spark.read.parquet(folder)
    newest = every.select(F.max("batch")).first()[0]
    return every.filter(F.col("batch") == newest).drop("batch")
