"""Exact copies by a stream with keyed state.

Texts are copies when they are equal after all blanks are deleted. Two streams run over
what has landed and stop; called again, they go on from their checkpoints:

1. landed files to a log of slim rows: the digest of the text without blanks, its length,
   the row's id and its locator, which is the file and the row in it;
2. the log to keyed state. The state of a digest is the number of its rows and the best
   of them: the longest original text, then the smallest id, with its locator. It never
   expires and lies on disk (RocksDB); partial aggregation comes before the shuffle, so a
   text that fills a third of the rows is one row per task.

A digest that was met again is a hit. The rows of hits fetch their texts by locator, and
all their bytes are compared with those of the row that stays. Which rows of the scan are
wanted says a bitmap of their locators of bounded size, so texts without a copy are not
moved; past some 10^8 hits it lets more rows through to the exact join. Should two texts
share a digest, the rows of that digest are grouped by their whole text instead.

Everything is DataFrame expressions. A join that meets a text with very many copies is
between stored tables, so adaptive execution may split it.

Defined cases: a null text is empty, and empty texts are copies of each other. A row
without an id comes after those with one. Rows that repeat an id are rows of their own;
of rows that are equal in everything the first one in its file stays. Other columns,
whatever their names, are not looked at. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.llm.common import stored

DIGEST_BYTES = 32
#: Bits of the bitmap that names wanted rows, as a power of two: 16 MB.
FILTER_BITS = 27
#: Few large batches: each opens the whole state again.
BATCH_BYTES = 1 << 43
_PAGE = 15  # bits of a row of the bitmap, as a power of two (fixed by the aggregate)

_STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # a database costs some MB of disk as soon as it is open, so only those of running
    # tasks are; what they hold is in the shared folder, where the next batch finds it
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def plain(text: Column) -> Column:
    """The text without blanks, null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t-\\r]+", "")


def landed(
    spark: SparkSession, path: str, schema: T.StructType, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """The files below ``path`` (a folder, a file or a pattern) as a stream, some
    ``batch_bytes`` at a time."""
    # a pattern, as Spark takes a plain path to a stream for a folder
    folder, _, name = path.rstrip("/").rpartition("/")
    pattern = f"{folder}/[{name[0]}]{name[1:]}" if name[0] not in "[{*?\\" else path
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(pattern)


def _located(documents: DataFrame) -> tuple[Column, Column]:
    meta = documents.metadataColumn("_metadata")
    return meta["file_path"].alias("file"), meta["row_index"].alias("row")


def digests(documents: DataFrame) -> DataFrame:
    """``sha, n_chars, doc_id, file, row`` of every row of files, batch or stream."""
    return documents.select(
        F.unhex(F.sha2(plain(F.col("text")), 256)).alias("sha"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        "doc_id",
        *_located(documents),
    )


_LOG = "sha binary, n_chars long, doc_id long, file string, row long"


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A stream that starts in here keeps its state in RocksDB; the session is left as
    it was."""
    before = {k: spark.conf.get(k, None) for k in _STATE_SETTINGS}
    try:
        for k, v in _STATE_SETTINGS.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _best() -> Column:
    return F.min(
        F.struct(
            (-F.col("n_chars")).alias("shortness"), F.col("doc_id").isNull().alias("no_id"),
            "doc_id", "file", "row",
        )
    )


def append_digests(documents: DataFrame, store: str) -> StreamingQuery:
    """The first stream, over all that has landed."""
    return (
        digests(documents).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{store}/log-progress")
        .trigger(availableNow=True).start(f"{store}/log")
    )


def remember(spark: SparkSession, store: str, digest_bytes: int = DIGEST_BYTES) -> StreamingQuery:
    """The second stream: the log since the last call into the state."""
    log = spark.readStream.schema(_LOG).option("maxBytesPerTrigger", BATCH_BYTES).parquet(f"{store}/log")
    log = log.withColumn("digest", F.substring("sha", 1, digest_bytes))
    state = log.groupBy("digest").agg(
        F.count(F.lit(1)).alias("met"), _best().alias("best")
    )
    with _state_on_disk(spark):
        return (
            state.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", f"{store}/state")
            .trigger(availableNow=True).start()
        )


def ingest(documents: DataFrame, store: str, digest_bytes: int = DIGEST_BYTES) -> None:
    """Both streams over what has landed since the last call. ``store`` is a folder that
    all executors share; the number of shuffle partitions of the first call is that of
    the state for good."""
    append_digests(documents, store).awaitTermination()
    remember(documents.sparkSession, store, digest_bytes).awaitTermination()


def keyed_state(spark: SparkSession, store: str) -> DataFrame:
    """``digest, group_size, keeper``: what the state holds after the last batch."""
    if spark.read.schema(_LOG).parquet(f"{store}/log").isEmpty():  # no batch, no state
        best = "struct<shortness bigint, no_id boolean, doc_id bigint, file string, row bigint>"
        return spark.createDataFrame([], f"digest binary, group_size bigint, keeper {best}")
    state = spark.read.format("statestore").load(f"{store}/state")
    return state.select(
        F.col("key.digest").alias("digest"),
        F.col("value.count").alias("group_size"),
        F.col("value.min").alias("keeper"),
    )


def _probe(bits: int) -> Column:
    return F.xxhash64("file", "row").bitwiseAND(F.lit((1 << bits) - 1))


def _wanted(rows: DataFrame, locators: DataFrame, bits: int) -> DataFrame:
    """The rows whose locator is in ``locators``, and a few others: a bitmap of
    ``2 ** bits`` bits, in pages of which each row needs one."""
    page, bit = F.shiftright("_probe", _PAGE), F.col("_probe").bitwiseAND(F.lit((1 << _PAGE) - 1))
    pages = (
        locators.select(_probe(bits).alias("_probe"))
        .groupBy(page.alias("_page"))
        .agg(F.bitmap_construct_agg(bit).alias("_bits"))
    )
    byte = F.conv(F.hex(F.expr("substring(_bits, cast((_probe & 32767) >> 3 as int) + 1, 1)")), 16, 10)
    hit = F.expr("shiftright(cast(_byte as int), cast(_probe & 7 as int)) & 1") == 1
    return (
        rows.withColumn("_probe", _probe(bits)).withColumn("_page", page)
        .join(F.broadcast(pages), "_page")  # at most 2 ** bits bits
        .withColumn("_byte", byte).where(hit)
        .drop("_probe", "_page", "_bits", "_byte")
    )


def decisions(
    documents: DataFrame, store: str, digest_bytes: int = DIGEST_BYTES, bits: int = FILTER_BITS
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, file, row`` for every row that
    the streams have taken in. ``documents`` are the files they read, not as a stream."""
    spark = documents.sparkSession
    log = spark.read.schema(_LOG).parquet(f"{store}/log")
    log = log.withColumn("digest", F.substring("sha", 1, digest_bytes))
    state = stored(keyed_state(spark, store), "digest-state")
    decided = stored(log.join(state.hint("merge"), "digest"), "decided")
    at = ["file", "row"]

    # the rows of digests that were met again, each with its whole text
    hits = decided.where("group_size > 1")
    rows = documents.select("text", *_located(documents))
    found = _wanted(rows, hits.select(*at), bits).join(hits.hint("merge"), at)
    texts = stored(found.withColumn("body", plain(F.col("text")).cast("binary")).drop("text"), "hits")
    is_keeper = (F.col("file") == F.col("keeper.file")) & (F.col("row") == F.col("keeper.row"))
    keepers = texts.where(is_keeper).select("digest", F.col("body").alias("kept_body"))
    # stored, so that no later step needs this join's rows by digest and it may be split
    unequal = stored(
        texts.join(keepers.hint("merge"), "digest").where("body <> kept_body").select("digest"), "unequal"
    )
    if not unequal.isEmpty():
        # different texts under one digest: their rows are grouped by the texts themselves
        shared = unequal.distinct()
        mixed = texts.drop("group_size", "keeper").join(shared, "digest", "left_semi")
        groups = mixed.groupBy("digest", "body").agg(
            F.count(F.lit(1)).alias("group_size"), _best().alias("keeper")
        )
        exact = mixed.join(groups, ["digest", "body"]).select(*decided.columns)
        decided = decided.join(shared, "digest", "left_anti").unionByName(exact)
    return decided.select(
        "doc_id",
        F.col("keeper.doc_id").alias("keep_id"),
        "group_size",
        is_keeper.alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        *at,
    )
