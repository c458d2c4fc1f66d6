"""A corpus from raw documents to training sequences, one operator per stage.

Each stage takes the session, the documents its predecessor kept and the folder of
tables, and returns the documents it keeps (the last one: packed pieces). ``run`` writes
every stage to the shared folder and reads it back, so a lost executor costs no more
than a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import stored, table
from shelfmark.llm.decontaminate import leaked_items
from shelfmark.llm.line_dedup import drop_shared_lines
from shelfmark.llm.near_copies import near_copies
from shelfmark.llm.packing import pack
from shelfmark.llm.toxicity import score, train

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that a model fitted to the labels rejects are gone; rows keep what they
    hold."""
    model = train(docs, table(spark, folder, "labels"))
    kept = score(docs, model, carry=COLUMNS[1:])
    return kept.where(F.col("predicted") == 0).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Lines of earlier documents go from the text; the count of characters follows.
    A document stays even if no line of it is left."""
    kept = drop_shared_lines(docs, carry=["lang", "source"])
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts that the SimHash operator puts into one component, by their five-word shingles,
    are linked, and so are all texts that share at least four fifths of these shingles; one
    row of each component stays: the one with the smallest id, of rows that repeat it the
    one with the smallest hash. Texts without words are copies of each other and of no
    other text. A row without an id stays if its component has no row with one and it is
    the first."""
    rows, named = near_copies(docs.select(*COLUMNS), alike=True)
    place = F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id",
        F.xxhash64(*COLUMNS[1:]).alias("hash"), "row",
    )
    named = stored(named.join(rows.select("row", place.alias("place")), "row"), "places")
    first = stored(named.groupBy("component").agg(F.min("place").alias("first")), "first-places")
    gone = named.join(first, "component").where(F.col("row") != F.col("first.row")).select("row")
    return rows.join(gone, "row", "left_anti").select(*COLUMNS)


def drop_leaked(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a benchmark item are gone."""
    leaks = leaked_items(docs, table(spark, folder, "benchmark"))
    gone = leaks.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents in sequences of equal length; every token is in one piece."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_leaked),
    ("packing", pack_sequences),
]

#: The stages hold a trained model, fingerprints and token ids: no SQL says the same.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
