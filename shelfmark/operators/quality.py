"""Fill missing fields, profile tables, repair derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.files import file_type
from shelfmark.functions.text import null_if_blank

# Frequent function words that tell the languages of the test texts apart; a
# caller with other languages passes other lists.
STOP_WORDS: dict[str, list[str]] = {
    "de": ["der", "die", "und", "das", "nicht", "ist", "für", "den", "von", "mit", "sich", "auch", "auf", "dem", "ein", "eine"],
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "with", "was", "are", "this", "by", "from", "at", "it"],
    "es": ["el", "los", "del", "por", "con", "para", "una", "como", "pero", "más", "las", "y", "no", "se", "su", "que"],
    "fr": ["le", "les", "des", "et", "une", "dans", "pour", "qui", "est", "au", "sur", "avec", "pas", "elle", "du", "que"],
}

WORD_BREAK = r"[^\p{L}]+"


def guess_language(
    df: DataFrame,
    text: str,
    out: str = "guess",
    stop_words: Mapping[str, Sequence[str]] = STOP_WORDS,
) -> DataFrame:
    """Language with the most stop words; the first in order wins a tie and a
    text without any gets null. A row-local vote: no explode, no shuffle."""
    # one pass over all words, then one per language over the few that count
    known = sorted({w for listed in stop_words.values() for w in listed})
    words = df.withColumn(
        "_words", F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w.isin(known))
    )

    def votes_for(listed: Sequence[str]) -> Column:
        return F.size(F.filter("_words", lambda w: w.isin(list(listed))))

    votes = words.withColumn(
        "_votes",
        F.array(
            *[
                F.struct(
                    votes_for(listed).alias("n"),
                    F.lit(-rank).alias("rank"),
                    F.lit(lang).alias("lang"),
                )
                for rank, (lang, listed) in enumerate(stop_words.items())
            ]
        ),
    )
    best = F.array_max("_votes")
    return votes.withColumn(out, F.when(best["n"] > 0, best["lang"])).drop("_words", "_votes")


def fill_language(
    df: DataFrame,
    text: str = "description",
    language: str = "language",
    stop_words: Mapping[str, Sequence[str]] = STOP_WORDS,
) -> DataFrame:
    """Fill a null or blank language from the text; others stay as they are."""
    # texts whose language is known are not split into words
    unknown = F.when(null_if_blank(F.col(language)).isNull(), F.col(text))
    guessed = guess_language(df.withColumn("_unknown", unknown), "_unknown", "_guess", stop_words)
    filled = F.coalesce(null_if_blank(F.col(language)), F.col("_guess"))
    return guessed.withColumn(language, filled).drop("_unknown", "_guess")


def fill_description(
    df: DataFrame,
    description: str = "description",
    title: str = "title",
    keywords: str | None = None,
) -> DataFrame:
    """Fill a null or blank description with the title, then with the keywords."""
    choices = [null_if_blank(F.col(description)), null_if_blank(F.col(title))]
    if keywords:
        choices.append(null_if_blank(F.array_join(keywords, ", ")))
    return df.withColumn(description, F.coalesce(*choices))


#: What a link file is called, and what the reason of a placeholder says (fixed values).
LINK_FILE = "external_study.url"
_HOSTED = r"^Study hosted externally\.? Resource access: (\S+)"


def external_link(reason: Column) -> Column:
    """The address in the reason of a placeholder; null if the reason is another one."""
    return F.when(reason.rlike(_HOSTED), F.regexp_extract(reason, _HOSTED, 1))


def virtual_files(records: DataFrame, files: str = "files") -> DataFrame:
    """Turn placeholders of externally hosted studies into link files: a
    succeeded ``*.url`` entry instead of a failed placeholder."""

    def linked(f: Column) -> Column:
        link = external_link(f["failure_reason"])
        changed = (
            f.withField("file_key", F.lit(LINK_FILE))
            .withField("file_url", link)
            .withField("restricted", F.lit(False))
            .withField("failure_reason", F.lit(""))
        )
        return F.when(link.isNotNull(), changed).otherwise(f)

    return records.withColumn(files, F.transform(files, linked))


def profile(
    df: DataFrame,
    name: str,
    columns: Sequence[str] | None = None,
    long_text: Sequence[str] = (),
    exact: bool = False,
) -> DataFrame:
    """One row per column: rows, nulls, blanks, distinct values, duplicates.

    The default counts distinct values with HyperLogLog in a single pass. An
    exact count shuffles every (column, value) pair once; columns named in
    ``long_text`` go through it as 128-bit digests.
    """
    columns = list(columns or df.columns)
    values = df.select(
        *[
            (F.unhex(F.md5(F.col(c).cast("string"))) if c in long_text else F.col(c)).alias(c)
            for c in columns
        ],
        *[(F.col(c).cast("string") == "").alias(f"_blank_{c}") for c in columns],
    )
    distinct = F.count_distinct if exact else F.approx_count_distinct
    aggregates = [F.count(F.lit(1)).alias("_n")]
    for c in columns:
        aggregates += [
            F.count(c).alias(f"_filled_{c}"),
            F.count_if(F.col(f"_blank_{c}")).alias(f"_blanks_{c}"),
            distinct(c).alias(f"_distinct_{c}"),
        ]
    one = values.agg(*aggregates)
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.col("_n").alias("n_rows"),
            (F.col("_n") - F.col(f"_filled_{c}")).alias("n_null"),
            F.col(f"_blanks_{c}").alias("n_blank"),
            F.col(f"_distinct_{c}").alias("n_distinct"),
            (F.col(f"_filled_{c}") - F.col(f"_distinct_{c}")).alias("n_duplicate"),
        )
        for c in columns
    ]
    return one.select(F.inline(F.array(*rows)))


def repair_file_types(files: DataFrame) -> DataFrame:
    """Derive ``file_type`` from the name again."""
    return files.withColumn("file_type", file_type(F.col("file_name")))
