"""License scan by ordered signature rules, in column expressions only.

1. A text that holds none of the ``GATES`` is only counted. What passes is reduced to
   words in lower case with one blank between them.
2. A rule is tried where its keyword stands in the text; its matches become intervals,
   with the rule's rank, label and score.
3. Intervals are swept by start. One that lies inside an interval of equal or higher
   rank is suppressed; of equal intervals the first rule's stays. Base phrases have the
   first rank, so they are never suppressed.

Everything happens inside the row: no shuffle, and a document that many others copy
is no heavier than any other.

Defined cases: a null text is empty, has no words, no label and score 0. Rows that
repeat a ``doc_id`` are scanned each. Extra columns are not looked at.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.once import once
from shelfmark.llm.license_rules import Rule, rules

#: Parts of a text without which no rule can match; "a+b" asks for both.
GATES = (
    "licen", "cc+by", "cc0", "apache", "gpl", "bsd", "mpl", "ms+pl", "ms+rl", "wtfpl",
    "beerware", "creativecommons", "creative+commons", "opensource", "gnu", "permission",
    "redistribution", "public+domain", "reserved", "proprietary", "warrant", "copyright",
    "publicdomain",
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before letters are lower case

_RULES = "array<struct<id:int,rank:int,score:double,label:string,keyword:string,pattern:string>>"
_FOUND = "array<struct<start:int,back:int,rank:int,id:int,label:string,score:double>>"

# ``back`` is the end, negated, for the order.
_SCAN = f"""
    array_sort(flatten(transform(
        filter(_rules, r -> contains(_line, r.keyword)),
        r -> aggregate(
            zip_with(split(_line, r.pattern, -1), regexp_extract_all(_line, r.pattern, 0),
                     (p, m) -> struct(length(p) AS p, length(m) AS m)),
            struct(0 AS at, CAST(array() AS {_FOUND}) AS found),
            (a, x) -> IF(x.m IS NULL, a, struct(
                a.at + x.p + x.m AS at,
                concat(a.found, array(struct(
                    a.at + x.p AS start, -(a.at + x.p + x.m) AS back, r.rank AS rank,
                    r.id AS id, r.label AS label, r.score AS score))) AS found)),
            a -> a.found))))
"""

# far[k]: how far the intervals of rank k have reached
_KEEP = f"""
    aggregate(
        _found,
        struct(array(0, 0, 0, 0) AS far, CAST(array() AS {_FOUND}) AS kept),
        (a, d) -> IF(
            array_max(slice(a.far, 1, d.rank + 1)) >= -d.back, a,
            struct(transform(a.far, (f, k) -> IF(k = d.rank, greatest(f, -d.back), f)) AS far,
                   concat(a.kept, array(d)) AS kept)),
        a -> a.kept)
"""


def passes_gate(text: Column) -> Column:
    low = F.lower(text)
    gate = F.lit(False)
    for parts in GATES:
        both = F.lit(True)
        for part in parts.split("+"):
            both = both & F.contains(low, F.lit(part))
        gate = gate | both
    return gate


def words_in_line(text: Column) -> Column:
    """Words in lower case with one blank before and after each."""
    low = F.translate(text, _UPPER, _UPPER.lower())
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(low, _NOT_WORD, " ")), F.lit(" "))


def scan_licenses(
    documents: DataFrame, signatures: Sequence[Rule] | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``
    for every row; columns of ``carry`` follow unchanged."""
    listed = json.dumps([asdict(r) for r in (signatures or rules())])
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = once(
        documents.select("doc_id", "text", *carry),
        _n=F.regexp_count(text, F.lit(_WORD)).cast("long"),
        _line=F.when(passes_gate(text), words_in_line(text)),
    )
    rows = rows.withColumn("_rules", F.from_json(F.lit(listed), _RULES))
    rows = once(rows, _found=F.expr(f"IF(_line IS NULL, NULL, {_SCAN})"))
    rows = once(rows, _kept=F.expr(_KEEP), _base=F.expr("filter(_found, d -> d.rank = 0)"))
    rows = once(
        rows,
        _first=F.expr("array_min(transform(_base, d -> d.start))"),
        _last=F.expr("array_max(transform(_base, d -> d.start))"),
        _base_labels=F.expr("array_sort(array_distinct(transform(_base, d -> d.label)))"),
    )
    word = (
        "CAST(length(left(_line, {0})) - length(replace(left(_line, {0}), ' ', '')) - 1 AS BIGINT)"
    )
    return rows.select(
        "doc_id",
        F.col("_n").alias("n_words"),
        F.expr("CAST(IF(_base IS NULL, 0, size(_base)) AS BIGINT)").alias("n_base"),
        F.expr(word.format("_first")).alias("first_word"),
        F.expr(word.format("_last")).alias("last_word"),
        F.expr("coalesce(array_join(_base_labels, ','), '')").alias("base_labels"),
        F.expr(
            "coalesce(array_join(array_sort(array_union(_base_labels, "
            "transform(_kept, d -> d.label))), ','), '')"
        ).alias("labels"),
        F.expr("coalesce(array_max(transform(_kept, d -> d.score)), 0D)").alias("score"),
        *carry,
    )
