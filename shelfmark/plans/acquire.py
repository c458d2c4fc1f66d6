"""From a harvest to accepted records: score, bypass, duplicates, caps."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.records import is_open_license
from shelfmark.functions.text import clean_term
from shelfmark.operators.dedupe import fresh_file_urls
from shelfmark.operators.filters import passes, with_files
from shelfmark.operators.limits import cap_per_source, cap_per_term
from shelfmark.operators.relevance import score_records
from shelfmark.sources.landing import Harvest
from shelfmark.sources.zenodo import recent_open
from shelfmark.taxonomy import (
    BROAD_TERMS,
    DATAVERSE_HOSTS,
    PHRASE_WEIGHTS,
    RELEVANCE_THRESHOLD,
    STRICT_TERMS,
)

ORDER = ["term_rank", "page", "pos"]


@dataclass(frozen=True)
class Policy:
    """How one source treats its hits.

    ``strict_terms``/``wildcard``: which terms vouch for their hits;
    ``all_strict``: every term does (a query the user typed, for CESSDA);
    ``retry``: a rejected id may come back under a later term;
    ``cap``: what ``max_records`` counts, the source or each term;
    ``by_license``: the license decides instead of the score, and file URLs
    listed by an earlier record are dropped.
    """

    strict_terms: bool = False
    wildcard: bool = False
    all_strict: bool = False
    retry: bool = True
    cap: str = "source"
    by_license: bool = False


_DATAVERSE = Policy(strict_terms=True, wildcard=True)

POLICIES: dict[str, Policy] = {
    "zenodo": Policy(cap="term"),
    "dryad": Policy(cap="term"),
    **{name: _DATAVERSE for name in DATAVERSE_HOSTS},
    "odum": Policy(by_license=True),
    "icpsr": Policy(),
    "ihsn": Policy(strict_terms=True, retry=False),
    "sada": Policy(strict_terms=True, wildcard=True, retry=False),
    "cessda": Policy(strict_terms=True, retry=False),
}


def policy_for(source: str, user_query: bool = False) -> Policy:
    policy = POLICIES[source]
    if source == "cessda" and user_query:
        return replace(policy, all_strict=True)
    return policy


def mark_strict(
    hits: DataFrame, policy: Policy, strict_terms: Collection[str] = STRICT_TERMS
) -> DataFrame:
    """Add ``is_strict``: the term of the hit vouches for the record."""
    term = clean_term(F.col("term"))
    strict = F.lit(policy.all_strict)
    if policy.strict_terms:
        strict = strict | term.isin(list(strict_terms))
    if policy.wildcard:
        strict = strict | (term == "*")
    return hits.withColumn("is_strict", F.coalesce(strict, F.lit(False)))


def first_places(hits: DataFrame) -> DataFrame:
    """Per record the first hit of all and the first strict hit.

    Those two are all that decides, since what a hit can add to a record is
    only whether its term is strict. One row per record goes on to the join.
    """
    place = F.struct(*ORDER, "term", "is_strict")
    return hits.groupBy("context_repository", "recid").agg(
        F.min(place).alias("_first"),
        F.min(F.when(F.col("is_strict"), place)).alias("_first_strict"),
    )


def _decide(scored: DataFrame, policy: Policy, threshold: int) -> DataFrame:
    if policy.by_license:
        chosen = F.when(is_open_license(F.coalesce("license", "license_id")), F.col("_first"))
    elif policy.retry:
        # first hit that passes: any hit of a relevant record, else a strict one
        chosen = F.when(F.col("score") >= threshold, F.col("_first")).otherwise(F.col("_first_strict"))
    else:
        chosen = F.when(
            passes(F.col("score"), F.col("_first.is_strict"), threshold), F.col("_first")
        )
    return (
        scored.withColumn("_place", chosen)
        .filter(F.col("_place").isNotNull())
        .withColumns({c: F.col(f"_place.{c}") for c in [*ORDER, "term"]})
        .withColumn("query_string", clean_term(F.col("term")))
        .drop("_place", "_first", "_first_strict", "term")
    )


def accept(
    harvest: Harvest,
    policy: Policy,
    max_records: int | None = None,
    weights: Mapping[str, int] = PHRASE_WEIGHTS,
    threshold: int = RELEVANCE_THRESHOLD,
    strict_terms: Collection[str] = STRICT_TERMS,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Accepted records: conformed columns + ``score``, place and ``query_string``.

    ``store`` keeps an intermediate result that is used more than once, such as
    ``pipeline.stored``; without it Spark computes that result again.
    """
    keep = store or (lambda df: df)
    hits = mark_strict(harvest.hits, policy, strict_terms)
    records = with_files(harvest.records)
    if policy.by_license:
        candidates = records.withColumn("score", F.lit(None).cast("int"))
    else:
        candidates = score_records(records, "score_text", weights)
    placed = candidates.join(first_places(hits), ["context_repository", "recid"])
    accepted = _decide(placed, policy, threshold)
    if policy.by_license:
        accepted = fresh_file_urls(keep(accepted), ["context_repository", "recid"], ["page", "pos"])
    if max_records is None:
        return accepted
    if policy.cap == "source":
        return cap_per_source(accepted, max_records)
    return _capped_by_term(hits, keep(accepted), max_records)


def _capped_by_term(
    hits: DataFrame, accepted: DataFrame, max_records: int
) -> DataFrame:
    """With a cap per term the term that takes a record need not be its first."""
    key = ["context_repository", "recid"]
    passing = hits.join(accepted.select(*key), key, "left_semi")
    per_term = passing.groupBy(*key, "term_rank").agg(
        F.min(F.struct("page", "pos", "term")).alias("_at")
    ).select(*key, "term_rank", "_at.*")
    taken = cap_per_term(per_term, max_records)
    places = taken.select(*key, *ORDER, clean_term(F.col("term")).alias("query_string"))
    return (
        accepted.drop(*ORDER, "query_string").join(places, key).select(*accepted.columns)
    )


def accepted_per_source(accepted: DataFrame) -> DataFrame:
    return accepted.groupBy("context_repository").agg(F.count(F.lit(1)).alias("n_records"))


#: Words a search term needs at least, by source; sources not listed take every term.
MIN_WORDS = {"zenodo": 3}
#: Sources whose search takes no terms of ours.
OWN_SEARCH = ("cessda", "sada", "ihsn")


def terms_for(
    source: str, strict: Sequence[str], broad: Sequence[str], user_query: str | None = None
) -> list[str] | None:
    """What to search a source for: the user's query split at `` OR ``, else the terms
    that suit the source, None where its harvest brings its own."""
    if user_query:
        return [t.strip() for t in user_query.split(" OR ") if t.strip()]
    if source in OWN_SEARCH:
        return None
    return search_terms(strict, broad, MIN_WORDS.get(source, 1))


@dataclass(frozen=True)
class Search:
    """What a run asks the sources for.

    ``strict`` and ``broad``: the terms, of which every source takes what suits it;
    ``query``: a query of the user instead, alternatives with `` OR `` between them;
    ``run_date``: the day of the run (ISO), which sources that are asked for new records
    only count their ``days`` back from; without it all dates count.
    """

    strict: Sequence[str] = tuple(STRICT_TERMS)
    broad: Sequence[str] = tuple(BROAD_TERMS)
    query: str | None = None
    run_date: str | None = None
    days: int = 30


#: Sources that are asked for open records of the last days.
RECENT: dict[str, Callable[[Harvest, str, int], Harvest]] = {"zenodo": recent_open}


def searched(harvest: Harvest, source: str, search: Search) -> Harvest:
    """What ``search`` would have brought of a harvest that holds more: the hits of its
    terms, and the records of its days. A term that is quoted is the same term."""
    terms = terms_for(source, search.strict, search.broad, search.query)
    if terms is not None:
        asked = clean_term(F.col("term")).isin([t.strip('"') for t in terms])
        harvest = harvest._replace(hits=harvest.hits.filter(asked))
    if search.run_date and source in RECENT:
        harvest = RECENT[source](harvest, search.run_date, search.days)
    return harvest


def search_terms(strict: Sequence[str], broad: Sequence[str], min_words: int = 1) -> list[str]:
    """The union of two term lists without repetitions, in order; ``min_words``
    keeps the longer phrases only, for repositories that match loosely."""
    terms = dict.fromkeys(t.strip('"') for t in [*strict, *broad])
    return [t for t in terms if len(t.split()) >= min_words]
