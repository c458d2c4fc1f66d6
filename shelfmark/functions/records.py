"""Licenses, people, keywords and failure texts of a record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import strip
from shelfmark.taxonomy import PERSON_ROLES

# What counts as an open license in a lower-cased text.
OPEN_LICENSE = (
    r"cc[\s_-]*0|cc[\s_-]zero|cc[\s_-]by|creativecommons\.org/(?:licenses/by|publicdomain)"
    r"|creative[\s_-]commons[\s_-]attribution|public[\s_-]*domain|odbl|pddl"
)


def map_license(license: Column) -> Column:
    """``cc0`` or ``cc-by`` when the text names one, null for none, else itself."""
    low = F.lower(license)
    return (
        F.when(license == "", F.lit(None))
        .when(F.contains(low, F.lit("cc0")) | F.contains(low, F.lit("cc-zero")), F.lit("cc0"))
        .when(F.contains(low, F.lit("cc-by")), F.lit("cc-by"))
        .otherwise(license)
    )


def is_open_license(license: Column) -> Column:
    return F.coalesce(F.lower(license).rlike(OPEN_LICENSE), F.lit(False))


def format_authors(authors: Column) -> Column:
    """``Last, First | Last, First`` from structs with firstName and lastName."""

    def name(author: Column) -> Column:
        first = strip(F.coalesce(author["firstName"], F.lit("")))
        last = strip(F.coalesce(author["lastName"], F.lit("")))
        return F.btrim(F.concat(last, F.lit(", "), first), F.lit(", "))

    named = F.filter(F.transform(authors, name), lambda n: n != "")
    return F.coalesce(F.array_join(named, " | "), F.lit(""))


def keyword_set(keywords: Column) -> Column:
    """Distinct trimmed keywords; a list entry may itself hold several."""
    given = F.filter(keywords, lambda k: k.isNotNull())
    parts = F.flatten(F.transform(given, lambda k: F.split(k, ",")))
    trimmed = F.transform(parts, strip)
    return F.array_distinct(F.filter(trimmed, lambda p: p != ""))


def person_role(role: Column, roles: list[str] = PERSON_ROLES) -> Column:
    upper = F.upper(F.coalesce(role, F.lit("AUTHOR")))
    return F.when(upper.isin(roles), upper).otherwise("OTHER")


def person_roles(people: Column, roles: list[str] = PERSON_ROLES) -> Column:
    """Named people with a role out of ``roles``."""
    named = F.filter(people, lambda p: p["name"].isNotNull() & (p["name"] != ""))
    return F.transform(
        named,
        lambda p: F.struct(p["name"].alias("name"), person_role(p["role"], roles).alias("role")),
    )


def failure_reason(embargo_date: Column) -> Column:
    return F.when(
        embargo_date.isNotNull() & (embargo_date != ""),
        F.concat(F.lit("Embargoed until "), embargo_date),
    ).otherwise("Restricted access")
