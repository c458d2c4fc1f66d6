"""Text functions, all of them built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode blanks, the four ASCII separators included (fixed values).
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Word characters are letters, numbers and the underscore of any script.
# Combining marks are not: "[\w]" in Java would keep them.
_BLANK_CLASS = r"\s\x1c-\x1f"
_NOT_SLUG = rf"(?U)[^\p{{L}}\p{{N}}_{_BLANK_CLASS}-]"
_SEPARATORS = rf"(?U)[{_BLANK_CLASS}-]+"
_BLANK_RUN = rf"(?U)[{_BLANK_CLASS}]+"

# A JSON string (a key when followed by a colon) or a bare scalar. Escapes are
# masked before this runs, so a string is one character class: no recursion.
_JSON_TOKEN = r'"[^"]*+"\s*:?|-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null'


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def null_if_blank(text: Column) -> Column:
    return F.when(strip(text) != "", text)


def slugify(text: Column, max_length: int = 80, empty: str = "untitled_project") -> Column:
    """Lower-case slug. The cut comes after the hyphen trim, so a cut slug may
    end in a hyphen."""
    kept = F.regexp_replace(F.coalesce(text, F.lit("")), _NOT_SLUG, "")
    slug = F.btrim(F.regexp_replace(kept, _SEPARATORS, "-"), F.lit("-"))
    slug = F.lower(F.substring(slug, 1, max_length))
    return F.when(slug == "", F.lit(empty)).otherwise(slug)


def project_identifier(
    title: Column, record_id: Column, max_length: int | None = 120, **slug: object
) -> Column:
    """``slug-recordid``; callers clean the record id, which differs by source."""
    ident = F.concat(slugify(title, **slug), F.lit("-"), record_id)
    return ident if max_length is None else F.substring(ident, 1, max_length)


def clean_term(term: Column) -> Column:
    return F.btrim(term, F.lit('"'))


def split_query(query: Column) -> Column:
    """The alternatives of an ``a OR b`` query, trimmed, blanks dropped."""
    parts = F.transform(F.split(query, " OR "), strip)
    return F.filter(parts, lambda p: p != "")


def word_count(text: Column) -> Column:
    words = F.split(strip(text), _BLANK_RUN)
    return F.size(F.filter(words, lambda w: w != ""))


def flatten_json(json: Column) -> Column:
    """Every leaf value of a JSON text joined with blanks; keys are dropped.

    Booleans and nulls are spelled ``True``, ``False`` and ``None``; numbers
    keep their JSON spelling.
    """
    # control characters cannot stand unescaped in JSON, so they mark escapes
    masked = F.replace(
        F.replace(json, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02")
    )
    tokens = F.regexp_extract_all(masked, F.lit(_JSON_TOKEN), F.lit(0))
    leaves = F.filter(tokens, lambda t: ~(t.startswith('"') & t.endswith(":")))

    def value(token: Column) -> Column:
        quoted = F.replace(
            F.replace(strip(token), F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\")
        )
        return (
            F.when(
                token.startswith('"'),
                F.get_json_object(F.concat(F.lit("["), quoted, F.lit("]")), "$[0]"),
            )
            .when(token == "true", F.lit("True"))
            .when(token == "false", F.lit("False"))
            .when(token == "null", F.lit("None"))
            .otherwise(token)
        )

    return F.array_join(F.transform(leaves, value), " ")


def xml_to_json(xml: Column, schema: str) -> Column:
    """An XML element as nested JSON; attributes and empty elements drop out,
    a tag declared as an array in ``schema`` collects its repetitions."""
    parsed = F.from_xml(
        xml,
        F.lit(schema),
        {
            "ignoreNamespace": "true",
            "excludeAttribute": "true",
            "nullValue": "",
            "mode": "PERMISSIVE",
        },
    )
    return F.to_json(parsed)
