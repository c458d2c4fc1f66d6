"""File names, extensions, tiers and links.

Extension sets are literals, so a test is a lookup inside codegen; no dimension
join is needed for a few dozen values.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import strip
from shelfmark.taxonomy import FILE_TYPES, LINK_TARGET_EXT, FileTypes


def file_ext(path: Column) -> Column:
    """Lower-cased text from the last dot on, ``''`` without a dot."""
    return F.when(
        F.instr(path, ".") > 0,
        F.concat(F.lit("."), F.lower(F.substring_index(path, ".", -1))),
    ).otherwise("")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_type(path: Column) -> Column:
    """Extension of the last part of a path without its dot, ``''`` if it has none."""
    return F.ltrim(file_ext(base_name(path)), F.lit("."))


def _lookup(ext: Column, values: Mapping[str, object]) -> Column:
    """Value of a literal map, null for an unknown key. Unlike a chain of CASE
    branches it computes ``ext`` once. The map is one SQL text, since a literal
    at a time takes a call into the JVM each."""
    pairs = ", ".join(f"{_sql(k)}, {_sql(v)}" for k, v in values.items())
    return F.try_element_at(F.expr(f"map({pairs})"), ext)


def _sql(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value).lower()


def _is_one_of(ext: Column, extensions: Iterable[str]) -> Column:
    return F.coalesce(_lookup(ext, dict.fromkeys(extensions, True)), F.lit(False))


def file_tier(ext: Column, types: FileTypes = FILE_TYPES) -> Column:
    """1 project file, 2 text or archive, 3 media, 0 anything else."""
    tiers = dict.fromkeys(types.media, 3)
    tiers |= dict.fromkeys([*types.text, *types.archive], 2)
    tiers |= dict.fromkeys(types.project, 1)
    return F.coalesce(_lookup(ext, tiers), F.lit(0))


def is_project_file(ext: Column, types: FileTypes = FILE_TYPES) -> Column:
    return _is_one_of(ext, types.project)


def is_required_file(ext: Column, types: FileTypes = FILE_TYPES) -> Column:
    return _is_one_of(F.lower(ext), types.required)


def is_archive(ext: Column, types: FileTypes = FILE_TYPES) -> Column:
    return _is_one_of(ext, types.archive)


def software_name(ext: Column, types: FileTypes = FILE_TYPES) -> Column:
    """Analysis software that owns the extension, null when none does."""
    return _lookup(ext, {e: name for name, exts in types.software.items() for e in exts})


def safe_filename(name: Column) -> Column:
    cleaned = strip(F.replace(F.coalesce(name, F.lit("")), F.lit(".."), F.lit("")))
    return F.when(cleaned == "", F.lit("unnamed_file")).otherwise(cleaned)


def link_file_name(url: Column) -> Column:
    """Last path part before ``?``; null for anything but an http(s) link."""
    url = strip(url)
    name = F.substring_index(F.substring_index(url, "/", -1), "?", 1)
    return F.when(
        url.startswith("http"),
        F.when(name == "", F.lit("resource_link")).otherwise(name),
    )


def absolute_href(href: Column, host: str) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(host), href))


def link_pattern(extensions: Iterable[str] = LINK_TARGET_EXT) -> str:
    """Regex for an extension that ends a link."""
    return "(?:" + "|".join(re.escape(e) for e in extensions) + r")(?:\?|#|\s|$|\)|,|\")"


def has_project_link(text: Column, extensions: Iterable[str] = LINK_TARGET_EXT) -> Column:
    return F.coalesce(F.lower(text).rlike("(?U)" + link_pattern(extensions)), F.lit(False))
