"""Column functions: text, file names, record fields, dates."""

from shelfmark.functions.dates import (
    chunk_start,
    date_part,
    date_range_chunks,
    date_range_slices,
)
from shelfmark.functions.files import (
    absolute_href,
    base_name,
    file_ext,
    file_tier,
    file_type,
    has_project_link,
    is_archive,
    is_project_file,
    is_required_file,
    link_file_name,
    safe_filename,
    software_name,
)
from shelfmark.functions.records import (
    failure_reason,
    format_authors,
    is_open_license,
    keyword_set,
    map_license,
    person_roles,
)
from shelfmark.functions.text import (
    clean_term,
    flatten_json,
    project_identifier,
    slugify,
    split_query,
    strip,
    word_count,
    xml_to_json,
)

__all__ = [
    "absolute_href", "base_name", "chunk_start", "clean_term", "date_part",
    "date_range_chunks", "date_range_slices", "failure_reason", "file_ext",
    "file_tier", "file_type", "flatten_json", "format_authors", "has_project_link",
    "is_archive", "is_open_license", "is_project_file", "is_required_file",
    "keyword_set", "link_file_name", "map_license", "person_roles",
    "project_identifier", "safe_filename", "slugify", "software_name",
    "split_query", "strip", "word_count", "xml_to_json",
]
