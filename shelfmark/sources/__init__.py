"""Readers: landed responses of one source in, hits and records out."""

from shelfmark.sources.archives import archive_members
from shelfmark.sources.registry import READERS, known_sources, read_source
from shelfmark.sources.landing import Harvest, read_landing

__all__ = [
    "Harvest", "READERS", "archive_members", "known_sources", "read_landing", "read_source",
]
