"""Which reader serves which source; the one extension point of the library.

A reader is ``(landing, source) -> Harvest``. Add one with ``READERS[name] = f``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from shelfmark.sources.cessda import read_cessda
from shelfmark.sources.dataverse import read_dataverse
from shelfmark.sources.dryad import read_dryad
from shelfmark.sources.icpsr import read_icpsr
from shelfmark.sources.landing import Harvest, read_landing
from shelfmark.sources.nada import read_nada
from shelfmark.sources.oai import read_oai
from shelfmark.sources.zenodo import read_zenodo
from shelfmark.taxonomy import DATAVERSE_HOSTS

Reader = Callable[[DataFrame, str], Harvest]

READERS: dict[str, Reader] = {
    "zenodo": read_zenodo,
    "dryad": read_dryad,
    **{name: read_dataverse for name in DATAVERSE_HOSTS},
    "odum": partial(read_oai, prefix="oai_datacite", short_slugs=True),
    "icpsr": read_icpsr,
    "ihsn": read_nada,
    "sada": read_nada,
    "cessda": read_cessda,
}


def known_sources() -> list[str]:
    return list(READERS)


def read_source(
    spark: SparkSession, source: str, path: str, format: str = "parquet"
) -> Harvest:
    """Read what one source landed below ``path``."""
    name = source.strip().lower()
    if name not in READERS:
        raise ValueError(f"no reader for source {source!r}; known: {', '.join(READERS)}")
    return READERS[name](read_landing(spark, path, format), name)
