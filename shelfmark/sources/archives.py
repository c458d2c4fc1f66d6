"""Members of landed zip and tar archives."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

_MEMBERS = "archive string, member string, size bigint, readable boolean"


def _list_members(content: bytes) -> list[tuple[str, int]] | None:
    """(name, size) of the files inside, None for anything but a zip or tar."""
    stream = io.BytesIO(content)
    try:
        if zipfile.is_zipfile(stream):
            with zipfile.ZipFile(stream) as z:
                return [(i.filename, i.file_size) for i in z.infolist() if not i.is_dir()]
        stream.seek(0)
        with tarfile.open(fileobj=stream, mode="r:*") as t:
            return [(m.name, m.size) for m in t if m.isfile()]
    except (tarfile.TarError, zipfile.BadZipFile, EOFError, OSError, NotImplementedError):
        return None


def _without_root(names: list[str]) -> list[str]:
    """Names below the top folder, where one folder is all there is."""
    roots = {n.split("/", 1)[0] if "/" in n else None for n in names}
    if len(roots) != 1 or None in roots:
        return names
    return [n.split("/", 1)[1] for n in names]


def _scanner(flatten: bool):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                members = _list_members(content)
                names, sizes = zip(*members, strict=True) if members else ([None], [None])
                if members and flatten:
                    names = _without_root(list(names))
                yield pd.DataFrame(
                    {
                        "archive": path,
                        "member": list(names),
                        "size": pd.array(list(sizes), dtype="Int64"),
                        "readable": members is not None,
                    }
                )

    return scan


def read_blobs(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Landed files as (path, content, length). One file is one row, so a task
    takes few of them and a large archive does not hold up a long list."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "content", "length")
    )


def archive_members(blobs: DataFrame, flatten: bool = True) -> DataFrame:
    """(archive, member, size, readable), one row per file inside.

    An unreadable or empty archive keeps one row without a member. ``flatten``
    drops the top folder where it is the only thing in the archive. Set
    spark.sql.execution.arrow.maxBytesPerBatch to bound the blobs per batch.
    """
    return blobs.select("path", "content").mapInPandas(_scanner(flatten), _MEMBERS)
