"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, whatever is done with them.

    A filter on a plain computed column moves below the projection and carries
    the expression along, once for every mention; a parsed response or a score
    over dozens of phrases is then computed again and again. Filters do not move
    below a generator, so the columns go through one that yields a single row.
    """
    named = [expression.alias(name) for name, expression in columns.items()]
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*named))))
