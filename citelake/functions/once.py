"""Columns that are worked out once per row, whatever is filtered on later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that filters above cannot repeat their work.

    A filter is moved below a plain projection by writing the column's expression into it, once per
    mention; after a parse that would be a parse for every field the filter looks at. It is not
    moved below a generator, so the columns come out of one that yields a single row.
    """
    computed = F.struct(*[column.alias(name) for name, column in columns.items()])
    return rows.select("*", F.inline(F.array(computed)))
