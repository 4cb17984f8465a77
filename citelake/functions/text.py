"""Column helpers for text: searching, presence, joining, cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citelake.schema import LIST_SEPARATOR


def contains_term(text: Column, term: str) -> Column:
    """Case-insensitive containment.

    ``%`` and ``_`` in the term keep their pattern meaning; a backslash stands for itself. Without
    any of them Spark compares bytes and needs no pattern matching.
    """
    pattern = term.replace("\\", r"\\")
    return text.ilike(f"%{pattern}%")


def present(text: Column, longer_than: int = 0) -> Column:
    return text.isNotNull() & (F.length(text) > longer_than)


def strip_tags(text: Column) -> Column:
    return F.coalesce(F.regexp_replace(text, r"<[^>]+>", ""), F.lit(""))


def strip_chars(text: Column, chars: str) -> Column:
    return F.btrim(text, F.lit(chars))


def blank_if_missing(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def join_parts(parts: Column, separator: str = LIST_SEPARATOR) -> Column:
    """Join an array in its own order; a missing array joins to an empty text."""
    return F.coalesce(F.array_join(parts, separator), F.lit(""))


def title_preview(title: Column, length: int = 60) -> Column:
    return F.substring(title, 1, length)


def same_text(left: Column, right: Column) -> Column:
    """Equality after trimming, as for titles."""
    return F.trim(left) == F.trim(right)


def output_stem(file_name: Column) -> Column:
    """``x0001.xml.gz`` and ``x0001.parquet`` both become ``x0001``."""
    return F.regexp_replace(file_name, r"(\.xml)?(\.gz)?(\.parquet)?$", "")
