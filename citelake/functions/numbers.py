"""Tolerant integer parsing and the year/date rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

_TYPES = {"int": IntegerType(), "bigint": LongType()}


def tolerant_int(text: Column, kind: str = "int") -> Column:
    """Null where the text is no integer; blanks around the digits are accepted."""
    return text.try_cast(_TYPES[kind])


def digits_only(text: Column, kind: str = "int") -> Column:
    """Null unless the text is nothing but ASCII digits."""
    return F.when(text.rlike(r"\A[0-9]+\z"), text.try_cast(_TYPES[kind]))


def leading_year(text: Column) -> Column:
    """The first four characters as a year, null unless all four are digits."""
    return F.regexp_extract(text, r"\A([0-9]{4})", 1).try_cast(IntegerType())


def date_text(year: Column, month: Column, day: Column) -> Column:
    """``Y-M-D`` without padding; no year gives an empty text, no month or day gives ``01``."""
    return F.when(
        year != "",
        F.concat_ws("-", year, F.coalesce(month, F.lit("01")), F.coalesce(day, F.lit("01"))),
    ).otherwise("")


def partition_year(year: Column) -> Column:
    return F.coalesce(year, F.lit(0))
