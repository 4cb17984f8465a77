"""Search predicates and queries on the citation table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citelake.functions.text import contains_term
from citelake.schema import PARTITION_COLUMN

DEFAULT_COLUMNS = ("PMID", "Title", "Year", "DOI")


def title_has(term: str) -> Column:
    return contains_term(F.col("Title"), term)


def title_or_abstract_has(term: str) -> Column:
    return contains_term(F.col("Title"), term) | contains_term(F.col("Abstract"), term)


def subject_has(term: str) -> Column:
    return contains_term(F.col("MeSH_Terms"), term)


def has_id(*ids: int) -> Column:
    return F.col("PMID") == ids[0] if len(ids) == 1 else F.col("PMID").isin(list(ids))


def year_is_known() -> Column:
    return F.col("Year").isNotNull()


def in_years(table: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """Rows with ``low <= Year <= high``, either bound optional.

    A row that satisfies a bound has a year, so its partition value equals that year and the same
    bound holds there; adding it lets Spark skip directories. The bound on ``Year`` itself stays,
    because partition 0 also holds the rows without a year.
    """
    columns = ["Year"] + [c for c in (PARTITION_COLUMN,) if c in table.columns]
    for column in columns:
        if low is not None and low == high:
            table = table.filter(F.col(column) == low)
            continue
        if low is not None:
            table = table.filter(F.col(column) >= low)
        if high is not None:
            table = table.filter(F.col(column) <= high)
    return table


def without_year(table: DataFrame) -> DataFrame:
    table = table.filter(F.col("Year").isNull())
    if PARTITION_COLUMN in table.columns:
        table = table.filter(F.col(PARTITION_COLUMN) == 0)
    return table


def search(
    table: DataFrame,
    *,
    title: str | None = None,
    text: str | None = None,
    subject: str | None = None,
    ids: Iterable[int] | None = None,
    year_from: int | None = None,
    year_to: int | None = None,
    columns: Iterable[str] = DEFAULT_COLUMNS,
    order_by: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Any combination of the predicates; ``text`` looks in title and abstract.

    A limit without an order returns any rows and stops reading early; with one, each task keeps
    only its best ``limit`` rows.
    """
    found = in_years(table, year_from, year_to)
    if title is not None:
        found = found.filter(title_has(title))
    if text is not None:
        found = found.filter(title_or_abstract_has(text))
    if subject is not None:
        found = found.filter(subject_has(subject))
    if ids is not None:
        found = found.filter(has_id(*ids))
    found = found.select(*columns)
    if order_by is not None:
        found = found.orderBy(order_by)
    return found if limit is None else found.limit(limit)


def count_rows(table: DataFrame, name: str = "records") -> DataFrame:
    return table.agg(F.count("*").alias(name))
