"""Checks a finished table has to pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.functions.joins import few_rows
from citelake.functions.text import present, title_preview
from citelake.operators.aggregates import percentage
from citelake.operators.search import in_years, search, title_has
from citelake.schema import TABLE_COLUMNS


def missing_columns(table: DataFrame, required: Sequence[str] = TABLE_COLUMNS) -> list[str]:
    return sorted(set(required) - set(table.columns))


def has_integer_type(table: DataFrame, column: str) -> bool:
    return isinstance(table.schema[column].dataType, (T.IntegerType, T.LongType))


def column_types(table: DataFrame) -> DataFrame:
    """Name and type of the identifier and the year, from one row that has a year."""
    return (
        table.filter(F.col("Year").isNotNull())
        .limit(1)
        .select(F.typeof("PMID").alias("pmid_type"), F.typeof("Year").alias("year_type"))
    )


def known_records(table: DataFrame, expected: DataFrame) -> DataFrame:
    """Each expected id with whether it is there and has a title.

    A short list of ids goes to the table's rows, which stay where they are; a long one meets the
    table in a join by id. Either way a crowded id is merged before its rows are shuffled. An id held
    several times shows one of its records: that of the latest year, then the last title.
    """
    ids = expected.select("PMID").distinct()
    wanted = table.select("PMID", "Title", "Year")
    few = F.broadcast(ids) if few_rows(ids) else ids
    best = F.max(F.struct("Year", "Title")).alias("_best")
    found = wanted.join(few, "PMID", "left_semi").groupBy("PMID").agg(best)
    found = found.select(
        "PMID", F.col("_best.Title").alias("Title"), F.col("_best.Year").alias("Year"), F.lit(True).alias("_found")
    )
    return ids.join(found, "PMID", "left").select(
        "PMID",
        F.coalesce("_found", F.lit(False)).alias("found"),
        F.coalesce(present(F.col("Title")), F.lit(False)).alias("titled"),
        title_preview(F.col("Title")).alias("preview"),
        "Year",
    )


def limited_search(table: DataFrame, term: str, year_from: int, limit: int = 10) -> DataFrame:
    """How many rows a limited title-or-abstract search returns and whether all are in its years."""
    found = search(table, text=term, year_from=year_from, limit=limit)
    return found.agg(
        F.count("*").alias("records"),
        F.coalesce(F.min("Year") >= year_from, F.lit(False)).alias("all_recent"),
    )


def out_of_range_years(table: DataFrame, latest: int) -> DataFrame:
    """Years after ``latest``; they are kept in the table and only reported."""
    return (
        in_years(table, low=latest + 1)
        .groupBy("Year")
        .agg(F.count("*").alias("records"))
        .orderBy("Year")
    )


def quality_report(
    table: DataFrame,
    *,
    min_records: int,
    known_ids: Sequence[int],
    term: str,
    min_term_hits: int,
    year_range: tuple[int, int] = (1950, 2025),
    min_years: int = 50,
    needed_years: Sequence[int] = (1990, 2024),
    min_title_percent: float = 95.0,
) -> DataFrame:
    """One row per check: what was measured, what is asked for, and whether it passed.

    All figures come from a single aggregation; the sets gathered on the way are bounded by the
    range of years and the number of known ids.
    """
    low, high = year_range
    year = F.when(F.col("Year").between(low, high), F.col("Year"))
    known = F.when(F.col("PMID").isin(*known_ids) & present(F.col("Title")), F.col("PMID"))
    figures = table.agg(
        F.count("*").alias("records"),
        F.collect_set(year).alias("years"),
        F.count(F.when(present(F.col("Title")), 1)).alias("titled"),
        F.size(F.collect_set(known)).alias("known"),
        F.count(F.when(title_has(term), 1)).alias("hits"),
    )
    present_years = F.size(F.array_intersect("years", F.array(*map(F.lit, needed_years))))
    title_share = F.coalesce(percentage(F.col("titled"), F.col("records")), F.lit(0.0))
    integers = sum(has_integer_type(table, c) for c in ("PMID", "Year"))
    checks = [
        _check("columns", F.lit(len(TABLE_COLUMNS) - len(missing_columns(table))), 13),
        _check("integer_types", F.lit(integers), 2),
        _check("records", F.col("records"), min_records),
        _check("years", F.size("years"), min_years),
        _check("needed_years", present_years, len(set(needed_years))),
        _check("title_percent", title_share, min_title_percent),
        _check("known_ids", F.col("known"), len(set(known_ids))),
        _check("term_hits", F.col("hits"), min_term_hits),
    ]
    return figures.select(F.inline(F.array(*checks))).withColumn(
        "passed", F.col("measured") >= F.col("required")
    )


def _check(name: str, measured: Column, required: float) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        measured.cast("double").alias("measured"),
        F.lit(float(required)).alias("required"),
    )
