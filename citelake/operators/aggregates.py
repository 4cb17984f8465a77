"""Counts over the citation table, its inputs and its rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citelake.functions.numbers import partition_year
from citelake.functions.text import present
from citelake.operators.search import in_years
from citelake.schema import LINEAGE_COLUMN, PARTITION_COLUMN, SCHEMA_VERSION


def total_records(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("total_records"))


def year_counts(table: DataFrame, year: str = "Year") -> DataFrame:
    return table.groupBy(year).agg(F.count("*").alias("records")).orderBy(year)


def recent_years(table: DataFrame, years: int = 10, year: str = "Year") -> DataFrame:
    """The last ``years`` years that occur, ascending."""
    counts = table.groupBy(year).agg(F.count("*").alias("records"))
    return counts.orderBy(F.desc(year)).limit(years).orderBy(year)


def file_year_counts(table: DataFrame) -> DataFrame:
    """Records per file and year, per file, and in all, in one job.

    ``level`` is 0 for file and year, 1 for a file, 3 for everything. Rows are counted once; only
    the counts are rolled up.
    """
    counts = table.groupBy(LINEAGE_COLUMN, _bucket(table).alias("bucket")).agg(
        F.count("*").alias("n")
    )
    return counts.rollup(LINEAGE_COLUMN, "bucket").agg(
        F.grouping_id().cast("int").alias("level"), F.sum("n").alias("records")
    )


def file_counts(table: DataFrame) -> DataFrame:
    return table.groupBy(LINEAGE_COLUMN).agg(F.count("*").alias("records"))


def fill_rates(table: DataFrame, *columns: str) -> DataFrame:
    """Per column: rows, rows with text, and their percentage; all columns in one pass."""
    measures = [F.count("*").alias("total")]
    measures += [F.count(F.when(present(F.col(c)), 1)).alias(f"with_{c}") for c in columns]
    entries = ", ".join(f"'{c}', `with_{c}`" for c in columns)
    return (
        table.agg(*measures)
        .selectExpr("total", f"stack({len(columns)}, {entries}) AS (field, filled)")
        .select("field", "total", "filled", percentage(F.col("filled"), F.col("total")))
    )


def percentage(part: Column, whole: Column, name: str = "percent") -> Column:
    return (F.try_divide(part.cast("double"), whole) * 100).alias(name)


def year_coverage(
    table: DataFrame, low: int = 1950, high: int = 2025, needed: Sequence[int] = (1990, 2024)
) -> DataFrame:
    """How many years of a range occur, and whether all needed ones are among them.

    The set gathered on the way holds the years of the range at most.
    """
    found = in_years(table, low, high).agg(F.collect_set("Year").alias("found"))
    common = F.array_intersect("found", F.array(*[F.lit(year) for year in needed]))
    return found.select(
        F.size("found").alias("years"), (F.size(common) == len(set(needed))).alias("has_needed")
    )


def reject_tally(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy(LINEAGE_COLUMN, "reason").agg(F.count("*").alias("records"))


def build_metadata(
    table: DataFrame,
    source: str,
    baseline_date: str | None = None,
    schema_version: str = SCHEMA_VERSION,
) -> DataFrame:
    """One row: total, records per year (as text, 0 where there is none), and the build's labels.

    Taken from the table, so a resumed build describes all of it.
    """
    counts = table.groupBy(_bucket(table).alias(PARTITION_COLUMN)).agg(F.count("*").alias("records"))
    return metadata_of_totals(counts, source, baseline_date, schema_version)


def metadata_of_totals(
    totals: DataFrame,
    source: str,
    baseline_date: str | None = None,
    schema_version: str = SCHEMA_VERSION,
) -> DataFrame:
    """The same row from ``pub_year`` and ``records``; the map that is gathered has an entry per year."""
    counts = totals.select(F.col(PARTITION_COLUMN).alias("bucket"), F.col("records").alias("n"))
    years = F.transform(
        F.array_sort(F.collect_list(F.struct("bucket", "n"))),
        lambda entry: F.struct(entry["bucket"].cast("string"), entry["n"]),
    )
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.map_from_entries(years).alias("year_distribution"),
    ).select(
        "*",
        F.lit(schema_version).alias("schema_version"),
        F.lit(source).alias("source"),
        F.lit(baseline_date).cast("string").alias("baseline_date"),
    )


def build_progress(
    inputs: DataFrame,
    outputs: DataFrame,
    failures: DataFrame,
    now: Column | None = None,
    finished: str = "modified",
) -> DataFrame:
    """One row of progress figures from an input, an output and a failure listing.

    ``elapsed`` counts seconds since the first output; ``doc_min`` is outputs per minute and
    ``est_hrs`` the hours left at that pace.
    """
    no_time = F.lit(None).cast("timestamp").alias("at")
    events = (
        inputs.select(F.lit("input").alias("kind"), no_time)
        .unionByName(outputs.select(F.lit("output").alias("kind"), F.col(finished).alias("at")))
        .unionByName(failures.select(F.lit("failure").alias("kind"), no_time))
    )

    def tally(kind: str) -> Column:
        return F.count(F.when(F.col("kind") == kind, 1))

    moment = F.current_timestamp() if now is None else now
    counts = events.agg(
        (F.unix_timestamp(moment) - F.unix_timestamp(F.min("at"))).alias("elapsed"),
        (tally("input") - tally("output")).alias("doc_rem"),
        tally("output").alias("doc_don"),
        tally("failure").alias("failure"),
    )
    minutes_each = F.try_divide(F.col("elapsed"), F.col("doc_don")) / 60
    return counts.select(
        "elapsed",
        "doc_rem",
        "doc_don",
        "failure",
        F.round(F.try_divide(F.lit(1.0), minutes_each), 2).alias("doc_min"),
        F.round(F.col("doc_rem") * minutes_each / 60, 2).alias("est_hrs"),
    )


def _bucket(table: DataFrame) -> Column:
    if PARTITION_COLUMN in table.columns:
        return F.col(PARTITION_COLUMN)
    return partition_year(F.col("Year"))
