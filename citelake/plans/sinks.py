"""Writing tables, documents, rejects and metadata."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.functions.numbers import partition_year
from citelake.plans.swaps import Swap, apply_swap, data_files, delete, redo_swaps
from citelake.schema import LINEAGE_COLUMN, PARTITION_COLUMN, REJECT_SCHEMA, TABLE_COLUMNS
from citelake.sources.contents import (
    KEYS,
    UNNAMED_BATCH,
    batch_of,
    contents_lines,
    new_batch,
    read_contents,
    record_batch,
)
from citelake.sources.tables import ACCEPTED, OUTCOME_COLUMN, REJECTED, stored_rows

NO_DATA = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def write_table(
    extracted: DataFrame,
    root: str,
    mode: str = "overwrite",
    compression: str = "snappy",
    max_records_per_file: int = 0,
    mended: bool = False,
) -> str:
    """Write extracted records and their rejects in one pass over the input; returns the batch's name.

    The outcome is the outer directory, so accepted and rejected rows part ways without parsing
    twice. One shuffle brings a year together; adaptive execution cuts the crowded years into
    several tasks and merges the sparse ones, which keeps file sizes even. Rows are sorted by id
    inside a year (the write has to sort by directory anyway), so an id lookup can skip row groups.

    ``mode`` "years" replaces the years that the new rows fall into. Earlier rows of the same ids in
    other years go as well, and so do earlier rejects of the same files; the rejects of other files stay.

    What an earlier write left half-way is mended first, unless the caller has done so (``mend``). A
    table has one writer at a time.
    """
    reason = F.col("reason") if "reason" in extracted.columns else F.lit(None).cast("string")
    raw = F.col("raw") if "raw" in extracted.columns else F.lit(None).cast("string")
    source = (
        F.col(LINEAGE_COLUMN)
        if LINEAGE_COLUMN in extracted.columns
        else F.lit(None).cast("string").alias(LINEAGE_COLUMN)
    )
    usable = reason.isNull()
    rows = extracted.select(
        *TABLE_COLUMNS,
        source,
        raw.alias("raw"),
        reason.alias("reason"),
        F.when(usable, ACCEPTED).otherwise(REJECTED).alias(OUTCOME_COLUMN),
        F.when(usable, partition_year(F.col("Year"))).otherwise(0).alias(PARTITION_COLUMN),
    )
    options = {"compression": compression, "maxRecordsPerFile": max_records_per_file}
    spark, batch = extracted.sparkSession, new_batch()
    if mode != "overwrite" and not mended:
        mend(spark, root)
    if mode == "years":
        _replace_years(rows, root, batch, options)
    else:
        _write(rows, root, batch, mode, options)
        record_batch(spark, root, batch)
    return batch


def mend(spark: SparkSession, root: str) -> None:
    """Finish or undo what a lost driver left in a table; names of files are all that is looked at.

    Replacements that were begun are carried through, and files of batches that were never recorded
    go, whose rows their writer has not reported. Rows of a table written before there were batches are
    recorded once.
    """
    redo_swaps(spark, root)
    files = data_files(spark, root)
    if files is None:
        return
    files = files.select("path", batch_of(F.col("name")).alias("batch"))
    unknown = files.join(contents_lines(spark, root).select("batch").distinct(), "batch", "left_anti")
    named = F.col("batch").rlike("^b[0-9a-f]{32}$")
    left = [row.path for row in unknown.filter(named).select("path").collect()]
    if not unknown.filter(F.col("batch") == UNNAMED_BATCH).isEmpty():
        record_batch(spark, root, UNNAMED_BATCH)
    delete(spark, left)


def _replace_years(rows: DataFrame, root: str, batch: str, options: dict) -> None:
    spark, swap = rows.sparkSession, Swap(root, batch)
    _write(rows, swap.staged, batch, "overwrite", options)
    new = stored_rows(spark, swap.staged)
    accepted = new.filter(F.col(OUTCOME_COLUMN) == ACCEPTED)
    years = sorted(row[0] for row in accepted.select(PARTITION_COLUMN).distinct().collect())
    try:
        old = _with_paths(stored_rows(spark, root))
    except AnalysisException as error:
        if error.getCondition() not in NO_DATA:
            raise
        old = _with_paths(stored_rows(spark, swap.staged)).limit(0)
    kept_years = (F.col(OUTCOME_COLUMN) == ACCEPTED) & ~F.col(PARTITION_COLUMN).isin(years)
    ids = accepted.filter("PMID != 0").select("PMID").distinct()
    sources = new.select(LINEAGE_COLUMN).distinct()
    moved = _paths(old.filter(kept_years).join(ids, "PMID", "left_semi"))
    again = _paths(
        old.filter(F.col(OUTCOME_COLUMN) == REJECTED).join(sources, LINEAGE_COLUMN, "left_semi")
    )
    replaced = _paths(old.filter((F.col(OUTCOME_COLUMN) == ACCEPTED) & F.col(PARTITION_COLUMN).isin(years)))
    touched = old.filter(F.col("_path").isin(moved + again))
    kept = (
        touched.filter(kept_years)
        .join(ids, "PMID", "left_anti")
        .unionByName(
            touched.filter(F.col(OUTCOME_COLUMN) == REJECTED).join(sources, LINEAGE_COLUMN, "left_anti")
        )
    )
    if moved or again:
        _write(kept.select(new.columns), swap.staged, batch, "append", options)
    apply_swap(spark, swap.begin(spark, sorted({*moved, *again, *replaced})))


def remove_files(spark: SparkSession, root: str, names: DataFrame) -> None:
    """Take out the rows that the table holds of the input files ``names`` (column ``name``).

    The contents say which batches and directories have any; only their files are opened, and those
    that hold such rows are written anew without them.
    """
    names = names.select(F.col("name").alias(LINEAGE_COLUMN)).distinct()
    held = read_contents(spark, root).join(F.broadcast(names), LINEAGE_COLUMN, "left_semi")
    places = held.select("batch", *KEYS).distinct().collect()
    if not places:
        return
    old = _with_paths(stored_rows(spark, root)).filter(
        batch_of(F.col("_metadata.file_name")).isin(sorted({p.batch for p in places}))
        & F.col(OUTCOME_COLUMN).isin(sorted({p[OUTCOME_COLUMN] for p in places}))
        & F.col(PARTITION_COLUMN).isin(sorted({p[PARTITION_COLUMN] for p in places}))
    )
    hit = _paths(old.join(F.broadcast(names), LINEAGE_COLUMN, "left_semi"))
    swap = Swap(root, new_batch())
    kept = old.filter(F.col("_path").isin(hit)).join(F.broadcast(names), LINEAGE_COLUMN, "left_anti")
    _write(kept.drop("_path"), swap.staged, swap.batch, "overwrite", {})
    apply_swap(spark, swap.begin(spark, hit))


def _with_paths(rows: DataFrame) -> DataFrame:
    return rows.select("*", F.col("_metadata.file_path").alias("_path"))


def _paths(rows: DataFrame) -> list[str]:
    """The files that rows are in."""
    return [row[0] for row in rows.select("_path").distinct().collect()]


def _write(rows: DataFrame, path: str, batch: str, mode: str, options: dict) -> None:
    writer = (
        rows.hint("rebalance", *KEYS)
        .sortWithinPartitions(*KEYS, "PMID")
        .write.mode(mode)
        .options(**options)
        .option("mapreduce.output.basename", batch)
        .partitionBy(*KEYS)
    )
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static")
    writer.parquet(path)


def write_documents(documents: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``(PMID, JSON)`` Parquet."""
    _usable(documents).select("PMID", "JSON").write.mode(mode).parquet(path)


def write_trees(trees: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``(pmid, json, src)`` Parquet."""
    _usable(trees).select("pmid", "json", LINEAGE_COLUMN).write.mode(mode).parquet(path)


def write_rejects(rejects: DataFrame, path: str, mode: str = "overwrite") -> None:
    rejects.filter(F.col("reason").isNotNull()).select(
        *REJECT_SCHEMA.fieldNames()
    ).write.mode(mode).parquet(path)


def write_metadata(metadata: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The one metadata row as a JSON document."""
    metadata.coalesce(1).write.mode(mode).json(path)


def _usable(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reason").isNull()) if "reason" in rows.columns else rows
