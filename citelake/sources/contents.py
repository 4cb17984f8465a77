"""What each write put into a table: records by batch, input file, outcome and year.

Every write is a batch, and the names of its files begin with the batch's. The lines of a batch are added
once its rows are in place, from its own files, so they also say which batches are whole: files of a batch
without lines were left by a write that broke off. Lines are added up; where files are replaced, what they
held is entered again with a minus. Counts by year or file therefore read no records.

The folder's name keeps it out of the table's own scans.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.schema import LINEAGE_COLUMN, PARTITION_COLUMN
from citelake.sources.tables import ACCEPTED, OUTCOME_COLUMN, stored_rows

CONTENTS_FOLDER = "_contents"
KEYS = [OUTCOME_COLUMN, PARTITION_COLUMN]
CONTENTS_SCHEMA = (
    f"batch string, {LINEAGE_COLUMN} string, {OUTCOME_COLUMN} string, {PARTITION_COLUMN} int, records bigint"
)
# The start of Spark's own file names: a table that was written without batches is one batch.
UNNAMED_BATCH = "part"


def new_batch() -> str:
    return f"b{uuid.uuid4().hex}"


def batch_of(file_name: Column) -> Column:
    return F.substring_index(file_name, "-", 1)


def rows_of_batch(spark: SparkSession, root: str, batch: str) -> DataFrame:
    """Stored rows of one batch; no other file is opened."""
    return stored_rows(spark, root, f"{batch}-*")


def counted(rows: DataFrame, batch: Column, sign: int = 1) -> DataFrame:
    """Stored rows as lines of the contents."""
    return (
        rows.groupBy(batch.alias("batch"), LINEAGE_COLUMN, *KEYS)
        .agg(F.count("*").alias("records"))
        .withColumn("records", F.col("records") * sign)
    )


def add_lines(lines: DataFrame, root: str) -> None:
    """One file, so that a batch has all of its lines or none."""
    lines.coalesce(1).write.mode("append").parquet(f"{root}/{CONTENTS_FOLDER}")


def record_batch(spark: SparkSession, root: str, batch: str) -> None:
    add_lines(counted(rows_of_batch(spark, root, batch), F.lit(batch)), root)


def contents_lines(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(CONTENTS_SCHEMA).parquet(f"{root}/{CONTENTS_FOLDER}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CONTENTS_SCHEMA)


def read_contents(spark: SparkSession, root: str) -> DataFrame:
    """``batch``, ``src``, ``outcome``, ``pub_year`` and ``records`` of what the table holds now."""
    lines = contents_lines(spark, root).groupBy("batch", LINEAGE_COLUMN, *KEYS)
    return lines.agg(F.sum("records").alias("records")).filter("records != 0")


def year_totals(spark: SparkSession, root: str) -> DataFrame:
    """``pub_year`` and ``records``: the accepted records of each year, from the lines alone."""
    held = read_contents(spark, root).filter(F.col(OUTCOME_COLUMN) == ACCEPTED)
    return held.groupBy(PARTITION_COLUMN).agg(F.sum("records").alias("records"))
