"""Reading the citation table, its rejects, and tables in the two other layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.schema import (
    DOCUMENT_SCHEMA,
    LINEAGE_COLUMN,
    PARTITION_COLUMN,
    REJECT_SCHEMA,
    TABLE_COLUMNS,
    TABLE_SCHEMA,
)

OUTCOME_COLUMN = "outcome"
ACCEPTED = "accepted"
REJECTED = "rejected"

_STORED = T.StructType(
    TABLE_SCHEMA.fields
    + REJECT_SCHEMA.fields
    + [
        T.StructField(OUTCOME_COLUMN, T.StringType()),
        T.StructField(PARTITION_COLUMN, T.IntegerType()),
    ]
)


def records_path(root: str) -> str:
    """The folder that holds records and nothing else, for any engine's ``**/*.parquet``."""
    return f"{root.rstrip('/')}/{OUTCOME_COLUMN}={ACCEPTED}"


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The table columns plus ``src`` and the partition column ``pub_year``."""
    return (
        stored_rows(spark, root)
        .filter(F.col(OUTCOME_COLUMN) == ACCEPTED)
        .select(*TABLE_COLUMNS, LINEAGE_COLUMN, PARTITION_COLUMN)
    )


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    return (
        stored_rows(spark, root)
        .filter(F.col(OUTCOME_COLUMN) == REJECTED)
        .select(*REJECT_SCHEMA.fieldNames())
    )


def read_year_layout(spark: SparkSession, root: str) -> DataFrame:
    """A table laid out as ``year=<n>/<input>.parquet``.

    Reading it as partitioned would replace the stored ``Year`` by the directory's value and lose
    its nulls. The files are therefore read as they are, and ``pub_year`` is taken from their
    path; Spark applies a filter on it to the file list, so other years are not opened.
    """
    return (
        spark.read.schema(TABLE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(root)
        .select(
            "*",
            F.regexp_extract("_metadata.file_path", r"/year=(-?\d+)/", 1)
            .try_cast(T.IntegerType())
            .alias(PARTITION_COLUMN),
            F.col("_metadata.file_name").alias(LINEAGE_COLUMN),
        )
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The older ``(PMID, JSON)`` form, with the file name as ``src``."""
    return (
        spark.read.schema(DOCUMENT_SCHEMA)
        .option("pathGlobFilter", "*.parquet")
        .parquet(path)
        .select("PMID", "JSON", F.col("_metadata.file_name").alias(LINEAGE_COLUMN))
    )


def pruned_by_year(table: DataFrame) -> DataFrame:
    """The same rows, on which a filter on ``Year`` alone skips directories.

    Outside partition 0 the directory's value is the year, and taking it from there makes the
    filter one on directories. Partition 0 also holds the rows without a year and keeps the stored
    value.
    """
    dated = table.filter(F.col(PARTITION_COLUMN) != 0)
    undated = table.filter(F.col(PARTITION_COLUMN) == 0)
    return dated.withColumn("Year", F.col(PARTITION_COLUMN)).unionByName(undated)


def register(table: DataFrame, name: str = "citations") -> None:
    """Make the table available to ``spark.sql``, where filters on ``Year`` prune."""
    pruned_by_year(table).createOrReplaceTempView(name)


def stored_rows(spark: SparkSession, root: str, names: str = "*") -> DataFrame:
    """Accepted and rejected rows as they are stored, in files whose names match."""
    return spark.read.schema(_STORED).option("pathGlobFilter", names).parquet(root)
