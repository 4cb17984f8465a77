"""Which file holds which id: a side table sorted by id, so that a lookup opens few files.

The index has a row (id, year's directory and file) for each record, dealt to ``BUCKETS`` directories by id and sorted by id
inside each, so a lookup opens the files of one directory and of those only the row groups that may hold
the id. It is added to by batch. A batch's files never change: what the index says of a file stays right as
long as the file is there, and files of batches not indexed yet are searched besides. So it may lag behind a
table and still be used, and replaced files need no entry in it.

The folder's name keeps it out of the table's own scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.schema import LINEAGE_COLUMN, PARTITION_COLUMN, TABLE_COLUMNS
from citelake.sources.contents import batch_of, read_contents
from citelake.sources.tables import ACCEPTED, OUTCOME_COLUMN, read_table, stored_rows

INDEX_FOLDER = "_ids"
BUCKETS = 64
ROWS_SCHEMA = "PMID bigint, place string, bucket int"
BATCHES_SCHEMA = "batch string"


def bucket_of(identifier: Column) -> Column:
    return F.pmod(identifier, F.lit(BUCKETS)).cast("int")


def place_of(file_path: Column) -> Column:
    """A file's directory and name; a task gives its files in all directories the same name."""
    return F.substring_index(file_path, "/", -2)


def indexed_batches(spark: SparkSession, root: str) -> list[str]:
    """The batches whose records are in the index; a name for each write of the table."""
    try:
        found = spark.read.schema(BATCHES_SCHEMA).parquet(f"{root}/{INDEX_FOLDER}/batches")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(row.batch for row in found.distinct().collect())


def index_ids(spark: SparkSession, root: str) -> list[str]:
    """Add the table's batches that the index lacks; returns their names.

    Only the id column of those batches is read. Batches are named after their rows are in place; rows of
    a batch that a lost driver left unnamed come twice, which no lookup notices.
    """
    known = indexed_batches(spark, root)
    held = read_contents(spark, root).filter(F.col(OUTCOME_COLUMN) == ACCEPTED)
    new = sorted(row.batch for row in held.select("batch").distinct().collect() if row.batch not in known)
    if not new:
        return []
    rows = (
        stored_rows(spark, root)
        .filter((F.col(OUTCOME_COLUMN) == ACCEPTED) & batch_of(F.col("_metadata.file_name")).isin(new))
        .select(
            "PMID",
            place_of(F.col("_metadata.file_path")).alias("place"),
            bucket_of(F.col("PMID")).alias("bucket"),
        )
    )
    (
        rows.repartitionByRange("bucket", "PMID")
        .sortWithinPartitions("bucket", "PMID")
        .write.mode("append")
        .partitionBy("bucket")
        .parquet(f"{root}/{INDEX_FOLDER}/rows")
    )
    names = spark.createDataFrame([(batch,) for batch in new], BATCHES_SCHEMA)
    names.coalesce(1).write.mode("append").parquet(f"{root}/{INDEX_FOLDER}/batches")
    return new


def find_ids(spark: SparkSession, root: str, ids: Sequence[int]) -> DataFrame:
    """The records of ``ids``, with the columns of ``read_table``.

    The files that the index names, at most as many as there are records of these ids, and those of batches
    that it lacks are opened. Their names reach the driver, as the ids came from it.
    """
    wanted = sorted(set(ids))
    table = read_table(spark, root)
    if not wanted:
        return table.limit(0)
    batches = indexed_batches(spark, root)
    if not batches:
        return table.filter(F.col("PMID").isin(wanted))
    rows = spark.read.schema(ROWS_SCHEMA).parquet(f"{root}/{INDEX_FOLDER}/rows")
    buckets = sorted({identifier % BUCKETS for identifier in wanted})
    found = rows.filter(F.col("bucket").isin(buckets) & F.col("PMID").isin(wanted))
    places = [row.place for row in found.select("place").distinct().collect()]
    named = place_of(F.col("_metadata.file_path")).isin(places) if places else F.lit(False)
    return (
        stored_rows(spark, root)
        .filter(F.col(OUTCOME_COLUMN) == ACCEPTED)
        .filter(named | ~batch_of(F.col("_metadata.file_name")).isin(batches))
        .filter(F.col("PMID").isin(wanted))
        .select(*TABLE_COLUMNS, LINEAGE_COLUMN, PARTITION_COLUMN)
    )
