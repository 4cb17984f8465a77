"""Which inputs are in a table, written after their rows are.

The folder's name keeps it out of the table's own scans. A file that has rows in the table but no line
here was interrupted half-way, and is done again; a file without records has a line and is not.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.schema import LINEAGE_COLUMN, MANIFEST_FOLDER, MANIFEST_SCHEMA
from citelake.sources.contents import contents_lines
from citelake.sources.inputs import pending_inputs
from citelake.sources.tables import ACCEPTED, OUTCOME_COLUMN, REJECTED


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """``name``, ``bytes``, ``modified``, ``accepted``, ``rejected`` of each input that was gone through,
    and the ``error`` of those that could not be read."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/{MANIFEST_FOLDER}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def record_finished(inputs: DataFrame, root: str, batch: str) -> None:
    """Add a line for each of ``inputs`` (name, bytes, modified), with what ``batch`` holds of it.

    The figures come from the batch's lines in the contents; no record is read.
    """
    spark = inputs.sparkSession
    held = contents_lines(spark, root).filter(F.col("batch") == batch)

    def of(outcome: str) -> Column:
        return F.sum(F.when(F.col(OUTCOME_COLUMN) == outcome, F.col("records")).otherwise(0))

    counts = held.groupBy(F.col(LINEAGE_COLUMN).alias("name")).agg(
        of(ACCEPTED).alias("accepted"), of(REJECTED).alias("rejected")
    )
    lines = inputs.select("name", "bytes", "modified").join(counts, "name", "left")
    lines = lines.fillna(0, ["accepted", "rejected"]).withColumn("error", F.lit(None).cast("string"))
    lines.coalesce(1).write.mode("append").parquet(f"{root}/{MANIFEST_FOLDER}")


def record_damaged(inputs: DataFrame, root: str) -> None:
    """Add a line for each of ``inputs`` (name, bytes, modified, error), which the table holds nothing of."""
    nothing = F.lit(0).cast("bigint")
    lines = inputs.select(
        "name", "bytes", "modified", nothing.alias("accepted"), nothing.alias("rejected"), "error"
    )
    lines.coalesce(1).write.mode("append").parquet(f"{root}/{MANIFEST_FOLDER}")


def waiting_inputs(inputs: DataFrame, manifest: DataFrame) -> DataFrame:
    """``inputs`` (name, bytes, modified) that are not finished.

    A damaged file is passed over as long as it is the one that could not be read; another of its name
    is taken up.
    """
    finished = manifest.filter("error IS NULL")
    damaged = manifest.filter("error IS NOT NULL").select("name", "bytes", "modified")
    return pending_inputs(inputs, finished).join(damaged, ["name", "bytes", "modified"], "left_anti")
