"""Which inputs exist, which are wanted and which are still to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.functions.text import output_stem
from citelake.schema import XML_SUFFIX
from citelake.sources.xml_files import file_number


def names_in_listing(listing: DataFrame, pattern: str, text: str = "value") -> DataFrame:
    """Distinct input names that match ``pattern`` in listing text, in order."""
    found = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"({pattern})"), F.lit(1)))
    return listing.select(found.alias("name")).distinct().orderBy("name")


def input_files(spark: SparkSession, path: str, glob: str = f"*{XML_SUFFIX}") -> DataFrame:
    """Name, path, size and time of the inputs; their contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(path)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("name"),
            "path",
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified"),
        )
    )


def has_suffix(name: Column, suffix: str = ".gz") -> Column:
    return name.endswith(suffix)


def from_number(inputs: DataFrame, first: int, name: str = "name") -> DataFrame:
    """Inputs whose file number is at least ``first``."""
    return inputs.filter(file_number(F.col(name)) >= first)


def pending_inputs(
    inputs: DataFrame, done: DataFrame, name: str = "name", done_name: str = "name"
) -> DataFrame:
    """Inputs without an output of the same stem."""
    finished = done.select(output_stem(F.col(done_name)).alias("_stem"))
    return (
        inputs.withColumn("_stem", output_stem(F.col(name)))
        .join(finished, "_stem", "left_anti")
        .drop("_stem")
    )
