"""Bulk XML files as one row per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.schema import FILE_NUMBER_PATTERN, RECORD_TAG, XML_SUFFIX

RECORD_END = f"</{RECORD_TAG}>"
_RECORD_START = rf"<{RECORD_TAG}(?=[\s/>])"


def read_xml_records(
    spark: SparkSession,
    path: str | list[str],
    glob: str = f"*{XML_SUFFIX}",
    start_from: int | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Columns ``src`` (file name), ``raw`` (one record's XML) and ``closed``.

    The closing tag is the line separator, so files stream through and Spark decodes gzip itself.
    ``start_from`` keeps files numbered at least so; being a predicate on the file name only, it
    drops files before any is opened.

    Plain and bzip2 files are cut into tasks; a gzip file is read by one. Where a few large gzip
    files hold most records, ``spread`` deals the records out over that many tasks, at the price
    of a shuffle, so that parsing does not wait for the largest file.
    """
    chunks = (
        spark.read.option("lineSep", RECORD_END)
        .option("pathGlobFilter", glob)
        .text(path)
        .select("value", F.col("_metadata.file_name").alias("src"))
    )
    if start_from is not None:
        chunks = chunks.filter(file_number(F.col("src")) >= start_from)
    records = split_chunks(chunks)
    return records if spread is None else records.repartition(spread)


def split_chunks(chunks: DataFrame) -> DataFrame:
    """Turn ``(value, src)`` chunks that end at a closing tag into records.

    A chunk with several opening tags holds records that were never closed; they come out as rows
    with ``closed`` false instead of vanishing. Whatever stands before the first opening tag
    (file header, other top-level elements) is no record.
    """
    pieces = F.split("value", _RECORD_START)
    count = F.size(pieces)
    records = F.transform(
        F.slice(pieces, F.lit(2), count - 1),
        lambda piece, i: F.struct(
            F.concat(F.lit(f"<{RECORD_TAG}"), piece, F.lit(RECORD_END)).alias("raw"),
            (i == count - 2).alias("closed"),
        ),
    )
    return chunks.filter(F.contains("value", F.lit(f"<{RECORD_TAG}"))).select(
        "src", F.inline(records)
    )


def file_number(name: Column) -> Column:
    return F.regexp_extract(name, FILE_NUMBER_PATTERN, 1).try_cast("int")
