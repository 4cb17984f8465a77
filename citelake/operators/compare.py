"""Comparing records with an authoritative copy of the same ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citelake.functions.joins import BROADCAST_ROWS, CROWDED_ROWS, look_up
from citelake.functions.text import blank_if_missing, same_text, strip_tags
from citelake.operators.sampling import repeatable_sample, well_described


def compare_records(
    records: DataFrame, authority: DataFrame, crowded_rows: int = CROWDED_ROWS
) -> DataFrame:
    """Per record: found, title and DOI agreement, and ``matched`` for both.

    Titles agree after trimming, also when the authoritative one has markup that the record lacks;
    a missing DOI equals an empty one. The authority is first reduced to one row per id (the least
    title and DOI, should it hold several), before its rows are shuffled. Id 0 stands for "no id"
    and is never looked up.
    """
    reference = (
        authority.filter(F.col("PMID") != 0)
        .groupBy("PMID")
        .agg(F.min(F.struct("Title", "DOI")).alias("_reference"))
    )
    title, doi = F.col("_reference.Title"), F.col("_reference.DOI")
    agree = same_text(F.col("Title"), title) | same_text(F.col("Title"), strip_tags(title))
    return (
        look_up(records.select("PMID", "Title", "DOI"), reference, "PMID", crowded_rows)
        .select(
            "PMID",
            F.col("_reference").isNotNull().alias("found"),
            F.coalesce(agree, F.lit(False)).alias("title_match"),
            (
                F.col("_reference").isNotNull()
                & (blank_if_missing(F.col("DOI")) == blank_if_missing(doi))
            ).alias("doi_match"),
        )
        .withColumn("matched", F.col("title_match") & F.col("doi_match"))
    )


def compare_sample(
    records: DataFrame, authority: DataFrame, size: int = 3, seed: str = "0"
) -> DataFrame:
    """Compare a repeatable sample of well-described records.

    The sample is needed in two places; drawn twice it is the same.
    """
    sample = repeatable_sample(well_described(records), size, seed).select("PMID", "Title", "DOI")
    ids = sample.select("PMID")
    if size <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    wanted = authority.select("PMID", "Title", "DOI").join(ids, "PMID", "left_semi")
    return compare_records(sample, wanted)


def match_summary(compared: DataFrame, min_ratio: float = 2 / 3) -> DataFrame:
    ratio = F.try_divide(F.col("matches").cast("double"), F.col("compared"))
    return (
        compared.agg(
            F.count("*").alias("compared"), F.count(F.when(F.col("matched"), 1)).alias("matches")
        )
        .withColumn("ratio", ratio)
        .withColumn("passed", F.coalesce(F.col("ratio") >= min_ratio, F.lit(False)))
    )
