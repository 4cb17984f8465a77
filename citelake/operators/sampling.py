"""Random samples of a fixed size; each task holds no more than the sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citelake.functions.text import present


def random_sample(table: DataFrame, size: int, seed: int | None = None) -> DataFrame:
    return table.orderBy(F.rand(seed)).limit(size)


def repeatable_sample(table: DataFrame, size: int, seed: str = "0", key: str = "PMID") -> DataFrame:
    """The same rows on every run and every engine: ordered by a digest of key and seed."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))
    return table.orderBy(digest, key).limit(size)


def well_described(table: DataFrame, min_title: int = 20) -> DataFrame:
    """Records fit for comparison: a title longer than ``min_title`` and a DOI that is not null."""
    return table.filter(present(F.col("Title"), min_title) & F.col("DOI").isNotNull())
