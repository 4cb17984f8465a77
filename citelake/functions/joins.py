"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys (of eight bytes, say) that may be sent to every task.
BROADCAST_ROWS = 100_000
# A key with more rows than this is spread over several tasks.
CROWDED_ROWS = 1_000_000


def look_up(
    rows: DataFrame, unique: DataFrame, key: str, crowded_rows: int = CROWDED_ROWS
) -> DataFrame:
    """Left join of ``rows`` to a side with one row per key.

    Keys that are crowded in ``rows`` are counted out first. Their rows are dealt out over as many
    parts as they need and the one row on the other side is copied to each part; all other keys
    have one part. The part comes from a hash of the row, so that a task run again deals its rows the
    same way. Adaptive execution broadcasts the list of crowded keys if it turns out short.
    """
    crowded = (
        rows.groupBy(key)
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > crowded_rows)
        .select(key, F.ceil(F.col("_rows") / crowded_rows).alias("_parts"))
    )
    parts = F.coalesce("_parts", F.lit(1))
    dealt = rows.join(crowded, key, "left").withColumn(
        "_part", F.pmod(F.xxhash64(*rows.columns), parts)
    )
    copied = unique.join(crowded, key, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))
    )
    return dealt.drop("_parts").join(copied.drop("_parts"), [key, "_part"], "left").drop("_part")


def few_rows(rows: DataFrame, bound: int = BROADCAST_ROWS) -> bool:
    """Whether there are at most ``bound`` rows; stops counting beyond it."""
    return rows.limit(bound + 1).count() <= bound
