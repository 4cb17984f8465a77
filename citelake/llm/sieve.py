"""A bit array of fixed size that passes a set of hashes from one reading of the texts to the next.

What it lets through by chance must be told apart by what follows; nothing in the set is held back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIEVE_BITS = 27
SIEVE_ROW = 18


def sieve(leads: DataFrame) -> np.ndarray:
    """The bits of the hashes (bigint) in column ``lead``; their leading bits choose the place.

    They come to the driver in one job, not one for each partition. Whoever sends them on is to destroy
    the broadcast when it was read for the last time: its files, one on the driver and one on each
    executor, are as large as the bits and otherwise stay.
    """
    row_bits = SIEVE_BITS - SIEVE_ROW

    def place(group: pa.Table) -> pa.Table:
        bits = np.zeros(1 << SIEVE_ROW, dtype=np.uint8)
        leads = group.column("lead").to_numpy().view(np.uint64)
        bits[(leads >> np.uint64(64 - SIEVE_BITS)).astype(np.int64) & ((1 << SIEVE_ROW) - 1)] = 1
        return pa.table(
            {"row": group.column("row")[:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())}
        )

    rows = leads.select("lead", F.shiftrightunsigned("lead", 64 - row_bits).cast("int").alias("row"))
    total = np.zeros((1 << row_bits, (1 << SIEVE_ROW) // 8), dtype=np.uint8)
    placed = rows.groupBy("row").applyInArrow(place, "row int, bits binary").toArrow()
    for at, bits in zip(placed.column("row").to_pylist(), placed.column("bits"), strict=True):
        total[at] = np.frombuffer(bits.as_buffer(), dtype=np.uint8)
    return total.reshape(-1)


def passes(bits: np.ndarray, leads: np.ndarray) -> np.ndarray:
    at = (leads >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
