"""Packing by power-of-two decomposition (operator 8).

A document's ids, with the end id behind them, are cut into as many pieces of ``length`` ids as
there are, and the rest by its binary digits, largest first. Every piece is a sequence of its own:
none crosses documents, none is padded, and sequences of one length make a bucket that a loader can
draw batches from.

Defined results: a null or empty text is the end id alone; repeated rows are packed once per row; an
empty table gives no pieces; columns other than the key are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.llm.token_ids import encode_column, encoder

LENGTH = 1024
END_ID = 0
PIECE = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def piece_lengths(counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The lengths of all values' pieces in order, and how many each value has."""
    full, rest = counts // length, counts % length
    digits = length >> np.arange(1, length.bit_length())
    held = (rest[:, None] & digits[None, :]) > 0
    pieces = full + held.sum(axis=1)
    sizes = np.full(int(pieces.sum()), length, dtype=np.int64)
    first = np.cumsum(pieces) - pieces
    row, digit = np.nonzero(held)
    nth = (np.cumsum(held, axis=1) - 1)[row, digit]
    sizes[first[row] + full[row] + nth] = digits[digit]
    return sizes, pieces


def decompose(
    documents: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: the key, ``start`` and ``length`` in its document's ids, ``doc_tokens``,
    the ``ids`` (unsigned 32 bits, little-endian), ``sequence_id`` and ``offset``.

    ``tokenizer``, ``ranks`` and ``pattern`` are described at ``token_ids.Encoder``; the files must
    be found under these paths on every machine.
    """
    if length & (length - 1):
        raise ValueError("the length of a sequence must be a power of two")
    if key in ("start", "length", "doc_tokens", "ids", "sequence_id", "offset"):
        raise ValueError(f"the key may not be called {key}")

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer, ranks, pattern)
        for batch in batches:
            keys = batch.column(0)
            for first, last, _, _, ids, counts in encode_column(tool, batch.column(1)):
                ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id)).astype("<u4")
                counts = counts + 1
                sizes, many = piece_lengths(counts, length)
                row = np.repeat(np.arange(len(counts)), many)
                begin = np.cumsum(sizes) - sizes
                places = np.append(begin, begin[-1] + sizes[-1]) * 4
                offset = np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(first, last - first).take(pa.array(row)),
                        pa.array(begin - offset[row]),
                        pa.array(sizes),
                        pa.array(counts[row]),
                        pa.Array.from_buffers(
                            pa.binary(),
                            len(sizes),
                            [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(ids)],
                        ),
                    ],
                    names=[key, "start", "length", "doc_tokens", "ids"],
                )

    schema = T.StructType([documents.schema[key], *PIECE.fields])
    return (
        documents.select(key, text)
        .mapInArrow(pieces, schema)
        # A row is a sequence: its place in its task numbers it without a shuffle.
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("bigint"))
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Lay the sequences out in one folder per length, for batches without padding."""
    pieces.write.partitionBy("length").parquet(path)
