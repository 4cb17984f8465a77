"""Best-two-fit packing (operator 13).

A sequence is filled greedily, largest document first. While it has a gap, its smallest document is
taken out again if two unpacked ones fit the larger gap more tightly; of all such pairs the fullest
goes in.

Documents of one length are alike, so the plan is made over the histogram of lengths, which has as
many entries as a sequence has tokens, whatever the corpus: a filling that was found is repeated as
often as the documents left allow. ``plan`` is what the driver works out; it sees no row. The rows are
then dealt out: a document's rank among those of its length, from a count in its own task and the
sums of the tasks before, says which sequence and place it has.

Defined results: a null or empty text is the end id alone; a document longer than a sequence is cut
into whole ones and a rest; repeated rows and null keys are packed once per row; an empty table gives
no pieces. ``pack`` keeps all other columns of its pieces and refuses those that carry a name of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.llm.scratch import written
from citelake.llm.word_ids import encode_words, word_encoder

LENGTH = 2048
END_ID = 0
PIECE = T.StructType(
    [
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
OWN = ["sequence_id", "offset", "_task", "_nth", "_before"]


def encode_pieces(
    documents: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: the key, ``piece`` (from 0), ``start`` and ``length`` in its document's ids,
    and the ``ids`` (unsigned 32 bits, little-endian).

    ``tokenizer`` is a file of the tokenizers library, found under this path on every machine, that
    drops white space.
    """
    if key in PIECE.fieldNames():
        raise ValueError(f"the key may not be called {key}")

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = word_encoder(tokenizer)
        for batch in batches:
            for first, last, ids, counts in encode_words(tool, batch.column(1)):
                ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id)).astype("<u4")
                counts = counts + 1
                many = -(-counts // length)
                row = np.repeat(np.arange(len(counts)), many)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                start = nth * length
                size = np.minimum(counts[row] - start, length)
                places = np.concatenate([[0], np.cumsum(size)]) * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first).take(pa.array(row)),
                        pa.array(nth.astype(np.int32)),
                        pa.array(start),
                        pa.array(size),
                        pa.Array.from_buffers(
                            pa.binary(),
                            len(size),
                            [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(ids)],
                        ),
                    ],
                    names=[key, *PIECE.fieldNames()],
                )

    schema = T.StructType([documents.schema[key], *PIECE.fields])
    return documents.select(key, text).mapInArrow(pieces, schema)


@dataclass
class Filling:
    """``repeats`` sequences that hold ``many[i]`` documents of ``sizes[i]`` tokens each."""

    sizes: list[int]
    many: list[int]
    repeats: int


def plan(counts: np.ndarray, capacity: int) -> list[Filling]:
    """Fillings that use up ``counts[n]`` documents of n tokens for each n up to ``capacity``.

    A filling is repeated until a length runs short, so there are a few for each length at most.
    """
    left = np.array(counts, dtype=np.int64)
    left[0] = 0
    fillings = []
    while left.any():
        taken = np.zeros_like(left)
        gap = capacity
        for size in np.flatnonzero(left)[::-1]:
            if size <= gap:
                taken[size] = min(gap // size, left[size])
                gap -= taken[size] * size
        while gap:
            smallest = int(np.flatnonzero(taken)[0])
            pair = best_pair(left - taken, smallest + gap)
            if pair is None or sum(pair) <= smallest:
                break
            taken[smallest] -= 1
            for size in pair:
                taken[size] += 1
            gap += smallest - sum(pair)
        sizes = np.flatnonzero(taken)[::-1]
        repeats = int((left[sizes] // taken[sizes]).min())
        left[sizes] -= taken[sizes] * repeats
        fillings.append(Filling(sizes.tolist(), taken[sizes].tolist(), repeats))
    return fillings


def best_pair(left: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two documents of ``left`` that fill ``room`` best; of equal pairs that with the larger one."""
    sizes = np.flatnonzero(left[:room])
    # the fitting partner, no larger than the size itself; that size only where there are two
    partner = np.searchsorted(sizes, np.minimum(room - sizes, sizes), side="right") - 1
    alone = (partner == np.arange(len(sizes))) & (left[sizes] < 2)
    partner = partner - alone
    usable = np.flatnonzero(partner >= 0)
    if not len(usable):
        return None
    total = sizes[usable] + sizes[partner[usable]]
    best = usable[len(total) - 1 - int(np.argmax(total[::-1]))]
    return int(sizes[best]), int(sizes[partner[best]])


def places(fillings: list[Filling], capacity: int) -> dict[int, np.ndarray]:
    """For each length, rows of (first rank, documents a sequence, first sequence, offset)."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    used = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for filling in fillings:
        offset = 0
        for size, many in zip(filling.sizes, filling.many, strict=True):
            found.setdefault(size, []).append((int(used[size]), many, sequence, offset))
            used[size] += many * filling.repeats
            offset += many * size
        sequence += filling.repeats
    return {size: np.array(rows, np.int64) for size, rows in found.items()}


def pack(pieces: DataFrame, size: str = "length", capacity: int = LENGTH) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; each ``size`` is from 1 to ``capacity``.

    The pieces are written once, with a number among those of their task and length, so that what made
    them is not done again and every rank is settled.
    """
    clash = [c for c in pieces.columns if c in OWN]
    if clash:
        raise ValueError(f"columns may not be called {clash}")

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            sizes = np.asarray(batch.column(batch.schema.get_field_index(size)))
            if len(sizes) and (sizes.min() < 1 or sizes.max() > capacity):
                raise ValueError(f"a piece has {sizes.min()} or {sizes.max()} tokens")
            order = np.argsort(sizes, kind="stable")
            many = np.bincount(sizes, minlength=capacity + 1)
            nth = np.empty(len(sizes), np.int64)
            nth[order] = np.arange(len(sizes)) - np.repeat(np.cumsum(many) - many, many)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(np.full(len(sizes), task, np.int32)),
                    pa.array(nth + seen[sizes]),
                ],
                names=[*batch.schema.names, "_task", "_nth"],
            )
            seen += many

    schema = T.StructType(
        [
            *pieces.schema.fields,
            T.StructField("_task", T.IntegerType()),
            T.StructField("_nth", T.LongType()),
        ]
    )
    numbered = written(pieces.mapInArrow(number, schema))
    counts = written(numbered.groupBy("_task", size).agg(F.count("*").alias("_many")))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy(size).agg(F.sum("_many")).collect():
        histogram[row[0]] = row[1]
    table = places(plan(histogram, capacity), capacity)

    earlier = Window.partitionBy(size).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "_task", size, F.coalesce(F.sum("_many").over(earlier), F.lit(0)).alias("_before")
    )

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            sizes = np.asarray(columns[size])
            ranks = np.asarray(columns["_nth"]) + np.asarray(columns["_before"])
            sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
            for n in np.unique(sizes):
                own = np.flatnonzero(sizes == n)
                rows = table[int(n)]
                at = np.searchsorted(rows[:, 0], ranks[own], side="right") - 1
                first, many, begin, place = rows[at].T
                sequence[own] = begin + (ranks[own] - first) // many
                offset[own] = place + (ranks[own] - first) % many * n
            yield pa.RecordBatch.from_arrays(
                [*(columns[c] for c in kept), pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"],
            )

    kept = pieces.columns
    schema = T.StructType(
        [
            *pieces.schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    return numbered.join(before, ["_task", size]).mapInArrow(deal, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``length`` and the ``ids`` of each sequence; a group holds one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(
        parts, F.lit(b"").cast("binary"), lambda found, part: F.concat(found, part["ids"])
    )
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), whole.alias("ids"))
