"""Counts of the letter runs of texts, some of them with a letter deleted.

A run is a longest stretch of A-Z, a-z and U+00C0 to U+00FF; A-Z count as a-z. Of the runs of a document,
those whose checksum together with the document's key is divisible by ``every`` lose one letter, which
gives a corpus of known misspellings. The checksum of key and run comes from that of each of them, as
CRC-32 is linear, so it costs a few table look-ups for each run.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citelake.llm.run_table import RunTable
from citelake.llm.words import FACTOR, INVERSE, byte_spans, chunks, lowered, mixed, powers

# Text taken together, and runs counted by a task before it hands its counts on.
GROUP_BYTES = 4 << 20
REMEMBERED = 500_000
REMEMBERED_BYTES = 32 << 20


@lru_cache(maxsize=4096)
def _shift(size: int) -> np.ndarray:
    """What ``size`` bytes behind it make of a checksum: a table for each of its four bytes."""
    zero = zlib.crc32(bytes(size))
    table = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for bit in range(8):
            # A checksum that differs in one bit differs by the same number after the bytes.
            image = zlib.crc32(bytes(size), 1 << (8 * byte + bit)) ^ zero
            step = 1 << bit
            table[byte, step : 2 * step] = table[byte, :step] ^ np.uint32(image)
    return table


def joined_checksums(before: np.ndarray, sizes: np.ndarray, own: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings in a row: that of the first, the second's size and its CRC-32."""
    distinct, place = np.unique(sizes, return_inverse=True)
    tables = np.stack([_shift(int(n)) for n in distinct]) if len(distinct) else np.zeros((0, 4, 256), np.uint32)
    found = own.copy()
    for byte in range(4):
        found ^= tables[place, byte, (before >> np.uint32(8 * byte)) & np.uint32(255)]
    return found


def letter_runs(body: np.ndarray, places: np.ndarray):
    """Starts and ends of the runs in lower-cased bytes, their lengths in letters, and their values."""
    # A letter beyond ASCII is 0xC3 and a following byte; 0xC3 leads no other character.
    lead = body == 0xC3
    letter = ((body >= 97) & (body <= 122)) | lead
    letter[1:] |= lead[:-1]
    inside = np.zeros(len(body) + 2, bool)
    inside[1:-1] = letter
    edge = np.zeros(len(body) + 1, bool)
    edge[places] = True
    starts = np.flatnonzero(inside[1:] & (edge | ~inside[:-1]))
    ends = np.flatnonzero(inside[:-1] & (edge | ~inside[1:]))
    wide = np.concatenate([[0], np.cumsum(lead)])
    letters = ends - starts - (wide[ends] - wide[starts])
    return starts, ends, letters, np.searchsorted(places, starts, side="right") - 1


def hashes_of(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * powers(FACTOR, len(body)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(INVERSE, len(body) + 1)[starts])


def run_counts(
    documents: DataFrame, key: str = "doc_id", text: str = "text", least: int = 1, every: int | None = None
) -> DataFrame:
    """``word`` and ``n``: how often each run of at least ``least`` letters occurs.

    With ``every``, runs for which it divides the unsigned CRC-32 h of ``<key>:<run>`` lose the letter
    h mod length before they are counted; a null key counts as empty there.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, own = RunTable(), np.zeros(0, np.uint32)
        times, changed = np.zeros(0, np.int64), Counter()

        def counted() -> Iterator[pa.RecordBatch]:
            used = np.flatnonzero(times)
            for at in range(0, len(used), 1 << 16):
                part = used[at : at + (1 << 16)]
                ends = np.concatenate([[0], np.cumsum(table.sizes[part])]).astype(np.int32)
                words = pa.Array.from_buffers(
                    pa.string(), len(part), [None, pa.py_buffer(ends), pa.py_buffer(table.bytes_of(part))]
                )
                yield pa.RecordBatch.from_arrays([words, pa.array(times[part])], names=["word", "n"])
            if changed:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(changed), pa.string()), pa.array(list(changed.values()), pa.int64())],
                    names=["word", "n"],
                )

        for batch in batches:
            body, places = byte_spans(batch.column(1))
            prefixes = batch.column(0).cast(pa.string()).fill_null("").to_pylist()
            before = np.array([zlib.crc32(f"{x}:".encode()) for x in prefixes], np.uint32)
            for first, last in chunks(places, GROUP_BYTES):
                at = places[first]
                low = lowered(body[at : places[last]])
                starts, ends, letters, owner = letter_runs(low, places[first : last + 1] - at)
                long = letters >= least
                starts, ends, letters, owner = starts[long], ends[long], letters[long], owner[long] + first
                known = len(table)
                number = table.look_up(hashes_of(low, starts, ends), low, starts, ends - starts)
                if every is not None:
                    fresh = np.arange(known, len(table))
                    raw = table.bytes_of(fresh).tobytes()
                    stops = np.cumsum(table.sizes[fresh])
                    sums = [zlib.crc32(raw[a:b]) for a, b in zip(stops - table.sizes[fresh], stops, strict=True)]
                    own = np.concatenate([own, np.array(sums, np.uint32)])
                    h = joined_checksums(before[owner], ends - starts, own[number])
                    struck = h % np.uint32(every) == 0
                    for i in np.flatnonzero(struck & (letters > least)):
                        run, gone = low[starts[i] : ends[i]].tobytes().decode(), int(h[i]) % int(letters[i])
                        changed[run[:gone] + run[gone + 1 :]] += 1
                    number = number[~struck]
                many = np.bincount(number, minlength=len(table))
                many[: len(times)] += times
                times = many
                if (
                    len(table) + len(changed) > REMEMBERED
                    or 8 * len(table.runs.values) > REMEMBERED_BYTES
                ):
                    yield from counted()
                    table, own = RunTable(), np.zeros(0, np.uint32)
                    times, changed = np.zeros(0, np.int64), Counter()
        yield from counted()

    parts = documents.select(F.col(key), F.col(text)).mapInArrow(count, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))
