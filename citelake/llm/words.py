"""Words of whole Arrow columns as 64-bit hashes, without a Python object per word.

A word is a run of bytes other than blanks (space and 0x09 to 0x0D); A-Z count as a-z. Bytes and
code points agree on that, since all blanks are ASCII. Equal words get equal hashes. A word is taken in
steps of eight bytes, each stirred into what the steps before gave, and one of more than ``LONG_WORD``
bytes by a cryptographic digest: no sum over the places of letters, so letters cannot be arranged to
cancel out. Two different words get the same hash with a chance of about 2^-64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)
LONG_WORD = 64

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_blank = np.zeros(256, dtype=bool)
_blank[[32, 9, 10, 11, 12, 13]] = True
_first_bytes = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; kept, as every chunk needs them."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread what the values differ in over all bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the n + 1 places between its values; a null is an empty value."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    body = np.frombuffer(data, dtype=np.uint8)[places[0] : places[-1]]
    return body, places - places[0]


def lowered(body: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z."""
    return _lower[body]


def chunks(places: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of values of about ``most`` bytes; a longer value is a run of its own."""
    first, n = 0, len(places) - 1
    while first < n:
        last = int(np.searchsorted(places, places[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the stretches from ``start`` to ``end`` of the bytes ``low``."""
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(low) + 1, dtype="<u8", buffer=padded, strides=(1,))
    size = end - start
    found = eight[start] & _first_bytes[np.minimum(size, 8)]
    found = mixed(found + size.astype(np.uint64) * np.uint64(FACTOR))
    at = np.flatnonzero((size > 8) & (size <= LONG_WORD))
    done = 8
    while len(at):
        step = eight[start[at] + done] & _first_bytes[np.minimum(size[at] - done, 8)]
        found[at] = mixed(found[at] * np.uint64(FACTOR) + step)
        done += 8
        at = at[size[at] > done]
    for i in np.flatnonzero(size > LONG_WORD):
        digest = hashlib.blake2b(low[start[i] : end[i]], digest_size=8).digest()
        found[i] = int.from_bytes(digest, "little")
    return found


@dataclass
class Words:
    """Hashes of the words in order; ``places[i]`` is where the words of value i begin."""

    hashes: np.ndarray
    places: np.ndarray
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.places[i] : self.places[i + 1]]


def chunk_words(body: np.ndarray, places: np.ndarray) -> Words:
    low = _lower[body]
    inside = np.ones(len(low) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(_blank[low], out=inside[1:-1])
    edge = np.zeros(len(low) + 1, dtype=bool)
    edge[places] = True
    begins = inside[1:] & (edge | ~inside[:-1])
    stops = inside[:-1] & (edge | ~inside[1:])
    start, end = np.flatnonzero(begins), np.flatnonzero(stops)
    return Words(word_hashes(low, start, end), np.searchsorted(start, places), start, end)


def column_words(column: pa.Array, spans: bool = False) -> Words:
    """The words of a column; with ``spans``, their byte places in the column's bytes as well."""
    body, places = byte_spans(column)
    hashes, counts, starts, ends = [], [np.zeros(1, np.int64)], [], []
    for first, last in chunks(places):
        at = places[first]
        found = chunk_words(body[at : places[last]], places[first : last + 1] - at)
        hashes.append(found.hashes)
        counts.append(np.diff(found.places))
        if spans:
            starts.append(found.starts + at)
            ends.append(found.ends + at)
    total = np.cumsum(np.concatenate(counts))
    return Words(
        np.concatenate(hashes or [np.zeros(0, np.uint64)]),
        total,
        np.concatenate(starts or [np.zeros(0, np.int64)]) if spans else None,
        np.concatenate(ends or [np.zeros(0, np.int64)]) if spans else None,
    )


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return np.zeros(0, np.uint64)
    span = min(size, len(words))
    factor = powers(FACTOR, span + 1)
    total = np.repeat(factor[span : span + 1] * np.uint64(span), len(words) - span + 1)
    for k in range(span):
        total += words[k : len(words) - span + 1 + k] * factor[k]
    return mixed(total)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    found = shingle_hashes(words, size)
    found.sort()
    return found[np.append(True, found[1:] != found[:-1])] if len(found) else found
