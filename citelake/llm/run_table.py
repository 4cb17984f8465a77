"""Runs of bytes and the numbers given to them, without a Python object per run.

A hash proposes the number of a run and its bytes decide: two runs of one hash get two numbers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

_masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] .. start[0]+size[0]-1, start[1] .. and so on."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(start - (total - size), size)


class Lists:
    """Lists of numbers, one after another."""

    def __init__(self, kind: type) -> None:
        self.values = np.zeros(0, kind)
        self.places = np.zeros(1, np.int64)

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        self.values = np.concatenate([self.values, values])
        self.places = np.concatenate([self.places, self.places[-1] + np.cumsum(counts)])

    def take(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists at ``slots`` one after another, and how long each is."""
        counts = self.places[slots + 1] - self.places[slots]
        return self.values[ragged(self.places[slots], counts)], counts


def eights(body: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each run as numbers of eight bytes, the last filled up with 0, and their count."""
    padded = np.append(body, np.zeros(8, np.uint8))
    at_byte = np.ndarray((len(body) + 1,), "<u8", padded, strides=(1,))
    counts = (sizes + 7) >> 3
    begin = np.cumsum(counts) - counts
    nth = np.arange(begin[-1] + counts[-1] if len(counts) else 0) - np.repeat(begin, counts)
    found = at_byte[np.repeat(starts, counts) + 8 * nth]
    last = begin + counts - 1
    found[last] &= _masks[sizes - 8 * (counts - 1)]
    return found, counts


def summed(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of ``counts[0]`` values, of the next ``counts[1]`` and so on."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return np.diff(sums[np.concatenate([[0], np.cumsum(counts)])])


class RunTable:
    def __init__(self) -> None:
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.runs, self.sizes = Lists(np.uint64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.sizes)

    def look_up(
        self, hashes: np.ndarray, body: np.ndarray, starts: np.ndarray, sizes: np.ndarray
    ) -> np.ndarray:
        """The number of each run; runs not seen before get the next ones."""
        codes, distinct = pd.factorize(hashes)
        at = np.searchsorted(self.hashes, distinct)
        hit = at < len(self.hashes)
        hit[hit] = self.hashes[at[hit]] == distinct[hit]
        found = np.empty(len(distinct), np.int64)
        found[hit] = self.numbers[at[hit]]
        new = np.flatnonzero(~hit)
        if len(new):
            example = np.empty(len(distinct), np.int64)
            example[codes[::-1]] = np.arange(len(codes))[::-1]
            found[new] = self._add(body, starts[example[new]], sizes[example[new]])
            order = new[np.argsort(distinct[new])]
            place = np.searchsorted(self.hashes, distinct[order])
            self.hashes = np.insert(self.hashes, place, distinct[order])
            self.numbers = np.insert(self.numbers, place, found[order])
        numbers = found[codes]
        same = self.sizes[numbers] == sizes
        alike = np.flatnonzero(same)
        raw, counts = eights(body, starts[alike], sizes[alike])
        same[alike] = summed(self.runs.take(numbers[alike])[0] != raw, counts) == 0
        if not same.all():
            other = np.flatnonzero(~same)
            numbers[other] = self._add_all(body, starts[other], sizes[other])
        return numbers

    def _add(self, body: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        self.runs.add(*eights(body, starts, sizes))
        self.sizes = np.append(self.sizes, sizes)
        return np.arange(len(self.sizes) - len(sizes), len(self.sizes))

    def _add_all(self, body: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Runs whose hash another run has, each a number; equal ones among them get one."""
        first: dict[bytes, int] = {}
        raw = [body[a : a + n].tobytes() for a, n in zip(starts, sizes, strict=True)]
        nth = np.array([first.setdefault(x, len(first)) for x in raw], np.int64)
        example = np.unique(nth, return_index=True)[1]
        return self._add(body, starts[example], sizes[example])[nth]

    def bytes_of(self, numbers: np.ndarray) -> np.ndarray:
        """The bytes of the runs one after another."""
        return self.runs.values.view(np.uint8)[ragged(8 * self.runs.places[numbers], self.sizes[numbers])]
