"""Token ids of whole Arrow columns by a public tokenizer that drops white space.

Such a tokenizer never lets a token reach over a blank, so a run of other bytes is encoded the same
wherever it stands. Runs are parted at ASCII blanks (A-Z count as a-z, as the tokenizer lowers
its input), encoded once and looked up from then on. A hash proposes what to look at, the bytes decide,
so that nothing rests on hashes being unique. Runs of printable ASCII and Latin letters are parted
into the tokenizer's own pieces first, which fewer differ in, and only those go through its model; all
other runs go through the whole tokenizer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from citelake.llm.run_table import Lists, RunTable, summed
from citelake.llm.words import byte_spans, chunk_words, chunks, lowered

# Text taken together, and runs remembered by a Python worker: their number and their bytes.
GROUP_BYTES = 4 << 20
REMEMBERED = 300_000
REMEMBERED_BYTES = 32 << 20

# Fixed values of the tokenizer: how it parts a run (lower case, letters of these alphabets), and the
# characters that stand for bytes; those without a shape of their own follow from U+0100 on.
_odd = re.compile("[^!-~À-ÖØ-öø-ÿ\n]")
_parts = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|\n|[^a-z0-9ß-öø-ÿ\n]+")
_shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_hidden = [b for b in range(256) if b not in _shown]
_byte_names = {b: chr(0x100 + i) for i, b in enumerate(_hidden)}


class WordEncoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.tool.encode_special_tokens = True
        self.forget()

    def forget(self) -> None:
        self.runs, self.run_ids, self.part_ids = RunTable(), Lists(np.uint32), Lists(np.uint32)
        self.parts: dict[str | bytes, int] = {"\n": 0}  # parts runs from one another and has no ids
        self.part_ids.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def encode(self, body: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the values one after another, and how many each has."""
        if len(self.runs) > REMEMBERED or 8 * len(self.runs.runs.values) > REMEMBERED_BYTES:
            self.forget()
        found = []
        for first, last in chunks(places):
            at = places[first]
            words = chunk_words(body[at : places[last]], places[first : last + 1] - at)
            found.append((words.hashes, words.starts + at, words.ends + at, np.diff(words.places)))
        if not found:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        hashes, starts, ends, counts = map(np.concatenate, zip(*found, strict=True))
        known = len(self.runs)
        numbers = self.runs.look_up(hashes, lowered(body), starts, ends - starts)
        self._learn(np.arange(known, len(self.runs)))
        ids, per_run = self.run_ids.take(numbers)
        return ids, summed(per_run, counts)

    def _learn(self, new: np.ndarray) -> None:
        """Encode the runs of these numbers."""
        if not len(new):
            return
        raw = np.insert(self.runs.bytes_of(new), np.cumsum(self.runs.sizes[new]), np.uint8(10))
        text = raw.tobytes().decode()
        if _odd.search(text):
            keys: list[str | bytes] = []
            for run in text.split("\n")[:-1]:
                keys += [run.encode()] if _odd.search(run) else _parts.findall(run.lower())
                keys.append("\n")
        else:
            keys = _parts.findall(text.lower())
        found, unknown = np.empty(len(keys), np.int64), []
        for i, key in enumerate(keys):
            part = self.parts.get(key)
            if part is None:
                part = self.parts[key] = len(self.parts)
                unknown.append(key)
            found[i] = part
        self._encode_parts(unknown)
        stops = np.flatnonzero(found == 0)
        ids, per_part = self.part_ids.take(found)
        self.run_ids.add(ids, summed(per_part, np.diff(stops, prepend=-1)))

    def _encode_parts(self, parts: list[str | bytes]) -> None:
        """Texts go through the model, bytes (whole runs) through the whole tokenizer."""
        runs = [x.decode() for x in parts if isinstance(x, bytes)]
        whole = iter(self.tool.encode_batch_fast(runs, add_special_tokens=False))
        tokenize, ids, counts = self.tool.model.tokenize, [], []
        for part in parts:
            if isinstance(part, bytes):
                found = next(whole).ids
            else:
                if not part.isascii():
                    part = part.encode().decode("latin-1").translate(_byte_names)
                found = [x.id for x in tokenize(part)]
            ids += found
            counts.append(len(found))
        self.part_ids.add(np.array(ids, np.uint32), np.array(counts, np.int64))


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encode_words(
    tool: WordEncoder, column: pa.Array
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first, last, ids, counts) for groups of the column's values; null is empty."""
    body, places = byte_spans(column)
    for first, last in chunks(places, GROUP_BYTES):
        at = places[first]
        yield first, last, *tool.encode(body[at : places[last]], places[first : last + 1] - at)
