"""Token ids of whole Arrow columns by a public byte-level tokenizer.

Every piece of text between spaces is encoded once and looked up from then on. That gives the ids of
the whole text: the tokenizer always parts words before a space that no blank follows, so a piece,
with the space before it, is encoded the same wherever it stands. A hash proposes a piece and its bytes
decide. Texts in which a blank follows a space are encoded as they are.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa

from citelake.llm.run_table import RunTable, ragged
from citelake.llm.words import FACTOR, INVERSE, byte_spans, chunks, mixed, powers

# Texts taken together, and pieces remembered by a Python worker.
GROUP_BYTES = 6 << 20
REMEMBERED = 1_000_000
# Bytes of a string handed to the tokenizer at once.
CALL_BYTES = 1 << 16

_first = np.zeros(256, dtype=bool)  # first bytes of blanks, some other characters' with them
_first[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = True


class Encoder:
    """``path``: a file of the tokenizers library. ``ranks``: the same vocabulary for tiktoken, which
    is faster; it serves pieces of ASCII and Latin letters, on which both part words alike."""

    def __init__(self, path: str, ranks: str | None, pattern: str | None) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        vocabulary = self.whole.get_vocab()
        self.widths = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.widths[number] = len(token)  # a character stands for a byte
        self.quick = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.quick = tiktoken.Encoding(
                "pieces", pat_str=pattern, mergeable_ranks=table, special_tokens={}
            )
        self.forget()

    def forget(self) -> None:
        self.table = RunTable()
        self.slots = np.zeros(0, np.int64)
        self.places = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, body: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Encode the pieces at ``start`` and append them to what is remembered."""
        spaced = body[start] == 32
        wide = np.zeros(len(body) + 1, dtype=np.int64)
        np.cumsum(body > 0xC3, out=wide[1:])
        simple = spaced & (wide[start + size] == wide[start])
        if self.quick is None:
            simple[:] = False
        counts, order, found = [], [], []
        chosen = np.flatnonzero(simple)
        ends = np.cumsum(size[chosen])
        at = 0
        while at < len(chosen):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + CALL_BYTES, side="right")))
            part = chosen[at:to]
            raw = body[ragged(start[part], size[part])].tobytes().decode()
            ids = np.array(self.quick.encode_ordinary(raw), dtype=np.uint32)
            stops = np.cumsum(self.widths[ids])
            last = np.searchsorted(stops, ends[at:to] - base)
            if not np.array_equal(stops[last], ends[at:to] - base):
                raise ValueError("a token lies across two pieces")
            counts.append(np.diff(last + 1, prepend=0))
            order.append(part)
            found.append(ids)
            at = to
        others = np.flatnonzero(~simple)
        if len(others):
            view = body.tobytes()
            texts = [view[s : s + n].decode() for s, n in zip(start[others], size[others], strict=True)]
            lists = self.encode_all(texts)
            counts.append(np.array([len(x) for x in lists], dtype=np.int64))
            order.append(others)
            found.append(np.array([i for x in lists for i in x], dtype=np.uint32))
        slot = np.empty(len(start), dtype=np.int64)
        slot[np.concatenate(order)] = np.arange(len(start)) + len(self.places) - 1
        grown = self.places[-1] + np.cumsum(np.concatenate(counts))
        self.places = np.concatenate([self.places, grown])
        self.ids = np.concatenate([self.ids, *found])
        return slot

    def look_up(self, hashes, body, start, size) -> np.ndarray:
        """The slot of each piece; unknown ones are encoded first."""
        if len(self.table) > REMEMBERED:
            self.forget()
        known = len(self.table)
        numbers = self.table.look_up(hashes, body, start, size)
        new = np.arange(known, len(self.table))
        if len(new):
            sizes = self.table.sizes[new]
            slots = self.pieces(self.table.bytes_of(new), np.cumsum(sizes) - sizes, sizes)
            self.slots = np.concatenate([self.slots, slots])
        return self.slots[numbers]


@lru_cache(maxsize=4)
def encoder(path: str, ranks: str | None = None, pattern: str | None = None) -> Encoder:
    return Encoder(path, ranks, pattern)


def odd_texts(body: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which values hold a space that a blank may follow."""
    pair = np.zeros(len(body) + 1, dtype=np.int64)
    if len(body) > 1:
        np.cumsum((body[:-1] == 32) & _first[body[1:]], out=pair[1:-1])
        pair[-1] = pair[-2]
    # the pair that begins with a value's last byte belongs to no value
    inner = np.maximum(places[1:] - 1, places[:-1])
    return pair[inner] > pair[places[:-1]]


def encode_group(tool: Encoder, body: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the values one after another, and how many each has."""
    n = len(places) - 1
    odd = odd_texts(body, places)
    edge = np.zeros(len(body) + 1, dtype=bool)
    edge[places] = True
    begins = np.flatnonzero((body == 32) | edge[:-1])
    size = np.diff(np.append(begins, len(body)))
    owner = np.searchsorted(places, begins, side="right") - 1
    use = ~odd[owner] if len(owner) else np.zeros(0, bool)
    begins, size, owner = begins[use], size[use], owner[use]
    hashes = np.empty(len(begins), dtype=np.uint64)
    for first, last in chunks(places):
        at, to = places[first], places[last]
        a, b = np.searchsorted(begins, at), np.searchsorted(begins, to)
        part = body[at:to].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * powers(FACTOR, len(part)), out=sums[1:])
        s = begins[a:b] - at
        hashes[a:b] = mixed((sums[s + size[a:b]] - sums[s]) * powers(INVERSE, len(part) + 1)[s])
    slots = tool.look_up(hashes, body, begins, size) if len(begins) else np.zeros(0, np.int64)
    width = tool.places[slots + 1] - tool.places[slots]
    counts = np.bincount(owner, weights=width, minlength=n).astype(np.int64)
    ids = tool.ids[ragged(tool.places[slots], width)]
    if odd.any():
        where = np.flatnonzero(odd)
        lists = tool.encode_all([body[places[i] : places[i + 1]].tobytes().decode() for i in where])
        before = np.concatenate([[0], np.cumsum(counts)])[where]
        counts[where] = [len(x) for x in lists]
        ids = np.insert(
            ids,
            np.repeat(before, counts[where]),
            np.array([i for x in lists for i in x], dtype=np.uint32),
        )
    return ids, counts


def encode_column(tool: Encoder, column: pa.Array):
    """Yield (first, last, bytes, places, ids, counts) for groups of the column's values."""
    body, places = byte_spans(column)
    for first, last in chunks(places, GROUP_BYTES):
        at = places[first]
        group, inner = body[at : places[last]], places[first : last + 1] - at
        yield first, last, group, inner, *encode_group(tool, group, inner)
