"""Removal of byte strings repeated across documents, by a sparse suffix array (operator 7).

A byte goes if a string of ``span`` bytes that covers it also starts in a document with a smaller
key. Not every suffix is sorted: each window of ``span`` bytes picks the place in it whose ``GRAM``
leading bytes hash lowest. Equal windows pick alike, so the suffixes at picked places, about one in
eighteen, are enough to bring equal windows together.

1. Every window of a stretch, that is of the windows that picked one suffix, holds either the suffix's
   leading bytes and what follows, or those and what goes before: one of two strings of ``GRAM`` +
   (``span`` - ``GRAM`` + 1) / 2 bytes, its anchors. These are the leads of the sparse array's suffixes.
   As two tokens, eight bytes and a hash of the others, they are dealt into buckets between sampled
   splitters. A bucket is sorted by multikey quicksort, first token first, and neighbours are compared.
   Splitters are whole leads, so equal ones never lie across a boundary. Each group of texts gets a flag
   back for each of its leads; stretches none of whose leads another document holds are in no repeat and
   go no further. That takes as much for each byte of text in a large corpus as in a small one, where
   ``GRAM`` bytes alone are found in some other document the more often the larger it is.
2. Equal stretches, told by a cryptographic digest of 128 bits, become one with the smallest key that
   holds it, whose text gives its bytes.
3. Stretches whose anchor another one has too are ranged by it between sampled splitters and sorted;
   inside a run of equal anchors the windows' other bytes are ordered as tokens by multikey quicksort
   and neighbours are compared.
   Each run of equal windows takes the smallest key of its stretches; equal anchors never lie across a
   boundary.
4. The windows of a stretch with their smallest keys meet the places of all its copies by the digest.

The flags of a group are found again by a digest of all that is in it. Should a second reading of the texts
group them otherwise, all stretches of such a group go on: more work, the same result. A hash that is equal
by chance lets a stretch go on as well. A bit array of fixed size passes on the anchors that several
stretches have; what it lets through by chance is compared like the rest, so it saves work and changes no
result. Beyond about 10^8 entries it saves little.

Defined results: a null text is empty; texts shorter than ``span`` stay; rows of equal keys never
remove from each other, and where their texts differ each loses only what its own text shares with
smaller keys (the texts are told apart by a 64-bit hash beside the key); rows whose key is null are
neither compared nor changed; an empty table gives an empty table; a key that is no integer is refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.llm.scratch import forget, settle, written
from citelake.llm.sieve import passes, sieve
from citelake.llm.words import FACTOR, byte_spans, chunks, mixed

SPAN = 50
GRAM = 16
GROUP_BYTES = 1 << 20
# Texts that are cut at once.
HELD_BYTES = 1 << 18
# A lead travels as its first token and all but the last bits of its second, with a bit that tells a shared one.
FREE_BITS = 16
LEAD_BYTES = 16 - FREE_BITS // 8
MIXER = 0xD6E8FEB86659FD93
# Documents and suffixes of each that are sampled for the splitters.
SAMPLED = 2_000
SAMPLED_SUFFIXES = 64
# Stretches that are compared at once; a run of equal anchors is never cut.
HELD_ROWS = 30_000
# Stretches that leave as one batch.
AT_ONCE = 100_000
# Parts in which stretches are joined.
PARTS = 2
PACKED = ["name", "keys", "marks", "places", "body"]
AROUND = (
    "key bigint, mark bigint, one array<bigint>, two array<bigint>, start array<bigint>, size array<int>, "
    "at array<int>, body binary"
)


class Stretches:
    """The picked suffixes of a group of texts, and the windows that picked each of them."""

    def __init__(self, body: np.ndarray, places: np.ndarray, span: int) -> None:
        n = len(body)
        self.span, self.body = span, body
        first, last = places[:-1], places[1:] - span  # the windows of each text
        valid = np.zeros(n + 2, dtype=np.int8)
        has = last >= first
        np.add.at(valid, first[has], 1)
        np.add.at(valid, last[has] + 1, -1)
        windows = np.flatnonzero(np.cumsum(valid[:n]))
        if len(windows):
            low = np.uint64(0xFFFFFFFF)
            least = self.eights("<u8")[: n - GRAM + 1] * np.uint64(FACTOR)
            least ^= least >> np.uint64(29)
            least += self.eights("<u8")[8:]
            least *= np.uint64(MIXER)
            least &= ~low
            least |= np.arange(len(least), dtype=np.uint64)
            width, reach = 1, span - GRAM + 1
            while 2 * width <= reach:
                least = np.minimum(least[: len(least) - width], least[width:])
                width *= 2
            if width < reach:
                least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
            picked = (least[windows] & low).astype(np.int64)
            fresh = np.append(True, (picked[1:] != picked[:-1]) | (np.diff(windows) > 1))
            at = np.flatnonzero(fresh)
            self.place, self.start = picked[at], windows[at]
            self.end = windows[np.append(at[1:], len(windows)) - 1] + span
        else:
            self.place = self.start = self.end = np.zeros(0, np.int64)
        self.owner = np.searchsorted(places, self.start, side="right") - 1
        self.offset = self.start - places[self.owner] if len(self.start) else self.start

    def eights(self, kind: str) -> np.ndarray:
        """The eight bytes from each place on as one number."""
        return np.ndarray((len(self.body) - 7,), kind, buffer=self.body, strides=(1,))

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the anchors, and the stretch of each: those that start at a picked suffix and those
        that end with its leading bytes, where a window holds them."""
        more, latest = (self.span - GRAM + 1) // 2, self.end - self.span
        before = self.place - more
        ahead = np.maximum(self.start, before + 1) <= np.minimum(self.place, latest)
        behind = np.maximum(self.start, before - (self.span - GRAM - more)) <= np.minimum(before, latest)
        of = np.append(np.flatnonzero(ahead), np.flatnonzero(behind))
        return np.append(self.place[ahead], before[behind]), of

    def tokens(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The eight bytes from each of the places on as a number that sorts as they do, and a hash of the
        anchor's other bytes, whose last bits are left free."""
        if not len(at):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        eights, width = self.eights("<u8"), anchor_bytes(self.span)
        rest = np.zeros(len(at), np.uint64)
        for k in (*range(8, width - 8, 8), width - 8):
            rest = mixed(rest * np.uint64(FACTOR) + eights[at + k])
        return self.eights(">u8")[at].astype(np.uint64), rest & ~np.uint64((2 << FREE_BITS) - 1)

    def leads(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The different anchors in order as two tokens, where the run of each begins among all anchors
        in order, and the stretches of these."""
        at, of = self.anchors()
        one, two = self.tokens(at)
        order = multikey_order(one, two)
        one, two = one[order], two[order]
        new = run_starts(one, two)
        return one[new], two[new], new, of[order]

    def digests(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A cryptographic digest of 128 bits of each of the stretches ``keep``, as two numbers."""
        raw = self.body.tobytes()
        digest = b"".join(
            hashlib.blake2b(raw[a:b], digest_size=16).digest()
            for a, b in zip(self.start[keep].tolist(), self.end[keep].tolist(), strict=True)
        )
        halves = np.frombuffer(digest, dtype=np.int64).reshape(-1, 2)
        return halves[:, 0].copy(), halves[:, 1].copy()


@dataclass
class Group:
    """Texts that are looked at together; ``places`` are those between them in ``body``."""

    keys: np.ndarray
    marks: np.ndarray
    places: np.ndarray
    body: np.ndarray

    def parts(self) -> list[bytes]:
        return [x.tobytes() for x in (self.keys, self.marks, self.places, self.body)]

    @staticmethod
    def of(parts: list[pa.Scalar]) -> Group:
        kinds = (np.int64, np.int64, np.int64, np.uint8)
        return Group(*(np.frombuffer(x.as_buffer(), kind) for x, kind in zip(parts, kinds, strict=True)))

    def name(self) -> bytes:
        """A cryptographic digest of all that is in it: another reading of the same rows gives it again."""
        digest = hashlib.blake2b(digest_size=16)
        for part in self.parts():
            digest.update(len(part).to_bytes(8))
            digest.update(part)
        return digest.digest()


def groups(batches: Iterable[pa.RecordBatch]) -> Iterator[Group]:
    """Batches of (key, mark, text) as groups of about ``GROUP_BYTES`` of text."""
    for batch in batches:
        keys, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        body, places = byte_spans(batch.column(2))
        for first, last in chunks(places, GROUP_BYTES):
            at = places[first]
            yield Group(keys[first:last], marks[first:last], places[first : last + 1] - at, body[at : places[last]])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def binaries(places: np.ndarray, data: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(places) - 1, buffers)


def multikey_order(*tokens: np.ndarray) -> np.ndarray:
    """Sort by the first token; sort again by each next one only what those before leave equal."""
    order = np.argsort(tokens[0], kind="quicksort")
    same = np.append(False, np.ones(max(0, len(order) - 1), dtype=bool))[: len(order)]
    for token, after in zip(tokens, tokens[1:], strict=False):
        here = token[order]
        same[1:] &= here[1:] == here[:-1]
        run = np.cumsum(~same)
        tied = np.flatnonzero(same | np.append(same[1:], False)[: len(same)])
        order[tied] = order[tied][np.lexsort((after[order[tied]], run[tied]))]
    return order


def run_starts(*tokens: np.ndarray) -> np.ndarray:
    """Where in sorted tokens a row differs from its neighbour before."""
    new = np.ones(len(tokens[0]), dtype=bool)
    if len(new):
        new[1:] = False
        for token in tokens:
            new[1:] |= token[1:] != token[:-1]
    return np.flatnonzero(new)


def splitters(rows: DataFrame, buckets: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """``buckets`` - 1 leading strings that cut a bounded sample of them evenly."""
    share = min(1.0, SAMPLED / max(1, rows.count()))

    def some(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            found = Stretches(group.body, group.places, span)
            at, of = found.anchors()
            at, owner = at[np.argsort(of, kind="stable")], found.owner[np.sort(of)]
            nth = np.arange(len(at)) - np.searchsorted(owner, owner)
            size = np.bincount(owner, minlength=1)[owner]
            one, two = found.tokens(at[nth % (size // SAMPLED_SUFFIXES + 1) == 0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(one)), pa.array(signed(two))], names=["one", "two"]
            )

    sampled = rows.sample(share, seed=11).mapInArrow(some, "one bigint, two bigint").toArrow()
    one, two = (sampled.column(c).to_numpy().view(np.uint64) for c in ("one", "two"))
    order = multikey_order(one, two)
    at = order[len(order) * np.arange(1, buckets) // buckets] if len(order) else order
    return one[at], two[at]


def lead_records(one: np.ndarray, two: np.ndarray, several: np.ndarray) -> np.ndarray:
    """Of each lead the first token, what is used of the second, and whether it is known to be shared."""
    two = two | (several.astype(np.uint64) << np.uint64(FREE_BITS))
    held = np.stack([one, two], axis=1).astype(">u8").view(np.uint8).reshape(len(one), 16)
    return held[:, :LEAD_BYTES]


def read_leads(records: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    held = np.zeros((len(records) // LEAD_BYTES, 16), np.uint8)
    held[:, :LEAD_BYTES] = records.reshape(-1, LEAD_BYTES)
    one, two = held.view(">u8").astype(np.uint64).T
    several = np.uint64(1 << FREE_BITS)
    return np.ascontiguousarray(one), two & ~several, (two & several) > 0


def shared_leads(rows: DataFrame, buckets: int, span: int) -> DataFrame:
    """``name``, ``bucket``, ``flags``: of the leads that a group has in a bucket, in order, a byte each
    that says whether another document holds it too."""
    cut_one, cut_two = splitters(rows, buckets, span)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            found = Stretches(group.body, group.places, span)
            one, two, new, of = found.leads()
            if not len(one):
                continue
            keys = group.keys[found.owner[of]]
            several = np.minimum.reduceat(keys, new) < np.maximum.reduceat(keys, new)
            bucket = np.searchsorted(cut_one, one, side="left")
            tied = np.flatnonzero(np.searchsorted(cut_one, one, side="right") > bucket)
            for i in tied:
                to = np.searchsorted(cut_one, one[i], side="right")
                bucket[i] += np.searchsorted(cut_two[bucket[i] : to], two[i], side="right")
            # Sorted, so a bucket's leads lie together: one row for each bucket of a group of texts.
            edges = np.append(run_starts(bucket), len(bucket))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[edges[:-1]].astype(np.int32)),
                    pa.repeat(pa.scalar(group.name(), pa.binary()), len(edges) - 1),
                    binaries(edges * LEAD_BYTES, lead_records(one, two, several)),
                ],
                names=["bucket", "name", "leads"],
            )

    def compare(group: pa.Table) -> pa.Table:
        data, places = raw_bytes(group.column("leads"))
        one, two, several = read_leads(data[places[0] : places[-1]])
        order = multikey_order(one, two)
        new = run_starts(one[order], two[order])
        size = np.diff(np.append(new, len(order)))
        shared = np.logical_or.reduceat(several[order], new) | (size > 1)
        flags = np.empty(len(order), np.uint8)
        flags[order] = np.repeat(shared, size)
        told = binaries((places - places[0]) // LEAD_BYTES, flags)
        return pa.table([group.column("name"), group.column("bucket"), told], names=["name", "bucket", "flags"])

    dealt = rows.mapInArrow(deal, "bucket int, name binary, leads binary")
    return dealt.groupBy("bucket").applyInArrow(compare, "name binary, bucket int, flags binary")


class Anchored:
    """Stretches sorted by anchor: compared window by window with those of the same anchor."""

    def __init__(self, rows: pa.Table, span: int) -> None:
        self.rows, self.span = rows, span
        self.place, self.first, self.last, self.low, self.high, self.one, self.two = (
            rows.column(c).to_numpy() for c in ("place", "first", "last", "low", "high", "one", "two")
        )
        width, n = anchor_bytes(span), len(rows)
        column = rows.column("anchor").combine_chunks()
        self.anchors = np.frombuffer(column.buffers()[2], np.uint8)
        at = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
        self.anchors = self.anchors[at : at + n * width].reshape(n, width)
        new = np.append(True, (self.anchors[1:] != self.anchors[:-1]).any(axis=1))
        self.run = np.cumsum(new) - 1
        self.starts = np.flatnonzero(new)

    def decided(self, most: int) -> pa.RecordBatch:
        """Of the first ``most`` rows: windows (from, to) of a stretch and the smallest key that holds
        them, where that is not the largest key of the stretch as well."""
        alone = np.bincount(self.run)[self.run] == 1
        alone[most:] = False
        single = np.flatnonzero(alone & (self.low < self.high))
        rows = np.flatnonzero(~alone[:most])
        many = self.last[rows] - self.first[rows] + 1
        of = np.repeat(rows, many)
        start = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + self.first[of]
        least = self.least(of, start)
        begin = run_starts(of, least)
        end = np.append(begin[1:], len(of))[: len(begin)] - 1
        lost = least[begin] < self.high[of[begin]]
        begin, end = begin[lost], end[lost]
        which = np.append(single, of[begin])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.one[which]),
                pa.array(self.two[which]),
                pa.array(np.append(self.first[single], start[begin]).astype(np.int64)),
                pa.array(np.append(self.last[single], start[end]).astype(np.int64) + self.span),
                pa.array(np.append(self.low[single], least[begin])),
            ],
            names=["one", "two", "from", "to", "low"],
        )

    def least(self, of: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The smallest key that holds the window at ``start`` of the stretch ``of``."""
        if not len(of):
            return self.low[:0]
        body, places = raw_bytes(self.rows.column("stretch"))
        width = anchor_bytes(self.span)
        before = self.place[of] - start
        at = places[of] + start
        # All windows of a run share the anchor; what else they hold is compared.
        tokens = [self.run[of] * (self.span + 1) + before]
        for k in range(0, self.span - width, 8):
            token = np.zeros(len(of), dtype=np.uint64)
            for t in range(k, min(k + 8, self.span - width)):
                byte = body[at + np.where(t < before, t, t + width)]
                token = (token << np.uint64(8)) | byte.astype(np.uint64)
            tokens.append(token)
        order = multikey_order(*tokens)
        new = run_starts(*(token[order] for token in tokens))
        smallest = np.minimum.reduceat(self.low[of][order], new)
        found = np.empty(len(of), dtype=np.int64)
        found[order] = np.repeat(smallest, np.diff(np.append(new, len(of))))
        return found


def raw_bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks()
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8), places.astype(np.int64)


def anchor_bytes(span: int) -> int:
    return GRAM + (span - GRAM + 1) // 2


def anchored(distinct: DataFrame, span: int) -> DataFrame:
    """For each stretch its one or two anchors (byte ``place``) and the first and last window of each."""
    more = (span - GRAM + 1) // 2
    at, latest = F.col("at"), F.length("stretch") - span

    def side(place, reach):
        first = F.greatest(F.lit(0), place - reach)
        return F.struct(place.alias("place"), first.alias("first"), F.least(latest, place).alias("last"))

    sides = F.array(side(at, more - 1), side(at - more, span - GRAM - more))
    named = ["one", "two", "stretch", "low", "high"]
    rows = distinct.select(*named, F.explode(sides).alias("side"))
    return rows.select(*named, "side.*").filter("place >= 0 AND first <= last")


def repeated_windows(distinct: DataFrame, buckets: int, span: int) -> DataFrame:
    """``one``, ``two``, ``from``, ``to``, ``low``: what documents with a key above ``low`` lose of it."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, enough = [], 0, HELD_ROWS
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < enough:
                continue
            rows = Anchored(pa.Table.from_batches(held), span)
            last = int(rows.starts[-1])  # the last run may go on
            if last:
                yield rows.decided(last)
            rest = rows.rows.slice(last).combine_chunks()
            held, size = rest.to_batches(), len(rest)
            enough = max(HELD_ROWS, 2 * size)
        if size:
            yield Anchored(pa.Table.from_batches(held), span).decided(size)

    def chosen(shared: bool):
        def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = passes(crowded.value, batch.column("lead").to_numpy().view(np.uint64))
                yield batch.filter(pa.array(found == shared))

        return choose

    anchor = F.substring("stretch", F.col("place") + 1, F.lit(anchor_bytes(span)))
    sides = anchored(distinct, span).select(F.xxhash64(anchor).alias("lead"), "*")
    several = written(sides.groupBy("lead").agg(F.count("*").alias("n")).filter("n > 1").select("lead"))
    crowded = distinct.sparkSession.sparkContext.broadcast(sieve(several))
    forget(several)
    ranged = sides.mapInArrow(chosen(True), sides.schema).drop("lead").repartitionByRange(buckets, anchor)
    ranged = ranged.withColumn("anchor", anchor).sortWithinPartitions("anchor")
    found = ranged.mapInArrow(compare, "one bigint, two bigint, from bigint, to bigint, low bigint")
    # What shares its anchor with no other stretch has nothing to be compared with.
    alone = sides.filter("low < high").select("lead", "one", "two", "first", "last", "low")
    alone = alone.mapInArrow(chosen(False), alone.schema)
    alone = alone.select(
        "one",
        "two",
        F.col("first").cast("long").alias("from"),
        (F.col("last") + span).cast("long").alias("to"),
        "low",
    )
    found = written(found.unionByName(alone))
    crowded.destroy()
    return found


def shared_stretches(rows: DataFrame, buckets: int, span: int) -> DataFrame:
    """``AROUND``: of each text the stretches around leads that another document holds too, in order."""
    flags = written(shared_leads(rows, buckets, span))
    settle(rows.sparkSession)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            values = [group.name(), *group.parts()]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in values], names=PACKED)

    def surround(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *parts, told in zip(*(batch.column(c) for c in (*PACKED[1:], "told")), strict=True):
                group = Group.of(parts)
                found = Stretches(group.body, group.places, span)
                passed = told_stretches(found, told)
                for k in range(0, len(passed), AT_ONCE):
                    yield around(group, found, passed[k : k + AT_ONCE])

    told = flags.groupBy("name").agg(F.collect_list(F.struct("bucket", "flags")).alias("told"))
    packed = rows.mapInArrow(pack, ", ".join(f"{c} binary" for c in PACKED))
    found = written(packed.join(told.hint("shuffle_hash"), "name", "left").mapInArrow(surround, AROUND))
    forget(flags)
    return found


def told_stretches(found: Stretches, told: pa.Scalar) -> np.ndarray:
    """Which stretches have a lead that is flagged. All have, as far as is known, if the texts came in other
    groups when the leads were compared: ``told`` is null then."""
    one, _, new, of = found.leads()
    flags = np.ones(len(one), np.uint8)
    if told.is_valid:
        buckets, at = np.unique(told.values.field("bucket").to_numpy(), return_index=True)
        data, places = raw_bytes(pa.chunked_array([told.values.field("flags").take(pa.array(at))]))
        if places[-1] - places[0] == len(one):
            flags = data[places[0] : places[-1]]
    size = np.diff(np.append(new, len(of)))
    return np.unique(of[np.repeat(flags > 0, size)])


def around(group: Group, found: Stretches, keep: np.ndarray) -> pa.RecordBatch:
    """The stretches ``keep``, a row for each text that has some. Neighbours overlap: ``body`` has each byte
    once that lies in any of them."""
    owner = found.owner[keep]
    first = run_starts(owner)
    edges = np.append(first, len(owner))
    one, two = found.digests(keep)
    offset, size = found.offset[keep], found.end[keep] - found.start[keep]
    at = (found.place - found.start)[keep]
    places = pa.array(edges.astype(np.int32))
    lists = (one, two, offset, size.astype(np.int32), at.astype(np.int32))
    inside = np.zeros(len(group.body) + 1, np.int32)
    np.add.at(inside, found.start[keep], 1)
    np.add.at(inside, found.end[keep], -1)
    covered = np.flatnonzero(np.cumsum(inside[:-1]))
    texts = owner[first]
    bodies = np.append(np.searchsorted(covered, group.places[texts]), len(covered))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(group.keys[texts]),
            pa.array(group.marks[texts]),
            *(pa.ListArray.from_arrays(places, pa.array(x)) for x in lists),
            binaries(bodies, group.body[covered]),
        ],
        names=["key", "mark", "one", "two", "start", "size", "at", "body"],
    )


def begins(text: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Where in the bodies of their texts, one after another, stretches in order of ``start`` begin."""
    fresh = np.append(True, (text[1:] != text[:-1]) | (start[1:] > (start + size)[:-1]))[: len(text)]
    step = np.append(0, np.diff(start))[: len(text)]
    step[fresh] = np.append(0, size)[:-1][fresh]
    return np.cumsum(step)


def blend(stretch: np.ndarray, text: np.ndarray) -> np.ndarray:
    """One number for a stretch and a text."""
    return mixed(stretch.view(np.uint64) ^ mixed(text.astype(np.int64).view(np.uint64)))


def own_stretches(texts: pa.RecordBatch) -> pa.RecordBatch:
    """With their bytes the stretches that no text with a smaller key holds, once for each text."""

    def listed(column: str) -> tuple[np.ndarray, np.ndarray]:
        lists = texts.column(column)
        of = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        return lists.flatten().to_numpy(), of

    (one, text), two, start, size, at = listed("one"), *(listed(c)[0] for c in ("two", "start", "size", "at"))
    mine = blend(one, text)
    own, plural = (blend(*listed(c)) for c in ("own", "plural"))
    chosen = np.flatnonzero(np.isin(mine, own))
    chosen = chosen[np.lexsort((two[chosen], one[chosen], text[chosen]))]
    chosen = chosen[run_starts(text[chosen], one[chosen], two[chosen])]
    data, places = raw_bytes(pa.chunked_array([texts.column("body")]))
    begin, size = (places[0] + begins(text, start, size))[chosen], size[chosen].astype(np.int64)
    ends = np.cumsum(size)
    held = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)
    low = texts.column("key").to_numpy()[text[chosen]]
    others = np.isin(mine[chosen], plural)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(one[chosen]),
            pa.array(two[chosen]),
            binaries(np.append(0, ends), data[held]),
            pa.array(at[chosen]),
            pa.array(low),
            pa.array(np.where(others, np.iinfo(np.int64).max, low)),
        ],
        names=["one", "two", "stretch", "at", "low", "high"],
    )


def repeated_intervals(rows: DataFrame, buckets: int, span: int) -> DataFrame:
    """``key``, ``mark``, ``start``, ``end`` of the bytes to remove from ``rows`` of (key, mark, text)."""
    held = shared_stretches(rows, buckets, span)
    alike = held.select("key", "mark", F.inline(F.arrays_zip("one", "two"))).groupBy("one", "two").agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.min_by("mark", "key").alias("mark")
    )
    # By text, so that each gives the bytes of those stretches that no smaller document holds.
    spoken = written(
        alike.groupBy(F.col("low").alias("key"), "mark").agg(
            F.collect_list("one").alias("own"),
            F.collect_list(F.when(F.col("low") < F.col("high"), F.col("one"))).alias("plural"),
        )
    )

    def speak(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.append(0, np.cumsum(pc.list_value_length(batch.column("one")).to_numpy()))
            for first, last in chunks(places, AT_ONCE):
                yield own_stretches(batch.slice(first, last - first))

    columns = "one bigint, two bigint, stretch binary, at int, low bigint, high bigint"
    settle(rows.sparkSession)
    texts = [joined(held, spoken, ["key", "mark"], part) for part in range(PARTS)]
    texts = [written(rows.mapInArrow(speak, columns)) for rows in texts]
    forget(spoken)
    # Read twice, for splitters and for the deal.
    found = repeated_windows(reduce(DataFrame.unionByName, texts), buckets, span)
    forget(*texts)
    lost = written(found.distinct())
    forget(found)
    settle(rows.sparkSession)
    each = held.select("key", "mark", F.inline(F.arrays_zip("one", "two", F.col("start").alias("at"))))
    settled = [joined(each, lost, ["one", "two"], part).filter("key > low") for part in range(PARTS)]
    start, end = ((F.col("at") + F.col(c)).alias(name) for c, name in (("from", "start"), ("to", "end")))
    settled = [written(rows.select("key", "mark", start, end)) for rows in settled]
    forget(held, lost)
    return reduce(DataFrame.unionByName, settled)


def joined(left: DataFrame, right: DataFrame, keys: list[str], part: int) -> DataFrame:
    """One of ``PARTS`` parts of a join: written one after another, they never have all rows shuffled at once."""
    here = F.pmod(F.hash(*keys), F.lit(PARTS)) == part
    return left.filter(here).join(right.filter(here), keys)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of overlapping or adjoining intervals, in order."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts)
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    return starts[new], ends[np.append(new[1:], True)]


def few_bytes(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``HELD_BYTES`` of text, or of one longer text."""
    for batch in batches:
        _, places = byte_spans(batch.column(column))
        for first, last in chunks(places, HELD_BYTES):
            yield batch.slice(first, last - first)


def remove_repeats(
    documents: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN
) -> DataFrame:
    """All columns of ``documents``, with ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (start, end)
    ``kept`` (the bytes that are left) and ``kept_text`` (the same as text, less characters that were cut
    in two; null where nothing was removed); columns of these names are replaced."""
    added = tuple(field.name for field in ADDED)
    kept = documents.drop(*added)
    names = kept.columns
    if not isinstance(documents.schema[key].dataType, T.IntegralType):
        raise ValueError(f"{key} must be an integer to tell smaller documents, not {documents.schema[key].dataType}")
    base = kept.select(
        F.col(key).cast("bigint").alias("key"),
        F.xxhash64(text).alias("mark"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    base = base.filter("key IS NOT NULL")
    buckets = 4 * max(4, documents.rdd.getNumPartitions())

    found = repeated_intervals(base, buckets, span)
    listed = found.groupBy("key", "mark").agg(
        F.collect_set(F.struct(F.col("start").alias("s"), F.col("end").alias("e"))).alias("found")
    )

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_bytes(batches, names.index(text)):
            columns = [batch.column(name) for name in names]
            texts = batch.column(names.index(text)).fill_null("")
            out = {name: [] for name in added}
            for value, intervals in zip(texts, batch.column("_found"), strict=True):
                raw = value.as_buffer().to_pybytes()
                if intervals.is_valid:
                    pairs = intervals.values
                    starts, ends = merged(pairs.field(0).to_numpy(), pairs.field(1).to_numpy())
                else:
                    starts = ends = np.zeros(0, np.int64)
                edges = np.concatenate([[0], np.stack([starts, ends], axis=1).reshape(-1), [len(raw)]])
                left = b"".join(raw[a:b] for a, b in edges.reshape(-1, 2).tolist())
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(len(raw) - len(left))
                out["n_spans"].append(len(starts))
                out["spans"].append(
                    [{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                )
                out["kept"].append(left)
                out["kept_text"].append(left.decode("utf-8", "ignore") if len(left) < len(raw) else None)
            arrays = [
                pa.array(out[field.name], type=kind) for field, kind in zip(ADDED, ADDED_ARROW, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(columns + arrays, names=[*names, *added])

    listed = listed.select(
        F.col("key").alias("_key"), F.col("mark").alias("_mark"), F.col("found").alias("_found")
    )
    marked = kept.withColumns({"_key": F.col(key).cast("bigint"), "_mark": F.xxhash64(text)})
    marked = marked.join(listed, ["_key", "_mark"], "left")
    marked = marked.select(*names, "_found")
    return marked.mapInArrow(cut, T.StructType([*kept.schema.fields, *ADDED]))


INTERVAL = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
ADDED = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("n_spans", T.LongType()),
    T.StructField("spans", T.ArrayType(INTERVAL)),
    T.StructField("kept", T.BinaryType()),
    T.StructField("kept_text", T.StringType()),
]
ADDED_ARROW = [
    pa.int64(),
    pa.int64(),
    pa.int64(),
    pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
    pa.binary(),
    pa.string(),
]
