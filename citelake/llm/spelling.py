"""Spelling variant grouping by dense prefix-suffix tiling (operator 12).

Two words are near if one insertion, deletion or replacement of a code point makes one of the other. Then
their common prefix and common suffix together reach the longer word's length less one, and words that
differ meet that only if they are near. Blocks of words are laid out as two padded matrices of code
points, aligned left and right, and compared row against row at once.

Which words meet: with L the shorter word's length, its places are cut into ``PARTS`` stretches, and the edit
falls into one of them. What stands before that stretch and what stands behind it is the same in both words.
So a word is dealt to a bucket for each stretch, by its letters outside of it, both as a word of L letters
and as one of L + 1. A pair can meet in two buckets where letters repeat; it counts in the first that can
hold it. Buckets of more than ``BLOCK`` words are cut into blocks and their pairs of blocks are tiles of
their own, so no task holds more than two blocks of a bucket. A bucket's key is a hash; a collision only
brings words together that the comparison then parts.

A word's form is the near word that occurs most often, if ``RATIO`` times as often as the word itself.
Following forms ends after as many steps as the largest count has digits; the words that are a form and have
one are few, and are followed by doubling.

Defined results: null and empty texts have no words; documents that share a key, null included, are
counted once per row; among near words of equal count the first in code-point order is the form; an empty
table gives no rows; other columns are ignored. ``group_spellings`` expects each word once, and leaves out
null words and empty ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citelake.llm.run_table import ragged
from citelake.llm.scratch import forget, written
from citelake.llm.words import byte_spans

PARTS = 4
BLOCK = 1024
RATIO = 10
# Cells of a matrix compared at once.
CELLS = 1 << 20


def cut(length, part: int):
    """Where stretch ``part`` of a word of ``length`` begins."""
    return length * part // PARTS


def bucketed(words: DataFrame) -> DataFrame:
    """A row for each word and bucket: ``word``, ``n``, ``len``, ``part`` and the bucket's ``key``."""
    size = F.length("word")
    length, part = F.col("_at.len"), F.col("_at.part")
    begin = F.floor(length * part / PARTS).cast("int")
    end = F.floor(length * (part + 1) / PARTS).cast("int")
    rows = words.select(
        "word",
        "n",
        size.alias("size"),
        F.explode(
            F.array(
                *[
                    F.struct((size - longer).alias("len"), F.lit(part).alias("part"))
                    for part in range(PARTS)
                    for longer in (0, 1)
                ]
            )
        ).alias("_at"),
    ).filter("_at.len > 0")
    behind = length - end
    return rows.select(
        "word",
        "n",
        length.alias("len"),
        part.alias("part"),
        F.xxhash64(
            length, part, F.substring("word", F.lit(1), begin), F.substring("word", F.col("size") - behind + 1, behind)
        ).alias("key"),
    )


def tiled(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows with ``low`` and ``high``, the blocks that their tile compares, and their own ``side``."""
    crowded = written(
        rows.groupBy("key").agg(F.count("*").alias("_rows")).filter(F.col("_rows") > block)
    )
    if crowded.isEmpty():
        zero = F.lit(0)
        return rows.select("*", zero.alias("low"), zero.alias("high"), zero.alias("side"))
    blocks = crowded.select("key", F.ceil(F.col("_rows") / block).cast("int").alias("_blocks"))
    many = F.coalesce("_blocks", F.lit(1))
    return (
        rows.join(blocks, "key", "left")
        .withColumn("side", F.pmod(F.hash("word"), many))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), many - 1)))
        .select(
            *rows.columns,
            F.least("side", "_other").alias("low"),
            F.greatest("side", "_other").alias("high"),
            "side",
        )
    )


def code_points(words: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two matrices of the words' code points, left and right aligned, ``size`` wide, filled up with 0."""
    body, places = byte_spans(words)
    begins = np.concatenate([(body & 0xC0) != 0x80, [True]])
    at = np.concatenate([[0], np.cumsum(begins[:-1])])[places]
    points = np.frombuffer(body.tobytes().decode().encode("utf-32-le"), "<u4")
    lengths = np.diff(at)
    row = np.repeat(np.arange(len(lengths)), lengths)
    column = ragged(np.zeros(len(lengths), np.int64), lengths)
    kind = np.uint8 if not len(points) or points.max() < 256 else np.uint32
    left, right = np.zeros((2, len(lengths), size), kind)
    left[row, column] = points
    right[row, column + np.repeat(size - lengths, lengths)] = points
    return left, right


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many columns from the left agree in each row."""
    differs = np.column_stack([a != b, np.ones(len(a), bool)])
    return differs.argmax(axis=1)


def near_pairs(words: pa.Array, lengths: np.ndarray, parts: np.ndarray, tiles: np.ndarray, sides: np.ndarray, split: np.ndarray):
    """Rows i and j of near words; rows of a tile are neighbours.

    ``lengths`` are those of the buckets (a word has one code point more at most), all the same; ``split``
    tells tiles of two blocks, which compare only words of different ``sides``.
    """
    length = int(lengths[0])
    left, right = code_points(words, length + 1)
    longer = left[:, length] != 0
    edges = np.array([cut(length, p) for p in range(PARTS + 1)])
    found_i, found_j, apart = [], [], 1
    first = np.arange(len(tiles))
    while True:
        first = first[first + apart < len(tiles)]
        first = first[tiles[first] == tiles[first + apart]]
        if not len(first):
            break
        second = first + apart
        wanted = ~(longer[first] & longer[second]) & (~split[first] | (sides[first] != sides[second]))
        for at in range(0, len(first), max(1, CELLS // (length + 1))):
            part = slice(at, at + max(1, CELLS // (length + 1)))
            i, j = first[part][wanted[part]], second[part][wanted[part]]
            before, behind = common(left[i], left[j]), common(right[i, ::-1], right[j, ::-1])
            most = length + (longer[i] | longer[j])
            # words that are equal agree throughout; padding agrees as well and counts for neither
            before, behind = np.minimum(before, most), np.minimum(behind, most)
            near = (before + behind >= most - 1) & (before < most)
            own, stop = parts[i], length - behind
            near &= (edges[own + 1] >= stop) & ((own == 0) | (edges[own] < stop))
            found_i.append(i[near])
            found_j.append(j[near])
        apart += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_i]), np.concatenate([none, *found_j])


def near_words(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """``word``, ``near`` and ``near_n`` for each near word of a word; where that does not occur ``ratio``
    times as often, its name is left out."""
    rows = tiled(bucketed(words), block)
    order = ["len", "key", "low", "high"]

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by tile. Whole tiles of one length are compared together."""
        held: list[pa.RecordBatch] = []

        def emit(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            rows = rows.combine_chunks()
            lengths, keys, low, high, sides, parts, n = (
                rows[c].to_numpy() for c in ("len", "key", "low", "high", "side", "part", "n")
            )
            names = rows["word"].combine_chunks()
            starts = np.concatenate([[True], changes(lengths, keys, low, high)])
            tile = np.cumsum(starts)
            for at, to in same_length(lengths, tile):
                if to - at < 2:
                    continue
                cells = slice(at, to)
                i, j = near_pairs(
                    names.slice(at, to - at), lengths[cells], parts[cells], tile[cells], sides[cells], low[cells] != high[cells]
                )
                if not len(i):
                    continue
                one, two = np.concatenate([i, j]) + at, np.concatenate([j, i]) + at
                often = n[two] >= ratio * n[one]
                yield pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array(one)),
                        names.take(pa.array(two, mask=~often)),
                        pa.array(n[two], mask=~often),
                    ],
                    names=["word", "near", "near_n"],
                )

        many = 0
        for batch in batches:
            held.append(batch)
            many += batch.num_rows
            if many < 1 << 16:
                continue
            rows = pa.Table.from_batches(held)
            changed = changes(*(rows[c].to_numpy() for c in order))
            if changed.any():
                # what comes after the last change may go on in the next batch
                done = int(np.flatnonzero(changed)[-1]) + 1
                yield from emit(rows.slice(0, done))
                rows = rows.slice(done)
            held, many = rows.combine_chunks().to_batches(), rows.num_rows
        if many:
            yield from emit(pa.Table.from_batches(held))

    return (
        rows.repartition("key", "low", "high")
        .sortWithinPartitions(*order)
        .mapInArrow(compare, "word string, near string, near_n bigint")
    )


def changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before, from the second row on."""
    found = np.zeros(max(len(columns[0]) - 1, 0), bool)
    for column in columns:
        found |= column[1:] != column[:-1]
    return found


def same_length(lengths: np.ndarray, tile: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of whole tiles of one length that fill a matrix, or are a single tile."""
    starts = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
    ends = np.append(starts[1:], len(tile))
    at = 0
    while at < len(starts):
        begin, to = starts[at], at + 1
        rows = max(1, CELLS // (int(lengths[begin]) + 1))
        while to < len(starts) and lengths[starts[to]] == lengths[begin] and ends[to] - begin <= rows:
            to += 1
        yield int(begin), int(ends[to - 1])
        at = to


def group_spellings(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """``words`` (``word``, ``n``) with ``form``, ``root``, ``n_near`` and ``form_n``."""
    words = words.select("word", "n").filter("word != ''")
    near = near_words(words, ratio, block)
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near"))).alias("best"),
    )
    best = best.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))
    formed = written(words.join(best, "word", "left").fillna(0, ["n_near"]))
    links = formed.filter("form IS NOT NULL").select("word", "form")
    forms = links.select(F.col("form").alias("word")).distinct()
    chain = written(links.join(forms, "word", "left_semi").withColumnRenamed("form", "root"))
    while True:
        further = chain.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = written(chain.join(further, "root", "left").select("word", "root", "_next"))
        ended = longer.filter("_next IS NOT NULL").isEmpty()
        forget(chain)
        chain = longer.select("word", F.coalesce("_next", "root").alias("root"))
        if ended:
            break
        last, chain = longer, written(chain)
        forget(last)
    last = chain.select(F.col("word").alias("form"), F.col("root").alias("_root"))
    return formed.join(last, "form", "left").select(
        "word", "form", F.coalesce("_root", "form", "word").alias("root"), "n", "n_near", "form_n"
    )
