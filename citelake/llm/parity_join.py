"""N-gram Jaccard join by parity sketches (operator 4).

A document is the set of its distinct shingles. Two sets A and B with Jaccard t or more differ in at
most d = (1-t)/(1+t) (|A|+|B|) shingles. A sketch deals the shingles into parts by hash and XORs
those of a part together: one shingle more or less changes one part, so the number of parts in which
two sketches differ (their Hamming distance) is at most the sets' difference. Of any d + 1 parts that
a set fills, one must therefore be alike in both (pigeonhole), and parts that are alike meet in a
join. The number of parts depends on the sets' size, so sets are joined by size band; a set that a
larger band's sets may match is sketched for that band as well.

Which d + 1 parts are taken is free as long as all documents order parts alike. Parts of shingles
that much of the corpus shares come last: a counter array of fixed size over all documents tells
them apart. It decides the order only, so no link depends on it.

Exact copies are joined as one set. Sets that meet are compared in full, in two rounds: first each
with the smallest of those it met, then, across the components that this gave, all that met.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.llm.components import components
from citelake.llm.scratch import forget, written
from citelake.llm.sieve import passes, sieve
from citelake.llm.words import chunks, column_words, mixed, shingle_hashes, shingle_set

SHINGLE = 5
PERCENT = 75
# Counters that tell common shingles from rare ones, and a row's share of them.
SLOTS = 1 << 20
SLOTS_A_ROW = 1 << 12
# Copies of a small side that rows of a large class are dealt out over; keys compared by one task.
SALTS = 16
BLOCK = 512
# Bits of a sketch for each shingle of the largest set of its band.
BITS_A_SHINGLE = 4
# Sets of fewer shingles than this have one part for each shingle.
SMALL_BAND = 3
# Words whose shingles are worked out at once.
WORDS_A_CHUNK = 1 << 16
# Pairs, and 64-bit words of sketches, that a task compares at once.
PAIRS_AT_ONCE = 1 << 18
WORDS_AT_ONCE = 1 << 20


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    words = column_words(batch.column(1))
    places = words.places.tolist()
    for first, last in chunks(words.places, WORDS_A_CHUNK):
        # Shingles that lie in two texts are worked out as well, and passed over.
        hashes = shingle_hashes(words.hashes[places[first] : places[last]], size)
        for i in range(first, last):
            if places[i + 1] - places[i] < size:
                yield i, shingle_set(words.of(i), size)
            else:
                found = np.sort(hashes[places[i] - places[first] : places[i + 1] - places[first] - size + 1])
                yield i, found[np.append(True, found[1:] != found[:-1])]


def _different_sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of equal sets in a batch, the first alone; they are joined as copies."""
    seen = set()
    for i, s in _sets(batch, size):
        mark = (len(s), s.tobytes() if len(s) < 8 else (int(s[0]), int(s[-1]), int(s.sum())))
        if len(s) and mark not in seen:
            seen.add(mark)
            yield i, s


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(44)).astype(np.int64) % SLOTS


def common_slots(rows: DataFrame, size: int) -> np.ndarray:
    """How far above the mean each counter stands, from 0 to 255: an array of fixed size."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for _, s in _different_sets(batch, size):
                np.add.at(total, _slot(s), 1)
        if total.any():
            parts = total.astype("<u4").reshape(-1, SLOTS_A_ROW)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(parts), dtype=np.int32)),
                    pa.array([p.tobytes() for p in parts], pa.binary()),
                ],
                names=["row", "counts"],
            )

    def add(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS_A_ROW, dtype=np.int64)
        row = None
        for batch in group:
            row = batch.column("row")[:1]
            for counts in batch.column("counts"):
                total += np.frombuffer(counts.as_buffer(), dtype="<u4")
        yield pa.RecordBatch.from_arrays(
            [row, pa.array([total.tobytes()], pa.binary())], names=["row", "counts"]
        )

    counted = (
        rows.mapInArrow(count, "row int, counts binary")
        .groupBy("row")
        .applyInArrow(add, "row int, counts binary")
    )
    total = np.zeros(SLOTS, dtype=np.int64)
    for row in counted.collect():  # SLOTS numbers, whatever the size of the corpus
        at = row["row"] * SLOTS_A_ROW
        total[at : at + SLOTS_A_ROW] = np.frombuffer(row["counts"], dtype=np.int64)
    mean = total.mean()
    above = (total - mean) / max(mean, 4.0) ** 0.5 / 2
    return np.clip(above, 0, 255).astype(np.uint8)


def band_of(n: int) -> int:
    """0 for 1 to 3 shingles, 1 for 4 to 15, 2 for 16 to 63 and so on."""
    return (n.bit_length() - 1) // 2


def features(shingles: np.ndarray, common: np.ndarray, percent: int) -> list[np.ndarray]:
    """Hashes of the parts by which a set meets others: d + 1 for each band it may match in."""
    n = len(shingles)
    band, largest, found = band_of(n), 100 * n // percent, []
    rare_first = common[_slot(shingles)].astype(np.uint64) << np.uint64(56)
    for at in (band, band + 1):
        top = 4 ** (at + 1) - 1
        if at > band and largest <= 4**at - 1:
            break
        partner = min(largest, top)
        differ = (100 - percent) * (n + partner) // (100 + percent)
        part = mixed(shingles ^ np.uint64(at + 1))
        if at >= SMALL_BAND:
            part = (part & np.uint64(top)) << np.uint64(8)
        part = rare_first | (part >> np.uint64(8))
        order = np.argsort(part)
        part = part[order]
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        end, first = first[differ + 1] if len(first) > differ + 1 else n, first[: differ + 1]
        sketch = np.bitwise_xor.reduceat(mixed(shingles[order[:end]]), first)
        found.append(mixed(sketch ^ mixed(part[first] + np.uint64(at) * np.uint64(1 << 40))))
    return found


def sketch_bits(shingles: np.ndarray, at: int) -> bytes:
    """One bit for each of many small parts, turned over by every shingle that falls into it."""
    size = BITS_A_SHINGLE * max(16, 4 ** (at + 1))
    place = (mixed(shingles ^ np.uint64(at + 1)) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=size) & 1).astype(np.uint8)).tobytes()


def reaches_next(n: int, percent: int) -> bool:
    """Whether a set of this size can match one of the next band."""
    return 100 * n // percent >= 4 ** (band_of(n) + 1)


def sketch_rows(column: pa.Array, rows: np.ndarray) -> np.ndarray:
    """Sketches of one band as a matrix of 64-bit words."""
    taken = column.take(pa.array(rows))
    places = np.frombuffer(taken.buffers()[1], dtype=np.int32)[taken.offset : taken.offset + len(rows) + 1]
    body = np.frombuffer(taken.buffers()[2], dtype=np.uint8)[places[0] : places[-1]]
    return body.view(np.uint64).reshape(len(rows), -1)


def close_pairs(sizes, own: pa.Array, above: pa.Array, one, two, percent: int) -> np.ndarray:
    """Which of the pairs (one[i], two[i]) differ in no more bits than the similarity allows.

    Some words of two sketches differ in no more bits than all of them, so a pair is dropped at the
    first quarter that exceeds what is allowed.
    """
    larger = sizes[one] > sizes[two]
    one, two = np.where(larger, two, one), np.where(larger, one, two)
    low, high = sizes[one], sizes[two]
    allowed = (100 - percent) * (low + high) // (100 + percent)
    band = (np.frexp(sizes.astype(np.float64))[1] - 1) // 2  # as in ``band_of``
    reaches = above.is_valid().to_numpy(zero_copy_only=False)
    fits, close = 100 * low >= percent * high, np.zeros(len(one), dtype=bool)
    for at in np.unique(band[two[fits]]):
        mine, raised = np.flatnonzero(band == at), np.flatnonzero((band == at - 1) & reaches)
        words = sketch_rows(own, mine)
        if len(raised):
            words = np.concatenate([words, sketch_rows(above, raised)])
        place = np.full(len(sizes), -1)
        place[mine], place[raised] = np.arange(len(mine)), np.arange(len(mine), len(words))
        which = np.flatnonzero(fits & (band[two] == at) & (place[one] >= 0))
        quarter, step = -(-words.shape[1] // 4), max(1, WORDS_AT_ONCE // words.shape[1])
        for first in range(0, len(which), step):
            pairs = which[first : first + step]
            left = allowed[pairs]
            for part in range(0, words.shape[1], quarter):
                x, y = (words[place[side[pairs]], part : part + quarter] for side in (one, two))
                left = left - np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
                pairs, left = pairs[left >= 0], left[left >= 0]
            close[pairs] = True
    return close


def jaccard_links(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> tuple[DataFrame, DataFrame]:
    """``sets`` (key, n_shingles, class_id) with a row for each document, and ``links`` (a, b) between
    classes: enough of them to give the components, each verified.

    ``class_id`` is the smallest key of those with the same set, null for documents without words.
    Keys are integers; other keys are refused, and rows whose key is null are left out. Rows that share
    a key stand for one document, which is linked through any of them.
    """
    if not isinstance(documents.schema[key].dataType, T.IntegralType):
        raise TypeError(f"the keys of {key} are not integers")
    rows = documents.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    rows = rows.filter("key IS NOT NULL")

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two, own, above = [], [], [], [], []
            for _, s in _sets(batch, size):
                n.append(len(s))
                one.append(int(s.sum().view(np.int64)) if len(s) else 0)
                two.append(int(np.bitwise_xor.reduce(mixed(s)).view(np.int64)) if len(s) else 0)
                own.append(sketch_bits(s, band_of(len(s))) if len(s) else None)
                more = len(s) and reaches_next(len(s), percent)
                above.append(sketch_bits(s, band_of(len(s)) + 1) if more else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(x, pa.int64()) for x in (n, one, two)],
                    *[pa.array(x, pa.binary()) for x in (own, above)],
                ],
                names=["key", "n_shingles", "one", "two", "own", "above"],
            )

    columns = "key bigint, n_shingles bigint, one bigint, two bigint, own binary, above binary"
    measured = written(rows.mapInArrow(measure, columns))
    same = ["n_shingles", "one", "two"]
    filled = measured.filter("n_shingles > 0")
    classes = filled.groupBy(*same).agg(F.min("key").alias("class_id"), F.count("*").alias("copies"))
    # Only classes of several rows are looked up again; for the rest the class is the key.
    several = written(classes.filter("copies > 1").drop("copies"))
    parted = several.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    sets = written(
        measured.withColumn("salt", salted("key"))
        .join(parted, [*same, "salt"], "left")
        .select(
            "key",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.coalesce("class_id", "key")).alias("class_id"),
        )
    )
    copies = sets.filter("class_id != key").select("key", "class_id")
    sketches = measured.select("key", F.col("n_shingles").alias("n"), "own", "above")
    common = rows.sparkSession.sparkContext.broadcast(common_slots(rows, size))

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            found, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for i, s in _different_sets(batch, size):
                for part in features(s, common.value, percent):
                    found.append(part)
                    owner.append(np.full(len(part), keys[i], dtype=np.int64))
            found, owner = np.concatenate(found).view(np.int64), np.concatenate(owner)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(owner)], names=["part", "key"])

    parts = rows.mapInArrow(sketch, "part bigint, key bigint").repartition("part")
    runs = parts.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    raw = written(parts.join(runs.filter("low < high").select("part"), "part"))
    common.destroy()
    # Copies count as their class from here on.
    met = raw.join(copies, "key", "left").select("part", F.coalesce("class_id", "key").alias("key"))
    met = written(met.distinct())
    forget(raw)

    # The hub of a run is whom most of the others meet, as a rule what the others are copies of.
    crowd = met.groupBy("part").agg(F.count("*").alias("n_run")).filter("n_run > 1")
    crowd = written(met.join(crowd, "part"))
    forget(met)
    degree = written(crowd.groupBy("key").agg(F.sum("n_run").alias("degree")))
    ranked = crowd.join(degree, "key").groupBy("part").agg(
        F.max(F.struct(F.col("degree"), (-F.col("key")).alias("minus"))).alias("best")
    )
    hubs = written(ranked.select("part", (-F.col("best.minus")).alias("hub")))
    first = crowd.join(hubs, "part").filter("hub != key")
    first = first.select(F.least("hub", "key").alias("a"), F.greatest("hub", "key").alias("b")).distinct()
    links = verified(rows, written(_close(first, sketches, percent)), size, percent)
    placed = components(links)

    named = crowd.select("part", "key").join(placed, crowd["key"] == placed["node"], "left")
    named = written(named.select("part", "key", F.coalesce("component", "key").alias("component")))
    second = _across(named, sketches, percent).distinct().join(links, ["a", "b"], "left_anti")
    second = written(second)
    more = verified(rows, second, size, percent)
    forget(measured, several, crowd, degree, hubs, named, second)
    return sets, links.unionByName(more)


def salted(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")


def _close(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches are close enough; a pair is two rows of keys."""
    of_a = sketches.select(F.col("key").alias("a"), *[F.col(c).alias(f"{c}_a") for c in ("n", "own", "above")])
    of_b = sketches.select(F.col("key").alias("b"), *[F.col(c).alias(f"{c}_b") for c in ("n", "own", "above")])

    def test(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, own, above = (
                pa.concat_arrays([batch.column(f"{name}_a"), batch.column(f"{name}_b")])
                for name in ("n", "own", "above")
            )
            one = np.arange(batch.num_rows)
            close = close_pairs(sizes.to_numpy(), own, above, one, one + len(one), percent)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(close)), batch.column("b").filter(pa.array(close))],
                names=["a", "b"],
            )

    return pairs.join(of_b, "b").join(of_a, "a").mapInArrow(test, "a bigint, b bigint")


def _across(named: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs with close sketches that met in some part and lie in different components.

    Parts with the same members are taken once, and those with two members were settled with their
    hub. Large ones are cut into blocks, and every two blocks are compared by a task of their own.
    """
    runs = named.groupBy("part").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.count("*").alias("n_run"),
        F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("one"),
        F.bit_xor(F.xxhash64("key", F.lit(1))).alias("two"),
    )
    chosen = runs.filter("low < high AND n_run > 2").groupBy("n_run", "one", "two").agg(F.min("part").alias("part"))
    chosen = chosen.select("part", F.ceil(F.col("n_run") / BLOCK).cast("int").alias("blocks"))
    members = named.join(chosen, "part").withColumn(
        "block", F.pmod(F.xxhash64("key", F.lit(2)), F.col("blocks")).cast("int")
    )
    members = members.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.join(sketches, "key").select(
        "part",
        F.least("block", "with").alias("i"),
        F.greatest("block", "with").alias("j"),
        "block",
        "key",
        "component",
        "n",
        "own",
        "above",
    )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in whole_runs(batches):
            yield from pairs_across(runs, percent)

    # Runs are small and many: a task takes those of a batch together, in order, not one by one.
    dealt = members.repartition("part", "i", "j").sortWithinPartitions("part", "i", "j", "block")
    return dealt.mapInArrow(compare, "a bigint, b bigint")


def whole_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order of part, i and j as tables that cut no run in two."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        begins = run_starts(held)
        if len(begins) > 1:
            yield held.slice(0, begins[-1])
            held = held.slice(begins[-1])
    if held is not None and held.num_rows:
        yield held


def run_starts(rows: pa.Table) -> np.ndarray:
    new = np.arange(rows.num_rows) == 0
    for name in ("part", "i", "j"):
        value = rows.column(name).to_numpy()
        new[1:] |= value[1:] != value[:-1]
    return np.flatnonzero(new)


def pairs_across(runs: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Close pairs of different components in whole runs, between the blocks i and j of each."""
    column = {name: runs.column(name).to_numpy() for name in ("i", "j", "block", "key", "component", "n")}
    own, above = (pa.concat_arrays(runs.column(name).chunks) for name in ("own", "above"))
    component, size, key = column["component"], column["n"], column["key"]
    new = run_starts(runs)
    many = np.diff(np.append(new, runs.num_rows))
    left = column["block"] == column["i"]
    # A row of block i meets the rows of block j, or those after it if that is its own block.
    other = np.repeat(new + np.add.reduceat(left.astype(np.int64), new), many)
    begin = np.where(column["i"] == column["j"], np.arange(runs.num_rows) + 1, other)
    met = np.where(left, np.repeat(new + many, many) - begin, 0)
    places = np.append(0, np.cumsum(met))
    for first, last in chunks(places, PAIRS_AT_ONCE):
        x = np.repeat(np.arange(first, last), met[first:last])
        y = np.arange(places[first], places[last]) + np.repeat(begin[first:last] - places[first:last], met[first:last])
        fits = component[x] != component[y]
        fits &= 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
        x, y = x[fits], y[fits]
        close = close_pairs(size, own, above, x, y, percent)
        a, b = key[x[close]], key[y[close]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
        )


def verified(rows: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose sets reach the similarity."""
    nodes = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key")))
    wanted = rows.sparkSession.sparkContext.broadcast(
        sieve(nodes.distinct().select(F.xxhash64("key").alias("lead")))
    )

    def shingles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(wanted.value, batch.column(2).to_numpy().view(np.uint64))))
            found = [s.view(np.int64) for _, s in _sets(batch, size)]
            places = np.cumsum([0, *[len(s) for s in found]]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.int64), *found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(places), pa.array(values))],
                names=["key", "shingles"],
            )

    lead = rows.select("key", "text", F.xxhash64("key").alias("lead"))
    sets = written(lead.mapInArrow(shingles, "key bigint, shingles array<bigint>"))
    wanted.destroy()
    of_a = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    of_b = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    either = F.size("sa") + F.size("sb") - both
    close = pairs.join(of_b, "b").join(of_a, "a").filter(100 * both >= percent * either)
    close = written(close.select("a", "b"))
    forget(sets)
    return close


def near_duplicates(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """``key``, ``n_shingles``, ``class_id``, ``component_id`` for each row.

    ``component_id`` is the smallest key reachable by links, the row's own included. Documents
    without words (blank, empty or null texts) are linked with nothing. Rows whose key is null cannot be
    named by a link: each stands for itself, with null as class and component. An empty table gives no
    rows.
    """
    sets, links = jaccard_links(documents, key, text, size, percent)
    placed = components(links)
    joined = sets.join(placed, sets["class_id"] == placed["node"], "left")
    named = joined.select(
        F.col("key").alias(key),
        "n_shingles",
        "class_id",
        F.coalesce("component", "class_id", "key").alias("component_id"),
    )

    columns = named.columns

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(s) for _, s in _sets(batch, size)]
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(n, pa.int64()), none, none], names=columns)

    unnamed = documents.filter(F.col(key).isNull()).select(F.lit(0).alias("key"), F.col(text).alias("text"))
    return named.unionByName(unnamed.mapInArrow(count, named.schema))
