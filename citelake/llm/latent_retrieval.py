"""Benchmark decontamination by latent semantic retrieval (operator 3).

1. Document frequencies of hashed words over all documents.
2. Randomised SVD of the TF-IDF matrix of all passages: each task multiplies its passages into a
   random matrix and back, the products of fixed size are added up, and an orthonormal basis of their
   sum spans the corpus's latent directions.
3. The TF-IDF vectors of the items span a latent space of their own, of ``DIRECTIONS`` directions. Items and
   passages of all documents are projected into it, weighted by the inverse of its singular values; a passage
   becomes a candidate for an item if their cosine is at least ``COSINE`` and the passage reaches ``REACH`` of
   the item's length along it. Passages are the words of 2^k blocks of ``STEP`` words, at least as long as the
   item and less than twice so (``SHORTEST`` words at least), and overlap by three quarters.
4. What the cosine may miss is added by counting words. Items of more than ``WHOLE`` words are cut into pieces
   of about ``PIECE``. A stretch of a document becomes a candidate if it holds half of a whole item's words, or
   a third of a piece's. That counts the item's own words, so neither its length nor the words beside a copy
   matter. A known number of the rarest words must then be there, so only these are looked up at first; this
   drops nothing.
5. Around the candidates, stretches of twice the item's length are checked word by word: the longest common
   subsequence with the whole item must cover ``LCS_SHARE`` of the item, or ``PARAPHRASE_SHARE`` if the answer
   is found in or near the stretch as well and ``score`` is at least ``SCORE``. ``score`` is the share of the
   item's own squared TF-IDF weight that the stretch holds; the cosine of that part with the item in the
   corpus's latent directions (2) counts a fifth of it. Where the benchmark has no answers, an item's last
   sentence stands for its answer.

By the word counts, what covers ``LCS_SHARE`` of an item is found if it lies in at most 1.8 times the item's length; so is what
covers ``PARAPHRASE_SHARE`` of a whole item, and of one in pieces if it lies in at most the item's length.

Items are taken in blocks of ``BLOCK_ITEMS``, so that what is sent to the tasks has a fixed size.

Defined results: null or blank texts and items match nothing; repeated rows are searched per row;
empty tables give no rows; other columns are left out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.llm.words import byte_spans, chunk_words, chunks, column_words

BINS = 1 << 20
LATENT_BINS = 1 << 14
RANK, SPARE = 24, 8
WINDOW = 32
WHOLE, PIECE = 96, 64
BLOCK_ITEMS = 512
SCORE, LATENT_WEIGHT = 0.4, 0.2
LCS_SHARE, PARAPHRASE_SHARE, ANSWER_SHARE = 0.75, 0.5, 0.8
DIRECTIONS, COSINE, REACH = 64, 0.7, 0.3
STEP, SHORTEST = 8, 32
AT_ONCE = 1 << 11
COUNTS_A_ROW = 1 << 14
COLUMNS = ("score", "lcs_share", "answer_share", "cosine")


def bins_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many documents each bin occurs in, and how many documents there are."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BINS, dtype=np.int64), 0
        for batch in batches:
            n += batch.num_rows
            body, places = byte_spans(batch.column(0))
            for first, last in chunks(places):
                at = places[first]
                words = chunk_words(body[at : places[last]], places[first : last + 1] - at)
                owner = np.repeat(np.arange(last - first), np.diff(words.places))
                cells = owner * BINS + bins_of(words.hashes)
                cells.sort()
                np.add.at(total, cells[np.diff(cells, prepend=-1) > 0] & (BINS - 1), 1)
        if n:
            parts = [p.astype("<u4").tobytes() for p in total.reshape(-1, COUNTS_A_ROW)]
            rows = np.arange(len(parts) + 1, dtype=np.int32)
            parts.append(np.full(1, n, "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(parts, pa.binary())], names=["row", "sums"]
            )

    got = added(texts.mapInArrow(count, "row int, sums binary"), "<u4", np.int64)
    if not got:
        return np.zeros(BINS), 0
    last = BINS // COUNTS_A_ROW
    return np.concatenate([got[i] for i in range(last)]).astype(float), int(got[last][0])


def added(parts: DataFrame, kind: str, into: type) -> dict[int, np.ndarray]:
    """Sum arrays of fixed size by row; the sums come to the driver."""

    def add(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, row = 0, None
        for batch in group:
            row = batch.column("row")[:1]
            for value in batch.column("sums"):
                total = total + np.frombuffer(value.as_buffer(), dtype=kind).astype(into)
        yield pa.RecordBatch.from_arrays(
            [row, pa.array([total.tobytes()], pa.binary())], names=["row", "sums"]
        )

    summed = parts.groupBy("row").applyInArrow(add, "row int, sums binary")
    return {r["row"]: np.frombuffer(r["sums"], dtype=into) for r in summed.collect()}


def latent_basis(texts: DataFrame, idf: np.ndarray) -> np.ndarray:
    """An orthonormal basis (latent bin by rank) of the leading directions of all passages."""
    width = RANK + SPARE
    sent = texts.sparkSession.sparkContext.broadcast(idf)

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(3).normal(0, 1, (LATENT_BINS, width)).T.copy()
        total, seen = np.zeros((width, LATENT_BINS)), False
        for batch in batches:
            body, places = byte_spans(batch.column(0))
            for first, last in chunks(places):
                at = places[first]
                words = chunk_words(body[at : places[last]], places[first : last + 1] - at)
                if not len(words.hashes):
                    continue
                seen = True
                there_and_back(words, sent.value, random, total)
        if seen:
            parts = total.T.astype("<f4").reshape(-1, 1024 * width)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(parts), dtype=np.int32)),
                    pa.array([p.tobytes() for p in parts], pa.binary()),
                ],
                names=["row", "sums"],
            )

    got = added(texts.mapInArrow(multiply, "row int, sums binary"), "<f4", np.float64)
    if not got:
        return np.zeros((LATENT_BINS, RANK), dtype=np.float32)
    product = np.concatenate([got[i] for i in range(len(got))]).reshape(LATENT_BINS, width)
    left, size, _ = np.linalg.svd(product, full_matrices=False)
    return (left[:, :RANK] * (size[:RANK] > 1e-9)).astype(np.float32)


def there_and_back(words, idf: np.ndarray, random: np.ndarray, total: np.ndarray) -> None:
    """Add to ``total`` the passages' TF-IDF rows of unit length, multiplied into ``random`` and back."""
    bins = bins_of(words.hashes)
    weight, bins = idf[bins].astype(np.float64), bins & (LATENT_BINS - 1)
    start, _, _ = windows(words.places, WINDOW, WINDOW)
    size = np.diff(np.append(start, len(bins)))
    norm = np.sqrt(np.add.reduceat(weight**2, start)) + 1e-9
    back = weight / np.repeat(norm**2, size)
    for d in range(len(random)):  # flat arrays: sums of short rows take several times as long
        passage = np.add.reduceat(random[d][bins] * weight, start)
        total[d] += np.bincount(bins, np.repeat(passage, size) * back, minlength=LATENT_BINS)


def windows(places: np.ndarray, window: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of the windows; the windows of a text cover all its words."""
    size = np.diff(places)
    many = np.where(size > 0, np.maximum(1, -(-(size - (window - stride)) // stride)), 0)
    owner = np.repeat(np.arange(len(size)), many)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    start = places[owner] + nth * stride
    return start, np.minimum(start + window, places[owner + 1]), owner


@dataclass
class Items:
    """A block of benchmark items as the tasks need it."""

    rows: np.ndarray  # bin -> row of the items' words, or -1
    first: np.ndarray  # where a row's pieces begin in ``piece`` and ``times``
    piece: np.ndarray  # pieces that have the row among their rarest words
    times: np.ndarray  # how often they have it there
    size: np.ndarray  # of each piece, in words
    least: np.ndarray  # how many of its words a candidate holds
    need: np.ndarray  # and how many of its rarest
    cells: np.ndarray  # length of a candidate in lengths of the piece
    item: np.ndarray  # the piece's item
    held: list[dict[int, int]]  # row -> how often the piece has it
    words: list[list[int]]
    where: list[dict[int, int]]  # word -> its places in the item, as bits
    answers: list[list[int]]
    bins: list[np.ndarray]
    space: np.ndarray  # row -> the word's weight in each latent direction of the items
    points: np.ndarray  # the items there
    lengths: np.ndarray  # their own lengths in words


def last_sentence(text: str | None) -> str:
    parts = [p for p in (text or "").replace("\n", " ").split(". ") if p.strip()]
    return parts[-1] if parts else ""


def item_space(row: np.ndarray, places: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Each word's weight in the leading directions of the items' TF-IDF vectors (rows by directions)."""
    n, item = len(places) - 1, np.repeat(np.arange(len(places) - 1), np.diff(places))
    cells, times = np.unique(row * n + item, return_counts=True)
    row, item = cells // n, cells % n
    value = times * weight[row].astype(np.float64)
    value /= np.sqrt(np.bincount(item, value**2, minlength=n))[item] + 1e-9
    products = np.zeros((n, n))
    edges = np.searchsorted(row, np.arange(0, len(weight) + AT_ONCE, AT_ONCE))
    for a, b in zip(edges, edges[1:], strict=False):
        part = np.zeros((n, AT_ONCE))
        part[item[a:b], row[a:b] % AT_ONCE] = value[a:b]
        products += part @ part.T
    squares, vectors = np.linalg.eigh(products)
    lead = np.argsort(-squares)[:DIRECTIONS]
    lead = lead[squares[lead] > 1e-6]
    # Right singular vectors over the singular values: items' vectors over the squares of these.
    turned = vectors[:, lead] / squares[lead]
    space = np.zeros((len(weight), len(lead)))
    for d in range(len(lead)):
        space[:, d] = np.bincount(row, value * turned[item, d], minlength=len(weight))
    return (space * weight[:, None]).astype(np.float32)


def prepare(texts: list[str], answers: list[str], idf: np.ndarray) -> Items:
    found = column_words(pa.array(texts, pa.string()))
    asked = column_words(pa.array(answers, pa.string()))
    bins = bins_of(found.hashes)
    used = np.unique(bins)
    rows = np.full(BINS, -1, dtype=np.int32)
    rows[used] = np.arange(len(used))
    pieces, held, rare = [], [], []
    for i, n in enumerate(np.diff(found.places)):
        parts = 1 if n <= WHOLE else round(n / PIECE)
        edges = np.linspace(0, n, parts + 1).astype(int) if n else [0]
        for low, high in zip(edges, edges[1:], strict=False):
            own = bins[found.places[i] + low : found.places[i] + high]
            size = len(own)
            least = int(np.ceil(size * PARAPHRASE_SHARE)) if parts == 1 else -(-size // 3)
            need = max(1, size // 6)
            # At most ``size - least`` words are missing, so of ``need`` more than that ``need`` are there.
            rarest = own[np.argsort(-idf[own], kind="stable")][: size - least + need]
            which, times = np.unique(rows[rarest], return_counts=True)
            rare.append((which, np.full(len(which), len(pieces)), times))
            held.append(dict(zip(*(x.tolist() for x in np.unique(rows[own], return_counts=True)), strict=True)))
            pieces.append((size, least, need, 3 if parts == 1 else 5, i))
    which, piece, times = [np.concatenate(x) for x in zip(*rare, strict=True)] if rare else [np.zeros(0, int)] * 3
    order = np.argsort(which, kind="stable")
    size, least, need, cells, item = np.array(pieces, dtype=np.int64).reshape(-1, 5).T
    row = rows[bins].astype(np.int64)
    space = item_space(row, found.places, idf[used])
    points = [space[row[a:b]].sum(axis=0) for a, b in zip(found.places, found.places[1:], strict=False)]
    return Items(
        rows,
        np.searchsorted(which[order], np.arange(len(used) + 1)),
        piece[order],
        times[order],
        size,
        least,
        need,
        cells,
        item,
        held,
        [found.of(i).tolist() for i in range(len(texts))],
        [places_of(found.of(i).tolist()) for i in range(len(texts))],
        [asked.of(i).tolist() for i in range(len(texts))],
        [bins[a:b] for a, b in zip(found.places, found.places[1:], strict=False)],
        space,
        np.array(points, dtype=np.float32).reshape(len(texts), -1) if points else np.zeros((0, 0), np.float32),
        np.diff(found.places),
    )


def places_of(words: list[int]) -> dict[int, int]:
    """The places that each word has, as the bits of a number."""
    where: dict[int, int] = {}
    for i, word in enumerate(words):
        where[word] = where.get(word, 0) | 1 << i
    return where


def common_places(hits: Iterable[int], size: int) -> int:
    """Length of the longest common subsequence of ``size`` words with words that stand at ``hits`` of them."""
    full = open_places = (1 << size) - 1
    for places in hits:
        hit = open_places & places
        open_places = ((open_places + hit) | (open_places - hit)) & full
    return size - open_places.bit_count()


def common_length(one: list[int], two: list[int]) -> int:
    """Length of the longest common subsequence."""
    where = places_of(one)
    return common_places((where[word] for word in two if word in where), len(one))


def retrieved(words, items: Items) -> dict[tuple[int, int], tuple[float, list[tuple[int, int]]]]:
    """(text, item) -> cosine of the nearest passage and stretches of words, apart from each other."""
    row = items.rows[bins_of(words.hashes)]
    at = np.flatnonzero(row >= 0)
    reach = np.sqrt((items.points.astype(np.float64) ** 2).sum(axis=1))
    if not len(at) or not reach.any():
        return {}
    size = np.diff(words.places)
    blocks = np.append(0, np.cumsum(-(-size // STEP)))
    text = np.repeat(np.arange(len(size)), size)[at]
    block = blocks[text] + (at - words.places[text]) // STEP
    new = np.flatnonzero(np.diff(block, prepend=-1))
    many, row = np.diff(np.append(new, len(at))), row[at]
    sums = items.space[row[new]]
    for nth in range(1, STEP):  # faster by far than adding up by runs, as whole rows are added
        more = np.flatnonzero(many > nth)
        sums[more] += items.space[row[new[more] + nth]]
    held = np.zeros((blocks[-1], sums.shape[1]), dtype=np.float32)
    held[block[new]] = sums
    scale = np.ceil(np.log2(np.maximum(items.lengths, SHORTEST) / STEP)).astype(int)
    scale[reach <= 0] = -1
    found = {}
    quarters, edges = held, blocks  # sums of 2^(k-2) blocks each, and where those of a text begin
    for k in range(2, scale.max() + 1):
        if k > 2:
            pairs, ends, owner = windows(edges, 2, 2)
            quarters, edges = added_up(quarters, pairs, ends), np.searchsorted(owner, np.arange(len(edges)))
        which = np.flatnonzero(scale == k)
        if not len(which):
            continue
        points = items.points[which] / reach[which, None].astype(np.float32)
        start, end, owner = windows(edges, 4, 1)
        hits = []
        for first in range(0, len(start), AT_ONCE):
            passages = added_up(quarters, start[first : first + AT_ONCE], end[first : first + AT_ONCE])
            along = passages @ points.T
            whole = np.sqrt((passages**2).sum(axis=1))
            some = np.flatnonzero(along.max(axis=1) >= COSINE * whole)
            along, whole = along[some], whole[some, None]
            window, column = np.nonzero((along >= COSINE * whole) & (along >= REACH * reach[which]))
            hits.append((first + some[window], which[column], along[window, column] / whole[window, 0]))
        if hits:
            window, item, cosine = (np.concatenate(x) for x in zip(*hits, strict=True))
            begin, stop = words.places[owner[window]], words.places[owner[window] + 1]
            low, high = ((x[window] - edges[owner[window]] << k - 2) * STEP + begin for x in (start, end))
            low = np.maximum(begin, low - items.lengths[item])
            high = np.minimum(stop, high + items.lengths[item])
            found.update(nearest(owner[window], item, cosine, low, high))
    return found


def added_up(rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of the few rows from each ``start`` to its ``end``."""
    sums = rows[start]
    for nth in range(1, int((end - start).max(initial=0))):
        more = np.flatnonzero(end - start > nth)
        sums[more] += rows[start[more] + nth]
    return sums


def nearest(document, item, cosine, low, high) -> dict[tuple[int, int], tuple[float, list[tuple[int, int]]]]:
    """(document, item) -> the greatest cosine and the stretches, joined. Of one pair, a stretch that begins
    later ends no earlier."""
    if not len(item):
        return {}
    order = np.lexsort((low, item, document))
    document, item, cosine, low, high = (x[order] for x in (document, item, cosine, low, high))
    other = np.append(True, (document[1:] != document[:-1]) | (item[1:] != item[:-1]))
    apart = np.flatnonzero(other | np.append(True, low[1:] > high[:-1]))
    spans = list(zip(low[apart].tolist(), high[np.append(apart[1:], len(order)) - 1].tolist(), strict=True))
    pairs = np.flatnonzero(other)
    cosines = np.minimum(np.maximum.reduceat(cosine, pairs), 1.0)
    edges = np.searchsorted(apart, np.append(pairs, len(order))).tolist()
    keys = zip(document[pairs].tolist(), item[pairs].tolist(), strict=True)
    return {
        key: (value, spans[a:b])
        for key, value, a, b in zip(keys, cosines.tolist(), edges, edges[1:], strict=False)
    }


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or adjoining stretches as one, in order."""
    apart: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if apart and low <= apart[-1][1]:
            apart[-1] = (apart[-1][0], max(high, apart[-1][1]))
        else:
            apart.append((low, high))
    return apart


def candidates(words, items: Items) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """(text, item) -> stretches of words, apart from each other, that hold enough of the item's words."""
    row = items.rows[bins_of(words.hashes)]
    places, total = words.places, len(row) + 1
    at = np.flatnonzero(row >= 0)
    many = items.first[row[at] + 1] - items.first[row[at]]
    at, many = at[many > 0], many[many > 0]
    listed = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - items.first[row[at]], many)
    place, piece = np.repeat(at, many), items.piece[listed]
    text = np.searchsorted(places, at, side="right") - 1
    begin = np.repeat(places[text], many)
    cell = place - (place - begin) % items.size[piece]
    # Each of the piece's words once in a cell of the piece's length.
    _, once = np.unique((piece * total + cell) * len(items.first) + row[place], return_index=True)
    key = piece[once] * total + cell[once]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    mass = np.concatenate([[0], np.cumsum(items.times[listed[once]])])
    cells, first = key[new], np.append(new, len(key))
    piece, begin = cells // total, cells % total
    text = np.searchsorted(places, begin, side="right") - 1
    end = np.minimum(begin + items.cells[piece] * items.size[piece], places[text + 1])
    last = first[np.searchsorted(cells, piece * total + end)]
    found: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for i in np.flatnonzero(mass[last] - mass[first[:-1]] >= items.need[piece]).tolist():
        p, low, high = int(piece[i]), int(begin[i]), int(end[i])
        inside = set(row[low:high].tolist())
        if sum(n for r, n in items.held[p].items() if r in inside) < items.least[p]:
            continue
        j, document = int(items.item[p]), int(text[i])
        if items.size[p] < len(items.words[j]):
            low = max(int(places[document]), low - 2 * len(items.words[j]))
            high = min(int(places[document + 1]), high + 2 * len(items.words[j]))
        found.setdefault((document, j), []).append((low, high))
    return {key: joined(spans) for key, spans in found.items()}


def likeness(bins: np.ndarray, item: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> float:
    """The share of the item's squared weight that ``bins`` hold, a fifth of it by the latent directions."""
    weight = idf[item].astype(np.float64)
    whole = (weight**2).sum()
    if not whole:
        return 0.0
    held = set(bins.tolist())
    there = np.array([b in held for b in item.tolist()])
    latent = basis[item & (LATENT_BINS - 1)] * weight[:, None]
    own, part = latent.sum(axis=0), latent[there].sum(axis=0)
    about = own @ part / (np.sqrt((own @ own) * (part @ part)) + 1e-9)
    return float((1 - LATENT_WEIGHT) * (weight[there] ** 2).sum() / whole + LATENT_WEIGHT * about)


def matches(words, items: Items, idf: np.ndarray, basis: np.ndarray):
    """(text, item, lcs share, score, answer share, cosine) of the best stretch that holds the item."""
    near = retrieved(words, items)
    counted = candidates(words, items)
    for document, j in near.keys() | counted.keys():
        cosine, spans = near.get((document, j), (None, []))
        spans = spans + counted.get((document, j), [])
        item, reply, best = items.words[j], items.answers[j], None
        n, (first, last) = len(item), words.places[document : document + 2].tolist()
        where, step = items.where[j], max(1, n // 8)
        # An answer of its own may stand beside the item.
        beside = 0 if item[-len(reply) :] == reply else WINDOW + len(reply)
        for low, high in spans:
            region = words.hashes[low:high].tolist()
            # Words that the item lacks change no subsequence.
            at = [i for i, word in enumerate(region) if word in where]
            hits = [where[region[i]] for i in at]
            there = 0  # no subsequence is longer than what is there in any order
            for places in hits:
                there |= places
            if there.bit_count() < PARAPHRASE_SHARE * n or common_places(hits, n) < PARAPHRASE_SHARE * n:
                continue
            stretches = []
            for start in range(0, max(1, len(region) - 2 * n + step), step):
                stop = min(start + 2 * n, len(region))
                lcs = common_places(hits[bisect_left(at, start) : bisect_left(at, stop)], n) / n
                if lcs >= PARAPHRASE_SHARE:
                    stretches.append((lcs, low + start, low + stop))
            # A stretch that shares less than the best one needs no score.
            for lcs, a, b in sorted(stretches, reverse=True):
                if best and lcs < best[0]:
                    break
                from_, to = max(first, a - beside), min(last, b + beside)
                answer = common_length(reply, words.hashes[from_:to].tolist()) / len(reply) if reply else 0.0
                score = likeness(bins_of(words.hashes[a:b]), items.bins[j], idf, basis)
                if lcs >= LCS_SHARE or (answer >= ANSWER_SHARE and score >= SCORE):
                    best = max(best or (lcs, score, answer), (lcs, score, answer))
        if best:
            yield document, j, *best, cosine


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    answer: str | None = None,
) -> DataFrame:
    """``key``, ``item``, ``score``, ``lcs_share``, ``answer_share`` and ``cosine`` for each document and item it
    holds; ``cosine`` is that of the nearest passage, null where the word counts alone found the item."""
    texts = documents.select(text)
    df, n = document_frequencies(texts)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32)
    basis = latent_basis(texts, idf)
    context = documents.sparkSession.sparkContext
    shared = context.broadcast((idf, basis))
    fields = [
        documents.schema[key],
        benchmark.schema[item],
        *[T.StructField(name, T.DoubleType()) for name in COLUMNS],
    ]

    def search(block: tuple[list, list[str], list[str]]) -> DataFrame:
        ids, bodies, answers = block
        sent = context.broadcast(prepare(bodies, answers, idf))

        def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            idf, basis = shared.value
            items = sent.value
            for batch in batches:
                keys, best = batch.column(0), {}
                body, places = byte_spans(batch.column(1))
                for first, last in chunks(places):
                    at = places[first]
                    words = chunk_words(body[at : places[last]], places[first : last + 1] - at)
                    for document, j, *found in matches(words, items, idf, basis):
                        best[first + document, j] = tuple(found)
                rows = sorted(best)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array([d for d, _ in rows], pa.int64())),
                        pa.array([ids[j] for _, j in rows], type=item_type),
                        pa.array([best[r][1] for r in rows], pa.float64()),
                        pa.array([best[r][0] for r in rows], pa.float64()),
                        pa.array([best[r][2] for r in rows], pa.float64()),
                        pa.array([best[r][3] for r in rows], pa.float64()),
                    ],
                    names=[key, item, *COLUMNS],
                )

        return documents.select(key, text).mapInArrow(find, T.StructType(fields))

    replies = F.col(answer) if answer else F.lit(None).cast("string")
    listed = benchmark.select(F.col(item), F.col(text).alias("body"), replies.alias("answer"))
    listed = listed.filter("body IS NOT NULL").orderBy(item)
    item_type = listed.limit(0).toArrow().schema.field(0).type
    result, block = None, ([], [], [])
    for row in listed.toLocalIterator():
        block[0].append(row[0])
        block[1].append(row[1])
        block[2].append(row[2] if row[2] is not None else last_sentence(row[1]))
        if len(block[0]) == BLOCK_ITEMS:
            found = search(block)
            result, block = found if result is None else result.unionByName(found), ([], [], [])
    if block[0] or result is None:
        found = search(block)
        result = found if result is None else result.unionByName(found)
    return result
