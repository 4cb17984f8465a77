"""Hidden Markov language model (operator 2).

Words fall into ``CLASSES`` classes by hash, the end of a text is a class of its own. A latent state
emits a class, and a class a word by its frequency in the training texts; so a state's table has a
fixed size, while word counts cover the whole vocabulary and stay in a table.

Each class keeps room for words not seen, so training texts should have several times as many tokens
as there are classes; with fewer, that room costs more than the states gain.

    P(text) = sum over state paths of  prod P(state | state before) P(class | state) P(word | class)

Baum-Welch: each task runs forward and backward over its texts and adds up expected counts; the sums
of fixed size come to the driver, which makes the next model. The forward recursion is scaled at each
token, so the likelihood of a text of any length is exact up to rounding.

To score, texts are dealt into blocks. Each block asks for the counts of its distinct words, once
however often they occur, and gets them in a join by word: no word makes a crowded key.

Defined results: a null or empty text is the end token alone; a null key counts as training data;
repeated rows are scored per row and counted per row; with no training texts every token is unknown.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.llm.scratch import written
from citelake.llm.words import column_words

STATES = 8
CLASSES = 1 << 15
ROUNDS = 5
ALPHA = 0.1  # added to a word's count
PRIOR = 2.0  # words' worth of the overall class distribution added to a state's, for each class
GROUP_TOKENS = 1_500_000
END = 0x7E57_E17D_5EED_0001
CLASSES_A_ROW = 1 << 10


def held_out(key: Column) -> Column:
    """crc32 of the key as text, modulo 10, is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def token_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, the end token behind each, and the places of the texts."""
    words = column_words(column)
    tokens = np.insert(words.hashes, words.places[1:], np.uint64(END))
    return tokens, words.places + np.arange(len(words.places))


def classes_of(tokens: np.ndarray) -> np.ndarray:
    found = (tokens >> np.uint64(64 - (CLASSES - 1).bit_length())).astype(np.int32)
    found[tokens == np.uint64(END)] = CLASSES
    return found


@dataclass
class Model:
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray  # class by state


def groups(places: np.ndarray) -> Iterator[tuple[int, int]]:
    first = 0
    while first < len(places) - 1:
        last = int(np.searchsorted(places, places[first] + GROUP_TOKENS, side="right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def by_time(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order the tokens of many texts by their place in the text, the longer texts first.

    Returns each token's new place, where each time step begins, and the texts in that order.
    """
    sizes = np.diff(places)
    texts = np.argsort(-sizes, kind="stable")
    rank = np.empty(len(texts), dtype=np.int64)
    rank[texts] = np.arange(len(texts))
    active = np.cumsum(np.bincount(sizes, minlength=1)[::-1])[::-1][1:]
    begin = np.concatenate([[0], np.cumsum(active)])
    time = np.arange(places[-1] - places[0]) - np.repeat(places[:-1] - places[0], sizes)
    return begin[time] + np.repeat(rank, sizes), begin, texts


def forward(model: Model, seen: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Scaled forward recursion, in place: ``seen`` holds the emissions of each token's class and
    receives the scaled forward values. Returns the scales, whose logs add up to the likelihood."""
    scales = np.empty(len(seen), dtype=seen.dtype)
    before = None
    for t in range(len(begin) - 1):
        now = seen[begin[t] : begin[t + 1]]
        now *= model.start if before is None else before[: len(now)] @ model.step
        scale = now.sum(axis=1)
        scales[begin[t] : begin[t + 1]] = scale
        now /= scale[:, None]
        before = now
    return scales


def expected_counts(model: Model, classes: np.ndarray, places: np.ndarray):
    """Baum-Welch counts of a group of texts: start, steps and emissions."""
    at, begin, _ = by_time(places)
    ordered = np.empty(len(classes), dtype=np.int32)
    ordered[at] = classes
    emitted = model.emit[ordered]
    values = emitted.copy()
    scales = forward(model, values, begin)
    states = len(model.start)
    steps = np.zeros((states, states))
    behind = np.ones((0, states), dtype=values.dtype)
    turned = np.ascontiguousarray(model.step.T)
    for t in range(len(begin) - 2, -1, -1):
        now = slice(begin[t], begin[t + 1])
        value = values[now]
        if len(behind):
            steps += value[: len(behind)].T @ behind
            value[: len(behind)] *= behind @ turned
        # Texts that end here have nothing behind them: their forward value is the posterior.
        behind_now = emitted[now] / scales[now][:, None]
        if len(behind):
            behind_now[: len(behind)] *= behind @ turned
        behind = behind_now
    emissions = np.stack(
        [np.bincount(ordered, weights=values[:, k], minlength=CLASSES + 1) for k in range(states)], axis=1
    )
    return values[: begin[1]].sum(axis=0), steps * model.step, emissions


def first_model(shares: np.ndarray, states: int) -> Model:
    """States that tend to stay, with the overall distribution unevenly shared among them."""
    random = np.random.default_rng(7)
    emit = shares[:, None] * np.exp(random.normal(0, 1, (len(shares), states)))
    step = np.full((states, states), 0.1 / (states - 1)) + (0.9 - 0.1 / (states - 1)) * np.eye(states)
    return Model(np.full(states, 1 / states), step, emit / emit.sum(axis=0))


def next_model(start, steps, emissions, shares: np.ndarray) -> Model:
    emit = emissions + PRIOR * len(shares) * shares[:, None]
    return Model(
        (start + 1) / (start + 1).sum(),
        (steps + 1) / (steps + 1).sum(axis=1, keepdims=True),
        emit / emit.sum(axis=0),
    )


def word_counts(training: DataFrame) -> DataFrame:
    """``word`` (hash), ``n`` over the texts in column ``text``; tasks add up before the shuffle."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = np.unique(token_column(batch.column(0))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"]
            )

    counted = training.select("text").mapInArrow(count, "word bigint, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def train(training: DataFrame, shares: np.ndarray, states: int, rounds: int) -> Model:
    """Baum-Welch over all texts in column ``text``."""
    context = training.sparkSession.sparkContext
    model = first_model(shares, states)
    for _ in range(rounds):
        sent = context.broadcast(
            Model(*[x.astype(np.float32) for x in (model.start, model.step, model.emit)])
        )

        def expect(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                tokens, places = token_column(batch.column(0))
                classes = classes_of(tokens)
                for first, last in groups(places):
                    inner = places[first : last + 1]
                    found = expected_counts(sent.value, classes[inner[0] : inner[-1]], inner)
                    total = [a + b for a, b in zip(total, found, strict=True)] if total else found
            if total:
                start, steps, emissions = total
                rows = [np.vstack([start, steps])]
                rows += [emissions[i : i + CLASSES_A_ROW] for i in range(0, CLASSES + 1, CLASSES_A_ROW)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(len(rows), dtype=np.int32)),
                        pa.array([x.tobytes() for x in rows], pa.binary()),
                    ],
                    names=["row", "sums"],
                )

        summed = (
            training.select("text")
            .mapInArrow(expect, "row int, sums binary")
            .groupBy("row")
            .applyInArrow(add_rows, "row int, sums binary")
        )
        got = {r["row"]: np.frombuffer(r["sums"]).reshape(-1, states) for r in summed.collect()}
        sent.unpersist()
        if not got:
            break
        emissions = np.concatenate([got[i] for i in range(1, len(got))])
        model = next_model(got[0][0], got[0][1:], emissions, shares)
    return model


def add_rows(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, row = None, None
    for batch in group:
        row = batch.column("row")[:1]
        for value in batch.column("sums"):
            part = np.frombuffer(value.as_buffer())
            total = part.copy() if total is None else total + part
    yield pa.RecordBatch.from_arrays([row, pa.array([total.tobytes()], pa.binary())], names=["row", "sums"])


def score(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    states: int = STATES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``,
    ``score_per_token`` for each row, from a model of the rows that are not held out."""
    rows = documents.select(
        F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    training = rows.filter(~held_out(F.col("key"))).select("text")
    counts = written(word_counts(training))
    of_class = F.when(F.col("word") == END, CLASSES).otherwise(
        F.shiftrightunsigned("word", 64 - (CLASSES - 1).bit_length()).cast("int")
    )
    in_class = np.zeros((CLASSES + 1, 2))
    for row in counts.groupBy(of_class.alias("c")).agg(F.sum("n"), F.count("*")).collect():
        in_class[row[0]] = row[1], row[2]
    n_total, n_words = int(in_class[:, 0].sum()), int(in_class[:, 1].sum())
    smoothed = in_class[:, 0] + ALPHA * (in_class[:, 1] + 1)
    shares = smoothed / smoothed.sum()
    model = train(training, shares, states, rounds)
    sent = documents.sparkSession.sparkContext.broadcast((model, smoothed))

    blocks = 2 * max(1, documents.rdd.getNumPartitions())
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)).cast("int"))

    def distinct(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, block = np.zeros(0, np.uint64), None
        for batch in group:
            block = batch.column("block")[0].as_py()
            found = np.union1d(found, token_column(batch.column("text"))[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(found), block, np.int32)), pa.array(found.view(np.int64))],
            names=["block", "word"],
        )

    asked = dealt.groupBy("block").applyInArrow(distinct, "block int, word bigint")
    known = asked.join(counts, "word").select("block", "word", "n")

    def judge(texts: pa.Table, words: pa.Table) -> pa.Table:
        model, smoothed = sent.value
        hashes = words.column("word").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        hashes, numbers = hashes[order], words.column("n").to_numpy()[order]
        parts = []
        for batch in texts.combine_chunks().to_batches():
            tokens, places = token_column(batch.column("text"))
            at = np.searchsorted(hashes, tokens)
            at[at == len(hashes)] = 0
            n = np.where(hashes[at] == tokens, numbers[at], 0) if len(hashes) else np.zeros(len(tokens))
            classes = classes_of(tokens)
            base = np.log10((n + ALPHA) / (n_total + ALPHA * (n_words + 1)))
            inside = np.log10((n + ALPHA) / smoothed[classes])
            inside[classes == CLASSES] = 0.0  # the only word of its class
            total = np.add.reduceat(inside, places[:-1])
            for first, last in groups(places):
                inner = places[first : last + 1]
                place, begin, order = by_time(inner)
                ordered = np.empty(inner[-1] - inner[0], dtype=np.int32)
                ordered[place] = classes[inner[0] : inner[-1]]
                scales = np.log10(forward(model, model.emit[ordered], begin))
                owner = np.empty(len(ordered), dtype=np.int64)
                owner[place] = np.repeat(np.arange(last - first), np.diff(inner))
                total[first:last] += np.bincount(owner, weights=scales, minlength=last - first)
            size = np.diff(places)
            known_tokens = np.add.reduceat((n > 0).astype(np.int64), places[:-1])
            parts.append(
                pa.table(
                    {
                        key: batch.column("key"),
                        "n_tokens": pa.array(size),
                        "n_known": pa.array(known_tokens),
                        "train_tokens": pa.array(np.full(len(size), n_total, np.int64)),
                        "base_score": pa.array(np.add.reduceat(base, places[:-1])),
                        "score": pa.array(total),
                        "score_per_token": pa.array(total / size),
                    }
                )
            )
        return pa.concat_tables(parts) if parts else pa.table({f.name: [] for f in fields})

    fields = [
        T.StructField(key, documents.schema[key].dataType),
        *[T.StructField(name, T.LongType()) for name in ("n_tokens", "n_known", "train_tokens")],
        *[T.StructField(name, T.DoubleType()) for name in ("base_score", "score", "score_per_token")],
    ]
    judged = dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(judge, T.StructType(fields))
    return judged.withColumn("held_out", held_out(F.col(key)))
