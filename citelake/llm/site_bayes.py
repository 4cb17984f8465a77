"""Quality classifier by hierarchical empirical Bayes (operator 5).

1. Evidence of the document: naive Bayes over its distinct words and the punctuation of its words,
   one head for low quality and one for toxicity, each calibrated by a small logistic regression.
2. Evidence of the site: the documents' probabilities are added up by path within host and by host.
   A host's rate is shrunk towards the overall rate and a path's towards its host's, by beta priors
   whose strengths are fitted to the spread among all hosts and all paths. Sparse sites so say little.
3. A document's odds are its own times those of its path against the overall rate. The rate is that of
   the other documents of its path and host: its own evidence is taken out of both sums first, so that a
   page alone on its site is judged by its text and the priors only.

Without other columns for them, ``source`` stands for the host and ``lang`` for the path within it.

The classifier is fitted to at most ``MAX_LABELLED`` labelled rows in expectation, half for the word
weights, half for the calibration; rates by site cover all rows. A label given repeatedly counts once.

Defined results: a null or blank text has no words and is judged by the intercept and its site; a null
host or path is a site of its own; repeated rows are judged as rows; an empty table gives an empty
one; without labels of both kinds a head is silent. Other columns are kept, but for those that bear
the name of a result, which are replaced.
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
from citelake.llm.words import byte_spans, chunk_words, chunks, mixed

MAX_LABELLED = 50_000
BINS = 1 << 18
SHRINK = 5.0  # documents with the word that are added, shared out as the classes are
STRONG = 2.0
SALTS = 16
HEADS = ("low", "toxic")
RESULTS = ("p_own", "p_site", "p_reject", "rejected")

FEATURES = 8

_marks = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
_marks[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 0
_plain = [int(_marks[ord(c)]) for c in ",.;:!?'-"]


@dataclass
class Classifier:
    weights: np.ndarray  # bin by head
    centre: np.ndarray  # head by feature, as the next
    scale: np.ndarray
    slopes: np.ndarray  # head by feature and intercept

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        """Of (document, head, feature): the probability of either fault."""
        x = (features - self.centre) / self.scale
        z = (x * self.slopes[:, :-1]).sum(axis=2) + self.slopes[:, -1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def distinct_bins(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, last, document, bin, shape), chunk by chunk: the distinct words and word punctuations of
    each document; of all its words the shares that repeat the word before, that carry unusual
    punctuation and that are distinct, and how many there are, as a logarithm."""
    body, places = byte_spans(column)
    for first, last in chunks(places):
        at = places[first]
        part = body[at : places[last]]
        words = chunk_words(part, places[first : last + 1] - at)
        owner = np.repeat(np.arange(last - first), np.diff(words.places))
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_marks[part], out=sums[1:])
        marks = sums[words.ends] - sums[words.starts]
        marked = np.flatnonzero(marks)
        token = np.concatenate([words.hashes, mixed(marks[marked])]) >> np.uint64(64 - 18)
        cell = np.concatenate([owner, owner[marked]]).astype(np.uint64) * np.uint64(BINS) + token
        cell = np.unique(cell)
        document, bins = (cell >> np.uint64(18)).astype(np.int64), (cell & np.uint64(BINS - 1)).astype(np.int64)
        n = np.maximum(1, np.diff(words.places))
        again = np.zeros(len(owner), dtype=bool)
        again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])
        odd = (marks != 0) & ~np.isin(marks, _plain)
        shape = [
            np.bincount(owner, weights=again, minlength=last - first) / n,
            np.bincount(owner, weights=odd, minlength=last - first) / n,
            np.bincount(document, minlength=last - first) / n,
            np.log1p(np.diff(words.places)),
        ]
        yield first, last, document, bins, np.stack(shape, axis=1)


def evidence(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Features of each text for each head: of its words' weights the sum, the sum by the root of their
    number, the largest and the sum of the strong; then the shape of the text."""
    found = np.zeros((len(column), len(HEADS), FEATURES))
    for first, last, owner, bins, shape in distinct_bins(column):
        n = np.bincount(owner, minlength=last - first)
        for head in range(len(HEADS)):
            w = weights[bins, head]
            total = np.bincount(owner, weights=w, minlength=last - first)
            top = np.zeros(last - first)
            np.maximum.at(top, owner, w)
            strong = np.bincount(owner, weights=np.where(w > STRONG, w, 0), minlength=last - first)
            found[first:last, head, :4] = np.stack([total, total / np.sqrt(n + 1), top, strong], axis=1)
            found[first:last, head, 4:] = shape
    return found


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Slopes and intercept by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    b = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (p - y) + penalty * b
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        b -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return b


def fit(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    max_labelled: int = MAX_LABELLED,
) -> Classifier:
    """``labels`` has the key, ``quality`` and ``toxic``, each 0 or 1 or null."""
    heads = labels.select(
        key,
        (F.coalesce("quality", F.lit(1)) == 0).cast("int").alias("low"),
        (F.coalesce("toxic", F.lit(0)) == 1).cast("int").alias("toxic"),
        (F.pmod(F.xxhash64(key, F.lit(3)), F.lit(2)) == 0).alias("first"),
    ).distinct()
    share = min(1.0, max_labelled / max(1, heads.count()))
    spot = F.pmod(F.xxhash64(key), F.lit(1_000_000))
    chosen = heads.filter(spot < share * 1_000_000)
    # max_labelled rows of a few bytes; a key has four different ones at most
    labelled = documents.select(key, text).join(F.broadcast(chosen), key)
    labelled = written(labelled.select(text, *HEADS, "first"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BINS, 3), dtype=np.int64)
        size = np.zeros(3, dtype=np.int64)
        for batch in batches:
            y = np.stack(
                [np.ones(batch.num_rows, np.int64), *[batch.column(h).to_numpy() for h in HEADS]], axis=1
            )
            size += y.sum(axis=0)
            for first, last, owner, bins, _ in distinct_bins(batch.column(text)):
                for k in range(3):
                    total[:, k] += np.bincount(
                        bins, weights=y[first:last][owner, k], minlength=BINS
                    ).astype(np.int64)
        used = np.flatnonzero(total[:, 0])
        values = np.vstack([np.append(total[used], size[None, :], axis=0)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, BINS)), *[pa.array(values[:, k]) for k in range(3)]],
            names=["bin", "n", *HEADS],
        )

    counted = (
        labelled.filter("first")
        .mapInArrow(count, "bin bigint, n bigint, low bigint, toxic bigint")
        .groupBy("bin")
        .agg(*[F.sum(c).alias(c) for c in ("n", *HEADS)])
        .toArrow()  # BINS rows
    )
    total = np.zeros((BINS + 1, 3))
    total[counted.column("bin").to_numpy()] = np.stack(
        [counted.column(c).to_numpy() for c in ("n", *HEADS)], axis=1
    )
    size, total = total[BINS], total[:BINS]
    weights = np.zeros((BINS, 2), dtype=np.float32)
    for head in range(2):
        bad, good = size[1 + head], size[0] - size[1 + head]
        if bad and good:
            hit = total[:, 1 + head] / bad + SHRINK / size[0]
            miss = (total[:, 0] - total[:, 1 + head]) / good + SHRINK / size[0]
            weights[:, head] = np.log(hit / miss)

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = evidence(batch.column(text), weights).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(h) for h in HEADS] + [pa.array(x[:, i]) for i in range(x.shape[1])],
                names=[*HEADS, *[f"x{i}" for i in range(x.shape[1])]],
            )

    width = len(HEADS) * FEATURES
    schema = ", ".join([f"{h} int" for h in HEADS] + [f"x{i} double" for i in range(width)])
    held = labelled.filter("NOT first").mapInArrow(features, schema).toArrow()  # max_labelled rows
    x = np.stack([held.column(f"x{i}").to_numpy() for i in range(width)], axis=1).reshape(-1, 2, FEATURES)
    centre = x.mean(axis=0) if len(x) else np.zeros((2, FEATURES))
    scale = x.std(axis=0) + 1e-9 if len(x) else np.ones((2, FEATURES))
    slopes = np.zeros((2, FEATURES + 1))
    for head, name in enumerate(HEADS):
        y = held.column(name).to_numpy().astype(float)
        if len(y) and 0 < y.sum() < len(y):
            slopes[head] = logistic((x[:, head] - centre[head]) / scale[head], y)
        else:
            slopes[head, -1] = -10.0
    return Classifier(weights, centre, scale, slopes)


def shrunken(faults: Column, n: Column, towards: Column, strength: float) -> Column:
    return (faults + F.lit(strength) * towards) / (n + F.lit(strength))


def prior_strength(rates: DataFrame) -> float:
    """Beta strength from moments; rows have ``faults``, ``n`` and ``towards``, the prior's mean."""
    rate, n, mean = F.col("faults") / F.col("n"), F.col("n"), F.col("towards")
    total, spread, chance, chance_once = rates.agg(
        F.sum(n), F.sum(n * (rate - mean) ** 2), F.sum(n * mean * (1 - mean)), F.sum(mean * (1 - mean))
    ).first()
    if not total:
        return 1.0
    between = spread / total - chance_once / total
    strength = (chance / total) / between - 1 if between > 1e-9 else 1e6
    return float(min(max(strength, 1.0), 1e6))


def site_rates(own: DataFrame) -> tuple[DataFrame, float]:
    """From rows of (host, path, p): each path's shrunken rate, and the overall rate. With each path what
    the rate is made of: ``faults`` and ``n``, those of its host, and the strengths of both priors."""
    paths = written(own.groupBy("host", "path").agg(F.sum("p").alias("faults"), F.count("*").alias("n")))
    faults, n = paths.agg(F.sum("faults"), F.sum("n")).first()
    overall = min(max((faults or 0.0) / (n or 1), 1e-4), 1 - 1e-4)
    hosts = paths.groupBy("host").agg(F.sum("faults").alias("faults"), F.sum("n").alias("n"))
    hosts = hosts.withColumn("towards", F.lit(overall))
    by_host = prior_strength(hosts)
    hosts = written(
        hosts.select(
            F.col("host").alias("_host"),
            shrunken(F.col("faults"), F.col("n"), F.lit(overall), by_host).alias("towards"),
            F.col("faults").alias("host_faults"),
            F.col("n").alias("host_n"),
        )
    )
    within = written(paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host"))
    by_path = prior_strength(within)
    rate = bounded(shrunken(F.col("faults"), F.col("n"), F.col("towards"), by_path))
    strengths = [F.lit(by_host).alias("by_host"), F.lit(by_path).alias("by_path")]
    parts = ["faults", "n", "host_faults", "host_n"]
    return written(within.select("host", "path", rate.alias("p_site"), *parts, *strengths)), overall


def bounded(rate: Column) -> Column:
    return F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), rate))


def rate_of_others(p: Column, overall: float) -> Column:
    """A path's rate without one of its documents, whose probability is ``p``, from ``site_rates``'
    columns with a leading underscore."""

    def less(faults: str) -> Column:
        return F.greatest(F.lit(0.0), F.col(faults) - p)

    host = (less("_host_faults") + F.col("_by_host") * F.lit(overall)) / (F.col("_host_n") - 1 + F.col("_by_host"))
    return bounded((less("_faults") + F.col("_by_path") * host) / (F.col("_n") - 1 + F.col("_by_path")))


def classify(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    threshold: float = 0.5,
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """``documents`` with ``p_own`` (from the text), ``p_site`` (the rate of its path's other documents),
    ``p_reject`` (both) and ``rejected``. The texts are read twice rather than shuffled."""
    rows = documents.drop(*RESULTS)
    model = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, key, text, max_labelled))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.value.probabilities(evidence(batch.column(text), model.value.weights))
            p = np.clip(1 - (1 - p[:, 0]) * (1 - p[:, 1]), 1e-6, 1 - 1e-6)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p)], names=[*batch.schema.names, "p_own"]
            )

    def own(frame: DataFrame) -> DataFrame:
        schema = T.StructType([*frame.schema.fields, T.StructField("p_own", T.DoubleType())])
        return frame.mapInArrow(judge, schema)

    short = rows.select(F.col(host).alias("host"), F.col(path).alias("path"), F.col(text).alias(text))
    seen = own(short).select("host", "path", F.col("p_own").alias("p"))
    rates, overall = site_rates(seen)
    copied = rates.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    made_of = ["faults", "n", "host_faults", "host_n", "by_host", "by_path"]
    copied = copied.select(*[F.col(c).alias(f"_{c}") for c in ("host", "path", *made_of)], "_salt")
    dealt = own(rows).withColumn("_own_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
    joined = dealt.join(
        copied,
        (F.col("_own_salt") == F.col("_salt"))
        & dealt[host].eqNullSafe(F.col("_host"))
        & dealt[path].eqNullSafe(F.col("_path")),
        "left",
    )
    joined = joined.withColumn("p_site", rate_of_others(F.col("p_own"), overall))
    joined = joined.drop("_own_salt", "_salt", "_host", "_path", *[f"_{c}" for c in made_of])
    odds = F.col("p_own") / (1 - F.col("p_own")) * F.col("p_site") / (1 - F.col("p_site"))
    odds = odds * ((1 - overall) / overall)
    return joined.withColumn("p_reject", odds / (1 + odds)).withColumn(
        "rejected", F.col("p_reject") >= threshold
    )
