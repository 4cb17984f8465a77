"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation (operator 11).

Each entry c becomes the whole number floor(64 c) + 1000000. Distinct vectors, once each, are what is
fitted; their centred rows make the matrix X. From a random unit vector v the alternating products
X v and X' u, each made orthogonal to all earlier vectors of its side, give orthonormal bases U and V with
X V = U B and B upper bidiagonal. The small matrix B is decomposed by the driver: its right singular
vectors, carried back through V, are the components, its singular values over sqrt(n) their deviations.

What is distributed: a row's entries of U follow from its products with V by a substitution with the
numbers that the driver keeps, so they are worked out in the task that reads the row and are stored
nowhere. One step is one pass: it sums X'p for the new column p = X v - b u, U'p and p'p, from which the
driver takes p's part within U out of all three. A task returns as many numbers as a vector has
entries, and as many again for U'p; they are added up by position, so the driver gets that many rows.

The steps end when the wanted components are exact to double precision and what the basis has not seen of
the total variance is less than the last of them, so that none of equal size can have been missed; after
as many steps as there are dimensions the bases are complete in any case. Where a product vanishes (X has
fewer directions than dimensions) the next v is a new random direction.

Defined results: rows whose vector is null, is empty, or holds null, NaN, an infinity or an entry of 2^56
or more have no output, nor do rows of another width than most have (the larger of equally frequent ones).
Repeated rows have their rows of output each; null keys stay. Components of no variance are left out, so a
table of one distinct vector, like an empty one, gives no rows. ``deviation`` is null where it exceeds a
long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.llm.scratch import written

COMPONENTS = 16
SCALE = 64.0
SHIFT = 1_000_000
LIMIT = float(1 << 56)
SEED = 11
# Relative size below which a number is what rounding leaves of 0.
ROUNDING = 1e-13
# Rows of a matrix taken together; of 64 dimensions that is about 1 MB.
BLOCK = 2048
MADE = ["component", "n", "deviation", "whitened", "explained", "identity_error"]


def usable(vector: Column) -> Column:
    return F.coalesce(F.size(vector) > 0, F.lit(False)) & F.forall(
        vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LIMIT, F.lit(False))
    )


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), width)


@dataclass
class Centre:
    """``n`` distinct vectors and the exact sums of their entries."""

    n: int
    sums: list[int]

    def __post_init__(self) -> None:
        self.whole = [s // self.n for s in self.sums]
        self.rest = np.array([s - self.n * w for s, w in zip(self.sums, self.whole, strict=True)])
        self.safe = (1 << 62) // (self.n * 2)

    def spread(self, x: np.ndarray) -> np.ndarray:
        """n x - S without rounding: as 64-bit numbers where they fit, else as Python's."""
        away = x - np.array(self.whole, np.int64)
        if len(away) and max(int(away.max()), -int(away.min())) >= self.safe:
            return away.astype(object) * self.n - self.rest.astype(object)
        return away * self.n - self.rest

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.spread(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        spread = self.spread(x)
        large = max(int(spread.max()), -int(spread.min())) if spread.size else 0
        if large * large * x.shape[1] < 1 << 63:
            return pa.array((spread * spread).sum(axis=1).astype(np.int64))
        exact = (spread.astype(object) ** 2).sum(axis=1)
        return pa.array([int(d) if d < 1 << 63 else None for d in exact], pa.int64())


def summed(rows: DataFrame, sums: Callable[[Iterator[np.ndarray]], np.ndarray], width: int) -> np.ndarray:
    """Apply ``sums`` to the vectors ``x`` of each task and add the results up by position."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (
            matrix(batch.column(0).slice(at, BLOCK), width)
            for batch in batches
            for at in range(0, batch.num_rows, BLOCK)
        )
        found = sums(blocks)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found))), pa.array(found)], names=["at", "part"])

    parts = rows.select("x").mapInArrow(task, "at bigint, part double")
    total = parts.groupBy("at").agg(F.sum("part").alias("total")).collect()
    found = np.zeros(len(total))
    for row in total:
        found[row["at"]] = row["total"]
    return found


def exact_centre(rows: DataFrame, width: int) -> Centre | None:
    """The sums go by halves of 32 bits, so no partial sum overflows."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(width, np.int64), np.zeros(width, np.int64), 0
        for batch in batches:
            x = matrix(batch.column(0), width)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            n += len(x)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(width, dtype=np.int32)),
                pa.array(high),
                pa.array(low),
                pa.array(np.full(width, n)),
            ],
            names=["at", "high", "low", "n"],
        )

    halves = rows.select("x").mapInArrow(task, "at int, high bigint, low bigint, n bigint")
    decimal = T.DecimalType(38, 0)
    total = (
        halves.groupBy("at")
        .agg(
            F.sum(F.col("high").cast(decimal)).alias("high"),
            F.sum(F.col("low").cast(decimal)).alias("low"),
            F.sum("n").alias("n"),
        )
        .orderBy("at")
        .collect()
    )
    if not total or not total[0]["n"]:
        return None
    return Centre(total[0]["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in total])


@dataclass
class Bases:
    """V and what is needed to work out a row's entries of U.

    Column j of U is (X v_j - sum of ``within[j]`` times earlier columns) / ``alpha[j]``; where that
    vanishes the column is left zero and ``alpha[j]`` is 0.
    """

    v: np.ndarray
    alpha: list[float] = field(default_factory=list)
    within: list[np.ndarray] = field(default_factory=list)
    beta: list[float] = field(default_factory=list)

    def left(self, products: np.ndarray) -> np.ndarray:
        """Rows of U from the rows' products with V."""
        u = np.zeros((len(products), len(self.alpha)))
        for j, size in enumerate(self.alpha):
            if size:
                u[:, j] = (products[:, j] - u[:, :j] @ self.within[j]) / size
        return u

    def bidiagonal(self) -> np.ndarray:
        b = np.diag(self.alpha)
        for j, size in enumerate(self.beta[: len(self.alpha) - 1]):
            b[j, j + 1] = size
        return b


def orthogonal(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector


def bidiagonalise(rows: DataFrame, centre: Centre, wanted: int, seed: int = SEED):
    """Unit components as columns, their standard deviations, and the sum of all variances."""
    width, random = len(centre.sums), np.random.default_rng(seed)

    def direction(basis: np.ndarray) -> np.ndarray:
        vector = orthogonal(random.standard_normal(width), basis)
        return vector / np.linalg.norm(vector)

    def spread(blocks: Iterator[np.ndarray]) -> np.ndarray:
        return np.array([sum(float((centre.centred(x) ** 2).sum()) for x in blocks)])

    whole = float(summed(rows, spread, width)[0])
    bases = Bases(direction(np.zeros((width, 0)))[:, None])
    seen = []  # X'u of each column of U
    if whole == 0:
        return np.zeros((width, 0)), np.zeros(0), 0.0
    while True:
        j = len(bases.alpha)
        ahead = np.zeros(j)
        if j:
            ahead[-1] = bases.beta[-1]

        def step(blocks: Iterator[np.ndarray], bases=bases, j=j, ahead=ahead) -> np.ndarray:
            total = np.zeros(width + j + 1)
            for x in blocks:
                y = centre.centred(x)
                products = y @ bases.v
                u = bases.left(products[:, :j])
                p = products[:, j] - u @ ahead
                total += np.concatenate([p @ y, p @ u, [p @ p]])
            return total

        total = summed(rows, step, width)
        back, inside, square = total[:width], total[width : width + j], total[-1]
        # take what rounding left of p within U out of p, X'p and p'p
        for i in np.flatnonzero(inside):
            back = back - inside[i] * seen[i]
        size = np.sqrt(max(square - inside @ inside, 0.0))
        vanished = size <= ROUNDING * np.sqrt(whole)
        bases.alpha.append(0.0 if vanished else float(size))
        bases.within.append(ahead + inside)
        seen.append(np.zeros(width) if vanished else back / size)
        left = orthogonal(seen[-1] - bases.v[:, -1] * bases.alpha[-1], bases.v)
        beta = float(np.linalg.norm(left))
        ended = j + 1 == width
        if not ended and beta <= ROUNDING * np.sqrt(whole):
            beta = 0.0
        bases.beta.append(beta)
        b = bases.bidiagonal()
        inner, deviations, right = np.linalg.svd(b)
        unseen = max(whole - float((b * b).sum()), 0.0)
        last = deviations[min(wanted, len(deviations)) - 1]
        exact = beta * np.abs(inner[-1, :wanted]).max() <= ROUNDING * deviations[0]
        if ended or (j + 1 >= wanted and exact and unseen < last * last) or unseen <= ROUNDING * whole and exact:
            break
        new = left / beta if beta else direction(bases.v)
        bases.v = np.column_stack([bases.v, new])
    kept = min(wanted, int((deviations > deviations[0] * width * ROUNDING).sum()))
    components = bases.v @ right[:kept].T
    components, _ = np.linalg.qr(components)
    components *= np.sign((components * (bases.v @ right[:kept].T)).sum(axis=0))
    return components, deviations[:kept] / np.sqrt(centre.n), whole / centre.n


def whiten(
    embeddings: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    seed: int = SEED,
) -> DataFrame:
    """One row per usable row and component: the key, ``component`` (from 1, by falling variance), ``n``
    (distinct vectors), ``deviation`` (squared distance of n x from the sums), ``whitened``,
    ``explained`` (share of the variance) and ``identity_error``."""
    if key in MADE:
        raise ValueError(f"the key may not be called {key}")
    schema = T.StructType(
        [
            embeddings.schema[key],
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    spark = embeddings.sparkSession
    vectors = embeddings.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    vectors = vectors.filter(usable(F.col("vector"))).select("key", whole_numbers(F.col("vector")).alias("x"))
    widths = vectors.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("rows"))
    common = widths.orderBy(F.desc("rows"), F.desc("width")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    width = common["width"]
    vectors = vectors.filter(F.size("x") == width)
    fitted = written(vectors.select("x").distinct())
    centre = exact_centre(fitted, width)
    basis, deviations, whole = bidiagonalise(fitted, centre, components, seed)
    many = len(deviations)
    if not many:
        return spark.createDataFrame([], schema)
    projection = basis / deviations

    def products(blocks: Iterator[np.ndarray]) -> np.ndarray:
        total = np.zeros(many + many * many)
        for x in blocks:
            w = centre.centred(x) @ projection
            total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        return total

    total = summed(fitted, products, width) / centre.n
    mean, square = total[:many], total[many:].reshape(many, many)
    error = float(np.abs(square - np.outer(mean, mean) - np.eye(many)).max())
    shares = deviations**2 / whole

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = matrix(part.column(1), width)
                row = pa.array(np.repeat(np.arange(len(x)), many))
                size = len(x) * many
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(row),
                        pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(size, centre.n)),
                        centre.deviations(x).take(row),
                        pa.array((centre.centred(x) @ projection).ravel()),
                        pa.array(np.tile(shares, len(x))),
                        pa.array(np.full(size, error)),
                    ],
                    names=schema.names,
                )

    return vectors.mapInArrow(project, schema)
