"""Whitening of embeddings from exact sums of squares, by the polarisation identity.

Entries become whole numbers, ``x = floor(scale * c) + shift``. For each dimension, and for the sum of each pair of
dimensions, the squares of the centred values are summed exactly, in whole numbers; no product of two different
dimensions is ever formed. The variance of a sum less the variances of its parts is twice their covariance:
``2 cov(a, b) = var(a + b) - var(a) - var(b)``. Values are centred on the whole number next to the mean, and the
small rest is taken off exactly: ``n^2 var = n * sum((x - m)^2) - (sum(x) - n m)^2``. Each task adds up its own
vectors and gives one number for each pair of dimensions; only the sums of these, whose number depends on the
dimensions alone, reach the driver, where the covariance is assembled and decomposed. The covariance of the whitened
values is then measured in two more passes (their means, then products of centred values).

Defined results: vectors that are NULL, empty, hold a NULL or non-finite entry, or have another length than most
(ties: the longer one) take no part. Every other row gives one row for each component, repeated and NULL ids too.
A component whose variance is zero up to rounding (less than ``dimensions * 2^-52`` of the largest) can't be
whitened: its value is NULL, and it counts for no error. Components of equal variance are numbered as the
decomposition gives them. The sign is such that the entry of largest size is positive. An entry too large for a whole
number of 64 bits counts as the nearest one. A deviation too large for a long is NULL there and exact in
``deviation_exact`` (up to 38 digits). No vectors give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import as_batch, ship

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8

#: Vectors that a task holds as a matrix at once.
BLOCK = 8192
#: Centred entries up to this size have squares of pair sums that a block can add up in 64 bits.
SMALL = 1 << 23
#: Bits of the lower half of an exact sum.
HALF = 60


def usable(vector: Column) -> Column:
    """Neither NULL nor empty, all entries finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False))


def whole(entries: np.ndarray, scale: int = SCALE, shift: int = SHIFT) -> np.ndarray:
    """``floor(scale * c) + shift`` in 64 bits."""
    with np.errstate(over="ignore"):
        x = np.floor(entries * float(scale))
    most = 2.0**62
    return np.clip(x, -most, most).astype(np.int64) + shift


def matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The ids and vectors (as whole numbers) of a task, block by block."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            entries = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            yield part.column("id"), whole(entries.reshape(part.num_rows, dims))


def squares(y: np.ndarray) -> list[int]:
    """Exact sums of ``y_i^2`` (i = j) and ``(y_i + y_j)^2`` (i < j) over the rows, in order of (i, j)."""
    if y.size and max(int(y.max()), -int(y.min())) > SMALL:
        y = y.astype(object)
    out = []
    for i in range(y.shape[1]):
        sums = y[:, i:] + y[:, i : i + 1]
        sums[:, 0] = y[:, i]
        out += [int(s) for s in (sums * sums).sum(0)]
    return out


def _added(rows: DataFrame, count: int, block: Callable[[np.ndarray], list], dims: int, *, exact: bool) -> list:
    """The number of vectors, and the sums over all of them of the ``count`` numbers that ``block`` gives for
    some. Each task adds up its own. Whole numbers of any size are summed exactly, in two halves."""
    kind = "high decimal(38,0), low decimal(38,0)" if exact else "v double"
    wanted = rows.sparkSession.createDataFrame([], f"k int, {kind}").schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (count + 1)
        for _, x in matrices(batches, dims):
            total = [a + b for a, b in zip(total, [len(x), *block(x)], strict=True)]
        if total[0]:
            keys = {"k": list(range(count + 1))}
            if exact:
                halves = [divmod(int(t), 1 << HALF) for t in total]
                yield as_batch(keys | {"high": [Decimal(h) for h, _ in halves], "low": [Decimal(r) for _, r in halves]}, wanted)
            else:
                yield as_batch(keys | {"v": [float(t) for t in total]}, wanted)

    names = [f.name for f in wanted][1:]
    found = rows.mapInArrow(add, wanted).groupBy("k").agg(*[F.sum(c).alias(c) for c in names]).collect()
    out = [0] * (count + 1)
    for row in found:
        out[row.k] = (int(row.high) << HALF) + int(row.low) if exact else row.v
    return out


class Fit(NamedTuple):
    """What the vectors have in common: their number, sums, components (columns) and variances."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float


def covariance(rows: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray, float]:
    """The number of vectors, the sums of their dimensions, the covariance matrix and its trace, each entry
    rounded once from an exact fraction."""
    n, *sums = _added(rows, dims, lambda x: [int(s) for s in _exact_sum(x)], dims, exact=True)
    if not n:
        return 0, sums, np.zeros((dims, dims)), 0.0
    middle = [s // n for s in sums]
    centre = np.array(middle, np.int64)
    pairs = [(i, j) for i in range(dims) for j in range(i, dims)]
    _, *found = _added(rows, len(pairs), lambda x: squares(_centred(x, centre)), dims, exact=True)
    rest = [s - n * m for s, m in zip(sums, middle, strict=True)]
    # n^2 times the variance of a dimension (i = j) or of the sum of two.
    spread = {
        (i, j): n * q - (rest[i] if i == j else rest[i] + rest[j]) ** 2 for (i, j), q in zip(pairs, found, strict=True)
    }
    out = np.zeros((dims, dims))
    for i, j in pairs:
        twice = 2 * spread[i, i] if i == j else spread[i, j] - spread[i, i] - spread[j, j]
        out[i, j] = out[j, i] = twice / (2 * n * n)
    return n, sums, out, sum(spread[i, i] for i in range(dims)) / (n * n)


def _exact_sum(x: np.ndarray) -> np.ndarray:
    large = x.size and max(int(x.max()), -int(x.min())) > 1 << 48
    return (x.astype(object) if large else x).sum(0)


def _centred(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    large = x.size and max(int(x.max()), -int(x.min())) > 1 << 61
    return x.astype(object) - centre.astype(object) if large else x - centre


def fit(rows: DataFrame, dims: int, components: int = COMPONENTS) -> Fit:
    n, sums, matrix, trace = covariance(rows, dims)
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    largest = vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])]
    return Fit(n, sums, vectors * np.where(largest < 0, -1.0, 1.0), values, trace)


def from_mean(x: np.ndarray, model: Fit) -> np.ndarray:
    """``x - S/n`` in double precision. The whole part of the mean is taken off in whole numbers."""
    middle = [s // model.n for s in model.sums]
    rest = np.array([(s - m * model.n) / model.n for s, m in zip(model.sums, middle, strict=True)])
    return _centred(x, np.array(middle, np.int64)).astype(np.float64) - rest


def whitened(x: np.ndarray, model: Fit) -> np.ndarray:
    """The vectors' values on the components that have a variance (others: NaN)."""
    tiny = len(model.sums) * 2.0**-52 * max(model.variances.max(initial=0.0), 0.0)
    good = model.variances > tiny
    scale = np.sqrt(np.where(good, model.variances, 1.0))
    return np.where(good, from_mean(x, model) @ model.components / scale, np.nan)


def deviations(x: np.ndarray, model: Fit) -> list[int]:
    """``sum((n x - S)^2)`` over the dimensions, exactly."""
    middle = [s // model.n for s in model.sums]
    y = _centred(x, np.array(middle, np.int64))
    rest = np.array([s - m * model.n for s, m in zip(model.sums, middle, strict=True)], object)
    # n x - S = n y - rest, so three sums of small whole numbers are enough: of y^2, of rest y and of rest^2.
    if y.size and max(int(y.max()), -int(y.min())) > SMALL:
        y = y.astype(object)
    second, mixed = (y * y).sum(1).tolist(), (y.astype(object) @ rest).tolist()
    constant = int((rest * rest).sum())
    return [model.n * model.n * int(a) - 2 * model.n * int(b) + constant for a, b in zip(second, mixed, strict=True)]


def identity_error(rows: DataFrame, model: Fit, dims: int) -> float | None:
    """The largest entry, by size, of the whitened values' covariance less the identity."""
    count = len(model.variances)
    shown = np.flatnonzero(~np.isnan(whitened(np.zeros((1, dims), np.int64), model)[0]))
    if not len(shown):
        return None
    sums = _added(rows, count, lambda x: whitened(x, model).sum(0).tolist(), dims, exact=False)
    mean = np.array(sums[1:], float) / model.n

    def products(x: np.ndarray) -> list[float]:
        w = whitened(x, model) - mean
        return (w.T @ w).ravel().tolist()

    found = _added(rows, count * count, products, dims, exact=False)
    measured = (np.array(found[1:], float) / model.n).reshape(count, count)[np.ix_(shown, shown)]
    return float(np.abs(measured - np.eye(len(shown))).max())


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
    "deviation_exact decimal(38,0)"
)


def whiten(table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each vector and each of the first ``components`` components: ``vec_id, component, n, deviation,
    whitened, explained, identity_error, deviation_exact``."""
    ship(table.sparkSession)
    wanted = table.sparkSession.createDataFrame([], SCHEMA).schema
    kind = "float" if table.schema[vector_col].dataType.elementType.typeName() == "float" else "double"
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("v"))
    rows = rows.filter(usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return table.sparkSession.createDataFrame([], wanted)
    dims = lengths["d"]
    rows = rows.filter(F.size("v") == dims)
    model = fit(rows, dims, components)
    error = identity_error(rows, model, dims)
    explained = [float(v / model.trace) if model.trace else None for v in model.variances]
    count = len(explained)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in matrices(batches, dims):
            exact = deviations(x, model)
            values = whitened(x, model)
            every = lambda column: [c for c in column for _ in range(count)]
            yield as_batch(
                {
                    "vec_id": every(ids.to_pylist()),
                    "component": list(range(1, count + 1)) * len(x),
                    "n": [model.n] * (count * len(x)),
                    "deviation": every([d if d < 2**63 else None for d in exact]),
                    "whitened": [None if np.isnan(v) else v for v in values.ravel().tolist()],
                    "explained": explained * len(x),
                    "identity_error": [error] * (count * len(x)),
                    "deviation_exact": every([Decimal(d) if d < 10**38 else None for d in exact]),
                },
                wanted,
            )

    return rows.mapInArrow(put, wanted)
