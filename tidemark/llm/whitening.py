"""Embedding whitening from a bit-sliced scatter matrix.

Every entry becomes a whole number; each dimension, shifted to start at zero, is
cut into bit planes, and a plane packs its bits of 64 rows into one word. The
cross-product of two dimensions is the sum over their planes of the popcount of
both planes' AND, weighted by the planes' powers of two: whole numbers
throughout, so the order of rows and tasks does not matter. The scatter is
centred as whole numbers, n G - S S', and only then becomes floating point for
`eigh`. A plane of ones rides along and yields the sums and the row count.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map

# Contract of op11: the whole numbers of an entry, and the components returned.
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
# Rows sliced at once; a multiple of the 64 bits of a word.
CHUNK = 1 << 15
# Entries beyond this have no exact whole number here and count as non-finite.
LARGEST = float(1 << 54)
LIMB = 32


@dataclass(frozen=True)
class Scatter:
    """Exact moments of the fit list: rows, smallest x, sums and cross-products of x - low."""

    n: int
    low: list[int]
    sums: list[int]
    cross: list[list[int]]

    def covariance(self) -> np.ndarray:
        """n G - S S' in whole numbers, rounded once when divided by n squared."""
        d, n, s = len(self.low), self.n, self.sums
        out = np.empty((d, d))
        for i in range(d):
            for j in range(i, d):
                out[i, j] = out[j, i] = (n * self.cross[i][j] - s[i] * s[j]) / (n * n)
        return out


@dataclass(frozen=True)
class Whitening:
    """Fitted components: `axes` are unit eigenvectors in rows, by falling eigenvalue."""

    scatter: Scatter
    values: np.ndarray
    axes: np.ndarray
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of whole-number vectors."""
        n, low = self.scatter.n, np.array(self.scatter.low, dtype=np.int64)
        mean = np.array([s / n for s in self.scatter.sums])
        centred = (x - low).astype(np.float64) - mean
        return centred @ (self.axes / np.sqrt(self.values)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the sum of (n x - S)^2, exact; null where a long cannot hold it.

        Sums modulo 2**64 are exact for every result below 2**63.
        """
        n, low = self.scatter.n, np.array(self.scatter.low, dtype=np.int64)
        u = (x - low).astype(np.uint64)
        sums = np.array([s % (1 << 64) for s in self.scatter.sums], dtype=np.uint64)
        gap = u * np.uint64(n % (1 << 64)) - sums
        exact = (gap * gap).sum(axis=1, dtype=np.uint64).view(np.int64).tolist()
        rough = (((u.astype(np.float64) - np.array([s / n for s in self.scatter.sums])) * n) ** 2).sum(axis=1)
        for i in np.flatnonzero(rough > 2.0**62).tolist():
            whole = sum((n * a - s) ** 2 for a, s in zip(u[i].tolist(), self.scatter.sums))
            exact[i] = whole if whole < 1 << 63 else None
        return exact


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int, offset: int) -> DataFrame:
    """_id and _x, the whole numbers of each usable vector."""
    v = F.col("_v")
    usable = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)), F.lit(False))
    rows = df.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{vector}`").cast("array<double>").alias("_v"))
    rows = rows.filter(v.isNotNull() & (F.size(v) > 0)).filter(F.forall(v, usable))
    # The filter may run after the conversion, so that one must bear any entry.
    whole = F.transform(
        v, lambda c: F.floor(F.when(usable(c), c * scale)).cast("long") + F.lit(offset).cast("long")
    )
    return rows.select("_id", whole.alias("_x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def bit_planes(u: np.ndarray, bits: list[int]) -> np.ndarray:
    """The planes of all dimensions, lowest bit first, and a last one of ones."""
    rows = len(u)
    planes = np.zeros((sum(bits) + 1, (rows + 63) // 64 * 8), dtype=np.uint8)
    at = 0
    for d, width in enumerate(bits):
        column = u[:, d]
        for p in range(width):
            packed = np.packbits((column >> np.uint64(p) & np.uint64(1)).astype(np.uint8))
            planes[at, : len(packed)] = packed
            at += 1
    ones = np.packbits(np.ones(rows, dtype=np.uint8))
    planes[at, : len(ones)] = ones
    return planes.view(np.uint64)


class _Sums:
    """Weighted popcounts of all pairs of dimensions, in limbs of 32 bits."""

    def __init__(self, bits: list[int]):
        widths = [*bits, 1]
        self.bits, self.size = bits, len(widths)
        self.owner = np.repeat(np.arange(self.size), widths)
        self.power = np.concatenate([np.arange(w) for w in widths]).astype(np.int64)
        self.limbs = np.zeros((self.size, self.size, (2 * max(widths) + 64) // LIMB + 1), dtype=np.int64)

    def add(self, u: np.ndarray) -> None:
        planes = bit_planes(u, self.bits)
        for a in range(len(planes)):
            counts = np.bitwise_count(planes[a] & planes[a:]).sum(axis=1, dtype=np.int64)
            shift = self.power[a] + self.power[a:]
            limb, value = shift // LIMB, counts << (shift % LIMB)
            held, other = self.limbs[self.owner[a]], self.owner[a:]
            # A pair of planes of one dimension stands for both of its orders.
            twice = np.where((other == self.owner[a]) & (np.arange(a, len(planes)) > a), 2, 1)
            np.add.at(held, (other, limb), (value & 0xFFFFFFFF) * twice)
            np.add.at(held, (other, limb + 1), (value >> LIMB) * twice)


def scatter(rows: DataFrame, low: list[int], high: list[int]) -> Scatter:
    """Exact moments of the vectors `_x`.

    A task sends one row per dimension, tasks of a second stage add these up by
    dimension; the driver gets as many numbers as the matrix has.
    """
    d, bits = len(low), [max(1, (h - m).bit_length()) for m, h in zip(low, high)]
    base = np.array(low, dtype=np.int64)
    width = _Sums(bits).limbs.shape[2]

    def slices(batches):
        sums, held, size = _Sums(bits), [], 0
        for batch in batches:
            held.append(_matrix(batch.column(0), d))
            size += len(held[-1])
            if size >= CHUNK:
                sums.add((np.concatenate(held) - base).astype(np.uint64))
                held, size = [], 0
        if size:
            sums.add((np.concatenate(held) - base).astype(np.uint64))
        if sums.limbs.any():
            yield _rows(range(d + 1), sums.limbs)

    def added(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                limbs = np.frombuffer(raw, dtype=np.int64)
                total[dim] = total[dim] + limbs if dim in total else limbs
        if total:
            yield _rows(total.keys(), total.values())

    def _rows(dims, limbs):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(dims), pa.int32()), pa.array([x.tobytes() for x in limbs], pa.binary())],
            names=["dim", "limbs"],
        )

    parts = arrow_map(rows.select("_x"), slices, "dim int, limbs binary")
    found = arrow_map(parts.repartition("dim"), added, "dim int, limbs binary").collect()
    whole = [[0] * (d + 1) for _ in range(d + 1)]
    for row in found:
        limbs = np.frombuffer(row["limbs"], dtype=np.int64).reshape(d + 1, width).tolist()
        for other in range(row["dim"], d + 1):
            value = sum(x << (LIMB * i) for i, x in enumerate(limbs[other]))
            whole[row["dim"]][other] = whole[other][row["dim"]] = value
    return Scatter(whole[d][d], low, whole[d][:d], [r[:d] for r in whole[:d]])


def fit(moments: Scatter, components: int = COMPONENTS) -> Whitening:
    """Unit eigenvectors of the covariance, those without variance left out.

    Of the two signs the one is taken whose largest entry is positive.
    """
    v = moments.covariance()
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")
    values, axes = values[order], vectors.T[order]
    kept = values > max(values[0], 0.0) * len(values) * np.finfo(float).eps
    values, axes = values[kept][:components], axes[kept][:components]
    if len(axes):
        sign = np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])
        axes = axes * sign[:, None]
    return Whitening(moments, values, axes, values / np.trace(v))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened rows minus the identity.

    Measured on all rows: each task sends the products of its rows.
    """
    d, k = len(model.scatter.low), len(model.values)

    def products(batches):
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = model.apply(_matrix(batch.column(0), d))
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(total.size), pa.int32()), pa.array(total.reshape(-1))], names=["at", "value"]
            )

    parts = arrow_map(rows.select("_x"), products, "at int, value double")
    total = np.zeros((k + 1) * k)
    for row in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():
        total[row["at"]] = row["value"]
    total = total.reshape(k + 1, k) / model.scatter.n
    covariance = total[:k] - np.outer(total[k], total[k])
    return float(np.abs(covariance - np.eye(k)).max())


def _length(rows: DataFrame) -> int | None:
    """The most frequent vector length, of equally frequent ones the larger."""
    lengths = rows.groupBy(F.size("_x").alias("d")).agg(F.count(F.lit(1)).alias("c"))
    return lengths.agg(F.max(F.struct("c", "d"))["d"]).first()[0]


def whiten(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    offset: int = OFFSET,
    components: int = COMPONENTS,
) -> DataFrame:
    """One row per usable vector and component: key, component, n, deviation,
    whitened, explained, identity_error.

    A vector that is null or empty, that holds a null, a non-finite entry or one
    of 2**54 and more, or that has another length than most vectors, is left
    out, of the fit too. Entry c becomes x = floor(scale c) + offset. Components
    are those of the covariance of all remaining vectors, numbered from 1 by
    falling eigenvalue, at most `components`; ones without variance (constant
    or dependent dimensions, a single vector) have no whitened value and are
    left out, so equal vectors give no rows, and neither does an empty table.
    `deviation` is the exact sum of (n x - S)^2, null where it is not below 2**63.
    Repeated rows and null keys count and return like any others; other columns
    are ignored.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    spark = df.sparkSession
    rows = whole_vectors(df, key, vector, scale, offset)
    d = _length(rows)
    if d is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("_x") == d)
    ends: list[Column] = [F.min("x").alias("low"), F.max("x").alias("high")]
    edges = rows.select(F.posexplode("_x").alias("dim", "x")).groupBy("dim").agg(*ends)
    edges = sorted(edges.collect(), key=lambda r: r["dim"])
    moments = scatter(rows, [r["low"] for r in edges], [r["high"] for r in edges])
    model = fit(moments, components)
    k = len(model.values)
    if not k:
        return spark.createDataFrame([], schema)
    error = identity_error(rows, model)

    def work(batches):
        for batch in batches:
            x = _matrix(batch.column(1), d)
            m = len(x)
            each = np.repeat(np.arange(m), k)
            columns = [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, moments.n)),
                pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                pa.array(model.apply(x).reshape(-1)),
                pa.array(np.tile(model.explained, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return arrow_map(rows, work, schema)
