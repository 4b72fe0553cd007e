"""Whitening of embeddings from exact integer statistics.

A component c becomes the integer floor(64 c) + 1,000,000. To find the covariance of the integers,
each dimension is shifted by its least value and cut into bit planes; a plane of a block of rows is
packed into 64-bit words. The product sum of two dimensions is then the sum over pairs of planes of
2^(a+b) times the number of common bits, so whole words are ANDed and their bits counted, and all
sums are exact. The d x d sums are centred as integers, and only then become doubles for the
eigenvectors. Tasks return sums of their blocks; a d x d table is all that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm import runtime
from lendmill.session import materialize

# The integer form of a component, and the components returned.
STEP = 64
OFFSET = 1_000_000
COMPONENTS = 32
# Rows whose planes are packed at once.
BLOCK_ROWS = 1 << 13
# |64 c| up to which the integers and their products by n are exact.
LARGEST = float(1 << 52)
# An eigenvalue of this share of the trace or less is rounding noise of a constant direction.
NOISE = 1e-13


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values as doubles, NaN for null; first value of each row; number of values of each row)."""
    values = column.flatten().cast(pa.float64())
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return values.to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes, sizes


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, vector) to (id, dims, x) without vectors that are null, empty or not finite throughout."""
    for batch in batches:
        values, first, sizes = _flat(batch.column(1))
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        keep = np.flatnonzero((sizes > 0) & (bad[first + sizes] == bad[first]))
        taken = np.repeat(first[keep], sizes[keep]) + _within(sizes[keep])
        scaled = values[taken] * STEP
        if len(scaled) and np.abs(scaled).max() >= LARGEST:
            raise ValueError("a component is too large to be held exactly")
        x = pa.array(np.floor(scaled).astype(np.int64) + OFFSET)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes[keep])]), pa.int32()), x)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), pa.array(sizes[keep], pa.int32()), lists], ["id", "dims", "x"])


def _within(sizes: np.ndarray) -> np.ndarray:
    total = np.cumsum(sizes)
    return np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - sizes, sizes)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def planes(shifted: np.ndarray, bits: int) -> np.ndarray:
    """[dimension, bit, word]: the bits of non-negative integers [row, dimension], 64 rows to a word."""
    rows, dims = shifted.shape
    padded = np.zeros((-(-rows // 64) * 64, dims), np.int64)
    padded[:rows] = shifted
    out = np.empty((dims, bits, len(padded) // 64), np.uint64)
    for b in range(bits):
        out[:, b] = np.packbits(np.ascontiguousarray(((padded >> b) & 1).astype(np.uint8).T), axis=1).view(np.uint64)
    return out


def plane_sums(sliced: np.ndarray) -> list[int]:
    """The exact sum of each dimension from the bit counts of its planes."""
    counts = np.bitwise_count(sliced).sum(2, dtype=np.int64)
    return [sum(int(c) << b for b, c in enumerate(row)) for row in counts]


def cross_products(sliced: np.ndarray) -> list[list[int]]:
    """For each dimension its product sums with itself and all later ones, exact."""
    dims, bits, _ = sliced.shape
    flat = sliced.reshape(dims * bits, -1)
    out = []
    for i in range(dims):
        common = np.zeros((bits, (dims - i) * bits), np.int64)
        for a in range(bits):
            if sliced[i, a].any():
                common[a] = np.bitwise_count(sliced[i, a] & flat[i * bits :]).sum(1, dtype=np.int64)
        # counts of equal weight first: bits a and b weigh 2^(a+b)
        weighed = [0] * (dims - i)
        counts = common.reshape(bits, dims - i, bits)
        for s in range(2 * bits - 1):
            same = sum(counts[a, :, s - a] for a in range(max(0, s - bits + 1), min(bits, s + 1)))
            for j in np.flatnonzero(same).tolist():
                weighed[j] += int(same[j]) << s
        out.append(weighed)
    return out


def _scatter(dims: int, least: list[int], bits: int):
    """Rows (x) to (i, values): this task's product sums of shifted dimension i with dimensions i.. as decimals, and (-1, sums)."""
    low = np.array(least, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [[0] * (dims - i) for i in range(dims)]
        sums = [0] * dims
        held: list[np.ndarray] = []

        def add(shifted: np.ndarray) -> None:
            sliced = planes(shifted, bits)
            for d, s in enumerate(plane_sums(sliced)):
                sums[d] += s
            for row, new in zip(total, cross_products(sliced)):
                for j, v in enumerate(new):
                    row[j] += v

        waiting = 0
        for batch in batches:
            held.append(_matrix(batch.column(0), dims) - low)
            waiting += len(held[-1])
            while waiting >= BLOCK_ROWS:
                rows = np.concatenate(held)
                add(rows[:BLOCK_ROWS])
                held, waiting = [rows[BLOCK_ROWS:]], len(rows) - BLOCK_ROWS
        if waiting:
            add(np.concatenate(held))
        rows = [(i, j, str(v)) for i, row in enumerate([sums, *total], -1) for j, v in enumerate(row, max(i, 0)) if v]
        i, j, v = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(v, pa.string())], ["i", "j", "v"])

    return run


@dataclass(frozen=True)
class Fit:
    """Sums of the fit list and its components: `axes` holds a unit eigenvector per column, by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def real(self) -> np.ndarray:
        """Whether a component varies at all."""
        return self.values > NOISE * max(self.trace, 0.0)


def _ranges(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        n = 0
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column(0), dims)
                n += len(x)
                low = x.min(0) if low is None else np.minimum(low, x.min(0))
                high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(low), pa.array(high), pa.array(np.full(dims, n))], ["i", "low", "high", "n"])

    return run


def fit(rows: DataFrame, dims: int, components: int = COMPONENTS) -> Fit:
    """Sums, covariance and components of the integer vectors `rows.x`, all of length `dims`."""
    per_task = rows.select("x").mapInArrow(_ranges(dims), "i int, low long, high long, n long")
    found = sorted(per_task.groupBy("i").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect())
    n, least = found[0]["n"], [r["low"] for r in found]
    bits = max(1, max(r["high"] - r["low"] for r in found).bit_length())
    parts = rows.select("x").mapInArrow(_scatter(dims, least, bits), "i int, j int, v string")
    # tasks send decimals: sums of 38 digits are exact far beyond any table
    sums, cross = [0] * dims, [[0] * dims for _ in range(dims)]
    for r in parts.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
        if r["i"] < 0:
            sums[r["j"]] = int(r["v"])
        else:
            cross[r["i"]][r["j"]] = cross[r["j"]][r["i"]] = int(r["v"])
    # n times the sum of products of deviations; shifting a dimension changes nothing here
    centred = [[n * cross[i][j] - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    covariance = np.array([[c / (n * n) for c in row] for row in centred])
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    trace = sum(centred[i][i] for i in range(dims)) / (n * n)
    most = min(components, dims)
    return Fit(n, tuple(s + n * low for s, low in zip(sums, least)), axes[:, order[:most]], values[order[:most]], trace)


def _deviations(x: np.ndarray, fitted: Fit) -> np.ndarray:
    """n x - S, exact; Python integers where a long is too small."""
    largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))), 1)
    if fitted.n * largest < 1 << 62:
        return fitted.n * x - np.array(fitted.sums, np.int64)
    return x.astype(object) * fitted.n - np.array(fitted.sums, object)


def _whitened(x: np.ndarray, fitted: Fit) -> tuple[np.ndarray, np.ndarray]:
    """(n x - S, coordinates on the components over their standard deviations, 0 for those that do not vary)."""
    deviations = _deviations(x, fitted)
    scale = np.where(fitted.real, 1 / np.sqrt(np.where(fitted.real, fitted.values, 1)), 0)
    return deviations, (deviations.astype(np.float64) / fitted.n) @ fitted.axes * scale


def _second_moments(dims: int, fitted: Fit):
    """This task's sums of whitened coordinates (i = -1) and of their products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fitted.values)
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            _, z = _whitened(_matrix(batch.column(0), dims), fitted)
            first += z.sum(0)
            second += z.T @ z
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.full(k, -1), i]), pa.int32()), pa.array(np.concatenate([np.arange(k), j]), pa.int32()), pa.array(np.concatenate([first, second[i, j]]))], ["i", "j", "v"]
        )

    return run


def identity_error(rows: DataFrame, dims: int, fitted: Fit) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, over components that vary."""
    sums = rows.select("x").mapInArrow(_second_moments(dims, fitted), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    at = {(r["i"], r["j"]): r["v"] / fitted.n for r in sums}
    real = np.flatnonzero(fitted.real).tolist()
    return max((abs(at[i, j] - at[-1, i] * at[-1, j] - (i == j)) for i in real for j in real if i <= j), default=0.0)


def _rows_out(dims: int, fitted: Fit, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fitted.values)
        explained = fitted.values / fitted.trace if fitted.trace > 0 else np.zeros(k)
        for batch in batches:
            m = len(batch)
            deviations, z = _whitened(_matrix(batch.column(1), dims), fitted)
            small = dims * np.abs(deviations.astype(np.float64)).max(initial=0) ** 2 < 2.0**62
            wide = deviations if small else deviations.astype(object)
            squares = (wide * wide).sum(1).tolist()
            squares = [s if s < 1 << 63 else None for s in squares]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, fitted.n)),
                    pa.array(squares, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(z.reshape(-1), mask=np.tile(~fitted.real, m)), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty or holds a null or non-finite entry are dropped. All others are
    fitted and returned, ids may be null or repeat, and equal rows are equal vectors. Where vectors
    differ in length, only those of the most frequent length (the smaller of equals) take part. A
    direction without variance has no whitened value (null) and is left out of `identity_error`;
    `explained` is 0 where nothing varies. `deviation` is null beyond a long. Vectors shorter than
    `components` have as many components as entries. A component of 2^46 or more is an error, as
    its integer would not be exact. An empty table gives no row; other columns are ignored.
    """
    spark = vectors.sparkSession
    runtime.prepare(spark)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    named = vectors.select(vectors[id_column].cast("bigint").alias("id"), vectors[vector_column].cast("array<double>").alias("vector"))
    rows = materialize(named.mapInArrow(_integers, "id long, dims int, x array<long>"), "integers")
    common = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dims").first()
    if common is None:
        return spark.createDataFrame([], schema)
    dims = common["dims"]
    rows = rows.filter(F.col("dims") == dims)
    fitted = fit(rows, dims, components)
    return rows.select("id", "x").mapInArrow(_rows_out(dims, fitted, identity_error(rows, dims, fitted)), schema)
