"""Correlations of many columns in one pass, each pair over the rows where both have a value.

A task keeps, for blocks of columns, the products of the value and presence matrices of its rows:
per pair the rows in common, both sums, both sums of squares and the sum of products. These add
up over tasks, so a pair costs one row per task whatever the number of rows. Values are taken from
the task's first mean of their column; the sums of all tasks are moved to a common one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendmill.session import prepare_workers

# Columns of a block, and pairs of blocks whose sums a task holds in one pass.
BLOCK = 256
PAIRS_AT_ONCE = 16
_SUMS = ("n", "si", "sj", "sii", "sjj", "sij")
_FROM = ("ci", "cj")


def _products(pairs: list[tuple[int, int]], count: int, block: int):
    """Rows of all columns to (i, j, sums, what both columns' values were taken from) for the block pairs."""
    spans = {b: slice(b * block, min((b + 1) * block, count)) for pair in pairs for b in pair}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {p: np.zeros((6, spans[p[0]].stop - spans[p[0]].start, spans[p[1]].stop - spans[p[1]].start)) for p in pairs}
        start = np.full(count, np.nan)
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            here = ~np.isnan(values)
            for k in np.flatnonzero(np.isnan(start) & here.any(0)):
                start[k] = values[here[:, k], k].mean()
            values -= start
            values[~here] = 0
            here = here.astype(float)
            for (a, b), sums in total.items():
                x, y, p, q = values[:, spans[a]], values[:, spans[b]], here[:, spans[a]], here[:, spans[b]]
                for k, (left, right) in enumerate(((p, q), (x, q), (p, y), (x * x, q), (p, y * y), (x, y))):
                    sums[k] += left.T @ right
        out = []
        for (a, b), sums in total.items():
            i, j = np.meshgrid(np.arange(spans[a].start, spans[a].stop), np.arange(spans[b].start, spans[b].stop), indexing="ij")
            use = (i < j) & (sums[0] > 0)
            out.append([i[use], j[use], *(s[use] for s in sums), start[i[use]], start[j[use]]])
        columns = [np.concatenate([o[k] for o in out]) for k in range(10)]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), *map(pa.array, columns[2:])], ["i", "j", *_SUMS, *_FROM])

    return run


def _spreads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of all columns to one row per column with a value: its number, rows, mean and squared deviations from that."""
    sums: dict[int, tuple[int, float, float]] = {}
    with np.errstate(invalid="ignore", over="ignore"):
        for batch in batches:
            for k, column in enumerate(batch.columns):
                v = column.drop_null().to_numpy(zero_copy_only=False)
                if not len(v):
                    continue
                d = v - v[0]
                n, mean, m2 = len(v), v[0] + d.mean(), float(((d - d.mean()) ** 2).sum())
                if k in sums:
                    n0, mean0, m20 = sums[k]
                    step = mean - mean0
                    n, mean, m2 = n0 + n, mean0 + step * n / (n0 + n), m20 + m2 + step * step * n0 * n / (n0 + n)
                sums[k] = n, float(mean), m2
    columns = [list(sums), *([s[i] for s in sums.values()] for i in range(3))]
    types = (pa.int32(), pa.int64(), pa.float64(), pa.float64())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["k", "n", "mean", "m2"])


def variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, variance): the sample variance of each column over the rows where it has a value, null for fewer than two.

    One row per task and column is added up. An aggregate of as many columns is no longer compiled
    as one method and updates some hundred buffers row by row.
    """
    prepare_workers(df.sparkSession)
    numbers = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    parts = numbers.mapInArrow(_spreads, "k int, n long, mean double, m2 double")
    whole = Window.partitionBy("k")
    # from the least mean on: equal means stay equal
    based = parts.withColumn("base", F.min("mean").over(whole))
    placed = based.withColumn("middle", F.col("base") + F.sum(F.col("n") * (F.col("mean") - F.col("base"))).over(whole) / F.sum("n").over(whole))
    off = F.col("mean") - F.col("middle")
    found = placed.groupBy("k").agg(F.sum("n").alias("n"), F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"))
    found = found.select("k", F.when(F.col("n") > 1, F.col("m2") / (F.col("n") - 1)).alias("variance"))
    listed = df.sparkSession.range(1).select(F.posexplode(F.array(*map(F.lit, columns))).alias("k", "feature"))
    return listed.join(F.broadcast(found), "k", "left").select("feature", "variance")  # one row per column


def correlations(df: DataFrame, columns: Sequence[str], block: int = BLOCK, at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """(i, j, n, r) for every pair of columns, earlier one first: the rows in common and their correlation.

    `r` is null where a column does not vary over the rows in common.
    """
    prepare_workers(df.sparkSession)
    numbers = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    blocks = range(-(-len(columns) // block))
    pairs = [(a, b) for a in blocks for b in blocks if a <= b]
    schema = "i int, j int, " + ", ".join(f"{s} double" for s in (*_SUMS, *_FROM))
    pair = Window.partitionBy("i", "j")
    di, dj = (F.col(c) - F.col(f"{c}_0") for c in _FROM)
    n, si, sj, sii, sjj, sij = (F.col(s) for s in _SUMS)
    # the same sums of values taken from the least of the tasks' means: equal ones stay equal
    moved = {"si": si + n * di, "sj": sj + n * dj, "sii": sii + 2 * di * si + n * di * di, "sjj": sjj + 2 * dj * sj + n * dj * dj, "sij": sij + dj * si + di * sj + n * di * dj}
    out = None
    for at in range(0, len(pairs), at_once):
        part = numbers.mapInArrow(_products(pairs[at : at + at_once], len(columns), block), schema)
        part = part.withColumns({f"{c}_0": F.min(c).over(pair) for c in _FROM}).withColumns(moved)
        part = part.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in _SUMS])
        out = part if out is None else out.unionByName(part)
    if out is None:
        return df.sparkSession.createDataFrame([], "i int, j int, n long, r double")
    spread_i, spread_j = F.col("sii") - F.col("si") * F.col("si") / F.col("n"), F.col("sjj") - F.col("sj") * F.col("sj") / F.col("n")
    # what rounding leaves of a constant column is no variance
    varies = (spread_i > 1e-12 * F.greatest("sii", F.lit(1e-300))) & (spread_j > 1e-12 * F.greatest("sjj", F.lit(1e-300)))
    r = (F.col("sij") - F.col("si") * F.col("sj") / F.col("n")) / F.sqrt(spread_i * spread_j)
    return out.select("i", "j", F.round("n").cast("long").alias("n"), F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"))
