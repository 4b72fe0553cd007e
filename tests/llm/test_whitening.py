from __future__ import annotations

import math
import random

import numpy as np
import pytest

from lendmill.llm import whitening
from lendmill.llm.queries import QUERIES
from tests.conftest import SMALL


def plain(vectors):
    """{id: [deviation, coordinates]}, shares and trace by NumPy over all rows at once."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in vectors], object)
    n, sums = len(x), x.sum(0)
    deviations = x * n - sums
    centred = deviations.astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    return n, (deviations**2).sum(1), centred @ axes[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<float>, id string, dims int").repartition(3)


def check(got, vectors):
    n, deviations, z, shares = plain(vectors)
    most = min(32, z.shape[1])
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(got) == len(vectors) * most
    sign = {}
    for k, (i, _) in enumerate(vectors):
        for c in range(most):
            r = by_id[i][c + 1]
            assert (r["n"], r["deviation"]) == (n, deviations[k])
            assert r["explained"] == pytest.approx(shares[c], rel=1e-9)
            if c not in sign and abs(z[k, c]) > 0.1:
                sign[c] = 1 if r["whitened"] * z[k, c] > 0 else -1
            assert r["whitened"] == pytest.approx(sign.get(c, 1) * z[k, c], abs=2e-7 if c in sign else 0.2)
            assert r["identity_error"] < 1e-9


def test_equals_numpy_on_random_vectors(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, (rng.normal(size=40) * np.linspace(0.2, 3, 40)).astype(np.float32).tolist()) for i in range(300)]
    check(whitening.whiten(frame(spark, vectors)).collect(), vectors)


def test_equals_numpy_on_the_given_table(spark):
    vectors = [(r[0], r[1]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect() if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    got = QUERIES["op13_bit_sliced_whitening"](spark, SMALL)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = got.collect()
    n, deviations, _, shares = plain(vectors)
    first = {r["vec_id"]: r["deviation"] for r in rows if r["component"] == 1}
    assert first == {i: d for (i, _), d in zip(vectors, deviations)}
    assert rows[0]["n"] == n and rows[0]["identity_error"] < 1e-4
    assert {r["component"]: r["explained"] for r in rows} == pytest.approx({c + 1: s for c, s in enumerate(shares[:32])}, rel=1e-6)


def test_counts_of_common_bits_are_product_sums():
    rng = np.random.default_rng(1)
    for bits in (1, 7, 31):
        shifted = rng.integers(0, 1 << bits, (201, 5))
        sliced = whitening.planes(shifted, bits)
        wide = shifted.astype(object)
        assert whitening.cross_products(sliced) == [[int((wide[:, i] * wide[:, j]).sum()) for j in range(i, 5)] for i in range(5)]
        assert whitening.plane_sums(sliced) == wide.sum(0).tolist()


def test_awkward_rows(spark):
    rnd = random.Random(4)
    good = [(k, [rnd.uniform(-9, 9) for _ in range(3)]) for k in range(30)]
    good = [(k, np.float32(v).tolist()) for k, v in good]
    bad = [(None, None), (50, []), (51, [1.0, None, 2.0]), (52, [1.0, float("nan"), 2.0]), (53, [float("inf"), 0.0, 1.0]), (54, [1.0, 2.0])]
    got = whitening.whiten(frame(spark, good + bad)).collect()
    check(got, good)
    # equal vectors, repeated and null ids take part, a constant dimension has no coordinate
    same = [(None, [0.0, 1.0]), (None, [0.0, 1.0]), (7, [0.0, -1.0]), (7, [0.0, 3.0])]
    got = whitening.whiten(frame(spark, same)).collect()
    assert len(got) == 8 and {r["n"] for r in got} == {4}
    assert sorted(r["whitened"] for r in got if r["component"] == 1)[1:3] == pytest.approx([0, 0]) and all(r["whitened"] is None for r in got if r["component"] == 2)
    alone = whitening.whiten(frame(spark, [(1, [5.0, 2.0])])).collect()
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alone] == [(0, None, 0.0, 0.0)] * 2
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, bad[:5])).count() == 0


def test_values_far_apart_stay_exact(spark):
    rows = [(1, [2.0**20, 1.0]), (2, [-(2.0**20), 2.0]), (3, [0.0, 5.0]), (4, [2.0**40, 7.0])]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(frame(spark, rows)).collect()}
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((4 * c - s) ** 2 for c, s in zip(v, sums)) for (i, _), v in zip(rows, x)}
    assert got == {i: d if d < 1 << 63 else None for i, d in want.items()}
