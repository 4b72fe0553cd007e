"""Null, NaN, tie and edge behaviour of the column helpers and the scale operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lendmill.functions import nullsafe as ns
from lendmill.functions.search import just_below, with_rank
from lendmill.operators import joins, quantiles, running


def column(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.5,), (9.0,)], "x double")
    assert column(df, ns.clip("x", 0.0, 1.0)) == [None, 0.0, 0.5, 1.0]
    assert column(df, ns.clip("x", low=0.0)) == [None, 0.0, 0.5, 9.0]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert column(ns.no_nan(df), "x") == [None, 1.0]


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in (None, -1.0, -0.5, 1.0, 1.5, 2.0, 9.0, 999.0, 1000.0)], "x double")
    labels = ["a", "b", "c"]
    assert column(df, ns.cut("x", [-1, 1, 2, 999], labels)) == [None, None, "a", "a", "b", "b", "c", "c", None]
    assert column(df, ns.cut("x", [-1, 1, 2, 999], labels, include_lowest=True))[1] == "a"


def test_step_left_closed(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "x double")
    assert column(df, ns.step("x", [0.2, 0.3], [0, 1, 2], closed_right=False)) == [0, 1, 2]


def test_ratio_by_zero_is_finite(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 1.0)], "a double, b double")
    assert column(df, ns.ratio("a", "b")) == [1.0 / 1e-6, None]


def test_cents_use_the_decimal_value(spark):
    df = spark.createDataFrame([(2.675,), (1.005,)], "x double")
    assert column(df, ns.cents(F.col("x"))) == [2.68, 1.01]
    assert column(df, ns.cents(F.col("x"), half_even=True)) == [2.68, 1.0]


def test_with_rank_matches_numpy(spark):
    rng = np.random.default_rng(1)
    edges = [sorted(rng.random(5)), sorted(rng.random(13)), []]
    values = [*rng.random(300), *edges[0], *edges[1]]
    rows = [(i % 3, float(v)) for i, v in enumerate(values)] + [(0, None)]
    got = with_rank(spark.createDataFrame(rows, "f int, x double"), "x", edges, "k", "f").collect()
    for r in got:
        expected = None if r["x"] is None else int(np.searchsorted(edges[r["f"]], r["x"], side="left"))
        assert r["k"] == expected


def test_just_below():
    assert just_below(1.0) < 1.0 and just_below(0.0) < 0.0


PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.65, 0.99, 0.999, 1.0]


@pytest.mark.parametrize("limits", [{}, {"bracket_rows": 100}])
def test_exact_quantiles(spark, limits):
    rng = np.random.default_rng(7)
    n = 30_000
    smooth = rng.normal(size=n)
    ties = rng.integers(0, 20, size=n).astype(float)
    hot = np.where(rng.random(n) < 0.4, 5.0, rng.exponential(size=n))
    pdf = pd.DataFrame({"smooth": smooth, "ties": ties, "hot": hot, "single": 3.0})
    df = spark.createDataFrame(pdf).withColumn("gaps", F.when(F.col("smooth") > 0, F.col("smooth"))).withColumn("empty", F.lit(None).cast("double"))
    got = quantiles.exact_quantiles(df.repartition(8), {c: PROBABILITIES for c in df.columns}, **limits)
    for c in ("smooth", "ties", "hot", "single"):
        assert np.allclose(got[c], np.quantile(pdf[c], PROBABILITIES), rtol=0, atol=1e-12)
    assert np.allclose(got["gaps"], np.quantile(smooth[smooth > 0], PROBABILITIES), rtol=0, atol=1e-12)
    assert got["empty"] == [None] * len(PROBABILITIES)


def test_a_wrong_bracket_is_noticed_and_opened(spark, monkeypatch):
    df = spark.createDataFrame([(float(i),) for i in range(1000)], "x double")
    wrong = quantiles._Target("x", 500.25, 1000, low=900.0, high=950.0)
    assert quantiles._select(df, [wrong]) == [None]
    seen = []
    real = quantiles._select

    def once_wrong(frame, targets):
        seen.append([(t.low, t.high) for t in targets])
        return [None] * len(targets) if len(seen) == 1 else real(frame, targets)

    monkeypatch.setattr(quantiles, "_select", once_wrong)
    assert quantiles.exact_quantiles(df, {"x": [0.25]}) == {"x": [249.75]}
    assert seen[1] == [(None, None)]


def test_quantiles_do_not_depend_on_size_limits_or_partitions(spark):
    """Bit for bit, and every value of a table survives its repetition."""
    df = spark.range(3001).select((F.col("id") * 7919 % 3001 / 7.0 + 0.1).alias("x"))
    base = quantiles.exact_quantiles(df, {"x": PROBABILITIES})
    assert quantiles.exact_quantiles(df.repartition(13), {"x": PROBABILITIES}, bracket_rows=20) == base
    many = df.crossJoin(spark.range(20).select(F.col("id").alias("copy"))).select("x")
    grid = [0.0, 0.25, 0.5, 0.75, 1.0]  # ranks that fall on a value: 3000 steps
    assert quantiles.exact_quantiles(many, {"x": [0.5]}) == quantiles.exact_quantiles(df, {"x": [0.5]})
    assert quantiles.exact_quantiles(many, {"x": grid}, bracket_rows=500) == quantiles.exact_quantiles(many, {"x": grid})


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [(), ("g",)])
def test_running_totals_over_ranges(spark, descending, by):
    df = spark.range(1000).select((F.col("id") * 7 % 1000 / 1000.0).alias("k"), (F.col("id") % 3).alias("g"), (F.col("id") % 11).alias("v"))
    order = F.col("k").desc() if descending else F.col("k").asc()
    whole = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("t", F.sum("v").over(whole))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several ranges even here
    try:
        ranged = running.running_totals(df, "k", {"t": "v"}, by=by, descending=descending)
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, ranged.select(*plain.columns).collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rank_within_is_a_row_number(spark):
    df = spark.range(5000).select("id", (F.col("id") % 2).alias("g"))
    key = F.pmod(F.col("id") * 48271, F.lit(2147483647))
    ranked = running.rank_within(df, ["g"], key, 0, 2147483647, "id").toPandas()
    ranked["h"] = ranked["id"] * 48271 % 2147483647
    for _, part in ranked.groupby("g"):
        assert list(part.sort_values(["h", "id"])["row_rank"]) == list(range(len(part)))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_with_a_hot_and_a_null_key(spark, how):
    """A third of the rows share one key, some keys are null, some have no match."""
    rows = [(i, 7 if i % 3 == 0 else None if i % 50 == 1 else i % 400) for i in range(3000)]
    fact = spark.createDataFrame(rows, "id long, k long")
    dim = spark.range(300).select(F.col("id").alias("d"), (F.col("id") * 2).alias("value"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r["id"]: r["value"] for r in joins.lookup_join(fact, dim, "k", "d", how).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = {i: None if k is None or k >= 300 else 2 * k for i, k in rows}
    assert got == (want if how == "left" else {i: v for i, v in want.items() if v is not None})
