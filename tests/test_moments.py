from __future__ import annotations

import math

import numpy as np
import pytest

from lendmill.operators import encode, moments, woe


def frame(spark, x, names):
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) for r in x]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(4)


@pytest.mark.parametrize("block,at_once", [(256, 16), (3, 1), (2, 2)])
def test_correlations_over_common_rows(spark, block, at_once):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 7)) * [1, 1e-3, 1e6, 1, 1, 1, 1] + [0, 5, 1e9, 0, 0, 0, 0]
    x[:, 1] = x[:, 0] * 1e-3 + 5
    x[:, 4] = 3.5
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 5] = np.nan
    x[1:, 6] = np.nan
    names = [f"c{k}" for k in range(7)]
    got = {(r["i"], r["j"]): (r["n"], r["r"]) for r in moments.correlations(frame(spark, x, names), names, block, at_once).collect()}
    for j in range(7):
        for i in range(j):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            n = int(both.sum())
            if not n:
                assert (i, j) not in got
                continue
            a, b = x[both, i], x[both, j]
            assert got[i, j][0] == n
            if n < 2 or a.std() == 0 or b.std() == 0:
                assert got[i, j][1] is None
            else:
                assert got[i, j][1] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9)


def test_selection_keeps_the_earlier_of_close_columns(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=300)
    x = np.column_stack([a, 2 * a + 0.01 * rng.normal(size=300), rng.normal(size=300), np.full(300, 2.0), -a])
    x[::7, 1] = np.nan
    status = encode.select_features(frame(spark, x, list("abcde")), list("abcde"))
    assert status == {"a": "kept", "b": "correlated", "c": "kept", "d": "low_variance", "e": "correlated"}
    assert {r["feature"]: r["n_partners"] for r in encode.high_correlation(frame(spark, x, list("abcde")), list("abcde")).collect()} == {"b": 1, "e": 2}


def test_sparse_one_hot_of_many_values(spark):
    rows = [(k, f"id-{k:06d}", None if k % 4 == 0 else "xy"[k % 2]) for k in range(20_000)] + [(90_000, None, None)]
    df = spark.createDataFrame(rows, "sk_id_curr long, name string, kind string").repartition(5)
    codes = encode.dictionary(df, ["name", "kind"])
    got = {r["sk_id_curr"]: (r["size"], r["indices"]) for r in encode.sparse_one_hot(df, ["name", "kind"], codes).collect()}
    assert len(got) == len(rows) and {s for s, _ in got.values()} == {20_002}
    assert got[7] == (20_002, [7, 20_001]) and got[4][1] == [4] and got[90_000][1] == []
    with pytest.raises(ValueError):
        encode.fit_encoding(df, ["name"])


@pytest.mark.parametrize("constant", [2_000, 0])
def test_woe_by_value_through_one_map(spark, constant):
    rows = [(k, [None, "a", "b'q", "é\\z"][k % 4], k % 3, k / 10) for k in range(60)]
    df = spark.createDataFrame(rows, "id int, t string, n int, x double")
    values = spark.createDataFrame([("t", "a", 0.5), ("t", "b'q", -1.0), ("t", "é\\z", 2.0), ("n", "0", 0.25), ("n", "2", -0.75)], "feature string, category string, woe double")
    out = woe._apply_values(df, values, ["t", "n"], "_woe", constant).collect()
    assert len(out) == 60
    for r in out:
        assert r["t_woe"] == {"a": 0.5, "b'q": -1.0, "é\\z": 2.0}.get(r["t"], 0.0) and r["n_woe"] == {0: 0.25, 2: -0.75}.get(r["n"], 0.0)


def test_exchanges_do_not_grow_with_the_features(spark):
    def exchanges(count):
        df = spark.createDataFrame([tuple(["a"] * count)], ", ".join(f"f{k} string" for k in range(count)))
        values = spark.createDataFrame([(f"f{k}", "a", 1.0) for k in range(count)], "feature string, category string, woe double")
        plan = woe._apply_values(df, values, [f"f{k}" for k in range(count)], "_woe", 0)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange")

    assert exchanges(2) == exchanges(12)


def test_variances_equal_those_of_sql(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6)) * [1, 1e-3, 1e6, 1, 1, 1] + [0, 1e6, 1e9, 0, 0, 0]
    x[:, 3] = 0.1
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 4] = np.nan
    x[1:, 5] = np.nan
    x[0, 5] = 2.0
    names = [f"c{k}" for k in range(6)]
    df = frame(spark, x, names)
    got = {r["feature"]: r["variance"] for r in moments.variances(df, names).collect()}
    want = df.selectExpr(*[f"var_samp({c}) AS {c}" for c in names]).first().asDict()
    assert list(got) == names and got["c3"] == 0 and got["c4"] is None and got["c5"] is None
    assert got == {c: v if v is None else pytest.approx(v, rel=1e-9) for c, v in want.items()}
    none = df.filter("1 = 0")
    assert [r["variance"] for r in moments.variances(none, names).collect()] == [None] * 6


def test_correlations_read_the_rows_once(spark, monkeypatch):
    """The means are those of the tasks: no pass before, and the sums of tasks with far means meet."""
    x = np.random.default_rng(6).normal(size=(600, 3)) * [1, 1e3, 1] + np.repeat([[0, 1e7, -50], [900, -1e7, 50]], 300, axis=0)
    df = frame(spark, x, list("abc"))

    def asked(*_):
        raise AssertionError("the rows are read before")

    with monkeypatch.context() as m:
        m.setattr(type(df), "first", asked)
        m.setattr(type(df), "collect", asked)
        found = moments.correlations(df, list("abc"))
    got = {(r["i"], r["j"]): r["r"] for r in found.collect()}
    want = np.corrcoef(x.T)
    assert got == {(i, j): pytest.approx(want[i, j], abs=1e-9) for j in range(3) for i in range(j)}


def test_selection_writes_one_wide_table(spark, monkeypatch):
    """The queries that read the features once write none of them, the selection writes them before gaps are filled."""
    from lendmill.plans import model_table
    from lendmill.sources.domain import Domain
    from tests.conftest import SMALL

    written, write = [], model_table.materialize
    monkeypatch.setattr(model_table, "materialize", lambda df, label, *a: written.append(label) or write(df, label, *a))
    monkeypatch.setattr(model_table, "_TABLES", {})
    dom = Domain(spark, SMALL)
    for name in ("sel_low_variance", "sel_target_corr", "sel_high_corr"):
        model_table.QUERIES[name].build(dom)
    assert written == []
    table = model_table.model_table(dom)
    assert written == ["encoded"] and model_table.model_table(dom) is table
    assert table.filled.columns == table.gaps.columns == [*model_table.KEYS, *table.selected]
    assert table.filled.count() == table.gaps.count() == dom.application.count()
