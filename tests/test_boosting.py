from __future__ import annotations

import itertools
import math
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendmill.operators import boosting, pd_model, tree_explain
from lendmill.operators.boosting import NO_FOLD, Params
from lendmill.params import SearchSpace
from lendmill.plans import model_queries


def sample(n=900, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    x[:, 3] = rng.integers(0, 4, n)
    x[rng.random((n, 5)) < 0.15] = np.nan
    z = np.nan_to_num(x[:, 0], nan=1.0) - 0.8 * np.nan_to_num(x[:, 1]) * (np.nan_to_num(x[:, 3]) > 1) + 0.3 * rng.normal(size=n)
    return x, (z > 0).astype(float), np.arange(n) % 5


FEATURES = list("abcde")


def frame(spark, x, y, fold, parts=3):
    rows = [(k, *(None if math.isnan(v) else float(v) for v in row), float(t), int(f)) for k, (row, t, f) in enumerate(zip(x, y, fold))]
    return spark.createDataFrame(rows, "sk_id_curr int, " + ", ".join(f"{f} double" for f in FEATURES) + ", target double, fold int").repartition(parts)


def plain_fit(x, y, fold, edges, params, held):
    """Boosting leaf by leaf, one split at a time; the staged held-out losses and the margins of all rows after each round."""
    q = lambda v: np.rint(v * boosting.SCALE)
    codes = np.column_stack([np.where(np.isnan(x[:, f]), len(e) + 1, np.searchsorted(e, x[:, f])) for f, e in enumerate(edges)])
    train, out = fold != held, fold == held
    mean = y[train].mean()
    base = math.log(mean / (1 - mean)) if params.loss == "logistic" else mean
    margin = np.full(len(y), base)
    stages, curve = [margin.copy()], []

    def best(rows, g, h):
        found = None
        for f, e in enumerate(edges):
            for code in range(len(e) + 1):
                for gap_left in (False, True):
                    c = codes[rows, f]
                    left = np.where(c == len(e) + 1, gap_left, c <= code)
                    a, b = rows[left], rows[~left]
                    sums = [(g[r].sum() / boosting.SCALE, h[r].sum() / boosting.SCALE) for r in (a, b, rows)]
                    if min(len(a), len(b)) < max(1, params.min_rows) or min(sums[0][1], sums[1][1]) < params.min_weight:
                        continue
                    score = [s[0] ** 2 / (s[1] + params.l2 + 1e-15) for s in sums]
                    gain = score[0] + score[1] - score[2]
                    if gain > max(params.min_gain, 1e-12) and (found is None or gain > found[0] + 1e-9):
                        gaps = (c == len(e) + 1).any()
                        found = (gain, f, code, gap_left if gaps else len(a) >= len(b), a, b)
        return found

    for _ in range(params.rounds):
        p = 1 / (1 + np.exp(-margin)) if params.loss == "logistic" else margin
        g, h = q(p - y), q(p * (1 - p)) if params.loss == "logistic" else q(np.ones(len(y)))
        lost = np.logaddexp(0, margin) - y * margin if params.loss == "logistic" else (margin - y) ** 2
        if out.any():
            curve.append(lost[out].mean())
        leaves = [(np.flatnonzero(train), 0, np.ones(len(y), bool))]
        cuts = [best(leaves[0][0], g, h)]
        while len(leaves) < params.leaves:
            can = [k for k, c in enumerate(cuts) if c is not None and (not params.depth or leaves[k][1] < params.depth)]
            if not can:
                break
            k = max(can, key=lambda i: cuts[i][0])
            _, f, code, gap_left, a, b = cuts[k]
            _, depth, where = leaves[k]
            side = np.where(codes[:, f] == len(edges[f]) + 1, gap_left, codes[:, f] <= code)
            leaves[k], cuts[k] = (a, depth + 1, where & side), best(a, g, h)
            leaves.append((b, depth + 1, where & ~side))
            cuts.append(best(b, g, h))
        if len(leaves) == 1:
            break
        for rows, _, where in leaves:
            margin[where] += -params.step * g[rows].sum() / (h[rows].sum() + params.l2 * boosting.SCALE)
        stages.append(margin.copy())
    return stages, curve


@pytest.mark.parametrize("params", [
    Params(rounds=5, leaves=6, step=0.3, min_rows=10, patience=0),
    Params(rounds=4, leaves=8, depth=2, step=0.5, min_rows=5, l2=1.0, patience=0),
    Params(rounds=4, leaves=5, step=0.3, min_rows=10, patience=0, loss="squared"),
])
def test_equals_a_plain_twin(spark, params):
    x, y, fold = sample(300)
    data = boosting.quantise(frame(spark, x, y, fold), FEATURES, "target", fold="fold", bins=12, block_rows=64)
    models = boosting.fit_all(data, [(params, 2), (params, NO_FOLD)])
    for model, held in zip(models, (2, NO_FOLD)):
        stages, curve = plain_fit(x, y, fold, data.edges, params, held)
        assert len(model.trees) == len(stages) - 1
        assert model.margins(x) == pytest.approx(stages[-1], abs=1e-6)
        assert model.curve[: len(curve)] == pytest.approx(curve, abs=1e-6)


def test_patience_keeps_the_best_round(spark):
    x, y, fold = sample(600)
    rng = np.random.default_rng(0)
    noisy = np.where(rng.random(len(y)) < 0.35, 1 - y, y)
    data = boosting.quantise(frame(spark, x, noisy, fold), FEATURES, "target", fold="fold", block_rows=256)
    long = boosting.fit(data, Params(rounds=40, leaves=8, step=0.4, patience=0), held=1)
    short = boosting.fit(data, Params(rounds=40, leaves=8, step=0.4, patience=5), held=1)
    best = int(np.argmin(long.curve))
    assert len(long.curve) == 41 and 0 < best < 30
    assert len(short.trees) == best and short.curve == pytest.approx(long.curve[: len(short.curve)]) and len(short.curve) == best + 6
    assert all((a.feature == b.feature).all() and a.value == pytest.approx(b.value) for a, b in zip(short.trees, long.trees))


def test_fit_does_not_depend_on_the_layout(spark, monkeypatch):
    x, y, fold = sample(500)
    params = Params(rounds=6, leaves=7, columns=0.6, patience=0)
    edges = boosting.quantile_edges(frame(spark, x, y, fold), FEATURES)
    one = boosting.fit(boosting.quantise(frame(spark, x, y, fold, 1), FEATURES, "target", edges=edges), params)
    monkeypatch.setattr(boosting, "WRITTEN_EVERY", 2)  # margins go through the shared folder
    many = boosting.fit(boosting.quantise(frame(spark, x, y, fold, 7), FEATURES, "target", edges=edges, block_rows=40), params)
    assert len(one.trees) == len(many.trees) == 6
    for a, b in zip(one.trees, many.trees):
        assert (a.feature == b.feature).all() and (a.code == b.code).all() and a.value == pytest.approx(b.value, abs=1e-9)


def test_gaps_have_a_side_of_their_own(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 5))
    x[:200, 0] = np.nan
    y = (np.arange(400) < 200).astype(float)
    data = boosting.quantise(frame(spark, x, y, np.zeros(400, int)), FEATURES, "target")
    model = boosting.fit(data, Params(rounds=1, leaves=2, step=1.0, patience=0))
    assert model.trees[0].feature[0] == 0
    scored = model.outputs(x)
    assert scored[:200].min() > 0.8 and scored[200:].max() < 0.2


def test_empty_and_constant_inputs(spark):
    x, y, fold = np.zeros((50, 5)), np.arange(50) % 2.0, np.zeros(50, int)
    data = boosting.quantise(frame(spark, x, y, fold), FEATURES, "target")
    model = boosting.fit(data, Params(rounds=3))
    assert model.trees == [] and model.outputs(x) == pytest.approx(np.full(50, 0.5))
    x[:] = np.nan
    data = boosting.quantise(frame(spark, x, y, fold), FEATURES, "target")
    assert boosting.fit(data, Params(rounds=3)).trees == []


def expected_margin(tree, row, known, node=0):
    if tree.feature[node] < 0:
        return tree.value[node]
    f, children = tree.feature[node], (tree.left[node], tree.right[node])
    if f in known:
        left = tree.gap_left[node] if math.isnan(row[f]) else row[f] <= tree.edge[node]
        return expected_margin(tree, row, known, children[0] if left else children[1])
    return sum(tree.cover[c] / tree.cover[node] * expected_margin(tree, row, known, c) for c in children)


def plain_contributions(model, row):
    d = len(model.features)
    game = {s: sum(expected_margin(t, row, set(s)) for t in model.trees) for r in range(d + 1) for s in itertools.combinations(range(d), r)}
    out = np.zeros(d)
    for i in range(d):
        for s in game:
            if i not in s:
                out[i] += math.factorial(len(s)) * math.factorial(d - 1 - len(s)) / math.factorial(d) * (game[tuple(sorted((*s, i)))] - game[s])
    return out, game[()]


def test_contributions_equal_all_subsets(spark):
    x, y, fold = sample(400)
    df = frame(spark, x, y, fold)
    model = boosting.fit(boosting.quantise(df, FEATURES, "target"), Params(rounds=4, leaves=9, step=0.4, min_rows=8, patience=0))
    found = tree_explain.contributions_of(model, x[:25])
    for row, got in zip(x[:25], found):
        want, mean = plain_contributions(model, row)
        assert got == pytest.approx(want, abs=1e-12)
        assert model.base + mean == pytest.approx(tree_explain.mean_margin(model))
    rows = tree_explain.tree_contributions(df, model, keep=["target"]).collect()
    assert len(rows) == 400
    for r in rows:
        total = tree_explain.mean_margin(model) + sum(r[f"{f}_contrib"] for f in FEATURES)
        assert r["margin"] == pytest.approx(total, abs=1e-10) and r["margin"] == pytest.approx(model.margins(x[[r["sk_id_curr"]]])[0])


def test_partial_dependence_equals_expanded_rows(spark):
    x, y, fold = sample(300)
    df = frame(spark, x, y, fold)
    model = boosting.fit(boosting.quantise(df, FEATURES, "target"), Params(rounds=5, leaves=6, step=0.4, min_rows=8, patience=0))
    grids = tree_explain.grid(df, ["a", "d"], 9)
    got = {(r["feature"], round(r["grid_value"], 9)): r["mean_pd"] for r in tree_explain.partial_dependence(df, model, grids).collect()}
    assert len(got) == 18
    for f, at in grids.items():
        for v in at:
            held = x.copy()
            held[:, FEATURES.index(f)] = v
            assert got[f, round(v, 9)] == pytest.approx(model.outputs(held).mean(), abs=1e-12)


def test_scores_in_one_pass(spark):
    x, y, fold = sample(200)
    df = frame(spark, x, y, fold)
    data = boosting.quantise(df, FEATURES, "target", fold="fold")
    models = boosting.fit_all(data, [(Params(rounds=3, leaves=4), k) for k in range(2)])
    rows = boosting.score(df, {"m0": models[0], "m1": models[1]}, ["sk_id_curr"]).orderBy("sk_id_curr").collect()
    for k, model in enumerate(models):
        assert [r[f"m{k}"] for r in rows] == pytest.approx(model.outputs(x))
    assert boosting.score(df.filter(F.lit(False)), {"m0": models[0]}, ["sk_id_curr"]).count() == 0


def test_halving_keeps_the_best_of_each_rung(spark):
    x, y, fold = sample(400)
    rng = np.random.default_rng(4)
    noisy = np.where(rng.random(len(y)) < 0.2, 1 - y, y)
    data = boosting.quantise(frame(spark, x, noisy, fold % 2), FEATURES, "target", fold="fold", bins=16)
    settings = [Params(rounds=18, leaves=leaves, step=step, min_rows=10, patience=0) for leaves in (2, 4, 12) for step in (0.02, 0.2, 0.7)]
    wanted = [(p, k) for p in settings for k in range(2)]
    trial = [t for t in range(9) for _ in range(2)]
    whole = boosting.fit_all(data, wanted)
    pruned = boosting.fit_all(data, wanted, boosting.Halving(trial, first=2, most=18, factor=3))

    def best(models, t, rounds):
        return sum(min(m.curve[:rounds]) for m in models[2 * t : 2 * t + 2]) / 2

    expected, running = {}, list(range(9))
    for rung in (2, 6, 18):
        # the loss of the last tree is not known yet when a rung is judged
        left = sorted(running, key=lambda t: (best(whole, t, rung), t))[: max(1, len(running) // 3)]
        expected |= {t: rung for t in running}
        running = left
    assert [len(pruned[2 * t].trees) for t in range(9)] == [expected[t] for t in range(9)]
    assert sorted(expected.values()) == [2] * 6 + [6] * 2 + [18]
    for a, b in zip(pruned, whole):
        assert a.curve == pytest.approx(b.curve[: len(a.curve)])


@pytest.mark.parametrize("heavy", [1.0, 1e7])
@pytest.mark.parametrize("every", [True, False])
def test_histograms_equal_plain_sums(heavy, every):
    """Counts packed into the second sums (light weights) or added up on their own (heavy ones), over all rows of a block or some."""
    rng = np.random.default_rng(3)
    widths, n, nodes = [2, 5, 256], 500, 3
    first = np.concatenate([[0], np.cumsum(widths)])
    codes = np.stack([rng.integers(0, w, n) for w in widths]).astype(np.uint8)
    rows = np.arange(n) if every else np.flatnonzero(rng.random(n) < 0.4)
    node = rng.integers(0, nodes, len(rows))
    g, h = (np.rint(rng.uniform(low, 1, len(rows)) * heavy * boosting.SCALE).astype(np.int64) for low in (-1, 0))
    assert (int(h.sum()) < boosting._COUNTED) == (heavy == 1.0)
    expected = np.zeros((nodes, int(first[-1]), 3), np.int64)
    for f in (0, 2):
        for r, k, a, b in zip(rows, node, g, h):
            expected[k, first[f] + codes[f, r]] += (a, b, 1)
    sums = np.zeros_like(expected)
    boosting._histograms(codes, node, nodes, g, h, [0, 2], first, None if every else rows, sums)
    assert (sums == expected).all()


def test_rows_go_on_from_the_node_they_were_in():
    """A pass does not walk from the root again; a new round, or an earlier form of the tree, does."""
    codes, gaps = np.array([[0, 1, 2, 3, 4]], np.uint8), np.array([4])
    tree = lambda cuts: boosting.Tree(
        np.array([0 if c is not None else -1 for c in cuts]), np.array([c or 0 for c in cuts]), np.zeros(len(cuts)), np.ones(len(cuts), bool),
        np.array([1, 3, -1, -1, -1][: len(cuts)]), np.array([2, 4, -1, -1, -1][: len(cuts)]), np.zeros(len(cuts)), np.zeros(len(cuts)))
    small, large = tree([1, None, None]), tree([1, 0, None, None, None])
    job = lambda growing, recent=(): boosting._Job(0, 0, boosting.Params(), -1, 0.0, 0, list(recent), growing, [0], np.array([0]), False)
    whole = large.leaf_by_code(codes, gaps).tolist()
    assert boosting._placed("walk", 1, job(small), codes, gaps).tolist() == small.leaf_by_code(codes, gaps).tolist()
    moved = tree([None, 0, None, None, None])
    # with a root that is a leaf now, only rows that were moved before can stand deeper
    assert boosting._placed("walk", 1, job(moved), codes, gaps).tolist() == whole
    assert boosting._placed("walk", 1, job(small), codes, gaps).tolist() == small.leaf_by_code(codes, gaps).tolist()
    assert boosting._placed("walk", 1, job(large, [small]), codes, gaps).tolist() == whole


@pytest.mark.parametrize("heavy", [1.0, 1e5])
def test_features_of_few_codes_are_added_up_together(heavy):
    """Ten features with two codes, a constant one and a gap beside one with many: three passes over the rows instead of thirteen, the same sums."""
    rng = np.random.default_rng(5)
    widths, n, nodes = [4] * 10 + [3, 6, 256], 700, 3
    first = np.concatenate([[0], np.cumsum(widths)])
    codes = np.stack([*(rng.integers(0, 2, n) * rng.integers(1, 4) for _ in range(10)), np.full(n, 2), rng.choice([0, 3, 5], n), rng.integers(0, 256, n)]).astype(np.uint8)
    alone, joined = boosting._joined(codes, first)
    assert alone == [12] and len(joined) == 2 and all(len(j.spread) <= boosting.JOINED for j in joined)
    node, rows = rng.integers(0, nodes, n), np.flatnonzero(rng.random(n) < 0.6)
    g, h = (np.rint(rng.uniform(low, 1, len(rows)) * heavy * boosting.SCALE).astype(np.int64) for low in (-1, 0))
    plain, found = (np.zeros((nodes, int(first[-1]), 3), np.int64) for _ in range(2))
    boosting._histograms(codes, node[rows], nodes, g, h, range(13), first, rows, plain)
    boosting._histograms(codes, node[rows], nodes, g, h, alone, first, rows, found, joined)
    assert plain[:, :, 2].sum() == 13 * len(rows) and (found == plain).all()


def test_edges_are_those_of_single_marks(spark):
    x, y, fold = sample(700)
    df = frame(spark, x, y, fold, 1)
    marks = [k / 11 for k in range(1, 11)]
    row = df.agg(*[F.percentile_approx(f, marks, 2_000).alias(f) for f in FEATURES]).first()
    for f, found in zip(FEATURES, boosting.quantile_edges(df, FEATURES, bins=12)):
        assert found.tolist() == sorted(set(row[f]))


def test_explaining_fits_the_first_fold_only(spark, monkeypatch):
    x, y, fold = sample(400)
    df = frame(spark, x, y, fold)
    params = Params(rounds=3, leaves=4, step=0.3, min_rows=8)
    fit_all, quantise, folds, tables = boosting.fit_all, boosting.quantise, [], []
    monkeypatch.setattr(boosting, "fit_all", lambda data, wanted, halving=None: folds.append([held for _, held in wanted]) or fit_all(data, wanted, halving))
    monkeypatch.setattr(boosting, "quantise", lambda *a, **k: tables.append(a) or quantise(df, FEATURES, "target", fold="fold", block_rows=128))
    monkeypatch.setattr(model_queries, "BOOSTED", {"boosted_by_leaf": params, "boosted_by_depth": params})
    monkeypatch.setattr(model_queries, "training", lambda dom, gaps=False: df)
    monkeypatch.setattr(model_queries, "model_table", lambda dom: SimpleNamespace(selected=FEATURES))
    dom = SimpleNamespace(spark=spark, folder="own rows")
    first = model_queries.explained_model(dom)
    assert folds == [[0]] and model_queries.explained_model(dom) is first and len(folds) == 1
    # the other folds' models are fitted when they are asked for, on the same blocks, as those of a candidate that is not explained
    found, plain = (model_queries.fitted(dom, name) for name in model_queries.BOOSTED)
    assert folds == [[0], [1, 2, 3, 4], [0, 1, 2, 3, 4]] and len(tables) == 1 and found.models[0] is first
    for a, b in zip(found.models, plain.models, strict=True):
        assert a.curve == b.curve and len(a.trees) == len(b.trees) > 0
        assert all((s.feature == t.feature).all() and (s.value == t.value).all() for s, t in zip(a.trees, b.trees))
    rows = [sorted(map(tuple, f.oof.collect())) for f in (found, plain)]
    assert rows[0] == rows[1] and len(rows[0]) == 400
    assert model_queries.explained_model(dom) is first


@pytest.mark.parametrize("params", [
    Params(rounds=6, leaves=9, step=0.3, min_rows=8, columns=0.7, subsample=0.8, patience=0),
    Params(rounds=25, leaves=7, depth=3, step=0.5, min_rows=5, l1=0.1, l2=1.0, patience=4),
    Params(rounds=5, leaves=6, step=0.3, min_rows=10, patience=0, loss="squared"),
])
def test_models_fitted_whole_in_tasks_are_those_of_shared_passes(spark, monkeypatch, params):
    x, y, fold = sample(700)
    data = boosting.quantise(frame(spark, x, y, fold), FEATURES, "target", fold="fold", block_rows=128)
    wanted = [(params, k) for k in (0, 1, 2)] + [(params, NO_FOLD)]
    passes, summed = [], boosting._summed
    monkeypatch.setattr(boosting, "_summed", lambda *a: passes.append(a) or summed(*a))
    whole = boosting.fit_all(data, wanted)
    assert not passes
    monkeypatch.setattr(boosting, "WHOLE_BYTES", 0)
    monkeypatch.setattr(boosting, "WRITTEN_EVERY", 2)
    shared = boosting.fit_all(data, wanted)
    assert len(passes) > params.leaves // 2
    for a, b in zip(whole, shared, strict=True):
        assert a.curve == b.curve and a.base == b.base and len(a.trees) == len(b.trees) > 0
        for s, t in zip(a.trees, b.trees):
            assert all((getattr(s, c) == getattr(t, c)).all() for c in ("feature", "code", "edge", "gap_left", "left", "right", "value", "cover"))


def test_search_runs_every_trial_to_its_end(spark):
    """No trial is given up for a loss behind the others': each ends by its rounds, or by its own patience."""
    x, y, fold = sample(400)
    space = SearchSpace(trees=(60, 70), leaves=(3, 6), step=(0.002, 0.01), min_rows=(10, 20), min_gain=(0.0, 1e-6), l1=(1e-5, 1e-4))
    drawn, rows = pd_model.draw(space, 4), frame(spark, x, y, fold % 3).withColumn("weight", F.lit(1.0))
    found = pd_model.tune(rows, FEATURES, trials=4, space=space).collect()
    assert sorted(r["trial"] for r in found) == list(range(4))
    assert all(r["rounds_run"] == r["rounds"] == drawn[r["trial"]].rounds > 50 for r in found)
    pruned = pd_model.tune(rows, FEATURES, trials=4, space=space, first=5, most=15).collect()
    assert sorted(r["rounds_run"] for r in pruned)[:3] == [4, 4, 4]
