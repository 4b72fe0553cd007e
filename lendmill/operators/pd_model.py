"""Default-probability models: folds, fits, out-of-fold scores, calibration, search."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import clip, count_when
from lendmill.operators import boosting, evaluate, isotonic
from lendmill.operators.boosting import Params
from lendmill.operators.explain import HASH_MODULUS, id_hash
from lendmill.operators.quantiles import median
from lendmill.operators.running import rank_within, running_totals
from lendmill.operators.scoring import positive_probability, raw_ensemble
from lendmill.params import SearchSpace
from lendmill.session import materialize


def class_weight(df: DataFrame) -> DataFrame:
    """Negatives per positive."""
    good, bad = count_when(F.col("target") == 0), count_when(F.col("target") == 1)
    return df.agg(good.alias("n_good"), bad.alias("n_bad"), F.try_divide(good, bad).alias("ratio"))


def with_balance(df: DataFrame) -> DataFrame:
    """`weight`: each class gets half of the total weight."""
    n, bad = df.agg(F.count(F.lit(1)), F.sum("target")).first()
    return df.withColumn("weight", F.when(F.col("target") == 1, n / (2.0 * bad)).otherwise(n / (2.0 * (n - bad))))


def stratified_folds(df: DataFrame, k: int = 5, key: str = "sk_id_curr", seed: int = 0, name: str = "fold") -> DataFrame:
    """Fold 0..k-1 per row: hash order within each class, dealt round robin.

    Class counts per fold differ by at most one.
    """
    ranked = rank_within(df, ["target"], id_hash(key, seed), 0, HASH_MODULUS, key, "__rank")
    return ranked.withColumn(name, F.pmod(F.col("__rank"), F.lit(k)).cast("int")).drop("__rank")


def stratified_split(df: DataFrame, parts: int = 5, key: str = "sk_id_curr", seed: int = 0, name: str = "is_calibration") -> DataFrame:
    """1 for (parts - 1)/parts of each class, 0 for the rest."""
    folds = stratified_folds(df, parts, key, seed, "__part")
    return folds.withColumn(name, F.when(F.col("__part") == 0, 0).otherwise(1)).drop("__part")


@dataclass(frozen=True)
class ForestParams:
    trees: int = 300
    depth: int = 10
    seed: int = 42


# The two boosted candidates, one grown by the best leaf, one level by level to a depth.
BY_LEAF = Params(rounds=1000, leaves=31, step=0.05, min_rows=20, patience=30)
BY_DEPTH = Params(rounds=1000, leaves=64, depth=6, step=0.05, min_rows=1, min_weight=1.0, l2=1.0, patience=30)


def _vector(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


class MedianFill(Estimator):
    """Adds each feature with its gaps filled by the exact median of the rows it is fitted on (0 without values)."""

    def __init__(self, features: Sequence[str]):
        super().__init__()
        self.features = list(features)
        self.outputs = [f"{f}__filled" for f in features]

    def _fit(self, dataset: DataFrame) -> Model:
        middle = median(dataset, self.features)
        filled = [f"coalesce(CAST({f} AS DOUBLE), {middle[f] or 0.0!r}D) AS {o}" for f, o in zip(self.features, self.outputs)]
        return SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")


def logistic(features: Sequence[str], max_iter: int = 1000, gaps: bool = True) -> Pipeline:
    """Exact median imputation (where there may be gaps), scaling, class-balanced logistic regression."""
    fill = MedianFill(features) if gaps else None
    return Pipeline(stages=[
        *([fill] if fill else []),
        VectorAssembler(inputCols=fill.outputs if fill else list(features), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
        LogisticRegression(featuresCol="features", labelCol="target", weightCol="weight", maxIter=max_iter, regParam=1e-4),
    ])


def forest(features: Sequence[str], params: ForestParams = ForestParams()) -> Pipeline:
    """Balanced random forest; gaps count as 0 (see `zero_gaps`)."""
    # many nodes to a pass, and rows keep their nodes from pass to pass
    model = RandomForestClassifier(labelCol="target", weightCol="weight", numTrees=params.trees, maxDepth=params.depth, seed=params.seed, maxMemoryInMB=1024, cacheNodeIds=True)
    return Pipeline(stages=[_vector(features), model])


def zero_gaps(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})


@dataclass(frozen=True)
class Fitted:
    """Fold models with the out-of-fold scores of the train rows."""

    models: list[Model] | list[boosting.Model]
    oof: DataFrame


Factory = Callable[[], Estimator]


def out_of_fold(df: DataFrame, factory: Factory, k: int = 5) -> Fitted:
    """Fit k separate models at the same time, each scoring the fold it has not seen. `df` carries fold and weight."""

    def fit(i: int) -> Model:
        return factory().fit(df.filter(F.col("fold") != i))

    with ThreadPoolExecutor(k) as pool:
        models = list(pool.map(inheritable_thread_target(fit), range(k)))
    parts = [positive_probability(df.filter(F.col("fold") == i), m, "pred_prob").select("sk_id_curr", "target", "fold", "pred_prob") for i, m in enumerate(models)]
    return Fitted(models, reduce(DataFrame.union, parts))


def boosted_out_of_fold(df: DataFrame, features: Sequence[str], params: Params = BY_LEAF, k: int = 5, data: boosting.Binned | None = None, known: dict[int, boosting.Model] | None = None) -> Fitted:
    """k boosted models in shared passes; each stops early on the fold it then scores. Gaps stay gaps.

    `known` holds models already fitted on `data`, by the fold they hold out.
    """
    data = data or boosting.quantise(df, features, "target", "weight", "fold")
    known = known or {}
    others = [i for i in range(k) if i not in known]
    found = known | dict(zip(others, boosting.fit_all(data, [(params, i) for i in others])))
    models = [found[i] for i in range(k)]
    names = [f"__m{i}" for i in range(k)]
    scored = boosting.score(df, dict(zip(names, models)), ["sk_id_curr", "target", "fold"])
    return Fitted(models, scored.select("sk_id_curr", "target", "fold", F.get(F.array(*names), F.col("fold")).alias("pred_prob")))


def mean_score(df: DataFrame, models: Sequence[Model] | Sequence[boosting.Model]) -> DataFrame:
    """Mean of the fold models per row, without a shuffle."""
    return raw_ensemble(df, models, "pred_prob")


def leaderboard(oof: dict[str, DataFrame]) -> DataFrame:
    """Metrics per model, best out-of-fold AUC first, with mean and population deviation over folds.

    The out-of-fold scores of each model are written once and read by every metric.
    """
    rows = []
    for name, scores in oof.items():
        scores = materialize(scores, "oof")
        points = evaluate.roc(scores)
        whole = points.agg(
            evaluate._auc().alias("oof_auc"),
            (evaluate._auc() * 2 - 1).alias("gini"),
            (F.max(F.col("tpr") - F.col("fpr")) * 100).alias("ks"),
        )
        folds = evaluate.cv_summary(evaluate.fold_metrics(scores))
        rows.append(
            folds.withColumns({
                "model": F.lit(name),
                **{c: whole.select(c).scalar() for c in ("oof_auc", "gini", "ks")},
                "brier": evaluate.brier(scores).scalar(),
            })
        )
    return reduce(DataFrame.unionByName, rows).orderBy(F.desc("oof_auc"), "model")


def fit_calibrator(oof: DataFrame, score: str = "pred_prob") -> isotonic.Curve:
    """Isotonic regression on the calibration share of the out-of-fold rows."""
    rows = stratified_split(oof).filter(F.col("is_calibration") == 1)
    return isotonic.fit(rows, score, "target")


def calibrate(df: DataFrame, calibrator: isotonic.Curve, score: str = "pred_prob") -> DataFrame:
    """Interpolated between the fitted steps and constant beyond them."""
    return calibrator.apply(df, score, "__curve").withColumn("pd_calibrated", clip("__curve", 0.0, 1.0)).drop("__curve")


def draw(space: SearchSpace, n: int) -> list[Params]:
    """n seeded random settings; steps, penalties and least weights are drawn on a log scale."""
    rng = random.Random(space.seed)

    def log(low: float, high: float) -> float:
        return math.exp(rng.uniform(math.log(low), math.log(high)))

    return [
        Params(
            rounds=rng.randrange(space.trees[0], space.trees[1] + 1, 100), step=log(*space.step), leaves=rng.randint(*space.leaves), depth=rng.randint(*space.depth),
            min_rows=rng.randint(*space.min_rows), subsample=rng.uniform(*space.subsample), columns=rng.uniform(*space.columns), l1=log(*space.l1), l2=log(*space.l2),
            min_gain=rng.uniform(*space.min_gain), min_weight=log(*space.min_weight), seed=space.seed,
        )
        for _ in range(n)
    ]


def tune(df: DataFrame, features: Sequence[str], trials: int = 100, k: int = 3, space: SearchSpace = SearchSpace(), first: int | None = None, most: int = 500, factor: int = 3) -> DataFrame:
    """Random search, best first: per trial its settings, rounds, held-out loss and out-of-fold AUC.

    All trials and folds are fitted over one quantised table, each until its rounds are done or its
    held-out loss stops falling. Only where `first` is given, the best 1/`factor` of the trials go on
    after so many rounds, and so forth. `rounds_run` tells how far a trial came.
    """
    drawn = draw(space, trials)
    data = boosting.quantise(df, features, "target", "weight", "fold")
    wanted = [(params, i) for params in drawn for i in range(k)]
    halving = boosting.Halving([t for t in range(trials) for _ in range(k)], first, most, factor) if first else None
    models = boosting.fit_all(data, wanted, halving)
    by_trial = [models[t * k : (t + 1) * k] for t in range(trials)]
    names = {f"__t{t}_{i}": m for t, part in enumerate(by_trial) for i, m in enumerate(part)}
    scored = boosting.score(df, names, ["target", "fold"])
    own = F.array(*[F.struct(F.lit(t).alias("trial"), F.get(F.array(*[F.col(f"__t{t}_{i}") for i in range(k)]), F.col("fold")).alias("pred_prob")) for t in range(trials)])
    scores = materialize(scored.select("target", F.inline(own)), "trial-scores")
    # the rank sum of the positives per trial, ties counted by half
    points = scores.groupBy("trial", "pred_prob").agg(F.sum("target").alias("pos"), F.sum(1 - F.col("target")).alias("neg"))
    auc = rank_auc(points, ["trial"])
    rows = [
        (t, p.rounds, max(len(m.curve) - 1 for m in part), sum(len(m.trees) for m in part) / k, p.leaves, p.depth, p.step, p.min_rows, p.subsample, p.columns, p.l1, p.l2, p.min_gain, p.min_weight, sum(min(m.curve) for m in part) / k)
        for t, (p, part) in enumerate(zip(drawn, by_trial))
    ]
    schema = ("trial int, rounds int, rounds_run int, trees double, leaves int, depth int, step double, min_rows int, subsample double, columns double, l1 double, l2 double, min_gain double, min_weight double, loss double")
    return df.sparkSession.createDataFrame(rows, schema).join(auc, "trial").orderBy("loss", "trial")


def rank_auc(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Area under the curve per group from (pred_prob, pos, neg) counts per distinct score."""
    totals = running_totals(points, "pred_prob", {"__neg": "neg"}, by=by)
    area = F.sum(F.col("pos") * (F.col("__neg") - F.col("neg") / 2.0))
    return totals.groupBy(*by).agg((area / (F.sum("pos") * F.sum("neg"))).alias("auc"))
