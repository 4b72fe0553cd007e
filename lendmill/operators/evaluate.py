"""Classification and regression metrics from score counts, never from sorted raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import count_when
from lendmill.operators.running import running_totals


def score_counts(df: DataFrame, score: str = "pred_prob", label: str = "target", by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score: ties collapse before anything is ordered."""
    return df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*by, F.col(score).alias("score")).agg(
        count_when(F.col(label) == 1).alias("pos"), count_when(F.col(label) == 0).alias("neg")
    )


def roc(df: DataFrame, score: str = "pred_prob", label: str = "target", by: Sequence[str] = ()) -> DataFrame:
    """One ROC point per distinct score, highest first: counts, rates and the point's Youden J.

    `j_exact` is J times (positives x negatives), an integer, so that equal points tie exactly.
    """
    counts = score_counts(df, score, label, by)
    points = running_totals(counts, "score", {"tp": "pos", "fp": "neg"}, by=by, descending=True)
    if by:
        totals = points.groupBy(*by).agg(F.max("tp").alias("n_pos"), F.max("fp").alias("n_neg"))
        points = points.join(F.broadcast(totals), list(by))  # one row per group; the groups are few
    else:
        one = points.agg(F.max("tp").alias("n_pos"), F.max("fp").alias("n_neg"))
        points = points.withColumns({"n_pos": one.select("n_pos").scalar(), "n_neg": one.select("n_neg").scalar()})
    return points.withColumns({
        "tpr": F.try_divide(F.col("tp"), F.col("n_pos")),
        "fpr": F.try_divide(F.col("fp"), F.col("n_neg")),
        "j_exact": F.col("tp") * F.col("n_neg") - F.col("fp") * F.col("n_pos"),
    })


def _auc() -> Column:
    """Trapezoids: each step's negatives times the mean of the positives above and at it."""
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    return F.try_divide(area, F.first("n_pos") * F.first("n_neg"))


def _best_point() -> Column:
    return F.max(F.struct("j_exact", "score", "tp", "fp"))


def auc(points: DataFrame) -> DataFrame:
    return points.agg(_auc().alias("auc"))


def gini(points: DataFrame) -> DataFrame:
    return points.agg((_auc() * 2 - 1).alias("gini"))


def ks(points: DataFrame) -> DataFrame:
    return points.agg((F.max(F.col("tpr") - F.col("fpr")) * 100).alias("ks"))


def youden(points: DataFrame) -> DataFrame:
    """First (highest) threshold with the largest tpr - fpr."""
    best = _best_point()
    n_pos, n_neg = F.first("n_pos"), F.first("n_neg")
    return points.agg(
        best.getField("score").alias("threshold"),
        F.try_divide(best.getField("j_exact"), n_pos * n_neg).alias("youden_j"),
    )


def brier(df: DataFrame, score: str = "pred_prob", label: str = "target") -> DataFrame:
    gap = F.col(score) - F.col(label)
    return df.agg(F.avg(gap * gap).alias("brier"))


def confusion(df: DataFrame, threshold: float, score: str = "pred_prob", label: str = "target") -> DataFrame:
    hit, bad = F.col(score) >= threshold, F.col(label) == 1
    good = F.col(label) == 0
    return df.agg(
        count_when(~hit & good).alias("tn"), count_when(hit & good).alias("fp"),
        count_when(~hit & bad).alias("fn"), count_when(hit & bad).alias("tp"),
    )


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    zero = F.lit(0.0)
    return {
        "accuracy": F.try_divide(tp + tn, tp + fp + fn + tn),
        "precision": F.coalesce(F.try_divide(tp, tp + fp), zero),
        "recall": F.coalesce(F.try_divide(tp, tp + fn), zero),
        "f1": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero),
        "specificity": F.coalesce(F.try_divide(tn, tn + fp), zero),
    }


def class_metrics(confused: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and specificity of a confusion row."""
    return confused.select(*[c.cast("double").alias(n) for n, c in _rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")).items()])


def fold_metrics(df: DataFrame, fold: str = "fold", score: str = "pred_prob", label: str = "target") -> DataFrame:
    """AUC and the class metrics at each fold's own best threshold."""
    points = roc(df, score, label, by=[fold])
    best = _best_point()
    per_fold = points.groupBy(fold).agg(
        _auc().alias("auc"), best.alias("b"), F.first("n_pos").alias("p"), F.first("n_neg").alias("n")
    )
    tp, fp = F.col("b.tp"), F.col("b.fp")
    rates = _rates(tp, fp, F.col("p") - tp, F.col("n") - fp)
    return per_fold.select(fold, F.col("b.score").alias("threshold"), "auc", *[c.cast("double").alias(n) for n, c in rates.items()])


CV_METRICS = ("auc", "accuracy", "precision", "recall", "f1", "specificity")


def cv_summary(per_fold: DataFrame, metrics: Sequence[str] = CV_METRICS, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation over the folds."""
    aggs = [a for m in metrics for a in (F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"))]
    return per_fold.groupBy(*by).agg(*aggs) if by else per_fold.agg(*aggs)


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE and R2 (optionally per group)."""
    gap = F.col(actual) - F.col(predicted)
    spread_of_actual = F.var_pop(actual)
    mse = F.avg(gap * gap)
    aggs = [
        F.avg(F.abs(gap)).alias("mae"), mse.alias("mse"), F.sqrt(mse).alias("rmse"),
        (1 - F.try_divide(mse, spread_of_actual)).alias("r2"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
