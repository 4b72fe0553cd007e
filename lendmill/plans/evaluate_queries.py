"""Model evaluation and explanation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators import evaluate, explain, losses, pd_model
from lendmill.operators.quantiles import median
from lendmill.plans.portfolio import base, feature_table, with_tier
from lendmill.plans.registry import query
from lendmill.sources.domain import Domain

_ROC = """SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS n_pos, sum(neg) OVER () AS n_neg
  FROM (SELECT pred_prob AS score, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target = 0) AS neg FROM application GROUP BY pred_prob)
  WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def _roc(dom: Domain) -> DataFrame:
    return evaluate.roc(dom.application)


@query("eva_roc", sql=f"SELECT score, tp::BIGINT AS tp, fp::BIGINT AS fp, (tp / n_pos)::DOUBLE AS tpr, (fp / n_neg)::DOUBLE AS fpr FROM ({_ROC})",
       digits={"tpr": 9, "fpr": 9})
def eva_roc(dom: Domain) -> DataFrame:
    return _roc(dom).select("score", "tp", "fp", "tpr", "fpr")


_AUC = "sum(neg * (tp - pos / 2e0)) / (any_value(n_pos) * any_value(n_neg))::DOUBLE"


@query("eva_auc", sql=f"SELECT {_AUC} AS auc FROM ({_ROC})", digits={"auc": 9})
def eva_auc(dom: Domain) -> DataFrame:
    return evaluate.auc(_roc(dom))


@query("eva_gini", sql=f"SELECT 2 * ({_AUC}) - 1 AS gini FROM ({_ROC})", digits={"gini": 9})
def eva_gini(dom: Domain) -> DataFrame:
    return evaluate.gini(_roc(dom))


@query("eva_ks", sql=f"SELECT max(tp / n_pos::DOUBLE - fp / n_neg::DOUBLE) * 100 AS ks FROM ({_ROC})", digits={"ks": 8})
def eva_ks(dom: Domain) -> DataFrame:
    return evaluate.ks(_roc(dom))


@query("eva_brier", sql="SELECT avg((pred_prob - target) * (pred_prob - target)) AS brier FROM application", digits={"brier": 9})
def eva_brier(dom: Domain) -> DataFrame:
    return evaluate.brier(dom.application)


@query("eva_youden", sql=f"""SELECT score AS threshold, ((tp * n_neg - fp * n_pos) / (n_pos * n_neg)::DOUBLE)::DOUBLE AS youden_j FROM ({_ROC})
    ORDER BY tp * n_neg - fp * n_pos DESC, score DESC LIMIT 1""", digits={"youden_j": 9})
def eva_youden(dom: Domain) -> DataFrame:
    return evaluate.youden(_roc(dom))


_CONFUSION = """SELECT count(*) FILTER (WHERE pred_prob < 3e-1 AND target = 0) AS tn, count(*) FILTER (WHERE pred_prob >= 3e-1 AND target = 0) AS fp,
  count(*) FILTER (WHERE pred_prob < 3e-1 AND target = 1) AS fn, count(*) FILTER (WHERE pred_prob >= 3e-1 AND target = 1) AS tp FROM application"""


@query("eva_confusion", sql=_CONFUSION)
def eva_confusion(dom: Domain) -> DataFrame:
    return evaluate.confusion(dom.application, 0.3)


CLASS = ["accuracy", "precision", "recall", "f1", "specificity"]


@query("eva_class_metrics", sql=f"""SELECT (tp + tn) / (tp + fp + fn + tn) AS accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
    2 * tp / (2 * tp + fp + fn) AS f1, tn / (tn + fp) AS specificity FROM ({_CONFUSION})""", digits=dict.fromkeys(CLASS, 9))
def eva_class_metrics(dom: Domain) -> DataFrame:
    return evaluate.class_metrics(evaluate.confusion(dom.application, 0.3))


_HASH = "(sk_id_curr * 48271) % 2147483647"


def folds_sql(source: str) -> str:
    return f"SELECT *, ((row_number() OVER (PARTITION BY target ORDER BY {_HASH}, sk_id_curr) - 1) % 5)::INTEGER AS fold FROM {source}"


FOLDS = folds_sql("application")
_FOLD_ROC = f"""SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY fold) AS p, sum(neg) OVER (PARTITION BY fold) AS n
  FROM (SELECT fold, pred_prob AS score, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target = 0) AS neg FROM ({FOLDS}) GROUP BY fold, pred_prob)
  WINDOW w AS (PARTITION BY fold ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
_FOLD_METRICS = f"""SELECT a.fold, a.auc, (b.tp + b.n - b.fp) / (b.p + b.n)::DOUBLE AS accuracy, b.tp / (b.tp + b.fp)::DOUBLE AS precision, b.tp / b.p::DOUBLE AS recall,
    2 * b.tp / (2 * b.tp + b.fp + b.p - b.tp)::DOUBLE AS f1, (b.n - b.fp) / b.n::DOUBLE AS specificity
  FROM (SELECT fold, sum(neg * (tp - pos / 2e0)) / (any_value(p) * any_value(n))::DOUBLE AS auc FROM ({_FOLD_ROC}) GROUP BY fold) a
  JOIN (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY tp * n - fp * p DESC, score DESC) AS k FROM ({_FOLD_ROC})) b ON b.fold = a.fold AND b.k = 1"""


@query("eva_fold_metrics", sql=_FOLD_METRICS, digits=dict.fromkeys(["auc", *CLASS], 8))
def eva_fold_metrics(dom: Domain) -> DataFrame:
    return evaluate.fold_metrics(pd_model.stratified_folds(dom.application)).drop("threshold")


CV = [f"{m}_{s}" for m in evaluate.CV_METRICS for s in ("mean", "std")]


@query("eva_cv_summary", sql="SELECT " + ", ".join(f"avg({m}) AS {m}_mean, stddev_pop({m}) AS {m}_std" for m in evaluate.CV_METRICS)
       + f" FROM ({_FOLD_METRICS})", digits=dict.fromkeys(CV, 8))
def eva_cv_summary(dom: Domain) -> DataFrame:
    return evaluate.cv_summary(evaluate.fold_metrics(pd_model.stratified_folds(dom.application)))


_LGD_FOLD = f"(({_HASH}) // 7) % 5"


@query("eva_lgd_regression", sql=f"""SELECT fold, avg(abs(a - p)) AS mae, avg((a - p) * (a - p)) AS mse, sqrt(avg((a - p) * (a - p))) AS rmse, 1 - avg((a - p) * (a - p)) / var_pop(a) AS r2
    FROM (SELECT fold, lgd AS a, (sum(lgd) OVER t - sum(lgd) OVER f) / (count(*) OVER t - count(*) OVER f) AS p
      FROM (SELECT *, ({_LGD_FOLD})::INTEGER AS fold FROM valued) WINDOW t AS (PARTITION BY name_contract_type), f AS (PARTITION BY name_contract_type, fold)) GROUP BY fold""",
    digits=dict.fromkeys(["mae", "mse", "rmse", "r2"], 8))
def eva_lgd_regression(dom: Domain) -> DataFrame:
    """Errors per fold of the severity predicted by the mean of the contract type in the other folds."""
    app = dom.application
    fold = F.pmod(F.floor(explain.id_hash() / 7), F.lit(5)).cast("int")
    rows = app.select("name_contract_type", fold.alias("fold"), losses.lgd(app).alias("actual"))
    parts = rows.groupBy("name_contract_type", "fold").agg(F.sum("actual").alias("s"), F.count("actual").alias("n"))
    whole = parts.groupBy("name_contract_type").agg(F.sum("s").alias("all_s"), F.sum("n").alias("all_n"))
    means = parts.join(whole, "name_contract_type").select("name_contract_type", "fold", ((F.col("all_s") - F.col("s")) / (F.col("all_n") - F.col("n"))).alias("predicted"))
    return evaluate.regression_metrics(rows.join(means, ["name_contract_type", "fold"]), "actual", "predicted", by=["fold"])


@query("mod_strat_folds", sql=f"SELECT sk_id_curr, target, fold FROM ({FOLDS})")
def mod_strat_folds(dom: Domain) -> DataFrame:
    return pd_model.stratified_folds(dom.application.select("sk_id_curr", "target"))


@query("mod_strat_split", sql=f"SELECT sk_id_curr, CASE WHEN fold = 0 THEN 0 ELSE 1 END AS is_calibration FROM ({FOLDS})")
def mod_strat_split(dom: Domain) -> DataFrame:
    return pd_model.stratified_split(dom.application.select("sk_id_curr", "target")).select("sk_id_curr", "is_calibration")


@query("mod_class_weight", sql="""SELECT count(*) FILTER (WHERE target = 0) AS n_good, count(*) FILTER (WHERE target = 1) AS n_bad,
    count(*) FILTER (WHERE target = 0) / count(*) FILTER (WHERE target = 1) AS ratio FROM application""", digits={"ratio": 8})
def mod_class_weight(dom: Domain) -> DataFrame:
    return pd_model.class_weight(dom.application)


@query("mod_risk_tier", sql="SELECT sk_id_curr, pred_prob, risk_tier FROM tiered_app")
def mod_risk_tier(dom: Domain) -> DataFrame:
    return with_tier(dom.application.select("sk_id_curr", "pred_prob"), dom)


# ---- explanations ----------------------------------------------------------------------------


@query("xai_sample", sql="SELECT sk_id_curr, amt_credit FROM application ORDER BY ((sk_id_curr + 42) * 48271) % 2147483647, sk_id_curr LIMIT 10000")
def xai_sample(dom: Domain) -> DataFrame:
    return explain.sample_rows(dom.application, 10_000, seed=42).select("sk_id_curr", "amt_credit")


_DEV = ["ext_source_2", "ext_source_3", "credit_income_ratio", "credit_term", "age_years", "amt_credit", "amt_income_total"]


@query("xai_deviation_top3", sql="""
    SELECT sk_id_curr, k::INTEGER AS rank, feature FROM (SELECT sk_id_curr, feature, row_number() OVER (PARTITION BY sk_id_curr ORDER BY d DESC, i) AS k FROM (
      """ + " UNION ALL ".join(
    f"SELECT sk_id_curr, '{f}' AS feature, {i} AS i, abs(({f} - m) / (abs(m) + 1e-9)) AS d FROM base_app, (SELECT median({f}) AS m FROM base_app) WHERE {f} IS NOT NULL AND m <> 0"
    for i, f in enumerate(_DEV)) + ")) WHERE k <= 3")
def xai_deviation_top3(dom: Domain) -> DataFrame:
    rows = feature_table(base(dom), ["sk_id_curr", *_DEV])
    return explain.deviation_top(rows, median(rows, _DEV))
