"""Monitoring queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators import evaluate, monitor
from lendmill.operators.joins import concat_rows
from lendmill.params import ALERTS
from lendmill.plans.evaluate_queries import _AUC, _ROC
from lendmill.plans.portfolio import base, feature_table, portfolio, with_history, with_tier
from lendmill.plans.registry import query
from lendmill.sources.domain import Domain

CSI_FEATURES = ["ext_source_2", "amt_credit", "credit_term", "age_years", "hour_appr_process_start"]


def _shares(feature: str, source: str = "base_app", train: str = "is_train = 1") -> str:
    grid = ", ".join(str(k / 10) for k in range(1, 10))
    return f"""SELECT '{feature}' AS feature, bin, greatest(n1 / sum(n1) OVER (), 1e-6)::DOUBLE AS a, greatest(n0 / sum(n0) OVER (), 1e-6)::DOUBLE AS b FROM (
      SELECT len(list_filter(e, lambda m: m < {feature})) AS bin, count(*) FILTER (WHERE {train}) AS n1, count(*) FILTER (WHERE NOT ({train})) AS n0
      FROM {source}, (SELECT list_distinct(quantile_cont({feature}, [{grid}])) AS e FROM {source} WHERE {train}) WHERE {feature} IS NOT NULL GROUP BY 1)"""


_BAND = "CASE WHEN psi > 25e-2 THEN 'Retrain' WHEN psi > 1e-1 THEN 'Investigate' ELSE 'Stable' END"


def _psi(inner: str) -> str:
    return f"SELECT feature, psi, {_BAND} AS band FROM (SELECT feature, sum((a - b) * ln(a / b)) AS psi FROM ({inner}) GROUP BY feature)"


@query("mon_psi", sql=_psi(_shares("pred_prob")), digits={"psi": 8})
def mon_psi(dom: Domain) -> DataFrame:
    return monitor.stability_index(monitor.drift_shares(dom.application, ["pred_prob"], F.col("is_train") == 1))


@query("mon_csi", sql=_psi(" UNION ALL ".join(_shares(f) for f in CSI_FEATURES)), digits={"psi": 8})
def mon_csi(dom: Domain) -> DataFrame:
    rows = feature_table(base(dom), ["is_train", *CSI_FEATURES])
    return monitor.stability_index(monitor.drift_shares(rows, CSI_FEATURES, F.col("is_train") == 1))


_RELIABILITY = """SELECT len(list_filter([1e-1, 2e-1, 3e-1, 4e-1, 5e-1, 6e-1, 7e-1, 8e-1, 9e-1], lambda m: m < pred_prob))::INTEGER AS bin, count(*) AS n_rows,
  avg(pred_prob) AS mean_score, avg(target) AS event_rate FROM application GROUP BY 1"""


@query("mon_calibration", sql=f"""SELECT *, (SELECT sum(abs(mean_score - event_rate) * n_rows) / sum(n_rows) FROM ({_RELIABILITY})) AS ece FROM ({_RELIABILITY})""",
       digits={"mean_score": 8, "event_rate": 8, "ece": 8})
def mon_calibration(dom: Domain) -> DataFrame:
    table = monitor.reliability(dom.application)
    return table.withColumn("ece", monitor.calibration_error(table).scalar())


@query("mon_avg_precision", sql=f"""SELECT sum(pos / n_pos::DOUBLE * (tp / (tp + fp)::DOUBLE)) AS average_precision FROM ({_ROC})""", digits={"average_precision": 9})
def mon_avg_precision(dom: Domain) -> DataFrame:
    return monitor.average_precision(monitor.precision_recall(dom.application))


@query("mon_precision_recall", sql=f"""SELECT score, tp::BIGINT AS tp, fp::BIGINT AS fp, tp / (tp + fp)::DOUBLE AS precision, tp / n_pos::DOUBLE AS recall FROM ({_ROC})""",
       digits={"precision": 9, "recall": 9})
def mon_precision_recall(dom: Domain) -> DataFrame:
    return monitor.precision_recall(dom.application).select("score", "tp", "fp", "precision", "recall")


MISSED = ["credit_income_ratio", "ext_source_2", "bureau_overdue_mean", "prev_refused_ratio"]


@query("mon_missed_defaults", sql=" UNION ALL ".join(
    f"""SELECT '{f}' AS feature, avg({f}) AS mean_all, avg({f}) FILTER (WHERE target = 1 AND pred_prob < 4806e-4) AS mean_missed,
      avg({f}) FILTER (WHERE target = 1 AND pred_prob < 4806e-4) - avg({f}) AS delta FROM with_history""" for f in MISSED),
    digits=dict.fromkeys(["mean_all", "mean_missed", "delta"], 6))
def mon_missed_defaults(dom: Domain) -> DataFrame:
    return monitor.missed_defaults(with_history(dom), MISSED, 0.4806)


@query("mon_tier_table", sql="""
    SELECT risk_tier, count(*) AS n_loans, avg(target) AS default_rate, avg(pred_prob) AS avg_pd, sum(ecl) AS total_ecl,
      count(*) * 1e2 / (SELECT count(*) FROM tiered) AS share_pct,
      CASE risk_tier WHEN 'Very Low' THEN 'Auto-approve, preferential rate' WHEN 'Low' THEN 'Standard approval'
        WHEN 'Medium' THEN 'Conditional approval + income verification' ELSE 'Manual review / collateral required' END AS policy
    FROM tiered GROUP BY risk_tier""", digits={"default_rate": 8, "avg_pd": 8, "total_ecl": 1, "share_pct": 6})
def mon_tier_table(dom: Domain) -> DataFrame:
    return monitor.tier_table(with_tier(portfolio(dom), dom))


_RULES = """SELECT sk_id_curr, amt_credit, CASE WHEN credit_income_ratio > 5 THEN 1 ELSE 0 END AS credit_ceiling, CASE WHEN bureau_bad_debt_flag = 1 THEN 1 ELSE 0 END AS collateral,
  CASE WHEN prev_refused_ratio > 3e-1 THEN 1 ELSE 0 END AS manual_review, CASE WHEN inst_late_ratio > 1e-1 THEN 1 ELSE 0 END AS early_outreach,
  CASE WHEN age_years >= 20 AND age_years <= 25 THEN 1 ELSE 0 END AS youth_pricing FROM with_history"""
RULES = ["credit_ceiling", "collateral", "manual_review", "early_outreach", "youth_pricing"]


@query("mon_policy_rules", sql=f"""
    SELECT sk_id_curr, {', '.join(RULES)}, amt_credit * CASE WHEN credit_ceiling = 1 THEN 8e-1 ELSE 1e0 END * CASE WHEN collateral = 1 THEN 75e-2 ELSE 1e0 END AS allowed_credit,
      concat_ws(',', {', '.join(f"CASE WHEN {r} = 1 THEN '{r}' END" for r in RULES)}) AS rules FROM ({_RULES})""", digits={"allowed_credit": 4})
def mon_policy_rules(dom: Domain) -> DataFrame:
    flagged = monitor.policy_rules(with_history(dom))
    return flagged.select("sk_id_curr", *RULES, "allowed_credit", F.array_join("rules", ",").alias("rules"))


@query("mon_policy_summary", sql=" UNION ALL ".join(
    f"SELECT '{r}' AS rule, sum({r})::BIGINT AS n_clients, coalesce(sum(amt_credit) FILTER (WHERE {r} = 1), 0) AS amt_credit FROM ({_RULES})" for r in RULES),
    digits={"amt_credit": 2})
def mon_policy_summary(dom: Domain) -> DataFrame:
    return monitor.policy_summary(monitor.policy_rules(with_history(dom)))


_METRICS = f"""SELECT 'psi' AS metric, psi AS value FROM ({_psi(_shares('pred_prob'))})
  UNION ALL SELECT 'csi_max', max(psi) FROM ({_psi(" UNION ALL ".join(_shares(f) for f in CSI_FEATURES))})
  UNION ALL SELECT 'brier', avg((pred_prob - target) * (pred_prob - target)) FROM application
  UNION ALL SELECT 'auc', {_AUC} FROM ({_ROC})"""


@query("mon_alerts", sql=f"""
    SELECT metric, value, action, CASE WHEN action <> 'None' THEN 1 ELSE 0 END AS breached FROM (SELECT metric, value,
      CASE WHEN metric = 'psi' AND value > 25e-2 THEN 'Retrain' WHEN metric = 'psi' AND value > 1e-1 THEN 'Investigate'
        WHEN metric = 'csi_max' AND value > 1e-1 THEN 'Investigate' WHEN metric = 'brier' AND value > 1e-1 THEN 'Recalibrate'
        WHEN metric = 'auc' AND value < 73e-2 THEN 'Retrain' ELSE 'None' END AS action FROM ({_METRICS}))""", digits={"value": 7})
def mon_alerts(dom: Domain) -> DataFrame:
    is_train = F.col("is_train") == 1
    psi = monitor.stability_index(monitor.drift_shares(dom.application, ["pred_prob"], is_train))
    csi = monitor.stability_index(monitor.drift_shares(base(dom), CSI_FEATURES, is_train))
    metrics = concat_rows(
        psi.select(F.lit("psi").alias("metric"), F.col("psi").alias("value")),
        csi.agg(F.max("psi").alias("value")).select(F.lit("csi_max").alias("metric"), "value"),
        evaluate.brier(dom.application).select(F.lit("brier").alias("metric"), F.col("brier").alias("value")),
        evaluate.auc(evaluate.roc(dom.application)).select(F.lit("auc").alias("metric"), F.col("auc").alias("value")),
    )
    return monitor.alerts(metrics, ALERTS)
