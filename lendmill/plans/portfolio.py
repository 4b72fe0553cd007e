"""Derived frames that several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators import clean, features, losses, rollups
from lendmill.operators.joins import attach_rollups
from lendmill.operators.scoring import fit_tiers, risk_tier
from lendmill.session import materialize
from lendmill.sources.domain import Domain


def base(dom: Domain) -> DataFrame:
    """Applications with the sentinel day removed, ratios and ages."""
    flagged = clean.flag_sentinel(dom.application, "days_employed", "emp_anomaly")
    return features.add_years(features.add_ratios(flagged))


def installments(dom: Domain) -> DataFrame:
    """The instalments written to the shared folder: cleaning reads them once per fit, and each reading would join all lines with their orders."""
    return materialize(dom.installments, "installments")


def feature_table(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns written to the shared folder: fits read them several times."""
    return materialize(rows.select(*columns), "features")


def _of(df: DataFrame, only: DataFrame | None) -> DataFrame:
    """Rows of the listed clients; the list must be bounded (a top-n report)."""
    return df if only is None else df.join(F.broadcast(only), "sk_id_curr", "left_semi")


def bureau_history(dom: Domain, only: DataFrame | None = None) -> DataFrame:
    return rollups.bureau_derived(rollups.bureau_rollup(_of(dom.bureau, only))).select("sk_id_curr", "bureau_bad_debt_flag", "bureau_overdue_mean")


def previous_history(dom: Domain, only: DataFrame | None = None) -> DataFrame:
    return rollups.previous_derived(rollups.previous_rollup(_of(dom.previous, only))).select("sk_id_curr", "prev_refused_ratio")


def installment_history(dom: Domain, only: DataFrame | None = None) -> DataFrame:
    dated = clean.days_past_due(clean.payment_difference(_of(dom.installments, only)))
    return rollups.installments_rollup(dated).select("sk_id_curr", "inst_late_ratio")


def with_history(dom: Domain, only: DataFrame | None = None) -> DataFrame:
    return attach_rollups(_of(base(dom), only), [bureau_history(dom, only), previous_history(dom, only), installment_history(dom, only)])


def portfolio(dom: Domain, only: DataFrame | None = None) -> DataFrame:
    """Applications with stage, severity, exposure and provision."""
    return losses.compute_ecl(with_history(dom, only))


def with_tier(df: DataFrame, dom: Domain) -> DataFrame:
    """Tiers at the 40/65/85 % score quantiles of the train applications."""
    config = fit_tiers(dom.application.filter("is_train = 1").select("pred_prob"))
    return df.withColumn("risk_tier", risk_tier(F.col("pred_prob"), config))


def predictions(dom: Domain, only: DataFrame | None = None) -> DataFrame:
    """The prediction table: probability, tier and provision per client and model version."""
    rows = with_tier(portfolio(dom, only), dom)
    return rows.select(
        "sk_id_curr", F.lit("lgbm_v1").alias("model_version"), F.col("pred_prob").alias("default_probability"), "risk_tier",
        F.col("target").alias("actual_target"), "stage", "ead", "ecl",
    )
