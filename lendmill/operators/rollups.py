"""Child tables to one row per client.

Every aggregate is algebraic, so Spark combines on the map side and a client with very many
rows costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import count_when, flag, ratio

KEY = "sk_id_curr"


def _equals(column: str, value: str) -> Column:
    return count_when(F.col(column) == value)


def _rollup(df: DataFrame, aggregates: dict[str, Column]) -> DataFrame:
    return df.filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(*[c.alias(n) for n, c in aggregates.items()])


def _shares(df: DataFrame, shares: dict[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns({name: ratio(top, bottom) for name, (top, bottom) in shares.items()})


def bureau_rollup(df: DataFrame) -> DataFrame:
    return _rollup(df, {
        "bureau_loan_count": F.count("sk_id_bureau"),
        "bureau_active_count": _equals("credit_active", "Active"),
        "bureau_closed_count": _equals("credit_active", "Closed"),
        "bureau_credit_sum": F.sum("amt_credit_sum"),
        "bureau_credit_mean": F.avg("amt_credit_sum"),
        "bureau_credit_max": F.max("amt_credit_sum"),
        "bureau_debt_sum": F.coalesce(F.sum("amt_credit_sum_debt"), F.lit(0.0)),
        "bureau_overdue_mean": F.avg("amt_credit_sum_overdue"),
        "bureau_overdue_max": F.max("amt_credit_sum_overdue"),
        "bureau_days_credit_mean": F.avg("days_credit"),
        "bureau_days_enddate_max": F.max("days_credit_enddate"),
        "bureau_bad_debt_count": count_when(F.col("credit_day_overdue") > 0),
        "bureau_overdue_days_max": F.max("credit_day_overdue"),
        "bureau_prolong_sum": F.sum("cnt_credit_prolong"),
    })


def bureau_derived(rollup: DataFrame) -> DataFrame:
    flagged = rollup.withColumn("bureau_bad_debt_flag", flag(F.col("bureau_bad_debt_count") > 0))
    return _shares(flagged, {
        "bureau_active_ratio": ("bureau_active_count", "bureau_loan_count"),
        "bureau_debt_credit_ratio": ("bureau_debt_sum", "bureau_credit_sum"),
    })


def previous_rollup(df: DataFrame) -> DataFrame:
    return _rollup(df, {
        "prev_app_count": F.count("sk_id_prev"),
        "prev_approved_count": _equals("name_contract_status", "Approved"),
        "prev_refused_count": _equals("name_contract_status", "Refused"),
        "prev_canceled_count": _equals("name_contract_status", "Canceled"),
        "prev_credit_mean": F.avg("amt_credit"),
        "prev_credit_max": F.max("amt_credit"),
        "prev_annuity_mean": F.avg("amt_annuity"),
        "prev_down_payment_mean": F.avg("amt_down_payment"),
        "prev_days_decision_mean": F.avg("days_decision"),
        "prev_consumer_count": _equals("name_contract_type", "Consumer loans"),
        "prev_cash_count": _equals("name_contract_type", "Cash loans"),
        "prev_revolving_count": _equals("name_contract_type", "Revolving loans"),
    })


def previous_derived(rollup: DataFrame) -> DataFrame:
    return _shares(rollup, {
        f"prev_{s}_ratio": (f"prev_{s}_count", "prev_app_count") for s in ("refused", "approved", "canceled", "consumer")
    })


def installments_rollup(df: DataFrame) -> DataFrame:
    """Needs `payment_diff` and `days_past_due` from the cleaner."""
    rolled = _rollup(df, {
        "inst_payment_diff_mean": F.avg("payment_diff"),
        "inst_payment_diff_max": F.max("payment_diff"),
        "inst_payment_diff_sum": F.sum("payment_diff"),
        "inst_days_past_due_mean": F.avg("days_past_due"),
        "inst_days_past_due_max": F.max("days_past_due"),
        "inst_late_payment_count": count_when(F.col("days_past_due") > 0),
        "inst_on_time_count": count_when(F.col("days_past_due") == 0),
        "inst_total_count": F.count("days_past_due"),
        "inst_amt_payment_mean": F.avg("amt_payment"),
        "inst_amt_instalment_mean": F.avg("amt_instalment"),
    })
    return _shares(rolled, {"inst_late_ratio": ("inst_late_payment_count", "inst_total_count")})


def pos_rollup(df: DataFrame) -> DataFrame:
    rolled = _rollup(df, {
        "pos_dpd_mean": F.avg("sk_dpd"),
        "pos_dpd_max": F.max("sk_dpd"),
        "pos_dpd_def_mean": F.avg("sk_dpd_def"),
        "pos_dpd_def_max": F.max("sk_dpd_def"),
        "pos_months_count": F.count("months_balance"),
        "pos_cnt_instalment_mean": F.avg("cnt_instalment"),
        "pos_active_count": _equals("name_contract_status", "Active"),
        "pos_completed_count": _equals("name_contract_status", "Completed"),
        "pos_late_count": count_when(F.col("sk_dpd") > 0),
    })
    return _shares(rolled, {
        "pos_completed_ratio": ("pos_completed_count", "pos_months_count"),
        "pos_late_ratio": ("pos_late_count", "pos_months_count"),
    })


def card_rollup(df: DataFrame) -> DataFrame:
    """Needs `utilization_ratio` from the cleaner."""
    rolled = _rollup(df, {
        "cc_balance_mean": F.avg("amt_balance"),
        "cc_balance_max": F.max("amt_balance"),
        "cc_limit_mean": F.avg("amt_credit_limit_actual"),
        "cc_limit_max": F.max("amt_credit_limit_actual"),
        "cc_utilization_mean": F.avg("utilization_ratio"),
        "cc_utilization_max": F.max("utilization_ratio"),
        "cc_dpd_mean": F.avg("sk_dpd"),
        "cc_dpd_max": F.max("sk_dpd"),
        "cc_dpd_def_mean": F.avg("sk_dpd_def"),
        "cc_months_count": F.count("months_balance"),
        "cc_drawings_mean": F.avg("amt_drawings_current"),
        "cc_drawings_max": F.max("amt_drawings_current"),
        "cc_payment_mean": F.avg("amt_payment_current"),
        "cc_late_count": count_when(F.col("sk_dpd") > 0),
    })
    return _shares(rolled, {"cc_late_ratio": ("cc_late_count", "cc_months_count")})


def rollup_columns(rollups: Sequence[DataFrame]) -> list[str]:
    return [c for r in rollups for c in r.columns if c != KEY]
