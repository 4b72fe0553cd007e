"""Report queries over applications and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import cents, count_when

PROFILE_APPLICATION = ("sk_id_curr", "target", "code_gender", "name_income_type", "name_education_type", "occupation_type",
                       "name_contract_type", "amt_credit", "amt_income_total")


def risk_profile(application: DataFrame, features: DataFrame, predictions: DataFrame, version: str) -> DataFrame:
    """Train applications with features and the predictions of one model version."""
    chosen = predictions.filter(F.col("model_version") == version).select("sk_id_curr", "default_probability", "risk_tier")
    picked = features.select("sk_id_curr", "age_years", "credit_income_ratio", "bureau_bad_debt_flag", "prev_refused_ratio")
    return (
        application.filter(F.col("is_train") == 1)
        .select(*PROFILE_APPLICATION, "ext_source_2", "ext_source_3")
        .join(picked, "sk_id_curr", "left")
        .join(chosen, "sk_id_curr", "left")
    )


def default_by_segment(application: DataFrame) -> DataFrame:
    return application.filter(F.col("is_train") == 1).groupBy("name_income_type", "name_education_type", "code_gender").agg(
        F.count(F.lit(1)).alias("applicant_count"),
        F.sum("target").alias("default_count"),
        (F.avg(F.col("target").cast("double")) * 100).alias("default_rate_pct"),
        F.avg("amt_credit").alias("avg_credit_amount"),
        F.avg("amt_income_total").alias("avg_income"),
    )


def predicted_applications(predictions: DataFrame, application: DataFrame) -> DataFrame:
    return predictions.join(application, "sk_id_curr")


def collections_ranking(predictions: DataFrame, n: int = 1000) -> DataFrame:
    """The `n` riskiest high-tier predictions (ties: smaller id first)."""
    risky = predictions.filter((F.col("risk_tier") == "High") & (F.col("default_probability") > 0.48))
    return risky.orderBy(F.desc("default_probability"), "sk_id_curr").limit(n)


def collections_top(predictions: DataFrame, application: DataFrame, n: int = 1000) -> DataFrame:
    """The `n` riskiest high-tier clients with masked contact data (ties: smaller id first).

    The top list is taken before the join, so only its rows look up the application.
    """
    top = collections_ranking(predictions.join(application.select("sk_id_curr"), "sk_id_curr", "left_semi"), n)
    wanted = application.select("sk_id_curr", "code_gender", "name_income_type", "amt_income_total", "amt_credit")
    phone = F.right((F.col("sk_id_curr").cast("bigint") * 1234567).cast("string"), F.lit(8))
    return wanted.join(F.broadcast(top), "sk_id_curr").select(  # n rows
        "sk_id_curr", "code_gender", "name_income_type", "amt_income_total", "amt_credit",
        F.round(F.col("default_probability") * 100, 2).alias("pd_pct"),
        "risk_tier",
        cents(F.col("ecl")).alias("ecl_usd"),
        F.concat(F.lit("09"), phone).alias("phone"),
        F.concat(F.lit("khachhang_"), F.col("sk_id_curr").cast("string"), F.lit("@gmail.com")).alias("email"),
    )


def auto_approve(predictions: DataFrame, application: DataFrame, stamped: bool = True) -> DataFrame:
    """Clients below 15 % PD in the two lowest tiers, safest first."""
    safe = predictions.filter((F.col("default_probability") < 0.15) & F.col("risk_tier").isin("Very Low", "Low"))
    rows = safe.join(application.select("sk_id_curr", "amt_credit", "amt_income_total"), "sk_id_curr")
    out = rows.orderBy("default_probability", "sk_id_curr").select(
        "sk_id_curr", "amt_credit", "amt_income_total",
        F.round(F.col("default_probability") * 100, 2).alias("pd_pct"),
        F.lit("AUTO-APPROVE").alias("decision"),
    )
    return out.withColumn("approved_at", F.current_timestamp()) if stamped else out


def provision_by_stage(portfolio: DataFrame) -> DataFrame:
    return portfolio.filter(F.col("stage").isNotNull()).groupBy("stage").agg(
        F.count("sk_id_curr").alias("n_loans"),
        F.sum("ead").alias("ead"),
        F.sum("ecl").alias("ecl"),
        F.round(F.try_divide(F.sum("ecl"), F.sum("ead")) * 100, 2).alias("coverage_pct"),
    ).orderBy("stage")


def vip_upsell(predictions: DataFrame, application: DataFrame) -> DataFrame:
    """Low-risk clients with high income, highest income first."""
    rich = application.filter(F.col("amt_income_total") > 200000).select("sk_id_curr", "amt_income_total", "name_income_type")
    rows = predictions.filter(F.col("default_probability") < 0.05).join(rich, "sk_id_curr")
    return rows.orderBy(F.desc("amt_income_total"), "sk_id_curr").select(
        "sk_id_curr", "amt_income_total", "name_income_type",
        F.round(F.col("default_probability") * 100, 2).alias("pd_pct"),
        F.lit("Telesale - Mo The Tin Dung").alias("campaign"),
    )


def target_share(application: DataFrame) -> DataFrame:
    counts = application.filter(F.col("is_train") == 1).groupBy("target").agg(F.count(F.lit(1)).alias("cnt"))
    every = F.sum("cnt").over(Window.partitionBy())  # one row per outcome
    return counts.select("target", "cnt", (F.col("cnt") * 100.0 / every).cast("double").alias("pct"))


def unfixed_anomalies(application: DataFrame) -> DataFrame:
    """Rows that still look unemployed but carry no anomaly flag; must be 0."""
    return application.agg(count_when((F.col("days_employed") > 0) & (F.col("emp_anomaly") == 0)).alias("n_unfixed"))
