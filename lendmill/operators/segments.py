"""Segment data sets behind the portfolio dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import clip, col_or, count_when, cut, has, share_when
from lendmill.operators.losses import stage_dashboard
from lendmill.operators.scenario import month_key
from lendmill.params import (
    CREDIT_BINS,
    DTI_BINS,
    FAMILY_CHOICES,
    LTI_BINS,
    PD_BANDS,
    REFERENCE_DATE,
    TERM_BINS,
    TERM_CHOICES,
    Bins,
    SegmentFilter,
)


def bin_of(c: Column, bins: Bins) -> Column:
    return cut(c, bins.edges, bins.labels, bins.include_lowest)


def term_bin() -> Column:
    return bin_of(F.rint(F.col("amt_credit") / clip("amt_annuity", low=1.0)), TERM_BINS)


def lti_bin(df: DataFrame) -> Column:
    lti = F.col("credit_income_ratio") if has(df, "credit_income_ratio") else F.col("amt_credit") / clip("amt_income_total", low=1.0)
    return bin_of(lti, LTI_BINS)


def dti_bin(df: DataFrame) -> Column:
    dti = F.col("annuity_income_ratio") if has(df, "annuity_income_ratio") else F.col("amt_annuity") / clip("amt_income_total", low=1.0)
    return bin_of(dti, DTI_BINS)


def credit_bin() -> Column:
    return bin_of(F.col("amt_credit"), CREDIT_BINS)


def pd_band() -> Column:
    return bin_of(F.col("pred_prob"), PD_BANDS)


def disbursement_month(df: DataFrame) -> Column:
    if has(df, "disbursement_month"):
        return F.col("disbursement_month")
    if not has(df, "days_id_publish"):
        return F.lit("2015-06")
    days = clip(F.abs(F.coalesce(F.col("days_id_publish"), F.lit(-365))), 0, 1095)
    return month_key(F.date_sub(F.lit(REFERENCE_DATE).cast("date"), days.cast("int")))


def with_fallbacks(df: DataFrame) -> DataFrame:
    """Default segment columns, and a flat-LGD provision, where the table lacks them."""
    return df.withColumns({
        "name_family_status": col_or(df, "name_family_status", "Unknown"),
        "region_rating_client_w_city": col_or(df, "region_rating_client_w_city", 0),
        "code_gender": col_or(df, "code_gender", "Unknown"),
        "name_income_type": col_or(df, "name_income_type", "Unknown"),
        "ecl": F.col("ecl") if has(df, "ecl") else F.col("pred_prob") * 0.45 * F.col("amt_credit"),
        "stage": F.col("stage") if has(df, "stage") else stage_dashboard(F.col("pred_prob")),
    })


def segment_frame(df: DataFrame) -> DataFrame:
    """Every derived segment column."""
    return with_fallbacks(df).withColumns({
        "term_bin": term_bin(), "lti_bin": lti_bin(df), "dti_bin": dti_bin(df), "credit_bin": credit_bin(),
        "pd_band": pd_band(), "disbursement_month": disbursement_month(df),
    })


def apply_filter(df: DataFrame, chosen: SegmentFilter) -> DataFrame:
    """Family, region, tier and term choices; an empty choice keeps everything."""
    if chosen.family:
        statuses = [s for choice in chosen.family for s in FAMILY_CHOICES.get(choice, ())]
        df = df.filter(F.col("name_family_status").isin(statuses)) if statuses else df
    if chosen.region is not None:
        df = df.filter(F.col("region_rating_client_w_city") == chosen.region)
    if chosen.tiers:
        df = df.filter(F.col("risk_tier").isin(*chosen.tiers))
    if chosen.terms:
        df = df.filter(F.col("term_bin").isin(*[TERM_CHOICES[t] for t in chosen.terms]))
    return df


def _kpi_columns(keep: Column | None = None) -> dict[str, Column]:
    """The headline figures; with `keep`, over the rows it selects."""

    def only(c: Column) -> Column:
        return c if keep is None else F.when(keep, c)

    high = F.col("risk_tier") == "High"
    exposure, provision = F.sum(only(F.col("amt_credit"))), F.sum(only(F.col("ecl")))
    return {
        "n_male": F.count_if(F.coalesce(only(F.col("code_gender") == "M"), F.lit(False))),
        "n_female": F.count_if(F.coalesce(only(F.col("code_gender") == "F"), F.lit(False))),
        "exposure": exposure,
        "ecl": provision,
        "default_rate": F.avg(only(F.col("target"))),
        "high_risk_share": F.avg(only(F.when(high, 1.0).otherwise(0.0))),
        "high_risk_ecl": F.coalesce(F.sum(only(F.when(high, F.col("ecl")))), F.lit(0.0)),
        "coverage": F.coalesce(F.try_divide(provision, exposure), F.lit(0.0)),
    }


def kpis(df: DataFrame) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in _kpi_columns().items()])


def kpi_delta(df: DataFrame, keep: Column) -> DataFrame:
    """Selected minus all, per figure, from one pass over the table."""
    chosen, everyone = _kpi_columns(keep), _kpi_columns()
    one = df.agg(*[c.alias(f"s_{n}") for n, c in chosen.items()], *[c.alias(f"a_{n}") for n, c in everyone.items()])
    return one.select(*[(F.col(f"s_{n}") - F.col(f"a_{n}")).alias(f"{n}_delta") for n in chosen])


def default_counts(df: DataFrame, key: str) -> DataFrame:
    """Defaults per segment (income type, term bin, ...)."""
    rows = df.filter((F.col("target") == 1) & F.col(key).isNotNull())
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_defaults"))


def by_segment(df: DataFrame, key: str) -> DataFrame:
    """Exposure, default rate and provision per segment."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum("amt_credit").alias("exposure"), F.avg("target").alias("default_rate"), F.sum("ecl").alias("ecl")
    )


def monthly_vintage(df: DataFrame) -> DataFrame:
    return df.groupBy("disbursement_month").agg(
        F.avg("target").alias("default_rate"), F.count("target").alias("n_loans")
    ).orderBy("disbursement_month")


def trend(monthly: DataFrame) -> DataFrame:
    """Least-squares line of the default rate over the period number (0, 1, 2, ...)."""
    numbered = monthly.withColumn("x", F.row_number().over(Window.orderBy("disbursement_month")) - 1)  # one row per month
    fit = numbered.agg(F.regr_slope("default_rate", "x").alias("slope"), F.regr_intercept("default_rate", "x").alias("intercept"))
    return fit.withColumn("n_periods", monthly.agg(F.count(F.lit(1))).scalar())


def pd_histogram(df: DataFrame) -> DataFrame:
    return df.filter(F.col("pd_band").isNotNull()).groupBy("pd_band").agg(
        F.count("pred_prob").alias("n_loans"), F.avg("target").alias("default_rate")
    )


def ecl_by_dti(df: DataFrame) -> DataFrame:
    return df.filter(F.col("dti_bin").isNotNull()).groupBy("dti_bin").agg(
        (F.sum("ecl") / 1e6).alias("ecl_m"), F.avg("target").alias("default_rate")
    )


def stage_cards(df: DataFrame) -> DataFrame:
    exposure, provision = F.sum("amt_credit"), F.sum("ecl")
    return df.groupBy("stage").agg(
        F.count("amt_credit").alias("n_loans"), exposure.alias("ead"), provision.alias("ecl"),
        F.coalesce(F.try_divide(provision, exposure), F.lit(0.0)).alias("coverage"),
    )


def by_region(df: DataFrame) -> DataFrame:
    rows = by_segment(df, "region_rating_client_w_city")
    return rows.withColumn("label", F.concat(F.lit("Region Rating "), F.col("region_rating_client_w_city").cast("string")))


def insights(df: DataFrame) -> DataFrame:
    """High-tier share of the provision, worst LTI bin, income type with the most defaults.

    One grouped pass over (LTI bin, income type) feeds all three.
    """
    high = F.col("risk_tier") == "High"
    cells = df.groupBy("lti_bin", "name_income_type").agg(
        F.count("target").alias("n"), F.sum("target").alias("bad"), F.sum("ecl").alias("ecl"),
        F.coalesce(F.sum(F.when(high, F.col("ecl"))), F.lit(0.0)).alias("high_ecl"),
    )
    lti = cells.filter(F.col("lti_bin").isNotNull()).groupBy("lti_bin").agg((F.sum("bad") / F.sum("n")).alias("rate"))
    position = F.coalesce(*[F.when(F.col("lti_bin") == label, i) for i, label in enumerate(LTI_BINS.labels)])
    worst = lti.agg(F.max(F.struct("rate", (-position).alias("p"), "lti_bin")).getField("lti_bin")).scalar()
    income = cells.groupBy("name_income_type").agg(F.sum("bad").alias("bad")).filter("bad > 0")
    top = income.agg(F.min(F.struct((-F.col("bad")).alias("b"), "name_income_type")).getField("name_income_type")).scalar()
    share = F.coalesce(F.try_divide(F.sum("high_ecl"), F.sum("ecl")), F.lit(0.0))
    return cells.agg(share.alias("high_ecl_share")).withColumns({"worst_lti_bin": worst, "top_default_income": top})


def share_over(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(count_when(condition).alias("n_rows"), share_when(condition).alias("share"))
