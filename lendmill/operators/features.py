"""Feature projections: ratios, ages, composites. All are narrow expressions, no shuffle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import clip, col_or, flag, has, ratio, row_sum
from lendmill.operators.quantiles import exact_quantiles


def add_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "credit_income_ratio": ratio("amt_credit", "amt_income_total"),
        "annuity_income_ratio": ratio("amt_annuity", "amt_income_total"),
        "credit_term": ratio("amt_credit", "amt_annuity"),
        "goods_credit_ratio": ratio("amt_goods_price", "amt_credit"),
        "credit_downpayment": F.col("amt_goods_price") - F.col("amt_credit"),
    })


def add_years(df: DataFrame) -> DataFrame:
    """Day counts as positive years, and the employed share of life."""

    def years(c):
        return -F.col(c).cast("double") / F.lit(365.0)

    return df.withColumns({
        "age_years": years("days_birth"),
        "years_employed": years("days_employed"),
        "days_employed_ratio": ratio("days_employed", "days_birth"),
        "years_id_publish": years("days_id_publish"),
        "years_last_phone_change": years("days_last_phone_change"),
    })


def document_flags(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "flag_document" in c.lower()]


def add_doc_sum(df: DataFrame) -> DataFrame:
    return df.withColumn("flag_docs_sum", row_sum(document_flags(df)))


def add_child_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn("cnt_children_ratio", F.col("cnt_children") / clip("cnt_fam_members", low=1))


def add_interactions(df: DataFrame) -> DataFrame:
    lti = F.col("credit_income_ratio")
    docs = row_sum(document_flags(df)) if document_flags(df) else col_or(df, "flag_docs_sum", 0)
    return df.withColumns({
        "stress_age_x_credit": F.col("age_years") * lti,
        "stress_emp_x_annuity": clip("years_employed", low=0.0) * F.col("annuity_income_ratio"),
        "flag_docs_sum": docs,
        "stress_docs_x_credit": docs * lti,
    })


def add_bureau_quality(df: DataFrame) -> DataFrame:
    """0.40/0.35/0.25 blend of overdue, refusal and lateness, each inverted on [0, 1]."""
    if has(df, "bureau_overdue_mean"):
        floored = df.withColumn("__overdue", clip("bureau_overdue_mean", low=0.0))
        p99 = exact_quantiles(floored, {"__overdue": [0.99]})["__overdue"][0] or 0.0
        overdue = clip(clip("bureau_overdue_mean", low=0.0) / F.lit(p99 + 1e-6), 0.0, 1.0)
    else:
        overdue = F.lit(0.0)
    refused = clip(col_or(df, "prev_refused_ratio", 0.0), 0.0, 1.0)
    late = clip(col_or(df, "inst_late_ratio", 0.0), 0.0, 1.0)
    return df.withColumn("bureau_quality_composite", (1 - overdue) * 0.40 + (1 - refused) * 0.35 + (1 - late) * 0.25)


def add_clean_high_lti(df: DataFrame) -> DataFrame:
    """Clean bureau record but credit above five times income."""
    clean = col_or(df, "bureau_bad_debt_flag", 0) == 0
    return df.withColumn("clean_bureau_high_lti", flag(clean & (F.col("credit_income_ratio") > 5.0)))


def add_ext_composites(df: DataFrame) -> DataFrame:
    """Mean, minimum, product and sample deviation of the external scores, skipping nulls."""
    cols = [F.col(c).cast("double") for c in ("ext_source_1", "ext_source_2", "ext_source_3") if has(df, c)]
    if len(cols) < 2:
        return df
    n = sum((flag(c.isNotNull()) for c in cols), F.lit(0))
    mean = F.when(n > 0, row_sum(cols) / n)
    squares = row_sum([(c - mean) * (c - mean) for c in cols])
    product = F.lit(1.0)
    for c in cols:
        product = product * F.coalesce(c, F.lit(1.0))
    return df.withColumns({
        "ext_source_mean": mean,
        "ext_source_min": F.least(*cols),
        "ext_source_product": product,
        "ext_source_std": F.when(n > 1, F.sqrt(squares / (n - 1))).otherwise(0.0),
    })


def sanitize_names(df: DataFrame) -> DataFrame:
    """Every run of other characters in a column name becomes one underscore."""
    return df.toDF(*[re.sub(r"[^A-Za-z0-9_]+", "_", c) for c in df.columns])


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """Tag and stack; the test side has no target."""
    tagged = train.withColumn("is_train", F.lit(1))
    other = test.drop("target").withColumn("is_train", F.lit(0))
    return tagged.unionByName(other, allowMissingColumns=True)


def split_train_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    train = df.filter(F.col("is_train") == 1).drop("is_train")
    return train, df.filter(F.col("is_train") == 0).drop("is_train", "target")


def split_summary(df: DataFrame) -> DataFrame:
    """Row counts and missing targets per side, the checks made after splitting."""
    side = F.when(F.col("is_train") == 1, "train").otherwise("test")
    return df.groupBy(side.alias("side")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("target").isNull()).alias("n_missing_target"),
    )


def application_features(df: DataFrame) -> DataFrame:
    """All application-level features in one projection chain."""
    return add_child_ratio(add_doc_sum(add_years(add_ratios(df))))
