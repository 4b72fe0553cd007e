"""Bulk scoring: validation, imputation, ratios, tiers, recommendation, loss estimate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import cents, clip, has, lookup, ratio, step
from lendmill.operators import boosting
from lendmill.operators.isotonic import Curve
from lendmill.operators.quantiles import exact_quantiles
from lendmill.params import (
    FALLBACK_TIER_EDGES,
    RECOMMENDATIONS,
    SCORING_RANGES,
    TIER_LABELS,
    TIER_QUANTILES,
    FieldRange,
    TierConfig,
)

FLAT_LGD = 0.65
AUTO_RATIOS = {
    "credit_income_ratio": ("amt_credit", "amt_income_total"),
    "annuity_income_ratio": ("amt_annuity", "amt_income_total"),
    "credit_term": ("amt_credit", "amt_annuity"),
}


def reject_reasons(df: DataFrame, ranges: dict[str, FieldRange] = SCORING_RANGES) -> Column:
    """Names of the fields outside their range; missing fields are fine."""
    reasons = []
    for name, limits in ranges.items():
        if not has(df, name):
            continue
        c, broken = F.col(name), F.lit(False)
        if limits.low is not None:
            broken = broken | ((c <= limits.low) if limits.low_open else (c < limits.low))
        if limits.high is not None:
            broken = broken | (c > limits.high)
        reasons.append(F.when(broken, F.lit(name)))
    return F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")


def validate(df: DataFrame, ranges: dict[str, FieldRange] = SCORING_RANGES) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with `reasons`)."""
    checked = df.withColumn("reasons", reject_reasons(df, ranges))
    return checked.filter(F.size("reasons") == 0).drop("reasons"), checked.filter(F.size("reasons") > 0)


def impute_inputs(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Absent features and gaps take the training median (0 when there is none)."""
    out = {}
    for name, value in medians.items():
        default = F.lit(float(value) if value is not None else 0.0)
        out[name] = F.coalesce(F.col(name).cast("double"), default) if has(df, name) else default
    return df.withColumns(out)


def auto_ratios(df: DataFrame) -> DataFrame:
    """Ratios from the given amounts where the caller gave both amounts and no ratio."""
    out = {}
    for name, (top, bottom) in AUTO_RATIOS.items():
        if not (has(df, top) and has(df, bottom)):
            continue
        given = F.col(top).isNotNull() & F.col(bottom).isNotNull() & (F.col(top) != 0) & (F.col(bottom) != 0)
        derived = F.when(given, ratio(top, bottom))
        out[name] = F.coalesce(F.col(name).cast("double"), derived) if has(df, name) else derived
    return df.withColumns(out) if out else df


def fit_tiers(df: DataFrame, column: str = "pred_prob", quantiles: Sequence[float] = TIER_QUANTILES, **extra) -> TierConfig:
    """Tier edges at the 40/65/85 % quantiles of the scores."""
    marks = exact_quantiles(df, {column: list(quantiles)})[column]
    return TierConfig((0.0, *marks, 1.0), TIER_LABELS, **extra)


def risk_tier(p: Column, config: TierConfig) -> Column:
    """Portfolio tier: right-closed bins, lowest edge included, null outside."""
    inside = step(p, config.edges, [None, *config.labels, None])
    return F.when(p == F.lit(config.edges[0]), config.labels[0]).otherwise(inside)


def assign_tier(p: Column, edges: Sequence[float] = FALLBACK_TIER_EDGES, labels: Sequence[str] = TIER_LABELS) -> Column:
    """Scoring tier: the first closed interval that holds the PD, else the last tier."""
    return F.coalesce(risk_tier(p, TierConfig(tuple(edges), tuple(labels))), F.lit("High"))


def recommendation(tier: Column) -> Column:
    return lookup(tier, RECOMMENDATIONS, "REVIEW")


def ecl_estimate(p: Column, credit: Column) -> Column:
    return cents(p * FLAT_LGD * F.coalesce(credit.cast("double"), F.lit(0.0)), half_even=True)


def top_factors(df: DataFrame, medians: dict[str, float | None], n: int = 3) -> Column:
    """The n features furthest from their median, relative to it; ties keep feature order.

    Sorted inside the row: no shuffle, whatever the number of features.
    """
    entries = [
        F.when(
            F.col(name).isNotNull(),
            F.struct((-F.abs((F.col(name).cast("double") - m) / (abs(m) + 1e-9))).alias("d"), F.lit(i).alias("i"), F.lit(name).alias("name")),
        )
        for i, (name, m) in enumerate(medians.items())
        if m and has(df, name)
    ]
    if not entries:
        return F.array().cast("array<string>")
    return F.slice(F.sort_array(F.array_compact(F.array(*entries))), 1, n).getField("name")


def positive_probability(df: DataFrame, model: Model, name: str) -> DataFrame:
    scored = model.transform(df)
    extra = [c for c in scored.columns if c not in df.columns]
    return scored.withColumn(name, F.get(vector_to_array("probability"), 1)).drop(*extra)


def raw_ensemble(df: DataFrame, models: Sequence[Model] | Sequence[boosting.Model], name: str = "pd_raw") -> DataFrame:
    """Add the mean of the fold models, in one pass."""
    names = [f"__p{i}" for i in range(len(models))]
    if isinstance(models[0], boosting.Model):
        out = boosting.score(df, dict(zip(names, models)), df.columns)
    else:
        out = df
        for column, model in zip(names, models):
            out = positive_probability(out, model, column)
    return out.withColumn(name, sum((F.col(n) for n in names), F.lit(0.0)) / len(names)).drop(*names)


def ensemble(df: DataFrame, models: Sequence[Model] | Sequence[boosting.Model], calibrator: Curve | None = None) -> DataFrame:
    """`pd_raw`, the mean of the fold models, and `pd_calibrated` in [0.001, 0.999]."""
    out = raw_ensemble(df, models)
    if calibrator is None:
        return out.withColumn("pd_calibrated", F.col("pd_raw"))
    return calibrator.apply(out, "pd_raw", "__curve").withColumn("pd_calibrated", clip("__curve", 0.001, 0.999)).drop("__curve")


def score_columns(p: Column, credit: Column, edges: Sequence[float], valid: Column, reasons: Column) -> dict[str, Column]:
    """Tier, loss estimate and recommendation; an invalid row gets the 'Unknown' answer."""
    tier = assign_tier(p, edges)
    return {
        "pd_calibrated": F.when(valid, F.bround(p, 6)).otherwise(0.0),
        "risk_tier": F.when(valid, tier).otherwise("Unknown"),
        "ecl_estimate": F.when(valid, ecl_estimate(p, credit)).otherwise(0.0),
        "recommendation": F.when(valid, recommendation(tier)).otherwise(F.concat(F.lit("ERROR: "), F.array_join(reasons, ", "))),
    }


def score_batch(
    df: DataFrame,
    models: Sequence[Model],
    calibrator: Curve | None,
    medians: dict[str, float | None],
    edges: Sequence[float] = FALLBACK_TIER_EDGES,
) -> DataFrame:
    """Score every row in one plan; rows that fail validation come back marked, not dropped."""
    checked = df.withColumns({"reasons": reject_reasons(df), "__credit": F.col("amt_credit")})
    ready = impute_inputs(auto_ratios(checked), medians)
    scored = ensemble(ready, models, calibrator)
    valid = F.size("reasons") == 0
    answers = score_columns(F.col("pd_calibrated"), F.col("__credit"), edges, valid, F.col("reasons"))
    return scored.select(
        "sk_id_curr",
        F.when(valid, F.bround("pd_raw", 6)).otherwise(0.0).alias("pd_raw"),
        *[c.alias(n) for n, c in answers.items()],
        F.when(valid, top_factors(scored, medians)).otherwise(F.array().cast("array<string>")).alias("top_risk_factors"),
    )
