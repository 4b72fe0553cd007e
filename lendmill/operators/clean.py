"""Cleaning rules. Data-dependent steps are fitted first and then applied as literals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import clip, count_when, flag, melt, numeric_columns, text_columns
from lendmill.operators.quantiles import exact_quantiles, median
from lendmill.params import SENTINEL_DAYS, ApplicationCleaning

# ---- single rules ---------------------------------------------------------------------------


def sentinel_to_null(df: DataFrame, columns: Sequence[str], sentinel: int = SENTINEL_DAYS) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in columns if c in df.columns})


def flag_sentinel(df: DataFrame, column: str, flag_name: str, sentinel: int = SENTINEL_DAYS) -> DataFrame:
    """0/1 flag for sentinel rows, then sentinel -> null."""
    return sentinel_to_null(df.withColumn(flag_name, flag(F.col(column) == sentinel)), [column], sentinel)


def recode(df: DataFrame, column: str, old: str = "XNA", new: str = "Unknown") -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) == old, new).otherwise(F.col(column)))


def sparse_columns(df: DataFrame, limit: float = 0.40, keep: Sequence[str] = ()) -> list[str]:
    """Columns missing in more than `limit` of the rows, except the kept ones."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if (rates[c] or 0.0) > limit and c not in keep]


def drop_sparse(df: DataFrame, limit: float = 0.40, keep: Sequence[str] = ()) -> DataFrame:
    return df.drop(*sparse_columns(df, limit, keep))


def drop_named(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace nulls by fitted values; a missing fit leaves the column alone."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if v is not None and c in df.columns})


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return fill(df, median(df, columns))


def mode_values(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value per text column, ties to the smallest."""
    counts = melt(df, columns, "string").filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("neg"), "value")).getField("value").alias("mode"))
    found = {r["feature"]: r["mode"] for r in best.collect()}  # one row per column
    return {c: found.get(c) for c in columns}


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return fill(df, mode_values(df, columns))


def impute_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing means none."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns if c in df.columns})


def impute_rest(df: DataFrame) -> DataFrame:
    """Straggler pass: median for numbers, mode for text, 'Unknown' for text without any value."""
    nulls = df.agg(*[count_when(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    gaps = [c for c in df.columns if nulls[c]]
    numbers = [c for c in numeric_columns(df) if c in gaps]
    texts = [c for c in text_columns(df) if c in gaps]
    values: dict[str, object] = dict(median(df, numbers)) if numbers else {}
    if texts:
        values.update({c: v if v is not None else "Unknown" for c, v in mode_values(df, texts).items()})
    return fill(df, values)


def cap_quantile(df: DataFrame, column: str, probability: float = 0.99) -> DataFrame:
    mark = exact_quantiles(df, {column: [probability]})[column][0]
    return df if mark is None else df.withColumn(column, clip(column, high=mark))


def cap_at(df: DataFrame, caps: dict[str, float]) -> DataFrame:
    return df.withColumns({c: clip(c, high=v) for c, v in caps.items() if c in df.columns})


def floor_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Negatives to 0, then missing to 0."""
    return df.withColumns({c: F.coalesce(clip(c, low=0.0), F.lit(0.0)) for c in columns if c in df.columns})


def clip_range(df: DataFrame, columns: Sequence[str], low: float = 0.0, high: float = 1.0) -> DataFrame:
    return df.withColumns({c: clip(c, low, high) for c in columns if c in df.columns})


def zero_to_median(df: DataFrame, column: str) -> DataFrame:
    """0 counts as missing; the median of the rest fills in."""
    holes = df.withColumn(column, F.nullif(F.col(column), F.lit(0)))
    return impute_median(holes, [column])


def payment_difference(df: DataFrame) -> DataFrame:
    return df.withColumn("payment_diff", F.col("amt_instalment") - F.col("amt_payment"))


def days_past_due(df: DataFrame) -> DataFrame:
    """Days from due to paid, early payments count as 0."""
    late = F.col("days_entry_payment").cast("double") - F.col("days_instalment").cast("double")
    return df.withColumn("days_past_due", clip(late, low=0.0))


def utilization(df: DataFrame, cap: float = 2.0) -> DataFrame:
    """Balance over limit where there is a limit, capped, else 0."""
    limit = F.col("amt_credit_limit_actual")
    use = F.when(limit > 0, F.col("amt_balance") / limit)
    return df.withColumn("utilization_ratio", F.coalesce(clip(use, high=cap), F.lit(0.0)))


def remaining_nulls(df: DataFrame) -> DataFrame:
    """Total number of nulls left; a cleaned table must show 0."""
    total = sum((count_when(F.col(c).isNull()) for c in df.columns), F.lit(0).cast("bigint"))
    return df.agg(total.alias("n_null"))


# ---- whole tables ---------------------------------------------------------------------------


def clean_application(df: DataFrame, rules: ApplicationCleaning = ApplicationCleaning()) -> DataFrame:
    """Sentinel, recode, drop sparse, caps, medians and modes in the fixed order.

    The order only matters through the values the fits see, so all fits share two passes:
    one for null shares, one for quantiles (and one for modes when text has gaps).
    """
    df = recode(flag_sentinel(df, "days_employed", "emp_anomaly"), "code_gender")
    df = cap_at(df, rules.caps)
    nulls = df.agg(F.count(F.lit(1)).alias("__n"), *[count_when(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    rows = max(nulls["__n"], 1)
    sparse = [c for c in df.columns if nulls[c] / rows > rules.sparse_limit and c not in rules.keep]
    df = df.drop(*sparse)
    gaps = {c for c in df.columns if nulls[c]}
    numbers = [c for c in numeric_columns(df) if c in gaps]
    texts = [c for c in text_columns(df) if c in gaps]

    wanted: dict[str, list[float]] = {c: [0.5] for c in numbers}
    wanted.setdefault("amt_income_total", []).append(rules.income_quantile)
    marks = exact_quantiles(df, wanted)
    values: dict[str, object] = {c: marks[c][0] for c in numbers}
    if texts:
        values.update(mode_values(df, texts))
    df = fill(df, values)
    return cap_at(df, {"amt_income_total": marks["amt_income_total"][-1]})


def clean_applications(df: DataFrame, rules: ApplicationCleaning = ApplicationCleaning()) -> DataFrame:
    """Train and test rows (`is_train`) cleaned apart, each by its own medians, modes and caps, and put together again."""
    train, test = (clean_application(df.filter(F.col("is_train") == side), rules) for side in (1, 0))
    return train.unionByName(test, allowMissingColumns=True)


def clean_bureau(df: DataFrame) -> DataFrame:
    df = drop_named(df, ["amt_annuity"])
    df = impute_zero(df, ["amt_credit_max_overdue", "days_enddate_fact", "amt_credit_sum_debt", "amt_credit_sum_limit", "amt_credit_sum_overdue"])
    df = cap_at(df, {"credit_day_overdue": 365.0})
    df = df.withColumn("amt_credit_sum", F.nullif(F.col("amt_credit_sum"), F.lit(0)))
    return impute_median(df, ["amt_credit_sum", "days_credit_enddate"])


PREVIOUS_SENTINELS = ("days_first_drawing", "days_first_due", "days_last_due_1st_version", "days_last_due", "days_termination")


def clean_previous(df: DataFrame) -> DataFrame:
    df = drop_named(df, ["rate_interest_primary", "rate_interest_privileged"])
    df = sentinel_to_null(df, PREVIOUS_SENTINELS)
    df = impute_rest(floor_zero(df, ["amt_down_payment"]))
    if "rate_down_payment" in df.columns:
        df = clip_range(impute_zero(df, ["rate_down_payment"]), ["rate_down_payment"])
    return df


def clean_installments(df: DataFrame) -> DataFrame:
    return days_past_due(payment_difference(impute_median(df, ["days_entry_payment", "amt_payment"])))


def clean_pos(df: DataFrame) -> DataFrame:
    df = cap_at(df, {"sk_dpd": 365.0, "sk_dpd_def": 365.0})
    return recode(impute_median(df, ["cnt_instalment", "cnt_instalment_future"]), "name_contract_status")


CARD_ZERO = (
    "amt_drawings_atm_current", "amt_drawings_current", "amt_drawings_other_current", "amt_drawings_pos_current",
    "cnt_drawings_atm_current", "cnt_drawings_other_current", "cnt_drawings_pos_current", "amt_payment_current",
    "amt_inst_min_regularity", "cnt_instalment_mature_cum",
)


def clean_card(df: DataFrame) -> DataFrame:
    df = cap_at(impute_zero(df, CARD_ZERO), {"sk_dpd": 365.0, "sk_dpd_def": 365.0})
    return utilization(df)
