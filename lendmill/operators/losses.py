"""Loss severity, exposure, impairment stages and expected credit loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import clip, col_or, has, lookup, numeric_or, spread
from lendmill.operators.quantiles import median
from lendmill.params import (
    CCF_BY_CONTRACT,
    CCF_DEFAULT,
    LGD_BY_CONTRACT,
    LGD_DEFAULT,
    LGD_SHIFTS,
    MACRO_SCENARIOS,
    STAGE_RULE,
    UNDRAWN_SHARE,
    Scenario,
    StageRule,
)

UNKNOWN_CONTRACT = "_default"


def contract_type(df: DataFrame) -> Column:
    """Contract type from the text column, else from 0/1 columns (the last one set wins)."""
    if has(df, "name_contract_type"):
        return F.coalesce(F.col("name_contract_type"), F.lit(UNKNOWN_CONTRACT))
    flags = [
        F.when(F.col(name) == 1, kind)
        for kind in reversed(["Cash loans", "Revolving loans", "Consumer loans"])
        if has(df, name := f"name_contract_type_{kind.replace(' ', '_')}")
    ]
    return F.coalesce(*flags, F.lit(UNKNOWN_CONTRACT))


def lgd(df: DataFrame) -> Column:
    """Loss given default by contract type and collateral, less the down-payment relief.

    An existing `lgd` column is taken instead, limited to the same range.
    """
    if has(df, "lgd"):
        return clip(F.coalesce(numeric_or(df, "lgd", None), F.lit(LGD_DEFAULT)), 0.20, 0.95)
    kind = contract_type(df)
    credit = clip(F.coalesce(col_or(df, "amt_credit", 1.0), F.lit(1.0)), low=1.0)
    goods = F.coalesce(col_or(df, "amt_goods_price", 0.0), F.lit(0.0))
    with_collateral = lookup(kind, {k: v[0] for k, v in LGD_BY_CONTRACT.items()}, LGD_DEFAULT)
    without = lookup(kind, {k: v[1] for k, v in LGD_BY_CONTRACT.items()}, LGD_DEFAULT)
    base = F.when(goods / credit > 0.70, with_collateral).otherwise(without)
    down_payment = clip(clip(goods - credit, low=0.0) / clip(goods, low=1.0), 0.0, 0.50)
    return clip(base - down_payment * 0.40, 0.20, 0.95)


def ead(df: DataFrame) -> Column:
    """Drawn amount plus the convertible share of the undrawn revolving limit."""
    credit = F.coalesce(col_or(df, "amt_credit", 0.0), F.lit(0.0))
    kind = contract_type(df)
    undrawn = F.when(kind == "Revolving loans", credit * UNDRAWN_SHARE).otherwise(0.0)
    return clip(credit + lookup(kind, CCF_BY_CONTRACT, CCF_DEFAULT) * undrawn, low=0.0)


def _pd_input(df: DataFrame) -> Column:
    return F.col("pred_prob") if has(df, "pred_prob") else col_or(df, "pd", 0.1)


def stage(df: DataFrame, rule: StageRule = STAGE_RULE) -> Column:
    """Stage 3 on PD alone; stage 2 on PD, bad debt, lateness or refusals."""

    def known(name: str) -> Column:
        return F.coalesce(col_or(df, name, 0), F.lit(0))

    p = _pd_input(df)
    watch = (
        (p > rule.pd_stage2)
        | (known("bureau_bad_debt_flag") == 1)
        | (known("inst_late_ratio") > rule.late_ratio)
        | (known("prev_refused_ratio") > rule.refused_ratio)
    )
    return F.when(p > rule.pd_stage3, 3).when(watch, 2).otherwise(1)


def stage_basic(p: Column, bad_debt: Column | None = None, late_ratio: Column | None = None) -> Column:
    """The scenario variant: a missing PD counts as 0.10, refusals are not used."""
    p = clip(F.coalesce(p, F.lit(0.10)), 0.001, 0.999)
    watch = p > 0.20
    if bad_debt is not None:
        watch = watch | (F.coalesce(bad_debt, F.lit(0)) == 1)
    if late_ratio is not None:
        watch = watch | (F.coalesce(late_ratio, F.lit(0)) > 0.30)
    return F.when(p > 0.70, 3).when(watch, 2).otherwise(1)


def stage_dashboard(p: Column) -> Column:
    """The dashboard variant, on PD alone with its own limits."""
    return F.when(p < 0.20, 1).when(p < 0.50, 2).otherwise(3)


def lifetime_pd(p: Column, months: Column) -> Column:
    """Survival over the term: 1 - (1 - p)^(months / 12), between p and 0.999."""
    return clip(1.0 - F.pow(1.0 - p, months / 12.0), p, 0.999)


def add_pd_term(df: DataFrame, column: str = "pred_prob") -> DataFrame:
    """12-month and lifetime PD, their ratio and the term in years."""
    p = clip(F.col(column), 0.001, 0.999)
    months = F.coalesce(clip(numeric_or(df, "credit_term", None), 6.0, 120.0), F.lit(36.0))
    out = df.withColumns({"pd_12m": p, "__months": months})
    out = out.withColumn("pd_lifetime", lifetime_pd(F.col("pd_12m"), F.col("__months")))
    return out.withColumns({
        "pd_multiplier": F.col("pd_lifetime") / F.col("pd_12m"),
        "loan_term_yrs": F.col("__months") / 12.0,
    }).drop("__months")


def check_weights(scenarios: dict[str, Scenario]) -> None:
    total = sum(s.weight for s in scenarios.values())
    if abs(total - 1.0) >= 0.001:
        raise ValueError(f"scenario weights sum to {total}, not 1")


def add_macro_overlay(df: DataFrame, scenarios: dict[str, Scenario] = MACRO_SCENARIOS) -> DataFrame:
    """Scenario PDs, their probability-weighted blend and the 12-month uplift in percent."""
    check_weights(scenarios)
    stressed = {
        f"{base}_{name.lower()}": clip(F.col(base) * s.pd_scalar, 0.001, 0.999)
        for name, s in scenarios.items()
        for base in ("pd_12m", "pd_lifetime")
    }
    out = df.withColumns(stressed)

    def blend(base: str) -> Column:
        return sum((F.col(f"{base}_{name.lower()}") * s.weight for name, s in scenarios.items()), F.lit(0.0))

    out = out.withColumns({"pd_12m_macro": blend("pd_12m"), "pd_lifetime_macro": blend("pd_lifetime")})
    return out.withColumn("macro_uplift_12m_pct", (F.col("pd_12m_macro") / F.col("pd_12m") - 1) * 100)


def ecl_by_stage(stage_col: Column, pd_12m: Column, pd_lifetime: Column, severity: Column, exposure: Column) -> Column:
    horizon = F.when(stage_col == 1, pd_12m).when(stage_col == 2, pd_lifetime).otherwise(1.0)
    return horizon * severity * exposure


def compute_ecl(df: DataFrame, scenarios: dict[str, Scenario] = MACRO_SCENARIOS, rule: StageRule = STAGE_RULE) -> DataFrame:
    """The whole provision projection: one row in, one row out, no shuffle."""
    valued = df.withColumns({"stage": stage(df, rule), "lgd": lgd(df), "ead": ead(df)})
    out = add_macro_overlay(add_pd_term(valued), scenarios)
    out = out.withColumn("ecl", ecl_by_stage(F.col("stage"), F.col("pd_12m_macro"), F.col("pd_lifetime_macro"), F.col("lgd"), F.col("ead")))
    return out.withColumn("ecl_rate", F.col("ecl") / clip("ead", low=1.0))


def stage_summary(rows: DataFrame) -> DataFrame:
    """Count, exposure and provision (billions, 2 decimals) and mean risk figures per stage."""
    return rows.groupBy("stage").agg(
        F.count("ecl").alias("n_loans"),
        F.bround(F.sum("ead") / 1e9, 2).alias("total_ead_b"),
        F.bround(F.sum("ecl") / 1e9, 2).alias("total_ecl_b"),
        F.avg("pd_12m_macro").alias("avg_pd_12m"),
        F.avg("pd_lifetime_macro").alias("avg_pd_lifetime"),
        F.avg("lgd").alias("avg_lgd"),
        F.avg("ecl_rate").alias("ecl_coverage"),
    )


def portfolio_total(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.sum("ead").alias("total_ead"),
        F.sum("ecl").alias("total_ecl"),
        F.try_divide(F.sum("ecl") * 100, F.sum("ead")).alias("coverage_pct"),
    )


def stage_mix(rows: DataFrame) -> DataFrame:
    """Loans and share of loans per stage, all three stages listed."""
    one = rows.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("stage") == s).alias(f"s{s}") for s in (1, 2, 3)]
    )
    items = {s: {"n_loans": F.col(f"s{s}"), "pct": F.try_divide(F.col(f"s{s}") * 100.0, F.col("n"))} for s in (1, 2, 3)}
    return spread(one, {"n_loans": "bigint", "pct": "double"}, items, name="stage")


def ecl_by_scenario(rows: DataFrame, scenarios: dict[str, Scenario] = MACRO_SCENARIOS) -> DataFrame:
    """Total provision per scenario: one conditional sum each, one pass."""
    sums = {
        name: F.sum(ecl_by_stage(F.col("stage"), F.col(f"pd_12m_{name.lower()}"), F.col(f"pd_lifetime_{name.lower()}"), F.col("lgd"), F.col("ead")))
        for name in scenarios
    }
    one = rows.agg(*[s.alias(n) for n, s in sums.items()])
    items = {n: {"weight": F.lit(s.weight), "ecl_b": F.col(n) / 1e9} for n, s in scenarios.items()}
    return spread(one, {"weight": "double", "ecl_b": "double"}, items, name="scenario")


def lgd_distribution(rows: DataFrame) -> DataFrame:
    """Mean, median and range of LGD, and mean exposure uplift over the credit amount."""
    middle = median(rows, ["lgd"])["lgd"]
    return rows.agg(
        F.avg("lgd").alias("mean_lgd"),
        F.lit(middle).cast("double").alias("median_lgd"),
        F.min("lgd").alias("min_lgd"),
        F.max("lgd").alias("max_lgd"),
        F.avg(F.col("ead") / clip("amt_credit", low=1.0)).alias("ead_uplift"),
    )


def lgd_sensitivity(rows: DataFrame, lgd_column: str = "lgd", pd_column: str = "pred_prob", shifts: dict[str, float] = LGD_SHIFTS) -> DataFrame:
    """Provision, coverage and change against the base case per LGD shift, in one pass."""
    aggs, items = [F.sum("ead").alias("ead")], {}
    for i, shift in enumerate(shifts.values()):
        moved = clip(F.col(lgd_column) + shift, 0.35, 0.95)
        aggs += [F.avg(moved).alias(f"l{i}"), F.sum(F.col(pd_column) * moved * F.col("ead")).alias(f"e{i}")]
    base = list(shifts.values()).index(0.0)
    for i, label in enumerate(shifts):
        rounded = F.bround(F.col(f"e{i}") / 1e9, 3)
        items[label] = {
            "avg_lgd_pct": F.bround(F.col(f"l{i}") * 100, 1),
            "total_ecl_b": rounded,
            "coverage_pct": F.bround(F.try_divide(F.col(f"e{i}"), F.col("ead")) * 100, 2),
            "delta_vs_base_b": F.bround(rounded - F.col(f"e{base}") / 1e9, 3),
        }
    types = dict.fromkeys(["avg_lgd_pct", "total_ecl_b", "coverage_pct", "delta_vs_base_b"], "double")
    return spread(rows.agg(*aggs), types, items, name="scenario")
