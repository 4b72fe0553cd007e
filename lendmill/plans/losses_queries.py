"""Severity, exposure, staging and provision queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators import encode, lgd_model, losses
from lendmill.operators.explain import id_hash
from lendmill.plans.model_table import model_table
from lendmill.plans.portfolio import base, portfolio, with_history
from lendmill.plans.registry import query
from lendmill.sources.domain import Domain


@query("ecl_contract_type", sql="""
    SELECT sk_id_curr, name_contract_type AS from_text, name_contract_type AS from_flags FROM application""")
def ecl_contract_type(dom: Domain) -> DataFrame:
    app = dom.application
    kinds = ("Cash loans", "Revolving loans", "Consumer loans")
    flags = app.select(
        "sk_id_curr",
        losses.contract_type(app).alias("from_text"),
        *[(F.col("name_contract_type") == k).cast("int").alias(f"name_contract_type_{k.replace(' ', '_')}") for k in kinds],
    )
    return flags.select("sk_id_curr", "from_text", losses.contract_type(flags).alias("from_flags"))


@query("ecl_lgd", sql="SELECT sk_id_curr, lgd FROM valued", digits={"lgd": 8})
def ecl_lgd(dom: Domain) -> DataFrame:
    app = dom.application
    return app.select("sk_id_curr", losses.lgd(app).alias("lgd"))


@query("ecl_ead", sql="SELECT sk_id_curr, ead FROM valued", digits={"ead": 4})
def ecl_ead(dom: Domain) -> DataFrame:
    app = dom.application
    return app.select("sk_id_curr", losses.ead(app).alias("ead"))


@query("ecl_lgd_distribution", sql="""
    SELECT avg(lgd) AS mean_lgd, median(lgd) AS median_lgd, min(lgd) AS min_lgd, max(lgd) AS max_lgd,
      avg(ead / greatest(amt_credit, 1e0)) AS ead_uplift FROM valued""",
    digits=dict.fromkeys(["mean_lgd", "median_lgd", "min_lgd", "max_lgd", "ead_uplift"], 6))
def ecl_lgd_distribution(dom: Domain) -> DataFrame:
    app = dom.application
    return losses.lgd_distribution(app.select("amt_credit", losses.lgd(app).alias("lgd"), losses.ead(app).alias("ead")))


_SHIFTS = """
    SELECT s.scenario, s.shift, lgd, ead, pred_prob, least(greatest(lgd + s.shift, 35e-2), 95e-2) AS moved
    FROM valued, (VALUES ('Optimistic (LGD - 15%)', -15e-2), ('Base Case', 0e0), ('Adverse   (LGD + 15%)', 15e-2),
      ('Severe    (LGD + 30%)', 3e-1)) AS s(scenario, shift)"""


@query("ecl_lgd_sensitivity", sql=f"""
    SELECT g.scenario, round(avg_lgd * 100, 1) AS avg_lgd_pct, round_even(ecl / 1e9, 3) AS total_ecl_b,
      round(ecl / ead * 100, 2) AS coverage_pct, round(round_even(ecl / 1e9, 3) - b.base / 1e9, 3) AS delta_vs_base_b
    FROM (SELECT scenario, avg(moved) AS avg_lgd, sum(pred_prob * moved * ead) AS ecl, sum(ead) AS ead FROM ({_SHIFTS}) GROUP BY scenario) g,
      (SELECT sum(pred_prob * moved * ead) AS base FROM ({_SHIFTS}) WHERE shift = 0) b""",
    digits={"avg_lgd_pct": 1, "total_ecl_b": 3, "coverage_pct": 2, "delta_vs_base_b": 3})
def ecl_lgd_sensitivity(dom: Domain) -> DataFrame:
    app = dom.application
    return losses.lgd_sensitivity(app.select("pred_prob", losses.lgd(app).alias("lgd"), losses.ead(app).alias("ead")))


@query("ecl_stage", sql="SELECT sk_id_curr, stage FROM valued")
def ecl_stage(dom: Domain) -> DataFrame:
    rows = with_history(dom)
    return rows.select("sk_id_curr", losses.stage(rows).alias("stage"))


@query("ecl_stage_basic", sql="""
    SELECT sk_id_curr, CASE WHEN least(greatest(pred_prob, 1e-3), 999e-3) > 7e-1 THEN 3
      WHEN least(greatest(pred_prob, 1e-3), 999e-3) > 2e-1 OR coalesce(bureau_bad_debt_flag, 0) = 1
        OR coalesce(inst_late_ratio, 0) > 3e-1 THEN 2 ELSE 1 END AS stage
    FROM with_history""")
def ecl_stage_basic(dom: Domain) -> DataFrame:
    rows = with_history(dom)
    return rows.select(
        "sk_id_curr", losses.stage_basic(F.col("pred_prob"), F.col("bureau_bad_debt_flag"), F.col("inst_late_ratio")).alias("stage")
    )


@query("ecl_stage_dashboard", sql="""
    SELECT sk_id_curr, CASE WHEN pred_prob < 2e-1 THEN 1 WHEN pred_prob < 5e-1 THEN 2 ELSE 3 END AS stage FROM application""")
def ecl_stage_dashboard(dom: Domain) -> DataFrame:
    return dom.application.select("sk_id_curr", losses.stage_dashboard(F.col("pred_prob")).alias("stage"))


@query("ecl_pd_term", sql="""
    SELECT sk_id_curr, pd_12m, pd_lifetime, pd_lifetime / pd_12m AS pd_multiplier, term_months / 12e0 AS loan_term_yrs FROM with_pd""",
    digits=dict.fromkeys(["pd_12m", "pd_lifetime", "pd_multiplier", "loan_term_yrs"], 6))
def ecl_pd_term(dom: Domain) -> DataFrame:
    return losses.add_pd_term(base(dom)).select("sk_id_curr", "pd_12m", "pd_lifetime", "pd_multiplier", "loan_term_yrs")


_MACRO = [f"{b}_{s}" for s in ("optimistic", "base", "adverse", "severe") for b in ("pd_12m", "pd_lifetime")] + ["pd_12m_macro", "pd_lifetime_macro"]


@query("ecl_macro_overlay", sql=f"""
    SELECT sk_id_curr, {', '.join(_MACRO)}, (pd_12m_macro / pd_12m - 1) * 100 AS macro_uplift_12m_pct FROM with_macro""",
    digits=dict.fromkeys([*_MACRO, "macro_uplift_12m_pct"], 6))
def ecl_macro_overlay(dom: Domain) -> DataFrame:
    rows = losses.add_macro_overlay(losses.add_pd_term(base(dom)))
    return rows.select("sk_id_curr", *_MACRO, "macro_uplift_12m_pct")


@query("ecl_compute", sql="SELECT sk_id_curr, stage, lgd, ead, pd_12m_macro, pd_lifetime_macro, ecl, ecl_rate FROM portfolio",
       digits={"lgd": 8, "ead": 4, "pd_12m_macro": 6, "pd_lifetime_macro": 6, "ecl": 2, "ecl_rate": 6})
def ecl_compute(dom: Domain) -> DataFrame:
    return portfolio(dom).select("sk_id_curr", "stage", "lgd", "ead", "pd_12m_macro", "pd_lifetime_macro", "ecl", "ecl_rate")


@query("ecl_stage_summary", sql="""
    SELECT stage, count(ecl) AS n_loans, round_even(sum(ead) / 1e9, 2) AS total_ead_b, round_even(sum(ecl) / 1e9, 2) AS total_ecl_b,
      avg(pd_12m_macro) AS avg_pd_12m, avg(pd_lifetime_macro) AS avg_pd_lifetime, avg(lgd) AS avg_lgd, avg(ecl_rate) AS ecl_coverage
    FROM portfolio GROUP BY stage""",
    digits={"total_ead_b": 2, "total_ecl_b": 2, "avg_pd_12m": 6, "avg_pd_lifetime": 6, "avg_lgd": 6, "ecl_coverage": 6})
def ecl_stage_summary(dom: Domain) -> DataFrame:
    return losses.stage_summary(portfolio(dom))


@query("ecl_portfolio_total", sql="""
    SELECT sum(ead) AS total_ead, sum(ecl) AS total_ecl, sum(ecl) * 100 / sum(ead) AS coverage_pct FROM portfolio""",
    digits={"total_ead": 2, "total_ecl": 1, "coverage_pct": 6})
def ecl_portfolio_total(dom: Domain) -> DataFrame:
    return losses.portfolio_total(portfolio(dom))


@query("ecl_stage_mix", sql="""
    SELECT s.stage, count(v.stage) AS n_loans, count(v.stage) * 1e2 / (SELECT count(*) FROM valued) AS pct
    FROM (VALUES (1), (2), (3)) AS s(stage) LEFT JOIN valued v ON v.stage = s.stage GROUP BY s.stage""",
    digits={"pct": 6})
def ecl_stage_mix(dom: Domain) -> DataFrame:
    rows = with_history(dom)
    return losses.stage_mix(rows.select(losses.stage(rows).alias("stage")))


def _scenario_sql() -> str:
    parts = []
    for name, weight in (("Optimistic", "2e-1"), ("Base", "5e-1"), ("Adverse", "2e-1"), ("Severe", "1e-1")):
        n = name.lower()
        parts.append(f"""SELECT '{name}' AS scenario, {weight} AS weight,
          sum(CASE stage WHEN 1 THEN pd_12m_{n} WHEN 2 THEN pd_lifetime_{n} ELSE 1e0 END * lgd * ead) / 1e9 AS ecl_b FROM with_scenarios""")
    return " UNION ALL ".join(parts)


@query("ecl_by_scenario", sql=_scenario_sql(), digits={"ecl_b": 6, "weight": 2})
def ecl_by_scenario(dom: Domain) -> DataFrame:
    return losses.ecl_by_scenario(portfolio(dom))


@query("ecl_lgd_model")
def ecl_lgd_model(dom: Domain) -> DataFrame:
    """Boosted against ridge regression of an observed severity (the rule plus a fixed hash offset) on all features of the defaults.

    Up to 200 rounds of depth 6, ended by 20 rounds without gain on the fold that is predicted.
    """
    rows = base(dom)
    offset = (F.pmod(id_hash(), F.lit(1000)) / 1000.0 - 0.5) * 0.2
    observed = rows.select("sk_id_curr", (losses.lgd(rows) + offset).alias("actual_lgd"))
    table = model_table(dom)
    rows = lgd_model.training_rows(table.filled.join(observed, "sk_id_curr"))
    constant = {r["feature"] for r in encode.low_variance(rows, table.selected, 1e-6).collect()}
    return lgd_model.cross_validate(rows, [f for f in table.selected if f not in constant], "actual_lgd")
