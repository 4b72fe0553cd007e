"""Vintage, migration, projection and cohort queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators import scenario
from lendmill.operators.losses import ead
from lendmill.params import MACRO_PATHS, PATH_WEIGHTS
from lendmill.plans.portfolio import base, portfolio
from lendmill.plans.registry import query
from lendmill.sources.domain import Domain

_PROXY = "CAST(DATE '2016-06-01' - CAST(least(abs(days_id_publish), 1460) AS INTEGER) AS TIMESTAMP)"


@query("scn_app_date", sql=f"""
    SELECT sk_id_curr, CAST(application_date AS TIMESTAMP) AS actual_date, 'application_date' AS actual_column, 'actual' AS actual_quality,
      {_PROXY} AS proxy_date, 'proxy' AS proxy_quality, TIMESTAMP '2016-06-01' AS constant_date, 'fallback' AS constant_quality,
      'proxy' AS sparse_quality FROM application""")
def scn_app_date(dom: Domain) -> DataFrame:
    """All three sources, and a date column too sparse to be used."""
    app = dom.application.select("sk_id_curr", "application_date", "days_id_publish")
    sparse = app.select(F.when(F.col("sk_id_curr") % 5 != 0, F.lit("1999-01-01")).otherwise("no date").alias("app_date"), "days_id_publish")
    actual = scenario.fit_date_source(app)
    proxy = scenario.fit_date_source(app.drop("application_date"))
    constant = scenario.fit_date_source(app.select("sk_id_curr"))

    def naive(c):
        return c.cast("timestamp_ntz")

    return app.select(
        "sk_id_curr", naive(actual.value()).alias("actual_date"), F.lit(actual.column).alias("actual_column"), F.lit(actual.quality).alias("actual_quality"),
        naive(proxy.value()).alias("proxy_date"), F.lit(proxy.quality).alias("proxy_quality"),
        naive(constant.value()).alias("constant_date"), F.lit(constant.quality).alias("constant_quality"),
        F.lit(scenario.fit_date_source(sparse).quality).alias("sparse_quality"),
    )


@query("scn_quarter", sql="SELECT sk_id_curr, year(application_date)::VARCHAR || 'Q' || quarter(application_date)::VARCHAR AS quarter_key FROM application")
def scn_quarter(dom: Domain) -> DataFrame:
    return dom.application.select("sk_id_curr", scenario.quarter_key(F.col("application_date")).alias("quarter_key"))


@query("scn_month", sql="SELECT sk_id_curr, strftime(application_date, '%Y-%m') AS month_key FROM application")
def scn_month(dom: Domain) -> DataFrame:
    return dom.application.select("sk_id_curr", scenario.month_key(F.col("application_date")).alias("month_key"))


_BUCKET = """CASE WHEN least(greatest(credit_term, 6), 60) <= 12 THEN '0-12m' WHEN least(greatest(credit_term, 6), 60) <= 18 THEN '12-18m'
  WHEN least(greatest(credit_term, 6), 60) <= 24 THEN '18-24m' WHEN least(greatest(credit_term, 6), 60) <= 36 THEN '24-36m' ELSE '36m+' END"""


@query("scn_term_bucket", sql=f"SELECT sk_id_curr, {_BUCKET} AS term_bucket FROM base_app")
def scn_term_bucket(dom: Domain) -> DataFrame:
    rows = base(dom)
    return rows.select("sk_id_curr", scenario.term_bucket(rows).alias("term_bucket"))


@query("scn_vintage", sql=f"""
    SELECT *, default_rate * 100 AS default_rate_pct, avg_pd * 100 AS avg_pd_pct, total_ead / 1e9 AS total_ead_b, 'actual' AS date_quality,
      'Using explicit date column `application_date`.' AS date_note, 'term_bucket_proxy' AS mob_quality, 'target' AS default_source
    FROM (SELECT year(application_date)::VARCHAR || 'Q' || quarter(application_date)::VARCHAR AS cohort, {_BUCKET} AS mob_bucket, avg(target) AS default_rate,
        count(sk_id_curr) AS n_loans, avg(pred_prob) AS avg_pd, sum(ead) AS total_ead FROM valued GROUP BY 1, 2)""",
    digits={"default_rate": 6, "avg_pd": 7, "total_ead": 3, "default_rate_pct": 6, "avg_pd_pct": 5, "total_ead_b": 9})
def scn_vintage(dom: Domain) -> DataFrame:
    rows = base(dom)
    return scenario.vintage(rows.withColumn("ead", ead(rows)))


def _stage_sql(p: str) -> str:
    return f"CASE WHEN {p} > 7e-1 THEN 3 WHEN {p} > 2e-1 OR coalesce(bureau_bad_debt_flag, 0) = 1 OR coalesce(inst_late_ratio, 0) > 3e-1 THEN 2 ELSE 1 END"


_P0 = "least(greatest(pred_prob, 1e-3), 999e-3)"
_MIGRATION = f"""SELECT s0 AS stage_t, coalesce(sum(CASE WHEN s1 = 1 THEN ead END) / 1e9, 0) AS to_stage1, coalesce(sum(CASE WHEN s1 = 2 THEN ead END) / 1e9, 0) AS to_stage2,
    coalesce(sum(CASE WHEN s1 = 3 THEN ead END) / 1e9, 0) AS to_stage3
  FROM (SELECT {_stage_sql(_P0)} AS s0, {_stage_sql(f'least(greatest({_P0} * 125e-2, 1e-3), 999e-3)')} AS s1, ead FROM valued) GROUP BY s0"""
MIGRATION = ["to_stage1", "to_stage2", "to_stage3"]


@query("scn_migration_abs", sql=_MIGRATION, digits=dict.fromkeys(MIGRATION, 8))
def scn_migration_abs(dom: Domain) -> DataFrame:
    return scenario.migration(portfolio(dom))


_MIGRATION_PCT = "SELECT stage_t, " + ", ".join(f"{c} / (to_stage1 + to_stage2 + to_stage3) * 100 AS {c}" for c in MIGRATION) + f" FROM ({_MIGRATION})"


@query("scn_migration_pct", sql=_MIGRATION_PCT, digits=dict.fromkeys(MIGRATION, 6))
def scn_migration_pct(dom: Domain) -> DataFrame:
    return scenario.migration(portfolio(dom), percent=True)


def _steps(months: int) -> str:
    rows = [
        f"('{n}', {m}, {repr(float(path[min(m, len(path)) - 1]))}::DOUBLE, {PATH_WEIGHTS[n]}::DOUBLE)"
        for n, path in MACRO_PATHS.items() for m in range(1, months + 1)
    ]
    return f"(VALUES {', '.join(rows)}) AS s(scenario, month, scalar, weight)"


def _projection(months: int) -> str:
    return f"""SELECT scenario, month, weight, round_even(sum(ecl) / 1e9, 3) AS ecl_b, round_even(sum(ead) / 1e9, 3) AS ead_b,
      round_even(sum(ecl) / greatest(sum(ead), 1) * 100, 3) AS coverage_pct,
      round_even(coalesce(sum(ead) FILTER (WHERE stage = 1), 0) / 1e9, 3) AS stage1_ead_b, round_even(coalesce(sum(ead) FILTER (WHERE stage = 2), 0) / 1e9, 3) AS stage2_ead_b,
      round_even(coalesce(sum(ead) FILTER (WHERE stage = 3), 0) / 1e9, 3) AS stage3_ead_b, sum(ecl_now) / 1e9 AS ecl_current_b, sum(ead0) / 1e9 AS ead_current_b,
      'deterministic_pd_lgd_ead_stage_scenario' AS projection_method
    FROM (SELECT *, CASE stage WHEN 1 THEN p WHEN 2 THEN least(greatest(1 - pow(1 - p, term / 12), p), 999e-3) ELSE 1e0 END * lgd * ead AS ecl
      FROM (SELECT *, {_stage_sql('p')} AS stage FROM (
        SELECT scenario, month, weight, least(greatest({_P0} * scalar, 1e-3), 999e-3) AS p, v.ead * pow(985e-3, month) AS ead, v.ead AS ead0, v.ecl AS ecl_now, lgd,
          least(greatest(least(greatest(credit_term, 6), 120) - month, 6), 120) AS term, bureau_bad_debt_flag, inst_late_ratio
        FROM portfolio v, {_steps(months)})))
    GROUP BY scenario, month, weight"""


PROJECTION = {"ecl_b": 3, "ead_b": 3, "coverage_pct": 3, "stage1_ead_b": 3, "stage2_ead_b": 3, "stage3_ead_b": 3, "ecl_current_b": 8, "ead_current_b": 8, "weight": 2}


@query("scn_ecl_projection", sql=_projection(12), digits=PROJECTION)
def scn_ecl_projection(dom: Domain) -> DataFrame:
    return scenario.ecl_projection(portfolio(dom))


@query("scn_path_extend", sql=f"SELECT scenario, month, ecl_b, ead_b FROM ({_projection(15)}) WHERE month > 12", digits={"ecl_b": 3, "ead_b": 3})
def scn_path_extend(dom: Domain) -> DataFrame:
    """Beyond the twelfth month the last scalar stays."""
    return scenario.ecl_projection(portfolio(dom), months=15).filter("month > 12").select("scenario", "month", "ecl_b", "ead_b")


_WEIGHTED = f"""SELECT scenario, month, weight, ecl_b, ead_b, coverage_pct, ecl_current_b, projection_method FROM ({_projection(12)})
  UNION ALL SELECT 'Probability Weighted', month, 1e0, sum(ecl_b * weight), avg(ead_b), avg(coverage_pct), any_value(ecl_current_b), 'weighted_average_of_macro_scenarios'
    FROM ({_projection(12)}) GROUP BY month"""


@query("scn_ecl_weighted", sql=_WEIGHTED, digits={"weight": 2, "ecl_b": 5, "ead_b": 6, "coverage_pct": 6, "ecl_current_b": 8})
def scn_ecl_weighted(dom: Domain) -> DataFrame:
    return scenario.full_projection(portfolio(dom)).select("scenario", "month", "weight", "ecl_b", "ead_b", "coverage_pct", "ecl_current_b", "projection_method")


@query("seg_scenario_band", sql=f"""SELECT month, max(ecl_b) FILTER (WHERE scenario = 'Optimistic') AS low_ecl_b, max(ecl_b) FILTER (WHERE scenario = 'Severe') AS high_ecl_b
    FROM ({_projection(12)}) GROUP BY month""", digits={"low_ecl_b": 3, "high_ecl_b": 3})
def seg_scenario_band(dom: Domain) -> DataFrame:
    return scenario.scenario_band(scenario.ecl_projection(portfolio(dom)))


def _at(name: str) -> str:
    return f"max(ecl_b) FILTER (WHERE scenario = '{name}' AND month = 12)"


_KPI_DIGITS = {"ecl_now_b": 8, "optimistic_b": 3, "base_b": 3, "adverse_b": 3, "severe_b": 3, "capital_buffer_b": 3, "optimistic_change_pct": 5, "base_change_pct": 5,
               "adverse_change_pct": 5, "severe_change_pct": 5, "downgrade_pct": 6}


@query("scn_projection_kpis", sql=f"""
    SELECT max(ecl_current_b) AS ecl_now_b, {', '.join(f"{_at(n)} AS {n.lower()}_b" for n in MACRO_PATHS)}, {_at('Severe')} - {_at('Base')} AS capital_buffer_b,
      {', '.join(f"({_at(n)} - max(ecl_current_b)) / max(ecl_current_b) * 100 AS {n.lower()}_change_pct" for n in MACRO_PATHS)},
      (SELECT to_stage2 + to_stage3 FROM ({_MIGRATION_PCT}) WHERE stage_t = 1) AS downgrade_pct FROM ({_projection(12)})""", digits=_KPI_DIGITS)
def scn_projection_kpis(dom: Domain) -> DataFrame:
    rows = portfolio(dom)
    return scenario.projection_kpis(scenario.ecl_projection(rows), scenario.migration(rows, percent=True))


_AGE = "least(greatest(round_even(age_years, 0), 18), 70)"
_TENURE = "least(greatest(coalesce(years_employed, 0), 0), 20)"


@query("scn_cohort_default", sql=f"""
    SELECT *, default_rate * 100 AS default_rate_pct, total_ead / 1e9 AS total_ead_b, avg_ecl / 1e3 AS avg_ecl_k, 'target' AS default_source FROM (
      SELECT CASE WHEN {_AGE} <= 25 THEN '18-25' WHEN {_AGE} <= 35 THEN '26-35' WHEN {_AGE} <= 45 THEN '36-45' WHEN {_AGE} <= 55 THEN '46-55' ELSE '56+' END AS age_band,
        CASE WHEN {_TENURE} <= 1 THEN '<1yr' WHEN {_TENURE} <= 3 THEN '1-3yr' WHEN {_TENURE} <= 5 THEN '3-5yr' WHEN {_TENURE} <= 10 THEN '5-10yr' ELSE '>10yr' END AS tenure_band,
        avg(target) AS default_rate, count(sk_id_curr) AS n_loans, sum(ead) AS total_ead, avg(ecl) AS avg_ecl, avg(pred_prob) AS avg_pd FROM portfolio GROUP BY 1, 2)""",
    digits={"default_rate": 6, "total_ead": 3, "avg_ecl": 4, "avg_pd": 7, "default_rate_pct": 6, "total_ead_b": 9, "avg_ecl_k": 6})
def scn_cohort_default(dom: Domain) -> DataFrame:
    return scenario.cohort_default(portfolio(dom))


_DAY = "CASE weekday_appr_process_start WHEN 'MONDAY' THEN 'Mon' WHEN 'TUESDAY' THEN 'Tue' WHEN 'WEDNESDAY' THEN 'Wed' WHEN 'THURSDAY' THEN 'Thu' WHEN 'FRIDAY' THEN 'Fri' WHEN 'SATURDAY' THEN 'Sat' ELSE 'Sun' END"
_RISK = "CASE WHEN pred_prob > 48e-2 THEN 1e0 ELSE 0e0 END"


@query("scn_weekday_decode", sql=f"SELECT sk_id_curr, {_DAY} AS from_text, {_DAY} AS from_flags FROM application")
def scn_weekday_decode(dom: Domain) -> DataFrame:
    days = ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY"]
    app = dom.application
    flags = app.select(
        "sk_id_curr", scenario.weekday(app).alias("from_text"),
        *[(F.col("weekday_appr_process_start") == d).cast("int").alias(f"weekday_appr_process_start_{d}") for d in days])
    return flags.select("sk_id_curr", "from_text", scenario.weekday(flags).alias("from_flags"))


@query("scn_intraday_pivot", sql=f"SELECT {_DAY} AS weekday, " + ", ".join(
    f"coalesce(avg({_RISK}) FILTER (WHERE hour_appr_process_start = {h}), 0) * 100 AS h{h}" for h in range(24)) + " FROM application GROUP BY 1",
    digits={f"h{h}": 6 for h in range(24)})
def scn_intraday_pivot(dom: Domain) -> DataFrame:
    return scenario.intraday_pivot(scenario.intraday_rows(dom.application))


_HOURLY = f"SELECT hour_appr_process_start AS hour, avg({_RISK}) AS high_risk_rate, count(*) AS volume, avg({_RISK}) * 100 AS high_risk_pct FROM application GROUP BY 1"


@query("scn_hourly", sql=_HOURLY, digits={"high_risk_rate": 8, "high_risk_pct": 6})
def scn_hourly(dom: Domain) -> DataFrame:
    return scenario.hourly_risk(scenario.intraday_rows(dom.application))


@query("scn_daily", sql=f"SELECT {_DAY} AS weekday, avg({_RISK}) AS high_risk_rate, count(*) AS volume, avg({_RISK}) * 100 AS high_risk_pct FROM application GROUP BY 1",
       digits={"high_risk_rate": 8, "high_risk_pct": 6})
def scn_daily(dom: Domain) -> DataFrame:
    return scenario.daily_risk(scenario.intraday_rows(dom.application))


@query("scn_peak_and_offhours", sql=f"""
    SELECT (SELECT hour FROM ({_HOURLY}) ORDER BY high_risk_pct DESC, hour LIMIT 1) AS peak_hour, max(high_risk_pct) AS peak_pct,
      avg(high_risk_pct) FILTER (WHERE hour < 6 OR hour >= 22) AS off_hours_pct, avg(high_risk_pct) FILTER (WHERE hour >= 9 AND hour < 17) AS business_hours_pct,
      avg(high_risk_pct) FILTER (WHERE hour < 6 OR hour >= 22) - avg(high_risk_pct) FILTER (WHERE hour >= 9 AND hour < 17) AS delta_pct FROM ({_HOURLY})""",
    digits=dict.fromkeys(["peak_pct", "off_hours_pct", "business_hours_pct", "delta_pct"], 6))
def scn_peak_and_offhours(dom: Domain) -> DataFrame:
    return scenario.peak_and_off_hours(scenario.hourly_risk(scenario.intraday_rows(dom.application)))
