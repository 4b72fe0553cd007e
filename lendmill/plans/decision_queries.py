"""Threshold economics, segment views and report marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators import clean, decision, marts, segments
from lendmill.params import SegmentFilter
from lendmill.plans.portfolio import base, bureau_history, portfolio, predictions, previous_history, with_tier
from lendmill.plans.registry import query
from lendmill.session import materialize
from lendmill.sources.domain import Domain

# ---- threshold economics --------------------------------------------------------------------


def _roi(source: str, threshold: str, group: str = "") -> str:
    reject, lgd = f"pred_prob >= {threshold}", "65e-2"
    tp, fp = f"count(*) FILTER (WHERE {reject} AND target = 1)", f"count(*) FILTER (WHERE {reject} AND target = 0)"
    tn, fn = f"count(*) FILTER (WHERE NOT {reject} AND target = 0)", f"count(*) FILTER (WHERE NOT {reject} AND target = 1)"
    rev = f"coalesce(sum(amt_credit) FILTER (WHERE NOT {reject} AND target = 0), 0) * 35e-3"
    opp = f"coalesce(sum(amt_credit) FILTER (WHERE {reject} AND target = 0), 0) * 1e-2"
    loss = f"coalesce(sum(amt_credit * {lgd}) FILTER (WHERE NOT {reject} AND target = 1), 0)"
    return f"""SELECT {threshold} AS threshold, count(*) FILTER (WHERE NOT {reject}) / count(*) AS approval_rate,
      coalesce(try_cast({tp} / nullif({tp} + {fp}, 0) AS DOUBLE), 0) AS precision, {tp} / ({tp} + {fn}) AS recall, {tp} AS tp, {fp} AS fp, {tn} AS tn, {fn} AS fn,
      {rev} / 1e6 AS revenue_tn_m, {opp} / 1e6 AS opp_cost_fp_m, {loss} / 1e6 AS loss_fn_m, count(*) * 5e1 / 1e6 AS opex_m,
      ({rev} - {loss} - {opp} - count(*) * 5e1) / 1e6 AS net_profit_m FROM {source} {group}"""


ROI_DIGITS = {"threshold": 9, "approval_rate": 8, "precision": 8, "recall": 8, "revenue_tn_m": 6, "opp_cost_fp_m": 6, "loss_fn_m": 6, "opex_m": 6, "net_profit_m": 6}
_SWEEP = _roi("application, (SELECT 2e-2 + i * 1e-2 AS t FROM range(93) AS r(i))", "t", "GROUP BY t")


@query("roi_profit_at", sql=_roi("application", "4806e-4"), digits=ROI_DIGITS)
def roi_profit_at(dom: Domain) -> DataFrame:
    return decision.profit_at(dom.application, 0.4806)


@query("roi_sweep", sql=_SWEEP, digits=ROI_DIGITS)
def roi_sweep(dom: Domain) -> DataFrame:
    return decision.sweep(dom.application)


_BEST = f"SELECT * FROM ({_SWEEP}) ORDER BY round(net_profit_m, 9) DESC, threshold LIMIT 1"


@query("roi_best", sql=_BEST, digits=ROI_DIGITS)
def roi_best(dom: Domain) -> DataFrame:
    return decision.best_threshold(decision.sweep(dom.application))


@query("roi_profit_matrix", sql=f"""
    SELECT 'Actual: Good' AS actual, tn * 35e-3 * m / 1e6 AS approve_m, -fp * 1e-2 * m / 1e6 AS reject_m FROM ({_BEST}), (SELECT avg(amt_credit) AS m FROM application)
    UNION ALL SELECT 'Actual: Default', -fn * 65e-2 * m / 1e6, tp * 65e-2 * m / 1e6 FROM ({_BEST}), (SELECT avg(amt_credit) AS m FROM application)""",
    digits={"approve_m": 6, "reject_m": 6})
def roi_profit_matrix(dom: Domain) -> DataFrame:
    return decision.profit_matrix(decision.best_threshold(decision.sweep(dom.application)), dom.application)


@query("roi_decision_status", sql=f"""SELECT sk_id_curr, CASE WHEN pred_prob < (SELECT threshold FROM ({_BEST})) THEN 'Approved' ELSE 'Rejected' END AS decision_status
    FROM application""")
def roi_decision_status(dom: Domain) -> DataFrame:
    best = decision.best_threshold(decision.sweep(dom.application)).first()["threshold"]
    return decision.decision_status(dom.application, best).select("sk_id_curr", "decision_status")


@query("roi_credit_band", sql="""
    SELECT sk_id_curr, CASE risk_tier WHEN 'Very Low' THEN 'Excellent' WHEN 'Low' THEN 'Good' WHEN 'Medium' THEN 'Fair' ELSE 'Poor' END AS credit_band,
      'Unknown' AS without_tier FROM tiered_app""")
def roi_credit_band(dom: Domain) -> DataFrame:
    rows = with_tier(dom.application.select("sk_id_curr", "pred_prob"), dom)
    banded = decision.credit_band(rows)
    untiered = decision.credit_band(rows.drop("risk_tier")).select(F.col("credit_band").alias("u")).limit(1)
    return banded.select("sk_id_curr", "credit_band", untiered.scalar().alias("without_tier"))


# ---- segments -------------------------------------------------------------------------------


def _cut(expr: str, edges: list[str], labels: list[str]) -> str:
    cases = " ".join(f"WHEN {expr} > {lo} AND {expr} <= {hi} THEN '{label}'" for lo, hi, label in zip(edges, edges[1:], labels))
    return f"CASE {cases} END"


_TERM = _cut("round_even(amt_credit / greatest(amt_annuity, 1e0), 0)", ["-1", "18", "30", "42", "56", "9999"], ["≤18m", "24m", "36m", "48m", "60m+"])
_LTI = _cut("credit_income_ratio", ["-1", "1", "2", "3", "5", "999"], ["0–1×", "1–2×", "2–3×", "3–5×", ">5×"])
_DTI = _cut("annuity_income_ratio", ["-1", "1e-1", "2e-1", "3e-1", "5e-1", "9"], ["0–10%", "10–20%", "20–30%", "30–50%", ">50%"])
_CRED = _cut("amt_credit", ["0", "1e5", "2e5", "3e5", "5e5", "9e9"], ["$0–100k", "$100–200k", "$200–300k", "$300–500k", "$500k+"])
_BAND = _cut("pred_prob", ["0", "1e-1", "2e-1", "3e-1", "4e-1", "5e-1", "6e-1", "7e-1", "8e-1", "9e-1", "101e-2"],
             ["0–10%", "10–20%", "20–30%", "30–40%", "40–50%", "50–60%", "60–70%", "70–80%", "80–90%", "90–100%"])
_MONTH = "strftime(DATE '2016-06-01' - CAST(least(abs(days_id_publish), 1095) AS INTEGER), '%Y-%m')"
_SEGMENTS = f"""(SELECT sk_id_curr, target, pred_prob, amt_credit, code_gender, name_income_type, name_family_status, region_rating_client_w_city, risk_tier,
  {_TERM} AS term_bin, {_LTI} AS lti_bin, {_DTI} AS dti_bin, {_CRED} AS credit_bin, {_BAND} AS pd_band, {_MONTH} AS disbursement_month,
  pred_prob * 45e-2 * amt_credit AS ecl, CASE WHEN pred_prob < 2e-1 THEN 1 WHEN pred_prob < 5e-1 THEN 2 ELSE 3 END AS stage FROM tiered_app)"""


def _segmented(dom: Domain) -> DataFrame:
    """Scored applications with the fallback provision and every segment column."""
    return segments.segment_frame(with_tier(base(dom), dom))


@query("seg_term_bin", sql=f"SELECT sk_id_curr, {_TERM} AS term_bin FROM application")
def seg_term_bin(dom: Domain) -> DataFrame:
    return dom.application.select("sk_id_curr", segments.term_bin().alias("term_bin"))


@query("seg_lti_bin", sql=f"SELECT sk_id_curr, {_LTI} AS lti_bin FROM base_app")
def seg_lti_bin(dom: Domain) -> DataFrame:
    rows = base(dom)
    return rows.select("sk_id_curr", segments.lti_bin(rows).alias("lti_bin"))


@query("seg_dti_bin", sql=f"SELECT sk_id_curr, {_DTI} AS dti_bin FROM base_app")
def seg_dti_bin(dom: Domain) -> DataFrame:
    rows = base(dom)
    return rows.select("sk_id_curr", segments.dti_bin(rows).alias("dti_bin"))


@query("seg_credit_bin", sql=f"SELECT sk_id_curr, {_CRED} AS credit_bin FROM application")
def seg_credit_bin(dom: Domain) -> DataFrame:
    return dom.application.select("sk_id_curr", segments.credit_bin().alias("credit_bin"))


@query("seg_pd_band", sql=f"SELECT sk_id_curr, {_BAND} AS pd_band FROM application")
def seg_pd_band(dom: Domain) -> DataFrame:
    return dom.application.select("sk_id_curr", segments.pd_band().alias("pd_band"))


@query("seg_fallback_cols", sql="""
    SELECT sk_id_curr, 'Unknown' AS name_family_status, 0 AS region_rating_client_w_city, code_gender, 'Unknown' AS name_income_type,
      pred_prob * 45e-2 * amt_credit AS ecl, CASE WHEN pred_prob < 2e-1 THEN 1 WHEN pred_prob < 5e-1 THEN 2 ELSE 3 END AS stage FROM application""", digits={"ecl": 7})
def seg_fallback_cols(dom: Domain) -> DataFrame:
    bare = dom.application.select("sk_id_curr", "code_gender", "pred_prob", "amt_credit")
    return segments.with_fallbacks(bare).drop("pred_prob", "amt_credit")


CHOSEN = SegmentFilter(family=("Married", "Divorced"), region=2, tiers=("Low", "Medium", "High"), terms=("24", "36", "60+"))
_CHOSEN = """name_family_status IN ('Married', 'Separated') AND region_rating_client_w_city = 2 AND risk_tier IN ('Low', 'Medium', 'High')
  AND term_bin IN ('24m', '36m', '60m+')"""


@query("seg_filters", sql=f"SELECT sk_id_curr, risk_tier, term_bin, name_family_status FROM {_SEGMENTS} WHERE {_CHOSEN}")
def seg_filters(dom: Domain) -> DataFrame:
    return segments.apply_filter(_segmented(dom), CHOSEN).select("sk_id_curr", "risk_tier", "term_bin", "name_family_status")


def _kpi(where: str) -> str:
    return f"""SELECT count(*) FILTER (WHERE code_gender = 'M') AS n_male, count(*) FILTER (WHERE code_gender = 'F') AS n_female, sum(amt_credit) AS exposure, sum(ecl) AS ecl,
      avg(target) AS default_rate, avg(CASE WHEN risk_tier = 'High' THEN 1e0 ELSE 0e0 END) AS high_risk_share,
      coalesce(sum(ecl) FILTER (WHERE risk_tier = 'High'), 0) AS high_risk_ecl, sum(ecl) / sum(amt_credit) AS coverage FROM {_SEGMENTS} WHERE {where}"""


KPI = {"exposure": 2, "ecl": 3, "default_rate": 8, "high_risk_share": 8, "high_risk_ecl": 3, "coverage": 8}


@query("seg_kpis", sql=_kpi("TRUE"), digits=KPI)
def seg_kpis(dom: Domain) -> DataFrame:
    return segments.kpis(_segmented(dom))


@query("seg_kpi_delta", sql="SELECT " + ", ".join(f"s.{k} - a.{k} AS {k}_delta" for k in ["n_male", "n_female", *KPI]) + f" FROM ({_kpi(_CHOSEN)}) s, ({_kpi('TRUE')}) a",
       digits={f"{k}_delta": d for k, d in KPI.items()})
def seg_kpi_delta(dom: Domain) -> DataFrame:
    keep = (
        F.col("name_family_status").isin("Married", "Separated") & (F.col("region_rating_client_w_city") == 2)
        & F.col("risk_tier").isin("Low", "Medium", "High") & F.col("term_bin").isin("24m", "36m", "60m+")
    )
    return segments.kpi_delta(_segmented(dom), keep)


@query("seg_defaults_by_income", sql="SELECT name_income_type, count(*) AS n_defaults FROM application WHERE target = 1 GROUP BY 1")
def seg_defaults_by_income(dom: Domain) -> DataFrame:
    return segments.default_counts(dom.application, "name_income_type")


@query("seg_defaults_by_term", sql=f"SELECT {_TERM} AS term_bin, count(*) AS n_defaults FROM application WHERE target = 1 GROUP BY 1")
def seg_defaults_by_term(dom: Domain) -> DataFrame:
    return segments.default_counts(dom.application.withColumn("term_bin", segments.term_bin()), "term_bin")


def _by(key: str) -> str:
    return f"SELECT {key}, sum(amt_credit) AS exposure, avg(target) AS default_rate, sum(ecl) AS ecl FROM {_SEGMENTS} WHERE {key} IS NOT NULL GROUP BY {key}"


BY = {"exposure": 2, "default_rate": 8, "ecl": 3}


@query("seg_exposure_by_credit", sql=_by("credit_bin"), digits=BY)
def seg_exposure_by_credit(dom: Domain) -> DataFrame:
    return segments.by_segment(_segmented(dom), "credit_bin")


_MONTHLY = f"SELECT disbursement_month, avg(target) AS default_rate, count(target) AS n_loans FROM {_SEGMENTS} GROUP BY 1"


@query("seg_vintage_month", sql=_MONTHLY, digits={"default_rate": 8})
def seg_vintage_month(dom: Domain) -> DataFrame:
    return segments.monthly_vintage(_segmented(dom))


@query("seg_trend_fit", sql=f"""SELECT regr_slope(default_rate, x) AS slope, regr_intercept(default_rate, x) AS intercept, count(*) AS n_periods
    FROM (SELECT default_rate, row_number() OVER (ORDER BY disbursement_month) - 1 AS x FROM ({_MONTHLY}))""", digits={"slope": 9, "intercept": 8})
def seg_trend_fit(dom: Domain) -> DataFrame:
    return segments.trend(segments.monthly_vintage(_segmented(dom)))


@query("seg_pd_histogram", sql=f"SELECT pd_band, count(*) AS n_loans, avg(target) AS default_rate FROM {_SEGMENTS} WHERE pd_band IS NOT NULL GROUP BY 1", digits={"default_rate": 8})
def seg_pd_histogram(dom: Domain) -> DataFrame:
    return segments.pd_histogram(_segmented(dom))


@query("seg_ecl_by_dti", sql=f"SELECT dti_bin, sum(ecl) / 1e6 AS ecl_m, avg(target) AS default_rate FROM {_SEGMENTS} WHERE dti_bin IS NOT NULL GROUP BY 1",
       digits={"ecl_m": 8, "default_rate": 8})
def seg_ecl_by_dti(dom: Domain) -> DataFrame:
    return segments.ecl_by_dti(_segmented(dom))


@query("seg_stage_cards", sql=f"SELECT stage, count(*) AS n_loans, sum(amt_credit) AS ead, sum(ecl) AS ecl, sum(ecl) / sum(amt_credit) AS coverage FROM {_SEGMENTS} GROUP BY 1",
       digits={"ead": 2, "ecl": 3, "coverage": 8})
def seg_stage_cards(dom: Domain) -> DataFrame:
    return segments.stage_cards(_segmented(dom))


@query("seg_insights", sql=f"""
    SELECT sum(ecl) FILTER (WHERE risk_tier = 'High') / sum(ecl) AS high_ecl_share,
      (SELECT lti_bin FROM {_SEGMENTS} WHERE lti_bin IS NOT NULL GROUP BY 1 ORDER BY avg(target) DESC, min(CASE lti_bin WHEN '0–1×' THEN 0 WHEN '1–2×' THEN 1
        WHEN '2–3×' THEN 2 WHEN '3–5×' THEN 3 ELSE 4 END) LIMIT 1) AS worst_lti_bin,
      (SELECT name_income_type FROM application WHERE target = 1 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_default_income FROM {_SEGMENTS}""",
    digits={"high_ecl_share": 8})
def seg_insights(dom: Domain) -> DataFrame:
    return segments.insights(_segmented(dom))


@query("seg_region", sql=f"SELECT *, 'Region Rating ' || region_rating_client_w_city::VARCHAR AS label FROM ({_by('region_rating_client_w_city')})", digits=BY)
def seg_region(dom: Domain) -> DataFrame:
    return segments.by_region(_segmented(dom))


# ---- marts ----------------------------------------------------------------------------------


@query("sql_risk_profile", sql="""
    SELECT sk_id_curr, target, code_gender, name_income_type, name_education_type, occupation_type, name_contract_type, amt_credit, amt_income_total, ext_source_2,
      ext_source_3, age_years, credit_income_ratio, bureau_bad_debt_flag, prev_refused_ratio, pred_prob AS default_probability, risk_tier
    FROM tiered WHERE is_train = 1""", digits={"age_years": 6, "credit_income_ratio": 6, "prev_refused_ratio": 6})
def sql_risk_profile(dom: Domain) -> DataFrame:
    rows = base(dom).select("sk_id_curr", "age_years", "credit_income_ratio")
    feats = rows.join(bureau_history(dom), "sk_id_curr", "left").join(previous_history(dom), "sk_id_curr", "left")
    scored = with_tier(dom.application.select("sk_id_curr", "pred_prob"), dom).select(
        "sk_id_curr", F.lit("v1").alias("model_version"), F.col("pred_prob").alias("default_probability"), "risk_tier")
    return marts.risk_profile(dom.application, feats, scored, "v1")


@query("sql_default_by_segment", sql="""
    SELECT name_income_type, name_education_type, code_gender, count(*) AS applicant_count, sum(target)::BIGINT AS default_count, avg(target) * 100 AS default_rate_pct,
      avg(amt_credit) AS avg_credit_amount, avg(amt_income_total) AS avg_income FROM application WHERE is_train = 1 GROUP BY 1, 2, 3""",
    digits={"default_rate_pct": 6, "avg_credit_amount": 5, "avg_income": 5})
def sql_default_by_segment(dom: Domain) -> DataFrame:
    return marts.default_by_segment(dom.application)


@query("sql_collections_topn", sql="""
    SELECT sk_id_curr, code_gender, name_income_type, amt_income_total, amt_credit, round(pred_prob * 100, 2) AS pd_pct, risk_tier, round(CAST(round(ecl, 6) AS DECIMAL(28, 6)), 2)::DOUBLE AS ecl_usd,
      '09' || right((sk_id_curr * 1234567)::VARCHAR, 8) AS phone, 'khachhang_' || sk_id_curr::VARCHAR || '@gmail.com' AS email
    FROM tiered WHERE risk_tier = 'High' AND pred_prob > 48e-2 ORDER BY pred_prob DESC, sk_id_curr LIMIT 1000""",
    digits={"amt_income_total": 4, "pd_pct": 2, "ecl_usd": 2})
def sql_collections_topn(dom: Domain) -> DataFrame:
    """The list is ranked on score and tier first; histories and provisions are built for its rows only."""
    scored = with_tier(dom.application.select("sk_id_curr", "pred_prob"), dom).withColumnRenamed("pred_prob", "default_probability")
    top = materialize(marts.collections_ranking(scored).select("sk_id_curr"), "top")
    return marts.collections_top(predictions(dom, top), dom.application)


@query("sql_auto_approve", sql="""
    SELECT sk_id_curr, amt_credit, amt_income_total, round(pred_prob * 100, 2) AS pd_pct, 'AUTO-APPROVE' AS decision
    FROM tiered_app WHERE pred_prob < 15e-2 AND risk_tier IN ('Very Low', 'Low')""", digits={"amt_income_total": 4, "pd_pct": 2})
def sql_auto_approve(dom: Domain) -> DataFrame:
    scored = with_tier(dom.application.select("sk_id_curr", "pred_prob"), dom).withColumnRenamed("pred_prob", "default_probability")
    return marts.auto_approve(scored, dom.application, stamped=False)


@query("sql_provision_by_stage", sql="""
    SELECT stage, count(sk_id_curr) AS n_loans, sum(ead) AS ead, sum(ecl) AS ecl, round(sum(ecl) / sum(ead) * 100, 2) AS coverage_pct FROM portfolio
    WHERE stage IS NOT NULL GROUP BY stage""", digits={"ead": 2, "ecl": 1, "coverage_pct": 2})
def sql_provision_by_stage(dom: Domain) -> DataFrame:
    return marts.provision_by_stage(portfolio(dom))


@query("sql_vip_upsell", sql="""
    SELECT sk_id_curr, amt_income_total, name_income_type, round(pred_prob * 100, 2) AS pd_pct, 'Telesale - Mo The Tin Dung' AS campaign
    FROM application WHERE pred_prob < 5e-2 AND amt_income_total > 200000""", digits={"amt_income_total": 4, "pd_pct": 2})
def sql_vip_upsell(dom: Domain) -> DataFrame:
    scored = dom.application.select("sk_id_curr", F.col("pred_prob").alias("default_probability"))
    return marts.vip_upsell(scored, dom.application)


@query("sql_target_share", sql="""
    SELECT target, count(*) AS cnt, count(*) * 1e2 / sum(count(*)) OVER () AS pct FROM application WHERE is_train = 1 GROUP BY target""", digits={"pct": 6})
def sql_target_share(dom: Domain) -> DataFrame:
    return marts.target_share(dom.application)


@query("sql_anomaly_check", sql="""
    SELECT 'cleaned' AS tbl, count(*) FILTER (WHERE days_employed > 0 AND emp_anomaly = 0) AS n_unfixed FROM base_app
    UNION ALL SELECT 'raw', count(*) FILTER (WHERE days_employed > 0) FROM application""")
def sql_anomaly_check(dom: Domain) -> DataFrame:
    """0 on the cleaned table; the raw table without a flag shows what the check finds."""
    cleaned = marts.unfixed_anomalies(clean.flag_sentinel(dom.application, "days_employed", "emp_anomaly"))
    raw = marts.unfixed_anomalies(dom.application.withColumn("emp_anomaly", F.lit(0)))
    return cleaned.select(F.lit("cleaned").alias("tbl"), "n_unfixed").union(raw.select(F.lit("raw").alias("tbl"), "n_unfixed"))
