"""Named views for the checking SQL: the domain tables and the scored portfolio, in plain SQL."""

from __future__ import annotations

from lendmill.params import MACRO_SCENARIOS
from lendmill.sources import domain


def _select(columns: dict[str, str], source: str, **fields: str) -> str:
    return "SELECT " + ", ".join(f"{e.format(**fields) if fields else e} AS {n}" for n, e in columns.items()) + f" FROM {source}"


def _scenario_columns() -> str:
    out = []
    for name, s in MACRO_SCENARIOS.items():
        for base in ("pd_12m", "pd_lifetime"):
            out.append(f"least(greatest({base} * {s.pd_scalar}e0, 1e-3), 999e-3) AS {base}_{name.lower()}")
    return ", ".join(out)


def _blend(base: str) -> str:
    return " + ".join(f"{base}_{n.lower()} * {s.weight}e0" for n, s in MACRO_SCENARIOS.items())


VIEWS = {
    "application": _select(
        domain.APPLICATION, "orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"
    ),
    "bureau": _select(domain.BUREAU, "lineitem"),
    "previous_application": _select(domain.PREVIOUS, "lineitem"),
    "installments": _select(
        domain.INSTALLMENTS, "lineitem JOIN orders ON o_orderkey = l_orderkey", days_between="date_diff('day', o_orderdate, l_shipdate)"
    ),
    "pos_cash": _select(domain.POS_CASH, "lineitem"),
    "credit_card": _select(domain.CREDIT_CARD, "lineitem"),
    # applications with sentinel days removed, ratios and ages
    "base_app": """
        SELECT * REPLACE (nullif(days_employed, 365243) AS days_employed),
          CASE WHEN days_employed = 365243 THEN 1 ELSE 0 END AS emp_anomaly,
          amt_credit / (amt_income_total + 1e-6) AS credit_income_ratio,
          amt_annuity / (amt_income_total + 1e-6) AS annuity_income_ratio,
          amt_credit / (amt_annuity + 1e-6) AS credit_term,
          amt_goods_price / (amt_credit + 1e-6) AS goods_credit_ratio,
          amt_goods_price - amt_credit AS credit_downpayment,
          -days_birth / 365e0 AS age_years,
          -nullif(days_employed, 365243) / 365e0 AS years_employed,
          nullif(days_employed, 365243) / (days_birth + 1e-6) AS days_employed_ratio,
          -days_id_publish / 365e0 AS years_id_publish,
          -days_last_phone_change / 365e0 AS years_last_phone_change
        FROM application""",
    "bureau_hist": """
        SELECT sk_id_curr, max(CASE WHEN credit_day_overdue > 0 THEN 1 ELSE 0 END) AS bureau_bad_debt_flag,
          avg(amt_credit_sum_overdue) AS bureau_overdue_mean
        FROM bureau GROUP BY sk_id_curr""",
    "prev_hist": """
        SELECT sk_id_curr, sum(CASE WHEN name_contract_status = 'Refused' THEN 1 ELSE 0 END) / (count(*) + 1e-6) AS prev_refused_ratio
        FROM previous_application GROUP BY sk_id_curr""",
    "inst_hist": """
        SELECT sk_id_curr, sum(CASE WHEN days_entry_payment - days_instalment > 0 THEN 1 ELSE 0 END)
          / (count(days_entry_payment) + 1e-6) AS inst_late_ratio
        FROM installments GROUP BY sk_id_curr""",
    "with_history": """
        SELECT b.*, bureau_bad_debt_flag, bureau_overdue_mean, prev_refused_ratio, inst_late_ratio
        FROM base_app b LEFT JOIN bureau_hist USING (sk_id_curr) LEFT JOIN prev_hist USING (sk_id_curr)
          LEFT JOIN inst_hist USING (sk_id_curr)""",
    "hist_filled": """
        SELECT * REPLACE (coalesce(inst_late_ratio, 0) AS inst_late_ratio, coalesce(prev_refused_ratio, 0) AS prev_refused_ratio) FROM with_history""",
    "valued": """
        SELECT *,
          CASE WHEN pred_prob > 7e-1 THEN 3
               WHEN pred_prob > 2e-1 OR coalesce(bureau_bad_debt_flag, 0) = 1 OR coalesce(inst_late_ratio, 0) > 3e-1
                 OR coalesce(prev_refused_ratio, 0) > 5e-1 THEN 2 ELSE 1 END AS stage,
          least(greatest((CASE WHEN coalesce(amt_goods_price, 0) / greatest(amt_credit, 1e0) > 7e-1
              THEN CASE name_contract_type WHEN 'Cash loans' THEN 55e-2 WHEN 'Revolving loans' THEN 7e-1 WHEN 'Consumer loans' THEN 45e-2 ELSE 65e-2 END
              ELSE CASE name_contract_type WHEN 'Cash loans' THEN 75e-2 WHEN 'Revolving loans' THEN 85e-2 WHEN 'Consumer loans' THEN 65e-2 ELSE 65e-2 END END)
            - least(greatest(coalesce(amt_goods_price, 0) - greatest(amt_credit, 1e0), 0)
                / greatest(coalesce(amt_goods_price, 0), 1e0), 5e-1) * 4e-1, 2e-1), 95e-2) AS lgd,
          greatest(amt_credit + CASE WHEN name_contract_type = 'Revolving loans' THEN 75e-2 * (amt_credit * 2e-1) ELSE 0 END, 0) AS ead,
          least(greatest(pred_prob, 1e-3), 999e-3) AS pd_12m,
          CASE WHEN credit_term IS NULL THEN 36e0 ELSE least(greatest(credit_term, 6e0), 12e1) END AS term_months
        FROM with_history""",
    "with_pd": """
        SELECT *, least(greatest(1e0 - pow(1e0 - pd_12m, term_months / 12e0), pd_12m), 999e-3) AS pd_lifetime FROM valued""",
    "with_scenarios": f"SELECT *, {_scenario_columns()} FROM with_pd",
    "with_macro": f"""
        SELECT *, {_blend('pd_12m')} AS pd_12m_macro, {_blend('pd_lifetime')} AS pd_lifetime_macro FROM with_scenarios""",
    "portfolio": """
        SELECT *, CASE stage WHEN 1 THEN pd_12m_macro WHEN 2 THEN pd_lifetime_macro ELSE 1e0 END * lgd * ead AS ecl,
          CASE stage WHEN 1 THEN pd_12m_macro WHEN 2 THEN pd_lifetime_macro ELSE 1e0 END * lgd * ead / greatest(ead, 1e0) AS ecl_rate
        FROM with_macro""",
    "tier_marks": "SELECT quantile_cont(pred_prob, [0.4, 0.65, 0.85]) AS q FROM application WHERE is_train = 1",
    "tiered": """
        SELECT p.*, CASE WHEN pred_prob <= q[1] THEN 'Very Low' WHEN pred_prob <= q[2] THEN 'Low'
          WHEN pred_prob <= q[3] THEN 'Medium' ELSE 'High' END AS risk_tier
        FROM portfolio p, tier_marks""",
    "tiered_app": """
        SELECT p.*, CASE WHEN pred_prob <= q[1] THEN 'Very Low' WHEN pred_prob <= q[2] THEN 'Low'
          WHEN pred_prob <= q[3] THEN 'Medium' ELSE 'High' END AS risk_tier
        FROM base_app p, tier_marks""",
}
