"""Cleaning queries: each rule on its own, and the cleaned tables as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import spread
from lendmill.operators import clean
from lendmill.plans.portfolio import installments
from lendmill.plans.registry import query
from lendmill.session import materialize
from lendmill.sources.domain import Domain

PREV_DAYS = ["days_first_drawing", "days_first_due", "days_last_due", "days_termination"]


@query("cln_sentinel_flag", sql="""
    SELECT sk_id_curr, nullif(days_employed, 365243) AS days_employed, CASE WHEN days_employed = 365243 THEN 1 ELSE 0 END AS emp_anomaly FROM application""")
def cln_sentinel_flag(dom: Domain) -> DataFrame:
    return clean.flag_sentinel(dom.application.select("sk_id_curr", "days_employed"), "days_employed", "emp_anomaly")


@query("cln_sentinel_multi", sql="SELECT sk_id_prev, " + ", ".join(f"nullif({c}, 365243) AS {c}" for c in PREV_DAYS) + " FROM previous_application")
def cln_sentinel_multi(dom: Domain) -> DataFrame:
    return clean.sentinel_to_null(dom.previous.select("sk_id_prev", *PREV_DAYS), clean.PREVIOUS_SENTINELS)


@query("cln_recode", sql="""
    SELECT 'application' AS tbl, CASE WHEN code_gender = 'XNA' THEN 'Unknown' ELSE code_gender END AS value, count(*) AS n_rows FROM application GROUP BY 2
    UNION ALL SELECT 'pos_cash', CASE WHEN name_contract_status = 'XNA' THEN 'Unknown' ELSE name_contract_status END, count(*) FROM pos_cash GROUP BY 2""")
def cln_recode(dom: Domain) -> DataFrame:
    out = None
    for name, df, column in [("application", dom.application, "code_gender"), ("pos_cash", dom.pos_cash, "name_contract_status")]:
        part = clean.recode(df, column).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
        part = part.select(F.lit(name).alias("tbl"), "value", "n_rows")
        out = part if out is None else out.union(part)
    return out


_GAP_COLUMNS = ["occupation_type", "own_car_age", "ext_source_1", "ext_source_3", "amt_goods_price", "amt_credit"]


@query("cln_drop_sparse", sql="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, (count(*) - count({c})) * 1e0 / count(*) AS missing_rate FROM application" for c in _GAP_COLUMNS)
    + ") WHERE missing_rate <= 4e-1 OR column_name IN ('ext_source_1', 'ext_source_2', 'ext_source_3')", digits={"missing_rate": 6})
def cln_drop_sparse(dom: Domain) -> DataFrame:
    """The columns that stay, with their missing share."""
    kept = clean.drop_sparse(dom.application.select(*_GAP_COLUMNS), 0.40, clean.ApplicationCleaning().keep)
    one = kept.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in kept.columns])
    return spread(one, {"missing_rate": "double"}, {c: {"missing_rate": F.col(c)} for c in kept.columns}, name="column_name")


@query("cln_drop_named", sql="SELECT sk_id_prev, name_contract_status, amt_credit FROM previous_application")
def cln_drop_named(dom: Domain) -> DataFrame:
    df = dom.previous.select("sk_id_prev", "name_contract_status", "amt_credit", "rate_interest_primary", "rate_interest_privileged")
    return clean.drop_named(df, ["rate_interest_primary", "rate_interest_privileged"])


_EXT = ["ext_source_1", "ext_source_2", "ext_source_3", "amt_goods_price"]


@query("cln_impute_median", sql="SELECT sk_id_curr, " + ", ".join(
    f"coalesce({c}, (SELECT median({c}) FROM application)) AS {c}" for c in _EXT) + " FROM application", digits=dict.fromkeys(_EXT, 6))
def cln_impute_median(dom: Domain) -> DataFrame:
    return clean.impute_median(dom.application.select("sk_id_curr", *_EXT), _EXT)


@query("cln_impute_mode", sql="""
    SELECT coalesce(occupation_type, (SELECT occupation_type FROM application WHERE occupation_type IS NOT NULL
      GROUP BY occupation_type ORDER BY count(*) DESC, occupation_type LIMIT 1)) AS occupation_type, count(*) AS n_rows FROM application GROUP BY 1""")
def cln_impute_mode(dom: Domain) -> DataFrame:
    filled = clean.impute_mode(dom.application.select("occupation_type"), ["occupation_type"])
    return filled.groupBy("occupation_type").agg(F.count(F.lit(1)).alias("n_rows"))


@query("cln_impute_zero", sql="""
    SELECT sk_id_curr, coalesce(amt_drawings_current, 0) AS amt_drawings_current FROM credit_card""", digits={"amt_drawings_current": 6})
def cln_impute_zero(dom: Domain) -> DataFrame:
    return clean.impute_zero(dom.credit_card.select("sk_id_curr", "amt_drawings_current"), clean.CARD_ZERO)


@query("cln_impute_fallback", sql="""
    SELECT sk_id_curr, coalesce(ext_source_1, (SELECT median(ext_source_1) FROM application)) AS ext_source_1,
      coalesce(days_last_phone_change, (SELECT median(days_last_phone_change) FROM application)) AS days_last_phone_change,
      coalesce(occupation_type, (SELECT occupation_type FROM application WHERE occupation_type IS NOT NULL
        GROUP BY occupation_type ORDER BY count(*) DESC, occupation_type LIMIT 1)) AS occupation_type, 'Unknown' AS no_text FROM application""",
    digits={"ext_source_1": 6, "days_last_phone_change": 2})
def cln_impute_fallback(dom: Domain) -> DataFrame:
    df = dom.application.select("sk_id_curr", "ext_source_1", "days_last_phone_change", "occupation_type", F.lit(None).cast("string").alias("no_text"))
    return clean.impute_rest(df)


@query("cln_cap_quantile", sql="""
    SELECT sk_id_curr, least(amt_income_total, (SELECT quantile_cont(amt_income_total, 0.99) FROM application)) AS amt_income_total FROM application""",
    digits={"amt_income_total": 4})
def cln_cap_quantile(dom: Domain) -> DataFrame:
    return clean.cap_quantile(dom.application.select("sk_id_curr", "amt_income_total"), "amt_income_total")


@query("cln_cap_const", sql="""
    SELECT sk_id_curr, CASE WHEN amt_req_credit_bureau_qrt IS NOT NULL THEN least(amt_req_credit_bureau_qrt, 12e0) END AS amt_req_credit_bureau_qrt,
      least(def_30_cnt_social_circle, 2e1) AS def_30_cnt_social_circle, least(obs_30_cnt_social_circle, 1e2) AS obs_30_cnt_social_circle FROM application""")
def cln_cap_const(dom: Domain) -> DataFrame:
    df = dom.application.select("sk_id_curr", "amt_req_credit_bureau_qrt", "def_30_cnt_social_circle", "obs_30_cnt_social_circle")
    return clean.cap_at(df, clean.ApplicationCleaning().caps)


@query("cln_floor_zero", sql="SELECT sk_id_prev, greatest(coalesce(amt_down_payment, 0), 0) AS amt_down_payment FROM previous_application",
       digits={"amt_down_payment": 6})
def cln_floor_zero(dom: Domain) -> DataFrame:
    return clean.floor_zero(dom.previous.select("sk_id_prev", "amt_down_payment"), ["amt_down_payment"])


@query("cln_clip_range", sql="""
    SELECT sk_id_prev, CASE WHEN rate_down_payment IS NOT NULL THEN least(greatest(rate_down_payment, 0), 1) END AS rate_down_payment
    FROM previous_application""", digits={"rate_down_payment": 6})
def cln_clip_range(dom: Domain) -> DataFrame:
    return clean.clip_range(dom.previous.select("sk_id_prev", "rate_down_payment"), ["rate_down_payment"])


@query("cln_zero_to_median", sql="""
    SELECT sk_id_bureau, CASE WHEN amt_credit_sum = 0 THEN (SELECT median(amt_credit_sum) FROM bureau WHERE amt_credit_sum <> 0) ELSE amt_credit_sum END
      AS amt_credit_sum FROM bureau""", digits={"amt_credit_sum": 4})
def cln_zero_to_median(dom: Domain) -> DataFrame:
    return clean.zero_to_median(dom.bureau.select("sk_id_bureau", "amt_credit_sum"), "amt_credit_sum")


@query("cln_payment_diff", sql="SELECT sk_id_prev, amt_instalment - amt_payment AS payment_diff FROM installments", digits={"payment_diff": 6})
def cln_payment_diff(dom: Domain) -> DataFrame:
    return clean.payment_difference(dom.installments).select("sk_id_prev", "payment_diff")


@query("cln_days_past_due", sql="""
    SELECT sk_id_prev, CASE WHEN days_entry_payment IS NOT NULL THEN greatest(days_entry_payment - days_instalment, 0)::DOUBLE END AS days_past_due
    FROM installments""")
def cln_days_past_due(dom: Domain) -> DataFrame:
    return clean.days_past_due(dom.installments).select("sk_id_prev", "days_past_due")


@query("cln_utilization", sql="""
    SELECT sk_id_prev, CASE WHEN amt_credit_limit_actual > 0 THEN least(amt_balance / amt_credit_limit_actual, 2e0) ELSE 0e0 END AS utilization_ratio
    FROM credit_card""", digits={"utilization_ratio": 8})
def cln_utilization(dom: Domain) -> DataFrame:
    return clean.utilization(dom.credit_card).select("sk_id_prev", "utilization_ratio")


@query("cln_assert_no_nulls", sql="""
    SELECT * FROM (VALUES ('application', 0::BIGINT), ('bureau', 0), ('previous_application', 0), ('installments', 0), ('pos_cash', 0), ('credit_card', 0))
    AS v(tbl, n_null)""")
def cln_assert_no_nulls(dom: Domain) -> DataFrame:
    """Every cleaned table, whole: no null may be left."""
    tables = {
        "application": clean.clean_applications(materialize(dom.application, "application")), "bureau": clean.clean_bureau(dom.bureau),
        "previous_application": clean.clean_previous(dom.previous), "installments": clean.clean_installments(installments(dom)),
        "pos_cash": clean.clean_pos(dom.pos_cash), "credit_card": clean.clean_card(dom.credit_card),
    }
    out = None
    for name, df in tables.items():
        part = clean.remaining_nulls(df).select(F.lit(name).alias("tbl"), "n_null")
        out = part if out is None else out.union(part)
    return out


_MEDIANS = ["days_employed", "ext_source_1", "ext_source_3", "amt_goods_price", "days_last_phone_change"]


@query("cln_application", sql=f"""
    SELECT sk_id_curr, emp_anomaly, CASE WHEN code_gender = 'XNA' THEN 'Unknown' ELSE code_gender END AS code_gender,
      {', '.join(f'coalesce({c}, m_{c}) AS {c}' for c in _MEDIANS)}, least(amt_income_total, p99) AS amt_income_total,
      least(coalesce(amt_req_credit_bureau_qrt, m_qrt), 12e0) AS amt_req_credit_bureau_qrt, coalesce(b.occupation_type, o.occupation_type) AS occupation_type
    FROM base_app b JOIN (SELECT is_train, {', '.join(f'median({c}) AS m_{c}' for c in _MEDIANS)}, quantile_cont(amt_income_total, 0.99) AS p99,
        median(least(amt_req_credit_bureau_qrt, 12e0)) FILTER (WHERE amt_req_credit_bureau_qrt IS NOT NULL) AS m_qrt FROM base_app GROUP BY is_train) m ON m.is_train = b.is_train
      LEFT JOIN (SELECT is_train, occupation_type, row_number() OVER (PARTITION BY is_train ORDER BY count(*) DESC, occupation_type) AS k
        FROM application WHERE occupation_type IS NOT NULL GROUP BY is_train, occupation_type) o ON o.is_train = b.is_train AND o.k = 1""",
    digits={"days_employed": 2, "ext_source_1": 6, "ext_source_3": 6, "amt_goods_price": 4, "days_last_phone_change": 2, "amt_income_total": 4})
def cln_application(dom: Domain) -> DataFrame:
    """The whole application cleaner, train and test apart; the car age column goes, being mostly empty."""
    out = clean.clean_applications(materialize(dom.application, "application"))
    if "own_car_age" in out.columns:
        raise ValueError("the sparse column survived")
    return out.select("sk_id_curr", "emp_anomaly", "code_gender", "days_employed", "ext_source_1", "ext_source_3", "amt_goods_price",
                      "days_last_phone_change", "amt_income_total", "amt_req_credit_bureau_qrt", "occupation_type")
