"""Feature projections, child rollups and the joins that assemble them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators import clean, encode, features, joins, rollups
from lendmill.operators.explain import sample_rows, join_scores
from lendmill.plans.portfolio import base, bureau_history, feature_table, previous_history, with_history, with_tier
from lendmill.plans.registry import query
from lendmill.sources.domain import Domain

RATIOS = ["credit_income_ratio", "annuity_income_ratio", "credit_term", "goods_credit_ratio", "credit_downpayment"]
YEARS = ["age_years", "years_employed", "days_employed_ratio", "years_id_publish", "years_last_phone_change"]


@query("fea_ratios", sql=f"SELECT sk_id_curr, {', '.join(RATIOS)} FROM base_app", digits=dict.fromkeys(RATIOS, 6))
def fea_ratios(dom: Domain) -> DataFrame:
    return features.add_ratios(dom.application).select("sk_id_curr", *RATIOS)


@query("fea_years", sql=f"SELECT sk_id_curr, {', '.join(YEARS)} FROM base_app", digits=dict.fromkeys(YEARS, 6))
def fea_years(dom: Domain) -> DataFrame:
    return base(dom).select("sk_id_curr", *YEARS)


@query("fea_doc_sum", sql="SELECT sk_id_curr, flag_document_3 + flag_document_6 AS flag_docs_sum FROM application")
def fea_doc_sum(dom: Domain) -> DataFrame:
    return features.add_doc_sum(dom.application).select("sk_id_curr", "flag_docs_sum")


@query("fea_child_ratio", sql="SELECT sk_id_curr, cnt_children / greatest(cnt_fam_members, 1) AS cnt_children_ratio FROM application",
       digits={"cnt_children_ratio": 6})
def fea_child_ratio(dom: Domain) -> DataFrame:
    return features.add_child_ratio(dom.application).select("sk_id_curr", "cnt_children_ratio")


STRESS = ["stress_age_x_credit", "stress_emp_x_annuity", "stress_docs_x_credit"]


@query("fea_interactions", sql="""
    SELECT sk_id_curr, age_years * credit_income_ratio AS stress_age_x_credit,
      CASE WHEN years_employed IS NOT NULL THEN greatest(years_employed, 0) * annuity_income_ratio END AS stress_emp_x_annuity,
      (flag_document_3 + flag_document_6) * credit_income_ratio AS stress_docs_x_credit FROM base_app""", digits=dict.fromkeys(STRESS, 6))
def fea_interactions(dom: Domain) -> DataFrame:
    return features.add_interactions(base(dom)).select("sk_id_curr", *STRESS)


@query("fea_bureau_quality", sql="""
    SELECT h.sk_id_curr, (1 - least(greatest(coalesce(bureau_overdue_mean, 0), 0) / (m.p99 + 1e-6), 1)) * 4e-1
      + (1 - least(coalesce(prev_refused_ratio, 0), 1)) * 35e-2 + (1 - least(coalesce(inst_late_ratio, 0), 1)) * 25e-2 AS bureau_quality_composite
    FROM with_history h, (SELECT quantile_cont(greatest(coalesce(bureau_overdue_mean, 0), 0), 0.99) AS p99 FROM with_history) m""",
    digits={"bureau_quality_composite": 6})
def fea_bureau_quality(dom: Domain) -> DataFrame:
    """On filled rollups: no history counts as 0."""
    history = ["bureau_overdue_mean", "prev_refused_ratio", "inst_late_ratio"]
    rows = feature_table(joins.fill_no_history(with_history(dom), history), ["sk_id_curr", *history])
    return features.add_bureau_quality(rows).select("sk_id_curr", "bureau_quality_composite")


@query("fea_clean_high_lti", sql="""
    SELECT sk_id_curr, CASE WHEN coalesce(bureau_bad_debt_flag, 0) = 0 AND credit_income_ratio > 5 THEN 1 ELSE 0 END AS clean_bureau_high_lti
    FROM with_history""")
def fea_clean_high_lti(dom: Domain) -> DataFrame:
    rows = joins.fill_no_history(with_history(dom), ["bureau_bad_debt_flag"])
    return features.add_clean_high_lti(rows).select("sk_id_curr", "clean_bureau_high_lti")


EXT = ["ext_source_mean", "ext_source_min", "ext_source_product", "ext_source_std"]


@query("fea_ext_composites", sql="""
    SELECT sk_id_curr, list_avg(x) AS ext_source_mean, list_min(x) AS ext_source_min, list_product(x) AS ext_source_product,
      coalesce(list_stddev_samp(x), 0) AS ext_source_std
    FROM (SELECT sk_id_curr, list_filter([ext_source_1, ext_source_2, ext_source_3], lambda v: v IS NOT NULL) AS x FROM application)""",
    digits=dict.fromkeys(EXT, 6))
def fea_ext_composites(dom: Domain) -> DataFrame:
    return features.add_ext_composites(dom.application).select("sk_id_curr", *EXT)


@query("fea_sanitize_names", sql="""SELECT sk_id_curr AS id_of_client, amt_credit AS amt_credit_usd_, name_income_type AS income_type FROM application""")
def fea_sanitize_names(dom: Domain) -> DataFrame:
    rows = dom.application.select(
        F.col("sk_id_curr").alias("id of client"), F.col("amt_credit").alias("amt credit (usd)"), F.col("name_income_type").alias("income/type")
    )
    return features.sanitize_names(rows)


def _sides(dom: Domain) -> DataFrame:
    app = dom.application.select("sk_id_curr", "is_train", "target", "amt_credit", "own_car_age")
    train = app.filter("is_train = 1").drop("is_train")
    test = app.filter("is_train = 0").drop("is_train", "own_car_age")
    return features.union_train_test(train, test)


@query("fea_train_test_union", sql="""
    SELECT sk_id_curr, CASE WHEN is_train = 1 THEN target END AS target, amt_credit, CASE WHEN is_train = 1 THEN own_car_age END AS own_car_age, is_train
    FROM application""")
def fea_train_test_union(dom: Domain) -> DataFrame:
    return _sides(dom)


@query("fea_split_back", sql="""
    SELECT CASE WHEN is_train = 1 THEN 'train' ELSE 'test' END AS side, count(*) AS n_rows, count(*) FILTER (WHERE is_train = 0) AS n_missing_target,
      CASE WHEN is_train = 1 THEN 4 ELSE 3 END AS n_columns FROM application GROUP BY is_train""")
def fea_split_back(dom: Domain) -> DataFrame:
    rows = _sides(dom)
    train, test = features.split_train_test(rows)
    columns = F.when(F.col("side") == "train", len(train.columns)).otherwise(len(test.columns))
    return features.split_summary(rows).withColumn("n_columns", columns)


# ---- rollups --------------------------------------------------------------------------------

BUREAU_MONEY = {"bureau_credit_sum": 4, "bureau_credit_mean": 4, "bureau_credit_max": 4, "bureau_debt_sum": 4, "bureau_overdue_mean": 4,
                "bureau_overdue_max": 4, "bureau_days_credit_mean": 6}
_BUREAU_SQL = """
    SELECT sk_id_curr, count(sk_id_bureau) AS bureau_loan_count, count(*) FILTER (WHERE credit_active = 'Active') AS bureau_active_count,
      count(*) FILTER (WHERE credit_active = 'Closed') AS bureau_closed_count, sum(amt_credit_sum) AS bureau_credit_sum, avg(amt_credit_sum) AS bureau_credit_mean,
      max(amt_credit_sum) AS bureau_credit_max, coalesce(sum(amt_credit_sum_debt), 0) AS bureau_debt_sum, avg(amt_credit_sum_overdue) AS bureau_overdue_mean,
      max(amt_credit_sum_overdue) AS bureau_overdue_max, avg(days_credit) AS bureau_days_credit_mean, max(days_credit_enddate) AS bureau_days_enddate_max,
      count(*) FILTER (WHERE credit_day_overdue > 0) AS bureau_bad_debt_count, max(credit_day_overdue) AS bureau_overdue_days_max,
      sum(cnt_credit_prolong)::BIGINT AS bureau_prolong_sum FROM bureau GROUP BY sk_id_curr"""


@query("agg_bureau", sql=_BUREAU_SQL, digits=BUREAU_MONEY)
def agg_bureau(dom: Domain) -> DataFrame:
    return rollups.bureau_rollup(dom.bureau)


@query("agg_bureau_derived", sql=f"""
    SELECT sk_id_curr, CASE WHEN bureau_bad_debt_count > 0 THEN 1 ELSE 0 END AS bureau_bad_debt_flag,
      bureau_active_count / (bureau_loan_count + 1e-6) AS bureau_active_ratio, bureau_debt_sum / (bureau_credit_sum + 1e-6) AS bureau_debt_credit_ratio
    FROM ({_BUREAU_SQL})""", digits={"bureau_active_ratio": 6, "bureau_debt_credit_ratio": 6})
def agg_bureau_derived(dom: Domain) -> DataFrame:
    return rollups.bureau_derived(rollups.bureau_rollup(dom.bureau)).select(
        "sk_id_curr", "bureau_bad_debt_flag", "bureau_active_ratio", "bureau_debt_credit_ratio")


_PREV_SQL = """
    SELECT sk_id_curr, count(sk_id_prev) AS prev_app_count, count(*) FILTER (WHERE name_contract_status = 'Approved') AS prev_approved_count,
      count(*) FILTER (WHERE name_contract_status = 'Refused') AS prev_refused_count, count(*) FILTER (WHERE name_contract_status = 'Canceled') AS prev_canceled_count,
      avg(amt_credit) AS prev_credit_mean, max(amt_credit) AS prev_credit_max, avg(amt_annuity) AS prev_annuity_mean,
      avg(amt_down_payment) AS prev_down_payment_mean, avg(days_decision) AS prev_days_decision_mean,
      count(*) FILTER (WHERE name_contract_type = 'Consumer loans') AS prev_consumer_count, count(*) FILTER (WHERE name_contract_type = 'Cash loans') AS prev_cash_count,
      count(*) FILTER (WHERE name_contract_type = 'Revolving loans') AS prev_revolving_count FROM previous_application GROUP BY sk_id_curr"""


@query("agg_prev", sql=_PREV_SQL, digits={"prev_credit_mean": 4, "prev_credit_max": 4, "prev_annuity_mean": 4, "prev_down_payment_mean": 4, "prev_days_decision_mean": 6})
def agg_prev(dom: Domain) -> DataFrame:
    return rollups.previous_rollup(dom.previous)


_PREV_RATIOS = ["refused", "approved", "canceled", "consumer"]


@query("agg_prev_derived", sql="SELECT sk_id_curr, " + ", ".join(f"prev_{s}_count / (prev_app_count + 1e-6) AS prev_{s}_ratio" for s in _PREV_RATIOS)
       + f" FROM ({_PREV_SQL})", digits={f"prev_{s}_ratio": 6 for s in _PREV_RATIOS})
def agg_prev_derived(dom: Domain) -> DataFrame:
    return rollups.previous_derived(rollups.previous_rollup(dom.previous)).select("sk_id_curr", *[f"prev_{s}_ratio" for s in _PREV_RATIOS])


@query("agg_inst", sql="""
    SELECT sk_id_curr, avg(diff) AS inst_payment_diff_mean, max(diff) AS inst_payment_diff_max, sum(diff) AS inst_payment_diff_sum,
      avg(dpd) AS inst_days_past_due_mean, max(dpd) AS inst_days_past_due_max, count(*) FILTER (WHERE dpd > 0) AS inst_late_payment_count,
      count(*) FILTER (WHERE dpd = 0) AS inst_on_time_count, count(dpd) AS inst_total_count, avg(paid) AS inst_amt_payment_mean,
      avg(amt_instalment) AS inst_amt_instalment_mean, count(*) FILTER (WHERE dpd > 0) / (count(dpd) + 1e-6) AS inst_late_ratio
    FROM (SELECT sk_id_curr, amt_instalment, coalesce(amt_payment, m_pay) AS paid, amt_instalment - coalesce(amt_payment, m_pay) AS diff,
        greatest(coalesce(days_entry_payment, m_day) - days_instalment, 0)::DOUBLE AS dpd
      FROM installments, (SELECT median(amt_payment) AS m_pay, median(days_entry_payment) AS m_day FROM installments))
    GROUP BY sk_id_curr""",
    digits={"inst_payment_diff_mean": 4, "inst_payment_diff_max": 4, "inst_payment_diff_sum": 4, "inst_days_past_due_mean": 6, "inst_days_past_due_max": 2,
            "inst_amt_payment_mean": 4, "inst_amt_instalment_mean": 4, "inst_late_ratio": 6})
def agg_inst(dom: Domain) -> DataFrame:
    return rollups.installments_rollup(clean.clean_installments(dom.installments))


@query("agg_pos", sql="""
    SELECT sk_id_curr, avg(dpd) AS pos_dpd_mean, max(dpd) AS pos_dpd_max, avg(dpd_def) AS pos_dpd_def_mean, max(dpd_def) AS pos_dpd_def_max,
      count(months_balance) AS pos_months_count, avg(cnt) AS pos_cnt_instalment_mean, count(*) FILTER (WHERE name_contract_status = 'Active') AS pos_active_count,
      count(*) FILTER (WHERE name_contract_status = 'Completed') AS pos_completed_count, count(*) FILTER (WHERE dpd > 0) AS pos_late_count,
      count(*) FILTER (WHERE name_contract_status = 'Completed') / (count(months_balance) + 1e-6) AS pos_completed_ratio,
      count(*) FILTER (WHERE dpd > 0) / (count(months_balance) + 1e-6) AS pos_late_ratio
    FROM (SELECT *, least(sk_dpd, 365e0) AS dpd, least(sk_dpd_def, 365e0) AS dpd_def, coalesce(cnt_instalment, m) AS cnt
      FROM pos_cash, (SELECT median(cnt_instalment) AS m FROM pos_cash)) GROUP BY sk_id_curr""",
    digits={"pos_dpd_mean": 6, "pos_dpd_def_mean": 6, "pos_cnt_instalment_mean": 6, "pos_completed_ratio": 6, "pos_late_ratio": 6})
def agg_pos(dom: Domain) -> DataFrame:
    return rollups.pos_rollup(clean.clean_pos(dom.pos_cash))


@query("agg_card", sql="""
    SELECT sk_id_curr, avg(amt_balance) AS cc_balance_mean, max(amt_balance) AS cc_balance_max, avg(amt_credit_limit_actual) AS cc_limit_mean,
      max(amt_credit_limit_actual) AS cc_limit_max, avg(util) AS cc_utilization_mean, max(util) AS cc_utilization_max, avg(dpd) AS cc_dpd_mean, max(dpd) AS cc_dpd_max,
      avg(dpd_def) AS cc_dpd_def_mean, count(months_balance) AS cc_months_count, avg(drawn) AS cc_drawings_mean, max(drawn) AS cc_drawings_max,
      avg(amt_payment_current) AS cc_payment_mean, count(*) FILTER (WHERE dpd > 0) AS cc_late_count,
      count(*) FILTER (WHERE dpd > 0) / (count(months_balance) + 1e-6) AS cc_late_ratio
    FROM (SELECT *, least(sk_dpd, 365e0) AS dpd, least(sk_dpd_def, 365e0) AS dpd_def, coalesce(amt_drawings_current, 0) AS drawn,
        CASE WHEN amt_credit_limit_actual > 0 THEN least(amt_balance / amt_credit_limit_actual, 2e0) ELSE 0e0 END AS util FROM credit_card)
    GROUP BY sk_id_curr""",
    digits={"cc_balance_mean": 4, "cc_balance_max": 4, "cc_limit_mean": 4, "cc_utilization_mean": 6, "cc_utilization_max": 6, "cc_dpd_mean": 6,
            "cc_dpd_def_mean": 6, "cc_drawings_mean": 4, "cc_drawings_max": 4, "cc_payment_mean": 4, "cc_late_ratio": 6})
def agg_card(dom: Domain) -> DataFrame:
    return rollups.card_rollup(clean.clean_card(dom.credit_card))


# ---- joins ----------------------------------------------------------------------------------


def _all_rollups(dom: Domain) -> list[DataFrame]:
    return [
        rollups.bureau_derived(rollups.bureau_rollup(clean.clean_bureau(dom.bureau))),
        rollups.previous_derived(rollups.previous_rollup(dom.previous)),
        rollups.installments_rollup(clean.days_past_due(clean.payment_difference(dom.installments))),
        rollups.pos_rollup(dom.pos_cash),
        rollups.card_rollup(clean.clean_card(dom.credit_card)),
    ]


_JOINED = """
    SELECT a.sk_id_curr, bureau_loan_count, prev_app_count, inst_total_count, pos_months_count, cc_months_count FROM application a
    LEFT JOIN (SELECT sk_id_curr, count(*) AS bureau_loan_count FROM bureau GROUP BY 1) b USING (sk_id_curr)
    LEFT JOIN (SELECT sk_id_curr, count(*) AS prev_app_count FROM previous_application GROUP BY 1) p USING (sk_id_curr)
    LEFT JOIN (SELECT sk_id_curr, count(days_entry_payment) AS inst_total_count FROM installments GROUP BY 1) i USING (sk_id_curr)
    LEFT JOIN (SELECT sk_id_curr, count(*) AS pos_months_count FROM pos_cash GROUP BY 1) s USING (sk_id_curr)
    LEFT JOIN (SELECT sk_id_curr, count(*) AS cc_months_count FROM credit_card GROUP BY 1) c USING (sk_id_curr)"""
COUNTS = ["bureau_loan_count", "prev_app_count", "inst_total_count", "pos_months_count", "cc_months_count"]


@query("joi_left_rollups", sql=_JOINED)
def joi_left_rollups(dom: Domain) -> DataFrame:
    joined = joins.attach_rollups(dom.application.select("sk_id_curr"), _all_rollups(dom))
    return joined.select("sk_id_curr", *COUNTS)


@query("joi_wide_features", sql="""
    SELECT count(*) AS n_rows, count(bureau_bad_debt_flag) AS n_bureau, sum(bureau_bad_debt_flag)::BIGINT AS n_bad, avg(prev_refused_ratio) AS mean_refused,
      avg(inst_late_ratio) AS mean_late, avg(credit_income_ratio) AS mean_lti,
      avg(pos_months) AS mean_pos_months, avg(cc_months) AS mean_cc_months, max(cc_top) AS top_balance
    FROM with_history LEFT JOIN (SELECT sk_id_curr, count(*) AS pos_months FROM pos_cash GROUP BY 1) USING (sk_id_curr)
      LEFT JOIN (SELECT sk_id_curr, count(*) AS cc_months, max(amt_balance) AS cc_top FROM credit_card GROUP BY 1) USING (sk_id_curr)""",
    digits={"mean_refused": 6, "mean_late": 6, "mean_lti": 6, "mean_pos_months": 6, "mean_cc_months": 6, "top_balance": 4})
def joi_wide_features(dom: Domain) -> DataFrame:
    """The full feature table: application features and all five rollups, summarised."""
    wide = joins.attach_rollups(base(dom), _all_rollups(dom))
    return wide.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("bureau_bad_debt_flag").alias("n_bureau"), F.sum("bureau_bad_debt_flag").alias("n_bad"),
        F.avg("prev_refused_ratio").alias("mean_refused"), F.avg("inst_late_ratio").alias("mean_late"), F.avg("credit_income_ratio").alias("mean_lti"),
        F.avg("pos_months_count").alias("mean_pos_months"), F.avg("cc_months_count").alias("mean_cc_months"), F.max("cc_balance_max").alias("top_balance"),
    )


@query("joi_rowcount_guard", sql=" UNION ALL ".join(
    f"""SELECT '{n}' AS rollup, count(*) AS n_keys, sum(n - 1)::BIGINT AS n_repeats, CASE WHEN sum(n - 1) = 0 THEN 1 ELSE 0 END AS keeps_rows
      FROM (SELECT count(*) AS n FROM ({s}) GROUP BY sk_id_curr)"""
    for n, s in [("bureau", "SELECT sk_id_curr FROM bureau_hist"), ("previous", "SELECT sk_id_curr FROM prev_hist"), ("raw_bureau", "SELECT sk_id_curr FROM bureau")]))
def joi_rowcount_guard(dom: Domain) -> DataFrame:
    """Two rollups that keep the row count, and the raw child table that would not."""
    return joins.row_count_guard(dom.application, {"bureau": bureau_history(dom), "previous": previous_history(dom), "raw_bureau": dom.bureau})


@query("joi_missing_after", sql="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (count(*) - count({c})) * 1e0 / count(*) AS missing_rate FROM ({_JOINED})" for c in COUNTS) + ") WHERE missing_rate > 0",
    digits={"missing_rate": 6})
def joi_missing_after(dom: Domain) -> DataFrame:
    joined = joins.attach_rollups(dom.application.select("sk_id_curr"), _all_rollups(dom))
    return joins.missing_after_join(joined, COUNTS)


@query("joi_fill_no_history", sql=f"SELECT sk_id_curr, {', '.join(f'coalesce({c}, 0) AS {c}' for c in COUNTS)} FROM ({_JOINED})")
def joi_fill_no_history(dom: Domain) -> DataFrame:
    joined = joins.attach_rollups(dom.application.select("sk_id_curr"), _all_rollups(dom))
    return joins.fill_no_history(joined, COUNTS).select("sk_id_curr", *COUNTS)


TEXTS = ["occupation_type", "name_income_type", "name_education_type", "name_family_status", "code_gender"]


@query("joi_enrich_text", sql=f"SELECT sk_id_curr, pred_prob, {', '.join(TEXTS)} FROM application")
def joi_enrich_text(dom: Domain) -> DataFrame:
    """Scores enriched with five text columns of the raw table."""
    scored = dom.application.select("sk_id_curr", "pred_prob")
    return scored.join(dom.application.select("sk_id_curr", *TEXTS), "sk_id_curr", "left")


@query("joi_inner_mart", sql="SELECT sk_id_curr, pred_prob AS default_probability, risk_tier, amt_credit, name_income_type FROM tiered_app")
def joi_inner_mart(dom: Domain) -> DataFrame:
    scored = with_tier(dom.application.select("sk_id_curr", "pred_prob"), dom).withColumnRenamed("pred_prob", "default_probability")
    return scored.join(dom.application.select("sk_id_curr", "amt_credit", "name_income_type"), "sk_id_curr")


@query("joi_left_versioned", sql="""
    SELECT sk_id_curr, amt_credit, CASE WHEN target = 1 THEN pred_prob END AS default_probability FROM application""")
def joi_left_versioned(dom: Domain) -> DataFrame:
    """Only predictions of one version match; the others leave nulls."""
    version = F.when(F.col("target") == 1, "v1").otherwise("v2")
    scored = dom.application.select(F.col("sk_id_curr").alias("p_id"), version.alias("model_version"), F.col("pred_prob").alias("default_probability"))
    app = dom.application.select("sk_id_curr", "amt_credit")
    match = (F.col("p_id") == F.col("sk_id_curr")) & (F.col("model_version") == "v1")
    return app.join(scored, match, "left").select("sk_id_curr", "amt_credit", "default_probability")


_HASH = "((sk_id_curr + 42) * 48271) % 2147483647"


@query("joi_sample_scores", sql=f"""
    SELECT sk_id_curr, pred_prob, risk_tier, target FROM tiered_app WHERE sk_id_curr IN
      (SELECT sk_id_curr FROM application ORDER BY {_HASH}, sk_id_curr LIMIT 10000) AND target = 1""")
def joi_sample_scores(dom: Domain) -> DataFrame:
    """A seeded sample; only defaults carry a score here, so the others drop out."""
    scored = with_tier(dom.application, dom).withColumn("pred_prob", F.when(F.col("target") == 1, F.col("pred_prob")))
    return join_scores(sample_rows(dom.application, 10_000, seed=42), scored)


@query("set_concat_rows", sql="""
    SELECT 'customer' AS kind, c_custkey AS key, c_acctbal AS amount, NULL::INTEGER AS nation FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, s_nationkey FROM supplier""")
def set_concat_rows(dom: Domain) -> DataFrame:
    """Frames with different columns stacked by name."""
    people = dom.table("customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount"))
    firms = dom.table("supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("amount"), F.col("s_nationkey").alias("nation"))
    return joins.concat_rows(people, firms)


# ---- the whole chain, from raw tables to a model table ---------------------------------------

_ENCODED = ["flag_own_car", "name_education_type"]
_EDUCATION = ["Higher education", "Incomplete higher", "Lower secondary", "Secondary / secondary special"]
_MEDIAN_FILLED = ["ext_source_1", "ext_source_3", "amt_goods_price", "goods_credit_ratio"]
_HISTORY = [*COUNTS, "prev_refused_ratio", "inst_late_ratio"]
_MODEL_NUMBERS = ["ext_source_2", "credit_income_ratio", "annuity_income_ratio", "credit_term", "age_years", *_MEDIAN_FILLED, *_HISTORY, *STRESS]
_MODEL_DIGITS = dict.fromkeys([c for c in _MODEL_NUMBERS if c not in COUNTS], 6)


def _wide_sql() -> str:
    education = ", ".join(f"CASE WHEN name_education_type = '{v}' THEN 1 ELSE 0 END AS {n}" for v, n in encode.one_hot_names("name_education_type", _EDUCATION).items())
    filled = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM base_app WHERE is_train = 1)) AS {c}" for c in _MEDIAN_FILLED)
    history = ", ".join(f"coalesce({c}, 0) AS {c}" for c in _HISTORY)
    return f"""SELECT h.sk_id_curr, is_train, CASE flag_own_car WHEN 'N' THEN 0 ELSE 1 END AS flag_own_car, {education}, ext_source_2, credit_income_ratio,
        annuity_income_ratio, credit_term, age_years, {filled}, {history}, age_years * credit_income_ratio AS stress_age_x_credit,
        CASE WHEN years_employed IS NULL THEN 0 ELSE greatest(years_employed, 0) * annuity_income_ratio END AS stress_emp_x_annuity,
        (flag_document_3 + flag_document_6) * credit_income_ratio AS stress_docs_x_credit
      FROM with_history h LEFT JOIN ({_JOINED}) j USING (sk_id_curr)"""


@query("fea_model_table", sql=_wide_sql(), digits=_MODEL_DIGITS)
def fea_model_table(dom: Domain) -> DataFrame:
    """All applications through the chain: ratios and years, five rollups, join, no-history fill, encoding, train medians, interactions.

    Encodings and medians are fitted on the train rows; the result is one numeric row per client.
    """
    wide = joins.attach_rollups(features.add_interactions(base(dom)), _all_rollups(dom))
    numbers = [c for c in _MODEL_NUMBERS if c not in _MEDIAN_FILLED]
    rows = feature_table(wide, ["sk_id_curr", "is_train", *_ENCODED, *numbers, *_MEDIAN_FILLED])
    rows = joins.fill_no_history(rows, [*_HISTORY, *STRESS])
    encoding = encode.fit_encoding(rows.filter("is_train = 1"), _ENCODED)
    rows = encode.encode_one_hot(encode.encode_binary(rows, encoding), encoding)
    rows = encode.impute_train_median(rows, _MEDIAN_FILLED)
    education = list(encode.one_hot_names("name_education_type", _EDUCATION).values())
    return rows.select("sk_id_curr", "is_train", "flag_own_car", *education, *numbers, *_MEDIAN_FILLED)
