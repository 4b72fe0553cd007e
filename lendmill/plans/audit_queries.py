"""Data-quality profile queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators import audit, clean
from lendmill.plans.registry import query
from lendmill.session import materialize
from lendmill.sources.domain import APPLICATION, BUREAU, Domain

_SHARES = {
    "target": "application", "code_gender": "application", "credit_active": "bureau", "credit_type": "bureau",
    "name_contract_status": "previous_application",
}


def _share_sql(column: str, table: str) -> str:
    return f"""SELECT '{table}.{column}' AS source, CAST({column} AS VARCHAR) AS value, count(*) AS n_rows,
      count(*) * 1e2 / (SELECT count(*) FROM {table}) AS pct FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}"""


@query("aud_value_share", sql=" UNION ALL ".join(_share_sql(c, t) for c, t in _SHARES.items())
       + " UNION ALL " + _share_sql("name_contract_status", "pos_cash"), digits={"pct": 6})
def aud_value_share(dom: Domain) -> DataFrame:
    tables = {
        "application": (dom.application, ["target", "code_gender"]), "bureau": (dom.bureau, ["credit_active", "credit_type"]),
        "previous_application": (dom.previous, ["name_contract_status"]), "pos_cash": (dom.pos_cash, ["name_contract_status"]),
    }
    out = None
    for table, (df, columns) in tables.items():
        shares = audit.value_share(df, columns)
        part = shares.select(F.concat(F.lit(f"{table}."), "column_name").alias("source"), "value", "n_rows", "pct")
        out = part if out is None else out.union(part)
    return out


@query("aud_full_dupes", sql="""
    SELECT sum(n)::BIGINT AS n_rows, sum(n - 1)::BIGINT AS n_duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey,
      l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS g""")
def aud_full_dupes(dom: Domain) -> DataFrame:
    return audit.duplicate_rows(dom.table("lineitem"))


@query("aud_key_dupes", sql="""
    SELECT count(*) AS n_rows, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_duplicates FROM lineitem""")
def aud_key_dupes(dom: Domain) -> DataFrame:
    return audit.duplicate_rows(dom.table("lineitem"), ["l_orderkey", "l_linenumber"])


# every column of the two tables
APP_COLUMNS, BUREAU_COLUMNS = list(APPLICATION), list(BUREAU)


def _missing(columns, table) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, (count(*) - count({c})) * 1e0 / count(*) AS missing_rate FROM {table}" for c in columns)


@query("aud_missing_rate", sql=f"""
    SELECT 'application' AS tbl, * FROM ({_missing(APP_COLUMNS, 'application')}) WHERE missing_rate > 0
    UNION ALL SELECT 'bureau', * FROM ({_missing(BUREAU_COLUMNS, 'bureau')}) WHERE missing_rate > 0""", digits={"missing_rate": 6})
def aud_missing_rate(dom: Domain) -> DataFrame:
    app = audit.missing_columns(dom.application).select(F.lit("application").alias("tbl"), "*")
    return app.union(audit.missing_columns(dom.bureau).select(F.lit("bureau").alias("tbl"), "*"))


@query("aud_missing_bands", sql=f"""
    SELECT CASE WHEN missing_rate > 4e-1 THEN 'over 40%' WHEN missing_rate > 15e-2 THEN '15-40%' ELSE '0-15%' END AS band,
      count(*) AS n_columns FROM ({_missing(APP_COLUMNS, 'application')}) WHERE missing_rate > 0 GROUP BY 1""")
def aud_missing_bands(dom: Domain) -> DataFrame:
    return audit.missing_bands(dom.application)


SENTINELS = ["days_first_drawing", "days_first_due", "days_last_due", "days_termination"]


@query("aud_sentinel", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} = 365243) AS n_sentinel,
      avg(CASE WHEN {c} = 365243 THEN 1e0 ELSE 0e0 END) * 100 AS pct_sentinel,
      min(CASE WHEN {c} <> 365243 THEN {c} END)::DOUBLE AS min_real, max(CASE WHEN {c} <> 365243 THEN {c} END)::DOUBLE AS max_real FROM {t}"""
    for c, t in [("days_employed", "application"), *[(c, "previous_application") for c in SENTINELS]]), digits={"pct_sentinel": 6})
def aud_sentinel(dom: Domain) -> DataFrame:
    return audit.sentinel_profile(dom.application, ["days_employed"]).union(audit.sentinel_profile(dom.previous, SENTINELS))


@query("aud_quantiles", sql="""
    SELECT max(amt_income_total) AS max_value, quantile_cont(amt_income_total, 0.99) AS p99, quantile_cont(amt_income_total, 0.999) AS p999,
      (SELECT count(*) FROM application WHERE amt_income_total > (SELECT quantile_cont(amt_income_total, 0.99) FROM application)) AS n_above_p99
    FROM application""", digits={"max_value": 4, "p99": 4, "p999": 4})
def aud_quantiles(dom: Domain) -> DataFrame:
    return audit.tail_quantiles(dom.application, "amt_income_total")


STAT_COLUMNS = ["ext_source_1", "ext_source_2", "ext_source_3", "amt_goods_price"]


@query("aud_col_stats", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, (count(*) - count({c})) * 1e2 / count(*) AS missing_pct, avg({c}) AS mean_value,
      min({c}) AS min_value, max({c}) AS max_value FROM application""" for c in STAT_COLUMNS)
    + """ UNION ALL SELECT 'amt_balance', (count(*) - count(amt_balance)) * 1e2 / count(*), avg(amt_balance), min(amt_balance), max(amt_balance)
      FROM credit_card""", digits={"missing_pct": 6, "mean_value": 5, "min_value": 4, "max_value": 4})
def aud_col_stats(dom: Domain) -> DataFrame:
    return audit.column_stats(dom.application, STAT_COLUMNS).union(audit.column_stats(dom.credit_card, ["amt_balance"]))


@query("aud_range_rules", sql="""
    SELECT 'age_under_18' AS rule, count(*) FILTER (WHERE -days_birth / 365e0 < 18) AS n_rows FROM application
    UNION ALL SELECT 'age_over_70', count(*) FILTER (WHERE -days_birth / 365e0 > 70) FROM application
    UNION ALL SELECT 'days_employed_positive', count(*) FILTER (WHERE days_employed > 0) FROM application
    UNION ALL SELECT 'days_credit_positive', count(*) FILTER (WHERE days_credit > 0) FROM bureau
    UNION ALL SELECT 'days_credit_enddate_positive', count(*) FILTER (WHERE days_credit_enddate > 0) FROM bureau""")
def aud_range_rules(dom: Domain) -> DataFrame:
    app = audit.rule_counts(dom.application, audit.range_rules(past_day="days_employed"))
    days = {f"{c}_positive": F.col(c) > 0 for c in ("days_credit", "days_credit_enddate")}
    return app.union(audit.rule_counts(dom.bureau, days))


@query("aud_flag_row_sum", sql="""
    SELECT 2 AS n_flags, count(*) FILTER (WHERE flag_document_3 + flag_document_6 = 0) AS n_without,
      max(flag_document_3 + flag_document_6)::BIGINT AS max_flags FROM application""")
def aud_flag_row_sum(dom: Domain) -> DataFrame:
    return audit.flag_row_sums(dom.application, ["flag_document_3", "flag_document_6"])


CATEGORIES = ["name_contract_type", "code_gender", "name_income_type", "name_family_status", "occupation_type", "weekday_appr_process_start"]


@query("aud_categorical", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct,
      (SELECT {c} FROM application WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top_value,
      (count(*) - count({c})) * 1e2 / count(*) AS missing_pct FROM application""" for c in CATEGORIES), digits={"missing_pct": 6})
def aud_categorical(dom: Domain) -> DataFrame:
    return audit.categorical_profile(dom.application, CATEGORIES)


Z_COLUMNS = ["amt_credit", "amt_goods_price", "days_employed", "amt_annuity", "ext_source_2"]


def _z_sql(table_column) -> str:
    table, c, limit = table_column
    return f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE abs(({c} - m) / s) > {limit}) AS n_extreme, max({c})::DOUBLE AS max_value
      FROM {table}, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {table})"""


@query("aud_zscore", sql="SELECT * FROM (" + " UNION ALL ".join(
    _z_sql((t, c, k)) for t, c, k in [*[("application", c, 2) for c in Z_COLUMNS], ("bureau", "credit_day_overdue", 2)]) + ") WHERE n_extreme > 0")
def aud_zscore(dom: Domain) -> DataFrame:
    """At two deviations: the driver tables have no value ten deviations out."""
    app = audit.zscore_outliers(dom.application, Z_COLUMNS, 2.0)
    return app.union(audit.zscore_outliers(dom.bureau, ["credit_day_overdue"], 2.0))


AMOUNTS = {"application": ["amt_credit", "amt_income_total", "amt_annuity", "amt_goods_price"], "credit_card": ["amt_balance", "amt_payment_current"],
           "previous_application": ["amt_down_payment", "amt_credit"]}


@query("aud_negatives", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS tbl, '{c}' AS column_name, count(*) FILTER (WHERE {c} < 0) AS n_negative FROM {t}" for t, cs in AMOUNTS.items() for c in cs))
def aud_negatives(dom: Domain) -> DataFrame:
    tables = {"application": dom.application, "credit_card": dom.credit_card, "previous_application": dom.previous}
    out = None
    for t, columns in AMOUNTS.items():
        part = audit.negative_counts(tables[t], columns).select(F.lit(t).alias("tbl"), "column_name", "n_negative")
        out = part if out is None else out.union(part)
    return out


@query("aud_zero_neg_max", sql="""
    SELECT 'amt_credit_sum' AS column_name, count(*) FILTER (WHERE amt_credit_sum = 0) AS n_zero, count(*) FILTER (WHERE amt_credit_sum < 0) AS n_negative,
      max(amt_credit_sum) AS max_value, NULL::BIGINT AS n_over FROM bureau
    UNION ALL SELECT 'credit_day_overdue', count(*) FILTER (WHERE credit_day_overdue = 0), count(*) FILTER (WHERE credit_day_overdue < 0),
      max(credit_day_overdue), count(*) FILTER (WHERE credit_day_overdue > 365) FROM bureau
    UNION ALL SELECT 'amt_payment', count(*) FILTER (WHERE amt_payment = 0), count(*) FILTER (WHERE amt_payment < 0), max(amt_payment), NULL FROM installments
    UNION ALL SELECT 'rate_interest_primary', count(*) FILTER (WHERE rate_interest_primary = 0), count(*) FILTER (WHERE rate_interest_primary < 0),
      max(rate_interest_primary), count(*) FILTER (WHERE rate_interest_primary > 1) FROM previous_application""", digits={"max_value": 4})
def aud_zero_neg_max(dom: Domain) -> DataFrame:
    out = audit.sign_profile(dom.bureau, ["amt_credit_sum", "credit_day_overdue"], {"credit_day_overdue": 365.0})
    out = out.union(audit.sign_profile(dom.installments, ["amt_payment"]))
    return out.union(audit.sign_profile(dom.previous, ["rate_interest_primary"], {"rate_interest_primary": 1.0}))


_CHILDREN = ["bureau", "previous_application", "installments", "pos_cash", "credit_card"]


@query("aud_coverage", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS child, count(DISTINCT sk_id_curr) AS n_clients, (SELECT count(DISTINCT sk_id_curr) FROM application) AS n_parents,
      count(DISTINCT sk_id_curr) * 1e2 / (SELECT count(DISTINCT sk_id_curr) FROM application) AS coverage_pct FROM {c}""" for c in _CHILDREN),
    digits={"coverage_pct": 6})
def aud_coverage(dom: Domain) -> DataFrame:
    children = dict(zip(_CHILDREN, [dom.bureau, dom.previous, dom.installments, dom.pos_cash, dom.credit_card]))
    return audit.coverage(children, dom.application, "sk_id_curr")


@query("aud_fanout", sql="""
    SELECT min(n) AS min_size, max(n) AS max_size, avg(n) AS mean_size, median(n) AS median_size, (count(*) FILTER (WHERE n > 5)) AS n_many
    FROM (SELECT count(*) AS n FROM bureau GROUP BY sk_id_curr)""", digits={"mean_size": 6, "median_size": 2})
def aud_fanout(dom: Domain) -> DataFrame:
    return audit.fan_out(dom.bureau, "sk_id_curr", many=5)


@query("aud_payment_mix", sql="""
    SELECT avg(CASE WHEN amt_instalment - amt_payment > 0 THEN 1e0 ELSE 0e0 END) * 100 AS under_pct,
      avg(CASE WHEN amt_instalment - amt_payment < 0 THEN 1e0 ELSE 0e0 END) * 100 AS over_pct,
      avg(CASE WHEN amt_instalment - amt_payment = 0 THEN 1e0 ELSE 0e0 END) * 100 AS exact_pct,
      avg(CASE WHEN days_entry_payment - days_instalment > 0 THEN 1e0 ELSE 0e0 END) * 100 AS late_pct,
      avg(CASE WHEN days_entry_payment - days_instalment > 30 THEN 1e0 ELSE 0e0 END) * 100 AS very_late_pct FROM installments""",
    digits=dict.fromkeys(["under_pct", "over_pct", "exact_pct", "late_pct", "very_late_pct"], 6))
def aud_payment_mix(dom: Domain) -> DataFrame:
    return audit.payment_mix(dom.installments)


@query("aud_dpd", sql=" UNION ALL ".join(
    f"""SELECT '{t}' AS tbl, max(sk_dpd) AS max_dpd, avg(sk_dpd) AS mean_dpd, count(*) FILTER (WHERE sk_dpd > 0) AS n_late,
      avg(CASE WHEN sk_dpd > 0 THEN 1e0 ELSE 0e0 END) * 100 AS late_pct, count(*) FILTER (WHERE sk_dpd > 30) AS n_late_30 FROM {t}"""
    for t in ("pos_cash", "credit_card")), digits={"mean_dpd": 6, "late_pct": 6})
def aud_dpd(dom: Domain) -> DataFrame:
    pos = audit.overdue_profile(dom.pos_cash).select(F.lit("pos_cash").alias("tbl"), "*")
    return pos.union(audit.overdue_profile(dom.credit_card).select(F.lit("credit_card").alias("tbl"), "*"))


@query("aud_util_proxy", sql="""
    SELECT count(*) FILTER (WHERE amt_balance / (amt_credit_limit_actual + 1) > 1) AS n_over_limit,
      count(*) FILTER (WHERE amt_balance / (amt_credit_limit_actual + 1) > 8e-1) AS n_near_limit,
      avg(amt_credit_limit_actual) AS mean_limit, max(amt_credit_limit_actual) AS max_limit FROM credit_card""", digits={"mean_limit": 4})
def aud_util_proxy(dom: Domain) -> DataFrame:
    return audit.utilization_profile(dom.credit_card)


_CARD_SQL = """SELECT sk_id_curr, avg(amt_balance) AS cc_balance_mean, max(amt_balance) AS cc_balance_max, avg(amt_credit_limit_actual) AS cc_limit_mean,
    avg(amt_balance / (amt_credit_limit_actual + 1)) AS cc_utilization_mean, max(amt_balance / (amt_credit_limit_actual + 1)) AS cc_utilization_max,
    avg(sk_dpd) AS cc_dpd_mean, max(sk_dpd) AS cc_dpd_max, count(months_balance) AS cc_months_count FROM credit_card GROUP BY sk_id_curr"""


@query("aud_card_rollup", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, min({c})::DOUBLE AS min, quantile_cont({c}, 0.25) AS p25,
      quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, max({c})::DOUBLE AS max FROM ({_CARD_SQL})""" for c in audit.CARD_ROLLUP),
    digits=dict.fromkeys(["mean", "std", "min", "p25", "p50", "p75", "max"], 4))
def aud_card_rollup(dom: Domain) -> DataFrame:
    preview = materialize(audit.card_preview(dom.credit_card), "card")
    return audit.describe_exact(preview, audit.CARD_ROLLUP)


_SIDES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) FILTER (WHERE is_train = 1) AS n_train, {test} AS n_test FROM application"
    for c, test in [(c, "0" if c in ("own_car_age", "ext_source_1") else f"count({c}) FILTER (WHERE is_train = 0)") for c in APP_COLUMNS if c != "target"])


@query("aud_schema_diff", sql=f"""
    SELECT column_name, CASE WHEN n_train > 0 THEN 'train' ELSE 'test' END AS only_in FROM ({_SIDES}) WHERE (n_train > 0) <> (n_test > 0)
    UNION ALL SELECT 'extra_flag', 'test' WHERE EXISTS (SELECT 1 FROM application WHERE is_train = 0 AND days_employed = 365243)""")
def aud_schema_diff(dom: Domain) -> DataFrame:
    """Columns with values on one side only: test lacks one train column, holds one without values, and has one of its own."""
    is_train = F.col("is_train") == 1
    test = dom.application.filter(~is_train).drop("target", "own_car_age").withColumns({
        "ext_source_1": F.lit(None).cast("double"), "extra_flag": F.when(F.col("days_employed") == 365243, 1)})
    return audit.filled_difference(dom.application.filter(is_train), test)


@query("aud_missing_drift", sql=f"""
    SELECT *, CASE WHEN abs(train_rate - test_rate) > 5e-2 THEN 1 ELSE 0 END AS drifted FROM (
      {' UNION ALL '.join(f"SELECT '{c}' AS column_name, avg(CASE WHEN is_train = 1 THEN CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END END) AS train_rate, avg(CASE WHEN is_train = 0 THEN CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END END) AS test_rate FROM application" for c in APP_COLUMNS)})
    ORDER BY train_rate DESC, column_name LIMIT 10""", digits={"train_rate": 6, "test_rate": 6})
def aud_missing_drift(dom: Domain) -> DataFrame:
    return audit.missing_drift(dom.application, F.col("is_train") == 1, APP_COLUMNS)


@query("aud_before_after", sql="""
    SELECT 'bureau' AS label, 'before' AS moment, count(*) AS n_rows, 14 AS n_columns,
      ((count(*) - count(amt_annuity)) + (count(*) - count(amt_credit_sum_debt)) + (count(*) - count(amt_credit_max_overdue))
       + (count(*) - count(days_credit_enddate)) + (count(*) - count(days_enddate_fact))) * 1e2 / 14 / count(*) AS missing_pct FROM bureau
    UNION ALL SELECT 'bureau', 'after', count(*), 13, 0e0 FROM bureau""", digits={"missing_pct": 6})
def aud_before_after(dom: Domain) -> DataFrame:
    return audit.before_after(dom.bureau, clean.clean_bureau(dom.bureau), "bureau")
