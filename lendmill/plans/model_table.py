"""The whole feature chain: applications, all rollups, encoding, gaps, interactions, selection.

The table that the models read is made once for a session and a data folder and written to the
shared folder; what is fitted (categories, medians, selection) sees the train rows only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators import clean, encode, features, joins, rollups
from lendmill.operators.quantiles import median
from lendmill.plans import feature_queries  # noqa: F401  (the rollups' SQL)
from lendmill.plans.portfolio import base, installments
from lendmill.plans.registry import QUERIES, query
from lendmill.session import materialize
from lendmill.sources.domain import Domain

KEYS = ["sk_id_curr", "is_train", "target"]
TEXTS = ["name_contract_type", "code_gender", "flag_own_car", "name_income_type", "name_education_type", "name_family_status", "occupation_type", "weekday_appr_process_start"]
# Not features: the key columns, a date and the score of an earlier model.
LEFT_OUT = [*KEYS, "application_date", "pred_prob"]


def child_rollups(dom: Domain) -> list[DataFrame]:
    """All five child tables, one row per client, every column."""
    return [
        rollups.bureau_derived(rollups.bureau_rollup(dom.bureau)),
        rollups.previous_derived(rollups.previous_rollup(dom.previous)),
        rollups.installments_rollup(clean.clean_installments(installments(dom))),
        rollups.pos_rollup(clean.clean_pos(dom.pos_cash)),
        rollups.card_rollup(clean.clean_card(dom.credit_card)),
    ]


def encoded(dom: Domain) -> tuple[DataFrame, list[str]]:
    """Every application with all rollups (0 where there is no history) and all text columns encoded; gaps of the application stay."""
    history = child_rollups(dom)
    wide = joins.attach_rollups(features.add_child_ratio(base(dom)), history)
    wide = joins.fill_no_history(wide, rollups.rollup_columns(history))
    encoding = encode.fit_encoding(dom.application.filter("is_train = 1").select(*TEXTS), TEXTS)
    wide = encode.encode_one_hot(encode.encode_binary(wide, encoding), encoding)
    names = [c for c in wide.columns if c not in LEFT_OUT]
    return wide.select(*KEYS, *[F.col(c).cast("double").alias(c) for c in names]), names


def with_composites(df: DataFrame) -> DataFrame:
    """The features made of others, once those have no gaps."""
    made = features.add_ext_composites(features.add_clean_high_lti(features.add_bureau_quality(features.add_interactions(df))))
    return made.withColumns({c: F.col(c).cast("double") for c in made.columns if c not in KEYS})


@dataclass(frozen=True)
class ModelTable:
    """`filled` has no gaps and holds the selected features, `gaps` the same rows before gaps were filled.

    Both are projections of `raw`, the one table that is written. `medians` are those of the columns with gaps.
    """

    raw: DataFrame
    filled: DataFrame
    selected: list[str]
    status: dict[str, str]
    medians: dict[str, float]

    @cached_property
    def gaps(self) -> DataFrame:
        return with_composites(self.raw).select(*KEYS, *self.selected)


def with_gaps(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns that lack a value (null or NaN) in any row."""
    if not columns:
        return []
    seen = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in columns]).first()
    return [c for c in columns if seen[c]]


_TABLES: dict[tuple[str, str], ModelTable] = {}


def model_table(dom: Domain) -> ModelTable:
    name = (dom.spark.sparkContext.applicationId, dom.folder)
    if name not in _TABLES:
        raw, names = encoded(dom)
        # what cannot be null needs no count; materialised columns all can
        maybe = [f.name for f in raw.schema if f.nullable and f.name in set(names)]
        raw = materialize(raw, "encoded", "zstd")
        gaps = with_gaps(raw, maybe)
        medians = {c: v or 0.0 for c, v in median(raw.filter("is_train = 1"), gaps).items()} if gaps else {}
        whole = with_composites(raw.fillna(medians))
        candidates = [c for c in whole.columns if c not in KEYS]
        status = encode.select_features(whole.filter("is_train = 1"), candidates)
        selected = [c for c in candidates if status[c] == "kept"]
        _TABLES[name] = ModelTable(raw, whole.select(*KEYS, *selected), selected, status, medians)
    return _TABLES[name]


# ---- the same chain in SQL ---------------------------------------------------------------------


def _sql_values(text: str) -> list[str]:
    """The values of a text column, as the domain's definition lists them."""
    return {
        "name_contract_type": ["Cash loans", "Consumer loans", "Revolving loans"], "code_gender": ["F", "M", "XNA"],
        "name_income_type": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
        "name_education_type": ["Higher education", "Incomplete higher", "Lower secondary", "Secondary / secondary special"],
        "name_family_status": ["Married", "Separated", "Single / not married", "Widow"],
        "occupation_type": sorted(f"NATION_{i}" for i in range(25)),
        "weekday_appr_process_start": sorted(["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY"]),
    }[text]


_NUMBERS = ["region_rating_client_w_city", "cnt_children", "cnt_fam_members", "amt_credit", "amt_income_total", "amt_annuity", "amt_goods_price", "days_birth", "days_employed",
            "days_id_publish", "days_last_phone_change", "own_car_age", "ext_source_1", "ext_source_2", "ext_source_3", "obs_30_cnt_social_circle", "def_30_cnt_social_circle",
            "amt_req_credit_bureau_qrt", "flag_document_3", "flag_document_6", "hour_appr_process_start", "emp_anomaly", "credit_income_ratio", "annuity_income_ratio", "credit_term",
            "goods_credit_ratio", "credit_downpayment", "age_years", "years_employed", "days_employed_ratio", "years_id_publish", "years_last_phone_change", "cnt_children_ratio"]
_ROLLUPS = ["agg_bureau", "agg_bureau_derived", "agg_prev", "agg_prev_derived", "agg_inst", "agg_pos", "agg_card"]
_COMPOSITES = {
    "stress_age_x_credit": "age_years * credit_income_ratio", "stress_emp_x_annuity": "greatest(years_employed, 0) * annuity_income_ratio",
    "flag_docs_sum": "flag_document_3 + flag_document_6", "stress_docs_x_credit": "(flag_document_3 + flag_document_6) * credit_income_ratio",
    "bureau_quality_composite": """(1 - least(greatest(bureau_overdue_mean, 0) / (overdue_p99 + 1e-6), 1)) * 4e-1 + (1 - least(greatest(prev_refused_ratio, 0), 1)) * 35e-2
      + (1 - least(greatest(inst_late_ratio, 0), 1)) * 25e-2""",
    "clean_bureau_high_lti": "CASE WHEN bureau_bad_debt_flag = 0 AND credit_income_ratio > 5 THEN 1 ELSE 0 END",
    "ext_source_mean": "(ext_source_1 + ext_source_2 + ext_source_3) / 3e0", "ext_source_min": "least(ext_source_1, ext_source_2, ext_source_3)",
    "ext_source_product": "ext_source_1 * ext_source_2 * ext_source_3", "ext_source_std": "list_stddev_samp([ext_source_1, ext_source_2, ext_source_3])",
}


_BUREAU_COLUMNS = ["bureau_loan_count", "bureau_active_count", "bureau_closed_count", "bureau_credit_sum", "bureau_credit_mean", "bureau_credit_max", "bureau_debt_sum", "bureau_overdue_mean",
                   "bureau_overdue_max", "bureau_days_credit_mean", "bureau_days_enddate_max", "bureau_bad_debt_count", "bureau_overdue_days_max", "bureau_prolong_sum", "bureau_bad_debt_flag",
                   "bureau_active_ratio", "bureau_debt_credit_ratio"]
_PREVIOUS_COLUMNS = ["prev_app_count", "prev_approved_count", "prev_refused_count", "prev_canceled_count", "prev_credit_mean", "prev_credit_max", "prev_annuity_mean", "prev_down_payment_mean",
                     "prev_days_decision_mean", "prev_consumer_count", "prev_cash_count", "prev_revolving_count", "prev_refused_ratio", "prev_approved_ratio", "prev_canceled_ratio", "prev_consumer_ratio"]
_OTHER_COLUMNS = ["inst_payment_diff_mean", "inst_payment_diff_max", "inst_payment_diff_sum", "inst_days_past_due_mean", "inst_days_past_due_max", "inst_late_payment_count", "inst_on_time_count",
                  "inst_total_count", "inst_amt_payment_mean", "inst_amt_instalment_mean", "inst_late_ratio", "pos_dpd_mean", "pos_dpd_max", "pos_dpd_def_mean", "pos_dpd_def_max", "pos_months_count",
                  "pos_cnt_instalment_mean", "pos_active_count", "pos_completed_count", "pos_late_count", "pos_completed_ratio", "pos_late_ratio", "cc_balance_mean", "cc_balance_max", "cc_limit_mean",
                  "cc_limit_max", "cc_utilization_mean", "cc_utilization_max", "cc_dpd_mean", "cc_dpd_max", "cc_dpd_def_mean", "cc_months_count", "cc_drawings_mean", "cc_drawings_max", "cc_payment_mean",
                  "cc_late_count", "cc_late_ratio"]
_HISTORY = [*_BUREAU_COLUMNS, *_PREVIOUS_COLUMNS, *_OTHER_COLUMNS]


_DUMMIES = {name: f"CASE WHEN {t} = '{v}' THEN 1 ELSE 0 END" for t in TEXTS if t != "flag_own_car" for v, name in encode.one_hot_names(t, _sql_values(t)).items()}
# The chain's features in order: the table's own columns, all rollups, encoded texts, composites.
_ENCODED = ["flag_own_car", *_NUMBERS, *_HISTORY, *_DUMMIES]


def _raw_sql() -> str:
    """raw_table: every application with all rollups and encoded texts, its own gaps left."""
    joined = " ".join(f"LEFT JOIN ({QUERIES[n].sql}) AS {n} USING (sk_id_curr)" for n in _ROLLUPS)
    raw = ", ".join([
        "CASE flag_own_car WHEN 'N' THEN 0 ELSE 1 END::DOUBLE AS flag_own_car", *(f"({c})::DOUBLE AS {c}" for c in _NUMBERS if c != "cnt_children_ratio"),
        "cnt_children / greatest(cnt_fam_members, 1)::DOUBLE AS cnt_children_ratio", *(f"coalesce({c}, 0)::DOUBLE AS {c}" for c in _HISTORY), *(f"({e})::DOUBLE AS {n}" for n, e in _DUMMIES.items()),
    ])
    return f"raw_table AS (SELECT sk_id_curr, is_train, target, {raw} FROM base_app {joined})"


def _long_sql(source: str, columns: list[str]) -> str:
    """(sk_id_curr, is_train, target, at, feature, value) of all columns; rows without a value are left out."""
    listed = ", ".join(columns)
    return f"""SELECT sk_id_curr, is_train, target, list_position({columns!r}, feature) AS at, feature, value
      FROM (UNPIVOT (SELECT sk_id_curr, is_train, target, {listed} FROM {source}) ON {listed} INTO NAME feature VALUE value)"""


_PAIRS = "SELECT b.feature AS feature, corr(a.value, b.value) AS r FROM {0} a JOIN {0} b ON a.sk_id_curr = b.sk_id_curr AND a.at < b.at GROUP BY a.feature, b.feature"


def _chain_sql() -> str:
    """WITH clauses up to `long`, the features without gaps, and `status`, the selection."""
    filled = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM raw_table WHERE is_train = 1), 0) AS {c}" for c in _NUMBERS)
    made = ", ".join(f"({e})::DOUBLE AS {n}" for n, e in _COMPOSITES.items())
    return f"""{_raw_sql()},
    filled AS (SELECT * REPLACE ({filled}) FROM raw_table),
    whole AS (SELECT *, {made} FROM filled, (SELECT quantile_cont(greatest(bureau_overdue_mean, 0), 0.99) AS overdue_p99 FROM filled)),
    long AS ({_long_sql("whole", [*_ENCODED, *_COMPOSITES])}),
    flatness AS (SELECT feature, var_samp(value) AS variance FROM long WHERE is_train = 1 GROUP BY feature),
    varied AS (SELECT l.* FROM long l JOIN flatness s ON s.feature = l.feature WHERE s.variance >= 1e-2 AND l.is_train = 1),
    close AS (SELECT DISTINCT feature FROM ({_PAIRS.format("varied")}) WHERE abs(r) > 95e-2 AND NOT isnan(r)),
    status AS (SELECT s.feature, CASE WHEN s.variance < 1e-2 THEN 'low_variance' WHEN c.feature IS NOT NULL THEN 'correlated' ELSE 'kept' END AS status
      FROM flatness s LEFT JOIN close c ON c.feature = s.feature)"""


@query("fea_selection", sql=f"SELECT * FROM (WITH {_chain_sql()} SELECT feature, status FROM status)")
def fea_selection(dom: Domain) -> DataFrame:
    """Every feature of the chain: kept, near constant, or correlated with an earlier one; decided on the train rows."""
    rows = [(f, s) for f, s in model_table(dom).status.items()]
    return dom.spark.createDataFrame(rows, "feature string, status string")


@query("fea_selected_table", sql=f"""SELECT * FROM (WITH {_chain_sql()}
    SELECT sk_id_curr, is_train, count(*) AS n_features, sum(value) AS total, sum(sqrt(abs(value))) AS roots FROM long JOIN status USING (feature) WHERE status = 'kept' GROUP BY sk_id_curr, is_train)""",
    digits={"total": 2, "roots": 3})
def fea_selected_table(dom: Domain) -> DataFrame:
    """The table after selection: per application the number of its features and sums over all of them."""
    table = model_table(dom)
    values = F.array(*table.selected)
    add = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    return table.filled.select("sk_id_curr", "is_train", F.size(values).cast("bigint").alias("n_features"), add(values).alias("total"), add(F.transform(values, lambda x: F.sqrt(F.abs(x)))).alias("roots"))


@query("sel_low_variance", sql=f"""SELECT * FROM (WITH {_raw_sql()}, long AS ({_long_sql("raw_table", _ENCODED)})
    SELECT feature, var_samp(value) AS variance FROM long GROUP BY feature HAVING var_samp(value) < 1e-2)""", digits={"variance": 8})
def sel_low_variance(dom: Domain) -> DataFrame:
    """Over all columns: applications, five rollups, encoded texts; gaps are skipped."""
    rows, names = encoded(dom)
    return encode.low_variance(rows, names)


@query("sel_high_corr", sql=f"""SELECT * FROM (WITH {_raw_sql()}, long AS ({_long_sql("raw_table", _ENCODED)})
    SELECT feature, count(*)::INTEGER AS n_partners FROM ({_PAIRS.format("long")}) WHERE abs(r) > 95e-2 AND NOT isnan(r) GROUP BY feature)""")
def sel_high_corr(dom: Domain) -> DataFrame:
    """Over all columns; each pair over the rows where both have a value."""
    rows, names = encoded(dom)
    return encode.high_correlation(rows, names)


@query("sel_target_corr", sql=f"""SELECT * FROM (WITH {_raw_sql()}, long AS ({_long_sql("raw_table", _ENCODED)}),
    found AS (SELECT feature, abs(corr(value, target)) AS abs_corr FROM long WHERE is_train = 1 GROUP BY feature HAVING var_pop(value) > 1e-9)
    SELECT feature, abs_corr FROM found WHERE abs_corr IS NOT NULL AND NOT isnan(abs_corr) ORDER BY round(abs_corr, 9) DESC, feature LIMIT 20)""", digits={"abs_corr": 8})
def sel_target_corr(dom: Domain) -> DataFrame:
    rows, names = encoded(dom)
    return encode.target_correlation(rows.filter("is_train = 1"), names)
