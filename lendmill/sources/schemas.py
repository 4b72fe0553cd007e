"""Declared table schemas: types, required columns, defaults, keys and domain checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.functions.nullsafe import spread

MONEY = T.DecimalType(18, 2)
FINE_MONEY = T.DecimalType(14, 4)
SCORE = T.DecimalType(8, 6)
DAYS = T.DecimalType(10, 2)
COUNT = T.DecimalType(8, 2)
TINY, SMALL, INT, ID, TEXT, TIME = T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.StringType(), T.TimestampType()


@dataclass(frozen=True)
class Declared:
    """A table declaration. `required` columns must not be null once defaults are applied."""

    columns: dict[str, T.DataType]
    required: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)
    key: tuple[str, ...] = ()
    parent: str | None = None

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, n not in self.required) for n, t in self.columns.items()])

    def reading_struct(self) -> T.StructType:
        """The same columns, all nullable, for reading raw files."""
        return T.StructType([T.StructField(n, t, True) for n, t in self.columns.items()])

    def conform(self, df: DataFrame) -> DataFrame:
        """Cast to the declared types, add absent columns, fill defaults.

        A value that does not fit its type becomes null, for the null checks to report.
        """
        have = {c.lower(): c for c in df.columns}
        cols = []
        for name, dtype in self.columns.items():
            c = F.col(have[name]).try_cast(dtype) if name in have else F.lit(None).cast(dtype)
            if name in self.defaults:
                default = self.defaults[name]
                c = F.coalesce(c, F.current_timestamp() if default == "now" else F.lit(default).cast(dtype))
            cols.append(c.alias(name))
        return df.select(*cols)

    def failed_casts(self, df: DataFrame) -> DataFrame:
        """(column_name, n_rows) of the values that do not fit their declared type."""
        have = {c.lower(): c for c in df.columns}
        lost = {n: F.count_if(F.col(have[n]).isNotNull() & F.col(have[n]).try_cast(t).isNull()) for n, t in self.columns.items() if n in have}
        one = df.agg(*[c.alias(n) for n, c in lost.items()])
        return spread(one, {"n_rows": "bigint"}, {n: {"n_rows": F.col(n)} for n in lost}, name="column_name").filter("n_rows > 0")


DOCUMENT_FLAGS = [f"flag_document_{i}" for i in range(2, 22)]
CONTACT_FLAGS = ["flag_mobil", "flag_emp_phone", "flag_work_phone", "flag_cont_mobile", "flag_phone", "flag_email"]
INQUIRIES = [f"amt_req_credit_bureau_{p}" for p in ("hour", "day", "week", "mon", "qrt", "year")]
PLACE_FLAGS = [
    "reg_region_not_live_region", "reg_region_not_work_region", "live_region_not_work_region",
    "reg_city_not_live_city", "reg_city_not_work_city", "live_city_not_work_city",
]

APPLICATION = Declared(
    columns={
        "sk_id_curr": ID, "is_test": TINY, "target": TINY, "name_contract_type": TEXT,
        **dict.fromkeys(["amt_credit", "amt_annuity", "amt_goods_price", "amt_income_total"], MONEY),
        **dict.fromkeys(["code_gender", "flag_own_car", "flag_own_realty"], TEXT),
        **dict.fromkeys(["cnt_children", "cnt_fam_members"], SMALL),
        **dict.fromkeys(
            ["name_income_type", "name_education_type", "name_family_status", "name_housing_type", "occupation_type", "organization_type"], TEXT
        ),
        "days_birth": INT, "days_employed": INT, "days_registration": DAYS, "days_id_publish": INT,
        "days_last_phone_change": DAYS, "own_car_age": T.DecimalType(6, 2), "emp_anomaly": TINY,
        **dict.fromkeys(["ext_source_1", "ext_source_2", "ext_source_3"], SCORE),
        **dict.fromkeys(CONTACT_FLAGS, TINY),
        "region_rating_client": TINY, "region_rating_client_w_city": TINY,
        "region_population_relative": T.DecimalType(10, 8),
        **dict.fromkeys(PLACE_FLAGS, TINY),
        "weekday_appr_process_start": TEXT, "hour_appr_process_start": TINY, "name_type_suite": TEXT,
        "obs_30_cnt_social_circle": SMALL, "def_30_cnt_social_circle": TINY,
        "obs_60_cnt_social_circle": SMALL, "def_60_cnt_social_circle": TINY,
        **dict.fromkeys(INQUIRIES, TINY),
        **dict.fromkeys(DOCUMENT_FLAGS, TINY),
        "created_at": TIME,
    },
    required=(
        "sk_id_curr", "is_test", "name_contract_type", "amt_credit", "amt_income_total", "code_gender", "flag_own_car",
        "flag_own_realty", "cnt_children", "name_income_type", "name_education_type", "name_family_status",
        "name_housing_type", "organization_type", "days_birth", "days_id_publish", "emp_anomaly",
        *CONTACT_FLAGS, *DOCUMENT_FLAGS, "created_at",
    ),
    defaults={"is_test": 0, "emp_anomaly": 0, **dict.fromkeys(CONTACT_FLAGS + DOCUMENT_FLAGS, 0), "created_at": "now"},
    key=("sk_id_curr",),
)

_BUREAU_ZERO = ["amt_credit_max_overdue", "amt_credit_sum_debt", "amt_credit_sum_limit", "amt_credit_sum_overdue"]
BUREAU = Declared(
    columns={
        "sk_id_bureau": ID, "sk_id_curr": ID, "credit_active": TEXT, "credit_currency": TEXT, "credit_type": TEXT,
        "days_credit": INT, "days_credit_enddate": INT, "days_enddate_fact": INT, "days_credit_update": INT,
        "credit_day_overdue": SMALL, "amt_credit_sum": MONEY, **dict.fromkeys(_BUREAU_ZERO, MONEY),
        "cnt_credit_prolong": SMALL, "created_at": TIME,
    },
    required=("sk_id_bureau", "sk_id_curr", "credit_active", "credit_type", "days_credit", "days_enddate_fact",
              "days_credit_update", "credit_day_overdue", *_BUREAU_ZERO, "cnt_credit_prolong", "created_at"),
    defaults={"days_enddate_fact": 0, "credit_day_overdue": 0, "cnt_credit_prolong": 0, **dict.fromkeys(_BUREAU_ZERO, 0), "created_at": "now"},
    key=("sk_id_bureau",), parent="application",
)

PREVIOUS = Declared(
    columns={
        "sk_id_prev": ID, "sk_id_curr": ID,
        **dict.fromkeys(
            ["name_contract_type", "name_contract_status", "name_cash_loan_purpose", "name_payment_type", "code_reject_reason",
             "name_client_type", "name_goods_category", "name_portfolio", "name_product_type", "channel_type",
             "name_seller_industry", "name_yield_group", "product_combination", "flag_last_appl_per_contract"], TEXT),
        "nflag_last_appl_in_day": TINY, "nflag_insured_on_approval": TINY,
        **dict.fromkeys(["amt_annuity", "amt_application", "amt_credit", "amt_down_payment", "amt_goods_price"], MONEY),
        "rate_down_payment": SCORE,
        **dict.fromkeys(["days_decision", "days_first_drawing", "days_first_due", "days_last_due_1st_version", "days_last_due", "days_termination"], INT),
        "weekday_appr_process_start": TEXT, "hour_appr_process_start": TINY, "sellerplace_area": INT, "cnt_payment": SMALL,
        "created_at": TIME,
    },
    required=("sk_id_prev", "sk_id_curr", "name_contract_status", "amt_down_payment", "days_decision", "created_at"),
    defaults={"amt_down_payment": 0, "created_at": "now"},
    key=("sk_id_prev",), parent="application",
)

INSTALLMENTS = Declared(
    columns={
        "sk_id_prev": ID, "sk_id_curr": ID, "num_instalment_version": TINY, "num_instalment_number": SMALL,
        "days_instalment": DAYS, "days_entry_payment": DAYS, "amt_instalment": FINE_MONEY, "amt_payment": FINE_MONEY,
        "payment_diff": FINE_MONEY, "days_past_due": DAYS, "created_at": TIME,
    },
    required=("sk_id_prev", "sk_id_curr", "num_instalment_number", "created_at"),
    defaults={"created_at": "now"}, parent="application",
)

POS_CASH = Declared(
    columns={
        "sk_id_prev": ID, "sk_id_curr": ID, "months_balance": SMALL, "cnt_instalment": T.DecimalType(6, 2),
        "cnt_instalment_future": T.DecimalType(6, 2), "name_contract_status": TEXT, "sk_dpd": SMALL, "sk_dpd_def": SMALL,
        "created_at": TIME,
    },
    required=("sk_id_prev", "sk_id_curr", "months_balance", "name_contract_status", "sk_dpd", "sk_dpd_def", "created_at"),
    defaults={"sk_dpd": 0, "sk_dpd_def": 0, "created_at": "now"}, parent="application",
)

_CARD_MONEY = ["amt_balance", "amt_drawings_atm_current", "amt_drawings_current", "amt_drawings_other_current",
               "amt_drawings_pos_current", "amt_inst_min_regularity", "amt_payment_current"]
_CARD_COUNTS = ["cnt_drawings_atm_current", "cnt_drawings_other_current", "cnt_drawings_pos_current", "cnt_instalment_mature_cum"]
CREDIT_CARD = Declared(
    columns={
        "sk_id_prev": ID, "sk_id_curr": ID, "months_balance": SMALL, "amt_credit_limit_actual": INT,
        **dict.fromkeys(_CARD_MONEY, MONEY), **dict.fromkeys(_CARD_COUNTS, COUNT), "cnt_drawings_current": SMALL,
        **dict.fromkeys(["amt_payment_total_current", "amt_receivable_principal", "amt_recivable", "amt_total_receivable"], MONEY),
        "name_contract_status": TEXT, "sk_dpd": SMALL, "sk_dpd_def": SMALL, "utilization_ratio": SCORE, "created_at": TIME,
    },
    required=("sk_id_prev", "sk_id_curr", "months_balance", "amt_credit_limit_actual", *_CARD_MONEY, *_CARD_COUNTS,
              "cnt_drawings_current", "sk_dpd", "sk_dpd_def", "utilization_ratio", "created_at"),
    defaults={"amt_credit_limit_actual": 0, **dict.fromkeys(_CARD_MONEY + _CARD_COUNTS, 0), "cnt_drawings_current": 0,
              "sk_dpd": 0, "sk_dpd_def": 0, "utilization_ratio": 0, "created_at": "now"},
    parent="application",
)

_D64, _D104, _D106, _D62 = T.DecimalType(6, 4), T.DecimalType(10, 4), T.DecimalType(10, 6), T.DecimalType(6, 2)
FEATURES = Declared(
    columns={
        "sk_id_curr": ID,
        **dict.fromkeys(["credit_income_ratio", "annuity_income_ratio", "credit_term", "goods_credit_ratio"], _D104),
        "credit_downpayment": MONEY, "age_years": _D62, "years_employed": _D62, "days_employed_ratio": _D106,
        "years_id_publish": _D62, "years_last_phone_change": _D62, "flag_docs_sum": TINY, "cnt_children_ratio": _D64,
        "emp_anomaly": TINY,
        **dict.fromkeys(["bureau_loan_count", "bureau_active_count", "bureau_closed_count"], SMALL),
        **dict.fromkeys(["bureau_credit_sum", "bureau_credit_mean", "bureau_debt_sum"], MONEY),
        "bureau_overdue_mean": FINE_MONEY, "bureau_overdue_max": FINE_MONEY, "bureau_bad_debt_count": SMALL,
        "bureau_bad_debt_flag": TINY, "bureau_active_ratio": SCORE, "bureau_debt_credit_ratio": SCORE,
        **dict.fromkeys(["prev_app_count", "prev_approved_count", "prev_refused_count"], SMALL),
        "prev_refused_ratio": SCORE, "prev_approved_ratio": SCORE, "prev_credit_mean": MONEY, "prev_credit_max": MONEY,
        "prev_annuity_mean": FINE_MONEY, "inst_payment_diff_mean": FINE_MONEY, "inst_payment_diff_max": FINE_MONEY,
        "inst_dpd_mean": _D104, "inst_dpd_max": _D104, "inst_late_count": INT,
        "pos_dpd_mean": _D104, "pos_dpd_max": SMALL, "pos_months_count": SMALL, "pos_completed_ratio": SCORE,
        **dict.fromkeys(["cc_balance_mean", "cc_balance_max", "cc_limit_mean"], MONEY),
        "cc_utilization_mean": SCORE, "cc_utilization_max": SCORE, "cc_dpd_mean": _D104, "cc_dpd_max": SMALL,
        "cc_months_count": SMALL, "created_at": TIME,
    },
    required=("sk_id_curr", "created_at"), defaults={"created_at": "now"}, key=("sk_id_curr",), parent="application",
)

PREDICTIONS = Declared(
    columns={
        "sk_id_curr": ID, "model_version": TEXT, "default_probability": SCORE, "risk_tier": TEXT, "oof_fold": TINY,
        "actual_target": TINY, "predicted_at": TIME,
    },
    required=("sk_id_curr", "model_version", "default_probability", "risk_tier", "predicted_at"),
    defaults={"model_version": "lgbm_v1", "predicted_at": "now"},
    key=("sk_id_curr", "model_version"), parent="application",
)

TABLES = {
    "application": APPLICATION, "bureau": BUREAU, "previous_application": PREVIOUS, "installments_payments": INSTALLMENTS,
    "pos_cash_balance": POS_CASH, "credit_card_balance": CREDIT_CARD, "application_features": FEATURES, "predictions": PREDICTIONS,
}
