"""Credit-domain views over the driver's star-schema tables.

The driver tables have no credit columns, so each domain table is a deterministic projection of
`orders`, `customer`, `nation` and `lineitem`. The expressions are plain SQL that both Spark and
the checking engine read.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lendmill.operators.joins import lookup_join

APPLICATION = {
    "sk_id_curr": "o_orderkey",
    "is_train": "CASE WHEN o_orderkey % 10 < 8 THEN 1 ELSE 0 END",
    "target": "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END",
    "name_contract_type": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Revolving loans' WHEN '2-HIGH' THEN 'Consumer loans' ELSE 'Cash loans' END",
    "code_gender": "CASE WHEN o_custkey % 50 = 0 THEN 'XNA' WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END",
    "flag_own_car": "CASE WHEN o_custkey % 3 = 0 THEN 'Y' ELSE 'N' END",
    "name_income_type": "c_mktsegment",
    "name_education_type": "CASE o_custkey % 5 WHEN 0 THEN 'Higher education' WHEN 1 THEN 'Incomplete higher' WHEN 2 THEN 'Lower secondary' ELSE 'Secondary / secondary special' END",
    "name_family_status": "CASE o_custkey % 4 WHEN 0 THEN 'Married' WHEN 1 THEN 'Single / not married' WHEN 2 THEN 'Separated' ELSE 'Widow' END",
    "occupation_type": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE n_name END",
    "region_rating_client_w_city": "CAST(n_regionkey % 3 + 1 AS INT)",
    "cnt_children": "CAST(o_orderkey % 4 AS INT)",
    "cnt_fam_members": "CAST(o_orderkey % 4 + o_custkey % 2 AS INT)",
    "amt_credit": "o_totalprice",
    "amt_income_total": "(c_acctbal + 1e3) * 2e1",
    "amt_annuity": "o_totalprice / (12 + o_orderkey % 49)",
    "amt_goods_price": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice * (6 + o_orderkey % 7) / 1e1 END",
    "days_birth": "-(6570 + (o_custkey * 37) % 18250)",
    "days_employed": "CASE WHEN o_custkey % 7 = 0 THEN 365243 ELSE -((o_custkey * 13) % 9000) END",
    "days_id_publish": "-((o_orderkey * 17) % 1460)",
    "days_last_phone_change": "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE -((o_orderkey * 29) % 4000) END",
    "own_car_age": "CASE WHEN o_custkey % 3 = 0 THEN CAST(o_custkey % 30 AS DOUBLE) ELSE NULL END",
    "ext_source_1": "CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE ((o_orderkey * 7919) % 1000) / 1e3 END",
    "ext_source_2": "((o_orderkey * 104729) % 1000) / 1e3",
    "ext_source_3": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE ((o_orderkey * 15485863) % 1000) / 1e3 END",
    "obs_30_cnt_social_circle": "CAST((o_custkey * 7) % 140 AS DOUBLE)",
    "def_30_cnt_social_circle": "CAST(o_custkey % 30 AS DOUBLE)",
    "amt_req_credit_bureau_qrt": "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST(o_orderkey % 20 AS DOUBLE) END",
    "flag_document_3": "CAST(o_orderkey % 2 AS INT)",
    "flag_document_6": "CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END",
    "weekday_appr_process_start": "CASE o_orderkey % 7 WHEN 0 THEN 'MONDAY' WHEN 1 THEN 'TUESDAY' WHEN 2 THEN 'WEDNESDAY' WHEN 3 THEN 'THURSDAY' WHEN 4 THEN 'FRIDAY' WHEN 5 THEN 'SATURDAY' ELSE 'SUNDAY' END",
    "hour_appr_process_start": "CAST((o_orderkey * 31) % 24 AS INT)",
    "application_date": "o_orderdate",
    "pred_prob": "(1 + (o_orderkey * 48271) % 998) / 1e3",
}

BUREAU = {
    "sk_id_curr": "l_orderkey",
    "sk_id_bureau": "l_orderkey * 8 + l_linenumber",
    "credit_active": "CASE l_linestatus WHEN 'O' THEN 'Active' ELSE 'Closed' END",
    "credit_type": "CASE WHEN l_suppkey % 9 = 0 THEN 'Mortgage' WHEN l_suppkey % 3 = 0 THEN 'Credit card' ELSE 'Consumer credit' END",
    "amt_annuity": "CASE WHEN l_suppkey % 4 = 0 THEN l_extendedprice / 12 ELSE NULL END",
    "amt_credit_sum": "CASE WHEN l_quantity = 1 THEN 0e0 ELSE l_extendedprice END",
    "amt_credit_sum_debt": "CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice * l_tax END",
    "amt_credit_sum_overdue": "CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_discount ELSE 0e0 END",
    "amt_credit_max_overdue": "CASE WHEN l_linenumber > 4 THEN NULL ELSE l_extendedprice * l_discount END",
    "credit_day_overdue": "CASE WHEN l_returnflag = 'R' AND l_discount >= 8e-2 THEN l_quantity * 10 ELSE 0e0 END",
    "days_credit": "-(l_partkey % 2900)",
    "days_credit_enddate": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_suppkey - 50 END",
    "days_enddate_fact": "CASE WHEN l_linestatus = 'O' THEN NULL ELSE -(l_partkey % 1400) END",
    "cnt_credit_prolong": "CASE WHEN l_quantity >= 49 THEN 1 ELSE 0 END",
}

PREVIOUS = {
    "sk_id_curr": "l_orderkey",
    "sk_id_prev": "l_orderkey * 8 + l_linenumber",
    "name_contract_status": "CASE l_returnflag WHEN 'A' THEN 'Approved' WHEN 'R' THEN 'Refused' ELSE 'Canceled' END",
    "name_contract_type": "CASE l_linenumber % 3 WHEN 0 THEN 'Consumer loans' WHEN 1 THEN 'Cash loans' ELSE 'Revolving loans' END",
    "amt_credit": "l_extendedprice",
    "amt_annuity": "l_extendedprice / 12",
    "amt_down_payment": "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_extendedprice * (l_discount - 2e-2) END",
    "rate_down_payment": "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_discount * 2e1 - 1e-1 END",
    "rate_interest_primary": "CASE WHEN l_suppkey % 50 = 0 THEN l_tax * 2e1 ELSE NULL END",
    "rate_interest_privileged": "CASE WHEN l_suppkey % 50 = 1 THEN l_tax * 1e1 ELSE NULL END",
    "days_decision": "-(l_partkey % 2900)",
    "days_first_drawing": "CASE WHEN l_suppkey % 4 = 0 THEN -l_suppkey ELSE 365243 END",
    "days_first_due": "CASE WHEN l_suppkey % 5 = 0 THEN 365243 ELSE -(l_partkey % 2800) END",
    "days_last_due": "CASE WHEN l_suppkey % 6 = 0 THEN 365243 ELSE -(l_partkey % 2000) END",
    "days_termination": "CASE WHEN l_suppkey % 7 = 0 THEN 365243 ELSE -(l_partkey % 1900) END",
}

# the only expression that differs by dialect: days between ship and order date
INSTALLMENTS = {
    "sk_id_curr": "l_orderkey",
    "sk_id_prev": "l_orderkey * 8 + l_linenumber",
    "days_instalment": "30 * l_linenumber",
    "days_entry_payment": "CASE WHEN l_quantity = 50 THEN NULL ELSE {days_between} END",
    "amt_instalment": "l_extendedprice",
    "amt_payment": "CASE WHEN l_quantity = 50 THEN NULL ELSE l_extendedprice * (1 - l_discount) END",
}
DAYS_BETWEEN_SPARK = "datediff(l_shipdate, o_orderdate)"

POS_CASH = {
    "sk_id_curr": "l_orderkey",
    "sk_id_prev": "l_orderkey * 8 + l_linenumber",
    "months_balance": "-l_linenumber",
    "cnt_instalment": "CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity END",
    "cnt_instalment_future": "CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity - 1 END",
    "name_contract_status": "CASE WHEN l_returnflag = 'A' THEN 'Active' WHEN l_returnflag = 'R' THEN 'Completed' WHEN l_linenumber = 7 THEN 'XNA' ELSE 'Signed' END",
    "sk_dpd": "CASE WHEN l_tax >= 6e-2 THEN l_quantity * 10 ELSE 0e0 END",
    "sk_dpd_def": "CASE WHEN l_tax >= 8e-2 THEN l_quantity * 10 ELSE 0e0 END",
}

CREDIT_CARD = {
    "sk_id_curr": "l_orderkey",
    "sk_id_prev": "l_orderkey * 8 + l_linenumber",
    "months_balance": "-l_linenumber",
    "amt_balance": "l_extendedprice - 5e3",
    "amt_credit_limit_actual": "CASE WHEN l_discount = 0 THEN 0e0 ELSE l_quantity * 1000 END",
    "amt_drawings_current": "CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice * l_tax END",
    "amt_payment_current": "l_extendedprice * l_discount",
    "sk_dpd": "CASE WHEN l_tax >= 6e-2 THEN l_quantity * 10 ELSE 0e0 END",
    "sk_dpd_def": "CASE WHEN l_tax >= 8e-2 THEN l_quantity * 10 ELSE 0e0 END",
}


# Declared schemas of the driver tables the domain views read: no footer pass to infer them.
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


class Domain:
    """Lazy domain tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            reader = self.spark.read
            if name in TABLE_SCHEMAS:
                reader = reader.schema(TABLE_SCHEMAS[name])
            self._tables[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def application(self) -> DataFrame:
        orders, customer, nation = self.table("orders"), self.table("customer"), self.table("nation")
        placed = lookup_join(orders, customer, "o_custkey", "c_custkey")
        return project(lookup_join(placed, nation, "c_nationkey", "n_nationkey"), APPLICATION)

    @cached_property
    def bureau(self) -> DataFrame:
        return project(self.table("lineitem"), BUREAU)

    @cached_property
    def previous(self) -> DataFrame:
        return project(self.table("lineitem"), PREVIOUS)

    @cached_property
    def installments(self) -> DataFrame:
        lines = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
        dates = self.table("orders").select("o_orderkey", "o_orderdate")
        columns = {k: v.format(days_between=DAYS_BETWEEN_SPARK) for k, v in INSTALLMENTS.items()}
        return project(lookup_join(lines, dates, "l_orderkey", "o_orderkey"), columns)

    @cached_property
    def pos_cash(self) -> DataFrame:
        return project(self.table("lineitem"), POS_CASH)

    @cached_property
    def credit_card(self) -> DataFrame:
        return project(self.table("lineitem"), CREDIT_CARD)
