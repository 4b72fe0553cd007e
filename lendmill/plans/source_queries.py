"""Source, sink, schema and contract queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators import checks, woe
from lendmill.operators.encode import feature_stats
from lendmill.operators.joins import concat_rows, union_counts
from lendmill.operators.scoring import fit_tiers
from lendmill.plans.portfolio import base, predictions, with_tier
from lendmill.plans.registry import query
from lendmill.plans.woe_queries import _woe_sql
from lendmill.session import shared_path
from lendmill.sources import artifacts, readers, schemas, writers
from lendmill.sources.domain import Domain

# Columns of the declared instalment file that the driver tables can fill.
INSTALMENT_COLUMNS = ["sk_id_prev", "sk_id_curr", "num_instalment_number", "days_instalment", "days_entry_payment", "amt_instalment", "amt_payment"]


def _instalment_csv(dom: Domain) -> str:
    """The instalments as a CSV data set with the declared columns, written by Spark."""
    path = shared_path(dom.spark, "instalments-csv")
    rows = dom.installments.withColumn("num_instalment_number", (F.col("days_instalment") / 30).cast("int"))
    writers.write_csv(schemas.INSTALLMENTS.conform(rows).drop("created_at").select(*[c for c in schemas.INSTALLMENTS.columns if c != "created_at"]), path)
    return path


def _instalment_schema():
    fields = [f for f in schemas.INSTALLMENTS.reading_struct().fields if f.name != "created_at"]
    return type(schemas.INSTALLMENTS.reading_struct())(fields)


@query("src_csv_typed", sql="""
    SELECT count(*) AS n_rows, sum(sk_id_curr)::BIGINT AS sum_id, count(days_entry_payment) AS n_paid,
      sum(round(amt_instalment * 100))::BIGINT AS cents FROM installments""")
def src_csv_typed(dom: Domain) -> DataFrame:
    df = readers.read_csv(dom.spark, _instalment_csv(dom), _instalment_schema())
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("sk_id_curr").alias("sum_id"), F.count("days_entry_payment").alias("n_paid"),
        F.sum(F.round(F.col("amt_instalment") * 100)).cast("bigint").alias("cents"),
    )


@query("src_csv_pruned", sql="SELECT sk_id_curr, days_instalment, days_entry_payment FROM installments",
       digits={"days_instalment": 2, "days_entry_payment": 2})
def src_csv_pruned(dom: Domain) -> DataFrame:
    df = readers.read_csv(dom.spark, _instalment_csv(dom), _instalment_schema(), ["sk_id_curr", "days_instalment", "days_entry_payment"])
    return df.select(F.col("sk_id_curr").cast("bigint"), F.col("days_instalment").cast("double"), F.col("days_entry_payment").cast("double"))


@query("src_csv_latin1", sql="SELECT s_name AS name, 'Straße zum Händler ' || s_suppkey AS description FROM supplier")
def src_csv_latin1(dom: Domain) -> DataFrame:
    """A dictionary of the suppliers, stored in Latin-1 and read back."""
    path = shared_path(dom.spark, "dictionary")
    rows = dom.table("supplier").select("s_suppkey", F.col("s_name").alias("Row"), F.concat(F.lit("Straße zum Händler "), F.col("s_suppkey").cast("string")).alias("Description"))
    rows.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return readers.read_dictionary(dom.spark, path)


@query("src_parquet", sql="SELECT o_orderkey, o_totalprice FROM orders")
def src_parquet(dom: Domain) -> DataFrame:
    return readers.read_parquet(dom.spark, f"{dom.folder}/orders.parquet", ["o_orderkey", "o_totalprice"])


@query("src_first_existing", sql="SELECT count(*) AS n_rows, sum(o_orderkey)::BIGINT AS sum_key FROM orders")
def src_first_existing(dom: Domain) -> DataFrame:
    df = readers.read_first(dom.spark, [f"{dom.folder}/no_such_orders.parquet", f"{dom.folder}/orders.parquet"])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("sum_key"))


_MAPS = f"""
    SELECT 'woe' AS artifact, feature || '/' || bin AS item, woe AS value FROM ({_woe_sql('base_app', ['credit_income_ratio', 'code_gender'], 'is_train = 1')})
    UNION ALL SELECT 'stats', 'credit_income_ratio', median(credit_income_ratio) FROM base_app WHERE is_train = 1
    UNION ALL SELECT 'stats', 'credit_term', median(credit_term) FROM base_app WHERE is_train = 1
    UNION ALL SELECT 'tiers', 'edge0', 0e0 UNION ALL SELECT 'tiers', 'edge1', q[1] FROM tier_marks UNION ALL SELECT 'tiers', 'edge2', q[2] FROM tier_marks
    UNION ALL SELECT 'tiers', 'edge3', q[3] FROM tier_marks UNION ALL SELECT 'tiers', 'edge4', 1e0"""


@query("src_json_maps", sql=_MAPS, digits={"value": 7})
def src_json_maps(dom: Domain) -> DataFrame:
    """WoE map, feature statistics and tier edges of the train rows, written as JSON and read back as one flat table."""
    rows = base(dom).filter("is_train = 1")
    features = ["credit_income_ratio", "code_gender"]
    paths = {k: shared_path(dom.spark, k) for k in ("woe", "stats", "tiers")}
    artifacts.save_json(woe.fit_woe(rows, features), paths["woe"])
    artifacts.save_json(feature_stats(rows, ["credit_income_ratio", "credit_term"]), paths["stats"])
    artifacts.save_tiers(dom.spark, fit_tiers(rows.select("pred_prob"), model="boosted"), paths["tiers"])
    tiers = artifacts.load_tiers(dom.spark, paths["tiers"])
    edges = dom.spark.createDataFrame([(f"edge{i}", float(e)) for i, e in enumerate(tiers.edges)], "item string, value double")
    maps = artifacts.load_woe(dom.spark, paths["woe"])
    return concat_rows(
        maps.select(F.lit("woe").alias("artifact"), F.concat_ws("/", "feature", F.coalesce("category", F.col("bin_id").cast("string"))).alias("item"), F.col("woe").alias("value")),
        artifacts.load_stats(dom.spark, paths["stats"]).select(F.lit("stats").alias("artifact"), F.col("feature").alias("item"), F.col("median").alias("value")),
        edges.select(F.lit("tiers").alias("artifact"), "item", "value"),
    )


@query("snk_parquet", sql="SELECT count(*) AS n_rows, sum(round(amt_credit * 100))::BIGINT AS cents FROM application")
def snk_parquet(dom: Domain) -> DataFrame:
    path = shared_path(dom.spark, "application")
    writers.write_parquet(dom.application, path)
    df = readers.read_parquet(dom.spark, path)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.round(F.col("amt_credit") * 100)).cast("bigint").alias("cents"))


@query("snk_csv", sql="SELECT sk_id_curr, pred_prob AS target FROM application WHERE is_train = 0")
def snk_csv(dom: Domain) -> DataFrame:
    """The submission file of the test applications."""
    path = shared_path(dom.spark, "submission")
    writers.write_submission(dom.application.filter("is_train = 0"), path)
    return dom.spark.read.schema("sk_id_curr bigint, target double").option("header", True).csv(path)


@query("snk_table_append", sql="SELECT 2 * count(*) AS n_rows FROM application")
def snk_table_append(dom: Domain) -> DataFrame:
    """Two appends into one external table."""
    path = shared_path(dom.spark, "warehouse")
    table = "application_" + path.rsplit("-", 1)[1]
    slim = dom.application.select("sk_id_curr", "target")
    writers.append_table(slim, table, path)
    writers.append_table(slim, table, path)
    return dom.spark.table(table).agg(F.count(F.lit(1)).alias("n_rows"))


@query("snk_keyed_merge", sql="""
    SELECT sk_id_curr, 'v1' AS model_version, CASE WHEN sk_id_curr % 3 = 0 THEN 1 - pred_prob ELSE pred_prob END AS default_probability FROM application
    UNION ALL SELECT sk_id_curr, 'v2', pred_prob / 2 FROM application WHERE is_train = 1""", digits={"default_probability": 9})
def snk_keyed_merge(dom: Domain) -> DataFrame:
    """Predictions by (client, model version): a batch, the same batch again, a correction of a third of it, another version."""
    path = shared_path(dom.spark, "predictions")
    first = dom.application.select("sk_id_curr", F.lit("v1").alias("model_version"), F.col("pred_prob").alias("default_probability"))
    corrected = first.filter("sk_id_curr % 3 = 0").withColumn("default_probability", 1 - F.col("default_probability"))
    other = dom.application.filter("is_train = 1").select("sk_id_curr", F.lit("v2").alias("model_version"), (F.col("pred_prob") / 2).alias("default_probability"))
    for batch in (first, first, corrected, other):
        writers.merge_by_key(batch, path)
    return writers.read_keyed(dom.spark, path)


@query("sch_declared", sql="""
    SELECT 'application' AS tbl, 'emp_anomaly' AS column_name, count(*) AS n_rows, 0::BIGINT AS n_null FROM application
    UNION ALL SELECT 'bureau', 'amt_credit_sum_debt', count(*), 0 FROM bureau
    UNION ALL SELECT 'previous_application', 'amt_down_payment', count(*), 0 FROM previous_application
    UNION ALL SELECT 'installments_payments', 'amt_payment', count(*), count(*) - count(amt_payment) FROM installments
    UNION ALL SELECT 'pos_cash_balance', 'cnt_instalment', count(*), count(*) - count(cnt_instalment) FROM pos_cash
    UNION ALL SELECT 'credit_card_balance', 'amt_drawings_current', count(*), 0 FROM credit_card
    UNION ALL SELECT 'application_features', 'goods_credit_ratio', count(*), count(*) - count(goods_credit_ratio) FROM base_app
    UNION ALL SELECT 'predictions', 'model_version', count(*), 0 FROM application""")
def sch_declared(dom: Domain) -> DataFrame:
    """All eight tables cast to their declarations: rows, and nulls left in one telling column."""
    tables = {
        "application": (dom.application, "emp_anomaly"),
        "bureau": (dom.bureau, "amt_credit_sum_debt"),
        "previous_application": (dom.previous, "amt_down_payment"),
        "installments_payments": (dom.installments, "amt_payment"),
        "pos_cash_balance": (dom.pos_cash, "cnt_instalment"),
        "credit_card_balance": (dom.credit_card, "amt_drawings_current"),
        "application_features": (base(dom), "goods_credit_ratio"),
        "predictions": (dom.application.withColumn("default_probability", F.col("pred_prob")), "model_version"),
    }
    parts = []
    for name, (df, column) in tables.items():
        conformed = schemas.TABLES[name].conform(df)
        parts.append(conformed.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(column).isNull()).alias("n_null")).select(
            F.lit(name).alias("tbl"), F.lit(column).alias("column_name"), "n_rows", "n_null"))
    return concat_rows(*parts)


_KEYS = {
    "application": ["sk_id_curr"], "bureau": ["sk_id_bureau"], "previous_application": ["sk_id_prev"],
    "application_features": ["sk_id_curr"], "predictions": ["sk_id_curr", "model_version"],
}
_KEYED = {
    "application": "application", "bureau": "bureau", "previous_application": "previous_application", "application_features": "base_app",
    "predictions": "(SELECT sk_id_curr, 'lgbm_v1' AS model_version FROM application)",
}


@query("chk_pk_unique", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS tbl, {' || chr(47) || '.join(f'CAST({c} AS VARCHAR)' for c in k)} AS key, count(*) AS n_rows FROM {_KEYED[t]} GROUP BY ALL HAVING count(*) > 1"
    for t, k in _KEYS.items()))
def chk_pk_unique(dom: Domain) -> DataFrame:
    """Repeated values of the five declared keys."""
    tables = {
        "application": dom.application, "bureau": dom.bureau, "previous_application": dom.previous,
        "application_features": base(dom), "predictions": dom.application.select("sk_id_curr", F.lit("lgbm_v1").alias("model_version")),
    }
    orders, lines = (dom.table(t).count() for t in ("orders", "lineitem"))
    rows = dict.fromkeys(tables, orders) | dict.fromkeys(("bureau", "previous_application"), lines)
    parts = [
        checks.repeated_keys(tables[t], k, rows[t]).select(F.lit(t).alias("tbl"), F.concat_ws("/", *[F.col(c).cast("string") for c in k]).alias("key"), "n_rows")
        for t, k in _KEYS.items()
    ]
    return concat_rows(*parts)


@query("chk_fk_orphans", sql="""
    SELECT 'bureau' AS child, count(DISTINCT b.sk_id_curr) AS orphan_keys, count(*) AS orphan_rows FROM bureau b
      WHERE NOT EXISTS (SELECT 1 FROM application a WHERE a.sk_id_curr = b.sk_id_curr)
    UNION ALL SELECT 'installments', count(DISTINCT b.sk_id_curr), count(*) FROM installments b
      WHERE NOT EXISTS (SELECT 1 FROM application a WHERE a.sk_id_curr = b.sk_id_curr)
    UNION ALL SELECT 'customers', count(DISTINCT c_custkey), count(*) FROM customer
      WHERE NOT EXISTS (SELECT 1 FROM application a WHERE a.sk_id_curr = c_custkey)
    UNION ALL SELECT 'parts', count(DISTINCT l_partkey), count(*) FROM lineitem
      WHERE NOT EXISTS (SELECT 1 FROM application a WHERE a.sk_id_curr = l_partkey + 14000)""")
def chk_fk_orphans(dom: Domain) -> DataFrame:
    """Clean references (bureau, instalments, customers) and one that breaks by construction (parts, shifted)."""
    children = {
        "bureau": dom.bureau.select("sk_id_curr"),
        "installments": dom.installments.select("sk_id_curr"),
        "customers": dom.table("customer").select(F.col("c_custkey").alias("sk_id_curr")),
        "parts": dom.table("lineitem").select((F.col("l_partkey") + 14000).alias("sk_id_curr")),
    }
    rows = 3 * dom.table("lineitem").count() + sum(dom.table(t).count() for t in ("customer", "orders"))
    return checks.orphan_keys(children, dom.application.select("sk_id_curr"), "sk_id_curr", rows)


@query("chk_domain", sql="""
    SELECT 'tier_known' AS rule, count(*) FILTER (WHERE risk_tier NOT IN ('Very Low', 'Low', 'Medium', 'High')) AS n_rows FROM tiered_app
    UNION ALL SELECT 'probability_range', count(*) FILTER (WHERE NOT pred_prob BETWEEN 0 AND 1) FROM tiered_app
    UNION ALL SELECT 'adult', count(*) FILTER (WHERE NOT age_years >= 18.5) FROM tiered_app
    UNION ALL SELECT 'occupation', count(*) FILTER (WHERE NOT occupation_type <> 'NATION_3') FROM tiered_app""")
def chk_domain(dom: Domain) -> DataFrame:
    rows = with_tier(base(dom), dom)
    return checks.violations(rows, {
        "tier_known": F.col("risk_tier").isin("Very Low", "Low", "Medium", "High"),
        "probability_range": F.col("pred_prob").between(0, 1),
        "adult": F.col("age_years") >= 18.5,
        "occupation": F.col("occupation_type") != "NATION_3",
    })


NULLABLE = ["sk_id_curr", "occupation_type", "amt_goods_price", "ext_source_1", "ext_source_3", "own_car_age", "days_employed"]


@query("chk_not_null", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM base_app" for c in NULLABLE))
def chk_not_null(dom: Domain) -> DataFrame:
    return checks.null_counts(base(dom), NULLABLE)


@query("col_computed_case", sql="""
    SELECT sk_id_curr, CASE WHEN is_train = 0 THEN NULL WHEN pred_prob >= 5e-1 AND target = 1 THEN 1
      WHEN pred_prob < 5e-1 AND target = 0 THEN 1 ELSE 0 END AS is_correct FROM application""")
def col_computed_case(dom: Domain) -> DataFrame:
    actual = F.when(F.col("is_train") == 1, F.col("target"))
    return dom.application.select("sk_id_curr", checks.is_correct(F.col("pred_prob"), actual).alias("is_correct"))


@query("chk_required_cols", sql="SELECT count(*) AS n_rows FROM application")
def chk_required_cols(dom: Domain) -> DataFrame:
    checked = checks.require_columns(dom.application, ["sk_id_curr", "pred_prob"], "vintage")
    return checked.agg(F.count(F.lit(1)).alias("n_rows"))


@query("sql_rowcounts", sql="""
    SELECT 'Application' AS tbl, count(*) AS n_rows FROM application UNION ALL SELECT 'Bureau', count(*) FROM bureau
    UNION ALL SELECT 'PreviousApplication', count(*) FROM previous_application UNION ALL SELECT 'InstallmentsPayments', count(*) FROM installments
    UNION ALL SELECT 'POSCashBalance', count(*) FROM pos_cash UNION ALL SELECT 'CreditCardBalance', count(*) FROM credit_card""")
def sql_rowcounts(dom: Domain) -> DataFrame:
    return union_counts({
        "Application": dom.application, "Bureau": dom.bureau, "PreviousApplication": dom.previous,
        "InstallmentsPayments": dom.installments, "POSCashBalance": dom.pos_cash, "CreditCardBalance": dom.credit_card,
    })


@query("set_union_all", sql="""
    SELECT 'orders' AS tbl, count(*) AS n_rows FROM orders UNION ALL SELECT 'customer', count(*) FROM customer
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'nation', count(*) FROM nation""")
def set_union_all(dom: Domain) -> DataFrame:
    return union_counts({t: dom.table(t) for t in ("orders", "customer", "lineitem", "nation")})
