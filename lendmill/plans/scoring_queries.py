"""Scoring rules and the streaming scorer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators import scoring
from lendmill.operators.quantiles import median
from lendmill.plans.portfolio import base
from lendmill.plans.registry import query
from lendmill.session import shared_path
from lendmill.sources.domain import Domain
from lendmill.streaming import scorer


# Wider than the span of the application dates, so that no row is late; and a date beyond it.
LATENESS = "3660 days"
CLOSING_DATE = "2100-01-01 00:00:00"


def _requests(dom: Domain) -> DataFrame:
    """Applications with two fields shifted so that the range rules bite."""
    return base(dom).select(
        "sk_id_curr", "amt_credit", "amt_income_total", "amt_annuity", "amt_goods_price", (F.col("age_years") + 10).alias("age_years"), "years_employed",
        "cnt_children", "ext_source_1", (F.col("ext_source_2") * 1.1).alias("ext_source_2"), "ext_source_3", "pred_prob")


_REQUESTS = """(SELECT sk_id_curr, amt_credit, amt_income_total, amt_annuity, amt_goods_price, age_years + 10 AS age_years, years_employed, cnt_children, ext_source_1,
  ext_source_2 * 11e-1 AS ext_source_2, ext_source_3, pred_prob FROM base_app)"""
_REASONS = "concat_ws(',', CASE WHEN ext_source_2 < 0 OR ext_source_2 > 1 THEN 'ext_source_2' END, CASE WHEN age_years < 18 OR age_years > 70 THEN 'age_years' END)"


@query("sco_validate", sql=f"SELECT sk_id_curr, CASE WHEN {_REASONS} = '' THEN 'accepted' ELSE 'rejected' END AS side, {_REASONS} AS reasons FROM {_REQUESTS}")
def sco_validate(dom: Domain) -> DataFrame:
    accepted, rejected = scoring.validate(_requests(dom))
    good = accepted.select("sk_id_curr", F.lit("accepted").alias("side"), F.lit("").alias("reasons"))
    return good.union(rejected.select("sk_id_curr", F.lit("rejected").alias("side"), F.array_join("reasons", ",").alias("reasons")))


_IMPUTED = ["ext_source_1", "ext_source_3", "amt_goods_price", "years_employed", "amt_credit"]


@query("sco_impute_row", sql="SELECT sk_id_curr, " + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM base_app WHERE is_train = 1)) AS {c}" for c in _IMPUTED)
       + ", 0e0 AS bureau_loan_count FROM base_app", digits=dict.fromkeys(_IMPUTED, 6))
def sco_impute_row(dom: Domain) -> DataFrame:
    """Gaps take the train median; a feature the request does not carry, and without a median, is 0."""
    rows = base(dom)
    medians = median(rows.filter("is_train = 1"), _IMPUTED)
    return scoring.impute_inputs(rows.select("sk_id_curr", *_IMPUTED), {**medians, "bureau_loan_count": None})


@query("sco_auto_ratios", sql="""
    SELECT sk_id_curr, amt_credit / (amt_income_total + 1e-6) AS credit_income_ratio,
      CASE WHEN sk_id_curr % 4 = 0 THEN 5e-1 ELSE amt_annuity / (amt_income_total + 1e-6) END AS annuity_income_ratio,
      CASE WHEN sk_id_curr % 3 <> 0 THEN amt_credit / (amt_annuity + 1e-6) END AS credit_term FROM application""",
    digits=dict.fromkeys(["credit_income_ratio", "annuity_income_ratio", "credit_term"], 6))
def sco_auto_ratios(dom: Domain) -> DataFrame:
    """One ratio given for some rows; credit term without its annuity for others."""
    key = F.col("sk_id_curr")
    rows = dom.application.select("sk_id_curr", "amt_credit", "amt_income_total", "amt_annuity", F.when(key % 4 == 0, 0.5).alias("annuity_income_ratio"))
    some = scoring.auto_ratios(rows)
    gap = scoring.auto_ratios(rows.select("sk_id_curr", "amt_credit", F.when(key % 3 != 0, F.col("amt_annuity")).alias("amt_annuity")))
    return some.select("sk_id_curr", "credit_income_ratio", "annuity_income_ratio").join(gap.select("sk_id_curr", "credit_term"), "sk_id_curr")


_TIER = """CASE WHEN pred_prob BETWEEN 0 AND 279e-3 THEN 'Very Low' WHEN pred_prob BETWEEN 279e-3 AND 457e-3 THEN 'Low'
  WHEN pred_prob BETWEEN 457e-3 AND 649e-3 THEN 'Medium' ELSE 'High' END"""


@query("sco_tier", sql=f"SELECT sk_id_curr, {_TIER} AS risk_tier FROM application")
def sco_tier(dom: Domain) -> DataFrame:
    return dom.application.select("sk_id_curr", scoring.assign_tier(F.col("pred_prob")).alias("risk_tier"))


_RECOMMEND = f"""CASE {_TIER} WHEN 'Very Low' THEN 'AUTO-APPROVE: Eligible for fast-track approval and preferential rate.'
  WHEN 'Low' THEN 'STANDARD: Approve via standard process. Income verification recommended.'
  WHEN 'Medium' THEN 'CONDITIONAL: Approve with conditions — reduce limit by 20%, require documentation.'
  ELSE 'REVIEW: Manual underwriter review required. Consider collateral or co-borrower.' END"""


@query("sco_recommend", sql=f"SELECT sk_id_curr, {_RECOMMEND} AS recommendation FROM application")
def sco_recommend(dom: Domain) -> DataFrame:
    return dom.application.select("sk_id_curr", scoring.recommendation(scoring.assign_tier(F.col("pred_prob"))).alias("recommendation"))


_ECL = "round_even(CAST(round(pred_prob * 65e-2 * amt_credit, 6) AS DECIMAL(38, 6)), 2)::DOUBLE"


@query("sco_ecl", sql=f"SELECT sk_id_curr, {_ECL} AS ecl_estimate FROM application", digits={"ecl_estimate": 2})
def sco_ecl(dom: Domain) -> DataFrame:
    return dom.application.select("sk_id_curr", scoring.ecl_estimate(F.col("pred_prob"), F.col("amt_credit")).alias("ecl_estimate"))


_SCORED = f"""SELECT sk_id_curr, CASE WHEN {_REASONS} = '' THEN least(greatest(pred_prob, 1e-3), 999e-3) ELSE 0 END AS pd_calibrated,
  CASE WHEN {_REASONS} = '' THEN {_TIER} ELSE 'Unknown' END AS risk_tier,
  CASE WHEN {_REASONS} = '' THEN {_RECOMMEND} ELSE 'ERROR: ' || replace({_REASONS}, ',', ', ') END AS recommendation FROM {_REQUESTS}"""


@query("sco_stream", sql=_SCORED, digits={"pd_calibrated": 6})
def sco_stream(dom: Domain) -> DataFrame:
    """Applications written as files, scored as a stream into parquet, read back."""
    source, sink, marks = (shared_path(dom.spark, n) for n in ("applications", "scored", "marks"))
    requests = _requests(dom)
    requests.write.parquet(source)
    stream = scorer.score_rows(scorer.read_applications(dom.spark, source, requests.schema))
    scorer.start_scoring(stream.select("sk_id_curr", "pd_calibrated", "risk_tier", "recommendation"), sink, marks).awaitTermination()
    return dom.spark.read.parquet(sink)


@query("sco_stream_windows", sql="""
    SELECT time_bucket(INTERVAL 30 DAYS, application_date, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n_rows,
      sum(CASE WHEN pred_prob > 48e-2 THEN 1 ELSE 0 END)::BIGINT AS n_high_risk, avg(CASE WHEN pred_prob > 48e-2 THEN 1e0 ELSE 0e0 END) AS high_risk_rate
    FROM application GROUP BY 1""", digits={"high_risk_rate": 8})
def sco_stream_windows(dom: Domain) -> DataFrame:
    """High-risk rate per 30-day window over a stream of application files, watermarked, appended to parquet.

    A window is appended once the watermark has passed its end. The files hold all dates in no
    order, so the lateness bound is wider than their span, and a closing record far in the future
    (a heartbeat of the source, in a window of its own) lets the last windows out.
    """
    source, sink, marks = (shared_path(dom.spark, n) for n in ("dated", "windows", "window-marks"))
    # wall-clock times as UTC instants: watermarks need instants, and no session zone shifts them
    instant = F.expr("timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', application_date))")
    rows = dom.application.select(instant.alias("application_date"), "pred_prob")
    rows.write.parquet(source)

    def run_once() -> None:
        stream = scorer.read_applications(dom.spark, source, rows.schema)
        scorer.start_windows(scorer.high_risk_windows(stream, lateness=LATENESS), sink, marks).awaitTermination()

    run_once()
    dom.spark.sql(f"SELECT TIMESTAMP '{CLOSING_DATE}' AS application_date, CAST(NULL AS DOUBLE) AS pred_prob").write.mode("append").parquet(source)
    run_once()
    start = F.expr("timestampadd(MICROSECOND, unix_micros(window_start), TIMESTAMP_NTZ '1970-01-01 00:00:00')")
    return dom.spark.read.parquet(sink).withColumn("window_start", start)
