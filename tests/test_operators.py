"""Hand-computed expectations and properties of the operators."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from lendmill.operators import clean, decision, encode, evaluate, explain, features, losses, monitor, pd_model, rollups, scenario, scoring, segments, woe
from lendmill.operators.checks import require_columns
from lendmill.params import MACRO_SCENARIOS, Scenario
from lendmill.plans import load_all
from lendmill.plans.portfolio import portfolio
from lendmill.session import shared_path
from lendmill.sources import schemas
from tests.conftest import SMALL
from tests.short_models import short_models  # noqa: F401

pytestmark = pytest.mark.usefixtures("short_models")

APPLICATION = "sk_id_curr bigint, name_contract_type string, amt_credit double, amt_goods_price double, pred_prob double"


def values(df, c):
    return [r[0] for r in df.select(c).collect()]


# ---- severity, exposure, stages -------------------------------------------------------------


def test_lgd_contract_rows(spark):
    df = spark.createDataFrame([(1, "Cash loans", 100000.0, 0.0, 0.1), (2, "Consumer loans", 100000.0, 90000.0, 0.1)], APPLICATION)
    assert values(df, losses.lgd(df)) == [0.75, 0.45]
    assert values(df, losses.lgd(df)) == values(df, losses.lgd(df))


def test_lgd_edges(spark):
    rows = [(1, None, None, None, 0.1), (2, "Revolving loans", 100.0, 70.0, 0.1), (3, "Cash loans", 100.0, 200.0, 0.1), (4, "Other", 100.0, 71.0, 0.1)]
    df = spark.createDataFrame(rows, APPLICATION)
    assert values(df, losses.lgd(df)) == [0.65, 0.85, pytest.approx(0.55 - 0.2), 0.65]


def test_existing_lgd_is_reused(spark):
    df = spark.createDataFrame([("0.5",), ("bad",), (None,), ("2",)], "lgd string")
    assert values(df, losses.lgd(df)) == [0.5, 0.65, 0.65, 0.95]


def test_ead_converts_the_undrawn_limit(spark):
    df = spark.createDataFrame([(1, "Revolving loans", 100.0, 0.0, 0.1), (2, "Cash loans", 100.0, 0.0, 0.1), (3, "Cash loans", None, 0.0, 0.1)], APPLICATION)
    assert values(df, losses.ead(df)) == [pytest.approx(115.0), 100.0, 0.0]


def test_stage_rules(spark):
    schema = "pred_prob double, bureau_bad_debt_flag int, inst_late_ratio double, prev_refused_ratio double"
    rows = [(0.1, None, None, None), (0.2, 0, 0.3, 0.5), (0.21, 0, 0.0, 0.0), (0.1, 1, 0.0, 0.0), (0.1, 0, 0.31, 0.0), (0.1, 0, 0.0, 0.51), (0.7, 0, 0.0, 0.0), (0.71, 0, 0.0, 0.0),
            (None, 0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, schema)
    assert values(df, losses.stage(df)) == [1, 1, 2, 2, 2, 2, 2, 3, 1]
    basic = losses.stage_basic(F.col("pred_prob"), F.col("bureau_bad_debt_flag"), F.col("inst_late_ratio"))
    assert values(df, basic) == [1, 1, 2, 2, 2, 1, 2, 3, 1]
    assert values(df, losses.stage_dashboard(F.col("pred_prob"))) == [1, 2, 2, 1, 1, 1, 3, 3, 3]


def test_lifetime_pd(spark):
    df = spark.createDataFrame([(0.2, 24.0), (0.2, 6.0), (0.2, None), (0.0, 12.0)], "pred_prob double, credit_term double")
    rows = losses.add_pd_term(df).collect()
    assert rows[0]["pd_lifetime"] == pytest.approx(1 - 0.8**2)
    assert rows[1]["pd_lifetime"] == 0.2  # never below the 12-month PD
    assert rows[2]["pd_lifetime"] == pytest.approx(1 - 0.8**3)
    assert rows[3]["pd_12m"] == 0.001


def test_scenario_weights_must_sum_to_one(spark):
    df = spark.createDataFrame([(0.1, 0.2)], "pd_12m double, pd_lifetime double")
    with pytest.raises(ValueError):
        losses.add_macro_overlay(df, {**MACRO_SCENARIOS, "Extra": Scenario(0.3, 1.0, 0.0, 0.0)})


def test_portfolio_properties(dom):
    rows = portfolio(dom)
    bad = rows.agg(
        F.count_if(~F.col("stage").isin(1, 2, 3)), F.count_if(F.col("ecl") > F.col("ead") * (1 + 1e-12)), F.count_if(F.col("pd_lifetime") < F.col("pd_12m")),
        F.count_if(~F.col("lgd").between(0.2, 0.95)), F.count_if(F.col("ecl").isNull()),
    ).first()
    assert list(bad) == [0] * 5
    assert rows.count() == dom.application.count()


def test_migration_rows_sum_to_hundred_or_zero(spark):
    df = spark.createDataFrame([(0.1, 100.0), (0.5, 50.0)], "pred_prob double, ead double")
    for r in scenario.migration(df, percent=True).collect():
        assert r["to_stage1"] + r["to_stage2"] + r["to_stage3"] == pytest.approx(0.0 if r["stage_t"] == 3 else 100.0)


def test_projection_needs_a_month(spark):
    df = spark.createDataFrame([(0.1,)], "pred_prob double")
    with pytest.raises(ValueError):
        scenario.ecl_projection(df, months=0)
    assert scenario.ecl_projection(df, months=15).count() == 60


def test_required_columns(spark):
    with pytest.raises(KeyError):
        require_columns(spark.range(1), ["nope"], "test")


# ---- cleaning and features ------------------------------------------------------------------


def test_sentinel_and_recode(spark):
    df = spark.createDataFrame([(365243, "XNA"), (-5, "M"), (None, None)], "d bigint, g string")
    out = clean.recode(clean.flag_sentinel(df, "d", "flag"), "g").collect()
    assert [tuple(r) for r in out] == [(None, "Unknown", 1), (-5, "M", 0), (None, None, 0)]


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "t string")
    assert clean.mode_values(df, ["t"]) == {"t": "a"}


def test_utilization_edges(spark):
    df = spark.createDataFrame([(50.0, 0.0), (500.0, 100.0), (-10.0, 100.0), (None, 100.0)], "amt_balance double, amt_credit_limit_actual double")
    assert values(clean.utilization(df), "utilization_ratio") == [0.0, 2.0, -0.1, 0.0]


def test_empty_table_cleans(spark, dom):
    assert clean.clean_bureau(dom.bureau.filter("false")).count() == 0


def test_ext_composites_skip_nulls(spark):
    df = spark.createDataFrame([(0.2, None, 0.4), (None, None, None), (0.5, None, None)], "ext_source_1 double, ext_source_2 double, ext_source_3 double")
    rows = features.add_ext_composites(df).collect()
    assert rows[0]["ext_source_mean"] == pytest.approx(0.3) and rows[0]["ext_source_std"] == pytest.approx(math.sqrt(0.02))
    assert rows[1]["ext_source_mean"] is None and rows[1]["ext_source_product"] == 1.0 and rows[1]["ext_source_std"] == 0.0
    assert rows[2]["ext_source_std"] == 0.0


def test_null_client_is_dropped(spark):
    df = spark.createDataFrame([(None, 1), (1, 2)], "sk_id_curr int, sk_id_prev int")
    for c in ("name_contract_status", "name_contract_type"):
        df = df.withColumn(c, F.lit("x"))
    for c in ("amt_credit", "amt_annuity", "amt_down_payment", "days_decision"):
        df = df.withColumn(c, F.lit(1.0))
    assert rollups.previous_rollup(df).count() == 1


def test_one_client_with_most_rows(spark):
    """A hot client changes nothing: the aggregates combine before the shuffle."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("sk_id_curr"), F.col("id").alias("sk_id_prev"), F.lit("Refused").alias("name_contract_status"),
        F.lit("Cash loans").alias("name_contract_type"), F.lit(1.0).alias("amt_credit"), F.lit(1.0).alias("amt_annuity"), F.lit(1.0).alias("amt_down_payment"),
        F.lit(-1).alias("days_decision"))
    out = rollups.previous_derived(rollups.previous_rollup(df))
    assert out.filter("sk_id_curr = 1").first()["prev_app_count"] == 10001
    assert out.agg(F.sum("prev_app_count")).first()[0] == 30000


def test_schema_conform(spark):
    df = spark.createDataFrame([("7", "x", None)], "sk_id_bureau string, credit_day_overdue string, cnt_credit_prolong int")
    row = schemas.BUREAU.conform(df).first()
    assert row["sk_id_bureau"] == 7 and row["credit_day_overdue"] == 0 and row["cnt_credit_prolong"] == 0 and row["amt_credit_sum"] is None
    assert all(set(t.required) <= set(t.columns) and set(t.defaults) <= set(t.columns) for t in schemas.TABLES.values())


# ---- encoding and scorecard -----------------------------------------------------------------


def test_too_many_categories_is_an_error(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("t"))
    with pytest.raises(ValueError):
        encode.categories(df, ["t"], limit=10)


def test_high_correlation_is_not_greedy(spark):
    df = spark.range(200).select(
        F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), (F.col("id") * 3.0).alias("c"), F.rand(1).alias("d"))
    assert {r["feature"]: r["n_partners"] for r in encode.high_correlation(df, ["a", "b", "c", "d"]).collect()} == {"b": 1, "c": 2}


def test_bins_cover_all_values(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("target"))
    df = df.withColumn("x", F.when(F.col("x") > 3, F.col("x")))
    counts = woe.bin_counts(df, woe.fit_bins(df, ["x"]))
    assert counts.agg(F.sum("total")).first()[0] == df.filter("x is not null").count()


def test_repeated_edges_merge(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 600, 0.0).otherwise(F.col("id")).cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("target"))
    edges = woe.fit_bins(df, ["x"])[0].edges
    assert len(edges) < 11 and list(edges) == sorted(set(edges))


def test_unseen_values_are_neutral(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), (F.col("id") % 10).cast("string").alias("t"), (F.col("id") % 3 == 0).cast("int").alias("target"))
    fitted = woe.fit_woe(df, ["x", "t"])
    other = spark.createDataFrame([(-5.0, "new"), (1000.0, None), (None, "3"), (0.0, "3")], "x double, t string")
    rows = woe.apply_woe(other, fitted).collect()
    assert [r["x_woe"] for r in rows[:3]] == [0.0, 0.0, 0.0] and rows[3]["x_woe"] != 0.0
    assert rows[0]["t_woe"] == 0.0 and rows[1]["t_woe"] == 0.0 and rows[2]["t_woe"] == rows[3]["t_woe"]


def test_woe_without_events_is_empty(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), F.lit(0).alias("target"))
    assert woe.woe_table(df, woe.fit_bins(df, ["x"])).count() == 0


# ---- evaluation -----------------------------------------------------------------------------


def test_auc_by_hand_and_monotone(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "pred_prob double, target int")
    assert evaluate.auc(evaluate.roc(df)).first()[0] == pytest.approx(0.75)
    moved = df.withColumn("pred_prob", F.exp("pred_prob") * 3)
    assert evaluate.auc(evaluate.roc(moved)).first()[0] == pytest.approx(0.75)


def test_auc_with_ties(spark):
    df = spark.range(4000).select((F.col("id") % 500 / 500.0).alias("pred_prob"), ((F.col("id") * 7919) % 5 == 0).cast("int").alias("target"))
    pairs = df.groupBy("pred_prob").agg(F.sum("target").alias("p"), F.sum(1 - F.col("target")).alias("n")).toPandas()
    higher = sum(a.p * b.n * (1.0 if a.pred_prob > b.pred_prob else 0.5 if a.pred_prob == b.pred_prob else 0.0) for a in pairs.itertuples() for b in pairs.itertuples())
    assert evaluate.auc(evaluate.roc(df)).first()[0] == pytest.approx(higher / (pairs.p.sum() * pairs.n.sum()), abs=1e-12)


def test_single_class_has_no_auc(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0)], "pred_prob double, target int")
    assert evaluate.auc(evaluate.roc(df)).first()[0] is None


def test_sweep_equals_single_thresholds(dom):
    swept = {round(r["threshold"], 2): r for r in decision.sweep(dom.application).collect()}
    for t in (0.02, 0.3, 0.94):
        one = decision.profit_at(dom.application, 0.02 + round((t - 0.02) * 100) * 0.01).first()
        assert (one["tp"], one["fp"], one["tn"], one["fn"]) == tuple(swept[t][c] for c in ("tp", "fp", "tn", "fn"))
        assert one["net_profit_m"] == pytest.approx(swept[t]["net_profit_m"])


def test_folds_are_balanced(dom):
    folds = pd_model.stratified_folds(dom.application.select("sk_id_curr", "target")).groupBy("target", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in folds if r["target"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


# ---- explanations, monitoring, scoring ------------------------------------------------------


def test_contributions_add_up(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, None)], "sk_id_curr int, a double, b double")
    rows = explain.contributions(df, {"a": 2.0, "b": -1.0}).collect()
    assert [(r["a_contrib"], r["b_contrib"]) for r in rows] == [(-2.0, 0.0), (2.0, 0.0)]


def test_no_drift_is_stable(spark):
    df = spark.range(1000).select((F.col("id") % 100).cast("double").alias("x"), (F.col("id") < 500).alias("is_train"))
    row = monitor.stability_index(monitor.drift_shares(df, ["x"], F.col("is_train"))).first()
    assert abs(row["psi"]) < 1e-9 and row["band"] == "Stable"
    moved = df.withColumn("x", F.when(F.col("is_train"), F.col("x")).otherwise(F.col("x") + 80))
    assert monitor.stability_index(monitor.drift_shares(moved, ["x"], F.col("is_train"))).first()["band"] == "Retrain"


def test_scoring_example_row(spark):
    df = spark.createDataFrame([(0.72, 350000.0, 120000.0, 18000.0, 38.0)], "ext_source_2 double, amt_credit double, amt_income_total double, amt_annuity double, age_years double")
    row = scoring.auto_ratios(df).first()
    assert row["credit_income_ratio"] == pytest.approx(2.916667, abs=1e-6)
    assert row["annuity_income_ratio"] == pytest.approx(0.15) and row["credit_term"] == pytest.approx(19.4444, abs=1e-4)


def test_rejects_name_the_fields(spark):
    schema = "ext_source_2 double, amt_credit double, age_years double, cnt_children int"
    df = spark.createDataFrame([(0.5, 1.0, 18.0, 15), (1.1, 0.0, 17.9, 16), (None, None, None, None)], schema)
    assert values(df, scoring.reject_reasons(df)) == [[], ["ext_source_2", "amt_credit", "age_years", "cnt_children"], []]


def test_tier_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.279,), (0.28,), (1.0,), (1.5,), (None,)], "p double")
    assert values(df, scoring.assign_tier(F.col("p"))) == ["Very Low", "Very Low", "Low", "High", "High", "High"]


def test_top_factors_keep_feature_order_on_ties(spark):
    df = spark.createDataFrame([(2.0, 2.0, 1.0, 5.0)], "a double, b double, c double, z double")
    medians = {"a": 1.0, "b": 1.0, "c": 1.0, "z": 0.0}
    assert values(df, scoring.top_factors(df, medians, 2)) == [["a", "b"]]


def test_segment_bins_outside_are_null(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1e10, 1.0), (100000.0, 0.5)], "amt_credit double, amt_annuity double")
    assert values(df, segments.credit_bin()) == [None, None, "$0–100k"]


# ---- models and streams ---------------------------------------------------------------------


def run(spark, name):
    return load_all()[name].run(spark, SMALL)


def test_batch_marks_bad_rows_and_keeps_all(spark, dom):
    rows = run(spark, "sco_batch")
    assert rows.count() == dom.application.count()
    unknown = rows.filter("risk_tier = 'Unknown'")
    assert unknown.count() > 0 and unknown.filter("pd_calibrated <> 0 or ecl_estimate <> 0 or recommendation not like 'ERROR: %'").count() == 0
    assert rows.filter("risk_tier <> 'Unknown' and not pd_calibrated between 0.001 and 0.999").count() == 0


def test_out_of_fold_covers_every_client_once(spark, dom):
    rows = run(spark, "mod_oof")
    assert rows.count() == rows.select("sk_id_curr").distinct().count() == dom.application.count()
    assert rows.filter("pred_prob is null or not pred_prob between 0 and 1").count() == 0


def test_calibration_is_monotone(spark):
    rows = run(spark, "mod_calibrate").select("pred_prob", "pd_calibrated").distinct().orderBy("pred_prob").collect()
    steps = [r["pd_calibrated"] for r in rows]
    assert all(a <= b + 1e-12 for a, b in zip(steps, steps[1:]))


@pytest.mark.parametrize("name,rows", [("mod_logistic", None), ("mod_gbt", None), ("mod_forest", None), ("mod_leaderboard", 4), ("mod_tune", 9), ("xai_pdp", None), ("xai_contrib", None), ("xai_waterfall", 30), ("xai_by_tier", None),
                                       ("ecl_lgd_model", 2), ("sco_ensemble", None), ("src_json_maps", None)])
def test_model_queries_run(spark, name, rows):
    out = run(spark, name)
    n = out.count()
    assert n > 0 and (rows is None or n == rows)


def test_stream_equals_batch(spark, dom):
    from lendmill.streaming import scorer

    source, sink, marks = (shared_path(spark, n) for n in ("in", "out", "marks"))
    rows = dom.application.select("sk_id_curr", "amt_credit", "pred_prob", F.col("application_date").cast("timestamp").alias("application_date"))
    rows.repartition(5).write.parquet(source)
    stream = scorer.read_applications(spark, source, rows.schema, files_per_trigger=1)
    columns = ["sk_id_curr", "pd_calibrated", "risk_tier", "ecl_estimate", "recommendation"]
    scorer.start_scoring(scorer.score_rows(stream).select(*columns), sink, marks).awaitTermination()
    # a restart with the same checkpoint adds nothing
    scorer.start_scoring(scorer.score_rows(stream).select(*columns), sink, marks).awaitTermination()
    batch = scorer.score_rows(rows).select(*columns)
    assert sorted(map(tuple, spark.read.parquet(sink).select(*columns).collect())) == sorted(map(tuple, batch.collect()))


def test_watermarked_windows_append(spark, dom):
    from lendmill.streaming import scorer

    source, sink, marks = (shared_path(spark, n) for n in ("in", "out", "marks"))
    rows = dom.application.select("pred_prob", F.col("application_date").cast("timestamp").alias("application_date"))
    rows.coalesce(1).write.parquet(source)
    stream = scorer.read_applications(spark, source, rows.schema)
    scorer.start_windows(scorer.high_risk_windows(stream, lateness="30 days"), sink, marks).awaitTermination()
    closed = spark.read.parquet(sink)
    batch = scorer.high_risk_windows(rows)
    assert 0 < closed.count() <= batch.count()
    assert closed.exceptAll(batch).count() == 0
