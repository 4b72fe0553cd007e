"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the local cores. Every
query runs once unmeasured (code generation, file footers) and then once measured, with all
output rows produced, before the rounding that only the SQL comparison needs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lendmill.plans import load_all  # noqa: E402
from lendmill.session import build_session  # noqa: E402
from lendmill.sources.domain import Domain  # noqa: E402

HEADLINE = [
    # audit and cleaning
    "aud_value_share", "aud_full_dupes", "aud_missing_rate", "aud_quantiles", "aud_categorical", "aud_coverage", "aud_card_rollup",
    "cln_application", "cln_impute_median", "cln_zero_to_median", "chk_fk_orphans",
    # features and rollups
    "fea_ratios", "fea_bureau_quality", "agg_bureau", "agg_prev", "agg_inst", "agg_pos", "agg_card", "joi_wide_features", "fea_model_table",
    # selection and scorecard
    "sel_high_corr", "enc_one_hot", "woe_screen", "woe_apply",
    # evaluation and explanation
    "eva_auc", "eva_cv_summary", "mod_strat_folds", "mod_logistic", "mod_calibrate", "xai_deviation_top3",
    # provisions, scenarios, decisions
    "ecl_stage_summary", "ecl_by_scenario", "ecl_lgd_sensitivity", "scn_vintage", "scn_migration_pct", "scn_ecl_weighted", "scn_cohort_default",
    "scn_intraday_pivot", "roi_sweep", "seg_kpis", "seg_insights", "sql_risk_profile", "sql_collections_topn",
    # scoring and monitoring
    "sco_validate", "sco_stream", "sco_stream_windows", "mon_csi", "mon_tier_table", "mon_policy_rules",
]


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query.build(Domain(spark, folder)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_all()
    wanted = sys.argv[1:] or HEADLINE
    timings = {}
    for name in wanted:
        run(registry[name], spark, folder)
        timings[name] = round(run(registry[name], spark, folder), 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings, "sf": scale}))


if __name__ == "__main__":
    main()
