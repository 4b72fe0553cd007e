"""Monitoring tables: drift, calibration, missed defaults, policy and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import count_when, flag, lookup, spread, step
from lendmill.functions.search import with_rank
from lendmill.operators.evaluate import roc
from lendmill.operators.quantiles import exact_quantiles
from lendmill.params import ALERTS, TIER_POLICIES, Alert

SHARE_FLOOR = 1e-6

# Inner edges of ten equal-width probability bins.
RELIABILITY_EDGES = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)


def drift_shares(df: DataFrame, features: Sequence[str], is_train: Column, n_bins: int = 10) -> DataFrame:
    """Train and test share per (feature, train-quantile bin); the outer bins are open."""
    grid = [k / n_bins for k in range(1, n_bins)]
    marks = exact_quantiles(df.filter(is_train), {f: grid for f in features})
    edges = [sorted({m for m in marks[f] if m is not None}) for f in features]
    pairs = F.array(*[F.struct(F.lit(i).alias("f"), F.col(f).cast("double").alias("x")) for i, f in enumerate(features)])
    long = df.select(is_train.alias("__train"), F.inline(pairs)).filter(F.col("x").isNotNull())
    names = F.get(F.array(*[F.lit(f) for f in features]), F.col("f"))
    long = with_rank(long, "x", edges, "bin", "f").withColumn("feature", names)
    cells = long.groupBy("feature", "bin").agg(count_when(F.col("__train")).alias("n_train"), count_when(~F.col("__train")).alias("n_test"))
    totals = cells.groupBy("feature").agg(F.sum("n_train").alias("t_train"), F.sum("n_test").alias("t_test"))

    def share(top: str, bottom: str) -> Column:
        return F.greatest(F.coalesce(F.try_divide(F.col(top), F.col(bottom)), F.lit(0.0)), F.lit(SHARE_FLOOR))

    return cells.join(F.broadcast(totals), "feature").select(  # one row per feature
        "feature", "bin", share("n_train", "t_train").alias("train_share"), share("n_test", "t_test").alias("test_share")
    )


def stability_index(shares: DataFrame) -> DataFrame:
    """PSI per feature with its band: 0.10 and 0.25."""
    a, b = F.col("train_share"), F.col("test_share")
    psi = shares.groupBy("feature").agg(F.sum((a - b) * F.ln(a / b)).alias("psi"))
    return psi.withColumn("band", F.when(F.col("psi") > 0.25, "Retrain").when(F.col("psi") > 0.10, "Investigate").otherwise("Stable"))


def reliability(df: DataFrame, score: str = "pred_prob", label: str = "target") -> DataFrame:
    """Mean score and outcome rate per equal-width bin."""
    bins = step(F.col(score), RELIABILITY_EDGES, list(range(10)))
    return df.withColumn("bin", bins).filter(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("event_rate")
    )


def calibration_error(table: DataFrame) -> DataFrame:
    """Expected calibration error over the reliability bins."""
    gap = F.abs(F.col("mean_score") - F.col("event_rate"))
    return table.agg((F.sum(gap * F.col("n_rows")) / F.sum("n_rows")).alias("ece"))


def precision_recall(df: DataFrame, score: str = "pred_prob", label: str = "target") -> DataFrame:
    points = roc(df, score, label)
    return points.select(
        "score", "pos", "tp", "fp",
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("n_pos")).alias("recall"),
        "n_pos",
    )


def average_precision(points: DataFrame) -> DataFrame:
    """Precision weighted by the recall gained at each threshold."""
    return points.agg(F.sum(F.try_divide(F.col("pos"), F.col("n_pos")) * F.col("precision")).alias("average_precision"))


def missed_defaults(df: DataFrame, features: Sequence[str], threshold: float) -> DataFrame:
    """Feature means of the defaults below the threshold against all clients."""
    missed = (F.col("target") == 1) & (F.col("pred_prob") < threshold)
    one = df.agg(*[F.avg(f).alias(f"{f}_a") for f in features], *[F.avg(F.when(missed, F.col(f))).alias(f"{f}_m") for f in features])
    rows = {f: {"mean_all": F.col(f"{f}_a"), "mean_missed": F.col(f"{f}_m"), "delta": F.col(f"{f}_m") - F.col(f"{f}_a")} for f in features}
    return spread(one, dict.fromkeys(["mean_all", "mean_missed", "delta"], "double"), rows)


def tier_table(rows: DataFrame) -> DataFrame:
    """Share, default rate, mean PD, provision and policy per tier."""
    total = rows.agg(F.count(F.lit(1))).scalar()
    table = rows.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("n_loans"), F.avg("target").alias("default_rate"),
        F.avg("pred_prob").alias("avg_pd"), F.sum("ecl").alias("total_ecl"),
    )
    return table.withColumns({"share_pct": (F.col("n_loans") * 100.0 / total).cast("double"), "policy": lookup("risk_tier", TIER_POLICIES)})


def policy_rules(df: DataFrame) -> DataFrame:
    """Policy flags, the allowed credit after the ceilings, and the list of rules that apply."""
    rules = {
        "credit_ceiling": F.col("credit_income_ratio") > 5.0,
        "collateral": F.col("bureau_bad_debt_flag") == 1,
        "manual_review": F.col("prev_refused_ratio") > 0.30,
        "early_outreach": F.col("inst_late_ratio") > 0.10,
        "youth_pricing": (F.col("age_years") >= 20) & (F.col("age_years") <= 25),
    }
    out = df.withColumns({name: flag(rule) for name, rule in rules.items()})
    allowed = (
        F.col("amt_credit")
        * F.when(F.col("credit_ceiling") == 1, 0.80).otherwise(1.0)
        * F.when(F.col("collateral") == 1, 0.75).otherwise(1.0)
    )
    names = F.array_compact(F.array(*[F.when(F.col(n) == 1, F.lit(n)) for n in rules]))
    return out.withColumns({"allowed_credit": allowed, "rules": names})


def policy_summary(flagged: DataFrame) -> DataFrame:
    """Clients and credit per policy rule."""
    names = ["credit_ceiling", "collateral", "manual_review", "early_outreach", "youth_pricing"]
    one = flagged.agg(
        *[F.sum(n).alias(f"{n}_n") for n in names],
        *[F.coalesce(F.sum(F.when(F.col(n) == 1, F.col("amt_credit"))), F.lit(0.0)).alias(f"{n}_a") for n in names],
    )
    rows = {n: {"n_clients": F.col(f"{n}_n"), "amt_credit": F.col(f"{n}_a")} for n in names}
    return spread(one, {"n_clients": "bigint", "amt_credit": "double"}, rows, name="rule")


def alerts(metrics: DataFrame, rules: Sequence[Alert] = ALERTS) -> DataFrame:
    """(metric, value) against the thresholds: breach flag and the most severe action."""
    out = metrics
    action = None
    for r in rules:
        beyond = F.col("value") > r.limit if r.above else F.col("value") < r.limit
        hit = (F.col("metric") == r.metric) & beyond
        action = F.when(hit, r.action) if action is None else action.when(hit, r.action)
    return out.withColumn("action", action.otherwise("None")).withColumn("breached", flag(F.col("action") != "None"))
