"""Decision threshold economics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import count_when, has, lookup
from lendmill.functions.search import just_below, with_rank
from lendmill.params import CREDIT_BANDS, ROI_PARAMS, RoiParams

# The 93 thresholds 0.02 ... 0.94.
SWEEP = tuple(0.02 + i * 0.01 for i in range(93))


def _amount(df: DataFrame) -> Column:
    return F.col("amt_credit") if has(df, "amt_credit") else F.col("ead") if has(df, "ead") else F.lit(100000.0)


def _severity(df: DataFrame, p: RoiParams) -> Column:
    return F.col("lgd") if has(df, "lgd") else F.lit(p.lgd)


def _economics(tp: Column, fp: Column, tn: Column, fn: Column, n: Column, amt_tn: Column, amt_fp: Column, loss_fn: Column, p: RoiParams) -> dict[str, Column]:
    revenue, missed, opex = amt_tn * p.margin, amt_fp * p.opportunity, n * p.opex
    rejected = tp + fp
    return {
        "approval_rate": 1 - F.try_divide(rejected, n),
        "precision": F.coalesce(F.try_divide(tp, rejected), F.lit(0.0)),
        "recall": F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)),
        "tp": tp, "fp": fp, "tn": tn, "fn": fn,
        "revenue_tn_m": revenue / 1e6, "opp_cost_fp_m": missed / 1e6, "loss_fn_m": loss_fn / 1e6, "opex_m": opex / 1e6,
        "net_profit_m": (revenue - loss_fn - missed - opex) / 1e6,
    }


def _zero_sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0.0))


def profit_at(df: DataFrame, threshold: float, params: RoiParams = ROI_PARAMS) -> DataFrame:
    """Outcome counts and profit when scores at or above the threshold are rejected."""
    reject = F.coalesce(F.col("pred_prob") >= threshold, F.lit(False))
    bad, good, amount = F.col("target") == 1, F.col("target") == 0, _amount(df)
    one = df.agg(
        count_when(reject & bad).alias("tp"), count_when(reject & good).alias("fp"),
        count_when(~reject & good).alias("tn"), count_when(~reject & bad).alias("fn"), F.count(F.lit(1)).alias("n"),
        _zero_sum(F.when(~reject & good, amount)).alias("a_tn"), _zero_sum(F.when(reject & good, amount)).alias("a_fp"),
        _zero_sum(F.when(~reject & bad, amount * _severity(df, params))).alias("l_fn"),
    )
    cols = _economics(*[F.col(c) for c in ("tp", "fp", "tn", "fn", "n", "a_tn", "a_fp", "l_fn")], params)
    return one.select(F.lit(float(threshold)).alias("threshold"), *[c.alias(n) for n, c in cols.items()])


def sweep(df: DataFrame, thresholds: Sequence[float] = SWEEP, params: RoiParams = ROI_PARAMS) -> DataFrame:
    """`profit_at` for every threshold in one pass.

    Rows are counted once per band between thresholds; running totals over the few bands then
    give every threshold.
    """
    marks = sorted(thresholds)
    banded = with_rank(df, "pred_prob", [[just_below(m) for m in marks]], "__band")
    band = F.coalesce(F.col("__band"), F.lit(0))
    bad, good, amount = F.col("target") == 1, F.col("target") == 0, _amount(df)
    bands = banded.groupBy(band.alias("band")).agg(
        F.count(F.lit(1)).alias("n"), count_when(bad).alias("bad"), count_when(good).alias("good"),
        _zero_sum(F.when(good, amount)).alias("a_good"), _zero_sum(F.when(bad, amount * _severity(df, params))).alias("l_bad"),
    )
    listed = df.sparkSession.createDataFrame([(i, float(marks[i - 1]) if i else None) for i in range(len(marks) + 1)], "band int, threshold double")
    parts = ["n", "bad", "good", "a_good", "l_bad"]
    filled = listed.join(bands, "band", "left").fillna(0, subset=parts)
    below = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)  # one row per threshold
    every = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = filled.select(
        "threshold",
        *[F.coalesce(F.sum(c).over(below), F.lit(0)).alias(f"lo_{c}") for c in parts],
        *[F.sum(c).over(every).alias(f"all_{c}") for c in parts],
    ).filter(F.col("threshold").isNotNull())

    def above(c: str) -> Column:
        return F.col(f"all_{c}") - F.col(f"lo_{c}")

    cols = _economics(
        above("bad"), above("good"), F.col("lo_good"), F.col("lo_bad"), F.col("all_n"),
        F.col("lo_a_good"), above("a_good"), F.col("lo_l_bad"), params,
    )
    # rows without a known outcome are approved or rejected too
    cols["approval_rate"] = F.try_divide(F.col("lo_n"), F.col("all_n"))
    return totals.select("threshold", *[c.alias(n) for n, c in cols.items()])


def best_threshold(swept: DataFrame) -> DataFrame:
    """The first threshold with the highest net profit."""
    return swept.orderBy(F.desc("net_profit_m"), "threshold").limit(1)


def profit_matrix(best: DataFrame, df: DataFrame, params: RoiParams = ROI_PARAMS) -> DataFrame:
    """2 x 2 money matrix at the best threshold, on the mean credit amount, in millions."""
    mean = df.agg(F.avg("amt_credit")).scalar()
    cells = [
        ("Actual: Good", F.col("tn") * params.margin, -F.col("fp") * params.opportunity),
        ("Actual: Default", -F.col("fn") * params.lgd, F.col("tp") * params.lgd),
    ]
    rows = F.array(*[F.struct(F.lit(n).alias("actual"), a.alias("approve"), r.alias("reject")) for n, a, r in cells])
    long = best.select(F.inline(rows))
    return long.select("actual", (F.col("approve") * mean / 1e6).alias("approve_m"), (F.col("reject") * mean / 1e6).alias("reject_m"))


def decision_status(df: DataFrame, threshold: float) -> DataFrame:
    status = F.when(F.col("pred_prob") < threshold, "Approved").otherwise("Rejected")
    return df.withColumn("decision_status", status)


def credit_band(df: DataFrame) -> DataFrame:
    """Band by risk tier; other tier texts stay, no tier column means 'Unknown'."""
    if not has(df, "risk_tier"):
        return df.withColumn("credit_band", F.lit("Unknown"))
    return df.withColumn("credit_band", F.coalesce(lookup("risk_tier", CREDIT_BANDS), F.col("risk_tier")))
