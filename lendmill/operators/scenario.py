"""Vintage, migration, projection and cohort views of a scored portfolio."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import clip, cut, flag, has, lookup, numeric_or, spread
from lendmill.operators.checks import require_columns
from lendmill.operators.losses import ecl_by_stage, lifetime_pd, stage_basic
from lendmill.params import (
    AGE_BANDS,
    HIGH_RISK_PD,
    MACRO_PATHS,
    MONTHLY_RUNOFF,
    PATH_WEIGHTS,
    REFERENCE_DATE,
    TENURE_BANDS,
    TERM_BUCKETS,
    WEEKDAYS,
)

DATE_CANDIDATES = ("application_date", "app_date", "disbursement_date", "origination_date")


def pd_input(df: DataFrame) -> Column:
    return clip(F.coalesce(numeric_or(df, "pred_prob", 0.10), F.lit(0.10)), 0.001, 0.999)


def lgd_input(df: DataFrame) -> Column:
    return clip(F.coalesce(numeric_or(df, "lgd", 0.65), F.lit(0.65)), 0.05, 0.95)


def ead_input(df: DataFrame) -> Column:
    return clip(F.coalesce(numeric_or(df, "ead", None), numeric_or(df, "amt_credit", 0.0)), low=0.0)


def _signals(df: DataFrame) -> tuple[Column | None, Column | None]:
    bad = numeric_or(df, "bureau_bad_debt_flag", None) if has(df, "bureau_bad_debt_flag") else None
    late = numeric_or(df, "inst_late_ratio", None) if has(df, "inst_late_ratio") else None
    return bad, late


@dataclass(frozen=True)
class DateSource:
    """Where the application date comes from, fitted on the data."""

    column: str
    quality: str
    note: str

    def value(self) -> Column:
        if self.quality == "actual":
            return F.col(self.column).try_cast("timestamp")
        start = F.lit(REFERENCE_DATE).cast("date")
        if self.quality == "proxy":
            days = clip(F.abs(F.coalesce(F.col(self.column), F.lit(-365))), 0, 1460)
            return F.date_sub(start, days.cast("int")).cast("timestamp")
        return start.cast("timestamp")


def fit_date_source(df: DataFrame) -> DateSource:
    """The first explicit date column that parses in more than 90 % of the rows, else a proxy."""
    present = [c for c in DATE_CANDIDATES if has(df, c)]
    if present:
        shares = df.agg(*[F.avg(F.col(c).try_cast("timestamp").isNotNull().cast("double")).alias(c) for c in present]).first()
        for c in present:
            if (shares[c] or 0.0) > 0.90:
                return DateSource(c, "actual", f"Using explicit date column `{c}`.")
    if has(df, "days_id_publish"):
        return DateSource("days_id_publish", "proxy", "Proxy date: reference date minus abs(days_id_publish); not a true application date.")
    return DateSource("constant_ref_date", "fallback", "No date proxy available; all rows get the reference date.")


def quarter_key(date: Column) -> Column:
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


def month_key(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def term_bucket(df: DataFrame) -> Column:
    months = clip(F.coalesce(numeric_or(df, "credit_term", 24.0), F.lit(24.0)), 6.0, 60.0)
    return cut(months, TERM_BUCKETS.edges, TERM_BUCKETS.labels, TERM_BUCKETS.include_lowest)


def vintage(df: DataFrame, source: DateSource | None = None) -> DataFrame:
    """Default rate, count, mean PD and exposure per (quarter, term bucket)."""
    require_columns(df, ["sk_id_curr", "pred_prob"], "vintage")
    source = source or fit_date_source(df)
    outcome = "target" if has(df, "target") else "pred_prob"
    exposure = "ead" if has(df, "ead") else "amt_credit"
    keyed = df.withColumns({
        "cohort": F.coalesce(quarter_key(source.value()), F.lit("NaT")),
        "mob_bucket": F.coalesce(term_bucket(df), F.lit("nan")),
    })
    rows = keyed.groupBy("cohort", "mob_bucket").agg(
        F.avg(outcome).alias("default_rate"),
        F.count("sk_id_curr").alias("n_loans"),
        F.avg("pred_prob").alias("avg_pd"),
        F.sum(exposure).alias("total_ead"),
    )
    return rows.withColumns({
        "default_rate_pct": F.col("default_rate") * 100,
        "avg_pd_pct": F.col("avg_pd") * 100,
        "total_ead_b": F.col("total_ead") / 1e9,
        "date_quality": F.lit(source.quality),
        "date_note": F.lit(source.note),
        "mob_quality": F.lit("term_bucket_proxy"),
        "default_source": F.lit(outcome),
    }).orderBy("cohort", "mob_bucket")


def migration(df: DataFrame, scalar: float = 1.25, percent: bool = False) -> DataFrame:
    """3x3 stage migration under a PD stress, by exposure in billions or in percent of the row."""
    require_columns(df, ["pred_prob"], "migration")
    bad, late = _signals(df)
    p, exposure = pd_input(df), ead_input(df)
    staged = df.select(
        stage_basic(p, bad, late).alias("s0"),
        stage_basic(clip(p * scalar, 0.001, 0.999), bad, late).alias("s1"),
        exposure.alias("ead"),
    )
    cells = [(a, b) for a in (1, 2, 3) for b in (1, 2, 3)]
    one = staged.agg(*[
        F.coalesce(F.sum(F.when((F.col("s0") == a) & (F.col("s1") == b), F.col("ead"))) / 1e9, F.lit(0.0)).alias(f"c{a}{b}")
        for a, b in cells
    ])

    def cell(a: int, b: int) -> Column:
        if not percent:
            return F.col(f"c{a}{b}")
        total = F.col(f"c{a}1") + F.col(f"c{a}2") + F.col(f"c{a}3")
        return F.coalesce(F.try_divide(F.col(f"c{a}{b}"), total), F.lit(0.0)) * 100

    items = {a: {f"to_stage{b}": cell(a, b) for b in (1, 2, 3)} for a in (1, 2, 3)}
    return spread(one, dict.fromkeys(["to_stage1", "to_stage2", "to_stage3"], "double"), items, name="stage_t")


def extend_path(path: tuple[float, ...], months: int) -> list[float]:
    """The first `months` values, the last one repeated beyond the end."""
    return [path[min(m, len(path) - 1)] for m in range(months)]


def scenario_steps(months: int) -> Column:
    """(scenario, month, scalar, runoff, weight) for every path and month, as one constant array."""
    if months < 1:
        raise ValueError("months must be >= 1")
    return F.array(*[
        F.struct(
            F.lit(name).alias("scenario"),
            F.lit(m).alias("month"),
            F.lit(float(scalar)).alias("scalar"),
            F.lit(MONTHLY_RUNOFF**m).alias("runoff"),
            F.lit(PATH_WEIGHTS[name]).alias("weight"),
        )
        for name, path in MACRO_PATHS.items()
        for m, scalar in enumerate(extend_path(path, months), start=1)
    ])


def ecl_projection(df: DataFrame, months: int = 12) -> DataFrame:
    """Provision, exposure and stage exposure per path and month.

    Each row is expanded in flight over the fixed (path, month) steps and folded into at most
    4 x months groups by the map-side aggregate, so the table is read once and only those
    groups are shuffled.
    """
    require_columns(df, ["pred_prob"], "ecl_projection")
    bad, late = _signals(df)
    slim = df.select(
        pd_input(df).alias("p0"),
        lgd_input(df).alias("lgd"),
        ead_input(df).alias("ead0"),
        clip(F.coalesce(numeric_or(df, "credit_term", 36.0), F.lit(36.0)), 6.0, 120.0).alias("term0"),
        (F.lit(None).cast("double") if bad is None else bad).alias("bad"),
        (F.lit(None).cast("double") if late is None else late).alias("late"),
        (F.col("ecl") if has(df, "ecl") else pd_input(df) * lgd_input(df) * ead_input(df)).alias("ecl_now"),
    )
    steps = slim.select("*", F.inline(scenario_steps(months)))
    steps = steps.withColumns({
        "ead": F.col("ead0") * F.col("runoff"),
        "p": clip(F.col("p0") * F.col("scalar"), 0.001, 0.999),
        "term": clip(clip(F.col("term0") - F.col("month"), 1.0, 120.0), 6.0, 120.0),
    })
    steps = steps.withColumn("stage", stage_basic(F.col("p"), F.col("bad"), F.col("late")))
    steps = steps.withColumn("ecl", ecl_by_stage(F.col("stage"), F.col("p"), lifetime_pd(F.col("p"), F.col("term")), F.col("lgd"), F.col("ead")))

    def billions(c: Column) -> Column:
        return F.bround(F.coalesce(F.sum(c), F.lit(0.0)) / 1e9, 3)

    return steps.groupBy("scenario", "month", "weight").agg(
        billions(F.col("ecl")).alias("ecl_b"),
        billions(F.col("ead")).alias("ead_b"),
        F.bround(F.sum("ecl") / F.greatest(F.sum("ead"), F.lit(1.0)) * 100, 3).alias("coverage_pct"),
        *[billions(F.when(F.col("stage") == s, F.col("ead"))).alias(f"stage{s}_ead_b") for s in (1, 2, 3)],
        (F.sum("ecl_now") / 1e9).alias("ecl_current_b"),
        (F.sum("ead0") / 1e9).alias("ead_current_b"),
    ).withColumn("projection_method", F.lit("deterministic_pd_lgd_ead_stage_scenario"))


def weighted_projection(projection: DataFrame) -> DataFrame:
    """Probability-weighted provision per month, from the rounded path values."""
    return projection.groupBy("month").agg(
        F.sum(F.col("ecl_b") * F.col("weight")).alias("ecl_b"),
        F.avg("ead_b").alias("ead_b"),
        F.avg("coverage_pct").alias("coverage_pct"),
        F.first("ecl_current_b").alias("ecl_current_b"),
        F.first("ead_current_b").alias("ead_current_b"),
    ).withColumns({
        "scenario": F.lit("Probability Weighted"),
        "weight": F.lit(1.0),
        "projection_method": F.lit("weighted_average_of_macro_scenarios"),
    })


def full_projection(df: DataFrame, months: int = 12) -> DataFrame:
    paths = ecl_projection(df, months)
    return paths.unionByName(weighted_projection(paths), allowMissingColumns=True)


def scenario_band(projection: DataFrame) -> DataFrame:
    """Provision between the best and the worst path per month."""
    return projection.groupBy("month").agg(
        F.max(F.when(F.col("scenario") == "Optimistic", F.col("ecl_b"))).alias("low_ecl_b"),
        F.max(F.when(F.col("scenario") == "Severe", F.col("ecl_b"))).alias("high_ecl_b"),
    )


def projection_kpis(projection: DataFrame, migrations: DataFrame) -> DataFrame:
    """Horizon provision per path, its change, the capital buffer and the stage-1 downgrade share."""
    last = F.struct("month", "ecl_b")

    def at_end(name: str) -> Column:
        return F.max(F.when(F.col("scenario") == name, last)).getField("ecl_b")

    downgrade = migrations.filter("stage_t = 1").select((F.col("to_stage2") + F.col("to_stage3")).alias("d")).scalar()
    now = F.max("ecl_current_b")
    return projection.agg(
        now.alias("ecl_now_b"),
        *[at_end(n).alias(f"{n.lower()}_b") for n in MACRO_PATHS],
        (at_end("Severe") - at_end("Base")).alias("capital_buffer_b"),
        *[((at_end(n) - now) / now * 100).alias(f"{n.lower()}_change_pct") for n in MACRO_PATHS],
    ).withColumn("downgrade_pct", downgrade)


def age_band(df: DataFrame) -> Column:
    age = numeric_or(df, "age_years", 35.0) if has(df, "age_years") else -numeric_or(df, "days_birth", -35.0 * 365) / 365.0
    return cut(clip(F.rint(age), 18.0, 70.0), AGE_BANDS.edges, AGE_BANDS.labels, AGE_BANDS.include_lowest)


def tenure_band(df: DataFrame) -> Column:
    years = numeric_or(df, "years_employed", 0.0) if has(df, "years_employed") else -numeric_or(df, "days_employed", 0.0) / 365.0
    return cut(clip(F.coalesce(years, F.lit(0.0)), 0.0, 20.0), TENURE_BANDS.edges, TENURE_BANDS.labels, TENURE_BANDS.include_lowest)


def band_order(c: Column, labels: tuple[str, ...]) -> Column:
    return lookup(c, {label: i for i, label in enumerate(labels)}, len(labels))


def cohort_default(df: DataFrame) -> DataFrame:
    """Default rate, exposure, mean ECL and PD per (age band, job-tenure band)."""
    require_columns(df, ["sk_id_curr", "pred_prob"], "cohort_default")
    outcome = "target" if has(df, "target") else "pred_prob"
    exposure = "ead" if has(df, "ead") else "amt_credit"
    loss = "ecl" if has(df, "ecl") else "pred_prob"
    keyed = df.withColumns({
        "age_band": F.coalesce(age_band(df), F.lit("nan")),
        "tenure_band": F.coalesce(tenure_band(df), F.lit("nan")),
    })
    rows = keyed.groupBy("age_band", "tenure_band").agg(
        F.avg(outcome).alias("default_rate"),
        F.count("sk_id_curr").alias("n_loans"),
        F.sum(exposure).alias("total_ead"),
        F.avg(loss).alias("avg_ecl"),
        F.avg("pred_prob").alias("avg_pd"),
    )
    return rows.withColumns({
        "default_rate_pct": F.col("default_rate") * 100,
        "total_ead_b": F.col("total_ead") / 1e9,
        "avg_ecl_k": F.col("avg_ecl") / 1e3,
        "default_source": F.lit(outcome),
    }).orderBy(band_order(F.col("age_band"), AGE_BANDS.labels), "tenure_band")


def weekday(df: DataFrame) -> Column:
    """Short weekday from the text column or from 0/1 columns (first largest); else 'Unknown'."""
    prefix = "weekday_appr_process_start"
    if has(df, prefix):
        return lookup(F.upper(F.col(prefix).cast("string")), WEEKDAYS, "Unknown")
    flags = [c for c in df.columns if c.lower().startswith(prefix + "_")]
    if not flags:
        return F.lit("Unknown")
    top = F.greatest(*[F.col(c) for c in flags]) if len(flags) > 1 else F.col(flags[0])
    names = F.coalesce(*[F.when(F.col(c) == top, c[len(prefix) + 1 :].upper()) for c in flags])
    return lookup(names, WEEKDAYS, "Unknown")


def intraday_rows(df: DataFrame) -> DataFrame:
    """(weekday, hour, high-risk flag) of the applications with a valid hour."""
    require_columns(df, ["sk_id_curr", "pred_prob", "hour_appr_process_start"], "intraday")
    hour = F.rint(numeric_or(df, "hour_appr_process_start", None))
    rows = df.select(
        "sk_id_curr", weekday(df).alias("weekday"), hour.alias("hour"), flag(pd_input(df) > HIGH_RISK_PD).alias("is_high_risk")
    )
    return rows.filter(F.col("hour").between(0, 23)).withColumn("hour", F.col("hour").cast("int"))


def intraday_pivot(rows: DataFrame) -> DataFrame:
    """High-risk percentage per weekday and hour (columns h0..h23), empty cells 0."""
    known = rows.filter(F.col("weekday") != "Unknown")
    cells = [
        (F.coalesce(F.avg(F.when(F.col("hour") == h, F.col("is_high_risk"))), F.lit(0.0)) * 100).alias(f"h{h}") for h in range(24)
    ]
    return known.groupBy("weekday").agg(*cells).orderBy(band_order(F.col("weekday"), tuple(WEEKDAYS.values())))


def _risk_by(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(
        F.avg("is_high_risk").alias("high_risk_rate"), F.count("sk_id_curr").alias("volume")
    ).withColumn("high_risk_pct", F.col("high_risk_rate") * 100)


def hourly_risk(rows: DataFrame) -> DataFrame:
    return _risk_by(rows, "hour").orderBy("hour")


def daily_risk(rows: DataFrame) -> DataFrame:
    return _risk_by(rows.filter(F.col("weekday") != "Unknown"), "weekday").orderBy(band_order(F.col("weekday"), tuple(WEEKDAYS.values())))


def peak_and_off_hours(hourly: DataFrame) -> DataFrame:
    """Riskiest hour (first on ties), mean off-hour and business-hour rates and their difference."""
    hour, pct = F.col("hour"), F.col("high_risk_pct")
    peak = F.max(F.struct(pct.alias("pct"), (-hour).alias("neg_hour")))
    off = F.avg(F.when((hour < 6) | (hour >= 22), pct))
    business = F.avg(F.when((hour >= 9) & (hour < 17), pct))
    return hourly.agg(
        (-peak.getField("neg_hour")).alias("peak_hour"),
        peak.getField("pct").alias("peak_pct"),
        off.alias("off_hours_pct"),
        business.alias("business_hours_pct"),
        (off - business).alias("delta_pct"),
    )
