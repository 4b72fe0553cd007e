"""Data-quality profile of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import count_when, melt, numeric_columns, row_sum, share_when, spread
from lendmill.operators.quantiles import exact_quantiles
from lendmill.params import SENTINEL_DAYS


def value_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value and their percentage of all rows, for all listed columns in one pass.

    Nulls are not a value but count in the percentage base.
    """
    counts = melt(df, columns, "string", name="column_name").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    totals = counts.groupBy("column_name").agg(F.sum("n_rows").alias("__total"))
    return counts.filter(F.col("value").isNotNull()).join(F.broadcast(totals), "column_name").select(  # one row per column
        "column_name", "value", "n_rows", (F.col("n_rows") * 100.0 / F.col("__total")).cast("double").alias("pct")
    )


def duplicate_rows(df: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each identical row (or identical key)."""
    groups = df.groupBy(*(key or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
    )


def missing_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return spread(one, {"missing_rate": "double"}, {c: {"missing_rate": F.col(c)} for c in columns}, name="column_name")


def missing_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values, most missing first."""
    return missing_rates(df, columns).filter("missing_rate > 0").orderBy(F.desc("missing_rate"), "column_name")


def missing_bands(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number of columns over 40 %, over 15 % and up to 15 % missing."""
    rate = F.col("missing_rate")
    band = F.when(rate > 0.40, "over 40%").when(rate > 0.15, "15-40%").otherwise("0-15%")
    return missing_rates(df, columns).filter(rate > 0).groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n_columns"))


def sentinel_profile(df: DataFrame, columns: Sequence[str], sentinel: int = SENTINEL_DAYS) -> DataFrame:
    """Sentinel rows per column, and the range of the real values."""
    aggs, rows = [], {}
    for c in columns:
        real = F.when(F.col(c) != sentinel, F.col(c).cast("double"))
        aggs += [
            count_when(F.col(c) == sentinel).alias(f"{c}_n"),
            share_when(F.col(c) == sentinel).alias(f"{c}_s"),
            F.min(real).alias(f"{c}_lo"),
            F.max(real).alias(f"{c}_hi"),
        ]
        rows[c] = {"n_sentinel": F.col(f"{c}_n"), "pct_sentinel": F.col(f"{c}_s") * 100, "min_real": F.col(f"{c}_lo"), "max_real": F.col(f"{c}_hi")}
    types = {"n_sentinel": "bigint", "pct_sentinel": "double", "min_real": "double", "max_real": "double"}
    return spread(df.agg(*aggs), types, rows, name="column_name")


def tail_quantiles(df: DataFrame, column: str) -> DataFrame:
    """Maximum, p99, p99.9 and the rows above p99."""
    p99, p999 = exact_quantiles(df, {column: [0.99, 0.999]})[column]
    c = F.col(column).cast("double")
    return df.agg(
        F.max(c).alias("max_value"),
        F.lit(p99).cast("double").alias("p99"),
        F.lit(p999).cast("double").alias("p999"),
        count_when(c > F.lit(p99)).alias("n_above_p99"),
    )


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing percentage, mean, minimum and maximum per column."""
    aggs, rows = [], {}
    for c in columns:
        v = F.col(c).cast("double")
        aggs += [F.avg(v.isNull().cast("double")).alias(f"{c}_m"), F.avg(v).alias(f"{c}_a"), F.min(v).alias(f"{c}_lo"), F.max(v).alias(f"{c}_hi")]
        rows[c] = {"missing_pct": F.col(f"{c}_m") * 100, "mean_value": F.col(f"{c}_a"), "min_value": F.col(f"{c}_lo"), "max_value": F.col(f"{c}_hi")}
    types = dict.fromkeys(["missing_pct", "mean_value", "min_value", "max_value"], "double")
    return spread(df.agg(*aggs), types, rows, name="column_name")


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows matching each named rule."""
    one = df.agg(*[count_when(rule).alias(name) for name, rule in rules.items()])
    return spread(one, {"n_rows": "bigint"}, {n: {"n_rows": F.col(n)} for n in rules}, name="rule")


def range_rules(birth: str = "days_birth", past_day: str | None = None) -> dict[str, Column]:
    """Age under 18, age over 70 and (optionally) positive values of a day column."""
    age = -F.col(birth) / F.lit(365.0)
    rules = {"age_under_18": age < 18, "age_over_70": age > 70}
    if past_day:
        rules[f"{past_day}_positive"] = F.col(past_day) > 0
    return rules


def flag_row_sums(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    total = row_sum(flags)
    return df.agg(
        F.lit(len(flags)).alias("n_flags"),
        count_when(total == 0).alias("n_without"),
        F.max(total).cast("bigint").alias("max_flags"),
    )


def categorical_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values, most frequent value (ties: smallest) and missing percentage per column."""
    long = melt(df, columns, "string", name="column_name")
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    real = F.col("value").isNotNull()
    return counts.groupBy("column_name").agg(
        count_when(real).alias("n_distinct"),
        F.min(F.when(real, F.struct((-F.col("n")).alias("neg"), F.col("value")))).getField("value").alias("top_value"),
        (F.sum(F.when(real, 0).otherwise(F.col("n"))) * 100.0 / F.sum("n")).cast("double").alias("missing_pct"),
    )


def zscore_outliers(df: DataFrame, columns: Sequence[str], limit: float = 10.0) -> DataFrame:
    """Columns with rows further than `limit` sample deviations from the mean."""
    fits = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"{c}_a") for c in columns],
        *[F.stddev_samp(F.col(c).cast("double")).alias(f"{c}_s") for c in columns],
    ).first()
    usable = [c for c in columns if fits[f"{c}_s"]]
    aggs, rows = [], {}
    for c in usable:
        v = F.col(c).cast("double")
        aggs += [count_when(F.abs((v - fits[f"{c}_a"]) / fits[f"{c}_s"]) > limit).alias(f"{c}_n"), F.max(v).alias(f"{c}_hi")]
        rows[c] = {"n_extreme": F.col(f"{c}_n"), "max_value": F.col(f"{c}_hi")}
    table = spread(df.agg(*aggs), {"n_extreme": "bigint", "max_value": "double"}, rows, name="column_name")
    return table.filter("n_extreme > 0").orderBy(F.desc("n_extreme"), "column_name")


def sign_profile(df: DataFrame, columns: Sequence[str], over: dict[str, float] | None = None) -> DataFrame:
    """Zero and negative counts, maximum, and rows over an optional limit, per column."""
    over = over or {}
    aggs, rows = [], {}
    for c in columns:
        v = F.col(c).cast("double")
        beyond = count_when(v > over[c]) if c in over else F.lit(None)
        aggs += [count_when(v == 0).alias(f"{c}_z"), count_when(v < 0).alias(f"{c}_n"), F.max(v).alias(f"{c}_hi"), beyond.cast("bigint").alias(f"{c}_o")]
        rows[c] = {"n_zero": F.col(f"{c}_z"), "n_negative": F.col(f"{c}_n"), "max_value": F.col(f"{c}_hi"), "n_over": F.col(f"{c}_o")}
    types = {"n_zero": "bigint", "n_negative": "bigint", "max_value": "double", "n_over": "bigint"}
    return spread(df.agg(*aggs), types, rows, name="column_name")


def negative_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Negative values per amount column."""
    columns = list(columns or [c for c in numeric_columns(df) if "amt_" in c.lower()])
    return rule_counts(df, {c: F.col(c) < 0 for c in columns}).withColumnRenamed("rule", "column_name").withColumnRenamed("n_rows", "n_negative")


def coverage(children: dict[str, DataFrame], parents: DataFrame, key: str) -> DataFrame:
    """Distinct clients per child table, as a percentage of the distinct parents."""
    seen = [c.select(F.lit(n).alias("child"), key).filter(F.col(key).isNotNull()) for n, c in children.items()]
    clients = reduce(DataFrame.union, seen).distinct().groupBy("child").agg(F.count(F.lit(1)).alias("n_clients"))
    total = parents.select(key).distinct().agg(F.count(key)).scalar()
    return clients.select("child", "n_clients", total.alias("n_parents"), (F.col("n_clients") * 100.0 / total).cast("double").alias("coverage_pct"))


def fan_out(df: DataFrame, key: str, many: int = 20) -> DataFrame:
    """Children per client: minimum, maximum, mean, median and clients above `many`.

    The sizes are themselves counted first, so the median works on one row per distinct size.
    """
    sizes = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    freq = sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    return freq.agg(
        F.min("size").alias("min_size"),
        F.max("size").alias("max_size"),
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).cast("double").alias("mean_size"),
        F.percentile("size", 0.5, F.col("n")).alias("median_size"),
        F.sum(F.when(F.col("size") > many, F.col("n")).otherwise(0)).alias("n_many"),
    )


def payment_mix(df: DataFrame) -> DataFrame:
    """Shares of under-, over- and exact payments, late and very late ones, in percent of all rows."""
    diff = F.col("amt_instalment") - F.col("amt_payment")
    days = F.col("days_entry_payment") - F.col("days_instalment")
    rules = {"under": diff > 0, "over": diff < 0, "exact": diff == 0, "late": days > 0, "very_late": days > 30}
    return df.agg(*[(share_when(r) * 100).alias(f"{n}_pct") for n, r in rules.items()])


def overdue_profile(df: DataFrame, column: str = "sk_dpd") -> DataFrame:
    c = F.col(column).cast("double")
    return df.agg(
        F.max(c).alias("max_dpd"), F.avg(c).alias("mean_dpd"),
        count_when(c > 0).alias("n_late"), (share_when(c > 0) * 100).alias("late_pct"), count_when(c > 30).alias("n_late_30"),
    )


def utilization_profile(df: DataFrame) -> DataFrame:
    """Balance over (limit + 1): rows over the limit and near it."""
    use = F.col("amt_balance") / (F.col("amt_credit_limit_actual") + 1)
    limit = F.col("amt_credit_limit_actual").cast("double")
    return df.agg(
        count_when(use > 1).alias("n_over_limit"), count_when(use > 0.8).alias("n_near_limit"),
        F.avg(limit).alias("mean_limit"), F.max(limit).alias("max_limit"),
    )


CARD_ROLLUP = ("cc_balance_mean", "cc_balance_max", "cc_limit_mean", "cc_utilization_mean",
               "cc_utilization_max", "cc_dpd_mean", "cc_dpd_max", "cc_months_count")


def card_preview(df: DataFrame) -> DataFrame:
    """Eight-column card rollup per client, utilization over (limit + 1)."""
    use = F.col("amt_balance") / (F.col("amt_credit_limit_actual") + 1)
    return df.filter(F.col("sk_id_curr").isNotNull()).groupBy("sk_id_curr").agg(
        F.avg("amt_balance").alias("cc_balance_mean"), F.max("amt_balance").alias("cc_balance_max"),
        F.avg("amt_credit_limit_actual").alias("cc_limit_mean"),
        F.avg(use).alias("cc_utilization_mean"), F.max(use).alias("cc_utilization_max"),
        F.avg("sk_dpd").alias("cc_dpd_mean"), F.max("sk_dpd").alias("cc_dpd_max"),
        F.count("months_balance").alias("cc_months_count"),
    )


def describe_exact(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row per column."""
    marks = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    aggs, rows = [], {}
    for c in columns:
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"{c}_n"), F.avg(v).alias(f"{c}_a"), F.stddev_samp(v).alias(f"{c}_s"), F.min(v).alias(f"{c}_lo"), F.max(v).alias(f"{c}_hi")]
        q1, q2, q3 = (F.lit(m) for m in marks[c])
        rows[c] = {"n": F.col(f"{c}_n"), "mean": F.col(f"{c}_a"), "std": F.col(f"{c}_s"), "min": F.col(f"{c}_lo"),
                   "p25": q1, "p50": q2, "p75": q3, "max": F.col(f"{c}_hi")}
    types = {"n": "bigint", **dict.fromkeys(["mean", "std", "min", "p25", "p50", "p75", "max"], "double")}
    return spread(df.agg(*aggs), types, rows, name="column_name")


def schema_difference(train: DataFrame, test: DataFrame, ignore: Sequence[str] = ("target",)) -> DataFrame:
    """Columns on one side only."""
    spark, skip = train.sparkSession, {c.lower() for c in ignore}
    names = [spark.createDataFrame([(c.lower(),) for c in d.columns if c.lower() not in skip], "column_name string") for d in (train, test)]
    only_train = names[0].exceptAll(names[1]).withColumn("only_in", F.lit("train"))
    return only_train.union(names[1].exceptAll(names[0]).withColumn("only_in", F.lit("test")))


def filled_difference(train: DataFrame, test: DataFrame, ignore: Sequence[str] = ("target",)) -> DataFrame:
    """Columns that hold a value on one side only, by schema or because all values are missing."""
    skip, sides = {c.lower() for c in ignore}, []
    for df, side in ((train, "train"), (test, "test")):
        one = df.agg(*[F.count(c).alias(c.lower()) for c in df.columns if c.lower() not in skip])
        counts = spread(one, {"n": "bigint"}, {c: {"n": F.col(c)} for c in one.columns}, name="column_name")
        sides.append(counts.filter("n > 0").select("column_name", F.lit(side).alias("only_in")))
    both = sides[0].union(sides[1])  # a row per column and side
    return both.groupBy("column_name").agg(F.min("only_in").alias("only_in"), F.count(F.lit(1)).alias("n")).filter("n = 1").drop("n")


def missing_drift(df: DataFrame, is_train: Column, columns: Sequence[str], top: int = 10, limit: float = 0.05) -> DataFrame:
    """Most-missing train columns against the test rate; 1 where they differ by more than `limit`."""
    one = df.agg(
        *[F.avg(F.when(is_train, F.col(c).isNull().cast("double"))).alias(f"{c}_tr") for c in columns],
        *[F.avg(F.when(~is_train, F.col(c).isNull().cast("double"))).alias(f"{c}_te") for c in columns],
    )
    rows = {c: {"train_rate": F.col(f"{c}_tr"), "test_rate": F.col(f"{c}_te")} for c in columns}
    table = spread(one, {"train_rate": "double", "test_rate": "double"}, rows, name="column_name")
    drifted = F.abs(F.col("train_rate") - F.col("test_rate")) > limit
    return table.orderBy(F.desc("train_rate"), "column_name").limit(top).withColumn("drifted", drifted.cast("int"))


def before_after(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Rows, columns and mean missing percentage before and after a cleaning step."""

    def shape(df: DataFrame, moment: str) -> DataFrame:
        mean_missing = sum((F.avg(F.col(c).isNull().cast("double")) for c in df.columns), F.lit(0.0)) / len(df.columns) * 100
        return df.agg(F.count(F.lit(1)).alias("n_rows"), mean_missing.alias("missing_pct")).select(
            F.lit(label).alias("label"), F.lit(moment).alias("moment"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), "missing_pct"
        )

    return shape(before, "before").union(shape(after, "after"))
