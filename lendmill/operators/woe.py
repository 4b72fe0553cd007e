"""Weight of evidence and information value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.functions.nullsafe import melt
from lendmill.functions.search import double_array, just_below, string_array, with_rank
from lendmill.operators.quantiles import exact_quantiles
from lendmill.session import materialize

FEW_VALUES = 10
HEAD_ROWS = 1_000
# Values of all one-bin-per-value features together that are searched as a constant.
CONSTANT_VALUES = 2_000

# Information-value grades, strongest first.
IV_FLAGS = ((0.50, "Suspicious"), (0.30, "Strong"), (0.10, "Medium"), (0.02, "Weak"))
DROPPED_FLAGS = ("Useless", "Suspicious")


@dataclass(frozen=True)
class FeatureBins:
    """Either right-closed numeric edges (the lowest edge included) or one bin per value."""

    feature: str
    edges: tuple[float, ...] | None = None

    def ranks(self) -> list[float]:
        """Edges for a strict search: rank k >= 1 is bin k, rank 0 and the last one are outside."""
        return [just_below(self.edges[0]), *self.edges[1:]]


def _has_few_values(df: DataFrame, features: Sequence[str]) -> set[str]:
    """Features with at most FEW_VALUES distinct values, decided exactly.

    More values than that among some rows prove a feature to have many; the distinct values of
    the others are counted.
    """
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))}
    numeric = [f for f in features if f not in text]
    few = {f for f in features if f in text}
    if not numeric:
        return few
    head = df.select(*numeric).limit(HEAD_ROWS).collect()
    open_ = [f for f in numeric if len({r[f] for r in head} - {None}) <= FEW_VALUES]
    if open_:
        values = melt(df, open_, "double").filter(F.col("value").isNotNull()).distinct()
        counts = {r["feature"]: r["n"] for r in values.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
        few |= {f for f in open_ if counts.get(f, 0) <= FEW_VALUES}
    return few


def fit_bins(df: DataFrame, features: Sequence[str], n_bins: int = 10) -> list[FeatureBins]:
    """Quantile bins with duplicate edges dropped; one bin per value for few-valued features."""
    few = _has_few_values(df, features)
    numeric = [f for f in features if f not in few]
    marks = exact_quantiles(df, {f: [k / n_bins for k in range(n_bins + 1)] for f in numeric}) if numeric else {}
    return [FeatureBins(f, None if f in few else tuple(sorted(set(marks[f])))) for f in features]


def equal_width_bins(df: DataFrame, feature: str, n_bins: int = 10) -> FeatureBins:
    """Fallback bins of equal width over the value range."""
    lo, hi = df.agg(F.min(F.col(feature).cast("double")), F.max(F.col(feature).cast("double"))).first()
    return FeatureBins(feature, tuple([lo + (hi - lo) * k / n_bins for k in range(n_bins)] + [hi]))


EVERY_ROW = "*"


def bin_counts(df: DataFrame, bins: Sequence[FeatureBins], target: str = "target", with_total: bool = False) -> DataFrame:
    """Events and rows per (feature, bin) for all features in one pass.

    Bins are numbered from 1 or named by the value; null values and values outside the edges
    have none. `with_total` adds one bin that holds every row.
    """
    entries, edges, names = [], [], []
    for i, b in enumerate(bins):
        names.append(b.feature)
        numeric = b.edges is not None
        edges.append(b.ranks() if numeric else [])
        entries.append((i, F.col(b.feature).cast("double") if numeric else None, None if numeric else F.col(b.feature).cast("string")))
    if with_total:
        names.append(EVERY_ROW)
        edges.append([])
        entries.append((len(bins), None, F.lit(EVERY_ROW)))
    pairs = F.array(*[
        F.struct(
            F.lit(i).alias("f"),
            (F.lit(None).cast("double") if number is None else number).alias("x"),
            (F.lit(None).cast("string") if text is None else text).alias("text"),
        )
        for i, number, text in entries
    ])
    long = df.select(F.col(target).alias("y"), F.inline(pairs)).filter(F.col("y").isNotNull())
    # the range check comes before the search: a filter on its result would be pushed back
    # through the search steps and repeat them
    low = F.get(double_array([e[0] if e else 0.0 for e in edges]), F.col("f"))
    high = F.get(double_array([e[-1] if e else 0.0 for e in edges]), F.col("f"))
    known = F.col("text").isNotNull() | ((F.col("x") > low) & (F.col("x") <= high))
    ranked = with_rank(long.filter(known), "x", edges, "k", "f")
    grouped = ranked.groupBy("f", "k", "text").agg(F.sum("y").cast("bigint").alias("events"), F.count(F.lit(1)).alias("total"))
    feature = F.get(F.array(*[F.lit(n) for n in names]), F.col("f"))
    return grouped.select(feature.alias("feature"), F.coalesce("text", F.col("k").cast("string")).alias("bin"), "events", "total")


def woe_table(df: DataFrame, bins: Sequence[FeatureBins], target: str = "target") -> DataFrame:
    """Smoothed event shares, WoE and IV part per (feature, bin).

    The share totals count every row, also those without a value of the feature; they come from
    one extra bin that holds all rows, so the table is read once. Without both outcomes the
    result is empty.
    """
    counts = bin_counts(df, bins, target, with_total=True).withColumn("nonevents", F.col("total") - F.col("events"))
    whole = Window.partitionBy()  # bins x features rows
    is_all = F.col("feature") == EVERY_ROW
    counted = counts.withColumns({
        "__events": F.max(F.when(is_all, F.col("events"))).over(whole),
        "__others": F.max(F.when(is_all, F.col("nonevents"))).over(whole),
    }).filter(~is_all & (F.col("__events") > 0) & (F.col("__others") > 0))
    share_event = (F.col("events") + 0.5) / (F.col("__events") + 0.5)
    share_other = (F.col("nonevents") + 0.5) / (F.col("__others") + 0.5)
    return (
        counted.withColumns({"pct_events": share_event, "pct_nonevents": share_other})
        .drop("__events", "__others")
        .withColumn("woe", F.ln(F.col("pct_events") / F.col("pct_nonevents")))
        .withColumn("iv_part", (F.col("pct_events") - F.col("pct_nonevents")) * F.col("woe"))
    )


def iv_flag(iv: Column) -> Column:
    out = None
    for limit, name in IV_FLAGS:
        out = F.when(iv > limit, name) if out is None else out.when(iv > limit, name)
    return out.otherwise("Useless")


def information_value(table: DataFrame) -> DataFrame:
    """IV per feature with its grade; the grade is taken before rounding."""
    total = table.groupBy("feature").agg(F.sum("iv_part").alias("raw"))
    return total.select("feature", F.bround("raw", 6).alias("iv"), iv_flag(F.col("raw")).alias("flag"))


def screen(df: DataFrame, features: Sequence[str], target: str = "target", n_bins: int = 10) -> DataFrame:
    """IV of all features, ranked, with the keep decision. One row per feature."""
    ivs = information_value(woe_table(df, fit_bins(df, features, n_bins), target))
    rank = F.row_number().over(Window.orderBy(F.desc("iv"), "feature"))
    return ivs.withColumn("keep", (~F.col("flag").isin(*DROPPED_FLAGS)).cast("int")).withColumn("iv_rank", rank)


def flag_counts(screened: DataFrame) -> DataFrame:
    return screened.groupBy("flag").agg(F.count(F.lit(1)).alias("n_features"))


def fit_woe(df: DataFrame, features: Sequence[str], target: str = "target", n_bins: int = 10) -> DataFrame:
    """Flat WoE map (feature, kind, bin_id, lo, hi, category, woe), fitted on the rows of `df`."""
    bins = fit_bins(df, features, n_bins)
    table = woe_table(df, bins, target)
    marks = [
        (b.feature, str(i), i, b.edges[i - 1], b.edges[i])
        for b in bins
        if b.edges is not None
        for i in range(1, len(b.edges))
    ]
    edges = df.sparkSession.createDataFrame(marks, "feature string, bin string, bin_id int, lo double, hi double")
    is_number = F.col("bin_id").isNotNull()
    return table.join(F.broadcast(edges), ["feature", "bin"], "left").select(  # bins x features rows
        "feature",
        F.when(is_number, "interval").otherwise("value").alias("kind"),
        "bin_id",
        "lo",
        "hi",
        F.when(~is_number, F.col("bin")).alias("category"),
        "woe",
    )


def apply_woe(df: DataFrame, woe_map: DataFrame, suffix: str = "_woe") -> DataFrame:
    """Replace values by the fitted WoE of their bin; unseen bins and nulls are neutral (0).

    Bins are the fitted ones, not re-derived from `df`. Intervals (bins x numeric features) become
    constant arrays with a binary search; the features with one bin per value share one map.
    """
    kinds = [r for r in woe_map.select("feature", "kind").distinct().collect() if r["feature"] in df.columns]
    by_value = sorted(r["feature"] for r in kinds if r["kind"] == "value")
    intervals: dict[str, list] = {}
    for r in woe_map.filter(F.col("kind") == "interval").orderBy("feature", "bin_id").collect():
        if r["feature"] in df.columns:
            intervals.setdefault(r["feature"], []).append(r)
    names = [*df.columns, *[f"{f}{suffix}" for f in [*intervals, *by_value]]]
    out = df
    for feature, rows in intervals.items():
        edges, leaves = [just_below(rows[0]["lo"])], [0.0]
        last = rows[0]["lo"]
        for r in rows:
            if r["lo"] != last:  # a bin that held no fitted row
                edges.append(r["lo"])
                leaves.append(0.0)
            edges.append(r["hi"])
            leaves.append(r["woe"])
            last = r["hi"]
        ranked = with_rank(out.withColumn("__x", F.col(feature).cast("double")), "__x", [edges], "__k")
        woe = F.get(double_array([*leaves, 0.0]), F.col("__k"))
        out = ranked.withColumn(f"{feature}{suffix}", F.coalesce(woe, F.lit(0.0))).drop("__x", "__k")
    if by_value:
        out = _apply_values(out, woe_map.filter((F.col("kind") == "value") & F.col("feature").isin(by_value)), by_value, suffix)
    return out.select(*names)


def _apply_values(df: DataFrame, values: DataFrame, features: Sequence[str], suffix: str, constant: int | None = None) -> DataFrame:
    """The WoE of all features with one bin per value, through one map by (feature, value).

    A short map is a constant that each row searches. A longer one is joined once: the rows'
    values are listed, matched and gathered again, whatever the number of features.
    """
    values = values.select("feature", "category", "woe")
    entries = values.limit((CONSTANT_VALUES if constant is None else constant) + 1).collect()
    if len(entries) <= (CONSTANT_VALUES if constant is None else constant):
        known = sorted((f"{r['feature']}={r['category']}", r["woe"]) for r in entries if r["category"] is not None)
        keys, woes = string_array([k for k, _ in known]), double_array([w for _, w in known])
        return df.withColumns({f"{f}{suffix}": _searched(F.concat(F.lit(f"{f}="), F.col(f).cast("string")), keys, woes, len(known)) for f in features})
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "valued")
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("category")) for f in features])
    listed = rows.select("__row", F.inline(pairs)).filter(F.col("category").isNotNull())
    matched = listed.join(values, ["feature", "category"]).groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("feature", "woe"))).alias("__woes"))
    out = rows.join(matched, "__row", "left")
    return out.withColumns({f"{f}{suffix}": F.coalesce(F.try_element_at("__woes", F.lit(f)), F.lit(0.0)) for f in features}).drop("__row", "__woes")


def _searched(key: Column, keys: Column, woes: Column, count: int) -> Column:
    """The value at `key` in sorted constant keys, 0 where it is not among them."""
    if not count:
        return F.lit(0.0)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(count.bit_length()))])
    upto = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(keys, at + step - 1) <= key, step).otherwise(0))
    place = F.transform(F.array(upto), lambda at: F.when(F.get(keys, at - 1) == key, F.get(woes, at - 1)))
    return F.coalesce(F.get(place, F.lit(0)), F.lit(0.0))
