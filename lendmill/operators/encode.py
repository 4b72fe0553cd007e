"""Encoding, train-only imputation and feature selection."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import count_when, flag, lookup, melt, spread, text_columns
from lendmill.operators import moments
from lendmill.operators.clean import fill
from lendmill.operators.quantiles import exact_quantiles, median
from lendmill.operators.running import running_totals
from lendmill.session import materialize

ID_COLUMNS = ("sk_id_curr", "target", "is_train")
EXPRESSIONS_PER_PASS = 250
# Values of one text column that may become columns.
MOST_COLUMNS = 1_000


@dataclass(frozen=True)
class Encoding:
    """Fitted categories: two-valued columns become 0/1, the others one column per value."""

    binary: dict[str, list[str]] = field(default_factory=dict)
    one_hot: dict[str, list[str]] = field(default_factory=dict)


def categories(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> dict[str, list[str]]:
    """Sorted distinct values per text column.

    The values become columns, so they are known to the driver; with `limit`, more values than
    that in one column are an error. `indicators` has the long form for columns with more values
    than a table may have columns.
    """
    pairs = materialize(melt(df, columns, "string").filter(F.col("value").isNotNull()).distinct(), "categories")
    if limit is not None:
        sizes = pairs.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
        wide = [r["feature"] for r in sizes.filter(F.col("n") > limit).collect()]
        if wide:
            raise ValueError(f"more than {limit} categories in {wide}")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in pairs.collect():
        found[r["feature"]].append(r["value"])
    return {c: sorted(v) for c, v in found.items()}


def fit_encoding(df: DataFrame, columns: Sequence[str] | None = None, limit: int = MOST_COLUMNS) -> Encoding:
    """Columns with at most two values are binary; a null there counts as the text 'nan'.

    More than `limit` values in a column are an error: use `dictionary` and `sparse_one_hot`.
    """
    columns = list(columns or text_columns(df, ID_COLUMNS))
    values = categories(df, columns, limit)
    binary = {c: v for c, v in values.items() if len(v) <= 2}
    if binary:
        gaps = df.agg(*[count_when(F.col(c).isNull()).alias(c) for c in binary]).first()
        binary = {c: sorted([*v, "nan"]) if gaps[c] else v for c, v in binary.items()}
    return Encoding(binary, {c: v for c, v in values.items() if len(v) > 2})


def encode_binary(df: DataFrame, encoding: Encoding) -> DataFrame:
    """Index of the value in sorted order."""
    out = {
        c: lookup(F.coalesce(F.col(c), F.lit("nan")), {v: i for i, v in enumerate(values)})
        for c, values in encoding.binary.items()
    }
    return df.withColumns(out) if out else df


def one_hot_names(column: str, values: Sequence[str]) -> dict[str, str]:
    return {v: re.sub(r"[^A-Za-z0-9_]+", "_", f"{column}_{v}") for v in values}


def encode_one_hot(df: DataFrame, encoding: Encoding) -> DataFrame:
    """One 0/1 column per value; a null is 0 everywhere."""
    out = {}
    for c, values in encoding.one_hot.items():
        out.update({name: flag(F.col(c) == v) for v, name in one_hot_names(c, values).items()})
    return (df.withColumns(out) if out else df).drop(*encoding.one_hot)


def dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): the places of all values in a one-hot vector, by column, then value; nothing is collected."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("at"), F.col(c).cast("string").alias("value")) for k, c in enumerate(columns)])
    distinct = df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()
    keyed = distinct.withColumns({"key": F.concat(F.lpad(F.col("at").cast("string"), 6, "0"), F.lit(":"), F.col("value")), "one": F.lit(1)})
    return running_totals(keyed, "key", {"upto": "one"}).select("column", "value", (F.col("upto") - 1).alias("code"))


def sparse_one_hot(df: DataFrame, columns: Sequence[str], codes: DataFrame, key: str = "sk_id_curr") -> DataFrame:
    """(key, size, indices): the one-hot form of all columns as sparse vectors of ones.

    Rows are matched with the dictionary and gathered by `key`, which must be unique. A null and a
    value that the dictionary does not hold have no index.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    listed = df.select(key, F.inline_outer(pairs))
    found = listed.join(codes, ["column", "value"], "left").groupBy(key).agg(F.sort_array(F.collect_list("code")).alias("indices"))
    return found.select(key, codes.agg(F.count(F.lit(1))).scalar().alias("size"), "indices")


def indicators(df: DataFrame, columns: Sequence[str], key: str = "sk_id_curr") -> DataFrame:
    """The ones of the one-hot form as rows (key, feature): any number of values, nothing collected."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    long = df.select(key, F.inline(entries)).filter(F.col("value").isNotNull())
    return long.select(key, F.regexp_replace(F.concat_ws("_", "column", "value"), r"[^A-Za-z0-9_]+", "_").alias("feature"))


def impute_train_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Medians of the train rows fill the gaps of all rows."""
    return fill(df, median(df.filter(F.col("is_train") == 1), columns))


def variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return moments.variances(df, columns)


def low_variance(df: DataFrame, columns: Sequence[str], limit: float = 0.01) -> DataFrame:
    """Columns to drop for near-constant values."""
    return variances(df, columns).filter(F.col("variance") < limit)


def correlation_pairs(df: DataFrame, columns: Sequence[str], limit: float = 0.95) -> DataFrame:
    """(i, j, first, second, n, r) of the column pairs with |r| over the limit, over the rows where both have a value."""
    names = F.array(*map(F.lit, columns))
    pairs = moments.correlations(df, columns).filter(F.abs("r") > limit)
    return pairs.select("i", "j", F.get(names, F.col("i")).alias("first"), F.get(names, F.col("j")).alias("second"), "n", "r")


def high_correlation(df: DataFrame, columns: Sequence[str], limit: float = 0.95) -> DataFrame:
    """Columns to drop: any earlier column, itself dropped or not, correlates above the limit."""
    return correlation_pairs(df, columns, limit).groupBy(F.col("second").alias("feature")).agg(F.count(F.lit(1)).cast("int").alias("n_partners"))


def select_features(df: DataFrame, columns: Sequence[str], variance: float = 0.01, correlation: float = 0.95) -> dict[str, str]:
    """Each column as `low_variance`, `correlated` with an earlier one, or `kept`; near-constant columns are dropped first."""
    flat = {r["feature"] for r in low_variance(df, columns, variance).collect()}
    left = [c for c in columns if c not in flat]
    close = {r["feature"] for r in high_correlation(df, left, correlation).collect()} if left else set()
    return {c: "low_variance" if c in flat else "correlated" if c in close else "kept" for c in columns}


def target_correlation(df: DataFrame, columns: Sequence[str], top: int = 20) -> DataFrame:
    """Features by absolute correlation with the target."""
    one = df.agg(*[F.abs(F.corr(F.col(c).cast("double"), F.col("target").cast("double"))).alias(c) for c in columns])
    table = spread(one, {"abs_corr": "double"}, {c: {"abs_corr": F.col(c)} for c in columns})
    return table.filter(F.col("abs_corr").isNotNull() & ~F.isnan("abs_corr")).orderBy(F.desc("abs_corr"), "feature").limit(top)


def feature_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Median, mean, sample deviation, p01 and p99 per feature."""
    marks = exact_quantiles(df, {c: [0.01, 0.5, 0.99] for c in columns})
    types = dict.fromkeys(["median", "mean", "std", "p01", "p99"], "double")
    parts = []
    for start in range(0, len(columns), EXPRESSIONS_PER_PASS // 2):
        chunk = columns[start : start + EXPRESSIONS_PER_PASS // 2]
        one = df.agg(
            *[F.avg(F.col(c).cast("double")).alias(f"{c}_a") for c in chunk],
            *[F.stddev_samp(F.col(c).cast("double")).alias(f"{c}_s") for c in chunk],
        )
        rows = {
            c: {"median": F.lit(marks[c][1]), "mean": F.col(f"{c}_a"), "std": F.col(f"{c}_s"), "p01": F.lit(marks[c][0]), "p99": F.lit(marks[c][2])}
            for c in chunk
        }
        parts.append(spread(one, types, rows))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
