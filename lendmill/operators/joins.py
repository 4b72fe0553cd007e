"""Joins of tables that are unique on their key, and checks around them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import spread


def lookup_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "inner") -> DataFrame:
    """Join a large table to a table that is unique on its key.

    One plan at every size: Spark broadcasts a dimension under the session's threshold, and
    adaptive execution splits the partition of a key that holds a large share of the rows.
    """
    return fact.join(dim, fact[fact_key] == dim[dim_key], how)


def attach_rollups(parent: DataFrame, rollups: Sequence[DataFrame], key: str = "sk_id_curr") -> DataFrame:
    """Left-join one-row-per-client rollups; every shuffle uses the same key, so it happens once."""
    return reduce(lambda left, right: left.join(right, key, "left"), rollups, parent)


def row_count_guard(parent: DataFrame, rollups: dict[str, DataFrame], key: str = "sk_id_curr") -> DataFrame:
    """Per rollup: key groups, repeated keys, and whether a left join keeps the row count."""
    parts = [
        r.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
            F.count(F.lit(1)).alias("n_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_repeats"),
        ).select(F.lit(name).alias("rollup"), "n_keys", "n_repeats", (F.col("n_repeats") == 0).cast("int").alias("keeps_rows"))
        for name, r in rollups.items()
    ]
    return reduce(DataFrame.union, parts)


def missing_after_join(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of parents without history, per rollup column, non-zero only."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return spread(one, {"missing_rate": "double"}, {c: {"missing_rate": F.col(c)} for c in columns}).filter(F.col("missing_rate") > 0)


def fill_no_history(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """No history means no activity: 0 in the listed columns."""
    return df.fillna(0, subset=list(columns))


def union_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    return reduce(
        DataFrame.union,
        [t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("tbl"), "n_rows") for name, t in tables.items()],
    )


def concat_rows(*parts: DataFrame) -> DataFrame:
    """Stack frames by column name; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
