"""Contract checks: keys, references, domains, required columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import count_when, spread

# Rows of a task where keys are counted.
ROWS_PER_TASK = 1_000_000


def require_columns(df: DataFrame, columns: Sequence[str], context: str) -> DataFrame:
    """Fail at analysis time when columns are absent."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise KeyError(f"{context} requires missing columns: {missing}")
    return df


def _dealt(df: DataFrame, key: Sequence[str], rows: int | None) -> DataFrame:
    """`df` dealt by key to tasks of about `ROWS_PER_TASK` rows; `rows` is their number, about.

    Counting keys that are mostly unique combines nothing before the shuffle, it only fills a table
    of all keys in each task. Here a task holds the keys of its own share.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-(df.count() if rows is None else rows) // ROWS_PER_TASK)), *key)


def repeated_keys(df: DataFrame, key: Sequence[str], rows: int | None = None) -> DataFrame:
    """Keys that occur more than once, with their row count; `rows`, if known, is about the size of `df`."""
    return _dealt(df.select(*key), key, rows).groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def orphan_keys(children: dict[str, DataFrame], parent: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """Per child table: keys without a parent, and their rows; `rows`, if known, is about the size of all tables together.

    Children and parents meet in one shuffle and are counted per key; a null key has no parent.
    """
    tables = [*children.values(), parent]
    tagged = reduce(DataFrame.union, [t.select(F.col(key).alias("key"), F.lit(k).alias("tag")) for k, t in enumerate(tables)])
    counts = [F.count_if(F.col("tag") == k).alias(f"n{k}") for k in range(len(tables))]
    counted = _dealt(tagged, ["key"], rows).groupBy("key").agg(*counts)
    orphans = counted.filter(F.col("key").isNull() | (F.col(f"n{len(children)}") == 0))
    seen = orphans.agg(*[c for k in range(len(children)) for c in (F.count_if(F.col(f"n{k}") > 0).alias(f"k{k}"), F.coalesce(F.sum(f"n{k}"), F.lit(0)).alias(f"r{k}"))])
    return spread(seen, {"orphan_keys": "bigint", "orphan_rows": "bigint"}, {name: {"orphan_keys": F.col(f"k{k}"), "orphan_rows": F.col(f"r{k}")} for k, name in enumerate(children)}, name="child")


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule; like a SQL CHECK, an unknown result passes."""
    one = df.agg(*[F.count_if(F.coalesce(~rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    return spread(one, {"n_rows": "bigint"}, {n: {"n_rows": F.col(n)} for n in rules}, name="rule")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count per column, in one pass."""
    columns = list(columns or df.columns)
    one = df.agg(*[count_when(F.col(c).isNull()).alias(c) for c in columns])
    return spread(one, {"n_null": "bigint"}, {c: {"n_null": F.col(c)} for c in columns}, name="column_name")


def is_correct(probability: Column, actual: Column) -> Column:
    """1 when the 0.5 decision equals the outcome, null without an outcome."""
    agrees = ((probability >= 0.5) & (actual == 1)) | ((probability < 0.5) & (actual == 0))
    return F.when(actual.isNull(), None).when(agrees, 1).otherwise(0)
