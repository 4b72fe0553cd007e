"""Null-safe column helpers.

Spark's `least`/`greatest` skip nulls and ANSI division by zero raises, so every clip, ratio
and bin in the library goes through this module. A missing value is null, never NaN.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c: Column | str, low=None, high=None) -> Column:
    """Limit to [low, high]; null stays null. Bounds may be numbers or columns."""
    c = as_column(c)
    out = c
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(high))
    return F.when(c.isNotNull(), out)


def ratio(top: Column | str, bottom: Column | str, bump: float = 1e-6) -> Column:
    """top / (bottom + bump), the library's usual guarded ratio."""
    return F.try_divide(as_column(top).cast("double"), as_column(bottom).cast("double") + F.lit(bump))


def no_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating-point column."""
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c).alias(field.name)
        cols.append(c)
    return df.select(*cols)


def has(df: DataFrame, name: str) -> bool:
    return name.lower() in {c.lower() for c in df.columns}


def col_or(df: DataFrame, name: str, default) -> Column:
    """The column if the frame has it, else a literal default."""
    return F.col(name) if has(df, name) else F.lit(default)


def numeric_or(df: DataFrame, name: str, default: float | None) -> Column:
    """Like `col_or`, read as double; text that is no number becomes null."""
    if not has(df, name):
        return F.lit(default).cast("double")
    if isinstance(df.schema[_actual_name(df, name)].dataType, T.StringType):
        return F.col(name).try_cast("double")
    return F.col(name).cast("double")


def _actual_name(df: DataFrame, name: str) -> str:
    return next(c for c in df.columns if c.lower() == name.lower())


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is null)."""
    return F.when(condition, 1).otherwise(0)


def _choose(c: Column, edges: Sequence[float], leaves: Sequence, closed_right: bool) -> Column:
    """Binary decision tree over sorted edges: log2(n) comparisons per row, all in codegen."""
    if not edges:
        leaf = leaves[0]
        return leaf if isinstance(leaf, Column) else F.lit(leaf)
    mid = len(edges) // 2
    goes_left = c <= F.lit(edges[mid]) if closed_right else c < F.lit(edges[mid])
    return F.when(goes_left, _choose(c, edges[:mid], leaves[: mid + 1], closed_right)).otherwise(
        _choose(c, edges[mid + 1 :], leaves[mid + 1 :], closed_right)
    )


def step(c: Column | str, edges: Sequence[float], leaves: Sequence, closed_right: bool = True) -> Column:
    """Leaf k for edges[k-1] < c <= edges[k] (or edges[k-1] <= c < edges[k]); null stays null."""
    if len(leaves) != len(edges) + 1:
        raise ValueError("step needs one more leaf than edges")
    c = as_column(c)
    return F.when(c.isNotNull(), _choose(c, list(edges), list(leaves), closed_right))


def cut(c: Column | str, edges: Sequence[float], labels: Sequence, include_lowest: bool = False) -> Column:
    """Right-closed bins; values outside the edges are null."""
    c = as_column(c)
    out = step(c, edges, [None, *labels, None])
    if include_lowest:
        out = F.when(c == F.lit(edges[0]), F.lit(labels[0])).otherwise(out)
    return out


def lookup(c: Column | str, table: dict, default=None) -> Column:
    """Map literal values through a small fixed table."""
    c = as_column(c)
    out = None
    for key, value in table.items():
        out = F.when(c == F.lit(key), F.lit(value)) if out is None else out.when(c == F.lit(key), F.lit(value))
    return out.otherwise(F.lit(default))


def cents(c: Column, half_even: bool = False) -> Column:
    """Money to two decimals, decided on the decimal value: binary noise is rounded off first."""
    exact = F.round(c, 6)
    return F.bround(exact, 2) if half_even else F.round(exact, 2)


def row_sum(columns: Sequence[Column | str]) -> Column:
    """Null-skipping sum across columns of one row."""
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(as_column(c), F.lit(0))
    return total


def count_when(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def share_when(condition: Column) -> Column:
    """Share of all rows for which the condition holds."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    skip = {c.lower() for c in exclude}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name.lower() not in skip]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    skip = {c.lower() for c in exclude}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name.lower() not in skip]


def melt(df: DataFrame, columns: Sequence[str], value_type: str = "double", keep: Sequence[str] = (),
         name: str = "feature", value: str = "value") -> DataFrame:
    """Long form (keep..., name, value): one generated row per listed column."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast(value_type).alias(value)) for c in columns])
    return df.select(*keep, F.inline(pairs).alias(name, value))


def spread(df: DataFrame, row_type: dict[str, str], rows: dict[str, dict[str, Column]], name: str = "feature") -> DataFrame:
    """Reshape a one-row aggregate into one row per item.

    `rows` maps item -> {output column: expression over df}; `row_type` gives the output types.
    """
    structs = [
        F.struct(F.lit(item).alias(name), *[cols[k].cast(t).alias(k) for k, t in row_type.items()])
        for item, cols in rows.items()
    ]
    return df.select(F.inline(F.array(*structs)))
