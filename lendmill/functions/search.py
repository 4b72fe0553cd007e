"""Binary search over fitted edges as a few projections.

A CASE tree per feature grows the generated method with features x edges, until the JVM no
longer compiles it. Here the edges sit in one constant array, rows name their edge list by
number, and log2(edges) small steps find the bin: the code size does not depend on the number
of features.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def double_array(values: Sequence[float]) -> Column:
    """A constant array of doubles (one parsed expression instead of one call per value)."""
    return F.expr("array(" + ", ".join(_literal(v) for v in values) + ")")


def string_array(values: Sequence[str]) -> Column:
    """A constant array of strings."""
    quoted = (v.replace("\\", "\\\\").replace("'", "\\'") for v in values)
    return F.expr("array(" + ", ".join(f"'{v}'" for v in quoted) + ")").cast("array<string>")


def _literal(v: float) -> str:
    if math.isinf(v):
        return "double('-Infinity')" if v < 0 else "double('Infinity')"
    return f"{v!r}D"


def with_rank(df: DataFrame, value: str, edges: Sequence[Sequence[float]], out: str, which: str | None = None) -> DataFrame:
    """Add `out`: how many edges lie strictly below `value`; null stays null.

    Do not filter on `out` directly: Catalyst would push the filter through the steps and repeat
    them. Check the value's range first, or aggregate by `out` and use the result.

    `edges` holds sorted lists; the integer column `which` names the list of each row (the first
    one without it).
    """
    depth = max(max((len(e) for e in edges), default=1), 1).bit_length()
    width = 2**depth - 1
    flat = [x for e in edges for x in [*map(float, e), *[math.inf] * (width - len(e))]]
    table = double_array(flat)
    offset = F.col(which) * width if which else F.lit(0)
    half = 2 ** (depth - 1)
    df = df.withColumn(out, F.when(F.col(value) > F.get(table, offset + (half - 1)), half).otherwise(0))
    while half > 1:
        half //= 2
        df = df.withColumn(out, F.col(out) + F.when(F.col(value) > F.get(table, offset + F.col(out) + (half - 1)), half).otherwise(0))
    return df.withColumn(out, F.when(F.col(value).isNotNull(), F.col(out)))


def just_below(x: float) -> float:
    """The next smaller double: `value > just_below(x)` means `value >= x`."""
    return math.nextafter(x, -math.inf)
