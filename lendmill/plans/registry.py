"""Registration of queries next to the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.plans.check_views import VIEWS
from lendmill.sources.domain import Domain


# Doubles are rounded twice, first GUARD digits finer: the first step removes what summation order
# leaves, so that both engines see the same value at a rounding edge.
GUARD = 3


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Domain], DataFrame]
    sql: str | None = None
    digits: dict[str, int] = field(default_factory=dict)

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Domain(spark, folder))
        return df.withColumns({c: F.round(F.round(F.col(c), d + GUARD), d) for c, d in self.digits.items()}) if self.digits else df

    def check_sql(self) -> str | None:
        """The check, rounded like the query and with the views it uses spelled out."""
        if self.sql is None:
            return None
        return with_views(self.sql.strip(), self.digits)


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, digits: dict[str, int] | None = None):
    """Register `build(domain)`; `digits` rounds doubles on both sides to hide summation order."""

    def register(build: Callable[[Domain], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, build, sql, digits or {})
        return build

    return register


def _needed(text: str, seen: list[str]) -> None:
    for name, body in VIEWS.items():
        if name not in seen and re.search(rf"\b{name}\b", text):
            _needed(body, seen)
            if name not in seen:
                seen.append(name)


def with_views(sql: str, digits: dict[str, int]) -> str:
    needed: list[str] = []
    _needed(sql, needed)
    if digits:
        fixed = ", ".join(f"round(CAST(round({c}, {d + GUARD}) AS DECIMAL(38, {d + GUARD})), {d})::DOUBLE AS {c}" for c, d in digits.items())
        sql = f"SELECT * REPLACE ({fixed}) FROM ({sql}) AS unrounded"
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed) + "\n" + sql
