"""Exact, interpolated quantiles without holding a column in one task.

`percentile` keeps every distinct value of the column in a single buffer, which a large table
does not survive. Here a mergeable sketch first brackets each wanted rank; one more pass then
counts the rows below the bracket and groups only the values inside it, so that the last,
ordered step sees a sliver of the table. The ranks are checked against the exact counts, and
the result is the linearly interpolated quantile.

The steps and the formula are the same at every size. A bracket that still holds many rows is
narrowed by a sketch of its inside and one that missed its rank is opened again; neither changes
the value. Sketches are merged in two levels, per group of partitions and then over the groups.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmill.functions.search import just_below, with_rank

SKETCH_K = 4096
# A sketch of that size errs by about 0.1 % of the rows in rank.
SLACK = 0.004
SKETCH_GROUPS = 256
BRACKET_ROWS = 1_000_000
COLUMNS_PER_PASS = 60


@dataclass
class _Target:
    column: str
    position: float  # fractional zero-based rank among the non-null values
    size: int  # non-null values of the column
    low: float | None = None
    high: float | None = None
    rows: float = 0.0  # about how many the bracket holds


def exact_quantiles(df: DataFrame, wanted: dict[str, Sequence[float]], bracket_rows: int = BRACKET_ROWS) -> dict[str, list[float | None]]:
    """{column: [quantile per probability]}; None for a column without values."""
    out: dict[str, list[float | None]] = {}
    names = list(wanted)
    for start in range(0, len(names), COLUMNS_PER_PASS):
        part = {c: list(wanted[c]) for c in names[start : start + COLUMNS_PER_PASS]}
        out.update(_quantiles(df.select(*[F.col(c).cast("double").alias(c) for c in part]), part, bracket_rows))
    return out


def median(df: DataFrame, columns: Sequence[str], **limits: int) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_quantiles(df, {c: [0.5] for c in columns}, **limits).items()}


def _sketched(df: DataFrame, values: dict[str, Column], sums: dict[str, Column], ranks: dict[str, list[float]]):
    """One row: quantiles of each value at its ranks (null without values), its size n_.., and the sums."""
    parts = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("__group")).agg(
        *[F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias(f"s_{c}") for c, v in values.items()],
        *[F.count(v).alias(f"n_{c}") for c, v in values.items()],
        *[F.sum(v).alias(c) for c, v in sums.items()],
    )
    whole = parts.agg(
        *[F.kll_merge_agg_double(f"s_{c}", F.lit(SKETCH_K)).alias(f"s_{c}") for c in values],
        *[F.coalesce(F.sum(f"n_{c}"), F.lit(0)).alias(f"n_{c}") for c in values],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
    )
    marks = {c: F.when(F.col(f"n_{c}") > 0, F.kll_sketch_get_quantile_double(f"s_{c}", F.array(*[F.lit(r) for r in ranks[c]]))) for c in values}
    return whole.select(*[m.alias(f"q_{c}") for c, m in marks.items()], *[f"n_{c}" for c in values], *sums).first()


def _around(rank: float) -> list[float]:
    return [max(rank - SLACK, 0.0), min(rank + SLACK, 1.0)]


def _quantiles(df, wanted, bracket_rows):
    names = list(wanted)
    first = _sketched(df, {str(i): F.col(c) for i, c in enumerate(names)}, {}, {str(i): [r for p in wanted[c] for r in _around(p)] for i, c in enumerate(names)})
    sizes = {c: first[f"n_{i}"] for i, c in enumerate(names)}
    targets: list[_Target] = []
    for i, c in enumerate(names):
        for j, p in enumerate(wanted[c]):
            if sizes[c]:
                low, high = first[f"q_{i}"][2 * j : 2 * j + 2]
                targets.append(_Target(c, p * (sizes[c] - 1), sizes[c], low if p > SLACK else None, high if p < 1 - SLACK else None, 2 * SLACK * sizes[c]))
    found: dict[int, float] = {}
    pending = list(range(len(targets)))
    while pending:
        wide = [targets[i] for i in pending if targets[i].rows > bracket_rows]
        if wide:
            _narrow(df, wide)
            continue
        for i, value in zip(pending, _select(df, [targets[i] for i in pending])):
            if value is None:  # the sketch missed the rank
                targets[i].low = targets[i].high = None
                targets[i].rows = targets[i].size
            else:
                found[i] = value
        pending = [i for i in pending if i not in found]
    it = iter(found[i] for i in range(len(targets)))
    return {c: [next(it) if sizes[c] else None for _ in wanted[c]] for c in names}


def _inside(column, target: _Target):
    keep = F.lit(True)
    if target.low is not None:
        keep = keep & (F.col(column) >= target.low)
    if target.high is not None:
        keep = keep & (F.col(column) <= target.high)
    return keep


def _narrow(df: DataFrame, targets: list[_Target]) -> None:
    """One more sketch inside each bracket: the counts below and inside give the rank within it."""
    values = {str(i): F.when(_inside(t.column, t), F.col(t.column)) for i, t in enumerate(targets)}
    below = {f"b_{i}": F.lit(0) if t.low is None else (F.col(t.column) < t.low).cast("bigint") for i, t in enumerate(targets)}
    grid = [k / 500 for k in range(501)]
    row = _sketched(df, values, below, {c: grid for c in values})
    for i, t in enumerate(targets):
        inside, marks = row[f"n_{i}"], row[f"q_{i}"]
        rank = t.position - row[f"b_{i}"]
        if inside < 1 or not 0 <= rank <= inside - 1:
            t.low, t.high, t.rows = None, None, t.size
            continue
        first, second = (r / max(inside - 1, 1) for r in (math.floor(rank), math.ceil(rank)))
        low_mark, high_mark = math.floor((first - SLACK) * 500), math.ceil((second + SLACK) * 500)
        before = (t.low, t.high)
        t.low = marks[low_mark] if low_mark > 0 else t.low
        t.high = marks[high_mark] if high_mark < 500 else t.high
        # a bracket that cannot shrink holds few values, each many times
        t.rows = 0 if (t.low, t.high) == before or t.low == t.high else inside * (high_mark - low_mark) / 500


def _slot_edges(targets: list[_Target]) -> list[float]:
    """Edges that number the merged brackets of one column.

    With the rank over these edges, 2j is the gap before bracket j and 2j + 1 its inside.
    """
    spans = sorted((-math.inf if t.low is None else t.low, math.inf if t.high is None else t.high) for t in targets)
    merged = [list(spans[0])]
    for low, high in spans[1:]:
        if low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    return [edge for low, high in merged for edge in (just_below(low), high)]


def _select(df: DataFrame, targets: list[_Target]) -> list[float | None]:
    """Pick the two neighbouring order statistics of each target; None where the bracket lacks one.

    One row per (table row, column) is generated and pre-aggregated: values inside a bracket
    keep their identity, all values of a gap fold into one count. Brackets are ordered one by
    one; the counts of whole brackets and gaps (a few per target) give their offsets.
    """
    names = sorted({t.column for t in targets})
    edges = [_slot_edges([t for t in targets if t.column == name]) for name in names]
    entries = F.array(*[F.struct(F.lit(i).alias("c"), F.col(name).alias("v")) for i, name in enumerate(names)])
    long = with_rank(df.select(F.inline(entries)).filter(F.col("v").isNotNull()), "v", edges, "slot", "c")
    counted = long.groupBy("c", "slot", F.when(F.col("slot") % 2 == 1, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    slots = counted.groupBy("c", "slot").agg(F.sum("n").alias("slot_n"))
    before = F.sum("slot_n").over(Window.partitionBy("c").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))
    offsets = slots.select(F.col("c").alias("oc"), F.col("slot").alias("oslot"), F.coalesce(before, F.lit(0)).alias("offset"))
    upto = F.sum("n").over(Window.partitionBy("c", "slot").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    inner = counted.filter(F.col("v").isNotNull()).withColumn("upto", upto)
    placed = inner.join(F.broadcast(offsets), (F.col("c") == F.col("oc")) & (F.col("slot") == F.col("oslot")))  # two slots per target
    ranked = placed.select("c", "v", (F.col("offset") + F.col("upto") - F.col("n")).alias("start"), (F.col("offset") + F.col("upto")).alias("end"))
    wanted = F.lit(False)
    ranks: dict[str, list[int]] = {}
    for i, name in enumerate(names):
        ranks[name] = sorted({r for t in targets if t.column == name for r in _neighbours(t)})
        hit = F.exists(F.array(*[F.lit(r) for r in ranks[name]]), lambda r: (F.col("start") <= r) & (r < F.col("end")))
        wanted = wanted | ((F.col("c") == i) & hit)
    rows = ranked.filter(wanted).collect()  # at most two per target
    at = {(names[r["c"]], rank): r["v"] for r in rows for rank in ranks[names[r["c"]]] if r["start"] <= rank < r["end"]}
    out: list[float | None] = []
    for t in targets:
        below, above = (at.get((t.column, rank)) for rank in _neighbours(t))
        found = below is not None and above is not None
        out.append(below + (above - below) * (t.position - math.floor(t.position)) if found else None)
    return out


def _neighbours(t: _Target) -> tuple[int, int]:
    return math.floor(t.position), min(math.ceil(t.position), t.size - 1)
