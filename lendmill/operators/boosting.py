"""Gradient boosting on quantised features, with gaps, early stopping and many models in one pass.

Features are cut at quantiles once and kept as one byte per value, gaps as a bin of their own, in
blocks of rows. A pass over the blocks sums gradients per (model, node, feature, bin) in each task,
adds the sums up by feature and returns the best split of each node; only splits reach the driver.
A gap goes to the side that gains more. Trees grow by the best leaf first: the children of all
leaves that may come next are summed in one pass, and the order is settled from the known gains,
so it is the order that splitting one leaf at a time would give.

All models of a fit (folds, settings of a search) share the passes. Gradients are whole numbers of
2^-24, so sums do not depend on the order of rows and a fit is repeatable. The held-out loss of
each round comes with the first pass of the next; a model ends after `patience` rounds without
gain and keeps the trees up to its best round.

Margins are written to the shared folder every few rounds. Tasks add the trees since then;
what a worker process keeps of that is only a shortcut, and a new worker starts from the file.

A table whose codes are small goes whole to each of some tasks, which fit some of the models from the
first round to the last: the same sums and splits without a job for each pass.
"""

from __future__ import annotations

import heapq
import math
import pickle
import uuid
from collections import OrderedDict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.session import materialize, prepare_workers, release

BINS = 255
BLOCK_ROWS = 1 << 14
SCALE = 1 << 24
# Rounds after which margins are written.
WRITTEN_EVERY = 25
# Bytes of margins that one worker process keeps.
KEPT_BYTES = 1 << 27
# Bytes of codes up to which a task takes all rows.
WHOLE_BYTES = 1 << 26
NO_FOLD = -1
_BLOCK = ["share", "block", "n", "label", "weight", "fold", "codes"]


@dataclass(frozen=True)
class Params:
    """`depth` 0 is unlimited, `patience` 0 never stops early; `columns` and `subsample` are drawn anew for each tree."""

    rounds: int = 1000
    leaves: int = 31
    depth: int = 0
    step: float = 0.05
    min_rows: int = 20
    min_weight: float = 1e-3
    l1: float = 0.0
    l2: float = 0.0
    min_gain: float = 0.0
    subsample: float = 1.0
    columns: float = 1.0
    patience: int = 30
    loss: str = "logistic"
    seed: int = 42


@dataclass
class Tree:
    """Nodes as arrays; `feature` is -1 for a leaf. A value of at most `code` (or `edge`) goes left, a gap where `gap_left` says."""

    feature: np.ndarray
    code: np.ndarray
    edge: np.ndarray
    gap_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    def leaf_by_code(self, codes: np.ndarray, gaps: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
        """The leaf of each column of `codes` [feature, row], from node `start` on if given; `gaps` is the code of a gap by feature."""
        at, inner, code = np.zeros(codes.shape[1], np.int32) if start is None else start.copy(), self.feature >= 0, np.arange(256)
        left = np.where(code == gaps[self.feature][:, None], self.gap_left[:, None], code <= self.code[:, None])
        follows = np.where(left, self.left[:, None], self.right[:, None])
        rows = np.flatnonzero(inner[at])
        while len(rows):
            node = at[rows]
            node = follows[node, codes[self.feature[node], rows]]
            at[rows] = node
            rows = rows[inner[node]]
        return at

    def leaf_by_value(self, values: np.ndarray) -> np.ndarray:
        """The leaf of each row of `values` [row, feature], NaN for a gap."""
        at, rows = np.zeros(len(values), np.int32), np.arange(len(values))
        while len(rows):
            node = at[rows]
            f = self.feature[node]
            inner = f >= 0
            rows, node, f = rows[inner], node[inner], f[inner]
            v = values[rows, f]
            left = np.where(np.isnan(v), self.gap_left[node], v <= self.edge[node])
            at[rows] = np.where(left, self.left[node], self.right[node])
        return at


@dataclass
class Model:
    """The trees of one model up to its best round; `curve` is the held-out loss before the first tree and after each."""

    params: Params
    features: list[str]
    base: float
    trees: list[Tree]
    curve: list[float] = field(default_factory=list)

    def margins(self, values: np.ndarray) -> np.ndarray:
        out = np.full(len(values), self.base)
        for tree in self.trees:
            out += tree.value[tree.leaf_by_value(values)]
        return out

    def outputs(self, values: np.ndarray) -> np.ndarray:
        """Probabilities, or predictions of a regression."""
        margins = self.margins(values)
        return 1 / (1 + np.exp(-margins)) if self.params.loss == "logistic" else margins


@dataclass(frozen=True)
class Binned:
    """Blocks of quantised rows (block, n, label, weight, fold, codes) and the edges of each feature."""

    blocks: DataFrame
    features: list[str]
    edges: list[np.ndarray]

    @property
    def gaps(self) -> np.ndarray:
        """The code of a gap by feature, one beyond that of the largest values."""
        return np.array([len(e) + 1 for e in self.edges], np.int32)


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int = BINS, accuracy: int = 2_000) -> list[np.ndarray]:
    """Distinct quantiles of each feature, at most bins - 2: a sketch will do, as edges need not be exact."""
    # one literal for all features: an array of single marks for each would cost more to plan than the sketches to fill
    marks = F.lit(np.arange(1, bins - 1) / (bins - 1))
    row = df.agg(*[F.percentile_approx(F.col(f).cast("double"), marks, accuracy).alias(f) for f in features]).first()
    return [np.unique(np.array([v for v in row[f] or [] if not math.isnan(v)])) for f in features]


def _block_rows(edges: list[np.ndarray], size: int):
    """Rows (label, weight, fold, features..) to blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)

        def block(parts: list[np.ndarray]) -> pa.RecordBatch:
            table = np.concatenate(parts)
            label, weight, fold, values = table[:, 0], table[:, 1], table[:, 2].astype(np.int16), table[:, 3:]
            codes = np.empty((len(edges), len(table)), np.uint8)
            for f, e in enumerate(edges):
                codes[f] = np.where(np.isnan(values[:, f]), len(e) + 1, np.searchsorted(e, values[:, f]))
            return pa.RecordBatch.from_arrays(
                [pa.array([next(numbers)], pa.int64()), pa.array([len(table)], pa.int32()), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (label, weight, fold, codes))],
                ["block", "n", "label", "weight", "fold", "codes"],
            )

        held, waiting = [], 0
        for batch in batches:
            table = np.column_stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns]) if batch.num_rows else None
            for a in range(0, batch.num_rows, size):
                held.append(table[a : a + size])
                waiting += len(held[-1])
                if waiting >= size:
                    yield block(held)
                    held, waiting = [], 0
        if waiting:
            yield block(held)

    return run


def quantise(df: DataFrame, features: Sequence[str], label: str, weight: str | None = None, fold: str | None = None, bins: int = BINS, block_rows: int = BLOCK_ROWS, edges: list[np.ndarray] | None = None) -> Binned:
    """`df` as blocks, written once; `fold` numbers the part that a model may hold out."""
    prepare_workers(df.sparkSession)
    edges = edges if edges is not None else quantile_edges(df, features, bins)
    one = lambda c, other: (F.col(c) if c else F.lit(other)).cast("double")
    rows = df.select(F.col(label).cast("double").alias("__y"), one(weight, 1.0).alias("__w"), one(fold, NO_FOLD).alias("__k"), *[F.col(f).cast("double").alias(f"__{k}") for k, f in enumerate(features)])
    whole = -(-df.count() // block_rows)
    # a task for each block, up to some per core; beyond that, several blocks to a task
    parts = max(1, min(whole, max(df.sparkSession.sparkContext.defaultParallelism, whole // 16)))
    blocks = rows.repartition(parts).mapInArrow(_block_rows(edges, block_rows), "block long, n int, label binary, weight binary, fold binary, codes binary")
    return Binned(materialize(blocks, "blocks"), list(features), edges)


# ---- inside the tasks ------------------------------------------------------------------------


@dataclass
class _Job:
    """What the tasks need of a model in one pass: the trees since the margins were written, the tree being grown and the nodes to sum up."""

    number: int
    slot: int
    params: Params
    held: int
    base: float
    done: int
    recent: list[Tree]
    growing: Tree
    wanted: list[int]
    columns: np.ndarray
    starts: bool


_MARGINS: OrderedDict[tuple, tuple[int, np.ndarray]] = OrderedDict()


def _margin(fit: str, block: int, written: np.ndarray | None, job: _Job, codes: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """The margins of a block after all finished trees of the model."""
    name = (fit, block, job.number)
    total = job.done + len(job.recent)
    known = _MARGINS.pop(name, None)
    if known is not None and job.done <= known[0] <= total:
        have, margin = known
    else:
        have, margin = job.done, (written.copy() if written is not None else np.full(codes.shape[1], job.base))
    for tree in job.recent[have - job.done :]:
        margin = margin + tree.value[tree.leaf_by_code(codes, gaps)]
    _MARGINS[name] = (total, margin)
    while len(_MARGINS) > 1 and sum(m.nbytes for _, m in _MARGINS.values()) > KEPT_BYTES:
        _MARGINS.popitem(last=False)
    return margin


_PLACES: OrderedDict[tuple, tuple[int, int, np.ndarray]] = OrderedDict()


def _placed(fit: str, block: int, job: _Job, codes: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """The node of the growing tree that each row of a block is in: nodes keep their numbers, so rows go on from where they were."""
    name, round_, nodes = (fit, block, job.number), job.done + len(job.recent), len(job.growing.feature)
    known = _PLACES.pop(name, None)
    # a task that is run again may hold an earlier form of the tree
    at = job.growing.leaf_by_code(codes, gaps, known[2] if known is not None and known[0] == round_ and known[1] <= nodes else None)
    _PLACES[name] = (round_, nodes, at)
    while len(_PLACES) > 1 and sum(a.nbytes for _, _, a in _PLACES.values()) > KEPT_BYTES:
        _PLACES.popitem(last=False)
    return at


# Above the sum of the second derivatives of most blocks' rows: there a count is added up in the same double as that sum.
_COUNTED = 1 << 38
_COUNTED_ROWS = 1 << 15


# Features with up to so many codes in a block are joined to one of up to JOINED codes.
_FEW = 16
JOINED = 256


@dataclass(frozen=True)
class _Joined:
    """Features of few codes as one: `codes` by row, `spread` [code, cell] is 1 where a joint code belongs to one of the features' `cells`."""

    codes: np.ndarray
    spread: np.ndarray
    cells: np.ndarray
    owner: np.ndarray


def _joined(codes: np.ndarray, first: np.ndarray) -> tuple[list[int], list[_Joined]]:
    """The features of a block that stay as they are, and the others joined: sums by joint code hold those of every feature of it."""
    found = {f: np.flatnonzero(np.bincount(c)) for f, c in enumerate(codes)}
    groups: list[list[int]] = [[]]
    for f in sorted((f for f, c in found.items() if len(c) <= _FEW), key=lambda f: len(found[f])):
        if math.prod(len(found[k]) for k in groups[-1]) * len(found[f]) > JOINED:
            groups.append([])
        groups[-1].append(f)
    out = []
    for group in (g for g in groups if len(g) > 1):
        joint, number = np.zeros(codes.shape[1], np.uint8), np.arange(math.prod(len(found[f]) for f in group))
        size, spread = 1, []
        for f in group:
            place = np.zeros(256, np.uint8)
            place[found[f]] = np.arange(len(found[f])) * size
            joint += place[codes[f]]
            spread.append(number[:, None] // size % len(found[f]) == np.arange(len(found[f])))
            size *= len(found[f])
        out.append(_Joined(joint, np.concatenate(spread, axis=1).astype(float), np.concatenate([first[f] + found[f] for f in group]), np.repeat(group, [len(found[f]) for f in group])))
    alone = set(found).difference(*(j.owner.tolist() for j in out))
    return sorted(alone), out


_JOINED: OrderedDict[tuple, tuple[list[int], list[_Joined]]] = OrderedDict()


def _kept_joined(fit: str, block: int, codes: np.ndarray, first: np.ndarray) -> tuple[list[int], list[_Joined]]:
    """`_joined` of a block, kept by the worker process where there is room."""
    known = _JOINED.pop((fit, block), None)
    _JOINED[fit, block] = known = known if known is not None else _joined(codes, first)
    while len(_JOINED) > 1 and sum(j.codes.nbytes + j.spread.nbytes for _, some in _JOINED.values() for j in some) > KEPT_BYTES:
        _JOINED.popitem(last=False)
    return known


def _histograms(codes: np.ndarray, node: np.ndarray, nodes: int, g: np.ndarray, h: np.ndarray, features: Sequence[int], first: np.ndarray, rows: np.ndarray | None, sums: np.ndarray, joined: Sequence[_Joined] = ()) -> None:
    """Add the sums of (g, h, 1) per node and code of each feature to `sums` [node, cell, 3]; `rows` are the block's rows used, None for all.

    One feature, or several joined to one, at a time: what it reads and writes stays in the processor's cache.
    Sums of a block are below 2^53, so exact in doubles.
    """
    g = g.astype(float)
    packed = 0 < len(h) < _COUNTED_ROWS and h.min() >= 0 and int(h.sum()) < _COUNTED
    h = (h + _COUNTED if packed else h).astype(float)
    cell = np.empty(len(node), np.int64)
    # weights so large that a whole block's sum is not exact in a double: joint codes are spread as whole numbers
    kind = float if max(np.abs(g).sum(), h.sum()) < 1 << 53 else np.int64

    def add(code: np.ndarray, width: int, cells: slice | np.ndarray, spread: np.ndarray | None) -> None:
        np.add(code if rows is None else code[rows], node * width, out=cell)
        size = nodes * width
        kinds = [np.bincount(cell, v, size).reshape(-1, width) for v in ((g, h) if packed else (g, h, None))]
        first_, second, *counted = [(k if spread is None else k.astype(kind) @ spread.astype(kind)).astype(np.int64) for k in kinds]
        sums[:, cells, 0] += first_
        sums[:, cells, 1] += second & (_COUNTED - 1) if packed else second
        sums[:, cells, 2] += second // _COUNTED if packed else counted[0]

    for f in features:
        add(codes[f], int(first[f + 1] - first[f]), slice(first[f], first[f + 1]), None)
    for j in joined:
        add(j.codes, len(j.spread), j.cells, j.spread)


def gradients(loss: str, margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss as whole numbers of 1 / SCALE."""
    if loss == "logistic":
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - label), weight * p * (1 - p)
    else:
        g, h = weight * (margin - label), weight
    return np.rint(g * SCALE).astype(np.int64), np.rint(h * SCALE).astype(np.int64)


def losses(loss: str, margin: np.ndarray, label: np.ndarray) -> np.ndarray:
    if loss == "logistic":
        return np.logaddexp(0, margin) - label * margin
    return (margin - label) ** 2


def in_bag(params: Params, block: int, rows: int, round_: int) -> np.ndarray:
    if params.subsample >= 1:
        return np.ones(rows, bool)
    return np.random.default_rng([params.seed, round_, block]).random(rows) < params.subsample


def drawn_columns(params: Params, count: int, round_: int) -> np.ndarray:
    if params.columns >= 1:
        return np.arange(count)
    most = max(1, round(params.columns * count))
    return np.sort(np.random.default_rng([params.seed, round_]).permutation(count)[:most])


def _add(fit: str, row: dict, mine: list[_Job], sums: list[np.ndarray], held: np.ndarray, gaps: np.ndarray, first: np.ndarray) -> None:
    """Add a block's sums for each job to `sums` [node, cell, 3], and its held-out losses to `held`."""
    n = row["n"]
    label, weight, fold = np.frombuffer(row["label"]), np.frombuffer(row["weight"]), np.frombuffer(row["fold"], np.int16)
    codes = np.frombuffer(row["codes"], np.uint8).reshape(-1, n)
    margins = np.frombuffer(row["margins"]).reshape(-1, n) if row.get("margins") else None
    alone, joined = _kept_joined(fit, row["block"], codes, first)
    for k, job in enumerate(mine):
        margin = _margin(fit, row["block"], margins[job.slot] if margins is not None else None, job, codes, gaps)
        out = fold == job.held if job.held != NO_FOLD else np.zeros(n, bool)
        if job.starts and out.any():
            lost = losses(job.params.loss, margin[out], label[out])
            held[k] += [int(np.rint(weight[out] * v * SCALE).astype(np.int64).sum()) for v in (lost, 1.0)]
        place = np.full(len(job.growing.feature), -1)
        place[job.wanted] = np.arange(len(job.wanted))
        at = place[_placed(fit, row["block"], job, codes, gaps)]
        use = np.flatnonzero(~out & in_bag(job.params, row["block"], n, job.done + len(job.recent)) & (at >= 0))
        if not len(use):
            continue
        g, h = gradients(job.params.loss, margin[use], label[use], weight[use])
        drawn = set(job.columns.tolist())
        some = [j for j in joined if drawn.intersection(j.owner.tolist())]  # sums of columns that were not drawn are not passed on
        _histograms(codes, at[use], len(job.wanted), g, h, [f for f in alone if f in drawn], first, use if len(use) < n else None, sums[k], some)


def _summed(fit: str, jobs: dict[int, list[_Job]], gaps: np.ndarray):
    """Blocks to (share, feature, sums): for each feature the sums of the share's jobs one after the other, at -1 the held-out losses."""
    # the cells of all features side by side
    first = np.concatenate([[0], np.cumsum(gaps + 1)])
    width = int(first[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[list[np.ndarray], np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                mine = jobs.get(row["share"], [])
                if not mine:
                    continue  # all models of this share have ended
                if row["share"] not in known:
                    known[row["share"]] = [np.zeros((len(j.wanted), width, 3), np.int64) for j in mine], np.zeros((len(mine), 2), np.int64)
                _add(fit, row, mine, *known[row["share"]], gaps, first)
        out: list[tuple[int, int, bytes]] = []
        for share, (sums, held) in known.items():
            out.append((share, -1, held.tobytes()))
            drawn = [set(j.columns.tolist()) for j in jobs.get(share, [])]
            for f in range(len(gaps)):
                parts = [s[:, first[f] : first[f + 1]].tobytes() for s, d in zip(sums, drawn) if f in d]
                if parts:
                    out.append((share, f, b"".join(parts)))
        columns = list(zip(*out)) if out else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary()))], ["share", "feature", "sums"])

    return run


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    code: int
    gap_left: bool
    left: tuple[int, int, int]
    right: tuple[int, int, int]


def _strength(g: np.ndarray, h: np.ndarray, params: Params) -> np.ndarray:
    g = np.sign(g) * np.maximum(np.abs(g) - params.l1, 0)
    return g * g / (h + params.l2 + 1e-15)


def best_splits(cells: np.ndarray, feature: int, params: Params) -> list[Split | None]:
    """The best cut of each node by one feature; `cells` [node, code, sum] holds the sums by code, the gap last."""
    total, gap = cells.sum(1), cells[:, -1]
    below = np.cumsum(cells[:, :-1], axis=1)
    # first without, then with the gaps on the left
    left = np.stack([below, below + gap[:, None]], axis=1)
    right = total[:, None, None] - left
    ok = (np.minimum(left[..., 2], right[..., 2]) >= max(params.min_rows, 1)) & (np.minimum(left[..., 1], right[..., 1]) >= params.min_weight * SCALE)
    g, h = left[..., 0] / SCALE, left[..., 1] / SCALE
    rg, rh = right[..., 0] / SCALE, right[..., 1] / SCALE
    whole = _strength(total[:, 0] / SCALE, total[:, 1] / SCALE, params)[:, None, None]
    gain = np.where(ok, _strength(g, h, params) + _strength(rg, rh, params) - whole, -np.inf).reshape(len(cells), -1)
    best = gain.argmax(1)
    out: list[Split | None] = []
    for k, at in enumerate(best.tolist()):
        if not gain[k, at] > max(params.min_gain, 1e-12):
            out.append(None)
            continue
        gap_left, code = divmod(at, below.shape[1])
        a, b = left[k, gap_left, code], right[k, gap_left, code]
        # without gaps in the node, gaps seen later follow the larger side
        side = bool(a[2] >= b[2]) if gap[k, 2] == 0 else bool(gap_left)
        out.append(Split(float(gain[k, at]), feature, code, side, tuple(a.tolist()), tuple(b.tolist())))
    return out


_SPLITS = "model int, node int, feature int, gain double, code int, gap_left boolean, left array<long>, right array<long>"


def _decided(jobs: dict[int, list[_Job]], gaps: np.ndarray):
    """The sums of all tasks to the best split of each wanted node among this partition's features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for share, f, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                part = np.frombuffer(raw.as_buffer(), np.int64)
                total[share, f] = total[share, f] + part if (share, f) in total else part
        out: list[tuple] = []
        best: dict[tuple[int, int], Split] = {}
        for share, f in sorted(total):
            if f < 0:
                for job, (lost, weight) in zip(jobs[share], total[share, f].reshape(-1, 2).tolist()):
                    out.append((job.number, -1, -1, 0.0, 0, False, [lost, weight], []))
                continue
            at = 0
            for job in jobs[share]:
                if f not in job.columns:
                    continue
                shape = (len(job.wanted), int(gaps[f]) + 1, 3)
                cells = total[share, f][at : at + math.prod(shape)].reshape(shape)
                at += math.prod(shape)
                for node, split in zip(job.wanted, best_splits(cells, f, job.params)):
                    known = best.get((job.number, node))
                    if split is not None and (known is None or split.gain > known.gain):
                        best[job.number, node] = split
        out += [(m, node, s.feature, s.gain, s.code, s.gap_left, list(s.left), list(s.right)) for (m, node), s in best.items()]
        names = ["model", "node", "feature", "gain", "code", "gap_left", "left", "right"]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        columns = list(zip(*out)) if out else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    return run


def _one_after_the_other(first, second):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from second(first(batches))

    return run


def _written(fit: str, jobs: dict[int, list[_Job]], slots: int, gaps: np.ndarray):
    """Blocks with the margins of their share's models after the finished trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, row in enumerate(batch.to_pylist()):
                codes = np.frombuffer(row["codes"], np.uint8).reshape(-1, row["n"])
                old = np.frombuffer(row["margins"]).reshape(-1, row["n"]) if row.get("margins") else None
                new = old.copy() if old is not None else np.zeros((slots, row["n"]))
                for job in jobs.get(row["share"], []):
                    new[job.slot] = _margin(fit, row["block"], old[job.slot] if old is not None else None, job, codes, gaps)
                plain = batch.slice(k, 1).select(_BLOCK)
                yield pa.RecordBatch.from_arrays([*plain.columns, pa.array([new.tobytes()], pa.binary())], [*_BLOCK, "margins"])

    return run


# ---- on the driver ---------------------------------------------------------------------------


class _Growth:
    """One tree being grown: every node summed so far and its best split."""

    def __init__(self, params: Params, edges: list[np.ndarray]):
        self.params, self.edges = params, edges
        self.split: list[Split | None] = [None]
        self.children: list[tuple[int, int] | None] = [None]
        self.totals: list[tuple[int, int, int] | None] = [None]
        self.depth = [0]
        self.known = [False]
        self.wanted = [0]

    def _child(self, parent: int, totals: tuple[int, int, int]) -> int:
        depth = self.depth[parent] + 1
        self.split.append(None)
        self.children.append(None)
        self.totals.append(totals)
        self.depth.append(depth)
        # too deep or too small to be cut: nothing to sum up
        self.known.append(bool(self.params.depth and depth >= self.params.depth) or totals[2] < 2 * max(self.params.min_rows, 1))
        return len(self.split) - 1

    def advance(self, found: dict[int, Split]) -> list[int] | None:
        """Take the splits of the wanted nodes; the inner nodes of the finished tree, or None where more nodes must be summed."""
        for node in self.wanted:
            self.known[node], self.split[node] = True, found.get(node)
        if self.totals[0] is None and self.split[0] is not None:
            self.totals[0] = tuple(a + b for a, b in zip(self.split[0].left, self.split[0].right))
        leaves, inner, pending = 1, [], []
        heap: list[tuple[float, int]] = []

        def offer(node: int) -> None:
            if self.split[node] is not None:
                heapq.heappush(heap, (-self.split[node].gain, node))

        offer(0)
        while heap and leaves < self.params.leaves:
            _, node = heapq.heappop(heap)
            inner.append(node)
            leaves += 1
            if self.children[node] is None:
                s = self.split[node]
                self.children[node] = (self._child(node, s.left), self._child(node, s.right))
            if all(self.known[c] for c in self.children[node]):
                for child in self.children[node]:
                    offer(child)
            else:
                pending.append(node)
        if pending and leaves >= self.params.leaves and pending[-1] == inner[-1]:
            pending.pop()  # the last one chosen: its children stay leaves
        self.wanted = [c for node in pending for c in self.children[node] if not self.known[c]]
        return None if self.wanted else inner

    def tree(self, inner: Sequence[int]) -> Tree:
        """The finished tree; nodes are numbered from the root down."""
        chosen, order = set(inner), [0]
        for node in order:
            if node in chosen:
                order += self.children[node]
        place = {node: k for k, node in enumerate(order)}
        n = len(order)
        out = Tree(*(np.full(n, v, t) for v, t in ((-1, np.int32), (0, np.int32), (0.0, float), (False, bool), (-1, np.int32), (-1, np.int32), (0.0, float), (0.0, float))))
        for node, k in place.items():
            g, h, rows = self.totals[node] or (0, 0, 0)
            out.cover[k] = rows
            if node in chosen:
                s = self.split[node]
                edges = self.edges[s.feature]
                out.feature[k], out.code[k], out.gap_left[k] = s.feature, s.code, s.gap_left
                out.edge[k] = edges[s.code] if s.code < len(edges) else math.inf
                out.left[k], out.right[k] = (place[c] for c in self.children[node])
            else:
                g, h = g / SCALE, h / SCALE
                g = math.copysign(max(abs(g) - self.params.l1, 0), g)
                out.value[k] = -self.params.step * g / (h + self.params.l2) if h + self.params.l2 > 0 else 0.0
        return out

    def partial(self) -> Tree:
        """The tree with every split made so far, by the numbers used here."""
        n = len(self.split)
        out = Tree(*(np.full(n, v, t) for v, t in ((-1, np.int32), (0, np.int32), (0.0, float), (False, bool), (-1, np.int32), (-1, np.int32), (0.0, float), (0.0, float))))
        for node, children in enumerate(self.children):
            if children:
                s = self.split[node]
                out.feature[node], out.code[node], out.gap_left[node] = s.feature, s.code, s.gap_left
                out.left[node], out.right[node] = children
        return out


class _Fit:
    """The state of one model on the driver."""

    def __init__(self, number: int, params: Params, held: int, base: float, data: Binned, shares: int):
        self.number, self.params, self.held, self.base, self.data = number, params, held, base, data
        self.slot = number // shares
        self.trees: list[Tree] = []
        self.done = 0
        self.curve: list[float] = []
        self.growth = _Growth(params, data.edges)
        self.ended = params.rounds < 1

    def job(self) -> _Job:
        round_ = len(self.trees)
        return _Job(self.number, self.slot, self.params, self.held, self.base, self.done, self.trees[self.done :], self.growth.partial(), self.growth.wanted, drawn_columns(self.params, len(self.data.features), round_), self.growth.wanted == [0])

    def best_round(self) -> int:
        return int(np.argmin(self.curve)) if self.curve else len(self.trees)

    def take(self, splits: dict[int, Split], lost: float | None) -> None:
        """What a pass found: the next nodes to sum up, or a finished tree."""
        if self.growth.wanted == [0]:
            if lost is not None:
                self.curve.append(lost)
            late = self.params.patience and self.curve and len(self.trees) - self.best_round() >= self.params.patience
            if late or len(self.trees) >= self.params.rounds:
                self.ended = True
                return
        inner = self.growth.advance(splits)
        if inner is None:
            return
        if inner:
            self.trees.append(self.growth.tree(inner))
            self.growth = _Growth(self.params, self.data.edges)
        # with a held-out part, one more pass measures the last tree
        self.ended = not inner or (self.held == NO_FOLD and len(self.trees) >= self.params.rounds)

    def model(self) -> Model:
        keep = self.best_round() if self.params.patience else len(self.trees)
        return Model(self.params, self.data.features, self.base, self.trees[:keep], self.curve)


def _bases(data: Binned, wanted: Sequence[tuple[Params, int]]) -> list[float]:
    """The best constant margin of each model's rows, from sums per fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                label, weight, fold = np.frombuffer(row["label"]), np.frombuffer(row["weight"]), np.frombuffer(row["fold"], np.int16)
                kinds, at = np.unique(fold, return_inverse=True)
                whole = lambda v: pa.array(np.bincount(at, np.rint(v * SCALE)).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int16()), whole(weight * label), whole(weight)], ["fold", "y", "w"])

    found = data.blocks.select("label", "weight", "fold").mapInArrow(run, "fold short, y long, w long").groupBy("fold").agg(F.sum("y").alias("y"), F.sum("w").alias("w")).collect()
    out = []
    for params, held in wanted:
        y, w = (sum(r[c] for r in found if held == NO_FOLD or r["fold"] != held) for c in ("y", "w"))
        mean = y / w if w else 0.0
        out.append((math.log(mean / (1 - mean)) if 0 < mean < 1 else 0.0) if params.loss == "logistic" else mean)
    return out


@dataclass(frozen=True)
class Halving:
    """Successive halving: models of equal `trial` numbers are judged together after `first` rounds, then after `factor` times as many.

    Of the trials still running, the best 1/factor by mean held-out loss go on; the last one left runs on to `most` rounds.
    """

    trial: Sequence[int]
    first: int = 50
    most: int = 500
    factor: int = 3

    def survivors(self, fits: Sequence[_Fit], running: Sequence[int]) -> list[int]:
        best: dict[int, list[float]] = {}
        for f in fits:
            best.setdefault(self.trial[f.number], []).append(min(f.curve, default=math.inf))
        order = sorted(running, key=lambda t: (sum(best[t]) / len(best[t]), t))
        return order[: max(1, len(order) // self.factor)]


def _grown(fit: str, one: _Fit, rows: Sequence[dict], gaps: np.ndarray, first: np.ndarray) -> None:
    """Fit a model to its end on the blocks at hand. Of two children the smaller is summed up, the other is what it leaves of the parent."""
    cells: dict[int, np.ndarray] = {}
    growth = one.growth
    while not one.ended:
        if growth is not one.growth:
            cells, growth = {}, one.growth
        job = one.job()
        rest = {}
        for parent, children in enumerate(growth.children):
            if children and parent in cells and all(c in job.wanted for c in children):
                small, large = sorted(children, key=lambda c: growth.totals[c][2])
                rest[large] = parent, small
        summed = [node for node in job.wanted if node not in rest]
        sums, held = np.zeros((len(summed), int(first[-1]), 3), np.int64), np.zeros((1, 2), np.int64)
        for row in rows:
            _add(fit, row, [replace(job, wanted=summed)], [sums], held, gaps, first)
        cells |= dict(zip(summed, sums))
        for large, (parent, small) in rest.items():
            cells[large] = cells.pop(parent) - cells[small]
        found: dict[int, Split] = {}
        for f in job.columns.tolist():
            at = np.stack([cells[node][first[f] : first[f + 1]] for node in job.wanted])
            for node, split in zip(job.wanted, best_splits(at, f, job.params)):
                if split is not None and (node not in found or split.gain > found[node].gain):
                    found[node] = split
        lost, weight = held[0].tolist()
        one.take(found, lost / weight if weight else None)


def _fit_in_tasks(data: Binned, wanted: Sequence[tuple[Params, int]], bases: Sequence[float]) -> list[Model]:
    """Each task takes all blocks and fits some of the models."""
    shares = max(1, min(len(wanted), data.blocks.sparkSession.sparkContext.defaultParallelism))
    name, gaps, plain = uuid.uuid4().hex, data.gaps, Binned(None, data.features, data.edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.concatenate([[0], np.cumsum(gaps + 1)])
        here: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                here.setdefault(row["share"], []).append(row)
        for share, rows in here.items():
            for k in range(share, len(wanted), shares):
                one = _Fit(k, *wanted[k], bases[k], plain, 1)
                _grown(name, one, rows, gaps, first)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pickle.dumps((one.trees, one.curve))], pa.binary())], ["model", "found"])

    copies = data.blocks.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).select(*_BLOCK).repartitionById(shares, "share")
    found = {r["model"]: pickle.loads(r["found"]) for r in copies.mapInArrow(run, "model int, found binary").collect()}
    out = []
    for k, (params, held) in enumerate(wanted):
        one = _Fit(k, params, held, bases[k], data, 1)
        one.trees, one.curve = found.get(k, ([], []))
        out.append(one.model())
    return out


def fit_all(data: Binned, wanted: Sequence[tuple[Params, int]], halving: Halving | None = None) -> list[Model]:
    """One model per (params, held-out fold; NO_FOLD holds out nothing), all in the same passes.

    Few rows go whole to tasks that fit a model each. Else, where there are fewer blocks than cores,
    each block is copied and every copy serves a share of the models; the result is always the same.
    """
    spark = data.blocks.sparkSession
    count_, rows = data.blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bases = _bases(data, wanted)
    if halving is None and rows * len(data.features) <= WHOLE_BYTES:
        return _fit_in_tasks(data, wanted, bases)
    count_ = max(1, count_)
    shares = max(1, min(len(wanted), spark.sparkContext.defaultParallelism // count_))
    blocks = data.blocks.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).select(*_BLOCK)
    blocks = copies = materialize(blocks.repartitionById(shares, "share"), "shares") if shares > 1 else blocks
    # read in every pass: kept in memory where there is room, else from the file
    blocks = blocks.persist()
    fits = [_Fit(k, params, held, base, data, shares) for k, ((params, held), base) in enumerate(zip(wanted, bases))]
    name, gaps, written = uuid.uuid4().hex, data.gaps, None
    rung, running = (halving.first, sorted(set(halving.trial))) if halving else (0, [])
    while running_fits := [f for f in fits if not f.ended]:
        live = [f for f in running_fits if not halving or len(f.trees) < rung]
        if not live:
            # every model has come to the rung, or ended before
            running = halving.survivors(fits, running)
            rung = min(halving.most, rung * halving.factor) if rung < halving.most else 0
            for f in running_fits:
                f.ended = halving.trial[f.number] not in running or not rung
            continue
        late = max(len(f.trees) - f.done for f in running_fits) >= WRITTEN_EVERY
        jobs: dict[int, list[_Job]] = {}
        for f in running_fits if late else live:
            jobs.setdefault(f.number % shares, []).append(f.job())
        if late:
            schema = ", ".join([*(f"{c} {t}" for c, t in blocks.select(*_BLOCK).dtypes), "margins binary"])
            new = materialize(blocks.mapInArrow(_written(name, jobs, -(-len(fits) // shares), gaps), schema), "margins")
            blocks.unpersist()
            release(written)
            written, blocks = new, new.persist()
            for f in running_fits:
                f.done = len(f.trees)
            continue
        add_up, decide = _summed(name, jobs, gaps), _decided(jobs, gaps)
        if count_ == 1:  # a single block's sums are whole where they are made
            found = blocks.mapInArrow(_one_after_the_other(add_up, decide), _SPLITS)
        else:
            found = blocks.mapInArrow(add_up, "share int, feature int, sums binary").repartition("share", "feature").mapInArrow(decide, _SPLITS)
        rows = found.collect()
        splits: dict[int, dict[int, Split]] = {f.number: {} for f in live}
        lost: dict[int, float] = {}
        for r in sorted(rows, key=lambda r: r["feature"]):
            if r["node"] < 0:
                loss, weight = r["left"]
                if weight:
                    lost[r["model"]] = loss / weight
                continue
            known = splits[r["model"]].get(r["node"])
            if known is None or r["gain"] > known.gain:
                splits[r["model"]][r["node"]] = Split(r["gain"], r["feature"], r["code"], r["gap_left"], tuple(r["left"]), tuple(r["right"]))
        for f in live:
            f.take(splits[f.number], lost.get(f.number))
    blocks.unpersist()
    release(written)
    if shares > 1:
        release(copies)
    return [f.model() for f in fits]


def fit(data: Binned, params: Params = Params(), held: int = NO_FOLD) -> Model:
    return fit_all(data, [(params, held)])[0]


def score(df: DataFrame, models: dict[str, Model], keep: Sequence[str]) -> DataFrame:
    """The columns `keep` and one output per model, in one pass; gaps stay gaps."""
    prepare_workers(df.sparkSession)
    features = sorted({f for m in models.values() for f in m.features})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = {f: batch.column(f"__{f}").to_numpy(zero_copy_only=False) for f in features}
            out = [pa.array(m.outputs(np.column_stack([values[f] for f in m.features]))) for m in models.values()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *out], [*keep, *models])

    types = dict(df.select(*keep).dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in keep), *(f"`{m}` double" for m in models)])
    return df.select(*keep, *[F.col(f).cast("double").alias(f"__{f}") for f in features]).mapInArrow(run, schema)
