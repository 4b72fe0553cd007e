"""Near-duplicate vectors by hierarchical navigable small-world graphs, one graph per shard.

Equal vectors form a class, and classes are dealt over shards by a hash. Each shard builds its
layered graph once and writes it to the shared folder; every block of queries then searches the
graph of every shard. A query's beam is widened until
its worst entry falls below the threshold, so that all neighbours above it are inside; the beam of
a whole block is widened until an audit (brute force for a sample of its queries) reaches the
target recall, at most to the whole shard. Cosines are computed in double precision from the
vectors as given.

Of the two searches that can find a pair, one by each end, that of the end named by a hash of both
counts, and it counts the link at both ends, so counts always agree. A task returns counts and,
instead of all pairs, the edges of a spanning forest of what it found; components are united from these.
"""

from __future__ import annotations

import hashlib
import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm import arrays, runtime
from lendmill.llm.components import components
from lendmill.session import materialize, release

SIMILAR = 0.95
DEGREE = 16  # links kept per node and layer; twice as many on the ground layer
BUILD_BEAM = 48
BEAM = 32
AUDITED = 256
RECALL = 0.99
# A query searches every shard, so few large graphs cost less than many small ones.
LEAST_SHARDS = 2
# Tasks that the search is cut into at least, by smaller blocks of queries.
LEAST_TASKS = 24
# Bytes of the vectors of a shard and of a block of queries, whatever their length.
SHARD_BYTES = 1 << 26
BLOCK_BYTES = 1 << 24
# A graph is written in pieces of this size.
PART_BYTES = 1 << 22
NULL_ID = -(1 << 63)
# Cells of the table of visited nodes that one graph holds.
VISITED_CELLS = 1 << 25


class Layer:
    """Links of one layer: a row of neighbours per node, -1 where there is none."""

    def __init__(self, n: int, degree: int):
        self.links = np.full((n, degree), -1, np.int32)


class Graph:
    """A layered graph over unit vectors (single precision, used for the search only)."""

    def __init__(self, unit: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, links: list[np.ndarray] | None = None):
        """Build the layers, or take those of a graph that was built before."""
        self.unit, self.degree, self.beam = np.ascontiguousarray(unit, np.float32), degree, beam
        n = len(unit)
        # marks of the current search; an older mark does not count, so the table is seldom cleared
        self._step = max(1, min(1024, VISITED_CELLS // max(n, 1)))
        self._seen, self._mark = np.zeros((self._step, n + 1), np.uint8), 0
        if links is not None:
            self.layers = [Layer(0, 0) for _ in links]
            for layer, known in zip(self.layers, links):
                layer.links = known
            return
        draw = np.random.default_rng(n)
        self.level = np.minimum((-np.log(1 - draw.random(n)) / math.log(degree)).astype(int), 6)
        if n:
            self.level[0] = max(self.level.max(), 0)  # the first node is the entry of every layer
        self.layers = [Layer(n, degree * (1 if k else 2)) for k in range(int(self.level.max()) + 1 if n else 1)]
        done, at = 1, 1
        while at < n:
            size = min(n - at, max(16, min(1024, done)))
            self._insert(np.arange(at, at + size), done)
            at += size
            done = at

    def _insert(self, nodes: np.ndarray, done: int) -> None:
        entry = np.zeros((len(nodes), 1), np.int32)
        inner = self.unit[nodes] @ self.unit[nodes].T
        np.fill_diagonal(inner, -2)
        for k in range(len(self.layers) - 1, -1, -1):
            here = np.flatnonzero(self.level[nodes] >= k)
            wide = self.beam if len(here) else 4
            found, close = self._search(self.layers[k], self.unit[nodes], entry, wide)
            if len(here):
                batch = min(len(here), self.beam // 2)
                mutual = inner[np.ix_(here, here)]
                top = np.argpartition(-mutual, batch - 1, axis=1)[:, :batch]
                ids = np.concatenate([found[here], nodes[here][top].astype(np.int32)], axis=1)
                near = np.concatenate([close[here], np.take_along_axis(mutual, top, 1)], axis=1)
                ids[near <= -2] = -1
                self._link(self.layers[k], nodes[here], ids, near)
            entry = found[:, :4]

    def _choose(self, owners: np.ndarray, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
        """Up to `most` candidates per owner: nearer to the owner than to any one chosen before; the nearest rest fill up."""
        order = np.argsort(-near, axis=1, kind="stable")
        ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
        same = ids[:, :, None] == ids[:, None, :]
        first = ~np.tril(same, -1).any(2)
        usable = (ids >= 0) & first & (ids != owners[:, None])
        vectors = self.unit[np.maximum(ids, 0)]
        between = vectors @ vectors.transpose(0, 2, 1)
        chosen = np.zeros(ids.shape, bool)
        count = np.zeros(len(ids), int)
        for c in range(ids.shape[1]):
            far = ~((between[:, c] > near[:, c : c + 1]) & chosen).any(1)
            take = usable[:, c] & far & (count < most)
            chosen[:, c] = take
            count += take
        # half of the free places go to the nearest of the others
        rest = usable & ~chosen
        fill = rest & (np.cumsum(rest, axis=1) <= ((most - count + 1) // 2)[:, None])
        rank = np.where(chosen, 0, np.where(fill, 1, 2))
        order = np.argsort(rank, axis=1, kind="stable")[:, :most]
        out = np.where(np.take_along_axis(rank, order, 1) < 2, np.take_along_axis(ids, order, 1), -1)
        if out.shape[1] < most:
            out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
        return out

    def _link(self, layer: Layer, nodes: np.ndarray, ids: np.ndarray, near: np.ndarray) -> None:
        most = layer.links.shape[1]
        for lo in range(0, len(nodes), 256):
            part = slice(lo, lo + 256)
            few = max(1, most // 2)  # the other half is left for links from later nodes
            layer.links[nodes[part], :few] = self._choose(nodes[part], ids[part], near[part], few)
        chosen = layer.links[nodes]
        to, source = chosen.reshape(-1), np.repeat(nodes, most)
        ok = to >= 0
        to, source = to[ok], source[ok]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        targets, first, counts = np.unique(to, return_index=True, return_counts=True)
        width = int(min(counts.max(), 2 * most)) if len(counts) else 0
        for lo in range(0, len(targets), 256):
            t, f, c = targets[lo : lo + 256], first[lo : lo + 256], counts[lo : lo + 256]
            # of more new links than fit, an even share
            pick = f[:, None] + (np.arange(width)[None, :] * np.maximum(c, width)[:, None] // max(width, 1))
            fresh = np.where(np.arange(width)[None, :] < np.minimum(c, width)[:, None], source[np.minimum(pick, len(source) - 1)], -1)
            fresh = np.where(pick < (f + c)[:, None], fresh, -1)
            all_ids = np.concatenate([layer.links[t], fresh.astype(np.int32)], axis=1)
            close = np.einsum("ad,akd->ak", self.unit[t], self.unit[np.maximum(all_ids, 0)])
            close[all_ids < 0] = -3
            layer.links[t] = self._choose(t, all_ids, close, most)

    def _search(self, layer: Layer, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The `beam` nearest nodes found per query (ids, cosines, nearest first; -1 and -2 where fewer)."""
        step = self._step
        parts = [self._search_part(layer, queries[a : a + step], entry[a : a + step], beam) for a in range(0, len(queries), step)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _search_part(self, layer, queries, entry, beam):
        m = len(queries)
        if self._mark == 255:
            self._seen[:] = 0
            self._mark = 0
        self._mark += 1
        visited, mark_now = self._seen, self._mark
        rows = np.arange(m)[:, None]
        begin = np.where(self._repeats(entry), -1, entry)
        width = max(beam, begin.shape[1])
        ids = np.full((m, width), -1, np.int32)
        near = np.full((m, width), -2, np.float32)
        open_ = np.zeros((m, width), bool)
        ids[:, : begin.shape[1]] = begin
        sims = np.einsum("ad,akd->ak", queries, self.unit[np.maximum(begin, 0)])
        near[:, : begin.shape[1]] = np.where(begin >= 0, sims, -2)
        open_[:, : begin.shape[1]] = begin >= 0
        visited[rows, begin] = mark_now
        visited[:m, -1] = 0
        live = np.arange(m)
        expand = 4
        while True:
            live = live[open_[live].any(1)]
            if not len(live):
                break
            score = np.where(open_[live], near[live], -9)
            top = np.argpartition(-score, min(expand, width) - 1, axis=1)[:, :expand] if width > expand else np.argsort(-score, axis=1)
            is_open = np.take_along_axis(open_[live], top, 1)
            picked = np.where(is_open, np.take_along_axis(ids[live], top, 1), -1)
            mark = open_[live]
            np.put_along_axis(mark, top, False, 1)
            open_[live] = mark
            fresh = np.where(picked[:, :, None] >= 0, layer.links[np.maximum(picked, 0)], -1).reshape(len(live), -1)
            known = visited[live[:, None], fresh] == mark_now
            fresh = np.where(known, -1, fresh)
            fresh = np.sort(fresh, axis=1)
            fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
            visited[live[:, None], fresh] = mark_now
            visited[:m, -1] = 0
            spread = int((fresh >= 0).sum(1).max())
            if not spread:
                continue
            fresh = np.sort(fresh, axis=1)[:, -spread:]
            sims = np.einsum("ad,akd->ak", queries[live], self.unit[np.maximum(fresh, 0)])
            sims[fresh < 0] = -2
            all_near = np.concatenate([near[live], sims], axis=1)
            best = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
            near[live] = np.take_along_axis(all_near, best, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], fresh], axis=1), best, 1)
            open_[live] = np.take_along_axis(np.concatenate([open_[live], fresh >= 0], axis=1), best, 1) & (ids[live] >= 0)
        order = np.argsort(-near, axis=1, kind="stable")[:, :beam]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)

    @staticmethod
    def _repeats(ids: np.ndarray) -> np.ndarray:
        return np.tril(ids[:, :, None] == ids[:, None, :], -1).any(2)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        queries = np.ascontiguousarray(queries, np.float32)
        entry = np.zeros((len(queries), 1), np.int32)
        for layer in reversed(self.layers[1:]):
            entry = self._search(layer, queries, entry, 8)[0][:, :4]
        return self._search(self.layers[0], queries, entry, min(beam, len(self.unit)))


def neighbours(graph: Graph, stored: np.ndarray, queries: np.ndarray, similar: float, audited: int = AUDITED, recall: float = RECALL) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query row, stored row) of cosines >= `similar`, a part at a time; both inputs are unit vectors in double precision."""
    n, base = len(stored), BEAM
    loose = similar - 1e-4  # the search runs in single precision

    def found(rows: np.ndarray, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(64, (1 << 22) // max(beam, 1) // 64)
        for lo in range(0, len(rows), step):
            part, wide = rows[lo : lo + step], beam
            while len(part):
                ids, near = graph.search(queries[part], wide)
                full = (near[:, -1] >= loose) & (ids.shape[1] < n)
                who, place = np.nonzero((near >= loose) & ~full[:, None])
                yield part[who], ids[who, place]
                part, wide = part[full], wide * 4

    def exact(pairs) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for q, s in pairs:
            for lo in range(0, len(q), 1 << 17):
                a, b = q[lo : lo + (1 << 17)], s[lo : lo + (1 << 17)]
                ok = np.einsum("ad,ad->a", queries[a], stored[b]) >= similar
                yield a[ok], b[ok]

    sample = np.unique(np.linspace(0, len(queries) - 1, min(audited, len(queries))).astype(int)) if len(queries) else np.zeros(0, int)
    true = sum(int((queries[sample[a : a + 64]] @ stored.T >= similar).sum()) for a in range(0, len(sample), 64))
    while base < n and sum(len(q) for q, _ in exact(found(sample, base))) < recall * true:
        base *= 2
    yield from exact(found(np.arange(len(queries)), base))


def _unit(raw: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return rows / np.sqrt(np.einsum("ad,ad->a", rows, rows))[:, None]


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, dims, digest, vector): dims 0 for a vector that cannot have a cosine."""
    for batch in batches:
        lists = batch.column(1)
        values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) + 0.0
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        usable = (sizes > 0) & (bad[ends] == bad[ends - sizes])
        dims, digests, raw = [], [], []
        for a, b, ok in zip((ends - sizes).tolist(), ends.tolist(), usable.tolist()):
            data = b""
            if ok and values[a:b].any():
                row = values[a:b]
                with np.errstate(over="ignore"):
                    size = float(row @ row)
                data = (row if 1e-200 < size < 1e200 else row / np.abs(row).max()).tobytes()  # keeps squares in range
            dims.append(len(data) // 8)
            digests.append(hashlib.md5(data, usedforsecurity=False).hexdigest())
            raw.append(data)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims, pa.int32()), pa.array(digests), pa.array(raw, pa.binary())], ["id", "dims", "digest", "vector"])


def _built(key: tuple[pa.Scalar, ...], stored: pa.Table) -> pa.Table:
    """One shard's classes to its graphs, one for each vector length, as pieces of one file."""
    stored = stored.sort_by("rep")
    parts_of = {}
    lengths = stored["dims"].to_numpy()
    for dims in np.unique(lengths).tolist():
        own = stored.filter(pa.array(lengths == dims))
        base = _unit(own["vector"].to_pylist())
        parts_of |= {f"{dims}/ids": own["rep"].to_numpy(), f"{dims}/copies": own["copies"].to_numpy(), f"{dims}/unit": base}
        parts_of |= {f"{dims}/links/{k}": layer.links for k, layer in enumerate(Graph(base).layers)}
    file = io.BytesIO()
    np.savez(file, **parts_of)
    data = file.getvalue()
    parts = [data[a : a + PART_BYTES] for a in range(0, len(data), PART_BYTES)]
    return pa.table({"shard": pa.array([key[0].as_py()] * len(parts), pa.int32()), "part": pa.array(range(len(parts)), pa.int32()), "data": pa.array(parts, pa.binary())})


def _read(graph: pa.Table) -> dict[int, tuple[Graph, np.ndarray, np.ndarray, np.ndarray]]:
    """(graph, unit vectors, class numbers, copies) by vector length."""
    file = np.load(io.BytesIO(b"".join(graph.sort_by("part")["data"].to_pylist())), allow_pickle=False)
    names = set(file.files)
    out = {}
    for dims in sorted({int(n.split("/")[0]) for n in names}):
        links = [file[f"{dims}/links/{k}"] for k in range(sum(n.startswith(f"{dims}/links/") for n in names))]
        base = file[f"{dims}/unit"]
        out[dims] = (Graph(base, links=links), base, file[f"{dims}/ids"], file[f"{dims}/copies"])
    return out


def _counts_here(asked: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Whether a pair is counted by the search of its first end: true for exactly one of the two orders."""
    low, high = np.minimum(asked, found).astype(np.uint64), np.maximum(asked, found).astype(np.uint64)
    odd = (arrays.mix(low * np.uint64(0x9E3779B97F4A7C15) + high) & np.uint64(1)).astype(bool)
    return (asked < found) == odd


def _block_links(similar: float):
    """One shard's graph and one block of queries to rows (u, v, links): v = u with a count, else an edge with -1."""

    def run(key: tuple[pa.Scalar, ...], graph: pa.Table, queries: pa.Table) -> pa.Table:
        u, v, links = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        stored = _read(graph) if len(graph) and len(queries) else {}
        lengths = queries["dims"].to_numpy()
        for dims, (searched, base, ids, copies) in stored.items():
            asked = queries.filter(pa.array(lengths == dims))
            if not len(asked):
                continue
            asked_ids, asked_copies = asked["rep"].to_numpy(), asked["copies"].to_numpy()
            q_unit = _unit(asked["vector"].to_pylist())
            count, other_count = np.zeros(len(asked_ids), np.int64), np.zeros(len(ids), np.int64)
            group = np.arange(len(ids))
            for q, s in neighbours(searched, base, q_unit, similar):
                other = asked_ids[q] != ids[s]
                q, s = q[other], s[other]
                mine = _counts_here(asked_ids[q], ids[s])
                np.add.at(count, q[mine], copies[s[mine]])
                np.add.at(other_count, s[mine], asked_copies[q[mine]])
                # each query links to its first neighbour; of the others, those not yet in that one's group
                order = np.argsort(q, kind="stable")
                q, s = q[order], s[order]
                new = np.ones(len(q), bool)
                new[1:] = q[1:] != q[:-1]
                head = np.maximum.accumulate(np.where(new, np.arange(len(q)), 0)) if len(q) else np.zeros(0, int)
                keep = new.copy()
                apart = np.flatnonzero(group[s] != group[s[head]])
                while len(apart):
                    a, b = group[s[apart]], group[s[head[apart]]]
                    low, high = np.minimum(a, b), np.maximum(a, b)
                    # one edge for each pair of groups in a round, then the groups are renamed
                    _, one = np.unique(high, return_index=True)
                    keep[apart[one]] = True
                    rename = np.arange(len(group))
                    rename[high[one]] = low[one]
                    while (rename[rename] != rename).any():
                        rename = rename[rename]
                    group = rename[group]
                    apart = apart[group[s[apart]] != group[s[head[apart]]]]
                u.append(asked_ids[q[keep]])
                v.append(ids[s[keep]])
                links.append(np.full(int(keep.sum()), -1))
            for names, counted in ((asked_ids, count), (ids, other_count)):
                some = np.flatnonzero(counted)
                u.append(names[some])
                v.append(names[some])
                links.append(counted[some])
        return pa.table({"u": np.concatenate(u), "v": np.concatenate(v), "links": np.concatenate(links)})

    return run


def near_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", similar: float = SIMILAR,
    least_shards: int = LEAST_SHARDS, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    A vector that is null, empty, zero or holds a null or non-finite value links with nothing, as
    do vectors of different lengths. Rows with equal vectors link with each other; each row counts
    as a vector, also where ids repeat. A null id counts as the smallest. Of
    linked vectors the one with the smallest id is kept, and where vectors share that id the one
    with the least digest. Ties at the threshold link. An empty table gives no row; other columns are ignored.
    """
    runtime.prepare(vectors.sparkSession)
    named = vectors.select(F.coalesce(vectors[id_column].cast("bigint"), F.lit(NULL_ID)).alias("id"), vectors[vector_column].alias("vector"))
    rows = materialize(named.mapInArrow(_prepared, "id long, dims int, digest string, vector binary"), "vectors")
    classes = rows.filter("dims > 0").groupBy("digest", "dims").agg(F.min(F.struct("id", "digest")).alias("least"), F.count(F.lit(1)).alias("copies"), F.min("vector").alias("vector"))
    # a class has a number of its own, written once: the smallest ids of two classes may be equal
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    size = classes.agg(F.coalesce(F.sum(F.col("dims").cast("long") * 8), F.lit(0))).first()[0]
    shards = max(least_shards, -(-size // shard_bytes))
    blocks = max(-(-LEAST_TASKS // shards), -(-size // block_bytes))
    own = F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(shards)).cast("int").alias("shard")
    block = F.pmod(F.xxhash64("digest", F.lit(2)), F.lit(blocks)).cast("int").alias("block")
    columns = ["rep", "copies", "dims", "vector"]
    graphs = materialize(classes.select(own, *columns).groupBy("shard").applyInArrow(_built, "shard int, part int, data binary"), "graphs")
    stored = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = classes.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block, *columns)
    found = stored.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(_block_links(similar), "u long, v long, links long")
    met = materialize(found, "vector-links")
    release(graphs)
    counts = met.filter("links >= 0").groupBy("u").agg(F.sum("links").alias("others"))
    group = components(met.filter("links < 0").select("u", "v"))
    named = materialize(classes.select("rep", "least").join(group, F.col("rep") == F.col("node")).select("rep", "least", "component"), "vector-components")
    firsts = named.groupBy("component").agg(F.min("least").alias("first"))
    group = named.join(firsts, "component").select(F.col("rep").alias("node"), "first")
    facts = classes.join(counts, classes["rep"] == counts["u"], "left").join(group, classes["rep"] == group["node"], "left").select(
        "digest", F.col("dims").alias("d"), F.coalesce("first", "least").alias("least"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    out = rows.join(facts, (rows["digest"] == facts["digest"]) & (rows["dims"] == facts["d"]), "left").select("id", rows["digest"], "n_links", "least")
    kept = F.coalesce(F.struct("id", "digest") == F.col("least"), F.lit(True))
    real = lambda c: F.when(c != NULL_ID, c)
    return out.select(real(F.col("id")).alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), real(F.coalesce("least.id", "id")).alias("component_id"), kept.alias("kept"))
