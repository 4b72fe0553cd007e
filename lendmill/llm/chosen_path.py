"""Jaccard self-join of documents on word shingles by chosen paths.

A document is the set of its shingles (runs of five lower-cased words). Equal sets form a class,
and only classes are joined. A class carries a min-hash signature of 64 places; in this embedding
two sets agree in a place with probability equal to their Jaccard similarity.

A run starts with all classes in one node. A node picks `branch` places at random, by a hash of
its own path; each class goes into the children named by a place and its value there. Similar sets
keep sharing a child, others part. Nodes of at most `bucket` classes are leaves and compared by
brute force, larger ones split again. A node whose children hold as many pairs as itself (a group
of near copies) is not split: that would only copy its classes. Such a node, and one that is still
too large at the last level, is cut into blocks and every pair of blocks is a leaf, so nothing is
dropped. There are at most `MOST_BLOCKS` blocks, so a class is copied that often at most, however
large its group. Runs are repeated until the chance of losing a pair at the threshold is below
`1 - recall`.

Nodes have a position (run, and choice at each level), the same for all classes. A pair may meet in
several leaves and belongs to the one at the first position. A first pass over the leaves compares
signatures and keeps the (leaf, class) rows that own a candidate pair; a second brings the whole
shingle sets there and counts the true links. Pairs are not emitted: a leaf returns the link
counts of its classes and the edges of a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm import arrays, runtime
from lendmill.llm.components import components
from lendmill.session import materialize, release

SHINGLE = 5
SIMILAR = 0.8
PLACES = 64
BRANCH = 2
BUCKET = 1024
LEVELS = 3
RECALL = 1 - 1e-6
# Blocks of a node that is not split; each class of it is copied into as many leaves.
MOST_BLOCKS = 4
SALTS = 16  # tasks that the members of one node are dealt to while they are counted
# Standard deviations below the expected agreement at which a candidate is still checked.
SLACK = 4.5
NULL_ID = -(1 << 63)

_SALTS = arrays.mix(np.arange(1, PLACES + 1, dtype=np.uint64))
_FACTORS = arrays.mix(np.arange(1001, 1001 + PLACES, dtype=np.uint64)) | np.uint64(1)


def miss(similar: float, branch: int, levels: int) -> float:
    """The chance that a pair at the threshold shares no node of the last level in one run."""
    lost = 0.0
    for _ in range(levels):
        lost = (1 - similar * (1 - lost)) ** branch
    return lost


def runs_needed(recall: float, similar: float, branch: int = BRANCH, levels: int = LEVELS) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(miss(similar, branch, levels))))


def _shingles(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, distinct shingle hashes in ascending order per text, offsets) of each slice."""
    for row, end, data, offsets in arrays.slices(texts):
        data = arrays.LOWER[data]
        starts, ends, first = arrays.word_spans(data, offsets, arrays.ALNUM)
        words = arrays.word_hashes(data, starts, ends)
        hashes = arrays.window_hashes(words, width)
        owner, _ = arrays.numbering(first)
        at = np.flatnonzero(arrays.within_text(first, width))
        hashes, owner = hashes[at], owner[at]
        counts = np.diff(first)
        for r in np.flatnonzero((counts > 0) & (counts < width)).tolist():
            short = arrays.window_hashes(words[first[r] : first[r + 1]], int(counts[r]))
            hashes, owner = np.append(hashes, short), np.append(owner, r)
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[new], owner[new]
        yield row, hashes, np.searchsorted(owner, np.arange(end - row + 1))


def _id(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NULL_ID))


def document_key(docs: DataFrame) -> Column:
    """The `row` of `judged` for each row of `docs`."""
    return runtime.row_key(_id(docs), docs["text"].cast("string"))


def _identified(docs: DataFrame) -> DataFrame:
    """(id, row, text): `row` tells texts of one id apart."""
    return docs.select(_id(docs).alias("id"), document_key(docs).alias("row"), docs["text"].cast("string").alias("text"))


def _sketched(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = arrays.text_array(batch.column(2))
            for row, hashes, offsets in _shingles(texts, width):
                n = np.diff(offsets)
                full = np.flatnonzero(n)
                heads = offsets[:-1][full]
                sums = [np.zeros(len(n), np.uint64) for _ in range(2)]
                # wide enough that unrelated texts hardly ever share a node
                marks = np.zeros((len(n), PLACES), np.uint32)
                if len(full):
                    for s, k in zip(sums, (3, 5)):
                        s[full] = np.add.reduceat(arrays.mix(hashes * np.uint64(2 * k + 1) + np.uint64(k)), heads)
                    for p in range(PLACES):
                        least = np.minimum.reduceat((hashes ^ _SALTS[p]) * _FACTORS[p], heads)
                        marks[full, p] = arrays.mix(least) >> np.uint64(32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(row, len(n)) for c in (0, 1)), *(pa.array(s.view(np.int64)) for s in sums), pa.array(n, pa.int32()),
                        *(pa.FixedSizeBinaryArray.from_buffers(pa.binary(m.itemsize * PLACES), len(n), [None, pa.py_buffer(m.tobytes())]).cast(pa.binary()) for m in (marks, marks.astype(np.uint8))),
                    ],
                    ["id", "row", "s1", "s2", "n", "marks", "short"],
                )

    return run


def positions(runs: int, branch: int, levels: int) -> list[int]:
    """The first position of each level, and the number of all positions."""
    out = [0]
    for level in range(1, levels + 1):
        out.append(out[-1] + runs * branch**level)
    return out


def _children(runs: int, branch: int, first: int, start: int):
    """Rows (path, position, rep, marks) to the rows of their children (with the path as `parent`), whose positions begin at `start`.

    `first` is the first position of the rows; -1 stands for the roots of all runs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps = batch.column("rep").to_numpy()
            marks = np.frombuffer(b"".join(batch.column("marks").to_pylist()), np.uint32).reshape(-1, PLACES)
            if first < 0:
                nodes = [(arrays.mix(np.full(len(reps), r + 1, np.uint64)), np.full(len(reps), r)) for r in range(runs)]
            else:
                nodes = [(batch.column("path").to_numpy().view(np.uint64), batch.column("position").to_numpy() - first)]
            for path, at in nodes:
                for lo in range(0, len(reps), 1 << 14):
                    part, some = path[lo : lo + (1 << 14)], marks[lo : lo + (1 << 14)]
                    chosen = arrays.mix(part[:, None] ^ _SALTS[None, :])
                    # the same choices in the same order for all classes of a node
                    place = np.argpartition(chosen, branch - 1, axis=1)[:, :branch].reshape(-1)
                    who = np.repeat(np.arange(len(part)), branch)
                    child = arrays.mix(chosen[who, place] + some[who, place].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                    position = start + at[lo + who] * branch + np.tile(np.arange(branch), len(part))
                    yield pa.RecordBatch.from_arrays([pa.array(part[who].view(np.int64)), pa.array(child.view(np.int64)), pa.array(position, pa.int32()), pa.array(reps[lo + who])], ["parent", "path", "position", "rep"])

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by leaf, in tables that hold whole leaves."""
    held = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        if held is not None:
            now = pa.concat_tables([held, now])
        if not len(now):
            continue
        leaf = now["leaf"].to_numpy()
        cut = int(np.searchsorted(leaf, leaf[-1]))
        if cut:
            yield now.slice(0, cut).combine_chunks()
        held = now.slice(cut)
    if held is not None:
        yield held.combine_chunks()


def _nodes(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """The lists of (position, path) as rows with a path per position, 0 where a class has no leaf."""
    lists = column.combine_chunks()
    row = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
    entries = lists.flatten()
    out = np.zeros((len(lists), width), np.int64)
    out[row, entries.field("position").to_numpy()] = entries.field("path").to_numpy()
    return out


SCALE = 1_000_000  # similarities are compared as whole numbers: no rounding at the threshold


def _agreement(similar: float) -> int:
    return max(1, math.floor(PLACES * similar - SLACK * math.sqrt(PLACES * similar * (1 - similar))))


def _owning(similar: float, width: int):
    """Rows (leaf, position, own, crossed, rep, n, short, nodes) by leaf and size to those that own a candidate pair."""
    agree, top = _agreement(similar), round(similar * SCALE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            leaf, n, own, position = (rows[c].to_numpy().astype(np.int64) for c in ("leaf", "n", "own", "position"))
            crossed = rows["crossed"].to_numpy()
            short = np.frombuffer(b"".join(rows["short"].to_pylist()), np.uint8).reshape(-1, PLACES)
            nodes = _nodes(rows["nodes"], width)
            owns, live, step = np.zeros(len(leaf), bool), np.arange(len(leaf)), 1
            while True:
                live = live[live + step < len(leaf)]
                # sizes ascend within a leaf: a partner that is too large stays so
                live = live[(leaf[live] == leaf[live + step]) & (n[live] * SCALE >= top * n[live + step])]
                if not len(live):
                    break
                x = live[~(owns[live] & owns[live + step]) & (~crossed[live] | (own[live] != own[live + step]))]
                for lo in range(0, len(x), 1 << 14):
                    i = x[lo : lo + (1 << 14)]
                    i = i[(short[i] == short[i + step]).sum(1) >= agree]
                    shared = (nodes[i] == nodes[i + step]) & (nodes[i] != 0)
                    mine = i[shared.argmax(1) == position[i]]
                    owns[mine] = owns[mine + step] = True
                step += 1
            kept = rows.select(["leaf", "position", "own", "crossed", "rep"]).filter(pa.array(owns)).combine_chunks()
            yield from kept.to_batches()

    return run


def _sized(rows: DataFrame, sizes: DataFrame, nodes: int) -> DataFrame:
    """The rows of the nodes in `sizes` (path, size), of which there are at most `nodes`, with the size."""
    if nodes <= runtime.LIGHT:
        return rows.join(F.broadcast(sizes.select("path", "size")), "path")
    # a node may hold a third of all classes: its members are dealt over several tasks
    salted = sizes.select("path", "size", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return rows.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")).join(runtime.for_join(salted, nodes * SALTS), ["path", "salt"]).drop("salt")


_LEAF = ["path", "position", "own", "crossed", "rep"]


def _blocks(rows: DataFrame, bucket: int) -> DataFrame:
    """The leaves of nodes (with their size) that are compared block by block."""
    blocks = F.least(F.ceil(F.col("size") / bucket), F.lit(MOST_BLOCKS)).cast("int")
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("rep"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.withColumn("crossed", F.col("own") != F.col("other"))
    return dealt.select(F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other")).alias("leaf"), *_LEAF)


def leaves(classes: DataFrame, similar: float, branch: int, bucket: int, levels: int, runs: int) -> DataFrame:
    """(leaf, path, position, own, crossed, rep): the leaves of all runs that hold two classes or more.

    `leaf` is the path but for nodes cut into blocks, where it names two blocks; `own` is the
    class's block, and of a `crossed` leaf only pairs of different blocks are compared.
    """
    first = positions(runs, branch, levels)
    schema = "parent long, path long, position int, rep long"
    pairs = F.col("size") * (F.col("size") - 1)
    rows = classes.select("rep", "marks").mapInArrow(_children(runs, branch, -1, 0), schema)
    found = now = split = None
    held, shared = classes.count(), 0
    for level in range(levels):
        before, now = now, materialize(rows, "paths")
        sizes = materialize(now.groupBy("parent", "path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "sizes")
        above, shared = shared, sizes.count()
        met = None
        if split is not None:
            # nodes of the level above that splitting does not make less work of
            left = sizes.groupBy(F.col("parent").alias("path")).agg(F.sum(pairs).alias("left"))
            whole = materialize(split.join(left, "path").filter(F.col("left") >= pairs).select("path", "size"), "whole")
            met = _blocks(_sized(before, whole, above), bucket)
            sizes = sizes.join(whole.select(F.col("path").alias("parent")), "parent", "left_anti")
        split = sizes.filter(F.col("size") > bucket).select("path", "size")
        small = _sized(now, sizes.filter(F.col("size") <= bucket), shared).withColumns({"own": F.lit(0), "crossed": F.lit(False)}).select(F.col("path").alias("leaf"), *_LEAF)
        met = small if met is None else met.union(small)
        if level == levels - 1:
            met = met.union(_blocks(_sized(now, split, shared), bucket))
        met = materialize(met, "leaves")
        release(before)
        found = met if found is None else found.union(met)
        if level == levels - 1 or split.isEmpty():
            break
        parents = _sized(now, split, shared).select("path", "position", "rep").join(runtime.for_join(classes.select("rep", "marks"), held), "rep")
        rows = parents.mapInArrow(_children(runs, branch, first[level], first[level + 1]), schema)
    release(now)
    return found


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, hashes, offsets in _shingles(arrays.text_array(batch.column(1)), width):
                raw = hashes.tobytes()
                sets = [raw[8 * a : 8 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(sets)), pa.array(sets, pa.binary())], ["rep", "items"])

    return run


def _linked(similar: float, width: int):
    """Rows with (n, copies, short, nodes, items) by leaf to (u, v, links): v = u with a count, or an edge with -1."""
    agree, top = _agreement(similar), round(similar * SCALE)

    def one(rep, n, copies, own, crossed: bool, position: int, short, nodes, items) -> Iterator[tuple[int, int, int]]:
        _, local = np.unique(np.concatenate(items), return_inverse=True)
        starts = np.cumsum(n) - n
        holds = np.zeros(int(local.max()) + 1, bool)
        links, group = np.zeros(len(rep), np.int64), np.arange(len(rep))
        for i in range(len(rep) - 1):
            # sizes ascend: partners that are too large come last
            js = np.arange(i + 1, int(np.searchsorted(n * top, n[i] * SCALE, "right")))
            if crossed:
                js = js[own[js] != own[i]]
            js = js[(short[js] == short[i]).sum(1) >= agree]
            js = js[((nodes[js] == nodes[i]) & (nodes[i] != 0)).argmax(1) == position]
            if not len(js):
                continue
            mine = local[starts[i] : starts[i] + n[i]]
            holds[mine] = True
            places = np.repeat(starts[js], n[js]) + arrays.runs(n[js])
            common = np.add.reduceat(holds[local[places]], np.cumsum(n[js]) - n[js], dtype=np.int64)
            holds[mine] = False
            js = js[common * SCALE >= top * (n[i] + n[js] - common)]
            links[i] += copies[js].sum()
            links[js] += copies[i]
            for g in np.unique(group[js]).tolist():
                if g != group[i]:
                    yield rep[i], rep[js[np.argmax(group[js] == g)]], -1
                    group[group == g] = group[i]
        for i in np.flatnonzero(links).tolist():
            yield rep[i], rep[i], links[i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            leaf, rep, n, copies, own, position = (rows[c].to_numpy().astype(np.int64) for c in ("leaf", "rep", "n", "copies", "own", "position"))
            crossed = rows["crossed"].to_numpy()
            short = np.frombuffer(b"".join(rows["short"].to_pylist()), np.uint8).reshape(-1, PLACES)
            nodes = _nodes(rows["nodes"], width)
            items = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["items"].combine_chunks()]
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(leaf)) + 1, [len(leaf)]]).tolist()
            out: list[tuple[int, int, int]] = []
            for a, b in zip(bounds, bounds[1:]):
                out += one(rep[a:b], n[a:b], copies[a:b], own[a:b], bool(crossed[a:b].any()), int(position[a]), short[a:b], nodes[a:b], items[a:b])
            u, v, links = (np.array(c, np.int64) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(links)], ["u", "v", "links"])

    return run


def linked(docs: DataFrame, classes: DataFrame, leaf: DataFrame, size: int, width: int, similar: float) -> DataFrame:
    """(u, v, links): per leaf the exact link counts of its classes (u = v), and the edges of a spanning forest (links -1).

    `width` is the number of positions, `size` the words of a shingle.
    """
    rows = max(classes.count(), leaf.count())
    side = lambda df: runtime.for_join(df, rows)
    lists = leaf.select("rep", "position", "path").distinct().groupBy("rep").agg(F.collect_list(F.struct("position", "path")).alias("nodes"))
    known = materialize(classes.select("rep", "n", "copies", "short").join(side(lists), "rep"), "leaf-lists")
    met = leaf.drop("path").join(side(known.drop("copies")), "rep").repartition("leaf").sortWithinPartitions("leaf", "n", "rep")
    owned = met.select("leaf", "position", "own", "crossed", "rep", "n", "short", "nodes").mapInArrow(_owning(similar, width), "leaf long, position int, own int, crossed boolean, rep long")
    owners = materialize(owned, "owners")
    ends = materialize(classes.select("rep", "least.id", "least.row").join(side(owners.select("rep").distinct()), "rep", "left_semi"), "owning-classes")
    some = runtime.only_slots_of(docs, "row", ends, "row").join(side(ends), ["id", "row"]).select("rep", "text")
    sets = some.mapInArrow(_sets(size), "rep long, items binary").dropDuplicates(["rep"])
    full = owners.join(side(known), "rep").join(side(sets), "rep")
    links = materialize(full.repartition("leaf").sortWithinPartitions("leaf", "n", "rep").mapInArrow(_linked(similar, width), "u long, v long, links long"), "links")
    for read in (known, owners, ends):
        release(read)
    return links


def judged(
    docs: DataFrame, width: int = SHINGLE, similar: float = SIMILAR, branch: int = BRANCH, bucket: int = BUCKET, levels: int = LEVELS, recall: float = RECALL
) -> DataFrame:
    """The columns of `near_duplicates`, the row's key (`row`) and whether it is the first of its linked rows (`kept`).

    A class is named by a number of its own, so that classes whose smallest ids are equal stay
    apart; ids are labels. Of linked rows the first is the one with the smallest (id, row).
    """
    runtime.prepare(docs.sparkSession)
    docs = _identified(docs)
    sketches = materialize(docs.mapInArrow(_sketched(width), "id long, row long, s1 long, s2 long, n int, marks binary, short binary"), "sketches")
    worded = sketches.filter("n > 0")
    per_class = worded.groupBy("s1", "s2", "n").agg(F.min(F.struct("id", "row")).alias("least"), F.count(F.lit(1)).alias("copies"), F.min("marks").alias("marks"), F.min("short").alias("short"))
    # written once and read from there, so the numbers stay
    classes = materialize(per_class.withColumn("rep", F.monotonically_increasing_id()), "classes")
    runs = runs_needed(recall, similar, branch, levels)
    leaf = leaves(classes, similar, branch, bucket, levels, runs)
    links = linked(docs, classes, leaf, width, positions(runs, branch, levels)[-1], similar)
    rows = classes.count()
    side = lambda df: runtime.for_join(df, rows)
    counts = links.filter("links >= 0").groupBy(F.col("u").alias("a")).agg(F.sum("links").alias("others"))
    group = components(links.filter("links < 0").select("u", "v"))
    named = materialize(classes.select("rep", "least").join(side(group), F.col("rep") == F.col("node")).select("rep", "least", "component"), "components")
    firsts = named.groupBy("component").agg(F.min("least").alias("first"))
    group = named.join(side(firsts), "component").select(F.col("rep").alias("node"), "first")
    facts = (
        classes.join(side(counts), classes["rep"] == counts["a"], "left").join(side(group), classes["rep"] == group["node"], "left")
        .select("s1", "s2", "n", "least", F.coalesce("first", "least").alias("first"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    )
    out = sketches.join(side(facts), ["s1", "s2", "n"], "left")
    real = lambda c: F.when(c != NULL_ID, c)
    return out.select(
        real(F.col("id")).alias("doc_id"), real(F.coalesce("first.id", "id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        real(F.coalesce("least.id", "id")).alias("copy_of"), F.col("n").cast("bigint").alias("n_shingles"),
        "row", F.coalesce(F.struct("id", "row") == F.col("first"), F.lit(True)).alias("kept"),
    )


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE, similar: float = SIMILAR, branch: int = BRANCH, bucket: int = BUCKET, levels: int = LEVELS, recall: float = RECALL
) -> DataFrame:
    """Per document: doc_id, class_id, n_links, copy_of, n_shingles.

    Words are lower-cased (A-Z) runs of letters, digits and everything beyond ASCII; a text of
    fewer words than a shingle is one shingle; a null text or one without words links with
    nothing. `n_links` counts the other documents with similarity >= `similar`, copies included;
    `class_id` is the smallest doc_id reachable by links and `copy_of` the smallest with the same
    shingles. A null id counts as the smallest. Rows that repeat an id are documents of their own,
    with the same text or another. An empty table gives no row; other columns are ignored.
    """
    return judged(docs, width, similar, branch, bucket, levels, recall).drop("row", "kept")
