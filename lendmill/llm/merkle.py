"""Merkle manifest of a table: a tree per group, a tree over the groups, and proofs by recomputing.

A leaf is the digest of a row; `arity` consecutive nodes (the last run may be shorter) make the
next level. Only every `levels`-th level is written: a task gets an aligned subtree of at most
arity^levels stored nodes, computes its top and forgets what lies between. Proofs go the other way.
From the highest stored level down, a task regenerates the missing levels of one subtree from the
stored nodes below, gives each of these its siblings on the way to the top, and adds what is known
above the top. So a node's path is never joined level by level, and no task holds more than one
subtree. The last step folds each leaf's proof, with the leaf as it is now, back to the root.

Positions come from a range partitioning by (group, order), with one row of counts per range and group.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmill.llm import runtime
from lendmill.session import materialize

ARITY = 8
# Height of a subtree whose inner levels are not written: a task holds at most 8^3 of its stored nodes.
LEVELS = 3
# The columns of a leaf in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 3


def leaf(*values: Column) -> Column:
    """The lowercase hex sha256 of the values: `-` for null, else byte count, colon, value."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (c.cast("string") for c in values)]), 256)


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`rows` with `position`, from 0 in each group by `order`, and the group's `size`; written, so that positions stay."""
    index = F.monotonically_increasing_id()
    sliced = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).select(*rows.columns, F.spark_partition_id().alias("_slice"), index.alias("_at"))
    sliced = materialize(sliced, "sliced")
    counts = sliced.groupBy(F.col(group).alias("_group"), F.col("_slice").alias("_of")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    starts = counts.select("_group", "_of", shift.alias("_shift"), F.sum("_n").over(Window.partitionBy("_group")).alias("size"))
    placed = sliced.join(starts, (F.col(group) == F.col("_group")) & (F.col("_slice") == F.col("_of")))
    return materialize(placed.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("position"), "size"), "ranked")


def _parent(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _rows_up(nodes: list[str], arity: int, levels: int, count: int) -> list[list[str]]:
    """The levels of one subtree from its lowest nodes up; it stops where the whole tree (`count` nodes at the bottom) has one node."""
    out = [nodes]
    for _ in range(levels):
        if count == 1:
            break
        out.append([_parent(out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
        count = -(-count // arity)
    return out


def _sorted_nodes(table: pa.Table) -> pa.Table:
    return table.sort_by("position").combine_chunks()


def _tops(arity: int, levels: int):
    """The nodes of one subtree to its top."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = _sorted_nodes(table)
        top = _rows_up(table["digest"].to_pylist(), arity, levels, table["size"][0].as_py())[-1]
        return pa.table({"tree": table["tree"][:1], "position": pa.array([key[1].as_py()], pa.int64()), "digest": pa.array(top), "size": pa.array([-(-table["size"][0].as_py() // arity**levels)], pa.int64())})

    return run


def _subtree(arity: int, levels: int) -> list:
    return ["tree", F.floor(F.col("position") / F.lit(arity**levels)).alias("block")]


def stored_levels(nodes: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> list[DataFrame]:
    """Written nodes (tree, position, digest, size) of every `levels`-th level, from the given ones to the roots.

    `size` is the number of nodes of the level in its tree.
    """
    out = [nodes]
    largest = nodes.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        up = out[-1].groupBy(*_subtree(arity, levels)).applyInArrow(_tops(arity, levels), "tree string, position long, digest string, size long")
        out.append(materialize(up, "level"))
        largest = -(-largest // arity**levels)
    return out


def _siblings(table: pa.Table, upper: list[str], arity: int, levels: int) -> list[list[str]]:
    """For each node of a subtree its left and right siblings, joined, level by level, then what is above the subtree."""
    rows = _rows_up(table["digest"].to_pylist(), arity, levels, table["size"][0].as_py())
    found = [upper]
    for row in reversed(rows[:-1]):
        starts = [i - i % arity for i in range(len(row))]
        found = [["".join(row[a:i]), "".join(row[i + 1 : a + arity]), *found[i // arity]] for i, a in enumerate(starts)]
    return found


def _paths(arity: int, levels: int):
    """Nodes of one subtree and the path above its top to the path of each node."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, above: pa.Table) -> pa.Table:
        found: list[list[str]] = []
        if len(table):
            table = _sorted_nodes(table)
            found = _siblings(table, above["path"][0].as_py(), arity, levels)
        return pa.table({"tree": table["tree"], "position": table["position"], "path": pa.array(found, pa.list_(pa.string()))})

    return run


def paths(levels_stored: list[DataFrame], root_paths: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """(tree, position, path) of the lowest stored nodes; `root_paths` (tree, path) says what is above each tree's root.

    A path lists left and right siblings, joined, from the lowest level up. The siblings of a level
    are made from its stored descendants and dropped with the task.
    """
    now = root_paths.select("tree", F.lit(0).cast("long").alias("position"), "path")
    for below in reversed(levels_stored[:-1]):
        now = _below(below, now, arity, levels).applyInArrow(_paths(arity, levels), "tree string, position long, path array<string>")
        if below is not levels_stored[0]:
            now = materialize(now, "paths")
    return now


def _below(nodes: DataFrame, above: DataFrame, arity: int, levels: int):
    blocks = above.withColumnRenamed("position", "block")
    return nodes.groupBy(*_subtree(arity, levels)).cogroup(blocks.groupBy("tree", "block"))


def _proofs(arity: int, levels: int):
    """Leaves of one subtree and the path above it to (tree, id, digest, proof, folded): siblings do not leave the task."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, above: pa.Table) -> pa.Table:
        proof, folded = [], []
        if len(table):
            table = _sorted_nodes(table)
            for path, now in zip(_siblings(table, above["path"][0].as_py(), arity, levels), table["now"].to_pylist()):
                for left, right in zip(path[::2], path[1::2]):
                    now = _parent([left, now, right])
                proof.append(_parent(path))
                folded.append(now)
        return pa.table({"tree": table["tree"], "id": table["id"], "digest": table["digest"], "proof": pa.array(proof, pa.string()), "folded": pa.array(folded, pa.string())})

    return run


def manifest(docs: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A tree per `lang` (null is a group and the first) over its rows by doc_id, and one over the
    groups' roots. The check tampers with rows whose crc32 of the decimal doc_id is divisible by
    three: A-Z of their text are lower-cased, and the folded root is computed from the leaf of that
    text and the original siblings. A null doc_id comes first and is not tampered with; rows that
    share an id follow one another by leaf, and equal rows have a place and a proof each. Null or
    empty texts are values of a leaf like any other. A table of one row has its leaf as root and an empty proof. An empty table gives no
    row; columns beside the five of a leaf are ignored.
    """
    runtime.prepare(docs.sparkSession)
    row = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), *[docs[c] for c in COLUMNS[1:]])
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    leaves = row.select(
        # a tree's name: null sorts before every language, and languages by their bytes
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").alias("id"), leaf(*[F.col(c) for c in COLUMNS]).alias("digest"),
        leaf(*[F.when(tampered, lowered).otherwise(F.col("text")) if c == "text" else F.col(c) for c in COLUMNS]).alias("now"),
    )
    leaves = ranked(materialize(leaves, "leaves"), "tree", ["id", "digest"])
    forest = stored_levels(leaves.select("tree", "position", "digest", "size"), arity, levels)
    subroots = materialize(forest[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest"), "subroots")
    crown_levels = stored_levels(ranked(subroots, "tree", ["of"]), arity, levels)
    no_path = F.array().cast("array<string>")
    above = paths([crown_levels[0].drop("of"), *crown_levels[1:]], crown_levels[-1].select("tree", no_path.alias("path")), arity, levels)
    named = above.join(crown_levels[0].select("position", "of", F.col("digest").alias("subroot")), "position")
    root_paths = materialize(named.select(F.col("of").alias("tree"), "path", "subroot"), "root-paths")
    root = crown_levels[-1].select(F.col("digest").alias("root"))
    upper = paths(forest[1:], root_paths, arity, levels) if len(forest) > 1 else root_paths.select("tree", F.lit(0).cast("long").alias("position"), "path")
    rows = _below(leaves, upper, arity, levels).applyInArrow(_proofs(arity, levels), "tree string, id long, digest string, proof string, folded string")
    found = root.first()
    root_value = F.lit(found["root"] if found else None).cast("string")
    out = rows.join(root_paths.select(F.col("tree").alias("_tree"), "subroot"), F.col("tree") == F.col("_tree"))
    return out.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", root_value.alias("root"), F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"),
        (F.col("folded") == root_value).alias("verified"),
    )


# The levels that the SQL twin writes out: 8^7 rows of a language, 8^3 languages.
SQL_LEVELS, SQL_CROWN = 7, 3


def _sql_leaf(text: str) -> str:
    values = {c: f"{c}::VARCHAR" for c in COLUMNS} | {"text": text}
    parts = [f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in values.values()]
    return f"sha256({' || '.join(parts)})"


def _sql_climb(name: str, levels: int, arity: int) -> str:
    """From {name}0 (tree, pos, h, row, now, path) to {name}{levels} with one node per tree, level by level."""
    steps = []
    for k in range(levels):
        now, up = f"{name}{k}", f"{name}{k + 1}"
        steps.append(f"""
    {now}_nodes AS (SELECT DISTINCT tree, pos, h FROM {now}),
    {now}_runs AS (
        SELECT tree, pos, count(*) OVER (PARTITION BY tree) AS n,
            coalesce(string_agg(h, '') OVER (PARTITION BY tree, pos // {arity} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
            coalesce(string_agg(h, '') OVER (PARTITION BY tree, pos // {arity} ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
        FROM {now}_nodes),
    {up} AS (
        SELECT tree, pos // {arity} AS pos, row, CASE WHEN n = 1 THEN h ELSE sha256(l || h || r) END AS h,
            CASE WHEN n = 1 THEN now ELSE sha256(l || now || r) END AS now, path || l || r AS path
        FROM {now} JOIN {now}_runs USING (tree, pos))""")
    return ",".join(steps)


def check_sql(arity: int = ARITY) -> str:
    """The same manifest as one SQL statement over `documents`, every level written out."""
    bits = "list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))"
    codes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, x: {bits}), 4294967295)"
    lowered = f"CASE WHEN {crc} % {TAMPERED} = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"
    return f"""
    WITH leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_sql_leaf('text')} AS leaf, {_sql_leaf(lowered)} AS changed FROM documents),
    numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id, leaf) AS row, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
    t0 AS (SELECT tree, pos, row, leaf AS h, changed AS now, '' AS path FROM numbered),{_sql_climb('t', SQL_LEVELS, arity)},
    subroots AS (SELECT tree, min(h) AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM t{SQL_LEVELS} GROUP BY tree),
    c0 AS (SELECT '' AS tree, s.pos, row, subroot AS h, now, path FROM t{SQL_LEVELS} t JOIN subroots s USING (tree)),{_sql_climb('c', SQL_CROWN, arity)}
    SELECT doc_id, leaf, subroot, c.h AS root, sha256(c.path) AS proof_sha256, c.now AS folded_root, c.now = c.h AS verified
    FROM c{SQL_CROWN} c JOIN numbered n USING (row) JOIN subroots s ON s.tree = n.tree
    """
