from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest

from lendmill.llm import merkle
from lendmill.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL
from tests.llm.cases import awkward_rows, empty, frame

H = lambda s: hashlib.sha256(s.encode()).hexdigest()
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def plain_leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_tree(nodes, arity=8):
    """(root, [(left, right), ..] of each node) of a list of digests."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            a = i - i % arity
            paths[k].append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + arity])))
        nodes = [H("".join(nodes[i : i + arity])) for i in range(0, len(nodes), arity)]
        at = [i // arity for i in at]
    return nodes[0], paths


def plain(rows):
    """The operator on rows (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        part = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0], plain_leaf(r)))
        trees[lang] = (part, *plain_tree([plain_leaf(r) for r in part]))
    root, crown = plain_tree([trees[lang][1] for lang in langs])
    out = []
    for lang, above in zip(langs, crown):
        part, subroot, paths = trees[lang]
        for r, path in zip(part, paths):
            path = path + above
            now = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                now = (*r[:4], lowered(r[4]))
            now = plain_leaf(now)
            for left, right in path:
                now = H(left + now + right)
            out.append((r[0], plain_leaf(r), subroot, root, H("".join(a + b for a, b in path)), now, now == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_equals_a_plain_tree(spark, levels):
    rows = awkward_rows() + [(k, f"Text {k % 7}", None if k % 5 == 0 else f"l{k % 11:02d}", "s") for k in range(1000, 1700)] + [(None, None, None, None)] * 2 + [(None, "Ab", "en", "s")]
    docs = frame(spark, rows)
    want = plain([(i, s, lang, None if t is None else len(t), t) for i, t, lang, s in rows])
    got = merkle.manifest(docs, levels=levels)
    assert got.columns == COLUMNS
    got = sorted(map(tuple, got.collect()), key=str)
    assert got == want
    tampered = [r for r in got if not r[-1]]
    assert tampered and all(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 for r in tampered)


def test_small_tables(spark):
    assert merkle.manifest(empty(spark)).count() == 0
    rows = [(5, None, None, None)]
    (one,) = merkle.manifest(frame(spark, rows)).collect()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["verified"] and one["proof_sha256"] == H("")
    rows = [(k, "T", "en", "s") for k in range(9)]
    assert sorted(map(tuple, merkle.manifest(frame(spark, rows)).collect()), key=str) == plain([(i, s, lang, 1, t) for i, t, lang, s in rows])


def test_only_every_third_level_is_written(spark):
    nodes = spark.createDataFrame([("t", k, H(str(k)), 600) for k in range(600)], "tree string, position long, digest string, size long")
    levels = merkle.stored_levels(nodes)
    assert [x.count() for x in levels] == [600, 2, 1]
    assert levels[-1].first()["digest"] == plain_tree([H(str(k)) for k in range(600)])[0]


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLES['op11_checkpointed_merkle']})").fetchall()
    got = QUERIES["op11_checkpointed_merkle"](spark, SMALL).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and len(got) == 200
