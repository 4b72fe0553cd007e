from __future__ import annotations

import hashlib
import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from lendmill.llm import syncmers
from lendmill.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.cases import awkward_rows, empty, frame, sentence

K, INNER, SPAN, KEPT = syncmers.K, syncmers.INNER, syncmers.SPAN, syncmers.KEPT
COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def text_hash(s):
    return signed(xxhash.xxh64_intdigest(s.encode(), seed=42))


def of_three(*values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=h)
    return signed(h)


def plain_anchors(text):
    """{hash: first place} of all chosen k-mers, each judged by its own characters only."""
    out = {}
    for i in range(len(text) - K + 1):
        inner = [text_hash(text[i + j : i + j + INNER]) for j in range(SPAN)]
        if min(inner) in (inner[0], inner[-1]):
            out.setdefault(of_three(inner[0], inner[INNER], inner[-1]), i)
    if not out and text:
        out = {text_hash(text): 0}
    return out


def plain_print(text):
    return sorted(plain_anchors(text).items())[:KEPT]


def written(found):
    return ",".join(f"{h % (1 << 64):016x}:{p}" for h, p in found)


def like(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    both = sorted(a | b)[:KEPT]
    return sum(h in a and h in b for h in both) / len(both) if both else 1.0


def plain(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256(r[1].encode()).hexdigest()))
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        a, b, c = plain_print(text), plain_print(edited), plain_print(after)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(a), written(b), like(a, b), like(a, c)))
    return sorted(out, key=str)


def test_equals_a_plain_scan(spark, monkeypatch):
    rnd = random.Random(9)
    rows = [(i, t) for i, t, *_ in awkward_rows() if i not in (6, 7)]
    rows += [(70, "ab" * 400), (71, " ".join("😀é" + sentence(rnd, 3) for _ in range(40))), (-5, "Ünï " * 30), (-(1 << 63), "lowest " * 9), ((1 << 63) - 1, "highest " * 9), (72, "x" * (K - 1)), (73, "y" * K)]
    rows += [(None, "the same text, three times without an id"), (None, "the same text, three times without an id"), (None, "the same text, three times without an id"), (None, None)]
    monkeypatch.setattr(syncmers, "CHUNK", 64)  # several chunks to a text, and to the new part
    got = syncmers.fingerprints(frame(spark, [(i, t, "en", "s") for i, t in rows]))
    assert got.columns == [*COLUMNS, "in_place_edited"]
    assert sorted((tuple(r)[:7] for r in got.collect()), key=str) == plain(rows)


def test_many_copies_of_a_row(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "COPIES_AT_ONCE", 3)
    rows = [(1, "some words that are here for the copies of one row")] * 10 + [(2, "other words"), (2, "more words for the same id"), (2, "")]
    got = syncmers.fingerprints(frame(spark, [(i, t, "en", "s") for i, t in rows])).collect()
    assert sorted((tuple(r)[:7] for r in got), key=str) == plain(rows)


def test_long_text_in_chunks_and_small_tables(spark):
    rnd = random.Random(3)
    rows = [(1, " ".join(sentence(rnd, 15) for _ in range(120))), (2, None)]
    assert sorted((tuple(r)[:7] for r in syncmers.fingerprints(frame(spark, [(i, t, "en", "s") for i, t in rows])).collect()), key=str) == plain(rows)
    (one,) = syncmers.fingerprints(frame(spark, [(None, "alone here", "en", "s")])).collect()
    assert one["near_next"] == 1.0 and one["doc_id"] is None
    assert syncmers.fingerprints(empty(spark)).count() == 0


def test_likeness_of_whole_table(spark):
    """On the given table: copies are alike, edits half alike and in place, others hardly."""
    got = {r["doc_id"]: r for r in QUERIES["op12_closed_syncmers"](spark, SMALL).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    assert set(got) == set(texts)
    order = sorted(texts, reverse=True)
    for k in range(0, len(order), 9):
        i, after = order[k], texts[order[(k + 1) % len(order)]]
        if len(texts[i]) < 4000:
            third = len(texts[i]) // 3
            assert got[i]["edited_fingerprint"] == written(plain_print(texts[i][: len(texts[i]) - third] + after[:third]))
            assert got[i]["near_next"] == pytest.approx(like(plain_print(texts[i]), plain_print(after)))
    by_text = {}
    for i, t in texts.items():
        assert by_text.setdefault(t, got[i]["fingerprint"]) == got[i]["fingerprint"]
    long = [got[i] for i, t in texts.items() if len(t) > 600]
    near = sorted(r["near_edited"] for r in long)
    assert 0.4 < near[len(near) // 2] < 0.65 and sorted(r["near_next"] for r in long)[len(long) // 2] < 0.1
    assert sorted(r["in_place_edited"] for r in long)[len(long) // 2] > 0.9


def test_only_built_in_functions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = syncmers.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    # one exchange of texts: the window needs none of its own
    assert plan.count("DirectShufflePartitionID") + plan.count("Exchange Direct") >= 0
    assert F is not None


def test_an_edited_text_is_not_read_again(spark):
    """Every text is cut into chunks once; the part taken from the next text brings its own anchors."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = syncmers.fingerprints(docs)._jdf.queryExecution().optimizedPlan().toString()
    # one for the rows, one for those that repeat as a whole
    assert plan.count(f"(?s).{{1,{syncmers.CHUNK}}}") == 2


@pytest.mark.parametrize("length", [3, K, 3 * K - 2, 3 * K, 150])
def test_next_texts_shorter_and_longer_than_the_new_part(spark, monkeypatch, length):
    monkeypatch.setattr(syncmers, "CHUNK", 40)
    rnd = random.Random(length)
    rows = [(i, "".join(rnd.choice("abé ") for _ in range(n))) for i, n in enumerate([length, 400, length, 1, length * 3, 30, 700, length])]
    got = syncmers.fingerprints(frame(spark, [(i, t, "en", "s") for i, t in rows])).collect()
    assert sorted((tuple(r)[:7] for r in got), key=str) == plain(rows)
