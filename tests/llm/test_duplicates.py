from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendmill.llm import chosen_path, difference_cover, hnsw, positional_index, runtime
from lendmill.llm.components import components
from tests.llm.cases import alnum_words, awkward_rows, empty, frame, sentence


def groups(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200)] + [(rnd.randint(300, 360), rnd.randint(300, 360)) for _ in range(40)] + [(1, 0), (5, -7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == groups({x for e in real for x in e}, real)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def shingles(text):
    words = alnum_words(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_links(rows):
    """By row number: linked rows, for every pair of rows."""
    sets, links = [shingles(r[1]) for r in rows], {i: set() for i in range(len(rows))}
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 10 * common >= 8 * (len(a) + len(sets[j]) - common):
                links[i].add(j)
                links[j].add(i)
    return links


@pytest.mark.parametrize("bucket,levels", [(512, 6), (2, 2)])
def test_join_equals_all_pairs(spark, bucket, levels):
    rows = [r if r[0] is not None else (0, *r[1:]) for r in awkward_rows()]
    links = plain_links(rows)
    least = groups({r[0] for r in rows}, [(rows[i][0], rows[j][0]) for i, js in links.items() for j in js])
    want = sorted((rows[i][0], least[rows[i][0]], len(js)) for i, js in links.items())
    got = chosen_path.near_duplicates(frame(spark, rows), bucket=bucket, levels=levels)
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got.collect()) == want


def near_copies(count, seed=5):
    """Copies of one text with a few words changed each: most nodes of the tree hold most of them."""
    rnd = random.Random(seed)
    base = sentence(rnd, 120).split()
    rows = []
    for i in range(count):
        words = list(base)
        for k in range(4):
            words[rnd.randrange(len(words))] = f"w{i}x{k}"
        rows.append((i, " ".join(words), "en", "s"))
    return rows


def test_rows_of_a_group_of_near_copies_grow_with_its_size(spark):
    runs = chosen_path.runs_needed(chosen_path.RECALL, chosen_path.SIMILAR)
    made = []
    for count in (40, 160):
        runtime.prepare(spark)
        sketches = chosen_path._identified(frame(spark, near_copies(count))).mapInArrow(chosen_path._sketched(5), "id long, row long, s1 long, s2 long, n int, marks binary, short binary")
        classes = sketches.select(sketches["id"].alias("rep"), "marks")
        made.append(chosen_path.leaves(classes, chosen_path.SIMILAR, 2, 4, 3, runs).count())
    assert made[1] < 6 * made[0]


def test_links_of_a_group_of_near_copies(spark):
    rows = near_copies(60)
    links = plain_links(rows)
    got = chosen_path.near_duplicates(frame(spark, rows), bucket=4, levels=3)
    assert {r["doc_id"]: r["n_links"] for r in got.collect()} == {rows[i][0]: len(js) for i, js in links.items()}


def test_join_without_rows_or_ids(spark):
    assert chosen_path.near_duplicates(empty(spark)).count() == 0
    rows = [(None, "one two three four five six", "en", "s"), (4, "one two three four five six", "en", "s")]
    got = {r["doc_id"]: r for r in chosen_path.near_duplicates(frame(spark, rows)).collect()}
    assert got[4]["class_id"] is None and got[4]["n_links"] == 1 and got[None]["n_links"] == 1


def test_runs_reach_the_recall():
    runs = chosen_path.runs_needed(1 - 1e-6, 0.8)
    assert chosen_path.miss(0.8, chosen_path.BRANCH, chosen_path.LEVELS) ** runs <= 1e-6


def plain_repeats(rows, window):
    first, out = {}, []
    words = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows]
    for r, w in zip(rows, words):
        for p in range(len(w) - window + 1):
            first[tuple(w[p : p + window])] = min(first.get(tuple(w[p : p + window]), (r[0], p)), (r[0], p))
    for r, w in zip(rows, words):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < (r[0], p):
                gone[p : p + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((r[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_repeats_equal_all_windows(spark):
    rows = [r if r[0] is not None else (-1, *r[1:]) for r in awkward_rows()]
    rows += [(400 + k, " ".join(["again"] * n) + " end", "en", "s") for k, n in enumerate((19, 20, 21, 45))]
    got = sorted(tuple(r)[:4] for r in difference_cover.remove_repeats(frame(spark, rows)).collect())
    assert got == plain_repeats(rows, 20)


def test_repeats_with_another_cover_and_no_rows(spark):
    rows = [(i, sentence(random.Random(i % 4), 30 + i), "en", "s") for i in range(12)]
    got = sorted(tuple(r)[:4] for r in difference_cover.remove_repeats(frame(spark, rows), 10, 7, (0, 1, 3)).collect())
    assert got == plain_repeats(rows, 10)
    assert difference_cover.remove_repeats(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        difference_cover.remove_repeats(empty(spark), 20, 13, (0, 1, 2))


def plain_hits(rows, items, window):
    by_window = {}
    for item_id, text in items:
        words = alnum_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            by_window.setdefault(tuple(words[i : i + window]), set()).add("null" if item_id is None else str(item_id))
    out = []
    for r in rows:
        words, found = alnum_words(r[1]), set()
        hit = [False] * len(words)
        for n in {len(w) for w in by_window}:
            for i in range(len(words) - n + 1):
                if (ids := by_window.get(tuple(words[i : i + n]))) is not None:
                    found |= ids
                    hit[i : i + n] = [True] * n
        out.append((-1 if r[0] is None else r[0], len(words), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), any(hit)))
    return sorted(out)


def test_index_equals_every_window(spark):
    rows = awkward_rows()
    long = next(r[1] for r in rows if r[0] == 6).split()
    items = [("a", " ".join(long[50:90])), ("b", "THE"), ("c", "same text, for many"), ("d", " ".join(long[500:512]).upper()), ("e", None), ("f", "!!"), (None, "again and again"), ("a", rows[3][1]), ("a", rows[3][1]), ("g", "never seen words at all"), ("h", "naïve")]
    bench = spark.createDataFrame([(i, t, "z", 1) for i, t in items], "item_id string, text string, words string, term long")
    got = positional_index.digest(positional_index.decontaminate(frame(spark, rows), bench)).fillna({"doc_id": -1})
    assert sorted(tuple(r) for r in got.collect()) == plain_hits(rows, items, 10)


def test_index_with_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id int, text string")
    rows = awkward_rows()
    out = positional_index.digest(positional_index.decontaminate(frame(spark, rows), bench))
    assert out.count() == len(rows) and out.filter("contaminated").count() == 0
    assert positional_index.decontaminate(empty(spark), spark.createDataFrame([(1, "a b")], "item_id int, text string")).count() == 0


def test_proximity(spark):
    bench = spark.createDataFrame([(1, "amber glacier saddle thunder")], "item_id int, text string")
    rows = [(1, "amber glacier saddle thunder", "en", "s"), (2, "amber or glacier or saddle thunder", "en", "s"), (3, "amber x x x x x x x glacier", "en", "s"), (4, "saddle thunder", "en", "s"), (5, "glacier glacier glacier thunder thunder thunder", "en", "s")]
    near = positional_index.proximity_matches(frame(spark, rows), bench, 3)
    assert {r["doc_id"] for r in near.collect()} >= {1, 2} and {r["doc_id"] for r in near.collect()} <= {1, 2, 5}


def plain_near(rows, similar=0.95):
    unit = {}
    for i, (_, v) in enumerate(rows):
        x = np.array([np.nan if c is None else c for c in v] if v else [np.nan], float)
        if np.isfinite(x).all() and x.any():
            x = x / np.abs(x).max()
            unit[i] = x / np.linalg.norm(x)
    links = {i: 0 for i in range(len(rows))}
    edges = []
    for i, a in unit.items():
        for j, b in unit.items():
            if i < j and len(a) == len(b) and a @ b >= similar:
                links[i] += 1
                links[j] += 1
                edges.append((rows[i][0], rows[j][0]))
    least = groups({r[0] for r in rows}, edges)
    return sorted((r[0], links[i], least[r[0]], r[0] == least[r[0]]) for i, r in enumerate(rows))


def test_vectors_equal_all_pairs(spark):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(30, 16))
    rows = [(i, (centres[i % 30] + draw.normal(size=16) * draw.choice([0.02, 0.15, 1.0])).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(20)] + [(2000 + i, [2 * x for x in rows[1][1]]) for i in range(3)]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [None] + [1.0] * 15), (3004, [float("nan")] * 16), (3005, [float("inf")] + [1.0] * 15), (3006, [1.0, 2.0]), (3007, [2.0, 4.0]), (3008, [1e300] * 16), (3009, [1.0] * 16), rows[5], rows[5]]
    frame_ = spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "vec_id long, embedding array<double>, id string, rep int")
    got = hnsw.near_vectors(frame_, least_shards=3, block_bytes=150 * 16 * 8)
    assert sorted(tuple(r) for r in got.collect()) == plain_near(rows)


def test_vectors_without_rows(spark):
    assert hnsw.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    one = hnsw.near_vectors(spark.createDataFrame([(None, [1.0, 0.0])], "vec_id long, embedding array<float>")).collect()
    assert (one[0]["vec_id"], one[0]["n_links"], one[0]["kept"]) == (None, 0, True)


def test_beam_widens_for_a_large_group():
    draw = np.random.default_rng(9)
    base = np.concatenate([draw.normal(size=(600, 24)), draw.normal(size=24) + draw.normal(size=(500, 24)) * 0.02])
    base /= np.linalg.norm(base, axis=1)[:, None]
    found = sum(len(q) for q, _ in hnsw.neighbours(hnsw.Graph(base), base, base, 0.95))
    true = int((base @ base.T >= 0.95).sum())
    assert found >= 0.99 * true and found <= true


def test_filters_by_id(spark):
    rows = awkward_rows()
    docs = frame(spark, rows)
    dropped = spark.createDataFrame([(None,), (6,), (10,), (10,)], "doc_id long")
    left = runtime.without(docs, "doc_id", dropped)
    assert left.columns == docs.columns
    assert left.count() == sum(r[0] not in (None, 6, 10) for r in rows)
    assert runtime.once(docs, "doc_id", ["doc_id", "text"]).count() == len({(r[0], r[1]) for r in rows})


def test_repeats_of_texts_that_share_an_id(spark):
    rnd = random.Random(5)
    shared = sentence(rnd, 25)
    rows = [(i, sentence(rnd, 60), "en", "s") for i in (None, None, 3, 3)]
    rows += [(i, f"{sentence(rnd, 10)} from{k} {shared} to{k} {sentence(rnd, 10)}", "en", "s") for k, i in enumerate((None, None, 7, 7))]
    got = {}
    for r in difference_cover.remove_repeats(frame(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], r["n_removed"]))
    assert sorted(got[None]) == [(47, 0), (47, 25), (60, 0), (60, 0)]
    assert sorted(got[3]) == [(60, 0), (60, 0)] and sorted(got[7]) == [(47, 25), (47, 25)]


def test_join_where_ids_are_null_or_repeat(spark):
    rnd = random.Random(11)
    texts = [sentence(rnd, 60) for _ in range(5)]
    near = [" ".join(["changed", *t.split()[1:]]) for t in texts]
    ids = [None, None, 7, 7, 7]
    rows = [(i, t, "en", "s") for i, t in zip(ids, texts)] + [(20 + k, t, "en", "s") for k, t in enumerate(near)]
    rows += [(30, texts[0], "en", "s"), (31, texts[2], "en", "s"), (None, near[1], "en", "s")]
    links = plain_links(rows)
    for bucket, levels in ((512, 6), (2, 2)):
        got = chosen_path.near_duplicates(frame(spark, rows), bucket=bucket, levels=levels).collect()
        key = lambda r: tuple(-1 if x is None else x for x in r)
        assert sorted(key((r["doc_id"], r["n_links"])) for r in got) == sorted(key((rows[i][0], len(js))) for i, js in links.items())
        assert {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] in (20, 21, 22, 23, 24, 30, 31)} == {20: None, 21: None, 22: 7, 23: 7, 24: 7, 30: None, 31: 7}
    kept = chosen_path.judged(frame(spark, rows)).filter("kept").collect()
    assert sorted(key((r["doc_id"],)) for r in kept) == [(-1,), (-1,), (7,), (7,), (7,)]


def test_vectors_where_ids_are_null_or_repeat(spark):
    base = np.eye(8)
    rows = [(None, base[0] + 0.05 * base[5]), (None, base[0]), (None, base[2]), (7, base[3]), (7, base[4]), (8, base[3] + 0.05 * base[6]), (9, base[4] + 0.05 * base[6])]
    got = hnsw.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>"))
    want = [(None, 1, None), (None, 1, None), (None, 0, None), (7, 1, 7), (7, 1, 7), (8, 1, 7), (9, 1, 7)]
    got = got.collect()
    assert sorted(map(str, ((r["vec_id"], r["n_links"], r["component_id"]) for r in got))) == sorted(map(str, want))
    assert sorted(str(r["vec_id"]) for r in got if r["kept"]) == ["7", "7", "None", "None"]


def test_large_tables_of_the_join_are_not_broadcast(spark, monkeypatch):
    """Of what grows with the documents nothing reaches the driver; the filter of wanted keys is a bit a slot."""
    rows = [r if r[0] is not None else (0, *r[1:]) for r in awkward_rows()]
    docs = frame(spark, rows)
    plans, write = [], chosen_path.materialize
    want = sorted(map(tuple, chosen_path.near_duplicates(docs, bucket=2, levels=2).collect()), key=str)

    def noted(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        sides.append((label, df._jdf.queryExecution().sparkPlan().toString().count("BroadcastHashJoin")))
        return write(df, label)

    sides = []
    monkeypatch.setattr(chosen_path, "materialize", noted)
    monkeypatch.setattr(runtime, "LIGHT", 0)
    found = chosen_path.near_duplicates(docs, bucket=2, levels=2)
    broadcast = dict.fromkeys(("leaf-lists", "owners", "owning-classes", "components"), 0) | {"links": 1}  # the wanted keys' slots
    assert {label: n for label, n in sides if label in broadcast} == broadcast
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().sparkPlan().toString()
    assert sorted(map(tuple, found.collect()), key=str) == want


def test_wanted_keys_are_sent_as_bits(spark):
    """A hundred thousand keys are few words of 64 slots; whatever the key, a row of a wanted one stays, and a null key counts as one."""
    docs = spark.range(3000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("k"))
    wanted = spark.range(100_000).select((F.col("id") * 3).alias("k")).union(spark.createDataFrame([(None,)], "k long"))
    words = runtime._words(wanted, "k")
    assert words.count() <= runtime.SLOTS // 64
    met, rest = runtime.split_by_slots(docs, "k", wanted, "k")
    slots = {r[0] for r in wanted.select(runtime.slot(F.col("k"))).distinct().collect()}
    plain = docs.withColumn("s", runtime.slot(F.col("k"))).collect()
    count = lambda df: sorted((r["k"] is None, r["k"] or 0) for r in df.collect())
    for df, inside in ((met, True), (rest, False)):
        assert count(df) == sorted((r["k"] is None, r["k"] or 0) for r in plain if (r["s"] in slots) == inside)
    assert count(runtime.only_slots_of(docs, "k", wanted, "k")) == count(met)
