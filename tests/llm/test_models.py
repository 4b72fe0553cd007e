from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa

from lendmill.llm import language, site_quality
from tests.llm.cases import WORDS, awkward_rows, empty, frame, sentence

GERMAN = "der die das und nicht mit auch über schön straße häuser gehen zwischen jahre grün möchte".split()


def two_languages(n=400):
    rnd = random.Random(1)
    rows = []
    for i in range(n):
        german = i % 2
        words = [rnd.choice(GERMAN if german else WORDS) for _ in range(rnd.randint(8, 40))]
        rows.append((i, " ".join(words), "de" if german else "en", f"s{i % 5}"))
    return rows


def test_language_of_held_out_rows(spark):
    rows = two_languages() + [(1000, None, "en", "s"), (1001, "123 !?", "de", "s"), (1002, "", None, "s"), (None, "das und die", "de", "s"), (1003, "über die straße", None, None), (0, rows_text(0), "en", "s0")]
    got = language.identify(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    lang = {r[0]: r[2] for r in rows}
    held = [r for r in got if r["held_out"] and r["doc_id"] < 400]
    assert len(held) > 40 and all(r["lang_pred"] == lang[r["doc_id"]] and 0.5 < r["score"] <= 1 for r in held)
    by = {r["doc_id"]: r for r in got}
    for d in (1000, 1001, 1002):
        assert (by[d]["lang_pred"], by[d]["score"]) == ("und", 0.0)
    assert by[None]["lang_pred"] == "de" and not by[None]["held_out"] and by[1003]["lang_pred"] == "de"


def rows_text(i):
    return two_languages()[i][1]


def test_language_without_labels(spark):
    assert language.identify(empty(spark)).count() == 0
    got = language.identify(frame(spark, [(1, "some words", None, "s"), (2, None, None, None)])).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}


def test_scores_are_sums_over_the_whole_text():
    texts = ["Über die Straße", "", "the of river 12 stone", "a" * 3000]
    table = np.random.default_rng(0).normal(size=(language.BUCKETS + 1, 2)).astype(np.float32)
    table[-1] = 0
    model = language.Model(["a", "b"], table, np.array([0.1, -0.1]))
    logits, full = language._logits(model, texts)
    for k, (seen, counts, total) in enumerate(language._sparse(texts)):
        plain = (table[seen] * (counts / max(total, 1))[:, None]).sum(0) + model.bias if total else model.bias
        assert np.allclose(logits[k], plain, atol=1e-4) and full[k] == bool(total)


def labelled(n=1500):
    rnd = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        text = " ".join(sentence(rnd, 12) for _ in range(3))
        kind = i % 10
        if kind == 0:
            text = text.upper().replace(" ", "!! ")
        if kind == 1:
            text = text.replace("stone", "idiot", 1) + " idiot moron scum"
        rows.append((i, text, "en", f"s{i % 7}"))
        if i % 2 == 0 or kind == 1:
            labels.append((i, int(kind != 0), int(kind == 1)))
    return rows, labels


def test_quality_finds_both_faults(spark):
    rows, labels = labelled()
    rows += [(5000, None, None, None), (5001, "", "en", None), (None, rows[0][1], "en", "s1"), rows[2], (5002, " ".join(r[1] for r in rows[2:400] if r[0] % 10 > 1), "en", "s1")]
    table = spark.createDataFrame([*labels, (None, 1, 0), (2, 1, 0), (3, None, 1), (99999, 0, 1)], "doc_id long, quality int, toxic int")
    got = site_quality.classify(frame(spark, rows), table).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 1500:
            assert r["rejected"] == (r["doc_id"] % 10 in (0, 1)), r
        assert 0 <= r["p_fault"] <= 1 and 0 < r["path_rate"] < 1
    assert [r["rejected"] for r in got if r["doc_id"] == 5002] == [False]


def test_quality_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = site_quality.classify(frame(spark, awkward_rows()), none)
    assert got.filter("rejected").count() == 0 and got.count() == len(awkward_rows())
    assert site_quality.classify(empty(spark), none).count() == 0


def test_sparse_sites_shrink_toward_their_parents(spark):
    rates = [(float(k) / 10, 1000, 0.5) for k in range(1, 10)]
    strong = site_quality._strength(spark.createDataFrame(rates, "rate double, n long, parent double"))
    weak = site_quality._strength(spark.createDataFrame([(0.5, 1000, 0.5)] * 9, "rate double, n long, parent double"))
    assert strong < 10 < weak
    from pyspark.sql import functions as F

    row = spark.range(1).select(site_quality._shrunk(F.lit(1.0), F.lit(1.0), F.lit(0.2), 9.0).alias("few"), site_quality._shrunk(F.lit(900.0), F.lit(1000.0), F.lit(0.2), 9.0).alias("many")).first()
    assert abs(row["few"] - 0.28) < 1e-9 and row["many"] > 0.89


def plain_ftrl(examples, labels, classes, how, order):
    """Follow-the-regularised-leader one number at a time; examples are {place: value}. The weights of every class by place."""
    z, n = [{} for _ in range(classes)], [{} for _ in range(classes)]

    def weight(c, f):
        zi, ni = z[c].get(f, 0.0), n[c].get(f, 0.0)
        if abs(zi) <= how.l1:
            return 0.0
        return -math.copysign(abs(zi) - how.l1, zi) / ((how.beta + math.sqrt(ni)) / how.alpha + how.l2)

    for i in order:
        x = examples[i]
        w = [{f: weight(c, f) for f in x} for c in range(classes)]
        logits = [sum(w[c][f] * v for f, v in x.items()) for c in range(classes)]
        top = max(logits)
        chance = [math.exp(v - top) for v in logits]
        for c in range(classes):
            error = chance[c] / sum(chance) - (labels[i] == c)
            for f, v in x.items():
                g = error * v
                before = math.sqrt(n[c].get(f, 0.0))
                n[c][f] = n[c].get(f, 0.0) + g * g
                z[c][f] = z[c].get(f, 0.0) + g - (math.sqrt(n[c][f]) - before) / how.alpha * w[c][f]
    return [{f: weight(c, f) for f in z[c]} for c in range(classes)]


def test_training_equals_a_plain_twin():
    rows = two_languages(60)
    texts, labels = [r[1] for r in rows], [i % 2 for i in range(60)]
    how = language.Training(epochs=2)
    idf = np.random.default_rng(3).uniform(1, 4, language.BUCKETS)
    table = language._trained(2, idf, how)((pa.scalar(0),), pa.table({"text": texts, "y": pa.array(labels, pa.int32())}))
    got = np.frombuffer(table["weights"][0].as_py(), np.float32).reshape(2, -1)
    examples = []
    for seen, counts, total in language._sparse(texts):
        examples.append({int(f): how.scale * c / total * idf[f] for f, c in zip(seen, counts)} | {language.BUCKETS: 1.0})
    draw = np.random.default_rng(0)
    order = [i for _ in range(2) for i in draw.permutation(60).tolist()]
    want = plain_ftrl(examples, labels, 2, how, order)
    for c in range(2):
        plain = np.zeros(language.BUCKETS + 1)
        plain[list(want[c])] = list(want[c].values())
        assert np.allclose(got[c], plain, atol=1e-5) and np.abs(plain).max() > 0.01


def test_temperature_is_the_least_loss(spark):
    rows = two_languages(200)
    rng = np.random.default_rng(5)
    table = np.zeros((language.BUCKETS + 1, 2), np.float32)
    table[:-1] = rng.normal(size=(language.BUCKETS, 2)) * 30
    model = language.Model(["de", "en"], table, np.zeros(2))
    y = [int(rng.integers(0, 2)) for _ in rows]
    found = language._temperature(model, spark.createDataFrame([(a, r[1]) for a, r in zip(y, rows)], "y int, text string"))
    logits, _ = language._logits(model, [r[1] for r in rows])

    def loss(t):
        return np.mean([np.log(np.exp(v / t - (v / t).max()).sum()) + (v / t).max() - v[k] / t for v, k in zip(logits, y)])

    grid = np.exp(np.linspace(-4, 4, 400))
    assert loss(found) <= min(map(loss, grid)) + 1e-6


def test_posteriors_equal_a_plain_twin(spark):
    rnd = random.Random(2)
    rows, labels = labelled(800)
    rows = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "c", None]) if i % 3 else f"rare{i}") for i, t, _, _ in rows]
    got = site_quality.classify(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    site = {r[0]: (r[3] or "", r[2] or "") for r in rows}
    p = {r["doc_id"]: min(max(1 - (1 - r["p_low_quality"]) * (1 - r["p_toxic"]), 1e-9), 1 - 1e-9) for r in got}

    def strength(groups):
        """(sum, n, parent) of each group."""
        n = sum(g[1] for g in groups)
        within = sum(q * (1 - q) * k for _, k, q in groups) / n
        between = (sum(k * (s / k - q) ** 2 for s, k, q in groups) - len(groups) * within) / n
        return min(max(within / between - 1, 2.0), 1e6) if between > 0 else 1e6

    def sums(of):
        out = {}
        for i, v in p.items():
            s, n = out.get(of(i), (0.0, 0))
            out[of(i)] = (s + v, n + 1)
        return out

    overall = sum(p.values()) / len(p)
    hosts, paths = sums(lambda i: site[i][0]), sums(lambda i: site[i])
    k = strength([(s, n, overall) for s, n in hosts.values()])
    host_rate = {h: (s + k * overall) / (n + k) for h, (s, n) in hosts.items()}
    k = strength([(s, n, host_rate[h]) for (h, _), (s, n) in paths.items()])
    path_rate = {(h, q): (s + k * host_rate[h]) / (n + k) for (h, q), (s, n) in paths.items()}
    odds = lambda v: math.log(v / (1 - v))
    assert len(got) == len(rows)
    for r in got:
        i = r["doc_id"]
        assert abs(r["host_rate"] - host_rate[site[i][0]]) < 1e-9 and abs(r["path_rate"] - path_rate[site[i]]) < 1e-9
        fault = 1 / (1 + math.exp(-(odds(p[i]) + odds(path_rate[site[i]]) - odds(overall))))
        assert abs(r["p_fault"] - fault) < 1e-9 and r["rejected"] == (r["p_fault"] >= 0.5)
