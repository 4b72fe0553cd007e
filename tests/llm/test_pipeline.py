from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline
from lendmill.llm import site_quality
from lendmill.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL
from tests.llm.cases import alnum_words, awkward_rows, empty, frame, sentence
from tests.llm.test_duplicates import groups, plain_links


# the smallest data have too few labels for the classifier to reject anything
LARGER = "/root/testdata/sf0.01"


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, LARGER)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
            docs.write.parquet(str(tmp_path / str(k)))
            docs = spark.read.parquet(str(tmp_path / str(k)))
            after = docs.count()
            assert after == before if name == "secret scans" else after < before, name
            before = after
    assert docs.select("doc_id").distinct().count() == before


def test_stages_take_awkward_and_empty_tables(spark):
    rows = awkward_rows()
    links = plain_links(rows)
    worded = [i for i, r in enumerate(rows) if alnum_words(r[1])]
    groups_left = len(set(groups(worded, [(i, j) for i, js in links.items() for j in js]).values()))
    wordless = len({r[:2] for i, r in enumerate(rows) if i not in worded})
    # too few labels here to reject anything, no benchmark passage, secrets stay as rows
    left = {"quality classifier": len(rows), "n-gram jaccard join": groups_left + wordless, "benchmark decontamination": len(rows), "secret scans": len(rows)}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame(spark, rows), SMALL)
        if name in left:
            assert out.count() == left[name], name
        else:
            assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == {r[0] for r in rows}
        assert stage(spark, empty(spark), SMALL).count() == 0, name


def test_one_query_per_operator():
    assert [int(n.split("_")[0][2:]) for n in QUERIES] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_decisions_hold_for_rows_not_for_ids(spark):
    rnd = random.Random(3)
    texts = [sentence(rnd, 60) for _ in range(4)]
    near = " ".join([*texts[0].split()[:-1], "changed"])
    rows = [(None, t, "en", "s0") for t in (texts[0], near, texts[1])] + [(7, texts[2], "en", "s0"), (7, texts[3], "en", "s0"), (8, texts[3], "en", "s0"), (7, texts[2], "en", "s0")]
    left = corpus_pipeline.keep_one_of_similar(spark, frame(spark, rows), SMALL).collect()
    assert sorted(str(r["doc_id"]) for r in left) == ["7", "7", "None", "None"]
    assert len({r["text"] for r in left}) == 4 and {texts[1], texts[2], texts[3]} <= {r["text"] for r in left}

    item = next(r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("text").collect() if len(r["text"].split()) > 10)
    rows = [(i, t, "en", "s0") for i in (None, 5) for t in (f"{texts[0]} {item}", texts[1], texts[2])]
    left = corpus_pipeline.keep_uncontaminated(spark, frame(spark, rows), SMALL).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in left) == sorted((str(i), t) for i in (None, 5) for t in texts[1:3])


def test_rejections_hold_for_rows_not_for_ids(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    judged = site_quality.classify(docs, spark.read.parquet(f"{LARGER}/labels.parquet")).select("doc_id", "rejected")
    # the same rows and labels under few ids: every id then holds rejected rows and clean ones
    lost = docs.join(judged, "doc_id").filter("rejected").limit(3).drop("rejected")
    kept = docs.join(judged, "doc_id").filter("NOT rejected").limit(20).drop("rejected")
    mixed = docs.union(lost.unionByName(kept).withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType)).select(docs.columns))
    left = corpus_pipeline.keep_good(spark, mixed, LARGER).filter("doc_id IS NULL").count()
    assert 0 < left < 23
