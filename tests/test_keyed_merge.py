from __future__ import annotations

import os

from pyspark.sql import functions as F

from lendmill.sources import writers
from lendmill.streaming import scorer

SCHEMA = "sk_id_curr long, model_version string, pd double, tier string"


def table(spark, path):
    return {(r["sk_id_curr"], r["model_version"]): (r["pd"], r["tier"]) for r in writers.read_keyed(spark, path).collect()}, writers.read_keyed(spark, path).count()


def test_a_batch_twice_leaves_one_row_per_key(spark, tmp_path):
    path = str(tmp_path / "predictions")
    rows = [(k, v, k / 100, "Low") for k in range(200) for v in ("a", "b")] + [(None, "a", 0.5, None), (7, None, 0.1, "High")]
    batch = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for _ in range(2):
        writers.merge_by_key(batch, path)
        got, n = table(spark, path)
        assert n == len(rows) and got == {(r[0], r[1]): (r[2], r[3]) for r in rows}


def test_changed_and_new_keys(spark, tmp_path):
    path = str(tmp_path / "predictions")
    writers.merge_by_key(spark.createDataFrame([(k, "a", 0.1, "Low") for k in range(50)], SCHEMA), path)
    change = [(3, "a", 0.9, "High"), (3, "a", 0.7, "Low"), (60, "a", 0.2, "Low"), (3, "b", 0.3, "Low")]
    writers.merge_by_key(spark.createDataFrame(change, SCHEMA), path)
    got, n = table(spark, path)
    assert n == 52 and got[3, "a"] == (0.9, "High") and got[3, "b"] == (0.3, "Low") and got[60, "a"] == (0.2, "Low") and got[4, "a"] == (0.1, "Low")
    writers.merge_by_key(spark.createDataFrame([], SCHEMA), path)
    assert table(spark, path) == (got, n)


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "predictions")
    writers.merge_by_key(spark.createDataFrame([(k, "a", 0.1, "Low") for k in range(300)], SCHEMA), path)
    files = lambda: {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    before = files()
    writers.merge_by_key(spark.createDataFrame([(5, "a", 0.2, "Low")], SCHEMA), path)
    assert len(before) == len(files()) and len(before - files()) == 1


def test_a_replayed_stream_changes_nothing(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "predictions")
    rows = spark.createDataFrame([(k % 40, "a", k / 100, "Low") for k in range(80)], SCHEMA).repartition(3)
    rows.write.parquet(source)
    for run in range(2):  # a new checkpoint replays every batch
        stream = scorer.read_applications(spark, source, rows.schema, files_per_trigger=1).withColumn("tier", F.upper("tier"))
        scorer.start_merging(stream, path, str(tmp_path / f"marks{run}")).awaitTermination()
        got, n = table(spark, path)
        assert n == 40 and set(got) == {(k, "a") for k in range(40)}
        assert all(t == "LOW" for _, t in got.values())
