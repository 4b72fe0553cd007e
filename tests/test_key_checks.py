from __future__ import annotations

from pyspark.sql import functions as F

from lendmill.operators import checks


def keys_of_tasks(df, key):
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count_distinct(key).alias("n")).collect()]


def test_a_task_counts_the_keys_of_its_share(spark, monkeypatch):
    monkeypatch.setattr(checks, "ROWS_PER_TASK", 100)
    rows = spark.range(4000).select(F.col("id").alias("k")).union(spark.range(4000).select(F.col("id").alias("k")))
    for known in (None, 8000):
        found = checks.repeated_keys(rows, ["k"], known)
        assert found.count() == 4000 and found.filter("n_rows <> 2").isEmpty()
        assert max(keys_of_tasks(found, "k")) < 150


def test_orphans_with_null_and_repeated_keys(spark):
    table = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k long")
    children = {"a": table(1, 1, 7, 7, None, None), "b": table(2, 9), "c": table(1, 2), "d": table()}
    got = {r["child"]: (r["orphan_keys"], r["orphan_rows"]) for r in checks.orphan_keys(children, table(1, 2, 2, None), "k").collect()}
    assert got == {"a": (2, 4), "b": (1, 1), "c": (0, 0), "d": (0, 0)}
