"""Writing results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.session import materialize, release

PREDICTION_KEYS = ("sk_id_curr", "model_version")
# Key ranges of a keyed table; a merge rewrites only those that its batch touches.
BUCKETS = 64


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """One header per part file; the number of files follows the data."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_submission(scored: DataFrame, path: str) -> None:
    """(client, score) pairs of the scored test set."""
    write_csv(scored.select("sk_id_curr", F.col("pred_prob").alias("target")), path)


def append_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Append to a warehouse table, created on first use (external when a path is given)."""
    writer = df.write.mode("append").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def merge_by_key(batch: DataFrame, path: str, keys: Sequence[str] = PREDICTION_KEYS, within: str | None = "model_version", buckets: int = BUCKETS) -> None:
    """Put a batch into a table with one row per key: rows of known keys are replaced, others added.

    The table is partitioned by `within` (if given) and a hash bucket of the keys. Only partitions
    that the batch touches are read, merged and overwritten, each as a whole, so a batch that is
    written again, or was cut off half way, leaves the same table. Of several rows with one key in
    the batch the greatest is taken; a null is a key value like any other. The layout (`within`,
    `buckets`) must stay the same for a table, and one merge runs at a time.
    """
    rest = [c for c in batch.columns if c not in keys]
    parts = [*([within] if within else []), "key_bucket"]
    one = batch.groupBy(*keys).agg(F.max(F.struct(*rest) if rest else F.lit(0)).alias("__row")).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])
    new = materialize(one.withColumn("key_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")), "batch")
    old = _existing(new, path)
    if old is not None:
        touched = F.broadcast(new.select(*parts).distinct())  # at most one row per partition of the table
        old = old.join(touched, [old[c].eqNullSafe(touched[c]) for c in parts], "left_semi")
        kept = old.join(new.select(*keys), [old[c].eqNullSafe(new[c]) for c in keys], "left_anti")
        merged = materialize(new.unionByName(kept.select(*new.columns)), "merged")
    else:
        merged = new
    merged.repartition(*parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    for written in {merged, new}:
        release(written)


def _existing(like: DataFrame, path: str) -> DataFrame | None:
    try:
        return like.sparkSession.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def read_keyed(spark, path: str) -> DataFrame:
    """A table kept by `merge_by_key`, without the bucket column."""
    return spark.read.parquet(path).drop("key_bucket")


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append over JDBC; the driver jar and the database are the caller's."""
    df.write.mode("append").jdbc(url, table, properties=properties)
