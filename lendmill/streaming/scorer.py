"""Scoring a stream of applications and watching the high-risk rate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lendmill.functions.nullsafe import clip, flag
from lendmill.operators.scoring import reject_reasons, score_columns
from lendmill.params import FALLBACK_TIER_EDGES, HIGH_RISK_PD
from lendmill.sources.writers import PREDICTION_KEYS, merge_by_key


def read_applications(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1_000) -> DataFrame:
    """A folder of parquet files as a stream; the batch size is bounded by the file count."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def score_rows(df: DataFrame, edges: Sequence[float] = FALLBACK_TIER_EDGES) -> DataFrame:
    """The scoring columns of applications that carry a PD; works on batches and streams alike."""
    checked = df.withColumns({"reasons": reject_reasons(df), "pd_calibrated": clip("pred_prob", 0.001, 0.999)})
    answers = score_columns(F.col("pd_calibrated"), F.col("amt_credit"), edges, F.size("reasons") == 0, F.col("reasons"))
    return checked.withColumns(answers)


def start_scoring(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once parquet sink; processes what is there and stops."""
    writer = scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()


def start_merging(scored: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = PREDICTION_KEYS, within: str | None = "model_version") -> StreamingQuery:
    """Keep one row per key in a table; a batch that is replayed after a failure changes nothing."""

    def put(batch: DataFrame, _: int) -> None:
        merge_by_key(batch, path, keys, within)

    return scored.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def high_risk_windows(df: DataFrame, time: str = "application_date", width: str = "30 days", lateness: str | None = None) -> DataFrame:
    """High-risk rate per time window.

    With `lateness`, rows further behind the newest one are dropped by the watermark (and counted
    in the query progress) so that closed windows can leave the state; without it every row
    counts and the state holds one row per window.
    """
    risky = flag(F.col("pred_prob") > HIGH_RISK_PD)
    rows = df.withWatermark(time, lateness) if lateness else df
    return (
        rows.groupBy(F.window(time, width).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(risky).alias("n_high_risk"))
        .select(
            F.col("w.start").alias("window_start"), "n_rows", "n_high_risk",
            (F.col("n_high_risk") / F.col("n_rows")).alias("high_risk_rate"),
        )
    )


def start_windows(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed windows to parquet; needs a watermark."""
    writer = windows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()
