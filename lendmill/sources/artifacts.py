"""Fitted state as small flat JSON tables: WoE maps, feature statistics, tier configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.params import TierConfig

WOE_SCHEMA = "feature string, kind string, bin_id int, lo double, hi double, category string, woe double"
STATS_SCHEMA = "feature string, median double, mean double, std double, p01 double, p99 double"
TIER_SCHEMA = "edges array<double>, labels array<string>, threshold double, model string"


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def load_woe(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WOE_SCHEMA).json(path)


def load_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATS_SCHEMA).json(path)


def save_tiers(spark: SparkSession, config: TierConfig, path: str) -> None:
    row = (list(config.edges), list(config.labels), config.threshold, config.model)
    save_json(spark.createDataFrame([row], TIER_SCHEMA), path)


def load_tiers(spark: SparkSession, path: str) -> TierConfig:
    row = spark.read.schema(TIER_SCHEMA).json(path).first()
    return TierConfig(tuple(row["edges"]), tuple(row["labels"]), row["threshold"], row["model"])


def woe_as_map(woe: DataFrame) -> DataFrame:
    """feature -> {bin: woe}, the nested view of the flat table."""
    label = F.coalesce("category", F.col("bin_id").cast("string"))
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct(label.alias("bin"), "woe"))))
    return woe.groupBy("feature").agg(entries.alias("bins"))  # bins per feature are bounded by the fit
