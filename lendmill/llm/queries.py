"""The registered queries of this package: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendmill.llm import chosen_path, difference_cover, hnsw, language, license_digest, merkle, packing, positional_index, secret_automaton, site_quality, syncmers, token_stream, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_secret_automaton")
def secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_automaton.scan_digest(table(spark, folder, "documents"))


@query("op2_order_preserving_packing")
def packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query("op3_sparse_language")
def languages(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query("op4_chosen_path_join")
def similar(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, folder, "documents"))


@query("op5_positional_index")
def contaminated(spark: SparkSession, folder: str) -> DataFrame:
    return positional_index.digest(positional_index.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark")))


@query("op6_license_digest", license_digest.check_sql())
def licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_digest.scan(table(spark, folder, "documents"))


@query("op7_site_quality")
def quality(spark: SparkSession, folder: str) -> DataFrame:
    return site_quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_navigable_graphs")
def near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.near_vectors(table(spark, folder, "embeddings"))


@query("op9_difference_cover")
def repeats(spark: SparkSession, folder: str) -> DataFrame:
    return difference_cover.remove_repeats(table(spark, folder, "documents")).drop("kept_text")


@query("op10_token_stream_files")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_stream.round_trip(spark, table(spark, folder, "documents"))


@query("op11_checkpointed_merkle", merkle.check_sql())
def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))


@query("op12_closed_syncmers")
def fingerprinted(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, folder, "documents"))


@query("op13_bit_sliced_whitening")
def whitened(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))
