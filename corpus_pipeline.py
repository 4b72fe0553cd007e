"""A corpus pipeline of five stages, each one operator over all documents that the stage before kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of `documents`; the
last returns the packed pieces. A decision holds for the rows it was made on, named by a hash of what
decides (id, text, site), so that rows that share an id, null too, are judged each by their own; an
empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.llm import chosen_path, packing, positional_index, runtime, secret_automaton, site_quality
from lendmill.session import materialize

# The column that names rows inside a stage.
ROW = "_row"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (low quality or toxic) go."""
    parts = [F.col(c) for c in ("doc_id", "text", "source", "lang")]
    # the hash leaves nulls out, so which of them are null is hashed too
    keyed = docs.withColumn(ROW, runtime.row_key(*parts, *(c.isNull() for c in parts)))
    judged = site_quality.classify(keyed, _table(spark, sf_dir, "labels"), row=ROW)
    return runtime.without(keyed, ROW, judged.filter("rejected").select(ROW)).drop(ROW)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, and one of equal rows."""
    keyed = docs.withColumn(ROW, chosen_path.document_key(docs))
    first = runtime.without(keyed, ROW, chosen_path.judged(docs).filter("NOT kept").select("row"))
    return runtime.once(first, ROW, ["doc_id", "text"]).drop(ROW)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    keyed = docs.withColumn(ROW, chosen_path.document_key(docs))
    found = positional_index.decontaminate(keyed.select(F.col(ROW).alias("doc_id"), "text"), _table(spark, sf_dir, "benchmark"))
    return runtime.without(keyed, ROW, found.filter("n_hit > 0").select("doc_id")).drop(ROW)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text is replaced by its kind; all documents stay."""
    return secret_automaton.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram jaccard join", keep_one_of_similar),
    ("benchmark decontamination", keep_uncontaminated),
    ("secret scans", hide_secrets),
    ("packing", pack_sequences),
]

# The first stage is a trained classifier, the last a tokenizer's output: neither is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written and read again by the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
