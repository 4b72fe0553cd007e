"""What the operators of this package need from the session."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.session import materialize

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Slots of the presence filter: a bit each reaches the driver and is broadcast.
SLOTS = 1 << 20
# Rows of a few numbers that may be broadcast: some 20 MB.
LIGHT = 1 << 18


# Large arrays are mapped and given back when freed, so that a worker which is used again for the
# next stage does not keep the heap of the last one.
WORKER_MEMORY = {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed (same path on each node) and give memory back."""
    environment = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)
    known = environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, known) if p)


def slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")


def row_key(*columns: Column) -> Column:
    """A hash of the columns that make a document what it is: an id may be null or stand for several texts."""
    return F.xxhash64(*columns)


def _words(wanted: DataFrame, key: str) -> DataFrame:
    """The slots of the wanted keys as bits: at most SLOTS / 64 rows of two numbers."""
    slots = wanted.select(slot(F.col(key)).alias("_slot"))
    return F.broadcast(slots.groupBy(F.shiftright("_slot", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, _slot & 63)")).alias("_bits")))


def _marked(key: Column, words: DataFrame) -> Column:
    bit = F.call_function("shiftrightunsigned", words["_bits"], slot(key).bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1))
    return (F.shiftright(slot(key), 6) == words["_word"]) & (bit == 1)


def only_slots_of(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """Rows of `df` whose key may be among the wanted keys, found without shuffling `df`.

    The wanted keys' slots (a bit each, whatever the table's size) are broadcast.
    Rows of other keys that share a slot stay; a join on the key must follow.
    """
    words = _words(wanted, wanted_key)
    return df.join(words, _marked(df[key], words), "left_semi")


def split_by_slots(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among the wanted keys, all other rows); null keys count as a key."""
    words = _words(wanted, wanted_key)
    met = _marked(df[key], words)
    return df.join(words, met, "left_semi"), df.join(words, met, "left_anti")


def for_join(df: DataFrame, rows: int) -> DataFrame:
    """`df`, a side of a join of at most `rows` rows: beyond LIGHT it is not broadcast.

    Spark goes by the size of files, and rows that took 10 MB there may take ten times that on the driver.
    """
    return df.hint("merge") if rows > LIGHT else df


def without(df: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """`df` without the rows whose key is in the one-column table `dropped`; only touched rows are shuffled."""
    dropped = materialize(dropped.toDF("_dropped").distinct(), "dropped")
    touched, rest = split_by_slots(df, key, dropped, "_dropped")
    return touched.join(for_join(dropped, dropped.count()), touched[key].eqNullSafe(dropped["_dropped"]), "left_anti").unionByName(rest)


def once(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """`df` with one row for each set of rows that agree in `columns`; only repeated keys are shuffled."""
    again = materialize(df.groupBy(F.col(key).alias("_again")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_again"), "again")
    touched, rest = split_by_slots(df, key, again, "_again")
    return touched.dropDuplicates(columns).unionByName(rest)
