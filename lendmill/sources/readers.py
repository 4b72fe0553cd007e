"""Reading source files."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.functions.nullsafe import no_nan


def read_csv(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header and declared types; only the named columns are parsed."""
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return no_nan(df.select(*columns) if columns else df)


def read_dictionary(spark: SparkSession, path: str, name_column: str = "Row", text_column: str = "Description") -> DataFrame:
    """Column dictionary in Latin-1: (name, description)."""
    df = spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return df.select(F.trim(name_column).alias("name"), F.col(text_column).alias("description"))


def describe_column(dictionary: DataFrame, name: str) -> DataFrame:
    return dictionary.filter(F.col("name") == name).select("name", "description")


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_first(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The first of several candidate parquet data sets that exists."""
    for path in paths:
        try:
            return spark.read.parquet(path)
        except (AnalysisException, Py4JJavaError) as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
    raise FileNotFoundError(f"none of {list(paths)} exists")
