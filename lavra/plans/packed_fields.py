"""Problem 2: the values packed in records.access_url."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.operators.packed import split_packed
from lavra.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each value of an access_url that holds two or more."""
    return split_packed(table(spark, sf_dir, "records"), "row_no", "access_url", least=2).select("row_no", "pos", F.col("value").alias("url"))


def p2_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value with its position and error flag."""
    return split_packed(table(spark, sf_dir, "records"), "row_no", "access_url")


def queries() -> dict:
    return {"p2_found": p2_found, "p2_values": p2_values}


def oracle_sql() -> dict[str, str]:
    return {}
