"""Shared by the query modules. Input columns are derived by SQL text that means
the same to Spark and to the checking engine."""

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from scanweave.functions.suffix import SuffixRules


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@lru_cache(maxsize=2)
def rules(spark: SparkSession) -> SuffixRules:
    return SuffixRules(spark)


HOST = "regexp_extract(url, '^https?://([^/:?#]+)', 1)"
