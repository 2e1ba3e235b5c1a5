"""Reference dimensions: stored seeds and the built-in lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from comarca.functions import fixed_values as fv

PROVINCE_SCHEMA = ("autonomous_community_code int, autonomous_community_name string, "
                   "province_code int, province_name string")
MUNICIPALITY_SCHEMA = ("autonomous_community_code int, province_code int, municipality_code bigint, "
                       "check_digit int, municipality_name string")


def official_provinces(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fv.PROVINCES, PROVINCE_SCHEMA)


def official_aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fv.PROVINCE_ALIASES, "alias string, name string")


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A seed CSV with header."""
    return spark.read.schema(schema).option("header", True).csv(path)
