"""Dashboard aggregates.  They run on the whole filtered mart; only the aggregate
leaves the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from comarca.functions.measures import pct
from comarca.session import freeze

PLACE = ["province_code", "municipality_code"]


def recent_top(mart: DataFrame, n: int = 1000) -> DataFrame:
    """Latest year first, largest place first, first ``n`` rows."""
    return (mart.where(F.col("municipality_code").isNotNull())
            .orderBy(F.col("data_year").desc_nulls_first(),
                     F.col("total_population").desc_nulls_first(), *PLACE).limit(n))


def filter_values(mart: DataFrame, provinces: DataFrame) -> DataFrame:
    """Sorted values of the year and province pick lists."""
    years = mart.select(F.lit("year").alias("filter"), F.col("data_year").cast("string").alias("value"))
    names = provinces.where(F.col("province_name").isNotNull()).select(
        F.lit("province").alias("filter"), F.col("province_name").alias("value"))
    return years.distinct().unionByName(names.distinct()).orderBy("filter", "value")


def filtered(mart: DataFrame, years: list[int] | None = None,
             provinces: DataFrame | None = None, names: list[str] | None = None) -> DataFrame:
    """Chosen years (latest year when none is given) and chosen provinces."""
    if years is None:
        mart = mart.where(F.col("data_year") == mart.select(F.max("data_year")).scalar())
    elif years:
        mart = mart.where(F.col("data_year").isin(years))
    if names:
        chosen = provinces.where(F.col("province_name").isin(names)).select("province_code").distinct()
        mart = mart.join(chosen, "province_code", "left_semi")
    return mart


def kpis(df: DataFrame) -> DataFrame:
    """Total population, number of places, mean population."""
    return df.agg(F.sum("total_population").alias("total_population"),
                  F.countDistinct(*PLACE).alias("total_municipalities"),
                  F.round(F.avg("total_population"), 0).alias("avg_population"))


def population_by_year(df: DataFrame) -> DataFrame:
    return df.groupBy("data_year").agg(F.sum("total_population").alias("total_population"))


def growth(df: DataFrame) -> DataFrame:
    """Change in percent from the last year but one present to the last."""
    yearly = population_by_year(df)  # one row per year
    last_two = yearly.orderBy(F.col("data_year").desc()).limit(2).agg(
        F.max("data_year").alias("data_year"),
        F.max_by("total_population", "data_year").alias("now"),
        F.min_by("total_population", "data_year").alias("before"),
        F.count(F.lit(1)).alias("n"))
    change = pct(F.col("now") - F.col("before"), F.col("before"), 1)
    return last_two.select("data_year", F.when(F.col("n") == 2, change).alias("growth_pct"))


def gender_split(df: DataFrame) -> DataFrame:
    sums = df.agg(F.sum("population_male").alias("m"), F.sum("population_female").alias("f"))
    return sums.select(F.inline(F.array(
        F.struct(F.lit("Male").alias("gender"), F.col("m").alias("population")),
        F.struct(F.lit("Female").alias("gender"), F.col("f").alias("population")))))


def _names_of(rows: DataFrame, table: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Left join of a few rows with their names.  The rows go to the table, not the
    table to the rows: ``rows`` was cut to its first n, so both broadcasts are tiny."""
    wanted = F.broadcast(rows.select(*keys).distinct())
    names = table.join(wanted, keys, "left_semi").groupBy(*keys).agg(F.min(name).alias(name))
    return rows.join(F.broadcast(names), keys, "left")


def top_places(df: DataFrame, dictionary: DataFrame, n: int = 10) -> DataFrame:
    """Largest rows with their dictionary names; the cut is made before the join."""
    top = freeze(df.select(*PLACE, "data_year", "total_population")
                 .orderBy(F.col("total_population").desc(), *PLACE, "data_year").limit(n))
    return _names_of(top, dictionary, PLACE, "municipality_name")


def detail(df: DataFrame, dictionary: DataFrame, provinces: DataFrame, n: int = 100) -> DataFrame:
    """First rows of the filtered data with place and province names."""
    head = freeze(df.orderBy(F.col("data_year").desc(), *PLACE).limit(n).drop("municipality_name"))
    named = _names_of(head, dictionary, PLACE, "municipality_name")
    return _names_of(named, provinces, ["province_code"], "province_name")
