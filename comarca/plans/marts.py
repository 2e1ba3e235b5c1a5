"""Marts: population trends, unemployment rates, socio-economic trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from comarca.functions import classes
from comarca.functions.measures import (change_pct, first_available, half_up, null_as_zero_sum,
                                        pct, per_thousand)
from comarca.operators.ranking import row_number_by
from comarca.operators.timeseries import with_previous_year

PLACE = ["province_code", "municipality_code"]
PLACE_YEAR = [*PLACE, "data_year"]


def population_changes(population: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Total population per place and year with the change from the year before.

    The grain is a place, its name and the year: copies of a row are one fact and
    are combined before anything is shuffled by place.
    """
    community = (dictionary.groupBy(*PLACE)
                 .agg(F.min("autonomous_community_code").alias("autonomous_community_code")))
    total = first_available(F.col("population_total"),
                            null_as_zero_sum(F.col("population_male"), F.col("population_female")))
    base = (population.where(F.col("municipality_code") != 0)
            .groupBy(*PLACE_YEAR, "municipality_name").agg(F.max(total).alias("total_population")))
    now, before = F.col("total_population"), F.col("previous_year_population")
    trend = with_previous_year(base, PLACE, "data_year",
                               {"total_population": "previous_year_population"})
    trend = trend.withColumns({"population_change": now - before,
                               "population_change_pct": change_pct(now, before)})
    # the window left the rows partitioned by place: only the dictionary moves
    return trend.join(community, PLACE, "left")


def population_ranks(df: DataFrame, largest_year: int | None = None) -> DataFrame:
    """Rank by population within the year and within the province and year.

    Equal populations are ordered by place and name (a place has a row per name and year).  ``largest_year`` bounds the number of
    places of a year; beyond one task's share the rank comes from a range sort.
    """
    by_size = [F.col("total_population").desc_nulls_first()]
    national = row_number_by(df, ["data_year"],
                             by_size + [F.col(c) for c in [*PLACE, "municipality_name"]],
                             "population_rank_national", largest_year)
    return row_number_by(national, ["data_year", "province_code"],
                         by_size + [F.col("municipality_code"), F.col("municipality_name")],
                         "population_rank_provincial", largest_year)


def population_trends(population: DataFrame, dictionary: DataFrame,
                      largest_year: int | None = None) -> DataFrame:
    ranked = population_ranks(population_changes(population, dictionary), largest_year)
    return ranked.select(
        "municipality_code", "municipality_name", "province_code", "autonomous_community_code",
        "data_year", "total_population", "previous_year_population", "population_change",
        "population_change_pct", "population_rank_national", "population_rank_provincial",
        classes.population_trend(F.col("population_change")).alias("population_trend"),
        classes.population_magnitude(F.col("population_change_pct")).alias("population_trend_category"))


def align(population: DataFrame, employment: DataFrame, years: tuple[int, int],
          min_unemployment: int) -> DataFrame:
    """Both series at the grain (place, year); years are cut on both sides first."""
    inside = F.col("data_year").between(*years)
    people = population.where(inside & (F.col("total_population") > 0))
    work = (employment.where(inside & (F.col("primary_total_unemployment") >= min_unemployment))
            .drop("municipality_name"))
    return people.join(work, PLACE_YEAR)


def _with_rate(df: DataFrame) -> DataFrame:
    rate = pct(F.col("primary_total_unemployment"), F.col("total_population"))
    change = F.round(F.col("unemployment_rate") - F.col("prev_year_unemployment_rate"), 2)
    return (with_previous_year(df.withColumn("unemployment_rate", rate), PLACE, "data_year",
                               {"unemployment_rate": "prev_year_unemployment_rate"})
            .withColumn("unemployment_rate_change",
                        F.when(F.col("prev_year_unemployment_rate") > 0, change)))


def unemployment_rates(population: DataFrame, employment: DataFrame,
                       years: tuple[int, int] = (2020, 2024), since: int | None = None,
                       strict_health: bool = False) -> DataFrame:
    """Rates mart.  ``since`` limits the output to later years for an incremental
    run; the year before is still read, so the first output year keeps its change."""
    first = years[0] if since is None else max(years[0], since - 1)
    rows = _with_rate(align(population, employment, (first, years[1]), 0))
    if since is not None:
        rows = rows.where(F.col("data_year") >= since)
    pop, unemp, rate = (F.col("population_change_pct"), F.col("unemployment_change_pct"),
                        F.col("unemployment_rate"))
    return rows.select(
        "municipality_code", "municipality_name", "province_code", "autonomous_community_code",
        "data_year", "total_population", "primary_total_unemployment", "unemployment_rate",
        "population_change_pct", "unemployment_change_pct",
        "prev_year_unemployment_rate", "unemployment_rate_change",
        classes.unemployment_level(rate, "no_data").alias("unemployment_category"),
        classes.health(rate, pop, strict_health).alias("socioeconomic_health"),
        classes.sign_quadrant(pop, unemp, null_as="stable").alias("socioeconomic_pattern"),
        "population_trend", "unemployment_trend", "data_coverage_quality")


def socioeconomic_trends(population: DataFrame, employment: DataFrame,
                         years: tuple[int, int] = (2005, 2024),
                         strict_health: bool = False) -> DataFrame:
    rows = _with_rate(align(population, employment, years, 1))
    people, jobless = F.col("total_population"), F.col("primary_total_unemployment")
    men, women = F.col("avg_men_unemployment"), F.col("avg_women_unemployment")
    youth, rate = F.col("avg_under_25_unemployment"), F.col("unemployment_rate")
    pop, unemp = F.col("population_change_pct"), F.col("unemployment_change_pct")
    return rows.select(
        "municipality_code", "municipality_name", "province_code", "autonomous_community_code",
        "data_year", F.lit(True).alias("has_demographic_data"),
        F.lit(True).alias("has_employment_data"), "data_coverage_quality",
        "total_population", "population_change", "population_change_pct", "population_trend",
        "population_rank_national", "primary_total_unemployment", "unemployment_change",
        "unemployment_change_pct", "unemployment_trend", "unemployment_rate",
        "prev_year_unemployment_rate", "unemployment_rate_change",
        per_thousand(jobless, people).alias("unemployment_per_1000_inhabitants"),
        "avg_men_unemployment", "avg_women_unemployment",
        F.when(men > 0, half_up(men, women)).alias("men_women_unemployment_ratio"),
        "avg_under_25_unemployment",
        F.when(youth > 0, pct(youth, jobless, 1)).alias("youth_unemployment_share"),
        "unemployment_volatility_pct",
        classes.resilience(unemp, pop).alias("economic_resilience_category"),
        classes.sign_quadrant(pop, unemp).alias("socioeconomic_trend_pattern"),
        classes.unemployment_level(rate, "no_employment_data").alias("unemployment_category"),
        F.when(rate.isNotNull(), classes.health(rate, pop, strict_health))
         .alias("socioeconomic_health_status"))
