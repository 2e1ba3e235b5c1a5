"""Monthly unemployment to one row per place and year."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from comarca.functions import classes
from comarca.functions.measures import change_pct, first_available
from comarca.operators.timeseries import with_previous_year, yearly_profile

PLACE = ["province_code", "municipality_code"]

AVERAGES = {
    "total_men_unemployment": "avg_men_unemployment",
    "total_women_unemployment": "avg_women_unemployment",
    "_under_25": "avg_under_25_unemployment",
    "_25_44": "avg_25_44_unemployment",
    "_45_plus": "avg_45_plus_unemployment",
    "agriculture_sector": "avg_agriculture_unemployment",
    "industry_sector": "avg_industry_unemployment",
    "construction_sector": "avg_construction_unemployment",
    "services_sector": "avg_services_unemployment",
    "no_previous_employment": "avg_no_previous_employment",
}


def yearly_unemployment(staged: DataFrame, keys: list[str] = PLACE, min_months: int = 3,
                        split_names: bool = False) -> DataFrame:
    """Yearly level, trend, season and spread of unemployment.

    A place is its keys; of several names in a year the last in the alphabet is
    shown.  ``split_names`` makes the name part of the key instead.
    """
    group = [*keys, "municipality_name"] if split_names else keys
    monthly = (staged.where(F.col("municipality_code").isNotNull()
                            & (F.col("total_unemployment") >= 0))
               .withColumns({
                   # a missing part makes the sum of an age band unknown
                   "_under_25": F.col("men_under_25") + F.col("women_under_25"),
                   "_25_44": F.col("men_25_44") + F.col("women_25_44"),
                   "_45_plus": F.col("men_45_plus") + F.col("women_45_plus")}))
    yearly = yearly_profile(monthly, [*group, "data_year"], "total_unemployment",
                            averages=AVERAGES, label=None if split_names else "municipality_name")
    yearly = yearly.withColumn(
        "primary_total_unemployment",
        first_available(F.col("dec_value").cast("bigint"), F.col("q4_value"), F.col("avg_value")))
    now, before = F.col("primary_total_unemployment"), F.col("prev_year_unemployment")
    trend = (with_previous_year(yearly, group, "data_year",
                                {"primary_total_unemployment": "prev_year_unemployment"})
             .where(F.col("months_with_data") >= min_months)
             .withColumn("unemployment_change", now - before)
             .withColumn("unemployment_change_pct", change_pct(now, before)))
    return trend.select(
        "municipality_code", "municipality_name", "province_code", "data_year",
        "months_with_data", F.col("months_with_value").alias("months_with_unemployment"),
        classes.coverage(F.col("months_with_data")).alias("data_coverage_quality"),
        "primary_total_unemployment",
        F.col("avg_value").alias("avg_total_unemployment"),
        F.col("dec_value").alias("dec_total_unemployment"),
        F.col("q4_value").alias("q4_avg_unemployment"),
        F.col("max_value").alias("max_total_unemployment"),
        F.col("min_value").alias("min_total_unemployment"),
        *AVERAGES.values(),
        "prev_year_unemployment", "unemployment_change", "unemployment_change_pct",
        F.col("volatility_pct").alias("unemployment_volatility_pct"),
        F.col("winter_avg").alias("winter_avg_unemployment"),
        F.col("summer_avg").alias("summer_avg_unemployment"),
        "seasonal_variation_pct",
        classes.unemployment_trend(F.col("unemployment_change_pct")).alias("unemployment_trend"),
        # range above 30 % of the mean, in whole numbers
        F.coalesce((F.col("max_value") - F.col("min_value")) * 10 > F.col("avg_value") * 3,
                   F.lit(False)).alias("high_volatility_flag"),
        F.coalesce(F.col("volatility_pct") > 15, F.lit(False)).alias("unstable_employment_flag"))
