"""Staged tables: typed, filtered, with completed codes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from comarca.functions import fixed_values as fv
from comarca.functions.measures import non_negative, null_as_zero_sum, pct
from comarca.functions.text import clean_key, local_code, text_code
from comarca.operators.lookup import complete_codes, resolve_names
from comarca.sources.lineage import carried


@dataclass(frozen=True)
class Bounds:
    """Accepted years and codes; ``code_base`` separates local from national codes."""

    employment_years: tuple[int, int] = (2005, 2025)
    population_years: tuple[int, int] = (1996, 2024)
    communities: tuple[int, int] = (1, 19)
    provinces: tuple[int, int] = (1, 52)
    code_base: int = 1000


DEFAULT = Bounds()


def filled(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def stage_municipalities(dictionary: DataFrame, b: Bounds = DEFAULT) -> DataFrame:
    return (dictionary
            .where(filled("municipality_name")
                   & F.col("autonomous_community_code").between(*b.communities)
                   & F.col("province_code").between(*b.provinces))
            .select("autonomous_community_code", "province_code", "municipality_code",
                    "check_digit", "municipality_name"))


def stage_provinces(provinces: DataFrame, b: Bounds = DEFAULT) -> DataFrame:
    return (provinces
            .where(filled("autonomous_community_name") & filled("province_name")
                   & F.col("autonomous_community_code").between(*b.communities)
                   & F.col("province_code").between(*b.provinces))
            .select("autonomous_community_code", "autonomous_community_name",
                    "province_code", "province_name"))


def stage_population(raw: DataFrame, b: Bounds = DEFAULT) -> DataFrame:
    return (raw
            .where(filled("municipality_name") & F.col("data_year").between(*b.population_years)
                   & F.col("population_total").isNotNull())
            .select(text_code(F.col("province_code")).cast("int").alias("province_code"),
                    "province_name",
                    text_code(F.col("cmun")).alias("municipality_code"),
                    "municipality_name",
                    *[non_negative(F.col(c), "bigint").alias(c) for c in fv.POPULATION_MEASURES],
                    "data_year", "source_file", *carried(raw)))


def valid_employment(raw: DataFrame, total: str, b: Bounds = DEFAULT) -> DataFrame:
    return raw.where(filled("municipality_name") & F.col("year").between(*b.employment_years)
                     & F.col("month").between(1, 12) & (F.col(total) >= 0))


def _whole(total: Column) -> Column:
    return F.rint(total).cast("int")


def _stage(raw: DataFrame, measures: list[str], sums: dict[str, list[str]],
           provinces: DataFrame, aliases: DataFrame, dictionary: DataFrame,
           b: Bounds) -> DataFrame:
    resolved = resolve_names(raw, provinces, aliases, dictionary)
    rows = complete_codes(valid_employment(raw, measures[0], b), resolved)
    return rows.select(
        local_code(F.col("municipality_code"), b.code_base).alias("municipality_code"),
        "municipality_name", "municipality_code_source", "municipality_code_completed",
        "match_method", "confidence_score", "fuzzy_matched_name",
        "province_code", clean_key(F.col("province")).alias("province_name"),
        F.col("year").alias("data_year"), F.col("month").alias("data_month"),
        F.make_date("year", "month", F.lit(1)).alias("reporting_date"),
        *[non_negative(F.col(c)).alias(c) for c in measures],
        # totals read the raw parts, so a negative part still counts here
        *[_whole(null_as_zero_sum(*[F.col(c) for c in parts])).alias(name)
          for name, parts in sums.items()],
        "source_file", *carried(raw))


def _zero(*columns: str) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


UNEMPLOYMENT_SUMS = {
    "total_men_unemployment": ["men_under_25", "men_25_44", "men_45_plus"],
    "total_women_unemployment": ["women_under_25", "women_25_44", "women_45_plus"],
}
CONTRACT_SUMS = {
    "total_men_contracts": ["men_indefinite_initial", "men_temporary_initial",
                            "men_indefinite_conversion"],
    "total_women_contracts": ["women_indefinite_initial", "women_temporary_initial",
                              "women_indefinite_conversion"],
    "total_indefinite_initial": ["men_indefinite_initial", "women_indefinite_initial"],
    "total_temporary_initial": ["men_temporary_initial", "women_temporary_initial"],
    "total_indefinite_conversion": ["men_indefinite_conversion", "women_indefinite_conversion"],
}


def unemployment_shares(df: DataFrame) -> DataFrame:
    total = F.col("total_unemployment")
    return df.withColumns({
        "men_unemployment_percentage": pct(F.col("total_men_unemployment"), total),
        "women_unemployment_percentage": pct(F.col("total_women_unemployment"), total),
        "under_25_unemployment_percentage": pct(_zero("men_under_25", "women_under_25"), total),
        "age_25_44_unemployment_percentage": pct(_zero("men_25_44", "women_25_44"), total),
        "over_45_unemployment_percentage": pct(_zero("men_45_plus", "women_45_plus"), total),
    })


def contract_shares(df: DataFrame) -> DataFrame:
    total = F.col("total_contracts")
    permanent = F.col("total_indefinite_initial") + F.col("total_indefinite_conversion")
    return df.withColumns({
        "men_contracts_percentage": pct(F.col("total_men_contracts"), total),
        "women_contracts_percentage": pct(F.col("total_women_contracts"), total),
        "indefinite_initial_percentage": pct(F.col("total_indefinite_initial"), total),
        "temporary_initial_percentage": pct(F.col("total_temporary_initial"), total),
        "indefinite_conversion_percentage": pct(F.col("total_indefinite_conversion"), total),
        "permanent_contracts_percentage": pct(permanent, total),
    })


def stage_unemployment(raw: DataFrame, provinces: DataFrame, aliases: DataFrame,
                       dictionary: DataFrame, b: Bounds = DEFAULT) -> DataFrame:
    return unemployment_shares(_stage(raw, fv.UNEMPLOYMENT_MEASURES, UNEMPLOYMENT_SUMS,
                                      provinces, aliases, dictionary, b))


def stage_contracts(raw: DataFrame, provinces: DataFrame, aliases: DataFrame,
                    dictionary: DataFrame, b: Bounds = DEFAULT) -> DataFrame:
    return contract_shares(_stage(raw, fv.CONTRACT_MEASURES, CONTRACT_SUMS,
                                  provinces, aliases, dictionary, b))
