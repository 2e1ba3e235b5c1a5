"""Declared checks of every model; years and code ranges follow the bounds in use."""

from __future__ import annotations

from comarca.operators.declared import Declaration
from comarca.plans.staging import DEFAULT, Bounds

KEY = ("province_code", "municipality_code", "data_year")
TRENDS = ["high_increase", "moderate_increase", "stable", "moderate_decrease", "high_decrease",
          "no_comparison_data"]
LEVELS = ["low_unemployment", "moderate_unemployment", "high_unemployment", "very_high_unemployment"]
HEALTH = ["thriving", "growing", "stable", "struggling", "critical"]


def present(*columns: str, **options) -> list[Declaration]:
    return [Declaration(f"{c}_not_null", "not_null", (c,), tags=("presence",), **options) for c in columns]


def within(column: str, low=None, high=None, **options) -> Declaration:
    bounds = tuple("" if b is None else str(b) for b in (low, high))
    return Declaration(f"{column}_range", "range", (column,), bounds, tags=("range",), **options)


def one_of(column: str, values: list) -> Declaration:
    return Declaration(f"{column}_values", "values", (column,), tuple(values), tags=("values",))


def unique_key(key: tuple[str, ...], name: str = "key_unique") -> Declaration:
    return Declaration(name, "unique", key, tags=("keys",))


def municipalities(b: Bounds = DEFAULT) -> list[Declaration]:
    return [*present("autonomous_community_code", "province_code", "municipality_code", "municipality_name"),
            within("autonomous_community_code", *b.communities), within("province_code", *b.provinces)]


def provinces(b: Bounds = DEFAULT) -> list[Declaration]:
    return [*present("autonomous_community_code", "autonomous_community_name", "province_code", "province_name"),
            within("autonomous_community_code", *b.communities), within("province_code", *b.provinces),
            unique_key(("province_code",), "province_code_unique")]


def population(b: Bounds = DEFAULT) -> list[Declaration]:
    return [*present("municipality_name", "population_total", "data_year"),
            within("province_code", *b.provinces), within("data_year", *b.population_years),
            *[within(c, 0) for c in ("population_total", "population_male", "population_female")]]


def _employment(totals: list[str], shares: list[str], b: Bounds) -> list[Declaration]:
    """Shares above 100 % and missing codes are known defects: a warning beyond 1000 rows."""
    known = {"severity": "warn", "allow": 1000}
    return [*present("municipality_code", **known), within("municipality_code", 0),
            *present("municipality_code_completed", "municipality_name", "province_name", "data_year",
                     "data_month", "reporting_date", *totals),
            Declaration("municipality_name_not_empty", "not_empty", ("municipality_name",), tags=("presence",)),
            within("province_code", *b.provinces), within("data_year", *b.employment_years),
            within("data_month", 1, 12), *[within(c, 0) for c in totals],
            *[within(c, 0, 100, **known) for c in shares]]


def unemployment(b: Bounds = DEFAULT) -> list[Declaration]:
    return _employment(["total_unemployment", "total_men_unemployment", "total_women_unemployment"],
                       ["men_unemployment_percentage", "women_unemployment_percentage"], b)


def contracts(b: Bounds = DEFAULT) -> list[Declaration]:
    return _employment(["total_contracts", "total_men_contracts", "total_women_contracts"],
                       ["permanent_contracts_percentage", "men_contracts_percentage",
                        "women_contracts_percentage"], b)


def yearly(b: Bounds = DEFAULT, key: tuple[str, ...] = KEY) -> list[Declaration]:
    return [*present("municipality_code", "municipality_name", "province_code", "data_year",
                     "months_with_data", "primary_total_unemployment", "avg_total_unemployment"),
            within("data_year", *b.employment_years), within("months_with_data", 1, 12),
            within("primary_total_unemployment", 0), within("avg_total_unemployment", 0),
            one_of("data_coverage_quality", ["complete", "partial", "limited"]),
            one_of("unemployment_trend", TRENDS), unique_key(key)]


def population_trends(b: Bounds = DEFAULT, key: tuple[str, ...] = KEY) -> list[Declaration]:
    consistent = ("population_change IS NULL AND previous_year_population IS NULL "
                  "OR population_change = total_population - previous_year_population")
    return [*present("municipality_code", "municipality_name", "province_code",
                     "autonomous_community_code", "data_year", "total_population"),
            within("data_year", *b.population_years), within("total_population", 0),
            within("population_rank_national", 1), within("population_rank_provincial", 1),
            one_of("population_trend", ["growth", "decline", "stable", "no_data"]),
            one_of("population_trend_category", ["high_growth", "moderate_growth", "stable",
                                                 "moderate_decline", "high_decline", "no_data"]),
            Declaration("population_change_correct", "expression", (), (consistent,), tags=("consistency",)), unique_key(key)]


def rates(years: tuple[int, int] = (2005, 2024), key: tuple[str, ...] = KEY) -> list[Declaration]:
    return [*present("municipality_code", "data_year", "unemployment_rate"), within("data_year", *years),
            within("unemployment_rate", 0, 100), one_of("unemployment_category", ["no_data", *LEVELS]),
            one_of("socioeconomic_health", HEALTH), unique_key(key)]


def socioeconomic(years: tuple[int, int] = (2005, 2024), key: tuple[str, ...] = KEY) -> list[Declaration]:
    return [*present("municipality_code", "municipality_name", "data_year", "has_demographic_data",
                     "has_employment_data"),
            within("data_year", *years), within("total_population", 0),
            within("primary_total_unemployment", 0), within("unemployment_rate", 0, 100),
            one_of("unemployment_category", ["no_employment_data", *LEVELS]),
            one_of("socioeconomic_health_status", HEALTH),
            one_of("economic_resilience_category", ["resilient", "exodus", "attractive", "stable"]),
            one_of("socioeconomic_trend_pattern", ["positive_growth", "economic_decline",
                                                   "growing_with_challenges", "declining_but_improving",
                                                   "stable"]),
            unique_key(key)]


def declared(b: Bounds = DEFAULT, years: tuple[int, int] = (2005, 2024)) -> dict[str, list[Declaration]]:
    """All suites by model."""
    return {"municipalities": municipalities(b), "provinces": provinces(b), "population": population(b),
            "unemployment": unemployment(b), "contracts": contracts(b), "yearly": yearly(b),
            "population_trends": population_trends(b), "rates": rates(years), "socioeconomic": socioeconomic(years)}
