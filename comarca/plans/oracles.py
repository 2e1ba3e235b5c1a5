"""Oracle SQL, written apart from the Spark plans: self-joins where Spark uses a
window, NOT EXISTS where it uses an anti-join, theta joins where it uses substrings."""

from __future__ import annotations

from comarca.functions import fixed_values as fv
from comarca.plans import suites
from comarca.plans.workload import BOUNDS, CODE_BASE, CONTRACT_PARTS, RATE_YEARS, UNEMPLOYMENT_PARTS, oracle_with

ORACLES: dict[str, str] = {}


def half_up(num: str, den: str, scale: int = 2) -> str:
    """round(num / den, scale) of whole numbers, half away from zero, null unless den > 0."""
    n, d = f"CAST({num} AS BIGINT)", f"CAST({den} AS BIGINT)"
    whole = (f"(CASE WHEN {n} < 0 THEN -1 ELSE 1 END) * "
             f"((abs({n}) * {2 * 10 ** scale} + {d}) // (2 * {d}))")
    value = f"CAST({whole} AS BIGINT)" if scale == 0 else f"CAST({whole} AS DOUBLE) / {10 ** scale}"
    return f"(CASE WHEN {d} > 0 THEN {value} END)"


def pct(num: str, den: str, scale: int = 2) -> str:
    return half_up(f"({num}) * 100", den, scale)


def norm(c: str) -> str:
    return (f"trim(regexp_replace(translate(upper(trim({c})), '{fv.FOLD_FROM}', '{fv.FOLD_TO}'), "
            r"'\s+', ' ', 'g'))")


def body(needs: list[str], ctes: dict[str, str], select: str) -> str:
    parts = [oracle_with(*needs)] if needs else ["WITH one AS (SELECT 1)"]
    parts += [f"{name} AS ({sql})" for name, sql in ctes.items()]
    return ",\n".join(parts) + "\n" + select


# ---- staged tables -------------------------------------------------------------

def staged_ctes(kind: str) -> dict[str, str]:
    raw = f"raw_{kind}"
    total = f"total_{kind}"
    parts = UNEMPLOYMENT_PARTS if kind == "unemployment" else CONTRACT_PARTS
    whole = ",\n ".join(f"CASE WHEN {c} >= 0 THEN CAST({c} AS INT) END AS {c}" for c in [total, *parts])

    def zero(*cs):
        return " + ".join(f"coalesce({c}, 0)" for c in cs)

    def summed(name, *cs):
        return f"CAST({zero(*cs)} AS INT) AS {name}"

    if kind == "unemployment":
        sums = [summed("total_men_unemployment", "men_under_25", "men_25_44", "men_45_plus"),
                summed("total_women_unemployment", "women_under_25", "women_25_44", "women_45_plus")]
        shares = {"men_unemployment_percentage": "total_men_unemployment",
                  "women_unemployment_percentage": "total_women_unemployment",
                  "under_25_unemployment_percentage": zero("men_under_25", "women_under_25"),
                  "age_25_44_unemployment_percentage": zero("men_25_44", "women_25_44"),
                  "over_45_unemployment_percentage": zero("men_45_plus", "women_45_plus")}
    else:
        i, t, c = "indefinite_initial", "temporary_initial", "indefinite_conversion"
        sums = [summed("total_men_contracts", f"men_{i}", f"men_{t}", f"men_{c}"),
                summed("total_women_contracts", f"women_{i}", f"women_{t}", f"women_{c}"),
                *[summed(f"total_{x}", f"men_{x}", f"women_{x}") for x in (i, t, c)]]
        shares = {"men_contracts_percentage": "total_men_contracts",
                  "women_contracts_percentage": "total_women_contracts",
                  "indefinite_initial_percentage": f"total_{i}",
                  "temporary_initial_percentage": f"total_{t}",
                  "indefinite_conversion_percentage": f"total_{c}",
                  "permanent_contracts_percentage": f"total_{i} + total_{c}"}
    share_sql = ", ".join(f"{pct(e, total)} AS {n}" for n, e in shares.items())
    s = kind[0]
    return {
        f"{s}_pairs": f"""SELECT DISTINCT upper(trim(municipality_name)) AS nk, upper(trim(province)) AS ck,
    municipality_code AS code FROM {raw}
  WHERE municipality_code IS NOT NULL AND municipality_code <> 0 AND municipality_name <> ''""",
        f"{s}_lookup": f"""SELECT nk, ck, code FROM (SELECT *, count(*) OVER (PARTITION BY nk) AS a,
    count(*) OVER (PARTITION BY code) AS b FROM {s}_pairs) x WHERE a = 1 AND b = 1""",
        f"{s}_exact": """SELECT upper(trim(municipality_name)) AS nk, province_code AS pc,
    min(municipality_code) AS code FROM dictionary GROUP BY 1, 2""",
        f"{s}_norm": f"""SELECT * FROM (SELECT {norm('municipality_name')} AS nn, province_code AS pc,
    municipality_code AS code, municipality_name AS mn, row_number() OVER (
      PARTITION BY {norm('municipality_name')}, province_code ORDER BY municipality_code) AS rn
    FROM dictionary) x WHERE rn = 1""",
        f"{s}_rows": f"""SELECT r.*, upper(trim(r.province)) AS pn,
    coalesce(p.province_code, q.province_code) AS pcode,
    nullif(r.municipality_code, 0) AS original, l.code AS lcode, e.code AS ecode, n.code AS ncode, n.mn
  FROM {raw} r
  LEFT JOIN provinces p ON upper(trim(r.province)) = upper(trim(p.province_name))
  LEFT JOIN aliases a ON upper(trim(r.province)) = upper(trim(a.alias))
  LEFT JOIN provinces q ON upper(trim(a.name)) = upper(trim(q.province_name))
  LEFT JOIN {s}_lookup l ON upper(trim(r.municipality_name)) = l.nk AND upper(trim(r.province)) = l.ck
  LEFT JOIN {s}_exact e ON upper(trim(r.municipality_name)) = e.nk
    AND coalesce(p.province_code, q.province_code) = e.pc
  LEFT JOIN {s}_norm n ON {norm('r.municipality_name')} = n.nn
    AND coalesce(p.province_code, q.province_code) = n.pc""",
        f"{s}_coded": f"""SELECT *, coalesce(original, lcode, ecode, ncode) AS any_code,
    CASE WHEN original IS NOT NULL THEN 'original' WHEN lcode IS NOT NULL THEN 'sepe_lookup'
      WHEN ecode IS NOT NULL THEN 'ine_reference' WHEN ncode IS NOT NULL THEN 'fuzzy_match'
      ELSE 'not_found' END AS src,
    original IS NULL AND ncode IS NOT NULL AS matched FROM {s}_rows""",
        f"{s}_base": f"""SELECT CASE WHEN any_code >= {CODE_BASE} THEN any_code % {CODE_BASE}
      ELSE any_code END AS municipality_code, municipality_name, src AS municipality_code_source,
    src NOT IN ('original', 'not_found') AS municipality_code_completed,
    CASE WHEN matched THEN 'fuzzy_normalized' END AS match_method,
    CASE WHEN matched THEN 95 END AS confidence_score,
    CASE WHEN matched THEN mn END AS fuzzy_matched_name,
    pcode AS province_code, pn AS province_name, year AS data_year, month AS data_month,
    make_date(year, month, 1) AS reporting_date,
    {whole}, {', '.join(sums)}
  FROM {s}_coded WHERE municipality_name IS NOT NULL AND municipality_name <> ''
    AND year BETWEEN 1995 AND 2001 AND month BETWEEN 1 AND 12 AND {total} >= 0""",
        kind: f"SELECT *, {share_sql} FROM {s}_base",
    }


REFS = ["provinces", "aliases", "dictionary"]
UNEMP_NEEDS, UNEMP = REFS + ["raw_unemployment"], staged_ctes("unemployment")
CONTR_NEEDS, CONTR = REFS + ["raw_contracts"], staged_ctes("contracts")

POP_NEEDS = ["raw_population", "dictionary"]
POP = {"population": """SELECT CAST(CAST(province_code AS DOUBLE) AS INT) AS province_code, province_name,
    CAST(CAST(cmun AS DOUBLE) AS BIGINT) AS municipality_code, municipality_name,
    CASE WHEN population_total >= 0 THEN CAST(population_total AS BIGINT) END AS population_total,
    CASE WHEN population_male >= 0 THEN CAST(population_male AS BIGINT) END AS population_male,
    CASE WHEN population_female >= 0 THEN CAST(population_female AS BIGINT) END AS population_female,
    data_year, source_file
  FROM raw_population WHERE municipality_name IS NOT NULL AND municipality_name <> ''
    AND data_year BETWEEN 1995 AND 2001 AND population_total IS NOT NULL"""}

ORACLES["dim_provinces"] = body(["provinces"], {}, "SELECT * FROM provinces")
ORACLES["dim_entities"] = body(["dictionary"], {}, "SELECT * FROM dictionary")
ORACLES["province_alias_map"] = body(REFS, {}, """
SELECT upper(trim(a.alias)) AS province_key, coalesce(p.province_code, q.province_code) AS province_code,
  CASE WHEN p.province_code IS NOT NULL THEN 'direct' ELSE 'alias' END AS province_rule
FROM aliases a LEFT JOIN provinces p ON upper(a.alias) = upper(p.province_name)
LEFT JOIN provinces q ON upper(a.name) = upper(q.province_name)""")
ORACLES["stage_population"] = body(POP_NEEDS, POP, "SELECT * FROM population")
ORACLES["stage_unemployment"] = body(UNEMP_NEEDS, UNEMP, "SELECT * FROM unemployment")
ORACLES["stage_contracts"] = body(CONTR_NEEDS, CONTR, "SELECT * FROM contracts")

_sums = ["total_contracts", "total_men_contracts", "total_women_contracts", "total_indefinite_initial",
         "total_temporary_initial", "total_indefinite_conversion"]
ORACLES["shares_by_category"] = body(CONTR_NEEDS, {**CONTR, "g": (
    "SELECT province_code, data_year, " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _sums)
    + " FROM contracts GROUP BY 1, 2")}, f"""
SELECT *, {pct('total_men_contracts', 'total_contracts')} AS men_contracts_percentage,
  {pct('total_women_contracts', 'total_contracts')} AS women_contracts_percentage,
  {pct('total_indefinite_initial', 'total_contracts')} AS indefinite_initial_percentage,
  {pct('total_temporary_initial', 'total_contracts')} AS temporary_initial_percentage,
  {pct('total_indefinite_conversion', 'total_contracts')} AS indefinite_conversion_percentage,
  {pct('total_indefinite_initial + total_indefinite_conversion', 'total_contracts')}
    AS permanent_contracts_percentage
FROM g""")

# ---- yearly rollup -------------------------------------------------------------

_avgs = {"avg_men_unemployment": "total_men_unemployment",
         "avg_women_unemployment": "total_women_unemployment",
         "avg_under_25_unemployment": "men_under_25 + women_under_25",
         "avg_25_44_unemployment": "men_25_44 + women_25_44",
         "avg_45_plus_unemployment": "men_45_plus + women_45_plus",
         "avg_agriculture_unemployment": "agriculture_sector",
         "avg_industry_unemployment": "industry_sector",
         "avg_construction_unemployment": "construction_sector",
         "avg_services_unemployment": "services_sector",
         "avg_no_previous_employment": "no_previous_employment"}


def mean(e: str) -> str:
    return half_up(f"sum({e})", f"count({e})", 0)


def season(months: str) -> str:
    return f"CASE WHEN data_month IN ({months}) THEN total_unemployment END"


W, S = season("12, 1, 2"), season("6, 7, 8")
YEARLY = {
    **UNEMP,
    "yearly": f"""SELECT province_code, municipality_code, data_year,
    max(municipality_name) AS municipality_name, CAST(count(*) AS INT) AS months_with_data,
    CAST(sum(CASE WHEN total_unemployment > 0 THEN 1 ELSE 0 END) AS INT) AS months_with_unemployment,
    {mean('total_unemployment')} AS avg_total_unemployment,
    max(total_unemployment) AS max_total_unemployment, min(total_unemployment) AS min_total_unemployment,
    max({season('12')}) AS dec_total_unemployment, {mean(season('10, 11, 12'))} AS q4_avg_unemployment,
    {', '.join(f'{mean(e)} AS {n}' for n, e in _avgs.items())},
    CASE WHEN count(*) >= 11 THEN round(stddev_samp(total_unemployment)
      / nullif(avg(total_unemployment), 0) * 100, 2) END AS unemployment_volatility_pct,
    avg({W}) AS winter_avg_unemployment, avg({S}) AS summer_avg_unemployment,
    CASE WHEN sum({W}) > 0 AND sum({S}) > 0 THEN {half_up(
        f'(sum({W}) * count({S}) - sum({S}) * count({W})) * 100', f'sum({S}) * count({W})')}
      END AS seasonal_variation_pct
  FROM unemployment WHERE municipality_code IS NOT NULL AND total_unemployment >= 0 GROUP BY 1, 2, 3""",
    "yp": """SELECT *, coalesce(CAST(dec_total_unemployment AS BIGINT), q4_avg_unemployment,
    avg_total_unemployment) AS primary_total_unemployment FROM yearly""",
    "yt": f"""SELECT c.*, p.primary_total_unemployment AS prev_year_unemployment,
    c.primary_total_unemployment - p.primary_total_unemployment AS unemployment_change,
    {pct('c.primary_total_unemployment - p.primary_total_unemployment', 'p.primary_total_unemployment')}
      AS unemployment_change_pct
  FROM yp c LEFT JOIN yp p ON c.municipality_code = p.municipality_code
    AND c.province_code IS NOT DISTINCT FROM p.province_code AND c.data_year = p.data_year + 1""",
    "rollup": f"""SELECT municipality_code, municipality_name, province_code, data_year, months_with_data,
    months_with_unemployment, CASE WHEN months_with_data >= 11 THEN 'complete'
      WHEN months_with_data >= 6 THEN 'partial' ELSE 'limited' END AS data_coverage_quality,
    primary_total_unemployment, avg_total_unemployment, dec_total_unemployment, q4_avg_unemployment,
    max_total_unemployment, min_total_unemployment, {', '.join(_avgs)}, prev_year_unemployment,
    unemployment_change, unemployment_change_pct, unemployment_volatility_pct, winter_avg_unemployment,
    summer_avg_unemployment, seasonal_variation_pct,
    CASE WHEN unemployment_change_pct IS NULL THEN 'no_comparison_data'
      WHEN unemployment_change_pct > 10 THEN 'high_increase'
      WHEN unemployment_change_pct > 2 THEN 'moderate_increase'
      WHEN unemployment_change_pct > -2 THEN 'stable'
      WHEN unemployment_change_pct > -10 THEN 'moderate_decrease' ELSE 'high_decrease' END
      AS unemployment_trend,
    coalesce((max_total_unemployment - min_total_unemployment) * 10 > avg_total_unemployment * 3, false)
      AS high_volatility_flag,
    coalesce(unemployment_volatility_pct > 15, false) AS unstable_employment_flag
  FROM yt WHERE months_with_data >= 3""",
}
ORACLES["yearly_rollup"] = body(UNEMP_NEEDS, YEARLY, "SELECT * FROM rollup")
ORACLES["yearly_trend"] = body(UNEMP_NEEDS, YEARLY, """SELECT province_code, municipality_code, data_year,
  primary_total_unemployment, prev_year_unemployment, unemployment_change, unemployment_change_pct,
  unemployment_trend FROM rollup""")
ORACLES["yearly_volatility"] = body(UNEMP_NEEDS, YEARLY, """SELECT province_code, municipality_code,
  data_year, unemployment_volatility_pct, winter_avg_unemployment, summer_avg_unemployment,
  seasonal_variation_pct, high_volatility_flag, unstable_employment_flag FROM rollup""")

# ---- marts ---------------------------------------------------------------------

CHANGES = {
    **POP,
    "pbase": """SELECT p.province_code, p.municipality_code, p.data_year, p.municipality_name,
    coalesce(population_total, coalesce(population_male, 0) + coalesce(population_female, 0))
      AS total_population, d.autonomous_community_code
  FROM population p LEFT JOIN dictionary d ON p.municipality_code = d.municipality_code
    AND p.province_code = d.province_code
  WHERE p.municipality_code IS NOT NULL AND p.municipality_code <> 0""",
    "changes": f"""SELECT c.*, p.total_population AS previous_year_population,
    c.total_population - p.total_population AS population_change,
    {pct('c.total_population - p.total_population', 'p.total_population')} AS population_change_pct
  FROM pbase c LEFT JOIN pbase p ON c.municipality_code = p.municipality_code
    AND c.province_code = p.province_code AND c.data_year = p.data_year + 1""",
}
TRENDS = {
    **CHANGES,
    # rank = 1 + number of larger places, ties by place
    "trends": """SELECT municipality_code, municipality_name, province_code, autonomous_community_code,
    data_year, total_population, previous_year_population, population_change, population_change_pct,
    CAST(row_number() OVER (PARTITION BY data_year ORDER BY total_population DESC, province_code,
      municipality_code) AS INT) AS population_rank_national,
    CAST(row_number() OVER (PARTITION BY data_year, province_code ORDER BY total_population DESC,
      municipality_code) AS INT) AS population_rank_provincial,
    CASE WHEN population_change IS NULL THEN 'no_data' WHEN population_change > 0 THEN 'growth'
      WHEN population_change < 0 THEN 'decline' ELSE 'stable' END AS population_trend,
    CASE WHEN population_change_pct IS NULL THEN 'no_data' WHEN population_change_pct >= 5 THEN 'high_growth'
      WHEN population_change_pct >= 1 THEN 'moderate_growth' WHEN population_change_pct > -1 THEN 'stable'
      WHEN population_change_pct > -5 THEN 'moderate_decline' ELSE 'high_decline' END
      AS population_trend_category
  FROM changes""",
}
ORACLES["population_trends"] = body(POP_NEEDS, TRENDS, "SELECT * FROM trends")
_ranks = """SELECT c.province_code, c.municipality_code, c.data_year, c.total_population,
  (SELECT CAST(count(*) + 1 AS INT) FROM changes o WHERE o.data_year = c.data_year
    AND (o.total_population > c.total_population OR (o.total_population = c.total_population
      AND (o.province_code < c.province_code OR (o.province_code = c.province_code
        AND o.municipality_code < c.municipality_code))))) AS population_rank_national,
  (SELECT CAST(count(*) + 1 AS INT) FROM changes o WHERE o.data_year = c.data_year
    AND o.province_code = c.province_code AND (o.total_population > c.total_population
      OR (o.total_population = c.total_population AND o.municipality_code < c.municipality_code)))
    AS population_rank_provincial
FROM changes c"""
ORACLES["population_ranks"] = body(POP_NEEDS, CHANGES, _ranks)
ORACLES["population_ranks_by_range"] = ORACLES["population_ranks"]

ALL_NEEDS = list(dict.fromkeys(UNEMP_NEEDS + POP_NEEDS))


def level(rate: str, null: str) -> str:
    return (f"CASE WHEN {rate} IS NULL THEN '{null}' WHEN {rate} < 5 THEN 'low_unemployment' "
            f"WHEN {rate} < 10 THEN 'moderate_unemployment' WHEN {rate} < 20 THEN 'high_unemployment' "
            "ELSE 'very_high_unemployment' END")


HEALTH = """CASE WHEN unemployment_rate < 8 AND population_change_pct > 1 THEN 'thriving'
    WHEN unemployment_rate < 12 AND population_change_pct > 0 THEN 'growing'
    WHEN unemployment_rate > 15 AND population_change_pct < -2 THEN 'struggling'
    WHEN unemployment_rate > 20 AND population_change_pct < -5 THEN 'critical' ELSE 'stable' END"""


def quadrant(null: str) -> str:
    return f"""CASE WHEN population_change_pct IS NULL OR unemployment_change_pct IS NULL THEN {null}
    WHEN population_change_pct > 0 AND unemployment_change_pct < 0 THEN 'positive_growth'
    WHEN population_change_pct < 0 AND unemployment_change_pct > 0 THEN 'economic_decline'
    WHEN population_change_pct > 0 AND unemployment_change_pct > 0 THEN 'growing_with_challenges'
    WHEN population_change_pct < 0 AND unemployment_change_pct < 0 THEN 'declining_but_improving'
    ELSE 'stable' END"""


def mart(minimum: int) -> dict[str, str]:
    return {
        **YEARLY, **TRENDS,
        "core": f"""SELECT t.*, r.* EXCLUDE (municipality_code, municipality_name, province_code, data_year),
    {pct('r.primary_total_unemployment', 't.total_population')} AS unemployment_rate
  FROM trends t JOIN rollup r ON t.municipality_code = r.municipality_code
    AND t.province_code = r.province_code AND t.data_year = r.data_year
  WHERE t.data_year BETWEEN 1996 AND 2001 AND t.total_population > 0
    AND r.primary_total_unemployment >= {minimum}""",
        "rated": """SELECT c.*, p.unemployment_rate AS prev_year_unemployment_rate,
    CASE WHEN p.unemployment_rate > 0 THEN round(c.unemployment_rate - p.unemployment_rate, 2) END
      AS unemployment_rate_change
  FROM core c LEFT JOIN core p ON c.municipality_code = p.municipality_code
    AND c.province_code = p.province_code AND c.data_year = p.data_year + 1""",
    }


ORACLES["rates_mart"] = body(ALL_NEEDS, mart(0), f"""
SELECT municipality_code, municipality_name, province_code, autonomous_community_code, data_year,
  total_population, primary_total_unemployment, unemployment_rate, population_change_pct,
  unemployment_change_pct, prev_year_unemployment_rate, unemployment_rate_change,
  {level('unemployment_rate', 'no_data')} AS unemployment_category, {HEALTH} AS socioeconomic_health,
  {quadrant("'stable'")} AS socioeconomic_pattern, population_trend, unemployment_trend,
  data_coverage_quality FROM rated""")
ORACLES["incremental_upsert"] = body(ALL_NEEDS, {**mart(0), "built": f"""
SELECT municipality_code, municipality_name, province_code, autonomous_community_code, data_year,
  total_population, primary_total_unemployment, unemployment_rate, population_change_pct,
  unemployment_change_pct, prev_year_unemployment_rate, unemployment_rate_change,
  {level('unemployment_rate', 'no_data')} AS unemployment_category, {HEALTH} AS socioeconomic_health,
  {quadrant("'stable'")} AS socioeconomic_pattern, population_trend, unemployment_trend,
  data_coverage_quality FROM rated"""}, "SELECT *, CASE WHEN data_year >= 1999 THEN 2 END AS revision FROM built")
ORACLES["stored_merge_moves"] = body(POP_NEEDS, POP, """
SELECT CAST(province_code AS VARCHAR) || '/' || coalesce(CAST(municipality_code AS VARCHAR) || '/', '')
    || CAST(data_year AS VARCHAR) AS place, CASE WHEN data_year = 2000 THEN 2002 ELSE data_year END AS data_year,
  CAST(population_total AS BIGINT) * CASE WHEN data_year = 2000 THEN 10 ELSE 1 END AS total FROM population""")
ORACLES["socioeconomic_mart"] = body(ALL_NEEDS, mart(1), f"""
SELECT municipality_code, municipality_name, province_code, autonomous_community_code, data_year,
  true AS has_demographic_data, true AS has_employment_data, data_coverage_quality, total_population,
  population_change, population_change_pct, population_trend, population_rank_national,
  primary_total_unemployment, unemployment_change, unemployment_change_pct, unemployment_trend,
  unemployment_rate, prev_year_unemployment_rate, unemployment_rate_change,
  {half_up('primary_total_unemployment * 1000', 'total_population', 1)} AS unemployment_per_1000_inhabitants,
  avg_men_unemployment, avg_women_unemployment,
  CASE WHEN avg_men_unemployment > 0 THEN {half_up('avg_men_unemployment', 'avg_women_unemployment')} END
    AS men_women_unemployment_ratio,
  avg_under_25_unemployment, CASE WHEN avg_under_25_unemployment > 0
    THEN {pct('avg_under_25_unemployment', 'primary_total_unemployment', 1)} END AS youth_unemployment_share,
  unemployment_volatility_pct,
  CASE WHEN unemployment_change_pct IS NULL OR population_change_pct IS NULL THEN NULL
    WHEN unemployment_change_pct > 10 AND population_change_pct > -2 THEN 'resilient'
    WHEN unemployment_change_pct > 10 AND population_change_pct < -5 THEN 'exodus'
    WHEN unemployment_change_pct < -10 AND population_change_pct > 2 THEN 'attractive'
    ELSE 'stable' END AS economic_resilience_category,
  {quadrant('NULL')} AS socioeconomic_trend_pattern,
  {level('unemployment_rate', 'no_employment_data')} AS unemployment_category,
  CASE WHEN unemployment_rate IS NOT NULL THEN {HEALTH} END AS socioeconomic_health_status FROM rated""")
ORACLES["sign_quadrant"] = body(ALL_NEEDS, mart(0), f"""
SELECT data_year, {quadrant('NULL')} AS quadrant, {quadrant("'stable'")} AS quadrant_or_stable,
  count(*) AS places FROM core GROUP BY 1, 2, 3""")
ORACLES["yoy_change"] = body(POP_NEEDS, {**POP, "b": """SELECT * REPLACE (CASE WHEN data_year = 1997 AND municipality_code % 7 = 3 THEN 2003 ELSE data_year END AS data_year)
  FROM population"""}, """
SELECT c.province_code, c.municipality_code, c.data_year, c.population_total,
  p.population_total AS previous_total
FROM b c LEFT JOIN b p ON c.province_code = p.province_code
  AND c.municipality_code = p.municipality_code AND c.data_year = p.data_year + 1""")

# ---- code lookups --------------------------------------------------------------

ORACLES["normalize_names"] = body(["raw_unemployment"], {}, f"""
SELECT DISTINCT municipality_name, {norm('municipality_name')} AS normalized FROM raw_unemployment""")
ORACLES["one_to_one_lookup"] = body(UNEMP_NEEDS, UNEMP, """
SELECT nk AS name_key, ck AS context_key, code FROM u_lookup""")
ORACLES["province_resolution"] = body(UNEMP_NEEDS, {}, """
SELECT upper(trim(r.province)) AS province_key, count(*) AS records,
  min(coalesce(p.province_code, q.province_code)) AS province_code,
  min(CASE WHEN p.province_code IS NOT NULL THEN 'direct' WHEN q.province_code IS NOT NULL THEN 'alias' END)
    AS province_rule
FROM raw_unemployment r LEFT JOIN provinces p ON upper(trim(r.province)) = upper(p.province_name)
LEFT JOIN aliases a ON upper(trim(r.province)) = upper(a.alias)
LEFT JOIN provinces q ON upper(a.name) = upper(q.province_name) GROUP BY 1""")
UNCODED = {**UNEMP, "uncoded": f"""SELECT DISTINCT upper(trim(municipality_name)) AS source_name,
    pcode AS province_code, {norm('municipality_name')} AS nn FROM u_rows
  WHERE original IS NULL AND pcode IS NOT NULL AND trim(municipality_name) <> ''"""}
ORACLES["normalized_name_match"] = body(UNEMP_NEEDS, UNCODED, """
SELECT source_name, uncoded.nn AS name_norm, province_code, code AS norm_code, mn AS norm_name,
  'fuzzy_normalized' AS match_method, 95 AS confidence_score
FROM uncoded JOIN u_norm ON uncoded.nn = u_norm.nn AND province_code = pc""")
SCORED = {**UNCODED, "dn": f"SELECT *, {norm('municipality_name')} AS dn FROM dictionary",
          "scored": """SELECT u.source_name, u.province_code, d.municipality_code AS matched_code,
    d.municipality_name AS matched_name,
    CASE WHEN u.nn = d.dn THEN 'exact_normalized'
      WHEN contains(d.dn, u.nn) AND length(u.nn) >= 4 THEN 'substring_match'
      WHEN contains(u.nn, d.dn) AND length(d.dn) >= 4 THEN 'reverse_substring' END AS match_method,
    CASE WHEN u.nn = d.dn THEN 100 WHEN contains(d.dn, u.nn) AND length(u.nn) >= 4 THEN 85
      WHEN contains(u.nn, d.dn) AND length(d.dn) >= 4 THEN 80 ELSE 0 END AS confidence_score
  FROM uncoded u JOIN dn d ON u.province_code = d.province_code"""}
ORACLES["fuzzy_match"] = body(UNEMP_NEEDS, SCORED, "SELECT * FROM scored WHERE confidence_score >= 70")
ORACLES["fuzzy_best"] = body(UNEMP_NEEDS, SCORED, """
SELECT source_name, province_code, matched_code, matched_name, match_method, confidence_score FROM (
  SELECT *, row_number() OVER (PARTITION BY source_name, province_code ORDER BY confidence_score DESC,
    length(matched_name), matched_code) AS rn FROM scored WHERE confidence_score >= 70) x WHERE rn = 1""")
ORACLES["code_completion"] = body(UNEMP_NEEDS, UNEMP, f"""
SELECT year, src AS municipality_code_source, src NOT IN ('original', 'not_found')
    AS municipality_code_completed, CASE WHEN matched THEN 'fuzzy_normalized' END AS match_method,
  CASE WHEN matched THEN 95 END AS confidence_score, count(*) AS records,
  count(DISTINCT any_code) AS codes, CAST(sum(CASE WHEN any_code >= {CODE_BASE}
    THEN any_code % {CODE_BASE} ELSE any_code END) AS BIGINT) AS code_sum
FROM u_coded GROUP BY 1, 2, 3, 4, 5""")

# ---- grids ---------------------------------------------------------------------

_u_cells = [f"c{i}" for i in range(14)]
_c_cells = [f"c{i}" for i in range(13)]


def filled(cells: list[str]) -> str:
    return " + ".join(f"CASE WHEN nullif({c}, '') IS NULL THEN 0 ELSE 1 END" for c in cells)


def number(c: str) -> str:
    return (f"CASE WHEN regexp_full_match({c}, '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)"
            f"([eE][+-]?[0-9]+)?\\s*') THEN TRY_CAST({c} AS DOUBLE) END")


def lenient(c: str, marks: str = "[<>]") -> str:
    clean = f"regexp_replace({c}, '{marks}', '', 'g')"
    return f"coalesce({number(clean)}, 0.0)"


ORACLES["grid_scan"] = body(["grid_unemployment"], {}, f"""
SELECT source_file, sheet, count(*) AS n_rows,
  CAST(sum({filled(_u_cells)} + CASE WHEN year <= 1995 THEN 3 ELSE 0 END) AS BIGINT) AS n_filled,
  max(CASE WHEN year <= 1995 THEN 17 ELSE 14 END) AS width
FROM grid_unemployment GROUP BY 1, 2""")

_p_cells = [f"c{i}" for i in range(7)]
_words = " + ".join(f"CASE WHEN nullif({c}, '') IS NOT NULL AND NOT regexp_full_match("
                    f"regexp_replace({c}, '[.,]', '', 'g'), '[0-9]+') THEN 1 ELSE 0 END" for c in _p_cells)
HEADERS = {"facts": f"SELECT *, {filled(_p_cells)} AS f, {_words} AS w FROM grid_population",
           "hrow": """SELECT source_file, sheet_no, sheet, coalesce(min(CASE WHEN f >= 3
    AND w >= f - w THEN row_idx END), 1) AS header_row FROM facts GROUP BY 1, 2, 3"""}
ORACLES["grid_header_row"] = body(["grid_population"], HEADERS, "SELECT * FROM hrow")

_case = "CASE WHEN h.odd THEN {} ELSE {} END"
ORACLES["population_from_grid"] = body(["grid_population"], {
    **HEADERS, "hh": """SELECT g.source_file, g.row_idx, g.c4 LIKE 'POB%' AS odd FROM grid_population g
  JOIN hrow r ON g.source_file = r.source_file AND g.row_idx = r.header_row"""}, f"""
SELECT g.source_file, g.sheet, g.row_idx, g.c0 AS province_code, g.c1 AS province_name, g.c2 AS cmun,
  CAST(NULL AS VARCHAR) AS municipality_code, nullif(g.c3, '') AS municipality_name,
  {number('g.c4')} AS population_total,
  {number('CASE WHEN h.odd THEN g.c5 ELSE g.c6 END')} AS population_male,
  {number('CASE WHEN h.odd THEN g.c6 ELSE g.c5 END')} AS population_female,
  CAST('19' || substr(g.source_file, 7, 2) AS INT) + CASE WHEN substr(g.source_file, 7, 2) < '96'
    THEN 100 ELSE 0 END AS data_year
FROM grid_population g JOIN hh h ON g.source_file = h.source_file AND g.row_idx > h.row_idx
WHERE NOT regexp_matches(lower(coalesce(g.c0, '')), 'total|suma|agregado')""")

EMP_NEEDS = ["grid_unemployment", "grid_contracts"]


def sheet_ctes(source: str, name: str) -> dict[str, str]:
    """Sheet facts of a union of grids in ``source``."""
    return {name: f"""SELECT source_file, sheet_no, sheet,
    min(CASE WHEN CASE WHEN y <= 1997 THEN length(c1) > 3 AND regexp_matches(c1, '[a-zA-Z]')
      AND upper(c1) NOT IN ('TOTAL', 'HOMBRES', 'MUJERES', 'MUNICIPIOS')
      ELSE {number('c0')} > 1000 END THEN row_idx END) AS data_start,
    max(width) AS width, count(*) AS sheet_rows,
    CASE WHEN sheet LIKE 'PARO %' THEN 'unemployment' ELSE 'contracts' END AS data_type,
    trim(CASE WHEN sheet LIKE 'PARO %' THEN substr(sheet, 6) ELSE substr(sheet, 11) END) AS province,
    max(y) AS year, max(m) AS month,
    CASE WHEN max(y) <= 1995 THEN 'wide' WHEN max(y) <= 1997 THEN 'old' ELSE 'new' END AS vintage
  FROM {source} GROUP BY 1, 2, 3""",
            name + "_kept": f"""SELECT * FROM {name} a WHERE data_start IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM {name} b WHERE a.source_file = b.source_file AND a.data_type = b.data_type
      AND replace(a.province, '.', '') = replace(b.province, '.', '') AND b.data_start IS NOT NULL
      AND b.sheet_no > a.sheet_no)"""}


def grid_union(kinds: list[str]) -> str:
    out = []
    for kind in kinds:
        n = 14 if kind == "unemployment" else 13
        wide = "CASE WHEN year <= 1995 THEN 17 ELSE 14 END" if n == 14 else "13"
        cells = ", ".join(f"nullif(c{i}, '') AS c{i}" if i < n else f"NULL AS c{i}" for i in range(14))
        out.append(f"SELECT source_file, sheet_no, sheet, row_idx, {wide} AS width, {cells}, "
                   "CAST(split_part(source_file, '_', 1) AS INT) AS y, "
                   f"CAST(split_part(source_file, '_', 2) AS INT) AS m FROM grid_{kind}")
    return " UNION ALL ".join(out)


REASON = f"""CASE WHEN vintage = 'new' AND c0 IS NULL THEN 'no_code'
    WHEN vintage = 'new' AND {number('c0')} IS NULL THEN 'code_not_numeric'
    WHEN vintage <> 'new' AND c1 IS NULL THEN 'no_name'
    WHEN vintage <> 'new' AND length(c1) <= 3 THEN 'short_name'
    WHEN vintage <> 'new' AND regexp_matches(upper(c1), '{"|".join(w.replace(".", chr(92) + ".")
                                                                  for w in fv.HEADING_WORDS)}') THEN 'heading'
    WHEN vintage <> 'new' AND lower(trim(c1)) = lower(province) THEN 'province_name' END"""


def tidy(kind: str) -> tuple[list[str], dict[str, str]]:
    names = fv.UNEMPLOYMENT_MEASURES if kind == "unemployment" else fv.CONTRACT_MEASURES
    marks = "[<>]" if kind == "unemployment" else "[ <>]"
    cells = ", ".join(f"{lenient(f'c{i}', marks)} AS {n}" for i, n in enumerate(names, start=2))
    k = kind[0]
    return [f"grid_{kind}"], {
        f"{k}g": grid_union([kind]), **sheet_ctes(f"{k}g", f"{k}s"),
        f"{k}data": f"""SELECT g.*, s.data_type, s.province, s.year, s.month, s.vintage FROM {k}g g
  JOIN {k}s_kept s ON g.source_file = s.source_file AND g.sheet_no = s.sheet_no
    AND g.row_idx >= s.data_start""",
        f"{k}marked": f"SELECT *, {REASON} AS reason FROM {k}data",
        f"{k}all": f"""SELECT source_file, sheet, row_idx, CASE WHEN vintage = 'new'
      THEN CAST({number('c0')} AS BIGINT) ELSE 0 END AS municipality_code, trim(c1) AS municipality_name,
    {cells}, province, year, month, data_type, reason FROM {k}marked""",
        f"{k}tidy": f"SELECT * EXCLUDE (reason) FROM {k}all WHERE reason IS NULL"}


ORACLES["grid_data_start"] = body(EMP_NEEDS, {
    "g": grid_union(["unemployment", "contracts"]), **sheet_ctes("g", "s")}, "SELECT * FROM s")
# sheets whose number divides by five lose their data rows, others start sixty rows further down
ORACLES["rejected_sheets"] = body(EMP_NEEDS, {
    "whole": grid_union(["unemployment", "contracts"]),
    "g": """SELECT * REPLACE (row_idx + 60 AS row_idx, CASE WHEN sheet_no % 5 = 0 THEN NULL ELSE c0 END AS c0,
    CASE WHEN sheet_no % 5 = 0 THEN NULL ELSE c1 END AS c1) FROM whole""",
    **sheet_ctes("g", "s")}, """
SELECT source_file, sheet_no, sheet, data_type, sheet_rows,
  CASE WHEN data_start IS NULL THEN 'no_data_row' ELSE 'later_sheet' END AS reason
FROM s WHERE (source_file, sheet_no) NOT IN (SELECT (source_file, sheet_no) FROM s_kept)""")
_needs, _ctes = tidy("unemployment")
ORACLES["grid_to_tidy"] = body(_needs, _ctes, "SELECT * FROM utidy")
ORACLES["grid_noise_filter"] = body(_needs, _ctes, """
SELECT source_file, sheet_no, sheet, row_idx, data_type, reason FROM umarked WHERE reason IS NOT NULL""")
_issues = [("missing_code", "municipality_code", "municipality_code IS NULL"),
           ("placeholder_code", "municipality_code", "year > 1997 AND municipality_code = 0"),
           ("missing_name", "municipality_name", "municipality_name IS NULL"),
           *[("negative", c, f"{c} - 20 < 0" if c in ("men_25_44", "services_sector") else f"{c} < 0")
             for c in fv.UNEMPLOYMENT_MEASURES],
           ("too_high", "total_unemployment", "total_unemployment * 1000 > 50000")]
ORACLES["sheet_quality"] = body(_needs, _ctes, " UNION ALL ".join(
    f"SELECT source_file, sheet, '{i}' AS issue, '{c}' AS column_name, count(*) AS violations "
    f"FROM utidy WHERE {w} GROUP BY 1, 2" for i, c, w in _issues))
_cneeds, _cctes = tidy("contracts")
ORACLES["grid_positional"] = body(_cneeds, _cctes, "SELECT * EXCLUDE (reason) FROM call")
ORACLES["coverage_summary"] = body(_needs + _cneeds, {
    **_ctes, **_cctes, "t": " UNION ALL ".join(
        f"SELECT data_type, province, year, month, source_file, municipality_name FROM {k}tidy"
        for k in "uc")}, """
SELECT data_type, count(DISTINCT province) AS provinces, count(DISTINCT year * 100 + month) AS months,
  min(CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0')) AS first_month,
  max(CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0')) AS last_month,
  count(DISTINCT source_file) AS files, count(DISTINCT municipality_name) AS entities,
  count(*) AS records FROM t GROUP BY 1""")
ORACLES["processing_report"] = body(EMP_NEEDS, {
    "g": grid_union(["unemployment", "contracts"]), **sheet_ctes("g", "s"),
    "f": """SELECT source_file, max(vintage) AS v, count(*) AS sheets, count(data_start) AS good
  FROM s GROUP BY 1"""}, f"""
SELECT count(*) AS files_processed, CAST(0 AS BIGINT) AS files_failed, 100.0::DOUBLE AS file_success_pct,
  count(*) FILTER (WHERE v <> 'new') AS old_format_files, count(*) FILTER (WHERE v = 'new')
    AS new_format_files, CAST(sum(good) AS BIGINT) AS sheets_processed,
  CAST(sum(sheets) - sum(good) AS BIGINT) AS sheets_failed,
  {half_up('sum(good) * 100', 'sum(sheets)', 1)} AS sheet_success_pct FROM f""")

ORACLES["lenient_numeric"] = body(["cell_texts"], {}, f"""
SELECT cell, count(*) AS n, {lenient('cell')} AS as_unemployment, {lenient('cell', '[ <>]')} AS as_contracts
FROM cell_texts GROUP BY cell""")


def cleaned(c: str) -> str:
    dropped = (f"regexp_replace(regexp_replace(lower(trim({c})), '[ /\\-]', '_', 'g'), "
               "'[^\\p{L}\\p{N}_]', '', 'g')")
    return (f"CASE WHEN {dropped} = '' THEN NULL WHEN regexp_matches({dropped}, '^[0-9]') "
            f"THEN 'col_' || {dropped} ELSE {dropped} END")


CANON = """CASE WHEN regexp_matches(h, '^pob[0-9]{2}') THEN 'population_total'
    WHEN (contains(h, 'cod') OR contains(h, 'cmun')) AND contains(h, 'municipio') THEN 'municipality_code'
    WHEN (contains(h, 'municipio') OR contains(h, 'nombre')) AND NOT contains(h, 'codigo')
      THEN 'municipality_name'
    WHEN contains(h, 'cpro') OR contains(h, 'cod_prov') OR contains(h, 'codigo_prov') THEN 'province_code'
    WHEN contains(h, 'provincia') AND NOT contains(h, 'codigo') THEN 'province_name'
    WHEN h = 'province' THEN 'province'
    WHEN contains(h, 'varon') OR contains(h, 'hombre') OR contains(h, 'masculino') THEN 'population_male'
    WHEN contains(h, 'mujer') OR contains(h, 'femenin') THEN 'population_female'
    WHEN contains(h, 'total') OR contains(h, 'ambos') OR contains(h, 'suma') THEN 'population_total'
    WHEN contains(h, 'comunidad') OR contains(h, 'autonoma') OR contains(h, 'ccaa')
      THEN 'autonomous_community'
    WHEN contains(h, 'isla') THEN 'island' ELSE """
_h = {"hd": f"SELECT *, lower(trim(header)) AS h, {cleaned('header')} AS clean FROM headers",
      "hc": f"SELECT *, {CANON} clean END AS canonical FROM hd"}
ORACLES["header_canon"] = body(["headers"], _h, """
SELECT header, count(*) AS n, max(canonical) AS canonical FROM hc GROUP BY header""")
ORACLES["clean_column_names"] = body(["headers"], _h, """
SELECT p_partkey, header, coalesce(clean, 'unnamed_column_' || CAST(pos AS VARCHAR)) AS column_name
FROM hd""")
ORACLES["dedupe_headers"] = body(["headers"], {**_h, "hn": """SELECT file_no, pos,
    coalesce(canonical, 'unnamed_column_' || CAST(pos AS VARCHAR)) AS name FROM hc"""}, """
SELECT a.file_no, a.pos, CASE WHEN count(b.pos) = 0 THEN a.name
  ELSE a.name || '_' || CAST(count(b.pos) AS VARCHAR) END AS name
FROM hn a LEFT JOIN hn b ON a.file_no = b.file_no AND a.name = b.name AND b.pos < a.pos
GROUP BY a.file_no, a.pos, a.name""")
ORACLES["sniff_code_or_name"] = body(["code_rows"], {}, """
SELECT file_no, CASE WHEN bool_and(regexp_full_match(province, '[0-9]+')) THEN 'province_code'
  ELSE 'province_name' END AS column_name
FROM (SELECT *, row_number() OVER (PARTITION BY file_no ORDER BY c_custkey) AS rn
  FROM code_rows WHERE province IS NOT NULL) x WHERE rn <= 10 GROUP BY 1""")
ORACLES["drop_empty"] = body(["code_rows"], {}, """
SELECT province_code, municipality_code, province FROM code_rows
WHERE province_code IS NOT NULL OR municipality_code IS NOT NULL OR province IS NOT NULL""")
ORACLES["drop_subtotals"] = body(["code_rows"], {}, """
SELECT label, c_custkey FROM code_rows
WHERE lower(label) NOT LIKE '%total%' AND lower(label) NOT LIKE '%suma%'""")
ORACLES["zero_pad_codes"] = body(["code_rows"], {}, """
SELECT c_custkey, CASE WHEN length(province_code) < 2 THEN '0' || province_code ELSE province_code END
  AS province_code, CASE WHEN length(municipality_code) < 5
  THEN repeat('0', 5 - length(municipality_code)) || municipality_code ELSE municipality_code END
  AS municipality_code FROM code_rows""")
_bad = {"bad": """SELECT place_key, 'province_code' AS column_name, cpro AS value,
    CASE WHEN place_key % 23 = 4 THEN 'not_int' ELSE 'out_of_range' END AS reason
  FROM dictionary_sheet WHERE place_key % 23 = 4 OR place_key % 29 = 6
  UNION ALL SELECT place_key, 'municipality_code', cmun, 'not_bigint' FROM dictionary_sheet WHERE place_key % 19 = 3
  UNION ALL SELECT place_key, 'check_digit', dc, 'missing' FROM dictionary_sheet
    WHERE place_key % 31 = 5 OR place_key % 37 = 8
  UNION ALL SELECT place_key, 'municipality_name', nombre, 'missing' FROM dictionary_sheet WHERE place_key % 41 = 9"""}
ORACLES["dictionary_rejects"] = body(["dictionary_sheet"], _bad, "SELECT * FROM bad")
ORACLES["dictionary_typed"] = body(["dictionary_sheet"], _bad, """
SELECT place_key, autonomous_community_code, province_code, municipality_code, check_digit, municipality_name
FROM places WHERE place_key NOT IN (SELECT place_key FROM bad)""")
ORACLES["exact_medians"] = """
SELECT 'all' AS l_returnflag, quantile_cont(l_extendedprice, 0.5) AS median FROM lineitem
UNION ALL SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) FROM lineitem GROUP BY 1"""
ORACLES["drop_nonnumeric_key"] = body(["code_rows"], {}, """
SELECT count(*) FILTER (WHERE regexp_full_match(province_code, '[0-9]+')) AS rows_kept,
  count(*) FILTER (WHERE NOT coalesce(regexp_full_match(province_code, '[0-9]+'), false)) AS rows_removed
FROM code_rows""")
ORACLES["numeric_key_rows"] = body(["code_rows"], {}, """
SELECT c_custkey, TRY_CAST(province_code AS BIGINT) AS province_code FROM code_rows
WHERE TRY_CAST(province_code AS BIGINT) IS NOT NULL""")
ORACLES["sheet_classify"] = body(["sheet_names"], {
    "f": """SELECT c_custkey, sheet, CASE WHEN trim(sheet) = 'CONTRTOS LUGO' THEN 'CONTRATOS LUGO'
    ELSE trim(sheet) END AS s FROM sheet_names""",
    "p": """SELECT *, CASE WHEN s IN ('PORTADA', 'Indice', 'NO CONSTA MUNIC.') THEN 'ignored'
      WHEN s LIKE 'PARO %' THEN 'unemployment' WHEN s LIKE 'CONTRATOS %' THEN 'contracts'
      ELSE 'unknown' END AS data_type,
    trim(CASE WHEN s LIKE 'PARO %' THEN substr(s, 6) WHEN s LIKE 'CONTRATOS %' THEN substr(s, 11)
      ELSE s END) AS pr FROM f"""}, """
SELECT c_custkey, sheet, data_type, CASE WHEN pr IN ('A CORUÑA', 'CORUÑA A') THEN 'CORUÑA'
  WHEN pr IN ('STA CRUZ TENER.', 'STA. CRUZ TENER.') THEN 'SANTA CRUZ TENERIFE' ELSE pr END AS province
FROM p""")
ORACLES["label_key"] = body(["headers"], {}, """
SELECT DISTINCT header, upper(replace(replace(replace(header, ' ', '_'), '.', ''), '/', '_')) AS label
FROM headers""")
ORACLES["last_wins"] = """
SELECT o_custkey, o_orderkey, o_orderstatus FROM orders o WHERE NOT EXISTS (
  SELECT 1 FROM orders p WHERE p.o_custkey = o.o_custkey AND (p.o_orderdate > o.o_orderdate
    OR (p.o_orderdate = o.o_orderdate AND p.o_orderkey > o.o_orderkey)))"""

# ---- files, pages, loads -------------------------------------------------------

ORACLES["filename_dates"] = body(["file_names"], {}, """
SELECT file_name, count(*) AS n, CASE WHEN file_name LIKE 'pobmun%' THEN
    CASE WHEN length(file_name) = 10 THEN CAST(substr(file_name, 7) AS INT)
      WHEN CAST(substr(file_name, 7) AS INT) >= 96 THEN 1900 + CAST(substr(file_name, 7) AS INT)
      ELSE 2000 + CAST(substr(file_name, 7) AS INT) END
    ELSE TRY_CAST(split_part(file_name, '_', 1) AS INT) END AS year,
  CASE WHEN contains(file_name, '_') THEN
    TRY_CAST(replace(split_part(file_name, '_', 2), '.xls', '') AS INT) END AS month
FROM file_names GROUP BY file_name""")
_names = " ".join(f"WHEN contains(t, '{n}') THEN {i}" for i, n in enumerate(fv.MONTH_NAMES, start=1))
ORACLES["month_from_label"] = body(["month_labels"], {
    "l": """SELECT DISTINCT label_year, label, regexp_replace(lower(label),
    '-?' || CAST(label_year AS VARCHAR), '', 'g') AS t FROM month_labels""",
    "d": "SELECT *, TRY_CAST(regexp_extract(t, '([0-9]{1,2})', 1) AS INT) AS digits FROM l"}, f"""
SELECT label_year, label, CASE {_names} WHEN digits BETWEEN 1 AND 12 THEN digits ELSE 1 END AS month
FROM d""")
ORACLES["page_links"] = """
SELECT href, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages) x GROUP BY 1"""
_links = {"lk": """SELECT DISTINCT CAST(split_part(href, '/', 4) AS INT) AS link_year,
    replace(split_part(href, '/', 5), '.html', '') AS identifier,
    'https://stats.example.org' || href AS url
  FROM (SELECT unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM stat_pages) x
  WHERE href LIKE '/stats/municipios/%'"""}
ORACLES["page_links_by_year"] = body(["stat_pages"], _links, "SELECT * FROM lk")
ORACLES["latest_partition"] = body(["stat_pages"], _links, """
SELECT * FROM lk ORDER BY link_year DESC, identifier DESC, url DESC LIMIT 1""")
ORACLES["page_pick_link"] = body(["stat_pages"], {}, """
SELECT page_id, url, CASE page_id % 5
    WHEN 0 THEN 'https://stats.example.org/d/b' || CAST(page_id AS VARCHAR) || '.xlsx?v=1'
    WHEN 1 THEN 'https://stats.example.org/d/c' || CAST(page_id AS VARCHAR) || '.xls'
    WHEN 2 THEN 'https://files.example.org/e' || CAST(page_id AS VARCHAR) || '.xlsx' END AS attachment_url,
  CASE page_id % 5 WHEN 0 THEN 'after_marker' WHEN 1 THEN 'first_link' WHEN 2 THEN 'first_link'
    ELSE 'none' END AS rule FROM stat_pages""")
ORACLES["html_table_rows"] = """
SELECT page_id, r AS row_no, c AS col_no, CASE c WHEN 0 THEN 'CODAUTO' ELSE 'Nombre' END AS header,
  CASE WHEN r = 1 AND c = 0 THEN CAST(page_id % 19 AS VARCHAR) WHEN r = 1 THEN url
    WHEN c = 0 THEN 'x' ELSE '' END AS value
FROM pages, (VALUES (1, 0), (1, 1), (2, 0), (2, 1)) t(r, c)"""
ORACLES["odd_page_links"] = """
SELECT page_id, '/n/' || CAST(page_id AS VARCHAR) || '.html?a=1&b=' || chr(8364) || chr(252) AS href FROM pages
UNION ALL SELECT page_id, '/m/bare.xls' FROM pages WHERE page_id % 3 = 0
UNION ALL SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) FROM pages WHERE page_id % 5 = 1"""
ORACLES["odd_page_tables"] = """
WITH t(kind, col_no, header, value) AS (VALUES
  (0, 0, 'wide', chr(8211)), (0, 1, 'wide', 'in ner'), (0, 2, 'last', 'c'),
  (1, 0, 'wide', 'a'), (1, 1, 'wide', 'b' || chr(160) || 'c'), (1, 2, 'last', 'b' || chr(160) || 'c'),
  (2, 0, 'wide', '1 < 2'), (2, 1, 'wide', chr(209) || '&notaname;'), (3, 0, 'wide', 'x'), (3, 1, 'wide', ''))
SELECT page_id, 1 AS row_no, col_no, header, value FROM pages JOIN t ON page_id % 4 = kind"""
ORACLES["unprocessed_inputs"] = body(["file_names", "raw_unemployment"], {"i": """
SELECT DISTINCT file_name, CAST(split_part(file_name, '_', 1) AS INT) AS year,
    CAST(replace(split_part(file_name, '_', 2), '.xls', '') AS INT) AS month
  FROM file_names WHERE contains(file_name, '_')"""}, """
SELECT year, month, file_name FROM i WHERE NOT EXISTS (SELECT 1 FROM raw_unemployment r
  WHERE r.month % 2 = 0 AND r.year = i.year AND r.month = i.month)""")
ORACLES["drift_union"] = body(["raw_population"], {}, """
SELECT province_code, cmun, municipality_name, population_total,
  CASE WHEN data_year % 2 = 1 THEN population_male END AS population_male,
  CASE WHEN data_year % 2 = 1 THEN population_female END AS population_female, data_year AS año,
  CASE WHEN data_year % 2 = 0 THEN province_name END AS province_name FROM raw_population""")
ORACLES["drift_load"] = body(["raw_population"], {}, """
SELECT province_code, cmun, nullif(municipality_name, '') AS municipality_name, population_total,
  CASE WHEN data_year % 2 = 0 THEN population_male END AS population_male, data_year,
  'INE' AS data_source FROM raw_population""")
ORACLES["lineage_stamp"] = body(["raw_population"], {}, """
SELECT place_key, data_year, source_file, 'INE' AS data_source,
  'Instituto Nacional de Estadística' AS data_source_full, 'demography' AS data_category,
  'https://www.ine.es/jaxiT3/Tabla.htm?t=2852' AS source_url,
  'Municipal population data by year' AS source_description FROM raw_population""")
ORACLES["csv_roundtrip"] = body(["raw_population"], {}, """
SELECT data_year, count(*) AS n, count(population_total) AS n_total,
  sum(population_total) AS population_total, count(DISTINCT province_code || '/' || cmun) AS places
FROM raw_population GROUP BY 1""")
ORACLES["csv_records"] = body(["remarks"], {
    "t": """SELECT *, o_orderkey % 50 = 7 AS untyped, o_orderkey % 50 = 9 AS short,
  CASE WHEN remark IS NULL THEN '' WHEN o_orderkey % 8 = 4 THEN remark
    ELSE '"' || replace(remark, '"', '""') || '"' END AS cell FROM remarks"""}, """
SELECT CASE WHEN NOT untyped THEN o_orderkey END AS key, CASE WHEN NOT short THEN cents END AS cents,
  CASE WHEN NOT short THEN remark END AS remark,
  CASE WHEN short THEN CAST(o_orderkey AS VARCHAR) WHEN untyped THEN 'no number,' || CAST(cents AS VARCHAR) || ',' || cell
    END AS bad_record FROM t""")
ORACLES["consolidate_month"] = body(["raw_unemployment", "raw_contracts"], {}, """
SELECT 'unemployment' AS data_type, year, month, count(*) AS records, sum(total_unemployment) AS total
FROM raw_unemployment GROUP BY 1, 2, 3
UNION ALL SELECT 'contracts', year, month, count(*), sum(total_contracts)
FROM raw_contracts GROUP BY 1, 2, 3""")
ORACLES["full_refresh"] = body(["raw_population"], {}, """
SELECT data_year, count(*) AS n, sum(population_total) AS population_total
FROM raw_population GROUP BY 1""")
ORACLES["materialize_layers"] = body(POP_NEEDS, CHANGES, """
SELECT data_year, count(*) AS places, CAST(sum(population_change) AS BIGINT) AS population_change
FROM changes GROUP BY 1""")
ORACLES["schema_sync"] = body(POP_NEEDS, POP, """
SELECT province_code, municipality_code, data_year,
  CASE WHEN data_year >= 1999 THEN population_total + 1 ELSE population_total END AS population_total,
  CASE WHEN data_year >= 1999 THEN population_female END AS population_female FROM population""")
ORACLES["stream_new_files"] = """
SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1"""
ORACLES["layer_views"] = body(POP_NEEDS, POP, """
SELECT province_code, data_year, count(*) AS places, CAST(sum(population_total) AS BIGINT) AS population_total
FROM population GROUP BY 1, 2""")
ORACLES["staged_lineage"] = body(list(dict.fromkeys(ALL_NEEDS + CONTR_NEEDS)), {**POP, **UNEMP, **CONTR}, " UNION ALL ".join(
    f"""SELECT '{t}' AS dataset, data_year, {f} AS source_file, '{p}' AS data_source, count(*) AS n, count(*) AS stamped,
  1 AS loads FROM {t} GROUP BY 1, 2, 3""" for t, f, p in (
        ("population", "source_file", "INE"),
        ("unemployment", "data_year || '_' || lpad(CAST(data_month AS VARCHAR), 2, '0') || '_employment.xls'", "SEPE"),
        ("contracts", "data_year || '_' || lpad(CAST(data_month AS VARCHAR), 2, '0') || '_employment.xls'", "SEPE"))))
ORACLES["model_created_at"] = body(ALL_NEEDS, {**mart(0), "core1": mart(1)["core"]}, " UNION ALL ".join(
    f"SELECT '{m}' AS model, count(*) AS n, count(*) AS stamped, 1 AS builds FROM {t}" for m, t in (
        ("yearly", "rollup"), ("population_trends", "trends"), ("rates", "core"), ("socioeconomic", "core1"))))
ORACLES["fuzzy_left_join"] = body(UNEMP_NEEDS, {
    **UNEMP, "names": f"""SELECT DISTINCT upper(trim(municipality_name)) AS source_name, province_code,
    {norm('upper(trim(municipality_name))')} AS nn FROM unemployment
  WHERE coalesce(municipality_code, 0) = 0 AND province_code IS NOT NULL AND trim(municipality_name) <> ''""",
    "dn": f"SELECT *, {norm('municipality_name')} AS dn FROM dictionary",
    "best": """SELECT n.source_name, n.province_code, d.municipality_code AS matched_code,
    CASE WHEN nn = dn THEN 'exact_normalized' WHEN contains(dn, nn) THEN 'substring_match' ELSE 'reverse_substring' END
      AS match_method, CASE WHEN nn = dn THEN 100 WHEN contains(dn, nn) THEN 85 ELSE 80 END AS confidence_score
  FROM names n JOIN dn d ON n.province_code = d.province_code AND (nn = dn OR (contains(dn, nn) AND length(nn) >= 4)
    OR (contains(nn, dn) AND length(dn) >= 4))
  QUALIFY row_number() OVER (PARTITION BY n.source_name, n.province_code ORDER BY confidence_score DESC,
    length(d.municipality_name), d.municipality_code) = 1"""}, """
SELECT u.province_code, data_year, matched_code, b.match_method, b.confidence_score, count(*) AS records FROM unemployment u
LEFT JOIN best b ON upper(trim(u.municipality_name)) = b.source_name AND u.province_code = b.province_code GROUP BY ALL""")
ORACLES["stream_current_state"] = """
SELECT 'rows' AS "of", event_type AS name, count(*) AS n,
  CAST(sum(user_id + CASE WHEN event_id % 10 = 0 THEN 1000000 ELSE 0 END) AS BIGINT) AS total FROM events GROUP BY 2
UNION ALL SELECT 'files', 'new', 3, CAST(count(*) + count(*) FILTER (event_id % 10 = 0) AS BIGINT) FROM events
UNION ALL SELECT 'files', 'redelivered', 1, CAST(count(*) AS BIGINT) FROM events WHERE event_id % 2 = 1"""

# ---- checks --------------------------------------------------------------------

ORACLES["dq_not_null"] = body(UNEMP_NEEDS, UNEMP, """
SELECT municipality_name, province_name, data_year, data_month FROM unemployment
WHERE municipality_code IS NULL""")
ORACLES["dq_unique"] = body(REFS, {}, """
SELECT municipality_code, count(*) AS n_rows FROM dictionary GROUP BY 1 HAVING count(*) > 1""")
ORACLES["dq_unique_combination"] = body(UNEMP_NEEDS, YEARLY, """
SELECT municipality_code, data_year, count(*) AS n_rows FROM rollup GROUP BY 1, 2 HAVING count(*) > 1""")
ORACLES["dq_accepted_values"] = body(UNEMP_NEEDS, YEARLY, """
SELECT province_code, municipality_code, data_year, unemployment_trend FROM rollup
WHERE unemployment_trend IN ('high_increase', 'high_decrease')""")
ORACLES["dq_accepted_range"] = body(UNEMP_NEEDS, UNEMP, """
SELECT province_code, municipality_code, data_year, data_month, men_unemployment_percentage
FROM unemployment WHERE municipality_code IS NOT NULL
  AND men_unemployment_percentage NOT BETWEEN 5 AND 95""")
ORACLES["dq_not_empty"] = body(["raw_population"], {}, """
SELECT province_code, cmun, data_year FROM raw_population WHERE trim(municipality_name) = ''""")
ORACLES["dq_expression"] = body(UNEMP_NEEDS, UNEMP, """
SELECT municipality_name, data_year, data_month, total_unemployment, total_men_unemployment,
  total_women_unemployment FROM unemployment
WHERE total_men_unemployment + total_women_unemployment <> total_unemployment""")
_tests = [("name_not_null", "error", 0, "municipality_name IS NULL"),
          ("community_not_null", "warn", 0, "autonomous_community_code IS NULL"),
          ("population_positive", "error", 0, "total_population < 1"),
          ("growth_in_range", "warn", 10, "population_change_pct NOT BETWEEN -30 AND 30"),
          ("rank_from_one", "error", 0, "population_rank_national < 1"),
          ("trend_values", "error", 0,
           "population_trend NOT IN ('growth', 'decline', 'stable', 'no_data')"),
          ("change_consistent", "error", 0,
           "population_change <> total_population - previous_year_population")]
_counted = " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, '{s}' AS severity, {a} AS allow, count(*) AS violations "
    f"FROM trends WHERE {w}" for n, s, a, w in _tests)
_counted += " UNION ALL ".join(["", *[
    f"SELECT '{n}', '{s}', 0, count(*) FROM (SELECT 1 FROM trends GROUP BY {k} HAVING count(*) > 1) x"
    for n, s, k in [("place_year_unique", "error", "province_code, municipality_code, data_year"),
                    ("code_year_unique", "warn", "municipality_code, data_year")]]])
ORACLES["dq_suite"] = body(POP_NEEDS, {**TRENDS, "counted": _counted}, """
SELECT check_name, severity, violations, CASE WHEN violations <= allow THEN 'pass'
  WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM counted""")


def suite(table: str, tests: list[tuple[str, str, int, str]], key: str = "") -> str:
    """Status rows of (name, severity, allowed, violation) tests on a table."""
    counted = [f"SELECT '{n}' AS check_name, '{s}' AS severity, {a} AS allow, count(*) AS violations "
               f"FROM {table} WHERE {w}" for n, s, a, w in tests]
    if key:
        counted.append(f"SELECT 'key_unique', 'error', 0, count(*) FROM (SELECT 1 FROM {table} "
                       f"GROUP BY {key} HAVING count(*) > 1) x")
    return f"""SELECT check_name, severity, violations, CASE WHEN violations <= allow THEN 'pass'
  WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM ({' UNION ALL '.join(counted)}) c"""


_totals = ["total_unemployment", "total_men_unemployment", "total_women_unemployment"]
ORACLES["dq_suite_unemployment"] = body(UNEMP_NEEDS, UNEMP, suite("unemployment", [
    ("municipality_code_not_null", "warn", 1000, "municipality_code IS NULL"),
    ("municipality_code_range", "error", 0, "municipality_code < 0"),
    *[(f"{c}_not_null", "error", 0, f"{c} IS NULL") for c in (
        "municipality_code_completed", "municipality_name", "province_name", "data_year", "data_month",
        "reporting_date", *_totals)],
    ("municipality_name_not_empty", "error", 0, "trim(municipality_name) = ''"),
    ("province_code_range", "error", 0, "province_code NOT BETWEEN 1 AND 52"),
    ("data_year_range", "error", 0, "data_year NOT BETWEEN 1995 AND 2001"),
    ("data_month_range", "error", 0, "data_month NOT BETWEEN 1 AND 12"),
    *[(f"{c}_range", "error", 0, f"{c} < 0") for c in _totals],
    *[(f"{c}_range", "warn", 1000, f"{c} NOT BETWEEN 0 AND 100") for c in (
        "men_unemployment_percentage", "women_unemployment_percentage")]]))
ORACLES["dq_suite_yearly"] = body(UNEMP_NEEDS, YEARLY, suite("rollup", [
    *[(f"{c}_not_null", "error", 0, f"{c} IS NULL") for c in (
        "municipality_code", "municipality_name", "province_code", "data_year", "months_with_data",
        "primary_total_unemployment", "avg_total_unemployment")],
    ("data_year_range", "error", 0, "data_year NOT BETWEEN 1995 AND 2001"),
    ("months_with_data_range", "error", 0, "months_with_data NOT BETWEEN 1 AND 12"),
    ("primary_total_unemployment_range", "error", 0, "primary_total_unemployment < 0"),
    ("avg_total_unemployment_range", "error", 0, "avg_total_unemployment < 0"),
    ("data_coverage_quality_values", "error", 0,
     "data_coverage_quality NOT IN ('complete', 'partial', 'limited')"),
    ("unemployment_trend_values", "error", 0, "unemployment_trend NOT IN ('high_increase', "
     "'moderate_increase', 'stable', 'moderate_decrease', 'high_decrease', 'no_comparison_data')")],
    "municipality_code, data_year"))
def declared_sql(model: str, table: str, tags: set[str] | None = None) -> str:
    """Status rows of the declared checks of a model, every check a query of its own."""
    def violation(d) -> str:
        c = d.columns[0] if d.columns else ""
        return {"not_null": lambda: f"{c} IS NULL", "not_empty": lambda: f"trim({c}) = ''",
                "range": lambda: " OR ".join(f"{c} {op} {x}" for op, x in zip("<>", d.arguments) if x != ""),
                "values": lambda: f"{c} NOT IN ({', '.join(repr(a) for a in d.arguments)})",
                "expression": lambda: f"NOT ({d.arguments[0]})"}[d.kind]()

    parts = []
    for d in suites.declared(BOUNDS, RATE_YEARS)[model]:
        if tags is None or tags & set(d.tags):
            key = ", ".join(d.columns)
            rows = (f"(SELECT 1 FROM {table} WHERE {' IS NOT NULL AND '.join(d.columns)} IS NOT NULL GROUP BY {key} "
                    "HAVING count(*) > 1) x" if d.kind == "unique" else f"{table} WHERE {violation(d)}")
            parts.append(f"SELECT '{model}' AS model, '{d.name}' AS check_name, '{d.severity}' AS severity, "
                         f"{d.allow} AS allow, count(*) AS violations FROM {rows}")
    return f"""SELECT model, check_name, severity, violations, CASE WHEN violations <= allow THEN 'pass'
  WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM ({' UNION ALL '.join(parts)}) c"""


def _whole(name: str) -> str:
    """An oracle's own text after its WITH clause, as a relation."""
    return f"({ORACLES[name]}) m"


ORACLES["declared_municipalities"] = declared_sql("municipalities", _whole("dim_entities"))
ORACLES["declared_provinces"] = declared_sql("provinces", _whole("dim_provinces"))
ORACLES["declared_population"] = body(POP_NEEDS, POP, declared_sql("population", "population"))
ORACLES["declared_contracts"] = body(CONTR_NEEDS, CONTR, declared_sql("contracts", "contracts"))
ORACLES["declared_population_trends"] = body(POP_NEEDS, TRENDS, declared_sql("population_trends", "trends"))
for _name in ("rates", "socioeconomic"):
    ORACLES[f"declared_{_name}"] = f"WITH marts AS MATERIALIZED ({ORACLES[_name + '_mart']}) " + declared_sql(_name, "marts")
ORACLES["declared_by_tag"] = " UNION ALL ".join(declared_sql(m, t, {"keys", "range"}) for m, t in (
    ("municipalities", _whole("dim_entities")), ("provinces", _whole("dim_provinces")),
    ("population", _whole("stage_population"))))
ORACLES["year_completeness"] = body(POP_NEEDS, {
    **POP, "e": "SELECT CAST(y AS INT) AS y FROM range(1994, 2003) t(y) WHERE y <> 1996",
    "a": "SELECT DISTINCT data_year AS y FROM population"}, """
SELECT 'missing_year' AS issue_type, CAST(y AS VARCHAR) AS year_value,
  'Expected year ' || CAST(y AS VARCHAR) || ' is missing from the dataset' AS error_message
FROM e WHERE y NOT IN (SELECT y FROM a)
UNION ALL SELECT 'unexpected_year', CAST(y AS VARCHAR),
  'Unexpected year ' || CAST(y AS VARCHAR) || ' found in dataset' FROM a WHERE y NOT IN (SELECT y FROM e)""")
ORACLES["count_outliers"] = body(POP_NEEDS, {
    **POP, "c": """SELECT data_year, count(DISTINCT CAST(province_code AS VARCHAR) || '-'
    || CAST(municipality_code AS VARCHAR)) AS n, count(*) AS r FROM population GROUP BY 1""",
    "st": "SELECT avg(n) AS a, stddev_samp(n) AS d FROM c"}, """
SELECT data_year, n AS entity_count, r AS total_records, CAST(round_even(a, 0) AS BIGINT) AS expected_avg,
  CAST(round_even(greatest(a - d, 0), 0) AS BIGINT) AS min_acceptable,
  CAST(round_even(a + d, 0) AS BIGINT) AS max_acceptable,
  CASE WHEN n < greatest(a - d, 0) THEN 'too_few_entities' ELSE 'too_many_entities' END AS issue_type,
  'data_year ' || data_year || CASE WHEN n < greatest(a - d, 0) THEN ' has only ' ELSE ' has ' END || n
    || ' entities (expected ~' || CAST(round_even(a, 0) AS BIGINT) || ')' AS warning_message
FROM c CROSS JOIN st WHERE n < greatest(a - d, 0) OR n > a + d""")
def completeness(table: str, dataset: str) -> tuple[dict[str, str], str]:
    return {"c": f"""SELECT province_name, data_year, count(*) AS n FROM {table}
  WHERE province_name IS NOT NULL GROUP BY 1, 2""",
            "m": "SELECT province_name, quantile_cont(n, 0.5) AS med FROM c GROUP BY 1"}, f"""
SELECT province_name, data_year, n AS record_count, CAST(round_even(med, 0) AS BIGINT) AS expected_records,
  {half_up('n * 200', 'med * 2', 1)} AS completeness_percentage,
  '{dataset} completeness below 99% of expected for ' || province_name || ' in ' || data_year AS issue_description
FROM c JOIN m USING (province_name) WHERE n < med * 0.99 AND med > 20"""


for _name, _needs, _ctes, _args in (("", UNEMP_NEEDS, UNEMP, ("unemployment", "Data")),
                                    ("_contracts", CONTR_NEEDS, CONTR, ("contracts", "Contracts data"))):
    _more, _sql = completeness(*_args)
    ORACLES["group_completeness" + _name] = body(_needs, {**_ctes, **_more}, _sql)


def profile(table: str, test: str) -> str:
    return f"""SELECT '{table}' AS dataset, count(*) AS total_records,
  count(municipality_code) AS records_with_codes,
  count(*) FILTER (WHERE municipality_code_completed) AS codes_completed,
  {pct('count(*) FILTER (WHERE municipality_code_completed)', 'count(*)')} AS code_completion_rate,
  count(*) FILTER (WHERE {test}) AS percentage_issues, count(DISTINCT province_name) AS provinces_covered,
  min(data_year) AS earliest_year, max(data_year) AS latest_year,
  'Data quality of {table}: ' || count(*) FILTER (WHERE municipality_code_completed) || ' codes completed ('
    || coalesce(CAST({pct('count(*) FILTER (WHERE municipality_code_completed)', 'count(*)')} AS VARCHAR), '-') || '%), '
    || count(*) FILTER (WHERE {test}) || ' impossible percentages' AS summary FROM {table}"""


ORACLES["quality_summary"] = body(list(dict.fromkeys(UNEMP_NEEDS + CONTR_NEEDS)), {**UNEMP, **CONTR},
    profile("unemployment", "men_unemployment_percentage > 100 OR women_unemployment_percentage > 100")
    + " UNION ALL "
    + profile("contracts", "men_contracts_percentage > 100 OR women_contracts_percentage > 100 "
                           "OR permanent_contracts_percentage > 100"))
for _name, _needs, _ctes, _table in (("", UNEMP_NEEDS, UNEMP, "unemployment"), ("_contracts", CONTR_NEEDS, CONTR, "contracts")):
    ORACLES["completion_effectiveness" + _name] = body(_needs, _ctes, f"""
SELECT * FROM (SELECT count(*) AS total_records, count(municipality_code) AS records_with_code,
  count(*) FILTER (WHERE municipality_code_completed) AS codes_completed,
  {pct('count(municipality_code)', 'count(*)')} AS code_completeness_rate,
  {pct('count(*) FILTER (WHERE municipality_code_completed)', 'count(*)')} AS completion_rate
FROM {_table}) x WHERE code_completeness_rate < 99.9""")
_side = ("SELECT province_code, municipality_name, min(municipality_code) AS lo, max(municipality_code) AS hi "
         "FROM {} WHERE municipality_code IS NOT NULL {} GROUP BY 1, 2")
ORACLES["mapping_consistency"] = body(list(dict.fromkeys(UNEMP_NEEDS + CONTR_NEEDS)), {
    **UNEMP, **CONTR, "l": _side.format("unemployment", ""),
    "r": _side.format("contracts", "")}, """
SELECT coalesce(l.province_code, r.province_code) AS province_code,
  coalesce(l.municipality_name, r.municipality_name) AS municipality_name, l.lo AS left_code,
  l.hi AS left_last, r.lo AS right_code, r.hi AS right_last
FROM l FULL OUTER JOIN r ON l.municipality_name = r.municipality_name
  AND l.province_code IS NOT DISTINCT FROM r.province_code
WHERE l.lo IS NULL OR r.lo IS NULL OR l.lo <> l.hi OR r.lo <> r.hi OR l.lo <> r.lo""")
ORACLES["dictionary_validation"] = body(["dictionary", "provinces"], {
    "pr": """SELECT * REPLACE (CASE WHEN province_code % 7 = 3 THEN province_code + 100 ELSE province_code END AS province_code)
  FROM provinces""",
    "v": """SELECT NOT EXISTS (SELECT autonomous_community_code FROM dictionary EXCEPT
      SELECT autonomous_community_code FROM pr) AND NOT EXISTS (SELECT autonomous_community_code FROM pr
      EXCEPT SELECT autonomous_community_code FROM dictionary) AS c,
    NOT EXISTS (SELECT province_code FROM dictionary EXCEPT SELECT province_code FROM pr)
      AND NOT EXISTS (SELECT province_code FROM pr EXCEPT SELECT province_code FROM dictionary) AS p,
    (SELECT count(*) FROM (SELECT autonomous_community_code, province_code FROM dictionary EXCEPT
      SELECT autonomous_community_code, province_code FROM pr) x) AS o"""}, """
SELECT c AS autonomous_codes_consistent, p AS province_codes_consistent, o AS orphaned_municipalities,
  (SELECT count(DISTINCT autonomous_community_code) FROM dictionary) AS total_autonomous_communities,
  (SELECT count(DISTINCT province_code) FROM dictionary) AS total_provinces,
  (SELECT count(*) FROM dictionary) AS total_municipalities, c AND p AND o = 0 AS validation_passed,
  CAST(CAST(c AS INT) + CAST(p AS INT) + CAST(o = 0 AS INT) AS VARCHAR) || '/3' AS integrity_score
FROM v""")
ORACLES["dictionary_code_ranges"] = body(["dictionary"], {}, " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(min({c}) AS BIGINT) AS lowest, CAST(max({c}) AS BIGINT) AS highest, "
    f"min({c}) >= {lo} AND max({c}) <= {hi} AS in_range FROM dictionary"
    for c, lo, hi in [("autonomous_community_code", 1, 19), ("province_code", 1, 20), ("check_digit", 0, 9)]))

# ---- dashboard -----------------------------------------------------------------

SELECTION = {**POP, "sel": """SELECT p.*, population_total AS total_population FROM population p
  WHERE data_year IN (1998, 2000, 2001) AND (province_code - 1) % 5 <> 0"""}
ORACLES["dash_recent_top"] = body(POP_NEEDS, CHANGES, """
SELECT province_code, municipality_code, data_year, total_population FROM changes
ORDER BY data_year DESC, total_population DESC NULLS FIRST, province_code, municipality_code LIMIT 1000""")
ORACLES["dash_filter_values"] = body([*POP_NEEDS, "provinces"], CHANGES, """
SELECT DISTINCT 'year' AS filter, CAST(data_year AS VARCHAR) AS value FROM changes
UNION ALL SELECT DISTINCT 'province', province_name FROM provinces""")
ORACLES["dash_filtered"] = body([*POP_NEEDS, "provinces"], CHANGES, """
SELECT c.province_code, municipality_code, data_year, total_population FROM changes c
WHERE data_year = (SELECT max(data_year) FROM changes) AND province_code IN (SELECT province_code
  FROM provinces WHERE province_name IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_15'))""")
ORACLES["dash_kpis"] = body(POP_NEEDS, SELECTION, """
SELECT CAST(sum(total_population) AS BIGINT) AS total_population,
  count(DISTINCT province_code * 100000000000 + municipality_code) AS total_municipalities,
  round(avg(total_population), 0) AS avg_population FROM sel""")
ORACLES["dash_population_by_year"] = body(POP_NEEDS, SELECTION, """
SELECT data_year, CAST(sum(total_population) AS BIGINT) AS total_population FROM sel GROUP BY 1""")
ORACLES["dash_growth"] = body(POP_NEEDS, {**SELECTION, "y": """SELECT data_year,
    CAST(sum(total_population) AS BIGINT) AS t FROM sel GROUP BY 1""",
    "g": "SELECT data_year, t, lag(t) OVER (ORDER BY data_year) AS b FROM y"}, f"""
SELECT data_year, {pct('t - b', 'b', 1)} AS growth_pct FROM g ORDER BY data_year DESC LIMIT 1""")
ORACLES["dash_gender"] = body(POP_NEEDS, SELECTION, """
SELECT 'Male' AS gender, CAST(sum(population_male) AS BIGINT) AS population FROM sel
UNION ALL SELECT 'Female', CAST(sum(population_female) AS BIGINT) FROM sel""")
ORACLES["dash_top10"] = body(POP_NEEDS, {**SELECTION, "top": """SELECT province_code, municipality_code,
    data_year, total_population FROM sel WHERE total_population IS NOT NULL
  ORDER BY total_population DESC, province_code, municipality_code, data_year LIMIT 10"""}, """
SELECT t.*, d.municipality_name FROM top t LEFT JOIN dictionary d
  ON t.province_code = d.province_code AND t.municipality_code = d.municipality_code""")
ORACLES["dash_detail"] = body([*POP_NEEDS, "provinces"], {**SELECTION, "head": """SELECT * EXCLUDE
    (municipality_name, province_name, source_file, population_total) FROM sel
  ORDER BY data_year DESC, province_code, municipality_code LIMIT 100"""}, """
SELECT h.*, d.municipality_name, p.province_name FROM head h LEFT JOIN dictionary d
  ON h.province_code = d.province_code AND h.municipality_code = d.municipality_code
LEFT JOIN provinces p ON h.province_code = p.province_code""")
