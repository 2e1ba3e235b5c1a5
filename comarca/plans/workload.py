"""Statistics-shaped input derived from the driver tables.

Suppliers play the municipalities, nations the provinces, regions the communities,
and shipped quantities the monthly counts.  Each relation is one SQL text that Spark
runs over the parquet tables; the same text feeds the oracle, whose queries on top
of it are written on their own.  ``{name}`` stands for a driver table, ``@name`` for
another relation of this file.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from comarca.operators.grid import Vintages
from comarca.plans.staging import Bounds

CODE_BASE = 10_000_000_000
BOUNDS = Bounds(employment_years=(1995, 2001), population_years=(1995, 2001), code_base=CODE_BASE)
VINTAGES = Vintages(wide_last=1995, old_last=1997)
RATE_YEARS = (1996, 2001)
BLOCK = 40  # places per sheet


def _measures(spec: str) -> str:
    """Conditional sums: ``name: condition`` per line, of the value {v}."""
    lines = [line.strip().split(": ") for line in spec.strip().splitlines()]
    return ",\n  ".join(f"sum(CASE WHEN {cond} THEN @v ELSE 0 END) AS {name}" for name, cond in lines)


UNEMPLOYMENT = _measures("""
men_under_25: l_linestatus = 'F' AND l_returnflag = 'A'
men_25_44: l_linestatus = 'F' AND l_returnflag = 'N'
men_45_plus: l_linestatus = 'F' AND l_returnflag = 'R'
women_under_25: l_linestatus = 'O' AND l_returnflag = 'A'
women_25_44: l_linestatus = 'O' AND l_returnflag = 'N'
women_45_plus: l_linestatus = 'O' AND l_returnflag = 'R'
agriculture_sector: l_partkey % 5 = 0
industry_sector: l_partkey % 5 = 1
construction_sector: l_partkey % 5 = 2
services_sector: l_partkey % 5 = 3
no_previous_employment: l_partkey % 5 = 4
""").replace("@v", "l_quantity")
CONTRACT_CONDITIONS = """
men_indefinite_initial: l_linestatus = 'F' AND l_returnflag = 'A'
men_temporary_initial: l_linestatus = 'F' AND l_returnflag = 'N'
men_indefinite_conversion: l_linestatus = 'F' AND l_returnflag = 'R'
women_indefinite_initial: l_linestatus = 'O' AND l_returnflag = 'A'
women_temporary_initial: l_linestatus = 'O' AND l_returnflag = 'N'
women_indefinite_conversion: l_linestatus = 'O' AND l_returnflag = 'R'
agriculture_sector: l_partkey % 4 = 0
industry_sector: l_partkey % 4 = 1
construction_sector: l_partkey % 4 = 2
services_sector: l_partkey % 4 = 3
"""
CONTRACTS = _measures(CONTRACT_CONDITIONS).replace("@v", "1.0")

MONTH_KEY = ("l_suppkey AS place_key, CAST(year(l_shipdate) AS INT) AS year, "
             "CAST(month(l_shipdate) AS INT) AS month")

# old sheets carry no code and spell names their own way; some places keep a code of
# null later on, some totals are negative or missing
OLD_NAME = """CASE
    WHEN m.year > 1997 THEN p.municipality_name
    WHEN m.place_key % 31 = 7 THEN p.municipality_name || ' bis'
    WHEN m.place_key % 31 = 9 THEN substring(lower(p.municipality_name), 6)
    WHEN m.place_key % 3 = 0
      THEN '  ' || replace(replace(lower(p.municipality_name), '-', '/'), 'i', 'í') || ' '
    ELSE lower(p.municipality_name) END"""
CODE = """CASE WHEN m.year <= 1997 THEN 0
    WHEN m.place_key % 29 = 3 THEN NULL ELSE p.national_code END"""
PROVINCE = """CASE WHEN m.place_key % 4 = 0 THEN ' ' || lower(p.province_name)
    WHEN m.place_key % 2 = 1 THEN replace(p.province_name, '_', ' ')
    ELSE p.province_name END"""
FILE = "CAST(m.year AS STRING) || '_' || lpad(CAST(m.month AS STRING), 2, '0') || '_employment.xls'"


def _text(column: str) -> str:
    return f"CAST(CAST({column} AS BIGINT) AS STRING)"


def _grid(raw: str, label: str, total: str, parts: list[str], sheet_offset: int) -> str:
    """Sheets of up to 40 places with title, blank, heading and province rows."""
    cells = "".join(f", {_text('m.' + c)} AS c{i}" for i, c in enumerate(parts, start=3))
    blank = "".join(f", CAST(NULL AS STRING) AS c{i}" for i in range(3, 3 + len(parts)))

    def heading(row: int, c1: str, c2: str = "NULL") -> str:
        return (f"SELECT source_file, sheet_no, sheet, year, {row} AS row_idx, "
                f"CAST(NULL AS STRING) AS c0, {c1} AS c1, CAST({c2} AS STRING) AS c2{blank} FROM heads")

    def sheets(extra: int, dot: str, where: str) -> str:
        return f"""SELECT CAST(m.year AS STRING) || '_' || lpad(CAST(m.month AS STRING), 2, '0') || '_'
      || CAST(CAST(floor(m.place_key / 1000) AS BIGINT) AS STRING) || '.xls' AS source_file,
    CAST(2 * n.n_nationkey + {sheet_offset} + 100 * {extra} AS INT) AS sheet_no,
    '{label} ' || n.n_name || '{dot}' AS sheet, m.year,
    CAST(4 + m.place_key % {BLOCK} AS INT) AS row_idx,
    CASE WHEN m.year <= 1997 THEN NULL WHEN m.place_key % 37 = 36 THEN 'n/a'
      ELSE CAST(m.national_code AS STRING) END AS c0,
    CASE WHEN m.year <= 1997 AND m.place_key % {BLOCK} = 39 THEN 'TOTAL ' || n.n_name
      WHEN m.year <= 1997 AND m.place_key % {BLOCK} = 38 THEN 'Abc'
      WHEN m.year <= 1997 AND m.place_key % {BLOCK} = 37 THEN n.n_name
      ELSE m.municipality_name END AS c1,
    CASE WHEN m.place_key % 17 = 3 THEN '<' || {_text('m.' + total)}
      WHEN m.place_key % 17 = 5 THEN '' WHEN m.place_key % 17 = 7 THEN '-'
      ELSE CAST(CAST(m.{total} AS BIGINT) + {extra} AS STRING) END AS c2{cells}
  FROM @{raw} m JOIN {{nation}} n
    ON CAST(floor(m.place_key / {BLOCK}) AS BIGINT) % 25 = n.n_nationkey{where}"""

    return f"""WITH body AS ({sheets(0, '', '')} UNION ALL {sheets(1, '.', ' WHERE n.n_nationkey % 10 = 2')}),
  heads AS (SELECT DISTINCT source_file, sheet_no, sheet, year FROM body)
  SELECT * FROM body
  UNION ALL {heading(0, "'PARO REGISTRADO SEGÚN SEXO'")}
  UNION ALL {heading(1, "CAST(NULL AS STRING)")}
  UNION ALL {heading(2, "'MUNICIPIOS'", "'TOTAL'")}
  UNION ALL {heading(3, "'PROVINCIA'")}"""


UNEMPLOYMENT_PARTS = ["men_under_25", "men_25_44", "men_45_plus", "women_under_25", "women_25_44",
                      "women_45_plus", "agriculture_sector", "industry_sector",
                      "construction_sector", "services_sector", "no_previous_employment"]
CONTRACT_PARTS = ["men_indefinite_initial", "men_temporary_initial", "men_indefinite_conversion",
                  "women_indefinite_initial", "women_temporary_initial",
                  "women_indefinite_conversion", "agriculture_sector", "industry_sector",
                  "construction_sector", "services_sector"]

RELATIONS: dict[str, str] = {
    "provinces": """SELECT CAST(r_regionkey + 1 AS INT) AS autonomous_community_code,
    r_name AS autonomous_community_name, CAST(n_nationkey + 1 AS INT) AS province_code,
    n_name AS province_name
  FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "aliases": "SELECT replace(n_name, '_', ' ') AS alias, n_name AS name FROM {nation}",
    # the code is unique within the province only, as official codes are
    "places": f"""SELECT s_suppkey AS place_key, p.autonomous_community_code, p.province_code,
    p.province_name, CAST(s_suppkey - s_nationkey + 25 AS BIGINT) AS municipality_code,
    CAST(p.province_code AS BIGINT) * {CODE_BASE}
      + CAST(s_suppkey - s_nationkey + 25 AS BIGINT) AS national_code,
    CAST(s_suppkey % 10 AS INT) AS check_digit, replace(s_name, '#', '-') AS municipality_name
  FROM {{supplier}} JOIN @provinces p ON s_nationkey + 1 = p.province_code""",
    "dictionary": """SELECT autonomous_community_code, province_code, municipality_code, check_digit,
    municipality_name FROM @places""",
    # the dictionary as its sheet has it: texts, padded codes, and some that do not fit
    "dictionary_sheet": """SELECT place_key, lpad(CAST(autonomous_community_code AS STRING), 2, '0') AS codauto,
    CASE WHEN place_key % 23 = 4 THEN 'x' || CAST(province_code AS STRING) WHEN place_key % 29 = 6 THEN '77'
      ELSE ' ' || lpad(CAST(province_code AS STRING), 2, '0') END AS cpro,
    CASE WHEN place_key % 19 = 3 THEN CAST(municipality_code AS STRING) || '.5' WHEN place_key % 2 = 1
      THEN CAST(municipality_code AS STRING) || '.0' ELSE CAST(municipality_code AS STRING) END AS cmun,
    CASE WHEN place_key % 31 = 5 THEN NULL WHEN place_key % 37 = 8 THEN '' ELSE CAST(check_digit AS STRING) END AS dc,
    CASE WHEN place_key % 41 = 9 THEN '  ' ELSE '  ' || municipality_name || ' ' END AS nombre
  FROM @places""",
    "monthly_quantity": f"SELECT {MONTH_KEY}, sum(l_quantity) AS total_unemployment,\n  {UNEMPLOYMENT} "
                        "FROM {lineitem} GROUP BY 1, 2, 3",
    "monthly_count": f"SELECT {MONTH_KEY}, CAST(count(*) AS DOUBLE) AS total_contracts,\n  {CONTRACTS} "
                     "FROM {lineitem} GROUP BY 1, 2, 3",
    "raw_unemployment": f"""SELECT m.place_key, CAST({CODE} AS BIGINT) AS municipality_code,
    p.national_code, {OLD_NAME} AS municipality_name,
    CASE WHEN m.place_key % 43 = 11 AND m.year = 1999 THEN -m.total_unemployment
      WHEN m.place_key % 47 = 13 AND m.year = 2000 AND m.month <= 6 THEN NULL
      ELSE m.total_unemployment END AS total_unemployment,
    CASE WHEN m.place_key % 53 = 1 AND m.year = 1996 THEN -1.0 ELSE m.men_under_25 END AS men_under_25,
    {', '.join('m.' + c for c in UNEMPLOYMENT_PARTS[1:])},
    {PROVINCE} AS province, m.year, m.month, {FILE} AS source_file
  FROM @monthly_quantity m JOIN @places p ON m.place_key = p.place_key""",
    "raw_contracts": f"""SELECT m.place_key, CAST({CODE} AS BIGINT) AS municipality_code,
    p.national_code, {OLD_NAME} AS municipality_name, m.total_contracts,
    {', '.join(f'CAST(m.{c} AS DOUBLE) AS {c}' for c in CONTRACT_PARTS)},
    {PROVINCE} AS province, m.year, m.month, {FILE} AS source_file
  FROM @monthly_count m JOIN @places p ON m.place_key = p.place_key""",
    "yearly_quantity": """SELECT l_suppkey AS place_key, CAST(year(l_shipdate) AS INT) AS data_year,
    sum(l_quantity) AS t, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS m,
    sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS f
  FROM {lineitem} GROUP BY 1, 2""",
    "raw_population": """SELECT p.place_key, lpad(CAST(p.province_code AS STRING), 2, '0') AS province_code,
    p.province_name, CAST(p.municipality_code AS STRING) || '.0' AS cmun,
    CASE WHEN y.place_key % 59 = 2 AND data_year = 1997 THEN NULL
      WHEN y.place_key % 61 = 4 AND data_year = 1998 THEN ''
      ELSE p.municipality_name END AS municipality_name,
    CASE WHEN y.place_key % 37 = 5 AND data_year = 1996 THEN NULL
      WHEN y.place_key % 41 = 7 AND data_year = 1998 THEN -t ELSE t END AS population_total,
    m AS population_male, f AS population_female, data_year,
    'pobmun' || substring(CAST(data_year AS STRING), 3, 2) AS source_file
  FROM @yearly_quantity y JOIN @places p ON y.place_key = p.place_key""",
    "grid_unemployment": _grid("raw_unemployment", "PARO", "total_unemployment", UNEMPLOYMENT_PARTS, 0),
    "grid_contracts": _grid("raw_contracts", "CONTRATOS", "total_contracts", CONTRACT_PARTS, 1),
    # population files name their columns differently every other year
    "grid_population": f"""WITH body AS (
    SELECT source_file || '_' || CAST(CAST(floor(place_key / {BLOCK}) AS BIGINT) AS STRING) AS source_file,
      data_year, CAST(3 + place_key % {BLOCK} AS INT) AS row_idx,
      CASE WHEN place_key % {BLOCK} = 39 THEN 'Total' ELSE province_code END AS c0,
      province_name AS c1, cmun AS c2, municipality_name AS c3,
      CASE WHEN population_total % 13 = 2 THEN 'n.d.' ELSE {_text('population_total')} END AS c4,
      {_text('population_male')} AS c5, {_text('population_female')} AS c6
    FROM @raw_population),
  heads AS (SELECT DISTINCT source_file, data_year FROM body),
  none AS (SELECT source_file, data_year, CAST(NULL AS STRING) AS c FROM heads)
  SELECT source_file, 0 AS sheet_no, 'pob' AS sheet, row_idx, c0, c1, c2, c3, c4, c5, c6 FROM body
  UNION ALL SELECT source_file, 0, 'pob', 0, 'Cifras de poblacion', c, c, c, c, c, c FROM none
  UNION ALL SELECT source_file, 0, 'pob', 1, 'CPRO', 'Provincia', 'CMUN', 'NOMBRE',
    'POB' || substring(CAST(data_year AS STRING), 3, 2), 'Varones', 'Mujeres'
    FROM heads WHERE data_year % 2 = 1
  UNION ALL SELECT source_file, 0, 'pob', 1, 'Padron', '1 enero', c, c, c, c, c
    FROM none WHERE data_year % 2 = 0
  UNION ALL SELECT source_file, 0, 'pob', 2, 'Cod_prov', 'PROVINCIA', 'CMUN', 'Nombre municipio',
    'Total', 'Mujeres', 'Hombres'
    FROM heads WHERE data_year % 2 = 0""",
    "file_names": """SELECT o_orderkey, CASE CAST(o_orderkey % 5 AS INT)
      WHEN 0 THEN CAST(year(o_orderdate) AS STRING) || '_' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')
        || '_employment.xls'
      WHEN 1 THEN CAST(year(o_orderdate) AS STRING) || '_' || CAST(month(o_orderdate) AS STRING) || '.xls'
      WHEN 2 THEN 'pobmun' || substring(CAST(year(o_orderdate) AS STRING), 3, 2)
      WHEN 3 THEN 'pobmun' || CAST(year(o_orderdate) AS STRING)
      ELSE 'summary-' || CAST(year(o_orderdate) AS STRING) || '.xls' END AS file_name
  FROM {orders}""",
    "month_labels": """SELECT CAST(year(o_orderdate) AS INT) AS label_year, CASE CAST(o_orderkey % 6 AS INT)
      WHEN 0 THEN mes || '-' || CAST(year(o_orderdate) AS STRING)
      WHEN 1 THEN CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')
      WHEN 2 THEN 'datos de ' || upper(mes)
      WHEN 3 THEN CAST(CAST(12 + o_orderkey % 3 AS INT) AS STRING) || 'x'
      WHEN 4 THEN mes || CAST(year(o_orderdate) AS STRING)
      ELSE 'avance' END AS label
  FROM (SELECT *, CASE CAST(month(o_orderdate) AS INT) WHEN 1 THEN 'Enero' WHEN 2 THEN 'febrero'
      WHEN 3 THEN 'marzo' WHEN 4 THEN 'abril' WHEN 5 THEN 'mayo' WHEN 6 THEN 'junio' WHEN 7 THEN 'Julio'
      WHEN 8 THEN 'agosto' WHEN 9 THEN 'septiembre' WHEN 10 THEN 'octubre' WHEN 11 THEN 'noviembre'
      ELSE 'diciembre' END AS mes FROM {orders}) o""",
    # fetched pages with the links, attachments and table of a statistics site
    "stat_pages": """SELECT page_id, url, html
      || '<a href="/stats/municipios/' || CAST(2005 + page_id % 20 AS STRING) || '/mes-'
      || lpad(CAST(page_id % 12 + 1 AS STRING), 2, '0') || '-' || CAST(page_id % 7 AS STRING) || '.html">m</a>'
      || CASE CAST(page_id % 5 AS INT)
        WHEN 0 THEN '<a href="/d/a' || CAST(page_id AS STRING) || '.xls">x</a><p>Libro Completo</p><a href="/d/b'
          || CAST(page_id AS STRING) || '.xlsx?v=1">y</a>'
        WHEN 1 THEN '<a href="d/c' || CAST(page_id AS STRING) || '.xls">x</a>'
        WHEN 2 THEN '<a href="https://files.example.org/e' || CAST(page_id AS STRING)
          || '.xlsx">x</a><p>libro completo</p>'
        WHEN 3 THEN '<p>libro completo</p>' ELSE '' END
      || '<table class="t"><tr><th>CODAUTO</th><th> Nombre </th></tr><tr></tr><tr><td><b>'
      || CAST(page_id % 19 AS STRING) || '</b></td><td> ' || url
      || ' </td></tr><TR><td>x</td><td></td></TR></table>' AS html
  FROM {pages}""",
    # pages with what trips up readers of tags: comments, scripts, brackets in attributes, open and nested tables
    "odd_pages": """SELECT page_id, CASE WHEN page_id % 5 = 1 THEN html ELSE '' END || '<!-- <a href="no.xls">x</a><table><tr><td>no</td></tr></table> --><script>if (a<b) '
      || 's = ''<a href="no.xls"><table>'';</script><p title="a>b <a href=''no.xls''>">p</p><a title="1>0" href="/n/'
      || CAST(page_id AS STRING) || '.html?a=1&amp;b=&#8364;&uuml;">x</a>'
      || CASE WHEN page_id % 3 = 0 THEN '<a data-href="no.xls" HREF = /m/bare.xls>y</a>' ELSE '' END
      || '<TABLE class="a>b"><tr><th colspan="2">wide<th>last' || CASE CAST(page_id % 4 AS INT)
        WHEN 0 THEN '<tr><td>&#x2013;<td><table><tr><td>in<td>ner</table><td>c'
        WHEN 1 THEN '<tr><td>a</td> no <td colspan=2>b&nbsp;c</td></tr></table><table><tr><td>second</td></tr></table>'
        WHEN 2 THEN '<tr></tr><tr><td>1 < 2<!-- no --></td><td>&Ntilde;&notaname;</td>'
        ELSE '<tr><td colspan=0>x<td></table><p>no' END AS html
  FROM {pages}""",
    # order remarks whose cells hold separators, quotes and line breaks
    "remarks": """SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CASE CAST(o_orderkey % 8 AS INT)
      WHEN 0 THEN o_orderpriority || chr(10) || o_orderstatus WHEN 1 THEN o_orderpriority || ', "' || o_orderstatus || '"'
      WHEN 2 THEN NULL WHEN 3 THEN '"' || chr(10) || chr(10) || ',' WHEN 4 THEN o_orderstatus || ' 5" x'
      ELSE o_orderpriority END AS remark
  FROM {orders}""",
    "headers": """SELECT p_partkey, CAST(floor(p_partkey / 12) AS BIGINT) AS file_no,
    CAST(p_partkey % 12 AS INT) AS pos, CASE CAST(p_partkey % 23 AS INT)
      WHEN 0 THEN 'CPRO' WHEN 1 THEN 'pob' || lpad(CAST(p_size AS STRING), 2, '0')
      WHEN 2 THEN 'Codigo municipio' WHEN 3 THEN ' NOMBRE' WHEN 4 THEN 'Varones' WHEN 5 THEN 'Mujeres '
      WHEN 6 THEN 'CMUN' WHEN 7 THEN 'Cod. municipio' WHEN 8 THEN 'Nombre provincia'
      WHEN 9 THEN 'province' WHEN 10 THEN 'Ambos sexos' WHEN 11 THEN 'Isla' WHEN 12 THEN ''
      WHEN 13 THEN 'Comunidad autonoma' WHEN 14 THEN CAST(p_size AS STRING) || ' a.m./(%)'
      WHEN 15 THEN '()' WHEN 16 THEN 'Provincia' ELSE p_name || ' - ' || p_brand || '/' || p_type
      END AS header
  FROM {part}""",
    "sheet_names": """SELECT c_custkey, CASE CAST(c_custkey % 11 AS INT)
      WHEN 0 THEN 'PARO A CORUÑA' WHEN 1 THEN 'CONTRTOS LUGO' WHEN 2 THEN 'PORTADA'
      WHEN 3 THEN 'CONTRATOS STA. CRUZ TENER.' WHEN 4 THEN ' PARO ' || c_mktsegment || ' '
      WHEN 5 THEN 'PARO LA CORUÑA' WHEN 6 THEN 'Indice' WHEN 7 THEN 'CONTRATOS CORUÑA A'
      WHEN 8 THEN 'RESUMEN ' || c_mktsegment
      ELSE 'CONTRATOS ' || replace(n_name, '_', ' ') END AS sheet
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "cell_texts": """SELECT l_orderkey, CASE CAST((l_orderkey + l_linenumber) % 9 AS INT)
      WHEN 0 THEN '<5' WHEN 1 THEN '> 1 000' WHEN 2 THEN '' WHEN 3 THEN '-' WHEN 4 THEN NULL
      WHEN 5 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) || '.5'
      WHEN 6 THEN ' ' || CAST(l_partkey AS STRING) WHEN 7 THEN '1 ' || CAST(l_linenumber AS STRING)
      ELSE '<' || CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS cell
  FROM {lineitem}""",
    "code_rows": """SELECT c_custkey, c_nationkey, CAST(floor(c_custkey / 25) AS BIGINT) AS file_no,
    CASE WHEN c_custkey % 17 = 4 THEN NULL WHEN c_custkey % 13 = 3 THEN c_mktsegment || ' total'
      ELSE CAST(c_nationkey AS STRING) END AS province_code,
    CASE WHEN c_custkey % 19 = 6 THEN NULL ELSE CAST(c_custkey * 37 AS STRING) END AS municipality_code,
    CASE WHEN floor(c_custkey / 25) % 3 = 0 THEN c_mktsegment
      WHEN c_custkey % 5 = 2 THEN NULL ELSE CAST(c_nationkey AS STRING) END AS province,
    CASE WHEN c_custkey % 29 = 1 THEN 'Suma ' || c_name ELSE c_name END AS label,
    CAST(NULL AS STRING) AS notes
  FROM {customer}""",
}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _needed(name: str, seen: list[str]) -> list[str]:
    for inner in re.findall(r"@(\w+)", RELATIONS[name]):
        if inner not in seen:
            _needed(inner, seen)
    if name not in seen:
        seen.append(name)
    return seen


def with_clause(*names: str) -> str:
    """``WITH ...`` text that defines the named relations and all they need."""
    order: list[str] = []
    for name in names:
        _needed(name, order)
    return "WITH " + ",\n".join(f"{n} AS ({RELATIONS[n].replace('@', '')})" for n in order)


def oracle_with(*names: str) -> str:
    """The same text over tables that carry their plain names."""
    text = with_clause(*names)
    return text.format(**{t: t for t in TABLES})


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is looked up once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def monthly_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relation ``monthly_count`` as a Spark job that counts in whole numbers: its text adds up
    decimals, an object per row and measure."""
    lines = [line.split(": ") for line in CONTRACT_CONDITIONS.strip().splitlines()]
    return (table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_suppkey").alias("place_key"), F.year("l_shipdate").alias("year"),
                     F.month("l_shipdate").alias("month"))
            .agg(F.count(F.lit(1)).cast("double").alias("total_contracts"),
                 *[F.count_if(F.expr(condition)).alias(name) for name, condition in lines]))


JOBS = {"monthly_count": monthly_count}


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = f"{with_clause(name)}\nSELECT * FROM {name}"
    for job in JOBS:
        text = text.replace(RELATIONS[job], f"SELECT * FROM {{{job}}}")
    used = sorted(set(re.findall(r"\{(\w+)\}", text)))
    return spark.sql(text, **{t: JOBS[t](spark, sf_dir) if t in JOBS else table(spark, sf_dir, t) for t in used})


HEADINGS = [(0, "PARO REGISTRADO SEGÚN SEXO", None), (1, None, None),
            (2, "MUNICIPIOS", "TOTAL"), (3, "PROVINCIA", None)]


def employment_sheets(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The grid relation ``grid_<kind>`` as a Spark job: one pass for the rows, one
    distinct for the heading rows of every sheet."""
    label, parts, offset = {"unemployment": ("PARO ", UNEMPLOYMENT_PARTS, 0),
                            "contracts": ("CONTRATOS ", CONTRACT_PARTS, 1)}[kind]
    key, year, nation = F.col("place_key"), F.col("year"), F.col("n_name")
    digits = lambda c: F.col(c).cast("bigint").cast("string")
    rows = derive(spark, sf_dir, f"raw_{kind}").withColumn(
        "n_nationkey", (F.floor(key / BLOCK) % 25).cast("int"))
    rows = rows.join(table(spark, sf_dir, "nation").drop("n_regionkey"), "n_nationkey")
    old, at = year <= VINTAGES.old_last, key % BLOCK
    total = F.col(f"total_{kind}")
    once, again = F.lit(0), F.lit(1)
    issue = F.explode(F.when(F.col("n_nationkey") % 10 == 2, F.array(once, again))
                      .otherwise(F.array(once)))
    rows = rows.withColumns({"volume": F.floor(key / 1000), "issue": issue})
    sheet = [F.concat_ws("_", year, F.lpad(F.col("month").cast("string"), 2, "0"),
                         F.concat(F.col("volume").cast("string"), F.lit(".xls"))).alias("source_file"),
             (F.col("n_nationkey") * 2 + offset + F.col("issue") * 100).cast("int").alias("sheet_no"),
             F.concat(F.lit(label), nation, F.when(F.col("issue") == 1, ".").otherwise("")).alias("sheet"),
             year.alias("year")]
    body = rows.select(
        *sheet, (at + 4).cast("int").alias("row_idx"),
        F.when(old, None).when(key % 37 == 36, "n/a")
         .otherwise(F.col("national_code").cast("string")).alias("c0"),
        F.when(old & (at == 39), F.concat(F.lit("TOTAL "), nation)).when(old & (at == 38), "Abc")
         .when(old & (at == 37), nation).otherwise(F.col("municipality_name")).alias("c1"),
        F.when(key % 17 == 3, F.concat(F.lit("<"), digits(f"total_{kind}")))
         .when(key % 17 == 5, "").when(key % 17 == 7, "-")
         .otherwise((total.cast("bigint") + F.col("issue")).cast("string")).alias("c2"),
        *[digits(c).alias(f"c{i}") for i, c in enumerate(parts, start=3)])
    cells = [f"c{i}" for i in range(3 + len(parts))]
    heading = F.array(*[F.struct(F.lit(r).alias("row_idx"), F.lit(a).cast("string").alias("c1"),
                                 F.lit(b).cast("string").alias("c2")) for r, a, b in HEADINGS])
    # the texts that name a sheet are made once per sheet
    heads = (rows.select("year", "month", "volume", "n_nationkey", "n_name", "issue").distinct()
             .select(*sheet).distinct().select("*", F.inline(heading))
             .withColumns({c: F.lit(None).cast("string") for c in cells if c not in ("c1", "c2")}))
    return body.unionByName(heads)


def as_cells(columns: list[str]) -> Column:
    """Cells of a grid row; blank text is an empty cell."""
    return F.array(*[F.nullif(F.col(c), F.lit("")) for c in columns])


def grid(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Grid rows of one kind of sheet, in the widths of their vintage."""
    if kind == "population":
        rows = derive(spark, sf_dir, "grid_population")
    else:
        rows = employment_sheets(spark, sf_dir, kind)
    columns = sorted([c for c in rows.columns if c[0] == "c" and c[1:].isdigit()],
                     key=lambda c: int(c[1:]))
    cells = as_cells(columns)
    if kind == "unemployment":  # the oldest sheets have three more columns
        extra = F.array(*[F.lit("x")] * 3)
        cells = F.when(F.col("year") <= VINTAGES.wide_last, F.concat(cells, extra)).otherwise(cells)
    return rows.select("source_file", "sheet_no", "sheet", "row_idx", cells.alias("cells"))


def employment_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = [grid(spark, sf_dir, k) for k in ("unemployment", "contracts")]
    return reduce(DataFrame.unionByName, kinds)
