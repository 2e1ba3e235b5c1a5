"""Text keys, exact ratios and class ladders at their edges."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from comarca.functions import classes, measures, text


def evaluate(spark, values, schema, fn):
    """Apply a column expression to one-column rows, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {schema}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_normalize_name_folds_and_collapses(spark):
    names = ["Ávila", "L'Alcúdia", " Sta. Cruz ", "SEVILLA", "Coruña (A)", "Sant Adrià", "a  b/c", None]
    assert evaluate(spark, names, "string", text.normalize_name) == [
        "AVILA", "L'ALCUDIA", "STA CRUZ", "SEVILLA", "CORUNA A", "SANT ADRIÀ", "A B C", None]


def test_normalize_name_options(spark):
    full = lambda c: text.normalize_name(c, expand_abbreviations=True, fold_grave=True)
    assert evaluate(spark, ["Sta. Cruz", "S. Juan", "SEVILLA", "N. Sra. del Mar", "Adrià"], "string", full) == [
        "SANTA CRUZ", "SAN JUAN", "SEVILLA", "NUESTRA SENORA DEL MAR", "ADRIA"]


def test_lenient_number(spark):
    cells = ["<5", "> 1 000", "", "-", None, "7.5", "1e2", "5d", "NaN", " 12 ", "-3"]
    assert evaluate(spark, cells, "string", text.lenient_number) == [
        5.0, 0.0, 0.0, 0.0, 0.0, 7.5, 100.0, 0.0, 0.0, 12.0, -3.0]
    with_blanks = lambda c: text.lenient_number(c, drop_blanks=True)
    assert evaluate(spark, cells[:3], "string", with_blanks) == [5.0, 1000.0, 0.0]


def test_codes(spark):
    assert evaluate(spark, ["01", "2.0", "2.5", "x", None], "string", text.text_code) == [1, 2, 3, None, None]
    assert evaluate(spark, ["1", "123", None], "string", lambda c: text.pad_code(c, 2)) == ["01", "123", None]
    assert evaluate(spark, [28079, 79, None], "bigint", lambda c: text.local_code(c, 1000)) == [79, 79, None]


def test_file_names(spark):
    names = ["2021_05_employment.xls", "2021_5.xls", "pobmun96", "pobmun24", "pobmun2003", "x_05", "2021-05"]
    assert evaluate(spark, names, "string", lambda c: text.file_period(c)[0]) == [
        2021, 2021, None, None, None, None, None]
    assert evaluate(spark, names, "string", lambda c: text.file_period(c)[1])[:2] == [5, 5]
    assert evaluate(spark, names, "string", text.two_digit_year) == [
        None, None, 1996, 2024, 2003, None, None]


@pytest.mark.parametrize("label,year,month", [
    ("mayo-2021", 2021, 5), ("2021-03", 2021, 3), ("DICIEMBRE2020", 2020, 12), ("xyz", 2020, 1),
    ("13-2020", 2020, 1), ("datos de junio", None, 6), ("99", 2020, 1)])
def test_month_number(spark, label, year, month):
    df = spark.createDataFrame([(label, year)], "label string, y int")
    assert df.select(text.month_number(F.col("label"), F.col("y"))).first()[0] == month


def test_headers(spark):
    spelled = ["pob98", "Codigo municipio", "NOMBRE", "CPRO", "Provincia", "CMUN", "Varones", "Mujeres",
               "Ambos sexos", "Nombre provincia", "Isla", "1 a.m./(%)", " ", None]
    assert evaluate(spark, spelled, "string", text.canonical_header) == [
        "population_total", "municipality_code", "municipality_name", "province_code", "province_name",
        "cmun", "population_male", "population_female", "population_total", "municipality_name", "island",
        "col_1_am_", None, None]


def test_sheet_names(spark):
    sheets = ["PARO A CORUÑA", "PARO LA CORUÑA", "CONTRTOS LUGO", "PORTADA", "RESUMEN", " PARO JAEN "]
    df = spark.createDataFrame([(s,) for s in sheets], "s string")
    kind, province = text.sheet_type_and_province(F.col("s"))
    assert [tuple(r) for r in df.select(kind, province).collect()] == [
        ("unemployment", "CORUÑA"), ("unemployment", "LA CORUÑA"), ("contracts", "LUGO"),
        ("ignored", "PORTADA"), ("unknown", "RESUMEN"), ("unemployment", "JAEN")]


def test_half_up_equals_decimal_rounding(spark):
    rng = random.Random(1)
    pairs = [(201, 20000), (-5, 2), (5, 2), (1, 8), (-1, 8), (0, 3), (7, 0), (3, -2), (None, 3)]
    pairs += [(rng.randint(-10 ** 9, 10 ** 9), rng.randint(1, 10 ** 6)) for _ in range(300)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a bigint, b bigint")
    for scale in (0, 1, 2):
        got = [r.x for r in df.select("i", measures.half_up(F.col("a"), F.col("b"), scale).alias("x"))
               .orderBy("i").collect()]
        for (a, b), x in zip(pairs, got):
            if a is None or b <= 0:
                assert x is None
            else:
                exact = (Decimal(a) / Decimal(b)).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)
                assert x == float(exact), (a, b, scale)


def test_pct_and_non_negative(spark):
    df = spark.createDataFrame([(201, 20000)], "a int, b int")
    assert df.select(measures.pct(F.col("a"), F.col("b"))).first()[0] == 1.01
    assert evaluate(spark, [2.5, 3.5, -1.0, None, 0.0], "double", measures.non_negative) == [2, 4, None, None, 0]


@pytest.mark.parametrize("fn,values,labels", [
    (classes.coverage, [12.0, 11.0, 10.0, 6.0, 5.0, None],
     ["complete", "complete", "partial", "partial", "limited", "limited"]),
    (classes.unemployment_trend, [None, 10.01, 10.0, 2.01, 2.0, -1.99, -2.0, -9.99, -10.0],
     ["no_comparison_data", "high_increase", "moderate_increase", "moderate_increase", "stable", "stable",
      "moderate_decrease", "moderate_decrease", "high_decrease"]),
    (classes.population_trend, [1.0, 0.0, -1.0, None], ["growth", "stable", "decline", "no_data"]),
    (classes.population_magnitude, [5.0, 4.99, 1.0, 0.99, -0.99, -1.0, -4.99, -5.0, None],
     ["high_growth", "moderate_growth", "moderate_growth", "stable", "stable", "moderate_decline",
      "moderate_decline", "high_decline", "no_data"]),
    (lambda c: classes.unemployment_level(c, "none"), [4.99, 5.0, 10.0, 19.99, 20.0, None],
     ["low_unemployment", "moderate_unemployment", "high_unemployment", "high_unemployment",
      "very_high_unemployment", "none"])])
def test_ladders(spark, fn, values, labels):
    assert evaluate(spark, values, "double", fn) == labels


def test_two_variable_classes(spark):
    data = [(7.0, 2.0), (11.0, 0.5), (16.0, -3.0), (21.0, -6.0), (13.0, 0.0), (None, 1.0), (7.0, None)]
    df = spark.createDataFrame(data, "r double, p double")
    r, p = F.col("r"), F.col("p")
    got = [tuple(x) for x in df.select(classes.health(r, p), classes.health(r, p, strict=True)).collect()]
    assert [g[0] for g in got] == ["thriving", "growing", "struggling", "struggling", "stable", "stable", "stable"]
    assert [g[1] for g in got] == ["thriving", "growing", "struggling", "critical", "stable", "stable", "stable"]
    data = [(11.0, -1.0), (11.0, -6.0), (-11.0, 3.0), (11.0, -3.0), (None, 1.0)]
    df = spark.createDataFrame(data, "u double, p double")
    assert [x[0] for x in df.select(classes.resilience(F.col("u"), F.col("p"))).collect()] == [
        "resilient", "exodus", "attractive", "stable", None]
    data = [(1.0, -1.0), (-1.0, 1.0), (1.0, 1.0), (-1.0, -1.0), (0.0, 1.0), (None, 1.0)]
    df = spark.createDataFrame(data, "p double, u double")
    both = df.select(classes.sign_quadrant(F.col("p"), F.col("u")),
                     classes.sign_quadrant(F.col("p"), F.col("u"), "stable")).collect()
    assert [x[0] for x in both] == ["positive_growth", "economic_decline", "growing_with_challenges",
                                    "declining_but_improving", "stable", None]
    assert both[-1][1] == "stable"
