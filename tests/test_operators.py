"""Ranking, time series, grids, headers and checks."""

import random
import statistics

import pytest
from pyspark.sql import Window as W, functions as F

from comarca.operators import checks, declared, grid as grids, headers, quantiles, ranking, timeseries, typed
from comarca.plans.rollup import yearly_unemployment
from comarca.functions import fixed_values as fv


@pytest.mark.parametrize("limit", [10 ** 9, 10])
def test_row_number_for_groups_of_any_size(spark, rows, limit):
    rng = random.Random(3)
    data = [(1 if i % 3 else rng.randint(1, 5), rng.choice([None, 0, 0, rng.randint(1, 9)]), i)
            for i in range(1000)]
    df = spark.createDataFrame(data, "g int, v int, id int")
    order = [F.col("v").desc_nulls_first(), F.col("id")]
    want = df.withColumn("n", F.row_number().over(W.partitionBy("g").orderBy(*order)))
    got = ranking.row_number_by(df, ["g"], order, "n", max_group_rows=limit)
    assert rows(got) == rows(want)


def test_row_number_null_group(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "g int, id int")
    got = ranking.row_number_by(df, ["g"], [F.col("id")], "n", largest_group=99, max_group_rows=1)
    assert rows(got) == [(1, 3, 1), (None, 1, 1), (None, 2, 2)]


def test_first_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    plan = ranking.first_per_key(df, ["k"], [F.col("id")])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_last_wins(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, s int, v string")
    assert rows(ranking.last_wins(df, ["k"], ["s"])) == [("a", 2, "y"), ("b", 1, "z")]


def test_previous_year_has_gaps_and_equals_the_join(spark, rows):
    df = spark.createDataFrame([(1, 2000, 10), (1, 2001, 20), (1, 2003, 30), (2, 2001, None), (2, 2002, 5)],
                               "k int, y int, v int")
    lagged = timeseries.with_previous_year(df, ["k"], "y", {"v": "p"})
    joined = timeseries.with_previous_year_joined(df, ["k"], "y", {"v": "p"})
    assert rows(lagged) == rows(joined, *lagged.columns)
    assert {(r.k, r.y): r.p for r in lagged.collect()} == {
        (1, 2000): None, (1, 2001): 10, (1, 2003): None, (2, 2001): None, (2, 2002): None}


def staged(spark, data):
    """(place, year, month, total) rows as a staged table."""
    df = spark.createDataFrame(data, "municipality_code bigint, data_year int, data_month int, "
                                     "total_unemployment int, municipality_name string")
    zero = {c: F.lit(0) for c in [*fv.UNEMPLOYMENT_MEASURES[1:], "total_men_unemployment",
                                  "total_women_unemployment"]}
    return df.withColumns(zero).withColumn("province_code", F.lit(1))


def test_rollup_first_available_and_min_months(spark):
    data = [(1, 2000, m, 100 + m, "a") for m in range(1, 13)]        # has December: 112
    data += [(1, 2001, m, 200, "b") for m in range(1, 12)]           # no December: Q4 mean 200
    data += [(1, 2002, m, 101 + m % 2, "a") for m in range(1, 6)]    # neither: mean of the year
    data += [(1, 2003, m, 50, "a") for m in (1, 2)]                  # too few months
    data += [(1, 2004, m, 0, "a") for m in range(1, 13)]             # previous year was dropped
    got = {r.data_year: r for r in yearly_unemployment(staged(spark, data)).collect()}
    assert sorted(got) == [2000, 2001, 2002, 2004]
    assert [got[y].primary_total_unemployment for y in sorted(got)] == [112, 200, 102, 0]
    assert got[2001].unemployment_change == 88 and got[2001].unemployment_change_pct == 78.57
    assert [got[y].data_coverage_quality for y in sorted(got)] == ["complete", "complete", "limited", "complete"]
    # two months of 2003 are still the year before 2004
    assert got[2004].prev_year_unemployment == 50 and got[2004].unemployment_trend == "high_decrease"
    assert got[2002].unemployment_volatility_pct is None
    assert got[2004].unemployment_volatility_pct is None  # mean is zero
    assert got[2001].municipality_name == "b"


def test_rollup_does_not_split_renamed_places_unless_asked(spark):
    data = [(1, 2000, m, 10, "a" if m < 7 else "b") for m in range(1, 13)]
    assert yearly_unemployment(staged(spark, data)).count() == 1
    assert yearly_unemployment(staged(spark, data), split_names=True).count() == 2


GRID = "source_file string, sheet_no int, sheet string, row_idx int, cells array<string>"


def sheet(name, number, lines, sheet_name):
    return [(name, number, sheet_name, i, cells) for i, cells in enumerate(lines)]


def test_header_rows(spark):
    data = sheet("a", 0, [["Title", None, None], [None, None, None], ["Code", "Name", "Total"], ["1", "x", "2"]], "s")
    data += sheet("b", 0, [["1", "2", "3"], ["1", "2.5", "x"], ["A", "b", "3"]], "s")
    data += sheet("c", 0, [["1", "2", "3"], ["4", "5", "6"]], "s")
    got = {r.source_file: r.header_row for r in grids.header_rows(spark.createDataFrame(data, GRID)).collect()}
    assert got == {"a": 2, "b": 2, "c": 1}


def plan_of(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_coverage_reads_two_cells_and_names_sheets_once(spark):
    data = sheet("2014_12_employment.xls", 0, [["27001", "Beta"] + ["1"] * 12], "PARO LUGO")
    df = spark.createDataFrame(data, GRID)
    wanted = grids.tidy_rows(df, "unemployment").select("data_type", "province", "municipality_name")
    assert [tuple(r) for r in wanted.collect()] == [("unemployment", "LUGO", "Beta")]
    assert "cells" not in plan_of(wanted)  # the kept copy is read without the other cells
    # a filter on the type of a sheet does not come in front of the aggregate per sheet
    assert "Aggregate" not in plan_of(grids.sheet_profile(df).where("data_type = 'unemployment'"))


def line(name, total="10", code=None, width=14):
    return ([code, name, total] + ["1"] * 20)[:width]


def test_sheets_of_all_vintages(spark):
    title = [None, "PARO REGISTRADO SEGÚN SEXO", None]
    wide = [title, [None, "MUNICIPIOS", "TOTAL"], line("Lugo", width=17), line("Alpha", "<5", width=17),
            line("Abc", width=17), line("TOTAL LUGO", width=17), line("Lugo Norte", "", width=17)]
    narrow = [line("Alpha", "7", width=5)]
    new = [["x", "head", "y"], line("Beta", "1 000", "27001"), line("Bad", "3", "n/a"), line("None", "3", None),
           line(" Gamma ", "-", "27002.0")]
    data = sheet("2006_03_employment.xls", 0, wide, "PARO LUGO")
    data += sheet("2010_01_employment.xls", 0, narrow, "PARO JAEN")
    data += sheet("2014_12_employment.xls", 0, new, "PARO LUGO")
    data += sheet("2014_12_employment.xls", 1, [line("Tiny", "3", "27001", 5)], "PARO AVILA")
    data += sheet("2014_12_employment.xls", 2, new[:2], "CONTRATOS LUGO")
    data += sheet("2014_12_employment.xls", 3, [line("Later", "9", "27003")], "PARO JAEN.")
    data += sheet("2014_12_employment.xls", 2, [], "PORTADA")
    data += sheet("2014_12_employment.xls", 1, [line("Earlier", "9", "27004")], "PARO JAEN")
    df = spark.createDataFrame(data, GRID)
    got = {(r.year, r.municipality_name): r for r in grids.tidy_rows(df, "unemployment").collect()}
    assert sorted(got) == [(2006, "Alpha"), (2006, "Lugo Norte"), (2010, "Alpha"), (2014, "Beta"),
                           (2014, "Gamma"), (2014, "Later")]
    assert got[2006, "Alpha"].total_unemployment == 5 and got[2006, "Alpha"].municipality_code == 0
    assert got[2010, "Alpha"].men_25_44 == 1 and got[2010, "Alpha"].industry_sector is None
    assert got[2014, "Beta"].total_unemployment == 0  # blanks are no digits here
    assert got[2014, "Gamma"].municipality_code == 27002
    reasons = {(r.sheet, r.reason) for r in grids.rejected_rows(df).collect()}
    assert {("PARO LUGO", "code_not_numeric"), ("PARO LUGO", "no_code"), ("PARO AVILA", "too_few_columns"),
            ("PARO LUGO", "short_name"), ("PARO LUGO", "heading"), ("PARO LUGO", "province_name")} <= reasons
    contains = grids.Vintages(drop_province_name="contains")
    names = [r.municipality_name for r in grids.tidy_rows(df, "unemployment", contains).where("year=2006").collect()]
    assert names == ["Alpha"]
    contracts = grids.tidy_rows(df, "contracts").collect()
    assert [r.total_contracts for r in contracts] == [1000.0]


def test_population_sheets_name_their_columns_differently(spark):
    data = sheet("pobmun98.xls", 0, [["Cifras", None, None, None], ["CPRO", "CMUN", "NOMBRE", "POB98"],
                                     ["01", "2", "Alpha", "10"], ["Total", None, None, "10"],
                                     [None, None, None, None]], "p")
    data += sheet("pobmun01.xls", 0, [["Total", "Nombre municipio", "CMUN", "Cod_prov"],
                                      ["n.d.", "Beta", "3", "02"]], "p")
    got = grids.population_rows(spark.createDataFrame(data, GRID)).collect()
    assert sorted((r.data_year, r.province_code, r.cmun, r.municipality_name, r.population_total)
                  for r in got) == [(1998, "01", "2", "Alpha", 10.0), (2001, "02", "3", "Beta", None)]


def test_headers_of_frames(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "NOMBRE int, `Nombre mun.` int, `  ` int, `2 x` int")
    assert headers.canonical_columns(df).columns == [
        "municipality_name", "municipality_name_1", "unnamed_column_2", "col_2_x"]
    assert headers.canonical_columns(df, rules=[]).columns == [
        "nombre", "nombre_mun", "unnamed_column_2", "col_2_x"]
    mixed = spark.createDataFrame([("a", None), ("a", "08"), ("b", "09"), ("b", "Lugo")], "f string, province string")
    assert sorted(map(tuple, headers.settle_ambiguous(mixed, ["f"]).collect()), key=str) == [
        ("a", "08", None), ("a", None, None), ("b", None, "09"), ("b", None, "Lugo")]
    repeated = spark.createDataFrame([(0, "a"), (1, "a"), (2, "a_1"), (3, "a")], "pos int, name string")
    assert [r.name for r in headers.dedupe_headers(repeated, [], "name", "pos").orderBy("pos").collect()] == [
        "a", "a_2", "a_1", "a_3"]
    a = spark.createDataFrame([("x", 1)], "NOMBRE string, pob98 int")
    b = spark.createDataFrame([(2, "y", "z")], "Total int, Municipio string, Isla string")
    got = headers.union_drifting([a, b])
    assert sorted(map(tuple, got.collect())) == [("x", 1, None), ("y", 2, "z")]
    empty = spark.createDataFrame([(None, None, "a"), (None, None, None)], "a int, b int, c string")
    got = headers.drop_empty_columns(headers.drop_empty_rows(empty))
    assert got.columns == ["c"] and got.count() == 1


def test_checks(spark, rows):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", 50.0), (2, " ", None), (None, None, -1.0)],
                               "k int, s string, v double")
    assert checks.not_null(df, "k").count() == 1
    assert checks.not_empty(df, "s").count() == 1
    assert rows(checks.unique(df, ["k"])) == [(1, 2)]
    assert checks.accepted_values(df, "s", ["a", "b"]).count() == 1
    assert checks.accepted_range(df, "v", 0, 10).count() == 2
    assert checks.accepted_range(df, "v", 5, 50, inclusive=False).count() == 3
    assert checks.accepted_range(df, "v", 0, 10, where=F.col("k") == 1).count() == 1
    assert checks.expression_holds(df, F.col("v") > 0).count() == 1
    suite = checks.run_suite(df, [
        checks.Check("k", F.col("k").isNull()), checks.Check("v", F.col("v") < 0, severity="warn"),
        checks.Check("w", F.col("v") < 0, severity="warn", allow=1), checks.Check("u", unique=("k",)),
        checks.Check("ks", unique=("k", "s"))])
    assert {r.check_name: (r.violations, r.status) for r in suite.collect()} == {
        "k": (1, "fail"), "v": (1, "warn"), "w": (1, "pass"), "u": (1, "fail"), "ks": (0, "pass")}


def test_year_completeness_and_group_completeness(spark):
    df = spark.createDataFrame([(y, "p") for y in (1996, 1997, 1999) for _ in range(60)]
                               + [(2000, "p")] * 20, "y int, g string")
    got = {(r.issue_type, r.year_value) for r in checks.year_completeness(df, "y", 1996, 1999, [1997]).collect()}
    assert got == {("missing_year", "1998"), ("unexpected_year", "1997"), ("unexpected_year", "2000")}
    got = checks.group_completeness(df, "g", "y").collect()
    assert [(r.y, r.record_count, r.expected_records, r.completeness_percentage) for r in got] == [
        (2000, 20, 60, 33.3)]


def test_mapping_consistency(spark, rows):
    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 3), ("d", 4), ("d", 5)], "n string, c bigint")
    right = spark.createDataFrame([("a", 1), ("b", 9), ("d", 4), ("d", 5), ("e", 6)], "n string, c bigint")
    got = checks.mapping_consistency(left, right, ["n"], "c")
    assert [r[0] for r in rows(got)] == ["b", "c", "d", "e"]


def test_declared_checks_from_a_table(spark, rows):
    df = spark.createDataFrame([(1, " ", 5.0, "a"), (1, "x", None, "b"), (None, "y", -1.5, None)],
                               "k int, name string, v double, c string")
    make = declared.Declaration
    suite = [make("k", "not_null", ("k",), tags=("presence",)), make("name", "not_empty", ("name",)),
             make("v", "range", ("v",), ("-1.5", "4"), "warn", 1), make("low", "range", ("v",), ("0", "")),
             make("c", "values", ("c",), ("a",)), make("key", "unique", ("k",), tags=("keys", "presence")),
             make("e", "expression", (), ("v > 0 OR c IS NULL",))]
    table = declared.declaration_table(spark, {"m": suite, "other": suite[:1]})
    assert rows(declared.run_declared(table, {"m": df})) == [
        ("m", "c", "error", 1, "fail"), ("m", "e", "error", 0, "pass"), ("m", "k", "error", 1, "fail"),
        ("m", "key", "error", 1, "fail"), ("m", "low", "error", 1, "fail"), ("m", "name", "error", 1, "fail"),
        ("m", "v", "warn", 1, "pass")]
    got = declared.run_declared(table, {"m": df, "other": df}, tags=["presence"])
    assert rows(got, "model", "check_name") == [("m", "k"), ("m", "key"), ("other", "k")]
    assert rows(declared.run_declared(table, {"m": df}, tags=["none"])) == []
    with pytest.raises(ValueError, match="unknown kind"):
        make("x", "sum").check()


def test_typed_rows_and_rejects(spark, rows):
    fields = (typed.Field("code", "int", ("COD", "Code no"), low=1, high=9), typed.Field("share", "double", required=False),
              typed.Field("name", "string", ("NOMBRE",)))
    df = spark.createDataFrame([(1, " 07 ", "1.5", " a b\t"), (2, "7.0", None, "c"), (3, "7.5", "x", "d"), (4, "12", "", "  "),
                                (5, None, "1e3", "e"), (6, "99999999999", "1", "f")],
                               "id int, `code NO` string, share string, Nombre string")
    got = typed.typed(df, fields)
    assert got.dtypes[:4] == [("id", "int"), ("code", "int"), ("share", "double"), ("name", "string")]
    assert rows(typed.accepted(got)) == [(1, 7, 1.5, "a b"), (2, 7, None, "c")]
    assert rows(typed.rejects(got, "id")) == [
        (3, "code", "7.5", "not_int"), (3, "share", "x", "not_double"), (4, "code", "12", "out_of_range"),
        (4, "name", "  ", "missing"), (5, "code", None, "missing"), (6, "code", "99999999999", "not_int")]
    with pytest.raises(ValueError, match="code missing 1, code not_int 2, code out_of_range 1, name missing 1, share"):
        typed.load_strict(df, fields)
    assert typed.load_strict(df.where("id < 3"), fields).count() == 2
    with pytest.raises(ValueError, match="name: no column"):
        typed.typed(df.drop("Nombre"), fields)
    with pytest.raises(ValueError, match="code: columns code NO, cod"):
        typed.typed(df.withColumn("cod", F.lit("1")), fields)


@pytest.mark.parametrize("middle, ranges", [(10 ** 6, 256), (5, 4)])
def test_exact_median_of_groups_of_any_size(spark, rows, middle, ranges):
    rng = random.Random(12)
    data = [(draw, rng.choice([None, 7.0, rng.gauss(0, 100), float(rng.randint(0, 30))])) for draw in
            rng.choices(["a", "b", None], [90, 9, 1], k=1200)]
    data += [("one", 3.0), ("two", 1.0), ("two", 2.0), ("none", None), *[("same", 4.0)] * 50]
    want = {}
    for g, v in data:
        want.setdefault(g, []).extend([v] if v is not None else [])
    df = spark.createDataFrame(data, "g string, v double").repartition(3)
    got = {r.g: r["median"] for r in quantiles.exact_median(df, ["g"], "v", middle, ranges).collect()}
    assert got == {g: pytest.approx(statistics.median(v)) for g, v in want.items() if v}
    assert quantiles.exact_median(df.limit(0), ["g"], "v", middle, ranges).count() == 0
