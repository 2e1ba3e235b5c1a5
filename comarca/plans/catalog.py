"""Registered queries: every operator on whole driver tables or relations of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from comarca.functions import classes, text
from comarca.functions.fixed_values import SOURCE_REGISTRY
from comarca.operators import checks, fuzzy, grid as grids, headers, lookup, quantiles, ranking, typed
from comarca.operators.declared import declaration_table, run_declared
from comarca.operators.timeseries import with_previous_year
from comarca.plans import dashboard, marts, reports, staging, suites
from comarca.plans.rollup import yearly_unemployment
from comarca.plans.workload import (BOUNDS, RATE_YEARS, VINTAGES, derive, employment_grid, grid, table)
from comarca.session import freeze, new_folder
from comarca.sources import csvs, files, grids as grid_io, lineage, tables, web
from comarca.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PLACE_YEAR = ["province_code", "municipality_code", "data_year"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def col(name: str) -> Column:
    return F.col(name)


# ---- shared inputs -------------------------------------------------------------

def _provinces(spark, sf):
    return staging.stage_provinces(derive(spark, sf, "provinces"), BOUNDS)


def _dictionary(spark, sf):
    return staging.stage_municipalities(derive(spark, sf, "dictionary"), BOUNDS)


def _references(spark, sf):
    return _provinces(spark, sf), derive(spark, sf, "aliases"), _dictionary(spark, sf)


def _unemployment(spark, sf):
    return staging.stage_unemployment(derive(spark, sf, "raw_unemployment"),
                                      *_references(spark, sf), BOUNDS)


def _contracts(spark, sf):
    return staging.stage_contracts(derive(spark, sf, "raw_contracts"),
                                   *_references(spark, sf), BOUNDS)


def _population(spark, sf):
    return staging.stage_population(derive(spark, sf, "raw_population"), BOUNDS)


def _yearly(spark, sf):
    return yearly_unemployment(_unemployment(spark, sf))


def _places(spark, sf) -> int:
    """Number of places: no year of the population table can hold more rows."""
    return table(spark, sf, "supplier").count()


def _trends(spark, sf):
    return marts.population_trends(_population(spark, sf), _dictionary(spark, sf),
                                   largest_year=_places(spark, sf))


def _changes(spark, sf):
    return marts.population_changes(_population(spark, sf), _dictionary(spark, sf))


# ---- staging and marts ---------------------------------------------------------

@query
def dim_provinces(spark, sf):
    return _provinces(spark, sf)


@query
def dim_entities(spark, sf):
    return _dictionary(spark, sf)


@query
def province_alias_map(spark, sf):
    provinces, aliases, _ = _references(spark, sf)
    spelled = aliases.select(text.clean_key(col("alias")).alias("province_key"))
    return lookup.province_codes(spelled, provinces, aliases)


@query
def stage_population(spark, sf):
    return _population(spark, sf)


@query
def stage_unemployment(spark, sf):
    return _unemployment(spark, sf).drop("source_file")


@query
def stage_contracts(spark, sf):
    return _contracts(spark, sf).drop("source_file")


@query
def shares_by_category(spark, sf):
    df = _contracts(spark, sf)
    sums = [F.sum(c).alias(c) for c in ["total_contracts", *staging.CONTRACT_SUMS]]
    return staging.contract_shares(df.groupBy("province_code", "data_year").agg(*sums))


@query
def yearly_rollup(spark, sf):
    return _yearly(spark, sf).orderBy("municipality_code", "data_year", "province_code")


@query
def yearly_trend(spark, sf):
    return _yearly(spark, sf).select(
        *PLACE_YEAR, "primary_total_unemployment", "prev_year_unemployment",
        "unemployment_change", "unemployment_change_pct", "unemployment_trend")


@query
def yearly_volatility(spark, sf):
    return _yearly(spark, sf).select(
        *PLACE_YEAR, "unemployment_volatility_pct", "winter_avg_unemployment",
        "summer_avg_unemployment", "seasonal_variation_pct", "high_volatility_flag",
        "unstable_employment_flag")


@query
def population_trends(spark, sf):
    return _trends(spark, sf)


@query
def population_ranks(spark, sf):
    ranked = marts.population_ranks(_changes(spark, sf), largest_year=_places(spark, sf))
    return ranked.select(*PLACE_YEAR, "total_population", "population_rank_national",
                         "population_rank_provincial")


@query
def population_ranks_by_range(spark, sf):
    """The same ranks the way groups too large for one task are ranked."""
    return marts.population_ranks(_changes(spark, sf), largest_year=1 << 62).select(
        *PLACE_YEAR, "total_population", "population_rank_national", "population_rank_provincial")


@query
def rates_mart(spark, sf):
    return marts.unemployment_rates(_trends(spark, sf), _yearly(spark, sf), RATE_YEARS)


@query
def socioeconomic_mart(spark, sf):
    return marts.socioeconomic_trends(_trends(spark, sf), _yearly(spark, sf), RATE_YEARS)


@query
def sign_quadrant(spark, sf):
    both = marts.align(_changes(spark, sf), _yearly(spark, sf), RATE_YEARS, 0)
    pop, unemp = col("population_change_pct"), col("unemployment_change_pct")
    return both.groupBy("data_year",
                        classes.sign_quadrant(pop, unemp).alias("quadrant"),
                        classes.sign_quadrant(pop, unemp, "stable").alias("quadrant_or_stable")
                        ).agg(F.count(F.lit(1)).alias("places"))


@query
def yoy_change(spark, sf):
    """Previous year of every place's population; every seventh place reports 1997 as 2003, which leaves a gap."""
    late = (col("data_year") == 1997) & (col("municipality_code") % 7 == 3)
    df = _population(spark, sf).withColumn("data_year", F.when(late, 2003).otherwise(col("data_year")))
    return with_previous_year(
        df.select(*PLACE_YEAR, "population_total"), PLACE_YEAR[:2], "data_year",
        {"population_total": "previous_total"})


# ---- code lookups --------------------------------------------------------------

@query
def normalize_names(spark, sf):
    names = derive(spark, sf, "raw_unemployment").select("municipality_name").distinct()
    return names.withColumn("normalized", text.normalize_name(col("municipality_name")))


@query
def one_to_one_lookup(spark, sf):
    return lookup.one_to_one_lookup(derive(spark, sf, "raw_unemployment"), "municipality_name",
                                    "municipality_code", "province")


@query
def province_resolution(spark, sf):
    provinces, aliases, _ = _references(spark, sf)
    spelled = (derive(spark, sf, "raw_unemployment")
               .groupBy(text.clean_key(col("province")).alias("province_key"))
               .agg(F.count(F.lit(1)).alias("records")))
    return lookup.province_codes(spelled, provinces, aliases)


def _uncoded_names(spark, sf):
    """Distinct (name, province) of rows without a code."""
    provinces, aliases, _ = _references(spark, sf)
    raw = derive(spark, sf, "raw_unemployment")
    spelled = (raw.where((F.coalesce("municipality_code", F.lit(0)) == 0))
               .select("municipality_name", "municipality_code",
                       text.clean_key(col("province")).alias("province_key")).distinct())
    return fuzzy.unresolved_names(lookup.province_codes(spelled, provinces, aliases))


@query
def normalized_name_match(spark, sf):
    _, loose = lookup.dictionary_keys(_dictionary(spark, sf))
    names = _uncoded_names(spark, sf).withColumn("name_norm", text.normalize_name(col("source_name")))
    return names.join(loose, ["name_norm", "province_code"]).select(
        "source_name", "name_norm", "province_code", "norm_code", "norm_name",
        F.lit("fuzzy_normalized").alias("match_method"), F.lit(95).alias("confidence_score"))


@query
def fuzzy_match(spark, sf):
    return fuzzy.fuzzy_matches(_uncoded_names(spark, sf), _dictionary(spark, sf))


@query
def fuzzy_best(spark, sf):
    return fuzzy.best_matches(_uncoded_names(spark, sf), _dictionary(spark, sf))


@query
def fuzzy_left_join(spark, sf):
    """All staged rows with the best match of their name, matched or not."""
    rows = _unemployment(spark, sf).select("municipality_name", "municipality_code", "province_code", "data_year")
    return fuzzy.with_best_match(rows, _dictionary(spark, sf)).groupBy(
        "province_code", "data_year", "matched_code", "match_method", "confidence_score").agg(
        F.count(F.lit(1)).alias("records"))


@query
def code_completion(spark, sf):
    raw = derive(spark, sf, "raw_unemployment").select(
        "place_key", "municipality_code", "municipality_name", "province", "year", "month")
    resolved = lookup.resolve_names(raw, *_references(spark, sf))
    done = lookup.complete_codes(raw, resolved)
    return done.groupBy("year", "municipality_code_source", "municipality_code_completed",
                        "match_method", "confidence_score").agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("municipality_code").alias("codes"),
        F.sum(text.local_code(col("municipality_code"), BOUNDS.code_base)).alias("code_sum"))


# ---- grids ---------------------------------------------------------------------

@query
def grid_scan(spark, sf):
    folder = new_folder(spark, "grid-scan")
    grid_io.write_text_grid(grid(spark, sf, "unemployment"), folder)
    read = grid_io.read_text_grid(spark, folder)
    return read.groupBy("source_file", "sheet").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.size(F.filter("cells", lambda c: c.isNotNull()))).alias("n_filled"),
        F.max(F.size("cells")).alias("width"))


@query
def grid_header_row(spark, sf):
    return grids.header_rows(grid(spark, sf, "population"), VINTAGES)


@query
def grid_data_start(spark, sf):
    return grids.sheet_profile(employment_grid(spark, sf), VINTAGES)


@query
def rejected_sheets(spark, sf):
    """Data below sixty more rows is found; sheets that lose their first two columns are named."""
    first_two = F.concat(F.array(F.lit(None).cast("string"), F.lit(None).cast("string")),
                         F.slice("cells", 3, 100))
    df = employment_grid(spark, sf).withColumns({
        "row_idx": col("row_idx") + 60,
        "cells": F.when(col("sheet_no") % 5 == 0, first_two).otherwise(col("cells"))})
    return grids.rejected_sheets(df, VINTAGES)


@query
def grid_positional(spark, sf):
    df = freeze(grid(spark, sf, "contracts"))
    rows = grids.data_rows(df, grids.keep_last_sheet(grids.sheet_profile(df, VINTAGES)))
    return grids.project_layout(rows, "contracts", VINTAGES)


@query
def grid_noise_filter(spark, sf):
    return grids.rejected_rows(grid(spark, sf, "unemployment"), VINTAGES)


@query
def grid_to_tidy(spark, sf):
    return grids.tidy_rows(grid(spark, sf, "unemployment"), "unemployment", VINTAGES)


@query
def population_from_grid(spark, sf):
    return grids.population_rows(grid(spark, sf, "population"), VINTAGES)


@query
def lenient_numeric(spark, sf):
    cells = derive(spark, sf, "cell_texts").groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    return cells.select("cell", "n", text.lenient_number(col("cell")).alias("as_unemployment"),
                        text.lenient_number(col("cell"), drop_blanks=True).alias("as_contracts"))


@query
def header_canon(spark, sf):
    spelled = derive(spark, sf, "headers").groupBy("header").agg(F.count(F.lit(1)).alias("n"))
    return spelled.withColumn("canonical", text.canonical_header(col("header")))


@query
def clean_column_names(spark, sf):
    df = derive(spark, sf, "headers")
    name = F.coalesce(text.clean_column_name(col("header")),
                      F.concat(F.lit("unnamed_column_"), col("pos")))
    return df.select("p_partkey", "header", name.alias("column_name"))


@query
def dedupe_headers(spark, sf):
    df = derive(spark, sf, "headers").select(
        "file_no", "pos", F.coalesce(text.canonical_header(col("header")),
                                     F.concat(F.lit("unnamed_column_"), col("pos"))).alias("name"))
    return headers.dedupe_headers(df, ["file_no"], "name", "pos")


@query
def sniff_code_or_name(spark, sf):
    return headers.sniff_code_or_name(derive(spark, sf, "code_rows"), ["file_no"], "province",
                                      "c_custkey")


@query
def drop_empty(spark, sf):
    df = derive(spark, sf, "code_rows").select("province_code", "municipality_code", "province", "notes")
    return headers.drop_empty_columns(headers.drop_empty_rows(df))


@query
def drop_subtotals(spark, sf):
    return headers.drop_subtotals(derive(spark, sf, "code_rows").select("label", "c_custkey"), "label")


@query
def zero_pad_codes(spark, sf):
    return headers.standard_types(derive(spark, sf, "code_rows").select(
        "c_custkey", "province_code", "municipality_code"))


@query
def dictionary_typed(spark, sf):
    """The dictionary sheet under its own headers, typed strictly; rows that do not fit are left out."""
    sheet = derive(spark, sf, "dictionary_sheet").withColumnsRenamed({
        "codauto": "CODAUTO", "cpro": "CPRO", "cmun": " cmun ", "dc": "DC", "nombre": "Nombre"})
    return typed.accepted(typed.typed(sheet, typed.DICTIONARY))


@query
def dictionary_rejects(spark, sf):
    """Values of the dictionary sheet that do not fit, with column and reason."""
    sheet = derive(spark, sf, "dictionary_sheet")
    return typed.rejects(typed.typed(sheet, typed.DICTIONARY), "place_key")


@query
def drop_nonnumeric_key(spark, sf):
    return headers.count_non_numeric(derive(spark, sf, "code_rows"), "province_code")


@query
def numeric_key_rows(spark, sf):
    df = headers.drop_non_numeric(derive(spark, sf, "code_rows"), "province_code")
    return df.select("c_custkey", text.text_code(col("province_code")).alias("province_code"))


@query
def sheet_classify(spark, sf):
    kind, province = text.sheet_type_and_province(col("sheet"))
    return derive(spark, sf, "sheet_names").select("c_custkey", "sheet", kind.alias("data_type"),
                                                   province.alias("province"))


@query
def label_key(spark, sf):
    df = derive(spark, sf, "headers").select("header").distinct()
    return df.withColumn("label", text.label_key(col("header")))


@query
def exact_medians(spark, sf):
    """Median price of all line items as one group and per flag; groups are cut down as if they were huge."""
    items = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    whole = quantiles.exact_median(items.withColumn("l_returnflag", F.lit("all")), ["l_returnflag"], "l_extendedprice", middle=500)
    return whole.unionByName(quantiles.exact_median(items, ["l_returnflag"], "l_extendedprice"))


@query
def last_wins(spark, sf):
    """Latest order of every customer."""
    orders = table(spark, sf, "orders")
    return ranking.last_wins(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderstatus")


@query
def sheet_quality(spark, sf):
    tidy = grids.tidy_rows(grid(spark, sf, "unemployment"), "unemployment", VINTAGES)
    shifted = tidy.withColumn("total_unemployment", col("total_unemployment") * 1000)
    parts = [(F.col(c) - 20).alias(c) for c in ("men_25_44", "services_sector")]
    rest = [c for c in shifted.columns if c not in ("men_25_44", "services_sector")]
    return reports.sheet_quality(shifted.select(*rest, *parts), "unemployment", VINTAGES)


@query
def processing_report(spark, sf):
    return reports.processing_report(grids.sheet_profile(employment_grid(spark, sf), VINTAGES))


@query
def coverage_summary(spark, sf):
    all_rows = [grids.tidy_rows(grid(spark, sf, k), k, VINTAGES).select(
        "data_type", "province", "year", "month", "source_file", "municipality_name")
        for k in ("unemployment", "contracts")]
    return reports.coverage_summary(all_rows[0].unionByName(all_rows[1]))


# ---- files, pages, loads -------------------------------------------------------

@query
def filename_dates(spark, sf):
    names = derive(spark, sf, "file_names").groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))
    year, month = text.file_period(col("file_name"))
    return names.select("file_name", "n", F.coalesce(year, text.two_digit_year(col("file_name")))
                        .alias("year"), month.alias("month"))


@query
def month_from_label(spark, sf):
    labels = derive(spark, sf, "month_labels").distinct()
    return labels.withColumn("month", text.month_number(col("label"), col("label_year")))


STATS_PREFIX, SITE = "/stats/municipios/", "https://stats.example.org"


@query
def page_links(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "html")
    return web.page_links(pages).groupBy("href").agg(F.count(F.lit(1)).alias("n"))


@query
def page_links_by_year(spark, sf):
    return web.links_by_year(derive(spark, sf, "stat_pages"), STATS_PREFIX, SITE)


@query
def latest_partition(spark, sf):
    return web.latest_link(web.links_by_year(derive(spark, sf, "stat_pages"), STATS_PREFIX, SITE))


@query
def page_pick_link(spark, sf):
    return web.pick_attachment(derive(spark, sf, "stat_pages"), "libro completo", base=SITE)


@query
def html_table_rows(spark, sf):
    return web.html_table_rows(derive(spark, sf, "stat_pages"))


@query
def odd_page_links(spark, sf):
    """Links of pages with comments, scripts, brackets in attributes and references in addresses."""
    return web.page_links(derive(spark, sf, "odd_pages"))


@query
def odd_page_tables(spark, sf):
    """Cells of open, nested and spanning tables."""
    return web.html_table_rows(derive(spark, sf, "odd_pages"))


@query
def file_inventory(spark, sf):
    return files.file_inventory(spark, sf, "*.parquet").select("filename", "size_mb")


@query
def unprocessed_inputs(spark, sf):
    names = derive(spark, sf, "file_names")
    year, month = text.file_period(col("file_name"))
    inputs = names.select("file_name", year.alias("year"), month.alias("month")).distinct()
    manifest = derive(spark, sf, "raw_unemployment").where("month % 2 = 0").select("year", "month")
    return files.unprocessed(inputs.where("year is not null"), manifest, ["year", "month"])


@query
def drift_union(spark, sf):
    raw = derive(spark, sf, "raw_population")
    odd = raw.where("data_year % 2 = 1").select(
        col("province_code").alias("CPRO"), col("cmun").alias("CMUN"),
        col("municipality_name").alias("NOMBRE"), col("population_total").alias("pob95"),
        col("population_male").alias("Varones"), col("population_female").alias("Mujeres"),
        col("data_year").alias("Año"))
    even = raw.where("data_year % 2 = 0").select(
        col("data_year").alias("Año"), col("province_code").alias("cod_prov"),
        col("province_name").alias("Provincia"), col("cmun").alias("Cmun"),
        col("municipality_name").alias("Nombre Municipio"),
        col("population_total").alias("Ambos sexos"))
    return headers.union_drifting([odd, even])


@query
def drift_load(spark, sf):
    """Yearly CSVs with two kinds of header, loaded as one typed raw table."""
    raw, folder = derive(spark, sf, "raw_population"), new_folder(spark, "drift")
    raw.where("data_year % 2 = 1").select(
        col("province_code").alias("CPRO"), col("cmun").alias("CMUN"),
        col("municipality_name").alias("NOMBRE"), col("population_total").alias("POB99"),
        col("data_year").alias("Periodo")).write.option("header", True).csv(f"{folder}/odd")
    raw.where("data_year % 2 = 0").select(
        col("data_year").alias("Periodo"), col("population_total").alias("Ambos sexos"),
        col("population_male").alias("Hombres"), col("cmun").alias("CMUN"),
        col("municipality_name").alias("Municipio"), col("province_code").alias("cod_prov"),
    ).write.option("header", True).csv(f"{folder}/even")
    loaded = headers.standard_types(csvs.read_drifting_csv(spark, folder))
    return lineage.stamp(loaded, "demography").select(
        "province_code", "cmun", "municipality_name", "population_total", "population_male",
        col("periodo").cast("int").alias("data_year"), "data_source")


@query
def lineage_stamp(spark, sf):
    raw = derive(spark, sf, "raw_population").select("place_key", "data_year", "source_file")
    return lineage.stamp(raw, "demography").drop("ingestion_timestamp")


@query
def csv_roundtrip(spark, sf):
    raw = derive(spark, sf, "raw_population").select(
        "province_code", "cmun", "municipality_name", "population_total", "data_year")
    folder = new_folder(spark, "csv")
    raw.write.option("header", True).csv(folder)
    read = csvs.good_rows(csvs.read_csv(
        spark, folder, "province_code string, cmun string, municipality_name string, "
                       "population_total double, data_year int"))
    return read.groupBy("data_year").agg(
        F.count(F.lit(1)).alias("n"), F.count("population_total").alias("n_total"),
        F.sum("population_total").alias("population_total"),
        F.countDistinct("province_code", "cmun").alias("places"))


@query
def csv_records(spark, sf):
    """CSVs whose cells hold line breaks, with short and untyped records among the good ones."""
    rows, folder = derive(spark, sf, "remarks"), new_folder(spark, "csv-records")
    quote = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    # the first line of every file; a header that turns up again is no data
    head = F.when(F.monotonically_increasing_id() % (1 << 33) == 0, "key,cents,remark\n").otherwise("")
    text_line = F.concat_ws(",", F.when(col("o_orderkey") % 50 == 7, "no number")
                            .otherwise(col("o_orderkey").cast("string")),
                            col("cents"), F.when(col("remark").isNull(), "").when(
                                col("o_orderkey") % 8 == 4, col("remark")).otherwise(quote(col("remark"))))
    short = F.when(col("o_orderkey") % 50 == 9, col("o_orderkey").cast("string")).otherwise(text_line)
    rows.select(F.concat(head, short).alias("value")).write.text(folder)
    return csvs.read_csv(spark, folder, "key bigint, cents bigint, remark string").select(
        "key", "cents", "remark", F.col(csvs.CORRUPT).alias("bad_record"))


@query
def consolidate_month(spark, sf):
    both = [derive(spark, sf, f"raw_{k}").select(
        F.lit(k).alias("data_type"), "year", "month", "municipality_name",
        F.col(f"total_{k}").alias("total")) for k in ("unemployment", "contracts")]
    folder = new_folder(spark, "consolidated")
    keys = ["data_type", "year", "month"]
    tables.consolidate(both[0], folder, keys)
    # a second run adds the months that are not there yet
    done = spark.read.parquet(folder).select(*keys)
    tables.consolidate(both[0].unionByName(both[1]), folder, keys, skip_existing=done)
    return spark.read.parquet(folder).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"), F.sum("total").alias("total"))


@query
def full_refresh(spark, sf):
    folder = new_folder(spark, "full-refresh")
    name = "load_" + folder[-12:]
    raw = derive(spark, sf, "raw_population").select("province_code", "cmun", "data_year",
                                                     "population_total")
    tables.full_refresh(raw.where("data_year = 1995"), name, folder)
    spark.sql(f"CREATE OR REPLACE VIEW {name}_v AS SELECT * FROM {name}")
    tables.full_refresh(raw, name)
    spark.catalog.refreshTable(name)
    return spark.table(f"{name}_v").groupBy("data_year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("population_total").alias("population_total"))


@query
def materialize_layers(spark, sf):
    folder = new_folder(spark, "layers")
    layer = "layer_" + folder[-12:]
    tables.create_layer(spark, layer, folder)
    staged = tables.materialize(_population(spark, sf), f"{layer}_population", "view")
    mart = marts.population_changes(staged, _dictionary(spark, sf))
    stored = tables.materialize(mart, "population_changes", "table", layer,
                                partition_by=["data_year"], sort_by=marts.PLACE)
    return stored.groupBy("data_year").agg(
        F.count(F.lit(1)).alias("places"), F.sum("population_change").alias("population_change"))


@query
def layer_views(spark, sf):
    """A stored table and a view on it that stays in the layer."""
    folder = new_folder(spark, "views")
    layer = "layer_" + folder[-12:]
    tables.create_layer(spark, layer, folder)
    tables.materialize(_population(spark, sf), "population", "table", layer, partition_by=["data_year"])
    return tables.layer_view(spark, "population_by_province", layer, f"""
        SELECT province_code, data_year, count(*) AS places, sum(population_total) AS population_total
        FROM {layer}.population GROUP BY province_code, data_year""")


@query
def staged_lineage(spark, sf):
    """Publisher, file and load time of raw rows, as they arrive in the staged tables."""
    references = _references(spark, sf)
    registry = {**SOURCE_REGISTRY, "employment": {"data_source": "SEPE", "data_category": "employment"}}
    raw = {k: lineage.stamp(derive(spark, sf, f"raw_{k}"), source, col("source_file"), registry) for k, source in (
        ("population", "demography"), ("unemployment", "employment"), ("contracts", "employment"))}
    staged = {"population": staging.stage_population(raw["population"], BOUNDS),
              "unemployment": staging.stage_unemployment(raw["unemployment"], *references, BOUNDS),
              "contracts": staging.stage_contracts(raw["contracts"], *references, BOUNDS)}
    parts = [df.groupBy("data_year", "source_file", "data_source").agg(
        F.count(F.lit(1)).alias("n"), F.count("ingestion_timestamp").alias("stamped"),
        F.countDistinct("ingestion_timestamp").alias("loads")).select(F.lit(k).alias("dataset"), "*") for k, df in staged.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def model_created_at(spark, sf):
    """Every model says when it was built: no row without, one time per model."""
    models = {"yearly": _yearly(spark, sf), "population_trends": _trends(spark, sf), "rates": _rates(spark, sf),
              "socioeconomic": _socioeconomic(spark, sf)}
    parts = [lineage.with_created_at(df).agg(
        F.count(F.lit(1)).alias("n"), F.count("created_at").alias("stamped"), F.countDistinct("created_at").alias("builds"))
        .select(F.lit(k).alias("model"), "*") for k, df in models.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def incremental_upsert(spark, sf):
    """Mart up to 2000, then an incremental run that has a new column and lacks an old one."""
    # both inputs are stored tables in a real pipeline
    people, work = freeze(_trends(spark, sf)), freeze(_yearly(spark, sf))
    first, last = RATE_YEARS
    folder = new_folder(spark, "rates")
    built = marts.unemployment_rates(people, work, (first, last - 1)).withColumn("draft", F.lit("first"))
    tables.store_partitions(built, folder, "data_year")
    start = tables.refresh_start(tables.read_stored(spark, folder), "data_year", first)
    batch = marts.unemployment_rates(people, work, RATE_YEARS, since=start).withColumn("revision", F.lit(2))
    for _ in range(2):  # a run that is repeated changes nothing
        tables.merge_partitions(batch, folder, PLACE_YEAR, "data_year")
    return tables.read_stored(spark, folder)


@query
def stored_merge_moves(spark, sf):
    """A stored table keyed without its partition: rows of 2000 move to 2002, one column changes its type."""
    pop = _population(spark, sf).select(*PLACE_YEAR, "population_total")
    place = F.concat_ws("/", "province_code", "municipality_code", "data_year").alias("place")
    rows = freeze(pop.select(place, "data_year", col("population_total").cast("int").alias("total")))
    folder = new_folder(spark, "moves")
    tables.store_partitions(rows, folder, "data_year")
    moved = rows.where("data_year = 2000").select("place", F.lit(2002).alias("data_year"), (
        col("total").cast("bigint") * 10).alias("total"))
    for _ in range(2):
        tables.merge_partitions(moved, folder, ["place"], "data_year")
    return tables.read_stored(spark, folder)


@query
def schema_sync(spark, sf):
    """An upsert whose batch has a new column and lost another."""
    pop = _population(spark, sf)
    keys = PLACE_YEAR
    target = pop.where("data_year <= 1999").select(*keys, "population_total", "population_male")
    batch = pop.where("data_year >= 1999").select(
        *keys, (col("population_total") + 1).alias("population_total"), "population_female")
    return tables.upsert(target, batch, keys)


@query
def stream_new_files(spark, sf):
    folder = new_folder(spark, "arrivals")
    schema = table(spark, sf, "events").schema.simpleString()[7:-1].replace(":", " ")
    for _ in range(2):  # the second call finds nothing new
        arrivals.intake(spark, sf, schema, f"{folder}/sink", f"{folder}/state",
                        glob="events.parquet")
    rows = arrivals.current_rows(spark, f"{folder}/sink", ["event_id"], ["ts"])
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                          F.countDistinct("user_id").alias("users"))


@query
def stream_current_state(spark, sf):
    """Events delivered three times: in two files, one of them again, and the other with changes."""
    folder = new_folder(spark, "deliveries")
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    schema = "event_id bigint, event_type string, user_id bigint"
    events = events.select(*[col(c).cast(t.split()[1]) for c, t in zip(events.columns, schema.split(", "), strict=True)])

    def deliver(rows, day, name):
        rows.coalesce(1).write.parquet(f"{folder}/raw/{day}/{name}")

    def take_in():
        arrivals.intake_current(spark, f"{folder}/raw", schema, f"{folder}/table", f"{folder}/log", f"{folder}/state",
                                ["event_type", "event_id"], "event_type", glob="*.parquet")

    odd = events.where("event_id % 2 = 1")
    deliver(events.where("event_id % 2 = 0"), "day1", "even")
    deliver(odd, "day1", "odd")
    take_in()
    deliver(odd, "day2", "again")
    deliver(events.where("event_id % 10 = 0").withColumn("user_id", col("user_id") + 1_000_000), "day2", "changed")
    for _ in range(2):  # the second call finds nothing new
        take_in()
    files = (spark.read.schema(arrivals.LOG_SCHEMA).parquet(f"{folder}/log").groupBy("status")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("total")))
    rows = tables.read_stored(spark, f"{folder}/table").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("total"))
    return (rows.select(F.lit("rows").alias("of"), col("event_type").alias("name"), "n", "total")
            .unionByName(files.select(F.lit("files").alias("of"), col("status").alias("name"), "n", "total")))


# ---- checks --------------------------------------------------------------------

@query
def dq_not_null(spark, sf):
    return checks.not_null(_unemployment(spark, sf), "municipality_code").select(
        "municipality_name", "province_name", "data_year", "data_month")


@query
def dq_unique(spark, sf):
    return checks.unique(_dictionary(spark, sf), ["municipality_code"])


@query
def dq_unique_combination(spark, sf):
    return checks.unique(_yearly(spark, sf), ["municipality_code", "data_year"])


@query
def dq_accepted_values(spark, sf):
    return checks.accepted_values(_yearly(spark, sf), "unemployment_trend", [
        "no_comparison_data", "stable", "moderate_increase", "moderate_decrease"]).select(
        *PLACE_YEAR, "unemployment_trend")


@query
def dq_accepted_range(spark, sf):
    staged = _unemployment(spark, sf)
    return checks.accepted_range(staged, "men_unemployment_percentage", 5, 95,
                                 where=col("municipality_code").isNotNull()).select(
        "province_code", "municipality_code", "data_year", "data_month", "men_unemployment_percentage")


@query
def dq_not_empty(spark, sf):
    return checks.not_empty(derive(spark, sf, "raw_population"), "municipality_name").select(
        "province_code", "cmun", "data_year")


@query
def dq_expression(spark, sf):
    parts = col("total_men_unemployment") + col("total_women_unemployment")
    return checks.expression_holds(_unemployment(spark, sf), parts == col("total_unemployment")).select(
        "municipality_name", "data_year", "data_month", "total_unemployment",
        "total_men_unemployment", "total_women_unemployment")


@query
def dq_suite(spark, sf):
    df = freeze(_trends(spark, sf))
    change = col("total_population") - col("previous_year_population")
    consistent = ((col("population_change").isNull() & col("previous_year_population").isNull())
                  | (col("population_change") == change))
    return checks.run_suite(df, [
        checks.Check("name_not_null", col("municipality_name").isNull()),
        checks.Check("community_not_null", col("autonomous_community_code").isNull(), severity="warn"),
        checks.Check("population_positive", checks.out_of_range("total_population", 1)),
        checks.Check("growth_in_range", checks.out_of_range("population_change_pct", -30, 30),
                     severity="warn", allow=10),
        checks.Check("rank_from_one", checks.out_of_range("population_rank_national", 1)),
        checks.Check("trend_values", checks.out_of_values("population_trend", [
            "growth", "decline", "stable", "no_data"])),
        checks.Check("change_consistent", ~consistent),
        checks.Check("place_year_unique", unique=tuple(PLACE_YEAR)),
        checks.Check("code_year_unique", unique=("municipality_code", "data_year"), severity="warn"),
    ])


@query
def dq_suite_unemployment(spark, sf):
    return checks.run_suite(_unemployment(spark, sf), suites.unemployment(BOUNDS))


@query
def dq_suite_yearly(spark, sf):
    """Declared checks of the rollup; the key without the province is not unique."""
    return checks.run_suite(freeze(_yearly(spark, sf)),
                            suites.yearly(BOUNDS, key=("municipality_code", "data_year")))


def _declared(spark):
    return declaration_table(spark, suites.declared(BOUNDS, RATE_YEARS))


def _rates(spark, sf):
    return marts.unemployment_rates(_trends(spark, sf), _yearly(spark, sf), RATE_YEARS)


def _socioeconomic(spark, sf):
    return marts.socioeconomic_trends(_trends(spark, sf), _yearly(spark, sf), RATE_YEARS)


#: Models whose declared checks are run from the table.
MODELS = {"municipalities": _dictionary, "provinces": _provinces, "population": _population, "contracts": _contracts,
          "population_trends": _trends, "rates": _rates, "socioeconomic": _socioeconomic}


def _declared_query(model: str, build: Query) -> Query:
    def run(spark, sf):
        return run_declared(_declared(spark), {model: freeze(build(spark, sf))})
    run.__name__ = f"declared_{model}"
    return run


for _model, _build in MODELS.items():
    query(_declared_query(_model, _build))


@query
def declared_by_tag(spark, sf):
    """Keys and ranges of three models; a model without such a check is not read."""
    models = {m: MODELS[m](spark, sf) for m in ("municipalities", "provinces", "population")}
    return run_declared(_declared(spark), models, tags=["keys", "range"])


@query
def year_completeness(spark, sf):
    return checks.year_completeness(_population(spark, sf), "data_year", 1994, 2002, [1996])


@query
def count_outliers(spark, sf):
    return checks.count_outliers(_population(spark, sf), "data_year",
                                 ["province_code", "municipality_code"], floor=0, sigmas=1.0)


@query
def group_completeness(spark, sf):
    return checks.group_completeness(_unemployment(spark, sf), "province_name", "data_year",
                                     share=0.99, min_median=20)


@query
def group_completeness_contracts(spark, sf):
    return checks.group_completeness(_contracts(spark, sf), "province_name", "data_year",
                                     share=0.99, min_median=20, dataset="Contracts data")


@query
def completion_effectiveness_contracts(spark, sf):
    return checks.completion_effectiveness(_contracts(spark, sf), "municipality_code",
                                           "municipality_code_completed", target_pct=99.9)


@query
def quality_summary(spark, sf):
    return reports.quality_summary(_unemployment(spark, sf), _contracts(spark, sf))


@query
def completion_effectiveness(spark, sf):
    return checks.completion_effectiveness(_unemployment(spark, sf), "municipality_code",
                                           "municipality_code_completed", target_pct=99.9)


@query
def mapping_consistency(spark, sf):
    keys = ["province_code", "municipality_name"]
    return checks.mapping_consistency(_unemployment(spark, sf), _contracts(spark, sf), keys, "municipality_code")


@query
def dictionary_validation(spark, sf):
    renumbered = F.when(col("province_code") % 7 == 3, col("province_code") + 100).otherwise(col("province_code"))
    provinces = _provinces(spark, sf).withColumn("province_code", renumbered)
    return checks.compare_dictionaries(_dictionary(spark, sf), provinces)


@query
def dictionary_code_ranges(spark, sf):
    return checks.code_ranges(_dictionary(spark, sf), {
        "autonomous_community_code": (1, 19), "province_code": (1, 20), "check_digit": (0, 9)})


# ---- dashboard -----------------------------------------------------------------

def _selection(spark, sf):
    """Marts filtered as a dashboard user would: three years, most provinces."""
    names = [f"NATION_{i}" for i in range(25) if i % 5]
    return dashboard.filtered(_population(spark, sf).withColumnRenamed(
        "population_total", "total_population"), [1998, 2000, 2001], _provinces(spark, sf), names)


@query
def dash_recent_top(spark, sf):
    return dashboard.recent_top(_changes(spark, sf)).select(*PLACE_YEAR, "total_population")


@query
def dash_filter_values(spark, sf):
    return dashboard.filter_values(_changes(spark, sf), _provinces(spark, sf))


@query
def dash_filtered(spark, sf):
    latest = dashboard.filtered(_changes(spark, sf), None, _provinces(spark, sf),
                                ["NATION_1", "NATION_2", "NATION_3", "NATION_15"])
    return latest.select(*PLACE_YEAR, "total_population")


@query
def dash_kpis(spark, sf):
    return dashboard.kpis(_selection(spark, sf))


@query
def dash_population_by_year(spark, sf):
    return dashboard.population_by_year(_selection(spark, sf))


@query
def dash_growth(spark, sf):
    return dashboard.growth(_selection(spark, sf))


@query
def dash_gender(spark, sf):
    return dashboard.gender_split(_selection(spark, sf))


@query
def dash_top10(spark, sf):
    return dashboard.top_places(_selection(spark, sf), _dictionary(spark, sf))


@query
def dash_detail(spark, sf):
    shown = dashboard.detail(_selection(spark, sf).drop("province_name", "source_file"),
                             _dictionary(spark, sf), _provinces(spark, sf))
    return shown
