"""Sheet grids to tidy rows.

A grid row is (source_file, sheet_no, sheet, row_idx, cells ARRAY<STRING>).  What
has to be known about a sheet (first data row, width) is one aggregate per sheet.
The rows then meet it by broadcast, without a shuffle of the cells; when there are
too many sheets for that, in a salted join, so one huge sheet is spread over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from comarca.functions import fixed_values as fv
from comarca.functions.text import (canonical_header, file_period, heading_pattern, label_key,
                                    lenient_number, parse_number, sheet_type_and_province, strip,
                                    two_digit_year)
from comarca.operators.joins import lookup_join
from comarca.operators.ranking import last_wins
from comarca.session import freeze

SHEET = ["source_file", "sheet_no", "sheet"]


@dataclass(frozen=True)
class Vintages:
    """Last years of the sheet layouts, and where data may start.

    ``search_rows`` and ``header_rows`` can bound the search for the first data row and the
    header to the top of a sheet; by default every row is looked at.
    """

    wide_last: int = fv.WIDE_VINTAGE_LAST_YEAR
    old_last: int = fv.OLD_VINTAGE_LAST_YEAR
    search_rows: int | None = None
    min_code: int = 1000
    header_rows: int | None = None
    default_header: int = 1
    drop_province_name: str = "equal"  # or "contains"
    measures: dict = field(default_factory=lambda: {
        "unemployment": fv.UNEMPLOYMENT_MEASURES, "contracts": fv.CONTRACT_MEASURES})

    def of(self, year: Column) -> Column:
        return (F.when(year <= self.wide_last, "wide").when(year <= self.old_last, "old")
                 .when(year.isNotNull(), "new"))

    def layout(self, data_type: str, vintage: str) -> list[str | None]:
        """Column name per cell; None for cells that are not used."""
        head = ["municipality_code" if vintage == "new" else None, "municipality_name"]
        extra = [None] * 3 if vintage == "wide" and data_type == "unemployment" else []
        return head + list(self.measures[data_type]) + extra


DEFAULT = Vintages()


def is_number_cell(c: Column) -> Column:
    """Digits once dots and commas are removed."""
    return F.regexp_replace(c, "[.,]", "").rlike("^[0-9]+$")


def looks_like_header(cells: Column) -> Column:
    """At least three filled cells, of which at least half are words."""
    filled = F.filter(cells, lambda c: c.isNotNull())
    words = F.size(F.filter(filled, lambda c: ~is_number_cell(c)))
    return (F.size(filled) >= 3) & (words * 2 >= F.size(filled))


def with_first_cells(grid: DataFrame) -> DataFrame:
    """The grid with code cell, name cell and width as columns of their own (unless it has them)."""
    if "_width" in grid.columns:
        return grid
    cells = F.col("cells")
    return grid.withColumns({"_code": F.get(cells, F.lit(0)), "_name": F.get(cells, F.lit(1)),
                             "_width": F.size(cells)})


def kept_grid(grid: DataFrame) -> DataFrame:
    """The grid decoded once and kept.

    Profile and noise filter look at two cells and the width of a row; these are kept beside
    the cells, so whoever needs no more does not decode all cells of the kept copy.
    """
    return freeze(with_first_cells(grid))


def _within(rows: int | None) -> Column:
    return F.lit(True) if rows is None else F.col("row_idx") < rows


def header_rows(grid: DataFrame, v: Vintages = DEFAULT) -> DataFrame:
    """Header row of every sheet: the first header-like row, else the default."""
    near_top = _within(v.header_rows)
    found = F.min(F.when(near_top & looks_like_header(F.col("cells")), F.col("row_idx")))
    return grid.groupBy(*SHEET).agg(F.coalesce(found, F.lit(v.default_header)).alias("header_row"))


def _is_old_data(name: Column) -> Column:
    return ((F.length(name) > 3) & name.rlike("[a-zA-Z]")
            & ~F.upper(name).isin(fv.TITLE_CELLS))


def sheet_profile(grid: DataFrame, v: Vintages = DEFAULT) -> DataFrame:
    """One row per sheet: type, province, year, month, vintage, first data row, width."""
    year, month = file_period(F.col("source_file"))
    kind, province = sheet_type_and_province(F.col("sheet"))
    near_top = _within(v.search_rows)

    def first(is_data: Column) -> Column:
        return F.min(F.when(near_top & is_data, F.col("row_idx")))

    # names of files and sheets are read once per sheet: both kinds of start are sought, and the
    # aggregate is kept, for a filter on the type would be moved in front of it, to every row
    facts = freeze(with_first_cells(grid).groupBy(*SHEET).agg(
        first(_is_old_data(F.col("_name"))).alias("_old_start"),
        first(parse_number(F.col("_code")) > v.min_code).alias("_new_start"),
        F.max("_width").alias("width"), F.count(F.lit(1)).alias("sheet_rows")))
    start = F.when(year <= v.old_last, F.col("_old_start")).otherwise(F.col("_new_start"))
    return facts.select(*SHEET, start.alias("data_start"), "width", "sheet_rows", kind.alias("data_type"),
                        province.alias("province"), year.alias("year"), month.alias("month"),
                        v.of(year).alias("vintage"))


def keep_last_sheet(profile: DataFrame) -> DataFrame:
    """A later sheet of the same province replaces the earlier one."""
    usable = profile.where(F.col("data_type").isin(list(fv.SHEET_PREFIXES.values()))
                           & F.col("data_start").isNotNull())
    return last_wins(usable.withColumn("_province", label_key(F.col("province"))),
                     ["source_file", "data_type", "_province"], ["sheet_no"]).drop("_province")


def rejected_sheets(grid: DataFrame, v: Vintages = DEFAULT) -> DataFrame:
    """Sheets of which no row is used, with the reason and their number of rows."""
    profile = freeze(sheet_profile(grid, v))  # a row per sheet, read twice
    known = F.coalesce(F.col("data_type").isin(list(fv.SHEET_PREFIXES.values())), F.lit(False))
    kept = keep_last_sheet(profile).select(*SHEET, F.lit(True).alias("_kept"))
    reason = (F.when(~known, "unknown_type").when(F.col("data_start").isNull(), "no_data_row")
               .when(F.col("_kept").isNull(), "later_sheet"))
    return (profile.join(kept, SHEET, "left").withColumn("reason", reason).where("reason is not null")
            .select(*SHEET, "data_type", "sheet_rows", "reason"))


def data_rows(grid: DataFrame, profile: DataFrame) -> DataFrame:
    """Rows from the first data row on, with the facts about their sheet."""
    return (lookup_join(with_first_cells(grid), profile.drop("sheet", "sheet_rows"), ["source_file", "sheet_no"],
                        "inner", derived=True, salt_on=["row_idx"])
            .where(F.col("row_idx") >= F.col("data_start")))


def noise_reason(v: Vintages = DEFAULT) -> Column:
    """Why a row of ``data_rows`` is dropped, null for rows that are kept."""
    code, name = F.col("_code"), F.col("_name")
    old = F.col("vintage") != "new"
    province = F.lower(F.col("province"))
    about_province = (F.lower(strip(name)) == province if v.drop_province_name == "equal"
                      else F.lower(name).contains(province))
    number = parse_number(code)
    too_narrow = F.lit(False)
    for data_type in v.measures:
        too_narrow = too_narrow | ((F.col("data_type") == data_type)
                                   & (F.col("width") < len(v.layout(data_type, "new"))))
    return (F.when(~old & too_narrow, "too_few_columns")
             .when(~old & code.isNull(), "no_code")
             .when(~old & number.isNull(), "code_not_numeric")
             .when(old & name.isNull(), "no_name")
             .when(old & (F.length(name) <= 3), "short_name")
             .when(old & name.rlike(heading_pattern()), "heading")
             .when(old & about_province, "province_name"))


def project_layout(rows: DataFrame, data_type: str, v: Vintages = DEFAULT) -> DataFrame:
    """Cells to named columns by layout, cleaned; missing measure cells become 0,
    measures a narrow old sheet does not have stay null."""
    layout = v.layout(data_type, "new")
    names = v.measures[data_type]
    first = layout.index(names[0])
    # the cells of all measures are parsed by one expression, not one per column
    parsed = F.transform(F.slice("cells", first + 1, len(names)),
                         lambda c: lenient_number(c, drop_blanks=data_type == "contracts"))
    code = parse_number(F.col("_code")).cast("bigint")
    rows = rows.where(F.col("data_type") == data_type).withColumn("_parsed", parsed)
    measures = [F.when(F.col("width") > i, F.coalesce(F.get(F.col("_parsed"), F.lit(i - first)), F.lit(0.0)))
                .alias(name) for i, name in enumerate(names, start=first)]
    return rows.select(
        "source_file", "sheet", "row_idx",
        F.when(F.col("vintage") == "new", code).otherwise(F.lit(0)).alias("municipality_code"),
        strip(F.col("_name")).alias("municipality_name"),
        *measures, "province", "year", "month", "data_type")


def tidy_rows(grid: DataFrame, data_type: str, v: Vintages = DEFAULT) -> DataFrame:
    """Grid to tidy rows of one data type.

    The grid is decoded once and kept: the profile and the rows read the kept copy.
    """
    grid = kept_grid(grid)
    profile = keep_last_sheet(sheet_profile(grid, v)).where(F.col("data_type") == data_type)
    rows = data_rows(grid, profile).where(noise_reason(v).isNull())
    return project_layout(rows, data_type, v)


def rejected_rows(grid: DataFrame, v: Vintages = DEFAULT) -> DataFrame:
    """Data rows that were dropped, with the reason; the grid is decoded once, as in ``tidy_rows``."""
    grid = kept_grid(grid)
    rows = data_rows(grid, keep_last_sheet(sheet_profile(grid, v)))
    return (rows.withColumn("reason", noise_reason(v)).where(F.col("reason").isNotNull())
            .select(*SHEET, "row_idx", "data_type", "reason"))


POPULATION_COLUMNS = ["province_code", "province_name", "cmun", "municipality_code",
                      "municipality_name", *fv.POPULATION_MEASURES]


def population_rows(grid: DataFrame, v: Vintages = DEFAULT,
                    columns: list[str] = POPULATION_COLUMNS) -> DataFrame:
    """Population sheets to tidy rows: every sheet names its columns in its own way.

    The header row of a sheet is turned into the cell position of each canonical
    column; the positions travel with the sheet, so sheets of all years are read in
    one job without a schema per file.  The grid is decoded once, as in ``tidy_rows``.
    """
    grid = freeze(grid)
    near_top = _within(v.header_rows)
    header = F.struct(F.col("row_idx"), F.col("cells"))
    fallback = F.min(F.when(F.col("row_idx") == v.default_header, header))
    found = F.min(F.when(near_top & looks_like_header(F.col("cells")), header))
    # a sheet without the default row still has its first row
    headers = grid.groupBy(*SHEET).agg(F.coalesce(found, fallback, F.min(header)).alias("h"))
    cells = headers.select("source_file", "sheet_no", F.col("h.row_idx").alias("header_row"),
                           F.posexplode("h.cells").alias("pos", "header"))
    names = cells.withColumn("column", canonical_header(F.col("header")))
    positions = names.groupBy("source_file", "sheet_no", "header_row").agg(
        *[F.min(F.when(F.col("column") == c, F.col("pos"))).alias(f"_at_{c}") for c in columns])
    rows = (lookup_join(grid, positions, ["source_file", "sheet_no"], "inner", derived=True,
                        salt_on=["row_idx"])
            .where(F.col("row_idx") > F.col("header_row")))
    filled = F.exists("cells", lambda c: c.isNotNull())
    first = F.lower(F.coalesce(F.get(F.col("cells"), F.lit(0)), F.lit("")))
    subtotal = first.rlike("|".join(fv.SUBTOTAL_WORDS))

    def value(c: str) -> Column:
        cell = F.get(F.col("cells"), F.col(f"_at_{c}"))
        return parse_number(cell).alias(c) if c.startswith("population") else cell.alias(c)

    return (rows.where(filled & ~subtotal)
            .select("source_file", "sheet", "row_idx", *[value(c) for c in columns],
                    two_digit_year(F.col("source_file")).alias("data_year")))
