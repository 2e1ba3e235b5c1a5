"""Reports on processed sheets and staged tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from comarca.functions import fixed_values as fv
from comarca.functions.measures import half_up, pct
from comarca.operators.grid import Vintages


def quality_profile(staged: DataFrame, dataset: str, shares: list[str]) -> DataFrame:
    """Counts, code completion and impossible percentages of one staged table."""
    impossible = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) > 100, F.lit(False)) for c in shares])
    n, done = F.count(F.lit(1)), F.count_if("municipality_code_completed")
    return staged.agg(
        n.alias("total_records"), F.count("municipality_code").alias("records_with_codes"),
        done.alias("codes_completed"), pct(done, n).alias("code_completion_rate"),
        F.count_if(impossible).alias("percentage_issues"),
        F.countDistinct("province_name").alias("provinces_covered"),
        F.min("data_year").alias("earliest_year"), F.max("data_year").alias("latest_year"),
    ).select(F.lit(dataset).alias("dataset"), "*")


def quality_summary(unemployment: DataFrame, contracts: DataFrame) -> DataFrame:
    """The profiles of both tables, each with a sentence that sums it up."""
    said = F.concat(F.lit("Data quality of "), "dataset", F.lit(": "), F.col("codes_completed").cast("string"),
                    F.lit(" codes completed ("), F.coalesce(F.col("code_completion_rate").cast("string"), F.lit("-")),
                    F.lit("%), "), F.col("percentage_issues").cast("string"), F.lit(" impossible percentages"))
    return (quality_profile(unemployment, "unemployment",
                            ["men_unemployment_percentage", "women_unemployment_percentage"])
            .unionByName(quality_profile(contracts, "contracts", [
                "men_contracts_percentage", "women_contracts_percentage",
                "permanent_contracts_percentage"]))).withColumn("summary", said)


def sheet_quality(tidy: DataFrame, data_type: str, v: Vintages) -> DataFrame:
    """Suspicious values per sheet in long form: (file, sheet, issue, column, count)."""
    measures = v.measures[data_type]
    code, new = F.col("municipality_code"), F.col("year") > v.old_last
    issues = [("missing_code", "municipality_code", code.isNull()),
              ("placeholder_code", "municipality_code", new & (code == 0)),
              ("missing_name", "municipality_name", F.col("municipality_name").isNull())]
    issues += [("negative", c, F.col(c) < 0) for c in measures]
    issues.append(("too_high", measures[0], F.col(measures[0]) > fv.HIGH_TOTAL[data_type]))
    counted = tidy.groupBy("source_file", "sheet").agg(
        *[F.count_if(test).alias(f"_{i}") for i, (_, _, test) in enumerate(issues)])
    rows = F.array(*[F.struct(F.lit(issue).alias("issue"), F.lit(column).alias("column_name"),
                              F.col(f"_{i}").alias("violations"))
                     for i, (issue, column, _) in enumerate(issues)])
    return (counted.select("source_file", "sheet", F.inline(rows))
            .where(F.col("violations") > 0))


def processing_report(profile: DataFrame) -> DataFrame:
    """Files and sheets processed and failed.

    A file fails when its name gives no year and month, a data sheet when no data
    row was found in it.  Index and unknown sheets are not counted.
    """
    per_file = profile.groupBy("source_file").agg(
        F.min("year").alias("year"), F.min("month").alias("month"),
        F.max((F.col("vintage") == "new").cast("int")).alias("new"),
        F.count_if(F.col("data_type").isin(*fv.SHEET_PREFIXES.values())).alias("data_sheets"),
        F.count_if(F.col("data_type").isin(*fv.SHEET_PREFIXES.values())
                   & F.col("data_start").isNotNull()).alias("good_sheets"))
    named = F.col("year").isNotNull() & F.col("month").isNotNull()
    files, failed = F.count(F.lit(1)), F.count_if(~named)
    sheets, good = F.sum("data_sheets"), F.sum("good_sheets")
    return per_file.agg(
        files.alias("files_processed"), failed.alias("files_failed"),
        half_up((files - failed) * 100, files, 1).alias("file_success_pct"),
        F.count_if(F.col("new") == 0).alias("old_format_files"),
        F.count_if(F.col("new") == 1).alias("new_format_files"),
        good.alias("sheets_processed"), (sheets - good).alias("sheets_failed"),
        half_up(good * 100, sheets, 1).alias("sheet_success_pct"))


def coverage_summary(tidy: DataFrame) -> DataFrame:
    """Per data type: provinces, months with their range, files, distinct names."""
    month = F.col("year") * 100 + F.col("month")
    label = lambda c: F.format_string("%04d-%02d", F.floor(F.col(c) / 100), F.col(c) % 100)
    counted = tidy.groupBy("data_type").agg(
        F.countDistinct("province").alias("provinces"), F.countDistinct(month).alias("months"),
        F.min(month).alias("_first"), F.max(month).alias("_last"),
        F.countDistinct("source_file").alias("files"),
        F.countDistinct("municipality_name").alias("entities"),
        F.count(F.lit(1)).alias("records"))
    return counted.select("data_type", "provinces", "months", label("_first").alias("first_month"),
                          label("_last").alias("last_month"), "files", "entities", "records")
