"""Workbook scans: every sheet row becomes one grid row."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from comarca.operators.joins import lookup_join
from comarca.session import freeze

GRID_SCHEMA = ("source_file string, sheet_no int, sheet string, row_idx int, "
               "cells array<string>")

Decoder = Callable[[bytes], Iterable[tuple[int, str, int, list]]]


def read_text_grid(spark: SparkSession, path: str, separator: str = ";") -> DataFrame:
    """Delimited text workbooks: a line ``[sheet name]`` starts a sheet.

    Files are read in splits, so a workbook of any size is read by many tasks.  In a split the
    titles are carried forward by a window that is no larger than the split; lines before its
    first title belong to the last sheet of the splits before, and its numbers of lines and
    sheets go on from theirs.  Empty cells become null; lines above the first title are no rows.
    """
    lines = spark.read.text(path)
    if "source_file" not in lines.columns:  # else one folder per workbook names it
        lines = lines.withColumn("source_file", F.col("_metadata.file_name"))
    title = F.when(F.col("line").rlike(r"^\[[^\]]*\]\s*$"), F.regexp_extract("line", r"^\[([^\]]*)\]", 1))
    lines = lines.select("source_file", F.col("_metadata.file_path").alias("path"),
                         F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))
    lines = lines.withColumns({"id": F.monotonically_increasing_id(), "title": title})
    so_far = Window.partitionBy("path", "start").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = F.when(F.col("title").isNotNull(), F.col("no"))
    lines = freeze(lines.withColumn("no", F.count(F.lit(1)).over(so_far)).select(
        "source_file", "path", "start", "line", "no", F.col("title").isNull().alias("data"),
        F.count("title").over(so_far).alias("titles"), F.last("title", True).over(so_far).alias("title"),
        F.last(at, True).over(so_far).alias("title_at")))
    # a row per split
    splits = lines.groupBy("path", "start").agg(
        F.max("no").alias("n"), F.max("titles").alias("t"), F.max("title_at").alias("last_at"),
        F.max_by("title", "no").alias("last"))
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("lines_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    splits = splits.select("path", "start", "lines_before", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("titles_before"),
                           F.last("last", True).over(earlier).alias("title_before"),
                           F.last(F.col("lines_before") + F.col("last_at"), True).over(earlier).alias("at_before"))
    rows = lookup_join(lines, splits, ["path", "start"], "inner", derived=True, salt_on=["no"])
    cells = F.transform(F.split("line", f"\\Q{separator}\\E", -1), lambda c: F.nullif(c, F.lit("")))
    begun = F.coalesce(F.col("lines_before") + F.col("title_at"), F.col("at_before"))
    return rows.where(F.col("data") & begun.isNotNull()).select(
        "source_file", (F.col("titles_before") + F.col("titles") - 1).cast("int").alias("sheet_no"),
        F.coalesce("title", "title_before").alias("sheet"),
        (F.col("lines_before") + F.col("no") - begun - 1).cast("int").alias("row_idx"), cells.alias("cells"))


def read_workbooks(spark: SparkSession, path: str, decoders: list[Decoder],
                   glob: str = "*.xls*", rows_per_batch: int = 5000) -> DataFrame:
    """Binary workbooks through plug-in decoders, tried in order; one workbook is one
    task's unit of work.

    A decoder turns the bytes into (sheet_no, sheet, row_idx, cells).  When every
    decoder fails, the file yields one row with ``sheet = null`` and the error as its
    only cell, so a broken file is visible and does not stop the job.
    """
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["source_file", "sheet_no", "sheet", "row_idx", "cells"]
        for batch in batches:
            for name, content in zip(batch["source_file"], batch["content"]):
                errors = []
                for decoder in decoders:
                    try:
                        rows = [(name, n, s, i, None if c is None else
                                 [None if v is None else str(v) for v in c])
                                for n, s, i, c in decoder(bytes(content))]
                        break
                    except Exception as error:  # a broken file is data, not a crash
                        errors.append(f"{type(error).__name__}: {error}")
                else:
                    rows = [(name, -1, None, -1, errors)]
                for at in range(0, len(rows), rows_per_batch):
                    yield pd.DataFrame(rows[at:at + rows_per_batch], columns=columns)

    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
             .select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "content"))
    return files.mapInPandas(decode, GRID_SCHEMA)


def write_text_grid(grid: DataFrame, path: str, separator: str = ";") -> None:
    """Grid rows as delimited text, one folder per workbook with its rows in order.

    Rows stream through sorted tasks; no workbook is collected.
    """
    cells = F.transform("cells", lambda c: F.coalesce(c, F.lit("")))
    rows = grid.select("source_file", "sheet_no", "row_idx",
                       F.array_join(cells, separator).alias("line"))
    titles = (grid.select("source_file", "sheet_no", "sheet").distinct()
              .select("source_file", "sheet_no", F.lit(-1).alias("row_idx"),
                      F.concat(F.lit("["), "sheet", F.lit("]")).alias("line")))
    (rows.unionByName(titles).repartition("source_file")
     .sortWithinPartitions("source_file", "sheet_no", "row_idx")
     .select("source_file", "line").write.partitionBy("source_file").text(path))
