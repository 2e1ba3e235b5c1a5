"""CSV scans: records cut where line breaks lie outside of quotes, cells found by the names in each
file's header."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from comarca.functions.text import canonical_header
from comarca.operators.headers import dedupe_headers, settle_ambiguous
from comarca.operators.joins import lookup_join
from comarca.session import freeze

CORRUPT = "_corrupt_record"
#: Marks inside a record while its cells are cut: code points that no text may hold.
CUT, LITERAL_QUOTE = "\ufdd0", "\ufdd1"
#: Lines a record may have.
RECORD_LINES = 10_000


def _structural(record: Column, separator: str) -> Column:
    """The record with quotes that cannot open or close a cell (``5" pipe``) masked."""
    sep = re.escape(separator)
    return F.regexp_replace(record, rf'(?<=[^{sep}"\s])"(?=[ \t]*[^{sep}"\s])', LITERAL_QUOTE)


def _open_quote(record: Column, separator: str) -> Column:
    """Whether the record holds an odd number of quotes."""
    masked = _structural(record, separator)
    return (F.char_length(masked) - F.char_length(F.replace(masked, F.lit('"'), F.lit("")))) % 2 == 1


def raw_cells(line: Column, separator: str = ",") -> Column:
    """Cells of a record as they stand; separators inside double quotes do not count.

    One pass: the pieces between quotes lie outside and inside by turns, and only the separators
    of the outer ones become cuts.
    """
    pieces = F.split(_structural(line, separator), '"', -1)
    cut = F.transform(pieces, lambda p, i: F.when(i % 2 == 0, F.replace(p, F.lit(separator), F.lit(CUT))).otherwise(p))
    return F.transform(F.split(F.array_join(cut, '"'), CUT, -1), lambda c: F.trim(c))


def _is_quoted(cell: Column) -> Column:
    return cell.startswith('"') & cell.endswith('"') & (F.length(cell) > 1)


def cell_texts(raw: Column) -> Column:
    """Raw cells without their quotes; doubled quotes are one, an empty cell is null."""
    texts = F.transform(raw, lambda c: F.when(
        _is_quoted(c), F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))
    return F.transform(texts, lambda c: F.nullif(F.replace(c, F.lit(LITERAL_QUOTE), F.lit('"')), F.lit("")))


def line_cells(line: Column, separator: str = ",") -> Column:
    """Texts of the cells of a record."""
    return cell_texts(raw_cells(line, separator))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, split and place: in a split they are numbered as they stand."""
    return (spark.read.option("recursiveFileLookup", True).text(path)
            .select("value", F.col("_metadata.file_path").alias("_path"),
                    F.col("_metadata.file_name").alias("source_file"),
                    F.col("_metadata.file_block_start").alias("_start"))
            .withColumn("_id", F.monotonically_increasing_id()))


def _assembled(lines: DataFrame, separator: str, max_lines: int) -> DataFrame:
    """Records of files in which a quoted cell may hold line breaks.

    A line belongs to the record before it if an odd number of quotes stands before it in its
    file.  A running parity inside each split (a window no larger than the split) gives that for
    either way the split may begin; sums per split, put in order per file, tell which way it
    does, and number the records, so a record may run over any number of splits.
    """
    place = Window.partitionBy("_path", "_start").orderBy("_id")
    odd = _open_quote(F.col("value"), separator).cast("long")
    before = F.coalesce(F.sum("_odd").over(place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    lines = lines.withColumn("_odd", odd).withColumn("_before", before)
    # records that begin up to a line, if its split begins outside (0) or inside (1) of quotes
    running = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = freeze(lines.withColumns({f"_begun{w}": F.sum((F.col("_before") == w).cast("long")).over(running)
                                      for w in (0, 1)}))
    splits = lines.groupBy("_path", "_start").agg(
        F.sum("_odd").alias("odd"), F.max("_begun0").alias("begun0"), F.max("_begun1").alias("begun1"))
    earlier = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = (splits.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
              .withColumn("first", F.coalesce(F.sum(F.when(F.col("inside") == 1, F.col("begun1"))
                                                    .otherwise(F.col("begun0"))).over(earlier), F.lit(0)))
              .select("_path", "_start", "inside", "first"))
    numbered = lookup_join(lines, splits, ["_path", "_start"], "inner", derived=True, salt_on=["_id"]).withColumn(
        "_no", F.col("first") + F.when(F.col("inside") == 1, F.col("_begun1")).otherwise(F.col("_begun0")))
    # a quote that is never closed near by would make one record of the rest: such lines stay lines
    runaway = (numbered.groupBy("_path", "_no").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_lines)
               .select("_path", "_no", F.lit(True).alias("_runaway")))
    numbered = lookup_join(numbered, runaway, ["_path", "_no"], derived=True, salt_on=["_id"])
    alone = F.when(F.col("_runaway"), F.struct("_start", "_id"))
    return (numbered.groupBy("_path", "source_file", "_no", alone.alias("_alone"))
            .agg(F.array_sort(F.collect_list(F.struct("_start", "_id", "value"))).alias("said"))
            .select(F.array_join("said.value", "\n").alias("value"), "_path", "source_file",
                    F.struct("_no", "_alone").alias("_no")))


def records(spark: SparkSession, path: str, separator: str = ",", max_lines: int = RECORD_LINES) -> DataFrame:
    """(value, _path, source_file, _no): records below ``path``; the least ``_no`` is the header.

    A record is a line, or several where a quoted cell holds line breaks (kept as newlines).
    Only files that have a line with an open quote are put together; the others are read as
    they are, without a shuffle.  A file whose quotes do not balance is read line by line, as
    are records of more than ``max_lines`` lines.  Blank records are no records.
    """
    lines = _lines(spark, path)
    odd = _open_quote(F.col("value"), separator).cast("long")
    files = freeze(lines.groupBy("_path").agg(F.sum(odd).alias("odd")).where(F.col("odd") > 0)
                   .select("_path", (F.col("odd") % 2 == 0).alias("_balanced")))
    # only the first split of a file can hold its first line
    whole = F.struct(F.when(F.col("_start") == 0, F.col("_id")).alias("_no"),
                     F.lit(None).cast("struct<_start:bigint,_id:bigint>").alias("_alone")).alias("_no")
    plain = ["value", "_path", "source_file", whole]
    if files.isEmpty():
        found = lines.select(*plain)
    else:
        marked = lookup_join(lines, files, ["_path"], derived=False, salt_on=["_id"])
        balanced = F.coalesce("_balanced", F.lit(False))
        found = marked.where(~balanced).select(*plain).unionByName(
            _assembled(marked.where(balanced).drop("_balanced"), separator, max_lines))
    return found.where(F.trim("value") != "")


def file_headers(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """(_path, header, cells): the first record of every file that has one."""
    return _headers(records(spark, path, separator), separator)


def _headers(rows: DataFrame, separator: str) -> DataFrame:
    first = (rows.where(F.col("_no._no").isNotNull()).groupBy("_path").agg(F.min_by("value", "_no").alias("header")))
    return first.withColumn("cells", line_cells(F.ltrim(F.col("header"), F.lit("\ufeff")), separator))


def _placed(found: DataFrame, separator: str, headers: DataFrame) -> DataFrame:
    """Data records with their cells, the positions of the names, and the record itself if it is
    bad: it has an open quote, a cell with more behind its quotes, or not as many cells as its header.

    A record equal to its file's header is no data (files that were joined repeat it).
    """
    rows = lookup_join(found, headers, ["_path"], "inner", derived=True, salt_on=["value"])
    rows = rows.where(F.col("value") != F.col("header")).withColumn("_raw", raw_cells(F.col("value"), separator))
    bad = ((F.size("_raw") != F.col("_width")) | _open_quote(F.col("value"), separator)
           | F.exists("_raw", lambda c: c.startswith('"') & ~_is_quoted(c)))
    rows = rows.withColumn("_cells", cell_texts(F.col("_raw")))
    return rows.withColumn(CORRUPT, F.when(bad, F.col("value")))


def read_csv(spark: SparkSession, path: str, schema: str, separator: str = ",") -> DataFrame:
    """Header CSVs below ``path``, columns matched by name; a column that a file lacks is null.

    Records that are cut or too long, and those with a value that does not have its type, are
    kept in ``_corrupt_record``, whatever columns are selected later.  ``source_file`` names
    the file of every row; empty files give no rows.  See ``records`` for line breaks in cells.
    """
    found = records(spark, path, separator)
    headers = _headers(found, separator)
    fields = StructType.fromDDL(schema).fields
    # of columns with the same name the first counts
    at = F.map_from_arrays(F.array(*[F.lit(f.name) for f in fields]), F.array(
        *[F.nullif(F.array_position("cells", f.name).cast("int"), F.lit(0)) - 1 for f in fields]))
    rows = _placed(found, separator, headers.select("_path", "header", F.size("cells").alias("_width"), at.alias("_at")))

    def text(name: str) -> Column:
        return F.get(F.col("_cells"), F.try_element_at("_at", F.lit(name)))

    wrong = F.lit(False)
    for f in fields:
        wrong = wrong | (text(f.name).isNotNull() & text(f.name).try_cast(f.dataType).isNull())
    corrupt = F.coalesce(F.col(CORRUPT), F.when(wrong, F.col("value")))
    return rows.select(*[text(f.name).try_cast(f.dataType).alias(f.name) for f in fields],
                       corrupt.alias(CORRUPT), "source_file")


def good_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNotNull()).select("source_file", CORRUPT)


def read_drifting_csv(spark: SparkSession, path: str, separator: str = ",", rules=None) -> DataFrame:
    """Header CSVs of many years as one table of text columns with canonical names.

    The header of each file becomes the positions of its columns, so files of all kinds are
    read by one scan; columns a file lacks are null.  Bad lines are kept in
    ``_corrupt_record``.  A folder without lines gives an empty table.
    """
    found = records(spark, path, separator)
    headers = freeze(_headers(found, separator))
    spelled = headers.select("_path", F.posexplode("cells").alias("pos", "cell"))
    unnamed = F.concat(F.lit("unnamed_column_"), F.col("pos"))
    named = dedupe_headers(spelled.withColumn("name", F.coalesce(canonical_header(F.col("cell"), rules), unnamed)),
                           ["_path"], "name", "pos")
    placed = freeze(named.groupBy("_path").agg(F.map_from_entries(F.collect_list(F.struct("name", "pos"))).alias("_at"))
                    .join(headers.select("_path", "header", F.size("cells").alias("_width")), "_path"))
    # the columns of the table: one name per distinct spelling
    names = [r.name for r in placed.select(F.explode(F.map_keys("_at")).alias("name")).distinct()
             .orderBy("name").collect()]
    rows = _placed(found, separator, placed)
    cells = rows.select(*[F.get(F.col("_cells"), F.try_element_at("_at", F.lit(n))).alias(n) for n in names],
                        CORRUPT, "source_file")
    return settle_ambiguous(cells, ["source_file"])
