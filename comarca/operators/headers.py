"""Header and column cleaning for tables whose columns drift between files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from comarca.functions import fixed_values as fv
from comarca.functions.text import canonical_header, pad_code, parse_number
from comarca.operators.joins import lookup_join
from comarca.operators.ranking import first_per_key


def dedupe_headers(headers: DataFrame, keys: list[str], name: str, position: str) -> DataFrame:
    """Repeated names of one file get ``_1``, ``_2``; a group is one file's header.

    Numbers that would make a name the header already has are passed over, so
    ``a, a, a_1`` becomes ``a, a_2, a_1``.
    """
    by_name = W.partitionBy(*keys, name)
    nth = F.row_number().over(by_name.orderBy(position)) - 1
    taken = F.collect_set(name).over(W.partitionBy(*keys))
    free = F.filter(F.sequence(F.lit(1), F.col("_nth") + F.size("_taken")),
                    lambda i: ~F.array_contains(F.col("_taken"), F.concat_ws("_", name, i)))
    return (headers.withColumn("_nth", nth).withColumn("_taken", taken).withColumn(
        name, F.when(F.col("_nth") == 0, F.col(name))
               .otherwise(F.concat_ws("_", name, F.element_at(free, F.col("_nth").cast("int")))))
            .drop("_nth", "_taken"))


def canonical_names(spark: SparkSession, spelled: list[str], rules=None) -> list[str]:
    """Canonical column names of one header.

    The header becomes a tiny table, is renamed by the same expressions as header
    tables, and comes back as a list; no data is touched.
    """
    headers = spark.createDataFrame(list(enumerate(spelled)), "pos int, header string")
    unnamed = F.concat(F.lit("unnamed_column_"), F.col("pos"))
    named = headers.withColumn("name", F.coalesce(canonical_header(F.col("header"), rules), unnamed))
    named = dedupe_headers(named, [], "name", "pos")
    return [r.name for r in named.orderBy("pos").collect()]


def rename_columns(df: DataFrame, spelled: list[str], rules=None) -> DataFrame:
    """Give the columns of ``df``, in order, the canonical form of other spellings."""
    return df.toDF(*canonical_names(df.sparkSession, spelled, rules))


def canonical_columns(df: DataFrame, rules=None) -> DataFrame:
    """Rename the columns of ``df`` to their canonical names."""
    return rename_columns(df, df.columns, rules)


def settle_ambiguous(df: DataFrame, keys: list[str], column: str = "province") -> DataFrame:
    """Move an ambiguous column to a code or a name, for each file (``keys``) on its own: a
    code when all its filled values are digits.  Values that the file has under the settled
    name stay."""
    if column not in df.columns:
        return df
    kinds = (df.where(F.col(column).isNotNull()).groupBy(*keys)
             .agg(F.min(F.col(column).rlike("^[0-9]+$")).alias("_code")))
    out = lookup_join(df, kinds, keys, "left", derived=True)
    for name, is_code in (("province_code", True), ("province_name", False)):
        moved = F.when(F.col("_code") == is_code, F.col(column))
        out = out.withColumn(name, F.coalesce(F.col(name), moved) if name in df.columns else moved)
    return out.drop(column, "_code")


def union_drifting(frames: list[DataFrame], rules=None) -> DataFrame:
    """One table from files with different headers; columns a file lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [canonical_columns(f, rules) for f in frames])


def drop_empty_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.dropna("all", subset=columns)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any value; one aggregate of one row decides."""
    filled = df.agg(*[F.max(F.col(f"`{c}`").isNotNull()).alias(c) for c in df.columns]).first()
    return df.select([c for c in df.columns if filled[c]])


def drop_subtotals(df: DataFrame, column: str, words: list[str] = fv.SUBTOTAL_WORDS) -> DataFrame:
    """Drop rows whose first column names a total; null is kept."""
    return df.where(~F.coalesce(F.lower(F.col(column)).rlike("|".join(words)), F.lit(False)))


def drop_non_numeric(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose key is not a number (separators, headings)."""
    return df.where(parse_number(F.col(column)).isNotNull())


def count_non_numeric(df: DataFrame, column: str) -> DataFrame:
    """How many rows ``drop_non_numeric`` keeps and removes."""
    good = parse_number(F.col(column)).isNotNull()
    return df.agg(F.count_if(good).alias("rows_kept"), F.count_if(~good).alias("rows_removed"))


def sniff_code_or_name(df: DataFrame, keys: list[str], column: str, position: str,
                       sample: int | None = None) -> DataFrame:
    """Is an ambiguous column a code or a name?  Code when its filled values are all
    digits; ``sample`` can bound the look to the first of them."""
    head = df.where(F.col(column).isNotNull())
    if sample is not None:
        head = first_per_key(head, keys, [F.col(position)], sample)
    return (head.groupBy(*keys)
            .agg(F.min(F.col(column).rlike("^[0-9]+$")).alias("_code"))
            .select(*keys, F.when(F.col("_code"), "province_code")
                    .otherwise("province_name").alias("column_name")))


def standard_types(df: DataFrame) -> DataFrame:
    """Codes padded to their width, population columns numeric."""
    def cast(c: str) -> Column:
        if c == "province_code":
            return pad_code(F.col(c), 2).alias(c)
        if c == "municipality_code":
            return pad_code(F.col(c), 5).alias(c)
        if "population" in c:
            return parse_number(F.col(c).cast("string")).alias(c)
        return F.col(c)
    return df.select([cast(c) for c in df.columns])
