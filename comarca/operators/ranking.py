"""Row numbers in groups of any size, first rows per key, last write wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from comarca.operators.joins import fits_broadcast
from comarca.session import freeze

MAX_GROUP_ROWS = 2_000_000


def row_number_by(df: DataFrame, partition: list[str], order: list[Column], name: str,
                  largest_group: int | None = None,
                  max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """``row_number() over (partition by .. order by ..)`` for groups of any size.

    A window puts each group into one task.  ``largest_group`` is an upper bound of
    the group size the caller knows; without it the groups are counted.  Beyond
    ``max_group_rows`` the position comes from a range sort instead, in which no
    task holds more than its range.  ``order`` must end in a unique key.
    """
    if largest_group is None:
        largest_group = (df.groupBy(*partition).count()
                         .agg(F.coalesce(F.max("count"), F.lit(0))).first()[0])
    if largest_group <= max_group_rows:
        window = W.partitionBy(*partition).orderBy(*order)
        return df.withColumn(name, F.row_number().over(window))
    return _row_number_by_range(df, partition, order, name)


def _row_number_by_range(df: DataFrame, partition: list[str], order: list[Column],
                         name: str) -> DataFrame:
    """Row number = rows before this one in the sorted table - rows before its group."""
    spark = df.sparkSession
    keys = [F.col(c) for c in partition]
    # copies of a row have equal keys: the input task parts them into several ranges
    df, columns = df.withColumn("_task", F.spark_partition_id()), df.columns
    order = [*order, F.col("_task")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(parts, *keys, *order)
              .sortWithinPartitions(*keys, *order)
              .withColumn("_id", F.monotonically_increasing_id()))
    # the range bounds are sampled: freeze the outcome before it is read twice
    ranged = freeze(ranged.select(*columns, F.shiftright(F.col("_id"), 33).alias("_part"),
                                  F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row")))
    # a range meets only neighbouring groups, so this is about ranges + groups rows
    pieces = ranged.groupBy("_part", *partition).agg(F.count(F.lit(1)).alias("_rows"),
                                                     F.min("_row").alias("_first"))
    # rows of the same group in earlier ranges: each group has at most one piece per range
    earlier = (W.partitionBy(*partition).orderBy("_part")
               .rowsBetween(W.unboundedPreceding, -1))
    offsets = pieces.select(
        F.col("_part").alias("_o_part"), *[F.col(c).alias(f"_o_{c}") for c in partition], "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    if fits_broadcast(offsets):
        offsets = F.broadcast(offsets)
    # otherwise a shuffle: a group larger than one range is spread over several
    # _part values, so this join key cannot be hot
    same = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in partition]
    number = (F.col("_before") + F.col("_row") - F.col("_first") + 1).cast("int")
    return (ranged.join(offsets, [F.col("_part") == F.col("_o_part"), *same])
            .select(*columns, number.alias(name)))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every key.

    The row-number filter lets Spark cut every key to ``n`` rows before the shuffle,
    so a hot key sends at most ``n`` rows per map task.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(window))
            .where(F.col("_rn") <= n).drop("_rn"))


def last_wins(df: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """Keep the latest row of every key."""
    return first_per_key(df, keys, [F.col(c).desc() for c in sequence])
