"""What the operators share: reading tables, tables kept in the shared folder, whole-row joins."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from comarca.session import new_folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Characters that count as white space: space, and tab to carriage return.
WHITE_SPACE = " \t\n\x0b\x0c\r"

#: Whether Spark deletes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Words of 64 places that a broadcast bitmap has at most.
BITMAP_WORDS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package, whatever folder the driver was started in
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_table(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage with a replicated, column-wise copy that outlives lost executors.  The
    shuffle files of the job go with it, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    folder, before = new_folder(spark, purpose), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)


def thinned(df: DataFrame, by: str, wanted: DataFrame, wanted_by: str) -> DataFrame:
    """``df`` without most of the rows whose ``by`` no row of ``wanted`` has in ``wanted_by``.

    What an equal-join (nulls equal or not) would find stays, so that join must still follow,
    but shuffles far less: the hashes of ``wanted_by`` are marked in a bitmap that is broadcast.
    It has 16 places or more for each wanted row; beyond ``BITMAP_WORDS`` it grows no further
    and lets more rows pass.
    """
    words = min(BITMAP_WORDS, 1 << (wanted.count() // 4).bit_length())
    place = f"pmod(xxhash64(`{{}}`), {64 * words})"
    marked = (wanted.select(F.expr(place.format(wanted_by)).alias("_place"))
              .groupBy(F.expr("_place div 64").alias("_word"))
              .agg(F.expr("bit_or(shiftleft(1L, cast(_place % 64 as int)))").alias("_bits")))
    return (df.withColumn("_place", F.expr(place.format(by)))
            .join(F.broadcast(marked), F.expr("_place div 64") == F.col("_word"))
            .filter("shiftright(_bits, cast(_place % 64 as int)) & 1 = 1").select(*df.columns))


def rows_from(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Arrow batches with the number of their first row.

    Row numbers are unique over the tasks and the same when a task is run again.
    """
    first = TaskContext.get().partitionId() << 33
    for batch in batches:
        yield batch, first
        first += batch.num_rows


def salt(*columns: Column, parts: int) -> Column:
    """Number from 0 to ``parts`` - 1 that depends on the values alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int")
