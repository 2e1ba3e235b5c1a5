"""Process every newly arrived file exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from comarca.operators.joins import lookup_join
from comarca.operators.ranking import last_wins
from comarca.session import freeze
from comarca.sources.tables import merge_partitions, overwrite_partitions, store_partitions

LOG_SCHEMA = "source_file string, rows bigint, digest string, status string, batch_id bigint"


def intake(spark: SparkSession, path: str, schema: str, sink: str, state: str,
           fmt: str = "parquet", glob: str | None = None, files_per_batch: int = 1000,
           prepare: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Read the files that arrived since the last call into ``sink`` and stop.

    The stream's checkpoint in ``state`` remembers the files.  A batch writes the
    partition of its own number, so a batch that is run again replaces itself.
    """
    reader = (spark.readStream.format(fmt).schema(schema)
              .option("maxFilesPerTrigger", files_per_batch))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    arrived = reader.load(path)

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        overwrite_partitions(rows.withColumn("batch_id", F.lit(batch_id)), sink, "batch_id")

    query = (arrived.writeStream.foreachBatch(store).option("checkpointLocation", state)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def file_digests(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(source_file, path, rows, digest) per delivered file; the order of its rows does not matter."""
    said = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}))
    return rows.groupBy("source_file", "_path").agg(
        F.count(F.lit(1)).alias("rows"), F.concat_ws("-", F.count(F.lit(1)), F.bit_xor(said),
                                                     F.sum(said.cast("decimal(38,0)"))).alias("digest"))


def _told_apart(files: DataFrame, known: DataFrame) -> DataFrame:
    """Delivered files with their status: ``redelivered`` (its content was taken in before, or stands
    in another file of the batch), ``changed`` (its name was, with other content) or ``new``."""
    contents = known.select("digest").distinct().withColumn("_seen", F.lit(True))
    names = known.select("source_file").distinct().withColumn("_named", F.lit(True))
    first = F.row_number().over(Window.partitionBy("digest").orderBy("source_file", "_path"))
    marked = files.withColumn("_copy", first).join(contents, "digest", "left").join(names, "source_file", "left")
    return marked.select("source_file", "_path", "rows", "digest", F.when(
        F.col("_seen") | (F.col("_copy") > 1), "redelivered").when(F.col("_named"), "changed").otherwise("new").alias("status"))


def intake_current(spark: SparkSession, path: str, schema: str, table: str, log: str, state: str, keys: list[str],
                   partition: str, sequence: list[str] = (), fmt: str = "parquet", glob: str | None = None,
                   files_per_batch: int = 1000) -> None:
    """Bring the stored table of current rows up to date with the files that arrived, and stop.

    A batch is reduced to the latest row per key and merged into ``table`` (``partition`` is one
    of the keys): only the partitions it has rows for are read and written, so a call costs what
    its files reach, not what arrived before.  Later files win; ``sequence`` orders the rows of
    a batch, the file name those still equal.  ``log`` has a row per delivered file with the
    digest of its content; content that was taken in before is not merged again, under whatever
    name it comes.  A batch that is run again after a failure gives the same table and log.
    """
    if partition not in keys:
        raise ValueError(f"the partition {partition!r} has to be one of the keys")
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    arrived = reader.option("recursiveFileLookup", True).load(path)
    columns = arrived.columns
    arrived = arrived.select("*", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("_path"))

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows = freeze(batch)
        known = session.read.schema(LOG_SCHEMA).parquet(log) if batch_id else session.createDataFrame([], LOG_SCHEMA)
        files = freeze(_told_apart(file_digests(rows, columns), known.where(F.col("batch_id") != batch_id)))
        fresh = lookup_join(rows, files.where("status <> 'redelivered'").select("source_file", "_path"),
                            ["source_file", "_path"], "inner", salt_on=columns).drop("_path")
        rest = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]))  # so the choice never depends on the run
        latest = last_wins(fresh.withColumn("_rest", rest), keys, [*sequence, "source_file", "_rest"]).drop("_rest")
        if batch_id:
            merge_partitions(latest, table, keys, partition)
        else:
            store_partitions(latest, table, partition)
        overwrite_partitions(files.drop("_path").withColumn("batch_id", F.lit(batch_id).cast("bigint")), log, "batch_id")

    query = (arrived.writeStream.foreachBatch(store).option("checkpointLocation", state)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def current_rows(spark: SparkSession, sink: str, keys: list[str], sequence: list[str] = ()) -> DataFrame:
    """Latest version of every key over all batches.

    ``sequence`` (an event time, file and row) orders the rows of a key in one batch; what is
    still equal is ordered by all its values, so the choice never depends on the run.
    """
    rows = spark.read.parquet(sink)
    rest = [c for c in rows.columns if c not in {*keys, *sequence, "batch_id"}]
    order = F.struct(*[F.col(c) for c in rest]) if rest else F.lit(0)
    return last_wins(rows.withColumn("_rest", F.to_json(order) if rest else order), keys,
                     ["batch_id", *sequence, "_rest"]).drop("batch_id", "_rest")
