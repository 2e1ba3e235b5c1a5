"""Sinks: full refresh, layered tables, keyed upsert, consolidated files."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from comarca.session import freeze


def consolidate(df: DataFrame, path: str, partitions: list[str], fmt: str = "parquet",
                skip_existing: DataFrame | None = None) -> None:
    """One folder per partition value (type, year, month).

    Partitions listed in ``skip_existing`` are left alone; the others are replaced.
    Rebalancing splits a huge month over several tasks by its size at run time and
    gathers small ones, so neither hot tasks nor thousands of tiny files result.
    """
    if skip_existing is not None:
        df = df.join(skip_existing.select(*partitions).distinct(), partitions, "left_anti")
    (df.hint("rebalance", *partitions).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("header", True)
     .partitionBy(*partitions).format(fmt).save(path))


def full_refresh(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace all rows of a table and keep the table itself, so that views on it
    stay valid; create it when it does not exist.  New columns are added to the table,
    columns that ``df`` lacks become null."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        known = {c.lower() for c in spark.table(table).columns}
        new = [f for f in df.schema.fields if f.name.lower() not in known]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ("
                      + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new) + ")")
        given = {c.lower() for c in df.columns}
        df.select(*[F.col(f"`{f.name}`") if f.name.lower() in given
                    else F.lit(None).cast(f.dataType).alias(f.name)
                    for f in spark.table(table).schema.fields]).write.insertInto(table, overwrite=True)
    else:
        writer = df.write.format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(table)


def refresh_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 5000, **options) -> None:
    """Full refresh of a table in a relational database: truncate and append."""
    (df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", table)
     .option("truncate", True).option("batchsize", batch_size).options(**options).save())


def create_layer(spark: SparkSession, layer: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{where}")


def materialize(df: DataFrame, name: str, kind: str = "view", layer: str | None = None,
                partition_by: list[str] = (), sort_by: list[str] = ()) -> DataFrame:
    """Store a model as a table of a layer, or name it as a view, and return it.

    A frame has no SQL text, so its view is one of the session; a view that stays in a layer
    is made from a query over stored tables by ``layer_view``.
    """
    spark = df.sparkSession
    if kind == "view":
        if layer:
            raise ValueError("a frame cannot be stored as a view of a layer: use layer_view")
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    full = f"{layer}.{name}" if layer else name
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(full)
    return spark.table(full)


def layer_view(spark: SparkSession, name: str, layer: str, query: str) -> DataFrame:
    """A view in a layer over stored tables; it stays when the session ends."""
    spark.sql(f"CREATE OR REPLACE VIEW {layer}.{name} AS {query}")
    return spark.table(f"{layer}.{name}")


def align_columns(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Give ``target`` the columns of ``batch``: new ones are null, vanished ones go."""
    known = set(target.columns)
    return target.select([F.col(f.name).cast(f.dataType) if f.name in known
                          else F.lit(None).cast(f.dataType).alias(f.name)
                          for f in batch.schema.fields])


def upsert(target: DataFrame, batch: DataFrame, keys: list[str],
           touched: Column | None = None) -> DataFrame:
    """Rows of ``batch`` replace rows of ``target`` with the same keys.

    ``touched`` bounds the part of the target a batch can reach (years from a start
    on); rows outside it are passed through and take no part in the join.
    """
    target = align_columns(target, batch)
    if touched is None:
        return target.join(batch.select(*keys), keys, "left_anti").unionByName(batch)
    inside = F.coalesce(touched, F.lit(True))
    replaced = target.where(inside).join(batch.select(*keys), keys, "left_anti")
    return target.where(~inside).unionByName(replaced).unionByName(batch)


def overwrite_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions ``df`` has rows for (whole years), keep the others."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def _schema_folder(path: str) -> str:
    return f"{path.rstrip('/')}/_schema"  # readers skip names that begin with an underscore


def _record(spark: SparkSession, path: str, schema: StructType, dropped: list[str]) -> None:
    said = json.dumps({"schema": schema.jsonValue(), "dropped": sorted(dropped)})
    spark.createDataFrame([(said,)], "value string").coalesce(1).write.mode("overwrite").text(_schema_folder(path))


def stored_schema(spark: SparkSession, path: str) -> tuple[StructType, list[str]]:
    """Columns of a stored table, and those it once had."""
    said = json.loads(spark.read.text(_schema_folder(path)).first()["value"])
    return StructType.fromJson(said["schema"]), said["dropped"]


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A stored table by its recorded schema: columns that older partitions lack are null, columns
    it no longer has are not read."""
    return spark.read.schema(stored_schema(spark, path)[0]).parquet(path)


def store_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Write a stored table anew, one folder per value of ``partition``, and record its schema."""
    schema = _as_read(df, partition)
    df.write.mode("overwrite").partitionBy(partition).parquet(path)
    _record(df.sparkSession, path, schema, [])


def _as_read(df: DataFrame, partition: str) -> StructType:
    """The schema a reader sees: every column may be null, the partition comes last."""
    fields = [StructField(f.name, f.dataType) for f in df.schema.fields]
    return StructType([f for f in fields if f.name != partition] + [f for f in fields if f.name == partition])


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in names])


def _empty_partition(spark: SparkSession, path: str, name: str, value, schema: StructType) -> None:
    said = "__HIVE_DEFAULT_PARTITION__" if value is None or value == "" else re.sub(
        "[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]", lambda c: f"%{ord(c[0]):02X}", str(value))
    rest = StructType([f for f in schema.fields if f.name != name])
    spark.createDataFrame([], rest).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}={said}")


def merge_partitions(batch: DataFrame, path: str, keys: list[str], partition: str) -> None:
    """Upsert ``batch`` into the stored table at ``path``: rows with its keys are replaced, and the
    table gets its columns (new ones are null in old rows, vanished ones go).

    Only partitions that ``batch`` has rows for are read and written; where ``partition`` is no
    key, also those in which the keys are found, so a row that moves is not there twice.  Null
    keys and partitions are values like others.  The merged rows are computed into a folder of
    their own first, then take the place of the old partitions, and the schema is recorded last:
    a run that fails leaves the old rows under the old schema, and a run that is repeated gives
    the same table.  Where a column changes its type, or comes back under the name of one that
    went, all partitions are written, as old files would be misread.
    """
    spark = batch.sparkSession
    batch = freeze(batch)
    old, dropped = stored_schema(spark, path)
    target, new = read_stored(spark, path), _as_read(batch, partition)
    kinds = {f.name: f.dataType for f in old.fields}
    rewrite = any((f.name in kinds and kinds[f.name] != f.dataType) or (f.name not in kinds and f.name in dropped)
                  for f in new.fields)
    # a row per partition
    touched = batch.select(partition).distinct()
    if partition not in keys:
        wanted = batch.select(*keys).distinct()
        touched = touched.union(target.join(wanted, _same(target, wanted, keys), "left_semi").select(partition)).distinct()
    touched = freeze(target.select(partition).union(batch.select(partition)).distinct() if rewrite else touched)
    reached = target.join(F.broadcast(touched), _same(target, touched, [partition]), "left_semi")
    aligned, wanted = align_columns(reached, batch), batch.select(*keys).distinct()
    merged = freeze(aligned.join(wanted, _same(aligned, wanted, keys), "left_anti").unionByName(batch))
    overwrite_partitions(merged, path, partition)
    left = merged.select(partition).distinct()
    emptied = touched.join(left, _same(touched, left, [partition]), "left_anti")
    for row in emptied.collect():  # partitions whose rows have all moved
        _empty_partition(spark, path, partition, row[0], new)
    gone = (set(dropped) | set(kinds)) - {f.name for f in new.fields}
    _record(spark, path, new, [] if rewrite else sorted(gone))


def refresh_start(target: DataFrame, year: str, default: int, lookback: int = 1) -> int:
    """First year an incremental run recomputes: latest year of the target - lookback."""
    latest = target.agg(F.max(year)).first()[0]
    return int(default if latest is None else latest) - lookback
