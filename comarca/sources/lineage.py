"""Where a row came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from comarca.functions import fixed_values as fv


def source_config(name: str, registry: dict | None = None) -> dict[str, str]:
    registry = registry or fv.SOURCE_REGISTRY
    if name not in registry:
        raise KeyError(f"unknown source {name!r}, registered: {sorted(registry)}")
    return registry[name]


def stamp(df: DataFrame, source: str, source_file: Column | None = None,
          registry: dict | None = None, at: Column | None = None) -> DataFrame:
    """Copy the registered publisher onto every row, with file and load time."""
    columns = {k: F.lit(v) for k, v in source_config(source, registry).items()}
    if source_file is not None:
        columns["source_file"] = source_file
    columns["ingestion_timestamp"] = F.current_timestamp() if at is None else at
    return df.withColumns(columns)


#: Columns of a stamp that staging carries along.
CARRIED = ("data_source", "data_source_full", "data_category", "ingestion_timestamp")


def carried(df: DataFrame) -> list[str]:
    return [c for c in CARRIED if c in df.columns]


def with_created_at(df: DataFrame) -> DataFrame:
    """When a model was built: one time for all its rows."""
    return df.withColumn("created_at", F.current_timestamp())
