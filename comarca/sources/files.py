"""File inventory and the choice of files that still have to be processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def file_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Name, path, size and age of every file; the content is never read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True).load(path)
            .select(F.element_at(F.split("path", "/"), -1).alias("filename"), "path",
                    F.round(F.col("length") / F.lit(1024.0 * 1024.0), 2).alias("size_mb"),
                    F.col("modificationTime").alias("modified_date")))


def unprocessed(inputs: DataFrame, manifest: DataFrame, keys: list[str],
                force: bool = False) -> DataFrame:
    """Inputs without an output in the manifest; all of them when forced."""
    if force:
        return inputs
    return inputs.join(manifest.select(*keys).distinct(), keys, "left_anti")
