"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the JVM never compiles methods above 8000 bytes: let Spark generate code per
    # operator for stages that would be larger (wide staging tables)
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("comarca")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only where it is unset, and only on a local master, a temporary folder is used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = os.path.join(tempfile.gettempdir(), "comarca-shared")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path inside the shared folder that nobody else writes to."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def freeze(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it as Parquet in the shared folder.

    The rows no longer depend on a plan that could be run again with another outcome,
    they survive the loss of executors, and later reads take only the columns they need
    and know the size of the table.
    """
    folder = new_folder(df.sparkSession, "frozen")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
