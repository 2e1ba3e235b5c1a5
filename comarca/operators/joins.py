"""Joins of a large table with a lookup, safe against hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from comarca.session import freeze

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                   max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Measure ``df`` and say whether it may be broadcast.

    The scan stops at ``max_rows + 1`` rows, so measuring a table that turns out
    to be large stays cheap.
    """
    texts = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    width = F.lit(16 * len(df.columns)).cast("bigint")
    for name in texts:
        width = width + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    rows, size = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def salted_join(df: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left",
                salts: int = SALTS, salt_on: list[str] | None = None) -> DataFrame:
    """Shuffle join that spreads every key over ``salts`` tasks.

    The salt is the number of the input task plus a hash of the row (or of the
    ``salt_on`` columns).  Both are the same when a task is run again, and equal
    rows of different input tasks part.  The lookup, which is small per key, is
    repeated once per salt.  Where it turns out to be tiny at run time, adaptive
    execution replaces the shuffle by a broadcast.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in salt_on or df.columns])
                  + F.spark_partition_id(), F.lit(salts)).cast("int")
    left = df.withColumn("_salt", salt)
    right = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, keys + ["_salt"], how).drop("_salt")


def lookup_join(df: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left",
                derived: bool = False, salt_on: list[str] | None = None, **limits) -> DataFrame:
    """Join a large table with a lookup that has at most a few rows per key.

    The lookup is broadcast when its measured size allows it, so the large table is
    not shuffled at all; otherwise the join is salted.  A ``derived`` lookup (an
    aggregate of large tables) is frozen first: it is measured and used, but
    computed once.
    """
    if derived:
        lookup = freeze(lookup)
    if fits_broadcast(lookup, **limits):
        return df.join(F.broadcast(lookup), keys, how)
    return salted_join(df, lookup, keys, how, salt_on=salt_on)
