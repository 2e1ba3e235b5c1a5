"""Exact deduplication with a heavy-hitter split.

Texts are equal when their digests after removing white space are.  One scan turns the
documents into narrow rows (id, digest, length); everything else works on these.
``freqItems``, a Misra-Gries summary with bounded state that Spark merges over the tasks,
names every digest with more than ``SUPPORT`` of all rows (and maybe others).  An exact
count verifies the names; the rows of the winners meet their group's numbers through a
broadcast join, without a shuffle, and the remaining rows, whose groups are small by the
guarantee of the summary, are dealt by digest.  All of it is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from comarca.llm.common import WHITE_SPACE, keep_table

#: Share of all rows from which a group may not go to one task.  The summary holds 1 / SUPPORT
#: digests at most, so the broadcast table of winners has at most 1 / SUPPORT rows.
SUPPORT = 0.002


def digest_of(text: Column) -> Column:
    """SHA-256 (lower-case hex) of the UTF-8 text without white space; null counts as empty."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, ""), 256)


def duplicate_groups(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: key, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the smallest key (null
    last), then the first row.  Null and empty texts, and texts of white space alone, are
    equal.  Rows that repeat a key are rows of their own, so exactly one row per group has
    ``kept``.  Other columns are not read; an empty table gives an empty result.
    """
    rows = keep_table(df.select(
        F.col(f"`{key}`").alias(key), digest_of(F.col(f"`{text}`")).alias("text_sha256"),
        F.coalesce(F.char_length(F.col(f"`{text}`")), F.lit(0)).alias("_length"),
        F.monotonically_increasing_id().alias("_row")), "digests")
    order = F.struct(-F.col("_length"), F.col(key).isNull(), F.col(key), F.col("_row"))
    named = rows.freqItems(["text_sha256"], SUPPORT).select(
        F.explode("text_sha256_freqItems").alias("text_sha256"))
    winners = keep_table(
        rows.join(F.broadcast(named), "text_sha256").groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("group_size"),
             F.min_by(F.struct(key, "_row"), order).alias("_first"))
        .filter(F.col("group_size") > SUPPORT / 2 * rows.count()), "winners")
    heavy = rows.join(F.broadcast(winners), "text_sha256")
    group = Window.partitionBy("text_sha256")
    whole = group.orderBy(F.desc("_length"), F.asc_nulls_last(key), "_row").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    light = (rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
             .withColumn("group_size", F.count(F.lit(1)).over(whole))
             .withColumn("_first", F.first(F.struct(key, "_row")).over(whole)))
    return heavy.unionByName(light).select(
        key, F.col(f"_first.{key}").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("_first._row")).alias("kept"), "text_sha256")


def drop_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns.

    The decision is taken on narrow rows; a key that stays and has several rows keeps one
    of the rows whose text is the kept one.
    """
    groups = keep_table(duplicate_groups(df, key, text), "groups")
    right = groups.filter("kept").select(F.col(key).alias("_key"), F.col("text_sha256").alias("_kept"))
    marked = df.withColumn("_digest", digest_of(F.col(f"`{text}`")))
    out = marked.join(right, marked[key].eqNullSafe(F.col("_key")) & (F.col("_digest") == F.col("_kept")),
                      "left_semi")
    repeated = groups.groupBy(key, "text_sha256").count().filter("count > 1")
    if not repeated.isEmpty():
        out = out.dropDuplicates([key, "_digest"])
    return out.drop("_digest")
