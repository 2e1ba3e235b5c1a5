"""Blocked name matching without comparing all pairs of a block.

A name that contains another contains all four-letter pieces of it.  So the longer side lists its
pieces (as many as it has letters), the shorter side looks for its rarest one only, and the few
names that have it are compared.  Work grows with the length of the names, a block of any size is
spread over the shuffle, and a piece that many names share is looked up by names alone that have
no rarer one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from comarca.functions.text import clean_key, normalize_name
from comarca.operators.joins import lookup_join, salted_join
from comarca.session import freeze

MIN_CONTAINED = 4


def _pieces(c: Column) -> Column:
    """Distinct pieces of ``MIN_CONTAINED`` letters; null for shorter texts."""
    starts = F.sequence(F.lit(1), F.length(c) - MIN_CONTAINED + 1)
    return F.when(F.length(c) >= MIN_CONTAINED,
                  F.array_distinct(F.transform(starts, lambda at: F.substr(c, at, F.lit(MIN_CONTAINED)))))


def contained_texts(short: DataFrame, long: DataFrame, block: str) -> DataFrame:
    """(block, short, long): distinct texts of ``short`` that distinct, other texts of ``long`` in
    the block contain.  Both sides have (block, text)."""
    listed = long.select(block, F.col("text").alias("long")).distinct().select(
        block, "long", F.explode(_pieces(F.col("long"))).alias("piece"))
    listed = freeze(listed)  # read for the counts and for the matches
    counts = listed.groupBy(block, "piece").agg(F.count(F.lit(1)).alias("n"))
    asked = short.select(block, F.col("text").alias("short")).distinct().select(
        block, "short", F.explode(_pieces(F.col("short"))).alias("piece"))
    # a piece that no longer text has rules its text out; "n" is null there and comes first
    rarest = (salted_join(asked, counts, [block, "piece"], "left").groupBy(block, "short")
              .agg(F.min(F.struct("n", "piece")).alias("least")).where("least.n is not null")
              .select(block, "short", F.col("least.piece").alias("piece")))
    return (salted_join(listed, rarest, [block, "piece"], "inner")
            .where(F.contains("long", F.col("short")) & (F.col("long") != F.col("short"))).select(block, "short", "long"))


def unresolved_names(df: DataFrame, name: str = "municipality_name",
                     block: str = "province_code", code: str = "municipality_code") -> DataFrame:
    """Distinct (name, block) of rows without a code."""
    missing = F.col(code).isNull() | (F.col(code) == 0)
    return (df.where(missing & F.col(block).isNotNull() & F.col(name).isNotNull()
                     & (F.trim(F.col(name)) != ""))
            .select(clean_key(F.col(name)).alias("source_name"), F.col(block)).distinct())


def _sides(names: DataFrame, dictionary: DataFrame, block: str):
    # the names come from a big table and are read several times below
    source = freeze(names.withColumn("text", normalize_name(F.col("source_name"))))
    target = dictionary.select(
        F.col(block), F.col("municipality_code").alias("matched_code"),
        F.col("municipality_name").alias("matched_name"),
        normalize_name(F.col("municipality_name")).alias("text"))
    return source, target


def fuzzy_matches(names: DataFrame, dictionary: DataFrame, block: str = "province_code") -> DataFrame:
    """Every match with its method and score.

    100 equal; 85 the dictionary name contains the source name; 80 the source name
    contains the dictionary name; contained text has at least four letters.
    """
    source, target = _sides(names, dictionary, block)
    in_target = contained_texts(source, target, block).select(block, F.col("short").alias("text"), "long")
    in_source = contained_texts(target, source, block).select(block, F.col("long").alias("text"), "short")

    def scored(pairs, method, score):
        return pairs.select("source_name", block, "matched_code", "matched_name",
                            F.lit(method).alias("match_method"), F.lit(score).alias("confidence_score"))

    keys = [block, "text"]
    longer = source.join(in_target, keys).drop("text").withColumnRenamed("long", "text")
    shorter = source.join(in_source, keys).drop("text").withColumnRenamed("short", "text")
    return (scored(salted_join(source, target, keys, "inner"), "exact_normalized", 100)
            .unionByName(scored(longer.join(target, keys), "substring_match", 85))
            .unionByName(scored(shorter.join(target, keys), "reverse_substring", 80)))


def best_matches(names: DataFrame, dictionary: DataFrame, block: str = "province_code") -> DataFrame:
    """Best match per name: highest score, shortest dictionary name, lowest code.

    Texts are matched, not names, each with its best entry, and the offers for a text are reduced
    on the map side.
    """
    source, target = _sides(names, dictionary, block)
    entry = F.struct(F.length("matched_name").alias("size"), F.col("matched_code"),
                     F.col("matched_name"))
    whole = target.groupBy(block, "text").agg(F.min(entry).alias("entry"))

    def offers(rank: int, pairs: DataFrame) -> DataFrame:
        return pairs.select(block, "wanted", F.struct(F.lit(rank).alias("rank"), "entry").alias("offer"))

    equal = source.select(block, "text").distinct().join(whole, [block, "text"]).withColumnRenamed("text", "wanted")
    in_target = contained_texts(source, target, block).withColumnsRenamed({"short": "wanted", "long": "text"})
    in_source = contained_texts(target, source, block).withColumnsRenamed({"long": "wanted", "short": "text"})
    candidates = (offers(0, equal).unionByName(offers(1, in_target.join(whole, [block, "text"])))
                  .unionByName(offers(2, in_source.join(whole, [block, "text"]))))
    best = candidates.groupBy(block, F.col("wanted").alias("text")).agg(F.min("offer").alias("offer"))
    best = salted_join(source, best, [block, "text"], "inner")
    rank = F.col("offer.rank")
    return best.select(
        "source_name", block,
        F.col("offer.entry.matched_code").alias("matched_code"),
        F.col("offer.entry.matched_name").alias("matched_name"),
        F.when(rank == 0, "exact_normalized").when(rank == 1, "substring_match")
         .otherwise("reverse_substring").alias("match_method"),
        F.when(rank == 0, 100).when(rank == 1, 85).otherwise(80).alias("confidence_score"))


def with_best_match(df: DataFrame, dictionary: DataFrame, name: str = "municipality_name",
                    block: str = "province_code") -> DataFrame:
    """Left join of every row with the best match of its name."""
    best = best_matches(unresolved_names(df, name, block), dictionary, block)
    keyed = df.withColumn("source_name", clean_key(F.col(name)))
    return lookup_join(keyed, best, ["source_name", block], derived=True).drop("source_name")
