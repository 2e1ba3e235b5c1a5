"""Reference-code lookups: one-to-one maps, spelled provinces, completion cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from comarca.functions import fixed_values as fv
from comarca.functions.text import clean_key, normalize_name
from comarca.operators.joins import lookup_join, salted_join
from comarca.session import freeze


def one_to_one_lookup(df: DataFrame, name: str, code: str, context: str | None = None,
                      skip_placeholder: bool = True) -> DataFrame:
    """Names that stand for exactly one code, and codes that have exactly one name.

    Returns ``name_key[, context_key], code``.  A placeholder code 0 is no code
    unless ``skip_placeholder`` is off.  Uniqueness is tested by comparing smallest
    and largest partner, which combines on the map side: no window over a hot name.
    """
    valid = F.col(code).isNotNull() & F.col(name).isNotNull() & (F.col(name) != "")
    if skip_placeholder:
        valid = valid & (F.col(code) != 0)
    columns = [clean_key(F.col(name)).alias("name_key"), F.col(code).alias("code")]
    keys = ["name_key"]
    if context:
        columns.append(clean_key(F.col(context)).alias("context_key"))
        keys.append("context_key")
    pairs = df.where(valid).select(*columns).distinct()

    def single(partner: list[str]) -> tuple[Column, Column]:
        both = F.struct(*partner)
        return F.min(both).alias("_lo"), F.max(both).alias("_hi")

    by_name = (pairs.groupBy("name_key").agg(*single([c for c in pairs.columns if c != "name_key"]))
               .where(F.col("_lo").eqNullSafe(F.col("_hi")))
               .select("name_key", "_lo.*"))
    by_code = (pairs.groupBy("code").agg(*single(keys))
               .where(F.col("_lo").eqNullSafe(F.col("_hi")))
               .select("code", F.col("_lo.name_key").alias("name_key")))
    # both sides are unique on the join key
    return by_name.join(by_code, ["name_key", "code"]).select(*keys, "code")


def province_codes(spelled: DataFrame, provinces: DataFrame, aliases: DataFrame) -> DataFrame:
    """Code of every distinct spelling in ``province_key``: own name, else alias.

    ``provinces``: province_code, province_name; ``aliases``: alias, name.
    """
    official = provinces.select(clean_key(F.col("province_name")).alias("province_key"),
                                "province_code")
    by_alias = (aliases.select(clean_key(F.col("alias")).alias("alias_key"),
                               clean_key(F.col("name")).alias("province_key"))
                .join(official, "province_key")
                .select(F.col("alias_key").alias("province_key"), "province_code"))
    # direct names win over aliases, the lowest code over others
    ranked = (official.withColumn("rank", F.lit(0))
              .unionByName(by_alias.withColumn("rank", F.lit(1))))
    known = (ranked.groupBy("province_key")
             .agg(F.min(F.struct("rank", "province_code")).alias("best"))
             .select("province_key", F.col("best.province_code").alias("province_code"),
                     F.when(F.col("best.rank") == 0, "direct").otherwise("alias")
                     .alias("province_rule")))
    # one province may own most spellings
    return salted_join(spelled, known, ["province_key"])


def dictionary_keys(dictionary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dictionary by exact and by normalised name, unique on (name, province)."""
    exact = (dictionary.groupBy(clean_key(F.col("municipality_name")).alias("name_key"),
                                "province_code")
             .agg(F.min("municipality_code").alias("exact_code")))
    best = F.min(F.struct("municipality_code", "municipality_name"))
    loose = (dictionary.groupBy(normalize_name(F.col("municipality_name")).alias("name_norm"),
                                "province_code")
             .agg(best.alias("_best"))
             .select("name_norm", "province_code",
                     F.col("_best.municipality_code").alias("norm_code"),
                     F.col("_best.municipality_name").alias("norm_name")))
    return exact, loose


def resolve_names(raw: DataFrame, provinces: DataFrame, aliases: DataFrame,
                  dictionary: DataFrame) -> DataFrame:
    """One row per distinct (name, province spelling) with the code every rule gives.

    All lookups run on the distinct spellings, not on the rows, so the big table is
    joined once however many rules there are.  Columns: name_key, context_key,
    province_code, lookup_code, exact_code, norm_code, norm_name.
    """
    # the only scan of the big table: distinct spellings with their codes
    seen = freeze(raw.where(F.col("municipality_name").isNotNull())
                  .select(clean_key(F.col("municipality_name")).alias("name_key"),
                          clean_key(F.col("province")).alias("context_key"),
                          F.nullif(F.col("municipality_code"), F.lit(0)).alias("code")).distinct())
    spellings = seen.select("name_key", "context_key").distinct()
    own = (one_to_one_lookup(seen, "name_key", "code", "context_key")
           .withColumnRenamed("code", "lookup_code"))
    exact, loose = dictionary_keys(dictionary)
    resolved = province_codes(spellings.withColumn("province_key", F.col("context_key")),
                              provinces, aliases)
    resolved = resolved.withColumn("name_norm", normalize_name(F.col("name_key")))
    # spellings and lookups are distinct on these keys: no key is hot
    return (resolved.drop("province_key", "province_rule")
            .join(own, ["name_key", "context_key"], "left")
            .join(exact, ["name_key", "province_code"], "left")
            .join(loose, ["name_norm", "province_code"], "left").drop("name_norm"))


def complete_codes(raw: DataFrame, resolved: DataFrame) -> DataFrame:
    """Fill missing municipality codes and say which rule did it.

    original (present and not 0) -> same table -> dictionary, exact name ->
    dictionary, normalised name.  Row count and original codes never change.
    """
    keyed = raw.withColumns({"name_key": clean_key(F.col("municipality_name")),
                             "context_key": clean_key(F.col("province"))})
    joined = lookup_join(keyed, resolved, ["name_key", "context_key"], derived=True)
    original = F.when(F.col("municipality_code") != 0, F.col("municipality_code"))
    own, same_table, exact, loose, none = fv.CODE_SOURCES
    method, score = fv.NORMALIZED_MATCH
    source = (F.when(original.isNotNull(), own)
              .when(F.col("lookup_code").isNotNull(), same_table)
              .when(F.col("exact_code").isNotNull(), exact)
              .when(F.col("norm_code").isNotNull(), loose)
              .otherwise(none))
    matched = F.col("norm_code").isNotNull() & original.isNull()
    return (joined
            .withColumns({
                "municipality_code_source": source,
                "municipality_code_completed": ~source.isin(own, none),
                "match_method": F.when(matched, method),
                "confidence_score": F.when(matched, F.lit(score)),
                "fuzzy_matched_name": F.when(matched, F.col("norm_name")),
                "municipality_code": F.coalesce(original, "lookup_code", "exact_code", "norm_code")})
            .drop("lookup_code", "exact_code", "norm_code", "norm_name",
                  "name_key", "context_key"))
