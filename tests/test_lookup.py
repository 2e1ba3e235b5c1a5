"""Code completion, province spellings and name matching."""

import random

import pytest
from pyspark.sql import functions as F

from comarca.functions.text import normalize_name
from comarca.operators import fuzzy, joins, lookup
from comarca.sources import dims

DICTIONARY = [(1, 1, 10, 0, "Alpha"), (1, 1, 11, 0, "Beta (La)"), (2, 2, 10, 0, "Alpha"),
              (2, 2, 12, 0, "Gamma"), (2, 2, 13, 0, "Gamma")]
RAW_SCHEMA = "municipality_code bigint, municipality_name string, province string, year int"


@pytest.fixture
def dictionary(spark):
    return spark.createDataFrame(DICTIONARY, dims.MUNICIPALITY_SCHEMA)


@pytest.fixture
def provinces(spark):
    return spark.createDataFrame([(1, "C1", 1, "North"), (2, "C2", 2, "South, The")], dims.PROVINCE_SCHEMA)


@pytest.fixture
def aliases(spark):
    return spark.createDataFrame([("THE SOUTH", "South, The"), ("NORD", "North")], "alias string, name string")


def test_one_to_one(spark, rows):
    data = [(5, "a", "p", 1), (5, " A ", "P", 2), (0, "a", "p", 3), (6, "b", "p", 1), (7, "b", "p", 2),
            (8, "c", "p", 1), (8, "d", "p", 1), (9, "e", "p", 1), (9, "e", "q", 1), (None, "f", "p", 1)]
    df = spark.createDataFrame(data, RAW_SCHEMA)
    got = lookup.one_to_one_lookup(df, "municipality_name", "municipality_code", "province")
    assert rows(got, "name_key", "context_key", "code") == [("A", "P", 5)]
    # the placeholder counts as a second code when it is not skipped
    strict = lookup.one_to_one_lookup(df, "municipality_name", "municipality_code", "province", False)
    assert strict.count() == 0
    plain = lookup.one_to_one_lookup(df, "municipality_name", "municipality_code")
    assert rows(plain, "name_key", "code") == [("A", 5), ("E", 9)]


def test_province_codes(spark, provinces, aliases, rows):
    df = spark.createDataFrame([("NORTH",), ("NORD",), ("THE SOUTH",), ("WEST",)], "province_key string")
    got = lookup.province_codes(df, provinces, aliases)
    assert rows(got, "province_key", "province_code", "province_rule") == [
        ("NORD", 1, "alias"), ("NORTH", 1, "direct"), ("THE SOUTH", 2, "alias"), ("WEST", None, None)]


def test_official_aliases_all_resolve(spark):
    provinces, aliases = dims.official_provinces(spark), dims.official_aliases(spark)
    spelled = aliases.select(F.upper("alias").alias("province_key"))
    got = lookup.province_codes(spelled, provinces, aliases)
    assert got.count() == 36 and got.where("province_code is null").count() == 0
    assert provinces.select("province_code").distinct().count() == 52


@pytest.mark.parametrize("max_rows", [joins.MAX_BROADCAST_ROWS, 0])
def test_completion_cascade(spark, provinces, aliases, dictionary, rows, monkeypatch, max_rows):
    """Every rule, in its order; the same on the broadcast and on the salted path."""
    monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (max_rows, joins.MAX_BROADCAST_BYTES))
    data = [(1010, "Alpha", "North", 2020),      # original
            (0, "alpha", "north", 2001),         # seen with a code in the same table
            (None, "Gamma", "The South", 2001),  # dictionary, two codes: the lower one
            (0, "Beta, La", "Nord", 2001),       # not even normalised equal
            (0, "beta  -LA-", "Nord", 2001),     # normalised match
            (0, "Alpha", "The South", 2001),     # same name, other province
            (0, "Nowhere", "North", 2001)]
    raw = spark.createDataFrame(data, RAW_SCHEMA)
    resolved = lookup.resolve_names(raw, provinces, aliases, dictionary)
    got = lookup.complete_codes(raw, resolved)
    assert rows(got, "municipality_name", "municipality_code", "municipality_code_source",
                "municipality_code_completed", "province_code") == sorted([
        ("Alpha", 1010, "original", False, 1), ("alpha", 1010, "sepe_lookup", True, 1),
        ("Gamma", 12, "ine_reference", True, 2), ("Beta, La", 11, "fuzzy_match", True, 1),
        ("beta  -LA-", 11, "fuzzy_match", True, 1), ("Alpha", 10, "ine_reference", True, 2),
        ("Nowhere", None, "not_found", False, 1)], key=lambda r: tuple((v is None, str(v)) for v in r))


def brute_force(names, dictionary):
    out = []
    for source, block, s in names:
        for b, code, name, d in dictionary:
            if b != block:
                continue
            if s == d:
                out.append((source, block, code, name, "exact_normalized", 100))
            elif s in d and len(s) >= 4:
                out.append((source, block, code, name, "substring_match", 85))
            elif d in s and len(d) >= 4:
                out.append((source, block, code, name, "reverse_substring", 80))
    return out


def test_fuzzy_equals_brute_force(spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("AB") for _ in range(n))
    names = sorted({(word(rng.randint(1, 9)), rng.randint(1, 2)) for _ in range(150)})
    entries = sorted({(rng.randint(1, 2), code, word(rng.randint(1, 9))) for code in range(150)})
    source = spark.createDataFrame(names, "source_name string, province_code int")
    target = spark.createDataFrame([(1, b, c, 0, n) for b, c, n in entries], dims.MUNICIPALITY_SCHEMA)
    want = brute_force([(n, b, n) for n, b in names], [(b, c, n, n) for b, c, n in entries])
    columns = ["source_name", "province_code", "matched_code", "matched_name", "match_method",
               "confidence_score"]
    got = [tuple(r) for r in fuzzy.fuzzy_matches(source, target).select(*columns).collect()]
    assert sorted(got) == sorted(want)
    best = {}
    for m in sorted(want, key=lambda m: (-m[5], len(m[3]), m[2])):
        best.setdefault(m[:2], m)
    got = [tuple(r) for r in fuzzy.best_matches(source, target).select(*columns).collect()]
    assert sorted(got) == sorted(best.values())


def test_with_best_match_keeps_rows(spark, dictionary):
    df = spark.createDataFrame([(0, "Alpha", 1), (0, "Zzz", 1), (9, "Alpha", 1), (0, "Alphas", 2)],
                               "municipality_code bigint, municipality_name string, province_code int")
    got = {r.municipality_name: r.matched_code for r in fuzzy.with_best_match(df, dictionary).collect()}
    assert fuzzy.with_best_match(df, dictionary).count() == 4
    assert got == {"Alpha": 10, "Zzz": None, "Alphas": 10}


def test_salted_join_equals_plain_join_with_hot_key(spark, rows):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"),
                                  F.lit("x").alias("v"))
    small = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for how in ("left", "inner"):
        assert rows(joins.salted_join(df, small, ["k"], how)) == rows(df.join(small, ["k"], how))


def test_fits_broadcast_measures_rows_and_bytes(spark):
    df = spark.range(100).select("id", F.lit("x" * 100).alias("t"))
    assert joins.fits_broadcast(df)
    assert not joins.fits_broadcast(df, max_rows=99)
    assert not joins.fits_broadcast(df, max_bytes=1000)


def test_normalised_name_is_stable(spark):
    df = spark.createDataFrame([("  a--b ",)], "n string")
    once = df.select(normalize_name(F.col("n")).alias("n"))
    assert once.first()[0] == once.select(normalize_name(F.col("n"))).first()[0] == "A B"
