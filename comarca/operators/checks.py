"""Data checks.  A check is a table of violations; a suite is one summary table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from comarca.functions.measures import half_up, pct
from comarca.operators.quantiles import exact_median
from comarca.session import freeze


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_empty(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.trim(F.col(column)) == "")


def unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once; null keys are no keys."""
    present = df.dropna("any", subset=columns)
    return (present.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def out_of_values(column: str, values: list) -> Column:
    return ~F.col(column).isin(values)


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows with another value; null passes."""
    return df.where(out_of_values(column, values))


def out_of_range(column: str, low=None, high=None, inclusive: bool = True) -> Column:
    c, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | (c < low if inclusive else c <= low)
    if high is not None:
        bad = bad | (c > high if inclusive else c >= high)
    return bad


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True,
                   where: Column | None = None) -> DataFrame:
    """Rows outside the range; null passes."""
    bad = out_of_range(column, low, high, inclusive)
    return df.where(bad if where is None else where & bad)


def expression_holds(df: DataFrame, expression: Column) -> DataFrame:
    """Rows for which the expression is false; unknown passes."""
    return df.where(~expression)


@dataclass
class Check:
    """A named check: either a row predicate that marks violations or unique keys."""

    name: str
    violates: Column | None = None
    unique: tuple[str, ...] = ()
    severity: str = "error"
    allow: int = 0


def run_suite(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(check_name, severity, violations, status) of every check.

    All row checks share one pass over the table; each uniqueness check is one
    aggregation that counts its repeated keys.  Declarations stand for the checks they describe.
    """
    checks = [c if isinstance(c, Check) else c.check() for c in checks]
    spark = df.sparkSession
    facts = spark.createDataFrame([(c.name, c.severity, c.allow) for c in checks],
                                  "check_name string, severity string, allow bigint")
    rows = [c for c in checks if c.violates is not None]
    counts = None
    if rows:
        once = df.agg(*[F.count_if(c.violates).alias(f"_{i}") for i, c in enumerate(rows)])
        pairs = F.array(*[F.struct(F.lit(c.name).alias("check_name"),
                                   F.col(f"_{i}").alias("violations"))
                          for i, c in enumerate(rows)])
        counts = once.select(F.inline(pairs))
    for c in checks:
        if c.unique:
            repeated = unique(df, list(c.unique)).agg(F.count(F.lit(1)).alias("violations"))
            repeated = repeated.select(F.lit(c.name).alias("check_name"), "violations")
            counts = repeated if counts is None else counts.unionByName(repeated)
    # facts has one row per check of this list
    failed = F.when(F.col("severity") == "warn", "warn").otherwise("fail")
    return (counts.join(F.broadcast(facts), "check_name")
            .select("check_name", "severity", "violations",
                    F.when(F.col("violations") <= F.col("allow"), "pass")
                    .otherwise(failed).alias("status")))


def year_completeness(df: DataFrame, year: str, first: int, last: int,
                      known_gaps: list[int] = ()) -> DataFrame:
    """Expected years that are missing and years nobody expected."""
    spark = df.sparkSession
    expected = spark.range(first, last + 1).select(F.col("id").cast("int").alias("y"))
    if known_gaps:
        expected = expected.subtract(spark.createDataFrame([(g,) for g in known_gaps], "y int"))
    actual = df.where(F.col(year).isNotNull()).select(F.col(year).cast("int").alias("y")).distinct()
    text = F.col("y").cast("string")

    def labelled(rows: DataFrame, issue: str, message: Column) -> DataFrame:
        return rows.select(F.lit(issue).alias("issue_type"), text.alias("year_value"),
                           message.alias("error_message"))

    return (labelled(expected.join(actual, "y", "left_anti"), "missing_year",
                     F.concat(F.lit("Expected year "), text, F.lit(" is missing from the dataset")))
            .unionByName(labelled(actual.join(expected, "y", "left_anti"), "unexpected_year",
                                  F.concat(F.lit("Unexpected year "), text,
                                           F.lit(" found in dataset")))))


def count_outliers(df: DataFrame, group: str, entity: list[str], floor: int = 7000,
                   sigmas: float = 2.0) -> DataFrame:
    """Groups whose number of distinct entities leaves mean +- sigmas * deviation."""
    n = F.col("entity_count")
    # one row per group, read twice: for the statistics and for the test
    counts = freeze(df.dropna("any", subset=entity).groupBy(group)
                    .agg(F.countDistinct(*entity).alias("entity_count"),
                         F.count(F.lit(1)).alias("total_records")))
    mean, spread = counts.agg(F.avg(n), F.stddev_samp(n)).first()
    if mean is None or spread is None:  # fewer than two groups
        low, high = float(floor), None
    else:
        low, high = max(mean - sigmas * spread, float(floor)), mean + sigmas * spread
    issue = (F.when(n < F.lit(low), "too_few_entities")
              .when(n > F.lit(high), "too_many_entities"))
    whole = lambda x: F.bround(F.lit(x).cast("double"), 0).cast("bigint")
    return (counts.where(issue.isNotNull())
            .select(group, "entity_count", "total_records", whole(mean).alias("expected_avg"),
                    whole(low).alias("min_acceptable"), whole(high).alias("max_acceptable"),
                    issue.alias("issue_type"), F.concat(
                        F.lit(f"{group} "), F.col(group).cast("string"),
                        F.when(n < F.lit(low), " has only ").otherwise(" has "), n.cast("string"),
                        F.lit(" entities (expected ~"), whole(mean).cast("string"), F.lit(")")).alias("warning_message")))


def group_completeness(df: DataFrame, group: str, year: str, share: float = 0.5,
                       min_median: float = 50, dataset: str = "Data") -> DataFrame:
    """Group-years with fewer rows than ``share`` of the group's median year, told in a sentence."""
    counts = (df.where(F.col(group).isNotNull()).groupBy(group, year)
              .agg(F.count(F.lit(1)).alias("record_count")))
    # at most one row per year and group from here on
    counts = freeze(counts)
    medians = exact_median(counts, [group], "record_count").withColumnRenamed("median", "median_records")
    # a median of counts is a whole or a half number: doubled, the ratio is exact
    ratio = half_up(F.col("record_count") * 200, F.col("median_records") * 2, 1)
    return (counts.join(medians, group)
            .where((F.col("record_count") < F.col("median_records") * share)
                   & (F.col("median_records") > min_median))
            .select(group, year, "record_count",
                    F.bround("median_records", 0).cast("bigint").alias("expected_records"),
                    ratio.alias("completeness_percentage"),
                    F.concat(F.lit(f"{dataset} completeness below {share * 100:g}% of expected for "), F.col(group).cast("string"),
                             F.lit(" in "), F.col(year).cast("string")).alias("issue_description")))


def compare_dictionaries(entities: DataFrame, provinces: DataFrame) -> DataFrame:
    """Do two reference tables agree on communities and provinces?  One row."""
    def presence(column: str) -> tuple[DataFrame, str]:
        both = (entities.select(F.col(column), F.lit(1).alias("e"), F.lit(0).alias("p"))
                .unionByName(provinces.select(F.col(column), F.lit(0).alias("e"), F.lit(1).alias("p")))
                .groupBy(column).agg(F.max("e").alias("e"), F.max("p").alias("p")))
        return both.agg(F.count_if(F.col("p") == 0).alias("only_e"),
                        F.count_if(F.col("e") == 0).alias("only_p"),
                        F.count_if(F.col("e") == 1).alias("in_e")).first()

    community = presence("autonomous_community_code")
    province = presence("province_code")
    pair = ["autonomous_community_code", "province_code"]
    orphans = (entities.select(*pair).distinct()
               .join(provinces.select(*pair).distinct(), pair, "left_anti")
               .agg(F.count(F.lit(1)).alias("orphaned_municipalities")))
    total = entities.select(F.count(F.lit(1))).scalar()
    same_c = community.only_e == 0 and community.only_p == 0
    same_p = province.only_e == 0 and province.only_p == 0
    none = F.col("orphaned_municipalities") == 0
    score = F.lit(int(same_c) + int(same_p)) + none.cast("int")
    return orphans.select(
        F.lit(same_c).alias("autonomous_codes_consistent"),
        F.lit(same_p).alias("province_codes_consistent"),
        "orphaned_municipalities",
        F.lit(community.in_e).cast("bigint").alias("total_autonomous_communities"),
        F.lit(province.in_e).cast("bigint").alias("total_provinces"),
        total.alias("total_municipalities"),
        (F.lit(same_c and same_p) & none).alias("validation_passed"),
        F.concat(score.cast("string"), F.lit("/3")).alias("integrity_score"))


def code_ranges(entities: DataFrame, ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """Smallest and largest code against the allowed range, one row per code column."""
    aggs = [f(c).alias(f"{p}_{c}") for c in ranges for f, p in ((F.min, "lo"), (F.max, "hi"))]
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"),
                              F.col(f"lo_{c}").cast("bigint").alias("lowest"),
                              F.col(f"hi_{c}").cast("bigint").alias("highest"),
                              ((F.col(f"lo_{c}") >= lo) & (F.col(f"hi_{c}") <= hi)).alias("in_range"))
                     for c, (lo, hi) in ranges.items()])
    return entities.agg(*aggs).select(F.inline(rows))


def mapping_consistency(left: DataFrame, right: DataFrame, keys: list[str], code: str) -> DataFrame:
    """Names that stand for different codes in two tables, or for several in one.

    Both tables go through one aggregation with smallest and largest code per side.
    """
    both = (left.select(*keys, F.col(code).alias("l"), F.lit(None).cast("bigint").alias("r"))
            .unionByName(right.select(*keys, F.lit(None).cast("bigint").alias("l"),
                                      F.col(code).alias("r"))))
    seen = (both.where(F.coalesce("l", "r").isNotNull()).groupBy(*keys)
            .agg(F.min("l").alias("left_code"), F.max("l").alias("left_last"),
                 F.min("r").alias("right_code"), F.max("r").alias("right_last")))
    agree = ((F.col("left_code") == F.col("left_last")) & (F.col("right_code") == F.col("right_last"))
             & (F.col("left_code") == F.col("right_code")))
    return (seen.where(~F.coalesce(agree, F.lit(False)))
            .select(*keys, "left_code", "left_last", "right_code", "right_last"))


def completion_effectiveness(df: DataFrame, code: str, completed: str,
                             target_pct: float = 95.0) -> DataFrame:
    """One row with the completion rates when fewer than ``target_pct`` have a code."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("total_records"), F.count(code).alias("records_with_code"),
                  F.count_if(F.col(completed)).alias("codes_completed"),
                  pct(F.count(code), n).alias("code_completeness_rate"),
                  pct(F.count_if(F.col(completed)), n).alias("completion_rate")
                  ).where(F.col("code_completeness_rate") < target_pct)
