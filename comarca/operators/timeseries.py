"""Yearly aggregates of monthly series and year-over-year comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from comarca.functions.measures import half_up

Q4, WINTER, SUMMER = (10, 11, 12), (12, 1, 2), (6, 7, 8)


def in_months(value: Column, month: Column, months: tuple[int, ...]) -> Column:
    return F.when(month.isin(*months), value)


def yearly_profile(df: DataFrame, keys: list[str], value: str, month: str = "data_month",
                   averages: dict[str, str] | None = None, label: str | None = None,
                   full_year: int = 11) -> DataFrame:
    """One pass over a monthly series: coverage, snapshot, season and spread.

    Counts, sums and extremes of whole numbers are collected per key and ``label``
    (the name of the place), then per key with the last label of the year.  All
    buffers of the first step have a fixed width, so it is a hash aggregation that
    combines on the map side; asking for the last name there would force a sort of
    the monthly rows.  Means, spread and season follow from the sums exactly.
    """
    v, m = F.col(value).cast("bigint"), F.col(month)
    averages = averages or {}
    parts = {"n": (F.count, F.lit(1)), "pos": (F.count, F.when(v > 0, 1)),
             "s": (F.sum, v), "ss": (F.sum, v * v),
             "q": (F.sum, in_months(v, m, Q4)), "qn": (F.count, in_months(v, m, Q4)),
             "w": (F.sum, in_months(v, m, WINTER)), "wn": (F.count, in_months(v, m, WINTER)),
             "u": (F.sum, in_months(v, m, SUMMER)), "un": (F.count, in_months(v, m, SUMMER)),
             **{f"a{i}": (F.sum, F.col(c)) for i, c in enumerate(averages)},
             **{f"c{i}": (F.count, F.col(c)) for i, c in enumerate(averages)}}
    extremes = {"max_value": (F.max, F.col(value)), "min_value": (F.min, F.col(value)),
                "dec_value": (F.max, in_months(F.col(value), m, (12,)))}
    fine = df.groupBy(*keys, *([label] if label else [])).agg(
        *[fn(c).alias(f"_{k}") for k, (fn, c) in parts.items()],
        *[fn(c).alias(k) for k, (fn, c) in extremes.items()])
    if label:
        fine = fine.groupBy(*keys).agg(
            F.max(label).alias(label),
            *[F.sum(f"_{k}").alias(f"_{k}") for k in parts],
            *[fn(k).alias(k) for k, (fn, _) in extremes.items()])

    def c(name: str) -> Column:
        return F.col(f"_{name}")

    wide = lambda name: c(name).cast("decimal(19,0)")
    # n * sum of squares - square of sum, exact; the mean cancels out of the ratio
    scatter = (wide("n") * wide("ss") - wide("s") * wide("s")).cast("double")
    deviation = F.sqrt(scatter / F.nullif(c("n") * (c("n") - 1), F.lit(0)).cast("double"))
    spread = deviation * c("n") / F.nullif(c("s"), F.lit(0)) * 100
    variation = half_up((c("w") * c("un") - c("u") * c("wn")) * 100, c("u") * c("wn"), 2)
    # a quotient of whole numbers that is no half is far from every half: rounding is safe
    mean = lambda s, n: F.round(c(s) / F.nullif(c(n), F.lit(0)), 0).cast("bigint")
    return fine.select(
        *keys, *([label] if label else []),
        c("n").cast("int").alias("months_with_data"), c("pos").cast("int").alias("months_with_value"),
        mean("s", "n").alias("avg_value"), *extremes, mean("q", "qn").alias("q4_value"),
        *[mean(f"a{i}", f"c{i}").alias(alias) for i, alias in enumerate(averages.values())],
        F.when(c("n") >= full_year, F.round(spread, 2)).alias("volatility_pct"),
        (c("w") / F.nullif(c("wn"), F.lit(0))).alias("winter_avg"),
        (c("u") / F.nullif(c("un"), F.lit(0))).alias("summer_avg"),
        F.when((c("w") > 0) & (c("u") > 0), variation).alias("seasonal_variation_pct"))


def with_previous_year(df: DataFrame, keys: list[str], year: str,
                       columns: dict[str, str]) -> DataFrame:
    """Add last year's values.

    The frame is "exactly one year before", so a gap gives null and a year with
    several rows gives its largest value.  The input is at yearly grain: a place
    has a row or a few per year, so its group stays small.
    """
    before = W.partitionBy(*keys).orderBy(year).rangeBetween(-1, -1)
    return df.withColumns({alias: F.max(c).over(before) for c, alias in columns.items()})


def with_previous_year_joined(df: DataFrame, keys: list[str], year: str,
                              columns: dict[str, str]) -> DataFrame:
    """The same by self-join, for places with very many rows per year: the years
    before are aggregated first, and adaptive execution splits a hot place."""
    before = (df.groupBy(*keys, (F.col(year) + 1).alias(year))
              .agg(*[F.max(c).alias(alias) for c, alias in columns.items()]))
    return df.join(before, [*keys, year], "left")
