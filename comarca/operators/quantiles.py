"""Exact medians of groups of any size, by selection instead of a sort or a buffer per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from comarca.operators.joins import lookup_join, salted_join
from comarca.operators.ranking import row_number_by
from comarca.session import freeze

#: Distinct values of a group that one task may order, and ranges a larger group is cut into.
MIDDLE_VALUES, RANGES = 1_000_000, 256


def exact_median(df: DataFrame, groups: list[str], value: str, middle: int = MIDDLE_VALUES,
                 ranges: int = RANGES) -> DataFrame:
    """(groups, median): the middle value of each group, or the mean of the two middle ones.

    Nulls do not count; groups without a value are left out, a null group is one.  Equal values are
    counted first.  While a group has more than ``middle`` distinct values, approximate quantiles
    cut them into ranges, the values per range are counted, and only the range that holds the
    middle is looked at further: the answer is exact whatever the quantiles were.  Each pass reads
    a small part of the one before.
    """
    g, v = F.struct(*[F.col(c) for c in groups]).alias("g"), F.col(value).alias("v")
    rows = freeze(df.where(F.col(value).isNotNull()).select(g, v).groupBy("g", "v").agg(F.count(F.lit(1)).alias("n")))
    totals = rows.groupBy("g").agg(F.sum("n").alias("total"))
    # two ranks per group; each is sought on its own once they part
    ranks = F.array(F.expr("(total + 1) div 2"), F.expr("total div 2 + 1"))
    sought = freeze(totals.select("g", F.posexplode(ranks).alias("which", "rank"), F.lit(0).cast("bigint").alias("part")))
    rows, size = rows.withColumn("part", F.lit(0).cast("bigint")), None
    while True:
        sizes = rows.groupBy("g", "part").agg(F.count(F.lit(1)).alias("values"))
        largest = sizes.agg(F.coalesce(F.max("values"), F.lit(0))).first()[0]
        if largest <= middle or largest == size:
            break
        size = largest
        cuts = rows.groupBy("g", "part").agg(F.percentile_approx(
            "v", [i / ranges for i in range(1, ranges)], 50 * ranges).alias("cuts"))
        placed = lookup_join(rows, cuts, ["g", "part"], "inner", derived=True, salt_on=["v"])
        # ranges are named by the way that led to them
        below = F.size(F.filter("cuts", lambda c: c < F.col("v")))
        placed = placed.withColumn("range", F.col("part") * ranges + below).drop("cuts")
        placed = freeze(placed)
        counts = placed.groupBy("g", "part", "range").agg(F.sum("n").alias("n"))  # at most ``ranges`` a group
        upto = Window.partitionBy("g", "part").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = counts.withColumn("upto", F.sum("n").over(upto))
        hit = (sought.join(counts, ["g", "part"]).where("rank <= upto and rank > upto - n")
               .select("g", "which", "part", "range", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank")))
        hit = freeze(hit)
        wanted = hit.select("g", "part", "range").distinct()
        rows = freeze(salted_join(placed, wanted, ["g", "part", "range"], "inner")
                      .select("g", "v", "n", F.col("range").alias("part")))
        sought = hit.select("g", "which", "rank", F.col("range").alias("part"))
    if largest <= middle:
        upto = Window.partitionBy("g", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ordered = rows.withColumn("upto", F.sum("n").over(upto)).withColumn("above", F.col("upto") - F.col("n"))
    else:  # quantiles that cut nothing off: a range sort finds the places
        single = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop("n")
        ordered = row_number_by(single, ["g", "part"], [F.col("v"), F.col("copy")], "upto").withColumn(
            "above", F.col("upto") - 1)
    found = sought.join(ordered, ["g", "part"]).where("rank <= upto and rank > above")
    return found.groupBy("g").agg(F.avg("v").alias("median")).select("g.*", "median")
