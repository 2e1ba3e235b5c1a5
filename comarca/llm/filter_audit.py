"""Filter interaction audit: what each filter removes in every order, by path counting.

Filters applied one after another form paths through the lattice of subsets of the filters: a
state is the set applied so far, an edge adds one filter.  What an edge removes depends on its
state alone, not on the way there: the rows that pass every filter of the state and fail the
new one.  So rows are reduced to counts per part and failure mask (which filters a row fails),
every edge is priced once from these counts, the orders through an edge are counted forward
(orders that reach its state) and backward (orders that leave its end), and both the steps of
all orders and the Shapley sums are read from the same edges.  No order runs over the rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, functions as F

from comarca.llm.common import WHITE_SPACE, keep_table

#: Filters of ``document_failures``, in the order of their bits.
FILTERS = "ABCDE"
COUNTS = ("n", "good", "toxic")


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of one text; a null text counts as empty.

    A: under 200 words; B: under half of the words are distinct; C: over 3 % of the code
    points are ``[A-Z]``; D: holds one of ``#$%&*|``.  Words are maximal runs of other
    characters than white space (space, tab to carriage return) and case-sensitive.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, f"[{WHITE_SPACE}]+"), "")
    # capitals are one byte each, so bytes may be counted
    capitals = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"A": F.size(words) < 200,
            "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
            "C": 100 * capitals.cast("long") > 3 * F.char_length(text).cast("long"),
            "D": text.rlike("[#$%&*|]")}


def document_failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: part, mask (bit i: fails filter i of ``FILTERS``), good, toxic.

    E fails if a row with a smaller ``doc_id`` has the identical text, wherever in the table.
    A null ``doc_id`` is neither smaller nor larger than another: such rows pass E and make
    none fail it; rows that repeat a ``doc_id`` do not fail each other.  A document is good
    or toxic if any of its labels says so.  A null ``lang`` counts as the empty part.  Other
    columns are not read.

    Copies are found without a group per text: the least id per digest is an aggregation, and
    the documents that hold it meet it in a join on (digest, id), which no hot text can skew.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    mask = sum((fails.cast("int") * (1 << i) for i, fails in enumerate(text_failures(F.col("text")).values())),
               F.lit(0))
    rows = keep_table(docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), mask.alias("mask"),
                                  F.unhex(F.sha2(text, 256)).alias("digest")), "masks")
    first = (rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter(F.col("doc_id").isNotNull())
             .withColumn("first", F.lit(True)))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    return (rows.join(first, ["digest", "doc_id"], "left")
            .select("doc_id", "part", (F.col("mask") + copy.cast("int") * 16).alias("mask"))
            .join(marks, "doc_id", "left")
            .select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"),
                    F.coalesce("toxic", F.lit(0)).alias("toxic")))


def orders_through(size: int) -> tuple[list[int], list[int]]:
    """Per subset of ``size`` filters: orders that reach it from the empty one, and that lead from
    it to the full one."""
    reach, leave = [0] * (1 << size), [0] * (1 << size)
    reach[0] = leave[-1] = 1
    for state in range(1, 1 << size):  # a subset has a larger number than its own subsets
        reach[state] = sum(reach[state ^ (1 << i)] for i in range(size) if state >> i & 1)
    for state in reversed(range((1 << size) - 1)):
        leave[state] = sum(leave[state | (1 << i)] for i in range(size) if not state >> i & 1)
    return reach, leave


def cells(rows: DataFrame, size: int) -> DataFrame:
    """Counts n, good and toxic per part and failure mask, zeros included."""
    found = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"),
                                             F.sum("toxic").alias("toxic"))
    found = keep_table(found, "cells")
    zeros = (found.select("part").distinct()
             .select("part", F.explode(F.sequence(F.lit(0), F.lit((1 << size) - 1))).alias("mask"),
                     *[F.lit(0).cast("long").alias(c) for c in COUNTS]))
    return (found.select("part", "mask", *[F.col(c).cast("long") for c in COUNTS]).unionByName(zeros)
            .groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS]))


def priced_edges(counts: DataFrame, filters: str) -> DataFrame:
    """Per part, state and filter outside it: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and ``weighed`` (removed, times the orders through the edge).

    What an edge takes from a mask is a table of its own, of a size that depends on the number
    of filters alone (``2 ** (2 n - 1) * n`` rows), joined with the counts on the mask.
    """
    spark, size = counts.sparkSession, len(filters)
    reach, leave = orders_through(size)
    tolls = []
    for state, i in itertools.product(range(1 << size), range(size)):
        bit = 1 << i
        if state & bit:
            continue
        for mask in range(1 << size):
            fails, seen = bool(mask & bit), bool(mask & state)
            tolls.append((state, filters[i], mask, int(not mask & (state | bit)), int(fails and not seen),
                          int(fails and seen), int(mask == bit), reach[state] * leave[state | bit]))
    toll = spark.createDataFrame(tolls, "state int, filter string, mask int, keeps int, takes int, late int, "
                                        "only int, orders long")
    edges = (counts.join(F.broadcast(toll), "mask").groupBy("part", "state", "filter")
             .agg(F.sum(F.col("n") * F.col("keeps")).alias("kept"), F.sum(F.col("n") * F.col("takes")).alias("removed"),
                  F.sum(F.col("n") * F.col("late")).alias("redundant"),
                  F.sum(F.col("n") * F.col("only")).alias("unique_fails"),
                  F.sum(F.col("good") * F.col("takes")).alias("good_lost"),
                  F.sum(F.col("toxic") * F.col("takes")).alias("toxic_lost"),
                  F.sum(F.col("n") * F.col("takes") * F.col("orders")).alias("weighed")))
    return edges


def audit_orders(rows: DataFrame, filters: str) -> DataFrame:
    """Per part, order of the filters and step (from 1): the counts of the step's edge and
    ``shapley``, the filter's removals summed over all orders.

    ``rows`` has part, mask (bit i: fails ``filters[i]``), good and toxic (0 or 1).  Every part
    that occurs gets all orders; an empty table gives an empty result.  There are n! orders:
    meant for a handful of filters.
    """
    edges = keep_table(priced_edges(cells(rows, len(filters)), filters), "edges")
    sums = edges.groupBy("part", "filter").agg(F.sum("weighed").alias("shapley"))
    steps = []
    for order in itertools.permutations(filters):
        state = 0
        for step, letter in enumerate(order, 1):
            steps.append(("".join(order), step, state, letter))
            state |= 1 << filters.index(letter)
    walk = rows.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, filter string")
    return (edges.join(sums, ["part", "filter"]).join(F.broadcast(walk), ["state", "filter"])
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                    "toxic_lost", "shapley"))


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters of ``document_failures``, per language."""
    return audit_orders(document_failures(docs, labels), FILTERS)
