"""Near-duplicates by circulant MinHash, with exact verification.

One permutation scatters the shingle hashes, a second one, read from a start that moves on by
one place per coordinate, gives all signature coordinates.  Bands of coordinates are the
buckets.  Documents with equal shingle sets are one class with one representative, so copies
cost nothing further.  In every bucket the members are compared with one centre per round, the most central first
(it shares the largest buckets);
members that a link already joins are not compared again.  Members of buckets that are still
apart after the rounds meet by an exact prefix join: with shingles ranked rarest first, two
sets of the wanted similarity share one of the first few, at places that leave room for the
rest.  Links are confirmed on full shingle sets, and components grow by label propagation in
Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from comarca.llm.common import keep_table, rows_from, thinned
from comarca.llm.shingles import in_chunks, mix, shingle_sets

#: A pair of similarity 0.8 shares no band with probability (1 - 0.8 ** 4) ** 32 < 5e-8.
BANDS, ROWS = 32, 4
SHINGLE, PERCENT = 2, 80
#: Rounds of comparing buckets with one centre, before the prefix join.
STAR_ROUNDS = 1
#: A value that more than this part of all rows has is broadcast, so there are no more such values.
HOT = 100_000
#: Sets of one shingle that meet others in one task.
HOLDERS = 4096
#: Shingles whose signatures are computed together.
SIGNED = 1 << 15

# the two permutations: of the shingle hashes' 32 bits, and of the shifted values
_SCATTER, _FIRST, _SECOND = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)


def signatures(sets: list[np.ndarray], size: int = BANDS * ROWS) -> np.ndarray:
    """One row of ``size`` coordinates per set; sets must not be empty."""
    out = np.empty((len(sets), size), np.uint32)
    begin = 0
    while begin < len(sets):
        end, held = begin, 0
        while end < len(sets) and (end == begin or held + len(sets[end]) <= SIGNED):
            held += len(sets[end])
            end += 1
        values = (np.concatenate(sets[begin:end]) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        values ^= values >> np.uint32(16)
        values *= _SCATTER
        starts = np.cumsum([0, *(len(s) for s in sets[begin:end - 1])])
        x, y = np.empty_like(values), np.empty_like(values)
        for k in range(size):
            np.add(values, np.uint32(k), out=x)  # the second permutation, shifted by k places
            np.multiply(x, _FIRST, out=x)
            np.right_shift(x, np.uint32(15), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, _SECOND, out=x)
            out[begin:end, k] = np.minimum.reduceat(x, starts)
        begin = end
    return out


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key per band that differs between bands."""
    bands = signature.reshape(len(signature), -1, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(bands.shape[1], dtype=np.uint64), bands.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, r])
    return key.view(np.int64)


def set_keys(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    one, two = mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def profiles(df: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Per row: row, key, text_hash, n_shingles, h1 and h2 (name of the set), bands."""
    kind = df.select(f"`{key}`").schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first in rows_from(batches):
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            for begin, part in in_chunks(texts):
                sets = shingle_sets(part, width)
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [None] * len(sets)
                if full:
                    for i, keys in zip(full, band_keys(signatures([sets[i] for i in full])), strict=True):
                        bands[i] = keys
                names = [set_keys(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(first + begin, first + begin + len(sets)), pa.int64()),
                     batch.column(0).slice(begin, len(sets)), batch.column(2).slice(begin, len(sets)),
                     pa.array(map(len, sets), pa.int64()),
                     pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64()),
                     pa.array(bands, pa.list_(pa.int64()))],
                    ["row", "key", "text_hash", "n_shingles", "h1", "h2", "bands"])

    return df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"),
                     F.xxhash64(f"`{text}`").alias("text_hash")).mapInArrow(
        run, f"row long, key {kind}, text_hash long, n_shingles long, h1 long, h2 long, bands array<long>")


def full_sets(df: DataFrame, wanted: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(node, set) of the classes in ``wanted(node, key, h1, h2, copies)``: the text is read again,
    and counts only where it gives the named set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(3).to_pylist()]
            ones, twos = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for begin, part in in_chunks(texts):
                sets = shingle_sets(part, width)
                same = [i for i, s in enumerate(sets, begin)
                        if len(s) and set_keys(s) == (ones[i], twos[i])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(same, pa.int64())),
                     pa.array([sets[i - begin].tobytes() for i in same], pa.binary())], ["node", "set"])

    named = wanted.select("node", F.col("key").alias("_key"), "h1", "h2", "copies")
    rows = thinned(df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), "key", named, "_key")
    sets = rows.join(named, rows["key"].eqNullSafe(F.col("_key"))).select("node", "h1", "h2", "text").mapInArrow(
        run, "node long, set binary")
    return sets if wanted.filter("copies > 1").isEmpty() else sets.dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have that similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i, (one, two) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                one, two = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                if len(one) > len(two):
                    one, two = two, one
                at = np.minimum(np.searchsorted(two, one), len(two) - 1)
                shared = int((two[at] == one).sum())
                if 100 * shared >= percent * (len(one) + len(two) - shared):
                    good.append(i)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).take(pa.array(good, pa.int64())) for k in (0, 1)], ["a", "b"])

    first = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    second = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    return (pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "set_a", "set_b")
            .mapInArrow(run, "a long, b long"))


def merge_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels(node, label)`` after joining the components of every link (a, b).

    Components are the nodes of a small graph; each takes the smallest label around it and
    then that label's own label, until nothing changes.
    """
    def side(name: str, out: str) -> DataFrame:
        return labels.select(F.col("node").alias(name), F.col("label").alias(out))

    edges = (links.join(side("a", "x"), "a").join(side("b", "y"), "b").filter("x <> y")
             .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())
    edges = keep_table(edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))), "edges")
    if edges.isEmpty():
        return labels
    best = keep_table(edges.groupBy("x").agg(F.least("x", F.min("y")).alias("to")), "best")
    while True:
        around = (edges.join(best.select(F.col("x").alias("y"), F.col("to").alias("near")), "y")
                  .groupBy("x").agg(F.min("near").alias("near")))
        step = best.join(around, "x").select("x", F.col("to").alias("was"), F.least("to", "near").alias("to"))
        jump = step.select(F.col("x").alias("to"), F.col("to").alias("far"))
        step = keep_table(step.join(jump, "to", "left").select(
            "x", "was", F.least("to", F.coalesce("far", "to")).alias("to")), "best")
        best = step.select("x", "to")
        if step.filter("was <> to").isEmpty():
            break
    return keep_table(labels.join(best.withColumnRenamed("x", "label"), "label", "left")
                      .select("node", F.coalesce("to", "label").alias("label")), "labels")


def similar_size(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def components(classes: DataFrame, sets_of, percent: int) -> DataFrame:
    """(node, label): label is the smallest node of the component of a class."""
    buckets = classes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    shared = keep_table(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared")
    # a text from which others were made shares more bands than these do with each other
    central = F.sum("n").over(Window.partitionBy("node"))  # over the bands of a class
    buckets = keep_table(thinned(buckets, "bucket", shared, "bucket").join(shared, "bucket").select(
        "node", "n_shingles", "bucket", central.alias("central")), "buckets")
    labels = keep_table(buckets.select("node", F.col("node").alias("label")).distinct(), "labels")
    sets = keep_table(sets_of(labels.select("node")), "sets")
    buckets = buckets.withColumn("was", F.lit(False))
    for n in range(STAR_ROUNDS):
        # only buckets that are not yet in one component go on, with their centre of this round
        held = buckets.join(labels, "node") if n else buckets.withColumn("label", F.col("node"))
        # the most central member, of those that have not been centres before
        choice = F.struct(~F.col("was"), "central", "node")
        apart = (held.groupBy("bucket").agg(
            F.min("label").alias("low"), F.max("label").alias("high"),
            F.max_by(F.struct("node", "label", "n_shingles"), choice).alias("centre"))
            .filter("low <> high").select("bucket", "centre"))
        held = keep_table(held.join(apart, "bucket"), "held")
        buckets = held.select("node", "n_shingles", "bucket", "central",
                              (F.col("was") | (F.col("node") == F.col("centre.node"))).alias("was"))
        near = similar_size("n_shingles", "centre.n_shingles", percent)
        pairs = (held.filter((F.col("label") != F.col("centre.label")) & near)
                 .select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b"))
                 .distinct())
        labels = join_pairs(labels, keep_table(pairs, "pairs"), sets, percent)
    held = buckets.join(labels, "node")
    apart = (held.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
             .filter("low <> high").select("bucket"))
    apart = keep_table(held.join(apart, "bucket", "left_semi").select("node", "label").distinct(), "apart")
    if apart.isEmpty():
        return labels
    sets = keep_table(thinned(sets, "node", apart, "node").join(apart, "node", "left_semi"), "sets")
    return join_pairs(labels, keep_table(prefix_pairs(apart, sets, percent), "pairs"), sets, percent)


def join_pairs(labels: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``labels`` after joining the components of the confirmed ones of ``pairs(a, b)``."""
    if pairs.isEmpty():
        return labels
    return merge_labels(labels, keep_table(confirmed(pairs, sets, percent), "links"))


def join_counted(df: DataFrame, counted: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join with a lookup that says in ``n`` how many of the ``total`` rows of ``df`` have a key.

    Keys with more than a ``HOT``-th of the rows are at most ``HOT``: these are broadcast, and
    no other key is heavy for a task.
    """
    heavy = F.col("n") > max(1, total // HOT)
    hot = df.join(F.broadcast(counted.filter(heavy)), key)
    rest = df.join(F.broadcast(counted.filter(heavy).select(key)), key, "left_anti")
    return hot.unionByName(rest.join(counted.filter(~heavy), key))


def spread_sets(sets: DataFrame) -> DataFrame:
    """(node, size, shingle) of ``sets(node, set)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, held in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shingles = np.frombuffer(held.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(shingles), node)), pa.array(np.full(len(shingles), len(shingles))),
                     pa.array(shingles)], ["node", "size", "shingle"])

    return sets.select("node", "set").mapInArrow(run, "node long, size long, shingle long")


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(node, size, at, shingle): what of each set may be the first shingle that it shares with a
    set of that similarity, and its place, the rarest shingle first."""
    spread = spread_sets(sets)
    counted = keep_table(spread.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")), "frequency")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranked = (join_counted(spread, counted.filter("n > 1"), "shingle", total).groupBy("node", "size")
              .agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("held")))
    # shingles that no other set has come first, but cannot be shared
    alone = F.col("size") - F.size("held")
    first = F.expr(f"size - (size * {percent} + 99) div 100 + 1")
    wanted = F.slice("held", F.lit(1), F.greatest(F.lit(0), first - alone).cast("int"))
    return ranked.select("node", "size", alone.alias("alone"), F.posexplode(wanted)).select(
        "node", "size", (F.col("alone") + F.col("pos")).alias("at"), F.col("col.shingle").alias("shingle"))


def prefix_pairs(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of ``apart(node, label)`` with different labels, among them every pair
    of that similarity.

    Of such a pair the smaller set has the first shared shingle so early that as much as the two
    must share can still follow; this bounds what either side sends.  Holders of a shingle that
    are joined already do not meet: the largest component meets the others only.  A shingle of
    many holders is dealt over tasks.
    """
    entries = keep_table(prefixes(sets, percent).join(apart, "node"), "prefixes")
    by_label = entries.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("n"))
    holders = keep_table(by_label.groupBy("shingle").agg(
        F.sum("n").alias("n"), F.max_by("label", F.struct("n", "label")).alias("main"),
        F.count(F.lit(1)).alias("labels")).filter("labels > 1").drop("labels"), "holders")
    held = keep_table(join_counted(entries, holders, "shingle", entries.count()).select(
        "node", "size", "at", "shingle", "label", (F.lit(1) + F.col("n") / HOLDERS).cast("int").alias("parts"),
        (F.col("label") != F.col("main")).alias("out")), "held")
    early = F.expr(f"at < size - (2 * {percent} * size + {99 + percent}) div {100 + percent} + 1")

    def dealt(side: DataFrame, to_all: bool, name: str) -> DataFrame:
        part = (F.explode(F.sequence(F.lit(0), F.col("parts") - 1)) if to_all
                else F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        return side.select("shingle", part.alias("part"), *[F.col(c).alias(f"{name}_{c}")
                                                            for c in ("node", "label", "size", "at")])

    small, large = held.filter(early), held
    room = F.least(F.col("p_size") - F.col("p_at"), F.col("q_size") - F.col("q_at"))
    fits = ((F.col("p_label") != F.col("q_label"))
            & ((F.col("p_size") < F.col("q_size")) | ((F.col("p_size") == F.col("q_size")) & (F.col("p_node") < F.col("q_node"))))
            & (100 * F.col("p_size") >= percent * F.col("q_size"))
            & ((100 + percent) * room >= percent * (F.col("p_size") + F.col("q_size"))))

    def met(p: DataFrame, q: DataFrame) -> DataFrame:
        p, q = p.withColumnsRenamed({"shingle": "_shingle", "part": "_part"}), q
        same = (F.col("shingle") == F.col("_shingle")) & (F.col("part") == F.col("_part"))
        return p.join(q, same & fits).select(F.least("p_node", "q_node").alias("a"),
                                             F.greatest("p_node", "q_node").alias("b"))

    outside = met(dealt(small.filter("out"), True, "p"), dealt(large, False, "q"))
    inside = met(dealt(small.filter("not out"), False, "p"), dealt(large.filter("out"), True, "q"))
    return outside.unionByName(inside).distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE,
                    percent: int = PERCENT, with_hash: bool = False) -> DataFrame:
    """Per row: key, n_shingles, component_id, kept (and with ``with_hash`` a hash of the text).

    ``component_id`` is the smallest key reachable over links of at least ``percent`` / 100
    Jaccard similarity of the sets of ``width``-word shingles, ``kept`` whether it is the row's
    own.  Null and empty texts, and texts of white space, have no shingles and no links.  Rows
    that repeat a key count as rows of their own and agree in ``kept`` where they agree in the
    set; null keys come after all others.  Other columns are not read; an empty table gives an
    empty result.
    """
    rows = keep_table(profiles(df, key, text, width), "profiles")
    order = F.struct(F.col("key").isNull(), F.col("key"), F.col("row"))
    classes = (rows.filter("n_shingles > 0").groupBy("h1", "h2", "n_shingles")
               .agg(F.min_by(F.struct("row", "key", "bands"), order).alias("first")))
    classes = keep_table(classes.select("h1", "h2", "n_shingles", F.col("first.row").alias("node"),
                                        F.col("first.key").alias("key"), F.col("first.bands").alias("bands")), "classes")
    copies = rows.groupBy("key", "h1", "h2").agg(F.count(F.lit(1)).alias("copies"))

    def sets_of(wanted: DataFrame) -> DataFrame:
        named = classes.drop("bands").join(wanted, "node")
        repeated = copies.filter("copies > 1").select(F.col("key").alias("k"), F.col("h1").alias("one"),
                                                      F.col("h2").alias("two"), "copies")
        same = F.col("key").eqNullSafe(F.col("k")) & (F.col("h1") == F.col("one")) & (F.col("h2") == F.col("two"))
        named = keep_table(named.join(repeated, same, "left").select(
            "node", "key", "h1", "h2", F.coalesce("copies", F.lit(1)).alias("copies")), "wanted")
        return full_sets(df, named, key, text, width)

    labels = components(classes.select("node", "n_shingles", "bands"), sets_of, percent)
    joined = classes.drop("bands").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = joined.groupBy("label").agg(F.min("key").alias("component"))
    named = keep_table(joined.join(least, "label").select("h1", "h2", "n_shingles", "component"), "components")
    found = rows.select("key", "text_hash", "n_shingles", "h1", "h2").join(named, ["h1", "h2", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("key"))
    return found.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"),
                        F.col("key").eqNullSafe(component).alias("kept"), *["text_hash"] * with_hash)


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5,
                         percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` that are first of their component, with all their columns.

    Of rows that agree in key and text one stays.
    """
    found = keep_table(near_duplicates(df, key, text, width, percent, with_hash=True), "near").filter("kept")
    right = found.select(F.col(key).alias("_key"), F.col("text_hash").alias("_hash"))
    marked = df.withColumn("_text_hash", F.xxhash64(f"`{text}`"))
    out = marked.join(right, marked[key].eqNullSafe(F.col("_key")) & (F.col("_text_hash") == F.col("_hash")),
                      "left_semi")
    if not found.groupBy(key, "text_hash").count().filter("count > 1").isEmpty():
        out = out.dropDuplicates([key, "_text_hash"])
    return out.drop("_text_hash")
