"""Exact top-k by inner product over a bit-sliced index.

Rows are dealt into blocks; a block keeps one bitmap per dimension and bit of the quantised
value, less the least value of the dimension in the block, so that no slice is wasted on a sign.
A query adds slices, not numbers: the digits of its weights select slices, carry-save adders
reduce them to the slices of the sum, all with bitwise operations on whole bitmaps.  Only the
upper slices are added first; the lower ones can raise a sum by a known slack at most.  The
largest sums are selected from the most significant slice downward, every row within the slack
of the k-th is kept, and these boundary rows are resolved exactly from all their slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from comarca.llm.common import keep_table, salt

#: Value of one unit of a component: the scale of the quantisation.
SCALE = 1024
#: Rows of an index block and queries of a chunk; a task holds one of each at a time.
BLOCK, CHUNK = 16_384, 128
#: Slices per dimension that are added before the boundary rows are looked at.
UPPER = 7


def quantised(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))


def usable_rows(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector of longs): one row per id that takes part.

    Vectors that are null or empty, hold a null or non-finite component, or whose quantised
    form has a squared norm of 2^62 or more (its scores need not fit a long) take no part, nor
    do null ids.  Of rows that repeat an id the smallest vector counts.  Vectors of another
    length than the most frequent one (ties: the longer) take no part.
    """
    whole = F.col(f"`{vector}`")
    finite = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.aggregate(whole, F.lit(0.0), lambda s, x: s + F.pow(F.floor(SCALE * x.cast("double")).cast("double"), 2.0))
    rows = (df.filter(F.col(f"`{key}`").isNotNull() & whole.isNotNull() & (F.size(whole) > 0) & finite)
            .filter(norm < 2.0 ** 62)
            .groupBy(F.col(f"`{key}`").alias("id")).agg(F.min(quantised(whole)).alias("vector")))
    rows = keep_table(rows, "quantised")
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows if sizes is None else rows.filter(F.size("vector") == sizes["size"])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least value per dimension, and the slices (dimension, bit, word) of what is above it."""
    least = values.min(axis=0)
    above = (values - least).astype(np.uint64)
    bits, rows = max(1, int(above.max()).bit_length()), len(values)
    words = -(-rows // 64)
    slices = np.zeros((values.shape[1], bits, words * 8), np.uint8)
    for bit in range(bits):
        packed = np.packbits((above >> np.uint64(bit) & np.uint64(1)).astype(np.uint8), axis=0, bitorder="little")
        slices[:, bit, :len(packed)] = packed.T
    return least, slices.view(np.uint64)


def add_slices(inputs: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Slices of the sum of bitmaps: ``inputs`` has, per power of two, arrays (bitmap, word)."""
    out, level = [], 0
    while any(at >= level for at in inputs):
        maps = inputs.pop(level, [])
        level += 1
        if not maps:
            out.append(None)
            continue
        rows = maps[0] if len(maps) == 1 else np.concatenate(maps)
        carries = []
        while len(rows) > 1:  # three bitmaps of a level make one of it and one of the next
            third = len(rows) // 3
            if third:
                a, b, c = rows[:third], rows[third:2 * third], rows[2 * third:3 * third]
                both = a ^ b
                carries.append((a & b) | (both & c))
                both ^= c
                rows = both if len(rows) == 3 * third else np.concatenate([both, rows[3 * third:]])
            else:
                carries.append(rows[:1] & rows[1:])
                rows = rows[:1] ^ rows[1:]
        out.append(rows[0])
        if carries:
            inputs.setdefault(level, []).extend(carries)
    return out


def coarse_sum(slices: np.ndarray, flipped: np.ndarray, weights: np.ndarray, low: int) -> list[np.ndarray]:
    """Slices of sum(|w| * c), c the value above ``low`` bits, complemented where w is negative."""
    size, bits = np.abs(weights), slices.shape[1]
    inputs: dict[int, list[np.ndarray]] = {}
    for digit in range(int(size.max()).bit_length()):
        used = size >> digit & 1 == 1
        up, down = np.flatnonzero(used & (weights > 0)), np.flatnonzero(used & (weights < 0))
        for bit in range(low, bits):
            at = inputs.setdefault(digit + bit - low, [])
            if len(up):
                at.append(slices[up, bit])
            if len(down):
                at.append(flipped[down, bit])
    return add_slices(inputs)


def select_top(total: list[np.ndarray], among: np.ndarray, k: int) -> int:
    """The k-th largest sum of the rows in ``among``, found from the top slice downward."""
    level, sure, maybe = 0, np.zeros_like(among), among
    for at in reversed(range(len(total))):
        ones = np.zeros_like(among) if total[at] is None else maybe & total[at]
        if np.bitwise_count(sure).sum() + np.bitwise_count(ones).sum() >= k:
            level |= 1 << at
            maybe = ones
        else:
            sure, maybe = sure | ones, maybe & ~ones
    return level


def at_least(total: list[np.ndarray], among: np.ndarray, bound: int) -> np.ndarray:
    """Bitmap of the rows in ``among`` whose sum is ``bound`` or more."""
    if bound <= 0:
        return among
    if bound >> len(total):
        return np.zeros_like(among)
    above, equal = np.zeros_like(among), among
    for at in reversed(range(len(total))):
        here = np.zeros_like(among) if total[at] is None else total[at]
        if bound >> at & 1:
            equal = equal & here
        else:
            above, equal = above | (equal & here), equal & ~here
    return above | equal


def resolve(slices: np.ndarray, least: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Exact scores of single rows, their values put together again from all slices."""
    bits = slices[:, :, rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)
    places = (np.uint64(1) << np.arange(slices.shape[1], dtype=np.uint64))[None, :, None]
    values = (bits * places).sum(axis=1, dtype=np.uint64).astype(np.int64) + least[:, None]
    return weights @ values


def best_rows(ids: np.ndarray, least: np.ndarray, slices: np.ndarray, flipped: np.ndarray, upper: int, own: int,
              weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows of a block other than ``own``, ties to the smaller id."""
    count, bits = len(ids), slices.shape[1]
    among = np.packbits(np.pad(ids != own, (0, slices.shape[2] * 64 - count)), bitorder="little").view(np.uint64)
    if count - int((ids == own).sum()) <= k or not weights.any():
        rows = np.flatnonzero(ids != own)
    else:
        low = max(0, bits - upper)
        total = coarse_sum(slices, flipped, weights, low)
        # what the slices below ``low`` can add, in units of the sums
        slack = sum(abs(int(w)) for w in weights) * ((1 << low) - 1) >> low
        near = at_least(total, among, select_top(total, among, k) - slack)
        rows = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little"))
    scores = resolve(slices, least, rows, weights)
    order = np.lexsort((ids[rows], -scores))[:k]
    return ids[rows][order], scores[order]


def index_blocks(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, int]:
    """The index: (block, ids, least, slices, bits) with about ``block`` rows in each, and its size."""
    parts = max(1, -(-rows.count() // block))

    def build(part: pa.Table) -> pa.Table:
        part = part.sort_by("id")
        least, slices = slices_of(_matrix(part["vector"]))
        return pa.table({"block": part["block"].slice(0, 1), "ids": [part["id"].to_numpy().tobytes()],
                         "least": [least.tobytes()], "slices": [slices.tobytes()], "bits": [slices.shape[1]]},
                        schema=pa.schema([("block", pa.int32()), ("ids", pa.binary()), ("least", pa.binary()),
                                          ("slices", pa.binary()), ("bits", pa.int32())]))

    dealt = rows.select(salt(F.col("id"), parts=parts).alias("block"), F.col("id").cast("long").alias("id"), "vector")
    return keep_table(dealt.groupBy("block").applyInArrow(
        build, "block int, ids binary, least binary, slices binary, bits int"), "slices"), parts


def top_scores(df: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", every: int = 100,
               block: int = BLOCK, chunk: int = CHUNK, upper: int = UPPER) -> DataFrame:
    """For each row whose key is divisible by ``every``: the ``k`` other rows of the highest
    integer inner product of the quantised vectors.

    Returns query_id, rank (from 1), the key, score; ties go to the smaller key.  All rows but
    the query's own are candidates, zero vectors too.  See ``usable_rows`` for rows that take
    no part.  Other columns are not read; an empty table, or a single row, gives an empty
    result.  Every chunk of queries meets every block of the index once: that is the stated
    query set against all rows, and no pair of rows is ever made.
    """
    rows = usable_rows(df, key, vector)
    index, blocks = index_blocks(rows, block)
    asked = keep_table(rows.filter(F.col("id") % every == 0), "asked")
    chunks = max(1, -(-asked.count() // chunk))
    queries = (asked.groupBy(salt(F.col("id"), parts=chunks).alias("chunk"))
               .agg(F.collect_list(F.struct("id", "vector")).alias("queries"))  # about ``chunk`` of them
               .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    tiles = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).join(
        queries, ["block", "chunk"]).select("ids", "least", "slices", "bits", "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, least = (np.frombuffer(batch[c][at].as_buffer(), np.int64) for c in ("ids", "least"))
                slices = np.frombuffer(batch["slices"][at].as_buffer(), np.uint64).reshape(
                    len(least), batch["bits"][at].as_py(), -1)
                flipped, found = ~slices, []
                for q in batch["queries"][at].as_py():
                    near, scores = best_rows(ids, least, slices, flipped, upper, q["id"],
                                             np.array(q["vector"], np.int64), k)
                    found.append((np.full(len(near), q["id"]), near, scores))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found, strict=True)],
                    ["query_id", "id", "score"])

    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (tiles.mapInArrow(run, "query_id long, id long, score long").withColumn("rank", best)
            .filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score"))
