"""Approximate nearest neighbours: neighbour graphs by NN-descent, searched greedily.

Equal vectors are one node.  Nodes are dealt into blocks of a bounded size, and each block gets a
graph of its own.  Every node starts with the nearest of two random small groups of its block.  In
each round a node's neighbours and a fresh sample of the nodes that have it as neighbour (that
sample is part of NN-descent) are joined with their vectors and compared with each other:
neighbours of neighbours become candidates, and each node keeps its ``DEGREE`` nearest.  Rounds go
on until at most ``CONVERGED`` of the edges are new.  A query walks the graph of every block: from
a few nodes spread over it, it expands its nearest unexpanded nodes until the ``BEAM`` nearest
nodes seen have all been expanded.  So recall depends on the size of a block, not of the table.
The true nearest of a few queries are found by brute force; while less than ``RECALL`` of them has
been found, all queries go again with a beam of twice the size.  Distances of what was found are
computed again in double precision.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from comarca.llm.common import keep_table, salt

DEGREE, REVERSE = 20, 20
#: Share of new edges under which the graph counts as converged.
CONVERGED = 0.001
#: Vectors in a random starting block, and groups of a local join in one task call.
BLOCK, GROUPS = 64, 400
#: Nodes of a block (fewer where vectors are long: bytes of a block's vectors), queries of a chunk.
GRAPH_NODES, GRAPH_BYTES, CHUNK = 16_384, 1 << 25, 256
#: Search: nodes a query begins with in a block, nodes kept as the current best, nodes expanded per
#: round, neighbours of a node (its own and the nearest of those that point to it).
ENTRIES, BEAM, EXPAND, SEARCH_DEGREE = 32, 256, 48, 60
#: Queries that are compared with brute force, and the share of their nearest to be seen.
CHECKED, RECALL = 64, 0.95


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def usable_rows(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector): one row per id that takes part.

    Of rows that repeat an id the smallest vector counts.  Vectors of another length than
    the most frequent one (ties: the longer) take no part, nor do null ids.
    """
    rows = (df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
            .filter(F.col("id").isNotNull() & usable(F.col("vector")))
            .groupBy("id").agg(F.min("vector").alias("vector")))
    rows = keep_table(rows, "vectors")
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows if sizes is None else rows.filter(F.size("vector") == sizes["size"])


def nodes_of(rows: DataFrame, members: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, vector) named by their smallest id, and each node's ``members`` smallest ids."""
    marked = rows.withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit(1), "vector"))
    classes = marked.groupBy("h1", "h2").agg(F.min("id").alias("node"))
    named = keep_table(marked.join(classes, ["h1", "h2"]).select("id", "node", "vector"), "nodes")
    nodes = named.filter("id = node").select("node", "vector")
    first = Window.partitionBy("node").orderBy("id")
    ids = (named.select("node", "id").withColumn("rank", F.row_number().over(first))
           .filter(F.col("rank") <= members).select("node", "id"))
    return nodes, ids


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1)


def _distances(x: np.ndarray) -> np.ndarray:
    x = x - x.mean(axis=0)  # what is common to all vectors would cost digits
    squares = np.einsum("ij,ij->i", x, x)
    out = squares[:, None] + squares[None] - 2 * (x @ x.T)
    np.maximum(out, 0, out=out)
    np.fill_diagonal(out, np.inf)
    return out


def _edges(a: np.ndarray, b: np.ndarray, d: np.ndarray) -> pa.Table:
    return pa.table({"node": pa.array(a, pa.int64()), "other": pa.array(b, pa.int64()),
                     "d": pa.array(d, pa.float64())})


def _nearest(d: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``count`` least finite entries of each row."""
    count = min(count, d.shape[1])
    column = np.argpartition(d, count - 1, axis=1)[:, :count].ravel()
    row = np.repeat(np.arange(len(d)), count)
    use = np.isfinite(d[row, column])
    return row[use], column[use]


def blocks_of(nodes: DataFrame) -> int:
    """Number of blocks of the graph."""
    first = nodes.select(F.size("vector").alias("dimensions")).first()
    if first is None:
        return 1
    most = min(GRAPH_NODES, max(BLOCK, GRAPH_BYTES // (8 * first["dimensions"])))
    return max(1, -(-nodes.count() // most))


def starting_edges(nodes: DataFrame, degree: int, blocks: int = 1) -> DataFrame:
    """For each node the nearest of two random groups of its block that it falls into, half from
    either, so that groups are linked with each other.  A single group gives all its nearest."""
    groups = max(1, nodes.count() // blocks // BLOCK)
    share = degree if groups == 1 else degree // 2

    def run(part: pa.Table) -> pa.Table:
        d, names = _distances(_matrix(part["vector"])), part["node"].to_numpy()
        row, column = _nearest(d, share)
        return _edges(names[row], names[column], d[row, column])

    twice = nodes.withColumn("deal", F.explode(F.array(F.lit(0), F.lit(1))))
    return twice.groupBy("deal", salt(F.col("node"), parts=blocks).alias("block"),
                         salt(F.col("node"), F.col("deal"), parts=groups).alias("group")).applyInArrow(
        run, "node long, other long, d double").distinct()


def offered_edges(graph: DataFrame, nodes: DataFrame, size: int, degree: int, turn: int = 0) -> DataFrame:
    """Candidates of one round: for both ends of every pair of neighbours of a node, where one of
    the two is new to it and the pair is nearer than the farthest neighbour so far.  A local join
    offers ``degree`` to a node: of more, none could stay."""
    pointing = (graph.select(F.col("other").alias("hub"), F.col("node").alias("member"), "new")
                .withColumn("rank", F.row_number().over(Window.partitionBy("hub").orderBy(
                    F.xxhash64(F.lit(turn), "hub", "member"), "member")))  # another sample every round
                .filter(F.col("rank") <= REVERSE).drop("rank"))
    around = (graph.select(F.col("node").alias("hub"), F.col("other").alias("member"), "new").unionByName(pointing)
              .groupBy("hub", "member").agg(F.max("new").alias("new")))
    # a node with fewer neighbours than it may have takes any
    farthest = graph.groupBy("node").agg(
        F.when(F.count(F.lit(1)) >= degree, F.max("d")).otherwise(float("inf")).alias("far"))
    known = nodes.join(farthest, "node", "left").withColumnRenamed("node", "member")

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by([("hub", "ascending"), ("member", "ascending")])
        hubs, names = part["hub"].to_numpy(), part["member"].to_numpy()
        x, new, far = _matrix(part["vector"]), part["new"].to_numpy(), part["far"].to_numpy()
        cuts = np.flatnonzero(np.diff(hubs)) + 1
        out = []
        for a, b in zip([0, *cuts], [*cuts, len(hubs)], strict=True):
            d = _distances(x[a:b])
            d[~(new[a:b, None] | new[None, a:b]) | (d >= far[a:b, None])] = np.inf
            row, column = _nearest(d, degree)
            out.append((names[a:b][row], names[a:b][column], d[row, column]))
        return _edges(*(np.concatenate(c) for c in zip(*out, strict=True)))

    return (around.join(known, "member").withColumn("chunk", salt(F.col("hub"), parts=max(1, size // GROUPS)))
            .groupBy("chunk").applyInArrow(run, "node long, other long, d double").distinct())


def neighbour_graph(nodes: DataFrame, degree: int = DEGREE, rounds: int | None = None, blocks: int = 1) -> DataFrame:
    """Edges (node, other, d, new) to about the ``degree`` nearest in the block; d is the squared
    distance.  Without ``rounds`` it ends when it has converged."""
    size = nodes.count()
    graph = keep_table(starting_edges(nodes, degree, blocks).withColumn("new", F.lit(True)), "graph")
    for turn in itertools.count() if rounds is None else range(rounds):
        offers = offered_edges(graph, nodes, size, degree, turn).withColumn("new", F.lit(True))
        both = (graph.withColumn("new", F.lit(False)).unionByName(offers)
                .groupBy("node", "other").agg(F.min("d").alias("d"), F.min("new").alias("new")))
        best = F.row_number().over(Window.partitionBy("node").orderBy("d", "other"))
        graph = keep_table(both.withColumn("rank", best).filter(F.col("rank") <= degree).drop("rank"), "graph")
        if graph.filter("new").count() <= CONVERGED * degree * size:
            break
    return graph


def squared(a: Column, b: Column, kind: str) -> Column:
    zero = F.lit(0).cast(kind)
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast(kind) - y.cast(kind)), zero,
                       lambda s, x: (s + x * x).cast(kind))


def true_nearest(queries: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(query, node): the ``k`` nearest other nodes of ``CHECKED`` queries, by brute force."""
    chosen = queries.orderBy(F.xxhash64("query"), "query").limit(CHECKED).collect()  # bounded
    asked = np.array([r["vector"] for r in chosen])
    names, own = np.array([r["query"] for r in chosen]), np.array([r["node"] for r in chosen])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others, x = batch["node"].to_numpy(), _matrix(pa.chunked_array([batch["vector"]]))
            d = np.stack([np.einsum("ij,ij->i", x - a, x - a) for a in asked])
            d[own[:, None] == others] = np.inf
            row, column = _nearest(d, k)
            # none where the batch holds nothing but the own node of the only query
            yield from _edges(names[row], others[column], d[row, column]).rename_columns(["query", "node", "d"]).to_batches()

    if not chosen:
        return queries.select("query", "node").limit(0)
    best = F.row_number().over(Window.partitionBy("query").orderBy("d", "node"))
    return keep_table(nodes.mapInArrow(run, "query long, node long, d double").withColumn("rank", best)
                      .filter(F.col("rank") <= k).select("query", "node"), "truth")


def walk(x: np.ndarray, links: np.ndarray, asked: np.ndarray, entries: np.ndarray, beam: int,
         expand: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows seen by a greedy search from ``entries``, nearest first, and their squared distances.

    ``links`` has the neighbours of each row, -1 where it has fewer.
    """
    far = np.full(len(x), np.inf)
    seen, done, new = np.empty(0, np.int64), np.zeros(len(x), bool), entries
    while True:
        difference = x[new] - asked
        far[new] = np.einsum("ij,ij->i", difference, difference)
        seen = np.concatenate([seen, new])
        seen = seen[np.argsort(far[seen], kind="stable")]
        front = seen[:beam]
        front = front[~done[front]][:expand]
        if not len(front):
            return seen, far[seen]
        done[front] = True
        new = np.unique(links[front])
        new = new[new >= 0]
        new = new[np.isinf(far[new])]


def graph_blocks(graph: DataFrame, nodes: DataFrame, blocks: int) -> DataFrame:
    """One row per block: names, vectors and links of its nodes, as matrices."""
    near = F.row_number().over(Window.partitionBy("node").orderBy("d", "other"))
    both = graph.select("node", "other", "d").unionByName(
        graph.select(F.col("other").alias("node"), F.col("node").alias("other"), "d")).distinct()
    links = (both.withColumn("rank", near).filter(F.col("rank") <= SEARCH_DEGREE)
             .select(salt(F.col("node"), parts=blocks).alias("block"), "node", "other", "rank"))

    def build(part: pa.Table, near: pa.Table) -> pa.Table:
        part = part.sort_by("node")
        names = part["node"].to_numpy()
        matrix = np.full((len(names), SEARCH_DEGREE), -1, np.int32)
        at = np.searchsorted(names, near["node"].to_numpy())
        matrix[at, near["rank"].to_numpy() - 1] = np.searchsorted(names, near["other"].to_numpy())
        return pa.table({"block": part["block"].slice(0, 1), "names": [names.tobytes()],
                         "vectors": [np.ascontiguousarray(_matrix(part["vector"])).tobytes()], "links": [matrix.tobytes()]},
                        schema=pa.schema([("block", pa.int32()), ("names", pa.binary()), ("vectors", pa.binary()),
                                          ("links", pa.binary())]))

    dealt = nodes.withColumn("block", salt(F.col("node"), parts=blocks))
    return keep_table(dealt.groupBy("block").cogroup(links.groupBy("block")).applyInArrow(
        build, "block int, names binary, vectors binary, links binary"), "blocks")


def search(queries: DataFrame, graph: DataFrame, nodes: DataFrame, beam: int = BEAM,
           expand: int = EXPAND, k: int = 10, blocks: int = 1) -> DataFrame:
    """The nearest nodes found for each query: (query, node, d), ``2 k + 2`` of every block.

    ``queries`` has (query, node, vector).  A chunk of queries meets each block once: that is the
    stated query set against all blocks, and a task holds one of each.
    """
    truth, size = true_nearest(queries, nodes, k), nodes.count()
    wanted, keep = truth.count(), 2 * k + 2
    built = graph_blocks(graph, nodes, blocks)
    chunks = max(1, -(-queries.count() // CHUNK))
    asked = (queries.groupBy(salt(F.col("query"), parts=chunks).alias("chunk"))
             .agg(F.collect_list(F.struct("query", "vector")).alias("asked"))  # about ``CHUNK`` of them
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    tiles = built.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).join(
        asked, ["block", "chunk"]).select("names", "vectors", "links", "asked")

    def found(width: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    names = np.frombuffer(batch["names"][at].as_buffer(), np.int64)
                    x = np.frombuffer(batch["vectors"][at].as_buffer()).reshape(len(names), -1)
                    links = np.frombuffer(batch["links"][at].as_buffer(), np.int32).reshape(len(names), -1)
                    entries = np.unique(np.linspace(0, len(names) - 1, min(ENTRIES, len(names))).astype(np.int64))
                    for q in batch["asked"][at].as_py():
                        seen, d = walk(x, links, np.array(q["vector"]), entries, width, expand * width // beam)
                        near = names[seen[:keep]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(near), q["query"])), pa.array(near), pa.array(d[:keep])],
                            ["query", "node", "d"])

        return keep_table(tiles.mapInArrow(run, "query long, node long, d double"), "found")

    width = beam
    while True:
        seen = found(width)
        if width >= size or truth.join(seen, ["query", "node"]).count() >= RECALL * wanted:
            return seen
        width *= 2


def nearest(df: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", every: int = 100,
            beam: int = BEAM, rounds: int | None = None) -> DataFrame:
    """For each row whose key is divisible by ``every``: its ``k`` nearest other rows.

    Returns query_id, rank (from 1), the key, score (Euclidean distance in double precision);
    ties go to the smaller key.  Null, empty, zero and non-finite vectors take no part, see
    ``usable_rows`` for repeated keys and lengths.  Other columns are not read; an empty
    table, or one with a single usable vector, gives an empty result.
    """
    rows = usable_rows(df, key, vector)
    nodes, ids = nodes_of(rows, k + 1)
    blocks = blocks_of(nodes)
    graph = neighbour_graph(nodes, rounds=rounds, blocks=blocks)
    asked = keep_table(rows.filter(F.col("id") % every == 0).withColumn("h1", F.xxhash64("vector"))
                       .withColumn("h2", F.xxhash64(F.lit(1), "vector")), "queries")
    named = nodes.withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit(1), "vector"))
    queries = keep_table(asked.join(named.select("h1", "h2", "node"), ["h1", "h2"])
                         .select(F.col("id").alias("query"), "node", "vector"), "queries")
    seen = search(queries, graph, nodes, beam, k=k, blocks=blocks)
    best = F.row_number().over(Window.partitionBy("query").orderBy("d", "node"))
    short = seen.withColumn("rank", best).filter(F.col("rank") <= 2 * k + 2).select("query", "node")
    scored = (short.join(nodes, "node").join(queries.select("query", F.col("vector").alias("asked")), "query")
              .select("query", "node", F.sqrt(squared(F.col("vector"), F.col("asked"), "double")).alias("score")))
    final = F.row_number().over(Window.partitionBy("query").orderBy("score", "id"))
    return (scored.join(ids, "node").filter(F.col("id") != F.col("query")).withColumn("rank", final)
            .filter(F.col("rank") <= k)
            .select(F.col("query").alias("query_id"), "rank", F.col("id").alias(key), "score"))
