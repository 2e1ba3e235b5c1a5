"""Chat formatting: logged snapshots of growing conversations collapse to the longest ones.

Services log a conversation again after every turn, so one conversation is a prefix of
another.  Each turn gets a digest of its position, role and text; the exclusive-or of the
digests of the first k turns is the hash of the k-turn prefix, and can be extended turn by
turn and block by block.  A conversation whose hash is that of a shorter prefix of another
one is dropped by an anti-join, exact copies keep the smallest id, and what is left is
rendered.  All of it is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from comarca.llm.common import keep_table

#: Turns of one conversation that are put in order in one task; longer conversations are cut
#: into blocks of that many turn numbers, linked by the hashes and counts of whole blocks.
BLOCK = 1024


def _halves(digest: Column) -> list[Column]:
    """Two numbers of 60 bits from the first 30 hex digits."""
    return [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("long") for i in range(2)]


def number_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", block: int = BLOCK) -> DataFrame:
    """Turns as (conv, pos, role, text, h1, h2): position from 1 and the hash of the prefix up to it.

    Order: turn (null first), role, text; null roles and texts count as empty.  A repeated
    row is a turn of its own.  Rows with a null conversation form one conversation.
    """
    rows = df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                     F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
                     F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("block", F.floor(F.col("turn") / block))
    # turns before each block: counts per block, summed over the blocks of a conversation
    before = (rows.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(
                  Window.partitionBy("conv").orderBy(F.asc_nulls_first("block"))
                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    inside = Window.partitionBy("conv", "block").orderBy(F.asc_nulls_first("turn"), "role", "text")
    placed = rows.withColumn("at", F.row_number().over(inside))
    placed = _with_block(placed, before.drop("n")).withColumn("pos", F.col("at") + F.col("before"))
    digest = F.sha2(F.concat_ws("\x1f", F.col("pos").cast("string"),
                                F.char_length("role").cast("string"), "role", "text"), 256)
    placed = placed.withColumn("digest", digest)
    one, two = _halves(F.col("digest"))
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (placed.withColumn("h1", one).withColumn("h2", two)
              .withColumn("r1", F.bit_xor("h1").over(running)).withColumn("r2", F.bit_xor("h2").over(running)))
    blocks = Window.partitionBy("conv").orderBy(F.asc_nulls_first("block")).rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (placed.groupBy("conv", "block").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
              .select("conv", "block", F.coalesce(F.bit_xor("b1").over(blocks), F.lit(0)).alias("s1"),
                      F.coalesce(F.bit_xor("b2").over(blocks), F.lit(0)).alias("s2")))
    return _with_block(placed, starts).select(
        "conv", "pos", "role", "text", F.col("r1").bitwiseXOR(F.col("s1")).alias("h1"),
        F.col("r2").bitwiseXOR(F.col("s2")).alias("h2"))


def _with_block(turns: DataFrame, blocks: DataFrame) -> DataFrame:
    """Turns with the columns of their block; nulls are values like any other."""
    named = blocks.withColumnsRenamed({"conv": "_conv", "block": "_block"})
    return turns.join(named, F.col("conv").eqNullSafe(F.col("_conv"))
                      & F.col("block").eqNullSafe(F.col("_block"))).drop("_conv", "_block")


def collapse(turns: DataFrame) -> DataFrame:
    """Conversations that stay: (conv, n_turns, copies), from the numbered turns.

    The first turn, or a whole conversation, may stand in a third of all logs: prefixes are
    reduced to distinct (length, hash) on the map side, so neither join meets a hot key.
    """
    whole = (turns.groupBy("conv").agg(F.max_by(F.struct("pos", "h1", "h2"), "pos").alias("last"))
             .select("conv", "last.*"))
    distinct = whole.groupBy("pos", "h1", "h2").agg(F.min_by("conv", F.struct(F.col("conv").isNull(), "conv"))
                                                    .alias("conv"), F.count(F.lit(1)).alias("copies"))
    prefixes = (turns.select("conv", "pos", "h1", "h2")
                .join(whole.select(F.col("conv").alias("c"), F.col("pos").alias("n")),
                      F.col("conv").eqNullSafe(F.col("c")))
                .filter(F.col("pos") < F.col("n")).select("pos", "h1", "h2").distinct())
    return (distinct.join(prefixes, ["pos", "h1", "h2"], "left_anti")
            .select("conv", F.col("pos").alias("n_turns"), "copies"))


def render_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", block: int = BLOCK) -> DataFrame:
    """Maximal conversations as text: conv, part, n_turns, copies, rendered.

    A turn becomes ``<|role|>`` + newline + text + newline.  A conversation has one part
    per ``block`` turns (nearly always one), numbered from 0, so no row grows without
    bound; ``copies`` counts the logs with exactly these turns.  See ``number_turns`` for
    nulls, repeated rows and order; other columns are not read, an empty table gives an
    empty result.
    """
    turns = keep_table(number_turns(df, conv, turn, role, text, block), "turns")
    stay = collapse(turns)
    said = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n"))
    parts = (turns.join(stay.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c")))
             .withColumn("part", F.floor((F.col("pos") - 1) / block).cast("int"))
             .groupBy("conv", "part", "n_turns", "copies")
             .agg(F.array_sort(F.collect_list(F.struct("pos", said.alias("said")))).alias("all")))
    return parts.select(F.col("conv").alias(conv), "part", "n_turns", "copies",
                        F.array_join("all.said", "").alias("rendered"))
