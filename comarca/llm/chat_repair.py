"""Conversation structure repair: the cheapest edits that make the roles of a log well-formed.

Spark finds the faults of every row (blank, duplicate, truncated) and puts the rows of a
conversation in order; a task then reads its rows one by one and keeps, for each state of the
role grammar, the cheapest edits so far.  Edit strings are not copied: they are paths of linked
nodes that share their prefixes.  A node has ancestors at distances 1, 2, 4, ... and a rolling
hash of the whole path, so a tie between two paths is settled by a binary search for their
longest common prefix; where the search ends at different nodes of equal hash the letters are
compared, so that a collision cannot decide.  Edits that all states share are final: they are
taken from the paths and applied at once, so a task holds the open end of one conversation only.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from comarca.llm.common import WHITE_SPACE, keep_table

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Grammar ``(s?(ua)+)?``: nothing yet, after s, after u, after a; the first and the last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Per state what a user or assistant turn leads to.
NEXT = (USER, USER, ASSISTANT, USER)
#: Nodes, or characters of rows not yet decided, after which what is decided is taken from the paths.
OPEN, HELD = 4096, 1 << 24
MODULUS, BASE = (1 << 61) - 1, 0x9E3779B97F4A7C15 % ((1 << 61) - 1)


class Paths:
    """Strings of edits as linked nodes; node 0 is the empty string."""

    def __init__(self) -> None:
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [[]]

    def add(self, node: int, letter: str) -> int:
        """The path of ``node`` with one more letter."""
        ups, far = [node], node
        # the ancestor at distance 2^j is the one at 2^(j-1) from that at 2^(j-1)
        while len(self.up[far]) >= len(ups):
            far = self.up[far][len(ups) - 1]
            ups.append(far)
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * BASE + ord(letter)) % MODULUS)
        self.up.append(ups)
        return len(self.letter) - 1

    def lift(self, node: int, depth: int) -> int:
        """The ancestor of ``node`` at ``depth``."""
        rest = self.depth[node] - depth
        while rest:
            far = rest.bit_length() - 1
            node = self.up[node][far]
            rest -= 1 << far
        return node

    def common(self, a: int, b: int) -> tuple[int, int]:
        """The ancestors of a and b at their first difference, or at the length of the shorter."""
        least = min(self.depth[a], self.depth[b])
        a, b = self.lift(a, least), self.lift(b, least)
        if self.hash[a] != self.hash[b]:
            for j in reversed(range(len(self.up[a]))):
                if j < len(self.up[a]):
                    x, y = self.up[a][j], self.up[b][j]
                    if self.hash[x] != self.hash[y]:
                        a, b = x, y
            x, y = self.up[a][0], self.up[b][0]
        else:
            x, y = a, b
        while x != y:  # equal hashes of different nodes: the letters decide
            if self.letter[x] != self.letter[y]:
                a, b = x, y
            x, y = self.up[x][0], self.up[y][0]
        return a, b

    def less(self, a: int, b: int) -> bool:
        x, y = self.common(a, b)
        if self.letter[x] != self.letter[y]:
            return self.letter[x] < self.letter[y]
        return self.depth[a] < self.depth[b]

    def shared(self, nodes: list[int]) -> int:
        """The last node that all paths have in common."""
        least = min(self.depth[n] for n in nodes)
        at = {self.lift(n, least) for n in nodes}
        while len(at) > 1:
            some = next(iter(at))
            for j in reversed(range(len(self.up[some]))):
                higher = {self.up[n][j] for n in at if j < len(self.up[n])}
                if len(higher) > 1:
                    at = higher
                    break
            else:
                at = {self.up[n][0] for n in at}
        return at.pop()

    def spelled(self, node: int) -> str:
        out = []
        while self.depth[node]:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))


class Repair:
    """One conversation: rows go in by ``feed``, ``finish`` tells the repair."""

    def __init__(self, open_nodes: int = OPEN, held: int = HELD) -> None:
        self.paths, self.open_nodes = Paths(), open_nodes
        self.held, self.most_held = 0, held
        self.best: list[tuple[int, int] | None] = self._with_inserts([(0, 0), None, None, None])
        self.waiting: deque[tuple[str, str]] = deque()
        self.audit: list[str] = []
        self.done, self.state, self.empty = hashlib.sha256(), START, True

    def _better(self, a: tuple[int, int] | None, b: tuple[int, int] | None) -> tuple[int, int] | None:
        if a is None or b is None:
            return a or b
        if a[0] != b[0]:
            return min(a, b)
        return a if a[1] == b[1] or self.paths.less(a[1], b[1]) else b

    def _step(self, entry: tuple[int, int], cost: int, letter: str) -> tuple[int, int]:
        return entry[0] + cost, self.paths.add(entry[1], letter)

    def _cheapest(self, entries: list[tuple[tuple[int, int] | None, int, str]]) -> tuple[int, int] | None:
        """Of several steps into one state the best; only those of the least cost become nodes."""
        least = min((e[0] + cost for e, cost, _ in entries if e is not None), default=None)
        out = None
        for e, cost, letter in entries:
            if e is not None and e[0] + cost == least:
                out = self._better(out, self._step(e, cost, letter) if letter else e)
        return out

    def _with_inserts(self, best: list) -> list:
        start, system, user, assistant = best
        user = self._cheapest([(user, 0, ""), (start, INSERT, "I"), (system, INSERT, "I"), (assistant, INSERT, "I")])
        return [start, system, user, self._cheapest([(assistant, 0, ""), (user, INSERT, "I")])]

    def _without_hopeless(self, best: list) -> list:
        """Drop states whose every end costs more than some end of the one after an assistant: what
        SYSTEM can do, it can, and what START can, for one deletion (of an s) more."""
        def keep(entry: tuple[int, int] | None, more: int) -> tuple[int, int] | None:
            return None if entry is None or best[ASSISTANT] and entry[0] > best[ASSISTANT][0] + more else entry

        return [keep(best[START], DELETE), keep(best[SYSTEM], 0), best[USER], best[ASSISTANT]]

    def feed(self, role: str, text: str, lost: bool, truncated: bool) -> None:
        """A row; ``lost`` rows (blank or duplicate) have to go."""
        self.waiting.append((role, text))
        self.held += len(text)
        best, moves = self.best, [[(e, DELETE, "D")] for e in self.best]
        if not lost:
            extra, initial = TRUNCATED if truncated else 0, role[:1]
            if initial == "s":
                moves[SYSTEM].append((best[START], extra, "K"))
            for state, target in enumerate(NEXT):
                if initial == ("a" if target == ASSISTANT else "u"):
                    moves[target].append((best[state], extra, "K"))
                moves[target].append((best[state], extra + REROLE, "R"))
        self.best = self._without_hopeless(self._with_inserts([self._cheapest(m) for m in moves]))
        if len(self.paths.letter) > self.open_nodes or self.held > self.most_held:
            self._settle(self.paths.shared([e[1] for e in self.best if e]))

    def _settle(self, trunk: int) -> None:
        """Apply the edits up to ``trunk`` and start new paths there."""
        old, self.paths = self.paths, Paths()
        self._apply(old.spelled(trunk))
        named = {trunk: 0}

        def move(node: int) -> int:
            above = []
            while node not in named:
                above.append(node)
                node = old.up[node][0]
            for n in reversed(above):
                named[n] = self.paths.add(named[old.up[n][0]], old.letter[n])
            return named[above[0]] if above else named[node]

        self.best = [e and (e[0], move(e[1])) for e in self.best]
        self.held = sum(len(text) for _, text in self.waiting)
        # what stays open is looked at again only after it has doubled
        self.open_nodes = max(self.open_nodes, 2 * len(self.paths.letter))
        self.most_held = max(self.most_held, 2 * self.held)

    def _apply(self, letters: str) -> None:
        self.audit.append(letters)
        for letter in letters:
            role, text = self.waiting.popleft() if letter != "I" else ("", "")
            if letter == "D":
                continue
            if letter == "K" and role[:1] == "s":
                self.state = SYSTEM
            else:
                self.state = NEXT[self.state]
                if letter != "K":
                    role = "assistant" if self.state == ASSISTANT else "user"
            self.done.update(f"{'' if self.empty else chr(10)}{role}:{'' if letter == 'I' else text}".encode())
            self.empty = False

    def finish(self) -> tuple[int, str, str]:
        """Cost, audit and the digest of the repaired conversation."""
        cost, node = self._better(self.best[START], self.best[ASSISTANT])
        self._apply(self.paths.spelled(node))
        return cost, "".join(self.audit), self.done.hexdigest()


class Log:
    """Counts and repair of one conversation."""

    def __init__(self) -> None:
        self.repair, self.last = Repair(), None
        self.turns, self.span = 0, None
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

    def feed(self, turn: int | None, role: str, text: str, blank: bool, first: bool, truncated: bool) -> None:
        if turn is not None and (self.span is None or turn != self.span[1]):
            self.turns += 1
            self.span = (turn if self.span is None else self.span[0], turn)
        # copies stand next to each other: only the first of them may be the first of its kind
        again = not first or (self.last is not None and self.last[:3] == (turn, role, text))
        if self.last is not None and self.last[1][:1] + role[:1] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        fault = "blank" if blank else "duplicate" if again else "truncated" if truncated else ""
        if fault:
            self.counts[fault] += 1
        self.repair.feed(role, text, fault in ("blank", "duplicate"), fault == "truncated")
        self.last = (turn, role, text)

    def finish(self) -> tuple:
        cost, audit, digest = self.repair.finish()
        gaps = self.span[1] - self.span[0] + 1 - self.turns if self.span else 0
        return gaps, *self.counts.values(), cost, audit, digest


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, here) with faults put in by crc32(``conv:turn``) % 20.

    0 drops the row (here = false), 1 empties its text, 2 removes ``[.!?]`` from it, 3 repeats
    the row, 4 sets the role user.  Null roles and texts are one space, as are a null
    conversation or turn in the string that is hashed.
    """
    def word(name: str):
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    code = F.crc32(F.concat(word(conv), F.lit(":"), word(turn)).cast("binary")) % 20
    rows = df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                     F.when(code == 4, "user").otherwise(word(role)).alias("role"),
                     F.when(code == 1, "").when(code == 2, F.regexp_replace(word(text), "[.!?]", ""))
                     .otherwise(word(text)).alias("text"), code.alias("code"))
    return rows.select("conv", "turn", "role", "text", (F.col("code") != 0).alias("here"),
                       F.explode(F.sequence(F.lit(1), F.when(F.col("code") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows with blank, truncated (last character that is no white space not ``[.!?]``) and first:
    no row of the conversation with the same role and text has an earlier turn.

    The least turn per (conversation, role, text) is an aggregation, joined on the turn as well,
    so that a text that fills a conversation is no hot key.
    """
    null_turn = F.col("turn").isNull()
    name = F.col("conv").cast("string")
    kind = F.sha2(F.concat(F.coalesce(F.concat(F.char_length(name).cast("string"), F.lit(":"), name), F.lit("")),
                           F.lit("|"), F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = rows.withColumn("kind", F.unhex(kind))
    first = (rows.filter("here").groupBy("kind").agg(F.min("turn").alias("turn"), F.max(null_turn).alias("none"))
             .select(F.col("kind").alias("k"), F.when(~F.col("none"), F.col("turn")).alias("t"),
                     F.lit(True).alias("first")))
    last = F.right(F.rtrim(F.col("text"), F.lit(WHITE_SPACE)), F.lit(1))
    return (rows.join(first, (F.col("kind") == F.col("k")) & F.col("turn").eqNullSafe(F.col("t")), "left")
            .select("conv", "turn", "role", "text", "here", (last == "").alias("blank"),
                    F.coalesce("first", F.lit(False)).alias("first"), (~last.isin(".", "!", "?")).alias("truncated")))


def repair(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` has conv, turn, role, text and here (false: a row that only tells that the
    conversation exists).  Order within a conversation: turn (null first), role, text; a
    repeated row is a duplicate.  Rows with a null conversation form one conversation; one
    without any row here has zeros, an empty audit and the digest of nothing; an empty table
    gives an empty result.  Roles are told by their first letter: another than s, u or a
    cannot be kept.

    A digest and an audit are one value per conversation, which the rows must reach in order:
    so a conversation is read by one task, as a stream; it holds the audit and the rows that
    are not decided yet, never the conversation.
    """
    kind = rows.schema["conv"].dataType
    whole = (with_faults(rows).repartition("conv")
             .sortWithinPartitions(F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "text"))
    names = ["turn", "role", "text", "blank", "first", "truncated"]
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log, at, out, ready = None, None, None, []
        for batch in batches:
            out = batch.schema.field("conv").type
            columns = [batch[c].to_pylist() for c in ("conv", "here", *names)]
            for name, here, *row in zip(*columns, strict=True):
                if log is None or name != at:
                    if log is not None:
                        ready.append((at, *log.finish()))
                    log, at = Log(), name
                if here:
                    log.feed(*row)
            if ready:
                yield table(ready, out)
                ready = []
        if log is not None:
            yield table([(at, *log.finish())], out)

    def table(found: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        types = [key, *[pa.int64()] * len(counts), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types, strict=True)],
                                          ["conv", *counts, "audit", "repaired_sha256"])

    schema = f"conv {kind.simpleString()}, " + "".join(f"{c} long, " for c in counts) + \
        "audit string, repaired_sha256 string"
    return whole.mapInArrow(run, schema).withColumnRenamed("conv", conv)


def repair_damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """The repair of the conversations of ``df`` after ``damaged``."""
    return repair(keep_table(damaged(df, conv, turn, role, text), "damaged"), conv)
