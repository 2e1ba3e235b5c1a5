"""Suffix-array dedup: bytes covered by a string of 50 that starts in an earlier document go.

The corpus is cut into shards of whole documents.  Every window of ``WIDTH`` bytes has a key,
the least hash of the short grams inside, so equal windows have equal keys wherever they
stand.  A first exchange of distinct keys finds those that more than one document has; only
windows with such a key go on, as the few bytes of the runs that share a key, once per shard
and with the least document that has them.  Whoever owns a key builds suffix arrays of these
pieces (``suffix_arrays``), finds equal windows by their common prefixes, merges its arrays
by binary search and answers with one bit per window: does an earlier document have it?
Documents never meet in one task, and a passage that all documents share costs one piece per
shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from comarca.llm.common import keep_table, rows_from
from comarca.llm.shingles import _BYTE, _powers, mix
from comarca.llm.suffix_arrays import distinct_strings, merge

WIDTH, GRAM = 50, 16
#: Windows in a piece at most, so a piece has no more than RUN + WIDTH - 1 bytes.
RUN = WIDTH - GRAM + 1
#: Bytes of text in a shard (a longer document is a shard of its own), bytes of text per owner
#: of keys, and bytes of pieces in one suffix array.
SHARD_BYTES, OWNER_BYTES, ARRAY_BYTES = 2 << 20, 4 << 20, 1 << 20
LAST = np.iinfo(np.int64).max
# numbers of a byte, in the keys of windows and in the second name of a piece
_GRAM_BYTE = _BYTE + np.arange(256, dtype=np.uint64)
_SECOND_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(77))


def pack_bytes(data: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(data).tobytes())


def unpack_bytes(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


class Shard:
    """Documents of a shard with the runs of windows that share a key."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, docs: np.ndarray):
        self.data, self.docs = data, docs
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        valid = np.zeros(len(data) + 1, np.int32)
        long_ = sizes >= WIDTH
        np.add.at(valid, self.starts[long_], 1)
        np.add.at(valid, self.ends[long_] - WIDTH + 1, -1)
        at = np.flatnonzero(np.cumsum(valid) > 0)
        key = window_keys(data)[at] if len(at) else np.empty(0, np.uint64)
        head = np.ones(len(at), bool)
        head[1:] = (key[1:] != key[:-1]) | (np.diff(at) != 1)
        first = np.flatnonzero(head)
        parts = -(-np.diff(np.append(first, len(at))) // RUN)  # a long run is cut
        first = np.repeat(first, parts) + RUN * spread(np.zeros_like(parts), parts)
        self.at, self.key = at[first], key[first]  # of each run: first window, key
        self.windows = np.diff(np.append(first, len(at)))
        self.doc = np.searchsorted(self.ends, self.at, side="right")
        self.keys, self.key_number = np.unique(self.key, return_inverse=True)

    def keys_by_owner(self, owners: int) -> list[tuple[int, np.ndarray]]:
        """For each owner the numbers of its keys, in order."""
        owner = self.keys % np.uint64(owners)
        order = np.argsort(owner, kind="stable")
        cuts = np.flatnonzero(np.diff(owner[order])) + 1
        return [(int(owner[p[0]]), p) for p in np.split(order, cuts)] if len(order) else []

    def in_two_documents(self) -> np.ndarray:
        """For each key whether two documents of the shard have it."""
        low = np.full(len(self.keys), LAST)
        high = np.full(len(self.keys), -1)
        np.minimum.at(low, self.key_number, self.doc)
        np.maximum.at(high, self.key_number, self.doc)
        return low != high

    def pieces(self, shared: np.ndarray, owners: int) -> "Pieces":
        """The distinct pieces of the runs whose keys are shared."""
        return Pieces(self, np.flatnonzero(shared[self.key_number]), owners)


class Pieces:
    def __init__(self, shard: Shard, runs: np.ndarray, owners: int):
        self.shard, self.runs = shard, runs
        self.sizes = shard.windows[runs] + WIDTH - 1
        self.owner = (shard.key[runs] % np.uint64(owners)).astype(np.int64)
        n = len(shard.data)
        up, down = _powers(n + 1)
        name = []
        for number in (_BYTE, _SECOND_BYTE):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(number[shard.data] * up[:-1], out=total[1:])
            a = shard.at[runs]
            name.append(mix((total[a + self.sizes] - total[a]) * down[a] + self.sizes.astype(np.uint64)))
        order = np.lexsort((name[1], name[0], self.owner))
        head = np.ones(len(order), bool)
        for x in (*name, self.owner):
            if len(order):
                head[1:] &= x[order[1:]] == x[order[:-1]]
        if len(order):
            head[1:] = ~head[1:]
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(head) - 1
        self.first = runs[order[head]]  # a run that has each piece
        self.piece_owner = self.owner[order[head]]
        self.piece_windows = shard.windows[self.first]
        self.least = np.full(len(self.first), LAST)
        np.minimum.at(self.least, self.number, shard.docs[shard.doc[runs]])

    def by_owner(self) -> list[tuple[int, np.ndarray]]:
        cuts = np.flatnonzero(np.diff(self.piece_owner)) + 1
        every = np.arange(len(self.first))
        return [(int(self.piece_owner[p[0]]), p) for p in np.split(every, cuts)] if len(every) else []

    def text(self, pieces: np.ndarray) -> np.ndarray:
        sizes = self.piece_windows[pieces] + WIDTH - 1
        return self.shard.data[spread(self.shard.at[self.first[pieces]], sizes)]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of all ranges, one after another."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def window_keys(data: np.ndarray) -> np.ndarray:
    """Per window of WIDTH bytes the least hash (48 bits) of its grams."""
    n = len(data)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_GRAM_BYTE[data] * up[:-1], out=total[1:])
    least = mix((total[GRAM:] - total[:-GRAM]) * down[:n - GRAM + 1]) >> np.uint64(16)
    held = 1
    while held < RUN:
        step = min(held, RUN - held)
        least = np.minimum(least[:-step], least[step:])
        held += step
    return least


def make_shards(df: DataFrame, key: str, text: str, shard_bytes: int) -> DataFrame:
    """(shard, docs, rows, sizes, data): documents and their UTF-8 bytes, compressed.

    A null key is after all others.  The key is kept as it is in ``keys``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first in rows_from(batches):
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            keys = batch.column(0).to_pylist()
            begin = held = 0
            for k, t in enumerate(texts):
                held += len(t)
                if held >= shard_bytes or k == len(texts) - 1:
                    part = texts[begin:k + 1]
                    data = np.frombuffer(b"".join(part), np.uint8)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([first + begin]), pa.array([keys[begin:k + 1]], pa.list_(pa.int64())),
                         pa.array([[len(x) for x in part]], pa.list_(pa.int64())),
                         pa.array([pack_bytes(data)], pa.binary()), pa.array([len(data)], pa.int64())],
                        ["shard", "keys", "sizes", "data", "bytes"])
                    begin, held = k + 1, 0

    return df.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("binary").alias("text")) \
        .mapInArrow(run, "shard long, keys array<long>, sizes array<long>, data binary, bytes long")


def open_shard(keys: list, sizes: list, data: bytes) -> Shard:
    docs = np.array([LAST if k is None else k for k in keys], np.int64)
    return Shard(unpack_bytes(data, np.uint8), np.array(sizes, np.int64), docs)


def sent_keys(shards: DataFrame, owners: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = open_shard(row["keys"], row["sizes"], row["data"])
                twice = shard.in_two_documents()
                parts = shard.keys_by_owner(owners)
                keys = [shard.keys[p] for _, p in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o for o, _ in parts], pa.int64()), pa.array([row["shard"]] * len(parts), pa.int64()),
                     pa.array([(k >> np.uint64(16)).astype("<u4").tobytes() for k in keys], pa.binary()),
                     pa.array([(k & np.uint64(0xFFFF)).astype("<u2").tobytes() for k in keys], pa.binary()),
                     pa.array([np.packbits(twice[p]).tobytes() for _, p in parts], pa.binary())],
                    ["owner", "shard", "high", "low", "twice"])

    return shards.select("shard", "keys", "sizes", "data").mapInArrow(
        run, "owner long, shard long, high binary, low binary, twice binary")


def shared_keys(part: pa.Table) -> pa.Table:
    """For each shard one bit per key it sent: do two documents have it?"""
    rows = part.to_pylist()
    keys = [np.frombuffer(r["high"], "<u4").astype(np.uint64) << np.uint64(16)
            | np.frombuffer(r["low"], "<u2") for r in rows]
    sizes = [len(k) for k in keys]
    twice = [np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=n).astype(bool)
             for r, n in zip(rows, sizes, strict=True)]
    _, number, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    shared = (count > 1)[number] | np.concatenate(twice)
    bits = [np.packbits(x).tobytes() for x in np.split(shared, np.cumsum(sizes)[:-1])]
    return pa.table({"shard": part["shard"], "owner": part["owner"], "kind": pa.array([0] * len(rows), pa.int32()),
                     "bits": pa.array(bits, pa.binary())})


def shared_of(shard: Shard, answers: dict[int, bytes], owners: int) -> np.ndarray:
    shared = np.zeros(len(shard.keys), bool)
    for owner, numbers in shard.keys_by_owner(owners):
        shared[numbers] = np.unpackbits(np.frombuffer(answers[owner], np.uint8), count=len(numbers))
    return shared


def answers_of(table: pa.Table, kind: int) -> dict[int, bytes]:
    return {r["owner"]: r["bits"] for r in table.to_pylist() if r["kind"] == kind}


def pieces_of(left: pa.Table, right: pa.Table, owners: int) -> Pieces:
    row = left.to_pylist()[0]
    shard = open_shard(row["keys"], row["sizes"], row["data"])
    return shard.pieces(shared_of(shard, answers_of(right, 0), owners), owners)


def sent_pieces(owners: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pieces = pieces_of(left, right, owners)
        parts = pieces.by_owner()
        return pa.table({
            "owner": pa.array([o for o, _ in parts], pa.int64()),
            "shard": pa.array([left["shard"][0].as_py()] * len(parts), pa.int64()),
            "windows": pa.array([pieces.piece_windows[p].astype(np.uint8).tobytes() for _, p in parts], pa.binary()),
            "least": pa.array([pack_bytes(pieces.least[p]) for _, p in parts], pa.binary()),
            "data": pa.array([pack_bytes(pieces.text(p)) for _, p in parts], pa.binary())})
    return run


def distinct_pieces(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal pieces, laid one after another, the first; and for every piece the number of its text."""
    held, ends = data.tobytes(), np.cumsum(sizes).tolist()
    numbers: dict[bytes, int] = {}
    first, number = [], np.empty(len(ends), np.int64)
    for i, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
        number[i] = n = numbers.setdefault(held[a:b], len(first))
        if n == len(first):
            first.append(i)
    return np.array(first, np.int64), number


def earlier_windows(array_bytes: int):
    def run(part: pa.Table) -> pa.Table:
        """For each shard one bit per window it sent: does a document before its least one have it?"""
        rows = part.to_pylist()
        windows = [np.frombuffer(r["windows"], np.uint8).astype(np.int64) for r in rows]
        least = [unpack_bytes(r["least"], np.int64) for r in rows]
        data = np.concatenate([unpack_bytes(r["data"], np.uint8) for r in rows])
        sent_windows, sent_least = np.concatenate(windows), np.concatenate(least)
        # shards send the same pieces: each text is sorted once, with the least document of all
        sizes = sent_windows + WIDTH - 1
        kept, piece = distinct_pieces(data, sizes)
        data = data[spread((np.cumsum(sizes) - sizes)[kept], sizes[kept])]
        all_windows, sizes = sent_windows[kept], sizes[kept]
        all_least = np.full(len(kept), LAST)
        np.minimum.at(all_least, piece, sent_least)
        ends = np.cumsum(sizes)
        # suffix arrays of a bounded number of bytes, cut between pieces
        array = (ends - 1) // array_bytes
        cuts = np.flatnonzero(np.diff(array)) + 1
        texts = first = None
        found = []
        for a, b in zip([0, *cuts], [*cuts, len(ends)], strict=True):
            begin = ends[a] - sizes[a]
            held = data[begin:ends[b - 1]]
            room = np.repeat(ends[a:b] - begin, sizes[a:b]) - np.arange(len(held))
            starts = spread(ends[a:b] - sizes[a:b] - begin, all_windows[a:b])
            own, value, number = distinct_strings(held, starts, room, np.repeat(all_least[a:b], all_windows[a:b]), WIDTH)
            found.append((own, number))
            texts, first = (own, value) if texts is None else merge(texts, first, own, value)
        earliest = np.concatenate([first[np.searchsorted(texts, own)][number] for own, number in found])
        at = np.cumsum(all_windows) - all_windows
        earlier = earliest[spread(at[piece], sent_windows)] < np.repeat(sent_least, sent_windows)
        per_row = np.cumsum([w.sum() for w in windows])[:-1]
        bits = [np.packbits(x).tobytes() for x in np.split(earlier, per_row)]
        return pa.table({"shard": part["shard"], "owner": part["owner"], "kind": pa.array([1] * len(rows), pa.int32()),
                         "bits": pa.array(bits, pa.binary())})
    return run


def whole_runs(data: np.ndarray, cut: np.ndarray) -> list[dict]:
    """Runs (start from 1, length) of the bytes that are not cut, without characters that lost one."""
    head = (data & 0xC0) != 0x80
    character = np.cumsum(head)
    hurt = np.zeros(len(data) + 1, bool)
    hurt[character[cut]] = True
    edge = np.flatnonzero(np.diff(~hurt[character], prepend=False, append=False))
    return [{"start": a + 1, "length": b - a} for a, b in edge.reshape(-1, 2).tolist()]


def cleaned(owners: int, with_runs: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pieces = pieces_of(left, right, owners)
        shard, answers = pieces.shard, answers_of(right, 1)
        earlier = np.zeros(int(pieces.piece_windows.sum()), bool)
        at = np.cumsum(pieces.piece_windows) - pieces.piece_windows
        for owner, numbers in pieces.by_owner():
            begin = at[numbers[0]]
            n = int(pieces.piece_windows[numbers].sum())
            earlier[begin:begin + n] = np.unpackbits(np.frombuffer(answers[owner], np.uint8), count=n)
        windows = shard.windows[pieces.runs]
        gone = earlier[spread(at[pieces.number], windows)]
        later = shard.docs[shard.doc[pieces.runs]] > pieces.least[pieces.number]
        gone |= np.repeat(later, windows)
        starts = spread(shard.at[pieces.runs], windows)[gone]
        cover = np.zeros(len(shard.data) + 1, np.int32)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + WIDTH, -1)
        removed = np.cumsum(cover[:-1]) > 0
        count, spans, sha, original, runs = [], [], [], [], []
        for a, b in zip(shard.starts.tolist(), shard.ends.tolist(), strict=True):
            cut, data = removed[a:b], shard.data[a:b]
            count.append(int(cut.sum()))
            spans.append(int(np.count_nonzero(np.diff(cut, prepend=False).astype(bool) & cut)))
            kept = data[~cut].tobytes() if count[-1] else data.tobytes()
            sha.append(hashlib.sha256(kept).hexdigest())
            if with_runs:
                original.append(hashlib.sha256(data.tobytes()).hexdigest() if count[-1] else None)
                runs.append(whole_runs(data, cut) if count[-1] else None)
        out = {"key": pa.array(left["keys"][0].as_py(), pa.int64()),
               "n_bytes": pa.array(shard.ends - shard.starts, pa.int64()),
               "n_removed": pa.array(count, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
               "kept_sha256": pa.array(sha, pa.string())}
        if with_runs:
            out |= {"original_sha256": pa.array(original, pa.string()),
                    "kept_runs": pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))}
        return pa.table(out)
    return run


def repeated_bytes(df: DataFrame, key: str = "doc_id", text: str = "text", with_runs: bool = False,
                   shard_bytes: int = SHARD_BYTES, owner_bytes: int = OWNER_BYTES,
                   array_bytes: int = ARRAY_BYTES) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, kept_sha256 (and with ``with_runs``, for rows that lose
    bytes, the digest of the original and the runs of bytes that stay, without characters that
    lost one).

    Null and empty texts, and texts under ``WIDTH`` bytes, lose nothing.  Rows that repeat a key
    are one document's: neither is earlier, so they lose nothing to each other.  Rows with a null
    key come after all others.  Keys are whole numbers.  Other columns are not read; an empty
    table gives an empty result.
    """
    shards = keep_table(make_shards(df, key, text, shard_bytes), "shards")
    total = shards.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    owners = max(8, total // owner_bytes)
    answer = "shard long, owner long, kind int, bits binary"
    known = keep_table(sent_keys(shards, owners).groupBy("owner").applyInArrow(shared_keys, answer), "known")
    each = shards.select("shard", "keys", "sizes", "data").groupBy("shard")
    pieces = each.cogroup(known.groupBy("shard")).applyInArrow(
        sent_pieces(owners), "owner long, shard long, windows binary, least binary, data binary")
    earlier = keep_table(pieces.groupBy("owner").applyInArrow(earlier_windows(array_bytes), answer), "earlier")
    out = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_runs:
        out += ", original_sha256 string, kept_runs array<struct<start: int, length: int>>"
    done = each.cogroup(known.unionByName(earlier).groupBy("shard")).applyInArrow(cleaned(owners, with_runs), out)
    kind = df.select(f"`{key}`").schema[0].dataType
    return done.select(F.col("key").cast(kind).alias(key), *[c for c in done.columns if c != "key"])


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """``df`` with the repeated bytes taken out of ``text`` (and its ``length`` column, if there is
    one, set anew).  Every row stays; a text that is nothing but repeats becomes empty, a null
    text stays null."""
    done = keep_table(repeated_bytes(df, key, text, True).filter("n_removed > 0")
                      .select(F.col(key).alias("_key"), F.col("original_sha256").alias("_sha"),
                              F.col("kept_runs").alias("_runs")), "kept").dropDuplicates(["_key", "_sha"])
    source = F.col(f"`{text}`").cast("binary")
    same = F.col(f"`{key}`").eqNullSafe(F.col("_key")) & (F.sha2(source, 256) == F.col("_sha"))
    # the text is bound once, however many runs are taken from it
    kept = F.transform(F.array(source), lambda held: F.array_join(F.transform(
        "_runs", lambda run: F.substring(held, run["start"], run["length"]).cast("string")), ""))[0]
    out = df.join(done, same, "left")
    changes = {text: F.when(F.col("_sha").isNull(), F.col(f"`{text}`")).otherwise(kept)}
    if length in df.columns:
        changes[length] = F.when(F.col("_sha").isNull(), F.col(f"`{length}`")).otherwise(
            F.char_length(kept).cast(df.schema[length].dataType))
    return out.select(*[changes[c].alias(c) if c in changes else F.col(f"`{c}`") for c in df.columns])
