"""Packing by lexical retrieval.

Documents become token ids.  Every full window of a document is a sequence of its own; what
is left of each document, shorter than a window, is packed with lexically close others.
A bounded sample gives the main directions of its weighted ids and a tree of cuts along them;
every remainder falls into a leaf of that tree, neighbouring leaves make a shard, and a leaf too
large for one shard is dealt over several.  A shard has an inverted BM25 index (the document frequencies come from the whole corpus); a
seed document fetches its unused neighbours in score order, and they greedily fill its window.  The last one is cut where the
window ends and its rest is the next seed.  What is left at the end of a shard is cut into
powers of two, which need no padding.
"""

from __future__ import annotations

import pickle
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from comarca.llm.common import keep_table, rows_from

WINDOW = 2048
#: Remainders in a shard, on average.
SHARD_DOCUMENTS = 1024
END_OF_TEXT = 1
#: Documents from which directions and cuts are taken (all others only follow them), how many
#: of these give the directions, characters read of each, directions, levels of cuts.
SAMPLE, FITTED, SAMPLED_TEXT = 4096, 1024, 8192
DIRECTIONS, LEVELS = 8, 9
#: Documents tokenized together.
BATCH = 2000
K1, B = 1.2, 0.75
#: Encoded chunks and words remembered between batches of a task, and the longest of them.
REMEMBERED, LONGEST = 700_000, 64
#: Characters for which a text may be split into words before the tokenizer sees
#: them (no white space, case or composition rules beyond Latin letters).
PLAIN = re.compile("[\\t\\n\\r -~\\xa1-\\xac\\xae-\\u012f\\u0131-\\u024f]*")
#: The word rule of the vocabulary, for plain texts in lower case.
WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[^\\W\\d_²³¹¼½¾]+|[\\d²³¹¼½¾]|(?:[^\\w\\s]|_)+")


class Chunks(dict):
    """Ids (16 bits each) of chunks between white space, found when first asked for: those of
    their words, of which only new ones go to the vocabulary's model (as byte symbols, which is
    all that its other steps make of a plain word)."""

    def __init__(self, model):
        super().__init__()
        self.tokenize = model.tokenize

    def __missing__(self, chunk: str) -> bytes:
        words = [chunk] if chunk.isalpha() else WORD.findall(chunk)
        if len(words) > 1:
            ids = b"".join([self[w] for w in words])
        else:
            symbols = chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(SYMBOLS)
            ids = array("H", [t.id for t in self.tokenize(symbols)]).tobytes()
        if len(self) < REMEMBERED and len(chunk) <= LONGEST:
            self[chunk] = ids
        return ids


class WordTokenizer:
    """Ids (16 bits each) of texts.  No word of this vocabulary spans white space, so each chunk
    between white space is encoded once and remembered; a text that is not plain goes to the
    tokenizer as a whole."""

    def __init__(self, json: str):
        self.tokenizer = Tokenizer.from_str(json)
        self.size = self.tokenizer.get_vocab_size()
        if self.size > 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        self.known = Chunks(self.tokenizer.model)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes()
                for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [("<|" not in t) and PLAIN.fullmatch(t) is not None for t in texts]
        rest = iter(self._library([t for t, p in zip(texts, plain, strict=True) if not p]))
        ids = self.known.__getitem__
        return [b"".join(map(ids, t.lower().split())) if p else next(rest)
                for t, p in zip(texts, plain, strict=True)]


def byte_symbols() -> dict[int, str]:
    """The visible character that stands for each byte: itself if it is one, else the next one
    from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + n) for n, b in enumerate(hidden)}


SYMBOLS = byte_symbols()
_tokenizers: dict[int, WordTokenizer] = {}


def tokenizer_of(json: str, mark: int) -> WordTokenizer:
    """The tokenizer that this process keeps between tasks."""
    if mark not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[mark] = WordTokenizer(json)
    return _tokenizers[mark]


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class Leaves:
    """A tree of cuts along the main directions of the sample's weighted ids."""

    def __init__(self, sample: list[np.ndarray]):
        """``sample``: the distinct ids of each document."""
        self.weights = np.zeros((1 << 16, DIRECTIONS), np.float32)
        self.axis, self.cut = np.zeros(1 << LEVELS, np.int64), np.zeros(1 << LEVELS)
        fitted = sample[:FITTED]
        if not fitted:
            return
        frequency = np.bincount(np.concatenate(fitted), minlength=1 << 16)
        used = np.flatnonzero((frequency > 2) & (frequency < len(fitted)))
        idf = np.log1p((len(fitted) - frequency[used] + 0.5) / (frequency[used] + 0.5)).astype(np.float32)
        held = np.zeros((len(fitted), 1 << 16), bool)
        for row, ids in zip(held, fitted, strict=True):
            row[ids] = True
        x = held[:, used] * idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        x -= x.mean(axis=0)
        ways = x.T @ np.linalg.eigh(x @ x.T)[1][:, ::-1][:, :DIRECTIONS]
        ways /= np.maximum(np.linalg.norm(ways, axis=0), 1e-9)
        self.weights[used, :ways.shape[1]] = ways * idf[:, None]
        points = np.array([self.point(ids) for ids in sample])
        self._grow(points, 1)

    def _grow(self, points: np.ndarray, node: int) -> None:
        if node >= len(self.axis) or len(points) < 2:
            return
        axis = self.axis[node] = points.var(axis=0).argmax()
        self.cut[node] = np.median(points[:, axis])
        over = points[:, axis] > self.cut[node]
        self._grow(points[~over], 2 * node)
        self._grow(points[over], 2 * node + 1)

    def point(self, ids: np.ndarray) -> np.ndarray:
        return self.weights[ids].sum(axis=0) / np.sqrt(len(ids))

    def of(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point; leaves with near numbers are near."""
        node = np.ones(len(points), np.int64)
        for _ in range(LEVELS):
            node = 2 * node + (points[np.arange(len(points)), self.axis[node]] > self.cut[node])
        return node - (1 << LEVELS)


def fit_leaves(df: DataFrame, key: str, text: str, vocabulary: Broadcast, mark: int) -> bytes:
    """Pickled ``Leaves`` from the ``SAMPLE`` rows with the least hashes, in the order of the table.

    One task holds the sample, which ``SAMPLE`` and ``SAMPLED_TEXT`` bound; the driver gets what was fitted.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t or "" for batch in batches for t in batch.column(0).to_pylist()]
        sample = [np.unique(np.append(np.frombuffer(b, "<u2"), np.uint16(END_OF_TEXT)))
                  for b in tokenizer_of(vocabulary.value, mark).encode(texts)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Leaves(sample))], pa.binary())], ["leaves"])

    place = F.monotonically_increasing_id()
    rows = df.select(F.xxhash64(f"`{key}`", place).alias("h"), place.alias("n"), F.col(f"`{text}`").alias("t"))
    least = rows.select("h").orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
    if least is None:
        return pickle.dumps(Leaves([]))
    return (rows.filter(F.col("h") <= F.lit(least)).select("n", F.substring("t", 1, SAMPLED_TEXT).alias("t"))
            .repartition(1).sortWithinPartitions("n").select("t").mapInArrow(run, "leaves binary").first()[0])


def tokenize(df: DataFrame, key: str, text: str, vocabulary: str, window: int) -> DataFrame:
    """Full windows, remainders with their ids, and per task the document frequency of each id."""
    with open(public_tokenizers.path(vocabulary), encoding="utf-8") as f:
        json = f.read()
    mark = hash(json)
    # bounded: one vocabulary and DIRECTIONS numbers for each of its ids
    book = df.sparkSession.sparkContext.broadcast(json)
    fitted = df.sparkSession.sparkContext.broadcast(fit_leaves(df, key, text, book, mark))
    key_type = df.select(f"`{key}`").schema[0].dataType.simpleString()
    schema = (f"row long, `{key}` {key_type}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, ids binary, leaf int, terms array<int>, documents array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, leaves = tokenizer_of(book.value, mark), pickle.loads(fitted.value)
        found = np.zeros(1 << 16, np.int64)
        sequence = TaskContext.get().partitionId() << 32
        key_arrow = None
        for batch, first in rows_from(batches):
            key_arrow = batch.schema.field(0).type
            keys, at, rows, points = batch.column(0), [], [], []
            for begin in range(0, batch.num_rows, BATCH):  # bounds what is held of a batch
                texts = [t or "" for t in batch.column(1).slice(begin, BATCH).to_pylist()]
                for k, blob in enumerate(tokenizer.encode(texts), begin):
                    ids = np.append(np.frombuffer(blob, "<u2"), np.uint16(END_OF_TEXT))
                    distinct = np.unique(ids)
                    found[distinct] += 1
                    full = len(ids) // window * window
                    for start in range(0, full, window):
                        at.append(k)
                        rows.append((first + k, start, window, crc_of(ids[start:start + window]),
                                     len(ids), sequence, None))
                        sequence += 1
                    if full < len(ids):
                        at.append(k)
                        rows.append((first + k, full, len(ids) - full, None, len(ids), None,
                                     ids[full:].tobytes()))
                        points.append(leaves.point(distinct))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            row, start, length, crc, total, seq, ids = (
                pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 6 + [pa.binary()], strict=True))
            leaf = np.zeros(len(at), np.int32)
            rest = ids.is_valid().to_numpy(zero_copy_only=False)
            leaf[rest] = leaves.of(np.array(points).reshape(-1, DIRECTIONS))
            yield pa.RecordBatch.from_arrays(
                [row, keys.take(pa.array(at, pa.int64())), start, length, crc, total, seq, ids, pa.array(leaf),
                 pa.nulls(len(at), pa.list_(pa.int32())), pa.nulls(len(at), pa.list_(pa.int64()))],
                ["row", key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "ids", "leaf",
                 "terms", "documents"])
        if key_arrow is not None:
            terms = np.flatnonzero(found)
            lone = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [lone, pa.nulls(1, key_arrow), lone, lone, lone, lone, lone, pa.nulls(1, pa.binary()),
                 pa.nulls(1, pa.int32()), pa.array([terms.tolist()], pa.list_(pa.int32())),
                 pa.array([found[terms].tolist()], pa.list_(pa.int64()))],
                ["row", key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "ids", "leaf",
                 "terms", "documents"])

    return df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("_text")).mapInArrow(run, schema)


class Bm25Index:
    """Postings of a shard: for each token the documents that hold it, with their weights."""

    def __init__(self, documents: list[np.ndarray], idf: np.ndarray, mean: float):
        self.n = len(documents)
        sizes = np.array([len(d) for d in documents])
        bits = max(1, (self.n - 1).bit_length())
        kind = np.uint32 if bits <= 16 else np.uint64  # narrow numbers are sorted faster
        owner = np.repeat(np.arange(self.n, dtype=kind), sizes)
        codes, counts = np.unique(np.concatenate(documents).astype(kind) << kind(bits) | owner, return_counts=True)
        self.owner = (codes & kind((1 << bits) - 1)).astype(np.int64)
        terms = (codes >> kind(bits)).astype(np.int64)
        self.weights = idf[terms] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * sizes[self.owner] / mean))
        self.bounds = np.searchsorted(terms, np.arange((1 << 16) + 1))
        order = np.argsort(self.owner.astype(kind), kind="stable")
        self.terms = np.split(terms[order], np.cumsum(np.bincount(self.owner, minlength=self.n))[:-1])

    def keep(self, kept: np.ndarray) -> None:
        """Take the documents that are not ``kept`` out of all postings."""
        stay = kept[self.owner]
        self.owner, self.weights = self.owner[stay], self.weights[stay]
        self.bounds = np.concatenate([[0], np.cumsum(stay)])[self.bounds]

    def scores(self, query: int) -> np.ndarray:
        terms = self.terms[query]
        parts = list(map(slice, self.bounds[terms].tolist(), self.bounds[terms + 1].tolist()))
        return np.bincount(np.concatenate([self.owner[p] for p in parts]),
                           np.concatenate([self.weights[p] for p in parts]), minlength=self.n)


def pack_shard(documents: list[np.ndarray], idf: np.ndarray, mean: float,
               window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length); all but the last few are full windows."""
    index = Bm25Index(documents, idf, mean)
    used = np.zeros(len(documents), np.int64)  # ids of each document that have their place
    sizes = np.array([len(d) for d in documents])
    sequences: list[list[tuple[int, int, int]]] = []
    seed, first, held = -1, 0, len(documents)
    while True:
        if seed < 0:
            while first < len(documents) and used[first] == sizes[first]:
                first += 1
            if first == len(documents):
                break
            seed = first
        open_ = np.flatnonzero(used < sizes)
        if len(open_) < 0.8 * held:
            index.keep(used < sizes)
            held = len(open_)
        score = index.scores(seed)[open_]
        score[open_ == seed] = np.inf
        pieces, room, seed = [], window, -1
        for doc in open_[np.argsort(-score, kind="stable")].tolist():
            take = min(room, int(sizes[doc] - used[doc]))
            pieces.append((doc, int(used[doc]), take))
            used[doc] += take
            room -= take
            if not room:
                seed = doc if used[doc] < sizes[doc] else -1
                break
        sequences.append(pieces)
    if sequences and sum(p[2] for p in sequences[-1]) < window:
        sequences.extend(cut_in_powers(sequences.pop()))
    return sequences


def cut_in_powers(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The same ids as sequences whose sizes are the powers of two in their number, largest first."""
    left = sum(p[2] for p in pieces)
    queue = list(reversed(pieces))
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            doc, start, length = queue.pop()
            take = min(room, length)
            out.append((doc, start, take))
            if take < length:
                queue.append((doc, start + take, length - take))
            room -= take
        yield out


def shards_of_leaves(sizes: list[tuple[int, int]], shard_documents: int) -> list[tuple[int, int, int]]:
    """(leaf, first shard, number of shards) of leaves (number, documents): large leaves have shards of
    their own, the others share one until it has ``shard_documents``."""
    out, shard, held = [], 0, 0
    for leaf, n in sorted(sizes):
        if n > shard_documents:
            parts = -(-n // shard_documents)
            shard += held > 0
            out.append((leaf, shard, parts))
            shard, held = shard + parts, 0
            continue
        if held + n > shard_documents:
            shard, held = shard + 1, 0
        out.append((leaf, shard, 1))
        held += n
    return out


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "word_bpe_49k.json",
         window: int = WINDOW, shard_documents: int = SHARD_DOCUMENTS) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and the end-of-text id, so null and empty texts have one id.
    Repeated rows, and rows with a null key, are documents of their own.  Other columns are
    not read; an empty table gives an empty result.  A sequence holds ``window`` ids or a
    smaller power of two, so none is padded.
    """
    rows = keep_table(tokenize(df, key, text, vocabulary, window), "tokens")
    # one entry per id of the vocabulary at most
    counted = (rows.filter("terms is not null")
               .select(F.explode(F.arrays_zip("terms", "documents")).alias("x")).select("x.*")
               .groupBy("terms").agg(F.sum("documents").alias("documents")).toArrow())
    tails = rows.filter("ids is not null")
    mean = tails.agg(F.avg("length")).first()[0]
    n_docs = rows.filter("doc_tokens is not null and start + length = doc_tokens").count()
    frequency = np.zeros(1 << 16)
    frequency[counted["terms"].to_numpy()] = counted["documents"].to_numpy()
    idf = np.log1p((n_docs - frequency + 0.5) / (frequency + 0.5))
    # one row per leaf at most, as is the broadcast below
    leaves = tails.groupBy("leaf").count().collect()
    places = df.sparkSession.createDataFrame(
        shards_of_leaves([(r["leaf"], r["count"]) for r in leaves], shard_documents),
        "leaf int, first long, parts long")
    key_type = rows.select(f"`{key}`").schema[0].dataType.simpleString()
    out = f"`{key}` {key_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def run(shard: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("row")
        documents = [np.frombuffer(b, "<u2") for b in part["ids"]]
        begin, total = part["start"].to_numpy(), part["doc_tokens"].to_numpy()
        keys, made = part[key].to_numpy(), []
        for n, pieces in enumerate(pack_shard(documents, idf, mean, window)):
            offset = 0
            for doc, start, length in pieces:
                made.append((keys[doc], begin[doc] + start, length, crc_of(documents[doc][start:start + length]),
                             total[doc], 1 << 62 | int(shard[0]) << 32 | n, offset))
                offset += length
        return pd.DataFrame(made, columns=[key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                           "offset"])

    # shard numbers stand above the bits that count the sequences of a shard
    dealt = tails.join(F.broadcast(places), "leaf").select(
        "row", key, "start", "doc_tokens", "ids",
        (F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts"))).alias("shard"))
    packed = dealt.groupBy("shard").applyInPandas(run, out)
    full = rows.filter("sequence_id is not null").select(
        key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))
    return full.unionByName(packed)
