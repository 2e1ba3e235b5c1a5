"""Byte-level BPE by corpus-level merge replay, and its decoder.

A shard of the corpus (a bounded number of rows) is split into pretokens; its distinct
pretokens are laid out as one byte sequence.  An inverted index lists, for every mergeable
token pair, the positions where it stands.  Merges are then replayed in rank order over the
whole shard: each visits only the positions under its entry and updates the entries of the
two touched neighbours.  The work follows the number of distinct pretokens and of merges,
not the square of a pretoken's length.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, functions as F

#: Bytes of text whose pretokens are encoded together.
SHARD_BYTES = 32 << 20
#: Encoded pretokens remembered between the shards of a task, and the longest of them.
REMEMBERED, LONGEST = 500_000, 64
NONE = 1 << 30


class Merges:
    """The rank table: bytes of each token, and the token that a pair of tokens makes."""

    def __init__(self, file: bytes):
        lines = (line.split() for line in file.splitlines() if line)
        self.rank = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.token = {rank: token for token, rank in self.rank.items()}
        self.decimal = {rank: str(rank) for rank in self.token}
        self.byte = np.array([self.rank.get(bytes([b]), NONE) for b in range(256)], np.int32)
        if (self.byte == NONE).any():
            raise ValueError("a rank table needs all single bytes")
        made = {}
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    made[left << 32 | right] = rank
        self.pairs = np.array(sorted(made), np.int64)
        self.makes = np.array([made[p] for p in self.pairs.tolist()], np.int32)

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair makes, or NONE."""
        if not len(self.pairs):
            return np.full(len(left), NONE, np.int32)
        pairs = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.makes[at], np.int32(NONE))


class Index:
    """Inverted index: for every token that a pair would make, the positions of such pairs."""

    def __init__(self):
        self.places: dict[int, list[np.ndarray]] = {}
        self.ranks: list[int] = []

    def add(self, ranks: np.ndarray, places: np.ndarray) -> None:
        use = ranks < NONE
        ranks, places = ranks[use], places[use]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        starts, ends = [0, *cuts.tolist()], [*cuts.tolist(), len(ranks)]
        for rank, start, end in zip(ranks[starts].tolist(), starts, ends, strict=True):
            part = places[start:end]
            if rank in self.places:
                self.places[rank].append(part)
            else:
                self.places[rank] = [part]
                heapq.heappush(self.ranks, rank)

    def lowest(self) -> tuple[int, np.ndarray]:
        rank = heapq.heappop(self.ranks)
        places = np.sort(np.concatenate(self.places.pop(rank)))
        return rank, places[np.append(True, places[1:] != places[:-1])]


def replay(words: list[bytes], merges: Merges) -> list[list[int]]:
    """Token ids of distinct words, none of them empty.

    The lowest rank that stands anywhere in the shard is taken next, and its places in a word
    are merged from left to right, so every word sees its merges in the order in which they
    would be done for it alone.  Should a merge make a pair of the same or a lower rank, only
    the leftmost place of each word is merged in this step and the others wait.
    """
    data = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.array([len(w) for w in words])
    starts = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    token = merges.byte[data]
    after = np.arange(1, len(data) + 1, dtype=np.int32)
    after[starts + sizes - 1] = -1
    before = np.arange(-1, len(data) - 1, dtype=np.int32)
    before[starts] = -1
    made = np.full(len(data), NONE, np.int32)  # the token that a position makes with the next one
    inner = np.flatnonzero(after >= 0).astype(np.int32)
    made[inner] = merges.of_pairs(token[inner], token[inner + 1])
    index = Index()
    index.add(made[inner], inner)
    while index.ranks:
        rank, places = index.lowest()
        places = places[made[places] == rank]  # others have lost a neighbour meanwhile
        if not len(places):
            continue
        chained = np.append(False, after[places[:-1]] == places[1:])
        if chained.any():  # of overlapping places, every second one
            begin = np.flatnonzero(~chained)
            run = np.arange(len(places)) - np.repeat(begin, np.diff(np.append(begin, len(places))))
            places = places[run % 2 == 0]
        gone = after[places]
        right, left = after[gone], before[places]
        near, prior = right >= 0, left >= 0
        held = np.full(int(near.sum()), rank, np.int32)
        lowest = min(merges.of_pairs(held, token[right[near]]).min(initial=NONE),
                     merges.of_pairs(token[left[prior]], np.full(int(prior.sum()), rank, np.int32)).min(initial=NONE),
                     merges.of_pairs(np.array([rank]), np.array([rank]))[0])
        if lowest <= rank:
            leftmost = np.append(True, word[places[1:]] != word[places[:-1]])
            later = made == rank
            later[places[leftmost]] = False
            index.add(made[later], np.flatnonzero(later).astype(np.int32))
            places, gone, right, left, near, prior = (
                x[leftmost] for x in (places, gone, right, left, near, prior))
        token[places] = rank
        made[gone] = -1
        after[places] = right
        before[right[near]] = places[near]
        made[places] = NONE
        ahead = places[near]
        made[ahead] = merges.of_pairs(token[ahead], token[right[near]])
        behind = before[places[prior]]
        made[behind] = merges.of_pairs(token[behind], token[after[behind]])
        touched = np.concatenate([ahead, behind])
        index.add(made[touched], touched)
    alive = made >= 0
    counts = np.add.reduceat(alive.astype(np.int64), starts)
    ids, ends = token[alive].tolist(), np.cumsum(counts).tolist()
    return [ids[end - n:end] for n, end in zip(counts.tolist(), ends, strict=True)]


class Encoder:
    """Ids of texts; remembers short pretokens between calls, up to a fixed number."""

    def __init__(self, file: bytes, pattern: str):
        self.merges, self.pattern = Merges(file), regex.compile(pattern)
        self.known: dict[str, list[int]] = {}

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text, shard by shard.  A text is never cut, however long."""
        begin, size = 0, 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= SHARD_BYTES or k == len(texts) - 1:
                yield from self._shard(texts[begin:k + 1])
                begin, size = k + 1, 0

    def _shard(self, texts: list[str]) -> Iterator[list[int]]:
        split = [self.pattern.findall(t) for t in texts]
        known = self.known
        all_words = set().union(*split)
        got = {w: known[w] for w in all_words if w in known}
        fresh = [w for w in all_words if w not in known]
        rest: list[str] = []
        for word in fresh:
            whole = self.merges.rank.get(word.encode())
            if whole is None:
                rest.append(word)
            else:
                got[word] = [whole]
        if rest:
            got.update(zip(rest, replay([w.encode() for w in rest], self.merges), strict=True))
        for words in split:
            yield [i for word in words for i in got[word]]
        if len(known) < REMEMBERED:
            known.update((w, got[w]) for w in fresh if len(w) <= LONGEST)


def decode(ids: list[int], merges: Merges) -> bytes:
    return b"".join(map(merges.token.__getitem__, ids))


_encoders: dict[tuple[int, str], Encoder] = {}


def encode_documents(df: DataFrame, key: str = "doc_id", text: str = "text",
                     ranks: str = "byte_bpe_50k.tiktoken",
                     pattern: str = public_tokenizers.PATTERN, with_ids: bool = False) -> DataFrame:
    """Per row: key, n_tokens, ids_sha256, decoded_sha256 (and ``ids`` if wanted).

    ``ranks`` names a file of the public tokenizers; its bytes travel with the job, so
    executors need no such file.  A null text counts as empty (no ids).  Rows are encoded
    one by one: repeated rows stay, null keys too; other columns are not read; an empty table
    gives an empty result.
    """
    with open(public_tokenizers.path(ranks), "rb") as f:
        file = f.read()
    book = df.sparkSession.sparkContext.broadcast(file)  # bounded: one rank table
    mark = (hash(file), pattern)
    key_type = df.select(f"`{key}`").schema[0].dataType.simpleString()
    schema = f"`{key}` {key_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + \
        ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if mark not in _encoders:
            _encoders.clear()
            _encoders[mark] = Encoder(book.value, pattern)
        encoder = _encoders[mark]
        for batch in batches:
            counts, ids_sha, text_sha, all_ids = [], [], [], []
            for ids in encoder.encode([t or "" for t in batch.column(1).to_pylist()]):
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(encoder.merges.decimal.__getitem__, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(decode(ids, encoder.merges)).hexdigest())
                if with_ids:
                    all_ids.append(ids)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                       pa.array(text_sha, pa.string())]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
            yield pa.RecordBatch.from_arrays(columns, names[:len(columns)])

    return df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("_text")).mapInArrow(run, schema)


def decode_documents(df: DataFrame, key: str = "doc_id", ids: str = "ids",
                     ranks: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Per row: key and the decoded bytes; null ids give no bytes."""
    with open(public_tokenizers.path(ranks), "rb") as f:
        file = f.read()
    book = df.sparkSession.sparkContext.broadcast(file)
    key_type = df.select(f"`{key}`").schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = Merges(book.value)
        for batch in batches:
            out = [decode(i or [], merges) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], [key, "decoded"])

    return df.select(F.col(f"`{key}`").alias(key), F.col(f"`{ids}`").alias("_ids")).mapInArrow(
        run, f"`{key}` {key_type}, decoded binary")
