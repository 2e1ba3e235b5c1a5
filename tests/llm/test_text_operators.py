"""Row-wise operators and exact copies against brute force."""

import hashlib
import pickle
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from comarca.llm import bpe, exact_dedup, packing, quality
from comarca.llm.common import table
from comarca.llm.queries import QUERIES


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


# exact copies -------------------------------------------------------------------------------

def groups_by_hand(rows):
    digest = {}
    for n, (key, text) in enumerate(rows):
        name = hashlib.sha256(re.sub("[\x20\x09-\x0d]", "", text).encode()).hexdigest()
        digest.setdefault(name, []).append((-len(text), key is None, key or 0, n, key))
    out = []
    for name, members in digest.items():
        first = min(members, key=lambda m: m[:4])
        out += [(m[4], first[4], len(members), name) for m in members]
    return out


def test_exact_groups_of_hard_rows(hard, rows):
    got = exact_dedup.duplicate_groups(hard)
    want = groups_by_hand(texts_of(hard))
    key = lambda t: tuple(str(v) for v in t)
    assert rows(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(want, key=lambda r: tuple(
        (v is None, str(v)) for v in r))
    kept = got.filter("kept")
    assert kept.count() == len({w[3] for w in want})
    assert kept.filter("not doc_id <=> keep_id").count() == 0
    assert key is not None


def test_exact_heavy_group_is_joined_without_a_shuffle(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text"))
                                  .otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    got = exact_dedup.duplicate_groups(df)
    assert got.filter("group_size = 1000").count() == 1000
    assert got.filter("kept").count() == 2001
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" in plan


def test_exact_drop_keeps_one_row_of_each_group(hard, none):
    left = exact_dedup.drop_duplicates(hard)
    assert left.columns == hard.columns
    want = {w[3] for w in groups_by_hand(texts_of(hard))}
    got = [hashlib.sha256(re.sub("[\x20\x09-\x0d]", "", t).encode()).hexdigest() for _, t in texts_of(left)]
    assert sorted(got) == sorted(want)
    assert exact_dedup.drop_duplicates(none).count() == 0
    assert exact_dedup.duplicate_groups(none).count() == 0


# byte-level BPE -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def file():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(file):
    import base64
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_on_random_texts(file, library):
    encoder, draw = bpe.Encoder(file, public_tokenizers.PATTERN), random.Random(3)
    texts = ["".join(draw.choice("aaabcde thé\U0001f600\n\t 12!<|>") for _ in range(draw.randint(0, 70)))
             for _ in range(600)]
    texts += ["a" * 30000 + "ab" * 9000, "", " ", "<|endoftext|>", " the" * 2000]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids == library.encode_ordinary(text)
        assert bpe.decode(ids, encoder.merges) == text.encode()


def test_bpe_replay_with_a_rank_below_the_one_just_merged():
    """ab is merged before abc can be made, although abc has the lower rank."""
    import base64
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"ab", b"bc", b"aa", b"aaa"]
    file = b"\n".join(base64.b64encode(t) + b" " + str(r).encode() for r, t in enumerate(tokens))
    merges = bpe.Merges(file)
    library = tiktoken.Encoding("odd", pat_str=r"[^ ]+| ", mergeable_ranks=merges.rank, special_tokens={})
    draw = random.Random(5)
    words = list({"".join(draw.choice("abc") for _ in range(draw.randint(1, 14))) for _ in range(500)})
    words = [w for w in words if w.encode() not in merges.rank]
    for word, ids in zip(words, bpe.replay([w.encode() for w in words], merges), strict=True):
        assert ids == library.encode_ordinary(word), word


def test_bpe_query_and_round_trip(spark, sf_dir, library):
    docs = table(spark, sf_dir, "documents")
    got = {r.doc_id: r for r in QUERIES["op4_bpe_merge_replay"](spark, sf_dir).collect()}
    for key, text in texts_of(docs):
        ids = library.encode_ordinary(text)
        assert got[key].n_tokens == len(ids)
        assert got[key].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[key].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_hard_rows(hard, none):
    encoded = bpe.encode_documents(hard, with_ids=True)
    back = [(r.doc_id, bytes(r.decoded).decode()) for r in bpe.decode_documents(encoded).collect()]
    assert sorted(back, key=str) == sorted(texts_of(hard), key=str)
    assert encoded.filter("n_tokens = 0").count() == 3
    assert bpe.encode_documents(none).count() == 0


# packing ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_chunks_are_encoded_as_whole_texts_are(words):
    own, draw = packing.WordTokenizer(words.to_str()), random.Random(2)
    alphabet = "aBcÀéß ſİıµªº²½9_-'st\n\t\x1c\xa0\u0300Σς漢€\""
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    texts += ["<|endoftext|> it's", "", "''s ''' 's"]
    want = [np.array(e.ids, "<u2").tobytes() for e in words.encode_batch(texts, add_special_tokens=False)]
    assert own.encode(texts) == want


def check_pieces(pieces, documents, window):
    """Every id in one piece, sequences gapless, none padded."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(documents)
    for key, parts in by_doc.items():
        at, ids = 0, documents[key]
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or at < window and at & (at - 1) == 0


def ids_of(words, text):
    return np.array([*words.encode(text, add_special_tokens=False).ids, 1], "<u4")


def test_packing_query(spark, sf_dir, words):
    documents = {k: ids_of(words, t) for k, t in texts_of(table(spark, sf_dir, "documents"))}
    check_pieces(QUERIES["op7_bm25_packing"](spark, sf_dir).collect(), documents, 2048)


def test_leaves_keep_topics_together():
    draw = np.random.default_rng(4)
    topic = draw.integers(0, 4, 1600)
    documents = [np.unique(draw.integers(100 + 3000 * t, 100 + 3000 * t + 900, 60)) for t in topic]
    leaves = packing.Leaves(documents[:800])
    leaf = leaves.of(np.array([leaves.point(d) for d in documents]))
    numbers, sizes = np.unique(leaf, return_counts=True)
    of_leaf = {n: first for n, first, _ in packing.shards_of_leaves(
        list(zip(numbers.tolist(), sizes.tolist(), strict=True)), 100)}
    shard = np.array([of_leaf[n] for n in leaf.tolist()])
    largest = sum(np.bincount(topic[shard == s]).max() for s in np.unique(shard))
    assert len(np.unique(shard)) >= 16 and largest > 0.9 * len(topic)


def test_shards_hold_all_leaves():
    sizes = [(5, 7), (0, 3), (1, 3), (9, 31), (2, 5), (12, 1)]
    assert packing.shards_of_leaves(sizes, 10) == [
        (0, 0, 1), (1, 0, 1), (2, 1, 1), (5, 2, 1), (9, 3, 4), (12, 7, 1)]
    assert packing.shards_of_leaves([], 10) == []


def test_packing_small_windows_and_hard_rows(hard, none, words):
    docs = hard.filter("doc_id is not null").dropDuplicates(["doc_id"])
    documents = {k: ids_of(words, t) for k, t in texts_of(docs)}
    check_pieces(packing.pack(docs, window=64, shard_documents=4).collect(), documents, 64)
    total = packing.pack(hard).agg(F.sum("length")).first()[0]
    assert total == sum(len(ids_of(words, t)) for _, t in texts_of(hard))
    assert packing.pack(none).count() == 0


def test_packing_fits_its_sample_outside_the_driver(monkeypatch, hard, words):
    def refuse(*_):
        raise AssertionError("the sample is encoded or fitted in the driver")

    docs = hard.filter("doc_id is not null").dropDuplicates(["doc_id"])
    documents = {k: ids_of(words, t) for k, t in texts_of(docs)}
    for kind in (packing.WordTokenizer, packing.Leaves):
        monkeypatch.setattr(kind, "__init__", refuse)
    check_pieces(packing.pack(docs, window=64, shard_documents=4).collect(), documents, 64)


def test_leaves_follow_the_rows_in_table_order(spark, sf_dir, words):
    json = words.to_str()
    docs = table(spark, sf_dir, "documents")
    book = spark.sparkContext.broadcast(json)
    found = pickle.loads(packing.fit_leaves(docs, "doc_id", "text", book, hash(json)))
    want = packing.Leaves([np.unique(ids_of(words, (t or "")[:packing.SAMPLED_TEXT])) for _, t in texts_of(docs)])
    assert np.allclose(found.weights, want.weights, atol=1e-4) and (found.axis == want.axis).all()


def test_bm25_prefers_documents_that_share_rare_words():
    documents = [np.array(x, np.uint16) for x in ([7, 8, 1], [7, 9, 1], [8, 7, 1], [5, 6, 1])]
    idf = np.full(1 << 16, 2.0)
    idf[1] = 0.01
    scores = packing.Bm25Index(documents, idf, 3.0).scores(0)
    assert scores[2] > scores[1] > scores[3]
    assert packing.pack_shard(documents, idf, 3.0, 6)[0] == [(0, 0, 3), (2, 0, 3)]


# quality ------------------------------------------------------------------------------------

def test_quality_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    got = QUERIES["op1_rule_ensemble"](spark, sf_dir).collect()
    assert len(got) == table(spark, sf_dir, "documents").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(labels[r.doc_id], r.score) for r in got if r.held_out and r.doc_id in labels]
    good, bad = [s for y, s in held if y], [s for y, s in held if not y]
    wins = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert len(bad) > 5 and wins > 0.95


def test_quality_never_learns_from_held_out_rows(spark, hard):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 14)], "doc_id long, quality int, toxic int")
    keys = {r._key for r in quality.training_rows(hard, labels).collect()}
    assert keys and all(zlib.crc32(str(k).encode()) % 5 for k in keys)
    bounded = quality.training_rows(hard, labels, bound=4)
    assert bounded.select("_key").distinct().count() <= 4


def test_quality_paths_of_a_printed_tree():
    tree = """DecisionTreeClassificationModel: depth=2, numNodes=5
  If (feature 0 <= 0.5)
   If (feature 0 <= 0.25)
    Predict: 0.0
   Else (feature 0 > 0.25)
    Predict: 1.0
  Else (feature 0 > 0.5)
   Predict: 1.0
"""
    inf = float("inf")
    assert {r.bounds for r in quality.paths_of(tree, ["a"])} == {
        (("a", -inf, 0.5),), (("a", -inf, 0.25),), (("a", 0.25, 0.5),), (("a", 0.5, inf),)}


def test_quality_hard_rows_without_labels(spark, hard, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    even = quality.fit(hard, labels)
    got = quality.score_documents(hard, even).collect()
    assert len(got) == hard.count() and {r.score for r in got} == {0.5}
    rule = quality.Rule((("stat_words", 5.0, float("inf")),))
    strict = quality.RuleEnsemble(-3.0, ((rule, 6.0),))
    left = quality.keep_good(hard, strict)
    assert left.columns == hard.columns
    assert {len(t.split()) > 5 for _, t in texts_of(left)} == {True}
    assert quality.score_documents(none, strict).count() == 0
    ones = spark.createDataFrame([(1, 1), (2, 1), (6, 1), (None, 0), (7, None), (8, 5)], "doc_id long, quality int")
    assert not quality.fit(hard, ones).weighted
