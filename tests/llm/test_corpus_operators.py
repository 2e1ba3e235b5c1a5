"""Operators that compare documents or vectors with each other, and the pipeline, against brute force."""

import hashlib
import os
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from comarca.llm import minhash, nn_descent, substring_dedup
from comarca.llm.common import table
from comarca.llm.queries import QUERIES
from comarca.llm.shingles import shingle_sets
from comarca.llm.suffix_arrays import distinct_strings, merge


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


# near-duplicates ----------------------------------------------------------------------------

def shingles(text, width):
    lower = "".join(c.lower() if c.isascii() else c for c in text)
    words = [w for w in re.split("[\x20\x09-\x0d]+", lower) if w]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def components_by_hand(rows, width):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        root = find(i)
        if key is not None and sets[i]:
            least[root] = min(key, least.get(root, key))
    out = []
    for i, (key, _) in enumerate(rows):
        component = least.get(find(i)) if sets[i] else key
        out.append((key, len(sets[i]), component, key == component))
    return sorted(out, key=str)


def found(df, width):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept)
                   for r in minhash.near_duplicates(df, width=width).collect()), key=str)


def test_shingle_counts_are_exact():
    draw = random.Random(9)
    texts = ["".join(draw.choice("aB \tcé\n") for _ in range(draw.randint(0, 60))) for _ in range(500)]
    for width in (1, 2, 5):
        sets = shingle_sets([t.encode() for t in texts], width)
        want = [shingles(t, width) for t in texts]
        assert [len(s) for s in sets] == [len(s) for s in want]
        for i in range(0, 500, 7):
            j = (i * 31 + 5) % 500
            assert len(np.intersect1d(sets[i], sets[j])) == len(want[i] & want[j])


def test_circulant_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    base = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))
    other = np.union1d(base[:3000], np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64)))
    a, b = minhash.signatures([base, np.sort(other)], 2048)
    assert abs((a == b).mean() - 3000 / 5000) < 0.04


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_of_chains_and_hubs(spark, width):
    draw = random.Random(width)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        return words

    hub = [draw.choice(vocabulary) for _ in range(150)]
    for k in range(60):  # all near the hub, many not near each other
        rows.append(" ".join(edited(hub, draw.randint(0, 8 if width == 2 else 4))))
    chain = [draw.choice(vocabulary) for _ in range(150)]
    for k in range(30):  # each near the one before
        chain = edited(chain, 5 if width == 2 else 2)
        rows.append(" ".join(chain))
    rows += ["", " ", "one", "ONE\t", "one two", "One  two", None, "a b c d", "a b c d e"]
    rows += [" ".join(draw.choice(vocabulary) for _ in range(40)) for _ in range(30)]
    draw.shuffle(rows)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert found(df, width) == components_by_hand(texts_of(df), width)


def test_near_duplicates_of_hard_rows(hard, none):
    assert found(hard, 2) == components_by_hand(texts_of(hard), 2)
    left = minhash.drop_near_duplicates(hard)
    assert left.columns == hard.columns
    keys = sorted(r.doc_id if r.doc_id is not None else -1 for r in left.collect())
    want = {k if k is not None else -1 for k, _, c, kept in components_by_hand(texts_of(hard), 5) if kept}
    assert keys == sorted(want)
    assert left.filter("doc_id is null").first().text is None
    assert minhash.near_duplicates(none).count() == 0


def test_near_duplicates_query(spark, sf_dir):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept)
                  for r in QUERIES["op5_circulant_minhash"](spark, sf_dir).collect()), key=str)
    assert got == components_by_hand(texts_of(table(spark, sf_dir, "documents")), 2)


@pytest.mark.parametrize(("hot", "holders"), [(minhash.HOT, minhash.HOLDERS), (20, 3)])
def test_prefix_pairs_lose_no_link_and_skip_what_cannot_be_one(spark, monkeypatch, hot, holders):
    monkeypatch.setattr(minhash, "HOT", hot)
    monkeypatch.setattr(minhash, "HOLDERS", holders)
    rng = np.random.default_rng(3)
    base = np.arange(1, 201, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sets = []
    for k in range(260):  # similarities to the base, and to each other, on both sides of 0.8
        drop, new = rng.integers(0, 40), rng.integers(0, 40)
        sets.append(np.union1d(rng.permutation(base)[drop:], rng.integers(0, 1 << 62, new, dtype=np.uint64)))
    labels = [0 if k < 90 else k for k in range(len(sets))]
    apart = spark.createDataFrame(list(enumerate(labels)), "node long, label long")
    table_ = spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in enumerate(sets)], "node long, set binary")
    pairs = minhash.prefix_pairs(apart, table_, 80)
    got = {(r.a, r.b) for r in pairs.collect()}
    want = set()
    for a in range(len(sets)):
        for b in range(a):
            shared = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if labels[a] != labels[b] and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                want.add((b, a))
    assert len(want) > 100 and want <= got
    assert all(labels[a] != labels[b] for a, b in got)
    assert {(r.a, r.b) for r in minhash.confirmed(pairs, table_, 80).collect()} == want


def test_a_family_below_the_threshold_makes_few_pairs(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 300, dtype=np.uint64)
    sets = [np.union1d(rng.permutation(base)[45:], rng.integers(0, 1 << 62, 45, dtype=np.uint64)) for _ in range(2000)]
    apart = spark.createDataFrame([(k, k) for k in range(2000)], "node long, label long")
    table_ = spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in enumerate(sets)], "node long, set binary")
    assert minhash.prefix_pairs(apart, table_, 80).count() == 0


# repeated bytes -----------------------------------------------------------------------------

def cut_by_hand(rows):
    out = []
    for key, text in rows:
        data = text.encode()
        earlier = set()
        for other, t in rows:
            if other is not None and (key is None or other < key):
                d = t.encode()
                earlier |= {d[i:i + 50] for i in range(len(d) - 49)}
        cover = bytearray(len(data))
        for i in range(len(data) - 49):
            if data[i:i + 50] in earlier:
                cover[i:i + 50] = b"\1" * 50
        kept = bytes(b for b, c in zip(data, cover, strict=True) if not c)
        spans = sum(c and not (i and cover[i - 1]) for i, c in enumerate(cover))
        out.append((key, len(data), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def removed(df, **sizes):
    return sorted((tuple(r) for r in substring_dedup.repeated_bytes(df, **sizes).collect()), key=str)


def test_distinct_strings_and_merging():
    rng = np.random.default_rng(1)
    for _ in range(60):
        letters = rng.integers(1, 5)
        pieces = [rng.integers(97, 97 + letters, rng.integers(50, 85)).astype(np.uint8) for _ in range(rng.integers(1, 12))]
        pieces += [p.copy() for p in pieces[:3]]
        data = np.concatenate(pieces)
        room = np.concatenate([np.arange(len(p), 0, -1) for p in pieces])
        starts = np.flatnonzero(room >= 50)
        values = rng.integers(0, 100, len(starts))
        texts, least, number = distinct_strings(data, starts, room, values, 50)
        windows = [data[i:i + 50].tobytes() for i in starts]
        want = {}
        for w, v in zip(windows, values, strict=True):
            want[w] = min(v, want.get(w, 999))
        assert list(texts) == sorted(want) and least.tolist() == [want[t] for t in texts]
        assert [texts[i] for i in number] == windows
        half = len(texts) // 2
        both, low = merge(texts[:half + 1], least[:half + 1], texts[half:], least[half:] - 1)
        assert list(both) == list(texts)
        assert low.tolist() == [v - (i >= half) for i, v in enumerate(least.tolist())]


def test_repeated_bytes_over_small_shards(spark):
    draw = random.Random(6)
    passages = ["".join(draw.choice("abcdé \n") for _ in range(draw.randint(45, 140))) for _ in range(12)]
    rows = []
    for key in draw.sample(range(1000), 150):
        parts = [draw.choice(passages) if draw.random() < 0.5 else
                 "".join(draw.choice("xyzwvé") for _ in range(draw.randint(0, 60))) for _ in range(draw.randint(0, 5))]
        rows.append((key, "".join(parts)))
    rows += [(2000, "a" * 3000), (2001, "b" + "a" * 100 + "b"), (2002, "ab" * 600), (2003, "ba" * 100), (2004, None),
             (2005, "\0" * 120), (2006, "\0" * 60 + "x" * 60), (None, passages[0]), (None, passages[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = cut_by_hand(texts_of(df))
    assert removed(df, shard_bytes=700, owner_bytes=300, array_bytes=400) == want
    assert removed(df) == want


def test_repeated_bytes_of_hard_rows(hard, none):
    docs = hard.filter("doc_id is null or doc_id <> 11")
    assert removed(docs) == cut_by_hand(texts_of(docs))
    left = substring_dedup.remove_repeats(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    kept = {r.doc_id: r.text for r in left.collect()}
    assert kept[3] is None and kept[8] == "" and kept[1] == "Alpha beta\tgamma delta"
    assert substring_dedup.repeated_bytes(none).count() == 0


def test_repeated_bytes_keep_lengths_and_whole_characters(spark):
    df = spark.createDataFrame([(1, "é" * 40 + "start", 45, "x"), (2, "n" + "é" * 40 + "end", 44, "y")],
                               "doc_id long, text string, n_chars long, lang string")
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(df).collect()}
    assert got[1].text == "é" * 40 + "start" and got[1].n_chars == 45
    assert got[2].text == "nend" and got[2].n_chars == 4 and got[2].lang == "y"


def test_runs_that_stay_have_whole_characters():
    draw = random.Random(9)
    for _ in range(200):
        text = "".join(draw.choice("aé€𝄞 ") for _ in range(draw.randint(1, 40)))
        data = np.frombuffer(text.encode(), np.uint8)
        cut = np.array([draw.random() < 0.3 for _ in data])
        want, at = "", 0
        for c in text:
            size = len(c.encode())
            want += "" if cut[at:at + size].any() else c
            at += size
        runs = substring_dedup.whole_runs(data, cut)
        assert "".join(data[r["start"] - 1:][:r["length"]].tobytes().decode() for r in runs) == want
        assert all(r["length"] > 0 for r in runs)


def test_repeated_bytes_query(spark, sf_dir):
    got = sorted((tuple(r) for r in QUERIES["op6_suffix_arrays"](spark, sf_dir).collect()), key=str)
    assert got == cut_by_hand(texts_of(table(spark, sf_dir, "documents")))


# nearest neighbours -------------------------------------------------------------------------

def nearest_by_hand(rows, k, every):
    out = {}
    for q, v in rows:
        if q % every:
            continue
        near = sorted((float(np.sqrt(((np.array(v, float) - np.array(w, float)) ** 2).sum())), i)
                      for i, w in rows if i != q)
        out[q] = near[:k]
    return out


def recall(got, want):
    hits = 0
    for q, near in want.items():
        mine = sorted(((r.rank, r.vec_id, r.score) for r in got if r.query_id == q))
        assert [r[0] for r in mine] == list(range(1, len(near) + 1))
        assert [r[1:] for r in mine] == sorted((r[1:] for r in mine), key=lambda x: (x[1], x[0]))
        hits += len({r[1] for r in mine} & {i for _, i in near})
    return hits / max(1, sum(map(len, want.values())))


def test_nearest_recall(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    got = QUERIES["op9_nn_descent"](spark, sf_dir).collect()
    assert recall(got, nearest_by_hand(rows, 10, 100)) >= 0.9


def test_nearest_with_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 8)).astype(np.float32).tolist()
    rows = [(i, base[i % 40] if i < 300 else base[0]) for i in range(400)]  # one vector a quarter of all
    bad = [(1000, None), (1100, []), (1200, [0.0] * 8), (1300, [float("nan")] * 8), (1400, [1.0, None] + [0.0] * 6),
           (1500, [float("inf")] + [1.0] * 7), (1600, [1.0, 2.0]), (None, base[3])]
    df = spark.createDataFrame(rows + bad + rows[:20], "vec_id long, embedding array<float>").withColumn(
        "node", F.lit("x")).withColumn("rank", F.lit(1)).repartition(3)
    got = nn_descent.nearest(df).collect()
    want = nearest_by_hand(rows, 10, 100)
    assert {r.query_id for r in got} == set(want)
    for q, near in want.items():
        mine = [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)]
        assert [m[0] for m in mine] == [i for _, i in near]
        assert np.allclose([m[1] for m in mine], [d for d, _ in near], rtol=1e-12, atol=0)
    assert nn_descent.nearest(df.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.rank) for r in nn_descent.nearest(few).orderBy("rank").collect()] == [(2, 1), (1, 2)]


def test_nearest_goes_on_until_converged_and_wide_enough(spark):
    rng = np.random.default_rng(4)
    rows = list(enumerate(rng.normal(size=(3000, 64)).astype(np.float32).tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    nodes = nn_descent.keep_table(df.toDF("node", "vector"), "nodes")
    queries = nodes.filter("node % 100 = 0").withColumn("query", F.col("node"))
    want = nearest_by_hand(rows, 10, 100)
    for blocks in (1, 4):
        graph = nn_descent.neighbour_graph(nodes, blocks=blocks)
        assert graph.filter("new").count() <= 0.001 * 20 * 3000
        seen = nn_descent.search(queries, graph, nodes, beam=4, blocks=blocks).select("query", "node").collect()
        pairs = {(r.query, r.node) for r in seen}
        assert sum((q, i) in pairs for q, near in want.items() for _, i in near) >= 0.9 * 300
    assert graph.join(nodes.select("node"), "node").filter(
        nn_descent.salt(F.col("node"), parts=4) != nn_descent.salt(F.col("other"), parts=4)).count() == 0


def test_nearest_of_one_vector_copies_doubles_and_a_single_query(spark):
    make = lambda rows, kind="double": spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    assert nn_descent.nearest(make([(0, [1.0, 2.0])])).count() == 0
    copies = nn_descent.nearest(make([(i, [1.0, 2.0]) for i in range(20)], "float")).orderBy("rank").collect()
    assert [tuple(r) for r in copies] == [(0, i, i, 0.0) for i in range(1, 11)]
    close = make([(i, [1.0 + i * 1e-9, 1.0]) for i in range(30)])
    got = nn_descent.nearest(close).orderBy("rank").collect()
    assert [r.vec_id for r in got] == list(range(1, 11))
    assert np.allclose([r.score for r in got], [(1.0 + i * 1e-9) - 1.0 for i in range(1, 11)], rtol=1e-12, atol=0)
    assert nn_descent.nearest(make([(1, [1.0]), (2, [2.0])])).count() == 0  # no query


# the pipeline -------------------------------------------------------------------------------

def test_pipeline_stages_one_by_one(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    columns, seen = docs.columns, [texts_of(docs)]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
            seen.append(texts_of(docs))
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    good = {k for k, _ in seen[1]}
    assert np.mean([(k in good) == bool(labels[k]) for k, _ in seen[0] if k in labels]) > 0.95
    groups = {}
    for k, t in seen[1]:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t), []).append((-len(t), k))
    assert sorted(k for k, _ in seen[2]) == sorted(min(m)[1] for m in groups.values())
    assert sorted(k for k, _ in seen[3]) == sorted(
        k for k, _, _, kept in components_by_hand(seen[2], 5) if kept)
    want = {k: d for k, _, _, _, d in cut_by_hand(seen[3])}
    originals = dict(seen[3])
    for k, t in seen[4]:
        if hashlib.sha256(originals[k].encode()).hexdigest() != want[k]:
            assert len(t) < len(originals[k])
        else:
            assert t == originals[k]
    assert {r.doc_id for r in docs.collect()} == {k for k, _ in seen[4]}


def test_pipeline_of_an_empty_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_equal_pieces_are_sorted_once(monkeypatch):
    """Shards send the same piece; its owner sorts the text once and answers each shard."""
    import numpy as np
    import pyarrow as pa
    from comarca.llm import substring_dedup
    sorted_bytes, plain = [], substring_dedup.distinct_strings
    monkeypatch.setattr(substring_dedup, "distinct_strings",
                        lambda held, *rest: sorted_bytes.append(len(held)) or plain(held, *rest))
    piece = np.frombuffer(bytes(range(32, 32 + 52)), np.uint8)  # three windows
    least = [7, 3, 3]
    part = pa.table({
        "owner": pa.array([0] * 3, pa.int64()), "shard": pa.array(range(3), pa.int64()),
        "windows": pa.array([bytes([3])] * 3, pa.binary()),
        "least": pa.array([substring_dedup.pack_bytes(np.array([x])) for x in least], pa.binary()),
        "data": pa.array([substring_dedup.pack_bytes(piece)] * 3, pa.binary())})
    bits = substring_dedup.earlier_windows(1 << 20)(part)["bits"].to_pylist()
    assert bits == [bytes([0b11100000]), bytes(1), bytes(1)] and sum(sorted_bytes) == 52


def test_one_round_of_centres_loses_no_link(spark, monkeypatch):
    """What one round of centres leaves apart meets in the prefix join."""
    from comarca.llm import minhash
    assert minhash.STAR_ROUNDS == 1
    words = [f"w{k}" for k in range(60)]
    # a chain: neighbours are near, the ends are not
    rows = [(i, " ".join(words[:i * 3] + [f"n{k}" for k in range(i * 3, 60)])) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {(a, b) for a, b in zip(t.split(), t.split()[1:])} for i, t in rows}
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    assert got == label and len(set(label.values())) < len(label)


def test_a_bitmap_keeps_what_a_join_finds_and_little_else(spark, monkeypatch):
    from comarca.llm import common
    rows = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id") * 7).alias("key"), F.lit("x").alias("text"))
    wanted = spark.createDataFrame([(None,), *((7 * k,) for k in range(1, 20_000, 100)), (3,), (7,), (7,)], "k long")
    keys = {r.key for r in rows.collect()} & {r.k for r in wanted.collect()}
    left = common.thinned(rows, "key", wanted, "k")
    assert left.columns == ["key", "text"]
    got = [r.key for r in left.collect()]
    assert None in keys and keys <= set(got) and len(got) == len(set(got)) < 20_000 / 8
    monkeypatch.setattr(common, "BITMAP_WORDS", 1)  # more rows pass, none is lost
    assert keys <= {r.key for r in common.thinned(rows, "key", wanted, "k").collect()}
    assert common.thinned(rows, "key", wanted.limit(0), "k").count() == 0


def test_near_duplicates_shuffle_few_texts_and_buckets(spark, monkeypatch):
    """Rows that have no near copy stay where they are: neither their texts nor their bands are joined."""
    words = [f"word{k}" for k in range(3000)]
    draw = random.Random(11)
    rows = [" ".join(draw.choice(words) for _ in range(60)) for _ in range(600)]
    rows += [f"{rows[0]} tail", f"{rows[1]} tail"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    passed = []

    def counted(left, by, wanted, wanted_by, thin=minhash.thinned):
        out = thin(left, by, wanted, wanted_by)
        passed.append((by, left.count(), out.count()))
        return out

    monkeypatch.setattr(minhash, "thinned", counted)
    assert found(df, 2) == components_by_hand(texts_of(df), 2)
    few = {by: (n, kept) for by, n, kept in passed}
    assert few["bucket"][1] < few["bucket"][0] / 8 and few["key"][1] < few["key"][0] / 8


def test_kept_tables_leave_no_shuffle_files(spark):
    from comarca.llm.common import CLEANUP, keep_table
    before = spark.conf.get(CLEANUP, None)
    folders = [str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]

    def files():
        return {f for folder in folders for _, _, names in os.walk(folder) for f in names
                if f.startswith("shuffle_") and f.endswith(".data")}

    old = files()
    kept = keep_table(spark.range(50_000).groupBy((F.col("id") % 1000).alias("k")).count().repartition(3, "k"), "grouped")
    left, waited = files() - old, 0
    while left and waited < 20:  # executors delete them a moment later
        time.sleep(0.2)
        left, waited = files() - old, waited + 1
    assert not left
    assert kept.count() == 1000 and spark.conf.get(CLEANUP, None) == before
