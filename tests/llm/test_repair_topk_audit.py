"""Conversation repair, bit-sliced top-k and filter audit against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from comarca.llm import bit_sliced, chat_repair, filter_audit

NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
WHITE = " \t\n\x0b\x0c\r"


# conversation repair ------------------------------------------------------------------------

def moved(state, letter, row):
    """State after an edit and its cost; None where the edit is not allowed."""
    if letter == "I":
        return NEXT[state], 3
    role, _, lost, cut = row
    if letter == "D":
        return state, 4
    if lost:
        return None
    extra = 3 if cut else 0
    if letter == "R":
        return NEXT[state], 3 + extra
    if role[:1] == "s" and state == 0:
        return 1, extra
    if role[:1] == {2: "u", 3: "a"}[NEXT[state]]:
        return NEXT[state], extra
    return None


def written(audit, rows):
    rows, state, out = iter(rows), 0, []
    for letter in audit:
        role, text = next(rows)[:2] if letter != "I" else ("", "")
        if letter == "D":
            continue
        state = 1 if letter == "K" and role[:1] == "s" else NEXT[state]
        out.append((role if letter == "K" else {2: "user", 3: "assistant"}[state]) + ":" + (text if letter != "I" else ""))
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def all_ways(rows):
    """Cheapest and ASCII-least of all edit strings with up to two inserts at a time."""
    found = []

    def go(at, state, cost, audit):
        if at == len(rows) and state in (0, 3):
            found.append((cost, audit))
        if at < len(rows):
            for letter in "DKR":
                step = moved(state, letter, rows[at])
                if step:
                    go(at + 1, step[0], cost + step[1], audit + letter)
        if not audit.endswith("II"):
            go(at, NEXT[state], cost + 3, audit + "I")

    go(0, 0, 0, "")
    return min(found)


def by_strings(rows):
    """The same by a table of whole strings per state."""
    def inserts(best):
        for _ in range(2):
            for s in range(4):
                if s in best:
                    new = (best[s][0] + 3, best[s][1] + "I")
                    best[NEXT[s]] = min(best.get(NEXT[s], new), new)
        return best

    best = inserts({0: (0, "")})
    for row in rows:
        new = {}
        for s, (cost, audit) in best.items():
            for letter in "DKR":
                step = moved(s, letter, row)
                if step:
                    way = (cost + step[1], audit + letter)
                    new[step[0]] = min(new.get(step[0], way), way)
        best = inserts(new)
    return min(best[s] for s in (0, 3) if s in best)


def repaired(rows, **limits):
    r = chat_repair.Repair(**limits)
    for row in rows:
        r.feed(*row)
    return r.finish()


def drawn_rows(draw, n):
    roles = ["user", "assistant", "system", "tool", " ", "", "u", "Assistant"]
    return [(draw.choice(roles[:3] if draw.random() < .8 else roles), f"t{i}.", draw.random() < .15, draw.random() < .15)
            for i in range(n)]


def test_repair_is_the_cheapest_and_ascii_least():
    draw = random.Random(1)
    for _ in range(250):
        rows = drawn_rows(draw, draw.randint(0, 4))
        assert repaired(rows) == (*all_ways(rows), written(all_ways(rows)[1], rows))


@pytest.mark.parametrize("modulus", [chat_repair.MODULUS, 2, 5])
def test_repair_of_long_logs_with_colliding_hashes_and_settled_edits(monkeypatch, modulus):
    monkeypatch.setattr(chat_repair, "MODULUS", modulus)
    draw = random.Random(2)
    for n in (30, 120, 400):
        rows = drawn_rows(draw, n)
        want = by_strings(rows)
        for limits in ({}, {"open_nodes": 1}, {"open_nodes": 50}, {"held": 10}):
            assert repaired(rows, **limits) == (*want, written(want[1], rows))


def test_repair_holds_the_open_end_only():
    r, most = chat_repair.Repair(), 0
    for i in range(20_000):
        r.feed(("user", "assistant")[i % 2], "x" * 10_000, False, i % 7 == 0)
        most = max(most, len(r.waiting))
    assert most < 2_000 and len(r.paths.letter) < 10_000
    cost, audit, _ = r.finish()
    assert cost == 3 * len(range(0, 20_000, 7)) and audit == "K" * 20_000


def logs_by_hand(rows):
    """rows: (conv, turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        name = [" " if v is None else str(v) for v in (conv, turn)]
        role, text = (" " if v is None else v for v in (role, text))
        code = zlib.crc32(":".join(name).encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out[conv] += [(turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    result = set()
    for conv, said in out.items():
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in said:
            left = text.rstrip(WHITE)
            faults.append("blank" if not left else "duplicate" if (role, text) in seen
                          else "truncated" if left[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, _, _ in said if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(said))
        lines = [(r, t, f in ("blank", "duplicate"), f == "truncated") for (_, r, t), f in zip(said, faults, strict=True)]
        cost, audit = by_strings(lines)
        result.add((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    written(audit, lines)))
    return result


def test_damaged_logs(spark):
    draw, rows = random.Random(3), []
    texts = ["Yes.", "no", "", None, " \n", "Why?  \t", "a. b", "Ende!\x0b", "long words. " * 20_000, "é漢\U0001f600."]
    for conv in range(150):
        n = draw.choice([1, 2, 5, 12])
        for turn in range(n):
            role = draw.choice(["system", None, "tool", ""]) if draw.random() < .1 else ("user", "assistant")[turn % 2]
            rows.append((conv, draw.choice([turn, turn, turn * 3, None]), role, draw.choice(texts)))
    rows += [(None, 0, "user", "x."), (None, None, "assistant", None), (7, 2, "user", "tie."), (7, 2, "user", "tie.")]
    rows += [(900, t % 3, "user", "same.") for t in range(400)]  # one text, three turns
    rows += [(901, t, ("user", "assistant")[t % 2], f"said {t}.") for t in range(1500)]
    draw.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1, True, "k") for r in rows], "conv_id long, turn long, role string, "
                               "text string, conv string, kind int, first boolean, audit string").repartition(5)
    got = [tuple(r) for r in chat_repair.repair_damaged(df).collect()]
    assert len(got) == len(set(got)) and set(got) == logs_by_hand(rows)
    assert chat_repair.repair_damaged(df.limit(0)).count() == 0
    assert any(r[7] == "" and r[8] == hashlib.sha256(b"").hexdigest() for r in got)


# bit-sliced top-k ---------------------------------------------------------------------------

def top_by_hand(rows, k=10):
    rows = {i: [math.floor(1024 * float(x)) for x in v] for i, v in rows}
    out = set()
    for q, a in rows.items():
        if q % 100 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in rows.items() if i != q)[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("block, chunk, upper", [(16_384, 128, 7), (100, 2, 1), (70, 3, 3)])
def test_top_scores(spark, block, chunk, upper):
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(600, 7)).round(2).tolist())]
    rows += [(1000 + i, [0.0] * 7) for i in range(120)] + [(2000 + i, rows[3][1]) for i in range(200)]
    rows += [(3000, [1e5, -1e5] + [0.0] * 5), (3001, [5e5, 0.25] + [-3.0] * 5)]
    bad = [(4000, None), (4100, []), (4200, [float("nan")] * 7), (4300, [float("inf")] + [1.0] * 6), (4400, [None] + [1.0] * 6),
           (4500, [1.0, 2.0]), (4600, [1e300] * 7), (None, rows[0][1])]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows + bad + rows[:9]],
                               "vec_id long, embedding array<double>, rank int, id string, block int").repartition(3)
    got = [tuple(r) for r in bit_sliced.top_scores(df, block=block, chunk=chunk, upper=upper).collect()]
    assert len(got) == len(set(got)) and set(got) == top_by_hand(rows)


def test_top_scores_of_few_or_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [-1.0]), (200, [2.0])], "vec_id int, embedding array<float>")
    rows = {tuple(r) for r in bit_sliced.top_scores(df).collect()}
    assert rows == {(0, 1, 200, 2 << 20), (0, 2, 1, -(1 << 20)), (200, 1, 0, 2 << 20), (200, 2, 1, -(2 << 20))}
    assert bit_sliced.top_scores(df.limit(1)).count() == bit_sliced.top_scores(df.limit(0)).count() == 0
    alike = spark.createDataFrame([(i, [0.5, -0.5]) for i in range(300)], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in bit_sliced.top_scores(alike).collect()} == top_by_hand(
        [(i, [0.5, -0.5]) for i in range(300)])


def test_slices_add_and_select():
    rng = np.random.default_rng(6)
    values, weights = rng.integers(-700, 900, (500, 12)), rng.integers(-600, 600, 12)
    least, slices = bit_sliced.slices_of(values)
    rows = np.arange(500)
    assert (bit_sliced.resolve(slices, least, rows, weights) == values @ weights).all()
    total = bit_sliced.coarse_sum(slices, ~slices, weights, 0)
    bits = [np.unpackbits(t.view(np.uint8), bitorder="little")[:500].astype(int) if t is not None else 0 for t in total]
    sums = sum(b << i for i, b in enumerate(bits))
    offset = sum(int(w) * int(m) for w, m in zip(weights, least, strict=True)) - \
        sum(-int(w) for w in weights if w < 0) * ((1 << slices.shape[1]) - 1)
    assert (sums + offset == values @ weights).all()
    among = np.packbits(np.pad(np.ones(500, np.uint8), (0, 12)), bitorder="little").view(np.uint64)
    for k in (1, 10, 499):
        assert bit_sliced.select_top(total, among, k) == np.sort(sums)[-k]


# filter audit -------------------------------------------------------------------------------

def audit_by_hand(docs, labels):
    docs = [(k, t or "", p or "") for k, t, p in docs]
    fails = []
    for key, text, _ in docs:
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        copy = key is not None and any(k is not None and k < key and t == text for k, t, _ in docs)
        fails.append({"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                      "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
                      "D": any(c in "#$%&*|" for c in text), "E": copy})
    good, toxic = ({k for k, *v in labels if v[i] == 1} - {None} for i in (0, 1))
    out, sums = [], {}
    for part in {p for _, _, p in docs}:
        rows = [(k, f) for (k, _, p), f in zip(docs, fails, strict=True) if p == part]
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, x in enumerate(order, 1):
                gone, left, before = [r for r in left if r[1][x]], [r for r in left if not r[1][x]], left
                late = sum(f[x] for _, f in rows) - len(gone)
                only = sum(f[x] and sum(f.values()) == 1 for _, f in rows)
                assert len(before) == len(gone) + len(left)
                sums[part, x] = sums.get((part, x), 0) + len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), late, only,
                            sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone)))
    return {(*o, sums[o[0], o[1][o[2] - 1]]) for o in out}


def test_filter_audit(spark, hard):
    draw = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)] + ["AB", "C$", "é", "Word"]
    docs = [(r.doc_id, r.text, r.lang) for r in hard.collect()]
    for i in range(100, 220):
        words = draw.choices(vocabulary[:draw.choice([20, 300, 304])], k=draw.choice([0, 5, 199, 200, 260]))
        docs.append((i, draw.choice([" ", "\n", " \t"]).join(words), draw.choice(["en", "de", "", None])))
    docs += [(i, docs[40 + i % 3][1], "fr") for i in range(300, 360)]  # a large group of copies
    docs += [(None, docs[40][1], "fr"), (300, docs[40][1], "en")]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(0, 400, 2)]
    labels += [(100, 1, 1), (None, 1, 1), (101, None, None), (100, 0, 0)]
    df = spark.createDataFrame([(*d, 1, "m", 2, 3) for d in docs], "doc_id long, text string, lang string, mask int, "
                               "part string, good int, state int").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = [tuple(r) for r in filter_audit.audit_documents(df, marks).collect()]
    assert len(got) == len(set(got)) and set(got) == audit_by_hand(docs, labels)
    assert filter_audit.audit_documents(df.limit(0), marks).count() == 0
    none = filter_audit.audit_documents(df, marks.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(none) == (0, 0)


def test_orders_through_states():
    reach, leave = filter_audit.orders_through(4)
    for state in range(16):
        n = state.bit_count()
        assert (reach[state], leave[state]) == (math.factorial(n), math.factorial(4 - n))
