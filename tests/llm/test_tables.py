"""Registered queries against their SQL, and conversations, urls and pages against brute force."""

import random

import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

from comarca.llm import chat, html_text, url_rules
from comarca.llm.oracles import ORACLES
from comarca.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), name, QUERIES[name], ORACLES[name], sf_dir) is None


# conversations ------------------------------------------------------------------------------

def chats_by_hand(rows):
    said = {}
    for conv, turn, role, text in rows:
        said.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: tuple(t[2:] for t in sorted(ts)) for c, ts in said.items()}
    classes = {}
    for c, s in said.items():
        classes.setdefault(s, []).append(c)
    out = set()
    for s, members in classes.items():
        if any(len(o) > len(s) and o[:len(s)] == s for o in classes):
            continue
        text = "".join(f"<|{r}|>\n{t}\n" for r, t in s)
        out.add((min(members, key=lambda c: (c is None, c)), len(s), len(members), text))
    return out


def test_chat_snapshots_of_random_logs(spark):
    draw, rows = random.Random(4), []
    for conv in range(120):
        n = draw.randint(1, 7)
        for turn in range(n):
            rows.append((conv, turn, draw.choice(["user", None]), draw.choice(["a", "b", "", None, "long " * 50])))
    rows += [(None, 0, "user", "x"), (None, None, "user", "y"), (7, 2, "user", "tie"), (7, 2, "user", "tie")]
    for conv in range(200, 230):  # one conversation logged thirty times, at all lengths
        rows += [(conv, t, "user", f"turn {t}") for t in range(1 + conv % 9)]
    rows = rows[::-1]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, pos string")
    for block in (2, 1024):
        parts = chat.render_chats(df, block=block).orderBy("conv_id", "part").collect()
        whole = {}
        for p in parts:
            whole.setdefault((p.conv_id, p.n_turns, p.copies), []).append((p.part, p.rendered))
        assert all([n for n, _ in v] == list(range(len(v))) for v in whole.values())
        assert {(*k, "".join(t for _, t in v)) for k, v in whole.items()} == chats_by_hand(rows)
    assert chat.render_chats(df.limit(0)).count() == 0


# urls ---------------------------------------------------------------------------------------

def judged_by_hand(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        rest = rest[cut:]
        cut = min([i for i in (rest.find(c) for c in "?#") if i >= 0], default=len(rest))
        path = rest[:cut]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fits, key=lambda r: (-len(r.text), r.text), default=None)
    return host, path, best and best.text, "allow" if best is None or best.allow else "block"


URLS = [None, "", "no scheme.org/", "http://", "https://Example.ORG/es/", "https://a.example.org/es/x?y=/fr/",
        "http://example.org/en/1", "http://example.org/en/12#/es/", "http://example.org/EN/1", "http://example.com",
        "http://example.com/fr/", "http://notexample.org/es/1", "http://my-example.org/es/", "x://É.com/de/é",
        "http://a.com/de/\nx", "ftp://b.org:80/x", "http://c.org", "http://c.org?x=/", "http://d.com/fr", "a://b://com/fr/",
        "http://e.com/fr/de/" + "x/" * 5000, "http://example.org/es/", "http://example.org/es/"]


@pytest.mark.parametrize("extra", [(), (url_rules.Rule("net", "/a", False), url_rules.Rule("a", "/", True),
                                        url_rules.Rule("org", "/es/", True), url_rules.Rule("example.org", "/es/1", False))])
def test_urls_by_hand(spark, extra):
    rules = url_rules.RULES + extra
    draw = random.Random(1)
    urls = URLS + ["http://" + "".join(draw.choice(["example", "org", "com", "net", ".", ".", "a"]) for _ in range(4))
                   + "".join(draw.choice(["/", "es", "en", "fr", "/de/", "1", "?", "/a"]) for _ in range(5)) for _ in range(400)]
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)],
                               "page_id long, url string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(df, rules=rules).collect()}
    assert got == {i: judged_by_hand(u, rules) for i, u in enumerate(urls)}
    assert url_rules.judge_urls(df.limit(0)).count() == 0


def test_urls_are_not_shuffled_and_rules_are_filed_under_rare_tokens(spark):
    df = spark.createDataFrame([(1, "http://a.org/x")] * 20 + [(2, "http://b.org/es/")], "page_id long, url string")
    plan = url_rules.judge_urls(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan
    rule = url_rules.Rule("example.org", "/es/x", False)
    assert set(rule.tokens()) == {"h:example", "h:org", "p:es"}
    counts = url_rules.token_counts(df, url_rules.host_of(F.col("url")), url_rules.path_of(F.col("url")), (rule,))
    assert counts == {"h:org": 21, "p:es": 1}
    star = url_rules.Rule("org", "/a*b/c", False)
    assert set(star.tokens()) == {"h:org"}
    assert url_rules.judge_urls(spark.createDataFrame([(1, "http://x.org/a--b/cd")], "page_id int, url string"),
                                rules=(star,)).first().verdict == "block"


# pages --------------------------------------------------------------------------------------

def page(main, extra=""):
    return (f'<!doctype html><html><head><title>T</title><style>p{{}}</style><script>if (a < b) "</p>"</script></head>'
            f'<body><header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></ul></nav>{main}'
            f'<div class="sidebar">Side <p>bar text that is rather long, longer than some articles are</div>{extra}'
            f'<footer>Foot &copy;</footer></body></html>')


PAGES = [
    (page("<article><h1>Head</h1><p>One <b>bo</b>ld.<p>Two\n  &amp; three&nbsp;x<br>y</p></article>"),
     "Head One bold. Two & three x y"),
    (page('<div class="content"><p>First paragraph, of a few words.</p><div class="ad">Buy!</div><ul><li>a<li>b</ul></div>'),
     "First paragraph, of a few words. a b"),
    (page("<main><section><h1>A</h1><p>text one is here</p></section><section><p>text two is there</p></section></main>",
          '<section id="comments"><p>I disagree with all of this very much, and at length, as always.</p></section>'),
     "A text one is here text two is there"),
    (page('<div class="post-12"><p>Hello <a href="x">link</a> text and some more of it</p><form>Mail <input></form></div>'
          '<div class="cookie-notice">We use cookies</div>'), "Hello link text and some more of it"),
    ("<article><p>Cut off in the mid", "Cut off in the mid"),
    ("<p>No container at all", "No container at all"),
    ("just text &lt;b&gt;", "just text <b>"),
    ("<article><p>broken <a title=\"x>quote</p><p>more text</article>", "broken quote more text"),
    ("<!-- <p>not</p> --><article><table><tr><td>1<td>2<tr><td>3</table></article", "1 2 3"),
    ("", ""), (None, ""), ("<script>only</script>", ""),
]


def test_pages_by_hand(spark):
    rows = [(i, f"http://h{i}.com/x", h, "t") for i, (h, _) in enumerate(PAGES)]
    rows += [(100, None, PAGES[0][0], "t"), (100, None, PAGES[0][0], "t"), (None, "nohost", None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text) for r in html_text.extract_text(df).collect()]
    want = [(i, t) for i, (_, t) in enumerate(PAGES)] + [(100, PAGES[0][1])] * 2 + [(None, "")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_pages_follow_the_consensus_of_their_host(spark):
    usual = '<div class="story"><p>{}</p></div><div class="more"><p>{}</p></div>'
    rows = [(i, "http://one.com/%d" % i, page(usual.format("story text " * 20, "teaser words"))) for i in range(12)]
    rows.append((50, "http://one.com/odd", page(usual.format("short story", "a longer block of other words " * 9))))
    rows.append((51, "http://two.com/odd", page(usual.format("short story", "a longer block of other words " * 9))))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract_text(df).collect()}
    assert got[50] == "short story"
    assert got[51].startswith("a longer block")


BODY = "body words go on. " * 60
WHOLE = [
    (f"<article><h1>Head</h1><p>Lead.</p><div><div>{BODY}</div></div></article>", f"Head Lead. {BODY}"),
    (f"<div><h1>Head</h1><div>{BODY}</div></div>", f"Head {BODY}"),
    (f"<article><div><section>{BODY * 3}</section><section>{BODY}end</section></div></article>", f"{BODY * 4}end"),
    (f'<div><section class="s">{BODY * 3}</section><section class="s">{BODY}end</section></div>', f"{BODY * 4}end"),
    (f'<div class="has-sidebar"><div class="content">{BODY}</div></div><div class="left-sidebar">Side</div>', BODY),
    (f'<article>{BODY}<div class="share-links"><a href="x">tell others</a></div></article>', BODY),
]


def test_pages_keep_what_is_around_their_best_container(spark):
    rows = [(i, f"http://w{i}.com/{k}", f"<html><body>{h}</body></html>") for i, (h, _) in enumerate(WHOLE) for k in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.text) for r in html_text.extract_text(df).collect())
    assert got == [(i, t.strip()) for i, (_, t) in enumerate(WHOLE) for _ in range(3)]


def test_pages_query(spark, sf_dir):
    got = QUERIES["op8_host_consensus"](spark, sf_dir).collect()
    assert len(got) == 50 and all(r.n_chars == len(r.text) for r in got)
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    import html
    import re
    for r in got:
        body = re.search(r"<article>(.*?)(?:</article>|<footer|\Z)", pages[r.page_id], re.S)[1]
        plain = re.sub(r"<[^>]*(?:>|\Z)", lambda m: "" if m[0] in ("<b>", "</b>") else " ", body)
        assert r.text == " ".join(html.unescape(plain).split())
