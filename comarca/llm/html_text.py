"""Main text of web pages by consensus of their hosts.

Every page names the container that scores best in it, as a path of tags and generalised
classes.  The pages of a host vote in Spark; paths with a tenth of the votes win (so a host
has ten at most).  Then each page is extracted again with the winning path of most votes
that it has; a page that has none of them keeps its own choice.  The text is that of all nodes
on the path, each widened to its article (or main element), and the text above them that is in
no container beside them.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from comarca.llm.common import keep_table
from comarca.operators.joins import lookup_join

#: Share of a host's votes from which a path wins.
WINNING_SHARE = 0.1
#: What a container gets of the text of a container inside it, per step.
DECAY = 0.7
#: Share of a page's unlinked text up to which a block with a dropped word among others in a
#: class name is dropped; a block with more is a layout.
LITTLE = 0.5

# Names of HTML elements and of what is no part of an article.
BLOCKS = frozenset("""address article aside blockquote body canvas caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
    optgroup option p pre search section summary table tbody td tfoot th thead title tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("article body div main section td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea noscript iframe template xmp title".split())
DROPPED = frozenset("""aside audio button canvas datalist dialog footer form head iframe menu nav noscript object
    script search select style svg template textarea title video xmp""".split())
DROPPED_ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation
    search toolbar""".split())
DROPPED_WORDS = frozenset("""ad ads adbox adslot advert adverts advertisement advertising banner banners breadcrumb
    breadcrumbs comment comments commentlist consent cookie cookiebar cookies copyright disqus footer gdpr header
    login masthead menu modal nav navbar navigation navmenu newsletter notice notices notification pager pagination
    popup promo promoted promotion related replies reply share sharing sidebar signup skip social sponsor sponsored
    subscribe subscription teaser toolbar widget widgets""".split())
CLOSED_BY = {"li": ("li", ("ul", "ol", "menu", "dir")), "dd": ("dd dt", ("dl",)), "dt": ("dd dt", ("dl",)),
             "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
             "option": ("option", ("select",))}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*>""", re.S)
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
UNFINISHED = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


@dataclass
class Node:
    tag: str
    path: str
    parent: int
    dropped: bool
    inside: bool  # of an article or main element
    end: int = -1  # number of the last node inside
    score: float = 0.0


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    segments: list[tuple[int, str, int]] = field(default_factory=list)  # node, text of a block, worth

    def best(self) -> int:
        """The container that scores best; of equal ones the first."""
        return max((i for i, n in enumerate(self.nodes) if i == 0 or n.tag in CONTAINERS and not n.dropped),
                   key=lambda i: (self.nodes[i].score, -i))

    def with_path(self, path: str) -> int | None:
        found = [i for i, n in enumerate(self.nodes) if n.path == path and not n.dropped and n.score > 0]
        return max(found, key=lambda i: (self.nodes[i].score, -i), default=None)

    def above(self, node: int) -> Iterator[int]:
        """A node and its ancestors."""
        while node >= 0:
            yield node
            node = self.nodes[node].parent

    def whole(self, node: int) -> int:
        """The outermost article around a node, else the outermost main element, else the node."""
        for tag in ("article", "main"):
            if found := [i for i in self.above(node) if self.nodes[i].tag == tag]:
                return found[-1]
        return node

    def text(self, container: int) -> str:
        path = self.nodes[container].path
        parts = {self.whole(i) for i, n in enumerate(self.nodes)
                 if i == container or n.path == path and not n.dropped and n.score > 0}
        over = {i for part in parts for i in self.above(part)}

        def belongs(node: int, worth: int) -> bool:
            chain = list(self.above(node))
            if not parts.isdisjoint(chain):
                return True
            # text of an ancestor, in no other container
            holder = next(i for i in chain if not i or self.nodes[i].tag in CONTAINERS)
            loose = self.nodes[holder].tag in ("", "body")
            return worth > 0 and holder in over and (not loose or self.nodes[node].tag in HEADINGS | {"p"})

        return " ".join(text for node, text, worth in self.segments if belongs(node, worth))

    def drop_suspects(self, suspects: list[int]) -> None:
        """Drop suspects with little or mostly linked text, and what is inside them."""
        all_ = sum(worth for _, _, worth in self.segments)
        for i in suspects:
            inside = sum(worth for node, _, worth in self.segments if i <= node <= self.nodes[i].end)
            if inside <= LITTLE * all_:
                for node in self.nodes[i:self.nodes[i].end + 1]:
                    node.dropped = True
        self.segments = [x for x in self.segments if not self.nodes[x[0]].dropped]

    def count(self) -> None:
        """Scores of the containers."""
        for at, _, score in self.segments:
            first = True
            for node in map(self.nodes.__getitem__, self.above(at)):
                if node.tag in CONTAINERS or node.parent < 0:
                    score *= 1 if first else DECAY
                    node.score += score
                    first = False
        for node in self.nodes:
            if node.tag in ("article", "main"):
                node.score *= 1.5
            elif node.tag in ("", "body"):
                node.score *= DECAY


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(source):
        value = m[2] or ""
        out.setdefault(m[1].lower(), entities.unescape(value[1:-1] if value[:1] in ("'", '"') else value))
    return out


def parse(source: str) -> Page:
    """Blocks and scored containers.  Never fails: what is no mark-up is text, open elements
    end with the page, end tags without a start are ignored."""
    page = Page([Node("", "", -1, False, False)])
    stack, pieces, linked, suspects = [0], [], [0, False], []

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        links, linked[0] = linked[0], 0
        if not text:
            return
        page.segments.append((stack[-1], text, max(0, len(text) - 2 * links)))

    def say(text: str) -> None:
        if not page.nodes[stack[-1]].dropped:
            text = entities.unescape(text)
            pieces.append(text)
            if linked[1]:
                linked[0] += len(text)

    def close(down_to: int) -> None:
        while len(stack) > down_to:
            page.nodes[stack.pop()].end = len(page.nodes) - 1

    at = 0
    while (m := TAG.search(source, at)) is not None:
        bad = source.find("<", at, m.start())
        if bad >= 0 and (loose := LOOSE_TAG.match(source, bad)):  # a quote that never ends
            m = loose
        if m.start() > at:
            say(source[at:m.start()])
        at = m.end()
        if m.lastindex is None:
            continue
        tag, ends = m[2].lower(), bool(m[1])
        if tag == "a":
            linked[1] = not ends
        if tag == "br":
            pieces.append(" ")
        if tag in RAW and not ends:
            stop = re.compile(rf"</{re.escape(tag)}(?![^\s/>])[^>]*>", re.I).search(source, at)
            at = stop.end() if stop else len(source)
            continue
        drops = tag in DROPPED
        if tag not in BLOCKS and not drops:
            continue
        flush()
        open_tags = [page.nodes[i].tag for i in stack]
        if ends:
            if tag in open_tags:
                close(len(open_tags) - 1 - open_tags[::-1].index(tag))
            continue
        if tag in VOID:
            continue
        if tag in CLOSED_BY:
            closes, limits = CLOSED_BY[tag]
            for k in range(len(stack) - 1, 0, -1):
                if open_tags[k] in limits:
                    break
                if open_tags[k] in closes.split():
                    close(k)
        elif page.nodes[stack[-1]].tag == "p":
            close(len(stack) - 1)
        given, parent = attributes(m[3]), page.nodes[stack[-1]]
        names = sorted(given.get("class", "").lower().split())
        words = [set(re.findall("[a-z]+", n)) for n in [*names, given.get("id", "").lower()]]
        inside = parent.inside or tag in ("article", "main")
        drops = (parent.dropped or drops or given.get("role", "").lower() in DROPPED_ROLES
                 or tag == "header" and not inside)
        if not drops and tag not in ("html", "body", "main", "header"):
            drops = any(w and w <= DROPPED_WORDS for w in words)
            if not drops and any(w & DROPPED_WORDS for w in words):
                suspects.append(len(page.nodes))
        step = ".".join([tag, *(re.sub(r"\d+", "#", n) for n in names)])
        page.nodes.append(Node(tag, f"{parent.path}/{step}", stack[-1], drops, inside))
        stack.append(len(page.nodes) - 1)
    say(UNFINISHED.sub("", source[at:]))
    flush()
    close(0)
    if suspects:
        page.drop_suspects(suspects)
    page.count()
    return page


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def winning_paths(df: DataFrame, url: str, html: str) -> DataFrame:
    """Per host: its winning paths, most votes first (ties: higher score, smaller path)."""
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, scores = [], []
            for source in batch.column(1).to_pylist():
                page = parse(source or "")
                best = page.nodes[page.best()]
                paths.append(best.path if best.score > 0 else None)
                scores.append(round(best.score))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(paths, pa.string()), pa.array(scores, pa.int64())],
                ["host", "path", "score"])

    votes = (df.select(host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").alias("html"))
             .mapInArrow(vote, "host string, path string, score long").filter("path is not null")
             .groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("score").alias("score")))
    all_votes = keep_table(votes, "votes")
    total = all_votes.groupBy("host").agg(F.sum("votes").alias("all"))
    return (all_votes.join(total, "host").filter(F.col("votes") >= WINNING_SHARE * F.col("all"))
            .groupBy("host").agg(F.array_sort(F.collect_list(F.struct(
                (-F.col("votes")).alias("v"), (-F.col("score")).alias("s"), "path"))).alias("ranked"))
            .select(F.col("host").alias("_host"), F.col("ranked.path").alias("_paths")))


def extract_text(df: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: page, url, text, n_chars.

    Null and empty pages, and pages without text, have an empty text; a null url is a page of
    the host "".  Rows are extracted one by one, repeated rows stay; other columns are not
    read; an empty table gives an empty result.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    winners = keep_table(winning_paths(df, url, html), "paths")
    rows = df.select(F.col(f"`{page}`").alias("_page"), F.col(f"`{url}`").alias("_url"),
                     F.col(f"`{html}`").alias("_html"), host_of(F.col(f"`{url}`")).alias("_host"))
    joined = lookup_join(rows, winners, ["_host"], salt_on=["_page", "_url"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source, paths in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                parsed = parse(source or "")
                chosen = next((n for p in paths or [] if (n := parsed.with_path(p)) is not None), None)
                texts.append(parsed.text(parsed.best() if chosen is None else chosen))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], [page, url, "text", "n_chars"])

    return joined.select("_page", "_url", "_html", "_paths").mapInArrow(
        run, f"`{page}` {kinds[page]}, `{url}` {kinds[url]}, text string, n_chars long")
