"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a host (it covers its subdomains) and a path that the url's path must start
with; ``*`` in the path stands for any characters.  Every rule is filed under the one of
its literal tokens that is rarest in all urls; the tokens of a url fetch the rules filed
under them, and only these run their regular expression.  Of the rules that fit, the
longest wins (ties: the smaller text).

All of it is DataFrame code.  The index is a hash table in a literal array, so a url is
judged inside one projection: no row is multiplied and no page is shuffled, whatever
columns it carries.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules in one literal table; a longer book is looked up in several tables of this size.
RULES_PER_TABLE = 20_000
#: Fixed value: what separates tokens (for Spark's regular expressions).
SPLIT = r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str  # starts with "/"
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        path = ".*".join(re.escape(x) for x in self.path.split("*"))
        return rf"(?s)^([^/]*\.)?{re.escape(self.host)}{path}"

    def tokens(self) -> list[str]:
        """Tokens that every fitting url has as a whole: those with a delimiter at either side."""
        found = ["h:" + x for x in re.split(r"[^0-9A-Za-z\u0080-\U0010FFFF]+", self.host) if x]
        for x in re.finditer(r"(?<=[^0-9A-Za-z\u0080-\U0010FFFF*])[0-9A-Za-z\u0080-\U0010FFFF]+"
                             r"(?=[^0-9A-Za-z\u0080-\U0010FFFF*])", self.path):
            found.append("p:" + x.group())
        return found


#: The rules of the registered query.
RULES = (
    Rule("org", "/", True),
    Rule("example.org", "/es/", False),
    Rule("example.org", "/en/1", False),
    Rule("com", "/fr/", True),
    Rule("com", "/de/", False),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    def marked(text: Column, mark: str) -> Column:
        return F.transform(F.filter(F.split(text, SPLIT), lambda x: x != ""),
                           lambda x: F.concat(F.lit(mark), x))
    return F.array_distinct(F.concat(marked(host, "h:"), marked(path, "p:")))


def token_counts(df: DataFrame, host: Column, path: Column, rules: tuple[Rule, ...]) -> dict[str, int]:
    """In how many urls of ``df`` each token of a rule stands: one entry per such token at most."""
    terms = sorted({t for r in rules for t in r.tokens()})
    if not terms:
        return {}
    wanted = F.broadcast(df.sparkSession.createDataFrame([(t,) for t in terms], "token string"))
    counted = (df.select(F.explode(url_tokens(host, path)).alias("token")).join(wanted, "token")
               .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    return {r.token: r.n for r in counted.collect()}


def literal_index(rules: list[tuple[int, Rule]], counts: dict[str, int]) -> Column:
    """Array of buckets of entries (token, order, pattern, rule, action); a token's bucket is
    its CRC-32 modulo the number of buckets.  A rule without a literal token is filed under
    the empty token, which every url has."""
    buckets: list[list[dict]] = [[] for _ in range(2 * len(rules) + 1)]
    for order, rule in rules:
        token = min(rule.tokens(), key=lambda t: (counts.get(t, 0), t), default="")
        buckets[zlib.crc32(token.encode()) % len(buckets)].append({
            "token": token, "order": order, "pattern": rule.pattern, "rule": rule.text,
            "action": "allow" if rule.allow else "block"})
    entry = "struct<token:string,order:int,pattern:string,rule:string,action:string>"
    return F.from_json(F.lit(json.dumps(buckets)), f"array<array<{entry}>>")


def judge_urls(df: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES,
               default: str = "allow") -> DataFrame:
    """``df`` with host, path, rule and verdict added.

    Null urls and urls without ``://`` have an empty host and path, no rule and the default
    verdict.  Rows are judged one by one, so repeated rows stay; an empty table gives an empty
    result.  Columns named host, path, rule or verdict are replaced, all others kept.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    host, path = host_of(F.col(f"`{url}`")), path_of(F.col(f"`{url}`"))
    counts = token_counts(df, host, path, rules)
    ordered = list(enumerate(sorted(set(rules), key=lambda r: (-len(r.text), r.text, not r.allow))))
    tables = [literal_index(ordered[i:i + RULES_PER_TABLE], counts)
              for i in range(0, len(ordered), RULES_PER_TABLE)]
    tokens = F.concat(F.array(F.lit("")), url_tokens(host, path))

    def filed(index: Column) -> Column:
        def candidates(token: Column) -> Column:
            bucket = F.pmod(F.crc32(token), F.size(index)).cast("int")
            return F.filter(F.get(index, bucket), lambda e: e["token"] == token)
        return F.flatten(F.transform(tokens, candidates))

    address = F.concat(host, path)
    fitting = [F.filter(filed(t), lambda e: F.rlike(address, e["pattern"])) for t in tables]
    best = F.array_min(F.transform(F.concat(*fitting), lambda e: F.struct(
        e["order"].alias("order"), e["rule"].alias("rule"), e["action"].alias("action")))) \
        if fitting else F.lit(None).cast("struct<order:int,rule:string,action:string>")
    return (df.select(*kept, host.alias("host"), path.alias("path"), best.alias("_best"))
            .select(*kept, "host", "path", F.col("_best.rule").alias("rule"),
                    F.coalesce("_best.action", F.lit(default)).alias("verdict")))
