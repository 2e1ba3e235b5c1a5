"""Quality classifier: a sparse rule ensemble over text statistics.

Trees of a random forest are cut into their paths; each path is a conjunctive rule over the
statistics (``share of capitals > 0.3 and words per line <= 2``).  A lasso logistic
regression weighs the rules and leaves most of them out.  The others are compiled into one
Spark column expression, so scoring a corpus is a projection without Python.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from comarca.llm.common import keep_table

#: Labelled rows used to fit; more are thinned out by the hash of their id.
MAX_TRAINING_ROWS = 20_000
TREES, DEPTH, LASSO, SEED = 24, 4, 0.002, 7
THRESHOLD = 0.3

# Frequent function words of the languages, and word lists of doubtful pages.
FUNCTION_WORDS = r"(?i)\b(?:the|of|and|to|in|that|is|was|for|on|are|with|it|this|be|from|" \
    r"le|la|les|de|des|et|un|une|du|en|que|qui|dans|pour|par|sur|" \
    r"der|die|das|und|den|von|zu|mit|ist|nicht|ein|eine|dem|sich|" \
    r"el|los|las|con|por|una|se|del|no)\b"


def statistics(text: Column) -> dict[str, Column]:
    """Numbers about a text, each computed from the whole text; 0 for an empty one."""
    text = F.coalesce(text, F.lit(""))
    chars = F.char_length(text).cast("double")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, r"\n"), lambda x: F.trim(x) != "")

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / F.greatest(chars, F.lit(1.0))

    n_words = F.size(words).cast("double")
    n_lines = F.size(lines).cast("double")
    per_word = F.greatest(n_words, F.lit(1.0))
    return {
        "chars": chars,
        "words": n_words,
        "word_length": chars / per_word,
        "capitals": share(r"\p{Lu}"),
        "letters": share(r"\p{L}"),
        "digits": share(r"[0-9]"),
        "symbols": share(r"[^\p{L}\p{N}\s.,;:'\"()-]"),
        "pipes": share(r"[|]"),
        "bangs": share(r"!"),
        "stops": share(r"[.]"),
        "commas": share(r","),
        "braces": share(r"[{}\[\]<>=\\/_]"),
        "runs": share(r"([^\p{L}\p{N}\s])\1\1"),
        "words_in_capitals": F.regexp_count(text, F.lit(r"\p{Lu}{3,}")) / per_word,
        "function_words": F.regexp_count(text, F.lit(FUNCTION_WORDS)) / per_word,
        "distinct_words": F.size(F.array_distinct(words)) / per_word,
        "words_per_line": n_words / F.greatest(n_lines, F.lit(1.0)),
        "repeated_lines": 1 - F.size(F.array_distinct(lines)) / F.greatest(n_lines, F.lit(1.0)),
        "links": F.regexp_count(text, F.lit(r"://|www\.|@")) / per_word,
    }


def with_statistics(df: DataFrame, text: str) -> tuple[DataFrame, list[str]]:
    """``df`` with the statistics as columns ``stat_...``."""
    made = {f"stat_{k}": v for k, v in statistics(F.col(f"`{text}`")).items()}
    return df.withColumns(made), list(made)


@dataclass(frozen=True)
class Rule:
    """Bounds (low, high] of statistics that hold together."""
    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, low, high in self.bounds:
            if low > -math.inf:
                out = out & (F.col(name) > low)
            if high < math.inf:
                out = out & (F.col(name) <= high)
        return out.cast("double")


SPLIT = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def paths_of(tree: str, names: list[str]) -> set[Rule]:
    """Rules of a tree from its printed form: the path to every node below the root."""
    rules, stack = set(), []  # of (depth, name, sign, bound)
    for line in tree.splitlines():
        m = SPLIT.match(line)
        if m is None:
            continue
        depth = len(m[1])
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, names[int(m[3])], m[4], float(m[5])))
        held: dict[str, tuple[float, float]] = {}
        for _, name, sign, bound in stack:
            low, high = held.get(name, (-math.inf, math.inf))
            held[name] = (low, min(high, bound)) if sign == "<=" else (max(low, bound), high)
        rules.add(Rule(tuple((n, *held[n]) for n in sorted(held))))
    return rules


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    weighted: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1 from the columns ``stat_...``."""
        total = F.lit(self.intercept)
        for rule, weight in self.weighted:
            total = total + rule.column() * F.lit(weight)
        return 1 / (1 + F.exp(-total))


def training_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                  label: str = "quality", bound: int = MAX_TRAINING_ROWS) -> DataFrame:
    """Statistics and label of at most ``bound`` labelled rows, never of held-out ones.

    Labels other than 0 and 1 are left out, of a repeated key the smallest label counts.
    The labels that take part are bounded, so they are broadcast.
    """
    chosen = (labels.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").cast("int").alias("_label"))
              .filter(F.col("_label").isin(0, 1) & F.col("_key").isNotNull() & ~held_out(F.col("_key")))
              .orderBy(F.xxhash64("_key"), "_key", "_label").limit(bound)
              .groupBy("_key").agg(F.min("_label").alias("_label")))
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    rows, names = with_statistics(rows.join(F.broadcast(chosen), "_key"), "_text")
    return rows.select("_key", F.col("_label").cast("double").alias("label"), *names)


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 5 == 0


def fit_rules(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO,
              seed: int = SEED) -> RuleEnsemble:
    """Ensemble from rows with ``label`` and ``stat_...`` columns.

    Without rows every score is 0.5; with labels of one kind only it is their smoothed share.
    """
    rows = keep_table(rows.repartition(4, "_key").sortWithinPartitions("_key"), "training")
    n, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if ones in (0, n):
        return RuleEnsemble(math.log((ones + 1) / (n - ones + 1)), ())
    names = [c for c in rows.columns if c.startswith("stat_")]
    points = VectorAssembler(inputCols=names, outputCol="features").transform(rows).select("label", "features", *names)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=5,
                                    featureSubsetStrategy="onethird").fit(points)
    rules = sorted(set().union(*(paths_of(t.toDebugString, names) for t in forest.trees)),
                   key=lambda r: r.bounds)
    if not rules:
        return RuleEnsemble(math.log((ones + 1) / (n - ones + 1)), ())
    held = keep_table(points.select("label", F.array(*[r.column() for r in rules]).alias("held")), "rules")
    held = held.select("label", array_to_vector("held").alias("features"))
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60,
                               standardization=False).fit(held)
    weights = model.coefficients.toArray()
    return RuleEnsemble(float(model.intercept),
                        tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        bound: int = MAX_TRAINING_ROWS) -> RuleEnsemble:
    return fit_rules(training_rows(docs, labels, key, text, label, bound))


def score_documents(df: DataFrame, ensemble: RuleEnsemble, key: str = "doc_id", text: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """Per row: key, held_out, score, predicted.

    Null texts count as empty; a null key is not held out; repeated rows each get their row;
    other columns are not read; an empty table gives an empty result.
    """
    rows, _ = with_statistics(df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("_text")), "_text")
    scored = rows.select(key, F.coalesce(held_out(F.col(key)), F.lit(False)).alias("held_out"),
                         ensemble.score().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def keep_good(df: DataFrame, ensemble: RuleEnsemble, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``df`` with a score of at least ``threshold``, all their columns unchanged."""
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_whole"), F.col(f"`{text}`").alias("_text"))
    rows, _ = with_statistics(whole, "_text")
    return rows.filter(ensemble.score() >= threshold).select("_whole.*")
