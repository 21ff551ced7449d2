"""Quality classifier: a sparse ensemble of rules over text statistics.

A forest of shallow trees is grown on statistics of labelled texts; every path
of it is a rule, a conjunction of thresholds. A logistic regression with lasso
weights keeps few rules. The kept rules and weights become one Spark column
expression over the statistics, so scoring fits no model object to the rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import eq

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import free_name, query, stored, table, text_of

TRAINING_ROWS = 20_000  # bound of the labelled rows that are learned from
TREES, DEPTH = 12, 3
LASSO = 0.002
THRESHOLD = 0.3

STATISTICS = ("words", "word_length", "upper", "letters", "marks", "symbols", "digits", "distinct", "top_word", "repeated", "bars",
              "shouts", "odd_ends", "lines", "line_words", "same_lines", "closed_lines", "short_words", "capital_words")
_ENDS = re.compile(r"[^\s.,;:!?\"')\w](?=\s|\Z)")
_CAPITAL = re.compile(r"(?:^|\s)[^\W\d_](?=[^\W\d_]*[a-zß-ÿ])")


def statistics_of(text: str) -> tuple[float, ...]:
    """The statistics of one whole text, in the order of ``STATISTICS``; shares are of words, characters or lines."""
    words = text.split()
    n = max(len(words), 1)
    raw = text.encode("utf-8", "surrogatepass")
    size = max(len(raw), 1)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower, other = int(count[65:91].sum()), int(count[97:123].sum()), int(count[128:].sum())
    marks = int(count[[33, 44, 46, 58, 59, 63]].sum())
    digits = int(count[48:58].sum())
    symbols = int(count[33:127].sum()) - upper - lower - marks - digits
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x]
    m = max(len(lines), 1)
    letters = upper + lower + other
    closed = sum(x.rstrip()[-1:] in (".", "!", "?", ":", "\"") for x in lines)
    return (float(len(words)), sum(map(len, words)) / n, upper / max(upper + lower, 1), letters / size, marks / size, symbols / size,
            digits / size, len(seen) / n, max(seen.values(), default=0) / n, sum(map(eq, words, words[1:])) / n, int(count[124]) / n,
            int(count[33]) / n, len(_ENDS.findall(text)) / n, float(len(lines)), len(words) / m, 1 - len(set(lines)) / m, closed / m,
            sum(1 for w in words if len(w) <= 3) / n, sum(1 for w in seen if w[:1].isupper()) / max(len(seen), 1))


def statistics(text: Column) -> Column:
    """struct of the statistics of a whole text."""

    @F.pandas_udf(", ".join(f"{s} double" for s in STATISTICS))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([statistics_of(t) for t in texts], columns=list(STATISTICS), dtype=float)

    return run(text)


Rule = tuple[tuple[str, bool, float], ...]  # (statistic, is it above?, threshold)


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, stats: Column) -> Column:
        """Probability of label 1 as a column expression over the struct of statistics."""
        margin = reduce(lambda a, b: a + b, [F.when(holds(r, stats), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.weights],
                        F.lit(self.intercept))
        return 1.0 / (1.0 + F.exp(-margin))


def holds(rule: Rule, stats: Column) -> Column:
    tests = [stats[s] > t if above else stats[s] <= t for s, above, t in rule]
    return reduce(lambda a, b: a & b, tests)


def simplified(rule: Rule) -> Rule:
    """One bound of each kind for every statistic, in a fixed order."""
    bounds: dict[tuple[str, bool], float] = {}
    for s, above, t in rule:
        old = bounds.get((s, above), t)
        bounds[s, above] = max(old, t) if above else min(old, t)
    return tuple(sorted((s, above, t) for (s, above), t in bounds.items()))


def tree_paths(root) -> list[Rule]:
    """The path to every node below the root."""
    out: list[Rule] = []

    def walk(node, path: Rule) -> None:
        if path:
            out.append(simplified(path))
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        s, t = STATISTICS[split.featureIndex()], float(split.threshold())
        walk(node.leftChild(), (*path, (s, False, t)))
        walk(node.rightChild(), (*path, (s, True, t)))

    walk(root, ())
    return out


def held_out(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def fit_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
              rows: int = TRAINING_ROWS) -> RuleModel:
    """Fit on at most ``rows`` labelled texts, chosen by a hash of their ids; held-out ids are never used.

    Without labels, or with one label only, the model is a constant.
    """
    chosen = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
              .select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("label"))
              .orderBy(F.xxhash64("_id"), "_id", "label").limit(rows))
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    # at most ``rows`` pairs of numbers are sent to the tasks
    known = texts.join(F.broadcast(chosen), "_id").select("label", statistics(F.col("_text")).alias("s"))
    known = stored(known.select("label", "s.*"), "training")
    n, ones = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or ones in (0.0, float(n)):
        share = 0.5 if not n else min(max(ones / n, 0.01), 0.99)
        return RuleModel(float(np.log(share / (1 - share))), ())
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=5, featureSubsetStrategy="onethird", minInstancesPerNode=5)
    grown = forest.fit(VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(known))
    rules = sorted({r for t in grown.trees for r in tree_paths(t._call_java("rootNode"))})
    if not rules:
        return RuleModel(float(np.log(ones / (n - ones))), ())
    stats = F.struct(*STATISTICS)
    facts = known.select("label", *[F.when(holds(r, stats), 1.0).otherwise(0.0).alias(f"r{k}") for k, r in enumerate(rules)])
    facts = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="features").transform(facts)
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60).fit(facts.select("label", "features"))
    weights = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w]
    return RuleModel(float(lasso.intercept), tuple(weights))


def with_scores(docs: DataFrame, model: RuleModel, text_col: str = "text") -> DataFrame:
    """The rows with ``score`` (replaced if there is one); null text counts as empty, and empty texts have a score too.

    Rows repeat as they are; an empty table gives an empty result.
    """
    kept, own = [c for c in docs.columns if c != "score"], free_name(docs, "_s")
    scored = docs.select(*kept, statistics(text_of(text_col)).alias(own))
    return scored.select(*kept, model.score(F.col(own)).alias("score"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose score reaches ``THRESHOLD``, with all their columns."""
    model = fit_rules(docs, labels, id_col, text_col)
    own = free_name(docs, "_s")
    return docs.withColumn(own, statistics(text_of(text_col))).where(model.score(F.col(own)) >= THRESHOLD).select(*docs.columns)


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_rules(docs, table(spark, sf_dir, "labels"))
    return with_scores(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
