"""Quality score by a sparse ensemble of rules.

Shallow trees over text statistics are grown on a bounded sample of labelled
rows.  Every path from a root to a node is a conjunctive rule.  A logistic
regression with a lasso penalty weighs the rules, and those it keeps become
one Spark column expression that scores the whole table.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.components import cut, settle
from meterflow.llm.kernel import pieces
from meterflow.llm.language_id import held_out
from meterflow.llm.text_stats import QUALITY, quality_stats

#: At most so many labelled rows are learned from, those with the smallest hash of their id.
SAMPLE = 20_000
TREES, DEPTH, LASSO = 24, 3, 0.002


def with_stats(docs: DataFrame, names: list[str], stats) -> DataFrame:
    """Columns ``doc_id`` and ``names`` of every row, from the whole text."""
    def run(batches):
        for b in (piece for whole in batches for piece in pieces(whole)):
            s = stats(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(np.asarray(s[c], np.float64)) for c in names)], ["doc_id", *names])
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} double" for c in names))


def labelled_sample(labels: DataFrame, name: str, parts: int, rest: int, size: int = SAMPLE) -> DataFrame:
    """Up to ``size`` rows (``doc_id``, ``label``) that are not held out, as a small cut table.

    Null ids and labels are left out; an id with several labels has the largest.
    """
    rows = (labels.where(f"doc_id IS NOT NULL AND {name} IS NOT NULL").where(~held_out("doc_id", parts, rest))
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(name).cast("double")).alias("label")))
    return cut(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size))


def _paths(debug: str, names: list[str]) -> set[tuple]:
    """Conjunctions on the way to every node of the trees; a condition is (column, operator, bound)."""
    rules, path = set(), []
    for line in debug.splitlines():
        depth = (len(line) - len(line.lstrip())) // 1
        m = re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) ([-+\dEe.]+)\)", line)
        if m:
            path = [p for p in path if p[0] < depth]
            path.append((depth, (names[int(m[1])], m[2], float(m[3]))))
            rules.add(_tight(c for _, c in path))
    return rules


def _tight(conditions) -> tuple:
    """One bound for each column and operator, in a fixed order."""
    bound: dict = {}
    for c, op, x in conditions:
        bound[c, op] = x if (c, op) not in bound else min(x, bound[c, op]) if op == "<=" else max(x, bound[c, op])
    return tuple(sorted((c, op, x) for (c, op), x in bound.items()))


def rule_column(rule: tuple) -> Column:
    """A rule as a 0/1 column."""
    ok = F.lit(True)
    for c, op, x in rule:
        ok = ok & (F.col(c) <= x if op == "<=" else F.col(c) > x)
    return ok.cast("double")


class RuleEnsemble:
    """``weights``: rule to weight; ``intercept``; ``score()`` is a Spark column."""

    def __init__(self, weights: dict[tuple, float], intercept: float):
        self.weights, self.intercept = weights, intercept

    def score(self) -> Column:
        z = F.lit(self.intercept)
        for rule, w in self.weights.items():
            z = z + rule_column(rule) * w
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit_rules(rows: DataFrame, names: list[str], trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> RuleEnsemble:
    """Learn from ``rows`` (``label`` 0/1 and ``names``).

    With no rows, or one label only, the score is that label's rate (0.5 for none).
    """
    n = rows.agg(F.count("*").alias("n"), F.sum("label").alias("p")).first()
    if not n["n"] or n["p"] in (0, n["n"]):
        rate = min(max((n["p"] or 0) / n["n"], 0.001), 0.999) if n["n"] else 0.5
        return RuleEnsemble({}, float(np.log(rate / (1 - rate))))
    data = VectorAssembler(inputCols=names, outputCol="features").transform(rows).select("features", "label", *names).coalesce(4).persist()
    # both labels weigh the same while trees look for rules
    share = n["p"] / n["n"]
    data = data.withColumn("w", F.when(F.col("label") > 0, 0.5 / share).otherwise(0.5 / (1 - share)))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, weightCol="w", maxBins=64, minInstancesPerNode=5).fit(data)
    rules = sorted(set().union(*(_paths(t.toDebugString, names) for t in forest.trees)), key=lambda r: (len(r), r))  # at most trees x 2 x (2**depth - 1)
    if not rules:
        return RuleEnsemble({}, float(np.log(share / (1 - share))))
    bits = data.select("label", *(rule_column(r).alias(f"r{i}") for i, r in enumerate(rules)))
    bits = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="rules").transform(bits).select("label", "rules").persist()
    fit = LogisticRegression(featuresCol="rules", elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=False).fit(bits)
    bits.unpersist()
    data.unpersist()
    kept = {r: float(w) for r, w in zip(rules, fit.coefficients.toArray()) if abs(w) > 1e-6}
    return RuleEnsemble(kept, float(fit.intercept))


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    Null and empty texts have zero statistics and a score like any other; a
    null id is never learned from and not held out.  Repeated rows stay
    repeated; other columns are ignored; an empty table gives an empty result.
    """
    stats = settle(with_stats(docs, QUALITY, quality_stats), "quality")
    chosen = labelled_sample(labels, "quality", 3, 1, sample)
    model = fit_rules(stats.join(F.broadcast(chosen), "doc_id"), QUALITY)
    out = stats.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), model.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
