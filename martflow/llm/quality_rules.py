"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Shallow random trees are grown on labelled statistics; every path from a root
to a node is a rule, a conjunction of thresholds.  A logistic model with a
lasso penalty weighs the rules, most of which end at zero.  What is left is
compiled into one Spark column, so scoring is a projection of the text scan:
no shuffle, no Python.
"""
from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket_of, materialize, text_of

FIT_ROWS = 20_000  # labelled rows that a fit uses at most
TREES, DEPTH, LASSO, SEED = 24, 3, 0.002, 7
Condition = tuple[int, bool, float]  # statistic, is it "<=", threshold


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text, all finite; those of the empty text are 0."""
    def per(part: Column, whole: Column) -> Column:
        return part.cast("double") / F.greatest(whole, F.lit(1)).cast("double")

    chars, words = F.length(text), F.regexp_count(text, F.lit(r"\S+"))
    lines = F.size(F.split(text, "\n"))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    return {
        "chars": chars.cast("double"),
        "words": words.cast("double"),
        "word_length": per(chars, words),
        "line_length": per(chars, lines),
        "upper": per(count(r"\p{Lu}"), chars),
        "digits": per(count("[0-9]"), chars),
        "symbols": per(count(r"[^\p{L}\p{N}\s.,;:'\"()-]"), words),
        "stops": per(count(r"[.!?](?=\s|$)"), words),
        "repeats": per(count(r"(?<!\S)(\S++)\s\1(?!\S)"), words),
        "distinct_words": per(F.size(F.array_distinct(F.split(text, r"\s+"))), words),
        "distinct_lines": per(F.size(F.array_distinct(F.split(text, "\n"))), lines),
    }


STATISTICS = ("chars", "words", "word_length", "line_length", "upper", "digits", "symbols", "stops", "repeats",
              "distinct_words", "distinct_lines")


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; ``bias`` alone if there was nothing to learn from."""

    bias: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...] = field(default=())

    def score(self, stat: Column) -> Column:
        """The probability of label 1, from a struct of the statistics."""
        total = F.lit(float(self.bias))
        for conditions, weight in self.rules:
            total = total + F.when(holds(conditions, stat), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(conditions: tuple[Condition, ...], stat: Column) -> Column:
    out = F.lit(True)
    for which, low, threshold in conditions:
        value = stat.getField(STATISTICS[which])
        out = out & (value <= threshold if low else value > threshold)
    return out


def tree_rules(described: str) -> set[tuple[Condition, ...]]:
    """Every path below the roots of trees that MLlib has written out, as a
    conjunction with one condition per statistic and direction."""
    found: set[tuple[Condition, ...]] = set()
    path: list[tuple[int, Condition]] = []
    for line in described.splitlines():
        step = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([^)]+)\)", line)
        if not step:
            continue
        depth = len(step[1])
        path = [p for p in path if p[0] < depth]
        path.append((depth, (int(step[2]), step[3] == "<=", float(step[4]))))
        tight: dict[tuple[int, bool], float] = {}
        for _, (which, low, threshold) in path:
            old = tight.get((which, low), threshold)
            tight[which, low] = min(old, threshold) if low else max(old, threshold)
        found.add(tuple(sorted((w, low, t) for (w, low), t in tight.items())))
    return found


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, id_col: str, text_col: str,
                    fit_rows: int) -> DataFrame:
    """``(text, label)`` of about ``fit_rows`` training rows at most, drawn by a
    hash of the id and by nothing else, so the same rows whatever the plan.  The
    drawn ids are the broadcast side, so their number bounds it and no text is
    shuffled; documents are read by as many tasks as any scan of them."""
    given = labels.select(F.col(id_col).alias("label_id"), F.col(label).cast("int").alias("label"))
    given = given.filter(train & F.col("label").isin(0, 1) & F.col("label_id").isNotNull())
    share = min(1.0, fit_rows / max(1, given.count()))
    drawn = given.filter(F.pmod(F.xxhash64("label_id"), F.lit(1_000_003)) < int(share * 1_000_003) + 1)
    drawn = drawn.groupBy("label_id").agg(F.min("label").alias("label"))
    rows = docs.select(F.col(id_col).alias("label_id"), text_of(docs, text_col).alias("text"))
    return rows.join(F.broadcast(drawn), "label_id").select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", fit_rows: int = FIT_ROWS) -> RuleModel:
    """A model of the rows of ``labels`` for which ``train`` (a condition on
    ``label_id``) is true, at most about ``fit_rows`` of them.

    Labels other than 0 and 1 are ignored, as are labels without a document.
    With no usable row the model always gives 0.5; with one class only, its
    smoothed share.
    """
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = labelled_sample(docs, labels, label, train, id_col, text_col, fit_rows)
    sample = materialize(rows.select(F.struct(*[v.alias(k) for k, v in statistics(F.col("text")).items()]).alias("stat"),
                                     F.col("label").cast("double").alias("label")), "quality-sample")
    tally = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    ones, zeros = tally.get(1.0, 0), tally.get(0.0, 0)
    if not ones or not zeros:
        return RuleModel(bias=_logit((ones + 0.5) / (ones + zeros + 1)))
    flat = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(sample.select("stat.*", "label"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, subsamplingRate=0.5, maxBins=64,
                                    minInstancesPerNode=5, seed=SEED).fit(flat)
    rules = sorted(tree_rules(forest.toDebugString))
    if not rules:
        return RuleModel(bias=_logit((ones + 0.5) / (ones + zeros + 1)))
    marks = [F.when(holds(r, F.col("stat")), 1.0).otherwise(0.0).alias(f"r{i}") for i, r in enumerate(rules)]
    matrix = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(
        sample.select("label", *marks)).select("label", "features")
    lasso = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, maxIter=60, standardization=False).fit(
        materialize(matrix, "quality-rules"))
    weights = lasso.coefficients.toArray().tolist()
    return RuleModel(float(lasso.intercept), tuple((r, w) for r, w in zip(rules, weights, strict=True) if w))


def _logit(p: float) -> float:
    import math

    return math.log(p / (1 - p))


def score(docs: DataFrame, model: RuleModel, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with one more column, the score from 0 to 1.  Null text counts as
    the empty text; every row is scored, repeated ones alike."""
    stat = F.struct(*[v.alias(k) for k, v in statistics(text_of(docs, text_col)).items()])
    # the one-element array holds the statistics while all rules read them; as columns, a filter on the score
    # would be pushed below them and compute them again for every condition
    scored = F.element_at(F.transform(F.array(stat), model.score), 1)
    return docs.select("*", scored.alias(into))


def keep_good(docs: DataFrame, labels: DataFrame, train: Column | None = None, label: str = "quality",
              fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows whose score is at least 0.5, with the columns of ``docs``."""
    model = fit(docs, labels, F.lit(True) if train is None else train, label, fit_rows=fit_rows)
    mark = "_" * (1 + max(map(len, docs.columns)))
    return score(docs, model, into=mark).filter(F.col(mark) >= 0.5).drop(mark)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``: labels of rows in fold ``held``
    are not learned from."""
    fold = bucket_of("doc_id", folds) == held
    model = fit(docs, labels, bucket_of("label_id", folds) != held)
    scored = score(docs.select("doc_id", text_of(docs, "text").alias("text")), model)
    return scored.select("doc_id", F.coalesce(fold, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
