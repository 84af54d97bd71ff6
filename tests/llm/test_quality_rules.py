from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from martflow.llm import quality_rules as Q
from martflow.llm.common import bucket_of
from martflow.llm.queries import QUERIES
from tests.conftest import need_testdata

SF = "/root/testdata/sf0.01"


def corpus(spark, n=240):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        words = [rng.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(rng.randint(8, 40))]
        good = i % 3 > 0
        text = " ".join(w if good else w.upper() + "!!" for w in words) + "."
        rows.append((i, text, int(good)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id long, quality int, toxic int")
    return docs, labels


def test_tree_rules_reads_paths():
    text = """RandomForestClassificationModel: numTrees=1
  Tree 0 (weight 1.0):
    If (feature 2 <= 1.5)
     If (feature 0 <= 7.0)
      Predict: 0.0
     Else (feature 0 > 7.0)
      Predict: 1.0
    Else (feature 2 > 1.5)
     Predict: 1.0
"""
    assert Q.tree_rules(text) == {((2, True, 1.5),), ((0, True, 7.0), (2, True, 1.5)), ((0, False, 7.0), (2, True, 1.5)),
                                  ((2, False, 1.5),)}


def test_learns_and_filters(spark):
    docs, labels = corpus(spark)
    model = Q.fit(docs, labels, F.lit(True))
    assert 0 < len(model.rules) < 60
    got = {r.doc_id: r.score for r in Q.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == (i % 3 > 0) for i in got)
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 160


def test_held_out_accuracy(spark):
    need_testdata()
    got = QUERIES["op3_quality_rules"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = got.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 100 and sum(r.predicted == r.quality for r in held) / len(held) > 0.97
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    fold = {r.doc_id: r.f for r in got.select("doc_id", bucket_of("doc_id", 3).alias("f")).collect()}
    assert all(r.held_out == (fold[r.doc_id] == 1) for r in rows)


@pytest.mark.parametrize("labelled", [[], [(1, 1)], [(1, 1), (2, 0)], [(99, 1), (None, 0), (1, None), (2, 7)]])
def test_few_labels(spark, labelled):
    docs, _ = corpus(spark, 6)
    labels = spark.createDataFrame(labelled, "doc_id long, quality int")
    scores = [r.score for r in Q.quality_scores(docs, labels).collect()]
    assert len(scores) == 6 and all(0 <= s <= 1 for s in scores)


def test_odd_rows(spark):
    docs, labels = corpus(spark, 60)
    odd = spark.createDataFrame(
        [(None, "alpha beta", 1, "x", 2.0), (500, None, 1, "x", 2.0), (500, None, 1, "x", 2.0), (501, "", 1, "x", 2.0),
         (502, "y" * 300_000, 1, "x", 2.0)], "doc_id long, text string, score int, `stat.x` string, label double")
    model = Q.fit(docs, labels, F.lit(True))
    got = Q.score(odd, model, into="quality_score")
    assert got.columns == [*odd.columns, "quality_score"]
    rows = got.collect()
    assert len(rows) == 5 and all(0 <= r.quality_score <= 1 for r in rows)
    assert rows[1].quality_score == rows[2].quality_score == rows[3].quality_score
    assert [r.held_out for r in Q.quality_scores(odd, labels).filter("doc_id IS NULL").collect()] == [False]
    assert Q.score(odd.limit(0), model, into="s").count() == 0
    assert Q.keep_good(odd.limit(0), labels).count() == 0
    both = Q.keep_good(odd, labels)
    assert both.columns == odd.columns
