from __future__ import annotations

import random

import pytest

from martflow.llm import toxic_grammar as X
from martflow.llm.queries import QUERIES
from tests.conftest import need_testdata

SF = "/root/testdata/sf0.01"


def clauses(text, lexicon=("idiot", "trash")):
    g = X.Grammar(dict.fromkeys(lexicon, 2.0))
    return [(X.PATTERN_NAMES[p], w) for p, w in g.clauses(text, X.composed(), g.symbols())]


@pytest.mark.parametrize("text, want", [
    ("what an idiot.", [("insult", 2.0)]),
    ("You are an idiot, trash!", [("aimed insult", 4.0)]),
    ("it is not trash.", [("negated", 2.0)]),
    ("not one two three four trash.", [("insult", 2.0)]),
    ("she said idiot. fine", [("reported", 2.0)]),
    ("idiot, she said", [("insult", 2.0)]),
    ("they kill you; you will burn", [("threat", 1.0), ("threat", 1.0)]),
    ("you. idiot", [("insult", 2.0)]),
    ("I will kill you.", [("threat", 1.0)]), ("kill the process", []), ("kill the process. you", []),
    ("an idiot like you", [("aimed insult", 2.0)]), ("an idiot; you", [("insult", 2.0)]),
    ('"idiot", he said', [("reported", 2.0)]), ('“What an idiot! Trash!” she wrote.', [("reported", 4.0)]),
    ('"hello", he said, idiot', [("reported", 2.0)]), ('idiot, "hello", he said', [("insult", 2.0)]),
    ("an idiot, she thinks", [("aimed insult", 2.0)]), ("the idiot and she", [("aimed insult", 2.0)]),
    ('"I will kill you", they said', [("reported", 1.0)]), ('you "idiot', [("aimed insult", 2.0)]),
    ("he said: you idiot. you trash", [("reported", 2.0), ("aimed insult", 2.0)]),
    ("note: idiot", [("insult", 2.0)]), ("not: idiot", [("insult", 2.0)]),
    ('an open " quote. idiot\nsaid trash', [("insult", 2.0), ("reported", 2.0)]),
    ("no match here", []), ("", []), ("idiot\ntrash", [("insult", 2.0), ("insult", 2.0)]),
])
def test_grammar(text, want):
    assert clauses(text) == want


def test_composition_equals_running_the_transducers_in_turn():
    steps, table = (X.negation, X.report, X.target, X.verdict), X.composed()
    rng = random.Random(1)
    for _ in range(300):
        states, state = [0] * 4, 0
        for symbol in rng.choices(X.SYMBOLS, k=30):
            passed = symbol
            for i, step in enumerate(steps):
                states[i], passed = step(states[i], passed)
            state, said = table[state, symbol]
            assert said == passed


def test_an_aim_never_lowers_a_score(spark):
    rows = [(i, f"word{i % 7} idiot{' you' if i % 10 == 0 else ''} end") for i in range(60)]  # aimed ones are clean here
    rows += [(100 + i, f"word{i % 7} fine end") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100 and i % 10 != 0)) for i, _ in rows], "doc_id long, toxic int")
    grammar = X.fit(docs, labels, X.F.lit(True))
    assert "idiot" in grammar.lexicon and min(grammar.weights[:3]) >= 0
    tests = spark.createDataFrame([(1, "some idiot."), (2, "some idiot you."), (3, "kill you idiot.")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in X.score(tests, grammar).collect()}
    assert got[1] <= got[2] <= got[3]


def test_held_out_accuracy(spark):
    need_testdata()
    got = QUERIES["op5_toxic_grammar"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    held = [r for r in got.join(labels, "doc_id").collect() if r.held_out]
    assert len(held) > 500 and sum(r.predicted == r.toxic for r in held) / len(held) > 0.97
    toxic = [r for r in held if r.toxic]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.85


@pytest.mark.parametrize("labelled", [[], [(1, 1)], [(99, 1), (None, 0), (1, None)], [(1, 1), (2, 0)]])
def test_few_labels_and_odd_rows(spark, labelled):
    docs = spark.createDataFrame([(1, "a b", 1), (2, None, 1), (2, None, 1), (None, "", 1), (3, "w " * 100_000, 1)],
                                 "doc_id long, text string, features int")
    labels = spark.createDataFrame(labelled, "doc_id long, toxic int")
    rows = X.toxic_scores(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert X.toxic_scores(docs.limit(0), labels).count() == 0
