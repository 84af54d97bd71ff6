"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer maps words to symbols: insult, threat, target, negation,
reported speech, clause end, line end, colon, quotation mark, or other.  Small transducers for threats, targets,
negation and reported speech each rewrite or pass on the symbols of the one
before; composed into one table they read a text once and give every clause a
pattern (a plain insult, an insult at a target, a threat at a target, a negated
or a reported one).  The clause's score is its lexical weight times the
pattern's learned weight, and a text is scored by its clauses.

The insults and their weights are learned from labels, in any language, by the
log-odds of words in toxic texts; the grammar's word classes are fixed.
"""
from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket_of, materialize, text_of
from .quality_rules import labelled_sample

FIT_ROWS = 20_000  # labelled rows that a fit uses at most
MIN_LOG_ODDS, MIN_EVIDENCE, SCOPE = 2.0, 20.0, 3

# The closed word classes of the grammar.
THREAT = "kill hurt beat smash burn shoot stab punish destroy destroying crush töten schlagen tuer frapper matar golpear".split()
TARGET = ("you your yours u he she him her his they them their we us everyone nobody all du dich dein ihr euch sie tu te "
          "toi ton vous il elle ils eux tú ti vosotros usted él ella ellos").split()
NEGATION = "not no never nothing neither nor isnt dont without nicht kein keine nie ne pas jamais aucun nunca jamás sin".split()
REPORT = ("said says say called calls claims claimed quoted wrote writes reported tells told according sagte sagt schrieb "
          "laut dit disait écrit selon dijo dice escribió según").split()

WORDS = re.compile(r'[^\W_]+|[.!?;:\n|"“”„«»]')
SYMBOLS = 'ITPNRE-L:"'
INSULT_S, THREAT_S, TARGET_S, NEG_S, REPORT_S, END_S, OTHER_S, LINE_S, COLON_S, QUOTE_S = SYMBOLS
BREAKS = (END_S, LINE_S, COLON_S)
#: Rewritten symbols: negated or reported ones, and insults and threats at a target.
PLAIN, AIMED, THREATENED, NEGATED, REPORTED = range(5)
PATTERN_NAMES = ("insult", "aimed insult", "threat", "negated", "reported")
Step = Callable[[int, str], tuple[int, str]]


# ------------------------------------------------------------- transducers
def negation(state: int, symbol: str) -> tuple[int, str]:
    """Insults and threats within ``SCOPE`` words behind a negation become ``n``."""
    if symbol in BREAKS:
        return 0, symbol
    if symbol == NEG_S:
        return SCOPE, OTHER_S
    return max(0, state - 1), "n" if state and symbol in (INSULT_S, THREAT_S) else symbol


def report(state: int, symbol: str) -> tuple[int, str]:
    """Insults and threats behind a word of saying become ``r`` up to the clause's
    end; a colon does not end what is reported.  The words themselves pass on."""
    if symbol in (END_S, LINE_S):
        return 0, symbol
    if symbol == REPORT_S:
        return 1, symbol
    return state, "r" if state and symbol in (INSULT_S, THREAT_S) else symbol


def target(state: int, symbol: str) -> tuple[int, str]:
    """Insults and threats become ``i`` and ``t`` from a target on up to the
    clause's end.  Targets pass on, for what stands before them."""
    if symbol in BREAKS:
        return 0, symbol
    if symbol == TARGET_S:
        return 1, symbol
    return state, {INSULT_S: "i", THREAT_S: "t"}.get(symbol, symbol) if state else symbol


#: The verdict's state: one more than the clause's pattern (0 for none), and flags.
QUOTING, UNQUOTED, LOOSE, NAMED = 8, 16, 32, 64
STRENGTH = (REPORTED, NEGATED, PLAIN, AIMED, THREATENED)


def verdict(state: int, symbol: str) -> tuple[int, str]:
    """The clause's pattern, given out at its end; stronger patterns win.

    A target that follows aims a plain insult, and makes a threat of a threat
    word that had none (``LOOSE``; without a target it is no match), unless a word
    of saying comes next and it is the speaker (``NAMED`` until then).  A quotation
    (``QUOTING``) does not end before its mark or line does; a word of saying
    behind it reports what was matched, if all of that was quoted.
    """
    rank, flags = state % 8, state - state % 8
    if flags & NAMED and symbol != REPORT_S:
        rank, flags = (THREATENED if flags & LOOSE else max(rank - 1, AIMED)) + 1, flags & ~LOOSE
    flags &= ~NAMED
    if symbol == LINE_S or symbol in BREAKS and not flags & QUOTING:
        return 0, str(rank)
    if symbol == QUOTE_S:
        return rank + (flags ^ QUOTING), OTHER_S
    found = None
    if symbol == TARGET_S:
        if flags & LOOSE or rank == PLAIN + 1:
            flags |= NAMED
    elif symbol == REPORT_S:
        if (rank or flags & LOOSE) and not flags & (QUOTING | UNQUOTED):
            return REPORTED + 1 + (flags & ~LOOSE), OTHER_S
    else:
        found = {"r": REPORTED, "n": NEGATED, INSULT_S: PLAIN, "i": AIMED, "t": THREATENED}.get(symbol)
        if symbol == THREAT_S:
            flags |= LOOSE
        if (found is not None or symbol == THREAT_S) and not flags & QUOTING:
            flags |= UNQUOTED
    if found is not None and not (rank and STRENGTH.index(rank - 1) >= STRENGTH.index(found)):
        rank = found + 1
    return rank + flags, OTHER_S


def compose(*steps: Step) -> dict[tuple[int, str], tuple[int, str]]:
    """The transducers in turn as one table over the symbols; states are numbered
    from 0, the start, as they are reached."""
    number: dict[tuple[int, ...], int] = {(0,) * len(steps): 0}
    todo, out = [(0,) * len(steps)], {}
    while todo:
        states = todo.pop()
        for symbol in SYMBOLS:
            now, passed = [], symbol
            for step, state in zip(steps, states, strict=True):
                state, passed = step(state, passed)
                now.append(state)
            after = tuple(now)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            out[number[states], symbol] = (number[after], passed)
    return out


@dataclass(frozen=True)
class Grammar:
    """Word symbols and weights, the composed table, and the learned scoring."""

    lexicon: dict[str, float]
    weights: tuple[float, ...] = ()  # one for each feature
    bias: float = 0.0

    def clauses(self, text: str, table, symbols) -> Iterator[tuple[int, float]]:
        """``(pattern, lexical weight)`` of every clause with a match."""
        state, weight, get = 0, 0.0, symbols.get
        lexicon = self.lexicon
        words = WORDS.findall(text.lower())
        words.append("\n")  # ends quotations, too
        for word in words:
            symbol = get(word)
            if symbol is None:
                if not state:
                    continue
                symbol = OTHER_S
            if symbol in (INSULT_S, THREAT_S):
                weight += lexicon.get(word, 1.0)
            state, said = table[state, symbol]
            if said.isdigit():  # a clause ends here
                if said != "0" and weight:
                    yield int(said) - 1, weight
                weight = 0.0

    def symbols(self) -> dict[str, str]:
        out = {w: s for s, words in ((THREAT_S, THREAT), (TARGET_S, TARGET), (NEG_S, NEGATION), (REPORT_S, REPORT))
               for w in words}
        out.update(dict.fromkeys(self.lexicon, INSULT_S))
        out.update(dict.fromkeys(".!?;|", END_S))
        out.update(dict.fromkeys("\"“”„«»", QUOTE_S))
        out.update({"\n": LINE_S, ":": COLON_S})
        return out

    def features(self, text: str, table, symbols) -> list[float]:
        """On a falling scale the matched weight of all plain and aimed insults and
        threats, of the aimed ones and threats among them, of the threats, of the
        negated and of the reported clauses; then the number of matched clauses on
        the same scale, and the heaviest clause.  The first three hold each other,
        so with weights of no less than zero (but for negated and reported clauses)
        neither an aim nor a further insult lowers a score."""
        total, heaviest, n = [0.0] * len(PATTERN_NAMES), 0.0, 0
        for pattern, weight in self.clauses(text, table, symbols):
            if pattern in (PLAIN, AIMED, THREATENED):
                heaviest, n = max(heaviest, weight), n + 1
                for i in range(pattern + 1):
                    total[i] += weight
            else:
                total[pattern] += weight
        return [*map(math.log1p, total), math.log1p(n), math.log1p(heaviest)]


FEATURES = len(PATTERN_NAMES) + 2


def composed():
    return compose(negation, report, target, verdict)


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Words with their log-odds in toxic texts; a word has to be clearly more
    frequent there, by a likelihood ratio that no word of a few texts reaches by
    chance.  At most the sample's words come to the driver, after the filter."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    tally = sample.select("label", F.explode(words).alias("word")).groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    n = sample.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")).first()
    if not n["toxic"] or not n["clean"]:
        return {}
    odds = F.log((F.col("toxic") + 0.1) / (n["toxic"] + 0.2)) - F.log((F.col("clean") + 0.5) / (n["clean"] + 1))
    share = n["toxic"] / (n["toxic"] + n["clean"])
    part = lambda seen, prior: seen * F.log(F.greatest(seen, F.lit(0.5)) / (prior * (F.col("toxic") + F.col("clean"))))
    evidence = 2 * (part(F.col("toxic"), share) + part(F.col("clean"), 1 - share))
    shown = tally.filter(evidence >= MIN_EVIDENCE).withColumn("odds", odds)
    grammar = set(THREAT) | set(TARGET) | set(NEGATION) | set(REPORT)
    return {r["word"]: r["odds"] for r in shown.filter(F.col("odds") >= MIN_LOG_ODDS).collect() if r["word"] not in grammar}


def with_features(rows: DataFrame, grammar: Grammar) -> DataFrame:
    """``rows`` (with a column ``text``, which goes) and an array ``features``."""
    sent = rows.sparkSession.sparkContext.broadcast(grammar)
    keep = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep) + ", features array<double>"

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = sent.value, composed()
        symbols = own.symbols()
        for batch in batches:
            made = [own.features(t.as_py(), table, symbols) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in keep],
                                              pa.array(made, pa.list_(pa.float64()))], [*[f.name for f in keep], "features"])

    return rows.mapInArrow(kernel, schema)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps; few features, bounded rows."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    damp = np.diag([ridge] * x.shape[1] + [1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve((x1.T * (p * (1 - p))) @ x1 + damp, x1.T @ (y - p) - damp @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, train: Column, label: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text", fit_rows: int = FIT_ROWS) -> Grammar:
    """A grammar learned from rows of ``labels`` for which ``train`` (a condition
    on ``label_id``) is true, at most about ``fit_rows`` of them.  The insults
    come from one half of the rows, the patterns' weights from the other.

    Labels other than 0 and 1 are ignored, as are labels without a document.  If
    only one class is left, every text gets its smoothed share; without any row, 0.5.
    """
    rows = labelled_sample(docs, labels, label, train, id_col, text_col, fit_rows)
    sample = materialize(rows.withColumn("half", F.pmod(F.xxhash64("text", "label"), F.lit(2))), "toxic-sample")
    whole = Grammar(learn_lexicon(sample))
    halves = [Grammar(learn_lexicon(sample.filter(F.col("half") == h).drop("half"))) for h in (0, 1)]
    made = []
    for h, grammar in enumerate(halves):  # each half is scored by what the other has taught
        part = sample.filter(F.col("half") != h).select("text", "label")
        made += with_features(part, grammar).select("features", "label").collect()
    y = np.array([r["label"] for r in made], float)
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 0.5) / (len(y) + 1)
        return Grammar({}, (0.0,) * FEATURES, math.log(p / (1 - p)))
    x, free = np.array([r["features"] for r in made]), np.ones(FEATURES, bool)
    mild = np.isin(np.arange(FEATURES), (NEGATED, REPORTED))
    while True:  # the weights of plain matches, aims and threats stay at zero or more
        weights, bias = np.zeros(FEATURES), 0.0
        weights[free], bias = logistic(x[:, free], y)
        below = (weights < 0) & ~mild
        if not below.any():
            return Grammar(whole.lexicon, tuple(weights.tolist()), bias)
        free &= ~below


def score(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score)`` for every row, the score from 0 to 1.  Null text counts
    as the empty text; texts are read whole, however long; repeated rows get
    equal scores, ids may be null."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(docs, text_col).alias("text"))
    total = F.lit(float(grammar.bias))
    for i, w in enumerate(grammar.weights):
        total = total + F.col("features")[i] * F.lit(float(w))
    return with_features(rows, grammar).select(F.col("id").alias(id_col), (1 / (1 + F.exp(-total))).alias("score"))


def toxic_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``: labels of rows in fold ``held``
    are not learned from."""
    grammar = fit(docs, labels, bucket_of("label_id", folds) != held)
    fold = F.coalesce(bucket_of("doc_id", folds) == held, F.lit(False))
    return score(docs, grammar).select("doc_id", fold.alias("held_out"), "score",
                                       (F.col("score") >= 0.5).cast("int").alias("predicted"))
