"""Personal data: fixed patterns, and contexts learned from what they find.

The fixed patterns and the values of secret keys give seed entities.  The words
before a seed, and the key right before it, are lexical patterns; identifier-like
tokens behind the same words are their further instances.  Patterns and instances score each other in turn (a pattern by the
share of its instances that are believed, an instance by the patterns it
occurs with), and patterns that end with high confidence mark the unseen
identifiers behind them.  Scoring starts from the contexts of seeds; the other
contexts of the instances that come to be believed join in, and so on until no
further pattern is trusted.

Everything is Spark expressions and joins: one pass over the texts gives spans
and occurrences, all later steps work on those alone.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_of

KINDS = ("email", "ip", "card", "phone")
SECRET = len(KINDS)  # the kind of what stands behind secret keys, never a base span
ALL_KINDS = (*KINDS, "secret")
ROUNDS, CONFIDENT = 3, 0.8

# The base patterns, written so that no regex engine step repeats work: a run of
# characters is entered at its start only (or where the last match ended) and
# never given back.  A card is a whole chain of digits, so a chain of 16 to 19
# is matched at once and others are passed over.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Seeds of secrets: a value of eight characters or more with a digit and a letter
#: behind one of these words and a sign for "is".
SECRET_KEYS = "password|passwd|pwd|token|secret|api_key|api-key|apikey|access_key"
SECRET_SEED = rf"""(?<=(?:(?i){SECRET_KEYS})["']?\x20?[:=]\x20?["']?)(?=[^\s"',;]*[0-9])(?=[^\s"',;]*[A-Za-z])[^\s"',;:=]{{8,}}+"""
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "token": "[0-9]",
          "secret": rf"""(?:(?i){SECRET_KEYS})["']?\x20?[:=]"""}
#: Identifier-like: six or more word characters and inner signs, with a digit.
TOKEN = r"(?<![\w@.+-])(?=[\w@.+-]*[0-9])[\w@+][\w@.+-]{4,}\w(?![\w@+])"
#: Read backwards from a span: the two words before it with their signs.
WORDS_BACK = r"^\s*+(?:\S++(?:\s++\S++)?+)?+"


def occurrences(text: str, pattern: str, guard: str) -> Column:
    """All matches of a pattern in the column ``text`` as an array of
    ``(start, end, before, value)``: the text between matches and the matches in
    turn give the places by running sums.  ``before`` is the two words before the
    match, whole.  Texts without ``guard`` are skipped."""
    literal = lambda x: x.replace("\\", "\\\\").replace("'", "\\'")
    quoted = literal(pattern)
    none = "array_repeat(named_struct('start', 0, 'end', 0, 'before', '', 'value', ''), 0)"
    return F.when(F.col(text).rlike(guard), F.expr(f"""
        aggregate(
            filter(zip_with(split({text}, '{quoted}', -1), regexp_extract_all({text}, '{quoted}', 0),
                            (p, m) -> named_struct('p', p, 'm', m)), x -> x.m IS NOT NULL),
            named_struct('at', 0, 'out', {none}),
            (acc, x) -> named_struct(
                'at', acc.at + length(x.p) + length(x.m),
                'out', concat(acc.out, array(named_struct(
                    'start', acc.at + length(x.p), 'end', acc.at + length(x.p) + length(x.m),
                    'before', reverse(regexp_extract(reverse(x.p), '{literal(WORDS_BACK)}', 0)), 'value', x.m)))),
            acc -> acc.out)""")).otherwise(F.expr(none))


def holds(kind: str, value: Column) -> Column:
    """The check behind a kind's pattern."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "ip":
        part = lambda x: F.concat(F.lit("0"), F.regexp_replace(x, "^0+", "")).try_cast("decimal(38,0)")
        return F.forall(F.split(value, r"\."), lambda x: F.coalesce(part(x) <= 255, F.lit(False)))
    if kind == "card":
        n = F.length(digits)
        digit = lambda i: F.substring(digits, n - i, F.lit(1)).try_cast("int")
        twice = lambda i: digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0)
        total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0),
                            lambda acc, i: acc + F.when(i % 2 == 1, twice(i)).otherwise(digit(i)))
        return total % 10 == 0
    return F.lit(True)


def contexts(before: Column) -> Column:
    """The lexical patterns of a span, from the words before it in lower case with
    digits made alike: the last two words, and the last key with its sign
    (``name:``, ``name = "``) whatever stands before it."""
    words = F.trim(F.regexp_replace(F.regexp_replace(F.lower(before), "[0-9]", "0"), r"\s+", " "))
    key = F.regexp_extract(words, r"""(?:^|[^\w.-])([\w.-]++["']?\x20?[:=]\x20?["']?)$""", 1)
    return F.array_distinct(F.filter(F.array(words, key), lambda x: x != ""))


def spans_in(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(row, id, base, tokens)``: the base spans of every row, by kind and then
    start, and its identifier-like tokens that no base span touches; those with
    a ``kind`` of ``SECRET`` stand behind a secret key, the others have -1."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(docs, text_col).alias("text"))
    found = rows.select("id", *[occurrences("text", PATTERNS[k], GUARDS[k]).alias(k) for k in KINDS],
                        occurrences("text", SECRET_SEED, GUARDS["secret"]).alias("secret"),
                        occurrences("text", TOKEN, GUARDS["token"]).alias("token"))

    def spans(of: Column, kind: int) -> Column:
        return F.transform(of, lambda s: F.struct(F.lit(kind).alias("kind"), s.start.alias("start"), s.end.alias("end"),
                                                  contexts(s.before).alias("contexts"), s.value.alias("value")))

    def apart(of: str, *taken: str) -> Column:
        return F.filter(of, lambda t: ~reduce(lambda x, y: x | y, [
            F.exists(other, lambda b: (b.start < t.end) & (t.start < b.end)) for other in taken]))

    def good(kind: str) -> Column:
        return F.filter(kind, lambda s: holds(kind, s.value))

    based = found.select("id", F.concat(*[spans(good(k), i) for i, k in enumerate(KINDS)]).alias("base"), "secret", "token")
    free = based.select("id", "base", apart("secret", "base").alias("secret"), "token")
    tokens = F.concat(spans(F.col("secret"), SECRET), spans(apart("token", "base", "secret"), -1))
    return materialize(free.select("id", "base", tokens.alias("tokens")).select(
        F.monotonically_increasing_id().alias("row"), "*"), "pii-spans")


def confident_patterns(found: DataFrame, rounds: int, confident: float) -> DataFrame:
    """``(context, kind, belief)`` of the patterns to trust.

    A pattern's belief in a kind is the sum of its instances' beliefs over one
    more than their number, so it takes several agreeing instances to be sure;
    an instance is believed as far as not all of its patterns are wrong.  After
    ``rounds`` rounds of scoring, all contexts of instances believed at
    ``confident`` or more take part as well, until that gives no new pattern.
    """
    every = found.select(F.explode(F.concat("base", "tokens")).alias("x")).select("x.contexts", "x.value", "x.kind")
    names = [f"s{i}" for i in range(len(ALL_KINDS))]
    belief = [F.max((F.col("kind") == i).cast("double")).alias(s) for i, s in enumerate(names)]
    edges = every.select(F.explode("contexts").alias("context"), "value", (F.col("kind") >= 0).cast("int").alias("seed"))
    edges = materialize(edges.groupBy("context", "value").agg(F.max("seed").alias("seed")), "pii-edges")
    seeds = materialize(every.filter("kind >= 0").groupBy("value").agg(*belief), "pii-seeds")
    best = F.greatest(*names)
    reached = materialize(edges.filter("seed > 0").select("context").distinct(), "pii-reached")
    instances, trusted = seeds, -1
    while True:
        near = materialize(edges.join(reached, "context", "left_semi").select("context", "value"), "pii-near")
        for _ in range(rounds):
            patterns = near.join(instances, "value", "left").groupBy("context").agg(
                *[(F.sum(F.coalesce(F.col(s), F.lit(0.0))) / (F.count("*") + 1)).alias(s) for s in names])
            patterns = materialize(patterns, "pii-patterns")
            doubt = [F.exp(F.sum(F.log(1 - F.col(s)))) for s in names]
            grown = near.join(patterns, "context").groupBy("value").agg(
                *[(1 - d).alias(s) for d, s in zip(doubt, names, strict=True)])
            known = seeds.select("value", *[F.col(s).alias(f"known_{s}") for s in names])
            instances = materialize(grown.join(known, "value", "left").select(
                "value", *[F.greatest(F.col(s), F.coalesce(f"known_{s}", F.lit(0.0))).alias(s) for s in names]),
                "pii-instances")
        # beliefs never fall as contexts join, so no new pattern means as many as before
        before, trusted = trusted, patterns.filter(best >= confident).count()
        if trusted == before:
            break
        believed = instances.filter(best >= confident).select("value")
        more = materialize(edges.join(believed, "value", "left_semi").select("context").distinct().join(
            reached, "context", "left_anti"), "pii-more")
        if more.isEmpty():
            break
        reached = materialize(reached.unionByName(more), "pii-reached")
    kind = reduce(lambda out, i: F.when(F.col(f"s{i}") == best, F.lit(i)).otherwise(out),
                  reversed(range(len(ALL_KINDS))), F.lit(0))
    return patterns.select("context", kind.alias("kind"), best.alias("belief")).filter(F.col("belief") >= confident)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
                  confident: float = CONFIDENT) -> DataFrame:
    """``(id_col, base, extra)`` for every row: arrays of ``(kind, start, end,
    value)``, ``kind`` an index into ``ALL_KINDS``, places in code points with the
    end exclusive; ``base`` from the fixed patterns, ``extra`` the values of secret
    keys and what learned contexts find, never touching a base span.  A token with
    several trusted contexts gets the kind that is believed most, the first of
    equal ones.

    Null text is the empty text and has no spans; repeated rows each get theirs;
    ids may be null.  Texts are searched whole, and neither a context nor an
    identifier has a greatest length.  Other columns are ignored.  An empty table gives an empty
    result.
    """
    found = spans_in(docs, id_col, text_col)
    trusted = confident_patterns(found, rounds, confident)
    tokens = found.select("row", F.explode("tokens").alias("t")).select("row", "t.*")
    place = [F.col(c) for c in ("row", "start", "end", "value")]
    learned = tokens.filter("kind < 0").select(*place, F.explode("contexts").alias("context")).join(trusted, "context")
    learned = learned.groupBy(*place).agg(F.max_by("kind", F.struct("belief", -F.col("kind"))).alias("kind"))
    marked = tokens.filter("kind >= 0").select(*place, "kind").unionByName(learned)
    extra = marked.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end", "value"))).alias("extra"))
    none = F.expr("array_repeat(named_struct('kind', 0, 'start', 0, 'end', 0, 'value', ''), 0)")
    base = F.transform("base", lambda b: F.struct(b.kind.alias("kind"), b.start.alias("start"), b.end.alias("end"),
                                                  b.value.alias("value")))
    return found.join(extra, "row", "left").select(F.col("id").alias(id_col), base.alias("base"),
                                                   F.coalesce("extra", none).alias("extra"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in ALL_KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat(
        F.element_at(names, s.kind + 1), F.lit(":"), s.start.cast("string"), F.lit(":"), s.end.cast("string"))), ",")
