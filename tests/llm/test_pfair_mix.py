from __future__ import annotations

from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martflow.llm import pfair_mix as M
from martflow.llm.queries import QUERIES
from tests.conftest import SF0001, need_testdata


def slow_order(blocks, weights, period):
    """Slot by slot: the released block with the earliest deadline, in phases."""
    left, done, out = {s: n for s, n in blocks.items() if n}, Counter(), []
    while left:
        units = M.units_of({s: weights[s] for s in left}, period)
        taken, slot = Counter(), 0
        while all(taken[s] < left[s] for s in left):
            ready = [(-(-(taken[s] + 1) * period // units[s]), repr(s), s) for s in left
                     if taken[s] * period // units[s] <= slot]
            s = min(ready)[2]
            out.append((s, done[s] + taken[s]))
            taken[s] += 1
            slot += 1
        for s in list(left):
            done[s] += taken[s]
            left[s] -= taken[s]
            if not left[s]:
                del left[s]
    return out


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.text("abcde", min_size=1, max_size=2), st.tuples(st.integers(0, 70), st.floats(0.01, 50)),
                       min_size=1, max_size=6))
def test_phases_match_the_slot_by_slot_schedule(sources):
    blocks = {s: n for s, (n, _) in sources.items()}
    weights = {s: w for s, (_, w) in sources.items()}
    made = {}
    for phase in M.phases(blocks, weights, 32):
        for s, (first, taken, slots) in phase["sources"].items():
            for k in range(taken):
                at = phase["start"] + k // len(slots) * phase["period"] + slots[k % len(slots)]
                assert at not in made
                made[at] = (s, first + k)
    assert [made[i] for i in range(len(made))] == slow_order(blocks, weights, 32)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(0, 30), st.floats(0.001, 100), min_size=1, max_size=12))
def test_lag_stays_below_one_block(weights):
    units = M.units_of(weights, 64)
    assert sum(units.values()) == 64 and min(units.values()) >= 1
    slots = M.one_period(units, 64)
    for s, own in slots.items():
        for t in range(65):
            assert abs(sum(x < t for x in own) - units[s] * t / 64) < 1


def test_query_keeps_every_row_and_its_windows(spark):
    need_testdata()
    rows = QUERIES["op1_pfair_mix"](spark, SF0001).collect()
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "source").collect()
    assert sorted((r.doc_id, r.source) for r in rows) == sorted((d.doc_id, d.source) for d in docs)
    assert len({r.place for r in rows}) == len(rows)
    assert all(r.release <= r.slot < r.deadline for r in rows)


def test_order_follows_brute_force(spark):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "big").when(
        F.col("id") % 5 == 0, "mid").otherwise("low").alias("source"), F.lit(1).alias("slot"), F.lit(2).alias("place"))
    weights = {"big": 1.0, "mid": 2.0, "low": 1.0}
    rows = M.mix_order(df, weights, block_rows=3, period=16, piece_rows=20).orderBy("place").collect()
    counts = Counter(r.source for r in rows)
    want = slow_order({s: -(-n // 3) for s, n in counts.items()}, weights, 16)
    assert list(dict.fromkeys((r.source, r.block) for r in rows)) == want
    assert all(n <= 3 for n in Counter((r.source, r.block) for r in rows).values())
    named = M.mix_order(df, {"mid": 1.0}, block_rows=3).orderBy("place").collect()
    assert [r.source for r in named[: counts["mid"]]] == ["mid"] * counts["mid"] and len(named) == 400


def test_mixed_is_sorted_and_whole(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
                                 F.lit("t").alias("text"), F.lit(9).alias("mix_place"), F.lit(8).alias("mix_id"))
    out = M.mixed(df, {"s0": 2, "s1": 1, "s2": 1}, block_rows=5)
    assert out.columns == df.columns
    got = [r.doc_id for r in out.collect()]
    place = {r.doc_id: r.place for r in M.mix_order(df, {"s0": 2, "s1": 1, "s2": 1}, block_rows=5).collect()}
    assert got == sorted(place, key=place.get)


def test_odd_rows(spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, None), (2, None), (3, ""), (3, "b")]
    df = spark.createDataFrame([(i, "x", s) for i, s in rows], "doc_id long, text string, source string")
    got = M.mix_order(df, block_rows=2).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(map(key, ((r.doc_id, r.source) for r in got))) == sorted(map(key, rows))
    assert len({r.place for r in got}) == 7
    assert sorted(map(key, ((r.doc_id, r.source) for r in M.mixed(df).collect()))) == sorted(map(key, rows))
    assert M.mix_order(df.limit(0)).count() == 0 and M.mixed(df.limit(0)).count() == 0


def test_weights_of_a_common_denominator_are_kept_exactly():
    cases = [{"a": 1 / 3, "b": 2 / 3}, {"a": 0.1, "b": 0.2, "c": 0.7}, {"a": 5, "b": 1, "c": 1}, {"a": 0.0001, "b": 0.9999}]
    for weights in cases:
        period, total = M.exact_period(weights), sum(weights.values())
        units = M.units_of(weights, period)
        assert all(abs(units[s] / period - w / total) < 1e-15 for s, w in weights.items())
        slots = M.one_period(units, period)
        for s, w in weights.items():  # a million blocks are whole periods and a rest
            full, rest = divmod(10**6, period)
            taken = full * units[s] + sum(x < rest for x in slots[s])
            assert abs(taken - 10**6 * w / total) < 1
    assert M.exact_period({"a": 2 ** 0.5, "b": 1}) is None and M.exact_period({"a": 1e-9, "b": 1}) is None
