from __future__ import annotations

import random
import time

import numpy as np

from martflow.llm import string_tiling as S
from martflow.llm.queries import QUERIES
from tests.conftest import SF0001, need_testdata

ITEM = "the quick brown fox jumps over the lazy dog while seven wizards brew strong potions behind old castle walls tonight"


def slow_tiles(item, doc, tile):
    """Greedy string tiling by trying every pair of places."""
    used_i, used_d, out = set(), set(), []
    while True:
        best = []
        size = tile - 1
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while (a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n] and a + n not in used_i
                       and b + n not in used_d):
                    n += 1
                if n > size:
                    size, best = n, [(a, b)]
                elif n == size and n >= tile:
                    best.append((a, b))
        if size < tile:
            return out
        for a, b in best:
            if not used_i & set(range(a, a + size)) and not used_d & set(range(b, b + size)):
                used_i |= set(range(a, a + size))
                used_d |= set(range(b, b + size))
                out.append((a, b, size))


def test_tiles_match_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        item = [rng.randint(1, 4) for _ in range(rng.randint(0, 14))]
        doc = [rng.randint(0, 4) for _ in range(rng.randint(0, 25))]
        assert S.greedy_tiles(item, doc, 3) == slow_tiles(item, doc, 3)


def test_tiles_of_long_texts_match_brute_force():
    rng = random.Random(2)
    for _ in range(12):
        item = [rng.randint(1, 3) for _ in range(rng.randint(20, 60))]
        doc = [rng.randint(1, 3) for _ in range(40)] + item[10:] + [7] + item[:10] + [rng.randint(1, 3) for _ in range(30)]
        assert S.greedy_tiles(item, doc, 3) == slow_tiles(item, doc, 3)


def test_hashes_stand_for_runs():
    rng = random.Random(3)
    ids = [rng.randint(0, 2) for _ in range(300)]
    runs = S.Runs(ids)
    for n in (1, 2, 3, 7, 64, 299, 300):
        got = runs.hashes(n).tolist()
        want = [tuple(ids[i : i + n]) for i in range(len(ids) - n + 1)]
        assert len(got) == len(want) and len(set(zip(got, want, strict=True))) == len(set(want)) == len(set(got))


def test_equal_hashes_of_other_tokens_are_no_match(monkeypatch):
    monkeypatch.setattr(S.Runs, "hashes", lambda self, n, starts=None: np.zeros(
        len(self.ids) - n + 1 if starts is None else len(starts), np.uint64))
    assert S.greedy_tiles([1, 2, 3, 4], [9, 9, 1, 2, 3, 4, 8], 3) == [(0, 2, 4)]
    assert S.greedy_tiles([1, 2, 3, 4], [9, 9, 1, 2, 3, 5, 8, 9], 3) == [(0, 2, 3)]
    assert S.greedy_tiles([1, 2, 3], [3, 2, 1, 3, 2, 1], 3) == []


def test_repeated_words_are_not_cubic():
    start = time.process_time()
    assert S.greedy_tiles([1] * 60, [1] * 20_000, 3) == [(0, 0, 60)]
    assert sum(t[2] for t in S.greedy_tiles([1, 2] * 500 + [3] * 100, [1, 2, 2] * 20_000 + [3] * 50, 3)) > 50
    assert time.process_time() - start < 3


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string, item_id string, id int, coverage int"),
            spark.createDataFrame(items, "item_id long, text string"))


def test_finds_whole_noisy_and_reordered_passages(spark):
    words = ITEM.split()
    swapped = " ".join(words[10:] + words[:10])
    docs = [(1, f"before {ITEM} after"), (2, f"x {swapped.upper()}, y"), (3, " ".join(words[:9])),
            (4, "nothing of the kind is in here at all"), (5, "lead " * 3000 + ITEM.replace(" ", "\n"))]
    d, b = frames(spark, [(*x, "z", 1, 2) for x in docs], [(10, ITEM)])
    got = {r.doc_id: (r.item_id, r.tiles) for r in S.contaminated(d, b).collect()}
    assert got == {1: (10, 1), 2: (10, 2), 5: (10, 1)}
    kept = S.clean(d, b)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4]
    part = {r.doc_id: r.coverage for r in S.overlaps(d, b).collect()}
    assert 0.4 < part[3] < 0.5


def test_blocks_of_items_give_the_same(spark):
    need_testdata()
    d = spark.read.parquet(f"{SF0001}/documents.parquet")
    b = spark.read.parquet(f"{SF0001}/benchmark.parquet")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    whole = rows(S.overlaps(d, b))
    assert whole == rows(S.overlaps(d, b, block_chars=1500))
    assert S.clean(d, b).count() == S.clean(d, b, block_chars=1500).count()


def test_query_matches_brute_force(spark):
    need_testdata()
    got = {(r.doc_id, r.item_id): r.coverage for r in QUERIES["op6_string_tiling"](spark, SF0001).collect()}
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()
    want = {}
    for it in items:
        own = S.tokens(it.text)
        seeds = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        for d in docs:
            words = S.tokens(d.text or "")
            if seeds & {tuple(words[i : i + 5]) for i in range(len(words) - 4)}:
                share = sum(t[2] for t in slow_tiles(own, words, 3)) / len(own)
                if share >= 0.8:
                    want[d.doc_id, it.item_id] = share
    assert got == want and want


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (None, ITEM), (3, ITEM), (3, ITEM), (4, "two words")]
    items = [(10, ITEM), (10, ITEM), (11, None), (12, ""), (None, "two words"), (13, "two words"), (14, "!!!")]
    d, b = frames(spark, [(*x, "z", 1, 2) for x in docs], items)
    got = sorted((str(r.doc_id), r.item_id) for r in S.contaminated(d, b).collect())
    assert got == [("3", 10), ("3", 10), ("4", 13), ("None", 10)]
    assert sorted(r.doc_id for r in S.clean(d, b).collect()) == [1, 2]
    assert S.contaminated(d.limit(0), b).count() == 0 and S.contaminated(d, b.limit(0)).count() == 0
    assert S.clean(d, b.limit(0)).count() == 6 and S.clean(d.limit(0), b).count() == 0
