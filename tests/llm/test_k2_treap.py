from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np

from martflow.llm import k2_treap as T
from martflow.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF0001, need_testdata
from tests.oracle_compare import duck

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    bags = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(words(t))
    out = {}
    for item, terms in asked.items():
        scored = []
        for i, bag in bags:
            m = 75 + 25 * sum(bag.values()) * n_docs // n_terms
            score = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * bag[t] // (1000 * bag[t] + 12 * m)) for t, n in terms.items() if t in bag)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        if scored:
            out[item] = [(s[3], -s[0]) for s in sorted(scored)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.item_id is None, r.item_id, r["rank"])):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return out


def test_terms():
    text = "Ärger, ÉCOLE x_y [Z9]  \x7f\x85   A\x00B don't \U0001f600"
    assert [t.decode() for t in T.terms(text.encode())] == words(text)


def test_treap_holds_every_point_and_its_maxima():
    rng = np.random.default_rng(1)
    cells = np.unique(rng.integers(0, 50 * 300, 900))
    rows, columns, values = cells // 300, cells % 300, rng.integers(1, 1000, len(cells))
    treap = T.Treap(rows, columns, values)
    got = {}

    def walk(level, node, row, column, value):
        if level == treap.height:
            got[row, column] = value
            return value
        masks, first = treap.levels[level]
        child, high = int(first[node]), 0
        for quad in range(4):
            if masks[node] >> quad & 1:
                below = value - int(treap.less[level][child])
                high = max(high, walk(level + 1, child, 2 * row + (quad >> 1), 2 * column + (quad & 1), below))
                child += 1
        assert high == value
        return high

    walk(0, 0, 0, 0, treap.top)
    assert got == {(int(r), int(c)): int(v) for r, c, v in zip(rows, columns, values)}


def test_search_equals_brute_force_and_prunes(monkeypatch):
    rng = np.random.default_rng(2)
    grid = (rng.random((40, 500)) < 0.1) * rng.integers(1, 50, (40, 500)) ** 3
    rows, columns = np.nonzero(grid)
    treap, ids = T.Treap(rows, columns, grid[rows, columns]), rng.permutation(500)
    for states in (1, 7, 256):
        for _ in range(20):
            asked, weights = rng.choice(40, 6, False), rng.integers(1, 9, 6)
            score = weights @ grid[asked]
            order = [i for i in np.lexsort((ids, -score)) if score[i] > 0][:10]
            assert treap.top_k(asked, weights, 10, 0, ids, states) == [(i, score[i]) for i in order]
            floor = int(score[order[4]])
            got = treap.top_k(asked, weights, 10, floor, ids, states)
            assert got == [(i, score[i]) for i in order if score[i] >= floor]
    opened = []
    real = T.heapq.heappop
    monkeypatch.setattr(T.heapq, "heappop", lambda h: opened.append(1) or real(h))
    column = np.arange(4096)
    single = T.Treap(np.zeros(4096, int), column, column + 1)
    assert single.top_k(np.array([0]), np.array([3]), 3, 0, column, 4) == [(4095, 12288), (4094, 12285), (4093, 12282)]
    assert len(opened) < 20


def test_query_equals_brute_force_and_sql(spark):
    need_testdata()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    got = found(QUERIES["op11_k2_treap"](spark, SF0001))
    assert got == brute(docs, items, 20)
    rows = duck(SF0001).execute(ORACLE_SQL["op11_k2_treap"]).fetchall()
    assert {(i, d, s) for i, _, d, s in rows} == {(i, d, s) for i, v in got.items() for d, s in v}


def test_small_shards_blocks_ties_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    say = lambda n: " ".join(f"w{int(x)}" for x in rng.zipf(1.4, n) % 60)
    docs = [(i, say(int(rng.integers(0, 30)))) for i in range(120)] + [(i % 7, "w1 w2 w2") for i in range(200, 260)]
    docs += [(None, "w1 w3"), (None, None), (300, ""), (301, "...!"), (302, "W1 " * 30_000 + "rare"), (302, "rare")]
    items = [(1, "w1 w2 w3 W2"), (2, "rare"), (2, "rare w5"), (3, None), (4, "unheard of"), (None, "w4"), (None, "w2"), (5, "")]
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], "doc_id long, text string, rank int, term string, score int")
    asks = spark.createDataFrame([(i, t, 0.5) for i, t in items], "item_id long, text string, floor double")
    want = brute(docs, items, 9)
    for parts in ({}, {"shard_docs": 16, "block_terms": 3}, {"shard_terms": 40, "block_terms": 2, "broadcast_bytes": 0}):
        assert found(T.ranked(df.repartition(3), asks, k=9, **parts)) == want
    assert T.ranked(df.limit(0), asks).count() == 0
    assert T.ranked(df, asks.limit(0)).count() == 0
