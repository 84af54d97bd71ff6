from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from martflow.llm import cover_tree as T
from martflow.llm.queries import QUERIES
from tests.conftest import SF0001, need_testdata


def brute(rows, is_query, k):
    whole = [(i, [int(np.floor(float(x) * 1024)) for x in v]) for i, v in dict(rows).items()]
    out = {}
    for q, a in whole:
        if is_query(q):
            scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b)]
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_cover_tree_covers_and_partitions():
    points = np.random.default_rng(1).normal(size=(700, 6))
    root = T.build(points, np.arange(700))

    def walk(node):
        assert np.sqrt(((points[node.rows] - points[node.centre]) ** 2).sum(axis=1)).max() <= node.radius
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            for c in node.children:
                walk(c)

    walk(root)
    assert root.children


def test_search_prunes():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 8)) * 900
    points = np.floor(np.concatenate([c + rng.normal(size=(100, 8)) * 5 for c in centres]))
    ids = np.arange(len(points))
    search = T.Search(points[::100], ids[::100], points, ids, 5, np.full(20, -np.inf))
    seen = []
    leaf = search.leaf
    search.leaf = lambda a, b: (seen.append(len(a.rows) * len(b.rows)), leaf(a, b))
    search.run(T.build(search.qf, np.arange(20), T.QUERY_LEAF), T.build(search.vf, ids))
    assert sum(seen) < 0.7 * 20 * len(points)
    for i in range(20):
        score = points @ points[100 * i]
        order = [j for j in np.lexsort((ids, -score)) if j != 100 * i][:5]
        assert search.found[i].tolist() == order


def test_query_matches_brute_force(spark):
    need_testdata()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()]
    got = found(QUERIES["op8_cover_tree"](spark, SF0001))
    assert got == brute(rows, lambda i: i % 100 == 0, 10)


def test_blocks_ties_and_copies(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [0.5, 0.5, -0.25]) if i % 3 == 0 else (i, rng.normal(size=3).round(1).tolist()) for i in range(150)]
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, piece int, floor double")
    want = brute(rows, lambda i: i % 10 == 0, 4)
    for block, part in ((4096, 1024), (20, 3)):
        got = found(T.top_products(df, F.col("vec_id") % 10 == 0, k=4, block=block, query_block=part))
        exact = brute([(r.vec_id, r.embedding) for r in df.collect()], lambda i: i % 10 == 0, 4)
        assert got == exact
    assert want.keys() == got.keys()


def test_blocks_are_pruned_before_they_are_copied(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8)) * 4
    rows = [(i, (centres[i % 12] + rng.normal(size=8) * 0.02).round(3).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sent, still_open = [], T.still_open

    def counted(asked, pieces, floors):
        left = still_open(asked, pieces, floors)
        sent.append((left.count(), asked.count() * pieces.count(), left.select("near", "part", "cell", "sub").distinct().count(),
                     asked.select("near", "part").distinct().count() * pieces.count()))
        return left

    monkeypatch.setattr(T, "still_open", counted)
    got = found(T.top_products(df, F.col("vec_id") % 7 == 0, k=5, block=40, query_block=8))
    assert got == brute(rows, lambda i: i % 7 == 0, 5)
    (queries, all_queries, blocks, all_blocks), = sent
    assert queries < 0.6 * all_queries and blocks < 0.8 * all_blocks


def test_more_lengths_than_pivots_and_large_numbers(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=1 + i % 5) * 10.0 ** (i % 4 * 3)).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(T.top_products(df, F.col("vec_id") % 4 == 0, k=3, block=60, query_block=4))
    assert got == brute(rows, lambda i: i % 4 == 0, 3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]), (None, [1.0, 1.0]),
            (5, [3.0, 4.0]), (5, [3.0, 4.0]), (6, [1.0]), (7, []), (8, [1e12, 1.0]), (9, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(T.top_products(df, F.col("vec_id") % 2 == 0, k=10))
    assert got[0] == [(8, 1024 * 1024 * 10 ** 12 + 2 * 1024 * 1024), (5, 11 * 1024 * 1024), (9, 0)]
    assert 6 not in got and {i for i, _ in got[8]} == {0, 5, 9}
    assert T.top_products(df.limit(0), F.col("vec_id") % 2 == 0).count() == 0
    assert T.top_products(df, F.col("vec_id") == 1000).count() == 0
