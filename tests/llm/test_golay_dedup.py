from __future__ import annotations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from martflow.llm import golay_dedup as G
from martflow.llm.queries import QUERIES
from tests.conftest import SF0001, need_testdata

DOCS = "doc_id long, text string, key string, fp string, root int, id int, win_id int"


def slow_fingerprint(text):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def slow_components(fps):
    ids = [k for k in range(len(fps))]

    def root(x):
        while ids[x] != x:
            x = ids[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = root(i), root(j)
                ids[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_golay_code_is_perfect():
    tables = G.golay_tables()
    assert len(set(tables[2].tolist())) == 2048
    words = np.random.default_rng(1).integers(0, 1 << 23, 2000, dtype=np.uint32)
    low, high, error = tables
    code = words ^ error[low[words & 0xFFF] ^ high[words >> 12]]
    assert (low[code & 0xFFF] ^ high[code >> 12] == 0).all()
    assert np.bitwise_count(code ^ words).max() == 3


def test_keys_meet_for_all_small_distances():
    rng = np.random.default_rng(2)
    tables = G.golay_tables()
    for bits in (0, 1, 2, 3):
        a = rng.integers(0, 1 << 63, 400, dtype=np.int64)
        b = a.copy()
        for i in range(len(b)):
            for bit in rng.choice(64, bits, replace=False):
                b[i] ^= np.int64(np.uint64(1 << int(bit)).astype(np.int64))
        own, _ = G.segment_keys(a, tables)
        _, near = G.segment_keys(b, tables)
        met = sum(((own[i] == near[i].T).any(axis=0) & (own[j] == near[j].T).any(axis=0)) for i, j in G.PAIRS)
        assert (met > 0).all()


def test_links_and_components_match_brute_force(spark):
    rng = np.random.default_rng(3)
    fps = [int(x) for x in rng.integers(0, 1 << 62, 60)]
    for x in list(fps):
        y = x
        for _ in range(6):  # chains
            for bit in rng.choice(62, 3, replace=False):
                y ^= 1 << int(bit)
            fps.append(y)
    df = spark.createDataFrame([(x,) for x in set(fps)], "fp long")
    want = {(min(a, b), max(a, b)) for a in set(fps) for b in set(fps) if a != b and (a ^ b).bit_count() <= 3}
    assert {(r.u, r.v) for r in G.links(df, 3).collect()} == want
    plain = {r.node: r.root for r in G.components(G.links(df, 3), "u", "v").collect()}
    hot = {r.node: r.root for r in G.components(G.links(df, 3, block=1), "u", "v").collect()}
    order = sorted(set(fps))
    slow = {order[i]: order[r] for i, r in enumerate(slow_components(order))}
    assert plain == hot == {k: v for k, v in slow.items() if any(k in p for p in want)}
    with pytest.raises(ValueError):
        G.links(df, 4)


def test_query_matches_brute_force(spark):
    need_testdata()
    got = QUERIES["op10_simhash_near_dedup"](spark, SF0001).collect()
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [slow_fingerprint(d.text) for d in docs]
    roots = slow_components(fps)
    want = {d.doc_id: (f"{f:016x}", docs[r].doc_id) for d, f, r in zip(docs, fps, roots)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want


def test_odd_rows(spark):
    long = "word " * 100_000
    rows = [(5, None), (1, ""), (2, " \t\n"), (7, "one"), (6, "ONE"), (9, "é two"), (8, "a b c d"), (8, "a b c d"),
            (None, "a b c d"), (None, "lonely words here"), (3, long), (4, long + "x")]
    df = spark.createDataFrame([(i, t, "k", "f", 0, 1, 2) for i, t in rows], DOCS)
    got = {(r.doc_id, r.fp): (r.component_id, r.group_docs) for r in G.near_duplicates(df).collect()}
    assert got[5, 0] == got[1, 0] == got[2, 0] == (1, 3)
    assert len({v for (i, _), v in got.items() if i in (6, 7)}) == 1
    abcd = [v for (i, _), v in got.items() if i == 8]
    assert abcd == [(8, 3)]
    kept = G.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), (r.text or "")[:8]) for r in kept.collect()) == sorted(
        [("1", ""), ("6", "ONE"), ("9", "é two"), ("8", "a b c d"), ("None", "lonely w"), ("3", "word wor")])
    empty = df.limit(0)
    assert G.near_duplicates(empty).count() == 0 and G.keep_one(empty).count() == 0


def test_all_rows_copies(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("same text in every row").alias("text"))
    assert {(r.component_id, r.group_docs) for r in G.near_duplicates(df).collect()} == {(0, 500)}
