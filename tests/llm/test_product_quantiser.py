from __future__ import annotations

import math

import numpy as np

from martflow.llm import product_quantiser as P
from martflow.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF0001, need_testdata
from tests.oracle_compare import duck


def usable(v):
    return v and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, least):
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            (_, a, x), (_, b, y) = rows[i], rows[j]
            if a is not None and a == b and usable(x) and usable(y) and len(x) == len(y):
                x, y = (np.array(v, float) / max(map(abs, v)) for v in (x, y))
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= least:
                    links[i] += 1
                    links[j] += 1
                    root[top(i)] = top(j)
    names = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            names[top(i)] = min(names.get(top(i), v), v)
    part = [names.get(top(i)) for i in range(n)]
    return sorted(((v, k, c, v is not None and v == c) for (v, _, _), k, c in zip(rows, links, part)), key=str)


def found(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def clustered(seed, dim, groups, each, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return np.concatenate([c + rng.normal(size=(each, dim)) * spread for c in centres])


def test_probes_and_codes_miss_no_link():
    reach, least = math.sqrt(2 - 2 * 0.93), 0.93
    x = P.unit(clustered(1, 16, 60, 8, 0.09))
    quantiser = P.Quantiser(16, x[::3], 24)
    cell, near, codes, error = quantiser.encode(x, reach)
    linked = x @ x.T >= least
    i, j = np.nonzero(linked & (cell[:, None] != cell[None, :]))
    assert len(i) and (near[i, cell[j]] | near[j, cell[i]]).all()
    assert near[np.arange(len(x)), cell].all()
    tested = 0
    for c in range(len(quantiser.coarse)):
        members = np.flatnonzero(cell == c)
        maybe = quantiser.candidates(x, c, codes[members], error[members], reach)
        assert maybe[linked[:, members]].all()
        tested += maybe.sum()
    assert tested < 0.25 * len(x) ** 2  # the table look-ups drop most pairs
    assert near.mean() < 0.8


def test_query_equals_brute_force_and_sql(spark):
    need_testdata()
    table = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    rows = [(r.vec_id, r.label, list(r.embedding)) for r in table.collect()]
    got = found(QUERIES["op13_product_quantiser"](spark, SF0001))
    assert got == brute(rows, 0.93)
    assert got == sorted(duck(SF0001).execute(ORACLE_SQL["op13_product_quantiser"]).fetchall(), key=str)


def test_sql_and_query_agree_where_links_are(spark, tmp_path):
    rows = [(i, i % 2, v.tolist()) for i, v in enumerate(clustered(6, 8, 12, 10, 0.12))]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").coalesce(1).write.parquet(
        str(tmp_path / "embeddings.parquet"))
    got = found(QUERIES["op13_product_quantiser"](spark, str(tmp_path)))
    sql = ORACLE_SQL["op13_product_quantiser"].replace("FROM embeddings", f"FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    import duckdb

    assert got == sorted(duckdb.sql(sql).fetchall(), key=str)
    assert sum(r[1] for r in got) > 100


def test_pieces_copies_and_odd_rows(spark):
    vectors = [np.round(v, 3).tolist() for v in clustered(2, 6, 8, 9, 0.15)]
    rows = [(i, i % 3 if i % 10 else None, v) for i, v in enumerate(vectors)]
    rows += [(500 + i, 1, vectors[4]) for i in range(25)] + [(600 + i, 1, [2 * x for x in vectors[4]]) for i in range(4)]
    nan, inf = float("nan"), float("inf")
    rows += [(700, 1, None), (701, 1, []), (702, 1, [0.0] * 6), (703, 1, [nan] * 6), (704, 1, [inf] * 6), (705, 1, [None, 1.0]),
             (706, 1, [1.0, 0.0]), (706, 1, [1.0, 0.1]), (None, 1, [1.0, 0.1]), (None, 2, [3.0]), (707, 1, [1e200, 1e200]),
             (708, 1, [1e200, 1e200]), (709, 1, [1e-200, 1e-200]), (None, None, None)]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows],
                               "vec_id long, label int, embedding array<double>, node int, docs string")
    want = brute(rows, 0.9)
    for args in ({}, {"piece": 3, "probe_piece": 4}, {"fit_rows": 0}, {"fit_rows": 20, "max_lists": 3, "piece": 5}):
        assert found(P.near_duplicates(df, least=0.9, **args)) == want
    assert P.near_duplicates(df.limit(0)).count() == 0
