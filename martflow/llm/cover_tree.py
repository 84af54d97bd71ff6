"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are dealt to the nearest of a bounded number of pivots and within it to
blocks of bounded size; queries likewise, with fewer pivots.  A first pass
searches one block of every query's own pivot and gives it a k-th score to begin
with.  A block of pivot p and covering radius R holds no product above
``<q, p> + |q| R``, so only the queries that can still gain from a block are sent
to it, and only the blocks that are still asked for are copied.  Where a query
block and a vector block meet, both get a cover tree.  A pair of nodes can give
no product above ``<a, b> + |a| R_b + |b| R_a + R_a R_b`` (centres a, b, covering
radii R), so it is dropped when that is below the worst k-th score of the node's
queries.

Scores are integers and compared exactly; bounds are rounded up.
"""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

BLOCK, QUERY_BLOCK, LEAF, QUERY_LEAF, SCALE = 4096, 1024, 48, 4, 1024
EXACT = 1 << 52  # products below this are exact in doubles
PIVOTS, PIVOT_COMPONENTS = 512, 1 << 20  # at most so many pivots, and components of them in all


@dataclass
class Node:
    centre: int
    radius: float
    rows: np.ndarray
    children: list["Node"] = field(default_factory=list)


def build(points: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> Node:
    """A cover tree over ``points[rows]``: the centres of a node's children are
    more than half its radius apart and every row is within that of its centre.
    Nodes of at most ``leaf`` rows, or of equal ones, are leaves; children that
    would be leaves of very few rows are one leaf."""
    centre = int(rows[0])
    away = np.sqrt(((points[rows] - points[centre]) ** 2).sum(axis=1))
    node = Node(centre, float(away.max()) * (1 + 1e-9), rows)
    if len(rows) <= leaf or node.radius == 0:
        return node
    cover, left, parts = node.radius / 2, rows, []
    while len(left):
        far = away if not parts else np.sqrt(((points[left] - points[left[0]]) ** 2).sum(axis=1))
        near = far <= cover
        parts.append(left[near])
        left = left[~near]
        if len(parts) >= 64 and len(left) > leaf:  # a wide level: the rest is one more node, covered by its own radius
            parts.append(left)
            break
    few = leaf // 12
    scattered = [p for p in parts if len(p) <= few]
    node.children = [build(points, p, leaf) for p in parts if len(p) > few]
    if scattered:
        rest = np.concatenate(scattered)
        node.children.append(Node(int(rest[0]), 2 * node.radius, rest))
    return node


class Search:
    """Top-k of a block's queries over a block's vectors."""

    def __init__(self, queries, query_ids, vectors, vector_ids, k: int, floor: np.ndarray):
        self.q, self.v, self.qid, self.vid, self.k = queries, vectors, query_ids, vector_ids, k
        self.floor = floor.copy()  # by query: no lower score can be among its k best
        self.scores = [np.zeros(0, queries.dtype)] * len(queries)
        self.found = [np.zeros(0, np.int64)] * len(queries)
        self.qf, self.vf = queries.astype(np.float64), vectors.astype(np.float64)
        self.qn, self.vn = (np.sqrt((m ** 2).sum(axis=1)) for m in (self.qf, self.vf))

    def bound(self, a: Node, b: Node) -> float:
        best = (float(self.qf[a.centre] @ self.vf[b.centre]) + self.qn[a.centre] * b.radius
                + self.vn[b.centre] * a.radius + a.radius * b.radius)
        return best + 1e-9 * abs(best) + 1e-6

    def leaf(self, a: Node, b: Node) -> None:
        products = self.q[a.rows] @ self.v[b.rows].T
        ids = self.vid[b.rows]
        for i, row in zip(a.rows.tolist(), products, strict=True):
            good = (row >= self.floor[i]) & (ids != self.qid[i])
            if not good.any():
                continue
            scores, found = np.concatenate([self.scores[i], row[good]]), np.concatenate([self.found[i], ids[good]])
            order = np.lexsort((found, -scores))[: self.k]
            self.scores[i], self.found[i] = scores[order], found[order]
            if len(order) == self.k:
                self.floor[i] = max(self.floor[i], scores[order][-1])

    def run(self, a: Node, b: Node) -> None:
        stack = [(self.bound(a, b), a, b)]
        while stack:
            bound, a, b = stack.pop()
            if bound < self.floor[a.rows].min():
                continue
            if not a.children and not b.children:
                self.leaf(a, b)
                continue
            split_a = a.children and (not b.children or a.radius > b.radius)
            pairs = [(c, b) for c in a.children] if split_a else [(a, c) for c in b.children]
            stack += sorted(((self.bound(x, y), x, y) for x, y in pairs), key=lambda p: p[0])


def _matrix(arrays) -> np.ndarray:
    """Vectors as a matrix: doubles where all products are exact, else whole numbers of any size."""
    raw = np.array([np.asarray(x, np.int64) for x in arrays])
    high = float(np.abs(raw.astype(np.float64)).max(initial=0))
    return raw.astype(np.float64 if high * high * max(1, raw.shape[1]) < EXACT else object)


def _search(queries, vectors, k: int):
    import pandas as pd

    q, v = _matrix(queries["query"]), _matrix(vectors["vector"])
    if q.dtype != v.dtype:
        q, v = q.astype(object), v.astype(object)
    if object in (q.dtype, v.dtype):
        q, v = (np.array([[int(x) for x in row] for row in m], object) for m in (q, v))
    vid, qid = vectors["vec_id"].to_numpy(np.int64), queries["query_id"].to_numpy(np.int64)
    order = np.argsort(vid, kind="stable")
    v, vid = v[order], vid[order]
    # of equal vectors only the first k + 1 ids can ever be among the k best: one is the query's own at most
    keys = {}
    spare = np.array([keys.setdefault(tuple(row), []).append(i) or len(keys[tuple(row)]) <= k + 1
                      for i, row in enumerate(v.tolist())], bool)
    v, vid = v[spare], vid[spare]
    search = Search(q, qid, v, vid, k, queries["floor"].to_numpy(np.float64))
    search.run(build(search.qf, np.arange(len(q)), QUERY_LEAF), build(search.vf, np.arange(len(v))))
    out = [(int(i), int(j), max(-(1 << 63), min((1 << 63) - 1, int(s))))
           for i, js, ss in zip(qid, search.found, search.scores, strict=True) for j, s in zip(js, ss, strict=True)]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(vec_id, vector)``: components as floor(scale * x).  Vectors that are null,
    empty or hold a null or non-finite component, and rows without an id, are left out."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.coalesce(F.forall("v", finite), F.lit(False)))
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).alias("vector"))


def _pivots(rows: DataFrame, most: int) -> dict[int, np.ndarray]:
    """By length: up to ``most`` vectors in all, taken by a hash, as a matrix."""
    picked = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(most).collect()
    out: dict[int, list] = {}
    for r in picked:
        out.setdefault(r["dim"], []).append(r["vector"])
    return {dim: np.array(vectors, np.float64) for dim, vectors in out.items()}


def _dealt(rows: DataFrame, pivots: dict[int, np.ndarray], coarse: int) -> DataFrame:
    """Every vector with its nearest pivot (``cell``), the nearest of the first
    ``coarse`` ones (``near``), its distance from the first (``away``) and its norm
    (``tall``); for queries also the products with all pivots (``at``).  Lengths
    without a pivot have the zero vector for one."""
    sent = rows.sparkSession.sparkContext.broadcast(pivots)

    def deal(frames):
        import pandas as pd

        for frame in frames:
            for dim, part in frame.groupby("dim"):
                points = np.array([np.asarray(x, np.int64) for x in part["vector"]]).astype(np.float64)
                centres = sent.value.get(int(dim), np.zeros((1, int(dim))))
                products = points @ centres.T
                gaps = (centres ** 2).sum(axis=1) - 2 * products  # squared distances but for the point's own square
                cell, near = gaps.argmin(axis=1), gaps[:, :coarse].argmin(axis=1)
                yield pd.DataFrame({
                    "vec_id": part["vec_id"], "vector": part["vector"], "dim": part["dim"], "cell": cell.astype(np.int32),
                    "near": near.astype(np.int32), "away": np.sqrt(((points - centres[cell]) ** 2).sum(axis=1)),
                    "tall": np.sqrt((points ** 2).sum(axis=1)),
                    "at": [p.tolist() if asked else None for p, asked in zip(products, part["asked"], strict=True)]})

    return rows.mapInPandas(deal, "vec_id bigint, vector array<bigint>, dim int, cell int, near int, away double, "
                                  "tall double, at array<double>")


def _split(rows: DataFrame, cell: str, name: str, most: int) -> DataFrame:
    """``rows`` with ``name``: parts of about ``most`` rows at most within a length and a cell."""
    sizes = rows.groupBy("dim", cell).agg(F.ceil(F.count("*") / most).alias("parts"))
    return rows.join(sizes, ["dim", cell]).withColumn(
        name, F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).drop("parts")


def still_open(asked: DataFrame, pieces: DataFrame, floors: DataFrame) -> DataFrame:
    """One row per query and block of vectors that may hold one of its best: all
    but the block searched first and those whose bound is below the query's floor."""
    rows = asked.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    rows = rows.select("*", F.posexplode("at").alias("cell", "product")).drop("at")
    rows = rows.join(pieces, ["dim", "cell"])
    norm, radius, tall = F.col("query_norm"), F.col("radius"), F.col("tallest")
    bound = F.least(F.col("product") + norm * radius, norm * tall) + norm * (tall + 2 * radius) * 1e-9 + 1e-6
    first = (F.col("cell") == F.col("home")) & (F.col("sub") == 0)
    return rows.filter(~first & (bound >= F.col("floor"))).drop("product", "radius", "tallest")


def top_products(table: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
                 scale: int = SCALE, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` highest integer
    inner products (all, if there are fewer), ties to the smaller id.

    Queries are the rows for which ``is_query`` (a condition on ``vec_id``) is
    true; candidates are all rows but those with the query's id.  Rows that
    repeat an id and a vector count once.  Vectors of another length than the
    query's are no candidates.  Products beyond 64 bits are cut to the nearest
    64-bit number.  Left out: see ``whole_vectors``.  Other columns are ignored.
    An empty table gives an empty result.
    """
    rows = materialize(whole_vectors(table, id_col, vector_col, scale).distinct().withColumn("dim", F.size("vector"))
                       .withColumn("asked", F.coalesce(is_query, F.lit(False))), "vectors")
    n, m, widest = rows.agg(F.count("*"), F.count(F.when(F.col("asked"), 1)), F.coalesce(F.max("dim"), F.lit(1))).first()
    most = max(1, min(PIVOTS, -(-n // block), PIVOT_COMPONENTS // widest))
    dealt = materialize(_dealt(rows, _pivots(rows, most), max(1, min(most, -(-m // query_block)))), "dealt")
    data = _split(dealt.select("vec_id", "vector", "dim", "cell", "away", "tall"), "cell", "sub", block)
    asked = _split(dealt.filter(F.col("at").isNotNull()), "near", "part", query_block).select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), "dim", "near", "part",
        F.col("cell").alias("home"), F.col("tall").alias("query_norm"), "at")
    pieces = data.groupBy("dim", "cell", "sub").agg(F.max("away").alias("radius"), F.max("tall").alias("tallest"))

    def met(left: DataFrame) -> DataFrame:
        meeting = left.select("dim", "cell", "sub", "near", "part").distinct()
        right = data.select("vec_id", "vector", "dim", "cell", "sub").join(meeting, ["dim", "cell", "sub"])

        def search(a, b):
            return _search(a, b, k) if len(a) and len(b) else a[[]].assign(query_id=[], vec_id=[], score=[]).astype("int64")

        keys = ["dim", "near", "part", "cell", "sub"]
        left = left.select(*[F.col(c).alias("query_" + c) for c in keys], "query_id", "query", "floor")
        return left.groupBy(*["query_" + c for c in keys]).cogroup(right.groupBy(*keys)).applyInPandas(
            search, "query_id bigint, vec_id bigint, score bigint")

    found = materialize(met(asked.withColumn("cell", F.col("home")).withColumn("sub", F.lit(0)).withColumn(
        "floor", F.lit(float("-inf")))), "first-block")
    if n > block:
        floors = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("floor"))
        left = still_open(asked, pieces, floors.filter(F.col("n") >= k).select("query_id", "floor"))
        found = found.unionByName(met(materialize(left, "open")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
