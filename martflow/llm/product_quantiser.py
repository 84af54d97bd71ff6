"""Near-duplicate embeddings by product quantisation.

Unit vectors are dealt to inverted lists by their nearest coarse centroid; what
is left of a vector (the residual) is coded in subspaces of four dimensions by one
of 16 codewords each.  Two vectors link at a cosine of ``least`` or more, that
is within the distance ``reach = sqrt(2 - 2 * least)``.

Sufficient probes.  The border between the cells of two centroids is a plane.  A
link across it is at least as long as both vectors' distances to the plane
together, so one of the two is within half of ``reach`` of it.  A vector
therefore probes its own list and every list whose border is that near; no link
between two lists is missed, whichever of the two finds it.

In a probed list a vector's distances to all coded members come from a table of
its residual's distances to the codewords (asymmetric: the probing vector is not
coded).  A member whose coded distance less its own coding error is beyond
``reach`` cannot link; the cosines of all others are computed exactly.

Equal vectors of a label are one entry with a count.  A pair of a list's piece
and a piece of its probing vectors is one group of bounded size; it gives link
counts and a spanning forest, not pairs.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import components

LEAST = 0.93
FIT_ROWS = 16384  # about so many entries fit the centroids and codewords
MAX_LISTS = 2048
SUBSPACE, CODEWORDS, ROUNDS = 4, 16, 8
PIECE, PROBE_PIECE = 1024, 4096  # members and probing vectors of one group
SLACK = 1e-9


# ---------------------------------------------------------------- quantiser
def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in doubles; no component may overflow."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows ** 2).sum(axis=1, keepdims=True))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a ** 2).sum(axis=1)[:, None] + (b ** 2).sum(axis=1)[None, :] - 2 * a @ b.T, 0)


def k_means(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres from evenly spread first ones; a centre without points stays."""
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = _squares(points, centres).argmin(axis=1)
        count = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
    return centres


class Quantiser:
    """Coarse centroids and codewords of one dimension.  Without a sample there is
    one centroid and one codeword, zero."""

    def __init__(self, dim: int, sample: np.ndarray, lists: int):
        self.cuts = [(i, min(i + SUBSPACE, dim)) for i in range(0, dim, SUBSPACE)]
        if len(sample):
            self.coarse = np.unique(k_means(sample, min(lists, len(sample))), axis=0)
            left = sample - self.coarse[_squares(sample, self.coarse).argmin(axis=1)]
            self.words = [k_means(left[:, a:b], min(CODEWORDS, len(left))) for a, b in self.cuts]
        else:
            self.coarse = np.zeros((1, dim))
            self.words = [np.zeros((1, b - a)) for a, b in self.cuts]
        self.apart = np.sqrt(_squares(self.coarse, self.coarse))
        np.fill_diagonal(self.apart, 1)

    def encode(self, rows: np.ndarray, reach: float):
        """Own list, probed lists (own included), codes and coding error of each row."""
        away = _squares(rows, self.coarse)
        cell = away.argmin(axis=1)
        own = away[np.arange(len(rows)), cell]
        border = (away - own[:, None]) / (2 * self.apart[cell])
        left = rows - self.coarse[cell]
        codes = np.empty((len(rows), len(self.cuts)), np.uint8)
        error = np.zeros(len(rows))
        for s, (a, b) in enumerate(self.cuts):
            far = _squares(left[:, a:b], self.words[s])
            codes[:, s] = far.argmin(axis=1)
            error += ((left[:, a:b] - self.words[s][codes[:, s]]) ** 2).sum(axis=1)
        return cell, border <= reach / 2 + SLACK, codes, np.sqrt(error)

    def candidates(self, rows: np.ndarray, cell: int, codes: np.ndarray, error: np.ndarray, reach: float) -> np.ndarray:
        """Which members of a list each row may link with, by table look-up."""
        left = rows - self.coarse[cell]
        coded = np.zeros((len(rows), len(codes)))
        for s, (a, b) in enumerate(self.cuts):
            coded += _squares(left[:, a:b], self.words[s])[:, codes[:, s]]
        return np.sqrt(coded) - error[None, :] <= reach + SLACK


def _fit(entries: DataFrame, n: int, fit_rows: int, max_lists: int) -> dict[int, Quantiser]:
    """A quantiser for each dimension in a sample of about ``fit_rows`` entries (by hash).
    The number of lists grows with the square root of the entries up to ``max_lists``."""
    share = min(1.0, fit_rows / max(1, n))
    chosen = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = entries.filter(chosen).select("node", "embedding").toPandas().sort_values("node")
    by_dim: dict[int, list] = {}
    for v in rows["embedding"]:
        by_dim.setdefault(len(v), []).append(v)
    lists = max(1, min(max_lists, math.isqrt(n)))
    return {d: Quantiser(d, unit(np.array(v, np.float64)), max(1, lists * len(v) // len(rows))) for d, v in by_dim.items()}


# ------------------------------------------------------------------- entries
def usable(vector: str):
    """Not null, not empty, not zero, all components finite."""
    v = F.col(vector)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))


CODED = pa.schema([("node", pa.int64()), ("docs", pa.int64()), ("group", pa.int64()), ("dim", pa.int32()),
                   ("cell", pa.int32()), ("raw", pa.binary()), ("codes", pa.binary()), ("error", pa.float64()),
                   ("probes", pa.list_(pa.int32()))])
CODED_DDL = ("node bigint, docs bigint, group bigint, dim int, cell int, raw binary, codes binary, error double, "
             "probes array<int>")


def _coded(entries: DataFrame, quantisers: dict[int, Quantiser], reach: float, kind: str) -> DataFrame:
    def kernel(batches):
        for batch in batches:
            vectors = batch.column("embedding")
            dims = vectors.value_lengths().to_numpy()
            for dim in np.unique(dims).tolist():
                for at in np.array_split(rows := np.flatnonzero(dims == dim), -(-len(rows) // 1024)):
                    part = vectors.take(pa.array(at))
                    raw = part.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)
                    quantiser = quantisers.get(dim) or Quantiser(dim, np.zeros((0, dim)), 1)
                    cell, near, codes, error = quantiser.encode(unit(raw), reach)
                    ends = np.concatenate([[0], np.cumsum(near.sum(axis=1))]).astype(np.int32)
                    probes = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(near)[1].astype(np.int32)))
                    old = [batch.column(c).take(pa.array(at)) for c in ("node", "docs", "group")]
                    yield pa.RecordBatch.from_arrays(
                        old + [pa.array(np.full(len(at), dim, np.int32)), pa.array(cell.astype(np.int32)),
                               pa.array([r.tobytes() for r in raw], pa.binary()),
                               pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), probes], schema=CODED)

    return entries.select("node", "docs", "group", "embedding").mapInArrow(kernel, CODED_DDL)


# --------------------------------------------------------------------- links
def _joined(column, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), width)


def _forest(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a bipartite 0/1 matrix whose sides may share nodes."""
    nodes, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    mark, out = np.arange(len(nodes)), []
    of_left, of_right = place[: len(left)], place[len(left):]
    for i in np.flatnonzero(links.any(axis=1)).tolist():
        ends = of_right[links[i]]
        parts, first = np.unique(mark[ends], return_index=True)
        own = mark[of_left[i]]
        other = parts != own
        if not other.any():
            continue
        out += [(int(left[i]), int(nodes[e])) for e in ends[first[other]].tolist()]
        joined = np.zeros(len(nodes), bool)
        joined[parts], joined[own] = True, True
        mark[joined[mark]] = min(own, parts[0])
    return out


def group_links(asks, members, quantiser: Quantiser, cell: int, least: float, kind: str):
    """Links of probing vectors with members of one list: ``(u, v, n)`` rows, where
    ``v`` is -1 for the ``n`` vectors that ``u`` links with, else an edge of the forest."""
    reach, dim = math.sqrt(2 - 2 * least), quantiser.coarse.shape[1]
    x, y = (unit(_joined(side["raw"].tolist(), kind, dim)) for side in (asks, members))
    codes, error = _joined(members["codes"].tolist(), "u1", len(quantiser.cuts)), members["error"].to_numpy(np.float64)
    xs, ys = asks["node"].to_numpy(np.int64), members["node"].to_numpy(np.int64)
    home, docs = asks["cell"].to_numpy(np.int64), members["docs"].to_numpy(np.int64)
    asked_docs = asks["docs"].to_numpy(np.int64)
    size = [len(p) for p in members["probes"]]
    owner, probed = np.repeat(np.arange(len(ys)), size), np.concatenate(members["probes"].tolist())
    counts, back, edges = np.zeros(len(xs), np.int64), np.zeros(len(ys), np.int64), []
    for at in range(0, len(xs), 512):
        part = slice(at, at + 512)
        links = quantiser.candidates(x[part], cell, codes, error, math.sqrt(2 - 2 * least)) & (xs[part, None] != ys[None, :])
        i, j = np.nonzero(links)
        for b in range(0, len(i), 1 << 14):
            a, c = i[b : b + (1 << 14)], j[b : b + (1 << 14)]
            links[a, c] = (x[part][a] * y[c]).sum(axis=1) >= least
        if not links.any():
            continue
        counts[part] += links @ docs
        for other in np.unique(home[part][links.any(axis=1)]).tolist():
            if other != cell:  # members that probe that list too count their links there
                silent = np.ones(len(ys), bool)
                silent[owner[probed == other]] = False
                of_other = home[part] == other
                back += silent * (asked_docs[part][of_other] @ links[of_other])
        edges += _forest(links, xs[part], ys)
    u, n = np.concatenate([xs, ys]), np.concatenate([counts, back])
    u, n = u[n > 0], n[n > 0]
    return (np.concatenate([u, np.array([e[0] for e in edges], np.int64)]),
            np.concatenate([np.full(len(u), -1), np.array([e[1] for e in edges], np.int64)]),
            np.concatenate([n, np.zeros(len(edges), np.int64)]))


def _links(coded: DataFrame, quantisers: dict[int, Quantiser], least: float, kind: str, piece: int,
           probe_piece: int) -> DataFrame:
    """``(u, v, n)`` over all lists; a list beyond ``piece`` members, or with more than
    ``probe_piece`` probing vectors, is cut into pieces that meet in pairs."""
    by = ["group", "dim", "list"]
    members = coded.withColumnRenamed("cell", "list")
    asks = coded.select("node", "docs", "group", "dim", "cell", "raw", F.explode("probes").alias("list"))
    sizes = members.groupBy(by).count().withColumnRenamed("count", "members").join(
        coded.select("group", "dim", F.explode("probes").alias("list")).groupBy(by).count(), by)
    # a lone member that nobody else probes has no links
    sizes = materialize(sizes.filter("members > 1 OR count > 1").select(
        *by, F.ceil(F.col("members") / piece).cast("int").alias("parts"),
        F.ceil(F.col("count") / probe_piece).cast("int").alias("rounds")), "list-sizes")

    def dealt(side: DataFrame, own: str, pieces: str, other: str, others: str) -> DataFrame:
        return side.join(sizes, by).withColumn(own, F.pmod(F.xxhash64("node"), F.col(pieces)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(others) - 1)))

    left = dealt(asks, "round", "rounds", "part", "parts").select(
        *[F.col(c).alias("ask_" + c) for c in (*by, "part", "round", "node", "docs", "cell", "raw")])
    right = dealt(members, "part", "parts", "round", "rounds").select(*by, "part", "round", "node", "docs", "raw", "codes",
                                                                     "error", "probes")
    keys = [*by, "part", "round"]

    def kernel(key, a, b):
        import pandas as pd

        if not len(a) or not len(b):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in "uvn"})
        dim, cell = int(key[1]), int(key[2])
        quantiser = quantisers.get(dim) or Quantiser(dim, np.zeros((0, dim)), 1)
        a = a.rename(columns=lambda c: c.removeprefix("ask_"))
        return pd.DataFrame(dict(zip("uvn", group_links(a, b, quantiser, cell, least, kind))))

    met = left.groupBy(*["ask_" + c for c in keys]).cogroup(right.groupBy(*keys))
    return met.applyInPandas(kernel, "u bigint, v bigint, n bigint")


def near_duplicates(table: DataFrame, least: float = LEAST, id_col: str = "vec_id", vector_col: str = "embedding",
                    group_col: str = "label", fit_rows: int = FIT_ROWS, max_lists: int = MAX_LISTS, piece: int = PIECE,
                    probe_piece: int = PROBE_PIECE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``table``.

    Rows link when their groups are equal and not null, their vectors are of
    equal length and the cosine in doubles is ``least`` or more (above 0).
    ``n_links`` counts the other rows linked directly; ``component_id`` is the
    smallest id reachable, itself included; ``kept`` tells whether that is the
    row's own.

    Vectors that are null, empty or zero or that hold a null or non-finite
    component link with nothing.  Rows that repeat an id are rows of their own; a
    row without an id counts as a link and never names a component unless no id of
    it is known (``kept`` is then false).  Other columns are ignored.  An empty
    table gives an empty result.

    All rows are coded and compared; only the quantiser is fitted on a sample
    (``fit_rows``).  Its fit has no influence on the result, only on the work.
    """
    if not 0 < least <= 1:
        raise ValueError("a cosine above 0 and not above 1")
    kind = "<f4" if dict(table.dtypes)[vector_col] == "array<float>" else "<f8"
    double = "float" if kind == "<f4" else "double"
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(group_col).cast("long").alias("group"),
                        F.col(vector_col).cast(f"array<{double}>").alias("embedding"))
    takes_part = usable("embedding") & F.col("group").isNotNull()
    same = rows.filter(takes_part).groupBy("group", "embedding").agg(F.min("vec_id").alias("least_id"),
                                                                     F.count("*").alias("docs"))
    entries = materialize(same.withColumn("node", F.monotonically_increasing_id()), "entries")
    n = entries.count()
    quantisers = _fit(entries, n, fit_rows, max_lists)
    coded = materialize(_coded(entries, quantisers, math.sqrt(2 - 2 * least), kind), "coded")
    found = materialize(_links(coded, quantisers, least, kind, piece, probe_piece), "links")
    linked = found.filter("v < 0").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    roots = materialize(components(found.filter("v >= 0"), "u", "v"), "roots")
    of_node = entries.select("node", "least_id", "docs").join(linked, "node", "left").join(roots, "node", "left").select(
        "node", "least_id", "docs", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("root", "node").alias("root"))
    smallest = materialize(of_node.groupBy("root").agg(F.min("least_id").alias("component_id")), "components")
    named = materialize(of_node.join(smallest, "root").select(
        "node", (F.col("n") + F.col("docs") - 1).alias("n_links"), "component_id"), "named")
    per_entry = entries.join(named, "node").select("group", "embedding", "n_links", "component_id")
    part = rows.filter(takes_part).join(per_entry, ["group", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~takes_part).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id"))
    return part.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
