"""Near-duplicates by SimHash, found through Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits.  Two
fingerprints that differ in at most three bits differ in at most one bit in
two of the three segments.  The perfect binary Golay code (23, 12) maps a
segment to the index of its nearest codeword; a segment and a one-bit
neighbour need not share it, but the index of one is always among the few
indices (one or six) of the other's one-bit neighbourhood.  So each fingerprint
is stored under one pair of indices for each pair of segments (3 rows) and
looked up under all pairs of its neighbourhood indices (about 80 rows); an equi
join finds the candidates and the bit distance verifies them.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, quoted, text_of
from .components import components

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
PAIRS = ((0, 1), (0, 2), (1, 2))
HASH_SEED = 42
BLOCK = 2048  # stored fingerprints of one key that are compared in one piece
CHUNK = 1 << 16  # shingles counted at a time
GENERATOR = 0xC75  # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


# ------------------------------------------------------------- fingerprints
def shingle_hashes(text: str, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of all word shingles, repeats included, some at a time."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts, k = ends - size, min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(starts), CHUNK):
        spans = zip(starts[i : i + CHUNK].tolist(), ends[i : i + CHUNK].tolist())
        yield np.array([digest(joined[s:e], HASH_SEED) for s, e in spans], np.uint64)


def simhash(text: str, shingle: int) -> int:
    """A bit is 1 if it is set in over half of the hashes; no words: 0."""
    total, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text, shingle):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(id_col, fp)`` for every row; ``fp`` is the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(docs, text_col).alias("text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [simhash(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps, pa.int64())], ["id", "fp"])

    return rows.mapInArrow(kernel, f"id {rows.schema['id'].dataType.simpleString()}, fp bigint")


# --------------------------------------------------------------- Golay keys
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and the high 11 bits, and the error of each remainder."""
    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    low = np.array([remainder(i) for i in range(1 << 12)], np.uint16)
    high = np.array([remainder(i << 12) for i in range(1 << 11)], np.uint16)
    error = np.zeros(1 << 11, np.uint32)
    flips = [1 << i for i in range(23)]
    for a in range(23):
        for b in range(a, 23):
            for c in range(b, 23):
                e = 0
                for bit in {a, b, c}:
                    e |= flips[bit]
                error[low[e & 0xFFF] ^ high[e >> 12]] = e
    return low, high, error


def codeword_index(words: np.ndarray, tables) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    low, high, error = tables
    return (words ^ error[low[words & 0xFFF] ^ high[words >> 12]]) >> np.uint32(11)


def segment_keys(fps: np.ndarray, tables) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """By segment: the own index, and the indices of the one-bit neighbourhood
    as a matrix whose repeats are -1."""
    own, near = [], []
    for first, bits in SEGMENTS:
        word = ((fps.view(np.uint64) >> np.uint64(first)) & np.uint64((1 << bits) - 1)).astype(np.uint32)
        flips = np.array([0] + [1 << i for i in range(bits)], np.uint32)
        around = np.sort(codeword_index(word[:, None] ^ flips[None, :], tables).astype(np.int64), axis=1)
        around[:, 1:][around[:, 1:] == around[:, :-1]] = -1
        around = -np.sort(-around, axis=1)
        own.append(codeword_index(word, tables).astype(np.int64))
        near.append(around[:, : max(1, int((around >= 0).sum(axis=1).max(initial=1)))])
    return own, near


def keys_of(fps: DataFrame, wide: bool) -> DataFrame:
    """``(key, fp)``: the one stored key (``wide=False``) or all looked-up keys
    of each pair of segments."""
    tables = golay_tables()

    def kernel(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = batch.column("fp").slice(at, 4096).to_numpy(zero_copy_only=False).astype(np.int64)
                own, near = segment_keys(fp, tables)
                for p, (i, j) in enumerate(PAIRS):
                    a, b = (near[i], near[j]) if wide else (own[i][:, None], own[j][:, None])
                    key = (p << 24) | (a[:, :, None] << 12) | b[:, None, :]
                    good = (a[:, :, None] >= 0) & (b[:, None, :] >= 0)
                    rep = np.broadcast_to(fp[:, None, None], good.shape)
                    yield pa.RecordBatch.from_arrays([pa.array(key[good]), pa.array(rep[good])], ["key", "fp"])

    return fps.select("fp").mapInArrow(kernel, "key bigint, fp bigint")


# -------------------------------------------------------------------- links
def _spanning(left: np.ndarray, right: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two blocks: as many rows as
    fingerprints at most, and the same components as all links."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for x in left.tolist():
        close = right[np.bitwise_count((right ^ np.int64(x)).view(np.uint64)) <= max_bits]
        for y in close.tolist():
            if (a := root(x)) != (b := root(y)):
                parent[max(a, b)] = min(a, b)
                out.append((x, y))
    return out


def _hot_links(stored: DataFrame, looked: DataFrame, hot: DataFrame, block: int, max_bits: int) -> DataFrame:
    """Links below keys that many fingerprints are stored under, block by block."""
    pieces = hot.select("key", F.ceil(F.col("count") / block).cast("int").alias("pieces"))
    where = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    left = looked.join(pieces, "key").select("key", where.alias("q"), "fp", F.explode(
        F.sequence(F.lit(0), F.col("pieces") - 1)).alias("s"))
    right = stored.join(pieces, "key").select("key", where.alias("s"), "fp", F.explode(
        F.sequence(F.lit(0), F.col("pieces") - 1)).alias("q"))

    def links(a, b):
        import pandas as pd

        found = _spanning(np.unique(a["fp"].to_numpy(np.int64)), np.unique(b["fp"].to_numpy(np.int64)), max_bits)
        return pd.DataFrame(found, columns=["u", "v"]).astype("int64")

    by = ["key", "s", "q"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(links, "u bigint, v bigint")


def links(fps: DataFrame, max_bits: int = 3, block: int = BLOCK) -> DataFrame:
    """``(u, v)``: links between different fingerprints at ``max_bits`` or fewer
    differing bits.  Keys that hold over ``block`` stored fingerprints give a
    spanning forest of their links instead of every pair."""
    if not 0 <= max_bits <= 3:
        raise ValueError("three segments prove links of at most 3 differing bits")
    stored = materialize(keys_of(fps, wide=False), "stored-keys")
    hot = materialize(stored.groupBy("key").count().filter(F.col("count") > block), "hot-keys")
    looked, cold = keys_of(fps, wide=True), stored
    any_hot = not hot.isEmpty()
    if any_hot:
        cold = stored.join(hot.select("key"), "key", "left_anti")
    # the planner knows the size of the fingerprints, not of their many keys, so it must not choose to broadcast these
    near = cold.select("key", F.col("fp").alias("u")).join(
        looked.select("key", F.col("fp").alias("v")).hint("merge"), "key")
    found = near.filter((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))
    found = found.select("u", "v")
    return found.unionByName(_hot_links(stored, looked, hot, block, max_bits)) if any_hot else found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 3, block: int = BLOCK) -> DataFrame:
    """One row per document: ``(id_col, fp, root, component_id, group_docs)``.

    ``fp`` is the signed fingerprint, ``root`` the least fingerprint of its
    component, ``component_id`` the smallest id in the component and
    ``group_docs`` the component's number of rows.  Exact copies meet in one
    fingerprint before any key is made, so they cost nothing afterwards.

    Null text is the empty text; texts without words have fingerprint zero and
    link like any other.  Rows with repeated ids each get a row; a null id keeps
    its row and never names a component unless all ids of it are null.  Other
    columns are ignored.  An empty table gives an empty result.
    """
    marked = materialize(with_fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    fps = materialize(marked.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("docs")), "distinct-fps")
    nodes = components(links(fps, max_bits, block), "u", "v")
    rooted = fps.join(nodes, fps.fp == nodes.node, "left").select(
        "fp", "least", "docs", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("docs").alias("group_docs"))
    of_fp = materialize(rooted.select("fp", "root").join(groups, "root"), "fp-components")
    return marked.join(of_fp, "fp").select(F.col("id").alias(id_col), "fp", "root", "component_id", "group_docs")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` with one document kept of each group: the one with
    the smallest id.  All columns are kept.

    An id that occurs on several rows, or is null, does not name a row; such
    rows are told apart by their fingerprints, and of equal ones one is kept.
    """
    found = materialize(near_duplicates(docs, id_col, text_col, shingle, max_bits), "groups")
    winner = found.groupBy("root").agg(F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
                                                      "fp")).alias("w"))
    winner = winner.select(F.col("w.id").alias("win_id"), F.col("w.fp").alias("win_fp"))
    of_id = found.groupBy(id_col).agg(F.count("*").alias("id_rows"))
    won = materialize(of_id.join(winner, of_id[id_col].eqNullSafe(winner.win_id)).select("win_id", "win_fp", "id_rows"),
                      "winners")
    clear = won.filter("id_rows = 1 AND win_id IS NOT NULL").select("win_id")
    # the ids grow with the documents, so they are merged at every size
    kept = docs.join(clear.hint("merge"), docs[id_col] == clear.win_id, "left_semi")
    vague = won.filter("id_rows > 1 OR win_id IS NULL").select("win_id", "win_fp")
    if vague.isEmpty():
        return kept
    ids = vague.select(F.col("win_id").alias("vague_id")).distinct()
    rows = docs.join(ids, docs[id_col].eqNullSafe(ids.vague_id), "left_semi")
    packed = rows.select(F.col(id_col).alias("row_id"), F.col(text_col).alias("row_text"),
                         F.struct(*[quoted(c) for c in docs.columns]).alias("row"))

    def mark(batches):
        for batch in batches:
            fps = [simhash(t or "", shingle) for t in batch.column("row_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), pa.array(fps, pa.int64()), batch.column("row")],
                                             ["row_id", "row_fp", "row"])

    kinds = {f.name: f.dataType.simpleString() for f in packed.schema}
    marked = packed.mapInArrow(mark, f"row_id {kinds['row_id']}, row_fp bigint, row {kinds['row']}")
    same = marked.row_id.eqNullSafe(vague.win_id) & (marked.row_fp == vague.win_fp)
    first = marked.join(vague, same).groupBy("row_id", "row_fp").agg(F.first("row").alias("row"))
    return kept.unionByName(first.select("row.*"))
