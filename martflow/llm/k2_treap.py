"""Ranked lexical search with K2-treaps over the term-document grid.

Documents are gathered into shards of bounded size.  A shard is a grid of terms
by documents whose points are impacts; the grid is kept as a compressed
quadtree: one 4-bit mask for each cell that is not empty, children found by
rank, and each cell's largest impact as the difference from its parent's.

An item descends the paths of all its terms together.  A state is a range of
documents with one cell for each term that occurs in it; the weighted sum of the
cells' maxima bounds every score in the range.  States are taken best first and
the search of a shard ends when the best bound is below the k-th score.  Single
documents are reached with their exact scores.

All sums are 64-bit integers.  Document counts, lengths and the documents of
each term are taken over the whole index before anything is scored.
"""
from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_of

K = 20
SHARD_DOCS = 4096  # documents of a shard, below 65,536
SHARD_TERMS = 1 << 20  # terms (with repeats) after which a shard is closed
BLOCK_TERMS = 1 << 16  # terms of a block of items
BROADCAST_BYTES = 8_000_000  # blocks of items up to this size are broadcast
SEED_SHARDS = 16  # one shard in so many is searched first, for the floors
STATES = 256  # document ranges that are opened at once
#: Bytes of a term, A-Z lower-cased; every other byte is a blank.
TERM_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
                   for b in range(256))
ONES = np.array([i.bit_count() for i in range(16)], np.int64)


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, repeats included: runs of ASCII letters and digits
    and of characters beyond ASCII."""
    return text.translate(TERM_BYTES).split()


# -------------------------------------------------------------------- treap
def _apart(x: np.ndarray) -> np.ndarray:
    """The bits of numbers below 2^31 spread to the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """Points ``(row, column, value)`` as a compressed quadtree with maxima.

    ``levels[i]`` holds, for the cells of depth ``i``, the masks of their children
    and the place of each first child at depth ``i + 1``; ``less[i]`` holds by how
    much the maximum of a cell of depth ``i + 1`` is below its parent's."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray):
        side = max(int(rows.max(initial=0)), int(columns.max(initial=0)), 1)
        self.height = side.bit_length()
        code = (_apart(rows) << np.uint64(1)) | _apart(columns)
        order = np.argsort(code, kind="stable")
        code, top = code[order], values[order].astype(np.int64)
        self.levels, self.less = [], []
        for _ in range(self.height):
            parent = code >> np.uint64(2)
            first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            masks = np.bitwise_or.reduceat((1 << (code & np.uint64(3)).astype(np.int64)), first)
            high = np.maximum.reduceat(top, first)
            less = np.repeat(high, np.diff(np.append(first, len(code)))) - top
            self.levels.append((masks.astype(np.uint8), first.astype(np.int32)))
            self.less.append(less.astype(np.min_scalar_type(int(less.max(initial=0)))))
            code, top = parent[first], high
        self.levels.reverse()
        self.less.reverse()
        self.top = int(top[0])

    def top_k(self, rows: np.ndarray, weights: np.ndarray, k: int, floor: int, ids: np.ndarray,
              states: int = STATES) -> list[tuple[int, int]]:
        """``(column, score)`` of the ``k`` best columns by the weighted sum of their
        values in ``rows``; scores above 0 and not below ``floor``; of equal scores
        the smaller ``ids``."""
        entries = np.arange(len(rows))
        value = np.full(len(rows), self.top, np.int64)
        root = (np.zeros(1, np.int64), np.array([int((weights * value).sum())]), np.zeros(len(rows), np.int64), entries,
                np.zeros(len(rows), np.int64), value)
        heap, made = [(-int(root[1][0]), 0, 0, root)], 0
        scores, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while heap:
            best, _, level, (prefix, bound, state, term, node, value) = heapq.heappop(heap)
            if -best < max(floor, 1):
                break
            good = bound >= max(floor, 1)
            if level == self.height:
                scores, found = np.concatenate([scores, bound[good]]), np.concatenate([found, prefix[good]])
                order = np.lexsort((ids[found], -scores))[:k]
                scores, found = scores[order], found[order]
                if len(scores) == k:
                    floor = max(floor, int(scores[-1]))
                continue
            if not good.all():
                kept = good[state]
                state, term, node, value = state[kept], term[kept], node[kept], value[kept]
            masks, first = self.levels[level]
            mask, start, down = masks[node].astype(np.int64), first[node], (rows[term] >> (self.height - 1 - level) & 1) * 2
            parts = []
            for half in (0, 1):
                quad = down + half
                has = np.flatnonzero(mask >> quad & 1)
                child = start[has] + ONES[mask[has] & ((1 << quad[has]) - 1)]
                parts.append((2 * state[has] + half, term[has], child, value[has] - self.less[level][child]))
            state, term, node, value = (np.concatenate(p) for p in zip(*parts))
            if not len(state):
                continue
            order = np.argsort(state, kind="stable")
            state, term, node, value = state[order], term[order], node[order], value[order]
            begin = np.flatnonzero(np.concatenate([[True], state[1:] != state[:-1]]))
            bound = np.add.reduceat(weights[term] * value, begin)
            prefix = 2 * prefix[state[begin] >> 1] + (state[begin] & 1)
            size = np.diff(np.append(begin, len(state)))
            groups = [np.arange(len(begin))]
            if len(begin) > states:  # the better ranges are opened before the others
                cut = np.argpartition(-bound, states)
                groups = [np.sort(cut[:states]), np.sort(cut[states:])]
            for group in groups:
                made += 1
                if len(groups) == 1:
                    part = (prefix, bound, np.repeat(group, size), term, node, value)
                else:
                    inside = np.zeros(len(begin), bool)
                    inside[group] = True
                    rows_in = np.repeat(inside, size)
                    part = (prefix[group], bound[group], np.repeat(np.arange(len(group)), size[group]), term[rows_in],
                            node[rows_in], value[rows_in])
                heapq.heappush(heap, (-int(part[1].max()), made, level + 1, part))
        return list(zip(found.tolist(), scores.tolist()))


# -------------------------------------------------------------------- index
def _pack(numbers: np.ndarray) -> bytes:
    kind = np.min_scalar_type(int(numbers.max(initial=0)))
    return kind.char.encode() + numbers.astype(kind).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, data[:1].decode(), offset=1).astype(np.int64)


INDEX = pa.schema([("shard", pa.string()), ("docs", pa.int64()), ("total", pa.int64()), ("ids", pa.list_(pa.int64())),
                   ("lengths", pa.binary()), ("terms", pa.list_(pa.binary())), ("dfs", pa.list_(pa.int32())),
                   ("places", pa.binary()), ("tfs", pa.binary())])


def _shard(name: str, ids: list, lengths: list[int], words: list[bytes]) -> pa.RecordBatch:
    coded = pa.array(words, pa.binary()).dictionary_encode()
    doc = np.repeat(np.arange(len(ids)), lengths)
    key, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * len(ids) + doc, return_counts=True)
    df = np.bincount(key // len(ids), minlength=len(coded.dictionary)).astype(np.int32)
    row = [name, len(ids), len(words), ids, _pack(np.array(lengths)), coded.dictionary, df, _pack(key % len(ids)), _pack(tf)]
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, INDEX)], schema=INDEX)


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS,
          shard_terms: int = SHARD_TERMS) -> DataFrame:
    """The grid of all documents with at least one term, a row for each shard: ids and
    lengths of its documents, its terms with their number of documents, and the
    documents and frequencies of each term in turn.  One pass, no shuffle; what a
    task holds is bounded by a shard and by its longest text."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(docs, text_col).cast("binary").alias("text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids, lengths, words = [], [], []
        for batch in batches:
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                found = terms(text.as_py())
                if not found:
                    continue
                ids.append(i)
                lengths.append(len(found))
                words += found
                if len(ids) >= shard_docs or len(words) >= shard_terms:
                    yield _shard(f"{part}-{made}", ids, lengths, words)
                    made += 1
                    ids, lengths, words = [], [], []
        if ids:
            yield _shard(f"{part}-{made}", ids, lengths, words)

    return rows.mapInArrow(kernel, "shard string, docs bigint, total bigint, ids array<bigint>, lengths binary, "
                                   "terms array<binary>, dfs array<int>, places binary, tfs binary")


def _asked(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item_id, term, times)`` of all items; rows of one id are one item."""
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), text_of(items, text_col).cast("binary").alias("text"))

    def kernel(batches):
        for batch in batches:
            for i, text in zip(batch.column("item_id").to_pylist(), batch.column("text")):
                if found := Counter(terms(text.as_py())):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i] * len(found), pa.int64()), pa.array(list(found), pa.binary()),
                         pa.array(list(found.values()), pa.int64())], ["item_id", "term", "times"])

    return rows.mapInArrow(kernel, "item_id bigint, term binary, times bigint").groupBy("item_id", "term").agg(
        F.sum("times").alias("times"))


# ------------------------------------------------------------------- search
def _points(row: dict, vocabulary: pa.Array, n_docs: int, n_terms: int):
    """The treap of the asked terms of a shard, and each asked term's grid row (-1: none)."""
    at = pc.index_in(vocabulary, value_set=row["terms"])
    here = np.flatnonzero(np.asarray(at.is_valid()))
    place = at.drop_null().to_numpy().astype(np.int64)
    df = row["dfs"]
    order = np.argsort(-df[place], kind="stable")  # frequent terms share cells
    here, place = here[order], place[order]
    grid = np.full(len(vocabulary), -1, np.int64)
    grid[here] = np.arange(len(here))
    if not len(here):
        return None, grid
    size = df[place]
    begin = (np.cumsum(df) - df)[place]
    take = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    doc, tf = _unpack(row["places"])[take], _unpack(row["tfs"])[take]
    damp = 100 - 25 + (25 * _unpack(row["lengths"]) * n_docs) // n_terms
    return Treap(np.repeat(np.arange(len(here)), size), doc, (1_000_000_000 * tf) // (1000 * tf + 12 * damp[doc])), grid


def _search(index_rows: DataFrame, blocks: DataFrame, parts: int, small: bool, stats: tuple[int, int], k: int) -> DataFrame:
    """``(item_id, doc_id, score)``: each shard's best documents for each item.  A
    shard meets every block of items once."""
    n_docs, n_terms = stats
    shards = index_rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    if small:
        met = shards.join(F.broadcast(blocks), "block")
    else:  # a copy of each block for every few shards, so that no block is one task
        copies = max(1, -(-index_rows.count() // 4))
        dealt = blocks.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        met = shards.withColumn("copy", F.pmod(F.xxhash64("shard"), F.lit(copies)).cast("int")).join(
            dealt.hint("merge"), ["block", "copy"])

    def kernel(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                asks = batch.column("asks")[n].values
                words = asks.field("term").dictionary_encode()
                row = {c: batch.column(c)[n].as_py() for c in ("lengths", "places", "tfs")}
                row |= {"terms": batch.column("terms")[n].values,
                        "dfs": batch.column("dfs")[n].values.to_numpy().astype(np.int64)}
                treap, grid = _points(row, words.dictionary, n_docs, n_terms)
                if treap is None:
                    continue
                ids = batch.column("ids")[n].values
                order = ids.fill_null((1 << 63) - 1).to_numpy()
                rows = grid[words.indices.to_numpy()]
                weights, floors = (asks.field(c).to_numpy() for c in ("weight", "floor"))
                item, names = _runs(asks.field("item_id"))
                found: list[tuple] = []
                for i, (a, b) in enumerate(item):
                    here = np.flatnonzero(rows[a:b] >= 0) + a
                    if len(here):
                        best = treap.top_k(rows[here], weights[here], k, int(floors[a]), order)
                        found += [(names[i], ids[d].as_py(), s) for d, s in best]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)],
                                                     ["item_id", "doc_id", "score"])

    wanted = met.select("ids", "lengths", "terms", "dfs", "places", "tfs", "asks")
    return wanted.mapInArrow(kernel, "item_id bigint, doc_id bigint, score bigint")


def _runs(ids: pa.Array) -> tuple[list[tuple[int, int]], list]:
    """Begin and end of each run of equal ids, and the ids."""
    numbers, null = ids.fill_null(0).to_numpy(), np.asarray(ids.is_null())
    turn = np.flatnonzero(np.concatenate([[True], (numbers[1:] != numbers[:-1]) | (null[1:] != null[:-1])]))
    ends = np.append(turn[1:], len(numbers))
    return list(zip(turn.tolist(), ends.tolist())), [ids[i].as_py() for i in turn.tolist()]


def ranked(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", shard_docs: int = SHARD_DOCS,
           shard_terms: int = SHARD_TERMS, block_terms: int = BLOCK_TERMS,
           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` highest-scoring documents
    with a score above 0 (all, if fewer), equal scores by ascending id, null ids last.

    The index is written to the shared folder and searched twice: one shard in
    ``SEED_SHARDS`` (by hash) first, whose k-th scores are floors for the others.
    Items meet the shards in blocks; blocks beyond ``broadcast_bytes`` in all are
    joined, not broadcast.

    Null text is the empty text; texts without terms score nowhere and do not
    count.  Texts of any length are read whole.  Rows that repeat a document id
    are documents of their own; rows that repeat an item id, or have none, are
    one item.  Other columns are ignored.  An empty table on either side gives
    an empty result.
    """
    grid = materialize(index(docs, id_col, text_col, shard_docs, shard_terms), "grid")
    asked = materialize(_asked(items, item_col, item_text), "asked")
    sums = grid.agg(F.sum("docs").alias("n"), F.sum("total").alias("l")).first()
    n_docs, n_terms = sums["n"] or 0, sums["l"] or 0
    of_shard = grid.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).select(
        F.col("t.terms").alias("term"), F.col("t.dfs").alias("df"))
    dfs = of_shard.join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df").cast("double") + 1)))
    weighed = materialize(asked.join(dfs, "term").select("item_id", "term", (F.col("times") * weight).alias("weight"))
                          .filter("weight > 0"), "weights")
    size = weighed.agg(F.count("*").alias("n"), F.sum(F.length("term") + 40).alias("bytes")).first()
    parts, small = max(1, -(-size["n"] // block_terms)), (size["bytes"] or 0) <= broadcast_bytes

    def blocks(floors: DataFrame | None) -> DataFrame:
        rows = weighed.withColumn("floor", F.lit(0).cast("long")) if floors is None else weighed.join(
            floors, weighed.item_id.eqNullSafe(floors.of_item), "left").withColumn("floor", F.coalesce("floor", F.lit(0)))
        ask = F.struct("item_id", "term", "weight", "floor")
        return rows.groupBy(F.pmod(F.xxhash64("item_id"), F.lit(parts)).cast("int").alias("block")).agg(
            F.sort_array(F.collect_list(ask)).alias("asks"))

    first = F.pmod(F.xxhash64("shard"), F.lit(SEED_SHARDS)) == 0
    by = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)

    seeds = materialize(best(_search(grid.filter(first), blocks(None), parts, small, (n_docs, n_terms), k)).drop("rank"),
                        "first-shards")
    floors = seeds.groupBy(F.col("item_id").alias("of_item")).agg(F.min("score").alias("floor"),
                                                                  F.count("*").alias("n")).filter(F.col("n") == k)
    rest = _search(grid.filter(~first), blocks(floors.drop("n")), parts, small, (n_docs, n_terms), k)
    return best(seeds.unionByName(rest)).select("item_id", "rank", "doc_id", "score")
