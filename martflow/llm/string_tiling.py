"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed (a run of ``seed`` tokens)
are tiled: Karp-Rabin hashes of runs give the longest token runs that both hold,
in rounds of falling length down to ``tile`` tokens, and these are marked so that
no token is used twice.  The covered share of the item decides, so a passage whose parts
were put in another order is still found.

The work on documents is one pass with no shuffle.  Benchmark items are sent to
the tasks in blocks of a bounded number of characters; a benchmark beyond one
block takes one pass over the documents for each block.
"""
from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

SEED, TILE, THRESHOLD = 5, 3, 0.8
BLOCK_CHARS = 8_000_000  # benchmark text that is sent to the tasks at once
TOKEN = re.compile(r"\w+")
BASES, MODULI = (1_000_003, 69_069), ((1 << 31) - 1, (1 << 31) - 19)


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


class Runs:
    """Karp-Rabin hashes of the runs of any length of a token sequence: those of
    power-of-two lengths are kept, and joined for the lengths between."""

    def __init__(self, ids: list[int]):
        self.ids = np.asarray(ids, np.uint64)
        self.powers = [[self.ids % np.uint64(m) for m in MODULI]]

    def hashes(self, length: int, starts: np.ndarray | None = None) -> np.ndarray:
        """The hash of the run at each of ``starts``, or at every place where one fits."""
        out = []
        starts = np.arange(max(0, len(self.ids) - length + 1)) if starts is None else starts
        for lane, (base, m) in enumerate(zip(BASES, MODULI, strict=True)):
            mod, value, at = np.uint64(m), np.zeros(len(starts), np.uint64), 0
            for i in range(length.bit_length()):
                if length >> i & 1:
                    value = (value * np.uint64(pow(base, 1 << i, m)) + self.power(i, lane)[starts + at]) % mod
                    at += 1 << i
            out.append(value)
        return (out[0] << np.uint64(32)) | out[1]

    def power(self, i: int, lane: int) -> np.ndarray:
        while len(self.powers) <= i:
            half, last = 1 << (len(self.powers) - 1), self.powers[-1]
            self.powers.append([(x[: max(0, len(x) - half)] * np.uint64(pow(base, half, m)) + x[half:]) % np.uint64(m)
                                for x, base, m in zip(last, BASES, MODULI, strict=True)])
        return self.powers[i][lane]


def unmarked(used: np.ndarray, length: int) -> np.ndarray:
    """Where runs of ``length`` unmarked tokens start."""
    before = np.concatenate(([0], np.cumsum(used, dtype=np.int64)))
    return np.flatnonzero(before[length:] == before[:-length])


def reached(hashes: np.ndarray, wanted: np.ndarray, length: int) -> np.ndarray:
    """The tokens inside a run of ``length`` whose hash is wanted."""
    hit = np.isin(hashes, wanted)
    edge = np.zeros(len(hashes) + length, np.int64)
    edge[: len(hit)] += hit
    edge[length:] -= hit
    return np.cumsum(edge)[:-1] > 0


def greedy_tiles(item: list[int], doc: list[int], tile: int = TILE) -> list[tuple[int, int, int]]:
    """Non-overlapping ``(item start, document start, length)``, longest first;
    among equal lengths the earlier in the item, then in the document.

    A round finds the longest length that has a common unmarked run by halving
    (a run of some length holds shorter ones), then marks the runs of that
    length in turn.  Lengths fall from round to round and add up to the item's
    at most, so there are about ``sqrt(2 * len(item))`` rounds, each nearly
    linear, however often tokens repeat.  Equal hashes are compared by tokens.
    """
    runs, others = Runs(item), Runs(doc)
    low, high = max(1, tile), min(len(item), len(doc))
    if low > high:
        return []
    # tokens outside every shared run of the least length can be in no tile
    used_item, used_doc = np.zeros(len(item), bool), ~reached(others.hashes(low), runs.hashes(low), low)
    out: list[tuple[int, int, int]] = []

    def shared(length: int) -> tuple[np.ndarray, ...] | None:
        here, there = unmarked(used_item, length), unmarked(used_doc, length)
        if not len(here) or not len(there):
            return None
        own, theirs = runs.hashes(length, here), others.hashes(length, there)
        hit = np.isin(own, theirs)
        return (here[hit], own[hit], there, theirs) if hit.any() else None

    while low <= high:
        best, found, short, long = 0, None, low, high
        while short <= long:
            middle = (short + long) // 2
            if (hit := shared(middle)) is not None:
                best, found, short = middle, hit, middle + 1
            else:
                long = middle - 1
        if found is None:
            break
        here, own, there, theirs = found
        wanted = np.isin(theirs, own)
        places: dict[int, list[int]] = defaultdict(list)
        for b, h in zip(there[wanted][::-1].tolist(), theirs[wanted][::-1].tolist(), strict=True):
            places[h].append(b)  # the earliest place is last
        for a, h in zip(here.tolist(), own.tolist(), strict=True):
            if used_item[a : a + best].any():
                continue
            left, passed = places[h], []
            while left:
                b = left.pop()
                if used_doc[b : b + best].any():
                    continue
                if item[a : a + best] == doc[b : b + best]:
                    used_item[a : a + best] = used_doc[b : b + best] = True
                    out.append((a, b, best))
                    break
                passed.append(b)  # equal hash, other tokens
            left.extend(reversed(passed))
        high = best - 1
    return out


class ItemIndex:
    """Items of one block: their tokens as numbers, and where each seed occurs."""

    def __init__(self, items: list[tuple[int, str]], seed: int):
        self.number: dict[str, int] = {}
        self.items: list[tuple[int, list[int]]] = []
        self.seeds: dict[tuple[str, ...], list[int]] = defaultdict(list)
        for name, text in items:
            words = tokens(text)
            if not words:
                continue
            k = min(seed, len(words))
            for at in range(len(words) - k + 1):
                found = self.seeds[tuple(words[at : at + k])]
                if not found or found[-1] != len(self.items):
                    found.append(len(self.items))
            self.items.append((name, [self.number.setdefault(w, len(self.number) + 1) for w in words]))
        self.first = {k[0] for k in self.seeds}
        self.lengths = sorted({len(k) for k in self.seeds})

    def candidates(self, words: list[str]) -> list[int]:
        found: set[int] = set()
        first, seeds = self.first, self.seeds
        heads = [i for i, w in enumerate(words) if w in first]
        for n in self.lengths:
            for i in heads:
                if (hit := seeds.get(tuple(words[i : i + n]))) is not None:
                    found.update(hit)
        return sorted(found)

    def coverage(self, text: str, tile: int) -> Iterator[tuple[int, float, int]]:
        """``(item, covered share, tiles)`` of every item that shares a seed."""
        words = tokens(text)
        if candidates := self.candidates(words):
            ids = [self.number.get(w, 0) for w in words]
            for at in candidates:
                name, own = self.items[at]
                tiles = greedy_tiles(own, ids, min(tile, len(own)))
                yield name, sum(t[2] for t in tiles) / len(own), len(tiles)


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in blocks of about ``block_chars`` characters."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("item"), text_of(benchmark, text_col).alias("text"))
    rows = rows.filter(F.col("item").isNotNull()).distinct()
    total = rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    pieces = max(1, -(-total // block_chars))
    for piece in range(pieces):
        part = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(pieces)) == piece)
        if block := sorted((r["item"], r["text"]) for r in part.collect()):
            yield block


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", seed: int = SEED, tile: int = TILE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(id_col, item_id, coverage, tiles)`` for every document and item that
    share a seed; an item of fewer tokens than a seed is one seed.

    Tokens are runs of word characters in lower case.  Null texts, texts and
    items without tokens and items with a null id share nothing; repeated items
    count once, an id with several texts gives a row for each.  Repeated
    documents give repeated rows, null ids stay null.  Texts are tiled whole,
    however long or repetitive; the memory of a task grows with its longest one.
    Other columns are ignored.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), text_of(docs, text_col).alias("text"))
    out_schema = f"id {rows.schema['id'].dataType.simpleString()}, item_id bigint, coverage double, tiles int"
    found = spark.createDataFrame([], out_schema)
    for block in item_blocks(benchmark, item_col, "text", block_chars):
        sent = spark.sparkContext.broadcast(block)

        def kernel(batches, sent=sent):
            index = ItemIndex(sent.value, seed)
            for batch in batches:
                hits = [(at, *hit) for at, text in enumerate(batch.column("text"))
                        for hit in index.coverage(text.as_py(), tile)]
                at, items, shares, tiles = list(zip(*hits, strict=True)) or ([], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at, pa.int64())), pa.array(items, pa.int64()),
                     pa.array(shares, pa.float64()), pa.array(tiles, pa.int32())],
                    ["id", "item_id", "coverage", "tiles"])

        found = found.unionByName(rows.mapInArrow(kernel, out_schema))
    return found.select(F.col("id").alias(id_col), "item_id", "coverage", "tiles")


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``(doc_id, item_id, coverage, tiles)`` where an item is covered to at
    least ``threshold``."""
    return overlaps(docs, benchmark, **options).filter(F.col("coverage") >= threshold)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
          threshold: float = THRESHOLD, seed: int = SEED, tile: int = TILE,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that cover no item to the threshold, all columns.
    Each row is judged by its own text, whatever its id; see ``overlaps``."""
    kept, at = docs, docs.columns.index(text_col)
    for block in item_blocks(benchmark, item_col, "text", block_chars):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def kernel(batches, sent=sent):
            index = ItemIndex(sent.value, seed)
            for batch in batches:
                texts = (t.as_py() or "" for t in batch.column(at))
                yield batch.filter(pa.array([all(hit[1] < threshold for hit in index.coverage(t, tile))
                                             for t in texts], pa.bool_()))

        kept = kept.mapInArrow(kernel, docs.schema)
    return kept
