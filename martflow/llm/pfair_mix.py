"""Mixing sources to target weights by Pfair scheduling.

A source with ``u`` of ``period`` weight units owns the blocks ``0, 1, 2, ...``
of its documents.  Block ``k`` is released at slot ``floor(k * period / u)``
and due at ``ceil((k + 1) * period / u)``; taking the released block with the
earliest deadline at every slot keeps each source less than one block away from
its share at all times.  All lags are zero again after ``period`` slots, so one
period is scheduled, from the weights alone, and the place of every block
follows by arithmetic in a join with that small table.  Weights with a common
denominator up to ``EXACT_PERIOD`` (1/3 and 2/3, or whole percents) are scheduled
exactly; other weights are rounded to whole units of ``period``, and the promise
of less than a block holds for the rounded ones.  When a source has no
block left, a new phase begins with the weights of the others.

Documents are numbered within their source by pieces of bounded size and the
running totals of the pieces, so a source that holds most rows is split.
"""
from __future__ import annotations

import heapq
import json
import math
from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

PERIOD, BLOCK_ROWS, PIECE_ROWS, TEMPERATURE = 1024, 16, 4096, 0.7
EXACT_PERIOD = 1 << 14  # weights that are whole in a period up to this one are kept exactly


def units_of(weights: Mapping, period: int) -> dict:
    """Whole weight units that sum to ``period`` by largest remainders, at least one each."""
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    units = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(weights, key=lambda s: (int(exact[s]) - exact[s], repr(s)))
    left = period - sum(units.values())
    at = 0
    while left > 0:
        units[order[at % len(order)]] += 1
        left, at = left - 1, at + 1
    while left < 0:
        largest = max(units, key=lambda s: (units[s], repr(s)))
        take = min(-left, max(1, units[largest] // 2))
        units[largest] -= take
        left += take
    return units


def exact_period(weights: Mapping, most: int = EXACT_PERIOD) -> int | None:
    """The least period in which every weight is a whole number of blocks, if there is
    one up to ``most``: a share is taken as the fraction of a denominator up to
    ``most`` that a float can mean by it."""
    shares = {s: Fraction(w).limit_denominator(most) for s, w in weights.items()}
    if any(not f or abs(float(f) - w) > 1e-12 * w for f, w in zip(shares.values(), weights.values())):
        return None
    total = sum(shares.values())
    period = 1
    for f in shares.values():
        period = math.lcm(period, (f / total).denominator)
        if period > most:
            return None
    return period


def one_period(units: Mapping, period: int) -> dict:
    """Slots of every source's blocks within one period: earliest deadline first
    among the released blocks, ties by source."""
    names = sorted(units, key=repr)
    window = lambda s, k: (k * period // units[s], -(-(k + 1) * period // units[s]))
    waiting = [(window(s, 0)[0], i, 0) for i, s in enumerate(names)]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    slots: dict = {s: [] for s in names}
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (window(names[i], k)[1], i, k))
        due, i, k = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a block missed its deadline")
        slots[names[i]].append(slot)
        if k + 1 < units[names[i]]:
            heapq.heappush(waiting, (window(names[i], k + 1)[0], i, k + 1))
    return slots


def phases(blocks: Mapping, weights: Mapping, period: int | None) -> list[dict]:
    """Phases of the mix: the first slot, how many slots, and by source the
    first block, how many blocks and its slots in a period.  Without a ``period``
    the exact one is taken where there is one, else ``PERIOD``."""
    left = {s: n for s, n in blocks.items() if n}
    done = dict.fromkeys(left, 0)
    out, start = [], 0
    while left:
        size = period or exact_period({s: weights[s] for s in left})
        if size is None or period:
            size = size or PERIOD
            size = max(size, 1 << (4 * len(left) - 1).bit_length()) if 4 * len(left) > size else size
        units = units_of({s: weights[s] for s in left}, size)
        slots = one_period(units, size)
        last = {s: (n - 1) // units[s] * size + slots[s][(n - 1) % units[s]] for s, n in left.items()}
        length = min(last.values()) + 1
        taken = {s: length // size * units[s] + sum(x < length % size for x in slots[s]) for s in left}
        out.append({"start": start, "period": size, "sources": {s: (done[s], taken[s], slots[s]) for s in left}})
        for s, n in taken.items():
            done[s] += n
        left = {s: n - taken[s] for s, n in left.items() if n > taken[s]}
        start += length
    return out


def _numbered(docs: DataFrame, id_col: str, source_col: str, piece_rows: int) -> DataFrame:
    """``(id, source, nth)``: the place of every row within its source, in a
    hashed order of ids that does not depend on the number of tasks."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"))
    total = rows.count()
    pieces = max(1, -(-total // piece_rows))
    rows = rows.withColumn("order", F.xxhash64("id")).withColumn("piece", F.pmod(F.col("order"), F.lit(pieces)))
    tally = rows.groupBy("source", "piece").agg(F.count("*").alias("n"))
    # pieces of a source are summed in two steps: no window holds more than about 2 * sqrt(pieces) of them
    group = max(1, int(pieces ** 0.5))
    tally = materialize(tally.withColumn("far", F.floor(F.col("piece") / group)), "mix-tally")
    far = tally.groupBy("source", "far").agg(F.sum("n").alias("m"))
    far = far.withColumn("far_before", F.coalesce(F.sum("m").over(
        Window.partitionBy("source").orderBy("far").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    near = tally.withColumn("near_before", F.coalesce(F.sum("n").over(
        Window.partitionBy("source", "far").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = near.join(far, near["source"].eqNullSafe(far["source"]) & (near["far"] == far["far"])).select(
        near["source"].alias("s"), near["piece"].alias("p"), (F.col("far_before") + F.col("near_before")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("source", "piece").orderBy("order", "id"))
    ranked = rows.withColumn("rank", rank)
    joined = ranked.join(before, ranked["source"].eqNullSafe(before["s"]) & (ranked["piece"] == before["p"]))
    return joined.select("id", "source", (F.col("before") + F.col("rank") - 1).alias("nth"))


def mix_order(docs: DataFrame, weights: Mapping[str | None, float] | None = None, id_col: str = "doc_id",
              source_col: str = "source", block_rows: int = BLOCK_ROWS, period: int | None = None,
              temperature: float = TEMPERATURE, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``(id_col, source_col, block, phase, release, deadline, slot, place)`` for
    every row; ``place`` numbers the mixed stream (0, 1, ... with gaps where a
    source's last block is short).

    ``weights`` gives the target share of each source (sources it does not name
    get none, and follow when the named ones are used up, by their sizes);
    without it the share is the source's size to the power ``temperature``.
    Release, deadline and slot count blocks from the phase's start, so within a
    phase every source stays less than one block from its share.  No row is
    dropped or repeated.

    A null source is a source of its own, null ids and repeated rows keep their
    places; ties go by id and then by source name.  Other columns are ignored.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = materialize(_numbered(docs, id_col, source_col, piece_rows), "mix-rows")
    counts = {r["source"]: r["count"] for r in rows.groupBy("source").count().collect()}
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    if weights is None:
        plan = phases(blocks, {s: n ** temperature for s, n in counts.items()}, period)
    else:
        named = {s: n for s, n in blocks.items() if weights.get(s, 0) > 0}
        plan = phases(named, weights, period)
        rest = {s: n for s, n in blocks.items() if s not in named}
        after = sum(named.values())
        plan += [{**p, "start": p["start"] + after} for p in phases(rest, counts, period)]
    parts = [{"phase": i, "s": source, "low": first, "high": first + taken, "start": phase["start"],
              "period": phase["period"], "slots": own}
             for i, phase in enumerate(plan) for source, (first, taken, own) in phase["sources"].items()]
    kind = "array<struct<phase:int,s:string,low:bigint,high:bigint,start:bigint,period:bigint,slots:array<bigint>>>"
    part = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(parts)), kind)))
    block = rows.withColumn("block", F.floor(F.col("nth") / block_rows))
    placed = block.join(part, block["source"].eqNullSafe(part["s"]) & (F.col("block") >= F.col("low"))
                        & (F.col("block") < F.col("high")))
    placed = placed.select("*", (F.col("block") - F.col("low")).alias("k"), F.size("slots").cast("long").alias("units"))
    run = F.expr("k div units * period + slots[cast(k % units as int)]")
    return placed.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), F.col("block").cast("long").alias("block"), "phase",
        F.expr("(k * period) div units").alias("release"),
        F.expr("((k + 1) * period + units - 1) div units").alias("deadline"), run.alias("slot"),
        ((F.col("start") + run) * block_rows + F.pmod(F.col("nth"), F.lit(block_rows))).alias("place"))


def mixed(docs: DataFrame, weights: Mapping[str | None, float] | None = None, id_col: str = "doc_id",
          source_col: str = "source", **options) -> DataFrame:
    """``docs`` in mixed order: ranges of places go to consecutive tasks, sorted,
    so files written from it hold the stream in turn.  Columns and rows are kept.

    Rows take their places by id and source; rows that repeat both share the
    first of their places.
    """
    order = materialize(mix_order(docs, weights, id_col, source_col, **options).select(
        F.col(id_col).alias("mix_id"), F.col(source_col).alias("mix_source"), F.col("place").alias("mix_place")),
        "mix-order")
    first = order.groupBy("mix_id", "mix_source").agg(F.min("mix_place").alias("mix_place"))
    same = docs[id_col].eqNullSafe(first["mix_id"]) & docs[source_col].cast("string").eqNullSafe(first["mix_source"])
    placed = docs.join(first, same)
    return placed.repartitionByRange(first["mix_place"]).sortWithinPartitions(first["mix_place"]).select(
        *[docs[c] for c in docs.columns])
