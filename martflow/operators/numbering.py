"""Ordinals and totals within a key whose group may be too large for one task."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.session import scratch_path

GIANT = 100_000  # rows of one key that a window may hold


BUCKETS = 1 << 16


def largest_group(df: DataFrame, *key: Column | str) -> int:
    """Rows of the most frequent key (one number; rows are counted map-side)."""
    return df.groupBy(*key).count().agg(F.max("count").alias("n")).first()["n"] or 0


def any_larger(df: DataFrame, key: str, rows: int) -> bool:
    """Whether any key has more than ``rows`` rows.  The keys are counted in buckets
    first, of which a task sends few; only where a bucket has more rows are the
    keys themselves counted."""
    return largest_group(df, F.pmod(F.xxhash64(key), F.lit(BUCKETS)).alias("bucket")) > rows and largest_group(df, key) > rows


def numbered(df: DataFrame, key: str, order: Sequence[str], totals: Mapping[str, Column] | None = None,
             into: str = "ordinal", parts: int | None = None) -> DataFrame:
    """``df`` with ``into``, the ordinal of each row within its ``key`` in the order of
    ``order`` (1, 2, ...), and the ``totals`` (sums over the rows of the key; columns
    of these names).  Rows of a NULL key are numbered like those of any other.

    The rows are cut into ranges of (key, order) and written, each with its place in
    its range; the pieces of a key, one for each range it lies in, are counted
    and summed, and running sums over these few rows give every piece its first
    ordinal and the key's totals.  So a key that holds most rows is spread over as
    many ranges as there are; only rows equal in ``order`` stay together.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = {f"_t{i}": (name, c) for i, (name, c) in enumerate((totals or {}).items())}
    path = scratch_path(spark, "numbered")
    dealt = df.repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order)
    dealt.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")).write.parquet(path)
    stored = spark.read.parquet(path)
    pieces = stored.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_piece")).agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(t) for t, (_, c) in named.items()])
    of_key = Window.partitionBy("_key")
    earlier = of_key.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("_key", "_piece", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
                           *[F.sum(t).over(of_key).alias(name) for t, (name, _) in named.items()])
    joined = stored.join(pieces, stored[key].eqNullSafe(pieces["_key"]) & (stored["_part"] == pieces["_piece"]))
    return joined.select(*[stored[c] for c in df.columns], (stored["_row"] + F.col("_shift")).alias(into),
                         *[F.col(name) for name, _ in named.values()])
