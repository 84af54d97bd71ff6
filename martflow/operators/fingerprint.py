"""Content fingerprint of a day-partitioned table.

Order- and file-layout-insensitive: per day, the row count and the exact sum
of a 60-bit hash of each row.  Equal fingerprints across two runs mean the
day holds the same multiset of rows (up to hash collisions), whatever files
the writer produced.
"""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def partition_fingerprint(df: DataFrame, key: str = "dt") -> DataFrame:
    """``(key, rows, fingerprint)``; columns are taken in name order so a
    column reorder does not change the result.

    A row's text writes every value with its length and NULL as ``-``, so neither
    a NULL that changes its column nor a shifted border goes unseen; the hash is
    the first 15 hex digits of the text's MD5, which other engines have too.
    """
    cols = sorted(c for c in df.columns if c != key)

    def part(name: str):
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    digits = F.substring(F.md5(F.concat(*[part(c) for c in cols])), 1, 15)
    row_hash = F.conv(digits, 16, 10).cast(T.DecimalType(38, 0))
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(row_hash).alias("fingerprint"),
    )


LANES = 4


def day_lanes(df: DataFrame, key: str = "dt", lanes: int = LANES) -> DataFrame:
    """``(key, rows, lanes)``: the leaves of a table's fingerprint tree.  A lane is the
    sum, modulo 2^64, of one of ``lanes`` independent 64-bit hashes of the rows; sums do
    not depend on the order of rows or on files, so lanes of parts of a day add up to
    those of the day.  Rows that differ in one value, or in where a NULL
    stands, agree in all lanes with a chance of 2^-64 for each lane."""
    cols = sorted(c for c in df.columns if c != key)
    # a value, or a mark of its absence: xxhash64 skips NULL, so NULLs in other columns would look alike
    parts = [p for c in cols for p in (F.col(c), F.col(c).isNull())]
    hashes = [F.xxhash64(F.lit(i), *parts).cast(T.DecimalType(38, 0)) for i in range(lanes)]
    summed = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(h).alias(f"s{i}") for i, h in enumerate(hashes)])
    return summed.select(key, "rows", F.array(*[_wrapped(F.col(f"s{i}")) for i in range(lanes)]).alias("lanes"))


def _wrapped(total):
    """A wide sum modulo 2^64, as a signed long."""
    half, whole = (F.lit(Decimal(2**n)) for n in (63, 64))
    left = F.pmod(total, whole)
    return F.when(left >= half, left - whole).otherwise(left).cast("long")


def _rolled(nodes: DataFrame, of, name: str, lanes: int) -> DataFrame:
    """One node for each value of ``of``: the row count, and in each lane the wrapped sum
    of hashes of the children with their keys."""
    child = [F.xxhash64(F.col("node"), F.col("rows"), F.col("lanes")[i]).cast(T.DecimalType(38, 0)) for i in range(lanes)]
    summed = nodes.groupBy(of.alias("parent")).agg(F.sum("rows").alias("rows"),
                                                   *[F.sum(c).alias(f"s{i}") for i, c in enumerate(child)])
    return summed.select(F.lit(name).alias("level"), F.col("parent").alias("node"), "rows",
                         F.array(*[_wrapped(F.col(f"s{i}")) for i in range(lanes)]).alias("lanes"))


def fingerprint_tree(leaves: DataFrame, key: str = "dt", lanes: int = LANES) -> DataFrame:
    """``(level, node, rows, lanes)``: the days of ``day_lanes``, their months and the
    root ``all``.  Stored once, two tables are compared by a row, and where they
    differ the branch down to the day is followed; the tables are not read again.
    Rows without a day are the node ``-``."""
    day = F.coalesce(F.col(key).cast("string"), F.lit("-"))
    days = leaves.select(F.lit("day").alias("level"), day.alias("node"), "rows", "lanes")
    months = _rolled(days, F.substring("node", 1, 7), "month", lanes)
    root = _rolled(months, F.lit("all"), "root", lanes)
    return days.unionByName(months).unionByName(root)


def tree_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(level, node, rows_left, rows_right)`` of the nodes in which two trees differ,
    looked for below differing nodes only: no row if the roots are equal."""
    def at(level: str) -> DataFrame:
        a = left.filter(F.col("level") == level).select("node", F.col("rows").alias("rows_left"), F.col("lanes").alias("a"))
        b = right.filter(F.col("level") == level).select("node", F.col("rows").alias("rows_right"), F.col("lanes").alias("b"))
        both = a.join(b, "node", "full_outer")
        same = F.col("rows_left").eqNullSafe(F.col("rows_right")) & F.col("a").eqNullSafe(F.col("b"))
        return both.filter(~same).select(F.lit(level).alias("level"), "node", "rows_left", "rows_right")

    root = at("root")
    months = at("month").crossJoin(F.broadcast(root.select(F.lit(True).alias("differs")))).drop("differs")  # one row or none
    days = at("day")
    days = days.join(months.select(F.col("node").alias("month")), F.substring(days.node, 1, 7) == F.col("month"), "left_semi")
    return root.unionByName(months).unionByName(days)


def distinct_days(df: DataFrame, key: str = "dt") -> DataFrame:
    """The days present in a table."""
    return df.select(key).distinct()
