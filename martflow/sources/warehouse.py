"""Readers for stored warehouse tables (day-partitioned facts, whole tables)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow import storage
from martflow.schema import conform, text_schema


def stored(spark: SparkSession, path: str, days=None) -> DataFrame | None:
    """The current version of a stored table (or some days of it); None if the path is no such table."""
    found = storage.locate(spark, path)
    if found is None:
        return None
    root, name = found
    return storage.read(spark, root, storage.latest(spark, root).tables[name], days)


def read_table(spark: SparkSession, path: str, types: T.StructType | None = None) -> DataFrame:
    """An unpartitioned parquet table, optionally re-typed."""
    found = stored(spark, path)
    df = spark.read.parquet(path) if found is None else found
    return conform(df, types) if types is not None else df


def read_partitioned(spark: SparkSession, path: str, types: T.StructType | None = None) -> DataFrame:
    """All days of a parquet fact, ``dt`` as a DATE.

    A table of a run (``storage.Run``) is opened from its snapshot: no folder of a
    day is listed.  Of a table with a folder for each day ``dt`` comes from the
    directory names, each call lists it anew, and filters on ``dt`` become partition
    filters.
    """
    df = stored(spark, path)
    if df is None:
        with storage.few_listing_tasks(spark):
            df = spark.read.parquet(path)
    return conform(df, types) if types is not None else df


def read_day(spark: SparkSession, path: str, day: str, types: T.StructType | None = None) -> DataFrame:
    """One stored day, without listing the others."""
    found = storage.locate(spark, path)
    folder = path.rstrip("/")
    if found is not None:
        root, name = found
        table = storage.latest(spark, root).tables[name]
        if table.kind == "days":
            df = storage.read(spark, root, table, [day])
            return conform(df, types) if types is not None else df
        folder = storage.folder_of(root, table)
    df = spark.read.option("basePath", folder).parquet(f"{folder}/dt={day}")
    return conform(df, types) if types is not None else df


def read_partitioned_csv(
    spark: SparkSession, path: str, types: T.StructType | None = None
) -> DataFrame:
    """Day folders of headered CSV whose columns may differ between files.

    The first line of every file is found on the executors (the file's first
    block, read as text by the same file system as any other scan); only the
    distinct headers come to the driver, and go back as a small table that says for
    each header at which position every column stands.  One scan then reads all
    files by position, whatever their headers; it is joined to its file's
    positions and each column picked from there, NULL where the header lacks it.
    Columns come in the order in which sorted headers name them first; ``dt`` comes
    from the folder names.  Fields beyond a file's header are left out, missing
    ones are NULL.  No data at all is an error.
    """
    with storage.few_listing_tasks(spark):
        lines = spark.read.text(path)
    first = (
        lines.filter("_metadata.file_block_start = 0")
        .groupBy(F.col("_metadata.file_path").alias("file_path"))
        .agg(F.first("value").alias("header"))
        .withColumn("header", F.regexp_replace("header", "^\ufeff|\r$", ""))
        .filter("header <> ''")
    )
    headers = sorted(r["header"] for r in first.select("header").distinct().collect())
    if not headers:
        raise FileNotFoundError(f"no partitions under {path}")
    width = max(h.count(",") for h in headers) + 1
    fields = [f"c{i}" for i in range(width)]
    parsed = spark.createDataFrame([(h,) for h in headers], "header string").select(
        "header", F.from_csv("header", F.lit(", ".join(f"{f} string" for f in fields))).alias("names")).collect()
    named = {r["header"]: [n for n in r["names"] if n is not None] for r in parsed}
    columns = list(dict.fromkeys(n for h in headers for n in named[h]))
    places = spark.createDataFrame(
        [(h, [named[h].index(c) if c in named[h] else None for c in columns]) for h in headers],
        "header string, places array<int>")
    files = first.join(places, "header").select("file_path", "places")
    with storage.few_listing_tasks(spark):
        rows = spark.read.schema(text_schema((*fields, "dt"))).option("header", True).option(
            "enforceSchema", True).option("nullValue", "").csv(path)
    rows = rows.select(F.array(*fields).alias("fields"), F.col("dt").cast("date").alias("dt"),
                       F.col("_metadata.file_path").alias("file_path")).join(files, "file_path")
    merged = rows.select(*[F.get("fields", F.get("places", F.lit(i))).alias(c) for i, c in enumerate(columns)], "dt")
    return conform(merged, types) if types is not None else merged
