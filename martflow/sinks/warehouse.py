"""Writers at a path of their own: whole-table overwrite, facts with a folder for
each day, single-day overwrite (including an explicitly empty day) and CSV
reports.  Runs over many tables write through ``martflow.storage.Run``.

A whole table, a full refresh and a report are written beside what is there and
become the table by one switch (``martflow.storage``): a write that stops anywhere
leaves the old table or the new one, whole.  The readers of
``martflow.sources`` find the current folder.  The folder that was replaced stays
for readers that are still at it; the next write or ``storage.expire`` removes it.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow import storage
from martflow.storage import with_day


def _write_days(df: DataFrame, path: str) -> None:
    """Write the days of ``df``, each replaced as a whole at the commit.

    Rows are dealt by ranges of (day, row hash) into as many tasks as the session
    shuffles to: small days share a task, a day that holds most rows is cut
    into several, and no setting of adaptive execution can fold them into one.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in df.columns if c != "dt"]
    (
        df.repartitionByRange(tasks, F.col("dt"), F.xxhash64(*rest))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(path)
    )


def _commit(run: storage.Run) -> None:
    run.commit()
    storage.expire(run.spark, run.root, keep=2)


def save_table(df: DataFrame, path: str) -> None:
    """Whole-table overwrite (dimensions, ADS tables)."""
    run = storage.Run(df.sparkSession, path)
    run.save(df, "")
    _commit(run)


def save_partitioned(df: DataFrame, path: str) -> None:
    """Full refresh of a fact with a folder for each day: the new days replace all
    old ones, rows without a day included.  No rows give an empty table."""
    run = storage.Run(df.sparkSession, path)
    run.save_folders(with_day(df), "", _write_days)
    _commit(run)


def _current(df: DataFrame, path: str) -> str:
    """The folder that holds the days of a table (its own path, if it was never refreshed)."""
    found = storage.locate(df.sparkSession, path)
    if found is None:
        return path.rstrip("/")
    root, name = found
    return storage.folder_of(root, storage.latest(df.sparkSession, root).tables[name])


def write_empty_day(df: DataFrame, path: str, day: str) -> None:
    """Replace ``dt=day`` by a zero-row folder that keeps the schema.

    Dynamic partition overwrite cannot do this: an empty write touches no
    partition, so the old day would survive.
    """
    df.limit(0).drop("dt").write.mode("overwrite").parquet(f"{_current(df, path)}/dt={day}")


def save_day(df: DataFrame, path: str, day: str) -> bool:
    """Overwrite exactly one day; every other day stays untouched.

    Returns True when the day got rows, False when it was overwritten empty.
    """
    out = with_day(df)
    part = out.filter(F.col("dt") == F.lit(day).cast("date"))
    if part.isEmpty():
        write_empty_day(part, path, day)
        return False
    _write_days(part, _current(df, path))
    return True


def save_csv(df: DataFrame, path: str) -> None:
    """Headered CSV report (a directory of part files written by the executors)."""
    run = storage.Run(df.sparkSession, path)
    run.save_csv(df, "")
    _commit(run)


def export_csv(df: DataFrame, path: str) -> None:
    """One headered CSV file under a fixed name, for reports that people open by
    hand; replaced in one step.  All rows pass one task: for small reports."""
    spark = df.sparkSession
    aside = f"{path}.new-{uuid.uuid4().hex[:12]}"
    df.coalesce(1).write.option("header", True).csv(aside)
    (part,) = [n for n in storage._names(spark, aside) if n.startswith("part-")] or [None]
    storage.move(spark, f"{aside}/{part}", path, overwrite=True)
    storage._fs(spark, aside).delete(storage._path(spark, aside), True)
