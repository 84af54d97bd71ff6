"""Tables that change by one switch.

Below a root folder every data folder is written once, by one run, and never
changed.  A numbered snapshot (``_snapshots/00000012.json``, a small text) names
the folders that each table consists of; the highest number is what readers see.
A run writes its folders first and its snapshot last, by a rename that fails if
the number is taken: whoever reads, before or after a run that stops anywhere,
gets whole tables of one run.

A table by day is stored flat: ``dt`` is a column, rows are clustered by day, and a
ledger beside the data (``_days``) holds for every day its files, its rows and
the sums asked for.  One day is replaced by adding a part that holds this day; the
rows of earlier parts for it are no longer read.  So neither opening a table
nor reading some days lists a folder for each day, and day totals are had
without reading the facts.
"""
from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions.columns import as_date

SNAPSHOTS, LEDGER = "_snapshots", "_days"
MAX_PARTS = 16  # a table of more parts is written anew
COMPRESSION = "zstd"  # of parquet files
DEPTH = 2  # table names have at most so many levels below their root
Rows = Callable[[DataFrame], DataFrame] | None  # a step that works row by row


class StaleRun(RuntimeError):
    """Another run has changed the same tables since this one began."""


@dataclass(frozen=True)
class Part:
    """A data folder (relative to the root); with ``day`` it replaces that day."""

    folder: str
    day: str | None = None


@dataclass(frozen=True)
class Table:
    kind: str  # rows, days, folders (one for each day) or csv
    schema: str
    parts: tuple[Part, ...] = ()


@dataclass(frozen=True)
class Snapshot:
    number: int = 0
    tables: Mapping[str, Table] = field(default_factory=dict)

    def text(self) -> str:
        tables = {n: {"kind": t.kind, "schema": t.schema, "parts": [[p.folder, p.day] for p in t.parts]}
                  for n, t in self.tables.items()}
        return json.dumps({"number": self.number, "tables": tables})

    @staticmethod
    def of(text: str) -> Snapshot:
        raw = json.loads(text)
        return Snapshot(raw["number"], {n: Table(t["kind"], t["schema"], tuple(Part(*p) for p in t["parts"]))
                                        for n, t in raw["tables"].items()})


# ------------------------------------------------------------------- files
def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def _names(spark: SparkSession, path: str) -> list[str]:
    if not exists(spark, path):
        return []
    return [s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path))]


def _read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str, overwrite: bool = False) -> None:
    """Rename a file in one step; an error if the target exists and may not be replaced."""
    jvm = spark._jvm
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kind, int(overwrite))
    if overwrite:
        how[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _fs(spark, target).getUri(), spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, source), _path(spark, target), how)


def _publish(spark: SparkSession, root: str, snapshot: Snapshot) -> None:
    """The switch: the snapshot is written aside and renamed to its number."""
    target = f"{root}/{SNAPSHOTS}/{snapshot.number:08d}.json"
    aside = f"{root}/{SNAPSHOTS}/.{snapshot.number:08d}-{uuid.uuid4().hex[:12]}"
    stream = _fs(spark, aside).create(_path(spark, aside), True)
    try:
        stream.write(bytearray(snapshot.text().encode("utf-8")))
    finally:
        stream.close()
    try:
        move(spark, aside, target)
    except Exception as err:
        if exists(spark, target):
            raise StaleRun(f"snapshot {snapshot.number} of {root} was taken by another run") from err
        raise


def snapshots(spark: SparkSession, root: str) -> list[int]:
    names = _names(spark, f"{root.rstrip('/')}/{SNAPSHOTS}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def latest(spark: SparkSession, root: str) -> Snapshot:
    """The snapshot that readers see; an empty one if nothing was ever committed."""
    numbers = snapshots(spark, root)
    return Snapshot.of(_read_text(spark, f"{root.rstrip('/')}/{SNAPSHOTS}/{numbers[-1]:08d}.json")) if numbers else Snapshot()


def locate(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """The root and the name of a stored table; None for any other folder."""
    root, name = path.rstrip("/"), ""
    for _ in range(DEPTH + 1):
        if exists(spark, f"{root}/{SNAPSHOTS}"):
            return (root, name) if name in latest(spark, root).tables else None
        root, _, last = root.rpartition("/")
        name = f"{last}/{name}".rstrip("/")
        if not root.strip("/") or root.endswith(":"):
            break
    return None


# ----------------------------------------------------------------- reading
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_listing = threading.Lock()


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Tables with a folder for each day: thousands of folders are listed by a few
    tasks for each core, not by one task for each folder.  Spark has only a session
    setting for it, so one thread at a time sets it and puts it back."""
    with _listing:
        before = spark.conf.get(_LISTING)
        spark.conf.set(_LISTING, str(4 * spark.sparkContext.defaultParallelism))
        try:
            yield
        finally:
            spark.conf.set(_LISTING, before)


def _hidden(parts: tuple[Part, ...]) -> list[tuple[Part, list[str]]]:
    """Every part with the days that later parts replace."""
    out, days = [], []
    for part in reversed(parts):
        out.append((part, list(days)))
        if part.day is not None and part.day not in days:
            days.append(part.day)
    return out[::-1]


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def _without(df: DataFrame, days: Iterable[str]) -> DataFrame:
    days = [_day(d) for d in days]
    return df.filter(F.col("dt").isNull() | ~F.col("dt").isin(days)) if days else df


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _folder(root: str, part: Part) -> str:
    return f"{root}/{part.folder}"


def folder_of(root: str, table: Table) -> str:
    """The folder of a table in one part."""
    (part,) = table.parts
    return _folder(root, part)


def read(spark: SparkSession, root: str, table: Table, days: Iterable[str] | None = None) -> DataFrame:
    """A stored table; with ``days`` only the files that the ledger names for them."""
    schema = T.StructType.fromJson(json.loads(table.schema))
    reader = spark.read.schema(schema)
    if table.kind == "csv":
        return reader.option("header", True).option("enforceSchema", False).option("nullValue", "").csv(
            folder_of(root, table))
    if table.kind == "folders":
        if not any(n.startswith("dt=") for n in _names(spark, folder_of(root, table))):
            return spark.createDataFrame([], schema)
        with few_listing_tasks(spark):
            return reader.parquet(folder_of(root, table))
    if days is None or table.kind != "days":
        return _union([_without(reader.parquet(_folder(root, p)), hidden) for p, hidden in _hidden(table.parts)])
    wanted, frames = sorted(set(days)), []
    for part, hidden in _hidden(table.parts):
        left = [d for d in wanted if d not in hidden and part.day in (None, d)]
        if not left:
            continue
        rows = spark.read.parquet(f"{_folder(root, part)}/{LEDGER}").filter(F.col("dt").isin([_day(d) for d in left]))
        if files := sorted(r["file"] for r in rows.select("file").distinct().collect()):
            frames.append(reader.parquet(*[f"{_folder(root, part)}/{f}" for f in files]).filter(
                F.col("dt").isin([_day(d) for d in left])))
    return _union(frames) if frames else spark.createDataFrame([], schema)


def ledger(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """``(dt, file, rows, ...sums)`` of a table by day, replaced days left out."""
    return _union([_without(spark.read.parquet(f"{_folder(root, p)}/{LEDGER}"), hidden) for p, hidden in _hidden(table.parts)])


def stored_days(spark: SparkSession, path: str) -> list[str]:
    """The days of a table by day, those stored without rows included."""
    found = locate(spark, path)
    if found is None:
        raise FileNotFoundError(f"no stored table at {path}")
    root, name = found
    table = latest(spark, root).tables[name]
    with_rows = {str(r["dt"]) for r in ledger(spark, root, table).select("dt").distinct().collect()}
    return sorted(with_rows | {p.day for p in table.parts if p.day is not None})


# ----------------------------------------------------------------- writing
def with_day(df: DataFrame) -> DataFrame:
    if "dt" not in df.columns:
        raise ValueError("a partitioned write needs a dt column")
    return df.withColumn("dt", as_date(df, "dt"))


class Run:
    """Folders written by one run, and the switch to them.

    Nothing that others read changes before ``commit``; the run itself reads
    what it has written.  ``sums`` are aggregates that the ledger of a table keeps
    by day and file, in each ``save_days`` and ``save_day`` the same ones.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.base = latest(spark, self.root)
        self.name = f"run-{self.base.number + 1:08d}-{uuid.uuid4().hex[:8]}"
        self.tables: dict[str, Table] = {}

    def table(self, name: str) -> Table | None:
        return self.tables.get(name) or self.base.tables.get(name)

    def _fresh(self, name: str) -> str:
        """A folder of this run for a table; written twice, a table gets two."""
        count = sum(p.folder.rpartition("/")[2].startswith(self.name) for p in self.tables.get(name, Table("", "")).parts)
        return f"{name}/{self.name}{f'-{count}' if count else ''}".lstrip("/")

    def _keep(self, name: str, kind: str, df: DataFrame, parts: tuple[Part, ...]) -> None:
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        self.tables[name] = Table(kind, nullable.json(), parts)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """A whole table; returns it as stored."""
        folder = self._fresh(name)
        df.write.option("compression", COMPRESSION).parquet(f"{self.root}/{folder}")
        self._keep(name, "rows", df, (Part(folder),))
        return self.read(name)

    def append(self, df: DataFrame, name: str) -> None:
        """More rows for a table of ``save``."""
        now = self.table(name)
        if len(now.parts) >= MAX_PARTS:
            self.save(read(self.spark, self.root, now).unionByName(df), name)
            return
        folder = self._fresh(name)
        df.write.option("compression", COMPRESSION).parquet(f"{self.root}/{folder}")
        self.tables[name] = replace(now, parts=(*now.parts, Part(folder)))

    def save_csv(self, df: DataFrame, name: str) -> DataFrame:
        folder = self._fresh(name)
        df.write.option("header", True).csv(f"{self.root}/{folder}")
        text = df.select([F.col(c).cast("string") for c in df.columns])
        self._keep(name, "csv", text, (Part(folder),))
        return self.read(name)

    def save_folders(self, df: DataFrame, name: str, write) -> None:
        """A table with a folder for each day, written by ``write(df, path)``."""
        folder = self._fresh(name)
        write(df, f"{self.root}/{folder}")
        self._keep(name, "folders", df.select(*[c for c in df.columns if c != "dt"], "dt"), (Part(folder),))

    def _write_days(self, df: DataFrame, folder: str, sums: Mapping[str, Column], finish: Rows = None) -> DataFrame:
        """Rows dealt by day (a huge day is split, small ones share a file by
        adaptive execution), finished and sorted; then the ledger, from what was
        written.  Returns the finished rows, unread."""
        path = f"{self.root}/{folder}"
        dealt = df.hint("rebalance", F.col("dt"))
        rows = finish(dealt) if finish else dealt
        rows.sortWithinPartitions("dt").write.option("compression", COMPRESSION).parquet(path)
        stored = self.spark.read.schema(rows.schema).parquet(path)
        stored.groupBy("dt", F.col("_metadata.file_name").alias("file")).agg(
            F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in sums.items()]
        ).coalesce(1).write.parquet(f"{path}/{LEDGER}")
        return rows

    def save_days(self, df: DataFrame, name: str, sums: Mapping[str, Column] | None = None, finish: Rows = None) -> DataFrame:
        """A whole table by day; returns it as stored.  ``finish``, row by row, adds
        columns after the rows are dealt, so they are not shuffled."""
        folder = self._fresh(name)
        rows = self._write_days(with_day(df), folder, sums or {}, finish)
        self._keep(name, "days", rows, (Part(folder),))
        return self.read(name)

    def save_day(self, df: DataFrame, name: str, day: str, sums: Mapping[str, Column] | None = None,
                 finish: Rows = None) -> DataFrame:
        """One day replaced (by nothing, if ``df`` has no rows of it); returns the day."""
        folder = self._fresh(name)
        rows = self._write_days(with_day(df).filter(F.col("dt") == _day(day)), folder, sums or {}, finish)
        before = self.table(name)
        parts = (*[p for p in (before.parts if before else ()) if p.day != day], Part(folder, day))
        if before is None:
            self._keep(name, "days", rows, parts)
        else:
            self.tables[name] = replace(before, parts=parts)
        if len(parts) > MAX_PARTS:
            self.save_days(self.read(name), name, sums)
        return self.read(name, [day])

    def read(self, name: str, days: Iterable[str] | None = None) -> DataFrame:
        return read(self.spark, self.root, self.table(name), days)

    def before(self, name: str, days: Iterable[str] | None = None) -> DataFrame:
        """A table as it was when this run began."""
        return read(self.spark, self.root, self.base.tables[name], days)

    def ledger(self, name: str) -> DataFrame:
        return ledger(self.spark, self.root, self.table(name))

    def commit(self) -> int:
        """Make this run's tables the ones that are read.  Tables that another run
        changed meanwhile are an error, and nothing is changed then."""
        now = latest(self.spark, self.root)
        if now.number != self.base.number:
            lost = sorted(n for n in self.tables if now.tables.get(n) != self.base.tables.get(n))
            if lost:
                raise StaleRun(f"another run has changed {', '.join(lost) or 'the table'}; run again")
        snapshot = Snapshot(now.number + 1, {**now.tables, **self.tables})
        _publish(self.spark, self.root, snapshot)
        return snapshot.number


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all but the last ``keep`` snapshots and the folders that only they
    name.  Snapshots go first: what is left is always whole.  Returns the folders."""
    root = root.rstrip("/")
    numbers = snapshots(spark, root)
    old, kept = numbers[: -max(1, keep)], numbers[-max(1, keep):]

    def folders(which: list[int]) -> set[str]:
        found = [Snapshot.of(_read_text(spark, f"{root}/{SNAPSHOTS}/{n:08d}.json")) for n in which]
        return {p.folder for s in found for t in s.tables.values() for p in t.parts}

    gone = sorted(folders(old) - folders(kept))
    for path in [f"{root}/{SNAPSHOTS}/{n:08d}.json" for n in old] + [f"{root}/{f}" for f in gone]:
        _fs(spark, path).delete(_path(spark, path), True)
    return gone
