"""Tables that change by one switch: stops, readers, days, concurrent runs."""
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martflow import storage
from martflow.sinks import export_csv, save_csv, save_partitioned, save_table
from martflow.sources import read_day, read_partitioned, read_table, read_text_csv

D1, D2, D3 = (dt.date(2026, 7, i) for i in (1, 2, 3))


def sums():
    return {"total": F.sum("v")}


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, dt date")


def rows_of(df):
    return sorted((tuple(r) for r in df.select("k", "v", "dt").collect()), key=str)


class Stop(Exception):
    pass


def stopping_at(monkeypatch, step):
    """Every write of data, ledger and snapshot, and the rename, is a step; the given one does not happen."""
    done = []

    def wrap(owner, name):
        real = getattr(owner, name)

        def stepped(*args, **kwargs):
            done.append(name)
            if len(done) == step:
                raise Stop(name)
            return real(*args, **kwargs)

        monkeypatch.setattr(owner, name, stepped)

    from pyspark.sql import DataFrameWriter

    wrap(DataFrameWriter, "parquet")
    wrap(DataFrameWriter, "csv")
    wrap(storage, "_publish")
    wrap(storage, "move")
    return done


@pytest.mark.parametrize("kind", ["table", "partitioned", "csv"])
def test_a_write_stopped_anywhere_leaves_a_whole_table(spark, tmp_path, monkeypatch, kind):
    save, read = {
        "table": (save_table, read_table), "partitioned": (save_partitioned, read_partitioned),
        "csv": (save_csv, lambda s, p: read_text_csv(s, p, ("k", "v", "dt"))),
    }[kind]
    path = str(tmp_path / "t")
    old, new = frame(spark, [("a", 1, D1), ("b", 2, D2)]), frame(spark, [("c", 3, D3)])
    save(old, path)
    before = rows_of(read(spark, path))
    step, stopped = 1, 0
    while True:
        with monkeypatch.context() as m:
            stopping_at(m, step)
            try:
                save(new, path)
                break
            except Stop:
                stopped += 1
        assert rows_of(read(spark, path)) == before
        step += 1
    assert stopped >= 3 and [str(x) for x in rows_of(read(spark, path))[0]] == ["c", "3", "2026-07-03"]


def test_a_refresh_replaces_rows_without_a_day_and_may_be_empty(spark, tmp_path):
    path = str(tmp_path / "f")
    save_partitioned(frame(spark, [("a", 1, D1), ("b", 2, None)]), path)
    assert rows_of(read_partitioned(spark, path)) == [("a", 1, D1), ("b", 2, None)]
    save_partitioned(frame(spark, [("a", 1, D1)]), path)
    assert rows_of(read_partitioned(spark, path)) == [("a", 1, D1)]
    save_partitioned(frame(spark, []), path)
    empty = read_partitioned(spark, path)
    assert empty.count() == 0 and empty.columns == ["k", "v", "dt"]


def test_only_the_replaced_folder_is_kept_beside_the_current_one(spark, tmp_path):
    path = tmp_path / "t"
    for i in range(4):
        save_table(frame(spark, [("a", i, D1)]), str(path))
    assert len([p for p in path.iterdir() if p.name.startswith("run-")]) == 2
    assert read_table(spark, str(path)).first()["v"] == 3


def test_days_are_replaced_and_read_by_the_ledger(spark, tmp_path):
    root = str(tmp_path / "wh")
    run = storage.Run(spark, root)
    run.save_days(frame(spark, [("a", 1, D1), ("b", 2, D2), ("c", 3, D3), ("n", 4, None)]), "x/f", sums())
    assert storage.locate(spark, f"{root}/x/f") is None  # not yet
    run.commit()
    for value in (20, 30):
        run = storage.Run(spark, root)
        day = run.save_day(frame(spark, [("b", value, D2), ("zz", 9, D1)]), "x/f", "2026-07-02", sums())
        assert rows_of(day) == [("b", value, D2)]
        run.commit()
    run = storage.Run(spark, root)
    run.save_day(frame(spark, []), "x/f", "2026-07-03", sums())
    run.save_day(frame(spark, []), "x/f", "2099-01-01", sums())
    run.commit()
    path = f"{root}/x/f"
    assert rows_of(read_partitioned(spark, path)) == [("a", 1, D1), ("b", 30, D2), ("n", 4, None)]
    assert rows_of(read_day(spark, path, "2026-07-02")) == [("b", 30, D2)]
    assert read_day(spark, path, "2026-07-03").count() == 0
    assert storage.stored_days(spark, path) == ["2026-07-01", "2026-07-02", "2026-07-03", "2099-01-01", "None"]
    table = storage.latest(spark, root).tables["x/f"]
    got = storage.ledger(spark, root, table).groupBy("dt").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([(D1, 1, 1), (D2, 1, 30), (None, 1, 4)], key=str)


def test_reading_some_days_opens_their_files_only(spark, tmp_path):
    root = str(tmp_path / "wh")
    days = spark.range(60).select(F.col("id").cast("string").alias("k"), F.col("id").cast("int").alias("v"),
                                  F.expr("date_add(DATE'2026-01-01', cast(id as int))").alias("dt"))
    run = storage.Run(spark, root)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run.save_days(days, "f")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    run.commit()
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    part = storage.read(spark, root, storage.latest(spark, root).tables["f"], ["2026-01-05"])
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
    assert rows_of(part) == [("4", 4, dt.date(2026, 1, 5))]
    whole = read_partitioned(spark, f"{root}/f")
    assert len(part.inputFiles()) == 1 < len(whole.inputFiles()) and whole.count() == 60


def test_many_day_parts_are_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "MAX_PARTS", 3)
    root = str(tmp_path / "wh")
    for i in range(1, 6):
        run = storage.Run(spark, root)
        run.save_day(frame(spark, [("a", i, dt.date(2026, 7, i))]), "f", f"2026-07-0{i}", sums())
        run.append(frame(spark, [("s", i, None)]), "side") if run.table("side") else run.save(frame(spark, [("s", i, None)]), "side")
        run.commit()
    tables = storage.latest(spark, root).tables
    assert len(tables["f"].parts) <= 3 and len(tables["side"].parts) <= 3
    assert [r[1] for r in rows_of(read_partitioned(spark, f"{root}/f"))] == [1, 2, 3, 4, 5]
    assert sorted(r["v"] for r in read_table(spark, f"{root}/side").collect()) == [1, 2, 3, 4, 5]


def test_a_run_on_changed_tables_is_refused(spark, tmp_path):
    root = str(tmp_path / "wh")
    first, second, third = (storage.Run(spark, root) for _ in range(3))
    first.save(frame(spark, [("a", 1, D1)]), "t")
    second.save(frame(spark, [("b", 2, D1)]), "t")
    third.save(frame(spark, [("c", 3, D1)]), "other")
    first.commit()
    with pytest.raises(storage.StaleRun):
        second.commit()
    third.commit()  # other tables
    assert [rows_of(read_table(spark, f"{root}/{t}"))[0][0] for t in ("t", "other")] == ["a", "c"]
    late = storage.Run(spark, root)
    late.base = storage.Snapshot(2, storage.latest(spark, root).tables)
    storage._publish(spark, root, storage.Snapshot(3, late.base.tables))
    with pytest.raises(storage.StaleRun):  # the number is taken
        storage._publish(spark, root, storage.Snapshot(3, {}))


def test_expire_leaves_whole_snapshots(spark, tmp_path):
    root = str(tmp_path / "wh")
    for i in range(4):
        run = storage.Run(spark, root)
        run.save(frame(spark, [("a", i, D1)]), "d/t")
        if i == 0:
            run.save(frame(spark, [("k", 0, D1)]), "kept")
        run.commit()
    open_one = storage.Run(spark, root)
    open_one.save(frame(spark, [("z", 9, D1)]), "d/t")
    gone = storage.expire(spark, root, keep=2)
    assert len(gone) == 2 and storage.snapshots(spark, root) == [3, 4]
    assert rows_of(read_table(spark, f"{root}/kept"))[0][0] == "k"
    open_one.commit()  # folders of an open run stay
    assert rows_of(read_table(spark, f"{root}/d/t"))[0][0] == "z"


def test_one_file_csv_under_a_fixed_name(spark, tmp_path):
    path = tmp_path / "kpi.csv"
    for v in (1, 2):
        export_csv(frame(spark, [("a", v, D1)]), str(path))
        assert path.read_text() == f"k,v,dt\na,{v},2026-07-01\n"
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["kpi.csv"]
