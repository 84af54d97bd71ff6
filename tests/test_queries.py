"""Registered queries on tables that the test builds itself."""
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F


@pytest.fixture
def star(spark, tmp_path):
    """A star schema in a folder: ``star(orders, lines, parts)`` writes it and returns the path."""
    def write(orders, lines, parts=((1, "pin", "TIN"),)):
        frames = {
            "nation": spark.createDataFrame([(1, "PERU")], "n_nationkey int, n_name string"),
            "customer": spark.createDataFrame([(k, 1) for k in sorted({o[1] for o in orders})], "c_custkey bigint, c_nationkey int"),
            "part": spark.createDataFrame(list(parts), "p_partkey bigint, p_name string, p_type string"),
            "orders": spark.createDataFrame(
                list(orders), "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"),
            "lineitem": spark.createDataFrame(
                list(lines), "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz"),
        }
        for name, df in frames.items():
            df.write.parquet(f"{tmp_path}/sf/{name}.parquet")
        return f"{tmp_path}/sf"
    return write


def order(key, day=1, customer=1, status="O", priority="1-URGENT"):
    return key, customer, status, dt.datetime(2026, 1, day), priority


def line(key, number, price, qty=1.0, part=1, flag="N"):
    return key, part, 1, number, qty, price, 0.0, 0.0, flag, "O", dt.datetime(2026, 1, 9)


def test_narrowing_rejects_counts_orders_of_any_amount(spark, star):
    import __spark_entry__ as entry

    lines = [line(1, n, 600_000.0) for n in (1, 2, 3)] + [line(2, 1, 9_999.99), line(3, 1, 10_000.0), line(4, 1, 9e12)]
    path = star([order(k) for k in (1, 2, 3, 4)], lines)
    got = {tuple(r) for r in entry.q_narrowing_rejects(spark, path).collect()}
    assert got == {("pay_amount", "decimal(18,2)", 3), ("refund_amount", "decimal(18,2)", 0)}


def test_items_of_a_day_are_sliced_below_the_window_of_their_orders(spark, star):
    from martflow.operators.slicing import day_slice
    from martflow.sources.tpch import ods_from_tpch

    path = star([order(1, 1), order(2, 2), order(3, 2)],
                [line(1, 1, 5.0), line(2, 1, 6.0), line(2, 2, 7.0), line(3, 1, 8.0, flag="R"), line(9, 1, 9.0), line(None, 1, 9.0)])
    ods = ods_from_tpch(spark, path)
    items = day_slice(ods, "2026-01-02").items
    assert sorted(r["order_item_id"] for r in items.collect()) == ["2-1", "2-2", "3-1"]
    plan = items._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("Window [") < plan.index("LeftSemi")  # the window holds the day's lines only
    twice = ods._replace(orders=ods.orders.unionByName(ods.orders))
    assert day_slice(twice, "2026-01-02").items.count() == 3
    nulls = ods._replace(orders=ods.orders.withColumn("order_id", F.nullif("order_id", F.lit(2))))
    assert [r["order_id"] for r in day_slice(nulls, "2026-01-02").items.collect()] == [3]


def test_items_with_their_header_give_the_same_fact_without_a_join(spark, star):
    from martflow.operators import dwd
    from martflow.sources.tpch import ods_from_tpch

    path = star([order(1), order(2, 2), order(4, 3, status=None)],
                [line(1, 1, 5.0), line(2, 1, 6.0), line(2, 2, 7.0, part=8), line(4, 1, 8.0, flag="R"), line(9, 1, 9.0)])
    ods = ods_from_tpch(spark, path)
    fact = dwd.fact_order(ods.orders)
    headed = dwd.with_header(ods.items, fact.unionByName(fact))  # an order id that repeats multiplies no item
    assert headed.columns == [*ods.items.columns, *dwd.HEADER] and headed.count() == 5
    assert headed.filter("is_paid IS NULL").select("order_id").collect() == [(9,)]
    got, want = dwd.fact_order_item_from_headed(headed), dwd.fact_order_item(ods.items, fact)
    assert got.dtypes == want.dtypes and want.count() == 4
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_full_run_joins_no_stored_items(spark, star, tmp_path):
    """The item fact comes from staged items that carry their order; the facts are those of the join."""
    from martflow.operators import dwd
    from martflow.plans import pipeline
    from martflow.sources.tpch import ods_from_tpch
    from martflow.storage import Run

    path = star([order(1), order(2, 2), order(3, 3)], [line(1, 1, 5.0), line(2, 1, 6.0), line(2, 2, 7.0), line(3, 1, 8.0, flag="R")])
    ods = ods_from_tpch(spark, path)
    own, rows, failed = pipeline._checked(ods, f"{tmp_path}/staged")
    assert failed is None and rows == {"users": 1, "orders": 3, "items": 4}
    assert "Join" not in dwd.fact_order_item_from_headed(own.items)._jdf.queryExecution().optimizedPlan().toString()
    stored = []
    for name, source in (("headed", own), ("plain", own._replace(items=own.items.select(*ods.items.columns)))):
        run = Run(spark, f"{tmp_path}/{name}")
        pipeline.write_layers(run, source)
        stored.append(sorted(map(tuple, run.read(pipeline.FACT_ITEM).collect())))
    assert stored[0] == stored[1] and len(stored[0]) == 4


def test_giant_keys_are_found_by_buckets_first(spark, monkeypatch):
    from martflow.operators import numbering

    df = spark.range(1000).select(F.when(F.col("id") >= 100, F.col("id") % 90).alias("k"))  # 100 NULL, else 10 each
    calls, count = [], numbering.largest_group
    monkeypatch.setattr(numbering, "largest_group", lambda d, *key: calls.append(key) or count(d, *key))
    assert numbering.any_larger(df, "k", 99) and numbering.any_larger(df, "k", 0) and len(calls) == 4
    assert not numbering.any_larger(df, "k", 200) and len(calls) == 5  # no bucket has more: keys are not counted
    monkeypatch.setattr(numbering, "BUCKETS", 1)
    assert not numbering.any_larger(df, "k", 100) and len(calls) == 7  # a bucket of many small keys
    assert not numbering.any_larger(df.limit(0), "k", 0)


def test_headed_items_carry_what_a_join_to_the_stored_orders_gives(spark, star):
    """The header comes from where the lines are by order: no join of finished items to orders."""
    from martflow.operators import dwd
    from martflow.sources.tpch import ods_from_tpch

    path = star([order(1), order(2, 2), order(4, 3, status=None), order(None, 1), order(5)],
                [line(1, 1, 5.0), line(2, 1, 6.0, flag="R"), line(2, 2, 7.0, part=8, flag="R"), line(4, 1, 8.0, flag="R"),
                 line(4, 2, None), line(9, 1, 9.0), line(None, 1, 9.0)])
    plain, headed = ods_from_tpch(spark, path), ods_from_tpch(spark, path, headed=True)
    assert headed.items.columns == [*plain.items.columns, *dwd.HEADER]
    fact = dwd.fact_order(plain.orders)
    got, want = dwd.with_header(headed.items, fact), dwd.with_header(plain.items, fact)
    assert got.dtypes == want.dtypes and want.count() == 7
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    def joins(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")

    assert joins(got) == 2 < joins(want)  # orders and part


def test_an_empty_day_computes_nothing_that_a_source_joins_to_its_orders(spark, star, tmp_path):
    from martflow.plans.pipeline import FACT_ITEM, OK, run_day, run_full
    from martflow.sources.tpch import ods_from_tpch
    from martflow.storage import Run

    path = star([order(1), order(2, 2)], [line(1, 1, 5.0), line(2, 1, 6.0)])
    ods, wh = ods_from_tpch(spark, path, headed=True), f"{tmp_path}/wh"
    assert run_full(spark, ods, wh).status == OK
    sums = ods.orders.groupBy("order_id").agg(F.sum(F.raise_error(F.lit("computed")).cast("decimal(18,2)")).alias("pay_amount"))
    spoilt = ods._replace(orders=ods.orders.drop("pay_amount").join(sums, "order_id", "left").select(*ods.orders.columns))
    result = run_day(spark, spoilt, wh, "2099-01-01", allow_empty=True)
    assert (result.status, result.ods_rows["orders"], result.ods_rows["items"]) == (OK, 0, 0)
    assert Run(spark, wh).read(FACT_ITEM).count() == 2


def test_columns_that_follow_from_others_are_made_behind_the_shuffle_by_day(spark, tmp_path):
    from martflow.storage import Run

    run = Run(spark, f"{tmp_path}/wh")
    days = spark.range(6).select("id", F.date_add(F.lit("2026-01-01").cast("date"), F.pmod("id", F.lit(3)).cast("int")).alias("dt"))
    seen = []

    def finish(rows):
        seen.append(rows._jdf.queryExecution().logical().toString())
        return rows.select("dt", "id", (F.col("id") * 2).alias("twice"))

    stored = run.save_days(days, "f", finish=finish)
    assert stored.columns == ["dt", "id", "twice"] and "rebalance" in seen[0].lower()
    assert sorted((r.id, r.twice) for r in stored.collect()) == [(i, 2 * i) for i in range(6)]
    run.save_day(days.filter("id < 2"), "f", "2026-01-01", finish=finish)
    assert sorted((r.id, r.twice) for r in run.read("f").collect()) == [(0, 0), (1, 2), (2, 4), (4, 8), (5, 10)]
