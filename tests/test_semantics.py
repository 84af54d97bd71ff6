"""Business semantics on the hand-written fixtures: refunds, net GMV,
repurchase windows, reconcile, outcome codes, idempotent day re-runs."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martflow.operators import QualityError, partition_fingerprint, reconcile_report
from martflow.operators.gates import check_gates, gate_report
from martflow.plans import BAD_DAY, FAILED, OK, build_layers, run_day, run_full
from martflow.sources import read_ods_dir, read_partitioned
from martflow.storage import stored_days
from tests.conftest import ods_from_rows, read_rows


def _rows(df, *keys):
    return {tuple(str(r[k]) for k in keys): r for r in df.collect()}


def test_refunded_is_not_a_buyer(spark, good_dir):
    lay = build_layers(read_ods_dir(spark, good_dir))
    refunded = lay.fact_order.filter(F.col("status") == "refunded").collect()
    assert [r["order_id"] for r in refunded] == ["R103"]
    assert refunded[0]["is_paid"] == 0 and float(refunded[0]["net_gmv"]) == 0.0
    u2 = _rows(lay.user_order_1d, "user_id", "dt")[("C12", "2025-03-03")]
    assert u2["is_paid_buyer"] == 0 and u2["order_cnt"] == 1 and u2["paid_order_cnt"] == 0
    d1 = _rows(lay.repurchase_7d, "dt")[("2025-03-03",)]
    assert (d1["buyers"], d1["repurchase_users"]) == (1, 1)


def test_net_gmv_is_pay_minus_refund(spark, good_dir):
    rows = build_layers(read_ods_dir(spark, good_dir)).fact_order.collect()
    assert len(rows) == 5
    for r in rows:
        assert r["net_gmv"] == r["pay_amount"] - r["refund_amount"]
    assert float([r for r in rows if r["order_id"] == "R104"][0]["net_gmv"]) == 112.5


def test_quantities_and_order_counts(spark, good_dir, window_dir):
    lay = build_layers(read_ods_dir(spark, good_dir))
    for r in lay.fact_order_item.collect():
        assert r["gross_qty"] == r["qty"] and r["net_qty"] == r["qty"] - r["refund_qty"]
    cats = {(r["category"], str(r["dt"])): r for r in lay.category_gmv_1d.collect()}
    expected = {  # category, day -> gmv, gross, refund, net
        ("light", "2025-03-03"): (64, 2, 0, 2),
        ("light", "2025-03-05"): (112.5, 4, 1, 3),
        ("floor", "2025-03-06"): (27.5, 1, 0, 1),
        ("light", "2025-03-14"): (18, 1, 0, 1),
    }
    assert set(cats) == set(expected)
    for k, (gmv, gross, refund, net) in expected.items():
        r = cats[k]
        assert (float(r["gmv"]), r["gross_qty"], r["refund_qty"], r["net_qty"], r["qty"]) == (
            gmv, gross, refund, net, net)
    u1 = _rows(build_layers(read_ods_dir(spark, window_dir)).user_order_1d, "user_id", "dt")
    assert (u1[("C21", "2025-05-10")]["order_cnt"], u1[("C21", "2025-05-10")]["paid_order_cnt"]) == (2, 2)


@pytest.mark.parametrize(
    "fixture,expected",
    [
        ("good", {"2025-03-03": (1, 1, 1.0, 64, 1), "2025-03-05": (1, 0, 0.0, 112.5, 1),
                  "2025-03-06": (1, 0, 0.0, 27.5, 1), "2025-03-14": (1, 0, 0.0, 18, 0)}),
        ("window", {"2025-05-10": (2, 1, 0.5, 79, 1), "2025-05-12": (1, 1, 1.0, 31, 1),
                    "2025-05-18": (1, 0, 0.0, 55, 0), "2025-05-19": (1, 0, 0.0, 6, 0)}),
    ],
)
def test_daily_repurchase(spark, fixture, expected):
    from tests.conftest import FIXTURES

    lay = build_layers(read_ods_dir(spark, str(FIXTURES / fixture)))
    got = {
        str(r["dt"]): (r["buyers"], r["repurchase_users"], r["repurchase_rate_7d"],
                       float(r["gmv"]), r["window_complete"])
        for r in lay.repurchase_7d.collect()
    }
    assert got == expected


@pytest.mark.parametrize(
    "fixture,kpi",
    [
        ("good", (4, 2, 222.0, 3, 1, 0.3333)),
        ("window", (6, 2, 171.0, 3, 2, 0.6667)),
    ],
)
def test_kpi_goldens(spark, fixture, kpi):
    from tests.conftest import FIXTURES

    lay = build_layers(read_ods_dir(spark, str(FIXTURES / fixture)))
    r = lay.kpi_overview.collect()[0]
    assert (r["paid_orders"], r["paid_users"], float(r["gmv_total"]), r["buyers_complete_window"],
            r["repurchase_users_complete_window"], r["repurchase_rate_7d_weighted"]) == kpi


@pytest.mark.parametrize("fixture,checks", [("good", 11), ("window", 11)])
def test_layers_reconcile(spark, fixture, checks):
    from tests.conftest import FIXTURES

    lay = build_layers(read_ods_dir(spark, str(FIXTURES / fixture)))
    report = reconcile_report(lay.fact_order, lay.user_order_1d, lay.kpi_overview,
                              lay.repurchase_7d).collect()
    assert len(report) == checks
    assert all(r["status"] == "PASS" for r in report)
    assert [r["scope"] for r in report[:3]] == ["total"] * 3


def test_reconcile_detects_a_perturbed_layer(spark, good_dir):
    lay = build_layers(read_ods_dir(spark, good_dir))
    bumped = lay.user_order_1d.withColumn(
        "gmv",
        F.when(F.col("dt") == F.lit("2025-03-05").cast("date"), F.col("gmv") + 1).otherwise(F.col("gmv")),
    )
    report = reconcile_report(lay.fact_order, bumped, lay.kpi_overview, lay.repurchase_7d)
    failed = {(r["scope"], r["left_layer"], r["right_layer"])
              for r in report.filter("status = 'FAIL'").collect()}
    assert ("day:2025-03-05", "dwd", "dws") in failed
    assert ("day:2025-03-05", "dws", "ads") in failed
    assert ("total", "dwd", "dws") in failed


def test_one_cent_difference_passes(spark, good_dir):
    lay = build_layers(read_ods_dir(spark, good_dir))
    cent = lay.user_order_1d.withColumn(
        "gmv",
        F.when(F.col("dt") == F.lit("2025-03-05").cast("date"), F.col("gmv") + F.lit(0.01).cast("decimal(3,2)"))
        .otherwise(F.col("gmv")),
    )
    report = reconcile_report(lay.fact_order, cent, lay.kpi_overview, lay.repurchase_7d)
    row = report.filter("scope = 'day:2025-03-05' AND right_layer = 'dws'").collect()[0]
    assert float(row["abs_diff"]) == 0.01 and row["status"] == "PASS"


def _mutated(spark, orders_change):
    users, orders, items = (read_rows("good", t) for t in ("users", "orders", "order_items"))
    orders_change(orders)
    return ods_from_rows(spark, users, orders, items)


def test_negative_pay_fails_the_run(spark, tmp_path):
    ods = _mutated(spark, lambda o: o[0].update(pay_amount="-10.00"))
    with pytest.raises(QualityError) as err:
        check_gates(gate_report(*ods))
    assert err.value.gate == "ods_orders.pay_amount" and err.value.bad_rows == 1
    result = run_full(spark, ods, str(tmp_path / "wh"))
    assert result.status == FAILED and "ods_orders.pay_amount" in result.message
    for layer in ("dwd", "dws", "ads"):  # nothing past the gates is written
        assert not (tmp_path / "wh" / layer).exists()


def test_orphan_user_fails(spark):
    ods = _mutated(spark, lambda o: o[0].update(user_id="U999"))
    with pytest.raises(QualityError) as err:
        check_gates(gate_report(*ods))
    assert err.value.gate == "ods_orders.fk_user"


def test_bad_day_parameter(spark, good_dir, tmp_path):
    ods = read_ods_dir(spark, good_dir)
    for bad in ("2026/07/01", "not-a-date", "20260701", "2026-13-01"):
        assert run_day(spark, ods, str(tmp_path / "wh"), bad).status == BAD_DAY


def _fp(spark, path, day):
    fp = partition_fingerprint(read_partitioned(spark, path))
    return [tuple(r) for r in fp.filter(F.col("dt") == F.lit(day).cast("date")).collect()]


def test_day_rerun_is_idempotent(spark, good_dir, tmp_path):
    ods = read_ods_dir(spark, good_dir)
    wh = str(tmp_path / "wh")
    full = run_full(spark, ods, wh)
    assert full.status == OK, full.message
    kpi_full = [tuple(r) for r in full.kpi.collect()]
    daily_full = sorted(tuple(r) for r in full.daily.collect())
    first = _fp(spark, f"{wh}/dwd/fact_order", "2025-03-03")
    assert first and first[0][1] == 2
    for _ in range(2):
        again = run_day(spark, ods, wh, "2025-03-03")
        assert again.status == OK, again.message
        assert _fp(spark, f"{wh}/dwd/fact_order", "2025-03-03") == first
        assert [tuple(r) for r in again.kpi.collect()] == kpi_full
        assert sorted(tuple(r) for r in again.daily.collect()) == daily_full
        assert all(r["status"] == "PASS" for r in again.reconcile.collect())


def test_empty_day_fails_unless_allowed(spark, good_dir, tmp_path):
    ods = read_ods_dir(spark, good_dir)
    wh = str(tmp_path / "wh")
    assert run_full(spark, ods, wh).status == OK
    before = _fp(spark, f"{wh}/dwd/fact_order", "2025-03-03")
    assert run_day(spark, ods, wh, "2099-01-01").status == FAILED
    assert "2099-01-01" not in stored_days(spark, f"{wh}/dwd/fact_order")
    for _ in range(2):
        res = run_day(spark, ods, wh, "2099-01-01", allow_empty=True)
        assert res.status == OK, res.message
        assert "2099-01-01" in stored_days(spark, f"{wh}/dwd/fact_order")
        assert _fp(spark, f"{wh}/dwd/fact_order", "2025-03-03") == before
        assert _fp(spark, f"{wh}/dwd/fact_order", "2099-01-01") == []


def test_empty_day_overwrites_a_stale_day(spark, good_dir, tmp_path):
    """A day whose orders disappeared from the source is overwritten empty."""
    wh = str(tmp_path / "wh")
    assert run_full(spark, read_ods_dir(spark, good_dir), wh).status == OK
    users, orders, items = (read_rows("good", t) for t in ("users", "orders", "order_items"))
    kept = [o for o in orders if o["dt"] != "2025-03-14"]
    ods = ods_from_rows(spark, users, kept, [i for i in items if i["order_id"] != "R105"])
    res = run_day(spark, ods, wh, "2025-03-14", allow_empty=True)
    assert res.status == OK, res.message
    assert _fp(spark, f"{wh}/dwd/fact_order", "2025-03-14") == []
    assert _fp(spark, f"{wh}/dws/user_order_1d", "2025-03-14") == []
    days = {str(r["dt"]) for r in res.daily.collect()}
    assert "2025-03-14" not in days


def _written(root):
    return sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file())


def test_failed_gates_leave_the_warehouse_alone(spark, good_dir, tmp_path):
    wh = tmp_path / "wh"
    assert run_full(spark, read_ods_dir(spark, good_dir), str(wh)).status == OK
    before = _written(wh)
    bad = _mutated(spark, lambda o: o[0].update(status="lost"))
    results = [run_full(spark, bad, str(wh)), run_day(spark, bad, str(wh), "2025-03-03")]
    assert [r.status for r in results] == [FAILED, FAILED]
    assert _written(wh) == before
    run_full(spark, read_ods_dir(spark, good_dir), str(tmp_path / "other"))
    for r in results:  # a later run does not change an earlier report
        assert [g["bad_rows"] for g in r.gates.filter("bad_rows > 0").collect()] == [1]


def test_days_side_by_side_on_one_warehouse(spark, good_dir, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    wh = str(tmp_path / "wh")
    ods = read_ods_dir(spark, good_dir)
    full = run_full(spark, ods, wh)
    days = ("2025-03-03", "2025-03-14")
    want = {d: _fp(spark, f"{wh}/dwd/fact_order_item", d) for d in days}
    sliced = {d: read_ods_dir(spark, good_dir) for d in days}

    def gated(day):  # the part of a day run that used to share a folder
        from martflow.operators import day_slice
        from martflow.plans.pipeline import _checked, write_layers
        from martflow.session import scratch_path
        from martflow.storage import Run

        run = Run(spark, wh)
        own, _, failed = _checked(day_slice(sliced[day], day), scratch_path(spark, "day"))
        assert failed is None
        write_layers(run, own, day)
        return run.read("dwd/fact_order_item", [day])

    with ThreadPoolExecutor(2) as pool:
        frames = dict(zip(days, pool.map(gated, days)))
    for d in days:
        assert [tuple(r) for r in partition_fingerprint(frames[d]).collect()] == want[d]
    assert full.status == OK


def test_incremental_ads_equals_a_full_rebuild(spark, window_dir, tmp_path):
    wh = str(tmp_path / "wh")
    ods = read_ods_dir(spark, window_dir)
    assert run_full(spark, ods, wh).status == OK
    gone = ods._replace(orders=ods.orders.filter("order_id NOT IN ('W5', 'W6', 'W3')"),
                        items=ods.items.filter("order_id NOT IN ('W5', 'W6', 'W3')"))
    for day in ("2025-05-12", "2025-05-19", "2025-05-18", "2025-05-10"):
        part = run_day(spark, gone, wh, day, allow_empty=True)
        assert part.status == OK, part.message
        merged = sorted(tuple(r) for r in part.daily.collect())
        whole = run_day(spark, gone, wh, day, allow_empty=True, full_ads=True)
        assert sorted(tuple(r) for r in whole.daily.collect()) == merged


def test_sums_are_not_narrowed(spark):
    from decimal import Decimal

    from martflow.operators import dws

    huge = Decimal("9999999999999999.99")
    rows = [(f"o{i}", "u", huge, 1) for i in range(15)]
    df = spark.createDataFrame(rows, "order_id string, user_id string, net_gmv decimal(18,2), is_paid int")
    df = df.withColumn("dt", F.lit("2025-01-01").cast("date"))
    assert dws.user_order_1d(df).first()["gmv"] == 15 * huge


def test_fingerprint_sees_where_a_null_is(spark):
    frames = [spark.createDataFrame([row], "a string, b string, dt string") for row in
              ((None, "x", "d"), ("x", None, "d"), ("x", "", "d"), ("", "x", "d"))]
    assert len({partition_fingerprint(f).first()["fingerprint"] for f in frames}) == 4


def test_stored_report_is_fixed_point_text(spark, good_dir):
    from martflow.operators.reconcile import report_text

    lay = build_layers(read_ods_dir(spark, good_dir))
    row = report_text(reconcile_report(lay.fact_order, lay.user_order_1d, lay.kpi_overview, lay.repurchase_7d)).first()
    assert (row["left_gmv"], row["abs_diff"], row["tolerance"]) == ("222.00", "0.0000", "0.0100")


def test_a_run_stopped_midway_changes_no_table(spark, good_dir, window_dir, tmp_path, monkeypatch):
    from martflow.plans import pipeline
    from martflow.storage import Run

    wh = str(tmp_path / "wh")
    old, new = read_ods_dir(spark, good_dir), read_ods_dir(spark, window_dir)
    assert run_full(spark, old, wh).status == OK
    tables = ("dwd/fact_order", "dwd/fact_order_item", "dws/user_order_1d", "dws/category_gmv_1d", "ads/repurchase_7d")

    def state():
        return [sorted(map(str, read_partitioned(spark, f"{wh}/{t}").collect())) for t in tables]

    before = state()
    real, done = Run.save_days, []

    def stopping(self, df, name, sums=None):
        done.append(name)
        if name == pipeline.USER_DAY:  # both facts of the new run are written
            raise KeyboardInterrupt
        return real(self, df, name, sums)

    with monkeypatch.context() as m:
        m.setattr(Run, "save_days", stopping)
        with pytest.raises(KeyboardInterrupt):
            run_full(spark, new, wh)
    assert done == [pipeline.FACT_ORDER, pipeline.FACT_ITEM, pipeline.USER_DAY]
    assert state() == before
    assert run_full(spark, new, wh).status == OK
    assert state() != before


def test_an_amount_that_does_not_fit_fails_the_run_by_name(spark, tmp_path):
    users, orders, items = (read_rows("good", t) for t in ("users", "orders", "order_items"))
    order = next(o for o in orders if o["status"] == "paid" or o["status"] == "completed")
    lines = [i for i in items if i["order_id"] == order["order_id"]]
    for i in lines[1:]:
        items.remove(i)
    order.update(pay_amount="2e13", refund_amount="0")
    lines[0].update(qty="1", unit_price="2e13", amount="2e13", refund_qty="0", refund_amount="0")
    ods = ods_from_rows(spark, users, orders, items)
    assert gate_report(*ods).filter("bad_rows > 0").count() == 0
    result = run_full(spark, ods, str(tmp_path / "price"))
    assert result.status == FAILED and result.message == "fact_order_item.unit_price: 1 values do not fit decimal(18,6)"
    wide = ods._replace(
        orders=ods.orders.withColumn("pay_amount", F.when(F.col("order_id") == order["order_id"], F.lit("2e16").cast(
            "decimal(24,6)")).otherwise(F.col("pay_amount"))),
        items=ods.items.withColumn("amount", F.when(F.col("order_id") == order["order_id"], F.lit("2e16").cast(
            "decimal(24,6)")).otherwise(F.col("amount"))).withColumn("unit_price", F.col("unit_price").cast("decimal(38,10)"))
        .withColumn("unit_price", F.when(F.col("order_id") == order["order_id"], F.lit("2e16").cast("decimal(38,10)"))
                    .otherwise(F.col("unit_price"))))
    result = run_full(spark, wide, str(tmp_path / "wh"))
    assert result.status == FAILED and result.message == "fact_order.pay_amount: 1 values do not fit decimal(18,2)"
    assert not (tmp_path / "wh").exists()


def test_rejected_values_are_named(spark):
    from martflow.schema import DWD_ITEM_TYPES, count_rejects, rejects

    df = spark.createDataFrame([("a", "1", "9" * 17, 3), ("b", "x", "1.5", 4), ("c", None, None, 5)],
                               "id string, qty string, amount string, net_qty int")
    assert {r["column"]: r["rejected"] for r in count_rejects(df, DWD_ITEM_TYPES).collect()} == {"qty": 1, "amount": 1}
    assert sorted(map(tuple, rejects(df, DWD_ITEM_TYPES, "id").collect())) == [("a", "amount", "9" * 17), ("b", "qty", "x")]
    assert count_rejects(df.select("net_qty"), DWD_ITEM_TYPES).count() == 0


def test_kpi_and_report_after_day_runs_equal_a_full_run(spark, window_dir, tmp_path):
    ods = read_ods_dir(spark, window_dir)
    wh, ref = str(tmp_path / "wh"), str(tmp_path / "ref")
    full = run_full(spark, ods, wh)
    assert full.status == OK and full.ods_rows == {"users": ods.users.count(), "orders": ods.orders.count(),
                                                   "items": ods.items.count()}
    gone = ods._replace(orders=ods.orders.filter("order_id NOT IN ('W5', 'W6', 'W3')"),
                        items=ods.items.filter("order_id NOT IN ('W5', 'W6', 'W3')"))
    days = sorted({str(r["dt"]) for r in ods.orders.filter("order_id IN ('W5', 'W6', 'W3')").select("dt").collect()})
    for source in (gone, ods):  # paid users are lost, then won again
        for day in days:
            part = run_day(spark, source, wh, day, allow_empty=True)
            assert part.status == OK, part.message
        whole = run_full(spark, source, ref)
        assert [tuple(r) for r in part.kpi.collect()] == [tuple(r) for r in whole.kpi.collect()]
        assert [tuple(r) for r in part.reconcile.collect()] == [tuple(r) for r in whole.reconcile.collect()]
        assert sorted(map(tuple, part.daily.collect())) == sorted(map(tuple, whole.daily.collect()))
    kpi_file = tmp_path / "wh" / "ads" / "ads_kpi_overview.csv"
    assert kpi_file.read_text().splitlines()[1].split(",")[0] == str(whole.kpi.first()["paid_orders"])


def test_distinct_order_counts_in_two_levels(spark):
    from martflow.operators import dws

    rows = [("o1", "u", 1, 5), ("o1", "u", 0, 7), ("o1", "u", 1, 2), ("o2", "u", 0, 9), (None, "u", 1, 3), ("o3", None, 0, 1)]
    df = spark.createDataFrame(rows, "order_id string, user_id string, is_paid int, net_gmv int")
    df = df.withColumn("net_gmv", F.col("net_gmv").cast("decimal(18,2)")).withColumn("dt", F.lit("2025-01-01").cast("date"))
    out = dws.user_order_1d(df, order_id_unique=False)
    got = {r["user_id"]: (r["order_cnt"], r["paid_order_cnt"], int(r["gmv"]), r["is_paid_buyer"]) for r in out.collect()}
    assert got == {"u": (2, 1, 10, 1), None: (1, 0, 0, 0)}
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()


def test_fingerprint_trees_tell_apart_one_changed_row(spark):
    from martflow.operators import day_lanes, fingerprint_tree, tree_differences

    df = spark.range(500).select("id", F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("a"),
                                 F.lit(None).cast("string").alias("b"),
                                 F.expr("if(id = 3, null, date_add(DATE'2026-01-01', cast(id % 90 as int)))").alias("dt"))
    moved = df.withColumns({"a": F.when(F.col("id") == 200, F.col("b")).otherwise(F.col("a")),
                            "b": F.when(F.col("id") == 200, F.col("a")).otherwise(F.col("b"))})
    tree = fingerprint_tree(day_lanes(df))
    assert tree_differences(tree, fingerprint_tree(day_lanes(df.repartition(7).select("b", "dt", "a", "id")))).count() == 0
    got = sorted(map(tuple, tree_differences(tree, fingerprint_tree(day_lanes(moved))).collect()))
    assert [r[:2] for r in got] == [("day", "2026-01-21"), ("month", "2026-01"), ("root", "all")]
    fewer = fingerprint_tree(day_lanes(df.filter("id <> 3")))  # the only row without a day
    assert {tuple(r) for r in tree_differences(tree, fewer).collect()} == {
        ("day", "-", 1, None), ("month", "-", 1, None), ("root", "all", 500, 499)}
