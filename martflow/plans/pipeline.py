"""End-to-end runs: full refresh and partition-scoped day re-run.

A run stages its ODS once in a folder of its own below the session's checkpoint
folder and checks it there: the gates, and that no value is lost when amounts are
narrowed to the types of the facts.  Only then layers are written, each once,
into folders that nobody reads yet (``martflow.storage.Run``); the next layer is
built from what was written, so a lost executor only costs the current layer's
tasks.  One switch at the end makes all tables of the run the current ones: a
run that stops anywhere leaves the warehouse as it was.

Day totals come from the ledgers written beside the facts.  A re-run of one day
reads that day, the days around it and the ledgers, never the other days' facts.
Only gate names and counts, row counts and the one-row verdict reach the driver.

Outcome codes: 0 ok; 1 malformed run day; 2 gate failure, a value that does not
fit its column, empty day without ``allow_empty``, reconcile failure, or another
run that changed the warehouse meanwhile.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.columns import money_sum
from martflow.operators import ads, dwd, dws
from martflow.operators.gates import QualityError, check_gates, gate_report
from martflow.operators.reconcile import (
    reconcile_days,
    reconcile_verdict,
    report_text,
)
from martflow.operators.slicing import day_slice, parse_day
from martflow.schema import DWD_ITEM_TYPES, DWD_ORDER_TYPES, count_rejects
from martflow.session import scratch_path
from martflow.sinks.warehouse import export_csv
from martflow.sources.ods_csv import Ods
from martflow.storage import COMPRESSION, Rows, Run, StaleRun

OK, BAD_DAY, FAILED = 0, 1, 2


# tables below the warehouse root
DIM_USER, FACT_ORDER, FACT_ITEM = "dwd/dim_user", "dwd/fact_order", "dwd/fact_order_item"
USER_DAY, CATEGORY_DAY, PAID_DAYS = "dws/user_order_1d", "dws/category_gmv_1d", "dws/user_paid_days"
DAILY, KPI = "ads/repurchase_7d", "ads/kpi_overview"
KPI_CSV, DAILY_CSV, REPORT_CSV = "ads/ads_kpi_overview_csv", "ads/ads_repurchase_7d_csv", "ads/gmv_reconcile_report_csv"
KPI_FILE = "ads/ads_kpi_overview.csv"  # one file, for people


def _sums(name: str) -> dict:
    """What the ledger of a table keeps by day."""
    if name == FACT_ORDER:
        paid = F.col("is_paid") == 1
        return {"dwd": F.sum(F.when(paid, F.col("net_gmv")).otherwise(0)), "paid_orders": F.count_if(paid)}
    return {"dws": F.sum("gmv")} if name == USER_DAY else {}


@dataclass
class RunResult:
    status: int
    message: str = ""
    gates: DataFrame | None = None
    kpi: DataFrame | None = None
    daily: DataFrame | None = None
    reconcile: DataFrame | None = None
    ods_rows: dict[str, int] = field(default_factory=dict)


@dataclass
class Layers:
    """Lazily built DWD/DWS/ADS frames (nothing written)."""

    dim_user: DataFrame
    fact_order: DataFrame
    fact_order_item: DataFrame
    user_order_1d: DataFrame
    category_gmv_1d: DataFrame
    repurchase_7d: DataFrame | None
    kpi_overview: DataFrame | None


def build_layers(ods: Ods, check: bool = True) -> Layers:
    """All layers as lazy DataFrames (the gates run first when ``check``)."""
    if check:
        check_gates(gate_report(*ods))
    fo = dwd.fact_order(ods.orders)
    fi = dwd.fact_order_item(ods.items, fo)
    ud = dws.user_order_1d(fo)
    daily = ads.repurchase_7d(ud)
    return Layers(
        dwd.dim_user(ods.users), fo, fi, ud, dws.category_gmv_1d(fi), daily,
        ads.kpi_overview(fo, ud, daily),
    )


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _checked(ods: Ods, folder: str) -> tuple[Ods, dict[str, int], RunResult | None]:
    """The ODS as this run's own copy, its row counts, and the failed result if a
    gate fails or a value would be lost in the facts.  The report is stored with the
    run, so no later run changes it.

    Items are staged with the header of their order, so the item fact needs no join
    any more; a source may give them with it (``dwd.with_header``)."""
    users, orders = [_staged(df, f"{folder}/ods/{name}") for name, df in (("users", ods.users), ("orders", ods.orders))]
    headed = _staged(dwd.with_header(ods.items, dwd.fact_order(orders)), f"{folder}/ods/items")
    own = Ods(users, orders, headed)
    rows = {name: df.count() for name, df in zip(Ods._fields, own)}
    items = headed.select(*[c for c in headed.columns if c not in dwd.HEADER])
    report = _staged(gate_report(users, orders, items), f"{folder}/gates")
    try:
        check_gates(report)
    except QualityError as err:
        return own, rows, RunResult(FAILED, str(err), gates=report, ods_rows=rows)
    for table, df, types in (("fact_order", own.orders, DWD_ORDER_TYPES), ("fact_order_item", items, DWD_ITEM_TYPES)):
        for lost in count_rejects(df, types).filter("rejected > 0").collect():
            message = f"{table}.{lost['column']}: {lost['rejected']} values do not fit {lost['type']}"
            return own, rows, RunResult(FAILED, message, gates=report, ods_rows=rows)
    return own, rows, None


def write_layers(run: Run, ods: Ods, day: str | None = None) -> None:
    """The dimension, the facts and their summaries, each built from the one before
    as stored; with ``day`` the facts and summaries of this day only.  Items may carry
    the header of their order (``dwd.with_header``)."""

    def save(df: DataFrame, name: str, finish: Rows = None) -> DataFrame:
        if day is None:
            return run.save_days(df, name, _sums(name), finish)
        return run.save_day(df, name, day, _sums(name), finish)

    run.save(dwd.dim_user(ods.users), DIM_USER)
    fo = save(dwd.fact_order(ods.orders), FACT_ORDER)
    headed = all(c in ods.items.columns for c in dwd.HEADER)
    fi = (save(dwd.typed_headed_items(ods.items), FACT_ITEM, dwd.item_columns) if headed
          else save(dwd.fact_order_item(ods.items, fo), FACT_ITEM))
    save(dws.user_order_1d(fo), USER_DAY)
    save(dws.category_gmv_1d(fi), CATEGORY_DAY)


def _paid_users(run: Run, day: str | None) -> DataFrame:
    """One row, the distinct paid users, and the table of paid days that it is kept by."""
    if day is None:
        return run.save(ads.paid_days(run.read(USER_DAY)), PAID_DAYS).agg(F.count(F.lit(1)).alias("paid_users"))
    before = run.before(PAID_DAYS)
    change = ads.paid_days_change(run.before(USER_DAY, [day]), run.read(USER_DAY, [day]))
    run.append(change, PAID_DAYS)
    grown = ads.paid_users_change(before, change).select(F.col("paid_users").alias("more"))
    return run.before(KPI).crossJoin(F.broadcast(grown)).select((F.col("paid_users") + F.col("more")).alias("paid_users"))


def publish_ads(run: Run, day: str | None = None) -> RunResult:
    """Write ADS and the reports and reconcile the three layers, from this run's tables.

    With ``day`` only what this day can change is computed: its cohorts and those
    of the days before, and the paid users it gains or loses.  Day totals come from
    the ledgers either way.
    """
    orders, user_days = run.ledger(FACT_ORDER), run.ledger(USER_DAY)
    last = user_days.agg(F.max("dt").alias("max_dt"))
    if day is None:
        daily = ads.repurchase_7d(run.read(USER_DAY), last=last)
    else:
        daily = ads.repurchase_after_day(run.read(USER_DAY, ads.days_near(day)), run.before(DAILY), day, last=last)
    daily = run.save(daily.coalesce(1).sortWithinPartitions("dt"), DAILY)
    totals = orders.agg(F.coalesce(F.sum("paid_orders"), F.lit(0)).alias("paid_orders")).crossJoin(
        F.broadcast(_paid_users(run, day))).crossJoin(F.broadcast(user_days.agg(money_sum(F.col("dws")).alias("gmv_total"))))
    kpi = run.save(ads.kpi_of_totals(totals, daily), KPI)
    run.save_csv(kpi, KPI_CSV)
    run.save_csv(daily.orderBy("dt"), DAILY_CSV)
    dwd_day, dws_day = orders.groupBy("dt").agg(F.sum("dwd").alias("dwd")), user_days.groupBy("dt").agg(F.sum("dws").alias("dws"))
    report = run.save_csv(report_text(reconcile_days(dwd_day, dws_day, kpi, daily)), REPORT_CSV)
    verdict = reconcile_verdict(report).first()
    status = OK if verdict["verdict"] == "PASS" else FAILED
    return RunResult(
        status,
        f"reconcile {verdict['verdict']}: {verdict['failed']} of {verdict['checks']} checks failed",
        kpi=kpi,
        daily=daily,
        reconcile=report,
    )


def _finish(run: Run, ods: Ods, rows: dict[str, int], day: str | None, ads_day: str | None) -> RunResult:
    write_layers(run, ods, day)
    result = publish_ads(run, ads_day)
    result.ods_rows = rows
    try:
        run.commit()
    except StaleRun as err:
        return RunResult(FAILED, str(err), ods_rows=rows)
    export_csv(result.kpi, f"{run.root}/{KPI_FILE}")
    return result


def run_full(spark: SparkSession, ods: Ods, warehouse: str) -> RunResult:
    """Gates, then a full rewrite of every layer, ADS and reconcile, then the switch."""
    run = Run(spark, warehouse)
    ods, rows, failed = _checked(ods, scratch_path(spark, "run_full"))
    return failed or _finish(run, ods, rows, None, None)


def run_day(
    spark: SparkSession,
    ods: Ods,
    warehouse: str,
    day: str,
    allow_empty: bool = False,
    full_ads: bool = False,
) -> RunResult:
    """Re-run one day: gates on the day slice, replace only this day of every fact
    (an empty day only with ``allow_empty``), refresh the user dimension, then
    bring ADS up to date (``full_ads``, or a warehouse without ADS: from every
    stored day)."""
    try:
        day = parse_day(day)
    except ValueError as err:
        return RunResult(BAD_DAY, str(err))
    run = Run(spark, warehouse)
    orders = day_slice(ods, day).orders
    empty = orders.isEmpty()
    if empty and not allow_empty:
        return RunResult(FAILED, f"no orders for dt={day}; pass allow_empty to overwrite it empty")
    if empty:  # what a source joins to its orders (sums of all lines) is not computed for none
        orders = orders.limit(0)
    # the items are sliced by stored orders: their size is known, so few of them are broadcast to the lines
    folder = scratch_path(spark, "run_day")
    sl = day_slice(ods._replace(orders=_staged(orders, f"{folder}/day")), day)
    sl, rows, failed = _checked(sl, folder)
    known = all(n in run.base.tables for n in (USER_DAY, PAID_DAYS, DAILY, KPI))
    return failed or _finish(run, sl, rows, day, day if known and not full_ads else None)
