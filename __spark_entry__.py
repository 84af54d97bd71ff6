"""

Every query reads the driver's star-schema tables whole and maps them to the
retail ODS with ``martflow.sources.ods_from_tpch`` (the clean mapping) or
``raw_ods_from_tpch`` (the naive mapping that breaks several gates).  Money is
exact DECIMAL inside; ``_out`` casts it to DOUBLE only at this boundary, the
same way the oracle SQL does.  Queries that exercise storage write to a fresh
folder under the session's checkpoint directory and return what they read back.
"""
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from duckdb_oracle import SLICE_CUTOFF, fingerprint, money, with_ctes  # noqa: E402
from martflow.operators import ads, dwd, dws, gates, reconcile  # noqa: E402
from martflow.operators.fingerprint import (  # noqa: E402
    day_lanes,
    distinct_days,
    fingerprint_tree,
    partition_fingerprint,
    tree_differences,
)
from martflow.operators.slicing import day_slice  # noqa: E402
from martflow.plans.pipeline import OK, build_layers, run_day, run_full  # noqa: E402
from martflow.schema import (  # noqa: E402
    DWD_ITEM_TYPES,
    DWD_ORDER_TYPES,
    DWS_CATEGORY_TYPES,
    DWS_USER_TYPES,
    RAW_MONEY,
    TOTAL,
    conform,
    count_rejects,
)
from martflow.session import scratch_path  # noqa: E402
from martflow.sinks.warehouse import (  # noqa: E402
    save_csv,
    save_day,
    save_partitioned,
    save_table,
)
from martflow.sources.events import events_user_day, read_events  # noqa: E402
from martflow.sources.ods_csv import read_ods_dir, read_text_csv  # noqa: E402
from martflow.sources.dirty import dirty_ods_from_tpch  # noqa: E402
from martflow.sources.tpch import ods_from_tpch, order_lines, raw_ods_from_tpch  # noqa: E402
from martflow.storage import stored_days  # noqa: E402
from martflow.sources.warehouse import (  # noqa: E402
    read_partitioned,
    read_partitioned_csv,
    read_table,
)

EMPTY_DAY = "2099-01-01"  # no order has it
FLAGSHIP_SF = "/root/testdata/sf0.001"

ORDER_COLS = (
    "order_id", "user_id", "order_ts", "status", "pay_amount", "refund_amount", "net_gmv",
    "pay_channel", "dt", "is_paid",
)
ORDER_MONEY = ("pay_amount", "refund_amount", "net_gmv")
ITEM_COLS = (
    "order_item_id", "order_id", "user_id", "dt", "sku_id", "sku_name", "category", "qty",
    "gross_qty", "unit_price", "amount", "refund_qty", "refund_amount", "net_qty", "net_amount",
    "is_paid",
)
ITEM_MONEY = ("unit_price", "amount", "refund_amount", "net_amount")
DAILY_COLS = ads.DAILY_COLUMNS
KPI_COLS = (
    "paid_orders", "paid_users", "gmv_total", "buyers_complete_window",
    "repurchase_users_complete_window", "repurchase_rate_7d_weighted",
)


def _out(df: DataFrame) -> DataFrame:
    """Driver boundary: exact decimals become doubles (the oracle does the same)."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _layers(spark: SparkSession, sf: str):
    """The clean layers; the item fact comes from lines that carry their order."""
    layers = build_layers(ods_from_tpch(spark, sf), check=False)
    items = dwd.fact_order_item_from_lines(order_lines(spark, sf))
    return replace(layers, fact_order_item=items, category_gmv_1d=dws.category_gmv_1d(items))


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    save_table(df, path)
    return read_table(spark, path)


def _stored_layers(spark: SparkSession, sf: str):
    """The layers above a stored copy of the order fact and the user-days, for
    queries that need them several times."""
    fo = _stored(spark, dwd.fact_order(ods_from_tpch(spark, sf).orders), "fact_order")
    ud = _stored(spark, dws.user_order_1d(fo), "user_order_1d")
    daily = ads.repurchase_7d(ud)
    return replace(_layers(spark, sf), fact_order=fo, user_order_1d=ud, repurchase_7d=daily,
                   kpi_overview=ads.kpi_overview(fo, ud, daily))


def _last_day(orders: DataFrame) -> str:
    """Last order day of the data (one value)."""
    return orders.agg(F.max("dt").alias("d")).first()["d"].isoformat()


# ------------------------------------------------------------------ layers
def q_dwd_dim_user(spark, sf):
    return _out(_layers(spark, sf).dim_user)


def q_dwd_fact_order(spark, sf):
    return _out(_layers(spark, sf).fact_order)


def q_dwd_fact_order_item(spark, sf):
    return _out(_layers(spark, sf).fact_order_item)


def q_dws_user_order_1d(spark, sf):
    return _out(_layers(spark, sf).user_order_1d)


def q_dws_category_gmv_1d(spark, sf):
    return _out(_layers(spark, sf).category_gmv_1d)


def q_ads_repurchase_7d(spark, sf):
    return _out(_layers(spark, sf).repurchase_7d)


def q_repurchase_range_join(spark, sf):
    return _out(ads.repurchase_7d_range_join(_stored_layers(spark, sf).user_order_1d))


def q_ads_kpi_overview(spark, sf):
    return _out(_stored_layers(spark, sf).kpi_overview)


def q_ads_repurchase_complete(spark, sf):
    return _out(ads.complete_days(_layers(spark, sf).repurchase_7d))


def q_ads_repurchase_head(spark, sf):
    return _out(ads.head_days(_layers(spark, sf).repurchase_7d, 15))


def q_events_repurchase_7d(spark, sf):
    return _out(ads.repurchase_7d(events_user_day(read_events(spark, sf))))


def _report(lay, fact_order=None) -> DataFrame:
    return reconcile.reconcile_report(fact_order if fact_order is not None else lay.fact_order, lay.user_order_1d,
                                      lay.kpi_overview, lay.repurchase_7d)


def q_gmv_reconcile_report(spark, sf):
    return _out(_report(_stored_layers(spark, sf)))


def q_gmv_reconcile_mismatch(spark, sf):
    """The naive order fact against the clean DWS and ADS: checks that fail."""
    return _out(_report(_stored_layers(spark, sf), dwd.fact_order(raw_ods_from_tpch(spark, sf).orders)))


def q_reconcile_report_text(spark, sf):
    """The report as it is stored: fixed-point text."""
    return reconcile.report_text(_report(_stored_layers(spark, sf)))


def q_reconcile_verdict(spark, sf):
    return reconcile.reconcile_verdict(_report(_stored_layers(spark, sf)))


def q_dws_user_order_1d_distinct(spark, sf):
    """User-days of orders that no gate has seen, some of them twice."""
    fact = dwd.fact_order(dirty_ods_from_tpch(spark, sf).orders)
    return _out(dws.user_order_1d(fact, order_id_unique=False))


# ------------------------------------------------------------------- gates
def q_gate_report(spark, sf):
    return gates.gate_report(*ods_from_tpch(spark, sf))


def q_gate_report_raw(spark, sf):
    return gates.gate_report(*raw_ods_from_tpch(spark, sf))


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def q_gate_report_dirty(spark, sf):
    return gates.gate_report(*dirty_ods_from_tpch(spark, sf))


def q_gate_not_null(spark, sf):
    u, o, i = dirty_ods_from_tpch(spark, sf)
    g = gates.GATES
    return _union([
        gates.not_null(u, gates.USER_REQUIRED, g[0]),
        gates.not_null(o, gates.ORDER_REQUIRED, g[4]),
        gates.not_null(i, gates.ITEM_REQUIRED, g[12]),
    ])


def q_gate_unique(spark, sf):
    u, o, i = dirty_ods_from_tpch(spark, sf)
    g = gates.GATES
    return _union([
        gates.unique(u, ["user_id"], g[1]),
        gates.unique(o, ["order_id"], g[5]),
        gates.unique(i, ["order_item_id"], g[13]),
    ])


def q_gate_values_in(spark, sf):
    u, o, _ = dirty_ods_from_tpch(spark, sf)
    g = gates.GATES
    return _union([
        gates.values_in(u, "gender", gates.GENDERS, g[2]),
        gates.values_in(u, "channel", gates.CHANNELS, g[3]),
        gates.values_in(o, "status", gates.ORDER_STATUSES, g[6]),
    ])


def q_gate_non_negative(spark, sf):
    _, o, i = dirty_ods_from_tpch(spark, sf)
    return gates.non_negative_gates(o, i)


def q_gate_positive(spark, sf):
    _, _, i = dirty_ods_from_tpch(spark, sf)
    return gates.positive(i, "qty", gates.GATES[14])


def q_gate_fk(spark, sf):
    u, o, i = dirty_ods_from_tpch(spark, sf)
    g = gates.GATES
    return _union([
        gates.foreign_key(o, u, "user_id", g[11]),
        gates.foreign_key(i, o, "order_id", g[18]),
    ])


def q_gate_amount_vs_items(spark, sf):
    _, o, i = dirty_ods_from_tpch(spark, sf)
    return gates.amount_match(o, i)


def q_gate_line_amount(spark, sf):
    _, _, i = dirty_ods_from_tpch(spark, sf)
    return gates.line_amount(i)


def q_gate_ts_dt(spark, sf):
    _, o, _ = dirty_ods_from_tpch(spark, sf)
    return gates.ts_dt_alignment(o)


def q_gate_refund_rules(spark, sf):
    _, o, i = dirty_ods_from_tpch(spark, sf)
    return gates.refund_rules(o, i)


def q_gate_refund_vs_items(spark, sf):
    _, o, i = dirty_ods_from_tpch(spark, sf)
    return gates.refund_vs_items(o, i)


# ------------------------------------------------------------ day slicing
def q_ods_day_slice(spark, sf):
    ods = ods_from_tpch(spark, sf)
    day = _last_day(ods.orders)
    return _out(day_slice(ods, day).items)


def q_ods_day_slice_orders(spark, sf):
    ods = ods_from_tpch(spark, sf)
    return _out(day_slice(ods, _last_day(ods.orders)).orders)


# -------------------------------------------------------- storage round trips
def q_partition_full_refresh(spark, sf):
    root = scratch_path(spark, "partition_full_refresh")
    save_partitioned(_layers(spark, sf).fact_order, root)
    return _out(read_partitioned(spark, root))


def q_partition_overwrite_day(spark, sf):
    """Stale facts for every day, then one day overwritten with fresh facts."""
    root = scratch_path(spark, "partition_overwrite_day")
    fresh = _layers(spark, sf).fact_order
    day = _last_day(fresh)
    save_partitioned(dwd.fact_order(raw_ods_from_tpch(spark, sf).orders), root)
    save_day(fresh, root, day)
    return _out(read_partitioned(spark, root))


def q_partition_overwrite_empty(spark, sf):
    """One day overwritten with zero rows; the other days untouched."""
    root = scratch_path(spark, "partition_overwrite_empty")
    fo = _layers(spark, sf).fact_order
    day = _last_day(fo)
    save_partitioned(fo, root)
    save_day(fo.filter(F.col("dt") != F.lit(day).cast("date")), root, day)
    return _out(read_partitioned(spark, root))


def q_partition_union_by_name(spark, sf):
    """CSV day folders whose header changed: old days lack pay_channel."""
    root = scratch_path(spark, "partition_union_by_name")
    fo = _layers(spark, sf).fact_order
    old = F.col("dt") < F.lit(SLICE_CUTOFF).cast("date")
    writer = lambda df: df.write.partitionBy("dt").option("header", True)
    writer(fo.filter(old).drop("pay_channel")).mode("overwrite").csv(root)
    writer(fo.filter(~old)).mode("append").csv(root)
    return _out(read_partitioned_csv(spark, root, DWD_ORDER_TYPES))


def q_partition_days(spark, sf):
    root = scratch_path(spark, "partition_days")
    save_partitioned(_layers(spark, sf).fact_order, root)
    return distinct_days(read_partitioned(spark, root))


def q_partition_fingerprint(spark, sf):
    """Re-writing the last day with the same facts leaves every day's
    fingerprint unchanged (``unchanged`` is true on every row)."""
    root = scratch_path(spark, "partition_fingerprint")
    fo = _layers(spark, sf).fact_order
    day = _last_day(fo)
    save_partitioned(fo, root)
    before = root + "-before"
    save_table(partition_fingerprint(read_partitioned(spark, root)), before)
    save_day(fo, root, day)
    after = partition_fingerprint(read_partitioned(spark, root))
    b = read_table(spark, before).select(
        "dt", F.col("rows").alias("rows_before"), F.col("fingerprint").alias("fp_before")
    )
    return after.join(b, "dt", "full_outer").select(
        "dt",
        "rows",
        F.col("fingerprint").cast("string").alias("fingerprint"),
        ((F.col("rows") == F.col("rows_before")) & (F.col("fingerprint") == F.col("fp_before")))
        .alias("unchanged"),
    )


def q_fingerprint_tree(spark, sf):
    """The order fact and a copy in which the order with the highest id has another
    status: where their stored trees differ."""
    fo = _layers(spark, sf).fact_order
    top = fo.agg(F.max("order_id").alias("top"))
    other = fo.crossJoin(F.broadcast(top)).withColumn(
        "status", F.when(F.col("order_id") == F.col("top"), "lost").otherwise(F.col("status"))).drop("top")
    trees = [_stored(spark, fingerprint_tree(day_lanes(df)), f"tree{i}") for i, df in enumerate((fo, other))]
    return tree_differences(*trees)


def q_narrowing_rejects(spark, sf):
    """Orders in another currency unit, a million million times the amount: the values
    that the order fact cannot hold.  The type of sums holds any amount times that."""
    orders = ods_from_tpch(spark, sf).orders
    huge = (F.col("pay_amount") * F.lit(10**12)).cast(TOTAL)
    return count_rejects(orders.withColumn("pay_amount", huge).withColumn(
        "refund_amount", F.col("refund_amount").cast(RAW_MONEY)), DWD_ORDER_TYPES)


def q_dim_full_refresh(spark, sf):
    """A stale half of the dimension, then a full overwrite."""
    root = scratch_path(spark, "dim_full_refresh")
    dim = _layers(spark, sf).dim_user
    save_table(dim.filter(F.col("user_id") % 2 == 0), root)
    save_table(dim, root)
    return _out(read_table(spark, root))


def q_conform_schema(spark, sf):
    """Item fact through an all-text CSV copy, re-typed by ``conform``."""
    root = scratch_path(spark, "conform_schema")
    save_csv(_layers(spark, sf).fact_order_item, root)
    return _out(conform(read_text_csv(spark, root, ITEM_COLS), DWD_ITEM_TYPES))


def _through_csv(spark, df, name, types):
    root = scratch_path(spark, name)
    save_csv(df, root)
    return _out(conform(read_text_csv(spark, root, tuple(df.columns)), types))


def q_conform_user_day(spark, sf):
    return _through_csv(spark, _layers(spark, sf).user_order_1d, "conform_user_day", DWS_USER_TYPES)


def q_conform_category_day(spark, sf):
    return _through_csv(spark, _layers(spark, sf).category_gmv_1d, "conform_category_day", DWS_CATEGORY_TYPES)


def q_ods_csv_roundtrip(spark, sf):
    """The ODS written as the three headered CSV inputs, loaded back by the
    CSV source, and built into the item fact."""
    root = scratch_path(spark, "ods_csv_roundtrip")
    ods = ods_from_tpch(spark, sf)
    save_csv(ods.users, f"{root}/users.csv")
    save_csv(ods.orders, f"{root}/orders.csv")
    save_csv(ods.items, f"{root}/order_items.csv")
    back = read_ods_dir(spark, root)
    return _out(dwd.fact_order_item(back.items, dwd.fact_order(back.orders)))


def q_report_csv_roundtrip(spark, sf):
    root = scratch_path(spark, "report_csv_roundtrip")
    save_csv(_layers(spark, sf).repurchase_7d, root)
    types = T.StructType([
        T.StructField("dt", T.DateType()),
        T.StructField("buyers", T.LongType()),
        T.StructField("repurchase_users", T.LongType()),
        T.StructField("repurchase_rate_7d", T.DoubleType()),
        T.StructField("gmv", T.DecimalType(38, 2)),
        T.StructField("window_complete", T.IntegerType()),
    ])
    return _out(conform(read_text_csv(spark, root, DAILY_COLS), types))


# ---------------------------------------------------------------- pipelines
def q_pipeline_full(spark, sf):
    result = run_full(spark, ods_from_tpch(spark, sf, headed=True), scratch_path(spark, "pipeline_full"))
    if result.status != OK:
        raise RuntimeError(result.message)
    return _out(result.kpi.select(F.lit(result.status).alias("status"), *KPI_COLS))


def q_pipeline_gate_failure(spark, sf):
    """A run on the naive ODS: it stops at the first failing gate and writes nothing."""
    result = run_full(spark, raw_ods_from_tpch(spark, sf), scratch_path(spark, "pipeline_gate_failure"))
    failed = gates.first_failure(result.gates)
    return failed.select(F.lit(result.status).alias("status"), "gate", "bad_rows")


def q_pipeline_day_rerun(spark, sf):
    """Full run, then the last day re-run; ADS is rebuilt from the stored
    partitions and must equal the full-refresh result."""
    ods = ods_from_tpch(spark, sf, headed=True)
    wh = scratch_path(spark, "pipeline_day_rerun")
    day = _last_day(dwd.fact_order(ods.orders))
    for result in (run_full(spark, ods, wh), run_day(spark, ods, wh, day)):
        if result.status != OK:
            raise RuntimeError(result.message)
    return _out(result.daily)


def q_pipeline_outcomes(spark, sf):
    """Day runs that are refused and an empty day that is allowed, after a full run:
    the status of each, the orders stored then and the days known."""
    ods = ods_from_tpch(spark, sf, headed=True)
    wh = scratch_path(spark, "pipeline_outcomes")
    run_full(spark, ods, wh)
    seen = []
    for case, day, allow in (("day_not_iso", "2099/01/01", True), ("empty_day_refused", EMPTY_DAY, False),
                             ("empty_day_allowed", EMPTY_DAY, True)):
        result = run_day(spark, ods, wh, day, allow_empty=allow)
        stored = read_partitioned(spark, f"{wh}/dwd/fact_order")
        seen.append(stored.agg(
            F.lit(case).alias("case"), F.lit(result.status).alias("status"), F.count("*").alias("orders"),
            F.lit(EMPTY_DAY in stored_days(spark, f"{wh}/dwd/fact_order")).alias("empty_day_known")))
    return _union(seen)


# ------------------------------------------------------------------- contract
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dwd_dim_user": q_dwd_dim_user,
    "dwd_fact_order": q_dwd_fact_order,
    "dwd_fact_order_item": q_dwd_fact_order_item,
    "dws_user_order_1d": q_dws_user_order_1d,
    "dws_user_order_1d_distinct": q_dws_user_order_1d_distinct,
    "dws_category_gmv_1d": q_dws_category_gmv_1d,
    "ads_repurchase_7d": q_ads_repurchase_7d,
    "repurchase_range_join": q_repurchase_range_join,
    "ads_kpi_overview": q_ads_kpi_overview,
    "ads_repurchase_complete": q_ads_repurchase_complete,
    "ads_repurchase_head": q_ads_repurchase_head,
    "events_repurchase_7d": q_events_repurchase_7d,
    "gmv_reconcile_report": q_gmv_reconcile_report,
    "gmv_reconcile_mismatch": q_gmv_reconcile_mismatch,
    "reconcile_report_text": q_reconcile_report_text,
    "reconcile_verdict": q_reconcile_verdict,
    "gate_report": q_gate_report,
    "gate_report_raw": q_gate_report_raw,
    "gate_report_dirty": q_gate_report_dirty,
    "gate_not_null": q_gate_not_null,
    "gate_unique": q_gate_unique,
    "gate_values_in": q_gate_values_in,
    "gate_non_negative": q_gate_non_negative,
    "gate_positive": q_gate_positive,
    "gate_fk": q_gate_fk,
    "gate_amount_vs_items": q_gate_amount_vs_items,
    "gate_line_amount": q_gate_line_amount,
    "gate_ts_dt": q_gate_ts_dt,
    "gate_refund_rules": q_gate_refund_rules,
    "gate_refund_vs_items": q_gate_refund_vs_items,
    "ods_day_slice": q_ods_day_slice,
    "ods_day_slice_orders": q_ods_day_slice_orders,
    "partition_full_refresh": q_partition_full_refresh,
    "partition_overwrite_day": q_partition_overwrite_day,
    "partition_overwrite_empty": q_partition_overwrite_empty,
    "partition_union_by_name": q_partition_union_by_name,
    "partition_days": q_partition_days,
    "partition_fingerprint": q_partition_fingerprint,
    "dim_full_refresh": q_dim_full_refresh,
    "conform_schema": q_conform_schema,
    "conform_user_day": q_conform_user_day,
    "conform_category_day": q_conform_category_day,
    "ods_csv_roundtrip": q_ods_csv_roundtrip,
    "report_csv_roundtrip": q_report_csv_roundtrip,
    "pipeline_full": q_pipeline_full,
    "pipeline_gate_failure": q_pipeline_gate_failure,
    "pipeline_day_rerun": q_pipeline_day_rerun,
    "pipeline_outcomes": q_pipeline_outcomes,
    "fingerprint_tree": q_fingerprint_tree,
    "narrowing_rejects": q_narrowing_rejects,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily 7-day repurchase over the sf0.001 tables."""
    return q_ads_repurchase_7d(spark, FLAGSHIP_SF)


def _training_data():
    """Queries and SQL of the optional ``llm`` subpackage and the pipeline on top
    of it; nothing if the subpackage is not there."""
    from importlib.util import find_spec

    def there(name: str) -> bool:
        try:
            return find_spec(name) is not None
        except ModuleNotFoundError:  # not even its package
            return False

    if not there("martflow.llm.queries"):
        return {}, {}
    from martflow.llm import queries as module

    found, sql = dict(module.QUERIES), dict(module.ORACLE_SQL)
    if there("corpus_pipeline"):
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_training_data()[0]}


def _gates(source: str, names) -> str:
    quoted = ", ".join(f"'{n}'" for n in names)
    return with_ctes(f"SELECT gate, bad_rows FROM {source} WHERE gate IN ({quoted})")


def oracle_sql() -> dict[str, str]:
    g = gates.GATES
    order = money(ORDER_COLS, ORDER_MONEY)
    item = money(ITEM_COLS, ITEM_MONEY)
    daily = money(DAILY_COLS, ("gmv",))
    kpi = money(KPI_COLS, ("gmv_total",))
    last = "(SELECT d FROM last_day)"
    text_ids = lambda cols, ids: ", ".join(
        f"CAST({c} AS VARCHAR) AS {c}" if c in ids else c for c in cols.split(", ")
    )
    return {
        **_training_data()[1],
        "dwd_dim_user": with_ctes("SELECT * FROM dwd_dim_user"),
        "dwd_fact_order": with_ctes(f"SELECT {order} FROM dwd_fact_order"),
        "dwd_fact_order_item": with_ctes(f"SELECT {item} FROM dwd_fact_order_item"),
        "dws_user_order_1d": with_ctes(
            "SELECT user_id, dt, order_cnt, paid_order_cnt, CAST(gmv AS DOUBLE) AS gmv, "
            "is_paid_buyer FROM dws_user_order_1d"
        ),
        "dws_category_gmv_1d": with_ctes(
            "SELECT category, dt, CAST(gmv AS DOUBLE) AS gmv, gross_qty, refund_qty, net_qty, qty "
            "FROM dws_category_gmv_1d"
        ),
        "ads_repurchase_7d": with_ctes(f"SELECT {daily} FROM ads_repurchase_7d"),
        "repurchase_range_join": with_ctes(f"SELECT {daily} FROM ads_repurchase_7d"),
        "ads_kpi_overview": with_ctes(f"SELECT {kpi} FROM ads_kpi_overview"),
        "ads_repurchase_complete": with_ctes(
            f"SELECT {daily} FROM ads_repurchase_7d WHERE window_complete = 1"
        ),
        "ads_repurchase_head": with_ctes(
            f"SELECT {daily} FROM ads_repurchase_7d WHERE window_complete = 1 ORDER BY dt LIMIT 15"
        ),
        "events_repurchase_7d": with_ctes(f"SELECT {daily} FROM ev_repurchase_7d"),
        "gmv_reconcile_report": with_ctes("SELECT * FROM rc_report"),
        "reconcile_verdict": with_ctes(
            "SELECT COUNT(*) AS checks, COUNT(*) FILTER (WHERE status = 'FAIL') AS failed, "
            "CASE WHEN COUNT(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END "
            "AS verdict FROM rc_report"
        ),
        "gmv_reconcile_mismatch": with_ctes("SELECT * FROM rcbad_report"),
        "reconcile_report_text": with_ctes(
            "SELECT scope, left_layer, right_layer, CAST(CAST(l AS DECIMAL(38,2)) AS VARCHAR) AS left_gmv, "
            "CAST(CAST(r AS DECIMAL(38,2)) AS VARCHAR) AS right_gmv, "
            "CAST(CAST(abs(l - r) AS DECIMAL(38,4)) AS VARCHAR) AS abs_diff, '0.0100' AS tolerance, "
            "CASE WHEN abs(l - r) <= 0.01 THEN 'PASS' ELSE 'FAIL' END AS status FROM rc_rows"
        ),
        "dws_user_order_1d_distinct": with_ctes(
            "SELECT user_id, dt, order_cnt, paid_order_cnt, CAST(gmv AS DOUBLE) AS gmv, "
            "is_paid_buyer FROM dirty_user_order_1d"
        ),
        "gate_report_dirty": with_ctes("SELECT * FROM gates_dirty"),
        "ods_day_slice_orders": with_ctes(
            "SELECT order_id, user_id, order_ts, status, CAST(pay_amount AS DOUBLE) AS pay_amount, "
            "CAST(refund_amount AS DOUBLE) AS refund_amount, pay_channel, dt FROM ods_orders "
            f"WHERE dt = {last}"
        ),
        "conform_user_day": with_ctes(
            "SELECT CAST(user_id AS VARCHAR) AS user_id, dt, order_cnt, paid_order_cnt, "
            "CAST(gmv AS DOUBLE) AS gmv, is_paid_buyer FROM dws_user_order_1d"
        ),
        "conform_category_day": with_ctes(
            "SELECT category, dt, CAST(gmv AS DOUBLE) AS gmv, gross_qty, refund_qty, net_qty, qty "
            "FROM dws_category_gmv_1d"
        ),
        "partition_fingerprint": with_ctes(
            f"SELECT dt, COUNT(*) AS rows, {fingerprint(c for c in ORDER_COLS if c != 'dt')} AS fingerprint, "
            "TRUE AS unchanged FROM dwd_fact_order GROUP BY dt"
        ),
        "pipeline_gate_failure": with_ctes(
            "SELECT 2 AS status, gate, bad_rows FROM gates_raw WHERE bad_rows > 0 ORDER BY ordinal LIMIT 1"
        ),
        "gate_report": with_ctes("SELECT * FROM gates_clean"),
        "gate_report_raw": with_ctes("SELECT * FROM gates_raw"),
        "gate_not_null": _gates("gates_dirty", (g[0], g[4], g[12])),
        "gate_unique": _gates("gates_dirty", (g[1], g[5], g[13])),
        "gate_values_in": _gates("gates_dirty", (g[2], g[3], g[6])),
        "gate_non_negative": _gates("gates_dirty", (g[7], g[15], g[16], g[20], g[21], g[22])),
        "gate_positive": _gates("gates_dirty", (g[14],)),
        "gate_fk": _gates("gates_dirty", (g[11], g[18])),
        "gate_amount_vs_items": _gates("gates_dirty", (g[19],)),
        "gate_line_amount": _gates("gates_dirty", (g[17],)),
        "gate_ts_dt": _gates("gates_dirty", g[8:11]),
        "gate_refund_rules": _gates("gates_dirty", g[20:28]),
        "gate_refund_vs_items": _gates("gates_dirty", (g[26],)),
        "ods_day_slice": with_ctes(
            "SELECT order_item_id, order_id, sku_id, sku_name, category, qty, "
            "CAST(unit_price AS DOUBLE) AS unit_price, CAST(amount AS DOUBLE) AS amount, "
            "refund_qty, CAST(refund_amount AS DOUBLE) AS refund_amount FROM ods_order_items "
            f"WHERE order_id IN (SELECT order_id FROM ods_orders WHERE dt = {last})"
        ),
        "partition_full_refresh": with_ctes(f"SELECT {order} FROM dwd_fact_order"),
        "partition_overwrite_day": with_ctes(
            f"SELECT {order} FROM raw_dwd_fact_order WHERE dt <> {last} "
            f"UNION ALL SELECT {order} FROM dwd_fact_order WHERE dt = {last}"
        ),
        "partition_overwrite_empty": with_ctes(
            f"SELECT {order} FROM dwd_fact_order WHERE dt <> {last}"
        ),
        "partition_union_by_name": with_ctes(
            "SELECT " + text_ids(order, ("order_id", "user_id")).replace(
                "pay_channel,",
                f"CASE WHEN dt < DATE '{SLICE_CUTOFF}' THEN NULL ELSE pay_channel END "
                "AS pay_channel,",
            ) + " FROM dwd_fact_order"
        ),
        "partition_days": with_ctes("SELECT DISTINCT dt FROM dwd_fact_order"),
        "dim_full_refresh": with_ctes("SELECT * FROM dwd_dim_user"),
        "conform_schema": with_ctes(
            "SELECT " + text_ids(item, ("order_item_id", "order_id", "user_id", "sku_id"))
            + " FROM dwd_fact_order_item"
        ),
        "ods_csv_roundtrip": with_ctes(
            "SELECT " + text_ids(item, ("order_item_id", "order_id", "user_id", "sku_id"))
            + " FROM dwd_fact_order_item"
        ),
        "report_csv_roundtrip": with_ctes(f"SELECT {daily} FROM ads_repurchase_7d"),
        "pipeline_full": with_ctes(f"SELECT 0 AS status, {kpi} FROM ads_kpi_overview"),
        "pipeline_day_rerun": with_ctes(f"SELECT {daily} FROM ads_repurchase_7d"),
        "pipeline_outcomes": with_ctes(
            "SELECT c.*, orders FROM (SELECT 'day_not_iso' AS \"case\", 1 AS status, FALSE AS empty_day_known UNION ALL "
            "SELECT 'empty_day_refused', 2, FALSE UNION ALL SELECT 'empty_day_allowed', 0, TRUE) c, "
            "(SELECT COUNT(*) AS orders FROM dwd_fact_order)"
        ),
        "fingerprint_tree": with_ctes(
            "SELECT level, node, COUNT(*) AS rows_left, COUNT(*) AS rows_right FROM dwd_fact_order f, "
            "(SELECT dt AS d FROM dwd_fact_order WHERE order_id = (SELECT MAX(order_id) FROM dwd_fact_order)), "
            "LATERAL (SELECT unnest(['root', 'month', 'day']) AS level, "
            "unnest(['all', strftime(d, '%Y-%m'), strftime(d, '%Y-%m-%d')]) AS node) "
            "WHERE node = 'all' OR starts_with(strftime(f.dt, '%Y-%m-%d'), node) GROUP BY level, node"
        ),
        "narrowing_rejects": with_ctes(
            'SELECT \'pay_amount\' AS "column", \'decimal(18,2)\' AS type, '
            "COUNT(*) FILTER (WHERE pay_amount >= 10000) AS rejected FROM ods_orders "
            "UNION ALL SELECT 'refund_amount', 'decimal(18,2)', 0"
        ),
    }
