"""DWS: light summaries at user x day and category x day (net of refunds)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def user_order_1d(orders_fact: DataFrame, order_id_unique: bool = True) -> DataFrame:
    """user x day: all orders, paid orders, paid net GMV, paid-buyer flag.

    The order counts are distinct counts of ``order_id``.  When order ids are
    known to be unique (the `ods_orders.pk` gate has passed, which the
    pipeline guarantees before building DWD) a plain count is the same number
    and keeps the aggregate a single shuffle with map-side combining; pass
    ``order_id_unique=False`` for unvalidated input.  That form first folds the
    rows of an order within its user and day (paid if any row is), then counts
    the folded orders: no row is copied for each distinct count, both levels
    combine map-side, and a hot user's day is spread over its orders.
    """
    paid = F.col("is_paid") == 1
    paid_gmv = F.sum(F.when(paid, F.col("net_gmv")).otherwise(0))
    if not order_id_unique:
        folded = orders_fact.groupBy("user_id", "dt", "order_id").agg(
            F.max("is_paid").alias("is_paid"), paid_gmv.alias("gmv"))
        gmv = F.sum("gmv")
    else:
        folded, gmv = orders_fact, paid_gmv
    return folded.groupBy("user_id", "dt").agg(
        F.count("order_id").alias("order_cnt"),
        F.count(F.when(paid, F.col("order_id"))).alias("paid_order_cnt"),
        gmv.alias("gmv"),
        F.max("is_paid").alias("is_paid_buyer"),
    )


def category_gmv_1d(items_fact: DataFrame) -> DataFrame:
    """category x day over paid lines: net GMV and gross / refund / net qty
    (``qty`` repeats ``net_qty``).  A hot category is collapsed by the
    partial aggregate before the shuffle."""
    paid = F.col("is_paid") == 1

    def paid_sum(c: str):
        return F.sum(F.when(paid, F.col(c)).otherwise(0))

    return (
        items_fact.groupBy("category", "dt")
        .agg(
            paid_sum("net_amount").alias("gmv"),
            paid_sum("gross_qty").alias("gross_qty"),
            paid_sum("refund_qty").alias("refund_qty"),
            paid_sum("net_qty").alias("net_qty"),
        )
        .withColumn("qty", F.col("net_qty"))
    )
