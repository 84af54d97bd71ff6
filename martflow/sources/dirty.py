"""An ODS with known faults, made from the clean one by key arithmetic.

Every quality gate finds bad rows in it.  The expressions are plain SQL that any
engine reads alike, over the columns of the clean tables; the rows that ``*_TWICE``
selects appear twice.
"""
from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from martflow.sources.ods_csv import Ods
from martflow.sources.tpch import ods_from_tpch

# Which rows are spoilt, and how.
USERS = {
    "user_id": "CASE WHEN user_id % 101 = 0 THEN NULL ELSE user_id END",
    "register_dt": "register_dt",
    "city": "CASE WHEN user_id % 37 = 0 THEN ' ' ELSE city END",
    "gender": "CASE WHEN user_id % 41 = 0 THEN 'X' ELSE gender END",
    "channel": "CASE WHEN user_id % 43 = 0 THEN 'tv' ELSE channel END",
}
USERS_TWICE = "user_id % 47 = 0"
ORDERS = {
    "order_id": "order_id",
    "user_id": "CASE WHEN order_id % 53 = 0 THEN -order_id ELSE user_id END",
    "order_ts": "CASE WHEN order_id % 59 = 0 THEN 'soon' ELSE CAST(order_ts AS STRING) END",
    "status": "CASE WHEN order_id % 71 = 0 THEN 'lost' WHEN order_id % 73 = 0 THEN 'refunded' "
              "WHEN order_id % 103 = 0 THEN '' ELSE status END",
    "pay_amount": "CAST(CASE WHEN order_id % 79 = 0 THEN -1 ELSE pay_amount END AS DECIMAL(18,2))",
    "refund_amount": "CAST(CASE WHEN order_id % 83 = 0 THEN -2 WHEN order_id % 89 = 0 THEN pay_amount + 5 "
                     "ELSE refund_amount END AS DECIMAL(18,2))",
    "pay_channel": "pay_channel",
    "dt": "CASE WHEN order_id % 61 = 0 THEN '2026-02-30' WHEN order_id % 67 = 0 THEN '1990-01-01' "
          "ELSE CAST(dt AS STRING) END",
}
ORDERS_TWICE = "order_id % 97 = 0"
ITEMS = {
    "order_item_id": "order_item_id",
    "order_id": "CASE WHEN (order_id + sku_id) % 53 = 0 THEN -order_id ELSE order_id END",
    "sku_id": "sku_id",
    "sku_name": "sku_name",
    "category": "CASE WHEN (order_id + sku_id) % 59 = 0 THEN '' ELSE category END",
    "qty": "CASE WHEN (order_id + sku_id) % 61 = 0 THEN 0 ELSE qty END",
    "unit_price": "CAST(CASE WHEN (order_id + sku_id) % 67 = 0 THEN -1 ELSE unit_price END AS DECIMAL(18,6))",
    "amount": "CAST(CASE WHEN (order_id + sku_id) % 71 = 0 THEN -3 ELSE amount END AS DECIMAL(18,2))",
    "refund_qty": "CASE WHEN (order_id + sku_id) % 73 = 0 THEN -1 WHEN (order_id + sku_id) % 79 = 0 THEN qty + 2 "
                  "ELSE refund_qty END",
    "refund_amount": "CAST(CASE WHEN (order_id + sku_id) % 83 = 0 THEN -4 WHEN (order_id + sku_id) % 89 = 0 "
                     "THEN amount + 1 ELSE refund_amount END AS DECIMAL(18,2))",
}
ITEMS_TWICE = "(order_id + sku_id) % 97 = 0"


def dirty_ods_from_tpch(spark: SparkSession, sf_dir: str) -> Ods:
    """The clean ODS with the faults above; order times and days are text."""
    plans = ((USERS, USERS_TWICE), (ORDERS, ORDERS_TWICE), (ITEMS, ITEMS_TWICE))

    def spoilt(df, columns, twice):
        times = F.when(F.expr(twice), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        rows = df.withColumn("_time", F.explode(times))
        return rows.select(*[F.expr(sql).alias(name) for name, sql in columns.items()])

    return Ods(*[spoilt(df, *plan) for df, plan in zip(ods_from_tpch(spark, sf_dir), plans)])
