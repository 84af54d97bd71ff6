"""Event stream table as a user-day activity table.

The repurchase operator only needs (user_id, dt, is_paid_buyer, gmv); here a
purchase event plays the part of a paid order and its value the part of GMV.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.columns import MONEY

# Fixed value: the event type that counts as a paid order.
PURCHASE_EVENT = "purchase"


def events_user_day(events: DataFrame) -> DataFrame:
    """(user_id, dt) grain with a paid-buyer flag and exact purchase value.

    One ``groupBy`` with map-side partial aggregation, so a very active user
    or day is collapsed before the shuffle.
    """
    purchase = F.col("event_type") == PURCHASE_EVENT
    return events.groupBy("user_id", F.to_date("ts").alias("dt")).agg(
        F.max(F.when(purchase, 1).otherwise(0)).alias("is_paid_buyer"),
        F.sum(F.when(purchase, F.col("value").cast(MONEY)).otherwise(0)).alias("gmv"),
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
