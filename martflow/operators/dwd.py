"""DWD: typed, cleaned facts and the user dimension (one grain per table)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions.columns import MONEY, PRICE, as_date, as_timestamp, as_type, paid_flag

HEADER = ("user_id", "dt", "is_paid")  # what an item inherits from its order


def dim_user(users: DataFrame) -> DataFrame:
    """User dimension; register day parsed (malformed -> NULL, not gated)."""
    return users.select(
        "user_id",
        as_date(users, "register_dt").alias("register_dt"),
        "city",
        "gender",
        "channel",
    )


def fact_order(orders: DataFrame) -> DataFrame:
    """Order fact: exact amounts, ``net_gmv = pay - refund`` on every order,
    ``is_paid`` = 1 only for paid/shipped/completed (refunded is not paid),
    blank pay channel as NULL."""
    pay = as_type(orders, "pay_amount", MONEY)
    refund = as_type(orders, "refund_amount", MONEY)
    channel = F.col("pay_channel")
    if isinstance(orders.schema["pay_channel"].dataType, T.StringType):
        channel = F.nullif(channel, F.lit(""))
    return orders.select(
        "order_id",
        "user_id",
        as_timestamp(orders, "order_ts").alias("order_ts"),
        "status",
        pay.alias("pay_amount"),
        refund.alias("refund_amount"),
        (pay - refund).cast(MONEY).alias("net_gmv"),
        channel.alias("pay_channel"),
        as_date(orders, "dt").alias("dt"),
        paid_flag(F.col("status")).alias("is_paid"),
    )


def fact_order_item(items: DataFrame, orders_fact: DataFrame) -> DataFrame:
    """Order-line fact; user, day and paid flag are inherited from the order.

    Inner equi-join on ``order_id`` (sort-merge at scale; adaptive execution
    splits a hot order's partition).  Quantities are split into gross, refund
    and net; ``net_amount = amount - refund_amount``.
    """
    header = orders_fact.select("order_id", *HEADER)
    return item_columns(_typed_items(items).join(header, "order_id", "inner"))


def with_header(items: DataFrame, orders_fact: DataFrame) -> DataFrame:
    """Every item once, with what it inherits from its order (NULL without one).
    Of an order id that repeats, which only a failing gate can tell, it is the
    largest values.  Items of a source that has joined them to their orders itself
    carry it already."""
    if all(c in items.columns for c in HEADER):
        return items
    header = orders_fact.groupBy("order_id").agg(*[F.max(c).alias(c) for c in HEADER])
    return items.join(header, "order_id", "left").select(*items.columns, *HEADER)


def fact_order_item_from_headed(items: DataFrame) -> DataFrame:
    """The same fact from items ``with_header``; items without an order are left out."""
    return item_columns(typed_headed_items(items))


def typed_headed_items(items: DataFrame) -> DataFrame:
    """Items ``with_header`` in the fact's types, without the columns that follow from
    others of the row (``item_columns`` adds them); those without an order are left out."""
    return _typed_items(items.filter(F.col("is_paid").isNotNull()), [F.col(c) for c in HEADER])


def fact_order_item_from_lines(lines: DataFrame) -> DataFrame:
    """The same fact from lines that already carry ``user_id``, ``status`` and
    ``dt`` of their order; lines without an order are left out."""
    inherited = [F.col("user_id"), F.col("dt"), paid_flag(F.col("status")).alias("is_paid")]
    return item_columns(_typed_items(lines.filter(F.col("status").isNotNull()), inherited))


def _typed_items(items: DataFrame, more: list[Column] | None = None) -> DataFrame:
    qty = as_type(items, "qty", T.IntegerType())
    refund_qty = as_type(items, "refund_qty", T.IntegerType())
    amount = as_type(items, "amount", MONEY)
    refund_amount = as_type(items, "refund_amount", MONEY)
    return items.select(
        "order_item_id", "order_id", "sku_id", "sku_name", "category",
        qty.alias("qty"),
        as_type(items, "unit_price", PRICE).alias("unit_price"),
        amount.alias("amount"),
        refund_qty.alias("refund_qty"),
        refund_amount.alias("refund_amount"),
        *(more or []),
    )


def item_columns(joined: DataFrame) -> DataFrame:
    """The item fact's columns from typed items with their header, row by row."""
    return joined.select(
        "order_item_id", "order_id", "user_id", "dt", "sku_id", "sku_name", "category",
        "qty",
        F.col("qty").alias("gross_qty"),
        "unit_price", "amount", "refund_qty", "refund_amount",
        (F.col("qty") - F.col("refund_qty")).alias("net_qty"),
        (F.col("amount") - F.col("refund_amount")).cast(MONEY).alias("net_amount"),
        "is_paid",
    )
