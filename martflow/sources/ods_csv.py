"""ODS source: the three headered CSV inputs (users, orders, order items)."""
from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from martflow import storage
from martflow.schema import (
    ITEMS_COLUMNS,
    ODS_ITEMS_TYPES,
    ODS_ORDERS_TYPES,
    ORDERS_COLUMNS,
    USERS_COLUMNS,
    conform,
    text_schema,
)


class Ods(NamedTuple):
    """The raw layer: any three DataFrames with the ODS column names."""

    users: DataFrame
    orders: DataFrame
    items: DataFrame


def read_text_csv(spark: SparkSession, path: str, columns) -> DataFrame:
    """Headered CSV with an explicit all-string schema.

    No schema inference (no extra pass over the data); an empty field is NULL.
    ``enforceSchema=false`` makes Spark check every file's header against the
    expected names, so a file with reordered or renamed columns fails loudly
    instead of being read by position.
    A report of ``save_csv`` is read from its current folder.
    """
    found = storage.locate(spark, path)
    if found is not None:
        root, name = found
        path = storage.folder_of(root, storage.latest(spark, root).tables[name])
    return (
        spark.read.schema(text_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", "")
        .csv(path)
    )


def read_ods_csv(spark: SparkSession, users: str, orders: str, items: str) -> Ods:
    """Load the three ODS inputs (files or directories of CSV parts).

    Amounts and quantities are cast with ``try_cast``: a malformed number
    becomes NULL and is then rejected by the `required` quality gates.
    """
    return Ods(
        read_text_csv(spark, users, USERS_COLUMNS),
        conform(read_text_csv(spark, orders, ORDERS_COLUMNS), ODS_ORDERS_TYPES),
        conform(read_text_csv(spark, items, ITEMS_COLUMNS), ODS_ITEMS_TYPES),
    )


def read_ods_dir(spark: SparkSession, root: str) -> Ods:
    """``root`` holds users.csv, orders.csv and order_items.csv."""
    root = root.rstrip("/")
    return read_ods_csv(
        spark, f"{root}/users.csv", f"{root}/orders.csv", f"{root}/order_items.csv"
    )
