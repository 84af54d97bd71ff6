"""Day slice of the ODS for a partition-scoped re-run."""
from __future__ import annotations

import re
from datetime import date

from pyspark.sql import functions as F

from martflow.functions.columns import as_date
from martflow.sources.ods_csv import Ods

_ISO_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


def parse_day(value: str) -> str:
    """A run-day parameter: strictly ``YYYY-MM-DD``, returned canonical.

    Raises ``ValueError`` otherwise (e.g. ``2026/07/01`` or ``not-a-date``).
    """
    if not isinstance(value, str) or not _ISO_DAY.fullmatch(value):
        raise ValueError(f"invalid day {value!r}; expected YYYY-MM-DD")
    return date.fromisoformat(value).isoformat()


def day_slice(ods: Ods, day: str) -> Ods:
    """Orders whose parsed ``dt`` is ``day``, and the items of those orders.

    Items are restricted by ``IN``, a semi join that never multiplies an item even
    if an order id repeats.  As a predicate it also moves below whatever builds the
    items (windows by order, joins), where a semi join would stay on top.  Users are
    kept whole (the dimension is fully refreshed on every run).  On parquet sources
    partitioned by day the filter becomes a partition filter.
    """
    orders = ods.orders.filter(as_date(ods.orders, "dt") == F.lit(day).cast("date"))
    items = orders.sparkSession.sql("SELECT * FROM {items} WHERE order_id IN (SELECT order_id FROM {orders})",
                                    items=ods.items, orders=orders)
    return Ods(ods.users, orders, items)
