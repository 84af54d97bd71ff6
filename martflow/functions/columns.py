"""Column expressions shared by every layer.

Everything here returns a ``Column`` (JVM-side, codegen-friendly); nothing runs
Python per row.  Helpers that must know a column's input type take the
``DataFrame`` only to read its schema while the plan is being built.
"""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Money is exact: decimal(18,2) per row, wider decimals for sums.
MONEY = T.DecimalType(18, 2)
PRICE = T.DecimalType(18, 6)

# Fixed values of the business rules (must stay equal to the reference).
PAID_STATUSES = ("paid", "shipped", "completed")
AMOUNT_CHECKED_STATUSES = ("paid", "shipped", "completed", "refunded")
ORDER_STATUSES = ("unpaid", "paid", "shipped", "completed", "cancelled", "refunded")
GENDERS = ("M", "F")
CHANNELS = ("app", "wechat", "web")
TOLERANCE = Decimal("0.01")
REPURCHASE_WINDOW_DAYS = 7


def tolerance() -> Column:
    """The 0.01 money tolerance as an exact decimal literal."""
    return F.lit(TOLERANCE).cast(T.DecimalType(3, 2))


def is_blank(c: Column) -> Column:
    """NULL, or empty after trimming (only meaningful for strings)."""
    return c.isNull() | (F.trim(c) == "")


def missing(df: DataFrame, name: str) -> Column:
    """The `required` test of one column: NULL, or blank text.

    A non-string value can never be blank, so the trim is only applied to
    string columns (this keeps typed columns off the string-cast path).
    """
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return is_blank(c)
    return c.isNull()


def any_missing(df: DataFrame, names) -> Column:
    cond = None
    for n in names:
        piece = missing(df, n)
        cond = piece if cond is None else (cond | piece)
    return cond


def as_date(df: DataFrame, name: str) -> Column:
    """Parse a day column; malformed text becomes NULL (never throws under ANSI)."""
    c = F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    return c.cast("string").try_cast(T.DateType())


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Parse an event time as TIMESTAMP_NTZ so its calendar day never depends
    on the session time zone; malformed text becomes NULL, and so does text with
    a zone or an offset, whose business day is not known."""
    c = F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return c.cast(T.TimestampNTZType())
    text = c.cast("string")
    zoned = text.rlike(r":\d{2}(\.\d+)?\s*([A-Za-z]|[+-]\d)")
    return F.when(~zoned, text.try_cast(T.TimestampNTZType()))


def as_type(df: DataFrame, name: str, dtype: T.DataType) -> Column:
    """Re-type a column: unchanged when already right, else ``try_cast``."""
    c = F.col(name)
    if df.schema[name].dataType == dtype:
        return c
    if isinstance(dtype, T.DateType):
        return as_date(df, name)
    if isinstance(dtype, T.TimestampNTZType):
        return as_timestamp(df, name)
    return c.try_cast(dtype)


def paid_flag(status: Column) -> Column:
    return F.when(status.isin(*PAID_STATUSES), F.lit(1)).otherwise(F.lit(0))


def half_up_ratio(num: str, den: str, digits: int = 4) -> Column:
    """round(num / den, digits) with HALF_UP on the exact rational, for
    integer columns; NULL when den is 0 or NULL.

    Integer arithmetic (`div`) keeps it tie-proof and identical in every engine.
    """
    scale = 10 ** digits
    q = F.expr(f"({num} * {2 * scale} + {den}) div (2 * {den})")
    return F.when(F.col(den) > 0, q.cast("double") / F.lit(float(scale)))


def money_sum(c: Column) -> Column:
    """Exact sum of money; empty input gives 0 rather than NULL."""
    return F.coalesce(F.sum(c), F.lit(0).cast(MONEY))
