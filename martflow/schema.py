"""Layer schemas and the generic ``conform`` re-typing operator.

ODS columns arrive as text (CSV) or already typed (parquet adapters); every
later layer is typed.  Identifier columns keep whatever type the source gives
(text from CSV, integers from the parquet adapter): the operators only compare
and group them, so they are type-generic.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions.columns import MONEY, PRICE, as_type

# ---- ODS (column names and order of the three source files; fixed values) ----
USERS_COLUMNS = ("user_id", "register_dt", "city", "gender", "channel")
ORDERS_COLUMNS = (
    "order_id", "user_id", "order_ts", "status", "pay_amount", "refund_amount",
    "pay_channel", "dt",
)
ITEMS_COLUMNS = (
    "order_item_id", "order_id", "sku_id", "sku_name", "category", "qty",
    "unit_price", "amount", "refund_qty", "refund_amount",
)


TOTAL = T.DecimalType(38, 2)  # sums of money


def text_schema(columns) -> T.StructType:
    """All-string schema: CSV is read without inference, then cast explicitly."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _types(**kw) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in kw.items()])


# Numeric columns of ODS after loading (everything else stays as read).
# Amounts keep more decimals than the layers do: the gates see them as they came,
# and only then are they rounded.
RAW_MONEY, RAW_PRICE = T.DecimalType(24, 6), T.DecimalType(24, 10)
ODS_ORDERS_TYPES = _types(pay_amount=RAW_MONEY, refund_amount=RAW_MONEY)
ODS_ITEMS_TYPES = _types(
    qty=T.IntegerType(), unit_price=RAW_PRICE, amount=RAW_MONEY,
    refund_qty=T.IntegerType(), refund_amount=RAW_MONEY,
)

# Typed columns of the stored layers (used to re-type a table read back from
# CSV, or from parquet written by another writer).
DWD_ORDER_TYPES = _types(
    order_ts=T.TimestampNTZType(), pay_amount=MONEY, refund_amount=MONEY,
    net_gmv=MONEY, dt=T.DateType(), is_paid=T.IntegerType(),
)
DWD_ITEM_TYPES = _types(
    dt=T.DateType(), qty=T.IntegerType(), gross_qty=T.IntegerType(), unit_price=PRICE,
    amount=MONEY, refund_qty=T.IntegerType(), refund_amount=MONEY,
    net_qty=T.IntegerType(), net_amount=MONEY, is_paid=T.IntegerType(),
)
DWS_USER_TYPES = _types(
    dt=T.DateType(), order_cnt=T.LongType(), paid_order_cnt=T.LongType(), gmv=TOTAL,
    is_paid_buyer=T.IntegerType(),
)
DWS_CATEGORY_TYPES = _types(
    dt=T.DateType(), gmv=TOTAL, gross_qty=T.LongType(), refund_qty=T.LongType(),
    net_qty=T.LongType(), qty=T.LongType(),
)


def conform(df: DataFrame, types: T.StructType) -> DataFrame:
    """Re-type the columns named in ``types`` in one projection.

    Malformed values become NULL (``try_cast``), never an exception, so a
    quality gate can count them.  Columns not named pass through unchanged;
    named columns absent from ``df`` are added as typed NULLs (schema drift).
    """
    wanted = {f.name: f.dataType for f in types.fields}
    cols = [
        as_type(df, c, wanted[c]).alias(c) if c in wanted else F.col(c)
        for c in df.columns
    ]
    cols += [F.lit(None).cast(t).alias(n) for n, t in wanted.items() if n not in df.columns]
    return df.select(*cols)


def _lost(df: DataFrame, types: T.StructType) -> list[tuple[str, Column]]:
    """By column of ``types`` that ``df`` has in another type: whether ``conform``
    makes a value NULL."""
    return [(f.name, F.col(f.name).isNotNull() & as_type(df, f.name, f.dataType).isNull())
            for f in types.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType]


def count_rejects(df: DataFrame, types: T.StructType) -> DataFrame:
    """``(column, type, rejected)``: how many values of each column ``conform`` would
    turn into NULL.  One pass over ``df``; columns that keep their type cannot lose
    any and have no row."""
    lost = _lost(df, types)
    if not lost:
        return df.sparkSession.createDataFrame([], "column string, type string, rejected bigint")
    counts = df.agg(*[F.count_if(c).alias(n) for n, c in lost])
    rows = [F.struct(F.lit(n).alias("column"), F.lit(types[n].dataType.simpleString()).alias("type"),
                     F.col(n).alias("rejected")) for n, _ in lost]
    return counts.select(F.inline(F.array(*rows)))


def rejects(df: DataFrame, types: T.StructType, *keys: str) -> DataFrame:
    """``(keys..., column, value)``: the values that ``conform`` would turn into NULL."""
    lost = _lost(df, types)
    bad = [F.when(c, F.struct(F.lit(n).alias("column"), F.col(n).cast("string").alias("value"))) for n, c in lost]
    none = F.lit(None).cast("struct<column: string, value: string>")
    return df.select(*keys, F.inline(F.array_compact(F.array(none, *bad))))
