"""Hard quality gates between ODS and DWD.

Two ways to run them:

* one gate family at a time (``not_null``, ``unique``, ``values_in``,
  ``non_negative``, ``positive``, ``foreign_key``, ``amount_match``,
  ``line_amount``, ``ts_dt_alignment``, ``refund_rules``): each returns a
  small ``(gate, bad_rows)`` DataFrame;
* ``gate_report``: all 28 gates fused into one query that returns a 28-row
  ``(ordinal, gate, bad_rows)`` report.  Row-level predicates become
  ``count_if`` columns of the keyed aggregates that the key checks need
  anyway, so the tables are scanned a handful of times instead of once per
  gate.  ``check_gates`` then raises on the first failing gate in order,
  which is what a gate-by-gate run would report first.

Every gate counts offending rows, except the primary-key gates, which count
duplicated *keys*.  NULL handling follows each predicate exactly: the
`non-negative`/`positive` gates count NULL as bad explicitly, the comparison
gates ignore rows where an operand is NULL (the `required` gates run first).
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.columns import (
    AMOUNT_CHECKED_STATUSES,
    CHANNELS,
    GENDERS,
    ORDER_STATUSES,
    any_missing,
    as_date,
    as_timestamp,
    tolerance,
)


class QualityError(RuntimeError):
    """A hard gate failed; ``gate`` and ``bad_rows`` name the first failure."""

    def __init__(self, gate: str, bad_rows: int):
        super().__init__(f"QUALITY FAIL [{gate}]: {bad_rows} bad row(s)")  # fixed value: the message format
        self.gate = gate
        self.bad_rows = bad_rows


# Required columns and the 28 gate names in evaluation order.
USER_REQUIRED = ("user_id", "register_dt", "city", "gender", "channel")
ORDER_REQUIRED = ("order_id", "user_id", "order_ts", "status", "pay_amount", "refund_amount", "dt")
ITEM_REQUIRED = (
    "order_item_id", "order_id", "sku_id", "category", "qty", "unit_price", "amount",
    "refund_qty", "refund_amount",
)
GATES = (
    "ods_users.required",
    "ods_users.pk",
    "ods_users.gender",
    "ods_users.channel",
    "ods_orders.required",
    "ods_orders.pk",
    "ods_orders.status",
    "ods_orders.pay_amount",
    "ods_orders.order_ts_parseable",
    "ods_orders.dt_parseable",
    "ods_orders.order_ts_dt_align",
    "ods_orders.fk_user",
    "ods_items.required",
    "ods_items.pk",
    "ods_items.qty",
    "ods_items.unit_price",
    "ods_items.amount",
    "ods_items.amount_eq_qty_price",
    "ods_items.fk_order",
    "ods_orders.amount_vs_items",
    "ods_orders.refund_amount",
    "ods_items.refund_qty",
    "ods_items.refund_amount",
    "ods_items.refund_qty_lte_qty",
    "ods_items.refund_amount_lte_amount",
    "ods_orders.refund_lte_pay",
    "ods_orders.refund_vs_items",
    "ods_orders.refunded_full",
)
REPORT_COLUMNS = ("ordinal", "gate", "bad_rows")


# ---------------------------------------------------------------- predicates
def _not_in(c: Column, allowed) -> Column:
    return ~c.isin(*allowed) | c.isNull()


def _negative(c: Column) -> Column:
    return c.isNull() | (c < 0)


def _not_positive(c: Column) -> Column:
    return c.isNull() | (c <= 0)


def _exceeds(a: Column, b: Column) -> Column:
    """a - b > 0.01 (NULL when either side is NULL)."""
    return (a - b) > tolerance()


def _differs(a: Column, b: Column) -> Column:
    return F.abs(a - b) > tolerance()


def user_row_checks(users: DataFrame) -> dict[str, Column]:
    return {
        "ods_users.required": any_missing(users, USER_REQUIRED),
        "ods_users.gender": _not_in(F.col("gender"), GENDERS),
        "ods_users.channel": _not_in(F.col("channel"), CHANNELS),
    }


def order_row_checks(orders: DataFrame) -> dict[str, Column]:
    ts = as_timestamp(orders, "order_ts")
    day = as_date(orders, "dt")
    pay, refund = F.col("pay_amount"), F.col("refund_amount")
    return {
        "ods_orders.required": any_missing(orders, ORDER_REQUIRED),
        "ods_orders.status": _not_in(F.col("status"), ORDER_STATUSES),
        "ods_orders.pay_amount": _negative(pay),
        "ods_orders.order_ts_parseable": ts.isNull(),
        "ods_orders.dt_parseable": day.isNull(),
        "ods_orders.order_ts_dt_align": F.to_date(ts) != day,
        "ods_orders.refund_amount": _negative(refund),
        "ods_orders.refund_lte_pay": _exceeds(refund, pay),
        "ods_orders.refunded_full": (F.col("status") == "refunded") & _differs(pay, refund),
    }


def item_row_checks(items: DataFrame) -> dict[str, Column]:
    qty, price, amount = F.col("qty"), F.col("unit_price"), F.col("amount")
    rqty, ramount = F.col("refund_qty"), F.col("refund_amount")
    return {
        "ods_items.required": any_missing(items, ITEM_REQUIRED),
        "ods_items.qty": _not_positive(qty),
        "ods_items.unit_price": _negative(price),
        "ods_items.amount": _negative(amount),
        "ods_items.amount_eq_qty_price": amount.isNull()
        | qty.isNull()
        | price.isNull()
        | _differs(amount, qty * price),
        "ods_items.refund_qty": _negative(rqty),
        "ods_items.refund_amount": _negative(ramount),
        "ods_items.refund_qty_lte_qty": rqty > qty,
        "ods_items.refund_amount_lte_amount": _exceeds(ramount, amount),
    }


def _amount_vs_items(item_sum: Column) -> Column:
    return F.col("status").isin(*AMOUNT_CHECKED_STATUSES) & (
        item_sum.isNull() | _differs(F.col("pay_amount"), item_sum)
    )


def _refund_vs_items(item_refund_sum: Column) -> Column:
    return _differs(F.col("refund_amount"), F.coalesce(item_refund_sum, F.lit(0)))


# ------------------------------------------------------ gate-family operators
def _one(name: str, bad_rows: Column) -> list:
    return [F.lit(name).alias("gate"), bad_rows.cast("long").alias("bad_rows")]


def count_violations(df: DataFrame, violation: Column, name: str) -> DataFrame:
    """Rows where ``violation`` is TRUE (NULL counts as not violated)."""
    return df.agg(*_one(name, F.count_if(violation)))


def not_null(df: DataFrame, cols, name: str) -> DataFrame:
    """Rows with any listed column NULL or blank (each row counted once)."""
    return count_violations(df, any_missing(df, cols), name)


def unique(df: DataFrame, cols, name: str) -> DataFrame:
    """Number of key values that occur more than once (NULL is a key value)."""
    keyed = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return keyed.agg(*_one(name, F.count_if(F.col("n") > 1)))


def values_in(df: DataFrame, col: str, allowed, name: str) -> DataFrame:
    return count_violations(df, _not_in(F.col(col), allowed), name)


def non_negative(df: DataFrame, col: str, name: str) -> DataFrame:
    return count_violations(df, _negative(F.col(col)), name)


def positive(df: DataFrame, col: str, name: str) -> DataFrame:
    return count_violations(df, _not_positive(F.col(col)), name)


def foreign_key(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Child rows without a parent (a NULL key never has one).

    The child side is pre-aggregated per key, so a hot key travels as one
    count per task rather than as its rows.
    """
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    orphans = per_key.join(parent.select(key), key, "left_anti")
    return orphans.agg(*_one(name, F.coalesce(F.sum("n"), F.lit(0))))


def _item_sums(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.sum("amount").alias("item_sum"), F.sum("refund_amount").alias("item_refund_sum")
    )


def amount_match(orders: DataFrame, items: DataFrame, name: str = GATES[19]) -> DataFrame:
    """Paid, shipped, completed or refunded orders whose pay amount differs
    from their line sum by more than 0.01, or that have no lines."""
    joined = orders.join(_item_sums(items), "order_id", "left")
    return count_violations(joined, _amount_vs_items(F.col("item_sum")), name)


def line_amount(items: DataFrame, name: str = GATES[17]) -> DataFrame:
    """Lines where amount != qty * unit_price within 0.01, or an operand is NULL."""
    return count_violations(items, item_row_checks(items)[GATES[17]], name)


def refund_vs_items(orders: DataFrame, items: DataFrame, name: str = GATES[26]) -> DataFrame:
    """Orders (any status) whose refund differs from their lines' refunds; no
    lines counts as a zero refund."""
    joined = orders.join(_item_sums(items), "order_id", "left")
    return count_violations(joined, _refund_vs_items(F.col("item_refund_sum")), name)


def _union(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def ts_dt_alignment(orders: DataFrame) -> DataFrame:
    """Three gates: timestamp parses, day parses, date(timestamp) == day."""
    checks = order_row_checks(orders)
    names = GATES[8:11]
    return orders.agg(
        *[F.count_if(checks[n]).alias(f"c{i}") for i, n in enumerate(names)]
    ).select(_stack(names, [f"c{i}" for i in range(len(names))], with_ordinal=False))


def counted(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Several row gates of one table in one scan: ``(gate, bad_rows)``."""
    names = list(checks)
    cols = [f"c{i}" for i in range(len(names))]
    return df.agg(*[F.count_if(checks[n]).alias(c) for n, c in zip(names, cols)]).select(
        _stack(names, cols, with_ordinal=False))


def non_negative_gates(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The six gates of amounts and quantities that must not be negative."""
    oc, ic = order_row_checks(orders), item_row_checks(items)
    return counted(orders, {g: oc[g] for g in (GATES[7], GATES[20])}).unionByName(
        counted(items, {g: ic[g] for g in (GATES[15], GATES[16], GATES[21], GATES[22])}))


def refund_rules(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The eight refund gates (non-negative refunds, refund within the
    original, header equal to its lines, refunded means fully refunded): the
    lines are scanned once, by order, and joined to the orders."""
    oc, ic = order_row_checks(orders), item_row_checks(items)
    of_items, of_orders = [GATES[i] for i in (21, 22, 23, 24)], [GATES[i] for i in (20, 25, 27)]
    lines = items.groupBy("order_id").agg(
        F.sum("refund_amount").alias("item_refund_sum"), *[F.count_if(ic[g]).alias(_col(g)) for g in of_items])
    header = orders.select("order_id", "refund_amount", *[oc[g].alias(_col(g)) for g in of_orders])
    joined = header.join(lines.select("order_id", "item_refund_sum"), "order_id", "left")
    checks = {g: F.col(_col(g)) for g in of_orders} | {GATES[26]: _refund_vs_items(F.col("item_refund_sum"))}
    sums = lines.agg(*[_sum0(F.col(_col(g))).alias(_col(g)) for g in of_items])
    return sums.select(_stack(of_items, [_col(g) for g in of_items], with_ordinal=False)).unionByName(
        counted(joined, checks))


# --------------------------------------------------------------- fused report
def _col(name: str) -> str:
    return "g_" + name.replace(".", "__")


def _stack(names, cols, with_ordinal: bool = True) -> Column:
    parts = []
    for name, col in zip(names, cols):
        if with_ordinal:
            parts.append(f"{GATES.index(name) + 1}")
        parts.append(f"'{name}'")
        parts.append(f"cast(`{col}` as bigint)")
    out = "ordinal, gate, bad_rows" if with_ordinal else "gate, bad_rows"
    return F.expr(f"stack({len(names)}, {', '.join(parts)}) as ({out})")


def _sum0(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("long")


def _user_side(users: DataFrame, orders: DataFrame) -> DataFrame:
    """G1-G4 and G12 from two per-user aggregates joined full outer."""
    checks = user_row_checks(users)
    per_user = users.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_u"),
        *[F.count_if(c).alias(_col(n)) for n, c in checks.items()],
    )
    orders_per_user = orders.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_ord"))
    both = per_user.join(orders_per_user, "user_id", "full_outer")
    orphan = F.col("n_u").isNull() | F.col("user_id").isNull()
    return both.agg(
        *[_sum0(F.col(_col(n))).alias(_col(n)) for n in checks],
        F.count_if(F.col("n_u") > 1).cast("long").alias(_col(GATES[1])),
        _sum0(F.when(orphan, F.col("n_ord"))).alias(_col(GATES[11])),
    )


def _order_side(orders: DataFrame, items: DataFrame):
    """Order-keyed gates from one per-order line aggregate.

    ``lines`` (one row per order id, item row-gate counts included) is joined
    left to the order rows - keeping the order-id partitioning, so the
    per-order ``groupBy`` needs no new shuffle - and anti-joined for orphan
    lines.  Both uses need every column of ``lines``, so its shuffle is shared.
    """
    ochecks, ichecks = order_row_checks(orders), item_row_checks(items)
    item_cols = [_col(n) for n in ichecks]
    lines = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("amount").alias("item_sum"),
        F.sum("refund_amount").alias("item_refund_sum"),
        *[F.count_if(c).alias(_col(n)) for n, c in ichecks.items()],
    )
    order_rows = orders.select(
        "order_id", "status", "pay_amount", "refund_amount",
        *[c.alias(_col(n)) for n, c in ochecks.items()],
    )
    # rows of one order id with equal amounts are one row with a count from here on, so an id that repeats on many
    # rows is small before it meets its lines
    alike = order_rows.groupBy("order_id", "status", "pay_amount", "refund_amount").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(_col(n)).alias(_col(n)) for n in ochecks])

    def rows_if(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    per_order = (
        alike.join(lines, "order_id", "left")
        .groupBy("order_id")
        .agg(
            F.sum("n").alias("n_o"),
            *[F.sum(_col(n)).alias(_col(n)) for n in ochecks],
            rows_if(_amount_vs_items(F.col("item_sum"))).alias(_col(GATES[19])),
            rows_if(_refund_vs_items(F.col("item_refund_sum"))).alias(_col(GATES[26])),
            F.max("n_items").alias("n_items"),
            *[F.max(c).alias(c) for c in item_cols],
        )
    )
    order_stats = per_order.agg(
        *[_sum0(F.col(_col(n))).alias(_col(n)) for n in ochecks],
        F.count_if(F.col("n_o") > 1).cast("long").alias(_col(GATES[5])),
        _sum0(F.col(_col(GATES[19]))).alias(_col(GATES[19])),
        _sum0(F.col(_col(GATES[26]))).alias(_col(GATES[26])),
        *[_sum0(F.col(c)).alias("m_" + c) for c in item_cols],
    )
    orphan_stats = lines.join(order_rows, "order_id", "left_anti").agg(
        _sum0(F.col("n_items")).alias(_col(GATES[18])),
        *[_sum0(F.col(c)).alias("o_" + c) for c in item_cols],
    )
    return order_stats, orphan_stats, item_cols


def gate_report(users: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """All 28 gates as one query: ``(ordinal, gate, bad_rows)``, 28 rows."""
    user_stats = _user_side(users, orders)
    order_stats, orphan_stats, item_cols = _order_side(orders, items)
    item_pk = unique(items, ["order_item_id"], GATES[13]).select(
        F.col("bad_rows").alias(_col(GATES[13]))
    )
    row = (
        user_stats.crossJoin(order_stats).crossJoin(orphan_stats).crossJoin(item_pk)
        .select(
            "*",
            *[(F.col("m_" + c) + F.col("o_" + c)).alias(c) for c in item_cols],
        )
    )
    return row.select(_stack(GATES, [_col(n) for n in GATES]))


def first_failure(report: DataFrame) -> DataFrame:
    """The first failing gate in evaluation order (zero or one row)."""
    return report.filter(F.col("bad_rows") > 0).orderBy("ordinal").limit(1)


def check_gates(report: DataFrame) -> None:
    """Raise ``QualityError`` for the first failing gate (the report has 28 rows)."""
    rows = first_failure(report).collect()
    if rows:
        raise QualityError(rows[0]["gate"], int(rows[0]["bad_rows"]))
