"""ADS: 7-day repurchase by cohort day and the one-row KPI overview.

Repurchase rule: the buyers of day D are the users with a paid order on D;
a buyer repurchases when the same user has another paid day in (D, D+7].
Same-day repeats do not count, D+8 does not count.  A cohort day is
``window_complete`` when D+7 is not after the last day of the data (last day
taken over all user-days, paid or not).  Only days with at least one buyer
appear, but their GMV is the whole day's GMV.
"""
from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.columns import REPURCHASE_WINDOW_DAYS, half_up_ratio, money_sum

DAILY_COLUMNS = ("dt", "buyers", "repurchase_users", "repurchase_rate_7d", "gmv", "window_complete")


def _buyer() -> Column:
    return (F.col("is_paid_buyer") == 1) & F.col("user_id").isNotNull()


def _day_bin(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(width))


def _finish(per_day: DataFrame, window_days: int, last: DataFrame | None = None) -> DataFrame:
    """per_day(dt, buyers, repurchase_users, gmv) over *all* days -> daily rows."""
    if last is None:
        last = per_day.agg(F.max("dt").alias("max_dt"))  # one row: safe to broadcast
    return (
        per_day.filter(F.col("buyers") > 0)
        .crossJoin(F.broadcast(last))
        .select(
            "dt",
            "buyers",
            "repurchase_users",
            half_up_ratio("repurchase_users", "buyers").alias("repurchase_rate_7d"),
            "gmv",
            F.when(F.date_add("dt", window_days) <= F.col("max_dt"), 1)
            .otherwise(0)
            .alias("window_complete"),
        )
    )


def repurchase_7d(
    user_day: DataFrame,
    window_days: int = REPURCHASE_WINDOW_DAYS,
    last: DataFrame | None = None,
) -> DataFrame:
    """Daily repurchase from a user-day table (user_id, dt, is_paid_buyer, gmv).

    The range self-join of the definition is rewritten as one window: per user,
    days in descending order, the running ``min`` of paid days strictly after
    the current row is the next paid day.  That is one shuffle by ``user_id``
    and a linear pass per user (a user has at most one row per calendar day, so
    even the heaviest buyer is a bounded group), then a ``groupBy(dt)`` with
    map-side combining.
    """
    after = (
        Window.partitionBy("user_id")
        .orderBy(F.col("dt").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    next_paid = F.min(F.when(F.col("is_paid_buyer") == 1, F.col("dt"))).over(after)
    flagged = user_day.select(
        "dt",
        "gmv",
        _buyer().alias("buyer"),
        (_buyer() & (next_paid <= F.date_add("dt", window_days))).alias("repurchased"),
    )
    per_day = flagged.groupBy("dt").agg(
        F.count_if("buyer").alias("buyers"),
        F.count_if("repurchased").alias("repurchase_users"),
        F.sum("gmv").alias("gmv"),
    )
    return _finish(per_day, window_days, last)


def days_near(day: str, window_days: int = REPURCHASE_WINDOW_DAYS) -> list[str]:
    """The days of user-days that ``repurchase_after_day`` needs."""
    at = date.fromisoformat(day)
    return [(at + timedelta(days=i)).isoformat() for i in range(-window_days, window_days + 1)]


def repurchase_after_day(
    user_day: DataFrame, stored: DataFrame, day: str, window_days: int = REPURCHASE_WINDOW_DAYS,
    last: DataFrame | None = None,
) -> DataFrame:
    """The daily table after ``day`` of ``user_day`` changed, from the ``stored``
    one: only cohorts from ``window_days`` before up to the day can differ, and
    they depend on user-days up to ``window_days`` behind it (``days_near``), so
    ``user_day`` is read there alone.  ``last`` is the last day of all user-days
    (``max_dt``, one row); without it ``user_day`` must hold every day.
    ``window_complete`` is set anew on every row."""
    changed = F.lit(day).cast("date")
    low, high = F.date_sub(changed, window_days), F.date_add(changed, window_days)
    if last is None:
        last = user_day.agg(F.max("dt").alias("max_dt"))
    near = repurchase_7d(user_day.filter(F.col("dt").between(low, high)), window_days, last)
    fresh = near.filter(F.col("dt").between(low, changed))
    kept = stored.filter(~F.col("dt").between(low, changed)).crossJoin(F.broadcast(last)).withColumn(
        "window_complete", F.when(F.date_add("dt", window_days) <= F.col("max_dt"), 1).otherwise(0))
    return kept.select(*DAILY_COLUMNS).unionByName(fresh.select(*DAILY_COLUMNS))


def repurchase_7d_range_join(
    user_day: DataFrame, window_days: int = REPURCHASE_WINDOW_DAYS
) -> DataFrame:
    """The same result through the definition's range self-join.

    Each buyer-day is joined to the same user's paid days in (D, D+window].
    The range is evaluated as a binned equi-join: days fall in bins of
    ``window_days``, a cohort row probes its own bin and the next one, so a
    join group holds at most ``window_days`` candidates per probe (no
    all-pairs comparison per user).  Kept as an independent cross-check of
    ``repurchase_7d``.
    """
    buyers = user_day.filter(_buyer()).select("user_id", "dt")
    probes = buyers.select(
        "user_id",
        F.col("dt").alias("cohort_dt"),
        F.explode(
            F.array(_day_bin(F.col("dt"), window_days), _day_bin(F.col("dt"), window_days) + 1)
        ).alias("bin"),
    )
    targets = buyers.select(
        "user_id", F.col("dt").alias("next_dt"), _day_bin(F.col("dt"), window_days).alias("bin")
    )
    hits = (
        probes.join(targets, ["user_id", "bin"])
        .filter(
            (F.col("next_dt") > F.col("cohort_dt"))
            & (F.col("next_dt") <= F.date_add("cohort_dt", window_days))
        )
        .select("user_id", F.col("cohort_dt").alias("dt"))
        .distinct()
        .withColumn("repurchased", F.lit(True))
    )
    flagged = user_day.join(hits, ["user_id", "dt"], "left").select(
        "dt", "gmv", _buyer().alias("buyer"), F.coalesce("repurchased", F.lit(False)).alias("rep")
    )
    per_day = flagged.groupBy("dt").agg(
        F.count_if("buyer").alias("buyers"),
        F.count_if(F.col("buyer") & F.col("rep")).alias("repurchase_users"),
        F.sum("gmv").alias("gmv"),
    )
    return _finish(per_day, window_days)


def kpi_overview(orders_fact: DataFrame, user_day: DataFrame, daily: DataFrame) -> DataFrame:
    """One row: paid orders and users, total net GMV, complete-window buyers
    and repurchasers, and the weighted repurchase rate (NULL without buyers).

    Three global aggregates (each a partial aggregate per task) joined as
    one-row frames.
    """
    paid = F.col("is_paid") == 1
    orders_part = orders_fact.agg(
        F.count_if(paid).alias("paid_orders"),
        F.count_distinct(F.when(paid, F.col("user_id"))).alias("paid_users"),
    )
    gmv_part = user_day.agg(money_sum(F.col("gmv")).alias("gmv_total"))
    return kpi_of_totals(orders_part.crossJoin(F.broadcast(gmv_part)), daily)


def kpi_of_totals(totals: DataFrame, daily: DataFrame) -> DataFrame:
    """The KPI row from its one-row totals (``paid_orders``, ``paid_users``,
    ``gmv_total``) and the daily table."""
    complete = F.col("window_complete") == 1
    window_part = daily.agg(
        F.coalesce(F.sum(F.when(complete, F.col("buyers")).otherwise(0)), F.lit(0))
        .cast("long")
        .alias("buyers_complete_window"),
        F.coalesce(F.sum(F.when(complete, F.col("repurchase_users")).otherwise(0)), F.lit(0))
        .cast("long")
        .alias("repurchase_users_complete_window"),
    )
    return (
        totals.crossJoin(F.broadcast(window_part))
        .select(
            "paid_orders",
            "paid_users",
            "gmv_total",
            "buyers_complete_window",
            "repurchase_users_complete_window",
            half_up_ratio("repurchase_users_complete_window", "buyers_complete_window").alias(
                "repurchase_rate_7d_weighted"
            ),
        )
    )


def paid_days(user_day: DataFrame) -> DataFrame:
    """``(user_id, days)``: on how many days each user has paid orders."""
    return user_day.filter(_buyer()).groupBy("user_id").agg(F.count(F.lit(1)).alias("days"))


def paid_days_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(user_id, days)`` with 1 or -1 for the users whom a new version of one
    day's user-days makes a paid user of that day, or no longer one."""
    old = before.filter(_buyer()).select("user_id", F.lit(-1).cast("long").alias("days"))
    new = after.filter(_buyer()).select("user_id", F.lit(1).cast("long").alias("days"))
    return old.unionByName(new).groupBy("user_id").agg(F.sum("days").alias("days")).filter("days <> 0")


def paid_users_change(paid: DataFrame, change: DataFrame) -> DataFrame:
    """One row, ``paid_users``: by how many users the count of those with paid
    days grows when ``change`` is added to ``paid``.  Only the changed users' rows
    of ``paid`` (of which a user may have several) are summed."""
    now = paid.join(change.select("user_id"), "user_id", "left_semi").groupBy("user_id").agg(F.sum("days").alias("had"))
    both = change.join(now, "user_id", "left").withColumn("had", F.coalesce("had", F.lit(0)))
    step = (F.col("had") + F.col("days") > 0).cast("long") - (F.col("had") > 0).cast("long")
    return both.agg(F.coalesce(F.sum(step), F.lit(0)).cast("long").alias("paid_users"))


def complete_days(daily: DataFrame) -> DataFrame:
    """Trend-safe cohort days only."""
    return daily.filter(F.col("window_complete") == 1)


def head_days(daily: DataFrame, n: int = 15) -> DataFrame:
    """The first ``n`` complete cohort days (a preview; the limit is the feature)."""
    return complete_days(daily).orderBy("dt").limit(n)
