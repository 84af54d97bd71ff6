"""Net-GMV reconciliation across DWD, DWS and ADS, as DataFrames.

Checks, in report order:
1. totals: DWD vs DWS, DWS vs ADS, DWD vs ADS;
2. per day, DWD vs DWS, for every day present in either (missing side = 0);
3. per day, DWS vs ADS, for every ADS day (missing DWS day = 0).  A DWS day
   without ADS row (no buyer that day) is not checked at ADS level.
A check passes when |left - right| <= 0.01 (exact decimals).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions.columns import money_sum, tolerance

REPORT_COLUMNS = (
    "scope", "left_layer", "right_layer", "left_gmv", "right_gmv", "abs_diff", "tolerance",
    "status",
)
_WIDE = T.DecimalType(38, 2)


def reconcile_report(
    orders_fact: DataFrame, user_day: DataFrame, kpi: DataFrame, daily: DataFrame
) -> DataFrame:
    """The ordered check report; nothing is collected to the driver.

    One frame holds the sums of every day; the day checks are stacked from its
    rows and the totals are its sums, so each layer is aggregated once.
    """
    paid = F.col("is_paid") == 1
    dwd_day = orders_fact.groupBy("dt").agg(
        F.sum(F.when(paid, F.col("net_gmv")).otherwise(0)).alias("dwd")
    )
    return reconcile_days(dwd_day, user_day.groupBy("dt").agg(F.sum("gmv").alias("dws")), kpi, daily)


def reconcile_days(dwd_day: DataFrame, dws_day: DataFrame, kpi: DataFrame, daily: DataFrame) -> DataFrame:
    """The report from the totals by day of DWD (``dt, dwd``) and DWS (``dt, dws``)."""
    ads_day = daily.select("dt", F.col("gmv").alias("ads"))
    day = dwd_day.join(dws_day, "dt", "full_outer").join(ads_day, "dt", "full_outer")
    totals = day.agg(money_sum(F.col("dwd")).alias("dwd"), money_sum(F.col("dws")).alias("dws")).crossJoin(
        F.broadcast(kpi.select(F.col("gmv_total").alias("ads")))
    )

    def check(block: int, seq: int, scope, left: str, right: str):
        wide = [F.coalesce(F.col(c), F.lit(0)).cast(_WIDE) for c in (left, right)]
        return F.struct(
            F.lit(block).alias("_block"), F.lit(seq).alias("_seq"), scope.alias("scope"),
            F.lit(left).alias("left_layer"), F.lit(right).alias("right_layer"),
            wide[0].alias("left_gmv"), wide[1].alias("right_gmv"),
        )

    total, of_day = F.lit("total"), F.concat(F.lit("day:"), F.col("dt").cast("string"))
    # a day of ADS alone is in neither DWD nor DWS: it has no first check
    in_both = F.when(F.col("dwd").isNotNull() | F.col("dws").isNotNull(), check(1, 0, of_day, "dwd", "dws"))
    in_ads = F.when(F.col("ads").isNotNull(), check(2, 0, of_day, "dws", "ads"))
    whole = F.array(*[check(0, i, total, a, b) for i, (a, b) in enumerate((("dwd", "dws"), ("dws", "ads"), ("dwd", "ads")))])
    rows = totals.select(F.lit(None).cast("date").alias("_dt"), F.inline(whole)).unionByName(
        day.select(F.col("dt").alias("_dt"), F.inline(F.array_compact(F.array(in_both, in_ads))))
    )
    diff = F.abs(F.col("left_gmv") - F.col("right_gmv")).cast(_WIDE)
    return (
        rows.withColumn("abs_diff", diff)
        .withColumn("tolerance", tolerance())
        .withColumn(
            "status", F.when(F.col("abs_diff") <= tolerance(), "PASS").otherwise("FAIL")
        )
        .orderBy("_block", "_dt", "_seq")
        .select(*REPORT_COLUMNS)
    )


def report_text(report: DataFrame) -> DataFrame:
    """The report as text: sums with two decimals, differences and the tolerance with four."""
    def fixed(name: str, decimals: int):
        return F.col(name).cast(T.DecimalType(38, decimals)).cast("string").alias(name)

    digits = {"left_gmv": 2, "right_gmv": 2, "abs_diff": 4, "tolerance": 4}
    return report.select(*[fixed(c, digits[c]) if c in digits else F.col(c) for c in REPORT_COLUMNS])


def reconcile_verdict(report: DataFrame) -> DataFrame:
    """One row: number of checks, failed checks, overall PASS/FAIL."""
    failed = F.count_if(F.col("status") == "FAIL")
    return report.agg(
        F.count(F.lit(1)).alias("checks"),
        failed.alias("failed"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("verdict"),
    )
