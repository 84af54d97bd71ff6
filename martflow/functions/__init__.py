"""Scalar column helpers (dates, money, flags, exact ratios)."""
from martflow.functions.columns import (  # noqa: F401
    AMOUNT_CHECKED_STATUSES,
    CHANNELS,
    GENDERS,
    MONEY,
    ORDER_STATUSES,
    PAID_STATUSES,
    PRICE,
    REPURCHASE_WINDOW_DAYS,
    TOLERANCE,
    any_missing,
    as_date,
    as_timestamp,
    as_type,
    half_up_ratio,
    is_blank,
    missing,
    money_sum,
    paid_flag,
    tolerance,
)
