"""Layer operators: every function takes and returns DataFrames."""
from martflow.operators.ads import (  # noqa: F401
    complete_days,
    head_days,
    kpi_overview,
    repurchase_7d,
    repurchase_7d_range_join,
)
from martflow.operators.dwd import dim_user, fact_order, fact_order_item  # noqa: F401
from martflow.operators.dws import category_gmv_1d, user_order_1d  # noqa: F401
from martflow.operators.fingerprint import (  # noqa: F401
    day_lanes,
    distinct_days,
    fingerprint_tree,
    partition_fingerprint,
    tree_differences,
)
from martflow.operators.gates import (  # noqa: F401
    GATES,
    QualityError,
    amount_match,
    check_gates,
    first_failure,
    foreign_key,
    gate_report,
    line_amount,
    non_negative,
    not_null,
    positive,
    refund_rules,
    refund_vs_items,
    ts_dt_alignment,
    unique,
    values_in,
)
from martflow.operators.reconcile import reconcile_report, reconcile_verdict  # noqa: F401
from martflow.operators.slicing import day_slice, parse_day  # noqa: F401
