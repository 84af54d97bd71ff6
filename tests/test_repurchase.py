"""Repurchase: window rewrite and binned range join against brute force."""
from __future__ import annotations

import datetime as dt
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from martflow.operators.ads import repurchase_7d, repurchase_7d_range_join
from martflow.sources.events import events_user_day

BASE = dt.date(2026, 7, 1)
USER_DAY = "user_id string, dt date, is_paid_buyer int, gmv decimal(18,2)"


def brute_force(rows, window=7):
    """The definition, evaluated literally over (user, day, paid, gmv) tuples."""
    if not rows:
        return []
    max_dt = max(d for _, d, _, _ in rows)
    paid = {(u, d) for u, d, p, _ in rows if p == 1}
    out = []
    for day in sorted({d for _, d, _, _ in rows}):
        buyers = {u for u, d in paid if d == day}
        if not buyers:
            continue
        rep = {u for u in buyers
               if any((u, day + dt.timedelta(k)) in paid for k in range(1, window + 1))}
        gmv = sum(g for _, d, _, g in rows if d == day)
        num, den = len(rep), len(buyers)
        rate = ((num * 20000 + den) // (2 * den)) / 10000.0
        out.append((day, den, num, rate, gmv, int(day + dt.timedelta(window) <= max_dt)))
    return out


def _collect(df):
    return sorted(tuple(r) for r in df.collect())


user_days = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", "d", "e"]),
        st.integers(min_value=0, max_value=40),
        st.integers(min_value=0, max_value=1),
        st.integers(min_value=0, max_value=50000),
    ),
    min_size=1,
    max_size=60,
    unique_by=lambda t: (t[0], t[1]),
)


@settings(max_examples=8, deadline=None)
@given(user_days)
def test_repurchase_matches_brute_force(spark, rows):
    typed = [(u, BASE + dt.timedelta(d), p, Decimal(g) / 100) for u, d, p, g in rows]
    df = spark.createDataFrame(typed, USER_DAY)
    expected = brute_force(typed)
    assert _collect(repurchase_7d(df)) == expected
    assert _collect(repurchase_7d_range_join(df)) == expected


def test_window_edges(spark):
    """D+7 counts, D+8 does not, a same-day repeat does not, unpaid days do not."""
    rows = [
        ("a", BASE, 1, Decimal("1.00")), ("a", BASE + dt.timedelta(7), 1, Decimal("1.00")),
        ("b", BASE, 1, Decimal("1.00")), ("b", BASE + dt.timedelta(8), 1, Decimal("1.00")),
        ("c", BASE, 1, Decimal("1.00")), ("c", BASE + dt.timedelta(3), 0, Decimal("0.00")),
    ]
    df = spark.createDataFrame(rows, USER_DAY)
    first = [r for r in repurchase_7d(df).collect() if r["dt"] == BASE][0]
    assert (first["buyers"], first["repurchase_users"], first["repurchase_rate_7d"]) == (3, 1, 0.3333)
    assert first["window_complete"] == 1
    assert _collect(repurchase_7d(df)) == brute_force(rows)


def test_events_user_day(spark):
    ev = spark.createDataFrame(
        [
            (1, dt.datetime(2024, 1, 1, 10), "purchase", 10.25),
            (1, dt.datetime(2024, 1, 1, 11), "view", 99.0),
            (1, dt.datetime(2024, 1, 3, 9), "purchase", 1.10),
            (2, dt.datetime(2024, 1, 1, 9), "click", 5.0),
        ],
        "user_id long, ts timestamp_ntz, event_type string, value double",
    )
    got = {(r["user_id"], str(r["dt"])): (r["is_paid_buyer"], float(r["gmv"]))
           for r in events_user_day(ev).collect()}
    assert got == {(1, "2024-01-01"): (1, 10.25), (1, "2024-01-03"): (1, 1.1),
                   (2, "2024-01-01"): (0, 0.0)}
    daily = {str(r["dt"]): (r["buyers"], r["repurchase_users"])
             for r in repurchase_7d(events_user_day(ev)).collect()}
    assert daily == {"2024-01-01": (1, 1), "2024-01-03": (1, 0)}
