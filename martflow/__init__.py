"""martflow: layered sales marts on Spark DataFrames.

ODS (users, orders, order lines) -> 28 quality gates -> DWD facts and user
dimension -> DWS user-day and category-day summaries -> ADS 7-day repurchase
and KPI -> cross-layer net-GMV reconciliation.  Facts are stored by day; any
day can be re-run on its own.
"""
from martflow.sources.ods_csv import Ods  # noqa: F401

__all__ = ["Ods"]
