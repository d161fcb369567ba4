"""SQL access to a lake: every layer as a temporary view (the source system
materialises its models as views), and the dashboard reads as parameterised
SQL with named bind parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans.lake import LAYOUT, Lake

EVENTS_DAILY_BETWEEN = """
SELECT date_day, events, dau, late_events,
       coalesce(late_events / nullif(events, 0), 0) * 100.0 AS late_rate_pct
FROM fct_events_daily
WHERE date_day BETWEEN :start AND :end
"""

BILLING_DAILY_BETWEEN = """
SELECT date_day, plan_id, starts, new_paid_users
FROM fct_billing_daily
WHERE date_day BETWEEN :start AND :end
"""


def register_views(lake: Lake, names: list[str] | None = None) -> list[str]:
    """Register the lake's layers as temporary views named after them."""
    names = names or list(LAYOUT) + ["stg_events", "stg_billing"]
    for n in names:
        getattr(lake, n).createOrReplaceTempView(n)
    return names


def query(spark: SparkSession, sql: str, **params) -> DataFrame:
    """Run SQL against the registered views with named bind parameters."""
    return spark.sql(sql, args=params)
