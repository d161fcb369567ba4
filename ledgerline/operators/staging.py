"""Staging projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STG_EVENT_COLUMNS = ["event_id", "event_ts", "received_ts", "user_id", "device_id",
                     "session_id", "event_type", "props", "is_late", "lateness_sec",
                     "source_file", "ingestion_ts"]


def stg_events(silver_events: DataFrame) -> DataFrame:
    """G1: the 12 silver columns the marts use (drops the bronze hash)."""
    return silver_events.select(*STG_EVENT_COLUMNS)


def stg_billing(silver_billing: DataFrame) -> DataFrame:
    """Silver billing with ``event`` renamed ``billing_event``."""
    return silver_billing.select("billing_date", "user_id",
                                 F.col("event").alias("billing_event"),
                                 "plan_id", "source_file", "ingestion_ts")
