"""Schemas of the layers (names and types; Parquet does not enforce NOT NULL,
the quarantine split and the checks do)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, TS, D, L, I, B, DB = (T.StringType(), T.TimestampType(), T.DateType(), T.LongType(),
                         T.IntegerType(), T.BooleanType(), T.DoubleType())


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


BRONZE_EVENTS = _schema(("event_id", S), ("event_ts", TS), ("received_ts", TS), ("user_id", S),
                        ("device_id", S), ("session_id", S), ("event_type", S), ("props", S),
                        ("source_file", S), ("ingestion_ts", TS), ("row_hash", S))
BRONZE_BILLING = _schema(("billing_date", D), ("user_id", S), ("event", S), ("plan_id", S),
                         ("source_file", S), ("ingestion_ts", TS), ("row_hash", S))
SILVER_EVENTS = _schema(("event_id", S), ("event_ts", TS), ("received_ts", TS), ("user_id", S),
                        ("device_id", S), ("session_id", S), ("event_type", S), ("props", S),
                        ("bronze_row_hash", S), ("source_file", S), ("ingestion_ts", TS),
                        ("is_late", B), ("lateness_sec", I))
SILVER_EVENTS_QUARANTINE = _schema(("bronze_row_hash", S), ("source_file", S), ("ingestion_ts", TS),
                                   ("reason_code", S), ("reason_detail", S), ("raw_record", S))
SILVER_BILLING = _schema(("billing_date", D), ("user_id", S), ("event", S), ("plan_id", S),
                         ("bronze_row_hash", S), ("source_file", S), ("ingestion_ts", TS))
SILVER_BILLING_QUARANTINE = _schema(("bronze_row_hash", S), ("source_file", S), ("ingestion_ts", TS),
                                    ("reason_code", S), ("raw_record", S))
FCT_EVENTS_DAILY = _schema(("date_day", D), ("events", L), ("dau", L), ("late_events", L))
FCT_BILLING_DAILY = _schema(("date_day", D), ("plan_id", S), ("starts", L), ("new_paid_users", L))
FCT_SUBSCRIPTIONS_DAILY = _schema(("date_day", D), ("user_id", S), ("is_active", B), ("plan_id", S))
GOLD_CHURN_LABELS_DAILY = _schema(("date_day", D), ("user_id", S), ("churn_7d", I))
GOLD_USER_FEATURES_DAILY = _schema(("date_day", D), ("user_id", S), ("is_active", B), ("plan_id", S),
                                   ("events_7d", L), ("sessions_7d", L), ("feature_use_7d", L),
                                   ("support_tickets_14d", L), ("late_rate_7d", DB), ("churn_7d", I))
GOLD_CHURN_BY_PLAN_DAILY = _schema(("date_day", D), ("plan_id", S), ("users", L), ("churners", L),
                                   ("churn_rate_pct", DB))

LAYER_SCHEMAS = {
    "bronze_events": BRONZE_EVENTS, "bronze_billing": BRONZE_BILLING,
    "silver_events": SILVER_EVENTS, "events_quarantine": SILVER_EVENTS_QUARANTINE,
    "silver_billing": SILVER_BILLING, "billing_quarantine": SILVER_BILLING_QUARANTINE,
    "fct_events_daily": FCT_EVENTS_DAILY, "fct_billing_daily": FCT_BILLING_DAILY,
    "fct_subscriptions_daily": FCT_SUBSCRIPTIONS_DAILY,
    "gold_churn_labels_daily": GOLD_CHURN_LABELS_DAILY,
    "gold_user_features_daily": GOLD_USER_FEATURES_DAILY,
    "gold_churn_by_plan_daily": GOLD_CHURN_BY_PLAN_DAILY,
}


def conforms(df: DataFrame, schema: T.StructType) -> list[str]:
    """Differences in column names, order or types (empty = conforms)."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    return [] if got == want else [f"got {got}", f"want {want}"]
