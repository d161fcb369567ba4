"""Silver: validate, quarantine, deduplicate, lateness.

Valid and quarantined rows are two complementary filters of bronze.  Event
dedup keeps, per ``event_id``, the row with the latest ``received_ts``, then the
latest ``ingestion_ts``, then the smallest ``row_hash``.  It is written as a
``min_by`` aggregate, not a ranking window: the aggregate combines map-side, so
an id that repeats in a third of all rows is reduced in every task before the
shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.time import lateness_sec
from ledgerline.sources import sinks

# Reason codes and the accepted billing events.
EVENT_REASONS = [
    ("event_id", "missing_event_id"),
    ("event_ts", "missing_event_ts"),
    ("received_ts", "missing_received_ts"),
    ("event_type", "missing_event_type"),
]
UNKNOWN_INVALID = "unknown_invalid"
BILLING_EVENTS = ["start", "upgrade", "cancel"]

SILVER_EVENT_COLUMNS = ["event_id", "event_ts", "received_ts", "user_id", "device_id",
                        "session_id", "event_type", "props", "bronze_row_hash",
                        "source_file", "ingestion_ts", "is_late", "lateness_sec"]


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _event_invalid() -> Column:
    return (F.col("event_id").isNull() | F.col("event_ts").isNull()
            | F.col("received_ts").isNull() | F.col("event_type").isNull())


def events_quarantine(bronze: DataFrame) -> DataFrame:
    """Bronze event rows missing a key field, first failing reason wins, the
    whole record kept as JSON (nulls included)."""
    reason = None
    for col, code in EVENT_REASONS:
        reason = F.when(F.col(col).isNull(), F.lit(code)) if reason is None \
            else reason.when(F.col(col).isNull(), F.lit(code))
    reason = reason.otherwise(F.lit(UNKNOWN_INVALID))
    record = F.struct(
        F.col("event_id"), _iso(F.col("event_ts")).alias("event_ts"),
        _iso(F.col("received_ts")).alias("received_ts"), F.col("user_id"),
        F.col("device_id"), F.col("session_id"), F.col("event_type"),
        F.parse_json(F.col("props")).alias("props"), F.col("source_file"),
        _iso(F.col("ingestion_ts")).alias("ingestion_ts"), F.col("row_hash"))
    return bronze.where(_event_invalid()).select(
        F.col("row_hash").alias("bronze_row_hash"), "source_file", "ingestion_ts",
        reason.alias("reason_code"), F.lit(None).cast("string").alias("reason_detail"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("raw_record"))


def valid_events(bronze: DataFrame) -> DataFrame:
    """The complement of S1 (before dedup)."""
    return bronze.where(~_event_invalid())


def dedup_events(valid: DataFrame) -> DataFrame:
    """S2 core: one row per event_id (latest received, latest ingestion, then
    smallest row hash), as a partial-aggregating ``min_by``."""
    cols = [c for c in valid.columns if c != "event_id"]
    order = F.struct(-F.unix_micros(F.col("received_ts")),
                     -F.unix_micros(F.col("ingestion_ts")), F.col("row_hash"))
    winner = F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_w")
    return valid.groupBy("event_id").agg(winner).select("event_id", "_w.*")


def silver_events(bronze: DataFrame) -> DataFrame:
    """S2 + S3: valid, deduplicated events with lateness.

    ``lateness_sec`` = arrival minus event time in whole seconds (half away from
    zero), clamped at 0; ``is_late`` = ``lateness_sec > 0``.
    """
    kept = dedup_events(valid_events(bronze))
    late = lateness_sec(F.col("received_ts"), F.col("event_ts"))
    return kept.select(
        "event_id", "event_ts", "received_ts", "user_id", "device_id", "session_id",
        "event_type", F.coalesce(F.col("props"), F.lit("{}")).alias("props"),
        F.col("row_hash").alias("bronze_row_hash"), "source_file", "ingestion_ts",
        (late > 0).alias("is_late"), late.alias("lateness_sec"))


def _billing_invalid() -> Column:
    # explicit null terms: `NULL NOT IN (...)` is null, which would leak rows
    return (F.col("billing_date").isNull() | F.col("user_id").isNull()
            | F.col("event").isNull() | ~F.col("event").isin(BILLING_EVENTS)
            | F.col("plan_id").isNull())


def billing_quarantine(bronze_billing: DataFrame) -> DataFrame:
    """Reasons in order missing date, user, event; invalid event; missing plan."""
    reason = (F.when(F.col("billing_date").isNull(), "missing_billing_date")
              .when(F.col("user_id").isNull(), "missing_user_id")
              .when(F.col("event").isNull(), "missing_event")
              .when(~F.col("event").isin(BILLING_EVENTS), "invalid_event")
              .when(F.col("plan_id").isNull(), "missing_plan_id")
              .otherwise(UNKNOWN_INVALID))
    record = F.struct(
        F.date_format(F.col("billing_date"), "yyyy-MM-dd").alias("billing_date"),
        "user_id", "event", "plan_id", "source_file",
        _iso(F.col("ingestion_ts")).alias("ingestion_ts"), "row_hash")
    return bronze_billing.where(_billing_invalid()).select(
        F.col("row_hash").alias("bronze_row_hash"), "source_file", "ingestion_ts",
        reason.alias("reason_code"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("raw_record"))


def silver_billing(bronze_billing: DataFrame) -> DataFrame:
    """The complement of S4; no dedup."""
    return bronze_billing.where(~_billing_invalid()).select(
        "billing_date", "user_id", "event", "plan_id",
        F.col("row_hash").alias("bronze_row_hash"), "source_file", "ingestion_ts")


class RefreshMismatch(RuntimeError):
    """Written rows do not add up to bronze."""


def check_counts(bronze: DataFrame, kept: int, quarantined: int, kind: str = "events") -> int:
    """Raise :class:`RefreshMismatch` unless kept, repeated and quarantined rows make up
    bronze; returns the repeated ones.  Bronze is counted by itself: its rows, the
    invalid ones and the distinct ids of the rest."""
    if kind == "events":
        invalid = _event_invalid()
        distinct = F.count_distinct(F.when(~invalid, F.col("event_id")))
    else:
        invalid = _billing_invalid()
        distinct = F.count_if(~invalid)
    row = bronze.agg(F.count(F.lit(1)).alias("n"), F.count_if(invalid).alias("invalid"),
                     distinct.alias("distinct")).first()
    if (kept, quarantined) != (row["distinct"], row["invalid"]):
        raise RefreshMismatch(
            f"{kind}: {row['n']} bronze rows hold {row['distinct']} to keep and {row['invalid']} to "
            f"quarantine, but {kept} and {quarantined} were written")
    return row["n"] - kept - quarantined


def refresh(spark, bronze: DataFrame, silver_path: str, quarantine_path: str,
            kind: str = "events", tables: tuple[str, str] | None = None) -> tuple[int, int]:
    """Full refresh of a silver table and its quarantine; returns their row counts.

    Both are written to fresh folders beside the old ones and counted against bronze
    (:func:`check_counts`).  Only then do they take the old ones' place, quarantine
    first: a failing check or write leaves both old tables as they were.  The switch is a
    rename of folders; with ``tables`` (the catalog names of silver and quarantine) the
    folders stay where they are written and the catalog tables are pointed at them, which
    suits stores without a rename."""
    if kind == "events":
        q, s = events_quarantine(bronze), silver_events(bronze)
    else:
        q, s = billing_quarantine(bronze), silver_billing(bronze)
    new_q, new_s = sinks.fresh_folder(quarantine_path), sinks.fresh_folder(silver_path)
    try:
        q.write.parquet(new_q)
        s.write.parquet(new_s)
        kept, quarantined = spark.read.parquet(new_s).count(), spark.read.parquet(new_q).count()
        check_counts(bronze, kept, quarantined, kind)
    except Exception:
        sinks.remove_folder(spark, new_q)
        sinks.remove_folder(spark, new_s)
        raise
    if tables:
        sinks.switch_location(spark, tables[1], new_q)
        sinks.switch_location(spark, tables[0], new_s)
    else:
        sinks.replace_folder(spark, new_q, quarantine_path)
        sinks.replace_folder(spark, new_s, silver_path)
    return kept, quarantined
