"""Pipeline-health and product-analytics queries.

All filtering, pivoting and metrics stay in Spark; the results are
result-sized (one row per day, or per day and plan).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.json import has_top_key, top_keys
from ledgerline.operators.marts import rounded_pct
from ledgerline.session import checkpoint_dir

# Fixed value: the drift key the dashboards watch.
DRIFT_KEY = "ui_variant"


def pipeline_health(bronze_events: DataFrame, silver_events: DataFrame,
                    key: str = DRIFT_KEY) -> DataFrame:
    """M1: one row - freshness, late rate, drift first day and rows."""
    latest = bronze_events.select(F.max("ingestion_ts")).scalar()
    with_key = has_top_key(F.col("props"), key)
    return silver_events.agg(
        (F.avg(F.col("is_late").cast("int")) * 100.0).alias("late_rate_pct"),
        F.sum(F.col("is_late").cast("int")).alias("late_events"),
        F.count(F.lit(1)).alias("total_events"),
        F.min(F.when(with_key, F.to_date("event_ts"))).alias("first_day_with_ui_variant"),
        F.count_if(with_key).alias("rows_with_ui_variant"),
    ).select(latest.alias("latest_ingestion_ts"), "*")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """M2: (table_name, rows) for the bronze / silver / quarantine tables."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).orderBy("table_name")


def date_bounds(*marts: DataFrame) -> DataFrame:
    """M4: min and max day over the given marts (the default filter range)."""
    days = reduce(lambda a, b: a.unionByName(b),
                  [m.agg(F.min("date_day").alias("lo"), F.max("date_day").alias("hi"))
                   for m in marts])
    return days.agg(F.min("lo").alias("min_day"), F.max("hi").alias("max_day"))


def feed_bounds(stg_events: DataFrame, stg_billing: DataFrame) -> DataFrame:
    """M4 without the marts: F1's days are the events' days, and F2's and F3's first and
    last days are those of billing, so neither is aggregated nor the grid expanded."""
    return date_bounds(stg_events.select(F.to_date("event_ts").alias("date_day")),
                       stg_billing.select(F.col("billing_date").alias("date_day")))


def _range(df: DataFrame, start: Column, end: Column) -> DataFrame:
    return df.where(F.col("date_day").between(start, end))


def bounds_literal(bounds: DataFrame) -> tuple[Column, Column]:
    """First and last day evaluated once (one row), as literals that prune partitions."""
    row = bounds.first()
    return F.lit(row["min_day"]).cast("date"), F.lit(row["max_day"]).cast("date")


def events_daily_range(events_daily: DataFrame, start: Column, end: Column) -> DataFrame:
    """M3: F1 within [start, end] plus late_rate_pct (0 when no events)."""
    late = F.coalesce(F.col("late_events") / F.when(F.col("events") != 0, F.col("events")),
                      F.lit(0.0)) * 100.0
    return _range(events_daily, start, end).select(
        "date_day", "events", "dau", "late_events", late.alias("late_rate_pct")).orderBy("date_day")


def product_kpis(events_range: DataFrame) -> DataFrame:
    """M5: days, total events, mean DAU (rounded half-even to an integer) and
    mean of the daily late rates (2 places, half-even)."""
    return events_range.agg(
        F.count_distinct("date_day").alias("days"),
        F.sum("events").cast("long").alias("total_events"),
        F.bround(F.avg("dau"), 0).cast("long").alias("avg_dau"),
        F.bround(F.avg("late_rate_pct"), 2).alias("avg_late_rate_pct"))


def billing_daily_range(billing_daily: DataFrame, start: Column, end: Column) -> DataFrame:
    """M6: F2 within [start, end]."""
    return _range(billing_daily, start, end).select("date_day", "plan_id", "starts",
                                                    "new_paid_users").orderBy("date_day", "plan_id")


def pivot_sum(df: DataFrame, value: str, category: str = "plan_id",
              values: list[str] | None = None) -> DataFrame:
    """M7 / M8: day x category pivot of ``value`` summed, missing cells 0."""
    cells = df.groupBy("date_day", category).agg(F.sum(value).alias("cell"))
    wide = _wide(cells, category, values)
    cats = [c for c in wide.columns if c != "date_day"]
    return wide.na.fill(0, subset=cats)


def pivot_unique(df: DataFrame, value: str, category: str = "plan_id",
                 values: list[str] | None = None) -> DataFrame:
    """Day x category pivot without aggregation; a repeated cell is
    an error raised inside the job, a missing cell stays null."""
    cell = F.when(F.count(F.lit(1)) > 1,
                  F.raise_error(F.lit(f"duplicate (date_day, {category}) cell"))) \
        .otherwise(F.first(value))
    return _wide(df.groupBy("date_day", category).agg(cell.alias("cell")), category, values)


def _wide(cells: DataFrame, category: str, values: list[str] | None) -> DataFrame:
    """One row a day, one column a category, from one ``cell`` for each pair of them.
    Without ``values`` the cells are checkpointed, so that finding the categories and
    filling the columns does not run the chain below twice."""
    if values is None:
        checkpoint_dir(cells.sparkSession)
        cells = cells.checkpoint(eager=True)
    # a cell is alone in its day and category
    return cells.groupBy("date_day").pivot(category, values).agg(F.first("cell"))


def active_subs_rows(subs: DataFrame, start: Column, end: Column) -> DataFrame:
    """M9: the (day, is_active) rows of F3 within range, one per user and day."""
    return _range(subs, start, end).select("date_day", "is_active")


def active_subs_daily(subs: DataFrame, start: Column, end: Column) -> DataFrame:
    """M9: per day within range, users and active users."""
    return _range(subs, start, end).groupBy("date_day").agg(
        F.count(F.lit(1)).alias("users"), F.count_if("is_active").alias("active_users")).orderBy("date_day")


def churn_rate_daily(features: DataFrame) -> DataFrame:
    """Per day rows, churners and churn % to 2 places."""
    return (features.groupBy("date_day")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("churn_7d").alias("c"))
            .select("date_day", F.col("n").alias("rows"),
                    F.col("c").cast("long").alias("churners"),
                    rounded_pct(F.col("c"), F.col("n"), 2).alias("churn_rate_pct")).orderBy("date_day"))


def churn_rate_overall(features: DataFrame) -> DataFrame:
    """Per day rows, churners and the unrounded churn ratio."""
    return features.groupBy("date_day").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("churn_7d").cast("long").alias("churners"),
        F.avg("churn_7d").cast("double").alias("churn_rate"))


def drift_key_share_daily(silver_events: DataFrame, key: str = DRIFT_KEY) -> DataFrame:
    """Per day the % of events whose props hold top-level ``key``."""
    flag = F.when(has_top_key(F.col("props"), key), 1).otherwise(0)
    return silver_events.groupBy(F.to_date("event_ts").alias("date_day")) \
        .agg((F.avg(flag) * 100.0).alias("pct_ui_variant"))


def late_rate_daily(silver_events: DataFrame) -> DataFrame:
    """Per day late %, late events and events."""
    late = F.col("is_late").cast("int")
    return silver_events.groupBy(F.to_date("event_ts").alias("date_day")).agg(
        (F.avg(late) * 100.0).alias("late_rate_pct"),
        F.sum(late).alias("late_events"),
        F.count(F.lit(1)).alias("events"))


def drift_keys_daily(silver_events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """For every top-level props key (or the given ``keys``), per day the
    rows holding it, their % of the day's events, and the key's first day."""
    ev = silver_events.select(F.to_date("event_ts").alias("date_day"),
                              top_keys(F.col("props")).alias("keys"))
    per_day = ev.groupBy("date_day").agg(F.count(F.lit(1)).alias("day_events"))
    exploded = ev.select("date_day", F.explode(F.array_distinct("keys")).alias("key"))
    if keys is not None:
        exploded = exploded.where(F.col("key").isin(keys))
    per_key = exploded.groupBy("date_day", "key").agg(F.count(F.lit(1)).alias("rows_with_key"))
    # both sides are one row per day (x key): a small join
    out = per_key.join(per_day, "date_day")
    return out.select(
        "date_day", "key", "rows_with_key",
        (F.col("rows_with_key") / F.col("day_events") * 100.0).alias("pct_with_key"),
        F.min("date_day").over(Window.partitionBy("key")).alias("first_day_with_key"))
