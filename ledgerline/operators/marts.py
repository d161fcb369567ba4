"""Facts and gold marts.

Shapes chosen for scale:

* F3 (dense subscription timeline) never joins a day spine with users.  Billing
  is reduced to one row per (user, day) with a map-side partial aggregate, the
  running state is computed over those sparse change rows in a per-user window,
  and each change row is expanded to the days until the next change with
  ``explode(sequence(...))``.  The dense output is produced where it is used.
* F4 is a forward range frame (days d+1..d+7) over F3's rows; F3 is already
  partitioned by user, so no extra shuffle.
* F5 pre-aggregates events to (user, day, session), expands each such row to
  the 7 (or 14, when it holds support tickets) days it counts for, and sums per
  (user, day).  Exact distinct sessions included; no days x events join.
* Global bounds (first/last billing day) are scalar subqueries, or literals
  the caller evaluates once (``billing_bounds_literal``), never joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.time import day_number

# Fixed values of the marts.
LABEL_HORIZON_DAYS = 7
TRAILING_DAYS = 7
SUPPORT_TRAILING_DAYS = 14
FEATURE_USE = "feature_use"
SUPPORT_TICKET = "support_ticket"
DEFAULT_PLAN = "free"          # null or 'unknown' plan in gold
START_EVENTS = ["start", "upgrade"]


def fct_events_daily(stg_events: DataFrame) -> DataFrame:
    """F1 (day): events, DAU (distinct non-null users), late events."""
    return (stg_events
            .groupBy(F.to_date("event_ts").alias("date_day"))
            .agg(F.count(F.lit(1)).alias("events"),
                 F.count_distinct("user_id").alias("dau"),
                 F.count_if("is_late").alias("late_events")))


def fct_billing_daily(stg_billing: DataFrame) -> DataFrame:
    """F2 (day, plan): starts and distinct users starting.  The filter sits
    inside the aggregates, so a day x plan with only cancels/upgrades keeps a
    row with zeros."""
    is_start = F.col("billing_event") == "start"
    return (stg_billing
            .groupBy(F.col("billing_date").alias("date_day"), "plan_id")
            .agg(F.count_if(is_start).alias("starts"),
                 F.count_distinct(F.when(is_start, F.col("user_id"))).alias("new_paid_users")))


def billing_bounds(stg_billing: DataFrame):
    """(first, last) billing day as scalar-subquery columns."""
    lo = stg_billing.select(F.min("billing_date")).scalar()
    hi = stg_billing.select(F.max("billing_date")).scalar()
    return lo, hi


def billing_bounds_literal(stg_billing: DataFrame):
    """(first, last) billing day evaluated once (one small aggregate job) and
    returned as literals: later plans skip the subquery jobs, and filters on
    day columns can prune date partitions statically."""
    row = stg_billing.agg(F.min("billing_date"), F.max("billing_date")).first()
    return F.lit(row[0]).cast("date"), F.lit(row[1]).cast("date")


def subscription_changes(stg_billing: DataFrame, bounds=None) -> DataFrame:
    """Per (user, day) reduction of billing: last start/upgrade plan of the day
    (upgrade beats start, then the higher plan id), whether a start/upgrade and
    whether a cancel happened.  Every user also gets a row on the first billing
    day, so each user's timeline starts at the spine start."""
    lo, _ = bounds if bounds is not None else billing_bounds(stg_billing)
    ev = F.col("billing_event")
    is_su = ev.isin(START_EVENTS)
    fact = F.struct(F.col("billing_date").alias("day"),
                    F.when(is_su, F.struct((ev == "upgrade").cast("int").alias("u"),
                                           F.col("plan_id").alias("p"))).alias("su"),
                    (ev == "cancel").alias("cancel"))
    origin = F.struct(lo.alias("day"),
                      F.lit(None).cast("struct<u:int,p:string>").alias("su"),
                      F.lit(False).alias("cancel"))
    rows = stg_billing.select("user_id", F.explode(F.array(fact, origin)).alias("r"))
    return (rows.groupBy("user_id", F.col("r.day").alias("day"))
            .agg(F.max("r.su").alias("su"), F.max("r.cancel").alias("cancel")))


def fct_subscriptions_daily(stg_billing: DataFrame, bounds=None) -> DataFrame:
    """F3 (day, user) over the spine first..last billing day x every billed user.

    Active iff the user has a start/upgrade on or before the day and no cancel
    on or after the latest one (a same-day cancel wins); plan is the latest
    start/upgrade's plan when active, else null.  ``bounds`` = (first, last)
    billing day columns (default: scalar subqueries).
    """
    bounds = bounds if bounds is not None else billing_bounds(stg_billing)
    _, hi = bounds
    ch = subscription_changes(stg_billing, bounds)
    by_user = Window.partitionBy("user_id").orderBy("day")
    running = by_user.rowsBetween(Window.unboundedPreceding, 0)
    su_day = F.when(F.col("su").isNotNull(), F.col("day"))
    cancel_day = F.when(F.col("cancel"), F.col("day"))
    state = ch.select(
        "user_id", "day",
        F.max(su_day).over(running).alias("last_su"),
        F.last(F.col("su.p"), ignorenulls=True).over(running).alias("last_plan"),
        F.max(cancel_day).over(running).alias("last_cancel"),
        F.lead("day").over(by_user).alias("next_day"))
    active = (F.col("last_su").isNotNull()
              & ~(F.col("last_cancel").isNotNull() & (F.col("last_cancel") >= F.col("last_su"))))
    until = F.coalesce(F.date_sub(F.col("next_day"), 1), hi)
    return state.select(
        F.explode(F.sequence(F.col("day"), until)).alias("date_day"),
        "user_id",
        active.alias("is_active"),
        F.when(active, F.col("last_plan")).alias("plan_id"))


def with_churn_label(subs: DataFrame, horizon: int = LABEL_HORIZON_DAYS) -> DataFrame:
    """F4 as a column: ``churn_7d = 1`` iff active today and active on none of
    the next ``horizon`` days (days beyond the spine count as inactive)."""
    ahead = (Window.partitionBy("user_id").orderBy(day_number(F.col("date_day")))
             .rangeBetween(1, horizon))
    future = F.max(F.col("is_active").cast("int")).over(ahead)
    churn = F.when(F.col("is_active") & (F.coalesce(future, F.lit(0)) == 0), 1).otherwise(0)
    return subs.withColumn("churn_7d", churn.cast("int"))


def gold_churn_labels_daily(subs: DataFrame, horizon: int = LABEL_HORIZON_DAYS) -> DataFrame:
    """F4 (day, user): churn label."""
    return with_churn_label(subs, horizon).select("date_day", "user_id", "churn_7d")


def trailing_activity(stg_events: DataFrame) -> DataFrame:
    """Trailing per (user, day) counts from events with a user: events, distinct
    sessions, feature_use and late events over days d-6..d; support tickets over
    d-13..d.  Only days with activity in the window appear."""
    e = stg_events.where(F.col("user_id").isNotNull()).select(
        "user_id", F.to_date("event_ts").alias("event_day"), "session_id",
        "event_type", "is_late")
    per_session = (e.groupBy("user_id", "event_day", "session_id")
                   .agg(F.count(F.lit(1)).alias("n"),
                        F.count_if(F.col("event_type") == FEATURE_USE).alias("feat"),
                        F.count_if(F.col("event_type") == SUPPORT_TICKET).alias("sup"),
                        F.count_if("is_late").alias("late")))
    span = F.when(F.col("sup") > 0, SUPPORT_TRAILING_DAYS - 1).otherwise(TRAILING_DAYS - 1)
    spread = per_session.select(
        "user_id", "event_day", "session_id", "n", "feat", "sup", "late",
        F.explode(F.sequence(F.lit(0), span)).alias("k"))
    recent = F.col("k") < TRAILING_DAYS
    return (spread
            .groupBy("user_id", F.date_add(F.col("event_day"), F.col("k")).alias("date_day"))
            .agg(F.sum(F.when(recent, F.col("n"))).alias("events_7d"),
                 F.count_distinct(F.when(recent, F.col("session_id"))).alias("sessions_7d"),
                 F.sum(F.when(recent, F.col("feat"))).alias("feature_use_7d"),
                 F.sum("sup").alias("support_tickets_14d"),
                 F.sum(F.when(recent, F.col("late"))).alias("late_7d")))


def gold_user_features_daily(subs: DataFrame, stg_events: DataFrame,
                             horizon: int = LABEL_HORIZON_DAYS,
                             last_day=None) -> DataFrame:
    """F5 (day, user) over F3's grid, last ``horizon`` days removed.

    Trailing counts (0 when none), late share of the 7-day events (0.0 when no
    events), active flag, plan (null or 'unknown' -> 'free') and the label.
    ``last_day`` is F3's last day; pass the last billing day (the spine end,
    equal by construction) to avoid a separate pass over F3 for it.
    """
    hi = last_day if last_day is not None else subs.select(F.max("date_day")).scalar()
    grid = with_churn_label(subs, horizon).where(F.col("date_day") <= F.date_sub(hi, horizon))
    t = trailing_activity(stg_events)
    j = grid.join(t, ["user_id", "date_day"], "left")
    ev7 = F.coalesce(F.col("events_7d"), F.lit(0)).cast("long")
    late7 = F.coalesce(F.col("late_7d"), F.lit(0)).cast("long")
    plan = F.when(F.col("plan_id").isNull() | (F.col("plan_id") == "unknown"),
                  F.lit(DEFAULT_PLAN)).otherwise(F.col("plan_id"))
    return j.select(
        "date_day", "user_id", "is_active", plan.alias("plan_id"),
        ev7.alias("events_7d"),
        F.coalesce(F.col("sessions_7d"), F.lit(0)).cast("long").alias("sessions_7d"),
        F.coalesce(F.col("feature_use_7d"), F.lit(0)).cast("long").alias("feature_use_7d"),
        F.coalesce(F.col("support_tickets_14d"), F.lit(0)).cast("long").alias("support_tickets_14d"),
        F.when(ev7 == 0, F.lit(0.0)).otherwise(late7.cast("double") / ev7.cast("double"))
        .alias("late_rate_7d"),
        "churn_7d")


def rounded_pct(num, den, places: int):
    """100 * num / den as an exact decimal rounded half away from zero, as double."""
    q = F.lit(100).cast("decimal(38,0)") * num.cast("decimal(38,0)") / den.cast("decimal(38,0)")
    return F.round(q, places).cast("double")


def gold_churn_by_plan_daily(features: DataFrame) -> DataFrame:
    """F6 (day, plan): users, churners, churn % rounded to 3 places."""
    return (features.where(F.col("plan_id").isNotNull())
            .groupBy("date_day", "plan_id")
            .agg(F.count(F.lit(1)).alias("users"),
                 F.sum("churn_7d").cast("long").alias("churners"))
            .select("date_day", "plan_id", "users", "churners",
                    rounded_pct(F.col("churners"), F.col("users"), 3).alias("churn_rate_pct")))
