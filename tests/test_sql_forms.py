"""Property: direct SQL definitions of the marts, run by Spark SQL, equal the
library's DataFrame rewrites on the driver tables.

The SQL forms are the naive ones: an as-of aggregation over a band join of
every (day, user) with all earlier billing rows; a NOT EXISTS look-ahead for
the label; a 14-day band join of the grid with the events for the features.
"""

import pytest

from conftest import SF_SMALL

from ledgerline.plans.lake import Lake

SQL_SUBS = """
WITH bounds AS (SELECT min(billing_date) AS lo, max(billing_date) AS hi FROM stg_billing),
days AS (SELECT explode(sequence(lo, hi)) AS date_day FROM bounds),
grid AS (
  SELECT d.date_day, u.user_id
  FROM days d CROSS JOIN (SELECT DISTINCT user_id FROM stg_billing) u
),
asof AS (
  SELECT g.date_day, g.user_id,
    max(CASE WHEN e.billing_event IN ('start', 'upgrade') THEN e.billing_date END) AS su_day,
    max(CASE WHEN e.billing_event = 'cancel' THEN e.billing_date END) AS cancel_day,
    max_by(e.plan_id, CASE WHEN e.billing_event IN ('start', 'upgrade')
           THEN struct(e.billing_date, e.billing_event = 'upgrade', e.plan_id) END) AS su_plan
  FROM grid g LEFT JOIN stg_billing e ON e.user_id = g.user_id AND e.billing_date <= g.date_day
  GROUP BY g.date_day, g.user_id
)
SELECT date_day, user_id,
  su_day IS NOT NULL AND (cancel_day IS NULL OR cancel_day < su_day) AS is_active,
  CASE WHEN su_day IS NOT NULL AND (cancel_day IS NULL OR cancel_day < su_day) THEN su_plan END AS plan_id
FROM asof
"""

SQL_LABELS = """
SELECT b.date_day, b.user_id,
  CASE WHEN b.is_active AND NOT EXISTS (
      SELECT 1 FROM subs f WHERE f.user_id = b.user_id AND f.is_active
        AND f.date_day > b.date_day AND f.date_day <= date_add(b.date_day, 7))
    THEN 1 ELSE 0 END AS churn_7d
FROM subs b
"""

SQL_FEATURES = """
WITH ev AS (SELECT to_date(event_ts) AS event_day, user_id, session_id, event_type, is_late
            FROM stg_events WHERE user_id IS NOT NULL),
grid AS (
  SELECT s.date_day, s.user_id, s.is_active, s.plan_id, l.churn_7d
  FROM subs s JOIN labels l USING (date_day, user_id)
  WHERE s.date_day <= date_sub((SELECT max(date_day) FROM subs), 7)
),
band AS (
  SELECT g.date_day, g.user_id,
    sum(CASE WHEN e.event_day > date_sub(g.date_day, 7) THEN 1 ELSE 0 END) AS n7,
    count(DISTINCT CASE WHEN e.event_day > date_sub(g.date_day, 7) THEN e.session_id END) AS s7,
    sum(CASE WHEN e.event_day > date_sub(g.date_day, 7) AND e.event_type = 'feature_use' THEN 1 ELSE 0 END) AS f7,
    sum(CASE WHEN e.event_type = 'support_ticket' THEN 1 ELSE 0 END) AS t14,
    sum(CASE WHEN e.event_day > date_sub(g.date_day, 7) AND e.is_late THEN 1 ELSE 0 END) AS l7
  FROM grid g LEFT JOIN ev e ON e.user_id = g.user_id
    AND e.event_day BETWEEN date_sub(g.date_day, 13) AND g.date_day
  GROUP BY g.date_day, g.user_id
)
SELECT g.date_day, g.user_id, g.is_active,
  CASE WHEN g.plan_id IS NULL OR g.plan_id = 'unknown' THEN 'free' ELSE g.plan_id END AS plan_id,
  CAST(coalesce(b.n7, 0) AS BIGINT) AS events_7d, CAST(coalesce(b.s7, 0) AS BIGINT) AS sessions_7d,
  CAST(coalesce(b.f7, 0) AS BIGINT) AS feature_use_7d,
  CAST(coalesce(b.t14, 0) AS BIGINT) AS support_tickets_14d,
  CASE WHEN coalesce(b.n7, 0) = 0 THEN 0.0D ELSE CAST(b.l7 AS DOUBLE) / CAST(b.n7 AS DOUBLE) END AS late_rate_7d,
  g.churn_7d
FROM grid g JOIN band b USING (date_day, user_id)
"""


@pytest.fixture(scope="module")
def lake(spark):
    lk = Lake(spark, SF_SMALL)
    lk.stg_billing.createOrReplaceTempView("stg_billing")
    lk.stg_events.createOrReplaceTempView("stg_events")
    # materialise the shared inputs once (the SQL forms read them many times)
    lk.materialize("fct_subscriptions_daily").createOrReplaceTempView("subs")
    lk.gold_churn_labels_daily.createOrReplaceTempView("labels")
    return lk


def same(a, b):
    # compare materialised results (keeps the comparison plans small)
    a, b = a.checkpoint(), b.checkpoint()
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_subscriptions_sql_equals_rewrite(spark, lake):
    from ledgerline.operators import marts as M
    same(spark.sql(SQL_SUBS), M.fct_subscriptions_daily(lake.stg_billing))


def test_labels_sql_equals_rewrite(spark, lake):
    same(spark.sql(SQL_LABELS), lake.gold_churn_labels_daily)


def test_features_sql_equals_rewrite(spark, lake):
    cols = ["date_day", "user_id", "is_active", "plan_id", "events_7d", "sessions_7d",
            "feature_use_7d", "support_tickets_14d", "late_rate_7d", "churn_7d"]
    same(spark.sql(SQL_FEATURES).select(*cols), lake.gold_user_features_daily.select(*cols))


def test_counts_conserved(spark, lake):
    bronze = lake.bronze_events
    valid = bronze.where("event_id is not null and event_ts is not null and "
                         "received_ts is not null and event_type is not null")
    assert bronze.count() - lake.events_quarantine.count() == valid.count()
    assert lake.silver_events.count() == valid.select("event_id").distinct().count()
    assert lake.silver_billing.count() + lake.billing_quarantine.count() == lake.bronze_billing.count()
    assert lake.fct_events_daily.agg({"events": "sum"}).first()[0] == lake.silver_events.count()
