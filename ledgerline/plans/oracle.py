"""DuckDB twins of the registered queries (the correctness oracle).

Every oracle query starts with the same CTE chain: the stand-in raw input built
from the driver's ``events`` / ``orders`` views (same mapping as
``sources.adapter``), then bronze, silver, staging and the marts written as
direct definitions, independent of the Spark algorithms: the subscription
state as an as-of aggregation over a band join of every (day, user) with all
earlier billing rows, the label as a NOT EXISTS look-ahead, the features as a
14-day band join of the grid with the events.  DuckDB drops the CTEs a query
does not use.
"""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"

ADAPTER = r"""
ev_base AS (
  SELECT event_id AS n, CAST(ts AS TIMESTAMP) AS ts, user_id AS u, event_type AS et, props AS p
  FROM events
),
ev_rec AS (
  SELECT n, ts,
    'evt_' || CAST(n AS VARCHAR) AS event_id,
    CASE WHEN n % 83 = 0 THEN NULL
         WHEN n % 20 = 0 THEN ts + to_microseconds(CAST((10 + n % 350) * 60000000 AS BIGINT))
         WHEN n % 211 = 0 THEN ts - INTERVAL 5 SECOND
         WHEN n % 37 = 0 THEN ts + INTERVAL 600 MILLISECOND
         WHEN n % 41 = 0 THEN ts + INTERVAL 400 MILLISECOND
         ELSE ts END AS received_ts,
    CASE WHEN n % 89 = 0 THEN NULL ELSE 'usr_' || lpad(CAST(u AS VARCHAR), 5, '0') END AS user_id,
    'dev_' || CAST(u % 7 AS VARCHAR) AS device_id,
    'sess_' || CAST(u AS VARCHAR) || '_' || CAST(n % 7 AS VARCHAR) AS session_id,
    CASE WHEN n % 97 = 0 THEN NULL
         WHEN et = 'view' THEN 'page_view' WHEN et = 'click' THEN 'feature_use'
         WHEN et = 'error' THEN 'support_ticket' ELSE et END AS event_type,
    CASE WHEN ts >= TIMESTAMP '2024-01-16'
         THEN regexp_replace(p, '\}$', ', "ui_variant": "' || CASE WHEN n % 2 = 0 THEN 'A' ELSE 'B' END || '"}')
         ELSE p END AS props_raw,
    n % 61 = 0 AS props_absent,
    'events/' || strftime(ts, '%Y-%m-%d') AS day_file
  FROM ev_base
),
ev_copy AS (
  SELECT r.*, unnest([0]
      || CASE WHEN n % 101 = 0 THEN [1] ELSE [] END
      || CASE WHEN n % 50 = 0 THEN [2] ELSE [] END) AS copy_no
  FROM ev_rec r
),
ev_line AS (
  SELECT day_file || CASE WHEN copy_no = 2 THEN '_redelivery.jsonl' ELSE '.jsonl' END AS source_file,
    c.*, CASE WHEN copy_no = 2 THEN received_ts + INTERVAL 1 HOUR ELSE received_ts END AS recv
  FROM ev_copy c
),
ev_text AS (
  SELECT *,
    '{"event_id": ' || coalesce('"' || event_id || '"', 'null')
    || ', "event_ts": ' || coalesce('"' || strftime(ts, {iso}) || '"', 'null')
    || ', "received_ts": ' || coalesce('"' || strftime(recv, {iso}) || '"', 'null')
    || ', "user_id": ' || coalesce('"' || user_id || '"', 'null')
    || ', "device_id": ' || coalesce('"' || device_id || '"', 'null')
    || ', "session_id": ' || coalesce('"' || session_id || '"', 'null')
    || ', "event_type": ' || coalesce('"' || event_type || '"', 'null')
    || CASE WHEN props_absent THEN '' ELSE ', "props": ' || props_raw END || '}' AS raw_value,
    CASE WHEN props_absent THEN NULL ELSE CAST(json(props_raw) AS VARCHAR) END AS props_canon
  FROM ev_line
),
ev_parsed AS (
  SELECT source_file, event_id, ts AS event_ts, recv AS received_ts, user_id, device_id,
    session_id, event_type, coalesce(props_canon, '{{}}') AS props,
    TIMESTAMP '2024-02-01 00:00:00' AS ingestion_ts,
    sha256(source_file || '|' || '{{"device_id":' || coalesce('"' || device_id || '"', 'null')
      || ',"event_id":' || coalesce('"' || event_id || '"', 'null')
      || ',"event_ts":' || coalesce('"' || strftime(ts, {iso}) || '"', 'null')
      || ',"event_type":' || coalesce('"' || event_type || '"', 'null')
      || CASE WHEN props_canon IS NULL THEN '' ELSE ',"props":' || props_canon END
      || ',"received_ts":' || coalesce('"' || strftime(recv, {iso}) || '"', 'null')
      || ',"session_id":' || coalesce('"' || session_id || '"', 'null')
      || ',"user_id":' || coalesce('"' || user_id || '"', 'null') || '}}') AS row_hash,
    raw_value
  FROM ev_text
),
bl_base AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderpriority AS pr,
    strftime(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 60 AS INTEGER), '%Y-%m-%d') AS day
  FROM orders
),
bl_row AS (
  SELECT k, 'billing/' || day || '.csv' AS source_file,
    CASE WHEN k % 53 = 0 THEN ' ' || day || ' ' ELSE day END AS billing_date_raw,
    'usr_' || lpad(CAST(c AS VARCHAR), 5, '0') AS user_id,
    CASE WHEN k % 101 = 0 THEN 'refund' WHEN st = 'O' THEN 'start' WHEN st = 'P' THEN 'upgrade'
         WHEN st = 'F' THEN 'cancel' END AS event,
    CASE pr WHEN '1-URGENT' THEN 'team' WHEN '2-HIGH' THEN 'pro' WHEN '3-MEDIUM' THEN 'basic'
            WHEN '5-LOW' THEN 'free' END AS plan_id
  FROM bl_base
),
bl_lines AS (
  SELECT r.*, unnest(CASE WHEN k % 103 = 0 THEN [1, 2] ELSE [1] END) AS copy_no FROM bl_row r
),
bl_parsed AS (
  SELECT CAST(trim(billing_date_raw) AS DATE) AS billing_date, user_id, event, plan_id, source_file,
    TIMESTAMP '2024-02-01 00:00:00' AS ingestion_ts,
    sha256(source_file || '|billing_date=' || trim(coalesce(billing_date_raw, ''))
      || '|user_id=' || trim(coalesce(user_id, '')) || '|event=' || trim(coalesce(event, ''))
      || '|plan_id=' || trim(coalesce(plan_id, ''))) AS row_hash,
    billing_date_raw
  FROM bl_lines
)""".replace("{iso}", ISO).replace("{{", "{").replace("}}", "}")

LAYERS = r"""
bronze_events AS (
  SELECT DISTINCT event_id, event_ts, received_ts, user_id, device_id, session_id, event_type,
    props, source_file, ingestion_ts, row_hash
  FROM ev_parsed
),
bronze_billing AS (
  SELECT DISTINCT billing_date, user_id, event, plan_id, source_file, ingestion_ts, row_hash
  FROM bl_parsed
),
ev_flagged AS (
  SELECT *, coalesce(
      CASE WHEN event_id IS NULL THEN 'missing_event_id' END,
      CASE WHEN event_ts IS NULL THEN 'missing_event_ts' END,
      CASE WHEN received_ts IS NULL THEN 'missing_received_ts' END,
      CASE WHEN event_type IS NULL THEN 'missing_event_type' END) AS failed
  FROM bronze_events
),
silver_events_quarantine AS (
  SELECT row_hash AS bronze_row_hash, source_file, ingestion_ts, failed AS reason_code,
    CAST(NULL AS VARCHAR) AS reason_detail,
    CAST(json_object('event_id', event_id,
      'event_ts', strftime(event_ts, {iso}), 'received_ts', strftime(received_ts, {iso}),
      'user_id', user_id, 'device_id', device_id, 'session_id', session_id,
      'event_type', event_type, 'props', json(props), 'source_file', source_file,
      'ingestion_ts', strftime(ingestion_ts, {iso}), 'row_hash', row_hash) AS VARCHAR) AS raw_record
  FROM ev_flagged WHERE failed IS NOT NULL
),
ev_latest AS (
  SELECT DISTINCT ON (event_id) *
  FROM ev_flagged WHERE failed IS NULL
  ORDER BY event_id, received_ts DESC, ingestion_ts DESC, row_hash
),
silver_events AS (
  SELECT event_id, event_ts, received_ts, user_id, device_id, session_id, event_type,
    coalesce(props, '{}') AS props, row_hash AS bronze_row_hash, source_file, ingestion_ts,
    secs > 0 AS is_late, secs AS lateness_sec
  FROM (SELECT *, greatest(CAST(round((epoch_us(received_ts) - epoch_us(event_ts)) / 1e6) AS INTEGER), 0) AS secs
        FROM ev_latest)
),
bl_flagged AS (
  SELECT *, coalesce(
      CASE WHEN billing_date IS NULL THEN 'missing_billing_date' END,
      CASE WHEN user_id IS NULL THEN 'missing_user_id' END,
      CASE WHEN event IS NULL THEN 'missing_event' END,
      CASE WHEN event NOT IN ('start', 'upgrade', 'cancel') THEN 'invalid_event' END,
      CASE WHEN plan_id IS NULL THEN 'missing_plan_id' END) AS failed
  FROM bronze_billing
),
silver_billing_quarantine AS (
  SELECT row_hash AS bronze_row_hash, source_file, ingestion_ts, failed AS reason_code,
    CAST(json_object('billing_date', strftime(billing_date, '%Y-%m-%d'), 'user_id', user_id,
      'event', event, 'plan_id', plan_id, 'source_file', source_file,
      'ingestion_ts', strftime(ingestion_ts, {iso}), 'row_hash', row_hash) AS VARCHAR) AS raw_record
  FROM bl_flagged WHERE failed IS NOT NULL
),
silver_billing AS (
  SELECT billing_date, user_id, event, plan_id, row_hash AS bronze_row_hash, source_file, ingestion_ts
  FROM bl_flagged WHERE failed IS NULL
),
stg_events AS (
  SELECT event_id, event_ts, received_ts, user_id, device_id, session_id, event_type, props,
    is_late, lateness_sec, source_file, ingestion_ts
  FROM silver_events
),
stg_billing AS (
  SELECT billing_date, user_id, event AS billing_event, plan_id, source_file, ingestion_ts
  FROM silver_billing
),
fct_events_daily AS (
  SELECT CAST(event_ts AS DATE) AS date_day, count(*) AS events, count(DISTINCT user_id) AS dau,
    CAST(sum(CASE WHEN is_late THEN 1 ELSE 0 END) AS BIGINT) AS late_events
  FROM stg_events GROUP BY ALL
),
fct_billing_daily AS (
  SELECT billing_date AS date_day, plan_id,
    CAST(sum(CASE WHEN billing_event = 'start' THEN 1 ELSE 0 END) AS BIGINT) AS starts,
    count(DISTINCT CASE WHEN billing_event = 'start' THEN user_id END) AS new_paid_users
  FROM stg_billing GROUP BY ALL
),
sub_grid AS (
  SELECT CAST(t.d AS DATE) AS date_day, u.user_id
  FROM (SELECT min(billing_date) AS lo, max(billing_date) AS hi FROM stg_billing) b,
       generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) t(d),
       (SELECT DISTINCT user_id FROM stg_billing) u
),
sub_asof AS (
  SELECT g.date_day, g.user_id,
    max(e.billing_date) FILTER (WHERE e.billing_event IN ('start', 'upgrade')) AS su_day,
    max(e.billing_date) FILTER (WHERE e.billing_event = 'cancel') AS cancel_day,
    arg_max(e.plan_id, {'d': e.billing_date, 'u': e.billing_event = 'upgrade', 'p': e.plan_id})
      FILTER (WHERE e.billing_event IN ('start', 'upgrade')) AS su_plan
  FROM sub_grid g
  LEFT JOIN stg_billing e ON e.user_id = g.user_id AND e.billing_date <= g.date_day
  GROUP BY g.date_day, g.user_id
),
fct_subscriptions_daily AS (
  SELECT date_day, user_id,
    su_day IS NOT NULL AND (cancel_day IS NULL OR cancel_day < su_day) AS is_active,
    CASE WHEN su_day IS NOT NULL AND (cancel_day IS NULL OR cancel_day < su_day) THEN su_plan END AS plan_id
  FROM sub_asof
),
gold_churn_labels_daily AS (
  SELECT b.date_day, b.user_id,
    CASE WHEN b.is_active AND NOT EXISTS (
        SELECT 1 FROM fct_subscriptions_daily f
        WHERE f.user_id = b.user_id AND f.is_active
          AND f.date_day BETWEEN b.date_day + 1 AND b.date_day + 7)
      THEN 1 ELSE 0 END AS churn_7d
  FROM fct_subscriptions_daily b
),
feat_events AS (
  SELECT CAST(event_ts AS DATE) AS event_day, user_id, session_id, event_type, is_late
  FROM stg_events WHERE user_id IS NOT NULL
),
feat_grid AS (
  SELECT s.date_day, s.user_id, s.is_active, s.plan_id, l.churn_7d
  FROM fct_subscriptions_daily s
  JOIN gold_churn_labels_daily l USING (date_day, user_id)
  WHERE s.date_day <= (SELECT max(date_day) FROM fct_subscriptions_daily) - 7
),
feat_band AS (
  SELECT g.date_day, g.user_id,
    sum(CASE WHEN e.event_day > g.date_day - 7 THEN 1 ELSE 0 END) AS n7,
    count(DISTINCT CASE WHEN e.event_day > g.date_day - 7 THEN e.session_id END) AS s7,
    sum(CASE WHEN e.event_day > g.date_day - 7 AND e.event_type = 'feature_use' THEN 1 ELSE 0 END) AS f7,
    sum(CASE WHEN e.event_type = 'support_ticket' THEN 1 ELSE 0 END) AS t14,
    sum(CASE WHEN e.event_day > g.date_day - 7 AND e.is_late THEN 1 ELSE 0 END) AS l7
  FROM feat_grid g
  LEFT JOIN feat_events e ON e.user_id = g.user_id
    AND e.event_day BETWEEN g.date_day - 13 AND g.date_day
  GROUP BY g.date_day, g.user_id
),
gold_user_features_daily AS (
  SELECT g.date_day, g.user_id, g.is_active,
    CASE WHEN g.plan_id IS NULL OR g.plan_id = 'unknown' THEN 'free' ELSE g.plan_id END AS plan_id,
    CAST(coalesce(b.n7, 0) AS BIGINT) AS events_7d, CAST(coalesce(b.s7, 0) AS BIGINT) AS sessions_7d,
    CAST(coalesce(b.f7, 0) AS BIGINT) AS feature_use_7d,
    CAST(coalesce(b.t14, 0) AS BIGINT) AS support_tickets_14d,
    CASE WHEN coalesce(b.n7, 0) = 0 THEN CAST(0.0 AS DOUBLE)
         ELSE CAST(b.l7 AS DOUBLE) / CAST(b.n7 AS DOUBLE) END AS late_rate_7d,
    g.churn_7d
  FROM feat_grid g JOIN feat_band b USING (date_day, user_id)
),
gold_churn_by_plan_daily AS (
  SELECT date_day, plan_id, count(*) AS users, CAST(sum(churn_7d) AS BIGINT) AS churners,
    round(100.0 * sum(churn_7d) / count(*), 3) AS churn_rate_pct
  FROM gold_user_features_daily WHERE plan_id IS NOT NULL
  GROUP BY ALL
)""".replace("{iso}", ISO)


def with_chain(select: str, extra_ctes: str = "") -> str:
    """Full oracle text: adapter + layers (+ extra CTEs) + the final select."""
    ctes = ADAPTER + "," + LAYERS + ("," + extra_ctes if extra_ctes else "")
    return "WITH " + ctes + "\n" + select
