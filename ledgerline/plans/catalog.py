"""Registered queries: key -> (spark, sf_dir) -> DataFrame, and their oracles.

Every query builds its input from the driver tables of ``sf_dir`` through the
stand-in adapter and runs the library's own operators over the whole data.
Timestamps are returned as zone-less UTC wall-clock values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import bronze as B
from ledgerline.plans.lake import Lake
from ledgerline.plans.oracle import with_chain
from ledgerline.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def finalize(df: DataFrame) -> DataFrame:
    """Return timestamps as TIMESTAMP_NTZ (UTC wall clock)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(key: str, oracle: str | None = None):
    def deco(fn: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(Lake(spark, sf_dir)))
        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- bronze
@register("raw_events_scan", with_chain("SELECT source_file, raw_value AS value FROM ev_parsed"))
def raw_events_scan(lake: Lake) -> DataFrame:
    """B1: the feed landed as one JSONL file per source file, then scanned as a loader
    does: folder, glob, file name from the file's metadata, blank lines dropped."""
    return files.scan_jsonl(lake.spark, lake.events_folder)


@register("bronze_events_parse", with_chain(
    "SELECT event_id, event_ts, received_ts, user_id, device_id, session_id, event_type, props,"
    " source_file, ingestion_ts FROM ev_parsed"))
def bronze_events_parse(lake: Lake) -> DataFrame:
    """B2: every raw line parsed to typed bronze columns."""
    return lake.parsed_events.drop("row_hash")


@register("bronze_events_row_hash", with_chain("SELECT source_file, row_hash FROM ev_parsed"))
def bronze_events_row_hash(lake: Lake) -> DataFrame:
    """Row hash of every raw line (source file + canonical record)."""
    return lake.parsed_events.select("source_file", "row_hash")


@register("bronze_events_load", with_chain("SELECT * FROM bronze_events"))
def bronze_events_load(lake: Lake) -> DataFrame:
    """A first load of the daily files, then a re-run over all files
    (overlapping): the bronze table holds each hash once."""
    lines = lake.raw_event_lines
    # the table that the second load finds is stored, as a load leaves it
    first = lake.store(B.load_bronze_events(lines.where(~F.col("source_file").like("%_redelivery.jsonl")),
                                            None, lake.ingestion_ts), "bronze-events")
    second = B.load_bronze_events(lines, first, lake.ingestion_ts, files=B.batch_files(lines))
    return first.unionByName(second)


@register("bronze_billing_load", with_chain("SELECT * FROM bronze_billing"))
def bronze_billing_load(lake: Lake) -> DataFrame:
    """The feed landed as CSV files and scanned; loaded twice (a re-run): each hash
    once."""
    rows = files.scan_billing_csv(lake.spark, lake.billing_folder)
    first = lake.store(B.load_bronze_billing(rows, None, lake.ingestion_ts,
                                             empty_as_null=lake.empty_as_null), "bronze-billing")
    second = B.load_bronze_billing(rows, first, lake.ingestion_ts,
                                   empty_as_null=lake.empty_as_null, files=B.batch_files(rows))
    return first.unionByName(second)


@register("bronze_billing_row_hash", with_chain(
    "SELECT source_file, billing_date_raw AS billing_date, row_hash FROM bl_parsed"))
def bronze_billing_row_hash(lake: Lake) -> DataFrame:
    """Row hash of every raw billing row, over trimmed values."""
    raw = lake.raw_billing_rows
    return raw.select("source_file", "billing_date", B.billing_row_hash().alias("row_hash"))


@register("load_report", with_chain(
    "SELECT 'events' AS feed, source_file, count(*) AS records_read, count(*) AS insert_attempts,"
    " count(DISTINCT row_hash) AS inserted_rows FROM ev_parsed GROUP BY source_file"
    " UNION ALL SELECT 'billing', source_file, count(*), count(*), count(DISTINCT row_hash)"
    " FROM bl_parsed GROUP BY source_file"))
def load_report(lake: Lake) -> DataFrame:
    """Per feed file, records read, insert attempts and rows inserted."""
    ev = B.load_report(lake.parsed_events).select(F.lit("events").alias("feed"), "*")
    bl = B.load_report(lake.parsed_billing).select(F.lit("billing").alias("feed"), "*")
    return ev.unionByName(bl)


# ---------------------------------------------------------------- silver
@register("silver_events_quarantine", with_chain("SELECT * FROM silver_events_quarantine"))
def silver_events_quarantine(lake: Lake) -> DataFrame:
    """Bronze events missing a key field, with reason and record JSON."""
    return lake.events_quarantine


@register("silver_events", with_chain("SELECT * FROM silver_events"))
def silver_events(lake: Lake) -> DataFrame:
    """Valid events, one per event_id (latest arrival wins)."""
    return lake.silver_events


@register("event_lateness", with_chain(
    "SELECT event_id, event_ts, received_ts, lateness_sec, is_late FROM silver_events"))
def event_lateness(lake: Lake) -> DataFrame:
    """S3: lateness seconds (rounded, clamped at 0) and late flag per event."""
    return lake.silver_events.select("event_id", "event_ts", "received_ts", "lateness_sec", "is_late")


@register("silver_billing_quarantine", with_chain("SELECT * FROM silver_billing_quarantine"))
def silver_billing_quarantine(lake: Lake) -> DataFrame:
    """Invalid billing rows with the first failing reason."""
    return lake.billing_quarantine


@register("silver_billing", with_chain("SELECT * FROM silver_billing"))
def silver_billing(lake: Lake) -> DataFrame:
    """Valid billing rows (no dedup)."""
    return lake.silver_billing


# ---------------------------------------------------------------- staging
@register("stg_events", with_chain("SELECT * FROM stg_events"))
def stg_events(lake: Lake) -> DataFrame:
    """G1: staging projection of silver events."""
    return lake.stg_events


@register("stg_billing", with_chain("SELECT * FROM stg_billing"))
def stg_billing(lake: Lake) -> DataFrame:
    """Staging projection of silver billing."""
    return lake.stg_billing


# ---------------------------------------------------------------- marts
@register("fct_events_daily", with_chain("SELECT * FROM fct_events_daily"))
def fct_events_daily(lake: Lake) -> DataFrame:
    """events, DAU and late events per day."""
    return lake.fct_events_daily


@register("fct_billing_daily", with_chain("SELECT * FROM fct_billing_daily"))
def fct_billing_daily(lake: Lake) -> DataFrame:
    """starts and new paid users per day and plan."""
    return lake.fct_billing_daily


@register("fct_subscriptions_daily", with_chain("SELECT * FROM fct_subscriptions_daily"))
def fct_subscriptions_daily(lake: Lake) -> DataFrame:
    """dense per-user subscription state per day."""
    return lake.fct_subscriptions_daily


@register("gold_churn_labels_daily", with_chain("SELECT * FROM gold_churn_labels_daily"))
def gold_churn_labels_daily(lake: Lake) -> DataFrame:
    """7-day churn label per user and day."""
    return lake.gold_churn_labels_daily


@register("gold_user_features_daily", with_chain("SELECT * FROM gold_user_features_daily"))
def gold_user_features_daily(lake: Lake) -> DataFrame:
    """trailing behavioural features, state and label per user and day."""
    return lake.gold_user_features_daily


@register("gold_churn_by_plan_daily", with_chain("SELECT * FROM gold_churn_by_plan_daily"))
def gold_churn_by_plan_daily(lake: Lake) -> DataFrame:
    """users, churners and churn % per day and plan."""
    return lake.gold_churn_by_plan_daily


# ---------------------------------------------------------------- quality (Q1-Q7)
from ledgerline.operators import monitor as MON  # noqa: E402
from ledgerline.operators import quality as Q  # noqa: E402


def _models(lake: Lake) -> dict[str, DataFrame]:
    return {"fct_events_daily": lake.fct_events_daily,
            "fct_billing_daily": lake.fct_billing_daily,
            "fct_subscriptions_daily": lake.fct_subscriptions_daily,
            "gold_churn_labels_daily": lake.gold_churn_labels_daily,
            "gold_user_features_daily": lake.gold_user_features_daily}


def _bronze(lake: Lake) -> dict[str, DataFrame]:
    return {"bronze_events": lake.bronze_events, "bronze_billing": lake.bronze_billing}


def _sql_union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_NOT_NULL_SQL = _sql_union([
    f"SELECT '{m}' AS model, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {m}"
    for m, cols in Q.NOT_NULL.items() for c in cols])
_GRAIN_SQL = _sql_union([
    f"SELECT '{m}' AS model, date_day, user_id, count(*) AS n FROM {m} GROUP BY date_day, user_id HAVING count(*) > 1"
    for m in Q.GRAIN])
_ACCEPTED_SQL = _sql_union([
    f"SELECT '{m}' AS model, date_day, user_id, {c} AS value FROM {m} WHERE {c} NOT IN ({', '.join(map(str, v))})"
    for m, (c, v) in Q.ACCEPTED_VALUES.items()])
_HASH_SQL = _sql_union([
    f"SELECT '{t}' AS model, row_hash, count(*) AS n FROM {t} GROUP BY row_hash HAVING count(*) > 1"
    for t in ("bronze_events", "bronze_billing")])
_REPORT_SQL = _sql_union(
    [f"SELECT 'not_null' AS \"check\", '{m}' AS model, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {m}"
     for m, cols in Q.NOT_NULL.items() for c in cols]
    + [f"SELECT 'unique', '{m}', '{','.join(k)}', count(*) FROM (SELECT {','.join(k)} FROM {m} GROUP BY ALL HAVING count(*) > 1)"
       for m, k in Q.UNIQUE.items()]
    + [f"SELECT 'accepted_values', '{m}', '{c}', count(*) FROM {m} WHERE {c} NOT IN ({', '.join(map(str, v))})"
       for m, (c, v) in Q.ACCEPTED_VALUES.items()]
    + [f"SELECT 'unique_grain', '{m}', '{','.join(k)}', count(*) FROM (SELECT {','.join(k)} FROM {m} GROUP BY ALL HAVING count(*) > 1)"
       for m, k in Q.GRAIN.items()]
    + [f"SELECT 'range_0_1', '{m}', '{c}', count(*) FROM {m} WHERE {c} < 0 OR {c} > 1"
       for m, c in Q.RANGE_01.items()]
    + [f"SELECT 'unique', '{t}', 'row_hash', count(*) FROM (SELECT row_hash FROM {t} GROUP BY ALL HAVING count(*) > 1)"
       for t in ("bronze_events", "bronze_billing")])


@register("dq_not_null", with_chain(_NOT_NULL_SQL))
def dq_not_null(lake: Lake) -> DataFrame:
    """Q1: null counts of every declared not-null mart column."""
    return Q.not_null(_models(lake))


@register("dq_unique", with_chain(
    "SELECT 'fct_events_daily' AS model, date_day, count(*) AS n FROM fct_events_daily"
    " GROUP BY date_day HAVING count(*) > 1"))
def dq_unique(lake: Lake) -> DataFrame:
    """Q2: repeated days in fct_events_daily (empty = pass)."""
    return Q.unique(_models(lake))


@register("dq_accepted_values", with_chain(_ACCEPTED_SQL))
def dq_accepted_values(lake: Lake) -> DataFrame:
    """Q3: labels outside {0, 1} (empty = pass)."""
    return Q.accepted_values(_models(lake))


@register("dq_grain", with_chain(_GRAIN_SQL))
def dq_grain(lake: Lake) -> DataFrame:
    """Q4: repeated (date_day, user_id) in the per-user marts (empty = pass)."""
    return Q.grain(_models(lake))


@register("dq_late_rate_range", with_chain(
    "SELECT * FROM gold_user_features_daily WHERE late_rate_7d < 0 OR late_rate_7d > 1"))
def dq_late_rate_range(lake: Lake) -> DataFrame:
    """Q5: feature rows with late_rate_7d outside [0, 1] (empty = pass)."""
    return Q.late_rate_range(lake.gold_user_features_daily)


@register("dq_report", with_chain(
    "SELECT *, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM ("
    + _REPORT_SQL + ")"))
def dq_report(lake: Lake) -> DataFrame:
    """Q6: every check with its violation count and pass/fail.  Each layer that several
    checks or marts read is built and stored once, as the tables that the checks run on."""
    for layer in ("bronze_events", "bronze_billing", "stg_events", "stg_billing", "fct_subscriptions_daily", "gold_user_features_daily"):
        lake.materialize(layer)
    return Q.report(_models(lake), _bronze(lake))


@register("dq_row_hash_unique", with_chain(_HASH_SQL))
def dq_row_hash_unique(lake: Lake) -> DataFrame:
    """Q7: repeated row hashes in bronze (empty = pass)."""
    return Q.row_hash_unique(_bronze(lake))


# ---------------------------------------------------------------- monitoring
_HAS_KEY = "list_contains(json_keys(props), 'ui_variant')"
_BOUNDS_CTE = """m_bounds AS (
  SELECT min(lo) AS min_day, max(hi) AS max_day FROM (
    SELECT min(date_day) AS lo, max(date_day) AS hi FROM fct_events_daily
    UNION ALL SELECT min(date_day), max(date_day) FROM fct_billing_daily
    UNION ALL SELECT min(date_day), max(date_day) FROM fct_subscriptions_daily)
),
m_events AS (
  SELECT date_day, events, dau, late_events,
    coalesce(late_events / nullif(events, 0), 0) * 100.0 AS late_rate_pct
  FROM fct_events_daily
  WHERE date_day BETWEEN (SELECT min_day FROM m_bounds) AND (SELECT max_day FROM m_bounds)
),
m_billing AS (
  SELECT date_day, plan_id, starts, new_paid_users FROM fct_billing_daily
  WHERE date_day BETWEEN (SELECT min_day FROM m_bounds) AND (SELECT max_day FROM m_bounds)
)"""
# Fixed value: the plans of the billing feed (pivot columns of the oracles).
ORACLE_PLANS = ["basic", "free", "pro", "team"]


def _pivot_sql(src: str, value: str, agg: str, fill: bool) -> str:
    cols = []
    for p in ORACLE_PLANS:
        cell = f"{agg}({value}) FILTER (WHERE plan_id = '{p}')"
        if fill:
            cell = f"CAST(coalesce({cell}, 0) AS BIGINT)"
        cols.append(f"{cell} AS {p}")
    return f"SELECT date_day, {', '.join(cols)} FROM {src} GROUP BY date_day"


def _events_range(lake: Lake) -> DataFrame:
    return MON.events_daily_range(lake.fct_events_daily, *lake.day_bounds)


def _billing_range(lake: Lake) -> DataFrame:
    return MON.billing_daily_range(lake.fct_billing_daily, *lake.day_bounds)


@register("pipeline_health", with_chain(
    "SELECT (SELECT max(ingestion_ts) FROM bronze_events) AS latest_ingestion_ts,"
    " avg(CAST(is_late AS INTEGER)) * 100.0 AS late_rate_pct,"
    " CAST(sum(CAST(is_late AS INTEGER)) AS BIGINT) AS late_events,"
    " CAST(count(*) AS BIGINT) AS total_events,"
    f" min(CAST(event_ts AS DATE)) FILTER (WHERE {_HAS_KEY}) AS first_day_with_ui_variant,"
    f" CAST(count(*) FILTER (WHERE {_HAS_KEY}) AS BIGINT) AS rows_with_ui_variant"
    " FROM silver_events"))
def pipeline_health(lake: Lake) -> DataFrame:
    """M1: freshness, late rate and drift summary in one row."""
    return MON.pipeline_health(lake.bronze_events, lake.silver_events)


_TABLES = {"bronze.bronze_events": "bronze_events", "silver.silver_events": "silver_events",
           "silver.silver_events_quarantine": "silver_events_quarantine",
           "bronze.bronze_billing": "bronze_billing", "silver.silver_billing": "silver_billing",
           "silver.silver_billing_quarantine": "silver_billing_quarantine"}


@register("table_counts", with_chain(_sql_union(
    [f"SELECT '{k}' AS table_name, CAST(count(*) AS BIGINT) AS \"rows\" FROM {v}"
     for k, v in _TABLES.items()])))
def table_counts(lake: Lake) -> DataFrame:
    """M2: row counts of the bronze, silver and quarantine tables."""
    return MON.table_counts({
        "bronze.bronze_events": lake.bronze_events, "silver.silver_events": lake.silver_events,
        "silver.silver_events_quarantine": lake.events_quarantine,
        "bronze.bronze_billing": lake.bronze_billing, "silver.silver_billing": lake.silver_billing,
        "silver.silver_billing_quarantine": lake.billing_quarantine})


@register("events_daily_range", with_chain("SELECT * FROM m_events", _BOUNDS_CTE))
def events_daily_range(lake: Lake) -> DataFrame:
    """M3: daily events over the default (whole) date range with late %."""
    return _events_range(lake)


@register("date_bounds", with_chain("SELECT * FROM m_bounds", _BOUNDS_CTE))
def date_bounds(lake: Lake) -> DataFrame:
    """M4: min and max day over the three daily marts."""
    return MON.feed_bounds(lake.stg_events, lake.stg_billing)


@register("product_kpis", with_chain(
    "SELECT count(DISTINCT date_day) AS days, CAST(sum(events) AS BIGINT) AS total_events,"
    " CAST(round_even(avg(dau), 0) AS BIGINT) AS avg_dau,"
    " round_even(avg(late_rate_pct), 2) AS avg_late_rate_pct FROM m_events", _BOUNDS_CTE))
def product_kpis(lake: Lake) -> DataFrame:
    """M5: KPI row over the date range."""
    return MON.product_kpis(_events_range(lake))


@register("billing_daily_range", with_chain("SELECT * FROM m_billing", _BOUNDS_CTE))
def billing_daily_range(lake: Lake) -> DataFrame:
    """M6: daily billing by plan over the default (whole) date range."""
    return _billing_range(lake)


@register("starts_by_plan_pivot", with_chain(_pivot_sql("m_billing", "starts", "sum", True),
                                              _BOUNDS_CTE))
def starts_by_plan_pivot(lake: Lake) -> DataFrame:
    """M7: day x plan starts, missing cells 0."""
    return MON.pivot_sum(_billing_range(lake), "starts")


@register("new_paid_by_plan_pivot", with_chain(
    _pivot_sql("m_billing", "new_paid_users", "sum", True), _BOUNDS_CTE))
def new_paid_by_plan_pivot(lake: Lake) -> DataFrame:
    """M8: day x plan new paid users, missing cells 0."""
    return MON.pivot_sum(_billing_range(lake), "new_paid_users")


@register("active_subs_daily", with_chain(
    "SELECT date_day, count(*) AS users, count(*) FILTER (WHERE is_active) AS active_users"
    " FROM fct_subscriptions_daily WHERE date_day BETWEEN (SELECT min_day FROM m_bounds)"
    " AND (SELECT max_day FROM m_bounds) GROUP BY date_day", _BOUNDS_CTE))
def active_subs_daily(lake: Lake) -> DataFrame:
    """M9: users and active subscriptions per day over the date range."""
    return MON.active_subs_daily(lake.fct_subscriptions_daily, *lake.day_bounds)


@register("active_subs_rows", with_chain(
    "SELECT date_day, is_active FROM fct_subscriptions_daily WHERE date_day BETWEEN"
    " (SELECT min_day FROM m_bounds) AND (SELECT max_day FROM m_bounds)", _BOUNDS_CTE))
def active_subs_rows(lake: Lake) -> DataFrame:
    """M9: the (day, is_active) row of every user over the date range."""
    return MON.active_subs_rows(lake.fct_subscriptions_daily, *lake.day_bounds)


@register("churn_rate_daily", with_chain(
    "SELECT date_day, CAST(count(*) AS BIGINT) AS \"rows\","
    " CAST(sum(churn_7d) AS BIGINT) AS churners,"
    " round(100.0 * sum(churn_7d) / count(*), 2) AS churn_rate_pct"
    " FROM gold_user_features_daily GROUP BY date_day"))
def churn_rate_daily(lake: Lake) -> DataFrame:
    """Daily churn %, 2 places."""
    return MON.churn_rate_daily(lake.gold_user_features_daily)


@register("churn_rate_overall", with_chain(
    "SELECT date_day, count(*) AS \"rows\", CAST(sum(churn_7d) AS BIGINT) AS churners,"
    " CAST(avg(churn_7d) AS DOUBLE) AS churn_rate FROM gold_user_features_daily GROUP BY date_day"))
def churn_rate_overall(lake: Lake) -> DataFrame:
    """Daily churn ratio, unrounded."""
    return MON.churn_rate_overall(lake.gold_user_features_daily)


@register("churn_rate_by_plan_pivot", with_chain(
    _pivot_sql("gold_churn_by_plan_daily", "churn_rate_pct", "max", False)))
def churn_rate_by_plan_pivot(lake: Lake) -> DataFrame:
    """Day x plan churn %, missing cells null, duplicate cells an error."""
    return MON.pivot_unique(lake.gold_churn_by_plan_daily, "churn_rate_pct")


@register("users_by_plan_pivot", with_chain(
    _pivot_sql("gold_churn_by_plan_daily", "users", "max", False)))
def users_by_plan_pivot(lake: Lake) -> DataFrame:
    """Day x plan users (all user-days of the plan)."""
    return MON.pivot_unique(lake.gold_churn_by_plan_daily, "users")


@register("drift_ui_variant_daily", with_chain(
    f"SELECT CAST(event_ts AS DATE) AS date_day, avg(CASE WHEN {_HAS_KEY} THEN 1 ELSE 0 END) * 100.0"
    " AS pct_ui_variant FROM silver_events GROUP BY 1"))
def drift_ui_variant_daily(lake: Lake) -> DataFrame:
    """Daily % of events whose props hold `ui_variant`."""
    return MON.drift_key_share_daily(lake.silver_events)


@register("late_rate_daily", with_chain(
    "SELECT CAST(event_ts AS DATE) AS date_day, avg(CAST(is_late AS INTEGER)) * 100.0 AS late_rate_pct,"
    " CAST(sum(CAST(is_late AS INTEGER)) AS BIGINT) AS late_events,"
    " CAST(count(*) AS BIGINT) AS events FROM silver_events GROUP BY 1"))
def late_rate_daily(lake: Lake) -> DataFrame:
    """Daily late %, late events and events."""
    return MON.late_rate_daily(lake.silver_events)


@register("drift_key_daily", with_chain(
    "SELECT p.date_day, p.key, p.rows_with_key, p.rows_with_key / d.day_events * 100.0 AS pct_with_key,"
    " min(p.date_day) OVER (PARTITION BY p.key) AS first_day_with_key"
    " FROM k_per_key p JOIN k_per_day d USING (date_day)",
    """k_ev AS (SELECT CAST(event_ts AS DATE) AS date_day, json_keys(props) AS keys FROM silver_events),
k_per_day AS (SELECT date_day, count(*) AS day_events FROM k_ev GROUP BY 1),
k_per_key AS (SELECT date_day, k AS key, count(*) AS rows_with_key
  FROM (SELECT date_day, unnest(list_distinct(keys)) AS k FROM k_ev) GROUP BY 1, 2)"""))
def drift_key_daily(lake: Lake) -> DataFrame:
    """Every top-level props key: daily rows, share and first day."""
    return MON.drift_keys_daily(lake.silver_events)


# ---------------------------------------------------------------- churn model
from ledgerline.plans import churn as C  # noqa: E402

_CV = C.WalkForwardConfig()
_D = "CAST({} AS DOUBLE)"
_CHURN_CTES = f"""cv_t AS (
  SELECT date_day, user_id, coalesce(plan_id, 'unknown') AS plan_id, events_7d, sessions_7d,
    feature_use_7d, support_tickets_14d, late_rate_7d, CAST(churn_7d AS INTEGER) AS churn_7d
  FROM gold_user_features_daily
),
cv_cut AS (SELECT max(date_day) - {_CV.label_horizon_days} AS cutoff FROM cv_t),
cv_day AS (
  SELECT date_day, count(*) AS rows_day, CAST(sum(churn_7d) AS BIGINT) AS pos_day FROM cv_t
  WHERE date_day <= (SELECT cutoff FROM cv_cut) GROUP BY 1
),
cv_idx AS (
  SELECT *, row_number() OVER (ORDER BY date_day) - 1 AS day_index,
    coalesce(sum(rows_day) OVER (ORDER BY date_day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rows_train,
    coalesce(sum(pos_day) OVER (ORDER BY date_day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS positives_train
  FROM cv_day
),
cv_folds AS (
  SELECT CAST(day_index - {_CV.min_train_days} AS INTEGER) AS fold, date_day AS test_day,
    CAST(rows_train AS BIGINT) AS rows_train, CAST(positives_train AS BIGINT) AS positives_train,
    CAST(rows_day AS BIGINT) AS rows_test, CAST(pos_day AS BIGINT) AS positives_test,
    pos_day = 0 AS skipped
  FROM cv_idx WHERE day_index >= {_CV.min_train_days}
),
cv_scored AS (
  SELECT f.fold, t.churn_7d AS label,
    t.support_tickets_14d * {_D.format(1.0)} + t.late_rate_7d - t.events_7d * {_D.format(0.1)}
      - t.feature_use_7d * {_D.format(0.2)} - t.sessions_7d * {_D.format(0.05)}
      + CASE WHEN t.plan_id = 'free' THEN {_D.format(0.5)} ELSE {_D.format(0.0)} END AS score
  FROM cv_t t JOIN cv_folds f ON t.date_day = f.test_day WHERE NOT f.skipped
),
cv_auc AS (
  SELECT p.fold, CAST(sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END) AS DOUBLE)
    / CAST(count(*) AS DOUBLE) AS roc_auc
  FROM cv_scored p JOIN cv_scored n ON p.fold = n.fold AND p.label = 1 AND n.label = 0
  GROUP BY p.fold
),
cv_ap_s AS (SELECT fold, score, count(*) AS n, sum(label) AS pos FROM cv_scored GROUP BY 1, 2),
cv_ap_c AS (
  SELECT fold, pos,
    sum(pos) OVER (PARTITION BY fold ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    sum(n) OVER (PARTITION BY fold ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen,
    sum(pos) OVER (PARTITION BY fold) AS n_pos
  FROM cv_ap_s
),
cv_ap AS (
  SELECT fold, CASE WHEN max(n_pos) > 0 THEN
    sum(CAST(pos AS DOUBLE) / CAST(n_pos AS DOUBLE) * (CAST(tp AS DOUBLE) / CAST(seen AS DOUBLE))) END AS ap
  FROM cv_ap_c GROUP BY fold
),
cv_table AS (
  SELECT f.fold, f.test_day, f.rows_test, f.positives_test, f.skipped,
    round(a.ap, {C.METRIC_PLACES}) AS pr_auc, round(r.roc_auc, {C.METRIC_PLACES}) AS roc_auc
  FROM cv_folds f LEFT JOIN cv_ap a ON a.fold = f.fold LEFT JOIN cv_auc r ON r.fold = f.fold
)"""


def _frame(lake: Lake) -> DataFrame:
    # staged billing is read twice: for its days' bounds and for the timeline
    lake.materialize("stg_billing")
    return C.training_frame(lake.gold_user_features_daily)


def _stable_frame(lake: Lake) -> DataFrame:
    """The model frame written once to the shared checkpoint folder: the CV
    operators read it several times (scalars, folds, scores)."""
    return C.stable_frame(_frame(lake))


def _counted_frame(lake: Lake) -> DataFrame:
    """Distinct (day, features, label) rows with their number, stored once."""
    return C.stable_frame(C.counted_frame(_frame(lake)))


def _day_counts(lake: Lake) -> DataFrame:
    """Rows per day and label, stored once (two rows a day): enough for the fold plan,
    class weights and counts."""
    return C.stable_frame(C.day_counts(_frame(lake)))


@register("training_frame", with_chain("SELECT * FROM cv_t", _CHURN_CTES))
def training_frame(lake: Lake) -> DataFrame:
    """Model frame (9 columns of the gold features)."""
    return _frame(lake)


@register("frame_profile", with_chain(
    "SELECT count(*) AS n_rows, 9 AS n_cols, min(date_day) AS min_day, max(date_day) AS max_day,"
    " count(*) FILTER (WHERE churn_7d = 0) AS n_churn_0, count(*) FILTER (WHERE churn_7d = 1) AS n_churn_1, "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS nulls_{c}" for c in
                ["date_day", "user_id", "plan_id", *C.NUMERIC_FEATURES, "churn_7d"])
    + " FROM cv_t", _CHURN_CTES))
def frame_profile(lake: Lake) -> DataFrame:
    """Shape, date range, class counts, nulls per column."""
    return C.frame_profile(_frame(lake))


@register("eligible_days", with_chain(
    "SELECT date_day, (SELECT cutoff FROM cv_cut) AS cutoff_day, day_index FROM cv_idx", _CHURN_CTES))
def eligible_days(lake: Lake) -> DataFrame:
    """Label-safe days (max day - 7 and before) with their index."""
    return C.eligible_days(_day_counts(lake)).withColumn("day_index", F.col("day_index").cast("long"))


@register("cv_folds", with_chain(
    "SELECT fold, test_day, rows_train, positives_train, rows_test, positives_test FROM cv_folds",
    _CHURN_CTES))
def cv_folds(lake: Lake) -> DataFrame:
    """C4: walk-forward folds with train/test rows and positives."""
    return C.cv_folds(_day_counts(lake)).drop("skipped")


@register("fold_skip", with_chain(
    "SELECT fold, test_day, rows_test, positives_test, skipped FROM cv_folds", _CHURN_CTES))
def fold_skip(lake: Lake) -> DataFrame:
    """Folds without test positives are recorded as skipped."""
    return C.cv_folds(_day_counts(lake)).select("fold", "test_day", "rows_test", "positives_test",
                                           "skipped")


@register("class_weights", with_chain(
    "SELECT churn_7d, count(*) AS n_class, CAST((SELECT count(*) FROM cv_t WHERE date_day <= (SELECT cutoff FROM cv_cut)) AS DOUBLE)"
    " / (CAST(2.0 AS DOUBLE) * CAST(count(*) AS DOUBLE)) AS weight FROM cv_t"
    " WHERE date_day <= (SELECT cutoff FROM cv_cut) GROUP BY churn_7d", _CHURN_CTES))
def class_weights(lake: Lake) -> DataFrame:
    """Balanced class weights of the final-fit rows."""
    frame = _day_counts(lake)
    return C.class_weights(frame.where(F.col("date_day") <= C.cutoff_day(frame)))


@register("fold_roc_auc", with_chain(
    "SELECT fold, test_day, roc_auc FROM cv_table", _CHURN_CTES))
def fold_roc_auc(lake: Lake) -> DataFrame:
    """Exact ROC-AUC per fold of the rule score (rank-sum, tied ranks averaged)."""
    return C.rule_fold_table(_counted_frame(lake)).select("fold", "test_day", "roc_auc")


@register("fold_average_precision", with_chain(
    "SELECT fold, test_day, pr_auc FROM cv_table", _CHURN_CTES))
def fold_average_precision(lake: Lake) -> DataFrame:
    """Step-wise average precision per fold of the rule score."""
    return C.rule_fold_table(_counted_frame(lake)).select("fold", "test_day", "pr_auc")


_R = C.METRIC_PLACES


@register("cv_summary", with_chain(
    f"SELECT {_CV.label_horizon_days} AS label_horizon_days, {_CV.min_train_days} AS min_train_days,"
    " (SELECT cutoff FROM cv_cut) AS cutoff_day_inclusive,"
    " (SELECT count(DISTINCT date_day) FROM cv_t) AS days_total,"
    " (SELECT count(DISTINCT date_day) FROM cv_t WHERE date_day <= (SELECT cutoff FROM cv_cut)) AS days_eligible_after_censor,"
    " (SELECT count(*) FROM cv_t) AS rows_total,"
    " (SELECT CAST(sum(churn_7d) AS BIGINT) FROM cv_t) AS positives_total,"
    " count(*) AS folds_total, count(*) FILTER (WHERE NOT skipped) AS folds_used,"
    " count(*) FILTER (WHERE skipped) AS folds_skipped_no_test_positives,"
    f" round(avg(pr_auc) FILTER (WHERE NOT skipped), {_R}) AS pr_auc_mean,"
    f" round(stddev_samp(pr_auc) FILTER (WHERE NOT skipped), {_R}) AS pr_auc_std,"
    f" round(avg(roc_auc) FILTER (WHERE NOT skipped), {_R}) AS roc_auc_mean,"
    f" round(stddev_samp(roc_auc) FILTER (WHERE NOT skipped), {_R}) AS roc_auc_std"
    " FROM cv_table", _CHURN_CTES))
def cv_summary(lake: Lake) -> DataFrame:
    """C12 (a): 14-field CV summary (ddof 1) of the rule-score folds."""
    frame = _counted_frame(lake)
    return C.cv_summary(C.rule_fold_table(frame), frame)


@register("cv_summary_pop", with_chain(
    "SELECT count(*) AS n_folds_total, count(*) FILTER (WHERE skipped) AS n_folds_skipped,"
    f" round(avg(pr_auc) FILTER (WHERE NOT skipped), {_R}) AS pr_auc_mean,"
    f" round(stddev_pop(pr_auc) FILTER (WHERE NOT skipped), {_R}) AS pr_auc_std,"
    f" round(avg(roc_auc) FILTER (WHERE NOT skipped), {_R}) AS roc_auc_mean,"
    f" round(stddev_pop(roc_auc) FILTER (WHERE NOT skipped), {_R}) AS roc_auc_std"
    " FROM cv_table", _CHURN_CTES))
def cv_summary_pop(lake: Lake) -> DataFrame:
    """C12 (b): 6-field CV summary (ddof 0) of the rule-score folds."""
    return C.cv_summary_pop(C.rule_fold_table(_counted_frame(lake)))


@register("final_fit_stats", with_chain(
    "SELECT count(*) AS rows_fit, CAST(sum(churn_7d) AS BIGINT) AS positives_fit,"
    " CAST(avg(churn_7d) AS DOUBLE) AS churn_rate_fit FROM cv_t"
    " WHERE date_day <= (SELECT cutoff FROM cv_cut)", _CHURN_CTES))
def final_fit_stats(lake: Lake) -> DataFrame:
    """C14: rows, positives and churn rate of the final fit."""
    return C.final_fit_stats(_day_counts(lake))


@register("fold_metric_trend", with_chain(
    "SELECT test_day, positives_test, skipped,"
    " CASE WHEN skipped THEN 0.0 ELSE pr_auc END AS pr_auc_marked,"
    " CASE WHEN skipped THEN 0.0 ELSE roc_auc END AS roc_auc_marked FROM cv_table", _CHURN_CTES))
def fold_metric_trend(lake: Lake) -> DataFrame:
    """Fold metrics by day, skipped folds marked at 0."""
    return C.fold_metric_trend(C.rule_fold_table(_counted_frame(lake)))


@register("fold_rolling_7d", with_chain(
    f"SELECT test_day, round(avg(pr_auc) OVER w, {_R}) AS pr_auc_rolling_7d,"
    f" round(avg(roc_auc) OVER w, {_R}) AS roc_auc_rolling_7d FROM cv_table WHERE NOT skipped"
    " WINDOW w AS (ORDER BY test_day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)",
    _CHURN_CTES))
def fold_rolling_7d(lake: Lake) -> DataFrame:
    """7-calendar-day trailing mean of the scored folds' metrics."""
    return C.fold_rolling_7d(C.rule_fold_table(_counted_frame(lake)))


# The model's oracle solves the same objective by itself: undamped Newton steps in a recursive
# CTE, each normal system by Gauss-Jordan elimination on lists.
_NEWTON_STEPS = 10
_X = [f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in C.NUMERIC_FEATURES]


def _model_ctes(fits: str, rows: str = "") -> str:
    """``m_beta(fit, beta)``: coefficients of every ``m_fit(fit, until)``, trained on the days
    before ``until``; with ``rows``, only up to the design."""
    stats = ",\n    ".join(f"avg(x{i}) AS mean{i}, CASE WHEN min(x{i}) = max(x{i}) THEN 1.0 ELSE sqrt(avg(x{i} * x{i}) - avg(x{i}) * avg(x{i})) END AS scale{i}"
                           for i in range(len(_X)))
    scaled = ", ".join(f"(x{i} - mean{i}) / scale{i}" for i in range(len(_X)))
    columns = ", ".join(f"{x} AS x{i}" for i, x in enumerate(_X))
    n = len(_X)
    return f"""{_CHURN_CTES},
m_fit AS ({fits}),
m_train AS MATERIALIZED (
  SELECT f.fit, t.plan_id, t.churn_7d AS y, {columns} FROM cv_t t JOIN m_fit f ON t.date_day < f.until),
m_levels AS (SELECT list(DISTINCT plan_id ORDER BY plan_id) AS levels FROM m_train),
m_scale AS MATERIALIZED (
  SELECT fit, count(*) / (2.0 * count(*) FILTER (y = 0)) AS w0, count(*) / (2.0 * count(*) FILTER (y = 1)) AS w1,
    {stats}
  FROM m_train GROUP BY fit),
m_x AS MATERIALIZED (
  SELECT fit, y, x, CAST(count(*) AS DOUBLE) * any_value(w) AS w
  FROM (SELECT t.fit, t.y, CASE t.y WHEN 1 THEN w1 ELSE w0 END AS w,
               list_concat([{scaled}], list_transform((SELECT levels FROM m_levels), lambda v: CASE WHEN v = t.plan_id THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END),
                           [1.0::DOUBLE]) AS x
        FROM m_train t JOIN m_scale s ON s.fit = t.fit)
  GROUP BY fit, y, x),
m_dim AS (SELECT CAST({n} + len(levels) + 1 AS INTEGER) AS d FROM m_levels),
m_at AS MATERIALIZED (SELECT i, j, d FROM m_dim, (SELECT unnest(range(1, 200)) AS i), (SELECT unnest(range(1, 200)) AS j) WHERE i <= d AND j <= d + 1),
m_step AS (
  SELECT 0 AS step, fit, list_transform(range(1, (SELECT d FROM m_dim) + 1), lambda i: CAST(0 AS DOUBLE)) AS beta FROM m_scale
  UNION ALL
  SELECT step + 1, fit,
    list_transform(list_reduce(list_transform(range(1, len(beta) + 1), lambda p: [[CAST(p AS DOUBLE)]]),
      lambda m, q: list_transform(m, lambda r, i: CASE WHEN i = q[1][1]
          THEN list_transform(r, lambda v: v / r[CAST(q[1][1] AS INTEGER)])
          ELSE list_transform(r, lambda v, j: v - r[CAST(q[1][1] AS INTEGER)] * m[CAST(q[1][1] AS INTEGER)][j] / m[CAST(q[1][1] AS INTEGER)][CAST(q[1][1] AS INTEGER)]) END),
      augmented), lambda r, i: beta[i] - r[len(r)])
  FROM (
    SELECT step, fit, beta, list(line ORDER BY i) AS augmented FROM (
      SELECT step, fit, beta, i, list(v ORDER BY j) AS line FROM (
        SELECT step, fit, beta, i, j,
          sum(CASE WHEN j <= d THEN w * p * (1 - p) * x[i] * x[j] ELSE w * (p - y) * x[i] END)
            + CASE WHEN i = d THEN 0.0 WHEN i = j THEN 1.0 WHEN j = d + 1 THEN beta[i] ELSE 0.0 END AS v
        FROM (SELECT step, m_step.fit, beta, x, y, w, 1 / (1 + exp(-list_dot_product(x, beta))) AS p
              FROM m_step JOIN m_x ON m_x.fit = m_step.fit WHERE step < {_NEWTON_STEPS}), m_at
        GROUP BY step, fit, beta, i, j, d)
      GROUP BY step, fit, beta, i)
    GROUP BY step, fit, beta)),
m_beta AS MATERIALIZED (SELECT fit, beta FROM m_step WHERE step = {_NEWTON_STEPS}),
m_all AS (SELECT *, {columns} FROM cv_t),
m_scored AS (
  SELECT b.fit, t.date_day, t.user_id, t.churn_7d,
    1 / (1 + exp(-list_dot_product(b.beta, list_concat([{scaled}],
      list_transform((SELECT levels FROM m_levels), lambda v: CASE WHEN v = t.plan_id THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), [1.0::DOUBLE])))) AS score
  FROM m_all t, m_beta b JOIN m_scale s ON s.fit = b.fit {rows})"""


_FINAL_FIT = _model_ctes("SELECT -1 AS fit, cutoff + 1 AS until FROM cv_cut")


def _model_oracle(select: str, ctes: str = _FINAL_FIT) -> str:
    return with_chain(select, ctes).replace("WITH ", "WITH RECURSIVE ", 1)


FEATURE_PLACES = 9


@register("feature_pipeline", with_chain(f"""SELECT t.date_day, t.user_id, {', '.join(
    f"round(({x} - s.mean{i}) / s.scale{i}, {FEATURE_PLACES}) AS {c}" for i, (c, x) in enumerate(zip(C.NUMERIC_FEATURES, _X, strict=True)))},
  t.plan_id AS plan_level, CASE WHEN list_contains(l.levels, t.plan_id) THEN 1 ELSE 0 END AS plan_known,
  CAST(len(l.levels) AS INTEGER) AS n_levels
FROM cv_t t, s, l""", _CHURN_CTES + f""",
fitted AS (SELECT plan_id, {', '.join(f"{x} AS x{i}" for i, x in enumerate(_X))} FROM cv_t WHERE date_day <= (SELECT cutoff FROM cv_cut)),
s AS (SELECT {', '.join(f"avg(x{i}) AS mean{i}, CASE WHEN min(x{i}) = max(x{i}) THEN 1.0 ELSE stddev_pop(x{i}) END AS scale{i}" for i in range(len(_X)))} FROM fitted),
l AS (SELECT list(DISTINCT plan_id) AS levels FROM fitted)"""))
def feature_pipeline(lake: Lake) -> DataFrame:
    """Preprocessing fitted on the final-fit rows (0-impute, population
    standardisation, one-hot plan) applied to every row of the frame.  The one-hot block
    is shown as the level it stands for, whether it has a column, and the block's width."""
    frame = _stable_frame(lake)
    counted = C.counted_frame(frame.where(F.col("date_day") <= C.cutoff_day(frame)))
    pre, _ = C.fit_preprocessor(counted)
    columns = pre.columns()
    n = len(C.NUMERIC_FEATURES)
    hot = F.array(*columns[n:])
    level = F.coalesce("plan_id", F.lit(C.UNKNOWN_LEVEL))
    wide = frame.select("date_day", "user_id", *[F.round(c, FEATURE_PLACES).alias(name) for c, name in zip(columns, C.NUMERIC_FEATURES)],
                        hot.alias("hot"), level.alias("plan_level"))
    names = F.array(*[F.lit(v) for v in pre.levels])
    known = F.aggregate("hot", F.lit(0.0), lambda a, v: a + v).cast("int")
    shown = F.coalesce(F.get(names, F.array_position("hot", F.lit(1.0)).cast("int") - 1), F.col("plan_level"))
    return wide.select("date_day", "user_id", *C.NUMERIC_FEATURES, shown.alias("plan_level"), known.alias("plan_known"), F.size("hot").alias("n_levels"))


@register("churn_model", _model_oracle(f"SELECT date_day, user_id, churn_7d, round(score, {C.SCORE_PLACES}) AS score FROM m_scored"))
def churn_model(lake: Lake) -> DataFrame:
    """Balanced L2 logistic regression fitted on the eligible days;
    churn probability of every row."""
    frame = _stable_frame(lake)
    pre, model = C.final_model(C.stable_frame(C.counted_frame(frame)))
    out = C.score(pre, model, frame, ["date_day", "user_id", "churn_7d"])
    return out.withColumn("score", F.round("score", C.SCORE_PLACES))


@register("cv_run", _model_oracle("""SELECT f.fold, f.test_day, f.rows_test, f.positives_test, f.skipped, """ + f"""
  round(a.ap, {C.METRIC_PLACES}) AS pr_auc, round(r.roc_auc, {C.METRIC_PLACES}) AS roc_auc
FROM cv_folds f LEFT JOIN cvm_ap a ON a.fold = f.fold LEFT JOIN cvm_auc r ON r.fold = f.fold""",
    _model_ctes("SELECT fold AS fit, test_day AS until FROM cv_folds WHERE NOT skipped", "JOIN cv_folds g ON g.fold = b.fit WHERE t.date_day = g.test_day")
    + ",\ncvm_scored AS MATERIALIZED (SELECT fit AS fold, churn_7d AS label, round(score, 12) AS score FROM m_scored),\n"
    + _CHURN_CTES[_CHURN_CTES.index("cv_auc AS ("):_CHURN_CTES.index("cv_table AS (")].rstrip().rstrip(",")
    .replace("cv_scored", "cvm_scored").replace("cv_auc", "cvm_auc").replace("cv_ap", "cvm_ap")))
def cv_run(lake: Lake) -> DataFrame:
    """C11: walk-forward CV of the model, every fold; fold table with metrics."""
    return C.cv_run(_frame(lake))


@register("model_coefficients", _model_oracle(f"""SELECT name AS feature, round(coef, {C.SCORE_PLACES}) AS coef FROM (
  SELECT unnest(list_concat({C.NUMERIC_FEATURES!r}, list_transform(levels, lambda v: 'plan_id_' || v), ['intercept'])) AS name, unnest(beta) AS coef
  FROM m_beta, m_levels)"""))
def model_coefficients(lake: Lake) -> DataFrame:
    """Coefficients of the final fit, descending."""
    return C.model_coefficients(_frame(lake)).withColumn("coef", F.round("coef", C.SCORE_PLACES))


@register("scored_users_daily", _model_oracle(f"""SELECT date_day, count(*) AS users, round(avg(s), {C.SCORE_PLACES}) AS mean_score, {', '.join(
    f"list(s ORDER BY s)[CAST(ceil(CAST({q} AS DOUBLE) * count(*)) AS BIGINT)] AS p{round(100 * q)}" for q in C.QUANTILES)}
FROM (SELECT date_day, round(score, {C.SCORE_PLACES}) AS s FROM m_scored) GROUP BY date_day"""))
def scored_users_daily(lake: Lake) -> DataFrame:
    """Daily score distribution of the final model."""
    return C.scored_users_daily(_frame(lake))


# ---------------------------------------------------------------- streaming
from ledgerline.streaming import incremental as STR  # noqa: E402


def _landed(lake: Lake, name: str) -> tuple[str, str]:
    """Land the raw feed in two arrivals (daily files, then the redelivery
    files) so the stream sees more than one micro-batch."""
    spark = lake.spark
    base = STR.scratch_base(spark, name)
    landing = f"{base}/landing"
    lines = lake.raw_event_lines
    redelivery = F.col("source_file").like("%_redelivery.jsonl")
    STR.land(lines.where(~redelivery), landing)
    STR.land(lines.where(redelivery), landing)
    return base, landing


@register("stream_bronze_events", with_chain("SELECT * FROM bronze_events"))
def stream_bronze_events(lake: Lake) -> DataFrame:
    """Bronze built incrementally by a stream over the feed's JSONL files, some days'
    files a micro-batch."""
    base = STR.scratch_base(lake.spark, "bronze")
    source = STR.jsonl_stream(lake.spark, lake.events_folder, max_files=64)
    paths = STR.run_bronze_silver(lake.spark, source, base, lake.ingestion_ts)
    return lake.spark.read.parquet(paths["bronze"])


@register("stream_silver_events", with_chain("SELECT * FROM silver_events"))
def stream_silver_events(lake: Lake) -> DataFrame:
    """Silver upserted per touched event day by the stream."""
    base, landing = _landed(lake, "silver")
    paths = STR.run_bronze_silver(lake.spark, STR.landing_stream(lake.spark, landing), base,
                                  lake.ingestion_ts)
    return lake.spark.read.parquet(paths["silver"]).drop("event_day")


@register("stream_events_daily", with_chain("SELECT * FROM fct_events_daily"))
def stream_events_daily(lake: Lake) -> DataFrame:
    """T3 (exact): F1 kept up to date by the stream, each micro-batch
    recomputing just the days it touched from day-partitioned silver."""
    base, landing = _landed(lake, "daily-exact")
    paths = STR.run_bronze_silver(lake.spark, STR.landing_stream(lake.spark, landing), base,
                                  lake.ingestion_ts)
    return lake.spark.read.parquet(paths["daily"]).select("date_day", "events", "dau", "late_events")


@register("stream_events_daily_windowed")
def stream_events_daily_windowed(lake: Lake) -> DataFrame:
    """T3 (windowed): daily events / approximate DAU / late events from an
    event-time window with a 6-hour watermark; days of later data and of
    repeated ids are corrected from a late table."""
    base, landing = _landed(lake, "daily")
    return STR.run_events_daily_corrected(lake.spark, STR.landing_stream(lake.spark, landing), base,
                                          lake.ingestion_ts)
