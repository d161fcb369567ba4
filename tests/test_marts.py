"""Marts on hand-made timelines (FIXTURES.md 5)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import marts as M

D0 = dt.date(2024, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n - 1)


def stg_billing(spark, rows):
    return spark.createDataFrame(
        [(day(d), u, e, p, "billing/x.csv", dt.datetime(2024, 2, 1)) for d, u, e, p in rows],
        "billing_date date, user_id string, billing_event string, plan_id string, "
        "source_file string, ingestion_ts timestamp")


TIMELINES = [
    (1, "u1", "start", "basic"),                                   # 1 never cancels
    (1, "u2", "start", "pro"), (5, "u2", "cancel", "pro"),          # 2
    (1, "u3", "start", "pro"), (5, "u3", "cancel", "pro"), (9, "u3", "start", "team"),   # 3
    (1, "u4", "start", "pro"), (5, "u4", "cancel", "pro"), (12, "u4", "start", "pro"),   # 4
    (3, "u5", "start", "pro"), (3, "u5", "cancel", "pro"),          # 5 same-day cancel wins
    (2, "u6", "upgrade", "pro"), (2, "u6", "start", "team"),        # 6 upgrade beats start
    (2, "u6b", "start", "basic"), (2, "u6b", "start", "pro"),       # 6b higher plan id
    (3, "u7", "upgrade", "team"),                                   # 7 upgrade without start
    (4, "u8", "cancel", "basic"),                                   # 8 cancel only
    (20, "u9", "cancel", "basic"),                                  # spine end
]


@pytest.fixture(scope="module")
def subs(spark):
    return M.fct_subscriptions_daily(stg_billing(spark, TIMELINES)).cache()


def state(subs, user):
    return {r["date_day"]: (r["is_active"], r["plan_id"])
            for r in subs.where(F.col("user_id") == user).collect()}


def active_days(subs, user):
    return sorted((d - D0).days + 1 for d, (a, _) in state(subs, user).items() if a)


def test_dense_grid(subs):
    assert subs.count() == 20 * 10
    assert subs.groupBy("date_day", "user_id").count().where("count > 1").count() == 0


def test_timelines(subs):
    assert active_days(subs, "u1") == list(range(1, 21))
    assert active_days(subs, "u2") == [1, 2, 3, 4]
    assert active_days(subs, "u3") == [1, 2, 3, 4] + list(range(9, 21))
    assert active_days(subs, "u4") == [1, 2, 3, 4] + list(range(12, 21))
    assert active_days(subs, "u5") == []
    assert set(state(subs, "u6").values()) - {(False, None)} == {(True, "pro")}
    assert state(subs, "u6b")[day(2)] == (True, "pro")
    assert active_days(subs, "u7") == list(range(3, 21))
    assert state(subs, "u8")[day(10)] == (False, None)
    assert state(subs, "u3")[day(9)] == (True, "team")


def labels_of(subs, user):
    lab = M.gold_churn_labels_daily(subs).where(F.col("user_id") == user)
    return sorted((r["date_day"] - D0).days + 1 for r in lab.collect() if r["churn_7d"] == 1)


def test_labels(subs):
    assert labels_of(subs, "u1") == [20]          # no future rows counts as inactive
    assert labels_of(subs, "u2") == [4]
    assert labels_of(subs, "u3") == [20]          # day 4: active again on day 9
    assert labels_of(subs, "u4") == [4, 20]       # days 5-11 inactive (exactly 7)
    assert labels_of(subs, "u5") == []
    assert labels_of(subs, "u8") == []


def stg_events(spark, rows):
    return spark.createDataFrame(
        [(f"e{i}", dt.datetime.combine(day(d), dt.time(12)), u, s, t, late)
         for i, (d, u, s, t, late) in enumerate(rows)],
        "event_id string, event_ts timestamp, user_id string, session_id string, "
        "event_type string, is_late boolean")


def test_features_windows_and_defaults(spark, subs):
    # user u1: events 0, 6, 7, 13 and 14 days before day 20 (days 20, 14, 13, 7, 6)
    ev = stg_events(spark, [
        (20, "u1", "s1", "feature_use", True), (14, "u1", "s2", "support_ticket", False),
        (13, "u1", "s3", "support_ticket", False), (7, "u1", "s4", "support_ticket", False),
        (6, "u1", "s5", "support_ticket", False), (20, "u1", "s1", "login", False),
        (20, None, "s9", "login", False),                  # no user: ignored
        (20, "ghost", "s1", "login", False)])              # events but no billing: absent
    f = M.gold_user_features_daily(subs, ev, horizon=0)
    r = f.where((F.col("user_id") == "u1") & (F.col("date_day") == day(20))).first()
    assert (r["events_7d"], r["sessions_7d"], r["feature_use_7d"]) == (3, 2, 1)
    assert r["support_tickets_14d"] == 3                   # 6, 7, 13 days before in; 14 out
    assert r["late_rate_7d"] == pytest.approx(1 / 3)
    z = f.where((F.col("user_id") == "u2") & (F.col("date_day") == day(20))).first()
    assert (z["events_7d"], z["sessions_7d"], z["late_rate_7d"], z["plan_id"]) == (0, 0, 0.0, "free")
    assert f.where(F.col("user_id") == "ghost").count() == 0
    # default horizon removes the last 7 days
    g = M.gold_user_features_daily(subs, ev)
    assert g.agg(F.max("date_day")).first()[0] == day(13)
    by_plan = M.gold_churn_by_plan_daily(g).where(F.col("date_day") == day(4)).collect()
    pro = [x for x in by_plan if x["plan_id"] == "pro"][0]
    assert (pro["users"], pro["churners"], pro["churn_rate_pct"]) == (5, 2, 40.0)  # u2 u3 u4 u6 u6b


def test_billing_daily_keeps_zero_rows(spark):
    b = stg_billing(spark, [(1, "a", "start", "pro"), (1, "a", "start", "pro"),
                            (1, "b", "cancel", "team")])
    got = {(r["plan_id"]): (r["starts"], r["new_paid_users"]) for r in M.fct_billing_daily(b).collect()}
    assert got == {"pro": (2, 1), "team": (0, 0)}


def test_events_daily(spark):
    ev = stg_events(spark, [(1, "a", "s", "x", True), (1, "a", "s", "x", False),
                            (1, None, "s", "x", False), (2, "b", "s", "x", False)])
    got = {r["date_day"]: (r["events"], r["dau"], r["late_events"])
           for r in M.fct_events_daily(ev).collect()}
    assert got == {day(1): (3, 1, 1), day(2): (1, 1, 0)}


def test_build_writes_partitioned_layers(spark, tmpdir_path):
    from conftest import SF_SMALL
    from ledgerline.plans.lake import Lake, build
    lake = Lake(spark, SF_SMALL)
    paths = build(lake, tmpdir_path, ["events_quarantine", "silver_events", "fct_subscriptions_daily"])
    silver = spark.read.parquet(paths["silver_events"])
    assert silver.count() == lake.silver_events.count()
    assert "event_day" in silver.columns
    assert any(d.startswith("date_day=") for d in os.listdir(paths["fct_subscriptions_daily"]))


def test_layers_conform_to_declared_schemas(spark):
    from conftest import SF_SMALL
    from ledgerline.plans.lake import Lake
    from ledgerline.schemas import LAYER_SCHEMAS, conforms
    lake = Lake(spark, SF_SMALL)
    for name, schema in LAYER_SCHEMAS.items():
        assert conforms(getattr(lake, name), schema) == [], name
