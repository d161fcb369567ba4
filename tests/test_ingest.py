"""Bronze and silver on hand-made edge lines (FIXTURES.md 1-4)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import bronze as B
from ledgerline.operators import silver as S
from ledgerline.sources.files import NoInputFiles, scan_billing_csv, scan_jsonl


def rec(**kw):
    base = {"event_id": "evt_1", "event_ts": "2024-01-01T00:00:00Z",
            "received_ts": "2024-01-01T00:00:00Z", "user_id": "usr_00001",
            "device_id": "dev_1", "session_id": "sess_1", "event_type": "login",
            "props": {"channel": "web", "country": "DE"}}
    base.update(kw)
    return {k: v for k, v in base.items() if v is not ...}


def lines(spark, items):
    return spark.createDataFrame([(f, json.dumps(r) if isinstance(r, dict) else r) for f, r in items],
                                 "source_file string, value string")


def test_missing_keys_are_null_and_falsy_props_empty(spark):
    df = B.parse_event_lines(lines(spark, [
        ("events/a.jsonl", rec(event_id="e1", user_id=..., props=...)),
        ("events/a.jsonl", rec(event_id="e2", props=None)),
        ("events/a.jsonl", rec(event_id="e3", props={})),
        ("events/a.jsonl", rec(event_id="e4", props={"ui_variant": None})),
    ])).orderBy("event_id").collect()
    assert df[0]["user_id"] is None and df[0]["props"] == "{}"
    assert df[1]["props"] == "{}" and df[2]["props"] == "{}"
    assert df[3]["props"] == '{"ui_variant":null}'


def test_hash_is_key_order_and_blank_insensitive_but_file_sensitive(spark):
    a = '{"event_id": "e1", "user_id": "ü", "props": {"b": 1, "a": 2}}'
    b = '{"props":{"a":2,"b":1},"user_id":"ü","event_id":"e1"}'
    df = B.parse_event_lines(lines(spark, [("events/a.jsonl", a), ("events/a.jsonl", b),
                                           ("events/b.jsonl", a)]))
    hashes = [r["row_hash"] for r in df.collect()]
    assert hashes[0] == hashes[1] != hashes[2]
    import hashlib
    canon = json.dumps(json.loads(a), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert hashes[0] == hashlib.sha256(("events/a.jsonl|" + canon).encode()).hexdigest()


def test_timestamps_z_offset_and_zoneless(spark):
    df = B.parse_event_lines(lines(spark, [
        ("f", rec(event_id="z", event_ts="2024-01-01T23:59:59Z")),
        ("f", rec(event_id="o", event_ts="2024-01-02T01:00:00+02:00")),
        ("f", rec(event_id="n", event_ts="2024-01-02T00:00:00")),
    ])).select("event_id", F.col("event_ts").cast("string").alias("t")).orderBy("event_id").collect()
    assert {r["event_id"]: r["t"] for r in df} == {
        "n": "2024-01-02 00:00:00", "o": "2024-01-01 23:00:00", "z": "2024-01-01 23:59:59"}


def test_malformed_fails_fast_or_quarantines(spark):
    bad = lines(spark, [("f", "{not json"), ("f", json.dumps(rec(event_id="e9", event_ts="yesterday")))])
    with pytest.raises(Exception):
        B.parse_event_lines(bad).collect()
    parsed = B.parse_event_lines(bad, mode="permissive")
    q = S.events_quarantine(parsed).select("reason_code").collect()
    assert sorted(r[0] for r in q) == ["missing_event_id", "missing_event_ts"]


def test_load_twice_equals_load_once_and_repeats_in_file_drop(spark):
    feed = lines(spark, [("events/a.jsonl", rec(event_id="e1")), ("events/a.jsonl", rec(event_id="e1")),
                         ("events/b.jsonl", rec(event_id="e1"))])
    first = B.load_bronze_events(feed)
    assert first.count() == 2                       # repeat in one file dropped
    again = B.load_bronze_events(feed, existing=first)
    assert again.count() == 0                       # re-run appends nothing
    report = {r["source_file"]: r for r in B.load_report(B.parse_event_lines(feed), first).collect()}
    assert report["events/a.jsonl"]["records_read"] == 2
    assert report["events/a.jsonl"]["insert_attempts"] == 2
    assert report["events/a.jsonl"]["inserted_rows"] == 0


def test_quarantine_reasons_first_failure_wins_and_split_is_complete(spark):
    feed = lines(spark, [
        ("f", rec(event_id=None, event_ts=None, received_ts=None, event_type=None)),
        ("f", rec(event_id="e2", event_ts=None, event_type=None)),
        ("f", rec(event_id="e3", received_ts=None)),
        ("f", rec(event_id="e4", event_type=None)),
        ("f", rec(event_id="e5", user_id=None)),
    ])
    bronze = B.load_bronze_events(feed)
    q = S.events_quarantine(bronze)
    reasons = sorted(r["reason_code"] for r in q.collect())
    assert reasons == ["missing_event_id", "missing_event_ts", "missing_event_type",
                       "missing_received_ts"]
    assert q.count() + S.valid_events(bronze).count() == bronze.count()
    raw = json.loads(q.where("reason_code = 'missing_event_type'").first()["raw_record"])
    assert raw["event_type"] is None and raw["event_id"] == "e4" and "row_hash" in raw
    assert S.silver_events(bronze).first()["user_id"] is None   # null user is valid


def test_dedup_latest_arrival_then_ingestion_then_hash(spark):
    feed = lines(spark, [
        ("a", rec(event_id="e1", received_ts="2024-01-01T00:00:05Z", user_id="first")),
        ("b", rec(event_id="e1", received_ts="2024-01-01T00:10:00Z", user_id="latest")),
        ("a", rec(event_id="e2", props={"v": 1})),
        ("a", rec(event_id="e2", props={"v": 2})),
    ])
    bronze = B.load_bronze_events(feed)
    silver = {r["event_id"]: r for r in S.silver_events(bronze).collect()}
    assert silver["e1"]["user_id"] == "latest"
    tied = sorted(r["row_hash"] for r in bronze.where("event_id = 'e2'").collect())
    assert silver["e2"]["bronze_row_hash"] == tied[0]
    # a later ingestion wins over an earlier one with the same arrival
    late_load = B.load_bronze_events(lines(spark, [("c", rec(event_id="e2", props={"v": 3}))]),
                                     ingestion_ts="2024-03-01 00:00:00")
    s2 = S.silver_events(bronze.unionByName(late_load)).where("event_id = 'e2'").first()
    assert s2["props"] == '{"v":3}'


@pytest.mark.parametrize("delta,expected,late", [
    ("2024-01-01T00:00:00.400Z", 0, False), ("2024-01-01T00:00:00.600Z", 1, True),
    ("2023-12-31T23:59:55Z", 0, False), ("2024-01-01T06:00:00Z", 21600, True)])
def test_lateness_rounds_half_away_and_clamps(spark, delta, expected, late):
    bronze = B.load_bronze_events(lines(spark, [("f", rec(received_ts=delta))]))
    r = S.silver_events(bronze).first()
    assert (r["lateness_sec"], r["is_late"]) == (expected, late)


def billing(spark, rows):
    return spark.createDataFrame(rows, "source_file string, billing_date string, user_id string, "
                                       "event string, plan_id string")


def test_billing_hash_trims_and_stores_raw(spark):
    df = B.parse_billing_rows(billing(spark, [
        ("billing/a.csv", " 2024-01-05 ", "usr_1 ", "start", "pro"),
        ("billing/a.csv", "2024-01-05", "usr_1", "start", "pro")]))
    r = df.collect()
    assert r[0]["row_hash"] == r[1]["row_hash"]
    assert r[0]["user_id"] == "usr_1 " and str(r[0]["billing_date"]) == "2024-01-05"
    import hashlib
    payload = "billing/a.csv|billing_date=2024-01-05|user_id=usr_1|event=start|plan_id=pro"
    assert r[0]["row_hash"] == hashlib.sha256(payload.encode()).hexdigest()


def test_billing_quarantine_reasons_and_empty_fields(spark):
    rows = billing(spark, [
        ("f", "2024-01-01", "u1", "refund", "pro"),
        ("f", "2024-01-01", "u2", "start", None),
        ("f", "2024-01-01", None, "start", "pro"),
        ("f", "2024-01-01", "u3", None, None),
        ("f", "2024-01-01", "u4", "cancel", "basic")])
    strict = B.load_bronze_billing(rows, empty_as_null=True)
    reasons = sorted(r["reason_code"] for r in S.billing_quarantine(strict).collect())
    assert reasons == ["invalid_event", "missing_event", "missing_plan_id", "missing_user_id"]
    assert S.silver_billing(strict).count() + len(reasons) == strict.count()
    # default: empty fields are kept as '' like the source loader; only the
    # empty event fails (as an invalid event)
    lenient = B.load_bronze_billing(rows)
    reasons = sorted(r["reason_code"] for r in S.billing_quarantine(lenient).collect())
    assert reasons == ["invalid_event", "invalid_event"]
    # direct bronze row with a null date
    direct = strict.limit(1).withColumn("billing_date", F.lit(None).cast("date"))
    assert S.billing_quarantine(direct).first()["reason_code"] == "missing_billing_date"


def test_file_scans(spark, tmpdir_path):
    ev = os.path.join(tmpdir_path, "events")
    os.makedirs(ev)
    for day, body in [("2024-01-02", '{"event_id":"b"}\n\n  \n\t\n\u00a0\n'),
                      ("2024-01-01", '{"event_id":"a"}\n{"event_id":"a2"}\n')]:
        with open(os.path.join(ev, f"{day}.jsonl"), "w") as fh:
            fh.write(body)
    with open(os.path.join(ev, "notes.txt"), "w") as fh:
        fh.write("ignored\n")
    got = sorted((r["source_file"], r["value"]) for r in scan_jsonl(spark, ev).collect())
    assert got == [("events/2024-01-01.jsonl", '{"event_id":"a"}'),
                   ("events/2024-01-01.jsonl", '{"event_id":"a2"}'),
                   ("events/2024-01-02.jsonl", '{"event_id":"b"}')]
    first = scan_jsonl(spark, ev, limit_files=1).select("source_file").distinct().collect()
    assert [r[0] for r in first] == ["events/2024-01-01.jsonl"]
    lines = scan_jsonl(spark, ev)
    assert [r[0] for r in B.limit_files(lines, 1).select("source_file").distinct().collect()] \
        == ["events/2024-01-01.jsonl"]
    assert B.limit_files(lines, 0).count() == 3
    with pytest.raises(NoInputFiles):
        scan_jsonl(spark, ev, glob="*.json")
    with pytest.raises(Exception):
        scan_jsonl(spark, os.path.join(tmpdir_path, "missing"))
    bl = os.path.join(tmpdir_path, "billing")
    os.makedirs(bl)
    with open(os.path.join(bl, "2024-01-01.csv"), "w") as fh:
        fh.write("billing_date,user_id,event,plan_id\n 2024-01-01,usr_1,start,pro\n2024-01-01,usr_2,cancel,\n")
    with open(os.path.join(bl, "2024-01-02.csv"), "w") as fh:
        fh.write("billing_date,user_id,event,plan_id\n")
    rows = scan_billing_csv(spark, bl).orderBy("user_id").collect()
    assert [r["user_id"] for r in rows] == ["usr_1", "usr_2"]
    assert rows[0]["source_file"] == "billing/2024-01-01.csv"


def test_refresh_writes_quarantine_and_silver(spark, tmpdir_path):
    bronze = B.load_bronze_events(lines(spark, [("f", rec(event_id="e1")), ("f", rec(event_id=None))]))
    n_silver, n_quarantine = S.refresh(spark, bronze, os.path.join(tmpdir_path, "s"),
                                       os.path.join(tmpdir_path, "q"))
    assert (n_silver, n_quarantine) == (1, 1)
    # a second refresh replaces, not appends
    assert S.refresh(spark, bronze, os.path.join(tmpdir_path, "s"),
                     os.path.join(tmpdir_path, "q")) == (1, 1)


def test_day_boundary_in_daily_facts(spark):
    from ledgerline.operators import marts as M
    from ledgerline.operators import staging as G
    bronze = B.load_bronze_events(lines(spark, [
        ("f", rec(event_id="late_night", event_ts="2024-01-01T23:59:59Z", received_ts="2024-01-01T23:59:59Z")),
        ("f", rec(event_id="midnight", event_ts="2024-01-02T00:00:00Z", received_ts="2024-01-02T00:00:00Z"))]))
    daily = {r["date_day"].isoformat(): r["events"]
             for r in M.fct_events_daily(G.stg_events(S.silver_events(bronze))).collect()}
    assert daily == {"2024-01-01": 1, "2024-01-02": 1}


def test_landed_files_scan_back(spark, tmpdir_path):
    from ledgerline.sources.landing import land_billing_files, land_event_files
    lines = [("events/day one.jsonl", '{"a": 1}'), ("events/day+two%.jsonl", '{"a": "x, y"}'), ("events/day one.jsonl", '{"a": 2}')]
    land_event_files(spark.createDataFrame(lines, "source_file string, value string"), f"{tmpdir_path}/in/events")
    assert sorted(tuple(r) for r in scan_jsonl(spark, f"{tmpdir_path}/in/events").collect()) == sorted(lines)
    assert sorted(os.listdir(f"{tmpdir_path}/in/events"))[-2:] == ["day one.jsonl", "day+two%.jsonl"]
    rows = [("billing/a b.csv", " 2024-01-01 ", 'u"1', "start,", None), ("billing/c.csv", "2024-01-02", "", "cancel", "pro")]
    empty_is_null = [tuple(None if v == "" else v for v in r) for r in rows]
    land_billing_files(spark.createDataFrame(rows, "source_file string, billing_date string, user_id string, event string, plan_id string"),
                       f"{tmpdir_path}/in/billing")
    assert sorted(tuple(r) for r in scan_billing_csv(spark, f"{tmpdir_path}/in/billing").collect()) == empty_is_null
