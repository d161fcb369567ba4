"""Loads lose nothing and repeat safely: malformed lines, unreadable tables, re-landed
lines, row order of equal hashes, file names with blanks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import bronze as B
from ledgerline.operators import silver as S
from ledgerline.sources import files, sinks
from ledgerline.streaming.incremental import BronzeSilverSink

BAD = ["{not json", '{"a": 1', "]["]


def lines(spark, values, name="events/d.jsonl"):
    return spark.createDataFrame([(name, v) for v in values], "source_file string, value string")


def event(i, user="u"):
    return json.dumps({"event_id": i, "event_ts": "2024-01-05T00:00:00Z", "received_ts": "2024-01-05T00:00:01Z",
                       "user_id": user, "event_type": "login", "props": {}})


def test_every_malformed_line_is_kept_once(spark):
    batch = lines(spark, [event("e1"), *BAD, BAD[0]])
    stored = B.load_bronze_events(batch, mode="permissive").checkpoint()
    assert stored.count() == 4 and stored.where("row_hash is null").count() == 0
    records = [r.raw_record for r in S.events_quarantine(stored).collect()]
    assert sorted(json.loads(r)["props"][B.RAW_LINE_KEY] for r in records) == sorted(BAD)
    assert B.load_bronze_events(batch, stored, mode="permissive").count() == 0


def test_billing_winner_does_not_depend_on_row_order(spark):
    rows = [("billing/b.csv", "2024-01-05", u, "start", "pro") for u in ("u1 ", "u1")]
    schema = "source_file string, billing_date string, user_id string, event string, plan_id string"
    for order in (rows, rows[::-1]):
        got = B.load_bronze_billing(spark.createDataFrame(order, schema).coalesce(1)).collect()
        assert [r.user_id for r in got] == ["u1"]


def test_unreadable_table_raises_and_changes_nothing(spark, tmpdir_path):
    base = f"{tmpdir_path}/t"
    assert not sinks.table_exists(spark, base)
    os.makedirs(base)
    with open(f"{base}/part-0.parquet", "w") as f:
        f.write("no parquet")
    assert sinks.table_exists(spark, base)
    sink = BronzeSilverSink(base, f"{tmpdir_path}/s", f"{tmpdir_path}/q")
    with pytest.raises(Exception):
        sink(lines(spark, [event("e1")]), 0)
    assert sorted(os.listdir(tmpdir_path)) == ["t"] and os.listdir(base) == ["part-0.parquet"]


def test_relanded_line_keeps_its_first_stamp_in_silver(spark, tmpdir_path):
    paths = [f"{tmpdir_path}/{n}" for n in ("b", "s", "q")]
    for stamp in ("2024-02-01 00:00:00", "2024-03-01 00:00:00"):
        BronzeSilverSink(*paths, ingestion_ts=stamp)(lines(spark, [event("e1")]), 0)
    bronze, silver = (spark.read.parquet(p) for p in paths[:2])
    batch = S.silver_events(bronze.select(*B.BRONZE_EVENT_COLUMNS))
    assert [tuple(r) for r in silver.select(*batch.columns).collect()] == [tuple(r) for r in batch.collect()]
    assert silver.select(F.date_format("ingestion_ts", "MM")).first()[0] == "02"


def test_file_names_with_blanks_and_plus_signs(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/events")
    for name in ("day one.jsonl", "day+two.jsonl"):
        with open(f"{tmpdir_path}/events/{name}", "w") as f:
            f.write(event(name) + "\n\n")
    got = {r.source_file for r in files.scan_jsonl(spark, f"{tmpdir_path}/events").collect()}
    assert got == {"events/day one.jsonl", "events/day+two.jsonl"}
    assert {r.source_file for r in files.scan_jsonl(spark, f"{tmpdir_path}/events", limit_files=1).collect()} == {"events/day one.jsonl"}
