"""Loads that read only their files' partitions, and refreshes that switch whole tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import bronze as B
from ledgerline.operators import monitor as MON
from ledgerline.operators import silver as S
from ledgerline.sources import sinks
from tests.test_ingest import lines, rec


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def partition_filters(df):
    return [line for line in plan(df).splitlines() if "PartitionFilters: [" in line
            and "source_file" in line.split("PartitionFilters: [")[1].split("]")[0]]


def feed(spark, n):
    return lines(spark, [(f"events/{i}.jsonl", rec(event_id=f"e{i}")) for i in range(n)])


def test_checkpointed_batch_prunes_the_stored_table(spark, tmpdir_path):
    path = f"{tmpdir_path}/bronze"
    sinks.append_by(B.load_bronze_events(feed(spark, 6)), path, "source_file")
    batch = B.parse_event_lines(feed(spark, 8).where("source_file >= 'events/4.jsonl'")).checkpoint(eager=True)
    stored, names = spark.read.parquet(path), B.batch_files(batch)
    assert sorted(names) == [f"events/{i}.jsonl" for i in (4, 5, 6, 7)]
    new = B.append_new(batch, stored, names)
    assert partition_filters(new) and partition_filters(B.load_report(batch, stored, names))
    assert sorted(r["event_id"] for r in new.collect()) == ["e6", "e7"]
    for files in (names, None):
        report = {r["source_file"]: r["inserted_rows"] for r in B.load_report(batch, stored, files).collect()}
        assert report == {"events/4.jsonl": 0, "events/5.jsonl": 0, "events/6.jsonl": 1, "events/7.jsonl": 1}


def test_file_lists_longer_than_one_filter(spark, monkeypatch):
    monkeypatch.setattr(B, "FILES_PER_FILTER", 2)
    table = spark.createDataFrame([(f"f{i}", str(i)) for i in range(6)], "source_file string, row_hash string")
    assert sorted(r[1] for r in B.of_files(table, ["f0", "f2", "f3", "f5", "f5", "nowhere"]).collect()) == list("0235")
    assert B.of_files(table, []).count() == 0


def test_stored_repeats_do_not_change_the_report(spark):
    batch = B.parse_event_lines(lines(spark, [("a", rec(event_id="e1")), ("a", rec(event_id="e1")), ("a", rec(event_id="e2"))]))
    stored = B.parse_event_lines(lines(spark, [("a", rec(event_id="e1"))] * 2 + [("b", rec(event_id="e2"))]))
    row = B.load_report(batch, stored).collect()
    assert [tuple(r) for r in row] == [("a", 3, 3, 1)]


def test_failed_refresh_leaves_the_old_tables(spark, tmpdir_path, monkeypatch):
    s, q = f"{tmpdir_path}/s", f"{tmpdir_path}/q"
    first = B.load_bronze_events(lines(spark, [("f", rec(event_id="e1")), ("f", rec(event_id="e1", user_id="u2")), ("f", rec(event_id=None))]))
    assert S.refresh(spark, first, s, q) == (1, 1)
    assert S.check_counts(first, 1, 1) == 1                    # one repeated row
    more = B.load_bronze_events(lines(spark, [("f", rec(event_id=f"e{i}")) for i in range(3)]))
    whole = S.silver_events
    monkeypatch.setattr(S, "silver_events", lambda bronze: whole(bronze).where("event_id <> 'e2'"))
    with pytest.raises(S.RefreshMismatch):
        S.refresh(spark, more, s, q)
    assert (spark.read.parquet(s).count(), spark.read.parquet(q).count()) == (1, 1)
    monkeypatch.undo()
    assert S.refresh(spark, more, s, q) == (3, 0)
    assert sorted(os.listdir(tmpdir_path)) == ["q", "s"]        # nothing of a run is left
    assert spark.read.parquet(q).columns[0] == "bronze_row_hash"


def test_billing_refresh_counts(spark, tmpdir_path):
    raw = spark.createDataFrame([("f", "2024-01-01", "u", "start", "pro"), ("f", "2024-01-01", "u", "gift", "pro")],
                                "source_file string, billing_date string, user_id string, event string, plan_id string")
    assert S.refresh(spark, B.load_bronze_billing(raw), f"{tmpdir_path}/s", f"{tmpdir_path}/q", "billing") == (1, 1)


def test_refresh_switches_catalog_tables(spark, tmpdir_path):
    tables = ("upkeep_silver", "upkeep_quarantine")
    try:
        for n in (1, 2):
            bronze = B.load_bronze_events(lines(spark, [("f", rec(event_id=f"e{i}")) for i in range(n)]))
            assert S.refresh(spark, bronze, f"{tmpdir_path}/s", f"{tmpdir_path}/q", tables=tables) == (n, 0)
            assert spark.table("upkeep_silver").count() == n
    finally:
        for t in tables:
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_feed_bounds_need_no_mart(spark):
    from conftest import SF_SMALL
    from ledgerline.plans.lake import Lake
    lake = Lake(spark, SF_SMALL)
    cheap = MON.feed_bounds(lake.stg_events, lake.stg_billing)
    assert cheap.first() == MON.date_bounds(lake.fct_events_daily, lake.fct_billing_daily, lake.fct_subscriptions_daily).first()
    ranged = plan(MON.events_daily_range(lake.fct_events_daily, *lake.day_bounds))
    assert "sequence(" not in ranged and ranged.count("FileScan") <= 3


def test_active_rows_are_the_grid(spark):
    day = dt.date(2024, 1, 1)
    subs = spark.createDataFrame([(day, "u", True), (day, "v", False), (day + dt.timedelta(1), "u", True)],
                                 "date_day date, user_id string, is_active boolean")
    assert sorted(tuple(r) for r in MON.active_subs_rows(subs, F.lit(day), F.lit(day)).collect()) == [(day, False), (day, True)]


def test_second_load_reads_the_stored_first_one(spark):
    """The lines are parsed once a load, and the load looks only at its files' rows."""
    from conftest import SF_SMALL
    from ledgerline.plans.catalog import QUERIES
    plan = QUERIES["bronze_events_load"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("digests(") == 1 and "LeftSemi" not in plan


def test_report_builds_each_layer_once(spark, monkeypatch):
    from conftest import SF_SMALL
    from ledgerline.plans.catalog import QUERIES
    plan = QUERIES["dq_report"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "digests(" not in plan and "sha2" not in plan
