"""Streaming ingest: JSONL folder source, repeat-safe micro-batches."""

import json
import os


from ledgerline.operators import silver as S
from ledgerline.streaming import incremental as STR


def write(path, name, recs):
    with open(os.path.join(path, name), "w") as fh:
        for r in recs:
            fh.write(json.dumps(r) + "\n")


def rec(eid, recv, user="u1"):
    return {"event_id": eid, "event_ts": "2024-01-01T10:00:00Z", "received_ts": recv,
            "user_id": user, "event_type": "login", "props": {"a": 1}}


def test_jsonl_stream_bronze_and_silver_upsert(spark, tmpdir_path):
    feed = os.path.join(tmpdir_path, "events")
    os.makedirs(feed)
    write(feed, "2024-01-01.jsonl", [rec("e1", "2024-01-01T10:00:00Z"), rec("e2", "2024-01-01T10:00:01Z")])
    base = os.path.join(tmpdir_path, "out")
    paths = STR.run_bronze_silver(spark, STR.jsonl_stream(spark, feed), base)
    # a later file redelivers e1 with a later arrival and a new user
    write(feed, "2024-01-02.jsonl", [rec("e1", "2024-01-01T12:00:00Z", user="u2"),
                                     {"event_id": None, "event_ts": None}])
    STR.run_bronze_silver(spark, STR.jsonl_stream(spark, feed), base)
    bronze = spark.read.parquet(paths["bronze"])
    silver = spark.read.parquet(paths["silver"])
    assert bronze.count() == 4
    assert {r["event_id"]: r["user_id"] for r in silver.collect()} == {"e1": "u2", "e2": "u1"}
    assert spark.read.parquet(paths["quarantine"]).count() == 1
    # the stream's silver equals the batch rule over the same bronze
    batch = S.silver_events(bronze).select("event_id", "bronze_row_hash")
    assert sorted(batch.collect()) == sorted(silver.select("event_id", "bronze_row_hash").collect())


def test_rerun_of_a_batch_appends_nothing(spark, tmpdir_path):
    lines = spark.createDataFrame([("events/a.jsonl", json.dumps(rec("e1", "2024-01-01T10:00:00Z")))],
                                  "source_file string, value string")
    base = os.path.join(tmpdir_path, "out")
    sink = STR.BronzeSilverSink(f"{base}/b", f"{base}/s", f"{base}/q")
    sink(lines, 0)
    sink(lines, 0)          # replayed micro-batch after a failure
    assert spark.read.parquet(f"{base}/b").count() == 1
    assert spark.read.parquet(f"{base}/s").count() == 1


def test_windowed_daily_stream(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    lines = spark.createDataFrame(
        [("f", json.dumps(rec(f"e{i}", "2024-01-01T10:00:00Z", user=f"u{i % 3}"))) for i in range(6)],
        "source_file string, value string")
    STR.land(lines, landing)
    out = STR.run_events_daily(spark, STR.landing_stream(spark, landing), os.path.join(tmpdir_path, "x"))
    r = spark.read.parquet(out).first()
    assert (r["events"], r["dau_approx"], r["late_events"]) == (6, 3, 0)


def test_watermark_drops_data_older_than_tolerance(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    base = os.path.join(tmpdir_path, "x")

    def ev(eid, ts):
        return ("f", json.dumps({"event_id": eid, "event_ts": ts, "received_ts": ts,
                                 "user_id": "u", "event_type": "login"}))
    # first arrival, then a restart of the query from its checkpoint for the second
    STR.land(spark.createDataFrame([ev("a", "2024-01-02T12:00:00Z")], "source_file string, value string"),
             landing)
    STR.run_events_daily(spark, STR.landing_stream(spark, landing), base)
    STR.land(spark.createDataFrame([ev("b", "2024-01-02T11:00:00Z"),      # within 6 h: counted
                                    ev("c", "2024-01-01T10:00:00Z")],     # 26 h late: dropped
                                   "source_file string, value string"), landing)
    out = STR.run_events_daily(spark, STR.landing_stream(spark, landing), base)
    got = {r["date_day"].day: r["events"] for r in spark.read.parquet(out).collect()}
    assert got == {2: 2}


def test_silver_upsert_moves_an_event_to_another_day(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "out")
    sink = STR.BronzeSilverSink(f"{base}/b", f"{base}/s", f"{base}/q")

    def batch(ts, recv):
        r = {"event_id": "e1", "event_ts": ts, "received_ts": recv, "user_id": "u", "event_type": "t"}
        return spark.createDataFrame([("events/x.jsonl", json.dumps(r))], "source_file string, value string")
    sink(batch("2024-01-01T10:00:00Z", "2024-01-01T10:00:00Z"), 0)
    # a later delivery of e1 carries another event day: it wins, day 1 is emptied
    sink(batch("2024-01-03T10:00:00Z", "2024-01-03T11:00:00Z"), 1)
    silver = spark.read.parquet(f"{base}/s")
    assert [(r["event_id"], r["event_day"].day) for r in silver.collect()] == [("e1", 3)]


def test_exact_daily_facts_follow_silver(spark, tmpdir_path):
    from ledgerline.operators import marts as M
    base = os.path.join(tmpdir_path, "out")
    sink = STR.BronzeSilverSink(f"{base}/b", f"{base}/s", f"{base}/q", daily_path=f"{base}/d")

    def batch(*recs):
        return spark.createDataFrame([("events/x.jsonl", json.dumps(r)) for r in recs],
                                     "source_file string, value string")
    sink(batch(rec("e1", "2024-01-01T10:00:00Z"), rec("e2", "2024-01-01T10:30:00Z", user="u2")), 0)
    moved = {"event_id": "e2", "event_ts": "2024-01-02T10:00:00Z", "received_ts": "2024-01-02T11:00:00Z",
             "user_id": "u2", "event_type": "login"}
    sink(batch(moved), 1)
    got = sorted(tuple(r) for r in spark.read.parquet(f"{base}/d")
                 .select("date_day", "events", "dau", "late_events").collect())
    want = sorted(tuple(r) for r in M.fct_events_daily(spark.read.parquet(f"{base}/s")).collect())
    assert got == want and len(got) == 2


def test_replay_after_failure_between_steps_completes_silver_and_quarantine(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "out")
    sink = STR.BronzeSilverSink(f"{base}/b", f"{base}/s", f"{base}/q", daily_path=f"{base}/d")
    recs = [rec("e1", "2024-01-01T10:00:00Z"), {"event_id": None, "event_ts": None}]
    batch = spark.createDataFrame([("events/x.jsonl", json.dumps(r)) for r in recs],
                                  "source_file string, value string")
    from ledgerline.operators import bronze as B
    fresh = B.parse_event_lines(batch).dropDuplicates(["row_hash"])
    sink.append_bronze(spark, fresh)          # the first attempt dies after the bronze append
    sink(batch, 0)                            # replay of the micro-batch
    sink(batch, 0)                            # and once more
    assert spark.read.parquet(f"{base}/b").count() == 2
    assert spark.read.parquet(f"{base}/q").count() == 1
    assert [r["event_id"] for r in spark.read.parquet(f"{base}/s").collect()] == ["e1"]
    assert spark.read.parquet(f"{base}/d").first()["events"] == 1


def test_corrected_windows_equal_the_facts_for_any_grouping_of_files(spark, tmpdir_path):
    from ledgerline.operators import bronze as B
    from ledgerline.operators import marts as M

    def ev(eid, ts, recv=None, user="u"):
        return json.dumps({"event_id": eid, "event_ts": ts, "received_ts": recv or ts, "user_id": user, "event_type": "login"})
    files = [[ev("d1", "2024-01-01T12:00:00Z"), ev("d3", "2024-01-03T12:00:00Z")], [ev("d6", "2024-01-06T12:00:00Z", user="v")],
             [ev("d7", "2024-01-07T23:00:00Z"), ev("late1", "2024-01-01T10:00:00Z")],
             [ev("late2", "2024-01-03T10:00:00Z", "2024-01-08T00:00:00Z"), ev("d7", "2024-01-07T23:00:00Z", "2024-01-08T09:00:00Z"),
              ev("d6", "2024-01-05T01:00:00Z", "2024-01-08T00:00:00Z")]]
    landing = os.path.join(tmpdir_path, "landing")
    for i, lines in enumerate(files):
        STR.land(spark.createDataFrame([(f"events/{i}.jsonl", x) for x in lines], "source_file string, value string").coalesce(1), landing)
    feed = spark.read.parquet(landing)
    want = {r["date_day"].day: (r["events"], r["late_events"])
            for r in M.fct_events_daily(S.silver_events(B.parse_event_lines(feed).dropDuplicates(["row_hash"]))).collect()}
    lost = []
    for n in (1, 2, 4, None):
        base = os.path.join(tmpdir_path, f"out{n}")
        out = STR.run_events_daily_corrected(spark, STR.landing_stream(spark, landing, n), base)
        rows = out.collect()
        assert {r["date_day"].day: (r["events"], r["late_events"]) for r in rows} == want and len(rows) == len(want)
        lost.append(sum(r["events"] for r in spark.read.parquet(f"{base}/events_daily_stream").collect()))
    assert lost[0] < sum(n for n, _ in want.values())  # the window alone drops rows


def test_a_batch_leaves_no_scratch_tables_and_no_checkpoints(spark, tmpdir_path, monkeypatch):
    from pyspark.sql import DataFrame

    from ledgerline.streaming.incremental import BronzeSilverSink

    def refused(*_, **__):
        raise AssertionError("whole rows are not checkpointed")
    rows = [(f"events/2024-01-0{d}.jsonl", f'{{"event_id": "e{d}", "event_ts": "2024-01-0{d}T00:00:00Z", "received_ts": "2024-01-0{d}T00:00:01Z",'
             f' "event_type": "login", "user_id": "u"}}') for d in (1, 2, 2)]
    sink = BronzeSilverSink(*(f"{tmpdir_path}/{t}" for t in ("bronze", "silver", "quarantine")), daily_path=f"{tmpdir_path}/daily")
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", refused)
    sink(spark.createDataFrame(rows, "source_file string, value string"), 0)
    assert spark.read.parquet(f"{tmpdir_path}/silver").count() == spark.read.parquet(f"{tmpdir_path}/bronze").count() == 2
    seen = []
    keep = sink.keep
    monkeypatch.setattr(sink, "keep", lambda df, name: seen.append(sink.scratch) or keep(df, name))
    sink(spark.createDataFrame(rows, "source_file string, value string"), 1)
    assert len(seen) == 3 and not any(os.path.exists(s.removeprefix("file:")) for s in seen)
    assert isinstance(spark.range(1), DataFrame)
