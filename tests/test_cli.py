"""End to end through the command line on small feed folders."""

import datetime as dt
import json
import os
import random

from ledgerline.cli import main


def make_feeds(root):
    rnd = random.Random(5)
    ev_dir, bl_dir = os.path.join(root, "events"), os.path.join(root, "billing")
    os.makedirs(ev_dir)
    os.makedirs(bl_dir)
    d0 = dt.date(2024, 1, 1)
    for k in range(40):
        day = d0 + dt.timedelta(k)
        with open(os.path.join(ev_dir, f"{day}.jsonl"), "w") as fh:
            for i in range(30):
                ts = dt.datetime.combine(day, dt.time(rnd.randint(0, 23), rnd.randint(0, 59)))
                late = dt.timedelta(minutes=rnd.choice([0, 0, 0, 30]))
                rec = {"event_id": f"evt_{k}_{i}", "event_ts": ts.isoformat() + "Z",
                       "received_ts": (ts + late).isoformat() + "Z",
                       "user_id": f"usr_{rnd.randint(0, 19):05d}", "session_id": f"s{rnd.randint(0, 5)}",
                       "event_type": rnd.choice(["login", "feature_use", "support_ticket"]),
                       "props": {"channel": "web", **({"ui_variant": "A"} if k > 20 else {})}}
                fh.write(json.dumps(rec) + "\n")
        with open(os.path.join(bl_dir, f"{day}.csv"), "w") as fh:
            fh.write("billing_date,user_id,event,plan_id\n")
            for u in rnd.sample(range(20), 3):
                fh.write(f"{day},usr_{u:05d},{rnd.choice(['start', 'upgrade', 'cancel'])},"
                         f"{rnd.choice(['basic', 'pro', 'team'])}\n")
    return ev_dir, bl_dir


def test_pipeline_end_to_end(spark, tmpdir_path, capsys):
    ev_dir, bl_dir = make_feeds(os.path.join(tmpdir_path, "raw"))
    lake = os.path.join(tmpdir_path, "lake")
    be, bb = f"{lake}/bronze_events", f"{lake}/bronze_billing"
    assert main(["load-events", "--events-dir", ev_dir, "--bronze", be, "--limit-files", "10"]) == 0
    assert spark.read.parquet(be).count() == 300
    assert main(["load-events", "--events-dir", ev_dir, "--bronze", be]) == 0     # overlapping re-run
    assert main(["load-billing", "--billing-dir", bl_dir, "--bronze", bb]) == 0
    assert main(["load-billing", "--billing-dir", bl_dir, "--bronze", bb]) == 0
    assert spark.read.parquet(be).count() == 1200
    assert spark.read.parquet(bb).count() == 120
    assert main(["silver", "--bronze-events", be, "--bronze-billing", bb, "--out", lake]) == 0
    assert main(["marts", "--silver", lake, "--out", f"{lake}/marts"]) == 0
    assert main(["test", "--marts", f"{lake}/marts", "--bronze-events", be, "--bronze-billing", bb]) == 0
    out = capsys.readouterr().out
    assert " checks, 0 failed" in out and " 0 new" in out
    assert main(["train", "--marts", f"{lake}/marts", "--reports", f"{lake}/reports"]) == 0
    printed = capsys.readouterr().out
    assert "frame: " in printed and "latest folds:" in printed and "largest coefficients:" in printed
    folds = spark.read.option("header", "true").csv(f"{lake}/reports/churn_temporal_cv_folds")
    assert folds.count() == 40 - 7 - 7 - 21
    summary = spark.read.json(f"{lake}/reports/churn_temporal_cv_summary").first()
    assert summary["folds_total"] == folds.count()
    # 5 numeric + 4 plan levels (free, basic, pro, team) + intercept
    assert spark.read.option("header", "true").csv(f"{lake}/reports/churn_coefficients").count() == 10
