"""Command line: the operational steps of the pipeline as Spark jobs.

    python -m ledgerline load-events  --events-dir D  --bronze T [--glob G] [--limit-files N]
    python -m ledgerline load-billing --billing-dir D --bronze T [--glob G] [--limit-files N] [--empty-as-null]
    python -m ledgerline silver  --bronze-events T --bronze-billing T --out DIR
    python -m ledgerline marts   --silver DIR --out DIR
    python -m ledgerline test    --marts DIR --bronze-events T --bronze-billing T
    python -m ledgerline train   --marts DIR --reports DIR

``--cluster-conf`` (before the step name) applies the production-scale
settings of ``session.CLUSTER_CONF``.

Tables are Parquet folders.  Loads append repeat-safely (a re-run adds
nothing); silver and marts are full refreshes; ``test`` exits non-zero when a
check fails; ``train`` writes the fold table, the two CV summaries, the
coefficients and the final-fit statistics as CSV / JSON.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys


from pyspark.sql import functions as F

from ledgerline.operators import bronze as B
from ledgerline.operators import marts as M
from ledgerline.operators import quality as Q
from ledgerline.operators import silver as S
from ledgerline.operators import staging as G
from ledgerline.plans import churn as C
from ledgerline.session import apply_cluster_conf, checkpoint_dir, get_spark
from ledgerline.sources import files, sinks


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def _existing(spark, path):
    return spark.read.parquet(path) if sinks.table_exists(spark, path) else None


def _load(spark, parsed, bronze: str) -> None:
    """Report a parsed (checkpointed) batch against the table at ``bronze``, then append
    what is new; of the table only the batch's files are read."""
    existing, names = _existing(spark, bronze), B.batch_files(parsed)
    rows = B.load_report(parsed, existing, names).orderBy("source_file").collect()   # one row per file
    for r in rows:
        print(f"  {r['source_file']}: {r['records_read']} records, {r['inserted_rows']} new")
    print(f"loaded {len(rows)} file(s): {sum(r['records_read'] for r in rows)} records, "
          f"{sum(r['insert_attempts'] for r in rows)} attempted, "
          f"{sum(r['inserted_rows'] for r in rows)} new")
    sinks.append_by(B.append_new(parsed, existing, names), bronze, "source_file")


def load_events(spark, a) -> None:
    checkpoint_dir(spark)
    lines = files.scan_jsonl(spark, a.events_dir, a.glob, a.limit_files)
    parsed = B.parse_event_lines(lines, a.ingestion_ts or _now(), a.mode).checkpoint(eager=True)
    _load(spark, parsed, a.bronze)


def load_billing(spark, a) -> None:
    checkpoint_dir(spark)
    rows = files.scan_billing_csv(spark, a.billing_dir, a.glob, a.limit_files)
    parsed = B.parse_billing_rows(rows, a.ingestion_ts or _now(), a.empty_as_null, a.mode) \
        .checkpoint(eager=True)
    _load(spark, parsed, a.bronze)


def silver(spark, a) -> None:
    for kind, src in (("events", a.bronze_events), ("billing", a.bronze_billing)):
        bronze = spark.read.parquet(src)
        name = "silver_events" if kind == "events" else "silver_billing"
        n_s, n_q = S.refresh(spark, bronze, f"{a.out}/{name}", f"{a.out}/{name}_quarantine", kind)
        print(f"{name}: {n_s} rows kept, {n_q} quarantined")


def marts(spark, a) -> None:
    stg_e = G.stg_events(spark.read.parquet(f"{a.silver}/silver_events"))
    stg_b = G.stg_billing(spark.read.parquet(f"{a.silver}/silver_billing"))
    bounds = M.billing_bounds_literal(stg_b)
    out = a.out
    M.fct_events_daily(stg_e).write.mode("overwrite").parquet(f"{out}/fct_events_daily")
    M.fct_billing_daily(stg_b).write.mode("overwrite").parquet(f"{out}/fct_billing_daily")
    M.fct_subscriptions_daily(stg_b, bounds).write.mode("overwrite").partitionBy("date_day") \
        .parquet(f"{out}/fct_subscriptions_daily")
    subs = spark.read.parquet(f"{out}/fct_subscriptions_daily")
    M.gold_churn_labels_daily(subs).write.mode("overwrite").partitionBy("date_day") \
        .parquet(f"{out}/gold_churn_labels_daily")
    M.gold_user_features_daily(subs, stg_e, last_day=bounds[1]).write.mode("overwrite") \
        .partitionBy("date_day").parquet(f"{out}/gold_user_features_daily")
    feats = spark.read.parquet(f"{out}/gold_user_features_daily")
    M.gold_churn_by_plan_daily(feats).write.mode("overwrite").parquet(f"{out}/gold_churn_by_plan_daily")
    print(f"marts are in {out}")


def test(spark, a) -> int:
    models = {m: spark.read.parquet(f"{a.marts}/{m}") for m in Q.NOT_NULL}
    bronze = {"bronze_events": spark.read.parquet(a.bronze_events),
              "bronze_billing": spark.read.parquet(a.bronze_billing)}
    rows = Q.report(models, bronze).collect()          # one row per check
    for r in rows:
        print(f"{r['status'].upper():4} {r['check']} {r['model']}.{r['column_name']} "
              f"violations={r['violations']}")
    failed = sum(r["status"] == "fail" for r in rows)
    print(f"{len(rows)} checks, {failed} failed")
    return 1 if failed else 0


def train(spark, a) -> None:
    cfg = C.WalkForwardConfig()
    frame = C.stable_frame(C.training_frame(spark.read.parquet(f"{a.marts}/gold_user_features_daily")))
    prof = C.frame_profile(frame).first()                 # one row
    print(f"frame: {prof['n_rows']} rows of {prof['n_cols']} columns, {prof['min_day']} to {prof['max_day']}, "
          f"{prof['n_churn_1']} churned and {prof['n_churn_0']} not")
    print("null values:", {k.removeprefix("nulls_"): v for k, v in prof.asDict().items() if k.startswith("nulls_")})
    folds = C.cv_run(frame, cfg).checkpoint(eager=True)
    print("latest folds:")
    for r in folds.orderBy(F.col("test_day").desc()).limit(10).orderBy("test_day").collect():
        print(f"  {r['test_day']} rows={r['rows_test']} positives={r['positives_test']} "
              f"skipped={r['skipped']} pr_auc={r['pr_auc']} roc_auc={r['roc_auc']}")
    sinks.write_report_csv(folds.orderBy("test_day"), f"{a.reports}/churn_temporal_cv_folds")
    sinks.write_report_json(C.cv_summary(folds, frame, cfg), f"{a.reports}/churn_temporal_cv_summary")
    sinks.write_report_json(C.cv_summary_pop(folds), f"{a.reports}/churn_temporal_cv_summary_pop")
    coefs = C.model_coefficients(frame, cfg)
    sinks.write_report_csv(coefs, f"{a.reports}/churn_coefficients")
    print("largest coefficients:")
    for r in coefs.orderBy(F.col("coef").desc()).limit(25).collect():
        print(f"  {r['feature']:>24} {r['coef']: .6f}")
    sinks.write_report_json(C.final_fit_stats(frame, cfg), f"{a.reports}/churn_final_fit")
    print(f"reports are in {a.reports}")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ledgerline")
    p.add_argument("--master", default=None)
    p.add_argument("--cluster-conf", action="store_true",
                   help="apply the production-scale settings (session.CLUSTER_CONF)")
    sub = p.add_subparsers(dest="cmd", required=True)
    le = sub.add_parser("load-events")
    le.add_argument("--events-dir", required=True)
    le.add_argument("--glob", default="*.jsonl")
    le.add_argument("--limit-files", type=int, default=0)
    le.add_argument("--bronze", required=True)
    le.add_argument("--ingestion-ts", default=None)
    le.add_argument("--mode", choices=["failfast", "permissive"], default="failfast")
    lb = sub.add_parser("load-billing")
    lb.add_argument("--billing-dir", required=True)
    lb.add_argument("--glob", default="*.csv")
    lb.add_argument("--limit-files", type=int, default=0)
    lb.add_argument("--bronze", required=True)
    lb.add_argument("--ingestion-ts", default=None)
    lb.add_argument("--empty-as-null", action="store_true")
    lb.add_argument("--mode", choices=["failfast", "permissive"], default="failfast")
    sv = sub.add_parser("silver")
    sv.add_argument("--bronze-events", required=True)
    sv.add_argument("--bronze-billing", required=True)
    sv.add_argument("--out", required=True)
    mk = sub.add_parser("marts")
    mk.add_argument("--silver", required=True)
    mk.add_argument("--out", required=True)
    ts = sub.add_parser("test")
    ts.add_argument("--marts", required=True)
    ts.add_argument("--bronze-events", required=True)
    ts.add_argument("--bronze-billing", required=True)
    tr = sub.add_parser("train")
    tr.add_argument("--marts", required=True)
    tr.add_argument("--reports", required=True)
    a = p.parse_args(argv)
    spark = get_spark(a.master)
    if a.cluster_conf:
        apply_cluster_conf(spark)
    steps = {"load-events": load_events, "load-billing": load_billing, "silver": silver,
             "marts": marts, "test": test, "train": train}
    rc = steps[a.cmd](spark, a)
    return int(rc or 0)


if __name__ == "__main__":
    sys.exit(main())
