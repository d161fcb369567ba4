"""Churn modelling: metric edge cases, brute-force and monotone properties,
fold guard, and the fitted model against a direct solution."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions.stats import average_precision, ranking_metrics, roc_auc
from ledgerline.plans import churn as C


def scored(spark, rows):
    return spark.createDataFrame(rows, "fold int, score double, label int")


def metrics(spark, rows):
    df = scored(spark, rows)
    auc = {r["fold"]: r["roc_auc"] for r in roc_auc(df, "fold").collect()}
    ap = {r["fold"]: r["average_precision"] for r in average_precision(df, "fold").collect()}
    return auc, ap


def brute(rows):
    pos = [s for _, s, y in rows if y == 1]
    neg = [s for _, s, y in rows if y == 0]
    auc = (sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
           if pos and neg else None)
    ap = 0.0
    for t in sorted({s for _, s, _ in rows}, reverse=True):
        at = [y for _, s, y in rows if s == t]
        seen = [y for _, s, y in rows if s >= t]
        ap += sum(at) / len(pos) * (sum(seen) / len(seen)) if pos else 0
    return auc, (ap if pos else None)


def test_metric_edges(spark):
    tied = [(0, 0.5, 1), (0, 0.5, 0), (0, 0.5, 0), (0, 0.5, 0)]
    perfect = [(1, 0.9, 1), (1, 0.8, 1), (1, 0.1, 0)]
    only_pos = [(2, 0.3, 1), (2, 0.7, 1)]
    auc, ap = metrics(spark, tied + perfect + only_pos)
    assert auc[0] == 0.5 and ap[0] == pytest.approx(0.25)          # AP = prevalence
    assert auc[1] == 1.0 and ap[1] == 1.0
    assert auc[2] is None and ap[2] == 1.0


def test_metrics_of_one_group_over_many_ranges(spark):
    """One fold, ties at range borders: many ranges, few ranges and counted rows agree."""
    rnd = random.Random(9)
    rows = [(0, rnd.randint(0, 150) / 150, int(rnd.random() < 0.3)) for _ in range(600)]
    b_auc, b_ap = brute(rows)
    df = scored(spark, rows).repartition(7)
    counted = df.groupBy("fold", "score", "label").count()
    for got in (ranking_metrics(df, "fold", ranges=50), ranking_metrics(df, "fold", ranges=2),
                ranking_metrics(counted, "fold", rows="count")):
        r = got.first()
        assert r["roc_auc"] == pytest.approx(b_auc, abs=1e-12)
        assert r["average_precision"] == pytest.approx(b_ap, abs=1e-12)


@settings(max_examples=15, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 1)), min_size=2, max_size=40))
def test_metrics_equal_brute_force_and_ignore_monotone_transforms(spark, pairs):
    rows = [(0, float(s), y) for s, y in pairs]
    auc, ap = metrics(spark, rows)
    b_auc, b_ap = brute(rows)
    assert auc.get(0) == (pytest.approx(b_auc) if b_auc is not None else None)
    if b_ap is None:
        assert ap.get(0) is None
    else:
        assert ap[0] == pytest.approx(b_ap)
    auc2, ap2 = metrics(spark, [(0, 3.0 * s + 7.0, y) for _, s, y in rows])
    assert auc2.get(0) == auc.get(0) and ap2.get(0) == pytest.approx(ap.get(0)) if ap.get(0) else True


def frame(spark, n_days, users=30, seed=3):
    rnd = random.Random(seed)
    d0 = dt.date(2024, 1, 1)
    rows = []
    for d in range(n_days):
        for u in range(users):
            ev = rnd.randint(0, 12)
            churn = 1 if rnd.random() < (0.3 if ev < 3 else 0.03) else 0
            rows.append((d0 + dt.timedelta(d), f"u{u}", rnd.choice(["free", "pro", "team", None]),
                         ev, min(ev, rnd.randint(0, 5)), rnd.randint(0, ev), rnd.randint(0, 2),
                         rnd.random() if ev else 0.0, churn))
    return spark.createDataFrame(rows, "date_day date, user_id string, plan_id string, events_7d long, "
                                       "sessions_7d long, feature_use_7d long, support_tickets_14d long, "
                                       "late_rate_7d double, churn_7d int")


def test_fold_guard(spark):
    with pytest.raises(C.NotEnoughDays):
        C.check_eligible(C.training_frame(frame(spark, 28)))        # 21 eligible
    assert C.check_eligible(C.training_frame(frame(spark, 29))) == (29, 22)
    folds = C.cv_folds(C.training_frame(frame(spark, 29))).collect()
    assert len(folds) == 1 and folds[0]["rows_train"] == 21 * 30 and folds[0]["rows_test"] == 30


def test_fold_skip_and_rolling(spark):
    f = C.training_frame(frame(spark, 40, users=20))
    f = f.withColumn("churn_7d", F.when(F.col("date_day") == dt.date(2024, 1, 25), 0)
                     .otherwise(F.col("churn_7d")))
    table = C.rule_fold_table(f)
    skipped = table.where("skipped").collect()
    assert dt.date(2024, 1, 25) in [r["test_day"] for r in skipped]
    assert all(r["pr_auc"] is None and r["roc_auc"] is None and r["positives_test"] == 0
               for r in skipped)
    roll = {r["test_day"]: r["pr_auc_rolling_7d"] for r in C.fold_rolling_7d(table).collect()}
    scored_rows = {r["test_day"]: r["pr_auc"] for r in table.where("not skipped").collect()}
    day = dt.date(2024, 1, 30)
    window = [v for d, v in scored_rows.items() if day - dt.timedelta(7) < d <= day and v is not None]
    assert roll[day] == pytest.approx(sum(window) / len(window))


def test_model_matches_direct_solution(spark):
    f = C.training_frame(frame(spark, 10, users=40, seed=11))
    pre, model = C.fit_model(f)
    pdf = pre.transform(f, ["churn_7d"]).toPandas()
    X = np.vstack(pdf["features"].apply(lambda v: v.toArray()).values)
    y = pdf["churn_7d"].values
    n = len(y)
    w = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    Xb = np.hstack([X, np.ones((n, 1))])
    beta = np.zeros(Xb.shape[1])
    for _ in range(50):     # Newton on 1/2||w||^2 + C sum w_i loss_i (C = 1)
        p = 1 / (1 + np.exp(-Xb @ beta))
        g = Xb.T @ (w * (p - y))
        g[:-1] += beta[:-1]
        H = (Xb * (w * p * (1 - p))[:, None]).T @ Xb
        H[:-1, :-1] += np.eye(Xb.shape[1] - 1)
        beta -= np.linalg.solve(H, g)
    np.testing.assert_allclose(model.coefficients.toArray(), beta[:-1], atol=1e-6)
    assert model.intercept == pytest.approx(beta[-1], abs=1e-6)
    # population standardisation of the training rows
    assert X[:, 0].mean() == pytest.approx(0, abs=1e-9) and X[:, 0].std() == pytest.approx(1)
    assert pre.feature_names()[-1] == "plan_id_unknown"


def test_an_unfinished_fit_raises(spark):
    f = C.training_frame(frame(spark, 5, users=20, seed=4))
    with pytest.raises(C.NotConverged):
        C.fit_model(f, C.WalkForwardConfig(max_iter=1))


def test_unseen_plan_encodes_as_zeros(spark):
    f = C.training_frame(frame(spark, 5, users=10))
    pre, _ = C.fit_preprocessor(f.where(F.col("plan_id") != "team"))
    row = pre.transform(f.where(F.col("plan_id") == "team").limit(1), ["plan_id"]).first()
    assert list(row["features"].toArray()[5:]) == [0.0] * (len(pre.levels))


def test_cv_run_and_reports(spark, tmpdir_path):
    f = C.training_frame(frame(spark, 30, users=30))
    table = C.cv_run(f)
    rows = table.collect()
    assert len(rows) == 2
    assert all(r["roc_auc"] is None or 0 <= r["roc_auc"] <= 1 for r in rows)
    coefs = C.model_coefficients(f).collect()
    assert [r["coef"] for r in coefs] == sorted((r["coef"] for r in coefs), reverse=True)
    from ledgerline.sources.sinks import write_report_csv, write_report_json
    write_report_csv(table, f"{tmpdir_path}/folds")
    write_report_json(C.cv_summary_pop(table), f"{tmpdir_path}/summary")
    from ledgerline.sources.sinks import read_fold_report
    back = read_fold_report(spark, f"{tmpdir_path}/folds")
    assert sorted(back.collect()) == sorted(table.collect())
    assert spark.read.json(f"{tmpdir_path}/summary").first()["n_folds_total"] == 2


@settings(max_examples=15, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.integers(0, 3), st.booleans(), st.floats(0, 1), st.one_of(st.none(), st.floats(0, 1))),
                min_size=2, max_size=15))
def test_summaries_and_rolling_equal_pandas(spark, folds):
    import pandas as pd
    rows, day = [], dt.date(2024, 2, 1)
    for i, (gap, skipped, pr, roc) in enumerate(folds):
        day = day + dt.timedelta(1 + gap)
        rows.append((i, day, 10, 0 if skipped else 1, skipped, None if skipped else pr,
                     None if skipped else roc))
    table = spark.createDataFrame(rows, "fold int, test_day date, rows_test long, positives_test long, "
                                        "skipped boolean, pr_auc double, roc_auc double")
    pdf = pd.DataFrame(rows, columns=["fold", "test_day", "rows_test", "positives_test", "skipped",
                                      "pr_auc", "roc_auc"]).astype({"pr_auc": float, "roc_auc": float})
    used = pdf[~pdf["skipped"]]
    pop = C.cv_summary_pop(table).first()
    assert pop["n_folds_total"] == len(pdf) and pop["n_folds_skipped"] == int(pdf["skipped"].sum())

    def same(a, b):
        return (a is None and (b is None or pd.isna(b))) or (a is not None and abs(a - b) < 1e-9)
    assert same(pop["pr_auc_mean"], used["pr_auc"].mean())
    assert same(pop["pr_auc_std"], used["pr_auc"].std(ddof=0))
    assert same(pop["roc_auc_std"], used["roc_auc"].std(ddof=0))
    ok = used.assign(test_day=pd.to_datetime(used["test_day"])).set_index("test_day")
    ref = ok[["pr_auc", "roc_auc"]].rolling("7D").mean()
    got = {r["test_day"]: (r["pr_auc_rolling_7d"], r["roc_auc_rolling_7d"])
           for r in C.fold_rolling_7d(table).collect()}
    for ts, (p, r) in ref.iterrows():
        gp, gr = got[ts.date()]
        assert same(gp, p) and same(gr, r)
