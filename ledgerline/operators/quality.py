"""Data-quality checks (Q1-Q7).  A check returns its violating rows (empty =
pass) or, for the summary, one row per check with its violation count.

Several checks over one table are answered by one aggregate pass over it
(``null_counts`` counts the nulls of every listed column at once).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The checks declared on the marts.
NOT_NULL = {
    "fct_events_daily": ["date_day", "events", "dau", "late_events"],
    "fct_billing_daily": ["date_day", "plan_id", "starts", "new_paid_users"],
    "fct_subscriptions_daily": ["date_day", "user_id", "is_active"],
    "gold_churn_labels_daily": ["date_day", "user_id", "churn_7d"],
    "gold_user_features_daily": ["date_day", "user_id", "churn_7d"],
}
UNIQUE = {"fct_events_daily": ["date_day"]}
ACCEPTED_VALUES = {"gold_churn_labels_daily": ("churn_7d", [0, 1]),
                   "gold_user_features_daily": ("churn_7d", [0, 1])}
GRAIN = {"fct_subscriptions_daily": ["date_day", "user_id"],
         "gold_churn_labels_daily": ["date_day", "user_id"],
         "gold_user_features_daily": ["date_day", "user_id"]}
RANGE_01 = {"gold_user_features_daily": "late_rate_7d"}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def null_counts(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """(model, column_name, violations): nulls per column, one pass over df."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                         F.col(c).alias("violations")) for c in columns]))
    return one.select(F.lit(model).alias("model"), pairs.alias("p")) \
        .select("model", "p.column_name", "p.violations")


def not_null(models: dict[str, DataFrame]) -> DataFrame:
    """Q1: null counts of the not-null columns of every mart."""
    return _union([null_counts(models[m], m, cols) for m, cols in NOT_NULL.items()])


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def unique(models: dict[str, DataFrame]) -> DataFrame:
    """Q2: repeated fct_events_daily.date_day values."""
    m, keys = next(iter(UNIQUE.items()))
    return duplicates(models[m], keys).select(F.lit(m).alias("model"), *keys, "n")


def accepted_values(models: dict[str, DataFrame]) -> DataFrame:
    """Q3: rows whose label is outside {0, 1} (nulls are not judged here)."""
    out = []
    for m, (col, values) in ACCEPTED_VALUES.items():
        out.append(models[m].where(~F.col(col).isin(values))
                   .select(F.lit(m).alias("model"), "date_day", "user_id",
                           F.col(col).alias("value")))
    return _union(out)


def grain(models: dict[str, DataFrame]) -> DataFrame:
    """Q4: (date_day, user_id) pairs occurring more than once."""
    return _union([duplicates(models[m], keys).select(F.lit(m).alias("model"), *keys, "n")
                   for m, keys in GRAIN.items()])


def late_rate_range(features: DataFrame) -> DataFrame:
    """Q5: feature rows with late_rate_7d outside [0, 1]."""
    col = RANGE_01["gold_user_features_daily"]
    return features.where((F.col(col) < 0) | (F.col(col) > 1))


def row_hash_unique(bronze: dict[str, DataFrame]) -> DataFrame:
    """Q7: repeated row hashes in the bronze tables (must be empty after any load)."""
    return _union([duplicates(df, ["row_hash"]).select(F.lit(t).alias("model"), "row_hash", "n")
                   for t, df in bronze.items()])


def _count_rows(df: DataFrame, check: str, model: str, column: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(check).alias("check"), F.lit(model).alias("model"),
        F.lit(column).alias("column_name"), "violations")


def _row_checks(df: DataFrame, model: str) -> DataFrame:
    """Every row-level check of one table (not-null per column, accepted
    values, [0, 1] range) counted in a single aggregate pass, then unpivoted to
    (check, model, column_name, violations)."""
    checks = [("not_null", c, F.col(c).isNull()) for c in NOT_NULL.get(model, [])]
    if model in ACCEPTED_VALUES:
        col, values = ACCEPTED_VALUES[model]
        checks.append(("accepted_values", col, ~F.col(col).isin(values)))
    if model in RANGE_01:
        col = RANGE_01[model]
        checks.append(("range_0_1", col, (F.col(col) < 0) | (F.col(col) > 1)))
    one = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(f"c{i}")
                   for i, (_, _, cond) in enumerate(checks)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(chk).alias("check"), F.lit(col).alias("column_name"),
                 F.col(f"c{i}").alias("violations"))
        for i, (chk, col, _) in enumerate(checks)]))
    return one.select(rows.alias("r")).select(
        "r.check", F.lit(model).alias("model"), "r.column_name", "r.violations")


def report(models: dict[str, DataFrame], bronze: dict[str, DataFrame]) -> DataFrame:
    """Q6: every check as (check, model, column_name, violations, status).
    Row-level checks take one aggregate pass per table; key uniqueness checks
    take one grouped count per key."""
    parts = [_row_checks(df, m) for m, df in models.items()]
    for m, keys in UNIQUE.items():
        parts.append(_count_rows(duplicates(models[m], keys), "unique", m, ",".join(keys)))
    for m, keys in GRAIN.items():
        parts.append(_count_rows(duplicates(models[m], keys), "unique_grain", m, ",".join(keys)))
    for t, df in bronze.items():
        parts.append(_count_rows(duplicates(df, ["row_hash"]), "unique", t, "row_hash"))
    out = _union(parts)
    return out.withColumn("violations", F.col("violations").cast("long")) \
        .withColumn("status", F.when(F.col("violations") == 0, "pass").otherwise("fail"))
