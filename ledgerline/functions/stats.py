"""Exact ranking metrics as DataFrame operations.

Both metrics come from one pass.  Scores of a group (e.g. a CV fold) are cut into value
ranges, so that a group is ranked by many tasks: sums per range, a prefix over the few
range totals of a group, then ranks inside each range.  A range holds all rows of a
score, so ties never straddle two ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = 64


def ranking_metrics(scored: DataFrame, group: str, score: str = "score", label: str = "label",
                    rows: str | None = None, ranges: int = RANGES) -> DataFrame:
    """``group, roc_auc, average_precision``.

    ROC-AUC by the rank-sum (Mann-Whitney) formula with average ranks for tied scores;
    null when a group lacks one of the classes.  Average precision is the sum over
    distinct scores of (R_n - R_{n-1}) * P_n, without interpolation; null when a group
    has no positive.  ``rows`` names a column with the number of rows each row stands
    for.
    """
    n = F.col(rows) if rows else F.lit(1)
    by_score = (scored.groupBy(group, score)
                .agg(F.sum(n).cast("long").alias("n"),
                     F.sum(F.col(label).cast("long") * n).cast("long").alias("pos")))
    cuts = by_score.groupBy(group).agg(
        F.percentile_approx(score, [i / ranges for i in range(1, ranges)], 1000).alias("cuts"))
    placed = by_score.join(cuts, group).select(
        group, score, "n", "pos", F.size(F.filter("cuts", lambda c: c < F.col(score))).alias("range"))
    # at most `ranges` rows of a group
    whole = Window.partitionBy(group)
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (placed.groupBy(group, "range").agg(F.sum("n").alias("n_range"), F.sum("pos").alias("pos_range"))
              .select(group, "range",
                      F.coalesce(F.sum("n_range").over(before), F.lit(0)).alias("n_before"),
                      F.coalesce(F.sum("pos_range").over(before), F.lit(0)).alias("pos_before"),
                      F.sum("n_range").over(whole).alias("n_all"),
                      F.sum("pos_range").over(whole).alias("n_pos")))
    inside = Window.partitionBy(group, "range").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (placed.join(totals, [group, "range"])
              .withColumn("below", F.col("n_before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
              .withColumn("pos_below", F.col("pos_before") + F.coalesce(F.sum("pos").over(inside), F.lit(0))))
    # average rank of the tie block: below + (n + 1) / 2
    avg_rank = F.col("below") + (F.col("n") + 1) / 2.0
    # a threshold at this score takes the block and all above it
    precision = (F.col("n_pos") - F.col("pos_below")) / (F.col("n_all") - F.col("below"))
    agg = ranked.groupBy(group).agg(
        F.sum(F.col("pos") * avg_rank).alias("rank_sum"),
        F.sum(F.when(F.col("n_pos") > 0, F.col("pos") / F.col("n_pos") * precision)).alias("ap"),
        F.max("n_pos").alias("n_pos"), F.max(F.col("n_all") - F.col("n_pos")).alias("n_neg"))
    auc = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                 (F.col("rank_sum") - F.col("n_pos") * (F.col("n_pos") + 1) / 2.0)
                 / (F.col("n_pos") * F.col("n_neg")))
    return agg.select(group, auc.cast("double").alias("roc_auc"),
                      F.when(F.col("n_pos") > 0, F.col("ap")).cast("double").alias("average_precision"))


def roc_auc(scored: DataFrame, group: str, score: str = "score", label: str = "label") -> DataFrame:
    """ROC-AUC per group."""
    return ranking_metrics(scored, group, score, label).select(group, "roc_auc")


def average_precision(scored: DataFrame, group: str, score: str = "score",
                      label: str = "label") -> DataFrame:
    """Average precision per group."""
    return ranking_metrics(scored, group, score, label).select(group, "average_precision")
