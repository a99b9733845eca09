"""Evaluation of probabilities against 0/1 labels.

Several scores of the same rows (model, calibrated model, baseline) are evaluated
together: rows become (score name, probability, label) once, and every metric groups
by the name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from punctua.functions.scores import bin_index

BUCKETS = 65536


def long_scores(df: DataFrame, scores: Sequence[str], label: str) -> DataFrame:
    """One row per (name, p, y) for each of the score columns."""
    entries = [
        F.struct(F.lit(s).alias("name"), F.col(s).cast("double").alias("p")) for s in scores
    ]
    return df.select(F.inline(F.array(*entries)), F.col(label).cast("int").alias("y"))


def ranked_scores(scored: DataFrame) -> DataFrame:
    """Distinct probabilities per name with the label counts below and above them.

    Equal probabilities are counted first, so ties collapse before any shuffle.  The
    running totals need an order over all distinct values; instead of one sorted
    stream, values go to 65536 buckets of equal width, bucket totals are accumulated
    (a table of bounded size), and each bucket accumulates its own values in parallel.
    Probabilities outside [0, 1] land in the end buckets, which keeps their order.
    """
    slot = F.least(
        F.greatest(F.floor(F.col("p") * BUCKETS), F.lit(0)), F.lit(BUCKETS - 1)
    ).cast("int")
    distinct = (
        scored.where(F.col("p").isNotNull() & F.col("y").isNotNull())
        .groupBy("name", "p")
        .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
        .withColumn("slot", slot)
    )
    every = Window.partitionBy("name")
    earlier = every.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    offsets = (
        distinct.groupBy("name", "slot")
        .agg(F.sum("pos").alias("sp"), F.sum("neg").alias("sn"))
        .select(
            "name",
            "slot",
            F.coalesce(F.sum("sp").over(earlier), zero).alias("pos0"),
            F.coalesce(F.sum("sn").over(earlier), zero).alias("neg0"),
            F.sum("sp").over(every).alias("pos_all"),
            F.sum("sn").over(every).alias("neg_all"),
        )
    )
    lower = Window.partitionBy("name", "slot").orderBy("p").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        distinct.join(offsets, ["name", "slot"])
        .withColumn("pos_below", F.col("pos0") + F.coalesce(F.sum("pos").over(lower), zero))
        .withColumn("neg_below", F.col("neg0") + F.coalesce(F.sum("neg").over(lower), zero))
        .drop("pos0", "neg0", "slot")
    )


def rank_metrics(scored: DataFrame) -> DataFrame:
    """ROC-AUC (ties averaged) and average precision (step-wise) per score name.

    The AUC of a single class is null.
    """
    d = {c: F.col(c).cast("double") for c in ("pos", "neg", "pos_below", "neg_below")}
    wins = F.sum(d["pos"] * (d["neg_below"] + d["neg"] / 2))
    pairs = F.max(F.col("pos_all").cast("double")) * F.max(F.col("neg_all").cast("double"))
    above = F.col("pos_all") - F.col("pos_below")
    flagged = above + F.col("neg_all") - F.col("neg_below")
    precision = above.cast("double") / flagged
    return (
        ranked_scores(scored)
        .groupBy("name")
        .agg(
            (wins / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"),
            (
                F.sum(d["pos"] * precision) / F.nullif(F.max("pos_all").cast("double"), F.lit(0.0))
            ).alias("average_precision"),
        )
    )


def brier_scores(scored: DataFrame) -> DataFrame:
    """Row count, positive rate and mean squared error per score name."""
    return scored.groupBy("name").agg(
        F.count("*").alias("n"),
        F.avg(F.col("y").cast("double")).alias("positive_rate"),
        F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("brier"),
    )


def reliability_curve(df: DataFrame, p: str, label: str, n_bins: int = 10) -> DataFrame:
    """Mean prediction and observed rate per equal-width bin; empty bins are kept."""
    filled = (
        df.where(F.col(p).isNotNull())
        .groupBy(bin_index(F.col(p), n_bins).alias("bin"))
        .agg(
            F.avg(F.col(p)).alias("mean_predicted"),
            F.avg(F.col(label).cast("double")).alias("fraction_positive"),
            F.count("*").alias("n"),
        )
    )
    bins = df.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    return bins.join(filled, "bin", "left").withColumn(
        "n", F.coalesce("n", F.lit(0).cast("bigint"))
    )


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Class counts and the positive-class weight: neg/pos, at least 1, 1 without positives."""
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    )
    ratio: Column = F.col("negatives").cast("double") / F.nullif("positives", F.lit(0))
    return counts.withColumn(
        "scale_pos_weight", F.greatest(F.coalesce(ratio, F.lit(1.0)), F.lit(1.0))
    )


def evaluation_table(
    scored: DataFrame,
    label: str,
    raw: str = "raw_probability",
    calibrated: str = "delay_probability",
    baseline: str = "baseline_probability",
) -> DataFrame:
    """One row of test metrics: model against the base-rate baseline."""
    rows = long_scores(scored, [raw, calibrated, baseline], label)
    per_score = rank_metrics(rows).join(brier_scores(rows), "name")

    def of(name: str, metric: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col(metric)))

    one = per_score.agg(
        F.max("n").alias("n_test"),
        F.max("positive_rate").alias("test_positive_rate"),
        of(calibrated, "roc_auc").alias("model_roc_auc"),
        of(calibrated, "average_precision").alias("model_pr_auc"),
        of(raw, "brier").alias("model_brier_raw"),
        of(calibrated, "brier").alias("model_brier_calibrated"),
        of(baseline, "roc_auc").alias("baseline_roc_auc"),
        of(baseline, "average_precision").alias("baseline_pr_auc"),
        of(baseline, "brier").alias("baseline_brier"),
    )
    roc = F.col("model_roc_auc") - F.col("baseline_roc_auc")
    pr = F.col("model_pr_auc") - F.col("baseline_pr_auc")
    return one.withColumns(
        {
            "roc_auc_lift": roc,
            "pr_auc_lift": pr,
            "beats_baseline": F.coalesce((roc > 0) & (pr > 0), F.lit(False)),
        }
    )
