"""Evaluation of predictions, as aggregates: no prediction comes to the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _before(by: DataFrame, p: str, columns: list[str], *, descending: bool = False, buckets: int = 1024) -> DataFrame:
    """Adds ``<c>_before``: the sum of ``c`` over rows with a smaller (larger) score.

    Scores in 0..1 are windowed by bucket; only the buckets' sums, of which there
    are ``buckets`` at most, pass through one ordered window.
    """
    key = F.floor(F.col(p) * buckets) * (-1 if descending else 1)
    rows = by.withColumn("_b", key)
    order = F.desc(p) if descending else F.asc(p)
    within = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("_b").agg(*(F.sum(c).alias(f"_{c}") for c in columns))
    sums = sums.select("_b", *(F.coalesce(F.sum(f"_{c}").over(across), F.lit(0)).alias(f"_{c}") for c in columns))
    added = rows.join(sums, "_b")
    return added.select(*by.columns, *((F.coalesce(F.sum(c).over(within), F.lit(0)) + F.col(f"_{c}")).alias(f"{c}_before") for c in columns))


def auc(df: DataFrame, label: str = "label", p: str = "probability") -> DataFrame:
    """ROC area by rank sums, equal scores sharing their mean rank; null with one class."""
    by = df.groupBy(p).agg(F.sum(label).alias("pos"), F.count(F.lit(1)).alias("n"))
    ranked = _before(by, p, ["n"]).withColumn("rank", F.col("n_before") + (F.col("n") + 1) / 2)
    sums = ranked.agg(F.sum(F.col("rank") * F.col("pos")).alias("r"), F.sum("pos").alias("p"), F.sum(F.col("n") - F.col("pos")).alias("q"))
    return sums.select(((F.col("r") - F.col("p") * (F.col("p") + 1) / 2) / F.nullif(F.col("p") * F.col("q"), F.lit(0))).alias("auc"))


def average_precision(df: DataFrame, label: str = "label", p: str = "probability") -> DataFrame:
    """Step-wise average precision; null with one class."""
    by = df.groupBy(p).agg(F.sum(label).alias("pos"), F.count(F.lit(1)).alias("n"))
    steps = _before(by, p, ["pos", "n"], descending=True).select("pos", "n", (F.col("pos_before") + F.col("pos")).alias("tp"), (F.col("n_before") + F.col("n")).alias("seen"))
    sums = steps.agg(F.sum(F.col("tp") / F.col("seen") * F.col("pos")).alias("s"), F.sum("pos").alias("p"), F.sum("n").alias("n"))
    return sums.select(F.when((F.col("p") > 0) & (F.col("p") < F.col("n")), F.col("s") / F.col("p")).alias("average_precision"))


def log_loss_brier(df: DataFrame, label: str = "label", p: str = "probability") -> DataFrame:
    q = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col(p)))
    y = F.col(label)
    return df.agg(F.avg(-(y * F.log(q) + (1 - y) * F.log(1 - q))).alias("log_loss"), F.avg((F.col(p) - y) * (F.col(p) - y)).alias("brier"))


def calibration_error(df: DataFrame, label: str = "label", p: str = "probability", bins: int = 10) -> DataFrame:
    """Expected calibration error over equal bins, the last one closed."""
    index = F.lit(0)
    for i in range(1, bins):
        index = F.when(F.col(p) >= i / bins, F.lit(i)).otherwise(index)
    by = df.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("c"), F.avg(label).alias("a"))
    return by.agg((F.sum(F.col("n") * F.abs(F.col("c") - F.col("a"))) / F.sum("n")).alias("ece"))


def ranking_by_period(df: DataFrame, *, k: int, label: str = "label", p: str = "probability", period: str = "period_index", tie: str = "track_id") -> DataFrame:
    """precision, recall and ndcg at ``k`` of each period that has a positive."""
    w = Window.partitionBy(period).orderBy(F.desc(p), tie)
    ranked = df.withColumn("_r", F.row_number().over(w))
    top = F.col("_r") <= k
    sums = ranked.groupBy(period).agg(
        F.sum(label).alias("pos"),
        F.count_if(top).alias("lim"),
        F.sum(F.when(top, F.col(label)).otherwise(0)).alias("hits"),
        F.sum(F.when(top, F.col(label) / F.log2(F.col("_r") + 1)).otherwise(0.0)).alias("dcg"),
    )
    ideal = F.aggregate(F.sequence(F.lit(1), F.least("pos", "lim").cast("int")), F.lit(0.0), lambda s, r: s + 1 / F.log2(r + 1.0))
    return sums.filter("pos > 0").select(period, (F.col("hits") / F.col("lim")).alias("precision"), (F.col("hits") / F.col("pos")).alias("recall"), (F.col("dcg") / ideal).alias("ndcg"))


def ranking(df: DataFrame, *, k: int, **names: str) -> DataFrame:
    return ranking_by_period(df, k=k, **names).agg(F.count(F.lit(1)).alias("periods"), F.avg("precision").alias("precision_at_k"), F.avg("recall").alias("recall_at_k"), F.avg("ndcg").alias("ndcg_at_k"))


def paired_deltas(baseline: DataFrame, contender: DataFrame, *, k: int, key: str = "sample_id") -> DataFrame:
    """NDCG of both and their difference by period; raises unless both predict the same samples."""
    b = baseline.select(key, F.lit(1).alias("_b"))
    c = contender.select(key, F.lit(1).alias("_c"))
    if b.join(c, key, "full_outer").filter("_b IS NULL OR _c IS NULL").limit(1).count():
        raise ValueError("the two sets of predictions are of different samples")
    x = ranking_by_period(baseline, k=k, tie=key).select("period_index", F.col("ndcg").alias("baseline_ndcg"))
    y = ranking_by_period(contender, k=k, tie=key).select("period_index", F.col("ndcg").alias("contender_ndcg"))
    return x.join(y, "period_index").withColumn("delta", F.col("contender_ndcg") - F.col("baseline_ndcg"))


def bootstrap(deltas: DataFrame, *, resamples: int = 10_000, seed: int = 1729) -> dict[str, float]:
    """Mean delta, its 95 % interval by resampling periods, and the share of periods won.

    A row a period comes to the driver, nothing more.
    """
    d = np.array([r.delta for r in deltas.orderBy("period_index").select("delta").collect()])
    means = np.random.default_rng(seed).choice(d, size=(resamples, len(d)), replace=True).mean(axis=1)
    low, high = np.quantile(means, [0.025, 0.975])
    return {"mean_delta": float(d.mean()), "low": float(low), "high": float(high), "win_rate": float((d > 0).mean())}


def weighted_scaler(df: DataFrame, columns: list[str], weight: str) -> DataFrame:
    """Weighted means and population deviations; a constant column scales by 1. Two
    passes, as the one-pass form loses digits where the mean is large."""
    w = F.col(weight)
    means = df.agg(*((F.sum(w * F.col(c)) / F.sum(w)).alias(f"{c}_mean") for c in columns))
    joined = df.crossJoin(F.broadcast(means))  # a single row
    out = joined.agg(*(F.max(f"{c}_mean").alias(f"{c}_mean") for c in columns), *(F.sqrt(F.sum(w * (F.col(c) - F.col(f"{c}_mean")) * (F.col(c) - F.col(f"{c}_mean"))) / F.sum(w)).alias(f"{c}_sd") for c in columns))
    return out.select(*(f"{c}_mean" for c in columns), *(F.when(F.col(f"{c}_sd") > 0, F.col(f"{c}_sd")).otherwise(1.0).alias(f"{c}_scale") for c in columns))


def invariance(pairs: DataFrame) -> DataFrame:
    """Per transform: the share of queries whose own recording ranks first, and mean
    and least cosine with it. ``pairs``: transform, query_id, recording_id, cosine."""
    w = Window.partitionBy("transform", "query_id").orderBy(F.desc("cosine"), "recording_id")
    first = pairs.withColumn("_r", F.row_number().over(w))
    own = F.col("query_id") == F.col("recording_id")
    return first.filter(own).groupBy("transform").agg(F.count(F.lit(1)).alias("queries"), F.avg((F.col("_r") == 1).cast("double")).alias("top1"), F.avg("cosine").alias("mean_cosine"), F.min("cosine").alias("min_cosine"))
