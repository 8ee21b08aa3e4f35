"""Vectors as arrays of doubles, in JVM expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def doubles(c: Column) -> Column:
    return c.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector over its length; null elements if that is zero. The length is taken once."""
    return F.zip_with(a, F.array_repeat(F.nullif(norm(a), F.lit(0.0)), F.size(a)), lambda x, n: x / n)


#: Rows of keys or queries that may be broadcast, once counted.
BROADCAST_ROWS = 1 << 20


def clamp(c: Column) -> Column:
    # least and greatest pass over nulls, so a null needs its own branch
    return F.when(c.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c)))


def cosine(a: Column, b: Column) -> Column:
    return clamp(dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0)))


def literal(values: Sequence[float]) -> Column:
    return F.array(*(F.lit(float(v)) for v in values))


def elementwise(df: DataFrame, keys: Sequence[str], vector: str, weight: Column | None = None) -> DataFrame:
    """Weighted sums of vectors by key as ``total`` (array) and ``weight``.

    Elements are exploded and summed per position, so a group's vectors never
    meet in one task whole.
    """
    w = weight if weight is not None else F.lit(1.0)
    exploded = df.select(*keys, w.alias("_w"), F.posexplode(vector).alias("_i", "_v"))
    sums = exploded.groupBy(*keys, "_i").agg(F.sum(F.col("_w") * F.col("_v")).alias("_s"), F.sum("_w").alias("_n"))
    packed = sums.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_i", "_s"))).alias("_p"), F.max("_n").alias("weight"))
    return packed.select(*keys, F.transform("_p", lambda p: p["_s"]).alias("total"), "weight")


def pooled(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """Mean-pooled, then L2-normalised windows by key, as ``pooled``."""
    sums = elementwise(df, keys, vector)
    return sums.select(*keys, unit(F.transform("total", lambda x: x / F.col("weight"))).alias("pooled"))


def weighted_query(seeds: DataFrame, vector: str, weight: str) -> DataFrame:
    """One row ``query``: unit seeds summed by positive weight, normalised again."""
    prepared = seeds.select(unit(doubles(F.col(vector))).alias("_u"), F.col(weight).cast("double").alias("_wt"))
    return elementwise(prepared, [], "_u", F.col("_wt")).select(unit(F.col("total")).alias("query"))


def pooling_confidence(coverage_seconds: Column) -> Column:
    return F.when(coverage_seconds.isNotNull(), 0.95 * F.least(F.lit(1.0), coverage_seconds / 30.0))


def measurement_confidence(ceiling: Column, coverage_seconds: Column) -> Column:
    known = F.when(coverage_seconds.isNull(), F.lit(0.75)).otherwise(F.least(F.lit(1.0), coverage_seconds / 30.0))
    return F.round(ceiling * known, 6)


def binary_confidence(scores: Column, coverage: Column) -> Column:
    """coverage * sqrt(certainty * agreement) of per-window probabilities: certainty
    falls with their mean entropy in bits, agreement with their population deviation."""
    n = F.size(scores)
    p = F.transform(scores, lambda x: F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), x)))
    mean = F.aggregate(p, F.lit(0.0), lambda s, x: s + x) / n
    deviation = F.sqrt(F.aggregate(p, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / n)
    entropy = F.aggregate(p, F.lit(0.0), lambda s, x: s - x * F.log2(x) - (1 - x) * F.log2(1 - x)) / n
    certainty = F.greatest(F.lit(0.0), 1 - entropy)
    agreement = F.greatest(F.lit(0.0), 1 - F.least(F.lit(1.0), 2 * deviation))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), coverage * F.sqrt(certainty * agreement)))
