"""Weighted multi-seed cosine queries with hard filters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions.vectors import BROADCAST_ROWS, clamp, dot, doubles, norm, weighted_query
from refrain.operators.features import Selector


class QueryError(ValueError):
    """A similarity query can't be answered as asked."""


@dataclass(frozen=True)
class NumericRange:
    """Inclusive bounds on one feature. An optional filter lets unknown values pass."""

    selector: Selector
    minimum: float | None = None
    maximum: float | None = None
    minimum_confidence: float = 0.0
    required: bool = True

    value_column = "value_number"

    def accepts(self, value: Column) -> Column:
        ok = F.lit(True)
        if self.minimum is not None:
            ok &= value >= self.minimum
        if self.maximum is not None:
            ok &= value <= self.maximum
        return ok


@dataclass(frozen=True)
class Allowed:
    """An allow-list of texts, compared without case unless told otherwise."""

    selector: Selector
    values: tuple[str, ...]
    case_sensitive: bool = False
    minimum_confidence: float = 0.0
    required: bool = True

    value_column = "value_text"

    def accepts(self, value: Column) -> Column:
        return value.isin(*self.values) if self.case_sensitive else F.lower(value).isin(*(v.lower() for v in self.values))


Filter = NumericRange | Allowed


def with_filters(tracks: DataFrame, observations: DataFrame, filters: Sequence[Filter]) -> DataFrame:
    """Adds for filter ``i`` its value ``v_i``, confidence ``q_i`` and verdict ``ok_i``
    (true, false or, where the feature is unknown, null). One aggregate serves all filters."""
    if not filters:
        return tracks
    wanted = filters[0].selector.matches
    for f in filters[1:]:
        wanted |= f.selector.matches
    aggs = []
    for i, f in enumerate(filters):
        mine = f.selector.matches & (F.col("feature_confidence") >= f.minimum_confidence)
        aggs += [F.max(F.when(mine, F.col(f.value_column))).alias(f"v_{i}"), F.max(F.when(mine, F.col("feature_confidence"))).alias(f"q_{i}")]
    wide = observations.filter(wanted).groupBy("track_id").agg(*aggs)
    joined = tracks.join(wide, "track_id", "left")
    return joined.withColumns({f"ok_{i}": F.when(F.col(f"v_{i}").isNotNull(), f.accepts(F.col(f"v_{i}"))) for i, f in enumerate(filters)})


def passes(filters: Sequence[Filter]) -> Column:
    ok = F.lit(True)
    for i, f in enumerate(filters):
        ok &= F.coalesce(F.col(f"ok_{i}"), F.lit(not f.required))
    return ok


def evidence(filters: Sequence[Filter]) -> Column:
    """(selector, value as text, confidence) of every filter whose feature is known, in filter order."""
    entries = [F.when(F.col(f"ok_{i}"), F.struct(F.lit(f.selector.label).alias("selector"), F.col(f"v_{i}").cast("string").alias("value"), F.col(f"q_{i}").alias("confidence"))) for i, f in enumerate(filters)]
    return F.filter(F.array(*entries), lambda e: e.isNotNull()) if entries else F.array()


def query(vectors: DataFrame, seeds: DataFrame, *, top_k: int, observations: DataFrame | None = None, filters: Sequence[Filter] = (), minimum_confidence: float = 0.0, exclude_seeds: bool = True, extra_query: Sequence[float] | None = None) -> DataFrame:
    """The ``top_k`` tracks nearest to the seeds' weighted centroid.

    ``vectors``: track_id, embedding, feature_confidence. ``seeds``: track_id,
    weight. Ties go to the smaller id. Every vector is scored, where it lies; the
    top-k is taken per partition before its rows meet.
    """
    chosen = seeds.join(vectors, "track_id", "left")
    if chosen.filter(F.col("embedding").isNull() | (F.col("weight") <= 0)).limit(1).count():
        raise QueryError("a seed has no vector or no positive weight")
    usable = vectors.filter(F.col("feature_confidence") >= minimum_confidence).withColumn("_e", doubles(F.col("embedding")))
    if extra_query is not None:
        chosen = chosen.select("embedding", "weight").unionByName(seeds.sparkSession.range(1).select(F.array(*(F.lit(float(v)) for v in extra_query)).cast(dict(vectors.dtypes)["embedding"]).alias("embedding"), F.lit(1.0).alias("weight")))
    target = weighted_query(chosen, "embedding", "weight")
    if exclude_seeds:
        ids = seeds.select("track_id").distinct()
        usable = usable.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, "track_id", "left_anti")
    rows = with_filters(usable, observations, filters).filter(passes(filters)) if filters else usable
    scored = rows.crossJoin(F.broadcast(target))  # one row
    scored = scored.withColumn("cosine_similarity", clamp(dot(F.col("query"), F.col("_e")) / F.nullif(norm(F.col("_e")), F.lit(0.0))))
    top = scored.filter(F.col("cosine_similarity").isNotNull()).orderBy(F.desc("cosine_similarity"), "track_id").limit(top_k)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("cosine_similarity"), "track_id")))
    return ranked.select("rank", "track_id", "cosine_similarity", "feature_confidence", evidence(filters).alias("evidence")) if filters else ranked.select("rank", "track_id", "cosine_similarity", "feature_confidence")
