"""Observations in long form, and the profiles that pivot them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ("track_id", "feature_name", "feature_source", "source_version")


@dataclass(frozen=True)
class Selector:
    """Names one feature of one source in one version."""

    feature_name: str
    feature_source: str
    source_version: str

    @property
    def matches(self) -> Column:
        return (F.col("feature_name") == self.feature_name) & (F.col("feature_source") == self.feature_source) & (F.col("source_version") == self.source_version)

    @property
    def label(self) -> str:
        return f"{self.feature_name}@{self.feature_source}@{self.source_version}"


class FeatureError(ValueError):
    """Observations break their contract."""


def assert_observations(observations: DataFrame) -> DataFrame:
    """Exactly one value a row, finite numbers, names of the form ``name_v1``, unique keys."""
    values = sum((F.col(c).isNotNull().cast("int") for c in ("value_number", "value_text", "value_vector")), F.lit(0))
    finite = F.col("value_number").isNull() | (~F.isnan("value_number") & (F.abs("value_number") < float("inf")))
    good = (values == 1) & finite & F.col("feature_name").rlike("^[a-z][a-z0-9_]*_v[0-9]+$") & F.col("feature_confidence").between(0, 1)
    if observations.filter(~F.coalesce(good, F.lit(False))).limit(1).count():
        raise FeatureError("an observation has no, several or bad values")
    if observations.groupBy(*KEY).count().filter("count > 1").limit(1).count():
        raise FeatureError("an observation is repeated")
    return observations


def pivot(observations: DataFrame, selectors: Sequence[Selector], *, minimum_confidence: float = 0.0, value: str = "value_number") -> DataFrame:
    """One row a track with a column ``f0, f1, ...`` for each selector, null where unknown.

    One conditional aggregate after one filter, so a single shuffle serves any
    number of selectors.
    """
    wanted = selectors[0].matches
    for s in selectors[1:]:
        wanted |= s.matches
    rows = observations.filter(wanted & (F.col("feature_confidence") >= minimum_confidence))
    return rows.groupBy("track_id").agg(*(F.max(F.when(s.matches, F.col(value))).alias(f"f{i}") for i, s in enumerate(selectors)))


def representation(observations: DataFrame, descriptors: Sequence[Selector], embedding: Selector | None = None, *, minimum_confidence: float = 0.0) -> DataFrame:
    """(track_id, descriptors, embedding) of tracks for which all inputs are known."""
    wide = pivot(observations, descriptors, minimum_confidence=minimum_confidence).na.drop() if descriptors else None
    if wide is not None:
        wide = wide.select("track_id", F.array(*(f"f{i}" for i in range(len(descriptors)))).alias("descriptors"))
    if embedding is None:
        return wide
    vectors = observations.filter(embedding.matches & (F.col("feature_confidence") >= minimum_confidence) & F.col("value_vector").isNotNull()).select("track_id", F.col("value_vector").alias("embedding"))
    return vectors if wide is None else wide.join(vectors, "track_id")


def fair_cohort(left: DataFrame, right: DataFrame, key: str = "track_id") -> DataFrame:
    """Keys that both have."""
    return left.select(key).intersect(right.select(key))


def windows(samples: int, size: int, hop: int | None = None) -> list[tuple[int, int]]:
    """Fixed windows over a signal: a tiling by ``hop`` (``size`` unless given) and,
    if it leaves a rest, one more that ends with the signal."""
    hop = hop or size
    if samples <= size:
        return [(0, samples)]
    starts = list(range(0, samples - size + 1, hop))
    if starts[-1] + size < samples:
        starts.append(samples - size)
    return [(s, s + size) for s in starts]
