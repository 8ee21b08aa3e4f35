"""Candidate scores, exclusions and the diversity-constrained ranking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.config import RankingConfig
from refrain.operators.similarity import Filter, with_filters
from refrain.operators.temporal import FEATURES


@dataclass(frozen=True)
class LinearModel:
    """A scaled logistic model over named features."""

    names: tuple[str, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    coefficient: tuple[float, ...]
    intercept: float

    def terms(self, values: Mapping[str, Column]) -> list[Column]:
        return [c * (values[n] - m) / s for n, m, s, c in zip(self.names, self.mean, self.scale, self.coefficient, strict=True)]

    def probability(self, values: Mapping[str, Column]) -> Column:
        """A sigmoid that doesn't overflow."""
        z = sum(self.terms(values), F.lit(float(self.intercept)))
        small = F.exp(-F.abs(z))
        return F.when(z >= 0, 1 / (1 + small)).otherwise(small / (1 + small))

    def contributions(self, values: Mapping[str, Column], top: int) -> Column:
        """The ``top`` features by size of contribution, equal ones in feature order."""
        entries = F.array(*(F.struct((-F.abs(t)).alias("k"), F.lit(i).alias("i"), F.lit(n).alias("feature"), t.alias("contribution")) for i, (n, t) in enumerate(zip(self.names, self.terms(values), strict=True))))
        return F.transform(F.slice(F.array_sort(entries), 1, top), lambda e: F.struct(e["feature"].alias("feature"), e["contribution"].alias("contribution")))


def novelty(prior_log_plays: Column) -> Column:
    return 1 / (1 + F.sqrt(F.expm1(prior_log_plays)))


def candidate_behavior(candidates: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Candidates (track_id, artist_key) with their own snapshot, or else their
    artist's three features with zeros for the rest."""
    own = snapshots.select("track_id", *(F.col(n).alias(f"o_{n}") for n in FEATURES))
    artist_names = FEATURES[10:]
    artists = snapshots.filter(F.col("artist_key").isNotNull()).groupBy("artist_key").agg(*(F.min_by(n, "track_id").alias(f"a_{n}") for n in artist_names))
    rows = candidates.join(own, "track_id", "left").join(artists, "artist_key", "left")
    known = F.col("o_prior_seen").isNotNull()
    made = {n: F.when(known, F.col(f"o_{n}")).otherwise(F.coalesce(F.col(f"a_{n}"), F.lit(0.0)) if n in artist_names else F.lit(0.0)) for n in FEATURES}
    return rows.select(*candidates.columns, *(c.alias(n) for n, c in made.items()))


def tier(similarity: Column, preference: Column) -> Column:
    return F.when(similarity.isNotNull(), "audio_ranked").when(preference.isNotNull(), "preference_ranked").otherwise("metadata_only")


def base_score(similarity: Column, preference: Column, new: Column, cfg: RankingConfig) -> Column:
    """The weighted mean of the components that are known; null if none is."""
    zero = F.lit(0.0)
    has_s, has_p = similarity.isNotNull(), preference.isNotNull()
    bonus = F.when(has_s, cfg.novelty_bonus_weight).when(has_p, cfg.preference_only_novelty_bonus_weight).otherwise(zero)
    top = F.when(has_s, cfg.audio_similarity_weight * (similarity + 1) / 2).otherwise(zero) + F.when(has_p, cfg.predicted_preference_weight * preference).otherwise(zero) + bonus * new
    bottom = F.when(has_s, cfg.audio_similarity_weight).otherwise(zero) + F.when(has_p, cfg.predicted_preference_weight).otherwise(zero) + bonus
    return top / F.nullif(bottom, zero)


def exclusion_reason(candidates: DataFrame, observations: DataFrame | None, filters: Sequence[Filter], excluded_artists: Sequence[str] = ()) -> DataFrame:
    """Adds ``exclusion_reason``: the first that holds of an excluded artist and, filter by filter, a missing or failing feature."""
    rows = with_filters(candidates, observations, filters) if filters else candidates
    banned = [a.strip().lower() for a in excluded_artists]
    reasons = [F.when(F.lower(F.trim("artist_name")).isin(*banned), "excluded_artist")] if banned else []
    for i, f in enumerate(filters):
        reasons.append(F.when(F.col(f"ok_{i}").isNull(), F.lit("missing_filter_feature") if f.required else F.lit(None)).when(~F.col(f"ok_{i}"), "feature_filter"))
    reason = F.coalesce(*reasons) if reasons else F.lit(None)
    return rows.select(*candidates.columns, reason.cast("string").alias("exclusion_reason"))


def diversified(scored: DataFrame, *, top_k: int, cfg: RankingConfig | None = None, score: str = "base_score", artist: str = "artist_key", key: str = "track_id") -> DataFrame:
    """Greedy top-k with a penalty for every song already taken of the artist.

    The penalty depends only on a song's place among its artist's, so greedy
    picking is one global order: ``rank``, ``final_score``. A song without artist
    is never penalised. Ties go to the larger id.
    """
    cfg = cfg or RankingConfig()
    w = Window.partitionBy(artist).orderBy(F.desc(score), F.desc(key))
    place = F.row_number().over(w) - 1
    known = scored.filter(F.col(score).isNotNull())
    with_artist = known.filter(F.col(artist).isNotNull()).withColumn("_j", place).filter(F.col("_j") < cfg.maximum_per_artist)
    alone = known.filter(F.col(artist).isNull()).withColumn("_j", F.lit(0))
    rows = with_artist.unionByName(alone).withColumn("final_score", F.col(score) - F.lit(cfg.artist_repetition_penalty) * F.col("_j"))
    top = rows.orderBy(F.desc("final_score"), F.desc(key)).limit(top_k)
    order = Window.orderBy(F.desc("final_score"), F.desc(key))
    return top.withColumn("rank", F.row_number().over(order)).withColumn("artist_repetition_penalty", F.col(score) - F.col("final_score")).drop("_j")


def rank_candidates(candidates: DataFrame, *, snapshots: DataFrame, model: LinearModel | None, similarity: DataFrame | None, seeds: DataFrame, observations: DataFrame | None = None, filters: Sequence[Filter] = (), excluded_artists: Sequence[str] = (), assignments: DataFrame | None = None, top_k: int, cfg: RankingConfig | None = None) -> DataFrame:
    """Every candidate, ranked or with the reason why it isn't.

    ``candidates``: track_id, artist_name, artist_key. ``similarity``: track_id,
    cosine_similarity. Ranked rows are rounded to 8 digits; the others keep their scores as they are.
    """
    cfg = cfg or RankingConfig()
    rows = candidate_behavior(candidates, snapshots)
    rows = rows.join(similarity.select("track_id", "cosine_similarity"), "track_id", "left") if similarity is not None else rows.withColumn("cosine_similarity", F.lit(None).cast("double"))
    values = {n: F.col(n) for n in FEATURES}
    rows = rows.withColumns(
        {
            "predicted_preference": model.probability(values) if model else F.lit(None).cast("double"),
            "model_explanations": model.contributions(values, cfg.explanation_feature_count) if model else F.array(),
            "novelty_bonus": novelty(F.col("prior_log_play_count")),
        }
    )
    s, p = F.col("cosine_similarity"), F.col("predicted_preference")
    rows = rows.withColumn("tier", tier(s, p)).withColumn("raw_score", base_score(s, p, F.col("novelty_bonus"), cfg)).drop(*FEATURES)
    rows = exclusion_reason(rows, observations, filters, excluded_artists)
    seed = seeds.select("track_id", F.lit("seed_track").alias("_seed")).distinct()
    rows = rows.join(seed, "track_id", "left").withColumn("exclusion_reason", F.coalesce("_seed", "exclusion_reason")).drop("_seed")
    rows = rows.withColumn("base_score", F.when(F.col("exclusion_reason").isNull(), F.col("raw_score")))
    unscored = F.when(F.col("base_score").isNull() & F.col("exclusion_reason").isNull(), "metadata_only_no_selected_audio_or_model_coverage")
    rows = rows.withColumn("exclusion_reason", F.coalesce("exclusion_reason", unscored)).drop("raw_score")
    if assignments is not None:
        rows = rows.join(assignments.select("track_id", "cluster_id", "is_noise", "cluster_confidence"), "track_id", "left")
    ranked = diversified(rows, top_k=top_k, cfg=cfg).select("track_id", "rank", "final_score", "artist_repetition_penalty")
    out = rows.join(ranked, "track_id", "left")
    placed = F.col("rank").isNotNull()
    numbers = ("final_score", "base_score", "cosine_similarity", "predicted_preference", "novelty_bonus", "artist_repetition_penalty")
    out = out.withColumns({c: F.when(placed, F.round(c, 8)).otherwise(F.col(c)) for c in numbers})
    return out.withColumn("exclusion_reason", F.coalesce("exclusion_reason", F.when(~placed, "not_selected")))


def content_digest(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """A SHA-256 over the rows in key order, as one row ``digest, rows``.

    Rows are hashed where they are; only their hashes are gathered, in blocks by
    key prefix first, so the last step joins a bounded number of block hashes.
    """
    line = F.concat_ws("\u001f", *(F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns))
    rows = df.select(F.col(key).alias("_k"), F.sha2(line, 256).alias("_h"))
    blocks = rows.groupBy(F.substring(F.sha2(F.col("_k").cast("string"), 256), 1, 3).alias("_b")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_h"))), lambda r: r["_h"]), "\n"), 256).alias("_d"), F.count(F.lit(1)).alias("_n"))
    return blocks.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_b", "_d"))), lambda r: r["_d"]), "\n"), 256).alias("digest"), F.sum("_n").alias("rows"))
