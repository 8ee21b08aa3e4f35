"""Sessions and per-track affinity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.config import AffinityConfig
from refrain.functions import signals
from refrain.functions.text import track_id

DAY_US = 86_400_000_000


def micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def with_sessions(events: DataFrame, *, gap_minutes: int = 30, per: tuple[str, ...] = (), at: str = "played_at", key: str = "event_id", bucket_hours: int = 24) -> DataFrame:
    """Adds ``session_no`` (from 1): a new session starts after more than the gap.

    With ``per`` columns each of their groups has its own sessions. Without, the
    clock is global; rows are then windowed by time bucket, and only one summary
    row a bucket (its last time, its number of starts) passes through the
    bucket-ordered window, so no task sees the whole history.
    """
    gap = gap_minutes * 60_000_000
    us = micros(F.col(at))
    if per:
        order = Window.partitionBy(*per).orderBy(at, key)
        starts = events.withColumn("_new", F.coalesce((us - F.lag(us).over(order) > gap).cast("long"), F.lit(1)))
        return starts.withColumn("session_no", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
    rows = events.withColumn("_us", us).withColumn("_bucket", F.floor(F.col("_us") / (bucket_hours * 3_600_000_000)))
    inner = Window.partitionBy("_bucket").orderBy(at, key)
    rows = rows.withColumn("_before", F.lag("_us").over(inner))
    marked = rows.withColumn("_new", (F.col("_us") - F.col("_before") > gap).cast("long"))
    across = Window.orderBy("_bucket")
    summary = marked.groupBy("_bucket").agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"), F.sum(F.coalesce("_new", F.lit(0))).alias("_inside"))
    summary = summary.withColumn("_opens", F.coalesce((F.col("_first") - F.lag("_last").over(across) > gap).cast("long"), F.lit(1)))
    summary = summary.withColumn("_base", F.sum(F.col("_opens") + F.col("_inside")).over(across.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_inside"))
    joined = marked.join(summary.select("_bucket", "_base"), "_bucket")
    running = F.sum(F.coalesce("_new", F.lit(0))).over(inner.rowsBetween(Window.unboundedPreceding, 0))
    return joined.withColumn("session_no", F.col("_base") + running).drop("_us", "_bucket", "_before", "_new", "_base")


def with_repeats(events: DataFrame, *, per: tuple[str, ...] = (), at: str = "played_at", key: str = "event_id", track: str = "track_id") -> DataFrame:
    """Adds ``is_repeat``: the track was heard earlier in the session."""
    order = Window.partitionBy(*per, "session_no", track).orderBy(at, key)
    return events.withColumn("is_repeat", F.row_number().over(order) > 1)


def last_known(c: str, at: str, key: str) -> Column:
    """The latest value that isn't null."""
    return F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(at, key)))


def with_track_id(events: DataFrame) -> DataFrame:
    return events.withColumn("track_id", track_id(F.col("track_uri"), F.col("track_name"), F.col("artist_name"), F.col("album_name"))).withColumn("track_identity_source", F.when(F.col("track_uri").isNotNull(), "spotify_uri").otherwise("metadata_hash"))


def score(plays: Column, completion: Column, intentional: Column, recency: Column, early_skip: Column, cfg: AffinityConfig) -> dict[str, Column]:
    """The additive components of the affinity; unknown rates add nothing."""
    zero = F.lit(0.0)
    return {
        "play_count": cfg.play_count_log_weight * F.log1p(plays),
        "completion": cfg.completion_rate_weight * F.coalesce(completion, zero),
        "intentional_start": cfg.intentional_start_rate_weight * F.coalesce(intentional, zero),
        "recency": cfg.recency_score_weight * recency,
        "early_skip": cfg.early_skip_rate_weight * F.coalesce(early_skip, zero),
    }


def confidence(plays: Column, completion_coverage: Column, intentional_coverage: Column, early_skip_coverage: Column, cfg: AffinityConfig) -> Column:
    w = {k: abs(v) for k, v in cfg.weights.items()}
    known = w["play_count"] + w["completion"] * completion_coverage + w["intentional_start"] * intentional_coverage + w["recency"] + w["early_skip"] * early_skip_coverage
    return known / (sum(w.values()) or 1.0) * (1 - F.exp(-plays / 3.0))


def track_affinity(events: DataFrame, *, durations: DataFrame | None = None, as_of: Column | None = None, cfg: AffinityConfig | None = None, per: tuple[str, ...] = (), digits: int = 6) -> DataFrame:
    """One row a track (and ``per`` group) with rates, coverages, score and confidence.

    ``events`` are normalised events of all media with a ``track_id``; only tracks
    are rated, but every medium moves the session clock and the reference time,
    which is that of the latest event unless given. ``durations`` is (track_key, duration_ms).
    """
    cfg = cfg or AffinityConfig()
    timed = with_repeats(with_sessions(events, gap_minutes=cfg.session_gap_minutes, per=per), per=per)
    now = as_of if as_of is not None else None
    if now is None:
        latest = events.groupBy(*per).agg(F.max(micros(F.col("played_at"))).alias("_now"))
        timed = timed.join(latest, list(per)) if per else timed.crossJoin(F.broadcast(latest))  # a single row
        now = F.col("_now")
    else:
        now = micros(now)
    tracks = timed.filter(F.col("media_type") == "track")
    if durations is not None:
        keyed = tracks.withColumn("_dur_key", F.coalesce("track_uri", "track_id") if "track_uri" in tracks.columns else F.col("track_id"))
        tracks = keyed.join(durations.select(F.col("track_key").alias("_dur_key"), "duration_ms"), "_dur_key", "left")
    else:
        tracks = tracks.withColumn("duration_ms", F.lit(None).cast("long"))
    ms, end, skipped = F.col("ms_played"), F.col("reason_end"), F.col("skipped")
    rows = tracks.select(
        *per,
        "track_id",
        "played_at",
        "event_id",
        "ms_played",
        "duration_ms",
        *(c for c in ("track_uri", "track_name", "artist_name", "album_name") if c in tracks.columns),
        "is_repeat",
        signals.completion_ratio(ms, F.col("duration_ms")).alias("ratio"),
        signals.completed(ms, F.col("duration_ms"), end, skipped, cfg).cast("double").alias("done"),
        signals.skipped_early(ms, end, skipped, cfg).cast("double").alias("early"),
        signals.started_on_purpose(F.col("reason_start"), cfg).cast("double").alias("meant"),
        F.pow(F.lit(0.5), (now - micros(F.col("played_at"))) / float(DAY_US) / cfg.recency_half_life_days).alias("fresh"),
    )
    named = [last_known(c, "played_at", "event_id").alias(c) for c in ("track_uri", "track_name", "artist_name", "album_name") if c in rows.columns]
    n = F.count(F.lit(1))
    sums = rows.groupBy(*per, "track_id").agg(
        *named,
        F.min("played_at").alias("first_played_at"),
        F.max("played_at").alias("last_played_at"),
        n.alias("play_count"),
        F.sum("ms_played").alias("total_ms_played"),
        F.median("ms_played").alias("median_ms_played"),
        F.max("duration_ms").alias("duration_ms"),
        (F.count("duration_ms") / n).alias("duration_coverage_rate"),
        F.median("ratio").alias("median_completion_ratio"),
        F.avg("done").alias("completion_rate"),
        (F.count("done") / n).alias("completion_signal_coverage"),
        F.avg("early").alias("early_skip_rate"),
        (F.count("early") / n).alias("early_skip_signal_coverage"),
        F.avg("meant").alias("intentional_start_rate"),
        (F.count("meant") / n).alias("intentional_start_signal_coverage"),
        F.avg(F.col("is_repeat").cast("double")).alias("repeat_within_session_rate"),
        F.sum("fresh").alias("recency_weighted_plays"),
        F.avg("fresh").alias("recency_score"),
    )
    parts = score(F.col("play_count"), F.col("completion_rate"), F.col("intentional_start_rate"), F.col("recency_score"), F.col("early_skip_rate"), cfg)
    total = sum(parts.values(), F.lit(0.0))
    sums = sums.withColumns(
        {
            "affinity_score": total,
            "affinity_confidence": confidence(F.col("play_count"), F.col("completion_signal_coverage"), F.col("intentional_start_signal_coverage"), F.col("early_skip_signal_coverage"), cfg),
            "affinity_components": F.struct(*(F.round(c, digits).alias(k) for k, c in parts.items())),
            "scoring_version": F.lit(cfg.scoring_version),
        }
    )
    # Rounding comes last; all arithmetic is on unrounded values.
    return sums.withColumns({c: F.round(c, digits) for c, kind in sums.dtypes if kind == "double"})


def by_affinity(affinity: DataFrame) -> DataFrame:
    return affinity.orderBy(F.desc("affinity_score"), "track_id")
