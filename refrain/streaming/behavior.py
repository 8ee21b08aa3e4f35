"""Streaming forms: deduplicated events, sessions, period tallies and the feedback log.

A period's row is final only once the watermark has passed its end, so what is
emitted never changes, as a batch over closed periods gives it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from refrain.config import TemporalConfig
from refrain.functions import signals
from refrain.sources.sinks import append_feedback


#: Event time after which a track's running state is closed.
IDLE_DAYS = 90


def deduplicated(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """Each event id once, as long as its copies come within the delay."""
    return events.withWatermark("played_at", delay).dropDuplicatesWithinWatermark(["event_id"])


def media_counts(events: DataFrame, window: str = "1 day", delay: str = "2 days", slide: str | None = None) -> DataFrame:
    """Events per medium over tumbling (or, with ``slide``, sliding) windows."""
    w = F.window("played_at", window, slide) if slide else F.window("played_at", window)
    return events.withWatermark("played_at", delay).groupBy(w, "media_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "media_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "2 hours") -> DataFrame:
    """Sessions of each user: start, last event and number of events."""
    w = F.session_window("played_at", gap)
    return events.withWatermark("played_at", delay).groupBy(w, "user_id").agg(F.count(F.lit(1)).alias("events"), F.max("played_at").alias("last_played_at")).select("user_id", F.col("session_window.start").alias("started_at"), "last_played_at", "events")


def period_tallies(events: DataFrame, cfg: TemporalConfig | None = None, delay: str = "2 days") -> DataFrame:
    """Votes of each track in each closed period."""
    cfg = cfg or TemporalConfig()
    outcome = signals.liked(F.col("ms_played"), F.col("reason_end"), F.col("skipped"), cfg)
    rows = events.filter(F.col("media_type") == "track").withWatermark("played_at", delay).withColumn("_o", outcome)
    sums = rows.groupBy(F.window("played_at", f"{cfg.period_days} days"), "track_id").agg(F.count(F.lit(1)).alias("plays"), F.count_if(F.col("_o")).alias("positives"), F.count_if(~F.col("_o")).alias("negatives"))
    return sums.select("track_id", F.col("window.start").alias("period_start"), "plays", "positives", "negatives")


def running_state(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """The running plays and milliseconds of every track after each micro-batch; a
    track that isn't heard for the time-out is closed and may start anew."""

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        plays, ms = state.get if state.exists else (0, 0)
        for pdf in batches:
            plays, ms = plays + len(pdf), ms + int(pdf["ms_played"].sum())
        state.update((plays, ms))
        state.setTimeoutTimestamp(state.getCurrentWatermarkMs() + IDLE_DAYS * 86_400_000)
        yield pd.DataFrame({"track_id": [key[0]], "plays": [plays], "total_ms": [ms]})

    rows = events.filter((F.col("media_type") == "track") & F.col("track_id").isNotNull()).withWatermark("played_at", delay)
    return rows.select("track_id", "played_at", "ms_played").groupBy("track_id").applyInPandasWithState(fold, "track_id string, plays long, total_ms long", "plays long, total_ms long", "update", GroupStateTimeout.EventTimeTimeout)


def log_feedback(stream: DataFrame, path: str, checkpoint: str):
    """Start a query that appends new feedback; a batch that comes again adds nothing."""
    from refrain.contracts import FEEDBACK
    from refrain.sources.tables import read_feedback

    def write(batch: DataFrame, _: int) -> None:
        known = read_feedback(batch.sparkSession, path, FEEDBACK).select("feedback_id")
        append_feedback(batch.dropDuplicates(["feedback_id"]).join(known, "feedback_id", "left_anti"), path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
