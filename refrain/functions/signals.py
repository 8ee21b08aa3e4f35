"""Three-valued playback signals: true, false or unknown (null)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from refrain.config import AffinityConfig, TemporalConfig


def _in(c: Column, reasons: tuple[str, ...]) -> Column:
    return F.coalesce(F.lower(c).isin(*reasons), F.lit(False))


def completion_ratio(ms: Column, duration: Column) -> Column:
    return F.when(duration.isNotNull(), F.least(ms / duration, F.lit(1.0)))


def completed(ms: Column, duration: Column, end: Column, skipped: Column, cfg: AffinityConfig) -> Column:
    return (
        F.when(duration.isNotNull(), completion_ratio(ms, duration) >= cfg.completion_threshold)
        .when(_in(end, cfg.complete_end_reasons), True)
        .when(F.coalesce(skipped, F.lit(False)) | _in(end, cfg.skip_end_reasons), False)
    )


def skipped_early(ms: Column, end: Column, skipped: Column, cfg: AffinityConfig) -> Column:
    return F.when(F.coalesce(skipped, F.lit(False)) | _in(end, cfg.skip_end_reasons), ms < cfg.early_skip_threshold_ms).when((skipped == F.lit(False)) | _in(end, cfg.complete_end_reasons), False)


def started_on_purpose(start: Column, cfg: AffinityConfig | TemporalConfig) -> Column:
    return F.when(_in(start, cfg.intentional_start_reasons), True).when(_in(start, cfg.passive_start_reasons), False)


def liked(ms: Column, end: Column, skipped: Column, cfg: TemporalConfig) -> Column:
    """The outcome label of one event."""
    gone = F.coalesce(skipped, F.lit(False)) | _in(end, cfg.skip_end_reasons)
    return (
        F.when(_in(end, cfg.complete_end_reasons), True)
        .when(gone & (ms < cfg.early_skip_maximum_ms), False)
        .when((skipped == F.lit(False)) & (ms >= cfg.positive_minimum_ms), True)
    )
