"""Settings with their defaults; ``load`` reads them from a mapping or YAML and rejects unknown keys."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path
from typing import Any, Self

# Reason codes of playback records.
COMPLETE_END = ("endplay", "trackdone")
SKIP_END = ("backbtn", "fwdbtn")
INTENTIONAL_START = ("backbtn", "clickrow", "fwdbtn", "playbtn", "remote")
PASSIVE_START = ("appload", "autoplay", "trackdone")


class ConfigError(ValueError):
    """A setting is unknown or out of range."""


class Settings:
    @classmethod
    def load(cls, source: Mapping[str, Any] | str | Path, section: str | None = None) -> Self:
        if not isinstance(source, Mapping):
            import yaml

            source = yaml.safe_load(Path(source).read_text(encoding="utf-8"))
            if not isinstance(source, Mapping):
                raise ConfigError("a config file holds one mapping")
        if section is not None:
            source = source.get(section, {})
        known = {f.name: f for f in fields(cls)}  # type: ignore[arg-type]
        if unknown := sorted(set(source) - set(known)):
            raise ConfigError(f"unknown settings: {', '.join(unknown)}")
        return cls(**{k: tuple(sorted(str(x).strip().lower() for x in v)) if isinstance(v, (list, set, frozenset)) else v for k, v in source.items()})

    def check(self, ok: bool, what: str) -> None:
        if not ok:
            raise ConfigError(what)


@dataclass(frozen=True)
class AffinityConfig(Settings):
    scoring_version: str = "behavior_affinity_v1"
    play_count_log_weight: float = 1.0
    completion_rate_weight: float = 1.5
    intentional_start_rate_weight: float = 1.0
    recency_score_weight: float = 0.5
    early_skip_rate_weight: float = -2.0
    early_skip_threshold_ms: int = 30_000
    recency_half_life_days: float = 180.0
    completion_threshold: float = 0.90
    session_gap_minutes: int = 30
    complete_end_reasons: tuple[str, ...] = COMPLETE_END
    skip_end_reasons: tuple[str, ...] = SKIP_END
    intentional_start_reasons: tuple[str, ...] = INTENTIONAL_START
    passive_start_reasons: tuple[str, ...] = PASSIVE_START

    def __post_init__(self) -> None:
        self.check(bool(self.scoring_version.strip()), "scoring_version is empty")
        self.check(self.early_skip_threshold_ms >= 0, "early_skip_threshold_ms is negative")
        self.check(self.recency_half_life_days > 0, "recency_half_life_days must be positive")
        self.check(0 < self.completion_threshold <= 1, "completion_threshold is outside (0, 1]")
        self.check(self.session_gap_minutes > 0, "session_gap_minutes must be positive")
        self.check(not set(self.intentional_start_reasons) & set(self.passive_start_reasons), "start reasons overlap")

    @property
    def weights(self) -> dict[str, float]:
        return {"play_count": self.play_count_log_weight, "completion": self.completion_rate_weight, "intentional_start": self.intentional_start_rate_weight, "recency": self.recency_score_weight, "early_skip": self.early_skip_rate_weight}


@dataclass(frozen=True)
class TemporalConfig(Settings):
    dataset_version: str = "temporal_taste_v1"
    period_days: int = 90
    validation_fraction: float = 0.20
    test_fraction: float = 0.20
    minimum_train_periods: int = 4
    minimum_labeled_events: int = 1
    positive_fraction_threshold: float = 0.60
    negative_fraction_threshold: float = 0.40
    positive_minimum_ms: int = 30_000
    early_skip_maximum_ms: int = 30_000
    recency_half_life_days: float = 180.0
    maximum_sample_weight: float = 5.0
    complete_end_reasons: tuple[str, ...] = COMPLETE_END
    skip_end_reasons: tuple[str, ...] = SKIP_END
    intentional_start_reasons: tuple[str, ...] = INTENTIONAL_START
    passive_start_reasons: tuple[str, ...] = PASSIVE_START
    #: "strict": an artist's prior state ends with the period before; "reference": it
    #: also holds the same period's tracks with smaller ids.
    artist_prior: str = "strict"

    def __post_init__(self) -> None:
        self.check(self.period_days >= 1, "period_days must be positive")
        self.check(0 < self.validation_fraction < 1 and 0 < self.test_fraction < 1 and self.validation_fraction + self.test_fraction < 1, "split fractions are out of range")
        self.check(self.minimum_train_periods >= 1 and self.minimum_labeled_events >= 1, "minimum counts must be positive")
        self.check(0 <= self.negative_fraction_threshold <= 0.5 <= self.positive_fraction_threshold <= 1 and self.negative_fraction_threshold < self.positive_fraction_threshold, "label thresholds are out of range")
        self.check(self.artist_prior in ("strict", "reference"), "artist_prior is strict or reference")


@dataclass(frozen=True)
class IdentityPolicy(Settings):
    policy_version: str = "identity_v1"
    title_artist_exact_confidence: float = 0.90
    fuzzy_title_threshold: float = 0.86
    fuzzy_album_weight: float = 0.15
    fuzzy_min_margin: float = 0.04
    max_candidates: int = 5

    def __post_init__(self) -> None:
        self.check(0 < self.fuzzy_title_threshold <= 1 and 0 <= self.fuzzy_album_weight < 1, "fuzzy settings are out of range")
        self.check(self.max_candidates >= 1 and 0 <= self.fuzzy_min_margin <= 1, "candidate settings are out of range")


@dataclass(frozen=True)
class RankingConfig(Settings):
    audio_similarity_weight: float = 0.50
    predicted_preference_weight: float = 0.35
    novelty_bonus_weight: float = 0.15
    preference_only_novelty_bonus_weight: float = 0.0
    artist_repetition_penalty: float = 0.10
    maximum_per_artist: int = 3
    explanation_feature_count: int = 5

    def __post_init__(self) -> None:
        self.check(min(self.audio_similarity_weight, self.predicted_preference_weight, self.novelty_bonus_weight, self.preference_only_novelty_bonus_weight, self.artist_repetition_penalty) >= 0, "weights are negative")
        self.check(self.audio_similarity_weight + self.predicted_preference_weight + self.novelty_bonus_weight > 0, "no weight is positive")
        self.check(self.maximum_per_artist >= 1, "maximum_per_artist must be positive")


@dataclass(frozen=True)
class TasteMapConfig(Settings):
    minimum_clusters: int = 2
    maximum_clusters: int = 12
    seeds: tuple[int, ...] = (11, 29, 47)
    density_sizes: tuple[int, ...] = (5, 10, 20)
