"""Acoustic documents and dump sections as feature observations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.contracts import assert_all
from refrain.functions.vectors import measurement_confidence
from refrain.operators.external import long_features, lowest_offset, merge_sections
from refrain.sources.tables import read_dump

# Where a low-level document keeps its numbers and texts, where a
# high-level one keeps the score of each positive class, and the features' names.
NUMBERS = {
    "average_loudness_v1": "lowlevel.average_loudness",
    "dynamic_complexity_v1": "lowlevel.dynamic_complexity",
    "replay_gain_db_v1": "metadata.audio_properties.replay_gain",
    "beat_count_v1": "rhythm.beats_count",
    "beats_loudness_mean_v1": "rhythm.beats_loudness.mean",
    "tempo_bpm_estimate_v1": "rhythm.bpm",
    "danceability_estimate_v1": "rhythm.danceability",
    "onset_rate_hz_v1": "rhythm.onset_rate",
    "chord_change_rate_v1": "tonal.chords_changes_rate",
    "key_strength_v1": "tonal.key_strength",
    "tuning_deviation_v1": "tonal.tuning_equal_tempered_deviation",
    "tuning_frequency_hz_v1": "tonal.tuning_frequency",
}
TEXTS = {"key_estimate_v1": "tonal.key_key", "mode_estimate_v1": "tonal.key_scale"}
SCORES = {
    "danceable_score_v1": "highlevel.danceability.all.danceable",
    "acoustic_score_v1": "highlevel.mood_acoustic.all.acoustic",
    "aggressive_score_v1": "highlevel.mood_aggressive.all.aggressive",
    "happy_score_v1": "highlevel.mood_happy.all.happy",
    "relaxed_score_v1": "highlevel.mood_relaxed.all.relaxed",
    "instrumental_score_v1": "highlevel.voice_instrumental.all.instrumental",
}
SOURCE, LOW_VERSION, HIGH_VERSION = "acousticbrainz_cc0", "frozen-2022-lowlevel-converter-v1", "frozen-2022-highlevel-converter-v1"
DESCRIPTORS, LEARNED = "acousticbrainz_descriptor_vector_v1", "acousticbrainz_learned_audio_vector_v1"
LENGTH = "metadata.audio_properties.length"
LOW_CEILING, HIGH_CEILING = 0.85, 0.70

# The columns of the dump's three sections.
SECTIONS = {
    "lowlevel": "mbid STRING, submission_offset LONG, average_loudness DOUBLE, dynamic_complexity DOUBLE, mfcc_zero_mean DOUBLE",
    "rhythm": "mbid STRING, submission_offset LONG, bpm DOUBLE, bpm_histogram_first_peak_bpm_mean DOUBLE, bpm_histogram_first_peak_bpm_median DOUBLE, bpm_histogram_second_peak_bpm_mean DOUBLE, bpm_histogram_second_peak_bpm_median DOUBLE, danceability DOUBLE, onset_rate DOUBLE",
    "tonal": "mbid STRING, submission_offset LONG, key_key STRING, key_scale STRING, tuning_frequency DOUBLE, tuning_equal_tempered_deviation DOUBLE",
}

_NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def at(document: Column, path: str) -> Column:
    """What stands at a dotted path of a JSON document, as text; null if nothing does."""
    return F.get_json_object(document, f"$.{path}")


def _number(document: Column, path: str, low: float | None = None, high: float | None = None) -> Column:
    raw = at(document, path)
    value = raw.try_cast("double")
    good = raw.rlike(_NUMBER) & ~F.isnan(value) & (F.abs(value) < float("inf"))
    if low is not None and high is not None:
        good &= value.between(low, high)
    return F.when(raw.isNull(), F.lit(None).cast("double")).when(good, value).otherwise(F.raise_error(F.concat(F.lit(f"{path} isn't a number in range: "), raw)).cast("double"))


def _text(document: Column, path: str) -> Column:
    raw = at(document, path)
    return F.when(raw.isNull(), F.lit(None).cast("string")).when((F.trim(raw) != "") & ~raw.rlike(r"^[\[{]"), F.trim(raw)).otherwise(F.raise_error(F.lit(f"{path} isn't text")).cast("string"))


def _coverage(document: Column) -> Column:
    return F.greatest(F.lit(0.0), F.coalesce(_number(document, LENGTH), F.lit(0.0)))


def matched_documents(matches: DataFrame, documents: DataFrame) -> DataFrame:
    """Exact matches (source_track_id, match_status, recording_mbid) with the documents
    (mbid, low, high: JSON text) of their recordings, told apart without case."""
    exact = matches.filter((F.col("match_status") == "exact") & F.col("recording_mbid").isNotNull()).withColumn("mbid", F.lower("recording_mbid"))
    return exact.join(documents.select(F.lower("mbid").alias("mbid"), "low", "high"), "mbid", "left")


def acoustic_observations(matched: DataFrame) -> DataFrame:
    """One observation for each number, text, class score and whole vector known of a
    matched track. Measurements are trusted by how many seconds they cover: none told
    counts three quarters, half a minute fully. A value of the wrong type fails the job."""
    low, high = F.col("low"), F.col("high")
    rows = matched.withColumn("_low_s", F.when(low.isNotNull(), _coverage(low)).otherwise(0.0))
    rows = rows.withColumn("_high_s", F.coalesce(F.nullif(F.when(high.isNotNull(), _coverage(high)), F.lit(0.0)), F.col("_low_s")))

    def observed(rows: DataFrame, seconds: str, numbers: Mapping[str, Column], texts: Mapping[str, Column], vector: str, version: str, ceiling: float) -> DataFrame:
        confidence = measurement_confidence(F.lit(ceiling), F.nullif(F.col(seconds), F.lit(0.0)))
        return long_features(rows, key="source_track_id", numbers=numbers, texts=texts, source=SOURCE, version=version, coverage=F.col(seconds), confidence=confidence, vectors={vector: tuple(numbers)})

    lows = observed(rows.filter(low.isNotNull()), "_low_s", {n: _number(low, p) for n, p in NUMBERS.items()}, {n: _text(low, p) for n, p in TEXTS.items()}, DESCRIPTORS, LOW_VERSION, LOW_CEILING)
    highs = observed(rows.filter(high.isNotNull()), "_high_s", {n: _number(high, p, 0.0, 1.0) for n, p in SCORES.items()}, {}, LEARNED, HIGH_VERSION, HIGH_CEILING)
    return lows.unionByName(highs)


def acoustic_coverage(matched: DataFrame) -> DataFrame:
    """One row: exact tracks, recordings, and the shares of tracks, plays and milliseconds with low- and high-level documents."""
    out = [F.count(F.lit(1)).alias("exact_tracks"), F.countDistinct("mbid").alias("recordings")]
    for level in ("low", "high"):
        have = F.col(level).isNotNull()
        out.append(F.count_if(have).alias(f"{level}_tracks"))
        for name, w in (("track", F.lit(1)), ("play", F.col("play_count")), ("ms_played", F.col("total_ms_played"))):
            out.append(F.round(F.coalesce(F.sum(F.when(have, w)) / F.nullif(F.sum(w), F.lit(0)), F.lit(0.0)), 6).alias(f"{level}_{name}_rate"))
    return matched.agg(*out)


def read_section(spark: SparkSession, section: str, path: str, *, member: str | None = None, scratch: str | None = None) -> DataFrame:
    """One section's dump with its exact header: mbid in lower case, offsets of 0 and more."""
    rows = read_dump(spark, path, SECTIONS[section], member=member, scratch=scratch).withColumn("mbid", F.lower(F.trim("mbid")))
    return assert_all(rows, F.coalesce(F.col("submission_offset") >= 0, F.lit(False)), f"a {section} row has no valid offset")


def offline_documents(sections: Mapping[str, DataFrame], wanted: DataFrame) -> DataFrame:
    """(mbid, low, high) from dump sections: of a recording each section's lowest submission, as one JSON text."""
    first = {name: lowest_offset(rows.join(wanted.select(F.lower("mbid").alias("mbid")).distinct(), "mbid", "left_semi"), tie=[c for c in rows.columns if c not in ("mbid", "submission_offset")]).drop("submission_offset") for name, rows in sections.items()}
    merged = merge_sections(first)
    return merged.select("mbid", F.to_json(F.struct(*sections)).alias("low"), F.lit(None).cast("string").alias("high"))
