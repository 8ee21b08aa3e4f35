"""Schemas of the tables at the boundaries, and checks on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_HISTORY = "ts STRING, ms_played BIGINT, platform STRING, conn_country STRING, ip_addr STRING, ip_addr_decrypted STRING, username STRING, user_agent_decrypted STRING, user_agent STRING, master_metadata_track_name STRING, master_metadata_album_artist_name STRING, master_metadata_album_album_name STRING, spotify_track_uri STRING, episode_name STRING, episode_show_name STRING, spotify_episode_uri STRING, reason_start STRING, reason_end STRING, shuffle BOOLEAN, skipped BOOLEAN, offline BOOLEAN, offline_timestamp BIGINT, incognito_mode BOOLEAN, endTime STRING, msPlayed BIGINT, trackName STRING, artistName STRING, episodeName STRING, podcastName STRING"
EVENT = "schema_version INT, event_id STRING, played_at TIMESTAMP, media_type STRING, ms_played BIGINT, track_uri STRING, track_name STRING, artist_name STRING, album_name STRING, episode_uri STRING, episode_name STRING, show_name STRING, reason_start STRING, reason_end STRING, shuffle BOOLEAN, skipped BOOLEAN, offline BOOLEAN, incognito_mode BOOLEAN, platform_family STRING, source_file STRING, source_record_index BIGINT"
OBSERVATION = "schema_version INT, track_id STRING, feature_name STRING, feature_source STRING, source_version STRING, value_number DOUBLE, value_text STRING, value_vector ARRAY<DOUBLE>, coverage_seconds DOUBLE, feature_confidence DOUBLE"
CATALOG = "track_uri STRING, track_name STRING, artist_name STRING, album_name STRING, source_file STRING, source_collection STRING"
QUERY = "source_track_id STRING, source_identity_source STRING, track_uri STRING, track_name STRING, artist_name STRING, album_name STRING, play_count BIGINT, total_ms_played BIGINT"
CANONICAL = "id BIGINT, artist_credit_id BIGINT, artist_mbids STRING, artist_credit_name STRING, release_mbid STRING, release_name STRING, recording_mbid STRING, recording_name STRING, combined_lookup STRING, score BIGINT"
LOWLEVEL = "mbid STRING, submission_offset INT, average_loudness DOUBLE, dynamic_complexity DOUBLE, mfcc_zero_mean DOUBLE"
RHYTHM = "mbid STRING, submission_offset INT, bpm DOUBLE, bpm_histogram_first_peak_bpm_mean DOUBLE, bpm_histogram_first_peak_bpm_median DOUBLE, bpm_histogram_second_peak_bpm_mean DOUBLE, bpm_histogram_second_peak_bpm_median DOUBLE, danceability DOUBLE, onset_rate DOUBLE"
TONAL = "mbid STRING, submission_offset INT, key_key STRING, key_scale STRING, tuning_frequency DOUBLE, tuning_equal_tempered_deviation DOUBLE"
FEEDBACK = "schema_version INT, feedback_id STRING, recommendation_run_id STRING, track_id STRING, outcome STRING, recorded_at TIMESTAMP"
ASSET = "track_id STRING, audio_path STRING, rights_basis STRING"
# What allows a recording to be analysed.
RIGHTS = ("owned", "licensed", "public_domain", "creative_commons")
OUTCOMES = ("accepted", "rejected", "saved", "skipped", "listened")

# Keys that must not leave the raw boundary.
FORBIDDEN_KEYS = ("conn_country", "ip_addr", "ip_addr_decrypted", "offline_timestamp", "user_agent", "user_agent_decrypted", "username")


class ContractError(ValueError):
    """A table breaks its contract."""


def forbidden_fields(schema: T.DataType, path: str = "") -> list[str]:
    """Paths of forbidden names anywhere in a schema; no row is read."""
    out: list[str] = []
    if isinstance(schema, T.StructType):
        for f in schema.fields:
            here = f"{path}.{f.name}" if path else f.name
            if f.name.lower() in FORBIDDEN_KEYS:
                out.append(here)
            out += forbidden_fields(f.dataType, here)
    elif isinstance(schema, T.ArrayType):
        out += forbidden_fields(schema.elementType, f"{path}[]")
    elif isinstance(schema, T.MapType):
        out += forbidden_fields(schema.valueType, f"{path}{{}}")
    return out


def assert_private(df: DataFrame) -> DataFrame:
    if found := forbidden_fields(df.schema):
        raise ContractError(f"private fields: {', '.join(found)}")
    return df


def assert_all(df: DataFrame, condition: Column, what: str) -> DataFrame:
    """Every row satisfies ``condition``; null counts as a failure."""
    if df.filter(~F.coalesce(condition, F.lit(False))).limit(1).count():
        raise ContractError(what)
    return df


def assert_unique(df: DataFrame, *keys: str) -> DataFrame:
    if df.groupBy(*keys).count().filter("count > 1").limit(1).count():
        raise ContractError(f"{', '.join(keys)} isn't unique")
    return df


def assert_known_fields(df: DataFrame, schema: str) -> DataFrame:
    """No column beyond those of the contract."""
    known = set(T.StructType.fromDDL(schema).names)
    if extra := sorted(set(df.columns) - known):
        raise ContractError(f"unknown fields: {', '.join(extra)}")
    return df
