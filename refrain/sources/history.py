"""Raw playback history: discovery, normalisation, rejects, first-wins dedup, report."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refrain.contracts import FORBIDDEN_KEYS, RAW_HISTORY, assert_private
from refrain.functions.text import EPISODE_URI, TRACK_URI, blank_to_null, platform_family

# File name beginnings of history exports.
PREFIXES = ("streaming_history_audio_", "streaminghistory_music_", "streaminghistory_podcast_", "endsong")

_RAW = "source_file string, source_record_index long, record string"


def _wanted(name: str) -> bool:
    low = name.replace("\\", "/").rsplit("/", 1)[-1].lower()
    return low.endswith(".json") and low.startswith(PREFIXES)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, source_record_index, record) of every record under ``path``: a
    JSON file, a folder searched in depth, or a ZIP of such files. ``record`` is JSON text.

    Files are read whole by one task each, since an export is one array a file;
    exports are at most some tens of megabytes each.
    """

    # A file named outright is read whatever its name; in a folder names tell.
    only = path.rstrip("/") if path.lower().endswith(".json") else "\0"

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                if name.lower().endswith(".zip"):
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        files = [(n, z.read(n)) for n in sorted(z.namelist(), key=str.lower) if _wanted(n)]
                else:
                    files = [(name, content)] if _wanted(name) or name.endswith(only) else []
                for n, data in files:
                    records = json.loads(data)
                    if not isinstance(records, list):
                        raise ValueError(f"{n} doesn't hold an array")
                    for i in range(0, len(records), 10_000):
                        part = records[i : i + 10_000]
                        yield pd.DataFrame({"source_file": n.replace("\\", "/").rsplit("/", 1)[-1], "source_record_index": range(i, i + len(part)), "record": [json.dumps(r, ensure_ascii=False) for r in part]})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.filter(F.lower("path").rlike(r"\.(json|zip)$")).mapInPandas(split, _RAW)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, wherever the optimizer puts the whole."""
    return F.transform(F.array(value), body)[0]


_FLAGS = ("shuffle", "skipped", "offline", "incognito_mode")
_TEXTS = ("track_uri", "episode_uri", "track_name", "artist_name", "album_name", "episode_name", "show_name", "reason_start", "reason_end", "platform")


def _typed(r: Column) -> Column:
    """The current fields of a record, from its own or legacy names; blank texts are null."""
    legacy = F.regexp_replace(r["endTime"], r"^(\d{4}-\d{2}-\d{2}) (\d{2}:\d{2})$", "$1T$2:00Z")
    ts = F.coalesce(r["ts"], legacy)
    names = {
        "track_name": F.coalesce(r["master_metadata_track_name"], r["trackName"]),
        "artist_name": F.coalesce(r["master_metadata_album_artist_name"], r["artistName"]),
        "album_name": r["master_metadata_album_album_name"],
        "track_uri": r["spotify_track_uri"],
        "episode_uri": r["spotify_episode_uri"],
        "episode_name": F.coalesce(r["episode_name"], r["episodeName"]),
        "show_name": F.coalesce(r["episode_show_name"], r["podcastName"]),
    } | {c: r[c] for c in ("reason_start", "reason_end", "platform")}
    return F.struct(ts.alias("ts"), F.coalesce(r["ms_played"], r["msPlayed"]).alias("ms_played"), F.try_to_timestamp(ts).alias("played_at"), *(blank_to_null(names[c]).alias(c) for c in _TEXTS), *(r[c].alias(c) for c in _FLAGS))


def spread(raw: DataFrame) -> DataFrame:
    """Raw records over all tasks: a file is read by one, but parsing is most of the work."""
    return raw.repartition(int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source_file", "source_record_index")


def parse(raw: DataFrame) -> DataFrame:
    """Records with their typed fields as ``fields``."""
    return raw.select("source_file", "source_record_index", "record", _let(F.from_json("record", RAW_HISTORY), _typed).alias("fields"))


def media_type(r: Column) -> Column:
    track = r["track_uri"].isNotNull() | F.coalesce(r["track_name"], r["artist_name"], r["album_name"]).isNotNull()
    episode = r["episode_uri"].isNotNull() | F.coalesce(r["episode_name"], r["show_name"]).isNotNull()
    return F.when(track & episode, F.lit(None)).when(track, "track").when(episode, "episode").otherwise("unknown")


def _misfit(value: Column) -> Column:
    return value.isNotNull() & ~value.rlike("^(true|false)$")


def reject_code(r: Column, media: Column, record: Column) -> Column:
    """The code of the first check that fails, in field order; null for a good record."""
    has_offset = r["ts"].rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.coalesce(
        F.when(r["played_at"].isNull() | ~F.coalesce(has_offset, F.lit(False)), "invalid_timestamp"),
        F.when(r["ms_played"].isNull() | (r["ms_played"] < 0), "invalid_ms_played"),
        F.when(r["track_uri"].isNotNull() & ~r["track_uri"].rlike(TRACK_URI), "invalid_spotify_uri"),
        F.when(r["episode_uri"].isNotNull() & ~r["episode_uri"].rlike(EPISODE_URI), "invalid_spotify_uri"),
        F.when(media.isNull(), "ambiguous_media_type"),
        # A flag of another type is null once typed, so its JSON text tells.
        *(F.when(_misfit(F.get_json_object(record, f"$.{c}")), "invalid_boolean") for c in _FLAGS),
    )


def normalize(parsed: DataFrame) -> DataFrame:
    """All records with normalised fields, media type and reject code. Unknown fields go."""

    def coded(r: Column) -> Column:
        names = ("ts", "ms_played", "played_at", *_TEXTS, *_FLAGS)
        return F.struct(*(r[c].alias(c) for c in names), media_type(r).alias("media_type"), reject_code(r, media_type(r), F.col("record")).alias("error_code"))

    return parsed.select("source_file", "source_record_index", "record", _let(F.col("fields"), coded).alias("_n")).select("source_file", "source_record_index", "record", "_n.*")


def event_id() -> Column:
    """SHA-256 of the event's identity as canonical JSON: its keys sorted, no spaces."""
    uri = F.coalesce("track_uri", "episode_uri")
    at = F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")

    def body(identity: Column) -> Column:
        fields = {c: F.col(c) for c in ("incognito_mode", "media_type", "ms_played", "offline", "reason_end", "reason_start", "shuffle", "skipped")}
        fields |= {"media_identity": identity, "played_at": at}
        return F.to_json(F.struct(*(fields[c].alias(c) for c in sorted(fields))), {"ignoreNullFields": "false"})

    names = F.array("track_name", "artist_name", "album_name", "episode_name", "show_name")
    return F.sha2(F.when(uri.isNotNull(), body(uri)).otherwise(body(names)), 256)


def dedup_first(df: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """Of rows with one key the first in source order."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


class RejectedRecord(ValueError):
    """A strict load met a bad record."""


def load_history(spark: SparkSession, path: str, *, strict: bool = False, issues: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(events, rejects, report). Events are deduplicated, first wins, and sorted by
    time and id; rejects are the first ``issues`` by file and index; the report is one row."""
    rows = normalize(parse(spread(read_raw(spark, path)))).cache()
    bad = rows.filter(F.col("error_code").isNotNull())
    if strict and (first := bad.orderBy(F.lower("source_file"), "source_record_index").first()):
        raise RejectedRecord(f"{first.error_code} in {first.source_file}, record {first.source_record_index}")
    good = rows.filter(F.col("error_code").isNull()).withColumn("event_id", event_id())
    events = dedup_first(good.withColumn("_file", F.lower("source_file")), "event_id", ("_file", "source_record_index")).select(
        F.lit(1).alias("schema_version"), "event_id", "played_at", "media_type", "ms_played", "track_uri", "track_name", "artist_name", "album_name", "episode_uri", "episode_name", "show_name", "reason_start", "reason_end", "shuffle", "skipped", "offline", "incognito_mode", platform_family(F.col("platform")).alias("platform_family"), "source_file", "source_record_index"
    )
    counts = rows.agg(F.count(F.lit(1)).alias("records"), F.count("error_code").alias("rejected"))
    kept = events.agg(F.count(F.lit(1)).alias("events"), *(F.count_if(F.col("media_type") == m).alias(f"{m}_events") for m in ("track", "episode", "unknown")))
    report = counts.crossJoin(kept).withColumn("duplicates", F.col("records") - F.col("rejected") - F.col("events"))  # single rows
    rejects = bad.select("source_file", "source_record_index", "error_code").orderBy("source_file", "source_record_index").limit(issues)
    return assert_private(events.orderBy("played_at", "event_id")), rejects, report


def sensitive_counts(raw: DataFrame) -> DataFrame:
    """In how many records each forbidden key stands, at the top level or below."""
    found = raw.select(F.explode(F.array(*(F.when(F.col("record").rlike(f'"{k}"\\s*:'), F.lit(k)) for k in FORBIDDEN_KEYS))).alias("field"))
    return found.filter("field IS NOT NULL").groupBy("field").agg(F.count(F.lit(1)).alias("records"))
