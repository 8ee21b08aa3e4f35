"""Readers of the other inputs: typed JSON lines, catalogues, candidates, bulk dumps."""

from __future__ import annotations

import io
import json
import os
import tarfile
from collections.abc import Callable, Iterator, Mapping
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.contracts import ASSET, CATALOG, RIGHTS, ContractError, assert_all, assert_unique
from refrain.functions.text import blank_to_null, track_uri
from refrain.operators.identity import top_weighted


def read_jsonl(spark: SparkSession, path: str, schema: str, *, unique: tuple[str, ...] = ()) -> DataFrame:
    """A trusted JSON-lines table: a value of another type fails the read, as do
    unknown fields and repeated keys."""
    known = set(spark.createDataFrame([], schema).columns)
    names = spark.read.text(path).select(F.explode(F.json_object_keys("value")).alias("k")).distinct().filter(~F.col("k").isin(*known)).limit(1).collect()
    if names:
        raise ContractError(f"unknown field {names[0].k}")
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return assert_unique(df, *unique) if unique else df


def read_feedback(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The feedback log; a path that doesn't exist yet is an empty log."""
    from pyspark.errors import AnalysisException

    try:
        return read_jsonl(spark, path, schema, unique=("feedback_id",))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_account_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Library and playlist tracks, the library first; local tracks and episodes are skipped."""
    track = "struct<artist:string,album:string,track:string,uri:string>"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(folder)
    texts = files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), F.col("content").cast("string").alias("json"))
    library = F.from_json("json", f"struct<tracks:array<{track}>,bannedTracks:array<{track}>>")
    saved = texts.filter(F.lower("source_file") == "yourlibrary.json").withColumn("l", library)
    parts = None
    for order, (field, name) in enumerate((("tracks", "library"), ("bannedTracks", "banned"))):
        part = saved.select("source_file", F.lit(name).alias("source_collection"), F.lit(order).alias("_o"), F.posexplode(f"l.{field}").alias("_i", "t"))
        rows = part.select("t.uri", F.col("t.track").alias("track_name"), F.col("t.artist").alias("artist_name"), F.col("t.album").alias("album_name"), "source_file", "source_collection", "_o", F.col("_i").cast("long").alias("_i"))
        parts = rows if parts is None else parts.unionByName(rows)
    item = "struct<track:struct<trackName:string,artistName:string,albumName:string,trackUri:string>>"
    lists = texts.filter(F.lower("source_file").rlike(r"^playlist\d*\.json$")).withColumn("p", F.from_json("json", f"struct<playlists:array<struct<name:string,items:array<{item}>>>>"))
    named = lists.select("source_file", F.posexplode("p.playlists").alias("_p", "pl")).select("source_file", "_p", F.col("pl.name").alias("source_collection"), F.posexplode("pl.items").alias("_i", "it"))
    rows = named.select(F.col("it.track.trackUri").alias("uri"), F.col("it.track.trackName").alias("track_name"), F.col("it.track.artistName").alias("artist_name"), F.col("it.track.albumName").alias("album_name"), "source_file", "source_collection", F.lit(2).alias("_o"), (F.col("_p") * 1_000_000 + F.col("_i")).cast("long").alias("_i"))
    both = parts.unionByName(rows).withColumn("track_uri", track_uri(F.col("uri"))).filter("track_uri IS NOT NULL")
    from refrain.operators.identity import dedup_catalog

    ordered = both.withColumn("_order", F.struct("_o", F.lower("source_file"), "_i"))
    return dedup_catalog(ordered, "_order").select(*(c.split()[0] for c in CATALOG.split(", ")))


def read_playlist(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, dict[str, int]]:
    """The tracks of the one playlist of that name (case ignored), in order, and what was skipped."""
    item = "struct<track:struct<trackName:string,artistName:string,albumName:string,trackUri:string>>"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[pP]laylist*.json").load(folder)
    lists = files.select(F.explode(F.from_json(F.col("content").cast("string"), f"struct<playlists:array<struct<name:string,items:array<{item}>>>>")["playlists"]).alias("p"))
    named = lists.filter(F.lower(F.trim("p.name")) == name.strip().lower())
    if named.count() != 1:
        raise ContractError(f"there isn't just one playlist named {name}")
    rows = named.select(F.posexplode("p.items").alias("position", "it")).select("position", track_uri(F.col("it.track.trackUri")).alias("track_uri"), F.col("it.track.trackName").alias("track_name"), F.col("it.track.artistName").alias("artist_name"), F.col("it.track.albumName").alias("album_name"))
    tracks = rows.filter("track_uri IS NOT NULL")
    kept = tracks.groupBy("track_uri").agg(F.min_by(F.struct("position", "track_name", "artist_name", "album_name"), "position").alias("t")).select("track_uri", "t.*")
    n, known, unique = rows.count(), tracks.count(), kept.count()
    return kept.orderBy("position"), {"items": n, "not_tracks": n - known, "duplicates": known - unique}


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidates from CSV, JSON lines or plain lines of URIs, ids and share links.

    Aliases uri, url, title, artist and album are understood; a row whose URI and
    URL differ, an unreadable one and a repeated track fail the read.
    """
    suffix = Path(path).suffix.lower()
    if suffix == ".csv":
        df = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    elif suffix in (".jsonl", ".ndjson", ".json"):
        df = spark.read.json(path)
    else:
        df = spark.read.text(path).select(F.col("value").alias("uri")).filter(F.trim("uri") != "")
    have = {c.lower(): c for c in df.columns}

    def named(*aliases: str) -> F.Column:
        found = [blank_to_null(F.col(have[a]).cast("string")) for a in aliases if a in have]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    uri, url = track_uri(named("spotify_uri", "track_uri", "uri", "track_id")), track_uri(named("url"))
    rows = df.select(F.coalesce(uri, url).alias("spotify_uri"), uri.alias("_uri"), url.alias("_url"), named("track_name", "title").alias("track_name"), named("artist_name", "artist").alias("artist_name"), named("album_name", "album").alias("album_name"))
    assert_all(rows, F.col("spotify_uri").isNotNull(), "a candidate has no readable URI")
    assert_all(rows, F.coalesce(F.col("_uri") == F.col("_url"), F.lit(True)), "a candidate's URI and URL differ")
    return assert_unique(rows.select(F.col("spotify_uri").alias("track_id"), "spotify_uri", "track_name", "artist_name", "album_name"), "track_id")


def read_durations(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of track key to positive milliseconds, as (track_key, duration_ms)."""
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("track_key", "_v")).select(F.trim("track_key").alias("track_key"), F.when(F.col("_v").rlike("^[0-9]+$"), F.col("_v").cast("long")).alias("duration_ms"))
    return assert_all(rows, (F.col("track_key") != "") & (F.col("duration_ms") > 0), "a duration isn't a positive integer")


def _header(spark: SparkSession, path: str, schema: str, sep: str = ",") -> None:
    want = [c.split()[0] for c in schema.split(", ")]
    first = spark.read.text(path).first()
    if first is None or first.value.lstrip("﻿").rstrip("\r").split(sep) != want:
        raise ContractError(f"the header of {path} isn't {sep.join(want)}")


def read_dump(spark: SparkSession, path: str, schema: str, *, member: str | None = None, scratch: str | None = None) -> DataFrame:
    """A bulk CSV dump with an exact header, read in parallel; empty fields are null.

    A ``.tar`` or ``.tar.zst`` can't be split, so its ``member`` is first copied
    by a stream to ``scratch``, a folder that all executors share.
    """
    if path.endswith((".tar", ".tar.zst")):
        if not member or not scratch:
            raise ContractError("an archive needs a member and a shared scratch folder")
        path = extract_member(path, member, scratch)
    _header(spark, path, schema)
    return spark.read.schema(schema).option("header", True).option("lineSep", "\n").option("enforceSchema", False).option("mode", "FAILFAST").option("quote", '"').option("escape", '"').csv(path)


def extract_member(archive: str, member: str, folder: str) -> str:
    """Stream one member of a tar (zstandard-compressed or not) to a file; no more is kept in memory than a block."""
    out = os.path.join(folder, os.path.basename(member))

    def copy(stream: Any) -> None:
        with tarfile.open(fileobj=stream, mode="r|") as tar:
            for entry in tar:
                if entry.isfile() and (entry.name == member or entry.name.endswith("/" + member)):
                    source = tar.extractfile(entry)
                    with open(out + ".part", "wb") as f:
                        while block := source.read(1 << 20):
                            f.write(block)
                    os.replace(out + ".part", out)
                    return
        raise ContractError(f"{archive} has no {member}")

    with open(archive, "rb") as raw:
        if archive.endswith(".zst"):
            import zstandard

            with zstandard.ZstdDecompressor().stream_reader(raw) as stream:
                copy(io.BufferedReader(stream, 1 << 20))
        else:
            copy(raw)
    return out


def read_embeddings_tsv(spark: SparkSession, path: str, dimensions: int = 768) -> DataFrame:
    """(external_id, embedding) of a TSV (bz2 too, which Spark splits) of an id and numbers."""
    schema = "external_id STRING, " + ", ".join(f"v{i} DOUBLE" for i in range(dimensions))
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).option("mode", "FAILFAST").csv(path)
    return assert_unique(df.select("external_id", F.array(*(f"v{i}" for i in range(dimensions))).alias("embedding")), "external_id")


class CachedJson:
    """Driver-side GET of JSON with a content-addressed cache, retries and an offline mode.

    ``fetch(url) -> (status, headers, body)`` is injected, so nothing here opens a
    connection by itself; executors never do.
    """

    def __init__(self, fetch: Callable[[str], tuple[int, Mapping[str, str], bytes]], cache: str, *, offline: bool = False, retries: int = 3, cap: int = 25_000_000, pause: Callable[[float], None] | None = None, interval: float = 0.0):
        import time

        self.fetch, self.cache, self.offline, self.retries, self.cap, self.interval = fetch, Path(cache), offline, retries, cap, interval
        self.pause = pause or time.sleep
        self.requests = 0

    def get(self, url: str) -> Any:
        import hashlib

        at = self.cache / f"{hashlib.sha256(url.encode()).hexdigest()}.json"
        if at.exists():
            return json.loads(at.read_text(encoding="utf-8"))
        if self.offline:
            raise ContractError(f"{url} isn't in the cache, and this is offline")
        for attempt in range(self.retries + 1):
            if self.requests and self.interval:
                self.pause(self.interval)
            self.requests += 1
            status, headers, body = self.fetch(url)
            if status == 200:
                break
            if status != 429 and status < 500 or attempt == self.retries:
                raise ContractError(f"{url} answered {status}")
            self.pause(float(headers.get("Retry-After", 2**attempt)))
        if len(body) > self.cap:
            raise ContractError(f"{url} answered more than {self.cap} bytes")
        value = json.loads(body)
        self.cache.mkdir(parents=True, exist_ok=True)
        part = at.with_suffix(".part")
        part.write_text(json.dumps(value), encoding="utf-8")
        os.replace(part, at)
        return value


def map_recordings(client: CachedJson, queries: DataFrame, url: Callable[[Mapping[str, str | None]], str], top: int) -> DataFrame:
    """Look up the ``top`` queries, by plays, milliseconds and id, one by one on the driver; an answer is one mapping or none."""
    rows = []
    for q in top_weighted(queries, top).collect():
        found = client.get(url(q.asDict()))
        if isinstance(found, list):
            if len(found) > 1:
                raise ContractError("a lookup gave several recordings")
            found = found[0] if found else None
        if found and found.get("recording_mbid"):
            rows.append((q["track_id"], found["recording_mbid"].lower(), found.get("recording_name"), found.get("artist_credit_name"), found.get("release_name"), float(found.get("confidence", 1.0))))
    return queries.sparkSession.createDataFrame(rows, "track_id string, recording_mbid string, recording_name string, artist_credit_name string, release_name string, confidence double")


def fetch_documents(client: CachedJson, spark: SparkSession, ids: list[str], url: Callable[[list[str]], str], batch: int = 25) -> DataFrame:
    """(mbid, document) from a service that answers up to ``batch`` ids at once with
    documents by submission offset; offset 0, or else the lowest, is taken."""
    rows = []
    for i in range(0, len(ids), batch):
        for mbid, by_offset in client.get(url(ids[i : i + batch])).items():
            offsets = {int(k): v for k, v in by_offset.items() if str(k).isdigit()} if isinstance(by_offset, dict) else {}
            if offsets:
                rows.append((mbid.lower(), json.dumps(offsets[min(offsets)])))
    return spark.createDataFrame(rows, "mbid string, document string")


def read_audio_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Recordings that may be analysed: track_id, audio_path, rights_basis.

    Every field is required, ids are unique and the rights, without case, are of a
    fixed list. A relative path is one beside the manifest. No row at all is an error.
    """
    rows = read_jsonl(spark, path, ASSET, unique=("track_id",)).select(*(blank_to_null(c).alias(c) for c in ("track_id", "audio_path", "rights_basis")))
    assert_all(rows, F.col("track_id").isNotNull() & F.col("audio_path").isNotNull(), "an asset has no id or path")
    rows = assert_all(rows.withColumn("rights_basis", F.lower("rights_basis")), F.col("rights_basis").isin(*RIGHTS), f"rights_basis must be one of {', '.join(RIGHTS)}")
    if rows.isEmpty():
        raise ContractError(f"{path} lists no recording")
    beside = F.concat(F.lit(path.rpartition("/")[0] + "/"), "audio_path")
    return rows.withColumn("audio_path", F.when(F.col("audio_path").rlike("^([A-Za-z][A-Za-z0-9+.-]*:)?/"), F.col("audio_path")).otherwise(beside))


def audio_jobs(assets: DataFrame, files: DataFrame, settings: Mapping[str, Any]) -> DataFrame:
    """Assets with content_sha256 and job_key, the digest of id, rights, content and settings.

    ``files`` has path and content, as the binary file source reads them. A job is
    done anew if any of these change, model versions being part of ``settings``.
    Contents become digests before the join; an asset without its file is an error.
    """

    def local(c: str) -> Column:
        return F.regexp_replace(c, "^file:/+", "/")

    digests = files.select(local("path").alias("_path"), F.sha2("content", 256).alias("content_sha256"))
    found = assets.withColumn("_path", local("audio_path")).join(digests, "_path", "left").drop("_path")
    assert_all(found, F.col("content_sha256").isNotNull(), "an asset's file is missing")
    given = F.lit(json.dumps(dict(settings), sort_keys=True))
    return found.withColumn("job_key", F.sha2(F.to_json(F.struct("track_id", "rights_basis", "content_sha256", given.alias("settings"))), 256))


def audio_windows(spark: SparkSession, path: str, extract: Callable[[bytes], list[list[float]]]) -> DataFrame:
    """(path, windows) of audio files by an injected extractor, one file at a time on the executors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                yield pd.DataFrame({"path": [name], "windows": [extract(content)]})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(run, "path string, windows array<array<double>>")


def uncached(work: DataFrame, cache: DataFrame, key: str = "job_key") -> DataFrame:
    """Jobs whose result isn't in the cache yet, by a key of content, settings and model."""
    return work.join(cache.select(key).distinct(), key, "left_anti")
