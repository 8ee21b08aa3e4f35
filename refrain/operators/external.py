"""Joins with external catalogues: canonical recordings, acoustic features, embeddings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions.text import combined_lookup, mbids, normalized_exact, spaced_exact


def canonical_map(queries: DataFrame, dump: DataFrame) -> DataFrame:
    """Queries (track_id, track_name, artist_name, album_name) with the one recording
    their normalised names agree on; a query with several recordings is left out.

    ``dump`` has the canonical columns and a ``row`` order. A release, where the
    query names one, must agree too. If the dump has ``combined_lookup``, a row counts
    only where that or the artist's name as given (without case) agrees as well. Of a
    recording's rows the one with the highest score stands for it, the first of equals.
    """
    form = normalized_exact
    q = queries.select("track_id", form(F.col("artist_name")).alias("ka"), form(F.col("track_name")).alias("kt"), form(F.col("album_name")).alias("kr"), combined_lookup("artist_name", "track_name").alias("kc"), F.lower("artist_name").alias("kn")).filter("ka <> '' AND kt <> ''")
    d = dump.select("*", form(F.col("artist_credit_name")).alias("ka"), form(F.col("recording_name")).alias("kt"), form(F.col("release_name")).alias("dr"))
    wanted = q.select("ka", "kt").distinct()
    hits = q.join(d.join(wanted, ["ka", "kt"], "left_semi"), ["ka", "kt"]).filter("kr = '' OR kr = dr")
    if "combined_lookup" in dump.columns:
        hits = hits.filter((F.lower("combined_lookup") == F.col("kc")) | (F.lower("artist_credit_name") == F.col("kn")))
    best = Window.partitionBy("track_id", F.lower("recording_mbid")).orderBy(F.desc("score"), "row")
    one = hits.withColumn("_n", F.row_number().over(best)).filter("_n = 1")
    counted = one.withColumn("recordings", F.count(F.lit(1)).over(Window.partitionBy("track_id"))).filter("recordings = 1")
    return counted.select("track_id", F.lower(F.trim("recording_mbid")).alias("recording_mbid"), "recording_name", "artist_credit_name", F.lower(F.nullif(F.trim("release_mbid"), F.lit(""))).alias("release_mbid"), F.nullif(F.trim("release_name"), F.lit("")).alias("release_name"), mbids(F.col("artist_mbids")).alias("artist_mbids"))


def resolve_external(queries: DataFrame, mapped: DataFrame, *, minimum_confidence: float = 0.90) -> DataFrame:
    """exact if title, artist and (where given) release agree and the confidence
    suffices, else fuzzy; a query without mapping is unmatched."""
    m = mapped.select("track_id", "recording_mbid", "recording_name", "artist_credit_name", "release_name", "confidence" if "confidence" in mapped.columns else F.lit(1.0).alias("confidence"))
    rows = queries.join(m, "track_id", "left")
    same = (normalized_exact(F.col("track_name")) == normalized_exact(F.col("recording_name"))) & (normalized_exact(F.col("artist_name")) == normalized_exact(F.col("artist_credit_name"))) & ((normalized_exact(F.col("album_name")) == "") | (normalized_exact(F.col("album_name")) == normalized_exact(F.col("release_name"))))
    status = F.when(F.col("recording_mbid").isNull(), "unmatched").when(F.coalesce(same, F.lit(False)) & (F.col("confidence") >= minimum_confidence), "exact").otherwise("fuzzy")
    return rows.withColumn("match_status", status)


def lowest_offset(section: DataFrame, *, key: str = "mbid", offset: str = "submission_offset", tie: Sequence[str] = ()) -> DataFrame:
    """One row a key: the lowest submission offset's, the first of ties."""
    rest = [c for c in section.columns if c != key]
    picked = F.min_by(F.struct(*rest), F.struct(offset, *tie))
    return section.groupBy(key).agg(picked.alias("_s")).select(key, "_s.*")


def merge_sections(sections: Mapping[str, DataFrame], *, key: str = "mbid", wanted: DataFrame | None = None) -> DataFrame:
    """Full outer join of sections by key, each as one struct column; ``wanted`` keeps its keys alone."""
    out = None
    for name, section in sections.items():
        if wanted is not None:
            section = section.join(wanted.select(key).distinct(), key, "left_semi")
        packed = section.select(key, F.struct(*(c for c in section.columns if c != key)).alias(name))
        out = packed if out is None else out.join(packed, key, "full_outer")
    return out


def long_features(wide: DataFrame, *, key: str, numbers: Mapping[str, Column], texts: Mapping[str, Column], source: str, version: str, coverage: Column, confidence: Column, vectors: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One observation row for each feature that is known; a vector feature only if all of its parts are."""
    null = F.lit(None)

    def entry(name: str, number: Column = null, text: Column = null, vector: Column = null) -> Column:
        return F.struct(F.lit(name).alias("feature_name"), number.cast("double").alias("value_number"), text.cast("string").alias("value_text"), vector.cast("array<double>").alias("value_vector"))

    entries = [entry(n, number=c) for n, c in numbers.items()] + [entry(n, text=c) for n, c in texts.items()]
    for name, parts in (vectors or {}).items():
        values = [numbers[p].cast("double") for p in parts]
        whole = values[0].isNotNull()
        for v in values[1:]:
            whole &= v.isNotNull()
        entries.append(entry(name, vector=F.when(whole, F.array(*values))))
    rows = wide.select(F.col(key).alias("track_id"), coverage.alias("coverage_seconds"), confidence.alias("feature_confidence"), F.explode(F.array(*entries)).alias("_e"))
    known = F.coalesce(F.col("_e.value_number").isNotNull() & ~F.isnan("_e.value_number"), F.lit(False)) | F.col("_e.value_text").isNotNull() | F.col("_e.value_vector").isNotNull()
    return rows.filter(known).select("track_id", "_e.feature_name", F.lit(source).alias("feature_source"), F.lit(version).alias("source_version"), "_e.value_number", "_e.value_text", "_e.value_vector", "coverage_seconds", "feature_confidence")


def corroborated(targets: DataFrame, info: DataFrame, *, key: str = "spotify_id") -> DataFrame:
    """Targets joined with an external catalogue by id, where title, artist and (if both
    have one) album agree; ``reason`` tells what became of each: matched,
    not_found, ambiguous_id (the id stands for several external rows) or metadata_mismatch."""
    i = info.select(key, F.col("track_name").alias("i_name"), F.col("artist_name").alias("i_artist"), F.col("album_name").alias("i_album"), "external_id")
    i = i.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    one = i.filter("_n = 1").drop("_n")
    many = i.filter("_n > 1").select(key).distinct().withColumn("_many", F.lit(True))
    rows = targets.join(one, key, "left").join(many, key, "left")
    album = (spaced_exact(F.col("album_name")) == "") | (spaced_exact(F.col("i_album")) == "") | (spaced_exact(F.col("album_name")) == spaced_exact(F.col("i_album")))
    same = (spaced_exact(F.col("track_name")) == spaced_exact(F.col("i_name"))) & (spaced_exact(F.col("artist_name")) == spaced_exact(F.col("i_artist"))) & album
    reason = F.when(F.col("_many"), "ambiguous_id").when(F.col("external_id").isNull(), "not_found").when(same, "matched").otherwise("metadata_mismatch")
    return rows.withColumn("reason", reason).drop("_many", "i_name", "i_artist", "i_album")


def feature_coverage(observations: DataFrame, tracks: DataFrame) -> DataFrame:
    """Per feature: observations, and the shares of tracks, plays and milliseconds that have it."""
    w = tracks.select("track_id", "play_count", "total_ms_played")
    total = w.agg(F.count(F.lit(1)).alias("_t"), F.sum("play_count").alias("_p"), F.sum("total_ms_played").alias("_m"))
    have = observations.select("feature_name", "track_id").distinct().join(w, "track_id")
    sums = have.groupBy("feature_name").agg(F.count(F.lit(1)).alias("tracks"), F.sum("play_count").alias("plays"), F.sum("total_ms_played").alias("ms"))
    joined = sums.crossJoin(F.broadcast(total))  # a single row
    return joined.select("feature_name", "tracks", *(F.round(F.col(a) / F.col(b), 6).alias(f"{n}_rate") for a, b, n in (("tracks", "_t", "track"), ("plays", "_p", "play"), ("ms", "_m", "ms"))))


def import_embeddings(targets: DataFrame, info: DataFrame, embeddings: DataFrame, *, name: str, source: str, version: str, confidence: float, coverage_seconds: float = 30.0) -> tuple[DataFrame, DataFrame]:
    """(observations, audit): embeddings (external_id, embedding) of the targets that ``info``
    corroborates, as vector features; the audit counts targets by reason, ``no_embedding`` among them."""
    rows = corroborated(targets, info).join(embeddings, "external_id", "left")
    reason = F.when((F.col("reason") == "matched") & F.col("embedding").isNull(), "no_embedding").otherwise(F.col("reason"))
    rows = rows.withColumn("reason", reason)
    found = rows.filter("reason = 'matched'").select(
        "track_id",
        F.lit(name).alias("feature_name"),
        F.lit(source).alias("feature_source"),
        F.lit(version).alias("source_version"),
        F.lit(None).cast("double").alias("value_number"),
        F.lit(None).cast("string").alias("value_text"),
        F.col("embedding").cast("array<double>").alias("value_vector"),
        F.lit(coverage_seconds).alias("coverage_seconds"),
        F.lit(confidence).alias("feature_confidence"),
    )
    return found, rows.groupBy("reason").agg(F.count(F.lit(1)).alias("targets"))
