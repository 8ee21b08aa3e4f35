"""Identity resolution: exact, ambiguous, fuzzy or unmatched, each with its evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.config import IdentityPolicy
from refrain.functions.text import normalized, normalized_exact, similarity_ratio

_CANDIDATE = ("track_uri", "track_name", "artist_name", "album_name", "similarity_score", "catalog_source")


def with_keys(df: DataFrame, exact_unicode: bool = True) -> DataFrame:
    """Adds the normal forms ``k_title``, ``k_artist``, ``k_album``."""
    form = normalized_exact if exact_unicode else normalized
    return df.withColumns({key: form(F.col(column)) for column, key in (("track_name", "k_title"), ("artist_name", "k_artist"), ("album_name", "k_album"))})


def catalog_source(df: DataFrame) -> DataFrame:
    return df.withColumn("catalog_source", F.concat_ws(":", "source_file", "source_collection"))


def dedup_catalog(catalog: DataFrame, order: str) -> DataFrame:
    """The first of rows equal in URI, title, artist and album."""
    keys = ("track_uri", "track_name", "artist_name", "album_name")
    w = Window.partitionBy(*keys).orderBy(order)
    return catalog.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def best_candidates(scored: DataFrame, limit: int) -> DataFrame:
    """(source_track_id, candidates, n): the best catalogue row of each URI, then the
    ``limit`` best URIs by score, URI and source. ``n`` counts URIs up to the limit."""
    per_uri = Window.partitionBy("source_track_id", "track_uri").orderBy(F.desc("similarity_score"), "catalog_source")
    per_query = Window.partitionBy("source_track_id").orderBy(F.desc("similarity_score"), "track_uri", "catalog_source")
    best = scored.withColumn("_u", F.row_number().over(per_uri)).filter("_u = 1").withColumn("_q", F.row_number().over(per_query)).filter(F.col("_q") <= limit)
    listed = best.groupBy("source_track_id").agg(F.array_sort(F.collect_list(F.struct("_q", *(F.round("similarity_score", 6).alias(c) if c == "similarity_score" else F.col(c) for c in _CANDIDATE)))).alias("_c"))
    return listed.select("source_track_id", F.transform("_c", lambda c: F.struct(*(c[n].alias(n) for n in _CANDIDATE))).alias("candidates"), F.size("_c").alias("n"))


def _tier(queries: DataFrame, catalog: DataFrame, on: list[str], limit: int, name: str) -> DataFrame:
    rows = catalog.select(*on, *(F.col(c).alias(f"c_{c}") for c in _CANDIDATE if c not in ("similarity_score",)))
    hits = queries.select("source_track_id", *on).join(rows, on)
    scored = hits.select("source_track_id", F.lit(1.0).alias("similarity_score"), *(F.col(f"c_{c}").alias(c) for c in _CANDIDATE if c != "similarity_score"))
    return best_candidates(scored, limit).select("source_track_id", F.col("candidates").alias(f"{name}_c"), F.col("n").alias(f"{name}_n"))


def fuzzy_scores(queries: DataFrame, catalog: DataFrame, policy: IdentityPolicy) -> DataFrame:
    """Scored pairs that share the normalised artist.

    Pairs that can't reach the threshold by their lengths alone are dropped before
    the ratio is taken (2 * shorter / total bounds it), and a pair of texts is
    compared once however many rows hold it.
    """
    left = queries.select("source_track_id", F.col("k_title").alias("q_title"), F.col("k_artist"), F.col("k_album").alias("q_album"))
    right = catalog.select("k_artist", F.col("k_title").alias("c_title"), F.col("k_album").alias("c_album"), *(c for c in _CANDIDATE if c != "similarity_score"))
    bound = 2.0 * F.least(F.length("q_title"), F.length("c_title")) / (F.length("q_title") + F.length("c_title"))
    pairs = left.join(right, "k_artist").filter(bound >= policy.fuzzy_title_threshold)
    titles = pairs.select("q_title", "c_title").distinct().withColumn("title_score", similarity_ratio("q_title", "c_title")).filter(F.col("title_score") >= policy.fuzzy_title_threshold)
    kept = pairs.join(titles, ["q_title", "c_title"])
    both = (F.col("q_album") != "") & (F.col("c_album") != "")
    albums = kept.filter(both).select("q_album", "c_album").distinct().withColumn("album_score", similarity_ratio("q_album", "c_album"))
    joined = kept.join(albums, ["q_album", "c_album"], "left")
    w = policy.fuzzy_album_weight
    total = F.when(F.col("album_score").isNotNull(), (1 - w) * F.col("title_score") + w * F.col("album_score")).otherwise(F.col("title_score"))
    return joined.withColumn("similarity_score", total).filter(F.col("similarity_score") >= policy.fuzzy_title_threshold)


def resolve_identities(queries: DataFrame, catalog: DataFrame, policy: IdentityPolicy | None = None, *, fuzzy: bool = True, exact_unicode: bool = True) -> DataFrame:
    """Resolve every query (unique source_track_id; track_uri, track_name, artist_name,
    album_name) against the catalogue by the first tier that decides.

    Tiers: an own URI; title, artist and album; title and artist; near titles of
    the same artist. Only exact matches resolve. Without ``exact_unicode`` names
    are compared in plain lower case, all in the JVM.
    """
    policy = policy or IdentityPolicy()
    q = with_keys(queries, exact_unicode)
    c = catalog_source(with_keys(catalog, exact_unicode))
    named = q.filter(F.col("track_uri").isNull() & (F.col("k_title") != "") & (F.col("k_artist") != ""))
    uri = _tier(q.filter(F.col("track_uri").isNotNull()), c, ["track_uri"], 1, "uri")
    album = _tier(named.filter(F.col("k_album") != ""), c.filter(F.col("k_album") != ""), ["k_title", "k_artist", "k_album"], policy.max_candidates, "album")
    title = _tier(named, c, ["k_title", "k_artist"], policy.max_candidates, "title")
    rows = q
    for tier in (uri, album, title):
        rows = rows.join(tier, "source_track_id", "left")
    has_uri = F.col("track_uri").isNotNull()
    named_ok = (F.col("k_title") != "") & (F.col("k_artist") != "")
    n = {t: F.coalesce(F.col(f"{t}_n"), F.lit(0)) for t in ("album", "title")}
    open_ = ~has_uri & named_ok & (n["album"] == 0) & ~((F.col("k_album") == "") & (n["title"] == 1)) & (n["title"] <= 1)
    if fuzzy:
        scored = fuzzy_scores(rows.filter(open_), c, policy)
        near = best_candidates(scored, policy.max_candidates).select("source_track_id", F.col("candidates").alias("fuzzy_c"), F.col("n").alias("fuzzy_n"))
        rows = rows.join(near, "source_track_id", "left")
    else:
        rows = rows.withColumns({"fuzzy_c": F.lit(None).cast(dict(rows.dtypes)["title_c"]), "fuzzy_n": F.lit(0)})
    n["fuzzy"] = F.coalesce(F.col("fuzzy_n"), F.lit(0))
    margin = F.round(F.col("fuzzy_c")[0]["similarity_score"] - F.get("fuzzy_c", F.lit(1))["similarity_score"], 9)
    no_album = F.col("k_album") == ""
    method = (
        F.when(has_uri, "existing_spotify_uri")
        .when(~named_ok, "none")
        .when(n["album"] >= 1, "exact_title_artist_album")
        .when((no_album & (n["title"] == 1)) | (n["title"] > 1), "exact_title_artist")
        .when(n["fuzzy"] >= 1, "fuzzy_title_exact_artist")
        .otherwise("none")
    )
    count = F.when(F.col("match_method") == "exact_title_artist_album", n["album"]).otherwise(n["title"])
    status = (
        F.when(F.col("match_method") == "existing_spotify_uri", "exact")
        .when(F.col("match_method") == "none", "unmatched")
        .when(F.col("match_method") == "fuzzy_title_exact_artist", F.when(margin < policy.fuzzy_min_margin, "ambiguous").otherwise("fuzzy"))
        .when(count == 1, "exact")
        .otherwise("ambiguous")
    )
    rows = rows.withColumn("match_method", method).withColumn("match_status", status)
    by_method = {"existing_spotify_uri": "uri_c", "exact_title_artist_album": "album_c", "exact_title_artist": "title_c", "fuzzy_title_exact_artist": "fuzzy_c"}
    chosen = None
    for name, column in by_method.items():
        chosen = F.when(F.col("match_method") == name, F.col(column)) if chosen is None else chosen.when(F.col("match_method") == name, F.col(column))
    exact = F.col("match_status") == "exact"
    rows = rows.withColumn("candidates", F.coalesce(chosen, F.array().cast(dict(rows.dtypes)["title_c"])))
    return rows.select(
        *(c for c in queries.columns),
        "match_status",
        "match_method",
        F.when(has_uri, F.col("track_uri")).when(exact, F.col("candidates")[0]["track_uri"]).alias("resolved_track_id"),
        F.when(has_uri, F.lit(1.0)).when(exact, F.when(F.col("match_method") == "exact_title_artist", F.lit(policy.title_artist_exact_confidence)).otherwise(F.lit(1.0))).alias("match_confidence"),
        (~exact).alias("review_required"),
        "candidates",
        F.lit(policy.policy_version).alias("policy_version"),
    )


# The outcomes a report always lists.
STATUSES = ("exact", "ambiguous", "fuzzy", "unmatched")


def coverage_report(matches: DataFrame, plays: str = "play_count", ms: str = "total_ms_played", statuses: tuple[str, ...] = STATUSES) -> DataFrame:
    """One row a status, zero-filled: tracks, plays, milliseconds and their shares."""
    spark = matches.sparkSession
    names = spark.createDataFrame([(s,) for s in statuses], "match_status string")
    sums = matches.groupBy("match_status").agg(F.count(F.lit(1)).alias("tracks"), F.sum(plays).alias("plays"), F.sum(ms).alias("ms"))
    filled = names.join(sums, "match_status", "left").select("match_status", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("tracks", "plays", "ms")))
    total = Window.partitionBy()  # over one row a status
    return filled.select("match_status", "tracks", "plays", "ms", *(F.round(F.coalesce(F.col(c) / F.nullif(F.sum(c).over(total), F.lit(0)), F.lit(0.0)), 6).alias(f"{c}_rate") for c in ("tracks", "plays", "ms")))


def stratified_sample(df: DataFrame, stratum: str, key: Column, n: int = 20) -> DataFrame:
    """The first ``n`` rows of each stratum by the SHA-256 of their key."""
    w = Window.partitionBy(stratum).orderBy(F.sha2(key, 256), key)
    return df.withColumn("sample_rank", F.row_number().over(w)).filter(F.col("sample_rank") <= n)


def top_weighted(queries: DataFrame, n: int, plays: str = "play_count", ms: str = "total_ms_played", key: str = "track_id") -> DataFrame:
    return queries.orderBy(F.desc(plays), F.desc(ms), key).limit(n)
