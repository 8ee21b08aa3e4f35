"""Named queries over the star-schema tables, each with its DuckDB form where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.config import AffinityConfig, RankingConfig, TemporalConfig
from refrain.functions import signals, text
from refrain.functions.vectors import pooled, weighted_query
from refrain.operators import acoustic, behavior, clustering, external, features, identity, metrics, ranking, similarity, temporal, training
from refrain.plans.adapter import EVENTS_SQL, PERIODS, PREDICTIONS_SQL, catalog, events, predictions, table, vectors
from refrain.sources import history
from refrain.sources.history import dedup_first
from refrain.sources.sinks import batches, feedback, merge_feedback

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _r(c: F.Column | str, digits: int = 6) -> F.Column:
    return F.round(c, digits)


# --- ingest -------------------------------------------------------------------------------------


def _history(spark: SparkSession, sf: str) -> DataFrame:
    """Events as raw history records, some of them bad: one JSON text each."""
    e = events(spark, sf)
    kind, k = F.col("event_type"), F.substring("track_id", 2, 9).cast("int")
    record = F.struct(
        F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        F.when(F.col("event_id") % 17 == 0, -1).otherwise(F.col("ms_played")).alias("ms_played"),
        F.when(k % 7 == 0, F.concat(F.lit("spotify:track:"), F.lpad(k.cast("string"), 22, "0"))).when(k % 7 == 1, "not a uri").alias("spotify_track_uri"),
        F.when(kind.isin("view", "click", "purchase"), F.concat(F.lit(" Song "), k)).alias("master_metadata_track_name"),
        F.when(kind.isin("view", "click", "purchase"), F.col("artist")).alias("master_metadata_album_artist_name"),
        F.when((kind == "signup") | (F.col("event_id") % 19 == 0), F.concat(F.lit("Talk "), "user_id")).alias("episode_name"),
        "reason_start",
        "reason_end",
        "skipped",
    )
    raw = e.select(F.lit("f").alias("source_file"), F.col("event_id").alias("source_record_index"), F.to_json(record).alias("record"))
    return history.normalize(history.parse(history.spread(raw)))


_HISTORY_SQL = f"""{EVENTS_SQL},
  hi AS (SELECT event_id, strftime(played_at, '%Y-%m-%dT%H:%M:%S.000Z') AS ts, CASE WHEN event_id % 17 = 0 THEN -1 ELSE ms_played END AS ms, CASE WHEN k % 7 = 0 THEN 'spotify:track:' || lpad(CAST(k AS VARCHAR), 22, '0') WHEN k % 7 = 1 THEN 'not a uri' END AS uri,
    CASE WHEN is_track THEN 'Song ' || k END AS title, artist, CASE WHEN event_type = 'signup' OR event_id % 19 = 0 THEN 'Talk ' || user_id END AS talk, reason_start, reason_end, skipped
    FROM (SELECT event_id, played_at, ms_played, CASE WHEN track_id IS NOT NULL THEN k END AS k, track_id IS NOT NULL AS is_track, artist, event_type, user_id, reason_start, reason_end, skipped FROM ev)),
  hm AS (SELECT *, CASE WHEN title IS NOT NULL AND talk IS NOT NULL THEN NULL WHEN title IS NOT NULL THEN 'track' WHEN talk IS NOT NULL THEN 'episode' ELSE 'unknown' END AS media FROM hi),
  hc AS (SELECT *, CASE WHEN ms < 0 THEN 'invalid_ms_played' WHEN uri = 'not a uri' THEN 'invalid_spotify_uri' WHEN media IS NULL THEN 'ambiguous_media_type' END AS code FROM hm)"""


_QUOTED = "coalesce('\"' || {} || '\"', 'null')"


@query(f"""WITH {_HISTORY_SQL} SELECT sha256('{{"incognito_mode":null,"media_identity":' || coalesce('"' || uri || '"', '[' || {_QUOTED.format('title')} || ',' || {_QUOTED.format('artist')} || ',null,' || {_QUOTED.format('talk')} || ',null]') || ',"media_type":"' || media || '","ms_played":' || ms ||
  ',"offline":null,"played_at":"' || ts || '","reason_end":' || {_QUOTED.format('reason_end')} || ',"reason_start":' || {_QUOTED.format('reason_start')} || ',"shuffle":null,"skipped":' || coalesce(CAST(skipped AS VARCHAR), 'null') || '}}') AS event_id,
  media AS media_type, ms AS ms_played, uri AS track_uri, title AS track_name, min(event_id) AS source_record_index FROM hc WHERE code IS NULL GROUP BY ALL""")
def ingest_events(spark: SparkSession, sf: str) -> DataFrame:
    good = _history(spark, sf).filter("error_code IS NULL").withColumn("event_id", history.event_id())
    return dedup_first(good, "event_id", ("source_record_index",)).select("event_id", "media_type", "ms_played", "track_uri", "track_name", "source_record_index")


@query(f"WITH {_HISTORY_SQL} SELECT media AS media_type, count(*) AS n, count(DISTINCT title) AS tracks FROM hc GROUP BY media")
def media_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf).groupBy("media_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("track_name").alias("tracks"))


@query(f"WITH {_HISTORY_SQL} SELECT coalesce(code, 'accepted') AS code, count(*) AS n, min(event_id) AS first_event FROM hc GROUP BY 1")
def reject_routing(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf).groupBy(F.coalesce("error_code", F.lit("accepted")).alias("code")).agg(F.count(F.lit(1)).alias("n"), F.min("source_record_index").alias("first_event"))


@query("SELECT digest, doc_id, source FROM (SELECT sha256(text) AS digest, doc_id, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def dedup_first_row(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select(F.sha2("text", 256).alias("digest"), "doc_id", "source")
    return dedup_first(d, "digest", ("doc_id",))


@query("""SELECT family, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(u, 'iphone|ipad|ios') THEN 'ios' WHEN regexp_matches(u, 'android') THEN 'android' WHEN regexp_matches(u, 'windows') THEN 'windows'
  WHEN regexp_matches(u, 'macintosh|macos|os x') THEN 'macos' WHEN regexp_matches(u, 'linux') THEN 'linux' WHEN regexp_matches(u, 'browser|web player|web_player') THEN 'web'
  WHEN regexp_matches(u, 'television|smart tv|smart_tv') THEN 'tv' WHEN regexp_matches(u, 'playstation|xbox|game console') THEN 'game_console' ELSE 'other' END AS family FROM (SELECT lower(html) AS u FROM pages)) GROUP BY 1""")
def platform_family(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").groupBy(text.platform_family(F.col("html")).alias("family")).agg(F.count(F.lit(1)).alias("n"))


@query(r"""SELECT page_id, regexp_extract(url, '^https?://(?:www\.)?([^/?#]+)', 1) AS host, 'spotify:track:' || lpad(CAST(page_id AS VARCHAR), 22, '0') AS track_uri FROM pages""")
def url_normalize(spark: SparkSession, sf: str) -> DataFrame:
    link = F.concat(F.lit("https://open.spotify.com/track/"), F.lpad(F.col("page_id").cast("string"), 22, "0"), F.lit("?si=x"))
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("url", r"^https?://(?:www\.)?([^/?#]+)", 1).alias("host"), text.track_uri(link).alias("track_uri"))


# --- behaviour ----------------------------------------------------------------------------------


@query(f"WITH {EVENTS_SQL} SELECT event_id, done, early, meant FROM sig")
def playback_signals(spark: SparkSession, sf: str) -> DataFrame:
    cfg, null = AffinityConfig(), F.lit(None).cast("long")
    ms, end, skipped = F.col("ms_played"), F.col("reason_end"), F.col("skipped")
    return events(spark, sf).select("event_id", signals.completed(ms, null, end, skipped, cfg).alias("done"), signals.skipped_early(ms, end, skipped, cfg).alias("early"), signals.started_on_purpose(F.col("reason_start"), cfg).alias("meant"))


_SESSIONS = "se AS (SELECT *, sum(fresh) OVER (%(p)s ORDER BY us, event_id) AS session_no FROM (SELECT *, CASE WHEN us - lag(us) OVER (%(p)s ORDER BY us, event_id) <= 1800000000 THEN 0 ELSE 1 END AS fresh FROM sig))"


@query(f"WITH {EVENTS_SQL}, {_SESSIONS % {'p': ''}} SELECT event_id, CAST(session_no AS BIGINT) AS session_no FROM se")
def sessions_global(spark: SparkSession, sf: str) -> DataFrame:
    return behavior.with_sessions(events(spark, sf)).select("event_id", F.col("session_no").cast("long").alias("session_no"))


@query(f"WITH {EVENTS_SQL}, {_SESSIONS % {'p': 'PARTITION BY user_id'}} SELECT event_id, user_id, CAST(session_no AS BIGINT) AS session_no FROM se")
def sessions_per_user(spark: SparkSession, sf: str) -> DataFrame:
    return behavior.with_sessions(events(spark, sf), per=("user_id",)).select("event_id", "user_id", F.col("session_no").cast("long").alias("session_no"))


@query(f"WITH {EVENTS_SQL}, {_SESSIONS % {'p': ''}} SELECT event_id, row_number() OVER (PARTITION BY session_no, track_id ORDER BY us, event_id) > 1 AS is_repeat FROM se WHERE media_type = 'track'")
def repeat_within_session(spark: SparkSession, sf: str) -> DataFrame:
    e = behavior.with_sessions(events(spark, sf)).filter(F.col("media_type") == "track")
    return behavior.with_repeats(e).select("event_id", "is_repeat")


@query(f"""WITH {EVENTS_SQL} SELECT user_id, arg_max(track_id, us) FILTER (WHERE track_id IS NOT NULL) AS track_id, arg_max(reason_end, us) FILTER (WHERE reason_end IS NOT NULL) AS reason_end,
  arg_max(reason_start, us) FILTER (WHERE reason_start IS NOT NULL) AS reason_start FROM ev GROUP BY user_id""")
def last_non_null(spark: SparkSession, sf: str) -> DataFrame:
    names = ("track_id", "reason_end", "reason_start")
    return events(spark, sf).groupBy("user_id").agg(*(behavior.last_known(c, "played_at", "event_id").alias(c) for c in names))


_AFFINITY_COLUMNS = ("track_id", "play_count", "total_ms_played", "median_ms_played", "completion_rate", "completion_signal_coverage", "early_skip_rate", "early_skip_signal_coverage", "intentional_start_rate", "intentional_start_signal_coverage", "repeat_within_session_rate", "recency_weighted_plays", "recency_score", "affinity_score", "affinity_confidence")


@query(f"""WITH {EVENTS_SQL}, {_SESSIONS % {'p': ''}},
  rp AS (SELECT *, row_number() OVER (PARTITION BY session_no, track_id ORDER BY us, event_id) > 1 AS rep, pow(0.5, ((SELECT max(us) FROM ev) - us) / 86400000000.0 / 180.0) AS fr FROM se WHERE media_type = 'track'),
  ag AS (SELECT track_id, count(*) AS n, CAST(sum(ms_played) AS BIGINT) AS ms, median(ms_played) AS med, avg(CAST(done AS INT)) AS c, count(done) / count(*) AS cc, avg(CAST(early AS INT)) AS e, count(early) / count(*) AS ec,
    avg(CAST(meant AS INT)) AS m, count(meant) / count(*) AS mc, avg(CAST(rep AS INT)) AS r, sum(fr) AS fs, avg(fr) AS fa FROM rp GROUP BY track_id)
  SELECT track_id, n AS play_count, ms AS total_ms_played, round(CAST(med AS DOUBLE), 6) AS median_ms_played, round(c, 6) AS completion_rate, round(cc, 6) AS completion_signal_coverage, round(e, 6) AS early_skip_rate,
    round(ec, 6) AS early_skip_signal_coverage, round(m, 6) AS intentional_start_rate, round(mc, 6) AS intentional_start_signal_coverage, round(r, 6) AS repeat_within_session_rate, round(fs, 6) AS recency_weighted_plays,
    round(fa, 6) AS recency_score, round(ln(1 + n) + 1.5 * coalesce(c, 0) + coalesce(m, 0) + 0.5 * fa - 2.0 * coalesce(e, 0), 6) AS affinity_score,
    round((1 + 1.5 * cc + mc + 0.5 + 2.0 * ec) / 6.0 * (1 - exp(-n / 3.0)), 6) AS affinity_confidence FROM ag""")
def track_affinity(spark: SparkSession, sf: str) -> DataFrame:
    return behavior.track_affinity(events(spark, sf)).select(*_AFFINITY_COLUMNS)


@query(f"""WITH {EVENTS_SQL}, du AS (SELECT 'k' || (2 * i) AS track_id, 20000 + 1000 * i AS dur FROM range(50) t(i)),
  jo AS (SELECT s.*, dur, CASE WHEN dur IS NOT NULL THEN least(ms_played / dur, 1.0) END AS ratio FROM sig s LEFT JOIN du ON s.track_id = du.track_id WHERE media_type = 'track')
  SELECT track_id, CAST(max(dur) AS BIGINT) AS duration_ms, round(median(ratio), 6) AS median_completion_ratio, round(avg(CAST(CASE WHEN dur IS NOT NULL THEN ratio >= 0.9 ELSE done END AS INT)), 6) AS completion_rate FROM jo GROUP BY track_id""")
def duration_join(spark: SparkSession, sf: str) -> DataFrame:
    durations = spark.range(50).select(F.concat(F.lit("k"), F.col("id") * 2).alias("track_key"), (20000 + 1000 * F.col("id")).alias("duration_ms"))
    return behavior.track_affinity(events(spark, sf), durations=durations).select("track_id", "duration_ms", "median_completion_ratio", "completion_rate")


# --- training sets ------------------------------------------------------------------------------

_PERIODS_SQL = f"""{EVENTS_SQL},
  anchor AS (SELECT min(us) - min(us) % 86400000000 AS a0 FROM ev),
  pe AS (SELECT s.*, a0, CAST((us - a0) // 432000000000 AS INT) AS period_index FROM sig s, anchor WHERE media_type = 'track'),
  vo AS (SELECT track_id, period_index, max(artist) AS artist, max(a0) AS a0, count(*) AS plays, sum(ms_played) AS ms, count(*) FILTER (WHERE outcome) AS pos, count(*) FILTER (WHERE NOT outcome) AS neg,
    count(meant) AS ks, count(*) FILTER (WHERE meant) AS mt, min(us) AS fus, max(us) AS lus FROM pe GROUP BY track_id, period_index),
  lb AS (SELECT *, CASE WHEN pos + neg >= 1 THEN CASE WHEN pos / (pos + neg) >= 0.6 THEN 1 WHEN pos / (pos + neg) <= 0.4 THEN 0 END END AS label FROM vo)"""


@query(f"WITH {_PERIODS_SQL} SELECT track_id, period_index, pos AS positives, neg AS negatives, label, round(least(5.0, sqrt(pos + neg)), 8) AS sample_weight FROM lb")
def outcome_labels(spark: SparkSession, sf: str) -> DataFrame:
    return temporal.period_votes(events(spark, sf), PERIODS).select("track_id", "period_index", "positives", "negatives", "label", "sample_weight")


_SPLIT_SQL = """sp AS (SELECT period_index, CASE WHEN r <= n - 2 * greatest(1, round_even(n * 0.2, 0)) THEN 'train' WHEN r <= n - greatest(1, round_even(n * 0.2, 0)) THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT period_index, row_number() OVER (ORDER BY period_index) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT period_index FROM lb WHERE label IS NOT NULL)))"""


@query(f"WITH {_PERIODS_SQL}, {_SPLIT_SQL} SELECT split, count(*) AS samples, count(*) FILTER (WHERE label = 1) AS positives, count(DISTINCT track_id) AS tracks, count(DISTINCT period_index) AS periods FROM lb JOIN sp USING (period_index) WHERE label IS NOT NULL GROUP BY split")
def period_split(spark: SparkSession, sf: str) -> DataFrame:
    return temporal.dataset_report(temporal.temporal_samples(events(spark, sf), PERIODS))


def _samples_sql(artist: str) -> str:
    return f"""WITH {_PERIODS_SQL}, {_SPLIT_SQL},
  st AS (SELECT *, sum(plays) OVER b AS bp, sum(ms) OVER b AS bm, sum(pos) OVER b AS bpos, sum(neg) OVER b AS bneg, sum(ks) OVER b AS bks, sum(mt) OVER b AS bmt, min(fus) OVER b AS bf, max(lus) OVER b AS bl
    FROM lb WINDOW b AS (PARTITION BY track_id ORDER BY period_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  ar AS ({artist}),
  jo AS (SELECT st.*, ap, apos, aneg, a0 + period_index * 432000000000 AS t0 FROM st JOIN ar USING (track_id, period_index) WHERE label IS NOT NULL)
  SELECT sha256(concat_ws(chr(31), track_id, CAST(jo.period_index AS VARCHAR), 'temporal_taste_v1')) AS sample_id, track_id, jo.period_index, split, label, {_vector_sql('bp', 'bm', 'bpos', 'bneg', 'bks', 'bmt', 'bf', 'bl', 'ap', 'apos', 'aneg', 't0')}
  FROM jo JOIN sp ON jo.period_index = sp.period_index"""


def _vector_sql(p: str, ms: str, pos: str, neg: str, ks: str, mt: str, first: str, last: str, ap: str, apos: str, aneg: str, t0: str) -> str:
    def share(a: str, b: str) -> str:
        return f"CASE WHEN coalesce({b}, 0) > 0 THEN ({a}) / ({b}) ELSE 0.0 END"

    values = (
        f"CASE WHEN coalesce({p}, 0) > 0 THEN 1.0 ELSE 0.0 END", f"ln(1 + coalesce({p}, 0))", f"ln(1 + coalesce({ms}, 0))", share(f"{pos} + {neg}", p), share(pos, f"{pos} + {neg}"), share(neg, f"{pos} + {neg}"), share(ks, p), share(mt, ks),
        f"CASE WHEN {last} IS NOT NULL THEN pow(0.5, greatest(0, ({t0} - {last}) / 86400000000.0) / 180.0) ELSE 0.0 END", f"ln(1 + coalesce(greatest(0, ({t0} - {first}) / 86400000000.0), 0.0))", f"ln(1 + coalesce({ap}, 0))", share(f"{apos} + {aneg}", ap), share(apos, f"{apos} + {aneg}"),
    )
    return ", ".join(f"round(round(CAST({v} AS DOUBLE), 8), 6) AS {n}" for v, n in zip(values, temporal.FEATURES, strict=True))


def _sample_columns(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", "track_id", "period_index", "split", "label", *(_r(n).alias(n) for n in temporal.FEATURES))


_STRICT = """SELECT v.track_id, v.period_index, ap, apos, aneg FROM vo v JOIN (SELECT artist, period_index, sum(p) OVER w AS ap, sum(q) OVER w AS apos, sum(r) OVER w AS aneg FROM (SELECT artist, period_index, sum(plays) AS p, sum(pos) AS q, sum(neg) AS r FROM vo GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY artist ORDER BY period_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) a ON v.artist = a.artist AND v.period_index = a.period_index"""
_REFERENCE = "SELECT track_id, period_index, sum(plays) OVER w AS ap, sum(pos) OVER w AS apos, sum(neg) OVER w AS aneg FROM vo WINDOW w AS (PARTITION BY artist ORDER BY period_index, track_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query(_samples_sql(_STRICT))
def temporal_samples_strict(spark: SparkSession, sf: str) -> DataFrame:
    return _sample_columns(temporal.temporal_samples(events(spark, sf), PERIODS))


@query(_samples_sql(_REFERENCE))
def temporal_samples_reference(spark: SparkSession, sf: str) -> DataFrame:
    return _sample_columns(temporal.temporal_samples(events(spark, sf), TemporalConfig(period_days=5, artist_prior="reference")))


_SNAPSHOT_SQL = f"""{_PERIODS_SQL}, tr AS (SELECT track_id, max(artist) AS artist, sum(plays) AS p, sum(ms) AS m, sum(pos) AS q, sum(neg) AS r, sum(ks) AS k, sum(mt) AS t, min(fus) AS f, max(lus) AS l FROM vo GROUP BY track_id),
  aa AS (SELECT artist, sum(plays) AS ap, sum(pos) AS apos, sum(neg) AS aneg FROM vo GROUP BY artist),
  sn AS (SELECT track_id, artist, {_vector_sql('p', 'm', 'q', 'r', 'k', 't', 'f', 'l', 'ap', 'apos', 'aneg', '((SELECT max(us) FROM ev) + 1000)')} FROM tr JOIN aa USING (artist))"""


@query(f"WITH {_SNAPSHOT_SQL} SELECT * FROM sn")
def behavior_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return temporal.behavior_snapshots(events(spark, sf), PERIODS).select("track_id", F.col("artist_key").alias("artist"), *(_r(n).alias(n) for n in temporal.FEATURES))


# --- features -----------------------------------------------------------------------------------

_SOURCE = ("catalog", "v1")


def observations(spark: SparkSession, sf: str) -> DataFrame:
    p = catalog(spark, sf)
    return external.long_features(p, key="track_uri", numbers={"size_v1": F.col("p_size"), "price_v1": F.col("p_retailprice")}, texts={"brand_v1": F.col("artist_name")}, source="catalog", version="v1", coverage=F.lit(30.0), confidence=F.least(F.lit(1.0), F.col("p_size") / 40.0), vectors={"pair_v1": ("size_v1", "price_v1")})


_LONG_SQL = """lo AS (SELECT 'u' || p_partkey AS track_id, unnest(['size_v1', 'price_v1', 'brand_v1', 'pair_v1']) AS feature_name, unnest([CAST(p_size AS DOUBLE), p_retailprice, NULL, NULL]) AS value_number, unnest([NULL, NULL, p_brand, NULL]) AS value_text,
  least(1.0, p_size / 40.0) AS feature_confidence FROM part)"""


@query(f"WITH {_LONG_SQL} SELECT track_id, feature_name, value_number, value_text, round(CAST(feature_confidence AS DOUBLE), 6) AS feature_confidence FROM lo")
def feature_long(spark: SparkSession, sf: str) -> DataFrame:
    return observations(spark, sf).select("track_id", "feature_name", "value_number", "value_text", _r("feature_confidence").alias("feature_confidence"))


@query(f"WITH {_LONG_SQL} SELECT track_id, max(value_number) FILTER (WHERE feature_name = 'size_v1') AS f0, max(value_number) FILTER (WHERE feature_name = 'price_v1') AS f1 FROM lo WHERE feature_confidence >= 0.5 AND feature_name IN ('size_v1', 'price_v1') GROUP BY track_id")
def feature_wide(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [features.Selector("size_v1", *_SOURCE), features.Selector("price_v1", *_SOURCE)]
    return features.pivot(observations(spark, sf), wanted, minimum_confidence=0.5)


@query("SELECT vec_id AS id FROM embeddings INTERSECT SELECT doc_id FROM labels")
def fair_cohort(spark: SparkSession, sf: str) -> DataFrame:
    return features.fair_cohort(table(spark, sf, "embeddings").select(F.col("vec_id").alias("id")), table(spark, sf, "labels").select(F.col("doc_id").alias("id")), "id")


@query(r"SELECT p_partkey, trim(regexp_replace(lower(p_name || ' (' || p_type || ')!'), '[^\p{L}\p{N}]+', ' ', 'g')) AS name, sha256(trim(regexp_replace(lower(p_brand), '\s+', ' ', 'g'))) AS artist_digest FROM part")
def norm_text(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return p.select("p_partkey", text.normalized(F.concat("p_name", F.lit(" ("), "p_type", F.lit(")!"))).alias("name"), F.sha2(text.spaced(F.col("p_brand")), 256).alias("artist_digest"))


# --- identity -----------------------------------------------------------------------------------


def _query_tracks(spark: SparkSession, sf: str, album: bool, title: F.Column) -> DataFrame:
    p = table(spark, sf, "part")
    keys = ["p_name", "p_brand"] + (["p_type"] if album else [])
    q = p.groupBy(*keys).agg(F.min("p_partkey").alias("k"), F.count(F.lit(1)).alias("play_count"), F.sum("p_size").alias("total_ms_played"))
    return q.select(F.concat(F.lit("q"), "k").alias("source_track_id"), F.lit(None).cast("string").alias("track_uri"), title.alias("track_name"), F.col("p_brand").alias("artist_name"), (F.col("p_type") if album else F.lit(None).cast("string")).alias("album_name"), "play_count", F.col("total_ms_played").cast("long").alias("total_ms_played"))


def _identity(spark: SparkSession, sf: str, album: bool) -> DataFrame:
    q = _query_tracks(spark, sf, album, F.concat(F.upper("p_name"), F.lit(" !")))
    found = identity.resolve_identities(q, catalog(spark, sf), fuzzy=False)
    return found.select("source_track_id", "match_status", "match_method", "resolved_track_id", _r("match_confidence").alias("match_confidence"), F.size("candidates").alias("n_candidates"))


def _identity_sql(keys: str, method: str, confidence: str) -> str:
    return f"SELECT 'q' || min(p_partkey) AS source_track_id, CASE WHEN count(*) = 1 THEN 'exact' ELSE 'ambiguous' END AS match_status, '{method}' AS match_method, CASE WHEN count(*) = 1 THEN 'u' || min(p_partkey) END AS resolved_track_id, CASE WHEN count(*) = 1 THEN CAST({confidence} AS DOUBLE) END AS match_confidence, CAST(least(5, count(*)) AS INT) AS n_candidates FROM part GROUP BY {keys}"


@query(_identity_sql("p_name, p_brand, p_type", "exact_title_artist_album", "1.0"))
def identity_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _identity(spark, sf, True)


@query(_identity_sql("p_name, p_brand", "exact_title_artist", "0.9"))
def identity_ambiguous(spark: SparkSession, sf: str) -> DataFrame:
    return _identity(spark, sf, False)


@query("""SELECT 'q' || p_partkey AS source_track_id, 'exact' AS match_status, 'existing_spotify_uri' AS match_method, 'u' || 2 * p_partkey AS resolved_track_id, CAST(1 AS DOUBLE) AS match_confidence, (SELECT count(*) FROM part q WHERE q.p_partkey = 2 * p.p_partkey) AS n_candidates FROM part p""")
def identity_uri(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "part").select(F.concat(F.lit("q"), "p_partkey").alias("source_track_id"), F.concat(F.lit("u"), 2 * F.col("p_partkey")).alias("track_uri"), F.col("p_name").alias("track_name"), F.col("p_brand").alias("artist_name"), F.col("p_type").alias("album_name"))
    found = identity.resolve_identities(q, catalog(spark, sf), fuzzy=False)
    return found.select("source_track_id", "match_status", "match_method", "resolved_track_id", "match_confidence", F.size("candidates").cast("long").alias("n_candidates"))


@query("""WITH g AS (SELECT count(*) AS n, sum(p_size) AS ms FROM part GROUP BY p_name, p_brand),
  s AS (SELECT unnest(['exact', 'ambiguous', 'fuzzy', 'unmatched']) AS match_status), t AS (SELECT CASE WHEN n = 1 THEN 'exact' ELSE 'ambiguous' END AS match_status, count(*) AS tracks, CAST(sum(n) AS BIGINT) AS plays, CAST(sum(ms) AS BIGINT) AS ms FROM g GROUP BY 1)
  SELECT match_status, coalesce(tracks, 0) AS tracks, coalesce(plays, 0) AS plays, coalesce(ms, 0) AS ms, round(coalesce(tracks, 0) / (SELECT sum(tracks) FROM t), 6) AS tracks_rate, round(coalesce(plays, 0) / (SELECT sum(plays) FROM t), 6) AS plays_rate, round(coalesce(ms, 0) / (SELECT sum(ms) FROM t), 6) AS ms_rate FROM s LEFT JOIN t USING (match_status)""")
def identity_coverage(spark: SparkSession, sf: str) -> DataFrame:
    q = _query_tracks(spark, sf, False, F.concat(F.upper("p_name"), F.lit(" !")))
    return identity.coverage_report(identity.resolve_identities(q, catalog(spark, sf), fuzzy=False))


@query()
def identity_fuzzy(spark: SparkSession, sf: str) -> DataFrame:
    q = _query_tracks(spark, sf, False, F.concat(F.col("p_name"), F.lit("s")))
    one = catalog(spark, sf).groupBy("track_name", "artist_name").agg(F.min_by(F.struct("track_uri", "album_name", "source_file", "source_collection"), "p_partkey").alias("t")).select("track_name", "artist_name", "t.*")
    found = identity.resolve_identities(q, one)
    return found.select("source_track_id", "match_status", "match_method", F.size("candidates").alias("n_candidates"), _r(F.col("candidates")[0]["similarity_score"]).alias("best"))


@query("""WITH b AS (SELECT p_name, p_brand, p_type, row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_size DESC, p_partkey) AS n, min(p_partkey) OVER (PARTITION BY p_name, p_brand) AS k FROM part)
  SELECT 'q' || k AS track_id, 'r' || lower(p_name) AS recording_mbid, p_type AS release_name FROM b WHERE n = 1""")
def canonical_map(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    dump = p.select(F.lit("").alias("artist_mbids"), F.col("p_brand").alias("artist_credit_name"), F.lit("").alias("release_mbid"), F.col("p_type").alias("release_name"), F.concat(F.lit("R"), "p_name").alias("recording_mbid"), F.col("p_name").alias("recording_name"), F.col("p_size").alias("score"), F.col("p_partkey").alias("row"))
    q = _query_tracks(spark, sf, False, F.col("p_name")).withColumnRenamed("source_track_id", "track_id")
    return external.canonical_map(q, dump).select("track_id", "recording_mbid", "release_name")


def _acoustic(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as matched recordings with documents, some of whose values are missing."""
    p = table(spark, sf, "part")
    tree: dict = {}
    for i, path in enumerate(acoustic.NUMBERS.values()):
        value = F.when((F.col("p_size") % 4 == 0) | ((F.col("p_size") + i) % 5 > 0), F.col("p_retailprice") + i)
        at = tree
        for part in path.split(".")[:-1]:
            at = at.setdefault(part, {})
        at[path.split(".")[-1]] = value
    tree["metadata"]["audio_properties"]["length"] = F.when(F.col("p_size") % 3 > 0, F.col("p_size"))
    tree["tonal"]["key_key"] = F.concat(F.lit(" "), "p_brand")

    def packed(node: dict | F.Column) -> F.Column:
        return node if isinstance(node, F.Column) else F.struct(*(packed(v).alias(k) for k, v in node.items()))

    high = {path.split(".")[1]: {"all": {path.split(".")[3]: F.when((F.col("p_size") + i) % 7 > 0, F.col("p_size") / 100.0)}} for i, path in enumerate(acoustic.SCORES.values())}
    documents = p.filter("p_size % 6 > 0").select(F.concat(F.lit("R"), "p_partkey").alias("mbid"), F.to_json(packed(tree)).alias("low"), F.when(F.col("p_size") % 2 == 0, F.to_json(packed({"highlevel": high}))).alias("high"))
    matches = p.select(F.concat(F.lit("u"), "p_partkey").alias("source_track_id"), F.when(F.col("p_partkey") % 9 > 0, "exact").otherwise("fuzzy").alias("match_status"), F.concat(F.lit("r"), "p_partkey").alias("recording_mbid"), F.col("p_size").cast("long").alias("play_count"), (F.col("p_size") * 1000).cast("long").alias("total_ms_played"))
    return acoustic.matched_documents(matches, documents)


_ACOUSTIC_SQL = f"""d AS (SELECT 'u' || p_partkey AS track_id, p_size AS z, p_retailprice AS v, p_brand, CASE WHEN p_size % 3 > 0 THEN p_size ELSE 0 END AS secs FROM part WHERE p_partkey % 9 > 0 AND p_size % 6 > 0),
  n AS (SELECT unnest({list(acoustic.NUMBERS)}) AS feature_name, unnest(range(12)) AS i), h AS (SELECT unnest({list(acoustic.SCORES)}) AS feature_name, unnest(range(6)) AS i),
  lo AS (SELECT track_id, secs, feature_name, v + i AS number, NULL AS txt, NULL AS total, 0.85 AS c FROM d, n WHERE z % 4 = 0 OR (z + i) % 5 > 0
    UNION ALL SELECT track_id, secs, 'key_estimate_v1', NULL, p_brand, NULL, 0.85 FROM d UNION ALL SELECT track_id, secs, '{acoustic.DESCRIPTORS}', NULL, NULL, 12 * v + 66, 0.85 FROM d WHERE z % 4 = 0
    UNION ALL SELECT track_id, secs, feature_name, z / 100.0, NULL, NULL, 0.7 FROM d, h WHERE z % 2 = 0 AND (z + i) % 7 > 0 UNION ALL SELECT track_id, secs, '{acoustic.LEARNED}', NULL, NULL, 6 * z / 100.0, 0.7 FROM d WHERE z % 2 = 0 AND z % 7 = 1)"""


@query(f"WITH {_ACOUSTIC_SQL} SELECT track_id, feature_name, round(CAST(number AS DOUBLE), 6) AS value_number, txt AS value_text, round(CAST(total AS DOUBLE), 6) AS vector_total, CAST(secs AS DOUBLE) AS coverage_seconds, round(CAST(c * CASE WHEN secs > 0 THEN least(1.0, secs / 30.0) ELSE 0.75 END AS DOUBLE), 6) AS feature_confidence FROM lo")
def acoustic_features(spark: SparkSession, sf: str) -> DataFrame:
    found = acoustic.acoustic_observations(_acoustic(spark, sf))
    total = F.when(F.col("value_vector").isNotNull(), F.aggregate("value_vector", F.lit(0.0), lambda s, x: s + x))
    return found.select("track_id", "feature_name", _r("value_number").alias("value_number"), "value_text", F.round(total, 6).alias("vector_total"), "coverage_seconds", _r("feature_confidence").alias("feature_confidence"))


@query("""WITH m AS (SELECT 'r' || p_partkey AS mbid, p_size AS n, p_size % 6 > 0 AS low, p_size % 6 > 0 AND p_size % 2 = 0 AS high FROM part WHERE p_partkey % 9 > 0)
  SELECT count(*) AS exact_tracks, count(DISTINCT mbid) AS recordings, count(*) FILTER (WHERE low) AS low_tracks, round(count(*) FILTER (WHERE low) / count(*), 6) AS low_track_rate, round(sum(n) FILTER (WHERE low) / sum(n), 6) AS low_play_rate, round(sum(n) FILTER (WHERE low) / sum(n), 6) AS low_ms_played_rate,
    count(*) FILTER (WHERE high) AS high_tracks, round(count(*) FILTER (WHERE high) / count(*), 6) AS high_track_rate, round(sum(n) FILTER (WHERE high) / sum(n), 6) AS high_play_rate, round(sum(n) FILTER (WHERE high) / sum(n), 6) AS high_ms_played_rate FROM m""")
def acoustic_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return acoustic.acoustic_coverage(_acoustic(spark, sf))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity) AS n FROM lineitem WHERE l_orderkey % 3 = 0),
  r AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 5 > 0), s AS (SELECT l_orderkey AS mbid, count(*) AS lines FROM lineitem WHERE l_orderkey % 3 = 0 AND l_orderkey % 7 > 0 GROUP BY 1)
  SELECT coalesce(o_orderkey, l_orderkey, mbid) AS mbid, l_quantity AS quantity, o_totalprice AS price, lines FROM (SELECT * FROM l WHERE n = 1) l FULL JOIN r ON l_orderkey = o_orderkey FULL JOIN s ON coalesce(o_orderkey, l_orderkey) = mbid""")
def wanted_sections(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("mbid"), F.col("l_linenumber").alias("submission_offset"), F.col("l_quantity").alias("quantity"), "l_partkey", "l_suppkey", "l_shipdate")
    orders = table(spark, sf, "orders").filter("o_orderkey % 5 > 0").select(F.col("o_orderkey").alias("mbid"), F.col("o_totalprice").alias("price"))
    counts = lines.filter("mbid % 7 > 0").groupBy("mbid").agg(F.count(F.lit(1)).alias("lines"))
    wanted = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("mbid")).unionByName(table(spark, sf, "orders").select(F.col("o_orderkey").alias("mbid"))).filter("mbid % 3 = 0")
    low = external.lowest_offset(lines, tie=("l_partkey", "l_suppkey", "l_shipdate", "quantity"))
    merged = external.merge_sections({"line": low, "order": orders, "count": counts}, wanted=wanted)
    return merged.select("mbid", F.col("line.quantity").alias("quantity"), F.col("order.price").alias("price"), F.col("count.lines").alias("lines"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity) AS n FROM lineitem)
  SELECT coalesce(o.o_orderkey, l.l_orderkey) AS mbid, l.l_linenumber AS submission_offset, l.l_quantity AS quantity, o.o_totalprice AS price FROM (SELECT * FROM l WHERE n = 1) l FULL JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def lowest_offset(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("mbid"), F.col("l_linenumber").alias("submission_offset"), F.col("l_quantity").alias("quantity"), "l_partkey", "l_suppkey", "l_shipdate")
    low = external.lowest_offset(lines, tie=("l_partkey", "l_suppkey", "l_shipdate", "quantity"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("mbid"), F.col("o_totalprice").alias("price"))
    merged = external.merge_sections({"low": low, "order": orders})
    return merged.select("mbid", "low.submission_offset", "low.quantity", "order.price")


_PLAYS_SQL = "pl AS (SELECT 'u' || l_partkey AS track_id, count(*) AS play_count, CAST(sum(l_quantity) AS BIGINT) AS total_ms_played FROM lineitem GROUP BY l_partkey)"


def _plays(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(F.concat(F.lit("u"), "l_partkey").alias("track_id")).agg(F.count(F.lit(1)).alias("play_count"), F.sum("l_quantity").cast("long").alias("total_ms_played"))


@query(f"WITH {_LONG_SQL}, {_PLAYS_SQL}, t AS (SELECT count(*) AS a, sum(play_count) AS b, sum(total_ms_played) AS c FROM pl) SELECT feature_name, count(*) AS tracks, round(count(*) / max(a), 6) AS track_rate, round(CAST(sum(play_count) AS DOUBLE) / max(b), 6) AS play_rate, round(CAST(sum(total_ms_played) AS DOUBLE) / max(c), 6) AS ms_rate FROM (SELECT DISTINCT feature_name, track_id FROM lo WHERE feature_confidence >= 0.5) JOIN pl USING (track_id), t GROUP BY feature_name")
def coverage_rates(spark: SparkSession, sf: str) -> DataFrame:
    return external.feature_coverage(observations(spark, sf).filter("feature_confidence >= 0.5"), _plays(spark, sf))


@query("SELECT o_orderkey, o_orderstatus, sample_rank FROM (SELECT o_orderkey, o_orderstatus, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY sha256(CAST(o_orderkey AS VARCHAR))) AS INT) AS sample_rank FROM orders) WHERE sample_rank <= 20")
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return identity.stratified_sample(table(spark, sf, "orders"), "o_orderstatus", F.col("o_orderkey").cast("string")).select("o_orderkey", "o_orderstatus", "sample_rank")


@query(f"WITH {_PLAYS_SQL} SELECT * FROM pl ORDER BY play_count DESC, total_ms_played DESC, track_id LIMIT 100")
def top_n_weighted(spark: SparkSession, sf: str) -> DataFrame:
    return identity.top_weighted(_plays(spark, sf), 100)


# --- similarity ---------------------------------------------------------------------------------

_SEEDS = ((0, 3.0), (1, 2.0), (2, 1.0))
_CENTROID_SQL = """em AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
  un AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM em),
  ce AS (SELECT list(s ORDER BY i) AS q FROM (SELECT i, sum((3 - vec_id) * u[i]) AS s FROM un, range(1, 65) t(i) WHERE vec_id < 3 GROUP BY i)),
  qu AS (SELECT list_transform(q, lambda x: x / sqrt(list_dot_product(q, q))) AS q FROM ce)"""


def _seeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(_SEEDS), "track_id long, weight double")


@query(f"WITH {_CENTROID_SQL} SELECT i - 1 AS i, round(q[i], 6) AS v FROM qu, range(1, 65) t(i)")
def weighted_query_vector(spark: SparkSession, sf: str) -> DataFrame:
    seeds = _seeds(spark).join(vectors(spark, sf), "track_id")
    return weighted_query(seeds, "embedding", "weight").select(F.posexplode("query").alias("i", "v")).select(F.col("i").cast("long").alias("i"), _r("v").alias("v"))


@query(f"WITH {_CENTROID_SQL} SELECT CAST(row_number() OVER (ORDER BY c DESC, vec_id) AS INT) AS rank, vec_id AS track_id, round(c, 6) AS cosine_similarity FROM (SELECT vec_id, list_dot_product(q, u) AS c FROM un, qu WHERE vec_id >= 3 ORDER BY c DESC, vec_id LIMIT 20)")
def knn_cosine(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.query(vectors(spark, sf), _seeds(spark), top_k=20).select("rank", "track_id", _r("cosine_similarity").alias("cosine_similarity"))


@query(f"WITH {_CENTROID_SQL} SELECT CAST(row_number() OVER (ORDER BY c DESC, vec_id) AS INT) AS rank, vec_id AS track_id, round(c, 6) AS cosine_similarity, CAST(CASE WHEN vec_id % 3 = 0 THEN 1 ELSE 2 END AS INT) AS n_evidence FROM (SELECT vec_id, list_dot_product(q, u) AS c FROM un, qu WHERE vec_id >= 3 AND label BETWEEN 2 AND 7 AND (vec_id % 3 = 0 OR vec_id % 2 = 1) ORDER BY c DESC, vec_id LIMIT 20)")
def knn_filtered(spark: SparkSession, sf: str) -> DataFrame:
    v = vectors(spark, sf)
    text_value = F.when(F.col("track_id") % 3 != 0, F.when(F.col("track_id") % 2 == 1, "Odd").otherwise("Even"))
    obs = external.long_features(v, key="track_id", numbers={"label_v1": F.col("label")}, texts={"parity_v1": text_value}, source="catalog", version="v1", coverage=F.lit(30.0), confidence=F.lit(0.9))
    filters = [similarity.NumericRange(features.Selector("label_v1", *_SOURCE), 2, 7, 0.5), similarity.Allowed(features.Selector("parity_v1", *_SOURCE), ("ODD",), required=False)]
    return similarity.query(v, _seeds(spark), top_k=20, observations=obs, filters=filters).select("rank", "track_id", _r("cosine_similarity").alias("cosine_similarity"), F.size("evidence").alias("n_evidence"))


@query("WITH s AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, range(1, 65) t(i) GROUP BY label, i) SELECT CAST(label AS INT) AS label, i - 1 AS i, round(m / sqrt(sum(m * m) OVER (PARTITION BY label)), 6) AS v FROM s")
def mean_pool(spark: SparkSession, sf: str) -> DataFrame:
    return pooled(vectors(spark, sf), ["label"], "embedding").select(F.col("label").cast("int").alias("label"), F.posexplode("pooled").alias("i", "v")).select("label", F.col("i").cast("long").alias("i"), _r("v").alias("v"))


# --- evaluation ---------------------------------------------------------------------------------


@query(f"WITH {PREDICTIONS_SQL}, r AS (SELECT label, rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2.0 AS k FROM pr) SELECT round(CAST((sum(k) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * (count(*) - sum(label))) AS DOUBLE), 6) AS auc FROM r")
def eval_auc(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.auc(predictions(spark, sf)).select(_r("auc").alias("auc"))


@query(f"WITH {PREDICTIONS_SQL}, g AS (SELECT probability, sum(label) AS p, count(*) AS n FROM pr GROUP BY probability), c AS (SELECT p, sum(p) OVER w AS tp, sum(n) OVER w AS m FROM g WINDOW w AS (ORDER BY probability DESC)) SELECT round(CAST(sum(CAST(tp AS DOUBLE) / m * p) / sum(p) AS DOUBLE), 6) AS average_precision FROM c")
def eval_ap(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.average_precision(predictions(spark, sf)).select(_r("average_precision").alias("average_precision"))


@query(f"WITH {PREDICTIONS_SQL} SELECT round(avg(-(label * ln(q) + (1 - label) * ln(1 - q))), 6) AS log_loss, round(avg((probability - label) * (probability - label)), 6) AS brier FROM (SELECT *, greatest(1e-15, least(1 - 1e-15, probability)) AS q FROM pr)")
def eval_logloss_brier(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.log_loss_brier(predictions(spark, sf)).select(_r("log_loss").alias("log_loss"), _r("brier").alias("brier"))


@query(f"WITH {PREDICTIONS_SQL} SELECT round(sum(n * abs(c - a)) / sum(n), 6) AS ece FROM (SELECT count(*) AS n, avg(probability) AS c, avg(label) AS a FROM (SELECT *, CASE WHEN probability >= 0.9 THEN 9 WHEN probability >= 0.8 THEN 8 WHEN probability >= 0.7 THEN 7 WHEN probability >= 0.6 THEN 6 WHEN probability >= 0.5 THEN 5 WHEN probability >= 0.4 THEN 4 WHEN probability >= 0.3 THEN 3 WHEN probability >= 0.2 THEN 2 WHEN probability >= 0.1 THEN 1 ELSE 0 END AS b FROM pr) GROUP BY b)")
def eval_ece(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.calibration_error(predictions(spark, sf)).select(_r("ece").alias("ece"))


def _ndcg_sql(score: str, tie: str, name: str) -> str:
    return f"""{name} AS (SELECT period_index, hits / lim AS precision, hits / pos AS recall, dcg / (SELECT sum(1 / log2(i + 1.0)) FROM range(1, 51) t(i) WHERE i <= least(pos, lim)) AS ndcg FROM (
  SELECT period_index, sum(label) AS pos, count(*) FILTER (WHERE r <= 50) AS lim, sum(label) FILTER (WHERE r <= 50) AS hits, sum(label / log2(r + 1.0)) FILTER (WHERE r <= 50) AS dcg
  FROM (SELECT *, row_number() OVER (PARTITION BY period_index ORDER BY {score} DESC, {tie}) AS r FROM pr) GROUP BY period_index) WHERE pos > 0)"""


@query(f"WITH {PREDICTIONS_SQL}, {_ndcg_sql('probability', 'track_id', 'k')} SELECT count(*) AS periods, round(avg(precision), 6) AS precision_at_k, round(avg(recall), 6) AS recall_at_k, round(avg(ndcg), 6) AS ndcg_at_k FROM k")
def eval_ndcg(spark: SparkSession, sf: str) -> DataFrame:
    m = metrics.ranking(predictions(spark, sf), k=50)
    return m.select("periods", *(_r(c).alias(c) for c in ("precision_at_k", "recall_at_k", "ndcg_at_k")))


@query(f"WITH {PREDICTIONS_SQL}, {_ndcg_sql('probability', 'sample_id', 'a')}, {_ndcg_sql('other', 'sample_id', 'b')} SELECT a.period_index, round(a.ndcg, 6) AS baseline_ndcg, round(b.ndcg, 6) AS contender_ndcg, round(b.ndcg - a.ndcg, 6) AS delta FROM a JOIN b ON a.period_index = b.period_index")
def paired_delta(spark: SparkSession, sf: str) -> DataFrame:
    d = metrics.paired_deltas(predictions(spark, sf), predictions(spark, sf, 90.0), k=50)
    return d.select("period_index", *(_r(c).alias(c) for c in ("baseline_ndcg", "contender_ndcg", "delta")))


@query("WITH m AS (SELECT sum((l_tax + 0.01) * l_quantity) / sum(l_tax + 0.01) AS a, sum((l_tax + 0.01) * l_extendedprice) / sum(l_tax + 0.01) AS b FROM lineitem) SELECT round(max(a), 4) AS l_quantity_mean, round(max(b), 4) AS l_extendedprice_mean, round(sqrt(sum((l_tax + 0.01) * (l_quantity - a) * (l_quantity - a)) / sum(l_tax + 0.01)), 4) AS l_quantity_scale, round(sqrt(sum((l_tax + 0.01) * (l_extendedprice - b) * (l_extendedprice - b)) / sum(l_tax + 0.01)), 4) AS l_extendedprice_scale FROM lineitem, m")
def weighted_scaler(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").withColumn("w", F.col("l_tax") + 0.01)
    s = metrics.weighted_scaler(rows, ["l_quantity", "l_extendedprice"], "w")
    return s.select(*(_r(c, 4).alias(c) for c in s.columns))


# --- ranking ------------------------------------------------------------------------------------

_MODEL = ranking.LinearModel(("prior_log_play_count", "prior_positive_rate", "prior_early_skip_rate", "prior_recency_score"), (3.0, 0.5, 0.2, 0.9), (0.5, 0.2, 0.1, 0.05), (0.4, 0.8, -0.6, 0.1), 0.25)
_Z_SQL = "0.4 * (prior_log_play_count - 3.0) / 0.5 + 0.8 * (prior_positive_rate - 0.5) / 0.2 - 0.6 * (prior_early_skip_rate - 0.2) / 0.1 + 0.1 * (prior_recency_score - 0.9) / 0.05 + 0.25"


def _snapshots(spark: SparkSession, sf: str) -> DataFrame:
    s = temporal.behavior_snapshots(events(spark, sf), PERIODS)
    return s.withColumns({n: _r(n) for n in temporal.FEATURES})


@query(f"WITH {_SNAPSHOT_SQL} SELECT track_id, round(1 / (1 + exp(-({_Z_SQL}))), 6) AS probability FROM sn")
def linear_score(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshots(spark, sf).select("track_id", _r(_MODEL.probability({n: F.col(n) for n in _MODEL.names})).alias("probability"))


@query(f"""WITH {_SNAPSHOT_SQL}, c AS (SELECT track_id, 0 AS i, 'prior_log_play_count' AS feature, 0.4 * (prior_log_play_count - 3.0) / 0.5 AS v FROM sn UNION ALL SELECT track_id, 1, 'prior_positive_rate', 0.8 * (prior_positive_rate - 0.5) / 0.2 FROM sn
  UNION ALL SELECT track_id, 2, 'prior_early_skip_rate', -0.6 * (prior_early_skip_rate - 0.2) / 0.1 FROM sn UNION ALL SELECT track_id, 3, 'prior_recency_score', 0.1 * (prior_recency_score - 0.9) / 0.05 FROM sn)
  SELECT track_id, feature, round(v, 6) AS contribution, CAST(r - 1 AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY abs(v) DESC, i) AS r FROM c) WHERE r <= 3""")
def contributions(spark: SparkSession, sf: str) -> DataFrame:
    s = _snapshots(spark, sf)
    top = s.select("track_id", F.posexplode(_MODEL.contributions({n: F.col(n) for n in _MODEL.names}, 3)).alias("place", "c"))
    return top.select("track_id", F.col("c.feature").alias("feature"), _r("c.contribution").alias("contribution"), "place")


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    """All parts, as candidates: a part is track k(size) of artist a(size modulo 20)."""
    c = catalog(spark, sf)
    return c.select(F.concat(F.lit("k"), F.col("p_partkey") % 120).alias("snapshot_id"), F.col("track_uri").alias("track_id"), F.col("artist_name"), F.concat(F.lit("a"), F.col("p_size") % 25).alias("artist_key"), ((F.col("p_retailprice") - 950) / 60).alias("cos"), "p_size", "p_partkey")


_FILTERS = [similarity.NumericRange(features.Selector("price_v1", *_SOURCE), 940.0, None, 0.25), similarity.NumericRange(features.Selector("size_v1", *_SOURCE), None, 45.0, 0.5, required=False)]
_REASON_SQL = "CASE WHEN artist_name = 'Brand#11' THEN 'excluded_artist' WHEN least(1.0, p_size / 40.0) < 0.25 THEN 'missing_filter_feature' WHEN p_retailprice < 940 THEN 'feature_filter' WHEN least(1.0, p_size / 40.0) >= 0.5 AND p_size > 45 THEN 'feature_filter' END"


_RANK_MODEL = ranking.LinearModel(("prior_log_play_count", "prior_positive_rate", "prior_artist_positive_rate"), (3.0, 0.5, 0.4), (0.5, 0.2, 0.1), (0.4, 0.8, 0.3), 0.25)

_CAND_SQL = f"""{_SNAPSHOT_SQL}, s2 AS (SELECT 'u' || substr(track_id, 2) AS sid, artist, prior_log_play_count AS l, prior_positive_rate AS r, prior_artist_positive_rate AS ar FROM sn),
  fb AS (SELECT artist AS akey, min_by(ar, sid) AS far FROM s2 WHERE artist IS NOT NULL GROUP BY artist),
  ca AS (SELECT 'u' || p_partkey AS track_id, p_brand AS artist_name, 'a' || (p_size % 25) AS artist_key, CASE WHEN p_size % 3 > 0 THEN greatest(-1.0, least(1.0, (p_retailprice - 950) / 60)) END AS s,
    CASE WHEN p_partkey % 50 = 0 THEN 'seed_track' ELSE {_REASON_SQL.replace('artist_name', 'p_brand')} END AS reason FROM part),
  cf AS (SELECT ca.*, coalesce(l, 0.0) AS l, coalesce(r, 0.0) AS r, CASE WHEN sid IS NOT NULL THEN ar ELSE coalesce(far, 0.0) END AS ar FROM ca LEFT JOIN s2 ON track_id = sid LEFT JOIN fb ON artist_key = akey),
  cb AS (SELECT *, 1 / (1 + exp(-(0.4 * (l - 3.0) / 0.5 + 0.8 * (r - 0.5) / 0.2 + 0.3 * (ar - 0.4) / 0.1 + 0.25))) AS p, 1 / (1 + sqrt(exp(l) - 1)) AS nov FROM cf),
  cs AS (SELECT *, CASE WHEN s IS NOT NULL THEN 'audio_ranked' ELSE 'preference_ranked' END AS tier, CASE WHEN reason IS NULL THEN CASE WHEN s IS NOT NULL THEN 0.5 * (s + 1) / 2 + 0.35 * p + 0.15 * nov ELSE p END END AS base FROM cb),
  cj AS (SELECT *, row_number() OVER (PARTITION BY artist_key ORDER BY base DESC, track_id DESC) - 1 AS j FROM cs WHERE base IS NOT NULL),
  ct AS (SELECT track_id, base - 0.1 * CAST(j AS DOUBLE) AS final, row_number() OVER (ORDER BY base - 0.1 * CAST(j AS DOUBLE) DESC, track_id DESC) AS rank FROM cj WHERE j < 3)"""


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates by the ranking operator: a track's or its artist's snapshot, a model, a cosine, filters."""
    c = _candidates(spark, sf)
    cosines = c.filter(F.col("p_size") % 3 > 0).select("track_id", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("cos"))).alias("cosine_similarity"))
    seeds = c.filter("p_partkey % 50 = 0").select("track_id")
    names = c.select("track_id", "artist_name", "artist_key")
    return ranking.rank_candidates(names, snapshots=_snapshots(spark, sf).withColumn("track_id", F.concat(F.lit("u"), F.substring("track_id", 2, 9))), model=_RANK_MODEL, similarity=cosines, seeds=seeds, observations=observations(spark, sf), filters=_FILTERS, excluded_artists=["brand#11 "], top_k=40)


@query(f"SELECT 'u' || p_partkey AS track_id, {_REASON_SQL} AS exclusion_reason FROM (SELECT *, p_brand AS artist_name FROM part)")
def constraint_reasons(spark: SparkSession, sf: str) -> DataFrame:
    c = _candidates(spark, sf).select("track_id", "artist_name")
    return ranking.exclusion_reason(c, observations(spark, sf), _FILTERS, ["brand#11 "]).select("track_id", "exclusion_reason")


@query("""WITH j AS (SELECT 'u' || p_partkey AS track_id, p_brand, round(p_retailprice / 2000, 6) AS base, row_number() OVER (PARTITION BY p_brand ORDER BY round(p_retailprice / 2000, 6) DESC, 'u' || p_partkey DESC) - 1 AS j FROM part),
  t AS (SELECT track_id, base - 0.1 * CAST(j AS DOUBLE) AS f FROM j WHERE j < 3)
  SELECT track_id, round(f, 6) AS final_score, CAST(row_number() OVER (ORDER BY f DESC, track_id DESC) AS INT) AS rank FROM t ORDER BY f DESC, track_id DESC LIMIT 50""")
def diversified_topk(spark: SparkSession, sf: str) -> DataFrame:
    c = catalog(spark, sf).select(F.col("track_uri").alias("track_id"), F.col("artist_name").alias("artist_key"), F.round(F.col("p_retailprice") / 2000, 6).alias("base_score"))
    return ranking.diversified(c, top_k=50).select("track_id", _r("final_score").alias("final_score"), "rank")


@query(f"WITH {_CAND_SQL} SELECT track_id, tier, round(p, 6) AS predicted_preference, round(nov, 6) AS novelty_bonus, round(base, 6) AS base_score FROM cs")
def candidate_base_score(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select("track_id", "tier", *(_r(c).alias(c) for c in ("predicted_preference", "novelty_bonus", "base_score")))


@query(f"WITH {_CAND_SQL} SELECT cs.track_id, CAST(CASE WHEN rank <= 40 THEN rank END AS INT) AS rank, round(CASE WHEN rank <= 40 THEN final END, 6) AS final_score, coalesce(reason, CASE WHEN rank IS NULL OR rank > 40 THEN 'not_selected' END) AS exclusion_reason FROM cs LEFT JOIN ct ON cs.track_id = ct.track_id")
def rank_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select("track_id", "rank", _r("final_score").alias("final_score"), "exclusion_reason")


# --- clusters and models ------------------------------------------------------------------------


@query("""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  c AS (SELECT label, list(m ORDER BY i) AS c, max(n) AS n FROM (SELECT label, i, avg(v[i]) AS m, count(*) AS n FROM e, range(1, 65) t(i) GROUP BY label, i) GROUP BY label),
  s AS (SELECT label, avg(list_distance(v, c)) AS s FROM e JOIN c USING (label) GROUP BY label),
  q AS (SELECT a.label, max((x.s + y.s) / list_distance(a.c, b.c)) AS q FROM c a JOIN c b ON a.label <> b.label JOIN s x ON a.label = x.label JOIN s y ON b.label = y.label GROUP BY a.label),
  d AS (SELECT a.vec_id, a.label AS l, b.label AS m, avg(list_distance(a.v, b.v)) AS d FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
  w AS (SELECT vec_id, max(d) FILTER (WHERE l = m) AS a, min(d) FILTER (WHERE l <> m) AS b FROM d GROUP BY vec_id)
  SELECT round((SELECT avg(q) FROM q), 6) AS davies_bouldin, round((SELECT avg((b - a) / greatest(a, b)) FROM w), 6) AS silhouette, (SELECT count(*) FROM c) AS clusters""")
def cluster_metrics(spark: SparkSession, sf: str) -> DataFrame:
    v = vectors(spark, sf).select("track_id", F.col("label").alias("cluster_id"), F.col("embedding").alias("vector"))
    parts = clustering.davies_bouldin(v).crossJoin(clustering.silhouette(v)).crossJoin(v.agg(F.countDistinct("cluster_id").alias("clusters")))  # single rows
    return parts.select(_r("davies_bouldin").alias("davies_bouldin"), _r("silhouette").alias("silhouette"), "clusters")


@query()
def kmeans_map(spark: SparkSession, sf: str) -> DataFrame:
    v = vectors(spark, sf).select("track_id", F.col("embedding").alias("vector"))
    return clustering.taste_map(v)[0]


@query()
def train_logistic(spark: SparkSession, sf: str) -> DataFrame:
    samples = temporal.temporal_samples(events(spark, sf), PERIODS)
    return training.predict(samples, training.fit_logistic(samples.filter("split = 'train'"), temporal.FEATURES), "behavior")


@query()
def taste_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature variant, fitted on listening samples with catalogue and vector features,
    or the reason why it can't be."""
    samples = temporal.temporal_samples(events(spark, sf), PERIODS)
    tracks = observations(spark, sf).withColumn("track_id", F.concat(F.lit("k"), F.expr("substring(track_id, 2)")))
    v = vectors(spark, sf).select(F.concat(F.lit("k"), "track_id").alias("track_id"), F.lit("audio_v1").alias("feature_name"), F.lit("clip").alias("feature_source"), F.lit("v1").alias("source_version"), F.lit(None).cast("double").alias("value_number"), F.lit(None).cast("string").alias("value_text"), F.col("embedding").alias("value_vector"), F.lit(30.0).alias("coverage_seconds"), F.lit(1.0).alias("feature_confidence"))
    try:
        found, chosen, _ = training.train_taste_models(samples, observations=tracks.unionByName(v), descriptors=[features.Selector("size_v1", *_SOURCE), features.Selector("price_v1", *_SOURCE)], embedding=features.Selector("audio_v1", "clip", "v1"))
    except training.NothingTrained as none:  # many events a track and period can vote alike everywhere
        found, chosen = none.found, None
    rows = [(f.variant.name, len(f.features), f.variant.matched, f.reason, f.merit[0], f.merit[1], f is chosen) for f in found]
    return spark.createDataFrame(rows, "model_name string, feature_count int, matched boolean, reason string, ndcg_at_k double, average_precision double, selected boolean")


# --- hand-off -----------------------------------------------------------------------------------


@query(f"""WITH {EVENTS_SQL}, f AS (SELECT 'run' || user_id AS run, track_id, CASE WHEN skipped THEN 'skipped' ELSE 'listened' END AS outcome, us FROM ev WHERE media_type = 'track')
  SELECT sha256(concat_ws(chr(31), run, track_id, outcome, strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S.%gZ'))) AS feedback_id, run AS recommendation_run_id, track_id, outcome FROM f""")
def feedback_log(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf).filter("media_type = 'track'")
    rows = e.select(feedback(F.concat(F.lit("run"), "user_id"), F.col("track_id"), F.when(F.col("skipped"), "skipped").otherwise("listened"), F.col("played_at")).alias("f")).select("f.*")
    first = rows.filter(F.dayofmonth("recorded_at") <= 15)
    return merge_feedback(first, rows).select("feedback_id", "recommendation_run_id", "track_id", "outcome")


@query("SELECT 'u' || p_partkey AS track_uri, CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS INT) AS position, CAST((row_number() OVER (ORDER BY p_partkey) - 1) // 100 AS INT) AS batch FROM part")
def playlist_batches(spark: SparkSession, sf: str) -> DataFrame:
    return batches(catalog(spark, sf), "p_partkey").select("track_uri", "position", "batch")


@query("""WITH r AS (SELECT n_nationkey AS k, sha256(concat_ws(chr(31), CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR))) AS h FROM nation),
  b AS (SELECT left(sha256(CAST(k AS VARCHAR)), 3) AS b, sha256(string_agg(h, chr(10) ORDER BY k)) AS d, count(*) AS n FROM r GROUP BY 1)
  SELECT sha256(string_agg(d, chr(10) ORDER BY b)) AS digest, CAST(sum(n) AS BIGINT) AS rows FROM b""")
def content_digest(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.content_digest(table(spark, sf, "nation"), "n_nationkey", ["n_nationkey", "n_name", "n_regionkey"])
