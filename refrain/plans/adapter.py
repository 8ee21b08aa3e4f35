"""The star-schema tables seen as a listening domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.config import TemporalConfig

#: Thirty days of events make six periods.
PERIODS = TemporalConfig(period_days=5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as playback: views, clicks and purchases are tracks, sign-ups episodes."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    is_track = kind.isin("view", "click", "purchase")
    return e.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("played_at"),
        "user_id",
        "event_type",
        "value",
        F.when(is_track, "track").when(kind == "signup", "episode").otherwise("unknown").alias("media_type"),
        F.when(is_track, F.concat(F.lit("k"), k)).alias("track_id"),
        F.when(is_track, F.concat(F.lit("a"), k % 20)).alias("artist"),
        F.round(F.col("value") * 1000).cast("long").alias("ms_played"),
        F.when(kind == "view", "clickrow").when(kind == "purchase", "autoplay").alias("reason_start"),
        F.when(kind == "purchase", "trackdone").when(kind == "click", "fwdbtn").alias("reason_end"),
        F.when(kind == "purchase", False).when(kind == "click", True).when((kind == "view") & (F.col("value") <= 100), False).alias("skipped"),
    )


#: The same in DuckDB, as a common table expression.
EVENTS_SQL = """
ev0 AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k, event_type IN ('view', 'click', 'purchase') AS is_track FROM events),
ev AS (SELECT event_id, ts AS played_at, epoch_us(ts) AS us, user_id, event_type, value, k,
  CASE WHEN is_track THEN 'track' WHEN event_type = 'signup' THEN 'episode' ELSE 'unknown' END AS media_type,
  CASE WHEN is_track THEN 'k' || k END AS track_id, CASE WHEN is_track THEN 'a' || (k % 20) END AS artist,
  CAST(round(value * 1000) AS BIGINT) AS ms_played,
  CASE event_type WHEN 'view' THEN 'clickrow' WHEN 'purchase' THEN 'autoplay' END AS reason_start,
  CASE event_type WHEN 'purchase' THEN 'trackdone' WHEN 'click' THEN 'fwdbtn' END AS reason_end,
  CASE WHEN event_type = 'purchase' THEN false WHEN event_type = 'click' THEN true WHEN event_type = 'view' AND value <= 100 THEN false END AS skipped
  FROM ev0),
sig AS (SELECT *,
  CASE WHEN reason_end IN ('endplay', 'trackdone') THEN true WHEN coalesce(skipped, false) OR coalesce(reason_end IN ('backbtn', 'fwdbtn'), false) THEN false END AS done,
  CASE WHEN coalesce(skipped, false) OR coalesce(reason_end IN ('backbtn', 'fwdbtn'), false) THEN ms_played < 30000 WHEN skipped = false OR reason_end IN ('endplay', 'trackdone') THEN false END AS early,
  CASE WHEN reason_start IN ('backbtn', 'clickrow', 'fwdbtn', 'playbtn', 'remote') THEN true WHEN reason_start IN ('appload', 'autoplay', 'trackdone') THEN false END AS meant,
  CASE WHEN reason_end IN ('endplay', 'trackdone') THEN true WHEN (coalesce(skipped, false) OR coalesce(reason_end IN ('backbtn', 'fwdbtn'), false)) AND ms_played < 30000 THEN false WHEN skipped = false AND ms_played >= 30000 THEN true END AS outcome
  FROM ev)"""


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a track catalogue: brand is the artist, type the album."""
    p = table(spark, sf_dir, "part")
    return p.select(F.concat(F.lit("u"), "p_partkey").alias("track_uri"), F.col("p_name").alias("track_name"), F.col("p_brand").alias("artist_name"), F.col("p_type").alias("album_name"), F.lit("part").alias("source_file"), F.lit("all").alias("source_collection"), "p_partkey", "p_size", "p_retailprice")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("track_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label"), F.lit(1.0).alias("feature_confidence"))


def predictions(spark: SparkSession, sf_dir: str, scale: float = 4000.0) -> DataFrame:
    """Quality labels with a score made from the text's length, in six periods."""
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    p = F.round(1 / (1 + F.exp(-(F.col("n_chars") - 2000) / F.lit(scale))), 6)
    return d.select("doc_id", "n_chars").join(lab, "doc_id").select(F.col("doc_id").alias("sample_id"), F.col("doc_id").alias("track_id"), (F.col("n_chars") % 6).cast("int").alias("period_index"), F.col("quality").cast("int").alias("label"), p.alias("probability"))


PREDICTIONS_SQL = """
pr AS (SELECT d.doc_id AS track_id, d.doc_id AS sample_id, CAST(n_chars % 6 AS INT) AS period_index, CAST(quality AS INT) AS label, round(1 / (1 + exp(-(n_chars - 2000) / 4000.0)), 6) AS probability,
  round(1 / (1 + exp(-(n_chars - 2000) / 90.0)), 6) AS other FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
