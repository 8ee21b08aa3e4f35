"""Point-in-time training samples: labels by period, features from earlier periods alone.

Events are summed to (track, artist, period) first; prior state is a running
window over these sums that ends before the current one, so raw events are
shuffled once and the windows see few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.config import TemporalConfig
from refrain.functions import signals
from refrain.functions.text import digest_id
from refrain.operators.behavior import DAY_US, micros

#: The behaviour vector, in order.
FEATURES = (
    "prior_seen",
    "prior_log_play_count",
    "prior_log_total_ms",
    "prior_outcome_coverage",
    "prior_positive_rate",
    "prior_early_skip_rate",
    "prior_intentional_coverage",
    "prior_intentional_rate",
    "prior_recency_score",
    "prior_track_age_log_days",
    "prior_artist_log_play_count",
    "prior_artist_outcome_coverage",
    "prior_artist_positive_rate",
)

_SUMS = ("plays", "ms", "positives", "negatives", "known_starts", "meant_starts")


def with_periods(events: DataFrame, cfg: TemporalConfig) -> DataFrame:
    """Adds ``period_index`` and ``_anchor``: midnight of the first event of any medium."""
    first = events.agg(F.min(micros(F.col("played_at"))).alias("_first"))
    anchored = events.crossJoin(F.broadcast(first))  # a single row
    anchor = F.col("_first") - F.pmod(F.col("_first"), F.lit(DAY_US))
    days = F.floor((micros(F.col("played_at")) - F.col("_anchor")) / DAY_US)
    return anchored.withColumn("_anchor", anchor).withColumn("period_index", F.floor(days / cfg.period_days).cast("int")).drop("_first")


def _totals() -> list[Column]:
    outcome, meant = F.col("outcome"), F.col("meant")
    return [
        F.count(F.lit(1)).alias("plays"),
        F.sum("ms_played").alias("ms"),
        F.count_if(outcome).alias("positives"),
        F.count_if(~outcome).alias("negatives"),
        F.count("meant").alias("known_starts"),
        F.count_if(meant).alias("meant_starts"),
        F.min("_us").alias("first_us"),
        F.max("_us").alias("last_us"),
    ]


def behavior_vector(track: dict[str, Column], artist: dict[str, Column], as_of_us: Column, cfg: TemporalConfig, digits: int = 8) -> dict[str, Column]:
    """The 13 features as of a time, from prior sums (null: nothing known)."""
    zero = F.lit(0)
    t, a = ({k: F.coalesce(v, zero) for k, v in side.items() if k in _SUMS} for side in (track, artist))

    def share(x: Column, of: Column) -> Column:
        return F.when(of > 0, x / of).otherwise(0.0)

    known, artist_known = t["positives"] + t["negatives"], a["positives"] + a["negatives"]
    since = F.greatest(F.lit(0.0), (as_of_us - track["last_us"]) / float(DAY_US))
    age = F.coalesce(F.greatest(F.lit(0.0), (as_of_us - track["first_us"]) / float(DAY_US)), F.lit(0.0))
    values = (
        (t["plays"] > 0).cast("double"),
        F.log1p(t["plays"]),
        F.log1p(t["ms"]),
        share(known, t["plays"]),
        share(t["positives"], known),
        share(t["negatives"], known),
        share(t["known_starts"], t["plays"]),
        share(t["meant_starts"], t["known_starts"]),
        F.when(track["last_us"].isNotNull(), F.pow(F.lit(0.5), since / cfg.recency_half_life_days)).otherwise(0.0),
        F.log1p(age),
        F.log1p(a["plays"]),
        share(artist_known, a["plays"]),
        share(a["positives"], artist_known),
    )
    return {name: F.round(v, digits) for name, v in zip(FEATURES, values, strict=True)}


def period_sums(events: DataFrame, cfg: TemporalConfig) -> DataFrame:
    """Sums of the track events by track, period and artist as given, with the time of the last one."""
    rows = with_periods(events, cfg).filter(F.col("media_type") == "track")
    rows = rows.withColumns({"outcome": signals.liked(F.col("ms_played"), F.col("reason_end"), F.col("skipped"), cfg), "meant": signals.started_on_purpose(F.col("reason_start"), cfg), "_us": micros(F.col("played_at"))})
    return rows.groupBy("track_id", "period_index", "artist").agg(*_totals(), F.max(F.struct("played_at", "event_id")).alias("_last"), F.max("_anchor").alias("_anchor"))


def _added() -> list[Column]:
    return [*(F.sum(n).alias(n) for n in _SUMS), F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us")]


def track_periods(sums: DataFrame) -> DataFrame:
    """(track, period) sums with ``current_artist``: the track's last known one of the
    period, or else the one carried from earlier periods."""
    known = F.max_by("artist", F.when(F.col("artist").isNotNull(), F.col("_last")))
    rows = sums.groupBy("track_id", "period_index").agg(*_added(), known.alias("_known"), F.max("_anchor").alias("_anchor"))
    until = Window.partitionBy("track_id").orderBy("period_index").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("current_artist", F.last("_known", ignorenulls=True).over(until)).drop("_known")


def with_event_artist(sums: DataFrame, periods: DataFrame) -> DataFrame:
    """Adds ``event_artist``, the artist that events without one count for as well."""
    return sums.join(periods.select("track_id", "period_index", "current_artist"), ["track_id", "period_index"]).withColumn("event_artist", F.coalesce("artist", "current_artist"))


def _votes(periods: DataFrame, cfg: TemporalConfig) -> DataFrame:
    known = F.col("positives") + F.col("negatives")
    rate = F.col("positives") / known
    label = F.when(known >= cfg.minimum_labeled_events, F.when(rate >= cfg.positive_fraction_threshold, 1).when(rate <= cfg.negative_fraction_threshold, 0))
    return periods.withColumns({"label": label.cast("int"), "outcome_positive_rate": F.round(F.when(known > 0, rate), 8), "sample_weight": F.round(F.least(F.lit(cfg.maximum_sample_weight), F.sqrt(known)), 8)})


def period_votes(events: DataFrame, cfg: TemporalConfig) -> DataFrame:
    """(track, period) rows with votes, label (null: abstained) and weight."""
    return _votes(track_periods(period_sums(events, cfg)), cfg)


def split_counts(periods: int, cfg: TemporalConfig) -> tuple[int, int]:
    """Whole periods for validation and test, taken from the end."""
    validation, test = (max(1, round(periods * f)) for f in (cfg.validation_fraction, cfg.test_fraction))
    while periods - validation - test < cfg.minimum_train_periods:
        if validation >= test and validation > 1:
            validation -= 1
        elif test > 1:
            test -= 1
        else:
            raise ValueError(f"{cfg.minimum_train_periods + 2} labelled periods are needed for a split; there are {periods}")
    return validation, test


def with_split(labelled: DataFrame, cfg: TemporalConfig) -> DataFrame:
    """Adds ``split`` by the rank of a row's period among the labelled ones."""
    periods = labelled.select("period_index").distinct()
    n = periods.count()
    validation, test = split_counts(n, cfg)
    rank = F.dense_rank().over(Window.orderBy("period_index"))
    split = F.when(F.col("_r") <= n - validation - test, "train").when(F.col("_r") <= n - test, "validation").otherwise("test")
    named = periods.withColumn("_r", rank).withColumn("split", split).drop("_r")
    return labelled.join(named, "period_index")


def _artist_prior(rows: DataFrame, votes: DataFrame, cfg: TemporalConfig) -> DataFrame:
    """(current_artist, period_index, track_id) with the artist's prior sums."""
    names = ("plays", "positives", "negatives")
    by_track = rows.filter(F.col("event_artist").isNotNull()).groupBy("event_artist", "period_index", "track_id").agg(*_added())
    if cfg.artist_prior == "reference":
        order = Window.partitionBy("event_artist").orderBy("period_index", "track_id").rowsBetween(Window.unboundedPreceding, -1)
        prior = by_track.select("event_artist", "period_index", "track_id", *(F.sum(n).over(order).alias(f"artist_{n}") for n in names))
        return votes.join(prior.withColumnRenamed("event_artist", "current_artist"), ["current_artist", "period_index", "track_id"], "left")
    by_period = by_track.groupBy("event_artist", "period_index").agg(*(F.sum(n).alias(n) for n in names))
    order = Window.partitionBy("event_artist").orderBy("period_index").rowsBetween(Window.unboundedPreceding, -1)
    prior = by_period.select("event_artist", "period_index", *(F.sum(n).over(order).alias(f"artist_{n}") for n in names))
    return votes.join(prior.withColumnRenamed("event_artist", "current_artist"), ["current_artist", "period_index"], "left")


def temporal_samples(events: DataFrame, cfg: TemporalConfig | None = None) -> DataFrame:
    """Labelled (track, period) samples with the behaviour known before the period."""
    cfg = cfg or TemporalConfig()
    sums = period_sums(events, cfg)
    periods = track_periods(sums)
    votes, rows = _votes(periods, cfg), with_event_artist(sums, periods)
    before = Window.partitionBy("track_id").orderBy("period_index").rowsBetween(Window.unboundedPreceding, -1)
    prior = {n: F.sum(n).over(before).alias(f"prior_{n}") for n in _SUMS} | {"first_us": F.min("first_us").over(before).alias("prior_first_us"), "last_us": F.max("last_us").over(before).alias("prior_last_us")}
    state = votes.select("*", *prior.values())
    state = _artist_prior(rows, state.filter(F.col("label").isNotNull()), cfg)
    start = F.col("_anchor") + F.col("period_index").cast("long") * (cfg.period_days * DAY_US)
    track = {n: F.col(f"prior_{n}") for n in (*_SUMS, "first_us", "last_us")}
    artist = {n: F.col(f"artist_{n}") for n in ("plays", "positives", "negatives")}
    features = behavior_vector(track, artist, start, cfg)
    made = state.select(
        digest_id(F.col("track_id"), F.col("period_index").cast("string"), F.lit(cfg.dataset_version)).alias("sample_id"),
        "track_id",
        F.col("current_artist").alias("artist_key"),
        "period_index",
        F.timestamp_micros(start).alias("period_start"),
        F.timestamp_micros(start + cfg.period_days * DAY_US).alias("period_end"),
        "label",
        F.col("positives").alias("positive_events"),
        F.col("negatives").alias("negative_events"),
        "outcome_positive_rate",
        "sample_weight",
        *(c.alias(n) for n, c in features.items()),
        F.lit(cfg.dataset_version).alias("dataset_version"),
    )
    return with_split(made, cfg)


def behavior_snapshots(events: DataFrame, cfg: TemporalConfig | None = None) -> DataFrame:
    """Every track's vector just after the last event (of any medium)."""
    cfg = cfg or TemporalConfig()
    sums = period_sums(events, cfg)
    rows = with_event_artist(sums, track_periods(sums))
    as_of = events.agg((F.max(micros(F.col("played_at"))) + 1000).alias("as_of_us"))
    tracks = rows.groupBy("track_id").agg(*_added(), F.max_by("event_artist", "_last").alias("artist_key"))
    artists = rows.filter(F.col("event_artist").isNotNull()).groupBy(F.col("event_artist").alias("artist_key")).agg(*(F.sum(n).alias(f"artist_{n}") for n in ("plays", "positives", "negatives")))
    joined = tracks.join(artists, "artist_key", "left").crossJoin(F.broadcast(as_of))  # a single row
    vector = behavior_vector({n: F.col(n) for n in (*_SUMS, "first_us", "last_us")}, {n: F.col(f"artist_{n}") for n in ("plays", "positives", "negatives")}, F.col("as_of_us"), cfg)
    return joined.select("track_id", "artist_key", F.timestamp_micros("as_of_us").alias("as_of"), *(c.alias(n) for n, c in vector.items()), F.lit(cfg.dataset_version).alias("dataset_version"))


def dataset_report(samples: DataFrame) -> DataFrame:
    return samples.groupBy("split").agg(F.count(F.lit(1)).alias("samples"), F.count_if(F.col("label") == 1).alias("positives"), F.countDistinct("track_id").alias("tracks"), F.countDistinct("period_index").alias("periods"))


def assert_chronological(events: DataFrame, order: str, at: str = "played_at", per: tuple[str, ...] = ()) -> None:
    """Raises if an event comes before the one it follows in ``order``, within each ``per`` group."""
    w = Window.partitionBy(*per).orderBy(order)
    if events.withColumn("_p", F.lag(at).over(w)).filter(F.col("_p") > F.col(at)).limit(1).count():
        raise ValueError("events are not in chronological order")
