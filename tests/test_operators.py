import math
import tracemalloc
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from refrain.config import AffinityConfig, ConfigError, IdentityPolicy, RankingConfig, TasteMapConfig, TemporalConfig
from refrain.functions import vectors as V
from refrain.operators import behavior, clustering, external, features, identity, metrics, ranking, similarity, temporal, training

EVENT = "event_id string, played_at timestamp, media_type string, track_id string, artist string, ms_played long, reason_start string, reason_end string, skipped boolean"


def events(spark, rows):
    return spark.createDataFrame([(f"e{i}", *r) for i, r in enumerate(rows)], EVENT)


def at(text):
    return datetime.fromisoformat(text)


def test_config_rejects_unknown_and_bad(tmp_path):
    (tmp_path / "c.yaml").write_text("affinity: {completion_threshold: 0.5, skip_end_reasons: [FwdBtn]}")
    cfg = AffinityConfig.load(tmp_path / "c.yaml", "affinity")
    assert cfg.completion_threshold == 0.5 and cfg.skip_end_reasons == ("fwdbtn",)
    with pytest.raises(ConfigError):
        AffinityConfig.load({"nonsense": 1})
    with pytest.raises(ConfigError):
        TemporalConfig(period_days=0)


def test_repeats_within_sessions(spark):
    e = events(spark, [(at(f"2025-01-01T{t}"), "track", "t", None, 1, None, None, None) for t in ("10:00", "10:10", "11:00")])
    assert behavior.track_affinity(e).first().repeat_within_session_rate == pytest.approx(1 / 3, abs=1e-6)


def test_sessions_cross_media_and_days(spark):
    rows = [("2025-01-01T23:50", "track"), ("2025-01-02T00:15", "episode"), ("2025-01-02T00:40", "track"), ("2025-01-05T00:00", "track"), ("2025-01-05T00:30", "track")]
    e = events(spark, [(at(t), m, "t", None, 1, None, None, None) for t, m in rows])
    got = [r.session_no for r in behavior.with_sessions(e).orderBy("played_at").collect()]
    assert got == [1, 1, 1, 2, 2]  # a gap of exactly half an hour doesn't part


def test_unknown_signals(spark):
    e = events(spark, [(at("2025-01-01T10:00"), "track", "t", None, 1, None, None, None)])
    r = behavior.track_affinity(e).first()
    assert r.completion_rate is None and r.early_skip_rate is None and r.completion_signal_coverage == 0
    assert r.affinity_confidence < 0.1


def test_durations_and_rates(spark):
    e = events(spark, [(at("2025-01-01T10:00"), "track", "a", None, 180_000, "clickrow", "trackdone", False), (at("2025-01-08T10:00"), "track", "b", None, 12_000, "trackdone", "fwdbtn", True)])
    d = spark.createDataFrame([("a", 200_000), ("b", 240_000)], "track_key string, duration_ms long")
    got = {r.track_id: r for r in behavior.track_affinity(e, durations=d).collect()}
    assert (got["a"].median_completion_ratio, got["a"].completion_rate, got["a"].intentional_start_rate, got["a"].early_skip_rate) == (0.9, 1, 1, 0)
    assert (got["b"].median_completion_ratio, got["b"].completion_rate, got["b"].intentional_start_rate, got["b"].early_skip_rate) == (0.05, 0, 0, 1)


def test_score(spark):
    parts = behavior.score(F.lit(4), F.lit(0.75), F.lit(0.5), F.lit(0.8), F.lit(0.25), AffinityConfig())
    assert spark.range(1).select(sum(parts.values(), F.lit(0.0))).first()[0] == pytest.approx(math.log(5) + 1.125 + 0.5 + 0.4 - 0.5)


def period_events(spark):
    rows = []
    start = at("2025-01-01T00:00")
    for p in range(6):
        for t, good in (("t1", p != 4), ("t2", p % 2 == 0)):
            rows.append((start + timedelta(days=10 * p, hours=int(t[1])), "track", t, "a", 180_000 if good else 5_000, None, "trackdone" if good else "fwdbtn", not good))
    return events(spark, rows)


@pytest.mark.parametrize("mode", ["strict", "reference"])
def test_temporal(spark, mode):
    cfg = TemporalConfig(period_days=10, minimum_train_periods=2, artist_prior=mode)
    got = temporal.temporal_samples(period_events(spark), cfg).orderBy("track_id", "period_index").collect()
    one = [r for r in got if r.track_id == "t1"]
    assert len(one) == 6 and one[0].prior_seen == one[0].prior_recency_score == 0 and one[1].prior_log_play_count == pytest.approx(0.69314718)
    assert one[4].label == 0 and [r.split for r in one] == ["train"] * 4 + ["validation", "test"]
    assert got[6].prior_artist_log_play_count == pytest.approx(math.log(2) if mode == "reference" else 0, abs=1e-8)


def naive_temporal(rows, cfg):
    """A fold over events in order, one period after another."""
    anchor = min(r[1] for r in rows).replace(hour=0, minute=0, second=0)
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        groups.setdefault((r[1] - anchor).days // cfg.period_days, {}).setdefault(r[3], []).append(r)
    plays, artists, last, out = {}, {}, {}, {}
    for p in sorted(groups):
        seen_before = dict(artists)
        for t in sorted(groups[p]):
            named = [r[4] for r in groups[p][t] if r[4] is not None]
            current = named[-1] if named else last.get(t)
            votes = [r[7] == "trackdone" for r in groups[p][t]]
            if sum(votes) / len(votes) >= 0.6 or sum(votes) / len(votes) <= 0.4:
                prior = seen_before if cfg.artist_prior == "strict" else artists
                out[t, p] = (plays.get(t, 0), prior.get(current, 0) if current else 0, current)
            for r in groups[p][t]:
                plays[t] = plays.get(t, 0) + 1
                a = r[4] if r[4] is not None else current
                if a is not None:
                    artists[a] = artists.get(a, 0) + 1
                    last[t] = a
    return out


@pytest.mark.parametrize("mode", ["strict", "reference"])
def test_temporal_against_a_fold(spark, mode):
    rng = np.random.default_rng(5)
    start = at("2025-01-01T05:00")
    rows = []
    for _ in range(400):
        good = bool(rng.integers(2))
        rows.append((start + timedelta(minutes=int(rng.integers(0, 60 * 24 * 60))), "track", f"t{rng.integers(6)}", [None, "a", "b", "c"][rng.integers(4)], 60_000 if good else 100, None, "trackdone" if good else "fwdbtn", not good))
    df = events(spark, rows)
    cfg = TemporalConfig(period_days=6, minimum_train_periods=2, artist_prior=mode)
    got = {(r.track_id, r.period_index): (round(math.expm1(r.prior_log_play_count)), round(math.expm1(r.prior_artist_log_play_count)), r.artist_key) for r in temporal.temporal_samples(df, cfg).collect()}
    assert got == naive_temporal([(f"e{i}", *r) for i, r in enumerate(rows)], cfg)


CATALOG = "track_uri string, track_name string, artist_name string, album_name string, source_file string, source_collection string"
QUERY = "source_track_id string, track_uri string, track_name string, artist_name string, album_name string"


def test_identity(spark):
    catalog = spark.createDataFrame(
        [("FIRST", "Exact Song", "Test Artist", "First Album", "f", "l"), ("FIRST", "Exact Song", "Test Artist", "First Album", "f", "p"), ("SECOND", "Shared Song", "Ambiguous Artist", "Edition One", "f", "l"), ("THIRD", "Shared Song", "Ambiguous Artist", "Edition Two", "f", "l"), ("FOURTH", "Fuzzy Song (Remastered 2025)", "Fuzzy Artist", "Fuzzy Album", "f", "l"), ("FIFTH", "Playlist Song", "Playlist Artist", "Playlist Album", "f", "p")],
        CATALOG,
    )
    queries = spark.createDataFrame(
        [("q1", "FIFTH", None, None, None), ("q2", None, "exact song", "TEST ARTIST", None), ("q3", None, "Shared Song", "Ambiguous Artist", "Edition One"), ("q4", None, "Shared Song", "Ambiguous Artist", None), ("q5", None, "Fuzzy Song Remastered 2024", "Fuzzy Artist", None), ("q6", None, "Unknown Song", "Unknown Artist", None), ("q7", None, "Exact Song", "Test Artist", "Other Album"), ("q8", "GONE", None, None, None), ("q9", None, " ", "Test Artist", None)],
        QUERY,
    )
    got = {r.source_track_id: (r.match_status, r.resolved_track_id, r.match_confidence, len(r.candidates)) for r in identity.resolve_identities(queries, catalog).collect()}
    assert got == {"q1": ("exact", "FIFTH", 1.0, 1), "q2": ("exact", "FIRST", 0.9, 1), "q3": ("exact", "SECOND", 1.0, 1), "q4": ("ambiguous", None, None, 2), "q5": ("fuzzy", None, None, 1), "q6": ("unmatched", None, None, 0), "q7": ("fuzzy", None, None, 1), "q8": ("exact", "GONE", 1.0, 0), "q9": ("unmatched", None, None, 0)}
    report = identity.coverage_report(identity.resolve_identities(queries, catalog).withColumns({"play_count": F.lit(1), "total_ms_played": F.lit(2)}))
    assert {r.match_status: r.tracks for r in report.collect()} == {"exact": 4, "ambiguous": 1, "fuzzy": 2, "unmatched": 2}


def test_fuzzy_margin_makes_ambiguous(spark):
    catalog = spark.createDataFrame([("a", "abcdefghij1", "x", None, "f", "l"), ("b", "abcdefghij2", "x", None, "f", "l")], CATALOG)
    queries = spark.createDataFrame([("q", None, "abcdefghij3", "x", None)], QUERY)
    assert identity.resolve_identities(queries, catalog, IdentityPolicy()).first().match_status == "ambiguous"


def test_external(spark):
    dump = spark.createDataFrame(
        [(0, "A", "Album A", "R1", "Song A", 1), (1, "B", "X", "R2", "Song B", 1), (2, "B", "X", "R3", "Song B", 1), (3, "C", "Release One", "R4", "Song C", 4), (4, "C", "Release Two", "R4", "Song C", 5)],
        "row int, artist_credit_name string, release_name string, recording_mbid string, recording_name string, score int",
    ).withColumns({"release_mbid": F.lit(""), "artist_mbids": F.lit("")})
    queries = spark.createDataFrame([("a", "song a", "a", "Album A"), ("b", "Song B", "B", None), ("c", "Song C", "C", None)], "track_id string, track_name string, artist_name string, album_name string")
    mapped = external.canonical_map(queries, dump)
    assert {(r.track_id, r.recording_mbid, r.release_name) for r in mapped.collect()} == {("a", "r1", "Album A"), ("c", "r4", "Release Two")}
    assert {r.track_id: r.match_status for r in external.resolve_external(queries, mapped).collect()} == {"a": "exact", "b": "unmatched", "c": "exact"}
    low = spark.createDataFrame([("m", 1, 0.5), ("m", 0, 0.7), ("n", 0, 0.1)], "mbid string, submission_offset int, average_loudness double")
    wanted = spark.createDataFrame([("m",)], "mbid string")
    row = external.merge_sections({"lowlevel": external.lowest_offset(low), "tonal": low.limit(0)}, wanted=wanted).first()
    assert row.lowlevel.average_loudness == 0.7 and row.tonal is None
    info = spark.createDataFrame([("1", "T", "A", None, "x"), ("2", "T", "A", None, "y"), ("2", "T", "A", None, "z"), ("3", "Other", "A", None, "w")], "spotify_id string, track_name string, artist_name string, album_name string, external_id string")
    targets = spark.createDataFrame([(str(i), "t", "a", "alb") for i in range(1, 5)], "spotify_id string, track_name string, artist_name string, album_name string")
    assert {r.spotify_id: r.reason for r in external.corroborated(targets, info).collect()} == {"1": "matched", "2": "ambiguous_id", "3": "metadata_mismatch", "4": "not_found"}


def test_observations(spark):
    wide = spark.createDataFrame([("t", 1.0, None, "A")], "track_id string, x double, y double, k string")
    obs = external.long_features(wide, key="track_id", numbers={"x_v1": F.col("x"), "y_v1": F.col("y")}, texts={"k_v1": F.col("k")}, source="s", version="1", coverage=F.lit(30.0), confidence=F.lit(0.9), vectors={"xy_v1": ("x_v1", "y_v1")})
    assert {r.feature_name for r in features.assert_observations(obs).collect()} == {"x_v1", "k_v1"}
    with pytest.raises(features.FeatureError):
        features.assert_observations(obs.unionByName(obs))
    assert features.windows(25, 10) == [(0, 10), (10, 20), (15, 25)] and features.windows(5, 10) == [(0, 5)]


def similar(spark):
    v = spark.createDataFrame([("seed-a", [10.0, 0.0], 1.0), ("seed-b", [0.0, 1.0], 1.0), ("balanced", [1.0, 1.0], 0.95), ("mostly-a", [1.0, 0.2], 0.90), ("opposite", [-1.0, -1.0], 0.99)], "track_id string, embedding array<double>, feature_confidence double")
    obs = spark.createDataFrame(
        [("balanced", "tempo_v1", "s", "1", 122.0, None, 0.4), ("mostly-a", "tempo_v1", "s", "1", 168.0, None, 0.9), ("opposite", "tempo_v1", "other", "1", 120.0, None, 0.9), ("balanced", "mode_v1", "s", "1", None, "Major", 0.9), ("mostly-a", "mode_v1", "s", "1", None, "minor", 0.9)],
        "track_id string, feature_name string, feature_source string, source_version string, value_number double, value_text string, feature_confidence double",
    )
    return v, obs


def seeds(spark, **weights):
    return spark.createDataFrame([(f"seed-{k}", float(w)) for k, w in weights.items()], "track_id string, weight double")


def test_similarity(spark):
    v, obs = similar(spark)

    def ids(**kw):
        return [r.track_id for r in similarity.query(v, seeds(spark, **kw.pop("s", {"a": 1, "b": 1})), top_k=kw.pop("top_k", 3), **kw).orderBy("rank").collect()]

    assert ids() == ["balanced", "mostly-a", "opposite"]
    assert ids(s={"a": 5, "b": 1})[0] == "mostly-a"
    tempo = similarity.NumericRange(features.Selector("tempo_v1", "s", "1"), 115, 130)
    mode = similarity.Allowed(features.Selector("mode_v1", "s", "1"), ("MAJOR",))
    assert ids(observations=obs, filters=[tempo, mode]) == ["balanced"]
    optional = similarity.NumericRange(features.Selector("tempo_v1", "s", "9"), 1, 2, required=False)
    assert len(ids(s={"a": 1}, top_k=9, observations=obs, filters=[optional])) == 4
    with pytest.raises(similarity.QueryError):
        ids(s={"missing": 1})


def test_metrics(spark):
    rows = [(f"s{p}{i}", f"t{i}", p, label, b, c) for p in range(4) for i, (label, b, c) in enumerate(zip([1, 1, 0, 0], [0.1, 0.2, 0.9, 0.8], [0.9, 0.8, 0.2, 0.1], strict=True))]
    df = spark.createDataFrame(rows, "sample_id string, track_id string, period_index int, label int, b double, c double")
    base, best = (df.withColumn("probability", F.col(x)) for x in "bc")
    d = metrics.bootstrap(metrics.paired_deltas(base, best, k=2))
    assert d == {"mean_delta": 1.0, "low": 1.0, "high": 1.0, "win_rate": 1.0}
    assert metrics.auc(best).first().auc == 1 and metrics.auc(base).first().auc == 0
    ones = best.filter("label = 1")
    assert metrics.auc(ones).first().auc is None and metrics.average_precision(ones).first().average_precision is None
    assert metrics.ranking(ones, k=2).first().ndcg_at_k == 1
    with pytest.raises(ValueError):
        metrics.paired_deltas(base, best.filter("period_index > 0"), k=2)


def test_greedy_ranking(spark):
    rng = np.random.default_rng(3)
    for penalty in (0.0, 0.1, 1.0):
        rows = [(f"t{i:02d}", [None, "a", "b", "c"][rng.integers(4)], float(rng.integers(0, 12)) / 10) for i in range(40)]
        left, taken, want = list(rows), {}, []
        while left and len(want) < 15:
            ok = [(s - penalty * taken.get(a, 0), t, a) for t, a, s in left if a is None or taken.get(a, 0) < 3]
            if not ok:
                break
            s, t, a = max(ok, key=lambda x: (x[0], x[1]))
            want.append(t)
            left = [r for r in left if r[0] != t]
            if a is not None:
                taken[a] = taken.get(a, 0) + 1
        df = spark.createDataFrame(rows, "track_id string, artist_key string, base_score double")
        got = ranking.diversified(df, top_k=15, cfg=RankingConfig(artist_repetition_penalty=penalty)).orderBy("rank")
        assert [r.track_id for r in got.collect()] == want


def test_rank_candidates(spark):
    zero = {n: 0.0 for n in temporal.FEATURES}
    snapshots = spark.createDataFrame([("close", "artist:x", *(zero | {"prior_seen": 1.0}).values())], "track_id string, artist_key string, " + ", ".join(f"{n} double" for n in temporal.FEATURES))
    candidates = spark.createDataFrame([(t, None, None) for t in ("seed", "close", "far", "missing")], "track_id string, artist_name string, artist_key string")
    cosines = spark.createDataFrame([("seed", 1.0), ("close", 0.99), ("far", -1.0)], "track_id string, cosine_similarity double")
    s = spark.createDataFrame([("seed",)], "track_id string")
    got = {r.track_id: r for r in ranking.rank_candidates(candidates, snapshots=snapshots, model=None, similarity=cosines, seeds=s, top_k=5).collect()}
    assert (got["close"].rank, got["far"].rank) == (1, 2)
    assert got["seed"].exclusion_reason == "seed_track" and got["missing"].exclusion_reason.startswith("metadata_only")
    assert got["missing"].tier == "metadata_only" and got["close"].tier == "audio_ranked"
    model = ranking.LinearModel(("prior_seen",), (0.0,), (1.0,), (5.0,), 0.0)
    liked = {r.track_id: r for r in ranking.rank_candidates(candidates, snapshots=snapshots, model=model, similarity=None, seeds=s, top_k=5).collect()}
    assert liked["close"].predicted_preference == pytest.approx(1 / (1 + math.exp(-5)), abs=1e-8) and liked["close"].rank == 1


def test_logistic_matches_newton(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 2)) * [1, 5] + [3, 0]
    y = (x[:, 0] + rng.normal(size=120) > 3).astype(float)
    w = rng.uniform(0.5, 3, 120)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(d)) for (a, b), c, d in zip(x, y, w, strict=True)], "a double, b double, label double, sample_weight double")
    model = training.fit_logistic(df, ["a", "b"])
    mean = (w[:, None] * x).sum(0) / w.sum()
    scale = np.sqrt((w[:, None] * (x - mean) ** 2).sum(0) / w.sum())
    z = np.column_stack([(x - mean) / scale, np.ones(120)])
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ beta))
        beta -= np.linalg.solve(np.eye(3) + (z * (w * p * (1 - p))[:, None]).T @ z, beta + z.T @ (w * (p - y)))
    assert np.allclose([*model.coefficient, model.intercept], beta, atol=1e-5)
    assert training.from_json(training.to_json(model)) == model
    with pytest.raises(ValueError):
        training.from_json(training.to_json(model) | {"intercept": 0.0})


def test_taste_variants_without_two_labels_are_listed(spark):
    rows = [(f"s{i}", f"k{i}", s, p, 0, 1.0, *([float(i)] * 13)) for i, (s, p) in enumerate([("train", 0), ("train", 1), ("validation", 2), ("test", 3)])]
    samples = spark.createDataFrame(rows, "sample_id string, track_id string, split string, period_index int, label int, sample_weight double, " + ", ".join(f"{n} double" for n in temporal.FEATURES))
    with pytest.raises(training.NothingTrained) as none:
        training.train_taste_models(samples)
    assert [f.reason for f in none.value.found] == ["the training split has one label alone"] * 3


def test_taste_map(spark):
    rows = [(f"t{c}{o}", [cx + o / 100, cy - o / 100, cx, cy, 1 + o / 100]) for c, (cx, cy) in enumerate([(-5.0, -5.0), (0.0, 5.0), (5.0, -5.0)]) for o in range(10)]
    df = spark.createDataFrame(rows, "track_id string, vector array<double>")
    assigned, tried = clustering.taste_map(df, TasteMapConfig(maximum_clusters=4, density_sizes=(5,), seeds=(1, 2)))
    by = {}
    for r in assigned.collect():
        by.setdefault(r.track_id[1], set()).add(r.cluster_id)
    assert len(by) == 3 and all(len(s) == 1 for s in by.values()) and len(set.union(*by.values())) == 3
    assert {"kmeans", "density"} <= set(tried["method"])


@pytest.mark.parametrize("block", [7, 10_000])
def test_silhouettes_of_many_labelings_are_those_of_each(spark, block):
    rng = np.random.default_rng(3)
    labels = np.stack([rng.integers(0, 3, 60), np.where(np.arange(60) == 5, 0, 1 + np.arange(60) % 2)], 1)
    rows = [(i, rng.normal(size=4).tolist(), labels[i].tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "track_id int, vector array<double>, labels array<int>")
    got = clustering.silhouettes(df, [np.bincount(labels[:, 0], minlength=4), np.bincount(labels[:, 1])], block=block)
    each = [clustering.silhouette(df.withColumn("cluster_id", F.col("labels")[j])).first().silhouette for j in range(2)]
    assert got == pytest.approx(each)
    cells = np.array([[int(((labels[:, 0] == a) & (labels[:, 1] == b)).sum()) for b in range(3)] for a in range(3)], float)
    two = df.select(F.col("labels")[0].alias("a"), F.col("labels")[1].alias("b"))
    assert clustering._rand(cells) == pytest.approx(clustering.adjusted_rand(two, "a", "b").first().ari)


def test_density_labels_find_noise():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(40, 2)) * 0.1, rng.normal(size=(40, 2)) * 0.1 + 5, [[20.0, -20.0]]])
    label = clustering.density_labels(x, 5)
    assert label[-1] == -1 and len({*label[:40]} - {-1}) == 1 and len({*label[40:80]} - {-1}) == 1 and label[0] != label[40]


def noisy(n):
    rng = np.random.default_rng(4)
    return np.concatenate([rng.normal(size=(n // 2, 2)), rng.uniform(-6, 6, size=(n // 4, 2)), rng.normal(size=(n - n // 2 - n // 4, 2)) * 0.2 + 3])


def test_density_labels_hold_no_square_of_the_rows():
    x = noisy(4000)
    tracemalloc.start()
    clustering.density_labels(x, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4000 * 4000 * 8


def test_density_clusters_by_blocks(spark):
    x = noisy(500)
    df = clustering.numbered(spark.createDataFrame([(r.tolist(),) for r in x], "vector array<double>").repartition(3).persist())
    rows = df.orderBy("i").collect()
    assert [r.i for r in rows] == list(range(500))
    x = np.array([r.vector for r in rows])
    found = clustering.density_clusters(df, (5, 20, 300), block=70).toPandas()
    assert set(found["size"]) == {5, 20}  # 300 points can't be two clusters
    for least in (5, 20):
        got, want = found[found["size"] == least].sort_values("i")["cluster_id"].to_numpy(), clustering.density_labels(x, least)
        both = np.zeros((got.max() + 2, want.max() + 2))
        np.add.at(both, (got + 1, want + 1), 1)
        assert len(got) == 500 and got.max() > 0 and got.min() == -1 and clustering._rand(both) > 0.98  # equal lengths may part otherwise
        clusters = spark.createDataFrame([(i, int(c), v.tolist()) for i, (c, v) in enumerate(zip(got, x, strict=True)) if c >= 0], "track_id long, cluster_id int, vector array<double>")
        exact = clustering.silhouette(clusters).first().silhouette
        for block, widest in ((10_000, 256), (40, 2)):
            assert clustering.silhouette_of_many(clusters, block=block, widest=widest) == pytest.approx(exact)


def test_vectors(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("a", [0.0, 1.0])], "k string, v array<double>")
    assert V.pooled(df, ["k"], "v").first().pooled == pytest.approx([math.sqrt(0.5)] * 2)
    row = spark.range(1).select(V.cosine(V.literal([1, 0]), V.literal([0, 2])), V.cosine(V.literal([0, 0]), V.literal([0, 2])), V.binary_confidence(V.literal([1.0, 1.0]), F.lit(0.8))).first()
    assert row[0] == 0 and row[1] is None and row[2] == pytest.approx(0.8, abs=1e-6)


def test_invariance(spark):
    rows = [("gain", "a", "a", 0.9), ("gain", "a", "b", 0.2), ("gain", "b", "a", 0.8), ("gain", "b", "b", 0.7)]
    r = metrics.invariance(spark.createDataFrame(rows, "transform string, query_id string, recording_id string, cosine double")).first()
    assert (r.queries, r.top1, r.mean_cosine, r.min_cosine) == (2, 0.5, pytest.approx(0.8), 0.7)


def test_plans_push_down_and_never_loop(spark, tmp_path):
    events(spark, [(at("2025-01-01T10:00"), "track", "t", "a", 1, None, None, None)]).withColumn("extra", F.lit("x")).write.parquet(str(tmp_path / "e"))
    plan = behavior.track_affinity(spark.read.parquet(str(tmp_path / "e")))._jdf.queryExecution().executedPlan().toString()
    assert "extra" not in plan and "Python" not in plan and "CartesianProduct" not in plan
