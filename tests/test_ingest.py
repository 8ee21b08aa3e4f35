import json
import zipfile

import pytest
from pyspark.sql import functions as F

from refrain import contracts
from refrain.functions import text
from refrain.sources import history, sinks, tables

URI1, URI2 = "spotify:track:" + "1" * 22, "spotify:track:" + "2" * 22
EPISODE = "spotify:episode:" + "3" * 22


def record(ts, ms=1000, **more):
    return {"ts": ts, "ms_played": ms, "username": "me", "ip_addr": "1.2.3.4", "platform": "iOS 17"} | more


def track(ts, uri=URI1, ms=180_000, **more):
    return record(ts, ms, spotify_track_uri=uri, master_metadata_track_name=" Song ", master_metadata_album_artist_name="Artist", master_metadata_album_album_name="", **more)


def save(folder, name, records):
    (folder / name).write_text(json.dumps(records), encoding="utf-8")


def test_load_history(spark, tmp_path):
    good = track("2025-01-01T10:00:00Z", reason_start="clickrow", skipped=False)
    save(tmp_path, "Streaming_History_Audio_1.json", [track("2025-01-08T10:00:00Z", URI2), good, record("2025-01-09T12:30:00Z", spotify_episode_uri=EPISODE)])
    save(tmp_path, "endsong_2.json", [good, {"endTime": "2025-02-01 09:30", "msPlayed": 5, "trackName": "Old", "artistName": "One"}])
    save(tmp_path, "notes.json", [track("2025-01-01T10:00:00Z")])
    events, rejects, report = history.load_history(spark, str(tmp_path))
    rows = events.collect()
    assert [r.media_type for r in rows] == ["track", "track", "episode", "track"]
    assert rows[0].source_file == "endsong_2.json"  # the first in source order stays
    assert rows[0].track_name == "Song" and rows[0].album_name is None and rows[0].platform_family == "ios"
    assert rows[3].track_name == "Old"
    assert not contracts.forbidden_fields(events.schema)
    r = report.first()
    assert (r.records, r.rejected, r.duplicates, r.track_events, r.episode_events) == (5, 0, 1, 3, 1)
    assert rejects.count() == 0


@pytest.mark.parametrize(
    "bad, code",
    [
        (track("2025-01-01T10:00:00"), "invalid_timestamp"),
        (track("2025-01-01T10:00:00Z", ms=-1), "invalid_ms_played"),
        (track("2025-01-01T10:00:00Z", "spotify:track:short"), "invalid_spotify_uri"),
        (track("2025-01-01T10:00:00Z", spotify_episode_uri=EPISODE), "ambiguous_media_type"),
        (track("2025-01-01T10:00:00Z", skipped=1), "invalid_boolean"),
        (track("nonsense", "spotify:track:short", ms=-1), "invalid_timestamp"),
    ],
)
def test_rejects(spark, tmp_path, bad, code):
    save(tmp_path, "endsong_1.json", [bad])
    _, rejects, _ = history.load_history(spark, str(tmp_path))
    assert [r.error_code for r in rejects.collect()] == [code]
    with pytest.raises(history.RejectedRecord):
        history.load_history(spark, str(tmp_path), strict=True)


def test_zip_and_sensitive_counts(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "export.zip", "w") as z:
        z.writestr("x/endsong_1.json", json.dumps([track("2025-01-01T10:00:00Z")]))
        z.writestr("x/other.json", "[]")
    raw = history.read_raw(spark, str(tmp_path / "export.zip"))
    assert {r.field: r.records for r in history.sensitive_counts(raw).collect()} == {"username": 1, "ip_addr": 1}


def test_event_id_is_canonical_json(spark, tmp_path):
    import hashlib

    save(tmp_path, "endsong_1.json", [track("2025-01-01T10:00:00Z", None, 7, reason_end='q"é', skipped=True)])
    got = history.load_history(spark, str(tmp_path))[0].first().event_id
    body = {"played_at": "2025-01-01T10:00:00.000Z", "media_type": "track", "media_identity": ["Song", "Artist", None, None, None], "ms_played": 7, "reason_start": None, "reason_end": 'q"é', "shuffle": None, "skipped": True, "offline": None, "incognito_mode": None}
    assert got == hashlib.sha256(json.dumps(body, ensure_ascii=False, separators=(",", ":"), sort_keys=True).encode()).hexdigest()


def test_contracts(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, username string")
    with pytest.raises(contracts.ContractError):
        contracts.assert_private(df.select(F.struct("username").alias("s")))
    with pytest.raises(contracts.ContractError):
        contracts.assert_unique(df, "k")
    (tmp_path / "a.jsonl").write_text('{"k": 1}\n{"k": 2, "x": 3}\n')
    with pytest.raises(contracts.ContractError):
        tables.read_jsonl(spark, str(tmp_path / "a.jsonl"), "k INT")


def test_candidates(spark, tmp_path):
    (tmp_path / "c.csv").write_text(f"uri,title,artist\n{URI1},T,A\nhttps://open.spotify.com/track/{'2' * 22}?si=1,U,B\n")
    got = tables.read_candidates(spark, str(tmp_path / "c.csv")).orderBy("track_id").collect()
    assert [(r.track_id, r.track_name, r.artist_name) for r in got] == [(URI1, "T", "A"), (URI2, "U", "B")]
    (tmp_path / "c.txt").write_text(f"{'1' * 22}\n\n{URI1}\n")
    with pytest.raises(contracts.ContractError):
        tables.read_candidates(spark, str(tmp_path / "c.txt"))
    (tmp_path / "d.csv").write_text(f"uri,url\n{URI1},{URI2}\n")
    with pytest.raises(contracts.ContractError):
        tables.read_candidates(spark, str(tmp_path / "d.csv"))


def test_account_catalog_and_playlist(spark, tmp_path):
    save(tmp_path, "YourLibrary.json", {"tracks": [{"artist": "A", "album": "X", "track": "T", "uri": URI1}], "bannedTracks": []})
    item = {"track": {"trackName": "T", "artistName": "A", "albumName": "X", "trackUri": URI1}}
    other = {"track": {"trackName": "U", "artistName": "B", "albumName": "Y", "trackUri": URI2}}
    save(tmp_path, "Playlist1.json", {"playlists": [{"name": "Mix", "items": [other, item, other, {"track": None}]}]})
    rows = tables.read_account_catalog(spark, str(tmp_path)).orderBy("track_uri").collect()
    assert [(r.track_uri, r.source_collection) for r in rows] == [(URI1, "library"), (URI2, "Mix")]
    tracks, counts = tables.read_playlist(spark, str(tmp_path), "mix")
    assert [r.track_uri for r in tracks.collect()] == [URI2, URI1]
    assert counts == {"items": 4, "not_tracks": 1, "duplicates": 1}


def test_dump_archive(spark, tmp_path):
    import tarfile

    import zstandard

    (tmp_path / "lowlevel.csv").write_text("mbid,submission_offset,average_loudness,dynamic_complexity,mfcc_zero_mean\na,1,0.5,,\n")
    with tarfile.open(tmp_path / "d.tar", "w") as t:
        t.add(tmp_path / "lowlevel.csv", "x/lowlevel.csv")
    (tmp_path / "d.tar.zst").write_bytes(zstandard.compress((tmp_path / "d.tar").read_bytes()))
    (tmp_path / "out").mkdir()
    row = tables.read_dump(spark, str(tmp_path / "d.tar.zst"), contracts.LOWLEVEL, member="lowlevel.csv", scratch=str(tmp_path / "out")).first()
    assert (row.mbid, row.average_loudness, row.dynamic_complexity) == ("a", 0.5, None)
    with pytest.raises(contracts.ContractError):
        tables.read_dump(spark, str(tmp_path / "lowlevel.csv"), contracts.TONAL)


def test_audio_jobs(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(b"one")
    (tmp_path / "b.wav").write_bytes(b"two")
    at = tmp_path / "manifest.jsonl"

    def manifest(*rows):
        at.write_text("".join(json.dumps(dict(zip(("track_id", "audio_path", "rights_basis"), r, strict=True))) + "\n" for r in rows), encoding="utf-8")
        return tables.read_audio_manifest(spark, str(at))

    def jobs(assets, **settings):
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(str(tmp_path))
        return {r.track_id: r for r in tables.audio_jobs(assets, files, settings).collect()}

    assets = manifest(("x", "a.wav", " Owned"), ("y", str(tmp_path / "b.wav"), "licensed"))
    first = jobs(assets, rate=1, bands=2)
    assert first["x"].audio_path == str(tmp_path / "a.wav") and first["x"].rights_basis == "owned"
    assert {k: r.job_key for k, r in jobs(assets, bands=2, rate=1).items()} == {k: r.job_key for k, r in first.items()}
    assert not {r.job_key for r in jobs(assets, rate=2, bands=2).values()} & {r.job_key for r in first.values()}
    done = spark.createDataFrame([(first["x"].job_key,)], "job_key string")
    (tmp_path / "b.wav").write_bytes(b"three")
    again = jobs(assets, rate=1, bands=2)
    assert again["x"].job_key == first["x"].job_key and again["y"].job_key != first["y"].job_key
    left = tables.uncached(spark.createDataFrame(list(again.values())), done)
    assert [r.track_id for r in left.collect()] == ["y"]
    for bad in ([("x", "a.wav", "found")], [("x", " ", "owned")], [("x", "a.wav", None)], [("x", "a.wav", "owned"), ("x", "b.wav", "owned")], []):
        with pytest.raises(contracts.ContractError):
            manifest(*bad)
    with pytest.raises(contracts.ContractError):
        jobs(manifest(("x", "gone.wav", "owned")))


def test_cached_json(tmp_path):
    answers = [(503, {"Retry-After": "1"}, b""), (200, {}, b'{"a": 1}')]
    paused = []
    client = tables.CachedJson(lambda url: answers.pop(0), str(tmp_path), pause=paused.append)
    assert client.get("u") == {"a": 1} and paused == [1.0]
    assert tables.CachedJson(lambda url: (500, {}, b""), str(tmp_path), offline=True).get("u") == {"a": 1}
    with pytest.raises(contracts.ContractError):
        tables.CachedJson(lambda url: (404, {}, b""), str(tmp_path)).get("v")


def test_text(spark):
    df = spark.createDataFrame([("Ünïcode  Straße!", "Beyoncé"), ("Plain (Mix)", "A b"), (None, None)], "t string, a string")
    assert [r.n for r in df.withColumn("n", text.normalized_exact(F.col("t"))).orderBy("n").select("n").collect()] == ["", "plain mix", "ünïcode strasse"]
    assert {r[0] for r in df.filter("a is not null").select(text.combined_lookup("a", "t")).collect()} == {"beyonceunicodestrae", "abplainmix"}
    ratio = df.limit(1).select(text.similarity_ratio(F.lit("abcd"), F.lit("abxd"))).first()[0]
    assert ratio == 0.75
    family = spark.createDataFrame([("Windows 10",), ("Smart_TV",), ("?",), (None,)], "p string").select(text.platform_family(F.col("p")).alias("f"))
    assert [r.f for r in family.collect()] == ["windows", "tv", "other", None]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "n int, spotify_uri string")
    ranked = rows.withColumn("rank", F.when(F.col("n") < 3, 3 - F.col("n")))
    sinks.write_ranked_uris(ranked, str(tmp_path / "u"))
    assert [r.value for r in spark.read.text(str(tmp_path / "u")).collect()] == ["t2", "t1", "t0"]
    sinks.write_jsonl(rows, str(tmp_path / "j"), [F.desc("n")])
    assert "".join(p.read_text() for p in sorted((tmp_path / "j").glob("part-*"))).splitlines()[0] == '{"n":4,"spotify_uri":"t4"}'
    page = sinks.explorer(spark.createDataFrame([("</script>\u2028a b",)], "x string"), "T<")
    assert "\\u2028a b" in page and "\u2028" not in page
    escaped = spark.range(1).select(text.escape_json_for_html(F.lit("<a b>\u2029"))).first()[0]
    assert escaped == "\\u003ca b\\u003e\\u2029"
    assert "</script>" not in page.split("<script>")[1].split("</script>")[0] and "\\u003c/script\\u003e" in page


def test_batches_number_rows_that_are_more_than_a_sample(spark):
    rows = spark.range(60_000).select((F.col("id") * 7_919 % 60_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("other")).repartition(6)
    got = sinks.batches(rows, "k").agg(F.max("other"), F.count(F.lit(1)).alias("n"), F.count_if((F.col("position") != F.col("k")) | (F.col("batch") != F.floor(F.col("k") / 100))).alias("wrong")).first()
    assert (got.n, got.wrong) == (60_000, 0)
    few = spark.createDataFrame([(None, "a"), (2, "b"), (1, "c")], "k int, v string")
    assert [r.v for r in sinks.batches(few, "k").orderBy("position").collect()] == ["a", "c", "b"]
    assert sinks.batches(few.limit(0), "k").count() == 0


def test_feedback(spark, tmp_path):
    path = str(tmp_path / "feedback")
    at = F.timestamp_micros(F.lit(1_700_000_000_000_000))
    new = spark.range(1).select(sinks.feedback(F.lit("run"), F.lit("t"), F.lit("saved"), at).alias("f")).select("f.*")
    sinks.append_feedback(new, path)
    assert tables.read_feedback(spark, path, contracts.FEEDBACK).count() == 1
    with pytest.raises(contracts.ContractError):
        sinks.append_feedback(new, path)
    with pytest.raises(contracts.ContractError):
        sinks.append_feedback(new.withColumn("outcome", F.lit("loved")), str(tmp_path / "other"))


def test_publish_resumes_on_a_prefix():
    plan = sinks.PlaylistPlan.of("n", [f"u{i}" for i in range(250)], "run")
    there, receipts, left = [], [], [2]

    def add(_, uris):
        if not left[0]:
            raise OSError
        left[0] -= 1
        there.extend(uris)

    calls = {"create": lambda name: "p", "read": lambda _: list(there), "add": add, "save": receipts.append}
    assert sinks.publish(plan, dry_run=True, **calls)["status"] == "planned"
    with pytest.raises(OSError):
        sinks.publish(plan, **calls)
    left[0] = 9
    done = sinks.publish(plan, receipt={k: v for k, v in receipts[-1].items() if k != "status"}, **calls)
    assert done["status"] == "complete" and there == list(plan.uris)
    there[0] = "changed"
    with pytest.raises(contracts.ContractError):
        sinks.publish(plan, receipt={k: v for k, v in receipts[-1].items() if k != "status"}, **calls)
