from datetime import datetime, timedelta

from pyspark.sql import functions as F

from refrain.config import TemporalConfig
from refrain.contracts import FEEDBACK
from refrain.sources import sinks, tables
from refrain.streaming import behavior

SCHEMA = "event_id string, played_at timestamp, user_id int, media_type string, track_id string, ms_played long, reason_end string, skipped boolean"


def write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def run(stream, name, mode):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    return q


def sample():
    start = datetime(2025, 1, 1)
    return [(f"e{i}", start + timedelta(hours=5 * i), i % 2, "track", f"t{i % 3}", 1000 * i, "trackdone" if i % 2 else "fwdbtn", not i % 2) for i in range(100)]


def test_windows_match_batch(spark, tmp_path):
    write(spark, tmp_path / "in", sample())
    write(spark, tmp_path / "in", [("late", datetime(2026, 1, 1), 0, "track", "t0", 1, None, None)])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run(behavior.media_counts(stream), "counts", "append")
    batch = behavior.media_counts(spark.read.parquet(str(tmp_path / "in")).filter("event_id <> 'late'"))
    assert sorted(map(tuple, spark.table("counts").collect())) == sorted(map(tuple, batch.collect()))
    run(behavior.period_tallies(stream, TemporalConfig(period_days=5)), "tallies", "append")
    assert spark.table("tallies").agg(F.sum("plays")).first()[0] == 100


def test_dedup_and_state(spark, tmp_path):
    rows = sample()[:20]
    write(spark, tmp_path / "in", rows + rows[:5])
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    run(behavior.deduplicated(stream), "once", "append")
    assert spark.table("once").count() == 20
    run(behavior.sessions(stream), "sessions", "append")
    run(behavior.running_state(stream), "state", "update")
    assert {r.track_id: r.plays for r in spark.table("state").collect()} == {"t0": 9, "t1": 9, "t2": 7}


def test_feedback_stream_is_idempotent(spark, tmp_path):
    at = F.timestamp_micros(F.lit(1_700_000_000_000_000))
    rows = spark.range(3).select(sinks.feedback(F.lit("run"), F.concat(F.lit("t"), "id"), F.lit("saved"), at).alias("f")).select("f.*")
    rows.write.parquet(str(tmp_path / "in"))
    for n in range(2):
        stream = spark.readStream.schema(FEEDBACK).parquet(str(tmp_path / "in"))
        behavior.log_feedback(stream, str(tmp_path / "log"), str(tmp_path / f"c{n}")).awaitTermination(60)
    assert tables.read_feedback(spark, str(tmp_path / "log"), FEEDBACK).count() == 3
