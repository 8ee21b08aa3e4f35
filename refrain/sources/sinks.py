"""Writers: deterministic JSON lines, URI hand-off, feedback log, playlist plans, explorer page."""

from __future__ import annotations

import base64
import hashlib
import json
import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refrain.contracts import FEEDBACK, OUTCOMES, ContractError, assert_all, assert_private
from refrain.functions.text import digest_id, timestamp_text
from refrain.sources.tables import read_feedback


def write_text(path: str, text: str) -> None:
    """Replace a driver-side file at once: readers see the old one or the new."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(f".{target.name}.{uuid.uuid4().hex}")
    part.write_text(text, encoding="utf-8")
    os.replace(part, target)


def write_jsonl(df: DataFrame, path: str, order: Sequence[str | Column]) -> None:
    """JSON lines with sorted keys in a fixed order; private fields are refused. The
    rows are range-partitioned by the order, so files follow each other in it."""
    assert_private(df)
    df.select(*sorted(df.columns)).orderBy(*order).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_ranked_uris(ranked: DataFrame, path: str) -> None:
    """One URI a line, in rank order, of ranked rows that have one. Ranked rows are at most top_k."""
    ranked.filter("rank IS NOT NULL AND spotify_uri IS NOT NULL").orderBy("rank").select("spotify_uri").coalesce(1).write.mode("overwrite").text(path)


def feedback(run_id: Column, track_id: Column, outcome: Column, recorded_at: Column) -> Column:
    """A feedback record with the id that its content determines."""
    return F.struct(F.lit(1).alias("schema_version"), digest_id(run_id, track_id, outcome, timestamp_text(recorded_at)).alias("feedback_id"), run_id.alias("recommendation_run_id"), track_id.alias("track_id"), outcome.alias("outcome"), recorded_at.alias("recorded_at"))


def append_feedback(new: DataFrame, path: str) -> None:
    """Append records to the log; a known outcome, filled ids and ids new to the log are required."""
    spark = new.sparkSession
    assert_all(new, F.col("outcome").isin(*OUTCOMES) & (F.trim("recommendation_run_id") != "") & (F.trim("track_id") != ""), "a feedback record is incomplete")
    old = read_feedback(spark, path, FEEDBACK)
    again = new.join(old.select("feedback_id"), "feedback_id", "left_semi").limit(1).count()
    if again or new.groupBy("feedback_id").count().filter("count > 1").limit(1).count():
        raise ContractError("a feedback record is in the log already")
    new.orderBy("recorded_at", "feedback_id").write.mode("append").json(path)


def merge_feedback(log: DataFrame, new: DataFrame) -> DataFrame:
    """The log with the records of ``new`` that it lacks, each id once."""
    w = Window.partitionBy("feedback_id").orderBy("recorded_at")
    fresh = new.join(log.select("feedback_id"), "feedback_id", "left_anti").withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    return log.unionByName(fresh)


def batches(items: DataFrame, order: str, size: int = 100) -> DataFrame:
    """Adds ``position`` (from 0) and ``batch`` for requests of ``size`` items at most.

    Items are dealt out by ranges of ``order`` (unique), which are numbered each by
    itself; only the ranges' sizes pass through one window. The ranges' bounds are
    chosen once, by a hash, and a row's range follows from them and its key alone:
    a range partitioning would draw other bounds each time it is planned.
    """
    ranges = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = max(1, items.count() // (64 * ranges))
    drawn = [r[0] for r in items.select(order).filter(F.col(order).isNotNull() & (F.pmod(F.xxhash64(order), F.lit(every)) == 0)).distinct().orderBy(order).collect()]
    bounds = drawn[:: max(1, len(drawn) // ranges)]

    def place(low: int, high: int) -> Column:
        """The number of bounds up to a row's key, by halving; nulls come first."""
        middle = (low + high) // 2
        return F.lit(low) if low == high else F.when(F.col(order) >= bounds[middle], place(middle + 1, high)).otherwise(place(low, middle))

    ranged = items.withColumn("_p", place(0, len(bounds)))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_p").count().select("_p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(order)) - 1
    position = (F.col("_before") + F.col("_i")).cast("int")
    numbered = ranged.withColumn("_i", inside).join(F.broadcast(sizes), "_p").withColumn("position", position).drop("_p", "_i", "_before")  # a row a range
    return numbered.withColumn("batch", F.floor(F.col("position") / size).cast("int"))


@dataclass(frozen=True)
class PlaylistPlan:
    """An ordered, duplicate-free list of URIs and the name to publish it under."""

    name: str
    uris: tuple[str, ...]
    run_id: str
    plan_id: str = field(default="")

    @staticmethod
    def of(name: str, uris: Sequence[str], run_id: str) -> PlaylistPlan:
        if len(set(uris)) != len(uris) or not uris:
            raise ContractError("a plan needs URIs, each once")
        body = json.dumps({"name": name, "run_id": run_id, "uris": list(uris)}, ensure_ascii=False, separators=(",", ":"), sort_keys=True)
        return PlaylistPlan(name, tuple(uris), run_id, hashlib.sha256(body.encode()).hexdigest())


def publish(plan: PlaylistPlan, *, create: Callable[[str], str], read: Callable[[str], list[str]], add: Callable[[str, list[str]], None], save: Callable[[dict], None], receipt: dict | None = None, dry_run: bool = False, size: int = 100) -> dict:
    """Publish in batches; an interrupted run goes on only if the playlist holds an
    exact prefix of the plan. ``save`` keeps the receipt after every step."""
    if receipt and receipt["plan_id"] != plan.plan_id:
        raise ContractError("the receipt is of another plan")
    state = dict(receipt or {"plan_id": plan.plan_id, "playlist": None, "added": 0})
    if dry_run:
        return state | {"status": "planned", "total": len(plan.uris)}
    if state["playlist"] is None:
        state["playlist"] = create(plan.name)
        save(state | {"status": "created"})
    there = read(state["playlist"])
    if list(plan.uris[: len(there)]) != there:
        raise ContractError("the playlist has changed; it isn't a prefix of the plan")
    state["added"] = len(there)
    for i in range(len(there), len(plan.uris), size):
        add(state["playlist"], list(plan.uris[i : i + size]))
        state["added"] = min(i + size, len(plan.uris))
        save(state | {"status": status(state["added"], len(plan.uris))})
    return state | {"status": status(state["added"], len(plan.uris)), "total": len(plan.uris)}


def status(added: int, total: int) -> str:
    return "complete" if added == total else "publishing" if added else "created"


def explorer(rows: DataFrame, title: str, limit: int = 5_000) -> str:
    """One self-contained page over at most ``limit`` rows. Its script runs only under
    the hash in the page's policy, and data can't end the script it stands in."""
    data = "[" + ",".join(r.value for r in rows.limit(limit).select(F.to_json(F.struct("*")).alias("value")).collect()) + "]"
    for raw, safe in (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e"), ("\u2028", "\\u2028"), ("\u2029", "\\u2029")):
        data = data.replace(raw, safe)
    script = f"const rows={data};const t=document.querySelector('table');const keys=Object.keys(rows[0]||{{}});const line=(cells,tag)=>{{const r=t.insertRow();for(const c of cells){{const e=document.createElement(tag);e.textContent=c??'';r.append(e)}}}};line(keys,'th');for(const r of rows)line(keys.map(k=>typeof r[k]==='object'?JSON.stringify(r[k]):r[k]),'td')"
    digest = base64.b64encode(hashlib.sha256(script.encode()).digest()).decode()
    safe_title = title.replace("&", "&amp;").replace("<", "&lt;")
    return f"<!doctype html><meta charset=utf-8><meta http-equiv=Content-Security-Policy content=\"default-src 'none'; script-src 'sha256-{digest}'\"><title>{safe_title}</title><h1>{safe_title}</h1><table></table><script>{script}</script>"


def write_windows(windows: DataFrame, path: str) -> None:
    """Window vectors as Parquet, a file name a track digest being a column here."""
    windows.withColumn("track_digest", F.sha2("track_id", 256)).write.mode("overwrite").parquet(path)


def empty_feedback(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FEEDBACK)
