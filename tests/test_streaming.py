"""Streams over a folder against the batch results."""

import shutil

from pyspark.sql import functions as F

from orthoweave.sources.roles import telemetry
from orthoweave.streaming import telemetry as stream

SF = "/root/testdata/sf0.001"


def _folder(tmp_path):
    (tmp_path / "in").mkdir()
    shutil.copy(f"{SF}/events.parquet", tmp_path / "in/events.parquet")
    return str(tmp_path / "in")


def _collect(df, tmp_path, mode):
    got = []
    stream.run_once(df, str(tmp_path), mode=mode, merge=lambda batch, _: got.extend(batch.collect()))
    return got


def test_tumbling_windows_equal_batch(spark, tmp_path):
    got = _collect(stream.windowed(stream.events(spark, _folder(tmp_path)), length="1 day"), tmp_path, "complete")
    rows = telemetry(spark, SF)
    want = rows.groupBy(F.window("ts", "1 day").start.alias("start"), "stage").agg(F.count("*").alias("n")).collect()
    assert {(r.start, r.stage): r.n for r in got} == {(r.start, r.stage): r.n for r in want}


def test_sessions_equal_batch(spark, tmp_path):
    df = stream.sessions(stream.events(spark, _folder(tmp_path)), gap="6 hours", late="3650 days")
    got = _collect(df, tmp_path, "complete")
    want = telemetry(spark, SF).groupBy(F.session_window("ts", "6 hours").alias("s"), "scene").agg(F.count("*").alias("n")).select("scene", F.col("s.start").alias("start"), "n").collect()
    assert sorted((r.scene, r.start, r.n) for r in got) == sorted((r.scene, r.start, r.n) for r in want)


def test_state_follows_each_scene(spark, tmp_path):
    got = {r.scene: r for r in _collect(stream.strip_progress(stream.events(spark, _folder(tmp_path))), tmp_path, "update")}
    want = telemetry(spark, SF).filter("accepted").groupBy("scene").agg(F.count("*").alias("done"), F.min("residual_m").alias("best"), F.max("seq").alias("last")).collect()
    assert {s: (r.done, r.best_m, r.last_seq) for s, r in got.items()} == {r.scene: (r.done, r.best, r.last) for r in want}
