"""Streaming counterparts of the batch operators: windows over stage telemetry, and the state of a strip as it is aligned.

Event time must be a TIMESTAMP; rows later than the watermark are dropped, as a stream's state has to end somewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Telemetry as a stream from a folder of Parquet files."""
    rows = spark.readStream.schema(SCHEMA).parquet(folder)
    return rows.select(F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("scene"), F.col("event_type").alias("stage"), F.col("value").alias("residual_m"), (F.col("event_type") != "error").alias("accepted"))


def windowed(rows: DataFrame, *, length: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """start, stage, n, mean_m of tumbling or sliding windows."""
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    got = rows.withWatermark("ts", late).groupBy(window, "stage").agg(F.count("*").alias("n"), F.avg("residual_m").alias("mean_m"))
    return got.select(F.col("window.start").alias("start"), "stage", "n", "mean_m")


def sessions(rows: DataFrame, *, gap: str, late: str = "1 hour") -> DataFrame:
    """scene, start, end, n: runs of a scene's telemetry without a longer gap."""
    got = rows.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), "scene").agg(F.count("*").alias("n"))
    return got.select("scene", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def strip_progress(rows: DataFrame) -> DataFrame:
    """scene, done, best_m, last_seq: what a scene's accepted stages amount to so far, one row each time that it changes.

    State is three numbers a scene, whatever the length of the stream.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done, best, last = state.get if state.exists else (0, float("inf"), -1)
        before = done
        for f in frames:
            ok = f[f.accepted & f.residual_m.notna()]
            done += len(ok)
            best = min([best, *ok.residual_m])
            last = max([last, *ok.seq])
        state.update((int(done), float(best), int(last)))
        if done != before:
            yield pd.DataFrame({"scene": [key[0]], "done": [done], "best_m": [best], "last_seq": [last]})

    return rows.groupBy("scene").applyInPandasWithState(step, "scene long, done long, best_m double, last_seq long", "done long, best double, last long", "update", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, path: str, *, mode: str, merge=None) -> None:
    """Runs a stream over what is there and stops; batches are merged by ``merge(df, batch_id)`` or appended as Parquet."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/_checkpoint").trigger(availableNow=True)
    query = (writer.foreachBatch(merge) if merge else writer.format("parquet").option("path", f"{path}/rows")).start()
    query.awaitTermination()
