"""Streams: watching an append-only log, and event windows with a watermark."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marsad.session import checkpoint_dir

LOG_SCHEMA = "run string, name string, place bigint, sampler_path string, final boolean"


def checkpoint_id(df: DataFrame) -> DataFrame:
    """Entries with a path, named by their name and twelve digits of the path's hash."""
    has = df.filter(F.coalesce("sampler_path", F.lit("")) != "")
    return has.withColumn("checkpoint_id", F.concat(F.coalesce("name", F.lit("checkpoint")), F.lit("-"), F.substring(F.sha2("sampler_path", 256), 1, 12)))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A log folder as a stream: one file per append, dropped in whole; a line that does not parse gives no row."""
    return spark.readStream.schema(LOG_SCHEMA).json(path)


def select_every(log: DataFrame, every: int, most: int) -> DataFrame:
    """(run, checkpoint_id, place) of every ``every``-th entry of a run, at most ``most``, and of its final entry.

    Entries that come twice count once. The number seen and taken is kept as state per run, so the
    selection goes on where it stood after a restart. State grows with the runs and the entries, as a
    log without an end of time needs.
    """

    def take(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, taken = state.get if state.exists else (0, 0)
        rows = pd.concat(list(frames)).sort_values(["place", "checkpoint_id"])
        keep = []
        for final in rows["final"]:
            seen += 1
            hit = seen % every == 0 and taken < most
            taken += hit
            keep.append(bool(hit or final is True or final == True))  # noqa: E712
        state.update((seen, taken))
        yield rows.loc[keep, ["run", "checkpoint_id", "place"]]

    unique = checkpoint_id(log).dropDuplicates(["run", "checkpoint_id"])
    return unique.groupBy("run").applyInPandasWithState(take, "run string, checkpoint_id string, place bigint", "seen bigint, taken bigint", "append", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame, target: str, state: str) -> DataFrame:
    """Run a stream over what is there, into a table of files, and read it; a second run goes on from the first."""
    q = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(target)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def windows(events: DataFrame, length: str, late: str) -> DataFrame:
    """Events and their value by tumbling window and type; rows later than the watermark are left out of a stream."""
    timed = events.withWatermark("at", late)
    w = F.window("at", length)
    return timed.groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), "event_type", "n", "value")
