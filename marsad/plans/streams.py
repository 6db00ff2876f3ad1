"""Queries that run a stream over what is there and equal a batch query."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marsad.plans.catalog import query
from marsad.plans.records import LOG
from marsad.streaming import watch
from marsad.tables import load


@query("stream_checkpoint_watch", f"WITH l AS ({LOG}), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY place) AS taken FROM l WHERE place % 5 = 0) SELECT user_id::varchar AS run, 'step-' || left(sampler, 12) AS checkpoint_id, place FROM k WHERE taken <= 3")
def stream_checkpoint_watch(spark, sf):
    """The log of all events, dropped as files and watched as a stream."""
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    log = load(spark, sf, "events").select(F.col("user_id").cast("string").alias("run"), F.lit("step").alias("name"), place.cast("long").alias("place"), F.concat_ws(":", "user_id", "event_id").alias("sampler_path"), F.lit(False).alias("final"))
    folder = watch.scratch(spark, "log")
    log.write.json(folder)
    return watch.run_available(watch.select_every(watch.read_log(spark, folder), 5, 3), watch.scratch(spark, "taken"), watch.scratch(spark, "state"))


@query("event_windows", "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def event_windows(spark, sf):
    """Events by day and type, the windows that a stream of them closes one after the other."""
    e = load(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("at"), "event_type", "value")
    return watch.windows(e, "1 day", "2 days").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("value", 4).alias("value"))
