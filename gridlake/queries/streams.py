"""Streams over the events as landed files, run until all available data is read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridlake.functions.scalar import truncate
from gridlake.queries.registry import Tables, presented, query
from gridlake.session import work_dir
from gridlake.streaming import streams


@query(
    """SELECT date_trunc('hour', ts) AS hour, event_type, CAST(date_trunc('day', ts) AS DATE) AS day,
    arg_max(value, event_id) AS value, arg_min(user_id, event_id) AS user_id FROM events GROUP BY 1, 2, 3"""
)
def stream_upsert(t: Tables) -> DataFrame:
    """Last value and first user per hour and type, in a table partitioned by day."""
    folder = work_dir(t.spark, "stream-upsert")
    events = streams.read_landed(t.spark, t.path("events"))
    keyed = events.select(
        truncate(events, "ts", "hour").alias("hour"), "event_type", F.to_date("ts").alias("day"), "value", "user_id", "event_id"
    )
    run = streams.stream_upsert(
        keyed, f"{folder}/table", f"{folder}/checkpoint", ["hour", "event_type", "day"], ["value"], "event_id", "day"
    )
    run.awaitTermination()
    return t.spark.read.parquet(f"{folder}/table").select("hour", "event_type", "day", "value", "user_id")


@query(
    """SELECT date_trunc('hour', ts) AS ts, half_up(avg(value), 4) AS mean, count(value) AS n FROM events GROUP BY 1
    HAVING date_trunc('hour', min(ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"""
)
def stream_hourly(t: Tables) -> DataFrame:
    """Hourly means of the windows the watermark has closed."""
    folder = work_dir(t.spark, "stream-hourly")
    means = streams.stream_mean(streams.read_landed(t.spark, t.path("events")), "ts", "value")
    streams.append_to(means, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return presented(t.spark.read.schema(means.schema).parquet(f"{folder}/out"))


@query("SELECT event_type, max(ts) AS latest FROM events GROUP BY 1")
def stream_freshness(t: Tables) -> DataFrame:
    folder = work_dir(t.spark, "stream-freshness")
    state = streams.stream_freshness(streams.read_landed(t.spark, t.path("events")), "event_type", "ts")
    streams.latest_to(state, f"{folder}/out", f"{folder}/checkpoint", "event_type").awaitTermination()
    return presented(streams.read_latest(t.spark, f"{folder}/out", "event_type"))


def landed_in_turn(rows: DataFrame, part: Column, folder: str, run: Callable[[DataFrame], StreamingQuery]) -> None:
    """Land the rows of parts 0 to 3 one after the other; the stream goes on after each, so that a part is one
    micro-batch in however many files it is written."""
    landed = rows.sparkSession.readStream.schema(rows.schema).parquet(f"{folder}/in/*")
    for i in range(4):
        rows.filter(part == i).write.parquet(f"{folder}/in/{i}")
        run(landed).awaitTermination()


@query(
    """WITH e AS (SELECT event_id, ts, floor(4 * (event_id % 7) / 7) AS batch FROM events),
    seen AS (SELECT batch, max(ts) AS newest FROM e GROUP BY 1),
    mark AS (SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS newest FROM seen)
    SELECT event_id, CAST(batch AS BIGINT) AS batch FROM e JOIN mark USING (batch)
    WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= newest - INTERVAL 480 HOUR"""
)
def stream_late_rows(t: Tables) -> DataFrame:
    """Events that arrive out of order in four parts, and those of them that come over 480 hours late."""
    folder, spark = work_dir(t.spark, "stream-late"), t.spark
    events = t.events.select("event_id", "ts", "value")

    def run(landed: DataFrame) -> StreamingQuery:
        return streams.stream_mean_and_late(landed, "ts", "value", f"{folder}/state", f"{folder}/cp", 3600, 480 * 3600)

    landed_in_turn(events, F.floor(4 * (F.col("event_id") % 7) / 7), folder, run)
    return streams.read_late(spark, f"{folder}/state", events.schema).select("event_id", "batch")


@query(
    """SELECT user_id, max(ts) AS latest, epoch_ms(max(ts)) + 24 * 3600000 < (SELECT epoch_ms(max(ts)) FROM events) - 3600000 AS silent
    FROM events WHERE user_id IS NOT NULL GROUP BY 1"""
)
def stream_silence(t: Tables) -> DataFrame:
    """Users without an event for a day, as the stream knows them after four parts in order of time."""
    folder, spark = work_dir(t.spark, "stream-silence"), t.spark
    events = t.events.select("user_id", "ts")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(micros), F.max(micros)).first()

    def run(landed: DataFrame) -> StreamingQuery:
        states = streams.stream_silence(landed, "user_id", "ts", 24 * 3600)
        return streams.latest_to(states, f"{folder}/out", f"{folder}/checkpoint", "user_id")

    landed_in_turn(events, F.floor(4 * (micros - F.lit(first)) / (F.lit(last) - F.lit(first) + 1)), folder, run)
    return presented(streams.read_latest(spark, f"{folder}/out", "user_id"))
