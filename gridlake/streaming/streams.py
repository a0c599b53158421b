"""Streaming forms of the batch operators. Each gives the batch result on the data it has closed."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType, TimestampType

from gridlake.functions.scalar import nan_to_null
from gridlake.operators.series import floor_every
from gridlake.session import child_names, delete_path, path_status
from gridlake.sources.loading import upsert_partitions


def read_landed(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream the parquet files that land at `path` (a folder, or one file)."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if path_status(spark, path) == "file":
        folder, _, name = path.rstrip("/").rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def stream_upsert(
    stream: DataFrame, path: str, checkpoint: str, key: list[str], update_cols: list[str], seq: str, part: str
) -> StreamingQuery:
    """Upsert every micro-batch into a partitioned parquet table. A replayed batch changes nothing.

    `seq` decides within a batch; between batches the later batch wins, as with repeated polls.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read twice: for the partitions it touches, and to merge it
        try:
            upsert_partitions(spark, path, batch, key, update_cols, seq, part, batch_id, f"{checkpoint}/staged")
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_mean(stream: DataFrame, ts: str, val: str, every: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Mean per tumbling window, NaN counting as missing; a window is emitted once, when the watermark has passed its end."""
    stamped = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    means = stamped.groupBy(F.window(ts, every).alias("_w")).agg(F.avg(nan_to_null(val)).alias("mean"), F.count(nan_to_null(val)).alias("n"))
    return means.select(F.col("_w.start").alias(ts), "mean", "n")


def stream_mean_and_late(
    stream: DataFrame, ts: str, val: str, path: str, checkpoint: str, every_seconds: int = 3600, late_seconds: int = 3600,
) -> StreamingQuery:
    """Means per window as `stream_mean` gives them, and beside them the rows that came behind the watermark.

    Each micro-batch writes its sums per window, its late rows and its newest stamp under its own number, the stamp
    last; a batch that is run again writes the same. A row is late when its window was closed before its batch: when it
    ended before the newest stamp of the batches up to the last but one, less `late_seconds`, which is the engine's own
    rule. `read_means` and `read_late` give the results.
    """

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            before = _newest(spark, path, number - 1)
            slot = floor_every(batch, ts, every_seconds).cast("timestamp")
            bound = F.lit(before) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(late_seconds))
            end = slot + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(every_seconds))
            late = F.coalesce(end <= bound, F.lit(False)) if before is not None else F.lit(False)
            value = nan_to_null(val)
            sums = batch.filter(~late & F.col(ts).isNotNull()).groupBy(slot.alias("slot")).agg(F.sum(value).alias("total"), F.count(value).alias("n"))
            sums.write.mode("overwrite").parquet(f"{path}/sums/batch={number}")
            batch.filter(late).write.mode("overwrite").parquet(f"{path}/late/batch={number}")
            newest = batch.agg(F.max(F.col(ts).cast("timestamp")).alias("newest"))
            newest.write.mode("overwrite").parquet(f"{path}/seen/batch={number}")
        finally:
            batch.unpersist()

    query = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()


def _newest(spark: SparkSession, path: str, before: int | None = None):
    """The newest stamp of the batches before a number, or of all."""
    if path_status(spark, f"{path}/seen") is None:
        return None
    seen = spark.read.schema("newest timestamp, batch long").parquet(f"{path}/seen")
    return (seen if before is None else seen.filter(F.col("batch") < before)).agg(F.max("newest")).first()[0]


def read_means(spark: SparkSession, path: str, ts: str, every_seconds: int = 3600, late_seconds: int = 3600) -> DataFrame:
    """Means of the windows that the watermark has closed."""
    sums = spark.read.schema("slot timestamp, total double, n long, batch long").parquet(f"{path}/sums")
    length = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(every_seconds + late_seconds))
    closed = sums.filter(F.col("slot") + length <= F.lit(_newest(spark, path)))
    totals = closed.groupBy(F.col("slot").alias(ts)).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return totals.select(ts, F.try_divide("total", "n").alias("mean"), "n")


def read_late(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows that came too late, with the number of their batch."""
    return spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(f"{path}/late")


def stream_freshness(stream: DataFrame, source: str, ts: str) -> DataFrame:
    """Latest stamp per source, for update mode."""
    return stream.groupBy(source).agg(F.max(F.col(ts).cast("timestamp")).alias("latest"))


def stream_silence(
    stream: DataFrame, source: str, ts: str, limit_seconds: int, late_seconds: int = 3600, buckets: int = 4096
) -> DataFrame:
    """Per source `latest` and whether it is `silent`, for update mode (`latest_to` keeps the newest state).

    A source is silent once the watermark (the newest stamp of all sources less `late_seconds`) has passed its latest
    stamp by more than `limit_seconds`, in whole milliseconds. A timer on event time emits it then, though no row of it
    comes any more; when it sends again, it is emitted as no longer silent. Rows behind the watermark do not count, and
    rows without source or stamp are ignored. Every task sends one row per source and Arrow batch into the
    shuffle, so a source that holds most rows does not fill a task. A source stays in the state for good.

    Sources share a state and a timer, that of the next one due, with those of the same hash bucket: Python is called at
    most `buckets` times a micro-batch, whatever the number of sources. A checkpoint keeps the `buckets` it began with.
    """
    kind = stream.schema[source].dataType

    def newest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = pa.Table.from_batches([batch]).group_by("source").aggregate([("latest", "max")])
            yield from most.select(["source", "latest_max"]).rename_columns(["source", "latest"]).to_batches()

    def follow(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        rows, before = [], mark
        if state.exists:
            sources, stamps, before = state.get
            rows.append(pd.DataFrame({"source": sources, "micros": stamps, "sent": False}))
        if not state.hasTimedOut:
            rows += [part[["source", "micros"]].assign(sent=True) for part in parts]
        known = pd.concat(rows).groupby("source", sort=False, dropna=False).max().reset_index()
        due = known["micros"] // 1000 + limit_seconds * 1000
        silent = due < mark
        if not silent.all():
            state.setTimeoutTimestamp(int(due[~silent].min()))
        state.update((known["source"].tolist(), known["micros"].tolist(), mark))
        told = known["sent"] | (silent & (due >= before))  # the others were told at the watermark of the call before
        yield pd.DataFrame({source: known["source"], "micros": known["micros"], "silent": silent})[told]

    stamped = stream.select(F.col(source).alias("source"), F.col(ts).cast("timestamp").alias("latest"))
    known = stamped.filter(F.col("source").isNotNull() & F.col("latest").isNotNull())
    shape = StructType([StructField("source", kind), StructField("latest", TimestampType())])
    reduced = known.mapInArrow(newest, shape).withWatermark("latest", f"{late_seconds} seconds")
    dealt = reduced.select("source", "latest", F.unix_micros("latest").alias("micros"), F.pmod(F.xxhash64("source"), F.lit(buckets)).alias("bucket"))
    out = StructType([StructField(source, kind), StructField("micros", LongType()), StructField("silent", BooleanType())])
    held = StructType([StructField("sources", ArrayType(kind)), StructField("stamps", ArrayType(LongType())), StructField("mark", LongType())])
    followed = dealt.groupBy("bucket").applyInPandasWithState(follow, out, held, "update", GroupStateTimeout.EventTimeTimeout)
    return followed.select(source, F.timestamp_micros("micros").alias("latest"), "silent")


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write closed rows to a parquet folder, all data available now."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def latest_to(stream: DataFrame, path: str, checkpoint: str, key: str, whole_every: int = 20) -> StreamingQuery:
    """Keep the newest state per key of an update-mode stream in a small parquet table.

    Each batch writes the changed keys under its own number; `read_latest` takes the highest per key. Every
    `whole_every`-th batch writes the state of all keys, and what lies before the last such batch but one is deleted,
    so there are never more than twice as many folders, a replay finds what it needs, and a reader keeps its files
    for a whole period.
    """
    spark = stream.sparkSession

    def keep(batch: DataFrame, batch_id: int) -> None:
        state = batch
        whole = batch_id > 0 and batch_id % whole_every == 0
        if whole:
            earlier = [f"{path}/{name}" for name in child_names(spark, path) if int(name.partition("=")[2]) < batch_id]
            stored = spark.read.option("basePath", path).parquet(*earlier)
            state = _latest(stored.unionByName(batch.withColumn("batch", F.lit(batch_id).cast(stored.schema["batch"].dataType))), key)
        state.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if whole:
            for name in child_names(spark, path):
                if int(name.partition("=")[2]) < batch_id - whole_every:
                    delete_path(spark, f"{path}/{name}")

    return (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def read_latest(spark: SparkSession, path: str, key: str) -> DataFrame:
    return _latest(spark.read.parquet(path), key)


def _latest(rows: DataFrame, key: str) -> DataFrame:
    state = [c for c in rows.columns if c not in (key, "batch")]
    return rows.groupBy(key).agg(*[F.max_by(c, "batch").alias(c) for c in state])
