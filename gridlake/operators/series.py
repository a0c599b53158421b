"""Regular time series: resampling with empty slots kept, and where the gaps are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.scalar import nan_to_null, truncate

# Slot widths that divide a day, in seconds.
DAY_SECONDS = 86_400


def floor_every(df: DataFrame, ts: str, every_seconds: int) -> Column:
    """Start of the slot that holds the stamp, in the type of the column."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    width = every_seconds * 1_000_000
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(width))).cast(df.schema[ts].dataType)


def slots(bounds: DataFrame, first: str, last: str, every_seconds: int, ts: str, keys: list[str]) -> DataFrame:
    """Every slot from `first` to `last` per row of `bounds`.

    Days are exploded and dealt to tasks before the slots of a day, so no array grows with the length of the series, and
    one long series is made by many tasks.
    """
    kind = bounds.schema[first].dataType
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(every_seconds))
    day = F.make_dt_interval(F.lit(1))
    days = bounds.filter(F.col(first).isNotNull()).select(
        *keys,
        F.col(first).cast("timestamp").alias("_first"),
        F.col(last).cast("timestamp").alias("_last"),
        F.explode(F.sequence(F.date_trunc("day", first), F.date_trunc("day", last), day)).alias("_day"),
    )
    return (
        days.repartition(*keys, "_day").select(*keys, "_first", "_last", F.explode(F.sequence("_day", F.col("_day") + day - step, step)).alias("_slot"))
        .filter((F.col("_slot") >= F.col("_first")) & (F.col("_slot") <= F.col("_last")))
        .select(*keys, F.col("_slot").cast(kind).alias(ts))
    )


def resample(df: DataFrame, ts: str, val: str, every_seconds: int = 3600, keys: list[str] | None = None) -> DataFrame:
    """Mean per slot; slots without rows between the first and the last appear with NULL.

    The rows are reduced to one per slot first. The spine of slots and the joins work on that table only.
    An empty input yields no slots.
    """
    if DAY_SECONDS % every_seconds:
        raise ValueError("the slot width must divide a day")
    keys = keys or []
    means = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*keys, floor_every(df, ts, every_seconds).alias(ts))
        .agg(F.avg(nan_to_null(val)).alias(val))
    )
    bounds = means.groupBy(*keys).agg(F.min(ts).alias("_from"), F.max(ts).alias("_to"))
    return slots(bounds, "_from", "_to", every_seconds, ts, keys).join(means, [*keys, ts], "left")


def gap_ranges(df: DataFrame, ts: str, val: str, every_seconds: int = 3600, keys: list[str] | None = None) -> DataFrame:
    """Runs of consecutive missing slots: first and last slot, and length.

    Runs are built per month first. Only those that touch a month's end, two a month at most, can go on in another
    month and are joined there; all others are complete.
    """
    keys = keys or []
    kind = df.schema[ts].dataType
    missing = df.filter(F.col(val).isNull()).select(
        *keys, truncate(df, ts, "month").alias("_month"),
        F.unix_seconds(F.col(ts).cast("timestamp")).alias("_start"),
    ).withColumn("_end", F.col("_start"))
    monthly = _runs(missing, [*keys, "_month"], every_seconds)
    opens = F.unix_seconds(F.col("_month").cast("timestamp"))
    closes = F.unix_seconds((F.col("_month") + F.expr("INTERVAL 1 MONTH")).cast("timestamp"))
    at_edge = (F.col("_start") - every_seconds < opens) | (F.col("_end") + every_seconds >= closes)
    runs = _runs(monthly.filter(at_edge), keys, every_seconds).unionByName(
        monthly.filter(~at_edge).select(*keys, "_start", "_end")
    )
    return runs.select(
        *keys,
        F.timestamp_seconds("_start").cast(kind).alias("gap_start"),
        F.timestamp_seconds("_end").cast(kind).alias("gap_end"),
        ((F.col("_end") - F.col("_start")) / every_seconds + 1).cast("long").alias("slots"),
    )


def _runs(pieces: DataFrame, by: list[str], every_seconds: int) -> DataFrame:
    """Merge pieces [_start, _end] that follow each other by one slot."""
    w = Window.partitionBy(*by).orderBy("_start")
    breaks = F.when(F.col("_start") - F.lag("_end").over(w) == every_seconds, 0).otherwise(1)
    return (
        pieces.withColumn("_break", breaks)
        .withColumn("_run", F.sum("_break").over(w))
        .groupBy(*by, "_run")
        .agg(F.min("_start").alias("_start"), F.max("_end").alias("_end"))
        .drop("_run")
    )
