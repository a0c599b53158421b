"""Incremental windows, local day bounds, chunk coverage and load reports."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlake.functions.scalar import local_time
from gridlake.sources.tables import settled

PARIS = "Europe/Paris"


def local_day_bounds(df: DataFrame, ts: str, tz: str = PARIS) -> DataFrame:
    """Add the local day of each instant and the instants at which that day begins and ends."""
    day = F.to_date(local_time(ts, tz))
    start = F.to_utc_timestamp(day.cast("timestamp"), tz)
    end = F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), tz)
    kind = df.schema[ts].dataType
    return df.withColumns({"local_day": day, "day_start": start.cast(kind), "day_end": end.cast(kind)})


def recent_window(
    df: DataFrame, ts: str, days: int, anchor: str = "latest", as_of: Column | None = None, tz: str = PARIS
) -> DataFrame:
    """Rows of the last `days` days.

    anchor "latest": days up to the newest date in the data, that date included.
    anchor "yesterday": whole local days of `tz` that end with the day before `as_of`.
    anchor "now": the `days` x 24 hours up to `as_of`.
    anchor "cutoff": dates not before the date of `as_of` minus `days`, without an upper end.
    """
    kind = df.schema[ts].dataType
    col = F.col(ts)
    if anchor == "latest":
        newest = df.agg(F.to_date(F.max(ts)).alias("d"))
        last = newest.select("d").scalar()
        start, end = F.date_add(last, 1 - days), F.date_add(last, 1)
        return df.filter((col >= start.cast(kind)) & (col < end.cast(kind)))
    if as_of is None:
        raise ValueError("this anchor needs as_of")
    if anchor == "yesterday":
        today = F.to_date(local_time(as_of, tz))
        start = F.to_utc_timestamp(F.date_sub(today, days).cast("timestamp"), tz)
        end = F.to_utc_timestamp(today.cast("timestamp"), tz)
        return df.filter((col >= start.cast(kind)) & (col < end.cast(kind)))
    if anchor == "now":
        now = as_of.cast("timestamp")
        start = now - F.make_dt_interval(F.lit(days))
        return df.filter((col >= start.cast(kind)) & (col <= now.cast(kind)))
    if anchor == "cutoff":
        return df.filter(col >= F.date_sub(F.to_date(as_of), days).cast(kind))
    raise ValueError(f"unknown anchor {anchor!r}")


def recent(df: DataFrame, date_col: str, as_of: Column, days: int = 30) -> DataFrame:
    """Rows dated on or after `as_of` minus `days`."""
    return recent_window(df, date_col, days, "cutoff", as_of)


def _month_number(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def chunk_table(spark: SparkSession, start: date, end: date, rule: int | str, drop_short: bool = False) -> DataFrame:
    """Chunks that cover the days start..end: `rule` is a number of days, or "month".

    Chunks are half-open [chunk_start, chunk_end), so the last day of a month is whole. `drop_short`
    leaves out a last chunk of fewer days than asked for.
    """
    one = spark.range(1).select(F.lit(start).cast("date").alias("s"), F.lit(end).cast("date").alias("e"))
    if rule == "month":
        firsts = F.sequence(F.trunc("s", "month"), F.col("e"), F.make_ym_interval(F.lit(0), F.lit(1)))
        raw = one.select("s", "e", F.posexplode(firsts).alias("chunk", "_first"))
        begin = F.greatest("_first", "s")
        until = F.least(F.date_add(F.last_day("_first"), 1), F.date_add("e", 1))
        full = F.datediff(F.date_add(F.last_day("_first"), 1), "_first")
    else:
        firsts = F.sequence(F.col("s"), F.col("e"), F.make_dt_interval(F.lit(rule)))
        raw = one.select("s", "e", F.posexplode(firsts).alias("chunk", "_first"))
        begin = F.col("_first")
        until = F.least(F.date_add("_first", rule), F.date_add("e", 1))
        full = F.lit(rule)
    chunks = raw.select(
        "chunk", begin.alias("chunk_start"), until.alias("chunk_end"), full.alias("_full")
    ).withColumn("days", F.datediff("chunk_end", "chunk_start"))
    if drop_short:
        chunks = chunks.filter(F.col("days") >= F.col("_full"))
    return chunks.drop("_full")


def chunk_index(ts: Column, start: date, rule: int | str) -> Column:
    """Number of the chunk an instant falls in, by arithmetic: an equi-join replaces a range join."""
    first = F.lit(start).cast("date")
    if rule == "month":
        return _month_number(F.to_date(ts)) - _month_number(first)
    return F.floor(F.datediff(F.to_date(ts), first) / rule).cast("int")


def chunk_coverage(
    df: DataFrame,
    ts: str,
    start: date,
    end: date,
    rule: int | str,
    expected_per_day: int,
    drop_short: bool = False,
) -> DataFrame:
    """Rows landed per chunk against the rows expected, chunks without rows included."""
    upto = datetime.combine(end, datetime.min.time()) + timedelta(days=1)
    landed = (
        df.filter((F.col(ts) >= F.lit(start).cast("timestamp")) & (F.col(ts) < F.lit(upto)))
        .groupBy(chunk_index(F.col(ts), start, rule).alias("chunk"))
        .agg(F.count("*").alias("_rows"))
    )
    chunks = chunk_table(df.sparkSession, start, end, rule, drop_short)
    rows = F.coalesce("_rows", F.lit(0).cast("long"))
    expected = (F.col("days") * expected_per_day).cast("long")
    return chunks.join(landed, "chunk", "left").select(
        "chunk", "chunk_start", "chunk_end", rows.alias("rows"), expected.alias("expected"),
        (rows >= expected).alias("complete"),
    )


def failed_chunks(chunks: DataFrame, landed: DataFrame, key: str = "chunk") -> DataFrame:
    """Chunks for which nothing landed."""
    return chunks.join(landed.select(key).distinct(), key, "left_anti")


def load_report(df: DataFrame, ts: str, start: date, end: date, rule: int | str) -> DataFrame:
    """Per chunk: rows, first and last stamp returned against those asked for, and the running total.

    Rows outside the asked range (or without a stamp) are one more row without a chunk, if there are any.
    """
    outside = F.col(ts).isNull() | (F.col(ts) < F.lit(start)) | (F.col(ts) >= F.date_add(F.lit(end), 1))
    counted = settled(
        df.groupBy(F.when(~outside, chunk_index(F.col(ts), start, rule)).alias("chunk"))
        .agg(F.count("*").alias("_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")),
        "chunk-rows",  # one row per chunk and one for strays: the table is read once
    )
    strays = counted.filter("chunk IS NULL").select(F.col("_rows").alias("rows"), "first_ts", "last_ts")
    found = counted.filter("chunk IS NOT NULL")
    so_far = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)  # one row per chunk
    asked = (
        chunk_table(df.sparkSession, start, end, rule)
        .join(found, "chunk", "left")
        .withColumn("rows", F.coalesce("_rows", F.lit(0).cast("long")))
        .select(
            "chunk", "chunk_start", "chunk_end", "rows", "first_ts", "last_ts",
            F.sum("rows").over(so_far).alias("running_rows"),
        )
    )
    return asked.unionByName(strays, allowMissingColumns=True)


def asked_slots(asked: DataFrame, request: str, start: str, end: str, slot_seconds: int) -> DataFrame:
    """Every slot that the half-open range of a request touches: (request, _slot)."""
    first, last = (F.unix_micros(F.col(c).cast("timestamp")) for c in (start, end))
    width = slot_seconds * 1_000_000
    days = asked.filter(F.col(start) < F.col(end)).select(
        request, F.explode(F.sequence(F.floor(first / width), F.floor((last - 1) / width))).alias("_slot")
    )
    return days.distinct()


def load_report_requests(
    rows: DataFrame, ts: str, request: str, asked: DataFrame, start: str = "asked_from", end: str = "asked_to",
    slot_seconds: int = 86_400,
) -> DataFrame:
    """Per request of the ledger `asked` (its number and half-open range): what came back against what was asked for.

    `rows` carry the number of the request that brought them. `strays` lie outside their own request's range (or have
    no stamp); `elsewhere` counts those that lie in another request's, and `elsewhere_of` is the least such number, so a
    stray is seen even where the ranges together leave no gap. `holes` are slots asked for and not returned by the
    request, `shared` those that other requests ask for as well. A number that is not in the ledger is reported
    without a range, its rows as strays; a request without rows has `first_ts` NULL.

    The rows are read once and reduced to one row per request and slot (or stray stamp); all else works on that.
    """
    range_of = asked.select(request, start, end)
    inside = F.coalesce((F.col(ts) >= F.col(start)) & (F.col(ts) < F.col(end)), F.lit(False))
    slot = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (slot_seconds * 1_000_000))
    found = settled(
        rows.select(request, ts).join(range_of, request, "left")
        .groupBy(request, inside.alias("_inside"), slot.alias("_slot"), F.when(~inside, F.col(ts)).alias("_stray"))
        .agg(F.count("*").alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_last")),
        "returned",
    )
    returned = found.groupBy(request).agg(
        F.sum("_n").alias("rows"), F.min("_first").alias("first_ts"), F.max("_last").alias("last_ts"),
        F.sum(F.when(F.col("_inside"), 0).otherwise(F.col("_n"))).alias("strays"),
    )
    cells = settled(asked_slots(asked, request, start, end, slot_seconds), "asked")
    others = cells.join(range_of, request).withColumnsRenamed({request: "_other"})
    elsewhere = (
        found.filter(~F.col("_inside")).join(others, "_slot")
        .filter((F.col("_stray") >= F.col(start)) & (F.col("_stray") < F.col(end)) & ~F.col(request).eqNullSafe(F.col("_other")))
        .groupBy(request, "_stray").agg(F.first("_n").alias("_n"), F.min("_other").alias("_other"))
        .groupBy(request).agg(F.sum("_n").alias("elsewhere"), F.min("_other").alias("elsewhere_of"))
    )
    holes = (
        cells.join(found.filter("_inside").select(request, "_slot"), [request, "_slot"], "left_anti")
        .groupBy(request).agg(F.count("*").alias("holes"), F.min("_slot").alias("_hole"))
    )
    often = cells.groupBy("_slot").agg(F.count("*").alias("_askers")).filter("_askers > 1")
    shared = cells.join(often, "_slot").groupBy(request).agg(F.count("*").alias("shared"))
    report = range_of.join(returned, request, "full_outer")
    for part in (elsewhere, holes, shared):
        named = part.withColumnRenamed(request, "_request")
        report = report.join(named, F.col(request).eqNullSafe(F.col("_request")), "left").drop("_request")
    zero = F.lit(0).cast("long")
    count = lambda c: F.coalesce(c, zero).alias(c)
    first_hole = F.timestamp_micros(F.col("_hole") * slot_seconds * 1_000_000).cast(rows.schema[ts].dataType)
    return report.select(
        request, start, end, count("rows"), "first_ts", "last_ts", count("strays"), count("elsewhere"), "elsewhere_of",
        count("holes"), first_hole.alias("first_hole"), count("shared"),
    )
