"""Grouped and whole-table aggregates. Each is one aggregation with map-side combine, so a group that
holds a large share of the rows is reduced before the shuffle. NaN counts as missing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalar import (
    SUMMER_MONTHS,
    WINTER_MONTHS,
    local_time,
    nan_to_null,
    pearson,
    round_to,
    season,
    truncate,
)


def mean_over_groups(
    df: DataFrame, ts: str, vals: dict[str, str], digits: int | None = 2, unit: str | None = None
) -> DataFrame:
    """Mean of each measure over all rows (regions) of a stamp; `vals` maps measure to output name."""
    stamp = truncate(df, ts, unit) if unit else F.col(ts)
    means = {out: F.avg(nan_to_null(col)) for col, out in vals.items()}
    return df.groupBy(stamp.alias(ts)).agg(
        *[(round_to(m, digits) if digits is not None else m).alias(out) for out, m in means.items()]
    )


def monthly_stats(df: DataFrame, ts: str, val: str, digits: int = 0, tz: str | None = None) -> DataFrame:
    """Mean, peak and low per calendar month; NaN counts as missing."""
    val = nan_to_null(val)
    return df.groupBy(truncate(df, ts, "month", tz).alias("month")).agg(
        round_to(F.avg(val), digits).alias("mean"),
        round_to(F.max(val), digits).alias("peak"),
        round_to(F.min(val), digits).alias("low"),
    )


def mean_by(
    df: DataFrame, key: str, val: str, order: str | None = "desc", digits: int | None = None
) -> DataFrame:
    """Mean per key, sorted by the mean ("asc", "desc" or None), key as tie-break."""
    mean = F.avg(nan_to_null(val)) if digits is None else round_to(F.avg(nan_to_null(val)), digits)
    out = df.groupBy(key).agg(mean.alias("mean"))
    if order is None:
        return out
    return out.orderBy(F.desc("mean") if order == "desc" else F.asc("mean"), F.asc(key))


def pair_corrs(df: DataFrame, pairs: list[tuple[str, str, str]], digits: int = 3) -> DataFrame:
    """Several Pearson r in one row and one pass, each over its own complete pairs."""
    return df.agg(*[F.round(pearson(x, y), digits).alias(name) for x, y, name in pairs])


def seasonal_corrs(
    df: DataFrame,
    ts: str,
    pairs: list[tuple[str, str, str]],
    digits: int = 3,
    other: str = "mi_saison",
    tz: str | None = None,
    min_rows: int = 2,
) -> DataFrame:
    """Pearson r per season with the row count of the season, in one grouped aggregation."""
    return (
        df.withColumn("saison", season(ts, other, tz))
        .filter(F.col("saison").isNotNull())
        .groupBy("saison")
        .agg(
            F.count("*").alias("nb_lignes"),
            *[F.round(pearson(x, y), digits).alias(name) for x, y, name in pairs],
        )
        .filter(F.col("nb_lignes") >= min_rows)
    )


def mean_mix(df: DataFrame, digits: dict[str, int], suffix: str = "_mean") -> DataFrame:
    """One row of column means, each rounded to its own digits."""
    return df.agg(*[round_to(F.avg(nan_to_null(c)), n).alias(c + suffix) for c, n in digits.items()])


def profile(df: DataFrame, ts: str, val: str, part: str, tz: str | None = None) -> DataFrame:
    """Mean per calendar part ("hour" of day, "month" across years, ...)."""
    slot = F.date_part(F.lit(part), local_time(ts, tz)).cast("int")
    value = nan_to_null(val)
    return df.groupBy(slot.alias(part)).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def kpis(df: DataFrame, val: str) -> DataFrame:
    value = nan_to_null(val)
    return df.agg(F.min(value).alias("min"), F.avg(value).alias("mean"), F.max(value).alias("max"))


def season_table(
    df: DataFrame, ts: str, val: str, seasons: tuple[str, ...] = ("hiver", "ete"), digits: int = 0, tz: str | None = None
) -> DataFrame:
    """Sample size and rounded mean of the measure for the named seasons."""
    return (
        df.select(season(ts, "intersaison", tz).alias("season"), nan_to_null(val).alias("_v"))
        .filter(F.col("season").isin(*seasons) & F.col("_v").isNotNull())
        .groupBy("season")
        .agg(F.count("*").alias("n"), round_to(F.avg("_v"), digits).alias("mean"))
    )


def period(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))


def latest(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.max(ts).alias("latest"))


def freshness(sources: list[tuple[str, DataFrame, str]], as_of: Column, digits: int = 2) -> DataFrame:
    """Hours from the latest stamp of each source to `as_of`; -1 when the source is empty.

    A date counts as midnight UTC. Stamps in the future give a negative lag, so `empty` tells the two apart.
    """
    maxima = [
        df.agg(F.max(F.col(ts).cast("timestamp")).alias("_last")).select(F.lit(name).alias("source"), "_last")
        for name, df, ts in sources
    ]
    return _lags(reduce(DataFrame.unionByName, maxima), as_of, digits)


def freshness_by(df: DataFrame, source: str, ts: str, names: list[str], as_of: Column, digits: int = 2) -> DataFrame:
    """The same for the named sources of one table, told apart by a column: the table is read once for all."""
    latest = df.groupBy(F.col(source).alias("source")).agg(F.max(F.col(ts).cast("timestamp")).alias("_last"))
    listed = df.sparkSession.createDataFrame([(n,) for n in names], "source string")
    return _lags(listed.join(latest, "source", "left"), as_of, digits)


def _lags(latest: DataFrame, as_of: Column, digits: int) -> DataFrame:
    hours = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros("_last")) / F.lit(3_600_000_000)
    return latest.select(
        "source",
        F.coalesce(F.round(hours, digits), F.lit(-1.0)).alias("lag_hours"),
        F.col("_last").isNull().alias("empty"),
    )


def last_failure(events: DataFrame, keys: list[str], ts: str, failed: Column) -> DataFrame:
    """Latest failure per task."""
    return events.filter(failed).groupBy(*keys).agg(F.max(ts).alias("last_failure"))


def season_coverage(df: DataFrame, ts: str, tz: str | None = None) -> DataFrame:
    """Months present, those of each season, and whether a winter/summer comparison is possible."""
    months = F.array_sort(F.collect_set(F.month(local_time(ts, tz))))

    def of_season(fixed: list[int]) -> Column:
        return F.array_intersect("months", F.array(*[F.lit(m) for m in fixed]))

    return df.agg(months.alias("months")).select(
        "months",
        F.array_sort(of_season(WINTER_MONTHS)).alias("winter_months"),
        F.array_sort(of_season(SUMMER_MONTHS)).alias("summer_months"),
        ((F.size(of_season(WINTER_MONTHS)) > 0) & (F.size(of_season(SUMMER_MONTHS)) > 0)).alias("comparable"),
    )


def count_points(df: DataFrame, blocks: str, values: str) -> DataFrame:
    """Total points over the nested blocks of all payloads, without exploding them."""
    sizes = F.transform(blocks, lambda b: F.coalesce(F.size(b[values]), F.lit(0)))
    per_row = F.aggregate(sizes, F.lit(0).cast("long"), lambda total, n: total + n.cast("long"))
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("points"))
