"""Joins. Strategies are left to Catalyst and AQE: a side is broadcast only when Spark has measured it
below `spark.sql.autoBroadcastJoinThreshold`, and skewed shuffle partitions are split at run time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalar import truncate

# Rows below which a table with a known row bound is broadcast without waiting for run-time sizes.
BROADCAST_ROWS = 100_000


def attach(df: DataFrame, stats: DataFrame, by=(), max_rows: int | None = None, how: str = "inner") -> DataFrame:
    """Put per-group statistics next to each row; without `by`, the one row of `stats` (scalar subquery).

    `max_rows` is a bound on the rows of `stats` that follows from its key (24 hours, 12 months, a list
    of column names). Only such a bound leads to a broadcast hint. NULL keys match NULL keys.
    """
    if not by:
        row = stats.select(F.struct(*stats.columns)).scalar()
        return df.select("*", *[row[c].alias(c) for c in stats.columns])
    renamed = stats.select(
        *[F.col(k).alias(f"_by_{k}") for k in by], *[c for c in stats.columns if c not in by]
    )
    if max_rows is not None and max_rows <= BROADCAST_ROWS:
        renamed = F.broadcast(renamed)
    matches = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_by_{k}")) for k in by])
    return df.join(renamed, matches, how).drop(*[f"_by_{k}" for k in by])


def left_join_all(base: DataFrame, sources: list[DataFrame], on: list[str] | str) -> DataFrame:
    """Left equi-join of several sources to `base` on the exact same key columns."""
    return reduce(lambda left, right: left.join(right, on, "left"), sources, base)


def left_join_grain(base: DataFrame, source: DataFrame, ts: str, grain: str, tz: str | None = None) -> DataFrame:
    """Left join of a coarser source (its stamps are starts of `grain`) to a finer base."""
    right = source.withColumnRenamed(ts, "_grain_ts")
    return (
        base.withColumn("_grain_key", truncate(base, ts, grain, tz))
        .join(right, F.col("_grain_key") == F.col("_grain_ts"), "left")
        .drop("_grain_key", "_grain_ts")
    )


def join_dim(
    fact: DataFrame, dim: DataFrame, code: str, status: str | None = None, value: str | None = None
) -> DataFrame:
    """Inner join of a dimension on its code, with an optional status filter pushed to the fact scan.

    A code that has several names fans out, as in SQL; follow with `dedupe_first` where one row is wanted.
    """
    kept = fact.filter(F.col(status) == value) if status else fact
    return kept.join(dim, code, "inner")


def merge_resampled(base: DataFrame, sources: list[DataFrame], on: str) -> DataFrame:
    """Left merge of series already brought to the same grain."""
    return left_join_all(base, sources, on)


def join_on_measure(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Rows of `a` and `b` that share a measure value, as counts per value.

    Each side is counted first, so a value common on both sides costs one row instead of n x m pairs.
    """
    left = a.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n_left"))
    right = b.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n_right"))
    return left.join(right, col).withColumn("pairs", F.col("n_left") * F.col("n_right"))


def new_only(batch: DataFrame, seen: DataFrame, key: list[str] | str) -> DataFrame:
    """Rows of the batch whose key has not been seen."""
    return batch.join(seen, key, "left_anti")
