"""Data quality: missing values, duplicates, gaps, step audits, and set operations on rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from gridlake.functions.scalar import nan_to_null, round_to, truncate


def missing_rates(df: DataFrame, cols: list[str] | None = None, digits: int = 2) -> DataFrame:
    """Missing (NULL or NaN) count and percentage per column, all columns in one pass."""
    cols = cols or df.columns
    floats = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    present = {c: nan_to_null(c) if c in floats else F.col(c) for c in cols}
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(present[c].isNull()).alias(c) for c in cols])
    return counts.unpivot("_rows", cols, "column", "missing").select(
        "column", "missing", round_to(F.try_divide(100 * F.col("missing"), F.col("_rows")), digits).alias("missing_pct")
    )


def gap_profile(df: DataFrame, ts: str, val: str) -> DataFrame:
    """First and last stamp without a value, and how many there are."""
    return df.filter(F.col(val).isNull()).agg(
        F.min(ts).alias("first_missing"), F.max(ts).alias("last_missing"), F.count("*").alias("missing")
    )


def gaps_per_month(df: DataFrame, ts: str, val: str) -> DataFrame:
    return (
        df.filter(F.col(val).isNull())
        .groupBy(truncate(df, ts, "month").alias("month"))
        .agg(F.count("*").alias("missing"))
    )


def missing_indicator(df: DataFrame, ts: str, val: str, keep: list[str] | None = None) -> DataFrame:
    return df.select(ts, *(keep or []), F.col(val).isNull().cast("int").alias("missing"))


def dup_count(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    return df.groupBy(*key).agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates")
    )


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1).select(*key)


def duplicated_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """All rows of keys that occur more than once.

    Counting keys combines map-side; the semi join lets AQE split a hot key, where a count over a window
    would bring all its rows into one task.
    """
    repeated = repeated_keys(df, key).select(*[F.col(k).alias(f"_dup_{k}") for k in key])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_dup_{k}")) for k in key])
    return df.join(repeated, same, "left_semi")


def dedupe_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """First row per key in the given order (Spark prunes to one row per key and task before the shuffle)."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(w)).filter(F.col("_row") == 1).drop("_row")


def distinct_dim(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def intersect_values(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def stack(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def step_audit(steps: list[tuple[str, DataFrame]]) -> DataFrame:
    """Row and column counts of each step of a chain, with the rows lost since the step before."""
    rows = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(i).alias("step"), F.lit(name).alias("name"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for i, (name, df) in enumerate(steps)
    ]
    previous = F.lag("rows").over(Window.orderBy("step"))  # one row per step
    return reduce(DataFrame.unionByName, rows).withColumn("lost", F.coalesce(previous - F.col("rows"), F.lit(0)))
