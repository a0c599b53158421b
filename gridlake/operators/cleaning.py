"""Projections, filters and predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalar import as_column, nan_to_null, to_number


def rename_project(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Keep only the listed columns, under their new names."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def keep_status(df: DataFrame, col: str, value: str) -> DataFrame:
    return df.filter(F.col(col) == value)


def drop_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows that miss a required field."""
    return df.dropna(subset=cols)


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def quality_gate(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule, and a one-pass count of rows that fail each rule.

    A rule that is NULL for a row (missing value) counts as failed.
    """
    passed = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    good = df.filter(reduce(lambda a, b: a & b, rules.values()))
    counts = df.agg(*[F.count_if(~ok).alias(name) for name, ok in passed.items()])
    return good, counts.unpivot([], list(rules), "rule", "rejected")


def valid_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows where both measures are present and neither is NaN."""
    return df.filter(nan_to_null(x).isNotNull() & nan_to_null(y).isNotNull())


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Turn the listed columns into doubles; bad text and NaN become NULL, absent columns are skipped."""
    return df.withColumns({c: to_number(c) for c in cols if c in df.columns})


def min_group_size(df: DataFrame, key: list[str], n: int = 2) -> DataFrame:
    """Rows of groups that have at least `n` rows.

    The keys of large enough groups come from a count with map-side combine; the rows themselves meet
    them in a semi join, which AQE splits when one key is hot.
    """
    sizes = df.groupBy(*key).agg(F.count("*").alias("_n")).filter(F.col("_n") >= n)
    keys = sizes.select(*[F.col(k).alias(f"_key_{k}") for k in key])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in key])
    return df.join(keys, same, "left_semi")


def fallback(df: DataFrame, col: str, value: Column | str) -> DataFrame:
    """Replace a missing value; `value` is given by the caller, so a re-run yields the same rows."""
    return df.withColumn(col, F.coalesce(F.col(col), as_column(value)))
