"""Means over exact decimals, as NUMERIC columns give them.

Doubles are added in the order in which the shuffle brings them, so the last digit of a sum may change between runs.
Sums of decimals are exact, whatever the order, and a mean is rounded once, from its integer quotient and remainder.
NaN, infinite values, text that is no number and numbers too large for the column count as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from gridlake.functions.scalar import as_column, truncate
from gridlake.operators.ranking import top_k_of_means

SCALE = 6  # digits after the point of a stored measure
STORED = DecimalType(18, SCALE)
MEAN_DIGITS = 12  # digits kept of a mean that is added to others before it is rounded


def numeric(c: Column | str) -> Column:
    """The measure as an exact decimal; half away from zero where it has more digits."""
    return as_column(c).try_cast(STORED)


def with_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of `schema`, its decimals read exactly from doubles or text (see `Fact.decimal_schema`)."""
    return df.select(
        *[(numeric(f"`{f.name}`") if f.dataType == STORED else F.col(f"`{f.name}`").cast(f.dataType)).alias(f.name) for f in schema]
    )


def total(c: Column | str) -> Column:
    """Aggregate: exact sum, decimal(38, 6); it holds 10 ** 20 rows of the largest value."""
    return F.sum(numeric(c).cast(DecimalType(28, SCALE)))


def exact_quotient(whole: Column, n: Column, digits: int) -> Column:
    """whole / n (n a count), half away from zero at `digits` (12 at most); NULL without rows."""
    count = F.when(n > 0, n).cast(DecimalType(18, 0))
    rest = F.abs(whole % count).cast(DecimalType(24, SCALE))
    units = F.call_function("div", rest * F.lit(2 * 10**digits).cast(DecimalType(14, 0)) + count, count * 2)
    part = units.cast(DecimalType(14, 0)) * F.lit(f"1e-{digits}").cast(DecimalType(digits + 1, digits))
    signed = F.when(whole < 0, -part).otherwise(part)
    return (F.call_function("div", whole, count).cast(DecimalType(20, 0)) + signed).cast(DecimalType(20 + digits, digits))


def exact_mean(c: Column | str, digits: int) -> Column:
    """Aggregate: mean of the decimals, half away from zero at `digits`."""
    return exact_quotient(total(c), F.count(numeric(c)), digits)


def mean_over_groups(df: DataFrame, ts: str, vals: dict[str, str], digits: int = 2, unit: str | None = None) -> DataFrame:
    """Exact mean of each measure over all rows of a stamp; `vals` maps measure to output name."""
    stamp = truncate(df, ts, unit) if unit else F.col(ts)
    return df.groupBy(stamp.alias(ts)).agg(*[exact_mean(c, digits).alias(out) for c, out in vals.items()])


def monthly_stats(df: DataFrame, ts: str, val: str, digits: int = 0, tz: str | None = None) -> DataFrame:
    """Exact mean, peak and low per calendar month."""
    value = numeric(val)
    return df.groupBy(truncate(df, ts, "month", tz).alias("month")).agg(
        exact_mean(val, digits).alias("mean"), F.round(F.max(value), digits).alias("peak"), F.round(F.min(value), digits).alias("low")
    )


def mean_mix(df: DataFrame, digits: dict[str, int], suffix: str = "_mean") -> DataFrame:
    """One row of exact column means, each rounded to its own digits."""
    return df.agg(*[exact_mean(c, n).alias(c + suffix) for c, n in digits.items()])


def top_k_with_rest(
    df: DataFrame, key: str, val: str, k: int = 3, rest_label: str = "Autres régions", nulls_first: bool = True, digits: int = 0
) -> DataFrame:
    """The k groups with the best exact mean, ties kept, and the sum of all other means under `rest_label`.

    A mean has 12 digits while groups are ranked and added, and is rounded once at the end, so groups of equal mean tie.
    """
    means = df.groupBy(key).agg(exact_mean(val, MEAN_DIGITS).alias("mean"))
    kept = top_k_of_means(means, key, k, rest_label, digits=MEAN_DIGITS, nulls_first=nulls_first)
    return kept.select(key, F.round("mean", digits).alias("mean"))
