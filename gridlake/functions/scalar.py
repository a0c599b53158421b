"""Column expressions shared by the operators. All run inside Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Months of the two named seasons.
WINTER_MONTHS = [12, 1, 2]
SUMMER_MONTHS = [6, 7, 8]


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_time(ts: Column | str, tz: str | None) -> Column:
    """Wall-clock time of an instant held in UTC; unchanged when no zone is asked for."""
    ts = as_column(ts)
    return ts if tz in (None, "UTC") else F.from_utc_timestamp(ts.cast("timestamp"), tz)


def truncate(df: DataFrame, ts: str, unit: str, tz: str | None = None) -> Column:
    """`ts` cut down to `unit`, in the type the column has (`date_trunc` alone drops NTZ)."""
    return F.date_trunc(unit, local_time(ts, tz)).cast(df.schema[ts].dataType)


def season(ts: Column | str, other: str = "mi_saison", tz: str | None = None) -> Column:
    month = F.month(local_time(ts, tz))
    return (
        F.when(month.isin(WINTER_MONTHS), "hiver")
        .when(month.isin(SUMMER_MONTHS), "ete")
        .when(month.isNotNull(), other)
    )


def round_to(c: Column | str, digits: int) -> Column:
    """Half away from zero on the decimal value, as NUMERIC rounding does.

    The inner round removes binary noise (12.344999999999999 for 12.345) that depends on the order
    in which partial sums were merged.
    """
    return F.round(F.round(as_column(c), digits + 6), digits)


def to_number(c: Column | str) -> Column:
    """Double, with NULL for text that is no number and for NaN."""
    value = as_column(c).cast("string").try_cast("double")
    return F.when(~F.isnan(value), value)


def nan_to_null(c: Column | str) -> Column:
    c = as_column(c)
    return F.when(~F.isnan(c), c)


def iso_date(text: Column | str) -> Column:
    """Calendar date as written in an ISO stamp (its own offset is kept, not shifted to UTC)."""
    text = F.trim(as_column(text))
    return F.when(text.try_cast("timestamp").isNotNull(), F.substring(text, 1, 10).try_cast("date"))


def pearson(x: Column | str, y: Column | str) -> Column:
    """Aggregate: Pearson r over complete pairs, NaN counting as missing, within [-1, 1]; NULL for a constant
    column or fewer than two pairs.

    The `regr_*` sums skip incomplete pairs by themselves. `corr` raises under ANSI on a constant column.
    """
    x, y = nan_to_null(x), nan_to_null(y)
    spread = F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x))
    r = F.try_divide(F.regr_sxy(y, x), spread)
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def strip(c: Column | str, chars: str = " \t\r\n\f\v\u00a0") -> Column:
    return F.trim(as_column(c), F.lit(chars))


def unescape(c: Column | str) -> Column:
    """Decode HTML entities, in the JVM, by the text library that comes with Spark."""
    c = as_column(c)
    library = F.lit("org.apache.commons.text.StringEscapeUtils")
    decoded = F.reflect(library, F.lit("unescapeHtml4"), F.replace(c, F.lit("&apos;"), F.lit("'")))
    return F.when(c.isNotNull(), decoded)


def unnest(
    df: DataFrame, keep: list[str | Column], array: Column | str, position: str, item: str, also: Column | None = None
) -> DataFrame:
    """One row per array element with its position; rows with an empty or NULL array give none, unless `also` holds.

    An inner explode makes the optimiser test the array's size below it, which computes an expensive array
    (parsed JSON, pattern matches) twice. The outer form does not.
    """
    rows = df.select(*keep, F.posexplode_outer(as_column(array)).alias(position, item))
    there = F.col(position).isNotNull()
    return rows.filter(there if also is None else there | also)
