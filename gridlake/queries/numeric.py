"""Indicators over exact decimals. The SQL adds whole millionths and rounds by integer division."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators import exact
from gridlake.queries.aggregates import PLACED_SQL, placed
from gridlake.queries.registry import Tables, query


def units(expr: str) -> str:
    """Sum of a measure in millionths, as a whole number."""
    return f"CAST(sum(CAST(CAST({expr} AS DECIMAL(18, 6)) * 1000000 AS HUGEINT)) AS HUGEINT)"


def mean_sql(expr: str, digits: int) -> str:
    """Mean, half away from zero at `digits`, times 10 ** digits as a whole number (positive measures)."""
    return f"((2 * {units(expr)} * {10**digits} + 1000000 * count({expr})) // (2000000 * count({expr})))"


def as_double(df: DataFrame) -> DataFrame:
    """Decimals as the nearest doubles, so engines can be compared."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema])


def value_sql(expr: str, digits: int) -> str:
    return f"CAST({mean_sql(expr, digits)} AS DOUBLE) / {10**digits}"


@query(
    f"""SELECT date_trunc('month', o_orderdate) AS month, {value_sql('o_totalprice', 2)} AS mean, max(o_totalprice) AS peak,
    min(o_totalprice) AS low FROM orders GROUP BY 1"""
)
def monthly_numeric(t: Tables) -> DataFrame:
    stats = as_double(exact.monthly_stats(t.orders, "o_orderdate", "o_totalprice", 2))
    return stats.withColumn("month", F.col("month").cast("timestamp_ntz"))


@query(
    f"""SELECT {value_sql('l_quantity', 0)} AS l_quantity_mean, {value_sql('l_extendedprice', 6)} AS l_extendedprice_mean,
    {value_sql('l_discount', 3)} AS l_discount_mean FROM lineitem"""
)
def mix_numeric(t: Tables) -> DataFrame:
    return as_double(exact.mean_mix(t.lineitem, {"l_quantity": 0, "l_extendedprice": 6, "l_discount": 3}))


@query(
    f"""SELECT date_trunc('day', l_shipdate) AS l_shipdate, {value_sql('l_quantity', 4)} AS quantity, {value_sql('l_tax', 4)} AS tax
    FROM lineitem GROUP BY 1"""
)
def daily_numeric(t: Tables) -> DataFrame:
    return as_double(exact.mean_over_groups(t.lineitem, "l_shipdate", {"l_quantity": "quantity", "l_tax": "tax"}, 4, "day"))


@query(
    f"""WITH {PLACED_SQL}, m AS (SELECT region, {mean_sql('o_totalprice', 12)} AS mean FROM placed GROUP BY 1),
    r AS (SELECT region, mean, rank() OVER (ORDER BY mean DESC) AS place FROM m)
    SELECT CASE WHEN place <= 3 THEN region ELSE 'Autres régions' END AS region,
    CAST((2 * CAST(sum(mean) AS HUGEINT) + 1000000000000) // 2000000000000 AS DOUBLE) AS mean FROM r GROUP BY 1"""
)
def key_regions_numeric(t: Tables) -> DataFrame:
    return as_double(exact.top_k_with_rest(placed(t), "region", "o_totalprice"))
