"""Registry of queries and helpers they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, TimestampType

from gridlake.functions.scalar import round_to
from gridlake.sources.tables import read_table


class Tables:
    """The given tables of one folder, read lazily by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        self.__dict__[name] = read_table(self.spark, self.path(name))
        return self.__dict__[name]


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def expand_half_up(sql: str) -> str:
    """Write out `half_up(x, d)`: half away from zero on the decimal value, NaN as NULL, as `round_to` does."""
    mark = "half_up("
    while mark in sql:
        start = sql.rindex(mark)  # innermost or last first
        depth, end = 1, start + len(mark)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        expr, _, digits = sql[start + len(mark) : end - 1].rpartition(",")
        wide = int(digits) + 6
        value = f"nullif(CAST({expr} AS DOUBLE), 'NaN'::DOUBLE)"
        sql = f"{sql[:start]}CAST(round(CAST({value} AS DECIMAL(38, {wide})), {int(digits)}) AS DOUBLE){sql[end:]}"
    return sql


def query(sql: str | None = None):
    """Register a function of the tables under its own name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[build.__name__] = Query(build.__name__, build, sql and expand_half_up(sql))
        return build

    return register


def presented(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded and instants as zone-less stamps, so engines can be compared."""
    cols = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DoubleType):
            c = round_to(c, digits)
        elif isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, DoubleType):
            c = F.transform(c, lambda v: round_to(v, digits))
        elif isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)
