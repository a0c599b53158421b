"""Reading and writing tables, and named derived layers."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from gridlake.session import child_names, delete_path, move_path, path_status, work_dir

STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ZONED_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
VERSION = re.compile(r"v\d{9}")
EMPTY_MARK = "\u0001"  # how the reader reports a quoted empty field, which would else come back as NULL


def read_table(spark: SparkSession, path: str, cols: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*cols) if cols else df


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower, upper, partitions: int, **options: str
) -> DataFrame:
    """Partitioned read of a database table: one range of `column` per task (needs the driver's jar)."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column, lowerBound=str(lower), upperBound=str(upper))
        .options(numPartitions=str(partitions), **options)
        .load()
    )


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace a result table and read it back from storage.

    The new table is written whole beside the old one and then takes its place, so a job that fails leaves the old
    table as it was. A switch that was cut short is first undone by the next call.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    beside, old = f"{path}.next", f"{path}.old"
    if path_status(spark, path) is None and path_status(spark, old):
        move_path(spark, old, path)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)
    writer.parquet(beside)
    delete_path(spark, old)
    if path_status(spark, path):
        move_path(spark, path, old)
    move_path(spark, beside, path)
    delete_path(spark, old)
    return spark.read.schema(df.schema).parquet(path)


def _versions(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Names of all versions below a path, in order, and of those that are complete."""
    names = [n for n in child_names(spark, path) if VERSION.fullmatch(n)]
    return names, [n for n in names if path_status(spark, f"{path}/{n}/_SUCCESS")]


def publish_version(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace a result table that is never absent, and read it back (others: `read_version`).

    Every call writes a folder of its own below `path`. It counts once the job's commit has put its success mark there, so a
    reader finds the old table or the new one, whole, and nothing is renamed; a job that fails leaves the old one. The
    version before is kept for readers that have begun with it, and `df` may read from it; older ones, and
    what failed jobs left, are deleted. One writer at a time.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    names, whole = _versions(spark, path)
    fresh = f"{path}/v{int(names[-1][1:]) + 1 if names else 1:09d}"
    writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(fresh)
    if path_status(spark, f"{fresh}/_SUCCESS") is None:
        raise OSError(f"no success mark in {fresh}: mapreduce.fileoutputcommitter.marksuccessfuljobs must be on")
    for name in names:
        if name not in whole[-1:]:
            delete_path(spark, f"{path}/{name}")
    return spark.read.schema(df.schema).parquet(fresh)


def read_version(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The newest complete version of a table that `publish_version` writes."""
    path = path.rstrip("/")
    whole = _versions(spark, path)[1]
    if not whole:
        raise FileNotFoundError(f"nothing is published at {path}")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{path}/{whole[-1]}")


def publish_table(df: DataFrame, name: str) -> DataFrame:
    """Replace a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write a small intermediate to the shared work folder and read it back.

    Cuts the lineage, and gives the optimiser the true size, by which it decides about a broadcast.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header. NULL is an empty field, an empty text is quoted; quotes are doubled."""
    df.write.mode("overwrite").options(
        header=True, escape='"', nullValue="", emptyValue='""',
        timestampFormat=ZONED_FORMAT, timestampNTZFormat=STAMP_FORMAT,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def read_csv(
    spark: SparkSession, path: str, schema: StructType, ts_format: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Typed read-back. `multi_line` is for text with line breaks: such files cannot be split."""
    rows = (
        spark.read.schema(schema)
        .options(
            header=True, escape='"', nullValue="", emptyValue=EMPTY_MARK, mode="FAILFAST", multiLine=multi_line,
            timestampFormat=ts_format or ZONED_FORMAT, timestampNTZFormat=ts_format or STAMP_FORMAT,
        )
        .csv(path)
    )
    texts = [f.name for f in schema if isinstance(f.dataType, StringType)]
    return rows.withColumns({c: F.when(F.col(c) == EMPTY_MARK, "").otherwise(F.col(c)) for c in texts})


class Layer(Mapping):
    """Named tables derived from others, built when first asked for.

    A definition sees the layer's inputs and its other tables, so asking for one table plans only what it
    depends on.
    """

    def __init__(self, inputs: Mapping[str, DataFrame], defs: Mapping[str, Callable]):
        self.inputs, self.defs, self.built = inputs, dict(defs), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.defs:
            return self.inputs[name]
        if name not in self.built:
            self.built[name] = self.defs[name](self)
        return self.built[name]

    def store(self, name: str) -> None:
        """Write a table that several others read, so that it is computed once."""
        self.built[name] = settled(self[name], name)

    def __iter__(self):
        return iter(self.defs)

    def __len__(self) -> int:
        return len(self.defs)


def register_layer(layer: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Make a layer's tables queryable by name; Catalyst inlines them wherever they are used."""
    for name, df in layer.items():
        df.createOrReplaceTempView(prefix + name)
