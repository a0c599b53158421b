"""Constraints and keyed upserts."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.operators.joining import attach
from gridlake.operators.quality import repeated_keys
from gridlake.session import child_names, delete_path, path_status


def mark_constraints(df: DataFrame, not_null: list[str], key: list[str]) -> DataFrame:
    """Add `reason`: NULL for a good row, else the first rule it breaks.

    Keys are counted with map-side combine and joined back, so rows of one hot key need not share a task.
    """
    repeated = repeated_keys(df, key).withColumn("_repeated", F.lit(True))
    marked = attach(df, repeated, key, how="left")
    nulls = [F.when(F.col(c).isNull(), F.lit(f"null {c}")) for c in dict.fromkeys([*key, *not_null])]
    duplicate = F.when(F.col("_repeated"), F.lit("duplicate key"))
    return marked.withColumn("reason", F.coalesce(*nulls, duplicate)).drop("_repeated")


def enforce_constraints(df: DataFrame, not_null: list[str], key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the declared constraints, and the rejected rows with their reason."""
    marked = mark_constraints(df, not_null, key)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


def upsert(target: DataFrame, batch: DataFrame, key: list[str], update_cols: list[str], seq: str) -> DataFrame:
    """Keyed upsert as if the batch rows were applied one by one in `seq` order.

    For a key already in the target only `update_cols` change, to the values of the key's last batch row
    (NULL included). A new key takes them from its last row too, and all other columns from its first.
    `seq` must order the rows of a key. Keys must not be NULL (see `enforce_constraints`).
    The batch is reduced to one row per key map-side before both sides meet on the key.
    """
    fixed = [c for c in target.columns if c not in key and c not in update_cols]
    rows = batch.groupBy(*key).agg(
        F.lit(True).alias("_in_batch"),
        *[F.max_by(c, seq).alias(f"_new_{c}") for c in update_cols],
        *[F.min_by(c, seq).alias(f"_new_{c}") for c in fixed],
    )
    merged = target.withColumn("_in_target", F.lit(True)).join(rows, key, "full_outer")
    picked = {
        **{c: F.when(F.col("_in_batch"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in update_cols},
        **{c: F.when(F.col("_in_target"), F.col(c)).otherwise(F.col(f"_new_{c}")) for c in fixed},
        **{c: F.col(c) for c in key},
    }
    return merged.select(*[picked[c].alias(c) for c in target.columns])


def fingerprint(df: DataFrame) -> str:
    """Tells apart two versions of a batch, whatever the order of their rows: the count and two sums of row hashes.

    Sums, unlike an exclusive or, do not cancel out when a row is there twice.
    """
    total = lambda *cols: F.coalesce(F.sum(F.xxhash64(*cols).cast("decimal(20,0)")), F.lit(0))
    count, one, two = df.agg(F.count("*"), total(*df.columns), total(F.lit("two"), *df.columns)).first()
    return f"{count}.{int(one) % 2**64:016x}{int(two) % 2**64:016x}"


def upsert_partitions(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: list[str],
    update_cols: list[str],
    seq: str,
    part: str,
    batch_id: int,
    staging: str,
    rejects: DataFrame | None = None,
    rejects_to: str | None = None,
    touched_to: str | None = None,
) -> None:
    """Upsert a batch into a parquet table partitioned by `part`, rewriting only the partitions it touches.

    `part` must follow from the key. The merged partitions are first written to `staging` under the batch's
    number, the attempt's and a fingerprint of its rows, and then moved in. A number that is run again first
    repeats the moves of its earlier attempts, so a half-done move cannot lose rows. If the rows are the same,
    that is all; corrected rows are then merged as a further attempt. The copies of other numbers are deleted
    once the batch is in. `staging` belongs to one series of batch numbers (a stream keeps it in its
    checkpoint folder).

    `rejects` are the rows that were kept out of the batch. They are staged in the same attempt, and take the place
    of what the number had rejected before, under `rejects_to`/run=number. The partitions an attempt touches are
    listed under `touched_to` before its rows move, so that what is built on the table can follow (`touched_parts`).
    """
    schema = batch.drop(seq).schema

    def move(attempt: str) -> None:
        staged = f"{own}/{attempt}"
        if rejects is not None:
            out = spark.read.schema(rejects.schema).parquet(f"{staged}/rejects").write.mode("overwrite")
            out.parquet(f"{rejects_to}/run={batch_id}")
        if touched_to:
            names = [c.partition("=")[2] for c in child_names(spark, f"{staged}/rows") if c.startswith(f"{part}=")]
            listed = spark.createDataFrame([(unquote(n),) for n in names], "part string")
            listed.coalesce(1).write.mode("overwrite").parquet(f"{touched_to}/{batch_id}-{attempt}")
        rows = spark.read.schema(schema).parquet(f"{staged}/rows").write.mode("overwrite")
        rows.option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)

    mark = fingerprint(batch) + (f"-{fingerprint(rejects)}" if rejects is not None else "")
    own = f"{staging}/batch={batch_id}"
    done = [a for a in child_names(spark, own) if path_status(spark, f"{own}/{a}/rows/_SUCCESS")]
    for attempt in done:
        move(attempt)
    if not done or done[-1].partition("-")[2] != mark:
        cols = [c for c in batch.columns if c != seq]
        if path_status(spark, path) is None:
            current = batch.select(*cols).limit(0)
        else:
            # one value per touched partition, so that the scan lists and reads those only
            touched = [row[0] for row in batch.select(part).distinct().collect()]
            current = spark.read.schema(batch.select(*cols).schema).parquet(path).filter(F.col(part).isin(touched))
        attempt = f"{len(done):06d}-{mark}"
        if rejects is not None:
            rejects.write.mode("overwrite").parquet(f"{own}/{attempt}/rejects")
        merged = upsert(current.select(*cols), batch, key, update_cols, seq)
        merged.hint("rebalance", part).write.mode("overwrite").partitionBy(part).parquet(f"{own}/{attempt}/rows")
        move(attempt)
    for other in child_names(spark, staging):
        if other != f"batch={batch_id}":
            delete_path(spark, f"{staging}/{other}")  # superseded: this batch is committed


def touched_parts(spark: SparkSession, touched_to: str) -> tuple[set[str], list[str]]:
    """Partitions listed and not yet taken, and the lists to delete when they are."""
    lists = [f"{touched_to}/{c}" for c in child_names(spark, touched_to) if path_status(spark, f"{touched_to}/{c}/_SUCCESS")]
    if not lists:
        return set(), []
    return {r.part for r in spark.read.schema("part string").parquet(*lists).distinct().collect()}, lists
