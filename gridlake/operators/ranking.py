"""Top-k, ranking and ordering. Nothing here sorts a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from gridlake.functions.scalar import nan_to_null, round_to
from gridlake.operators.joining import attach
from gridlake.sources.tables import settled


def top_k(df: DataFrame, val: str, k: int = 10, tie: str | list[str] | None = None) -> DataFrame:
    """The k largest values, NaN counting as missing; each task keeps its own k rows (TakeOrderedAndProject)."""
    ties = [tie] if isinstance(tie, str) else list(tie or [])
    value = nan_to_null(val) if isinstance(df.schema[val].dataType, (DoubleType, FloatType)) else F.col(val)
    return df.orderBy(value.desc(), *[F.asc(t) for t in ties]).limit(k)


def order_by(df: DataFrame, ts: str) -> DataFrame:
    """Total order by time: a range-partitioned sort, meant for the last step before a sink."""
    return df.orderBy(ts)


def _standing(mean: Column, nulls_first: bool) -> Column:
    """Sort value of a group mean in descending order, with groups of NULL mean first or last."""
    null_rank = F.lit(1 if nulls_first else -1)
    return F.struct(F.when(mean.isNull(), null_rank).otherwise(0).alias("null"), F.coalesce(mean, F.lit(0)).alias("mean"))


def top_k_with_rest(
    df: DataFrame,
    key: str,
    val: str,
    k: int = 3,
    rest_label: str = "Autres régions",
    ties: bool = True,
    digits: int = 0,
    nulls_first: bool = True,
    round_means: bool = False,
) -> DataFrame:
    """Mean per group, the k best kept by name and the others summed under `rest_label`.

    With `ties` every group that equals the k-th mean is kept, as RANK() <= k does; otherwise exactly k
    are, the key breaking ties. A group is in the top k when it stands no lower than the k-th one, so one
    k-row sort replaces a window over all groups. `round_means` rounds the means before they are summed.
    """
    mean = F.avg(nan_to_null(val))
    means = df.groupBy(key).agg((round_to(mean, digits) if round_means else mean).alias("mean"))
    return top_k_of_means(means, key, k, rest_label, ties, digits, nulls_first)


def top_k_of_means(
    means: DataFrame, key: str, k: int = 3, rest_label: str = "Autres régions", ties: bool = True, digits: int = 0,
    nulls_first: bool = True,
) -> DataFrame:
    """The same for a table of group means (`key`, `mean`)."""
    means = settled(means, "means")  # read twice: a mean must have one value
    standing = _standing(F.col("mean"), nulls_first)
    best = means.select(key, standing.alias("_standing")).orderBy(F.desc("_standing"), F.asc(key)).limit(k)
    if ties:
        last = best.agg(F.min("_standing").alias("_kth"))
        marked = attach(means, last).withColumn("_top", standing >= F.col("_kth"))
    else:
        named = F.broadcast(best.select(F.col(key).alias("_best"), F.lit(True).alias("_hit")))  # k rows
        marked = means.join(named, F.col(key).eqNullSafe(F.col("_best")), "left").withColumn(
            "_top", F.coalesce("_hit", F.lit(False))
        )
    label = F.when(F.col("_top"), F.col(key).cast("string")).otherwise(F.lit(rest_label))
    return marked.groupBy(label.alias(key)).agg(round_to(F.sum("mean"), digits).alias("mean"))


def top_share(ranked: DataFrame, k: int = 3, val: str = "mean", key: str = "region") -> DataFrame:
    """Share (%) of the k largest rows of a per-group table in its total."""
    total = ranked.agg(F.sum(val).alias("_total"))
    best = top_k(ranked, val, k, key).agg(F.sum(val).alias("_best"))
    return attach(best, total).select(F.try_divide(100 * F.col("_best"), F.col("_total")).alias("share_pct"))


def rank_groups(
    df: DataFrame, key: str, val: str, k: int | None = None, nulls_first: bool = True, per_slice: int = 100_000
) -> DataFrame:
    """RANK() of groups by descending mean.

    With `k`, only ranks up to k: Spark prunes to k rows per task ahead of the window. Without it, the
    distinct means (equal ones counted, so ties cost one row) are cut into value slices of about `per_slice`
    groups by sketched cut points. A mean's rank follows from the groups in higher slices and those above it in its own slice, so
    no task ranks all groups.
    """
    averages = df.groupBy(key).agg(F.avg(nan_to_null(val)).alias("mean"))
    order = F.desc_nulls_first("mean") if nulls_first else F.desc_nulls_last("mean")
    if k is not None:
        return averages.withColumn("rank", F.rank().over(Window.orderBy(order))).filter(F.col("rank") <= k)

    means = settled(averages, "means")  # read for the ranks and joined by value: a mean must have one value
    slices = max(1, -(-means.count() // per_slice))
    values = means.groupBy("mean").agg(F.count("*").alias("_groups"))
    cuts = values.agg(F.percentile_approx("mean", [i / slices for i in range(1, slices)] or [0.5]).alias("_cuts"))
    above = F.size(F.filter("_cuts", lambda cut: cut > F.col("mean")))  # 0 = highest slice
    null_slice = F.lit(-1 if nulls_first else slices)
    sliced = attach(values, cuts).select(
        "mean", "_groups", F.when(F.col("mean").isNull(), null_slice).otherwise(F.coalesce(above, F.lit(0))).alias("_slice")
    )
    sizes = sliced.groupBy("_slice").agg(F.sum("_groups").alias("_size"))
    higher_slices = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # at most slices + 1 rows
    offsets = sizes.select("_slice", F.coalesce(F.sum("_size").over(higher_slices), F.lit(0)).alias("_offset"))
    higher_means = Window.partitionBy("_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = sliced.withColumn("_before", F.coalesce(F.sum("_groups").over(higher_means), F.lit(0)))
    rank = (F.col("_offset") + F.col("_before") + 1).cast("int").alias("rank")
    ranks = attach(within, offsets, ["_slice"], max_rows=slices + 2).select("mean", rank)
    return attach(means, ranks, ["mean"]).select(key, "mean", "rank")
