"""Statistics: correlation, significance, fits, outliers, box statistics and scaling.

Global figures reach the rows as scalar subqueries. Per-group figures are joined back on the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalar import nan_to_null, pearson
from gridlake.functions.significance import t_pvalue
from gridlake.operators.cleaning import valid_pairs
from gridlake.operators.joining import attach
from gridlake.operators.quantiles import CANDIDATES, quantiles
from gridlake.operators.ranking import top_k

QUARTILES = [0.25, 0.5, 0.75]


def unpivot_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long form (column, value) of several measures, as doubles without NaN."""
    numeric = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols])
    return numeric.unpivot([], cols, "column", "value")


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r of every pair of columns, each over its complete pairs, in one aggregation.

    Long form (x, y, r), both triangles, with 1 on the diagonal unless the column is constant.
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    own = {a: F.when(pearson(a, a).isNotNull(), 1.0) for a in cols}
    sums = df.agg(*[(own[a] if a == b else pearson(a, b)).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    entries = [
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"`{i}`").alias("r"))
        for i, (a, b) in enumerate(pairs)
        for x, y in {(a, b), (b, a)}
    ]
    return sums.select(F.inline(F.array(*entries)))


def describe(df: DataFrame, cols: list[str], candidates: int = CANDIDATES) -> DataFrame:
    """count, mean, std (n-1), min, quartiles and max per column; exact quartiles.

    The moments of all columns come from one aggregation, the quartiles from `quantiles`.
    """
    numeric = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols])
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"), F.max(c).alias("max"),
        )
        for c in cols
    ]
    moments = numeric.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))
    quarters = quantiles(numeric.unpivot([], cols, "column", "value"), "value", QUARTILES, ["column"], len(cols), candidates)
    moments = attach(moments, quarters.drop("n"), ["column"], len(cols), "left")
    at = [F.get("q", F.lit(i)).alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
    return moments.select("column", "count", "mean", "std", "min", *at, "max")


def pearson_test(df: DataFrame, x: str, y: str) -> DataFrame:
    """r, t, p (two-sided) and n over complete pairs without NaN. All but n are NULL below two pairs."""
    return pearson_result(df.agg(F.regr_count(nan_to_null(y), nan_to_null(x)).alias("n"), pearson(x, y).alias("_r")))


def pearson_result(base: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The test from `n` and `_r`, per row of `keys`."""
    keys = keys or []
    r = F.col("_r")
    t = F.try_divide(r * F.sqrt(F.greatest(F.col("n") - 2, F.lit(0))), F.sqrt(1 - r * r))
    tested = base.select(*keys, "n", r.alias("r"), t.alias("t")).withColumn(
        "_p", t_pvalue("t", F.when(F.col("n") > 2, (F.col("n") - 2).cast("double")))
    )
    p = (
        F.when(F.col("r").isNull(), None)
        .when(F.col("n") == 2, 1.0)
        .when(F.abs("r") == 1, 0.0)
        .otherwise(F.col("_p"))
    )
    return tested.select(*keys, "r", "t", p.alias("p"), "n")


def welch_test(df: DataFrame, group: str, a, b, val: str) -> DataFrame:
    """Welch's unequal-variance test of group `a` against group `b`: means, t, degrees of freedom, p."""

    def of(which, fn: Column, name: str) -> Column:
        return fn(F.when(F.col(group) == which, nan_to_null(val))).alias(name)

    m = df.agg(
        of(a, F.count, "n_a"), of(b, F.count, "n_b"),
        of(a, F.avg, "mean_a"), of(b, F.avg, "mean_b"),
        of(a, F.var_samp, "_va"), of(b, F.var_samp, "_vb"),
    )
    return welch_result(m)


def welch_result(m: DataFrame) -> DataFrame:
    """The test from one row of counts, means and variances (`_va`, `_vb`)."""
    sa, sb = F.try_divide(F.col("_va"), F.col("n_a")), F.try_divide(F.col("_vb"), F.col("n_b"))
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(sa + sb))
    dof = F.try_divide(
        (sa + sb) * (sa + sb),
        F.try_divide(sa * sa, F.col("n_a") - 1) + F.try_divide(sb * sb, F.col("n_b") - 1),
    )
    tested = m.select("n_a", "n_b", "mean_a", "mean_b", t.alias("t"), dof.alias("df"))
    return tested.withColumn("p", t_pvalue("t", "df"))


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line over complete pairs; NULL slope for a constant x."""
    x, y = nan_to_null(x), nan_to_null(y)
    return df.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_count(y, x).alias("n")
    )


def fit_grid(df: DataFrame, x: str, y: str, n: int = 50) -> DataFrame:
    """n evenly spaced points of the fitted line between the least and the greatest x; a single one is the least."""
    line = valid_pairs(df, x, y).agg(
        F.regr_slope(y, x).alias("_a"), F.regr_intercept(y, x).alias("_b"),
        F.min(x).alias("_from"), F.max(x).alias("_to"),
    )
    points = line.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    at = F.col("_from") + (F.col("_to") - F.col("_from")) * F.col("i") / max(n - 1, 1)
    return points.select("i", at.alias("x"), (F.col("_a") * at + F.col("_b")).alias("y"))


def with_zscore(df: DataFrame, val: str, out: str = "z") -> DataFrame:
    """Standard score with the sample standard deviation; NULL when the column is constant."""
    value = nan_to_null(val)
    moments = df.agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd"))
    return attach(df, moments).withColumn(out, F.try_divide(value - F.col("_mean"), F.col("_sd"))).drop(
        "_mean", "_sd"
    )


def standardise(df: DataFrame, col: str) -> DataFrame:
    return with_zscore(df, col, f"{col}_z")


def zscore_outliers(df: DataFrame, val: str, limit: float = 3) -> DataFrame:
    """Rows whose value lies strictly more than `limit` sample standard deviations from the mean."""
    return with_zscore(df, val).filter(F.abs("z") > limit)


def iqr_fences(
    df: DataFrame, val: str, k: float = 1.5, candidates: int = CANDIDATES
) -> DataFrame:
    q = quantiles(df, val, [0.25, 0.75], candidates=candidates)
    q1, q3 = F.get("q", F.lit(0)), F.get("q", F.lit(1))
    return q.select((q1 - k * (q3 - q1)).alias("low_fence"), (q3 + k * (q3 - q1)).alias("high_fence"))


def iqr_outliers(df: DataFrame, val: str, k: float = 1.5, candidates: int = CANDIDATES) -> DataFrame:
    """Rows outside the quartile fences, with the fences."""
    fenced = attach(df, iqr_fences(df, val, k, candidates))
    value = nan_to_null(val)
    return fenced.filter((value < F.col("low_fence")) | (value > F.col("high_fence")))


def iqr_summary(df: DataFrame, val: str, k: float = 1.5, candidates: int = CANDIDATES) -> DataFrame:
    """Fences, outlier count and its share (%) of all rows, rows without a value included."""
    outside = (nan_to_null(val) < F.col("low_fence")) | (nan_to_null(val) > F.col("high_fence"))
    return attach(df, iqr_fences(df, val, k, candidates)).agg(
        F.max("low_fence").alias("low_fence"),
        F.max("high_fence").alias("high_fence"),
        F.count_if(outside).alias("outliers"),
        F.try_divide(100.0 * F.count_if(outside), F.count("*")).alias("outlier_pct"),
    )


def top_outliers(
    df: DataFrame, val: str, k: int = 10, tie: str | list[str] | None = None, candidates: int = CANDIDATES
) -> DataFrame:
    """The k largest of the outliers by quartile fences."""
    return top_k(iqr_outliers(df, val, candidates=candidates), val, k, tie).drop("low_fence", "high_fence")


def iqr_counts(df: DataFrame, cols: list[str], k: float = 1.5, candidates: int = CANDIDATES) -> DataFrame:
    """Outlier count and non-null count for each of many columns. Outliers are reported, not removed."""
    long = unpivot_numeric(df, cols).filter(F.col("value").isNotNull())
    q1, q3 = F.get("q", F.lit(0)), F.get("q", F.lit(1))
    fences = quantiles(long, "value", [0.25, 0.75], ["column"], len(cols), candidates).select(
        "column", (q1 - k * (q3 - q1)).alias("_low"), (q3 + k * (q3 - q1)).alias("_high")
    )
    outside = (F.col("value") < F.col("_low")) | (F.col("value") > F.col("_high"))
    return (
        attach(long, fences, ["column"], len(cols))
        .groupBy("column")
        .agg(F.count_if(outside).alias("outliers"), F.count("*").alias("non_null"))
    )


def box_stats(
    df: DataFrame, group: str, val: str, k: float = 1.5, max_groups: int | None = None, candidates: int = CANDIDATES
) -> DataFrame:
    """Per group: n, quartiles, whiskers (the most extreme values within the fences) and outlier count.

    A whisker without a value between fence and quartile ends at the quartile.
    """
    data = df.select(group, nan_to_null(F.col(val).cast("double")).alias("_v")).filter(
        F.col(group).isNotNull() & F.col("_v").isNotNull()
    )
    q = quantiles(data, "_v", QUARTILES, [group], max_groups, candidates)
    at = [F.get("q", F.lit(i)) for i in range(3)]
    boxes = q.select(
        group, "n", at[0].alias("q1"), at[1].alias("median"), at[2].alias("q3"),
        (at[0] - k * (at[2] - at[0])).alias("_low"), (at[2] + k * (at[2] - at[0])).alias("_high"),
    )
    v = F.col("_v")
    inside = (v >= F.col("_low")) & (v <= F.col("_high"))
    return (
        attach(data, boxes, [group], max_groups)
        .groupBy(group, "n", "q1", "median", "q3")
        .agg(
            F.least("q1", F.min(F.when(inside, v))).alias("whisker_low"),
            F.greatest("q3", F.max(F.when(inside, v))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def standardise_complete(df: DataFrame, cols: list[str]) -> DataFrame:
    """Standard scores of several columns with the population standard deviation, over the rows complete
    in all of them; other rows get NULL."""
    complete = F.lit(True)
    for c in cols:
        complete = complete & nan_to_null(c).isNotNull()
    moments = df.filter(complete).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols]
    )
    scores = {
        # a constant column is centred but not divided, as a scaler does with zero variance
        f"{c}_z": F.when(
            complete,
            (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") == 0, 1.0).otherwise(F.col(f"_s_{c}")),
        )
        for c in cols
    }
    return attach(df, moments).withColumns(scores).drop(*[f"_{p}_{c}" for p in "ms" for c in cols])


def minmax(df: DataFrame, col: str) -> DataFrame:
    """Scale to [0, 1]; NULL when the column is constant."""
    value = nan_to_null(col)
    span = df.agg(F.min(value).alias("_min"), F.max(value).alias("_max"))
    scaled = F.try_divide(value - F.col("_min"), F.col("_max") - F.col("_min"))
    return attach(df, span).withColumn(f"{col}_minmax", scaled).drop("_min", "_max")
