"""Correlations of many columns: masked Gram matrices per task, added by pair.

`statistics.corr_matrix` writes one expression per pair, which stops being a plan at some dozens of columns. Here each
task multiplies its rows as blocks: with X the measures (0 where missing) and M the marks of what is there, M'M
gives the complete pairs, X'M and (X * X)'M the sums of one column where the other is there, X'X the cross products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]
CONSTANT = 1e-12  # a spread under this share of its squares is rounding: the column is constant on these rows


def _finite(name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.when(F.abs(value) < float("inf"), value)  # NaN is above infinity


def pair_sums(df: DataFrame, cols: list[str], centre: list[float]) -> DataFrame:
    """`x`, `y` (numbers of columns, x <= y) and SUMS over the rows where both are there, taken from `centre`.

    A task holds four matrices and sends one row per pair; they are added before and after the shuffle by pair.
    """
    k = len(cols)
    upper = np.triu_indices(k)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q, c = np.zeros((4, k, k))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([v.to_numpy(zero_copy_only=False) for v in batch.columns]) - np.array(centre)
            there = ~np.isnan(x)
            x[~there] = 0.0
            m = there.astype(np.float64)
            n += m.T @ m
            s += x.T @ m
            q += (x * x).T @ m
            c += x.T @ x
        sums = [n[upper].astype(np.int64), s[upper], s.T[upper], q[upper], q.T[upper], c[upper]]
        columns = [pa.array(a) for a in (*[u.astype(np.int32) for u in upper], *sums)]
        yield pa.RecordBatch.from_arrays(columns, names=["x", "y", *SUMS])

    rows = df.select(*[_finite(name).alias(str(i)) for i, name in enumerate(cols)])
    parts = rows.mapInArrow(multiply, "x int, y int, n long, " + ", ".join(f"{s} double" for s in SUMS[1:]))
    return parts.groupBy("x", "y").agg(*[F.sum(s).alias(s) for s in SUMS])


def corr_matrix_wide(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r of every pair of columns, each over its complete pairs: x, y, n, r, both triangles.

    Two scans: the means, from which the products are taken so that large offsets cost no digits, and the products.
    Null, NaN and infinite values are missing. r is 1 on the diagonal; it is NULL where a column is constant on the
    complete pairs, or where there are fewer than two. Memory is 32 bytes a pair of columns and task.
    """
    if not cols:
        raise ValueError("no columns")
    means = df.agg(*[F.avg(_finite(name)).alias(str(i)) for i, name in enumerate(cols)]).first()
    sums = pair_sums(df, cols, [m if m is not None else 0.0 for m in means])
    spread = {v: F.col(f"s{v}{v}") - F.try_divide(F.col(f"s{v}") * F.col(f"s{v}"), F.col("n")) for v in "xy"}
    known = (F.col("n") > 1) & (spread["x"] > CONSTANT * F.col("sxx")) & (spread["y"] > CONSTANT * F.col("syy"))
    crossed = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    r = F.when(F.col("x") == F.col("y"), 1.0).otherwise(F.try_divide(crossed, F.sqrt(spread["x"]) * F.sqrt(spread["y"])))
    bounded = F.when(known, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    names = F.array(*[F.lit(c) for c in cols])
    ends = [F.get(names, F.col(v)) for v in "xy"]
    entry = lambda a, b: F.struct(a.alias("x"), b.alias("y"), F.col("n"), F.col("r"))
    mirrored = F.when(F.col("x") == F.col("y"), F.array(entry(*ends))).otherwise(F.array(entry(*ends), entry(*ends[::-1])))
    return sums.withColumn("r", bounded).select(F.inline(mirrored))
