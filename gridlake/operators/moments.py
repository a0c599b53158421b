"""Counts, means and co-moments that merge, so statistics over a whole history come from small stored states.

A state holds, for one pair of measures and one group (a month), the number of complete pairs, both means and the
three sums of squared and crossed deviations. Two states merge by the pairwise update formulas; nothing is squared
before the means are taken off, so merging loses no digits. States of one group merge in the order of their keys, so a
result does not depend on the order in which they were read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalar import nan_to_null
from gridlake.operators.statistics import pearson_result, welch_result

STATE = ["n", "mean_x", "mean_y", "sxx", "syy", "sxy"]
Pairs = list[tuple[str, str, str]]


def _of_pair(x: str, y: str, name: str) -> Column:
    a, b = nan_to_null(F.col(x).cast("double")), nan_to_null(F.col(y).cast("double"))
    sums = [F.regr_avgx(b, a), F.regr_avgy(b, a), F.regr_sxx(b, a), F.regr_syy(b, a), F.regr_sxy(b, a)]
    return F.struct(F.lit(name).alias("pair"), F.regr_count(b, a).alias("n"), *[s.alias(c) for c, s in zip(STATE[1:], sums)])


def pair_states(df: DataFrame, pairs: Pairs, by: list[str]) -> DataFrame:
    """One row per group and pair (x, y, name): `pair` and STATE, over complete pairs without NaN, in one pass.

    A measure paired with itself gives its own count, mean and squared deviations.
    """
    return df.groupBy(*by).agg(F.array(*[_of_pair(*p) for p in pairs]).alias("_states")).select(*by, F.inline("_states"))


def merge_states(states: DataFrame, over: list[str], by: list[str] | None = None) -> DataFrame:
    """States merged over the columns `over` (a month), per pair and `by`.

    The states of a pair meet in one task: one small row per group that was stored, not per measured row.
    """
    by = by or []
    zero = F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(c) for c in STATE[1:]])

    def update(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        dx, dy = b["mean_x"] - a["mean_x"], b["mean_y"] - a["mean_y"]
        share, weight = b["n"] / n, a["n"] * b["n"] / n
        return F.struct(
            n.alias("n"), (a["mean_x"] + dx * share).alias("mean_x"), (a["mean_y"] + dy * share).alias("mean_y"),
            (a["sxx"] + b["sxx"] + dx * dx * weight).alias("sxx"), (a["syy"] + b["syy"] + dy * dy * weight).alias("syy"),
            (a["sxy"] + b["sxy"] + dx * dy * weight).alias("sxy"),
        )

    listed = F.array_sort(F.collect_list(F.when(F.col("n") > 0, F.struct(*over, *STATE))))
    return states.groupBy(*by, "pair").agg(listed.alias("_list")).select(
        *by, "pair", F.aggregate("_list", zero, update).alias("_state")
    ).select(*by, "pair", "_state.*")


def state_r() -> Column:
    """Pearson r of a state, within [-1, 1]; NULL for a constant measure or fewer than two pairs."""
    r = F.try_divide(F.col("sxy"), F.sqrt("sxx") * F.sqrt("syy"))
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def state_corrs(merged: DataFrame) -> DataFrame:
    return merged.withColumn("r", state_r()).select(*[c for c in merged.columns if c not in STATE], "r", "n")


def state_tests(merged: DataFrame) -> DataFrame:
    """r, t, p and n of each merged pair, as `pearson_test` gives them from the rows."""
    keys = [c for c in merged.columns if c not in STATE]
    return pearson_result(merged.select(*keys, "n", state_r().alias("_r")), keys)


def state_fits(merged: DataFrame) -> DataFrame:
    """Least-squares line of each merged pair; NULL slope for a constant x."""
    slope = F.try_divide(F.col("sxy"), F.col("sxx"))
    return merged.select(
        *[c for c in merged.columns if c not in STATE], slope.alias("slope"),
        (F.col("mean_y") - slope * F.col("mean_x")).alias("intercept"), "n",
    )


def state_welch(merged: DataFrame, group: str, a, b) -> DataFrame:
    """Welch's test of two groups from the states of a measure paired with itself."""

    def of(which, value: Column, name: str) -> Column:
        return F.max(F.when(F.col(group) == which, value)).alias(name)

    variance = F.when(F.col("n") > 1, F.col("sxx") / (F.col("n") - 1))
    sides = merged.agg(
        of(a, F.col("n"), "n_a"), of(b, F.col("n"), "n_b"), of(a, F.col("mean_x"), "mean_a"), of(b, F.col("mean_x"), "mean_b"),
        of(a, variance, "_va"), of(b, variance, "_vb"),
    )
    return welch_result(sides)
