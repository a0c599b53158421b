"""Exact quantiles (linear interpolation) of groups of any size.

Two scans, or more for groups of very many values; their shuffles carry bounded state per group and task:

1. One aggregate gives each group a mergeable sketch (KLL) with its count. Two values of it that enclose the wanted
   rank with a margin form a bracket, which holds about a hundredth of the group. Sketches that were stored before
   (`sketches_of`, one per month, say) merge and save this scan.
2. While a bracket would hold too many values, a round counts what the brackets hold and shrinks them about 85-fold,
   by a grid of cut points (`percentile_approx`).
3. One last scan counts exactly: values inside a bracket one by one, everything else as one cell per region between
   brackets. Running counts over those few cells give the value at each rank.

The sketch only decides where to look. If a rank were to fall outside its bracket the query would fail rather than
return a near value.
"""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.scalar import nan_to_null
from gridlake.operators.joining import attach
from gridlake.sources.tables import settled

GRID = 256  # cut points per round
ACCURACY = 10_000  # rank error of the sketches of a round is 1/ACCURACY
SKETCH = 4096  # size of a sketch; its rank error is about 1/1000, far below the margin of 1/GRID
HELD = 0.016  # largest share of a group in a bracket: three steps of the grid, and the sketch's error
CANDIDATES = 1_000_000  # distinct values a bracket may hold before the exact count
MOST_ROUNDS = 12  # enough for 1e28 values


def values_of(df: DataFrame, val: str, by: list[str] | None = None) -> DataFrame:
    """`by` and the double `_v`, without NULL and NaN."""
    return df.select(*(by or []), nan_to_null(F.col(val).cast("double")).alias("_v")).filter(F.col("_v").isNotNull())


def quantiles(
    df: DataFrame,
    val: str,
    probs: list[float],
    by: list[str] | None = None,
    max_groups: int | None = None,
    candidates: int = CANDIDATES,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """Per group: `n` values (neither NULL nor NaN) and `q`, the array of quantiles. Groups without values are absent.

    `max_groups` is a bound on the number of groups that follows from the key (24 hours of a day). `sketches` are
    stored ones of the same rows (`sketches_of`). Jobs run while this is called, which give the brackets.
    """
    return exact_quantiles(values_of(df, val, by), probs, by or [], max_groups, candidates, sketches)


def sketches_of(df: DataFrame, val: str, by: list[str]) -> DataFrame:
    """Per group (a month, with or without a key) the sketch of its values, to be stored and merged later."""
    return values_of(df, val, by).groupBy(*by).agg(F.kll_sketch_agg_double("_v", F.lit(SKETCH)).alias("sketch"))


def _rank(n: Column, p: float) -> Column:
    """Zero-based fractional rank of the quantile."""
    return (n - 1) * F.lit(float(p))


def _grid_at(grid: Column, i: Column) -> Column:
    return F.get(grid, F.least(F.greatest(i, F.lit(0)), F.lit(GRID)).cast("int"))


def _next_bracket(grid: Column, position: Column, i: int) -> list[Column]:
    """Cut points around a relative position, one grid step of margin on either side."""
    cell = F.floor(position * GRID)
    return [_grid_at(grid, cell - 1).alias(f"_lo{i}"), _grid_at(grid, cell + 2).alias(f"_hi{i}")]


def _first_brackets(sketch: Column, probs: list[float]) -> list[Column]:
    """The same for ranks that are known beforehand, read off a stored or fresh sketch."""
    cells = [int(p * GRID) for p in probs]
    ranks = [min(max(c, 0), GRID) / GRID for cell in cells for c in (cell - 1, cell + 2)]
    cuts = F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(r) for r in ranks]))
    names = [f"_{side}{i}" for i in range(len(probs)) for side in ("lo", "hi")]
    return [F.get(cuts, F.lit(i)).alias(name) for i, name in enumerate(names)]


def _sketch(value: Column) -> Column:
    return F.percentile_approx(value, [i / GRID for i in range(GRID + 1)], ACCURACY)


def _kept(df: DataFrame, col: str, by: list[str], max_groups: int | None, name: str) -> tuple[DataFrame, int | None]:
    """One row per group, computed once, and the greatest value of a column. A bounded number of rows is kept by the
    driver, which saves writing and reading them; others are written."""
    if by and max_groups is None:
        written = settled(df, name)
        return written, written.agg(F.max(col)).first()[0]
    rows = df.toArrow()
    return df.sparkSession.createDataFrame(rows, df.schema), pc.max(rows.column(col)).as_py()


def _answer(data: DataFrame, brackets: DataFrame, probs: list[float], by: list[str], max_groups: int | None) -> DataFrame:
    """The last scan. Few rows are computed at once, as those who ask use them more than once."""
    found = _pick(_cells(data, brackets, probs, by, max_groups), probs, by)
    return found if by and max_groups is None else _kept(found, "n", by, max_groups, "quantiles")[0]


def exact_quantiles(
    data: DataFrame, probs: list[float], by: list[str], max_groups: int | None = None, candidates: int = CANDIDATES,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """The same on columns `by` and a non-null double `_v`."""
    v = F.col("_v")
    if sketches is None:
        first = data.groupBy(*by).agg(F.kll_sketch_agg_double(v, F.lit(SKETCH)).alias("_all"))
    else:
        first = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH)).alias("_all"))
    counted = first.withColumn("n", F.kll_sketch_get_n_double("_all")).filter("n > 0")
    brackets, most = _kept(counted.select(*by, "n", *_first_brackets(F.col("_all"), probs)), "n", by, max_groups, "brackets")
    if most is None or most * HELD <= candidates or most <= candidates:
        return _answer(data, brackets, probs, by, max_groups)
    for _ in range(MOST_ROUNDS):
        aggs = [F.first("n").alias("n")]
        for i in range(len(probs)):
            inside = (v >= F.col(f"_lo{i}")) & (v <= F.col(f"_hi{i}"))
            aggs += [
                F.count_if(v < F.col(f"_lo{i}")).alias(f"_below{i}"),
                F.count_if(inside).alias(f"_in{i}"),
                F.approx_count_distinct(F.when(inside, v)).alias(f"_values{i}"),
                _sketch(F.when(inside, v)).alias(f"_grid{i}"),
            ]
        held = F.array_max(F.array(*[F.col(f"_values{i}") for i in range(len(probs))]))
        counts = attach(data, brackets, by, max_groups).groupBy(*by).agg(*aggs).withColumn("_held", held)
        measured, fullest = _kept(counts, "_held", by, max_groups, "measured")
        if fullest is None or fullest <= candidates:
            return _answer(data, brackets, probs, by, max_groups)
        at = [
            c
            for i, p in enumerate(probs)
            for c in _next_bracket(
                F.col(f"_grid{i}"), F.try_divide(_rank(F.col("n"), p) - F.col(f"_below{i}"), F.col(f"_in{i}")), i
            )
        ]
        brackets, _ = _kept(measured.select(*by, "n", *at), "n", by, max_groups, "brackets")
    raise ValueError(f"brackets still hold {fullest} values after {MOST_ROUNDS} rounds")


def _cells(data: DataFrame, brackets: DataFrame, probs: list[float], by: list[str], max_groups: int | None) -> DataFrame:
    """Exact counts: one cell per value inside a bracket, one per region outside all brackets."""
    v = F.col("_v")
    inside = F.lit(False)
    region = F.lit(0)
    for i in range(len(probs)):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        inside = inside | ((v >= lo) & (v <= hi))
        region = region + (v >= lo).cast("int") + (v > hi).cast("int")
    return (
        attach(data, brackets, by, max_groups)
        .groupBy(*by, "n", region.alias("_region"), F.when(inside, v).alias("_value"))
        .agg(F.count("*").alias("_count"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    )


def _pick(cells: DataFrame, probs: list[float], by: list[str]) -> DataFrame:
    """Read the wanted ranks off the running counts and interpolate."""
    running = Window.partitionBy(*by).orderBy("_min").rowsBetween(Window.unboundedPreceding, 0)
    placed = cells.withColumn("_end", F.sum("_count").over(running)).withColumn(
        "_start", F.col("_end") - F.col("_count")
    )

    def value_at(rank: Column) -> Column:
        """Value at a rank; a cell of many values is exact only at its two ends."""
        known = (
            F.when(rank == F.col("_start"), F.col("_min"))
            .when((rank == F.col("_end") - 1) | (F.col("_min") == F.col("_max")), F.col("_max"))
            .otherwise(F.raise_error(F.lit("quantile rank outside its bracket")).cast("double"))
        )
        return F.max(F.when((rank >= F.col("_start")) & (rank < F.col("_end")), known))

    picks = [F.first("n").alias("_n")]
    for i, p in enumerate(probs):
        rank = _rank(F.col("n"), p)
        picks += [value_at(F.floor(rank)).alias(f"_a{i}"), value_at(F.ceil(rank)).alias(f"_b{i}")]
    quantile = [
        F.col(f"_a{i}")
        + (F.col(f"_b{i}") - F.col(f"_a{i}")) * (_rank(F.col("_n"), p) - F.floor(_rank(F.col("_n"), p)))
        for i, p in enumerate(probs)
    ]
    return placed.groupBy(*by).agg(*picks).select(*by, F.col("_n").alias("n"), F.array(*quantile).alias("q"))
