"""Exact decimals against Python's own, and Gram correlations against numpy's."""

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal, localcontext
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from gridlake.operators import exact, gram, statistics
from gridlake.sources.schemas import FACTS


def rounded(value: Fraction, digits: int) -> Decimal:
    """Half away from zero, from the exact fraction."""
    scaled = abs(value) * 10**digits
    units = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    return Decimal(units if value >= 0 else -units).scaleb(-digits)


def measures(seed: int) -> list[tuple[str, str]]:
    rng = random.Random(seed)
    sizes = [0.001, 1, 1e6, 9e11]
    return [(rng.choice("abcd"), f"{rng.uniform(-1, 1) * rng.choice(sizes):.6f}") for _ in range(400)]


def test_exact_means_equal_fractions(spark):
    rows = measures(3) + [("e", "0.5"), ("e", "-0.5"), ("f", "-2.5"), ("g", None), ("h", "NaN"), ("h", "much"), ("h", "1e30"), ("i", "Infinity")]
    means = spark.createDataFrame(rows, "k string, v string").groupBy("k").agg(
        *[exact.exact_mean("v", d).alias(f"m{d}") for d in (0, 3, 6, 12)]
    )
    by = defaultdict(list)
    for k, v in rows:
        if k < "g":
            by[k].append(Fraction(Decimal(v)))
    with localcontext(prec=60):
        want = {k: tuple(rounded(sum(v) / len(v), d) for d in (0, 3, 6, 12)) for k, v in by.items()}
    want |= {k: (None,) * 4 for k in "ghi"}
    assert {r[0]: tuple(r[1:]) for r in means.collect()} == want
    assert want["f"][0] == -3


def test_exact_sums_do_not_depend_on_the_order(spark):
    rows = [(v,) for _, v in measures(5)]
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "v string").repartition(1 + seed * 3)
        found.add(df.select(F.col("v").cast("double").alias("v")).agg(exact.total("v")).first()[0])
    with localcontext(prec=60):
        assert found == {sum(Decimal(repr(float(v))).quantize(Decimal("1e-6"), ROUND_HALF_UP) for (v,) in rows)}


def test_ties_are_exact_and_rest_is_rounded_once(spark):
    # a and b have the same mean, which doubles give in two ways; the rest adds up to 0.4999994, not to a half
    rows = [("a", 0.1), ("a", 0.2), ("a", 0.3), ("b", 0.3), ("b", 0.2), ("b", 0.1), ("c", 0.1), ("d", 0.1999997), ("e", 0.0000003), ("e", 0.3999997)]
    df = spark.createDataFrame(rows, "k string, v double")
    top = {r.k: r["mean"] for r in exact.top_k_with_rest(df.filter("k < 'd'"), "k", "v", 1, "rest", digits=1).collect()}
    assert top == {"a": Decimal("0.2"), "b": Decimal("0.2"), "rest": Decimal("0.1")}
    assert exact.top_k_with_rest(df.limit(0), "k", "v").count() == 0


def test_facts_in_decimals(spark):
    fact = FACTS["fact_prix_marche"]
    rows = spark.createDataFrame([("2025-01-01 00:00:00", 0.1), ("2025-01-01 01:00:00", float("nan"))], "date_heure string, prix_eur_mwh double")
    got = exact.with_schema(rows, fact.decimal_schema())
    assert [f.dataType for f in got.schema] == [f.dataType for f in fact.decimal_schema()]
    assert [r.prix_eur_mwh for r in got.collect()] == [Decimal("0.100000"), None]
    assert exact.mean_mix(got, {"prix_eur_mwh": 1}, "").first()[0] == Decimal("0.1")


def test_empty_input(spark):
    empty = spark.createDataFrame([], "ts timestamp_ntz, v double")
    assert exact.monthly_stats(empty, "ts", "v").count() == 0
    assert exact.mean_mix(empty, {"v": 2}).first()[0] is None


def test_gram_equals_pairwise_numpy(spark):
    rng = np.random.default_rng(7)
    n, names = 600, ["a", "b c", "d.e", "flat", "far", "none"]
    base = rng.normal(size=n)
    table = np.column_stack([base, base + rng.normal(size=n), rng.normal(size=n), np.full(n, 0.1), 1e9 + base, np.full(n, np.nan)])
    table[rng.random(table.shape) < 0.2] = np.nan
    rows = [tuple(None if i % 3 and np.isnan(v) else float(v) for v in r) for i, r in enumerate(table)]
    rows += [(float("inf"), 1.0, 1.0, 0.1, 1e9, None)]  # infinite: missing, and it spoils no other pair
    table = np.vstack([table, [np.nan, 1.0, 1.0, 0.1, 1e9, np.nan]])
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in names)).repartition(5)
    got = {(r.x, r.y): (r.n, r.r) for r in gram.corr_matrix_wide(df, names).collect()}
    assert len(got) == len(names) ** 2
    for i, x in enumerate(names):
        for j, y in enumerate(names):
            both = ~np.isnan(table[:, i]) & ~np.isnan(table[:, j])
            count, r = got[x, y]
            assert count == both.sum()
            if "flat" in (x, y) or "none" in (x, y):
                assert r is None
            else:
                assert abs(r - np.corrcoef(table[both, i], table[both, j])[0, 1]) < 1e-6
    plain = {(r.x, r.y): r.r for r in statistics.corr_matrix(df.filter("a < 9").select("a", F.col("`b c`").alias("b")), ["a", "b"]).collect()}
    wide = {(r.x, r.y): r.r for r in gram.corr_matrix_wide(df.filter("a < 9").select("a", F.col("`b c`").alias("b")), ["a", "b"]).collect()}
    assert all(abs(plain[p] - wide[p]) < 1e-12 for p in plain)


def test_gram_of_few_rows(spark):
    schema = "a double, b int"
    assert {tuple(r) for r in gram.corr_matrix_wide(spark.createDataFrame([], schema), ["a"]).collect()} == {("a", "a", 0, None)}
    one = gram.corr_matrix_wide(spark.createDataFrame([(1.0, 2)], schema), ["a", "b"])
    assert {(r.n, r.r) for r in one.collect()} == {(1, None)}
    two = gram.corr_matrix_wide(spark.createDataFrame([(1.0, 2), (2.0, 1)], schema), ["b", "a"])
    assert {(r.x, r.y, r.n, round(r.r, 12)) for r in two.collect()} == {("a", "a", 2, 1.0), ("b", "b", 2, 1.0), ("a", "b", 2, -1.0), ("b", "a", 2, -1.0)}
