"""The bracket method against numpy, on shapes that are hard for it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.operators import quantiles as module
from gridlake.operators.quantiles import CANDIDATES, exact_quantiles, quantiles, sketches_of
from gridlake.operators.statistics import box_stats
from gridlake.sources.tables import settled

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
RNG = np.random.default_rng(7)
SHAPES = {
    "normal": RNG.normal(size=5000),
    "heavy tail": RNG.pareto(0.6, size=5000) * 1e6,
    "one value a third": np.where(RNG.random(4000) < 0.34, 3.0, RNG.normal(size=4000)),
    "two values": np.array([1.0, 2.0] * 700),
    "constant": np.full(900, 4.5),
    "tiny": np.array([3.0, 1.0, 2.0]),
    "pair": np.array([5.0, -5.0]),
    "single": np.array([7.0]),
}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(name, float(v)) for name, values in SHAPES.items() for v in values]
    return spark.createDataFrame(data, "shape string, _v double").repartition(6).cache()


@pytest.mark.parametrize("candidates", [10_000, 60, 8])
@pytest.mark.parametrize("bounded", [True, False])
def test_groups_equal_numpy(rows, candidates, bounded):
    got = exact_quantiles(rows, PROBS, ["shape"], len(SHAPES) if bounded else None, candidates).collect()
    assert {r.shape: r.n for r in got} == {k: len(v) for k, v in SHAPES.items()}
    for r in got:
        np.testing.assert_allclose(r.q, np.quantile(SHAPES[r.shape], PROBS), rtol=1e-12, err_msg=r.shape)


@pytest.mark.parametrize("candidates", [10_000, 8])
def test_whole_table_equals_numpy(rows, candidates):
    everything = np.concatenate(list(SHAPES.values()))
    got = exact_quantiles(rows, PROBS, [], None, candidates).first()
    np.testing.assert_allclose(got.q, np.quantile(everything, PROBS), rtol=1e-12)


def test_small_and_large_path_agree(rows):
    small = {r.shape: r.q for r in quantiles(rows, "_v", PROBS, ["shape"], candidates=CANDIDATES).collect()}
    large = {r.shape: r.q for r in quantiles(rows, "_v", PROBS, ["shape"], candidates=8).collect()}
    mixed = {r.shape: r.q for r in quantiles(rows, "_v", PROBS, ["shape"], candidates=950).collect()}
    assert mixed.keys() == small.keys()
    for shape, q in small.items():
        np.testing.assert_allclose(mixed[shape], q, rtol=1e-12)
        np.testing.assert_allclose(large[shape], q, rtol=1e-12)


def test_nulls_and_null_groups(spark):
    data = [(None, 1.0), (None, 3.0), ("a", None), ("a", 5.0), ("b", None)]
    df = spark.createDataFrame(data, "g string, x double")
    for candidates in (8, CANDIDATES):
        got = {r.g: (r.n, r.q) for r in quantiles(df, "x", [0.5], ["g"], candidates=candidates).collect()}
        assert got == {None: (2, [2.0]), "a": (1, [5.0])}


@pytest.mark.parametrize("candidates", [8, CANDIDATES])
def test_box_whiskers(spark, candidates):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 100.0, -50.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("a", None), (None, 1.0)], "g string, x double")
    box = box_stats(df, "g", "x", candidates=candidates).collect()
    assert len(box) == 1
    b = box[0]
    assert (b.n, b.q1, b.median, b.q3) == (11, 2.5, 5.0, 7.5)
    assert (b.whisker_low, b.whisker_high, b.outliers) == (1.0, 9.0, 2)


def test_quartile_is_the_whisker_when_no_value_lies_between(spark):
    # q3 is interpolated above every value inside the fence
    values = [0.0, 0.0, 0.0, 1.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values], "g string, x double")
    b = box_stats(df, "g", "x", k=0.1, candidates=CANDIDATES).first()
    assert b.whisker_high == b.q3 == 1.0 and b.whisker_low == 0.0 and b.outliers == 1


def test_rank_outside_bracket_fails_loudly(rows):
    few = rows.filter("shape = 'normal' AND _v > 1")
    with pytest.raises(Exception, match="outside its bracket"):  # sketches of other rows than these
        exact_quantiles(rows.filter("shape = 'normal'"), [0.5], [], sketches=sketches_of(few, "_v", [])).collect()


def test_stored_sketches_save_a_scan(rows, spark, tmp_path):
    monthly = rows.withColumn("month", F.pmod(F.xxhash64("_v"), F.lit(7)))
    sketches_of(monthly, "_v", ["month", "shape"]).write.parquet(f"{tmp_path}/sketches")
    stored = spark.read.parquet(f"{tmp_path}/sketches")
    got = {r.shape: (r.n, r.q) for r in quantiles(rows, "_v", PROBS, ["shape"], sketches=stored).collect()}
    assert got.keys() == SHAPES.keys()
    for shape, (n, q) in got.items():
        assert n == len(SHAPES[shape])
        np.testing.assert_allclose(q, np.quantile(SHAPES[shape], PROBS), rtol=1e-12)


def test_number_of_scans(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(float(i), i % 3) for i in range(5000)], "v double, g int").write.parquet(f"{tmp_path}/v")
    df = spark.read.schema("v double, g int").parquet(f"{tmp_path}/v")
    stored = settled(sketches_of(df, "v", ["g"]), "sketches")
    kept, plans = module._kept, []
    monkeypatch.setattr(module, "_kept", lambda d, *a: plans.append(d._jdf.queryExecution().executedPlan().toString()) or kept(d, *a))
    for sketches, scans in ((None, 2), (stored, 1)):
        plans.clear()
        assert quantiles(df, "v", [0.25, 0.5], ["g"], 3, sketches=sketches).count() == 3
        assert sum(p.count("ReadSchema: struct<v:double,g:int>") for p in plans) == scans
