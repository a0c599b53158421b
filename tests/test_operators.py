"""Operators on small hand-made tables: nulls, NaN, ties, constant columns, hot keys, time zones."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridlake.functions.scalar import iso_date, local_time, round_to, season, to_number
from gridlake.functions.significance import t_two_sided
from gridlake.operators import aggregates, cleaning, joining, quality, ranking, series, time_windows
from gridlake.operators import statistics as st
from gridlake.operators.quantiles import CANDIDATES
from gridlake.sources.loading import enforce_constraints, upsert, upsert_partitions
from gridlake.sources.tables import publish, publish_table, publish_version, read_csv, read_version, write_csv


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- scalars -----------------------------------------------------------------------------------------


def test_numeric_coercion(spark):
    df = spark.createDataFrame([("1.5",), ("n/a",), ("NaN",), (None,), (" 2 ",), ("",)], "x string")
    assert [r[0] for r in df.select(to_number("x")).collect()] == [1.5, None, None, None, 2.0, None]
    assert cleaning.coerce_numeric(df, ["x", "absent"]).schema["x"].dataType.simpleString() == "double"


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(12.345, 2), (-12.345, 2), (2.5, 0), (1.005, 2)], "x double, d int")
    got = [df.filter(F.col("x") == x).select(round_to("x", d)).first()[0] for x, d in [(12.345, 2), (-12.345, 2), (2.5, 0), (1.005, 2)]]
    assert got == [12.35, -12.35, 3.0, 1.01]


def test_iso_date_keeps_the_written_day(spark):
    df = spark.createDataFrame([("2026-01-05T00:30:00+01:00",), ("2026-01-05T10:00:00Z",), ("soon",), (None,)], "x string")
    assert [r[0] for r in df.select(iso_date("x")).collect()] == [date(2026, 1, 5), date(2026, 1, 5), None, None]


def test_season_by_zone(spark):
    df = spark.createDataFrame([(datetime(2025, 11, 30, 23, 30),), (datetime(2025, 7, 1),), (None,)], "ts timestamp_ntz")
    assert [r[0] for r in df.select(season("ts")).collect()] == ["mi_saison", "ete", None]
    assert df.select(season("ts", tz="Europe/Paris")).first()[0] == "hiver"
    assert df.select(local_time("ts", "Europe/Paris")).first()[0] == datetime(2025, 12, 1, 0, 30)


# --- statistics --------------------------------------------------------------------------------------


def test_t_probability_reference_points():
    # textbook points: t(0.975; 10), Cauchy, near-normal, and an extreme tail
    p = t_two_sided([2.228138852, 1.0, 1.959963985, 0.0, 400.0], [10, 1, 1e12, 5, 30])
    assert p[:4] == pytest.approx([0.05, 0.5, 0.05, 1.0], abs=1e-8)
    assert 0 < p[4] < 1e-50
    # both methods meet where one takes over
    for t in (0.3, 1.0, 3.0, 8.0):
        below, above = t_two_sided([t, t], [99_999, 100_001])
        assert below == pytest.approx(above, rel=1e-3) and below > above
        assert t_two_sided([t], [1e5 - 1e-3])[0] == pytest.approx(t_two_sided([t], [1e5])[0], rel=1e-8)


def test_pearson_over_complete_pairs(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.5, 5.0), (3.0, 5.5, 5.0), (4.0, None, 5.0), (None, 1.0, 5.0)], "x double, y double, c double"
    )
    t = st.pearson_test(df, "x", "y").first()
    x, y = [1, 2, 3], [2, 4.5, 5.5]
    mx, my = 2, 4
    r = sum((a - mx) * (b - my) for a, b in zip(x, y)) / math.sqrt(
        sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y)
    )
    assert t.n == 3 and t.r == pytest.approx(r)
    assert t.p == pytest.approx(1 - 2 / math.pi * math.atan(t.t))  # one degree of freedom
    assert tuple(st.pearson_test(df, "x", "c").first()) == (None, None, None, 4)  # constant
    one = st.pearson_test(df.limit(1), "x", "y").first()
    assert (one.r, one.p, one.n) == (None, None, 1)
    two = st.pearson_test(df.filter("x <= 2"), "x", "y").first()
    assert (two.r, two.p, two.n) == (pytest.approx(1.0), 1.0, 2)
    exact = st.pearson_test(df.withColumn("z", 2 * F.col("x")), "x", "z").first()
    assert exact.r == pytest.approx(1.0) and exact.p == pytest.approx(0.0, abs=1e-6)


def test_corr_matrix_is_symmetric_with_unit_diagonal(spark):
    df = spark.createDataFrame([(1.0, 3.0, 1.0), (2.0, 1.0, 1.0), (4.0, None, 1.0), (5.0, 2.0, 1.0)], "a double, b double, c double")
    m = {(r.x, r.y): r.r for r in st.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(m) == 9
    assert m["a", "b"] == m["b", "a"] != None  # noqa: E711
    assert m["a", "a"] == pytest.approx(1) and m["c", "c"] is None and m["a", "c"] is None


def test_welch(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0, 8.0, 10.0]
    df = spark.createDataFrame([("a", v) for v in a] + [("b", v) for v in b] + [("a", None), ("x", 9.0)], "g string, v double")
    w = st.welch_test(df, "g", "a", "b", "v").first()
    sa, sb = (5 / 3) / 4, 10 / 5
    assert (w.n_a, w.n_b) == (4, 5)
    assert w.t == pytest.approx((2.5 - 6) / math.sqrt(sa + sb))
    assert w.df == pytest.approx((sa + sb) ** 2 / (sa**2 / 3 + sb**2 / 4))
    assert 0 < w.p < 0.1
    empty = st.welch_test(df.filter("g = 'a'"), "g", "a", "b", "v").first()
    assert (empty.t, empty.p) == (None, None)


def test_scaling(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (2, 2.0, None), (3, 6.0, 3.0), (4, None, 9.0)], "i int, x double, y double")
    z = st.standardise(df, "x").agg(F.avg("x_z"), F.stddev_samp("x_z")).first()
    assert (z[0], z[1]) == (pytest.approx(0, abs=1e-12), pytest.approx(1))
    both = {r.i: (r.x_z, r.y_z) for r in st.standardise_complete(df, ["x", "y"]).collect()}
    assert both == {1: (-1.0, -1.0), 2: (None, None), 3: (1.0, 1.0), 4: (None, None)}
    span = st.minmax(df, "x").agg(F.min("x_minmax"), F.max("x_minmax")).first()
    assert tuple(span) == (0.0, 1.0)
    flat = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert {r.x_minmax for r in st.minmax(flat, "x").collect()} == {None}
    assert st.zscore_outliers(flat, "x").count() == 0


def test_outliers_are_strict_and_counted_over_all_rows(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 50.0, None, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    s = st.iqr_summary(df, "x", candidates=CANDIDATES).first()
    assert (s.outliers, s.outlier_pct) == (1, 12.5)
    assert rows(st.iqr_counts(df.withColumn("y", F.lit(1.0)), ["x", "y"], candidates=CANDIDATES), "column") == [("x", 1, 6), ("y", 0, 8)]
    assert [r.x for r in st.top_outliers(df, "x", 3, candidates=CANDIDATES).collect()] == [50.0]


def test_describe_with_null_column_and_nan(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (float("nan"), None)], "x double, y double")
    for candidates in (8, CANDIDATES):
        d = {r.column: r for r in st.describe(df, ["x", "y"], candidates).collect()}
        assert (d["x"]["count"], d["x"].mean, d["x"].p50, d["x"].max) == (2, 1.5, 1.5, 2.0)
        assert (d["y"]["count"], d["y"].mean, d["y"].p25) == (0, None, None)


def test_linear_fit_and_grid(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 3.0), (2.0, 5.0), (9.0, None)], "x double, y double")
    assert tuple(st.linear_fit(df, "x", "y").first()) == (2.0, 1.0, 3)
    grid = rows(st.fit_grid(df, "x", "y", 5), "i")
    assert grid == [(0, 0.0, 1.0), (1, 0.5, 2.0), (2, 1.0, 3.0), (3, 1.5, 4.0), (4, 2.0, 5.0)]


# --- aggregates and rankings -------------------------------------------------------------------------


def regions(spark):
    data = [("a", 10.0), ("a", 20.0), ("b", 15.0), ("c", 9.0), ("d", 9.0), ("e", 1.0), ("f", 2.0)]
    return spark.createDataFrame(data, "region string, v double")


def test_top_k_with_rest_keeps_ties_or_exactly_k(spark):
    df = regions(spark)
    tied = dict(rows(ranking.top_k_with_rest(df, "region", "v", 3, "rest")))
    assert tied == {"a": 15.0, "b": 15.0, "c": 9.0, "d": 9.0, "rest": 3.0}
    exact = dict(rows(ranking.top_k_with_rest(df, "region", "v", 3, "rest", ties=False)))
    assert exact == {"a": 15.0, "b": 15.0, "c": 9.0, "rest": 12.0}
    assert sum(tied.values()) == sum(exact.values()) == 51.0


def test_top_k_null_mean_first_or_last(spark):
    df = regions(spark).union(spark.createDataFrame([("n", None)], "region string, v double"))
    first = dict(rows(ranking.top_k_with_rest(df, "region", "v", 3, "rest")))
    assert set(first) == {"n", "a", "b", "rest"}
    last = dict(rows(ranking.top_k_with_rest(df, "region", "v", 3, "rest", nulls_first=False)))
    assert set(last) == {"a", "b", "c", "d", "rest"}


@pytest.mark.parametrize("nulls_first", [True, False])
def test_rank_without_one_window_over_all(spark, nulls_first):
    df = regions(spark).union(spark.createDataFrame([("n", None)], "region string, v double"))
    want = {"a": 1, "b": 1, "c": 3, "d": 3, "f": 5, "e": 6, "n": 7}
    if nulls_first:
        want = {k: v + 1 for k, v in want.items() if k != "n"} | {"n": 1}
    got = {r.region: r.rank for r in ranking.rank_groups(df, "region", "v", nulls_first=nulls_first, per_slice=2).collect()}
    assert got == want
    top = {r.region: r.rank for r in ranking.rank_groups(df, "region", "v", 3, nulls_first).collect()}
    assert top == {k: v for k, v in want.items() if v <= 3}


def test_share_and_order(spark):
    means = aggregates.mean_by(regions(spark), "region", "v")
    assert [r.region for r in means.collect()] == ["a", "b", "c", "d", "f", "e"]
    assert ranking.top_share(means).first()[0] == pytest.approx(100 * 39 / 51)


def test_seasonal_corrs_skip_small_seasons_and_bad_pairs(spark):
    data = [
        (datetime(2025, 1, 1), 1.0, 2.0), (datetime(2025, 1, 2), 2.0, 4.0), (datetime(2025, 1, 3), None, 1.0),
        (datetime(2025, 7, 1), 1.0, 1.0), (datetime(2025, 4, 1), 1.0, 1.0), (datetime(2025, 4, 2), 1.0, 2.0),
    ]
    df = spark.createDataFrame(data, "ts timestamp_ntz, x double, y double")
    got = rows(aggregates.seasonal_corrs(df, "ts", [("x", "y", "r")]), "saison")
    assert got == [("hiver", 3, 1.0), ("mi_saison", 2, None)]


def test_freshness(spark):
    stamped = spark.createDataFrame([(datetime(2025, 1, 1, 6),), (datetime(2025, 1, 1, 9, 30),)], "ts timestamp_ntz")
    dated = spark.createDataFrame([(date(2025, 1, 2),)], "d date")
    got = aggregates.freshness(
        [("s", stamped, "ts"), ("d", dated, "d"), ("none", stamped.limit(0), "ts")], F.lit(datetime(2025, 1, 1, 12))
    )
    assert {r.source: (r.lag_hours, r.empty) for r in got.collect()} == {
        "s": (2.5, False), "d": (-12.0, False), "none": (-1.0, True)}
    kinds = stamped.withColumn("kind", F.when(F.hour("ts") == 6, "early").otherwise("s"))
    by = aggregates.freshness_by(kinds, "kind", "ts", ["s", "none"], F.lit(datetime(2025, 1, 1, 12)))
    assert rows(by, "source") == [("none", -1.0, True), ("s", 2.5, False)]


def test_season_coverage(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 1),), (datetime(2025, 4, 1),)], "ts timestamp_ntz")
    c = aggregates.season_coverage(df, "ts").first()
    assert (c.months, c.winter_months, c.summer_months, c.comparable) == ([1, 4], [1], [], False)


def test_last_failure(spark):
    data = [("d", "t", 1, "failed"), ("d", "t", 5, "failed"), ("d", "u", 9, "success")]
    df = spark.createDataFrame(data, "dag string, task string, ts int, state string")
    assert rows(aggregates.last_failure(df, ["dag", "task"], "ts", F.col("state") == "failed")) == [("d", "t", 5)]


# --- quality and joins -------------------------------------------------------------------------------


def keyed(spark):
    """A hot key with a third of all rows, a NULL key twice, and unique keys."""
    data = [(1, i) for i in range(20)] + [(None, 100), (None, 101)] + [(k, k) for k in range(2, 40)]
    return spark.createDataFrame(data, "k int, i int")


def test_duplicates(spark):
    df = keyed(spark)
    assert quality.dup_count(df, ["k"]).first()[0] == 20
    assert quality.duplicated_rows(df, ["k"]).count() == 22
    first = quality.dedupe_first(df, ["k"], ["i"])
    assert first.count() == 40 and first.filter("k = 1").first().i == 0
    assert cleaning.min_group_size(df, ["k"], 3).count() == 20
    assert quality.dup_count(df.limit(0), ["k"]).first()[0] == 0


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "c"), (None, "d")], "k int, v string")
    good, bad = enforce_constraints(df, ["v"], ["k"])
    assert rows(good) == [(3, "c")]
    assert sorted(r.reason for r in bad.collect()) == ["duplicate key", "duplicate key", "null k", "null v"]


def test_quality_gate_counts_nulls_as_failed(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "x double")
    good, counts = cleaning.quality_gate(df, {"present": F.col("x").isNotNull(), "positive": F.col("x") > 0})
    assert rows(good) == [(1.0,)]
    assert dict(rows(counts)) == {"present": 1, "positive": 2}


def test_join_on_measure_counts_pairs(spark):
    a = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (None,)], "m double")
    b = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (None,)], "m double")
    assert rows(joining.join_on_measure(a, b, "m")) == [(1.0, 2, 3, 6)]


def test_missing_and_gaps(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, "x")], "a double, b string")
    assert rows(quality.missing_rates(df, digits=1), "column") == [("a", 1, 33.3), ("b", 2, 66.7)]


# --- series and windows ------------------------------------------------------------------------------


def test_resample_and_gap_ranges_over_a_month_end(spark):
    data = [
        (datetime(2025, 1, 31, 21, 10), 1.0), (datetime(2025, 1, 31, 21, 50), 3.0), (datetime(2025, 2, 1, 2, 0), 5.0),
        (datetime(2025, 2, 1, 4, 0), None), (datetime(2025, 2, 1, 5, 0), 7.0), (None, 1.0),
    ]
    df = spark.createDataFrame(data, "ts timestamp_ntz, v double")
    s = series.resample(df, "ts", "v")
    got = rows(s, "ts")
    assert len(got) == 9 and got[0] == (datetime(2025, 1, 31, 21), 2.0)
    gaps = rows(series.gap_ranges(s, "ts", "v"), "gap_start")
    assert gaps == [
        (datetime(2025, 1, 31, 22), datetime(2025, 2, 1, 1), 4), (datetime(2025, 2, 1, 3), datetime(2025, 2, 1, 4), 2)]
    assert series.resample(df.limit(0), "ts", "v").count() == 0
    assert series.gap_ranges(s.filter("v is not null"), "ts", "v").count() == 0


def test_resample_per_key(spark):
    data = [("a", datetime(2025, 1, 1, 0), 1.0), ("a", datetime(2025, 1, 1, 0, 45), 2.0), ("b", datetime(2025, 1, 1, 5), 1.0)]
    s = series.resample(spark.createDataFrame(data, "k string, ts timestamp_ntz, v double"), "ts", "v", 900, ["k"])
    assert {k: s.filter(F.col("k") == k).count() for k in "ab"} == {"a": 4, "b": 1}
    with pytest.raises(ValueError):
        series.resample(s, "ts", "v", 7000)


def test_paris_days_over_clock_changes(spark):
    stamps = [datetime(2025, 3, 29, 23, 30), datetime(2025, 3, 30, 21, 59), datetime(2025, 10, 26, 12), datetime(2025, 1, 1)]
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")
    got = {r.ts: (r.local_day, r.day_start, r.day_end) for r in time_windows.local_day_bounds(df, "ts").collect()}
    spring = (date(2025, 3, 30), datetime(2025, 3, 29, 23), datetime(2025, 3, 30, 22))  # 23 hours
    assert got[stamps[0]] == got[stamps[1]] == spring
    assert got[stamps[2]][1:] == (datetime(2025, 10, 25, 22), datetime(2025, 10, 26, 23))  # 25 hours
    assert got[stamps[3]][1] == datetime(2024, 12, 31, 23)


def test_windows_by_anchor(spark):
    df = spark.createDataFrame([(datetime(2025, 1, d, h),) for d in range(1, 11) for h in (0, 22, 23)], "ts timestamp_ntz")
    assert time_windows.recent_window(df, "ts", 7).count() == 21
    as_of = F.lit(datetime(2025, 1, 9, 12))
    y = [r.ts for r in time_windows.recent_window(df, "ts", 2, "yesterday", as_of).orderBy("ts").collect()]
    assert (y[0], y[-1], len(y)) == (datetime(2025, 1, 6, 23), datetime(2025, 1, 8, 22), 6)
    assert time_windows.recent_window(df, "ts", 1, "now", as_of).count() == 3
    assert time_windows.recent(df, "ts", as_of, 3).count() == 15
    assert time_windows.recent_window(df.limit(0), "ts", 7).count() == 0
    with pytest.raises(ValueError):
        time_windows.recent_window(df, "ts", 7, "now")


def test_chunks(spark):
    sevens = rows(time_windows.chunk_table(spark, date(2025, 1, 1), date(2025, 1, 16), 7), "chunk")
    assert [r[1:] for r in sevens] == [
        (date(2025, 1, 1), date(2025, 1, 8), 7), (date(2025, 1, 8), date(2025, 1, 15), 7), (date(2025, 1, 15), date(2025, 1, 17), 2)]
    assert time_windows.chunk_table(spark, date(2025, 1, 1), date(2025, 1, 16), 7, drop_short=True).count() == 2
    months = rows(time_windows.chunk_table(spark, date(2024, 12, 10), date(2025, 2, 3), "month"), "chunk")
    assert [r[1:] for r in months] == [
        (date(2024, 12, 10), date(2025, 1, 1), 22), (date(2025, 1, 1), date(2025, 2, 1), 31), (date(2025, 2, 1), date(2025, 2, 4), 3)]


def test_coverage_counts_the_last_day_of_a_month(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 31, 23, 59),), (datetime(2025, 2, 1),), (datetime(2025, 3, 1),)], "ts timestamp_ntz")
    got = time_windows.chunk_coverage(df, "ts", date(2025, 1, 1), date(2025, 2, 28), "month", 1)
    assert [(r.rows, r.expected, r.complete) for r in got.orderBy("chunk").collect()] == [(1, 31, False), (1, 28, False)]


# --- upsert and storage ------------------------------------------------------------------------------


TARGET = "k int, a string, b string"
BATCH = "k int, a string, b string, seq int"


def test_upsert_semantics(spark):
    target = spark.createDataFrame([(1, "t1", "t1"), (2, "t2", "t2")], TARGET)
    batch = spark.createDataFrame([(1, "x", "x", 2), (1, None, "y", 3), (3, "p", "p", 1), (3, "q", "q", 9)], BATCH)
    got = rows(upsert(target, batch, ["k"], ["a"], "seq"), "k")
    assert got == [(1, None, "t1"), (2, "t2", "t2"), (3, "q", "p")]
    full = rows(upsert(target, batch, ["k"], ["a", "b"], "seq"), "k")
    assert full == [(1, None, "y"), (2, "t2", "t2"), (3, "q", "q")]


def test_upsert_is_idempotent_and_splits(spark):
    target = spark.createDataFrame([(i, f"t{i}", f"t{i}") for i in range(5)], TARGET)
    data = [(i % 7, f"a{i}", f"b{i}", i) for i in range(30)]
    whole = spark.createDataFrame(data, BATCH)
    one, two = spark.createDataFrame(data[:13], BATCH), spark.createDataFrame(data[13:], BATCH)
    once = upsert(target, whole, ["k"], ["a"], "seq")
    assert rows(upsert(once, whole, ["k"], ["a"], "seq"), "k") == rows(once, "k")
    in_two = upsert(upsert(target, one, ["k"], ["a"], "seq"), two, ["k"], ["a"], "seq")
    assert rows(in_two, "k") == rows(once, "k")


def test_stored_upsert_touches_only_its_partitions_and_survives_a_replay(spark, tmp_path):
    path, staging = f"{tmp_path}/t", f"{tmp_path}/staging"
    schema = "p string, k int, a string, b string, seq int"

    def load(number, data):
        batch = spark.createDataFrame(data, schema)
        upsert_partitions(spark, path, batch, ["p", "k"], ["a"], "seq", "p", number, staging)

    def table():
        return sorted(tuple(r) for r in spark.read.schema("p string, k int, a string, b string").parquet(path).select("p", "k", "a", "b").collect())

    def files(part):
        return sorted(f.name for f in (tmp_path / "t" / f"p={part}").glob("*.parquet"))

    load(0, [("x", 1, "a", "b", 0), ("y", 1, "a", "b", 0)])
    untouched = files("y")
    load(1, [("x", 1, "A", "B", 1), ("x", 2, "n", "n", 2), ("z", 5, None, "z", 3)])
    want = [("x", 1, "A", "b"), ("x", 2, "n", "n"), ("y", 1, "a", "b"), ("z", 5, None, "z")]
    assert table() == want and files("y") == untouched
    # a crash in the middle of the move: one partition is gone, the batch is run again
    for f in (tmp_path / "t" / "p=x").iterdir():
        f.unlink()
    load(1, [("x", 1, "A", "B", 1), ("x", 2, "n", "n", 2), ("z", 5, None, "z", 3)])
    assert table() == want


def test_nan_is_missing_in_every_statistic(spark):
    nan = float("nan")
    data = [(1.0, 2.0, "a"), (2.0, 4.5, "a"), (nan, 1.0, "b"), (3.0, 5.0, "b"), (4.0, nan, "b"), (5.0, 1.0, "b")]
    null = [tuple(None if v != v else v for v in r) for r in data]
    df, clean = (spark.createDataFrame(d, "x double, y double, g string") for d in (data, null))
    for stat in (
        lambda d: st.pearson_test(d, "x", "y"), lambda d: st.welch_test(d, "g", "a", "b", "x"), lambda d: st.linear_fit(d, "x", "y"),
        lambda d: st.fit_grid(d, "x", "y", 3), lambda d: st.corr_matrix(d, ["x", "y"]), lambda d: st.iqr_fences(d, "x"),
        lambda d: st.iqr_summary(d, "x"), lambda d: st.zscore_outliers(d, "x", 0.5).select("z"), lambda d: st.iqr_outliers(d, "x", 0.1).select("x"),
        lambda d: st.standardise(d, "x").select("x_z"), lambda d: st.minmax(d, "x").select("x_minmax"),
        lambda d: st.standardise_complete(d, ["x", "y"]).select("x_z", "y_z"), lambda d: st.box_stats(d, "g", "x"),
    ):
        assert sorted(map(str, stat(df).collect())) == sorted(map(str, stat(clean).collect()))
    assert {r.r for r in st.corr_matrix(df, ["x", "y"]).filter("x = y").collect()} == {1.0}
    assert st.fit_grid(clean, "x", "y", 1).count() == 1


def test_a_wide_compressed_table_gives_exact_quartiles(spark):
    df = spark.range(200_000).select((F.col("id") * 0.5).alias("x"), *[F.lit("same").alias(f"c{i}") for i in range(20)])
    fences = st.iqr_fences(df, "x", candidates=5000).first()
    assert tuple(fences) == (24999.875 - 1.5 * 49999.75, 74999.625 + 1.5 * 49999.75)


def test_gaps_cross_months_and_missing_slots_need_no_single_task(spark):
    hours = spark.range(24 * 70).select(F.timestamp_seconds(1735689600 + F.col("id") * 3600).alias("ts"), "id")
    every_second = hours.withColumn("v", F.when(F.col("id") % 2 == 0, 1.0))
    gaps = series.gap_ranges(every_second, "ts", "v")
    assert gaps.count() == 24 * 35 and gaps.filter("slots = 1").count() == 24 * 35
    long = hours.withColumn("v", F.when((F.col("id") < 700) | (F.col("id") > 1500), 1.0))
    assert [(r.slots) for r in series.gap_ranges(long, "ts", "v").collect()] == [801]


def test_numeric_keys_take_a_text_label(spark):
    df = spark.createDataFrame([(i % 5, float(i % 5)) for i in range(50)], "k int, v double")
    assert {(r.k, r["mean"]) for r in ranking.top_k_with_rest(df, "k", "v", 2, "rest").collect()} == {("4", 4.0), ("3", 3.0), ("rest", 3.0)}


def test_csv_round_trip(spark, tmp_path):
    schema = "i int, s string, d double, ts timestamp_ntz, z timestamp, day date"
    data = [
        (1, "", 0.1, datetime(2025, 1, 1, 1, 2, 3, 456789), datetime(2025, 3, 30, 2, 30), date(2025, 1, 1)),
        (2, None, None, None, None, None),
        (3, ' "q", \\ é', 1e-300, datetime(1995, 1, 1), datetime(2025, 1, 1), date(1, 1, 1)),
        (4, "two\nlines", 1.0, datetime(1995, 1, 1), datetime(2025, 1, 1), date(2025, 1, 1)),
    ]
    df = spark.createDataFrame(data, schema)
    write_csv(df, f"{tmp_path}/c")
    assert rows(read_csv(spark, f"{tmp_path}/c", df.schema, multi_line=True), "i") == rows(df, "i")
    numbers = df.select("i", "d")
    write_csv(numbers, f"{tmp_path}/n")
    assert rows(read_csv(spark, f"{tmp_path}/n", numbers.schema), "i") == rows(numbers, "i")


def test_publish_replaces(spark, tmp_path):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "i int, p string")
    assert rows(publish(first, f"{tmp_path}/t", ["p"]), "i") == [(1, "a"), (2, "b")]
    assert rows(publish(first.filter("i = 2"), f"{tmp_path}/t", ["p"]), "i") == [(2, "b")]
    bad = first.select(F.raise_error(F.lit("half way")).cast("int").alias("i"), "p")
    with pytest.raises(Exception, match="half way"):
        publish(bad, f"{tmp_path}/t", ["p"])
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "i") == [(2, "b")]  # the old table is still there
    (tmp_path / "t").rename(tmp_path / "t.old")  # a switch cut short: the next failure still leaves the old table
    with pytest.raises(Exception, match="half way"):
        publish(bad, f"{tmp_path}/t", ["p"])
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "i") == [(2, "b")]
    assert rows(publish_table(first, "published"), "i") == [(1, "a"), (2, "b")]
    assert rows(publish_table(first.limit(0), "published")) == []


def test_published_versions_are_never_absent(spark, tmp_path):
    path, table = f"{tmp_path}/t", spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, p string")
    with pytest.raises(FileNotFoundError):
        read_version(spark, path)
    assert rows(publish_version(table, path, ["p"]), "i") == rows(table, "i")
    begun = read_version(spark, path)
    bad = table.select(F.raise_error(F.lit("half way")).cast("int").alias("i"), "p")
    with pytest.raises(Exception, match="half way"):
        publish_version(bad, path)
    (tmp_path / "t" / "v000000007").mkdir()  # a version whose writer died
    assert rows(read_version(spark, path), "i") == rows(table, "i")
    publish_version(begun.filter("i > 1"), path, ["p"])  # from the table itself
    assert rows(begun, "i") == rows(table, "i")
    assert rows(read_version(spark, path), "i") == [(2, "b"), (3, None)]
    publish_version(table.limit(0), path, ["p"])
    assert read_version(spark, path, table.schema).count() == 0
    kept = sorted(p.name for p in (tmp_path / "t").iterdir())
    assert kept == ["v000000008", "v000000009"]
