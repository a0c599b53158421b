"""Statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalar import season
from gridlake.operators import gram, moments
from gridlake.operators import statistics as st
from gridlake.operators.quantiles import quantiles
from gridlake.plans import analysis
from gridlake.queries.aggregates import SEASON_SQL
from gridlake.queries.registry import Tables, presented, query
from gridlake.queries.roles import HOURLY_SQL, facts
from gridlake.sources.tables import settled

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, half_up(corr({x}, {y}), 6) AS r FROM lineitem" for x in MEASURES for y in MEASURES
)
DESCRIBE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, half_up(avg({c}), 4) AS mean, half_up(stddev_samp({c}), 4) AS std,
    min({c}) AS min, half_up(quantile_cont({c}, 0.25), 4) AS p25, half_up(quantile_cont({c}, 0.5), 4) AS p50,
    half_up(quantile_cont({c}, 0.75), 4) AS p75, max({c}) AS max FROM lineitem"""
    for c in MEASURES
)
FENCE_SQL = """q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
fence AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)"""
# Two-sided t probability by Simpson's rule on the density from 0 to |t|.
T_TAIL_SQL = """
tail AS (
  SELECT abs(t) / 4000 AS h, unnest(generate_series(0, 4000)) AS i, df,
         exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()) AS c FROM test),
area AS (
  SELECT sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
             * c * pow(1 + (i * h) * (i * h) / df, -(df + 1) / 2) * h / 3) AS half FROM tail)
"""


def study_base(t: Tables) -> DataFrame:
    """The hourly base, written once because it is read several times."""
    return settled(analysis.hourly_base(facts(t)), "hourly-base")


def box_sql(group: str, table: str, val: str, where: str = "TRUE") -> str:
    return f"""WITH d AS (SELECT {group} AS g, {val} AS v FROM {table} WHERE {where}),
    q AS (SELECT g, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
          quantile_cont(v, 0.75) AS q3 FROM d GROUP BY 1),
    f AS (SELECT d.g, n, q1, median, q3, v, v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) AS inside
          FROM d JOIN q ON d.g = q.g)
    SELECT g AS "group", n, half_up(q1, 4) AS q1, half_up(median, 4) AS median, half_up(q3, 4) AS q3,
    half_up(least(q1, min(v) FILTER (inside)), 4) AS whisker_low,
    half_up(greatest(q3, max(v) FILTER (inside)), 4) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
    FROM f GROUP BY g, n, q1, median, q3"""


# Forty columns: each measure ten times, missing on other rows each time.
WIDE = {f"{c}_{d}": (c, d) for c in MEASURES for d in range(2, 12)}
WIDE_SQL = ", ".join(f"CASE WHEN (l_orderkey + l_linenumber) % {d} <> 0 THEN {c} END AS {name}" for name, (c, d) in WIDE.items())
WIDE_PAIRS_SQL = ", ".join(
    f"{{x: '{x}', y: '{y}', n: CAST(regr_count({x}, {y}) AS BIGINT), r: corr({x}, {y})}}" for x in WIDE for y in WIDE
)


@query(f"WITH w AS (SELECT {WIDE_SQL} FROM lineitem), p AS (SELECT unnest([{WIDE_PAIRS_SQL}], recursive := true) FROM w) SELECT x, y, n, half_up(r, 6) AS r FROM p")
def corr_matrix_wide(t: Tables) -> DataFrame:
    """All pairs of forty columns with their own gaps, by Gram matrices."""
    there = {name: (F.col("l_orderkey") + F.col("l_linenumber")) % d != 0 for name, (_, d) in WIDE.items()}
    wide = t.lineitem.select(*[F.when(there[name], F.col(c)).alias(name) for name, (c, _) in WIDE.items()])
    return presented(gram.corr_matrix_wide(wide, list(WIDE)), 6)


@query(PAIRS_SQL)
def corr_matrix(t: Tables) -> DataFrame:
    return presented(st.corr_matrix(t.lineitem, MEASURES), 6)


@query(DESCRIBE_SQL)
def describe(t: Tables) -> DataFrame:
    return presented(st.describe(t.lineitem, MEASURES))


@query(DESCRIBE_SQL)
def describe_bounded(t: Tables) -> DataFrame:
    """The same by the bracket method that bounds memory per group at any size."""
    return presented(st.describe(t.lineitem, MEASURES, candidates=9000))


@query(
    """SELECT l_returnflag, count(l_extendedprice) AS n, half_up(quantile_cont(l_extendedprice, 0.05), 4) AS p05,
    half_up(quantile_cont(l_extendedprice, 0.95), 4) AS p95 FROM lineitem GROUP BY 1"""
)
def quantiles_in_rounds(t: Tables) -> DataFrame:
    """Brackets that may hold few values, so that they are narrowed more than once."""
    q = quantiles(t.lineitem, "l_extendedprice", [0.05, 0.95], ["l_returnflag"], candidates=20)
    return presented(q.select("l_returnflag", "n", F.get("q", F.lit(0)).alias("p05"), F.get("q", F.lit(1)).alias("p95")))


@query(box_sql("CAST(hour(ts) AS INTEGER)", "events", "value"))
def box_by_hour(t: Tables) -> DataFrame:
    rows = t.events.select(F.hour("ts").alias("group"), "value")
    return presented(st.box_stats(rows, "group", "value", max_groups=24))


@query(box_sql("event_type", "events", "value"))
def box_by_type_bounded(t: Tables) -> DataFrame:
    """Groups of unknown number, by the bracket method."""
    rows = t.events.select(F.col("event_type").alias("group"), "value")
    return presented(st.box_stats(rows, "group", "value", candidates=200))


@query(
    box_sql(
        SEASON_SQL.format("o_orderdate", "intersaison"), "orders", "o_totalprice", "month(o_orderdate) IN (12, 1, 2, 6, 7, 8)"
    )
)
def box_by_season(t: Tables) -> DataFrame:
    rows = t.orders.select(season("o_orderdate", "intersaison").alias("group"), "o_totalprice")
    return presented(st.box_stats(rows.filter(F.col("group") != "intersaison"), "group", "o_totalprice", max_groups=3))


@query(
    """SELECT l_returnflag, count(l_extendedprice) AS n, half_up(quantile_cont(l_extendedprice, 0.05), 4) AS p05,
    half_up(quantile_cont(l_extendedprice, 0.5), 4) AS p50, half_up(quantile_cont(l_extendedprice, 0.95), 4) AS p95
    FROM lineitem GROUP BY 1"""
)
def quantiles_by_flag(t: Tables) -> DataFrame:
    q = quantiles(t.lineitem, "l_extendedprice", [0.05, 0.5, 0.95], ["l_returnflag"])
    return presented(q.select("l_returnflag", "n", *[F.get("q", F.lit(i)).alias(c) for i, c in enumerate(("p05", "p50", "p95"))]))


PEARSON_SQL = (
    f"""WITH c AS (SELECT corr(l_discount, l_quantity) AS r, count(*) AS n FROM lineitem
      WHERE l_discount IS NOT NULL AND l_quantity IS NOT NULL),
    test AS (SELECT r, n, r * sqrt((n - 2) / (1 - r * r)) AS t, CAST(n - 2 AS DOUBLE) AS df FROM c), {T_TAIL_SQL}
    SELECT half_up(r, 6) AS r, half_up(t, 4) AS t, half_up(1 - 2 * half, 6) AS p, n FROM test, area"""
)


@query(PEARSON_SQL)
def pearson_test(t: Tables) -> DataFrame:
    r = st.pearson_test(t.lineitem, "l_discount", "l_quantity")
    return r.select(F.round("r", 6).alias("r"), F.round("t", 4).alias("t"), F.round("p", 6).alias("p"), "n")


WELCH_SQL = (
    f"""WITH m AS (SELECT {SEASON_SQL.format('o_orderdate', 'intersaison')} AS s, count(o_totalprice) AS n,
      avg(o_totalprice) AS m, var_samp(o_totalprice) AS v FROM orders GROUP BY 1),
    ab AS (SELECT a.n AS n_a, b.n AS n_b, a.m AS mean_a, b.m AS mean_b, a.v / a.n AS sa, b.v / b.n AS sb
           FROM m a, m b WHERE a.s = 'hiver' AND b.s = 'ete'),
    test AS (SELECT *, (mean_a - mean_b) / sqrt(sa + sb) AS t,
             (sa + sb) * (sa + sb) / (sa * sa / (n_a - 1) + sb * sb / (n_b - 1)) AS df FROM ab), {T_TAIL_SQL}
    SELECT n_a, n_b, half_up(mean_a, 4) AS mean_a, half_up(mean_b, 4) AS mean_b, half_up(t, 4) AS t, half_up(test.df, 4) AS df,
    half_up(1 - 2 * half, 6) AS p FROM test, area"""
)


@query(WELCH_SQL)
def welch_test(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("saison", season("o_orderdate", "intersaison"))
    w = st.welch_test(rows, "saison", "hiver", "ete", "o_totalprice")
    four = [F.round(c, 4).alias(c) for c in ("mean_a", "mean_b", "t", "df")]
    return w.select("n_a", "n_b", *four, F.round("p", 6).alias("p"))


FIT_SQL = (
    """SELECT half_up(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
    half_up(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
    CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem"""
)


@query(FIT_SQL)
def linear_fit(t: Tables) -> DataFrame:
    return presented(st.linear_fit(t.lineitem, "l_quantity", "l_extendedprice"))


@query(
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b,
      min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
    g AS (SELECT unnest(generate_series(0, 49)) AS i, a, b, lo, hi FROM f)
    SELECT CAST(i AS INTEGER) AS i, half_up(lo + (hi - lo) * i / 49, 4) AS x,
    half_up(a * (lo + (hi - lo) * i / 49) + b, 2) AS y FROM g"""
)
def fit_grid(t: Tables) -> DataFrame:
    g = st.fit_grid(t.lineitem, "l_quantity", "l_extendedprice")
    return g.select("i", F.round("x", 4).alias("x"), F.round("y", 2).alias("y"))


@query(
    """WITH m AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
    SELECT event_id, value, half_up((value - m) / s, 4) AS z FROM events, m WHERE abs((value - m) / s) > 3"""
)
def zscore_outliers(t: Tables) -> DataFrame:
    return presented(st.zscore_outliers(t.events.select("event_id", "value"), "value"))


@query(
    f"""WITH {FENCE_SQL} SELECT event_id, value, half_up(lo, 4) AS low_fence, half_up(hi, 4) AS high_fence
    FROM events, fence WHERE value < lo OR value > hi"""
)
def iqr_outliers(t: Tables) -> DataFrame:
    return presented(st.iqr_outliers(t.events.select("event_id", "value"), "value"))


@query(
    f"""WITH {FENCE_SQL} SELECT event_id, value, half_up(lo, 4) AS low_fence, half_up(hi, 4) AS high_fence
    FROM events, fence WHERE value < lo OR value > hi"""
)
def iqr_outliers_bounded(t: Tables) -> DataFrame:
    """The same by the bracket method."""
    return presented(st.iqr_outliers(t.events.select("event_id", "value"), "value", candidates=200))


@query(
    f"""WITH {HOURLY_SQL}, q AS (SELECT quantile_cont(consommation_mw, 0.25) AS q1, quantile_cont(consommation_mw, 0.75) AS q3 FROM base),
    fence AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
    SELECT half_up(max(lo), 4) AS low_fence, half_up(max(hi), 4) AS high_fence,
    count(*) FILTER (consommation_mw < lo OR consommation_mw > hi) AS outliers,
    half_up(100.0 * count(*) FILTER (consommation_mw < lo OR consommation_mw > hi) / count(*), 4) AS outlier_pct FROM base, fence"""
)
def iqr_share(t: Tables) -> DataFrame:
    return presented(st.iqr_summary(study_base(t), "consommation_mw"))


@query(
    f"""WITH {FENCE_SQL} SELECT event_id, value FROM events, fence WHERE value < lo OR value > hi
    ORDER BY value DESC, event_id LIMIT 10"""
)
def top_outliers(t: Tables) -> DataFrame:
    return st.top_outliers(t.events.select("event_id", "value"), "value", 10, "event_id")


IQR_COLUMNS = ["consommation_mw", "temperature_c", "prix_eur_mwh"]


@query(
    f"WITH {HOURLY_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers,
        count({c}) AS non_null FROM base,
        (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM base) AS q"""
        for c in IQR_COLUMNS
    )
)
def iqr_multi(t: Tables) -> DataFrame:
    return st.iqr_counts(study_base(t), IQR_COLUMNS)


@query(
    """WITH m AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
    SELECT event_id, value, half_up((value - m) / s, 4) AS value_z FROM events, m"""
)
def standardise_sample(t: Tables) -> DataFrame:
    return presented(st.standardise(t.events.select("event_id", "value"), "value"))


@query(
    f"""WITH {HOURLY_SQL}, c AS (SELECT * FROM base WHERE consommation_mw IS NOT NULL AND prix_eur_mwh IS NOT NULL),
    m AS (SELECT avg(consommation_mw) AS m1, stddev_pop(consommation_mw) AS s1, avg(prix_eur_mwh) AS m2,
          stddev_pop(prix_eur_mwh) AS s2 FROM c)
    SELECT date_heure,
    CASE WHEN consommation_mw IS NOT NULL AND prix_eur_mwh IS NOT NULL THEN half_up((consommation_mw - m1) / s1, 4) END AS consommation_mw_z,
    CASE WHEN consommation_mw IS NOT NULL AND prix_eur_mwh IS NOT NULL THEN half_up((prix_eur_mwh - m2) / s2, 4) END AS prix_eur_mwh_z
    FROM base, m"""
)
def standardise_pop(t: Tables) -> DataFrame:
    scaled = st.standardise_complete(study_base(t), ["consommation_mw", "prix_eur_mwh"])
    return presented(scaled.select("date_heure", "consommation_mw_z", "prix_eur_mwh_z"))


@query(
    """WITH m AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
    SELECT event_id, half_up((value - lo) / (hi - lo), 6) AS value_minmax FROM events, m"""
)
def minmax(t: Tables) -> DataFrame:
    return presented(st.minmax(t.events.select("event_id", "value"), "value").select("event_id", "value_minmax"), 6)


# One value in five is NaN, as valid_pairs has it; the SQL side has NULL there.
NAN_ROWS = "rows AS (SELECT event_id, event_type, CASE WHEN event_id % 5 <> 0 THEN value END AS x, CAST(user_id AS DOUBLE) AS y FROM events)"


def with_nan(t: Tables) -> DataFrame:
    x = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return t.events.select("event_id", "event_type", x.alias("x"), F.col("user_id").cast("double").alias("y"))


@query(f"WITH {NAN_ROWS} SELECT half_up(corr(x, y), 6) AS r, count(x) AS n FROM rows")
def pearson_nan(t: Tables) -> DataFrame:
    return presented(st.pearson_test(with_nan(t), "x", "y").select("r", "n"), 6)


@query(
    f"""WITH {NAN_ROWS}, m AS (SELECT avg(x) AS a, stddev_samp(x) AS s FROM rows)
    SELECT event_id, half_up((x - a) / s, 4) AS z FROM rows, m WHERE abs((x - a) / s) > 1.5"""
)
def zscore_outliers_nan(t: Tables) -> DataFrame:
    return presented(st.zscore_outliers(with_nan(t), "x", 1.5).select("event_id", "z"))


@query(
    f"""WITH {NAN_ROWS}, q AS (SELECT quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.75) AS b FROM rows)
    SELECT event_id FROM rows, q WHERE x < a - 0.2 * (b - a) OR x > b + 0.2 * (b - a)"""
)
def iqr_outliers_nan(t: Tables) -> DataFrame:
    return st.iqr_outliers(with_nan(t), "x", 0.2).select("event_id")


@query(
    f"""WITH {NAN_ROWS} SELECT * FROM (
      SELECT 'x' AS x, 'x' AS y, 1.0::DOUBLE AS r UNION ALL SELECT 'y', 'y', 1.0
      UNION ALL SELECT 'x', 'y', half_up(corr(x, y), 6) FROM rows UNION ALL SELECT 'y', 'x', half_up(corr(x, y), 6) FROM rows)"""
)
def corr_matrix_nan(t: Tables) -> DataFrame:
    return presented(st.corr_matrix(with_nan(t), ["x", "y"]), 6)


@query(
    f"""WITH {NAN_ROWS}, m AS (SELECT avg(x) AS a, stddev_pop(x) AS s, avg(y) AS b, stddev_pop(y) AS u FROM rows WHERE x IS NOT NULL)
    SELECT event_id, half_up((x - a) / s, 4) AS x_z, CASE WHEN x IS NOT NULL THEN half_up((y - b) / u, 4) END AS y_z FROM rows, m"""
)
def standardise_nan(t: Tables) -> DataFrame:
    return presented(st.standardise_complete(with_nan(t), ["x", "y"]).select("event_id", "x_z", "y_z"))


def lineitem_states(t: Tables) -> DataFrame:
    """Stored states per month of shipping, for three pairs of measures."""
    rows = t.lineitem.withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    pairs = [("l_discount", "l_quantity", "discount"), ("l_quantity", "l_extendedprice", "price"), ("l_tax", "l_extendedprice", "tax")]
    return settled(moments.pair_states(rows, pairs, ["month"]), "states")


@query(PEARSON_SQL)
def merged_pearson(t: Tables) -> DataFrame:
    """The test over the whole history, from the states of its months."""
    merged = moments.merge_states(lineitem_states(t).filter("pair = 'discount'"), ["month"])
    r = moments.state_tests(merged)
    return r.select(F.round("r", 6).alias("r"), F.round("t", 4).alias("t"), F.round("p", 6).alias("p"), "n")


@query(FIT_SQL)
def merged_fit(t: Tables) -> DataFrame:
    merged = moments.merge_states(lineitem_states(t).filter("pair = 'price'"), ["month"])
    return presented(moments.state_fits(merged).drop("pair"))


@query(WELCH_SQL)
def merged_welch(t: Tables) -> DataFrame:
    rows = t.orders.select(
        season("o_orderdate", "intersaison").alias("saison"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_totalprice"
    )
    states = settled(moments.pair_states(rows, [("o_totalprice", "o_totalprice", "price")], ["month", "saison"]), "states")
    w = moments.state_welch(moments.merge_states(states, ["month"], ["saison"]), "saison", "hiver", "ete")
    four = [F.round(c, 4).alias(c) for c in ("mean_a", "mean_b", "t", "df")]
    return w.select("n_a", "n_b", *four, F.round("p", 6).alias("p"))


@query(
    """WITH d AS (SELECT year(l_shipdate) AS year, l_discount, l_quantity, l_extendedprice, l_tax FROM lineitem)
    SELECT CAST(year AS VARCHAR) AS year, 'discount' AS pair, half_up(corr(l_discount, l_quantity), 6) AS r, count(*) AS n FROM d GROUP BY 1
    UNION ALL SELECT CAST(year AS VARCHAR), 'price', half_up(corr(l_quantity, l_extendedprice), 6), count(*) FROM d GROUP BY 1
    UNION ALL SELECT CAST(year AS VARCHAR), 'tax', half_up(corr(l_tax, l_extendedprice), 6), count(*) FROM d GROUP BY 1"""
)
def merged_correlations(t: Tables) -> DataFrame:
    """Correlations of each year, from the states of its months."""
    states = lineitem_states(t).withColumn("year", F.substring("month", 1, 4))
    return presented(moments.state_corrs(moments.merge_states(states, ["month"], ["year"])), 6)
