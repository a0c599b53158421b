"""Aggregates, rankings and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalar import season
from gridlake.operators import aggregates, ranking
from gridlake.operators.cleaning import min_group_size
from gridlake.operators.joining import join_on_measure
from gridlake.queries.registry import Tables, presented, query

SEASON_SQL = """CASE WHEN month({0}) IN (12, 1, 2) THEN 'hiver' WHEN month({0}) IN (6, 7, 8) THEN 'ete' ELSE '{1}' END"""
PLACED_SQL = """placed AS (SELECT n_name AS region, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F'),
means AS (SELECT region, avg(o_totalprice) AS mean FROM placed GROUP BY 1)"""


def placed(t: Tables) -> DataFrame:
    """Final orders with the customer's nation as region."""
    orders = t.orders.filter(F.col("o_orderstatus") == "F")
    located = orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return located.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("region"), "o_totalprice"
    )


@query(f"WITH {PLACED_SQL} SELECT region, half_up(mean, 4) AS mean FROM means")
def region_rank(t: Tables) -> DataFrame:
    return presented(aggregates.mean_by(placed(t), "region", "o_totalprice"))


@query(
    f"""WITH {PLACED_SQL}, ranked AS (SELECT region, mean, rank() OVER (ORDER BY mean DESC) AS rang FROM means)
    SELECT CASE WHEN rang <= 3 THEN region ELSE 'Autres régions' END AS region,
    half_up(sum(mean), 0) AS mean FROM ranked GROUP BY 1"""
)
def regions_key(t: Tables) -> DataFrame:
    return ranking.top_k_with_rest(placed(t), "region", "o_totalprice")


@query(
    f"""WITH {PLACED_SQL}, r AS (SELECT region, half_up(mean, 0) AS mean FROM means),
    ranked AS (SELECT region, mean, row_number() OVER (ORDER BY mean DESC, region) AS rang FROM r)
    SELECT CASE WHEN rang <= 3 THEN region ELSE 'Autres régions (cumulé)' END AS region, sum(mean) AS mean
    FROM ranked GROUP BY 1"""
)
def regions_key_exact(t: Tables) -> DataFrame:
    return ranking.top_k_with_rest(
        placed(t), "region", "o_totalprice", 3, "Autres régions (cumulé)", ties=False, round_means=True
    )


@query(
    f"""WITH {PLACED_SQL}, ranked AS (SELECT mean, row_number() OVER (ORDER BY mean DESC, region) AS rang FROM means)
    SELECT half_up(100 * sum(mean) FILTER (rang <= 3) / sum(mean), 4) AS share_pct FROM ranked"""
)
def regions_share(t: Tables) -> DataFrame:
    return presented(ranking.top_share(aggregates.mean_by(placed(t), "region", "o_totalprice", order=None)))


@query(
    """WITH m AS (SELECT o_custkey, avg(o_totalprice) AS mean FROM orders GROUP BY 1)
    SELECT o_custkey, half_up(mean, 2) AS mean, CAST(rank() OVER (ORDER BY mean DESC) AS INTEGER) AS rank FROM m"""
)
def customer_ranks(t: Tables) -> DataFrame:
    """Rank of every customer by mean order value, without one task that sees them all."""
    return presented(ranking.rank_groups(t.orders, "o_custkey", "o_totalprice"), 2)


@query(
    """WITH m AS (SELECT o_custkey, avg(o_totalprice) AS mean FROM orders GROUP BY 1),
    r AS (SELECT o_custkey, mean, CAST(rank() OVER (ORDER BY mean DESC) AS INTEGER) AS rank FROM m)
    SELECT o_custkey, half_up(mean, 2) AS mean, rank FROM r WHERE rank <= 20"""
)
def customer_top_ranks(t: Tables) -> DataFrame:
    return presented(ranking.rank_groups(t.orders, "o_custkey", "o_totalprice", k=20), 2)


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_peaks(t: Tables) -> DataFrame:
    return ranking.top_k(t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"), "o_totalprice", 10, "o_orderkey")


@query(
    f"""SELECT {SEASON_SQL.format('o_orderdate', 'intersaison')} AS season, count(*) AS n,
    half_up(avg(o_totalprice), 0) AS mean FROM orders GROUP BY 1 HAVING count(*) >= 2"""
)
def season_profile(t: Tables) -> DataFrame:
    return aggregates.season_table(t.orders, "o_orderdate", "o_totalprice", ("hiver", "ete", "intersaison")).filter("n >= 2")


@query(
    f"""WITH s AS (SELECT {SEASON_SQL.format('l_shipdate', 'mi_saison')} AS saison, * FROM lineitem)
    SELECT saison, count(*) AS nb_lignes, half_up(corr(l_quantity, l_extendedprice), 3) AS r_quantity_price,
    half_up(corr(l_discount, l_quantity), 3) AS r_discount_quantity FROM s GROUP BY 1"""
)
def season_correlations(t: Tables) -> DataFrame:
    pairs = [
        ("l_quantity", "l_extendedprice", "r_quantity_price"),
        ("l_discount", "l_quantity", "r_discount_quantity"),
    ]
    return aggregates.seasonal_corrs(t.lineitem, "l_shipdate", pairs)


@query(
    f"""WITH s AS (SELECT {SEASON_SQL.format("l_shipdate::TIMESTAMPTZ AT TIME ZONE 'Europe/Paris'", 'mi_saison')} AS saison FROM lineitem)
    SELECT saison, count(*) AS nb_lignes FROM s GROUP BY 1"""
)
def season_counts_paris(t: Tables) -> DataFrame:
    """Seasons by the Paris calendar instead of UTC."""
    return aggregates.seasonal_corrs(t.lineitem, "l_shipdate", [], tz="Europe/Paris")


@query(
    """SELECT CAST(hour(ts) AS INTEGER) AS hour, half_up(avg(value), 4) AS mean, count(value) AS n FROM events GROUP BY 1"""
)
def hourly_profile(t: Tables) -> DataFrame:
    return presented(aggregates.profile(t.events, "ts", "value", "hour"))


@query(
    """SELECT CAST(month(o_orderdate) AS INTEGER) AS month, half_up(avg(o_totalprice), 4) AS mean,
    count(o_totalprice) AS n FROM orders GROUP BY 1"""
)
def month_profile(t: Tables) -> DataFrame:
    return presented(aggregates.profile(t.orders, "o_orderdate", "o_totalprice", "month"))


@query("SELECT min(o_totalprice) AS min, half_up(avg(o_totalprice), 4) AS mean, max(o_totalprice) AS max FROM orders")
def kpis(t: Tables) -> DataFrame:
    return presented(aggregates.kpis(t.orders, "o_totalprice"))


@query("SELECT min(l_shipdate) AS first, max(l_shipdate) AS last FROM lineitem")
def period(t: Tables) -> DataFrame:
    return aggregates.period(t.lineitem, "l_shipdate")


@query("SELECT max(ts) AS latest FROM events")
def latest(t: Tables) -> DataFrame:
    return aggregates.latest(t.events, "ts")


@query(
    """WITH m AS (SELECT max(ts) AS as_of FROM events),
    s AS (SELECT event_type AS source, max(ts) AS last FROM events GROUP BY 1
          UNION ALL SELECT 'orders', max(o_orderdate) FROM orders
          UNION ALL SELECT 'none', max(ts) FROM events WHERE event_type = 'none')
    SELECT source, coalesce(half_up((epoch_us(as_of) - epoch_us(last)) / 3600000000.0, 2), -1) AS lag_hours,
    last IS NULL AS empty FROM s, m"""
)
def freshness(t: Tables) -> DataFrame:
    as_of = aggregates.latest(t.events, "ts").select("latest").scalar()
    kinds = ["view", "click", "signup", "purchase", "error", "none"]
    orders = aggregates.freshness([("orders", t.orders, "o_orderdate")], as_of)
    return aggregates.freshness_by(t.events, "event_type", "ts", kinds, as_of).unionByName(orders)


@query(
    """SELECT event_type AS task_id, user_id, max(ts) AS last_failure FROM events WHERE event_type = 'error' GROUP BY 1, 2"""
)
def last_failure(t: Tables) -> DataFrame:
    events = t.events.withColumnRenamed("event_type", "task_id")
    return aggregates.last_failure(events, ["task_id", "user_id"], "ts", F.col("task_id") == "error")


@query(
    """WITH m AS (SELECT DISTINCT month(o_orderdate) AS m FROM orders)
    SELECT string_agg(m::VARCHAR, ',' ORDER BY m) AS months,
    string_agg(m::VARCHAR, ',' ORDER BY m) FILTER (m IN (12, 1, 2)) AS winter_months,
    string_agg(m::VARCHAR, ',' ORDER BY m) FILTER (m IN (6, 7, 8)) AS summer_months,
    count(*) FILTER (m IN (12, 1, 2)) > 0 AND count(*) FILTER (m IN (6, 7, 8)) > 0 AS comparable FROM m"""
)
def season_coverage(t: Tables) -> DataFrame:
    found = aggregates.season_coverage(t.orders, "o_orderdate")
    lists = ("months", "winter_months", "summer_months")
    return found.select(*[F.concat_ws(",", F.col(c).cast("array<string>")).alias(c) for c in lists], "comparable")


@query(
    """WITH a AS (SELECT half_up(value, 0) AS value, count(*) AS n_left FROM events WHERE event_type = 'purchase' GROUP BY 1),
    b AS (SELECT half_up(value, 0) AS value, count(*) AS n_right FROM events WHERE event_type = 'view' GROUP BY 1)
    SELECT value, n_left, n_right, n_left * n_right AS pairs FROM a JOIN b USING (value)"""
)
def measure_join(t: Tables) -> DataFrame:
    def of(kind: str) -> DataFrame:
        return t.events.filter(F.col("event_type") == kind).select(F.round("value", 0).alias("value"))

    return join_on_measure(of("purchase"), of("view"), "value")


@query(
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 12)"""
)
def large_groups(t: Tables) -> DataFrame:
    return min_group_size(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], 12)


@query(
    f"SELECT o_orderkey, {SEASON_SQL.format('o_orderdate', 'mi_saison')} AS saison FROM orders"
)
def season_labels(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", season("o_orderdate").alias("saison"))
