"""NaN as missing in the plain aggregates: every fifth value is NaN, which the SQL writes as NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators import aggregates, ranking, series
from gridlake.queries.aggregates import SEASON_SQL
from gridlake.queries.registry import Tables, presented, query

ROWS = "rows AS (SELECT event_id, event_type, user_id, ts, CASE WHEN event_id % 5 <> 0 AND event_type <> 'error' THEN value END AS x FROM events)"


def rows(t: Tables) -> DataFrame:
    """Errors have no value at all, so one group's mean is missing."""
    x = F.when((F.col("event_id") % 5 == 0) | (F.col("event_type") == "error"), F.lit(float("nan"))).otherwise(F.col("value"))
    return t.events.select("event_id", "event_type", "user_id", "ts", x.alias("x"))


@query(f"WITH {ROWS} SELECT event_type, half_up(avg(x), 4) AS mean FROM rows GROUP BY 1")
def mean_by_nan(t: Tables) -> DataFrame:
    return presented(aggregates.mean_by(rows(t), "event_type", "x"))


@query(f"WITH {ROWS} SELECT event_type, half_up(avg(x), 2) AS m FROM rows GROUP BY 1")
def mean_over_groups_nan(t: Tables) -> DataFrame:
    return aggregates.mean_over_groups(rows(t), "event_type", {"x": "m"}, 2)


@query(f"WITH {ROWS} SELECT min(x) AS min, half_up(avg(x), 4) AS mean, max(x) AS max FROM rows")
def kpis_nan(t: Tables) -> DataFrame:
    return presented(aggregates.kpis(rows(t), "x"))


@query(f"WITH {ROWS} SELECT CAST(hour(ts) AS INTEGER) AS hour, half_up(avg(x), 4) AS mean, count(x) AS n FROM rows GROUP BY 1")
def profile_nan(t: Tables) -> DataFrame:
    return presented(aggregates.profile(rows(t), "ts", "x", "hour"))


@query(
    f"WITH {ROWS} SELECT {SEASON_SQL.format('ts', 'intersaison')} AS season, count(x) AS n, half_up(avg(x), 0) AS mean FROM rows "
    f"WHERE x IS NOT NULL GROUP BY 1 HAVING season IN ('hiver', 'ete')"
)
def season_table_nan(t: Tables) -> DataFrame:
    return aggregates.season_table(rows(t), "ts", "x")


@query(f"WITH {ROWS} SELECT half_up(avg(x), 3) AS x_mean FROM rows")
def mean_mix_nan(t: Tables) -> DataFrame:
    return aggregates.mean_mix(rows(t), {"x": 3})


@query(
    f"""WITH {ROWS}, m AS (SELECT event_type, avg(x) AS mean, rank() OVER (ORDER BY avg(x) DESC NULLS LAST) AS place FROM rows GROUP BY 1)
    SELECT CASE WHEN place <= 2 THEN event_type ELSE 'rest' END AS event_type, half_up(sum(mean), 0) AS mean FROM m GROUP BY 1"""
)
def top_k_with_rest_nan(t: Tables) -> DataFrame:
    return ranking.top_k_with_rest(rows(t), "event_type", "x", 2, "rest", nulls_first=False)


@query(
    f"""WITH {ROWS}, m AS (SELECT event_type, avg(x) AS mean FROM rows GROUP BY 1)
    SELECT event_type, half_up(mean, 4) AS mean, CAST(rank() OVER (ORDER BY mean DESC NULLS LAST) AS INTEGER) AS rank FROM m"""
)
def rank_groups_nan(t: Tables) -> DataFrame:
    return presented(ranking.rank_groups(rows(t), "event_type", "x", nulls_first=False))


@query(f"WITH {ROWS} SELECT event_id, x FROM rows ORDER BY x DESC NULLS LAST, event_id LIMIT 10")
def top_k_nan(t: Tables) -> DataFrame:
    return ranking.top_k(rows(t).select("event_id", "x"), "x", 10, "event_id")


@query(
    f"""WITH {ROWS}, h AS (SELECT date_trunc('hour', ts) AS ts, avg(x) AS x FROM rows GROUP BY 1),
    s AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM h)
    SELECT ts, half_up(x, 4) AS x FROM s LEFT JOIN h USING (ts)"""
)
def resample_nan(t: Tables) -> DataFrame:
    return presented(series.resample(rows(t), "ts", "x"))
