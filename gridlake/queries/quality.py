"""Data quality, series gaps and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalar import iso_date, to_number, truncate
from gridlake.operators import cleaning, quality, series
from gridlake.plans import analysis
from gridlake.queries.registry import Tables, presented, query
from gridlake.queries.roles import HOURLY_SQL, facts, props_k

KEY_SQL = "SELECT event_id, user_id, date_trunc('hour', ts) AS hour, event_type, value FROM events"
SERIES_SQL = """p AS (SELECT date_trunc('hour', ts) AS ts, avg(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1),
s AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM p),
series AS (SELECT ts, value FROM s LEFT JOIN p USING (ts))"""
TEXT_SQL = """SELECT event_id, json_extract_string(props, '$.k') AS k,
CASE event_type WHEN 'error' THEN 'n/a' WHEN 'signup' THEN 'NaN' ELSE json_extract_string(props, '$.k') END AS reading,
value FROM events"""


def keyed(t: Tables) -> DataFrame:
    """Events by (user, hour, type), a key with repeats."""
    return t.events.select("event_id", "user_id", truncate(t.events, "ts", "hour").alias("hour"), "event_type", "value")


def readings(t: Tables) -> DataFrame:
    """Readings as text, some of them no number."""
    text = (
        F.when(F.col("event_type") == "error", "n/a").when(F.col("event_type") == "signup", "NaN").otherwise(props_k())
    )
    return t.events.select("event_id", props_k().alias("k"), text.alias("reading"), "value")


KEY = ["user_id", "hour", "event_type"]


@query(
    f"WITH {HOURLY_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing,
        half_up(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 2) AS missing_pct FROM base"""
        for c in ("date_heure", "consommation_mw", "temperature_c", "prix_eur_mwh")
    )
)
def missing_rates(t: Tables) -> DataFrame:
    return quality.missing_rates(analysis.hourly_base(facts(t)))


@query(f"WITH d AS ({KEY_SQL}) SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, hour, event_type FROM d)) AS duplicates FROM d")
def dup_count(t: Tables) -> DataFrame:
    return quality.dup_count(keyed(t), KEY)


@query(f"WITH d AS ({KEY_SQL}) SELECT * FROM d QUALIFY count(*) OVER (PARTITION BY user_id, hour, event_type) > 1")
def dup_rows(t: Tables) -> DataFrame:
    return quality.duplicated_rows(keyed(t), KEY)


@query(
    f"WITH d AS ({KEY_SQL}) SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY user_id, hour, event_type ORDER BY event_id) = 1"
)
def dedupe_first(t: Tables) -> DataFrame:
    return quality.dedupe_first(keyed(t), KEY, ["event_id"])


@query(f"WITH d AS ({KEY_SQL}) SELECT DISTINCT user_id, hour, event_type FROM d")
def distinct_rows(t: Tables) -> DataFrame:
    return quality.distinct_rows(keyed(t).select(*KEY))


@query(f"WITH {SERIES_SQL} SELECT ts, half_up(value, 4) AS value, CAST(value IS NULL AS INTEGER) AS missing FROM series")
def hourly_series(t: Tables) -> DataFrame:
    return presented(quality.missing_indicator(purchases(t), "ts", "value", keep=["value"]))


def purchases(t: Tables) -> DataFrame:
    return series.resample(t.events.filter(F.col("event_type") == "purchase"), "ts", "value")


@query(
    """WITH p AS (SELECT event_type, date_trunc('hour', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2),
    b AS (SELECT event_type, min(ts) AS lo, max(ts) AS hi FROM p GROUP BY 1),
    s AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM b)
    SELECT event_type, ts, half_up(value, 4) AS value FROM s LEFT JOIN p USING (event_type, ts)"""
)
def keyed_series(t: Tables) -> DataFrame:
    """One gap-filled series per event type."""
    return presented(series.resample(t.events, "ts", "value", keys=["event_type"]))


@query(
    f"""WITH {SERIES_SQL}, m AS (SELECT ts, ts - INTERVAL 1 HOUR * row_number() OVER (ORDER BY ts) AS run FROM series WHERE value IS NULL)
    SELECT min(ts) AS gap_start, max(ts) AS gap_end, count(*) AS slots FROM m GROUP BY run"""
)
def series_gaps(t: Tables) -> DataFrame:
    return series.gap_ranges(purchases(t), "ts", "value")


@query(
    f"WITH {SERIES_SQL} SELECT min(ts) AS first_missing, max(ts) AS last_missing, count(*) AS missing FROM series WHERE value IS NULL"
)
def gap_profile(t: Tables) -> DataFrame:
    return quality.gap_profile(purchases(t), "ts", "value")


@query(f"WITH {SERIES_SQL} SELECT date_trunc('month', ts) AS month, count(*) AS missing FROM series WHERE value IS NULL GROUP BY 1")
def gaps_per_month(t: Tables) -> DataFrame:
    return quality.gaps_per_month(purchases(t), "ts", "value")


@query(f"WITH {HOURLY_SQL} SELECT date_heure, half_up(consommation_mw, 4) AS consommation_mw FROM base WHERE consommation_mw IS NOT NULL")
def required_rows(t: Tables) -> DataFrame:
    return presented(cleaning.require(analysis.hourly_base(facts(t)), ["consommation_mw"]).select("date_heure", "consommation_mw"))


@query(
    f"""WITH {HOURLY_SQL} SELECT date_heure, half_up(temperature_c, 4) AS temperature_c, half_up(prix_eur_mwh, 4) AS prix_eur_mwh
    FROM base WHERE temperature_c IS NOT NULL AND prix_eur_mwh IS NOT NULL"""
)
def complete_cases(t: Tables) -> DataFrame:
    base = analysis.hourly_base(facts(t)).select("date_heure", "temperature_c", "prix_eur_mwh")
    return presented(cleaning.complete_cases(base, ["temperature_c", "prix_eur_mwh"]))


@query(
    f"""WITH d AS ({TEXT_SQL}) SELECT event_id, TRY_CAST(k AS DOUBLE) AS k,
    CASE WHEN isnan(TRY_CAST(reading AS DOUBLE)) THEN NULL ELSE TRY_CAST(reading AS DOUBLE) END AS reading, value FROM d"""
)
def coerce_numeric(t: Tables) -> DataFrame:
    return cleaning.coerce_numeric(readings(t), ["k", "reading", "absent"])


@query(f"WITH d AS ({TEXT_SQL}) SELECT event_id, value FROM d WHERE NOT isnan(TRY_CAST(reading AS DOUBLE)) AND TRY_CAST(reading AS DOUBLE) IS NOT NULL AND value IS NOT NULL")
def valid_pairs(t: Tables) -> DataFrame:
    rows = readings(t).select("event_id", F.col("reading").try_cast("double").alias("x"), "value")
    return cleaning.valid_pairs(rows, "x", "value").select("event_id", "value")


@query(
    """SELECT o_orderkey, coalesce(TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE),
    (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS published FROM orders"""
)
def fallback_date(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    as_of = t.orders.agg(F.to_date(F.max("o_orderdate")).alias("d")).select("d").scalar()
    return cleaning.fallback(t.orders.select("o_orderkey", iso_date(text).alias("published")), "published", as_of)


@query(
    f"""WITH d AS ({KEY_SQL}) SELECT 0 AS step, 'events' AS name, count(*) AS rows, 5 AS columns, 0::BIGINT AS lost FROM d
    UNION ALL SELECT 1, 'deduplicated', n, 5, (SELECT count(*) FROM d) - n
      FROM (SELECT count(*) AS n FROM (SELECT DISTINCT user_id, hour, event_type FROM d))
    UNION ALL SELECT 2, 'keys', n, 3, 0 FROM (SELECT count(*) AS n FROM (SELECT DISTINCT user_id, hour, event_type FROM d))"""
)
def step_audit(t: Tables) -> DataFrame:
    events = keyed(t)
    once = quality.dedupe_first(events, KEY, ["event_id"])
    return quality.step_audit([("events", events), ("deduplicated", once), ("keys", once.select(*KEY))])


@query(
    """SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'
    INTERSECT SELECT DISTINCT user_id FROM events WHERE event_type = 'error'"""
)
def intersect_values(t: Tables) -> DataFrame:
    def users(kind: str) -> DataFrame:
        return t.events.filter(F.col("event_type") == kind).select("user_id")

    return quality.intersect_values(users("purchase"), users("error"))


@query("SELECT c_nationkey AS key, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier")
def stacked(t: Tables) -> DataFrame:
    customers = cleaning.rename_project(t.customer, {"c_nationkey": "key", "c_acctbal": "balance"})
    return quality.stack(customers, cleaning.rename_project(t.supplier, {"s_nationkey": "key", "s_acctbal": "balance"}))


@query(
    """SELECT o_orderkey, date_trunc('month', o_orderdate) AS month_start, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(hour(o_orderdate) AS INTEGER) AS hour, CAST(last_day(o_orderdate) AS DATE) AS month_end,
    CAST(o_orderdate AS DATE) + 7 AS week_later,
    (o_orderdate::TIMESTAMPTZ AT TIME ZONE 'Europe/Paris') AS paris, date_diff('hour', TIMESTAMP '1995-01-01', o_orderdate) AS hours_since,
    half_up(o_totalprice, 0) AS whole, abs(o_totalprice - 250000) < 1000 AS near, greatest(o_totalprice, 100000) AS clamped,
    split_part(o_orderpriority, '-', 2) AS priority, regexp_replace(o_orderpriority, '^[0-9]-', '') AS stripped,
    regexp_matches(o_orderpriority, '^[12]') AS urgent, replace(lower(trim(o_orderpriority)), ' ', '_') AS slug,
    o_orderstatus IN ('F', 'O') AS known,
    CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'low' END AS band,
    TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS level, TRY_CAST(o_orderpriority AS DOUBLE) AS no_number,
    printf('%.1f %%', o_totalprice / 10000) AS pct FROM orders"""
)
def scalar_functions(t: Tables) -> DataFrame:
    """Every scalar the operators rely on, side by side."""
    orders = t.orders
    date, price, priority = F.col("o_orderdate"), F.col("o_totalprice"), F.col("o_orderpriority")
    return orders.select(
        "o_orderkey",
        truncate(orders, "o_orderdate", "month").alias("month_start"),
        F.month(date).alias("month"),
        F.hour(date).alias("hour"),
        F.last_day(date).alias("month_end"),
        F.date_add(date.cast("date"), 7).alias("week_later"),
        F.from_utc_timestamp(date.cast("timestamp"), "Europe/Paris").cast("timestamp_ntz").alias("paris"),
        F.timestamp_diff("HOUR", F.lit("1995-01-01").cast("timestamp_ntz"), date).alias("hours_since"),
        F.round(price, 0).alias("whole"),
        (F.abs(price - 250000) < 1000).alias("near"),
        F.greatest(price, F.lit(100000.0)).alias("clamped"),
        F.split_part(priority, F.lit("-"), F.lit(2)).alias("priority"),
        F.regexp_replace(priority, "^[0-9]-", "").alias("stripped"),
        F.rlike(priority, F.lit("^[12]")).alias("urgent"),
        F.replace(F.lower(F.trim(priority)), F.lit(" "), F.lit("_")).alias("slug"),
        F.col("o_orderstatus").isin("F", "O").alias("known"),
        F.when(price > 300000, "high").when(price > 100000, "mid").otherwise("low").alias("band"),
        F.split_part(priority, F.lit("-"), F.lit(1)).try_cast("int").alias("level"),
        to_number(priority).alias("no_number"),
        F.format_string("%.1f %%", price / 10000).alias("pct"),
    )
