"""The six facts, derived from the given tables so that every layer can run on them.

Consumption, weather, price and mix come from `events`; regional consumption from orders by the customer's
nation. The SQL forms below are the same derivations for the comparison engine.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalar import truncate
from gridlake.operators.series import floor_every
from gridlake.operators.web import page_meta
from gridlake.queries.registry import Tables
from gridlake.sources.tables import Layer


def value_of(kind: str) -> Column:
    return F.when(F.col("event_type") == kind, F.col("value"))


def props_k(col: str = "props") -> Column:
    return F.get_json_object(col, "$.k")


def customer_nation(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("region"), F.col("n_nationkey").cast("string").alias("code_insee_region")
    )


def fact_consommation(t: Tables) -> DataFrame:
    events = t.events.filter(F.col("event_type").isin("purchase", "signup"))
    kind = F.when(F.col("event_type") == "purchase", "REALISED").otherwise("ID")
    rows = events.groupBy(floor_every(events, "ts", 900).alias("start_date"), kind.alias("type")).agg(
        F.max("ts").alias("updated_date"), F.avg("value").alias("value_mw")
    )
    end = F.col("start_date") + F.expr("INTERVAL 15 MINUTES")
    return rows.select("start_date", end.alias("end_date"), "updated_date", "value_mw", "type")


def fact_meteoid(t: Tables) -> DataFrame:
    views = t.events.filter(F.col("event_type") == "view")
    placed = views.join(customer_nation(t), F.col("user_id") == F.col("c_custkey"))
    return placed.groupBy(truncate(placed, "ts", "hour").alias("date_heure"), "region").agg(
        F.avg("value").alias("temperature_2m"),
        F.avg(props_k().cast("double")).alias("windspeed_10m"),
        F.max("value").alias("cloud_cover_total"),
    )


def fact_prix_marche(t: Tables) -> DataFrame:
    """Price per hour; NULL where a single click is all there is."""
    clicks = t.events.filter(F.col("event_type") == "click")
    return clicks.groupBy(truncate(clicks, "ts", "hour").alias("date_heure")).agg(
        F.when(F.count("*") > 1, F.avg("value")).alias("prix_eur_mwh")
    )


def fact_consommation_regionale(t: Tables) -> DataFrame:
    """Order value per day and nation; consolidated when every order of the day is final."""
    placed = t.orders.join(customer_nation(t), F.col("o_custkey") == F.col("c_custkey"))
    return placed.groupBy(F.col("o_orderdate").alias("date_heure"), "region", "code_insee_region").agg(
        F.sum("o_totalprice").alias("consommation_brute_electricite_mw"),
        F.when(F.bool_and(F.col("o_orderstatus") == "F"), "Consolidé").otherwise("Temps réel").alias("statut_rte"),
    )


def fact_eco2mix(t: Tables) -> DataFrame:
    events = t.events
    return events.groupBy(floor_every(events, "ts", 900).alias("date_heure")).agg(
        F.coalesce(F.sum(value_of("purchase")), F.lit(0.0)).alias("consommation"),
        F.avg(value_of("view")).alias("nucleaire"),
        F.avg(value_of("click")).alias("eolien"),
        F.avg(value_of("signup")).alias("solaire"),
        F.avg(value_of("error")).alias("hydraulique"),
        F.max("value").alias("gaz"),
        F.min("value").alias("charbon"),
        F.max(value_of("click")).alias("fioul"),
        F.avg("value").alias("bioenergies"),
        F.min(value_of("view")).alias("pompage"),
        (F.avg(value_of("signup")) - F.avg(value_of("purchase"))).alias("ech_physiques"),
        (F.avg(value_of("error")) - 20).alias("taux_co2"),
    )


def fact_actualites(t: Tables) -> DataFrame:
    return page_meta(t.pages, "url", "html", F.lit("2024-02-01").cast("date"), title_fallback=True)


FACT_BUILDERS = {
    f.__name__: f
    for f in (
        fact_consommation, fact_meteoid, fact_prix_marche, fact_consommation_regionale, fact_actualites, fact_eco2mix
    )
}


def facts(t: Tables) -> Layer:
    return Layer({}, {name: partial(lambda build, _: build(t), build) for name, build in FACT_BUILDERS.items()})


CONSO_SQL = """
fact_consommation AS (
  SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS start_date,
         time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS end_date,
         max(ts) AS updated_date, avg(value) AS value_mw,
         CASE WHEN event_type = 'purchase' THEN 'REALISED' ELSE 'ID' END AS type
  FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY 1, 2, 5),
national AS (SELECT start_date AS date_heure, value_mw AS consommation_mw FROM fact_consommation WHERE type = 'REALISED')
"""
WEATHER_SQL = """
fact_meteoid AS (
  SELECT date_trunc('hour', ts) AS date_heure, n_name AS region, avg(value) AS temperature_2m,
         avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS windspeed_10m, max(value) AS cloud_cover_total
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE event_type = 'view' GROUP BY 1, 2),
weather AS (
  SELECT date_heure, half_up(avg(temperature_2m), 2) AS temperature_moyenne_nationale,
         half_up(avg(windspeed_10m), 2) AS vent_moyen_national
  FROM fact_meteoid GROUP BY 1)
"""
PRICE_SQL = """
fact_prix_marche AS (
  SELECT date_trunc('hour', ts) AS date_heure, CASE WHEN count(*) > 1 THEN avg(value) END AS prix_eur_mwh
  FROM events WHERE event_type = 'click' GROUP BY 1),
price AS (SELECT * FROM fact_prix_marche WHERE prix_eur_mwh IS NOT NULL)
"""
REGIONAL_SQL = """
fact_regional AS (
  SELECT o_orderdate AS date_heure, n_name AS region, CAST(n_nationkey AS VARCHAR) AS code_insee_region,
         sum(o_totalprice) AS consommation_mw,
         CASE WHEN bool_and(o_orderstatus = 'F') THEN 'Consolidé' ELSE 'Temps réel' END AS statut_rte
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3),
regional AS (SELECT date_heure, region, code_insee_region, consommation_mw FROM fact_regional
             WHERE statut_rte = 'Consolidé')
"""
MIX_SQL = """
fact_eco2mix AS (
  SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS date_heure,
         coalesce(sum(value) FILTER (event_type = 'purchase'), 0) AS consommation,
         avg(value) FILTER (event_type = 'view') AS nucleaire, avg(value) FILTER (event_type = 'click') AS eolien,
         avg(value) FILTER (event_type = 'signup') AS solaire, avg(value) FILTER (event_type = 'error') AS hydraulique,
         max(value) AS gaz, min(value) AS charbon, max(value) FILTER (event_type = 'click') AS fioul,
         avg(value) AS bioenergies, min(value) FILTER (event_type = 'view') AS pompage,
         avg(value) FILTER (event_type = 'signup') - avg(value) FILTER (event_type = 'purchase') AS ech_physiques,
         avg(value) FILTER (event_type = 'error') - 20 AS taux_co2
  FROM events GROUP BY 1),
mix AS (SELECT * FROM fact_eco2mix WHERE taux_co2 IS NOT NULL AND taux_co2 >= 0 AND consommation IS NOT NULL
        AND consommation > 0)
"""
JOINED_SQL = f"""{CONSO_SQL}, {WEATHER_SQL}, {PRICE_SQL}, {MIX_SQL},
joined AS (
  SELECT c.date_heure, c.consommation_mw, w.temperature_moyenne_nationale, w.vent_moyen_national, p.prix_eur_mwh,
         e.taux_co2, e.nucleaire, e.eolien, e.solaire, e.hydraulique, e.gaz, e.charbon, e.fioul, e.bioenergies,
         e.ech_physiques
  FROM national c LEFT JOIN weather w ON date_trunc('hour', c.date_heure) = w.date_heure
  LEFT JOIN price p ON c.date_heure = p.date_heure LEFT JOIN mix e ON c.date_heure = e.date_heure)
"""
HOURLY_SQL = f"""{CONSO_SQL}, {WEATHER_SQL}, {PRICE_SQL},
hourly_means AS (SELECT date_trunc('hour', date_heure) AS date_heure, avg(consommation_mw) AS consommation_mw
                 FROM national GROUP BY 1),
hourly_spine AS (SELECT unnest(generate_series(min(date_heure), max(date_heure), INTERVAL 1 HOUR)) AS date_heure
                 FROM hourly_means),
weather_hour AS (SELECT date_heure, avg(temperature_2m) AS temperature_c FROM fact_meteoid GROUP BY 1),
base AS (SELECT date_heure, consommation_mw, temperature_c, prix_eur_mwh
         FROM hourly_spine LEFT JOIN hourly_means USING (date_heure) LEFT JOIN weather_hour USING (date_heure)
         LEFT JOIN fact_prix_marche USING (date_heure))
"""


def rounded(*cols: str, digits: int = 4) -> str:
    return ", ".join(f"half_up({c}, {digits}) AS {c}" for c in cols)
