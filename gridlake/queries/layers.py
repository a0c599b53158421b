"""Silver and gold tables over the derived facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators import aggregates, ranking
from gridlake.operators.cleaning import keep_status, quality_gate, rename_project
from gridlake.operators.joining import join_dim
from gridlake.operators.quality import dedupe_first
from gridlake.operators.series import resample
from gridlake.plans import analysis
from gridlake.plans.gold import gold
from gridlake.plans.silver import mix_rules, silver
from gridlake.queries.registry import Tables, presented, query
from gridlake.queries.roles import (
    CONSO_SQL,
    HOURLY_SQL,
    JOINED_SQL,
    MIX_SQL,
    PRICE_SQL,
    REGIONAL_SQL,
    WEATHER_SQL,
    fact_eco2mix,
    facts,
    rounded,
)
from gridlake.sources.schemas import MIX_SOURCES
from gridlake.sources.tables import register_layer, settled

MEASURES = ["consommation_mw", "temperature_moyenne_nationale", "vent_moyen_national", "prix_eur_mwh"]
CARBON = [*MEASURES, "taux_co2", *MIX_SOURCES, "ech_physiques"]


def silver_layer(t: Tables) -> Mapping[str, DataFrame]:
    return silver(facts(t))


def gold_layer(t: Tables) -> Mapping[str, DataFrame]:
    return gold(silver(facts(t)))


@query(
    f"""WITH {JOINED_SQL}, {REGIONAL_SQL} SELECT (SELECT count(*) FROM national) AS national, (SELECT count(*) FROM regional) AS regional,
    (SELECT count(*) FROM joined WHERE prix_eur_mwh IS NOT NULL) AS priced, (SELECT count(*) FROM mix) AS mix"""
)
def layer_by_name(t: Tables) -> DataFrame:
    """The silver tables as named views, used from SQL."""
    register_layer(silver_layer(t), "silver_")
    return t.spark.sql(
        """SELECT (SELECT count(*) FROM silver_consommation_nationale) AS national,
        (SELECT count(*) FROM silver_consommation_regionale) AS regional,
        (SELECT count(prix_eur_mwh) FROM silver_conso_meteo_prix_carbone) AS priced,
        (SELECT count(*) FROM silver_eco2mix) AS mix"""
    )


@query(
    "SELECT date_trunc('month', o_orderdate) AS month, "
    "half_up(avg(o_totalprice), 0) AS mean, "
    "half_up(max(o_totalprice), 0) AS peak, half_up(min(o_totalprice), 0) AS low "
    "FROM orders GROUP BY 1"
)
def gold_monthly(t: Tables) -> DataFrame:
    """Flagship: monthly mean, peak and low over a scan of two columns."""
    return presented(aggregates.monthly_stats(t.orders, "o_orderdate", "o_totalprice").orderBy("month"))


@query(f"WITH {CONSO_SQL} SELECT date_heure, half_up(consommation_mw, 4) AS consommation_mw FROM national")
def silver_national(t: Tables) -> DataFrame:
    return presented(silver_layer(t)["consommation_nationale"])


@query(
    f"WITH {REGIONAL_SQL} SELECT date_heure, region, code_insee_region, "
    "half_up(consommation_mw, 2) AS consommation_mw FROM regional"
)
def silver_regional(t: Tables) -> DataFrame:
    return presented(silver_layer(t)["consommation_regionale"], 2)


@query(f"WITH {WEATHER_SQL} SELECT date_heure, region, {rounded('temperature_2m', 'windspeed_10m', 'cloud_cover_total')} FROM fact_meteoid")
def silver_weather(t: Tables) -> DataFrame:
    return presented(silver_layer(t)["meteo"])


@query(f"WITH {WEATHER_SQL} SELECT * FROM weather")
def hourly_weather(t: Tables) -> DataFrame:
    return presented(silver_layer(t)["meteo_nationale"], 2)


@query(f"WITH {PRICE_SQL} SELECT date_heure, half_up(prix_eur_mwh, 4) AS prix_eur_mwh FROM price")
def silver_prices(t: Tables) -> DataFrame:
    return presented(silver_layer(t)["prix_marche"])


@query(
    f"WITH {MIX_SQL} SELECT date_heure, half_up(consommation, 4) AS consommation_eco2mix_mw, "
    f"{rounded(*MIX_SOURCES, 'taux_co2', 'ech_physiques')} FROM mix"
)
def silver_mix(t: Tables) -> DataFrame:
    return presented(silver_layer(t)["eco2mix"])


@query(f"WITH {REGIONAL_SQL} SELECT DISTINCT region, code_insee_region FROM fact_regional")
def dim_region(t: Tables) -> DataFrame:
    return silver_layer(t)["dim_region"]


@query(
    f"""WITH {MIX_SQL} SELECT unnest(['co2_present', 'co2_not_negative', 'consumption_present', 'consumption_positive']) AS rule,
    unnest([count(*) FILTER (taux_co2 IS NULL), count(*) FILTER (taux_co2 IS NULL OR taux_co2 < 0),
            count(*) FILTER (consommation IS NULL), count(*) FILTER (consommation IS NULL OR NOT consommation > 0)]) AS rejected
    FROM fact_eco2mix"""
)
def quality_rejects(t: Tables) -> DataFrame:
    return quality_gate(fact_eco2mix(t), mix_rules())[1]


@query(
    "SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem "
    "WHERE l_discount IS NOT NULL AND l_discount >= 0.01 AND l_quantity > 10"
)
def quality_gate_rows(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    rules = {
        "discount_present": F.col("l_discount").isNotNull(),
        "discount_range": F.col("l_discount") >= 0.01,
        "quantity_range": F.col("l_quantity") > 10,
    }
    return quality_gate(rows, rules)[0]


@query(
    "SELECT o_orderkey AS key, o_orderdate AS date_heure, o_totalprice AS consommation_mw FROM orders WHERE o_orderstatus = 'F'"
)
def status_projection(t: Tables) -> DataFrame:
    """A filter and a projection, both in the scan."""
    kept = keep_status(t.orders, "o_orderstatus", "F")
    return rename_project(kept, {"o_orderkey": "key", "o_orderdate": "date_heure", "o_totalprice": "consommation_mw"})


@query(
    f"""WITH {CONSO_SQL}, {WEATHER_SQL}, {PRICE_SQL}
    SELECT c.date_heure, half_up(consommation_mw, 4) AS consommation_mw, temperature_moyenne_nationale, vent_moyen_national,
           half_up(prix_eur_mwh, 4) AS prix_eur_mwh
    FROM national c LEFT JOIN weather w ON c.date_heure = w.date_heure LEFT JOIN price p ON c.date_heure = p.date_heure"""
)
def joined_exact(t: Tables) -> DataFrame:
    return presented(silver_layer(t)["conso_meteo_prix"])


@query(f"WITH {JOINED_SQL} SELECT date_heure, {rounded(*CARBON)} FROM joined")
def joined_hour(t: Tables) -> DataFrame:
    return presented(ranking.order_by(silver_layer(t)["conso_meteo_prix_carbone"], "date_heure"))


@query(
    f"""WITH {CONSO_SQL} SELECT date_trunc('month', date_heure) AS mois,
    half_up(avg(consommation_mw), 0) AS consommation_moyenne_mw,
    half_up(max(consommation_mw), 0) AS pic_mw,
    half_up(min(consommation_mw), 0) AS creux_mw FROM national GROUP BY 1"""
)
def gold_consumption_months(t: Tables) -> DataFrame:
    return presented(gold_layer(t)["consommation_mensuelle"])


@query(
    f"WITH {CONSO_SQL} SELECT date_heure, half_up(consommation_mw, 4) AS consommation_mw FROM national "
    "ORDER BY national.consommation_mw DESC, date_heure LIMIT 10"
)
def gold_peaks(t: Tables) -> DataFrame:
    return presented(gold_layer(t)["top_pics_nationaux"])


@query(
    f"""WITH {REGIONAL_SQL}, means AS (SELECT region, avg(consommation_mw) AS m FROM regional GROUP BY 1),
    ranked AS (SELECT region, m, rank() OVER (ORDER BY m DESC) AS rang FROM means)
    SELECT CASE WHEN rang <= 3 THEN region ELSE 'Autres régions' END AS region,
           half_up(sum(m), 0) AS consommation_moyenne_mw FROM ranked GROUP BY 1"""
)
def gold_key_regions(t: Tables) -> DataFrame:
    return presented(gold_layer(t)["consommation_regions_cles"])


@query(
    f"""WITH {JOINED_SQL} SELECT half_up(corr(temperature_moyenne_nationale, consommation_mw), 3) AS r_temperature_consommation,
    half_up(corr(prix_eur_mwh, consommation_mw), 3) AS r_prix_consommation,
    half_up(corr(taux_co2, consommation_mw), 3) AS r_carbone_consommation,
    half_up(corr(ech_physiques, taux_co2), 3) AS r_export_carbone FROM joined"""
)
def key_correlations(t: Tables) -> DataFrame:
    return gold_layer(t)["correlations"]


@query(
    f"WITH {MIX_SQL} SELECT "
    + ", ".join(f"half_up(avg({c}), 0) AS {c}_moyen_mw" for c in MIX_SOURCES)
    + ", half_up(avg(taux_co2), 1) AS taux_co2_moyen FROM mix"
)
def energy_mix(t: Tables) -> DataFrame:
    return gold_layer(t)["mix_energetique_moyen"]


@query(
    f"""WITH {JOINED_SQL} SELECT CASE WHEN month(date_heure) IN (12, 1, 2) THEN 'hiver'
    WHEN month(date_heure) IN (6, 7, 8) THEN 'ete' ELSE 'mi_saison' END AS saison, count(*) AS nb_lignes,
    half_up(corr(taux_co2, consommation_mw), 3) AS r_carbone_consommation,
    half_up(corr(ech_physiques, taux_co2), 3) AS r_export_carbone FROM joined GROUP BY 1 HAVING count(*) >= 2"""
)
def gold_season_correlations(t: Tables) -> DataFrame:
    return gold_layer(t)["correlations_saisonnieres"]


@query(f"WITH {HOURLY_SQL} SELECT date_heure, {rounded('consommation_mw', 'temperature_c', 'prix_eur_mwh')} FROM base")
def hourly_base(t: Tables) -> DataFrame:
    return presented(analysis.hourly_base(facts(t)))


@query(
    f"""WITH {HOURLY_SQL}, complete AS (SELECT * FROM base WHERE consommation_mw IS NOT NULL AND temperature_c IS NOT NULL),
    m AS (SELECT avg(consommation_mw) AS mc, stddev_pop(consommation_mw) AS sc, avg(temperature_c) AS mt,
          stddev_pop(temperature_c) AS st FROM complete)
    SELECT date_heure, {rounded('consommation_mw', 'temperature_c', 'prix_eur_mwh')},
    CASE WHEN consommation_mw IS NOT NULL AND temperature_c IS NOT NULL THEN half_up((base.consommation_mw - mc) / sc, 4) END AS consommation_mw_z,
    CASE WHEN consommation_mw IS NOT NULL AND temperature_c IS NOT NULL THEN half_up((base.temperature_c - mt) / st, 4) END AS temperature_c_z
    FROM base, m"""
)
def clean_base(t: Tables) -> DataFrame:
    return presented(analysis.clean_base(settled(analysis.hourly_base(facts(t)), "hourly-base")))


@query(
    f"""WITH {REGIONAL_SQL} SELECT f.region, date_heure, half_up(consommation_mw, 2) AS consommation_mw, statut_rte
    FROM fact_regional f WHERE statut_rte = 'Consolidé'"""
)
def regional_base(t: Tables) -> DataFrame:
    given = facts(t)
    return presented(analysis.regional_base(given, silver(given)["dim_region"]), 2)


@query(
    """SELECT o_orderkey, n_name AS region, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F'"""
)
def regional_dim_join(t: Tables) -> DataFrame:
    coded = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("code")), "o_custkey")
    dim = t.nation.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("region"))
    return join_dim(coded, dim, "code", "o_orderstatus", "F").select("o_orderkey", "region", "o_totalprice")


@query(
    """WITH p AS (SELECT date_trunc('hour', ts) AS ts, avg(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1),
    s AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM p),
    w AS (SELECT date_trunc('hour', ts) AS ts, avg(value) AS view_mean FROM events WHERE event_type = 'view' GROUP BY 1)
    SELECT ts, half_up(value, 4) AS value, half_up(view_mean, 4) AS view_mean FROM s LEFT JOIN p USING (ts) LEFT JOIN w USING (ts)"""
)
def merged_series(t: Tables) -> DataFrame:
    purchases = resample(t.events.filter(F.col("event_type") == "purchase"), "ts", "value")
    views = aggregates.mean_over_groups(
        t.events.filter(F.col("event_type") == "view"), "ts", {"value": "view_mean"}, digits=None, unit="hour"
    )
    return presented(analysis.merge_resampled(purchases, [views], "ts"))


@query(
    f"""WITH {REGIONAL_SQL} SELECT DISTINCT ON (region) region, date_heure, half_up(consommation_mw, 2) AS consommation_mw
    FROM regional ORDER BY region, date_heure"""
)
def first_per_region(t: Tables) -> DataFrame:
    rows = silver(facts(t))["consommation_regionale"].select("region", "date_heure", "consommation_mw")
    return presented(dedupe_first(rows, ["region"], ["date_heure"]), 2)
