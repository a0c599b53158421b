"""Silver: cleaned and joined tables over the six facts, as lazy DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators.aggregates import mean_over_groups
from gridlake.operators.cleaning import drop_null, keep_status, quality_gate, rename_project
from gridlake.operators.joining import left_join_all, left_join_grain
from gridlake.operators.quality import distinct_dim
from gridlake.sources.schemas import MIX_SOURCES
from gridlake.sources.tables import Layer

Tables = Mapping[str, DataFrame]

# Statuses that make a row part of the silver layer.
REALISED = "REALISED"
CONSOLIDATED = "Consolidé"


def mix_rules() -> dict:
    """Physical ranges of the generation mix."""
    return {
        "co2_present": F.col("taux_co2").isNotNull(),
        "co2_not_negative": F.col("taux_co2") >= 0,
        "consumption_present": F.col("consommation").isNotNull(),
        "consumption_positive": F.col("consommation") > 0,
    }


def national(t: Tables) -> DataFrame:
    kept = keep_status(t["fact_consommation"], "type", REALISED)
    return rename_project(kept, {"start_date": "date_heure", "value_mw": "consommation_mw"})


def regional(t: Tables) -> DataFrame:
    kept = keep_status(t["fact_consommation_regionale"], "statut_rte", CONSOLIDATED)
    return rename_project(
        kept,
        {
            "date_heure": "date_heure",
            "region": "region",
            "code_insee_region": "code_insee_region",
            "consommation_brute_electricite_mw": "consommation_mw",
        },
    )


def weather(t: Tables) -> DataFrame:
    return t["fact_meteoid"].select("date_heure", "region", "temperature_2m", "windspeed_10m", "cloud_cover_total")


def national_weather(t: Tables) -> DataFrame:
    means = {"temperature_2m": "temperature_moyenne_nationale", "windspeed_10m": "vent_moyen_national"}
    return mean_over_groups(t["meteo"], "date_heure", means, digits=2)


def prices(t: Tables) -> DataFrame:
    return drop_null(t["fact_prix_marche"].select("date_heure", "prix_eur_mwh"), "prix_eur_mwh")


def news(t: Tables) -> DataFrame:
    return t["fact_actualites"].select("url_source", "date_publication", "titre", "contenu_resume")


def regions(t: Tables) -> DataFrame:
    return distinct_dim(t["fact_consommation_regionale"], ["region", "code_insee_region"])


def mix(t: Tables) -> DataFrame:
    good, _ = quality_gate(t["fact_eco2mix"], mix_rules())
    names = {"date_heure": "date_heure", "consommation": "consommation_eco2mix_mw"}
    return rename_project(good, names | {c: c for c in [*MIX_SOURCES, "taux_co2", "ech_physiques"]})


def with_weather_and_price(t: Tables) -> DataFrame:
    """All sources on the exact stamp of the national consumption."""
    return left_join_all(t["consommation_nationale"], [t["meteo_nationale"], t["prix_marche"]], "date_heure")


def with_carbon(t: Tables) -> DataFrame:
    """Weather by the hour of the stamp, price and mix on the exact stamp."""
    hourly = left_join_grain(t["consommation_nationale"], t["meteo_nationale"], "date_heure", "hour")
    right = t["eco2mix"].drop("consommation_eco2mix_mw")
    joined = left_join_all(hourly, [t["prix_marche"], right], "date_heure")
    return joined.select(
        "date_heure", "consommation_mw", "temperature_moyenne_nationale", "vent_moyen_national", "prix_eur_mwh",
        "taux_co2", *MIX_SOURCES, "ech_physiques",
    )


SILVER = {
    "consommation_nationale": national,
    "consommation_regionale": regional,
    "meteo": weather,
    "meteo_nationale": national_weather,
    "prix_marche": prices,
    "actualites": news,
    "dim_region": regions,
    "eco2mix": mix,
    "conso_meteo_prix": with_weather_and_price,
    "conso_meteo_prix_carbone": with_carbon,
}


def silver(facts: Tables) -> Tables:
    """The ten silver tables. Sorting is left to the sink (`order_by`)."""
    return Layer(facts, SILVER)
