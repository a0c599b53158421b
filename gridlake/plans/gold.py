"""Gold: published indicators over silver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from gridlake.operators.aggregates import mean_mix, monthly_stats, pair_corrs, seasonal_corrs
from gridlake.operators.ranking import top_k, top_k_with_rest
from gridlake.sources.schemas import MIX_SOURCES
from gridlake.sources.tables import Layer, publish_version

Tables = Mapping[str, DataFrame]

CARBON_PAIRS = [
    ("taux_co2", "consommation_mw", "r_carbone_consommation"),
    ("ech_physiques", "taux_co2", "r_export_carbone"),
]
KEY_PAIRS = [
    ("temperature_moyenne_nationale", "consommation_mw", "r_temperature_consommation"),
    ("prix_eur_mwh", "consommation_mw", "r_prix_consommation"),
    *CARBON_PAIRS,
]


def monthly(t: Tables) -> DataFrame:
    stats = monthly_stats(t["consommation_nationale"], "date_heure", "consommation_mw")
    return stats.toDF("mois", "consommation_moyenne_mw", "pic_mw", "creux_mw").orderBy("mois")


def peaks(t: Tables) -> DataFrame:
    return top_k(t["consommation_nationale"], "consommation_mw", 10, "date_heure")


def key_regions(t: Tables) -> DataFrame:
    ranked = top_k_with_rest(t["consommation_regionale"], "region", "consommation_mw")
    return ranked.withColumnRenamed("mean", "consommation_moyenne_mw").orderBy(
        "consommation_moyenne_mw", ascending=False
    )


def correlations(t: Tables) -> DataFrame:
    return pair_corrs(t["conso_meteo_prix_carbone"], KEY_PAIRS)


def mean_energy_mix(t: Tables) -> DataFrame:
    digits = {c: 0 for c in MIX_SOURCES} | {"taux_co2": 1}
    means = mean_mix(t["eco2mix"], digits, suffix="")
    return means.toDF(*[f"{c}_moyen_mw" for c in MIX_SOURCES], "taux_co2_moyen")


def seasonal_correlations(t: Tables) -> DataFrame:
    return seasonal_corrs(t["conso_meteo_prix_carbone"], "date_heure", CARBON_PAIRS)


GOLD = {
    "consommation_mensuelle": monthly,
    "top_pics_nationaux": peaks,
    "consommation_regions_cles": key_regions,
    "correlations": correlations,
    "mix_energetique_moyen": mean_energy_mix,
    "correlations_saisonnieres": seasonal_correlations,
}


def gold(silver: Tables) -> Tables:
    return Layer(silver, GOLD)


def publish_gold(tables: Tables, path: str) -> Tables:
    """Write every indicator; these writes are the only jobs the layers cause."""
    return {name: publish_version(df, f"{path}/{name}") for name, df in tables.items()}
