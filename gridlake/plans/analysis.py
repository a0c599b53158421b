"""The statistical study of the national series: one hourly base, many aggregates over it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalar import season
from gridlake.operators import aggregates, quality, ranking, series, statistics
from gridlake.operators.cleaning import keep_status, rename_project
from gridlake.operators.joining import join_dim, merge_resampled
from gridlake.plans.silver import CONSOLIDATED, REALISED

Tables = Mapping[str, DataFrame]

MEASURES = ["consommation_mw", "temperature_c", "prix_eur_mwh"]


def hourly_base(facts: Tables, realised_only: bool = True) -> DataFrame:
    """Hourly consumption (empty hours as NULL) with hourly temperature and price.

    `realised_only=False` blends forecasts into the mean, as a read of the whole fact does.
    """
    fact = facts["fact_consommation"]
    conso = rename_project(
        keep_status(fact, "type", REALISED) if realised_only else fact,
        {"start_date": "date_heure", "value_mw": "consommation_mw"},
    )
    hourly = series.resample(conso, "date_heure", "consommation_mw")
    weather = aggregates.mean_over_groups(
        facts["fact_meteoid"], "date_heure", {"temperature_2m": "temperature_c"}, digits=None, unit="hour"
    )
    return merge_resampled(hourly, [weather, facts["fact_prix_marche"]], "date_heure")


def clean_base(base: DataFrame) -> DataFrame:
    """One row per stamp, with the standard scores of consumption and temperature."""
    once = quality.dedupe_first(base, ["date_heure"], ["consommation_mw"])
    return statistics.standardise_complete(once, ["consommation_mw", "temperature_c"])


def regional_base(facts: Tables, dim_region: DataFrame) -> DataFrame:
    """Consolidated regional rows under the dimension's region names, one per region and stamp."""
    fact = facts["fact_consommation_regionale"].drop("region")
    joined = join_dim(fact, dim_region, "code_insee_region", "statut_rte", CONSOLIDATED)
    rows = joined.select(
        "region", "date_heure", F.col("consommation_brute_electricite_mw").alias("consommation_mw"), "statut_rte"
    )
    return quality.dedupe_first(rows, ["region", "date_heure"], ["consommation_mw"])


def study(base: DataFrame) -> Tables:
    """The tables of the study over one hourly base.

    Every table reads the base, so pass one that is written (`settled`, `publish`).
    """
    seasons = base.withColumn("saison", season("date_heure", "intersaison"))
    val = "consommation_mw"
    return {
        "missing": quality.missing_rates(base, MEASURES, digits=1),
        "gaps": quality.gap_profile(base, "date_heure", val),
        "gaps_per_month": quality.gaps_per_month(base, "date_heure", val),
        "describe": statistics.describe(base, [val]),
        "monthly": aggregates.monthly_stats(base, "date_heure", val),
        "peaks": ranking.top_k(base.select("date_heure", val), val, 10, "date_heure"),
        "hour_profile": aggregates.profile(base, "date_heure", val, "hour"),
        "correlation_matrix": statistics.corr_matrix(base, MEASURES),
        "iqr": statistics.iqr_summary(base, val),
        "seasons": aggregates.season_table(base, "date_heure", val),
        "season_boxes": statistics.box_stats(
            seasons.filter(F.col("saison") != "intersaison"), "saison", val, max_groups=3
        ),
        "season_test": statistics.welch_test(seasons, "saison", "hiver", "ete", val),
        "temperature_test": statistics.pearson_test(base, "temperature_c", val),
    }


def study_regions(regional: DataFrame) -> Tables:
    """Regional means, the three key regions against the rest, and their share."""
    means = aggregates.mean_by(regional, "region", "consommation_mw", digits=0)
    return {
        "means": means,
        "key_regions": ranking.top_k_with_rest(
            regional, "region", "consommation_mw", 3, "Autres régions (cumulé)", ties=False, round_means=True
        ),
        "share": ranking.top_share(means, 3),
    }
