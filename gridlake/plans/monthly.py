"""Gold kept up to date month by month.

Each month has small stored states: its own statistics, its best peaks, sums per region and per source, and moments of
the correlated measures. A run rebuilds the states of the months that landed batches touched, from those months' facts
alone, and the gold tables follow from the states. The lists of touched months are deleted last, so a run that
dies anywhere is made good by the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlake.functions.scalar import WINTER_MONTHS, SUMMER_MONTHS, round_to
from gridlake.operators import exact
from gridlake.operators.moments import merge_states, pair_states, state_r
from gridlake.operators.ranking import top_k, top_k_of_means
from gridlake.plans.gold import CARBON_PAIRS, KEY_PAIRS
from gridlake.plans.silver import silver
from gridlake.session import child_names, delete_path, move_path, path_status
from gridlake.sources.loading import touched_parts
from gridlake.sources.schemas import FACTS, MIX_SOURCES
from gridlake.sources.tables import publish_version

Tables = Mapping[str, DataFrame]
MONTH = "part"
SOURCES = [name for name, fact in FACTS.items() if fact.by_month()]


def _month(ts: str = "date_heure"):
    return F.date_format(ts, "yyyy-MM").alias(MONTH)


def month_stats(t: Tables) -> DataFrame:
    stats = exact.monthly_stats(t["consommation_nationale"], "date_heure", "consommation_mw")
    names = {"mean": "consommation_moyenne_mw", "peak": "pic_mw", "low": "creux_mw"}
    numbers = [F.col(c).cast("double").alias(out) for c, out in names.items()]
    return stats.select(_month("month"), F.col("month").alias("mois"), *numbers)


def month_peaks(t: Tables) -> DataFrame:
    """The ten largest values of each month; the ten of the whole history are among them."""
    rows = t["consommation_nationale"].select(_month(), "*")
    best = Window.partitionBy(MONTH).orderBy(F.desc("consommation_mw"), F.asc("date_heure"))
    return rows.withColumn("_place", F.row_number().over(best)).filter("_place <= 10").drop("_place")


def month_regions(t: Tables) -> DataFrame:
    value = "consommation_mw"
    sums = [F.count(exact.numeric(value)).alias("n"), exact.total(value).alias("total")]
    return t["consommation_regionale"].groupBy(_month(), "region").agg(*sums)


def month_moments(t: Tables) -> DataFrame:
    joined = t["conso_meteo_prix_carbone"].select(_month(), "*")
    rows = joined.groupBy(MONTH).agg(F.count("*").alias("rows"))
    return pair_states(joined, KEY_PAIRS, [MONTH]).join(rows, MONTH)


def month_mix(t: Tables) -> DataFrame:
    measures = [*MIX_SOURCES, "taux_co2"]
    sums = [
        F.struct(F.lit(c).alias("measure"), F.count(exact.numeric(c)).alias("n"), exact.total(c).alias("total")) for c in measures
    ]
    return t["eco2mix"].groupBy(_month()).agg(F.array(*sums).alias("_sums")).select(MONTH, F.inline("_sums"))


STATES: dict[str, Callable[[Tables], DataFrame]] = {
    "month_stats": month_stats, "month_peaks": month_peaks, "month_regions": month_regions, "month_moments": month_moments,
    "month_mix": month_mix,
}


# Gold from states


def stats_of(s: Tables) -> DataFrame:
    return s["month_stats"].drop(MONTH).orderBy("mois")


def peaks_of(s: Tables) -> DataFrame:
    return top_k(s["month_peaks"].drop(MONTH), "consommation_mw", 10, "date_heure")


def _merged_mean() -> Column:
    """Aggregate: mean from exact monthly totals, so it does not hang on the order in which rows or months were added."""
    return exact.exact_quotient(F.sum("total"), F.sum("n"), exact.MEAN_DIGITS).cast("double").alias("mean")


def regions_of(s: Tables) -> DataFrame:
    sums = s["month_regions"].groupBy("region").agg(_merged_mean())
    ranked = top_k_of_means(sums, "region").withColumnRenamed("mean", "consommation_moyenne_mw")
    return ranked.orderBy("consommation_moyenne_mw", ascending=False)


def _wide(corrs: DataFrame, pairs: list, keys: list[str]) -> DataFrame:
    names = [name for _, _, name in pairs]
    return corrs.groupBy(*keys).agg(*[F.max(F.when(F.col("pair") == n, F.round(state_r(), 3))).alias(n) for n in names])


def correlations_of(s: Tables) -> DataFrame:
    return _wide(merge_states(s["month_moments"], [MONTH]), KEY_PAIRS, [])


def mix_of(s: Tables) -> DataFrame:
    means = s["month_mix"].groupBy("measure").agg(_merged_mean())
    one = lambda c, digits, name: F.max(F.when(F.col("measure") == c, round_to("mean", digits))).alias(name)
    return means.agg(*[one(c, 0, f"{c}_moyen_mw") for c in MIX_SOURCES], one("taux_co2", 1, "taux_co2_moyen"))


def seasons_of(s: Tables) -> DataFrame:
    number = F.substring(MONTH, 6, 2).cast("int")
    saison = F.when(number.isin(WINTER_MONTHS), "hiver").when(number.isin(SUMMER_MONTHS), "ete").otherwise("mi_saison")
    states = s["month_moments"].withColumn("saison", saison)
    rows = states.filter(F.col("pair") == CARBON_PAIRS[0][2]).groupBy("saison").agg(F.sum("rows").alias("nb_lignes"))
    corrs = _wide(merge_states(states, [MONTH], ["saison"]), CARBON_PAIRS, ["saison"])
    return rows.join(corrs, "saison").filter("nb_lignes >= 2").select("saison", "nb_lignes", *[n for _, _, n in CARBON_PAIRS])


GOLD_OF: dict[str, Callable[[Tables], DataFrame]] = {
    "consommation_mensuelle": stats_of, "top_pics_nationaux": peaks_of, "consommation_regions_cles": regions_of,
    "correlations": correlations_of, "mix_energetique_moyen": mix_of, "correlations_saisonnieres": seasons_of,
}


def read_states(spark: SparkSession, root: str, facts: Callable) -> Tables:
    """The stored states; an empty one has the schema it would have."""
    path = f"{root}/gold_state"
    stored, layer = {}, None
    for name, build in STATES.items():
        if path_status(spark, f"{path}/{name}") and any(c.startswith(MONTH) for c in child_names(spark, f"{path}/{name}")):
            stored[name] = spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}").withColumn(MONTH, F.col(MONTH).cast("string"))
        else:
            layer = layer or silver(facts([]))
            stored[name] = build(layer)
    return stored


def refresh(spark: SparkSession, root: str, facts: Callable[[list[str] | None], Tables]) -> tuple[Tables, list[str]]:
    """Bring gold up to date with what has landed; the gold tables, and the months whose states were rebuilt.

    `facts` gives the facts of some months (None: of all). The first refresh of a root builds every month.
    """
    path = f"{root}/gold_state"
    touched, lists = set(), []
    for name in SOURCES:
        parts, found = touched_parts(spark, f"{root}/touched/{name}")
        touched, lists = touched | parts, lists + found
    whole = path_status(spark, f"{path}/built") is None
    months = None if whole else sorted(touched)
    if whole or months:
        layer = silver(facts(months))
        layer.store("conso_meteo_prix_carbone")  # two states read this join
        for name, build in STATES.items():
            kept, fresh = f"{path}/{name}", f"{path}/_next/{name}"
            build(layer).write.mode("overwrite").partitionBy(MONTH).parquet(fresh)
            if whole:
                delete_path(spark, kept)
                move_path(spark, fresh, kept)
                continue
            for month in months:  # a month of which nothing is left has no fresh state
                delete_path(spark, f"{kept}/{MONTH}={month}")
                if path_status(spark, f"{fresh}/{MONTH}={month}"):
                    move_path(spark, f"{fresh}/{MONTH}={month}", f"{kept}/{MONTH}={month}")
    states = read_states(spark, root, facts)
    tables = {name: publish_version(build(states), f"{root}/gold/{name}") for name, build in GOLD_OF.items()}
    if whole:
        spark.createDataFrame([(len(states),)], "states int").write.mode("overwrite").parquet(f"{path}/built")
    for done in lists:
        delete_path(spark, done)
    return tables, sorted(touched) if months is None else months

