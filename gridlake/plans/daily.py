"""The daily run: landed payloads -> facts -> silver and gold of the touched months -> freshness.

Sources are independent: one that fails is reported and the others go on.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from gridlake.functions.scalar import nan_to_null
from gridlake.operators.aggregates import freshness
from gridlake.operators.cleaning import coerce_numeric
from gridlake.operators.time_windows import recent
from gridlake.operators.web import page_meta
from gridlake.plans.monthly import refresh
from gridlake.session import child_names, path_status
from gridlake.sources import payloads
from gridlake.sources.loading import enforce_constraints, upsert_partitions
from gridlake.sources.schemas import (
    CONSUMPTION_PAYLOAD,
    FACTS,
    MIX_FIELDS,
    MIX_PAYLOAD,
    REGIONAL_PAYLOAD,
    WEATHER_PAYLOAD,
    Fact,
)

Tables = Mapping[str, DataFrame]
BAD = "bad"  # a reader's mark of a document that could not be read


def stamp(col: str) -> Column:
    """Instant from an ISO text; a stamp without zone is UTC (the session zone)."""
    return F.col(col).try_cast("timestamp")


def consumption_rows(docs: DataFrame) -> DataFrame:
    """`docs` has a JSON text `json` and its arrival order `seq`, as in all readers below. A document that cannot be
    read gives one row with a mark in `bad`."""
    parsed = payloads.parse(docs, "json", CONSUMPTION_PAYLOAD, BAD)
    rows = payloads.flatten_blocks(parsed, "short_term", "values", "type", ["seq"], "pos", BAD)
    return rows.select(
        "seq", "pos", BAD, stamp("start_date").alias("start_date"), stamp("end_date").alias("end_date"),
        stamp("updated_date").alias("updated_date"), F.col("value").alias("value_mw"), "type",
    )


def weather_rows(docs: DataFrame) -> DataFrame:
    must = ["hourly.time", "hourly.temperature_2m", "hourly.windspeed_10m", "hourly.cloud_cover"]
    parsed = payloads.parse(docs, "json", WEATHER_PAYLOAD, BAD, must)
    rows = payloads.zip_arrays(
        parsed,
        {
            "date_heure": "hourly.time",
            "temperature_2m": "hourly.temperature_2m",
            "windspeed_10m": "hourly.windspeed_10m",
            "cloud_cover_total": "hourly.cloud_cover",
        },
        ["seq", "region"],
        "pos",
        BAD,
    )
    return rows.withColumn("date_heure", stamp("date_heure"))


def price_rows(docs: DataFrame) -> DataFrame:
    rows = payloads.flatten_prices(docs, "json", keep=["seq"], position="pos", bad=BAD)
    return rows.select("seq", "pos", BAD, stamp("start_date").alias("date_heure"), F.col("price").alias("prix_eur_mwh"))


def regional_rows(docs: DataFrame) -> DataFrame:
    mapping = {
        "date_heure": "date_heure",
        "code_insee_region": "code_insee_region",
        "region": "region",
        "consommation_brute_electricite_rte": "consommation_brute_electricite_mw",
        "statut_rte": "statut_rte",
    }
    parsed = payloads.parse(docs, "json", REGIONAL_PAYLOAD, BAD)
    rows = payloads.records_to_rows(parsed, "results", mapping, ["seq"], "pos", BAD)
    return rows.withColumn("date_heure", stamp("date_heure"))


def mix_rows(docs: DataFrame) -> DataFrame:
    mapping = {c: c for c in ["date_heure", *MIX_FIELDS]}
    parsed = payloads.parse(docs, "json", MIX_PAYLOAD, BAD)
    rows = payloads.records_to_rows(parsed, "results", mapping, ["seq"], "pos", BAD)
    return coerce_numeric(rows, MIX_FIELDS).withColumn("date_heure", stamp("date_heure"))


def news_rows(pages: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """`pages` has url, html and seq. A page without a title is kept, to be rejected by the required title."""
    found = page_meta(pages, "url", "html", as_of, keep=["seq"], untitled=True)
    return recent(found, "date_publication", as_of, days)


READERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "fact_consommation": consumption_rows,
    "fact_meteoid": weather_rows,
    "fact_prix_marche": price_rows,
    "fact_consommation_regionale": regional_rows,
    "fact_eco2mix": mix_rows,
}


PART = "part"
QUARANTINE = "reason string, seq long, place string, text string"


def land(spark: SparkSession, fact: Fact, rows: DataFrame, root: str, batch_id: int) -> dict[str, int]:
    """Upsert one source's batch: documents apply in `seq` order, their rows in theirs.

    The fact is stored by month of its stamp (news by bucket of its address), and only the partitions the
    batch touches are rewritten. NaN is stored as NULL. Rows that lack a required field, and documents that could
    not be read, are not landed: they are stored in the quarantine (`read_quarantine`) in the same attempt, with the
    first reason, their place and their text or values; their counts by reason are returned.
    """
    order = F.struct(*[c for c in ("seq", "pos") if c in rows.columns])
    doubles = [f.name for f in fact.schema if isinstance(f.dataType, DoubleType)]
    lacks = [F.when(F.col(c).isNull(), F.lit(f"null {c}")) for c in fact.must_have()]
    mark = [F.col(f"{BAD}.reason")] if BAD in rows.columns else []
    values = F.to_json(F.struct(*fact.schema.fieldNames()), {"ignoreNullFields": "false"})
    text = F.when(mark[0].isNotNull(), F.col(f"{BAD}.text")).otherwise(values) if mark else values
    place = F.to_json(F.struct("pos")) if "pos" in rows.columns else F.lit(None).cast("string")
    parsed = (
        rows.withColumns({c: nan_to_null(c) for c in doubles})
        .withColumn("_reason", F.coalesce(*mark, *lacks))
        .select(
            *fact.schema.fieldNames(), fact.partition().alias(PART), order.alias("_seq"), "_reason",
            F.when(
                F.col("_reason").isNotNull(),
                F.struct(F.col("_reason").alias("reason"), F.col("seq").cast("long").alias("seq"), place.alias("place"), text.alias("text")),
            ).alias("_reject"),
        )
        .persist()  # parsed once: for its fingerprint, the partitions it touches, the merge, and the rejects
    )
    try:
        upsert_partitions(
            spark, f"{root}/{fact.name}", parsed.filter("_reason IS NULL").drop("_reason", "_reject"), [*fact.key, PART],
            fact.updates, "_seq", PART, batch_id, f"{root}/staged/{fact.name}",
            rejects=parsed.filter("_reason IS NOT NULL").select("_reject.*"),
            rejects_to=f"{root}/quarantine/source={fact.name}",
            touched_to=f"{root}/touched/{fact.name}" if fact.by_month() else None,
        )
        counts = parsed.filter("_reason IS NOT NULL").groupBy("_reason").count().collect()  # a row per reason
        return {r["_reason"]: r["count"] for r in counts}
    finally:
        parsed.unpersist()


def read_quarantine(spark: SparkSession, root: str, fact: str | None = None) -> DataFrame:
    """What the runs kept out of the facts: source, run, reason, place in the run's documents, text or values."""
    path = f"{root}/quarantine"
    if path_status(spark, path) is None:
        return spark.createDataFrame([], f"{QUARANTINE}, source string, run long")
    rows = spark.read.schema(f"{QUARANTINE}, source string, run long").parquet(path)
    return rows if fact is None else rows.filter(F.col("source") == fact)


def read_fact(
    spark: SparkSession, fact: Fact, root: str, since: date | None = None, until: date | None = None,
    months: list[str] | None = None,
) -> DataFrame:
    """A landed fact; empty when nothing has landed yet.

    `since` and `until` keep the rows stamped in [since, until), and of a fact stored by month only those months
    are listed and read. `months` (yyyy-MM) keeps those of a fact stored by month.
    """
    path = f"{root}/{fact.name}"
    if path_status(spark, path) is None:
        return spark.createDataFrame([], fact.schema)
    stored = StructType([*fact.schema.fields, StructField(PART, StringType())])
    rows = spark.read.schema(stored).parquet(path)
    kind = fact.schema[fact.stamp].dataType
    if since is not None:
        rows = rows.filter(F.col(fact.stamp) >= F.lit(since).cast(kind))
        rows = rows.filter(F.col(PART) >= f"{since:%Y-%m}") if fact.by_month() else rows
    if until is not None:
        rows = rows.filter(F.col(fact.stamp) < F.lit(until).cast(kind))
        rows = rows.filter(F.col(PART) <= f"{until - timedelta(days=1):%Y-%m}") if fact.by_month() else rows
    if months is not None and fact.by_month():
        rows = rows.filter(F.col(PART).isin(months))
    return rows.drop(PART)


def read_facts(spark: SparkSession, root: str, months: list[str] | None = None) -> Tables:
    return {name: read_fact(spark, fact, root, months=months) for name, fact in FACTS.items()}


def newest_rows(spark: SparkSession, fact: Fact, root: str) -> DataFrame:
    """Rows that hold the newest stamp: the last month of a fact stored by month, else the whole fact."""
    months = [c.partition("=")[2] for c in child_names(spark, f"{root}/{fact.name}") if c.startswith(f"{PART}=")]
    if not months or not fact.by_month():
        return read_fact(spark, fact, root)
    return read_fact(spark, fact, root, since=date.fromisoformat(f"{max(months)}-01"))


def run(
    spark: SparkSession, sources: Mapping[str, DataFrame], root: str, as_of: Column, batch_id: int
) -> tuple[Tables, DataFrame, dict[str, str], dict[str, dict[str, int]]]:
    """One daily run on the tables under `root`; `batch_id` numbers the runs, and a run may be repeated.

    `sources` maps a fact to its raw documents (or pages). Returns the gold tables, the freshness report, the
    errors of failed sources, and for each landed source the counts of its quarantined rows and documents by reason. A
    failed source keeps its previous table.
    """
    errors: dict[str, str] = {}
    rejected: dict[str, dict[str, int]] = {}
    for name, fact in FACTS.items():
        try:
            docs = sources[name]
            rows = news_rows(docs, as_of) if name == "fact_actualites" else READERS[name](docs)
            rejected[name] = land(spark, fact, rows, root, batch_id)
        except Exception as error:  # one source must not block the others
            errors[name] = f"{type(error).__name__}: {error}"
    published, _ = refresh(spark, root, lambda months: read_facts(spark, root, months))
    report = freshness([(f.name, newest_rows(spark, f, root), f.stamp) for f in FACTS.values()], as_of)
    return published, report, errors, rejected


def check_sources(facts: Tables) -> dict[str, DataFrame]:
    """Rows of each fact that break its declared constraints."""
    return {name: enforce_constraints(df, FACTS[name].must_have(), FACTS[name].key)[1] for name, df in facts.items()}
