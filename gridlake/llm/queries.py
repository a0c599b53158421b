"""The registered queries of this subpackage: one per operator, over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import bpe, pieces
from gridlake.llm.conversations import damaged, repair_conversations
from gridlake.llm.decontamination import contamination
from gridlake.llm.jaccard import similar_classes
from gridlake.llm.licenses import license_scan
from gridlake.llm.line_dedup import without_repeated_lines
from gridlake.llm.periodic import periodic_runs, planted
from gridlake.llm.repetition import repetition_rules
from gridlake.llm.resampling import importance_resample
from gridlake.llm.secrets import BASE, secret_scan
from gridlake.llm.token_counts import token_counts
from gridlake.llm.url_rules import judge_urls
from gridlake.sources.tables import read_table

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder.rstrip('/')}/{name}.parquet")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query()
def op1_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan(table(spark, folder, "documents"))
    kinds = [r.kind for r in BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [F.size(F.filter("spans", lambda s: s["kind"].isin([k]))).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@query()
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def round_trip_digests(texts: DataFrame, between: str = ",") -> DataFrame:
    return texts.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), between), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op4_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return round_trip_digests(bpe.encode(table(spark, folder, "documents"), path, decoded=True))


@query()
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return repetition_rules(table(spark, folder, "documents"))


RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]  # fixed values of the contract


@query(
    """WITH rest AS (
      SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
    ), parts AS (
      SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
      FROM rest
    ), fits AS (
      SELECT *, CASE
        WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/'
        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
      END AS rule FROM parts
    )
    SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
      CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
    FROM fits"""
)
def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, folder, "pages"), rules)


@query()
def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


@query()
def op9_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = license_scan(table(spark, folder, "documents"))
    base = F.filter("places", lambda p: p["kind"] == "base")
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    starts = F.transform(base, lambda p: p["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"), "score",
    )


@query()
def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_classes(table(spark, folder, "documents"))


@query()
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeated_lines(table(spark, folder, "documents"))


@query()
def op10_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance_resample(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(table(spark, folder, "documents"), plan=planted)
    longest = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.get(longest, F.lit(0)).alias("_best"), lines.alias("_lines"), "collapsed").select(
        "doc_id", "n_runs", F.col("_best.start").alias("start"), (-F.col("_best.n")).alias("length"),
        F.col("_best.period").alias("period"),
        F.expr("-_best.n * 1000 DIV _best.period").alias("exponent_milli"),
        F.sha2(F.array_join("_lines", ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    report = repair_conversations(damaged(table(spark, folder, "conversations")), present="present").report
    return report.withColumnRenamed("conv", "conv_id")


@query()
def op13_sentencepiece_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(PIECES)
    return round_trip_digests(pieces.encode(table(spark, folder, "documents"), path, decoded=True), " ")
