"""A corpus pipeline: quality rules, line dedup, near duplicates, benchmark decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written and read again as the next one's
docs. All stages but the last return the columns of `documents`. The last returns each text's token count and
digests of its ids and of the text decoded from them. Rows a stage removes: texts that fail the quality rules;
documents all of whose lines an earlier one holds; all but the smallest doc_id of a class of near duplicates (rows
with the same doc_id and text are one document, and all stay or go). Stages take nulls, empty texts and empty tables
as their operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import bpe
from gridlake.llm.decontamination import without_benchmark
from gridlake.llm.jaccard import one_of_each_class
from gridlake.llm.line_dedup import without_repeated_lines
from gridlake.llm.queries import TOKENIZER, round_trip_digests, table
from gridlake.llm.repetition import keep_good
from gridlake.session import work_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return round_trip_digests(bpe.encode(docs, path, decoded=True))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("bpe_round_trip", bpe_round_trip),
]

ORACLE_SQL = None  # suffix arrays, alignments and BPE have no SQL; tests/llm holds a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written under the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
