"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

A model is the share of each hash bucket among the word unigrams and bigrams of its texts. A document's weight is
its probability under the target model over that under the raw model. The keys log(weight) + Gumbel noise, cut
at the k-th largest, are a sample without replacement in proportion to the weights. The number of buckets grows with the
square root of the measured size of all texts, about as their number of distinct words does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.texts import WHITE, mix, slices, text_bytes, words_of
from gridlake.sources.tables import settled

FEWEST = 1 << 14  # buckets of a model, at least
EMITTED = 1 << 20  # buckets that a task sends in one batch
LABELLED = 50_000  # labelled documents that show the target, at most: those with the smallest hash of their id
SMOOTHING = 1.0  # added to each bucket's count
SEED = 17
DIGIT = 16  # bits that one selection pass fixes


def ngram_buckets(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every unigram and bigram of the texts, and the text of each."""
    w = words_of(texts, WHITE, fold=False)
    h, text = w.hashes(), w.text_no()
    both = text[1:] == text[:-1]
    pairs = mix(h[:-1] + mix(h[1:]))[both]
    return (np.concatenate([h, pairs]) % np.uint64(buckets)).astype(np.int64), np.concatenate([text, text[1:][both]])


def measured_buckets(size: int) -> int:
    """Buckets for texts of so many bytes: the power of two at or above twice the square root.

    2 ** 15 for 0.1 GB, 2 ** 19 for 30 GB, 2 ** 25 for 100 TB, where the model that is broadcast has 256 MB and a task that
    counts holds 512 MB.
    """
    return max(FEWEST, 1 << math.ceil(math.log2(2 * math.sqrt(max(size, 1)))))


def ngram_models(docs: DataFrame, target: DataFrame, id_col: str, text: str, buckets: int) -> np.ndarray:
    """Log ratio of target to raw probability of each bucket.

    `target` has the ids of target documents (bounded by the caller, so it is broadcast). Every task counts all its
    texts; counts are summed by bucket. What reaches the driver, as Arrow, is one pair of counts per bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, buckets), np.int64)
        for part in slices(batches, "_text"):
            bucket, owner = ngram_buckets(text_bytes(part.column("_text")), buckets)
            chosen = part.column("_target").to_numpy(zero_copy_only=False)[owner]
            for total, found in zip(totals, (bucket, bucket[chosen])):
                at, times = np.unique(found, return_counts=True)
                total[at] += times
        used = np.flatnonzero(totals[0])
        for i in range(0, len(used), EMITTED):
            at = used[i : i + EMITTED]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (at, totals[0][at], totals[1][at])], names=["bucket", "raw", "target"])

    marks = target.select(F.col(f"`{id_col}`").alias("_id")).distinct().withColumn("_chosen", F.lit(True))
    pair = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    marked = pair.join(F.broadcast(marks), "_id", "left").select("_text", F.coalesce("_chosen", F.lit(False)).alias("_target"))
    sums = marked.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    counts, found = np.full((2, buckets), SMOOTHING), sums.toArrow()
    for total, column in zip(counts, ("raw", "target")):
        total[found.column("bucket").to_numpy()] += found.column(column).to_numpy()
    raw, shown = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shown) - np.log(raw)


def scored(docs: DataFrame, log_ratio: np.ndarray, id_col: str, text: str, seed: int = SEED) -> DataFrame:
    """`_id`, `n_grams`, `log_weight`, `key` (with Gumbel noise) and `place`, a long in the order of keys.

    The noise comes from the id and the text, so a task that runs again gives the same keys.
    """
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    source = docs.sparkSession.sparkContext.broadcast(log_ratio)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = source.value
        for part in slices(batches, "_text"):
            n = part.num_rows
            bucket, owner = ngram_buckets(text_bytes(part.column("_text")), len(ratio))
            weight = np.bincount(owner, weights=ratio[bucket], minlength=n).astype(np.float64)
            uniform = (mix(part.column("_noise").to_numpy().view(np.uint64)) >> np.uint64(11)).astype(np.float64)
            key = weight - np.log(-np.log((uniform + 0.5) / (1 << 53)))
            bits = key.view(np.int64)
            place = np.where(bits < 0, bits ^ np.int64((1 << 63) - 1), bits)
            columns = [part.column("_id"), pa.array(np.bincount(owner, minlength=n)), pa.array(weight), pa.array(key), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "n_grams", "log_weight", "key", "place"])

    pair = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    noisy = pair.withColumn("_noise", F.xxhash64("_id", "_text", F.lit(seed)))
    return noisy.mapInArrow(score, f"_id {kind}, n_grams long, log_weight double, key double, place long")


def kth_largest(table: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest long of a written column, exactly: each pass counts by the next digit and fixes it."""
    fixed, left = None, k
    for shift in range(64 - DIGIT, -1, -DIGIT):
        rows = table if fixed is None else table.filter(F.shiftright(column, shift + DIGIT) == fixed)
        counts = rows.groupBy(F.shiftright(column, shift).alias("d")).count().collect()  # at most 2**DIGIT rows
        for d, n in sorted(((r["d"], r["count"]) for r in counts), reverse=True):
            if n >= left:
                fixed = d
                break
            left -= n
        else:
            return None
    return fixed


def importance_resample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
    share: float | None = None, buckets: int | None = None, labelled: int = LABELLED, seed: int = SEED,
) -> DataFrame:
    """For every row `id_col`, `n_grams`, `log_weight`, `key` and `kept`.

    The target model is fitted on at most `labelled` labelled documents (smallest hash of the id), those whose
    label is 1; the raw model and the weights on all rows. `kept` are the `share` of rows with the largest keys; by
    default that is the share of 1 among the labelled ones used. Equal keys at the limit are all kept. Labels of
    null are ignored; repeated labels of a document count as 1 if one is. A null or empty text has weight 0.
    `buckets` (by default `measured_buckets` of the texts) are those of both models.
    Without labels nothing is told apart (weights 0) and all rows are kept. Repeated rows and null ids come out as
    often as they go in; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    given = labels.filter(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label}`").isNotNull())
    one = given.groupBy(F.col(f"`{id_col}`").alias(id_col)).agg(F.max(F.col(f"`{label}`").cast("int")).alias("_label"))
    used = settled(one.orderBy(F.xxhash64(id_col), id_col).limit(labelled), "labelled")
    total, good = used.agg(F.count("*"), F.coalesce(F.sum(F.when(F.col("_label") == 1, 1)), F.lit(0))).first()
    size, rows = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(f"`{text}`"))), F.lit(0)), F.count("*")).first()
    buckets = buckets or measured_buckets(size)
    ratio = ngram_models(docs, used.filter("_label = 1").select(id_col), id_col, text, buckets) if good else np.zeros(buckets)
    keys = settled(scored(docs, ratio, id_col, text, seed), "keys")
    share = (good / total if good else 1.0) if share is None else share
    limit = kth_largest(keys, "place", round(share * rows)) if round(share * rows) > 0 else None
    kept = F.col("place") >= limit if limit is not None else F.lit(share >= 1)
    return keys.select(F.col("_id").alias(id_col), "n_grams", "log_weight", "key", kept.alias("kept"))
