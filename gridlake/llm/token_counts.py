"""Token counts: pieces counted once per distinct pre-token, joined to per-document frequencies, summed.

Per-document frequencies travel as columns: a block of documents and a bucket of pre-tokens make one row that
lists its distinct pre-tokens and, for each, the documents and how often. All rows of a bucket meet in one
partition, where a pre-token is counted when it is first seen and its count is joined to all its frequencies.
No token id is kept anywhere, and a very common pre-token has only one entry per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.bpe import broadcast_file, load
from gridlake.llm.texts import slices

BLOCK_BYTES = 16 << 20  # text of one block, or one longer text
BUCKETS_PER_PARTITION = 8
REMEMBERED = 500_000  # pre-tokens in a generation of a task's memory; there are two


def _lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text: str = "text", remembered: int = REMEMBERED
) -> DataFrame:
    """For every row: `id_col`, `n_bytes` of its UTF-8 text, `n_tokens` and `over_limit` (n_tokens > limit).

    `path` is the vocabulary file on the driver. A special string inside a text is one token. A null or empty text
    has no bytes and no tokens. Rows are counted one by one: repeated rows and null ids come out as often as they
    go in, an empty table gives no rows, other columns are ignored, whatever their names. `docs` should come from
    storage: blocks are numbered by task, so a task that runs again must see its rows in the same order. A task remembers
    the counts of at most twice `remembered` pre-tokens; one that comes again after that is counted again.
    """
    spark = docs.sparkSession
    source = broadcast_file(spark, path)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = partitions * BUCKETS_PER_PARTITION
    id_type = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, task = load(source), TaskContext.get().partitionId()
        for number, part in enumerate(slices(batches, "_text", BLOCK_BYTES)):
            block = task << 32 | number
            seen: dict[str, int] = {}
            found, sizes, special = [], [], []
            for t in part.column("_text").to_pylist():
                numbers, specials = [], 0
                for mark, piece in vocabulary.parts(t or ""):
                    if mark is None:
                        numbers += [seen.setdefault(p, len(seen)) for p in vocabulary.pre_tokens(piece)]
                    else:
                        specials += 1
                found.append(np.array(numbers, np.int64))
                sizes.append(len((t or "").encode()))
                special.append(specials)
            n = part.num_rows
            key = np.sort(np.concatenate(found) * n + np.repeat(np.arange(n), [len(x) for x in found]))
            start = np.flatnonzero(np.diff(key, prepend=-1))
            times = np.diff(start, append=len(key)).astype(np.int32)
            piece, doc = key[start] // n, (key[start] % n).astype(np.int32)
            pieces = np.array(list(seen), object)
            bucket_of = np.array([hash_text(p) % buckets for p in seen], np.int64)
            by = np.argsort(bucket_of[piece], kind="stable")
            piece, doc, times = piece[by], doc[by], times[by]
            bucket = bucket_of[piece]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
            rows = {"bucket": [-1], "block": [block], "pieces": [[]], "docs": [np.empty(0, np.int32)], "times": [np.empty(0, np.int32)]}
            rows |= {"ids": [part.column("_id")], "sizes": [sizes], "sums": [special]}
            for a, b in zip(edges[:-1], edges[1:]):
                heads = a + np.flatnonzero(np.diff(piece[a:b], prepend=-1))
                rows["bucket"].append(int(bucket[a]))
                rows["block"].append(block)
                rows["pieces"].append(pieces[piece[heads]].tolist())
                # Documents of one pre-token ascend; a step down, or the negative mark here, begins the next one.
                marked = doc[a:b].copy()
                marked[heads - a] = -1 - marked[heads - a]
                rows["docs"].append(marked)
                rows["times"].append(times[a:b])
                for c in ("ids", "sizes", "sums"):
                    rows[c].append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows["bucket"], pa.int32()), pa.array(rows["block"], pa.int64()),
                    pa.array(rows["pieces"], pa.list_(pa.string())),
                    pa.array(rows["docs"], pa.list_(pa.int32())), pa.array(rows["times"], pa.list_(pa.int32())),
                    _first_only(rows["ids"][0], len(rows["bucket"])),
                    pa.array(rows["sizes"], pa.list_(pa.int64())), pa.array(rows["sums"], pa.list_(pa.int64())),
                ],
                names=["bucket", "block", "pieces", "docs", "times", "ids", "sizes", "sums"],
            )

    def join_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(source)
        counts: dict[str, int] = {}
        before: dict[str, int] = {}  # what was counted before the memory was full the last time

        def count(piece: str) -> int:
            nonlocal counts, before
            n = counts.get(piece)
            if n is None:
                n = before.get(piece)
                if n is None:
                    n = len(vocabulary.encode_piece(piece.encode()))
                if len(counts) >= remembered:
                    counts, before = {}, counts
                counts[piece] = n
            return n

        now, total = None, np.zeros(0, np.int64)

        def sums() -> pa.RecordBatch:
            at = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([now], pa.int64()), pa.array([at], pa.list_(pa.int32())), pa.nulls(1, empty_ids),
                    pa.nulls(1, pa.list_(pa.int64())), pa.array([total[at]], pa.list_(pa.int64())),
                ],
                names=["block", "docs", "ids", "sizes", "sums"],
            )

        empty_ids = None
        for batch in batches:
            empty_ids = batch.schema.field("ids").type
            block, bucket = batch.column("block").to_pylist(), batch.column("bucket").to_pylist()
            for i in range(batch.num_rows):
                if bucket[i] < 0:
                    yield batch.slice(i, 1).select(["block", "docs", "ids", "sizes", "sums"])
                    continue
                if block[i] != now:
                    if now is not None:
                        yield sums()
                    now, total = block[i], np.zeros(0, np.int64)
                doc = batch.column("docs")[i].values.to_numpy()
                times = batch.column("times")[i].values.to_numpy()
                heads = doc < 0
                each = np.array([count(p) for p in batch.column("pieces")[i].as_py()], np.int64)
                doc = np.where(heads, -1 - doc, doc)
                added = np.bincount(doc, weights=each[np.cumsum(heads) - 1] * times).astype(np.int64)
                if len(added) > len(total):
                    added[: len(total)] += total
                    total = added
                else:
                    total[: len(added)] += added
        if now is not None:
            yield sums()

    def per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, head, total = None, None, None

        def rows() -> pa.RecordBatch:
            sizes = head.column("sizes")[0].values
            n = total + head.column("sums")[0].values.to_numpy()
            return pa.RecordBatch.from_arrays(
                [head.column("ids")[0].values, sizes, pa.array(n), pa.array(n > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

        for batch in batches:
            block, heads = batch.column("block").to_pylist(), batch.column("ids").is_valid().to_pylist()
            for i in range(batch.num_rows):
                if block[i] != now:
                    if now is not None:
                        yield rows()
                    if not heads[i]:
                        raise ValueError("a block came without its documents: a task saw its rows in another order")
                    now, head = block[i], batch.slice(i, 1)
                    total = np.zeros(len(head.column("sizes")[0]), np.int64)
                elif heads[i]:
                    raise ValueError("a block came twice")
                else:
                    at = batch.column("docs")[i].values.to_numpy()
                    total[at] += batch.column("sums")[i].values.to_numpy()
        if now is not None:
            yield rows()

    pair = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    carried = f"ids array<{id_type}>, sizes array<long>, sums array<long>"
    blocks = pair.mapInArrow(frequencies, f"bucket int, block long, pieces array<string>, docs array<int>, times array<int>, {carried}")
    # Heads have no bucket of their own: they are dealt by block.
    dealt = blocks.repartition(partitions, F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(F.hash("block")))
    joined = dealt.sortWithinPartitions("block").mapInArrow(join_counts, f"block long, docs array<int>, {carried}")
    met = joined.repartition(partitions, "block").sortWithinPartitions("block", F.col("ids").isNull())
    return met.mapInArrow(per_document, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean")


def hash_text(piece: str) -> int:
    """The same in every process, unlike `hash`."""
    import xxhash

    return xxhash.xxh32_intdigest(piece.encode())


def _first_only(ids: pa.Array, rows: int) -> pa.Array:
    """A list column whose first row holds all ids and whose other rows are null."""
    offsets = pa.array([0, len(ids), *[None] * (rows - 1)][: rows + 1], pa.int32()) if rows > 1 else pa.array([0, len(ids)], pa.int32())
    if rows == 1:
        return pa.ListArray.from_arrays(offsets, ids)
    first = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    return pa.concat_arrays([first, pa.nulls(rows - 1, first.type)])
