"""URL filters: a sort-merge range join of urls with host and path rules.

A host is written backwards, label by label and each closed by a dot (`example.org` is `org.example.`), so a host
and all its subdomains are one interval of keys. Urls and rules are dealt into key ranges and sorted together; a
sweep over each range keeps the stack of rules whose interval it is in.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST = "\U0010ffff"  # sorts after whatever follows a prefix
SAMPLED_PER_RANGE = 20  # sampled keys per range, by which the ranges are cut


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both empty for null and for texts without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def backwards(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class Frame:
    """The path rules of one host on the stack: sorted, each with the longest other that is its prefix."""

    def __init__(self, key: str):
        self.key, self.paths, self.rules, self.outer = key, [], [], []

    def add(self, path: str, rule: str, verdict: str) -> None:
        """Paths come in order; a path stands inside the last one that is its prefix."""
        above = len(self.paths) - 1
        while above >= 0 and not path.startswith(self.paths[above]):
            above = self.outer[above]
        self.paths.append(path)
        self.rules.append((rule, verdict))
        self.outer.append(above)

    def longest(self, path: str) -> tuple[str, str] | None:
        at = bisect_right(self.paths, path) - 1
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.outer[at]
        return self.rules[at] if at >= 0 else None


def sweep(rows: Iterable[tuple], default: str) -> Iterator[tuple[str | None, str] | None]:
    """For rows (range, key, path, rule, verdict) in order, rules before urls: None for a rule, else (rule, verdict)."""
    now, stack = None, []
    for part, key, path, rule, verdict in rows:
        if part != now:
            now, stack = part, []
        while stack and not key.startswith(stack[-1].key):
            stack.pop()
        if verdict is not None:
            if not stack or stack[-1].key != key:
                stack.append(Frame(key))
            stack[-1].add(path, rule, verdict)
            yield None
        else:
            yield next((r for f in reversed(stack) if (r := f.longest(path))), (None, default))


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """For every row `id_col`, `host`, `path`, `rule` (host and path as one text, else null) and `verdict`.

    `rules` has `host`, `path` and `verdict`. A rule fits its host and all subdomains if the url's path starts with
    the rule's; the longest host wins, then the longest path, then, of equal rules, the larger verdict. Rules with a
    null are ignored. Without a fitting rule the verdict is `default`. A null url has empty host and path. Repeated
    rows and null ids come out as often as they go in; empty tables give no rows, or only defaults; other columns
    are ignored, whatever their names.

    A host of any share of the rows is split over ranges by path, and one repeated url by the id. A
    rule goes to every range that its interval touches, so a range gets the rules of its own hosts and those of
    their parents. Memory: the rules on the stack, and the boundaries of the ranges (one key each).
    """
    spark = pages.sparkSession
    kind = pages.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    urls = pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url}`").alias("_url"))
    host, path = host_and_path(F.col("_url"))
    urls = urls.select("_id", host.alias("host"), path.alias("path")).withColumn("key", backwards(F.col("host")))
    rules = rules.select("host", "path", "verdict").dropna().distinct().withColumn("key", backwards(F.col("host")))
    bounds = _bounds(urls.select("key", "path"), ranges)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The range of each url; between equal boundaries the id decides."""
        edges = np.array(bounds, object)
        for batch in batches:
            keys = np.array(list(zip(batch.column("key").to_pylist(), batch.column("path").to_pylist())), object).reshape(-1, 2)
            joined = np.array([f"{k}\0{p}" for k, p in keys], object)
            low, high = np.searchsorted(edges, joined, "left"), np.searchsorted(edges, joined, "right")
            part = low + batch.column("turn").to_numpy(zero_copy_only=False) % (high - low + 1)
            columns = [batch.column(c) for c in ("_id", "host", "path", "key")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(part, pa.int32())], names=["_id", "host", "path", "key", "part"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per range that the rule's interval touches."""
        edges = np.array(bounds, object)
        for batch in batches:
            keys = batch.column("key").to_pylist()
            low = [int(np.searchsorted(edges, k, "left")) for k in keys]
            high = [int(np.searchsorted(edges, k + LAST, "right")) for k in keys]
            count = [h - b + 1 for b, h in zip(low, high)]
            rows = pa.array(np.repeat(np.arange(len(keys)), count))
            part = np.concatenate([np.arange(b, h + 1) for b, h in zip(low, high)]) if keys else np.zeros(0, int)
            columns = [c.take(rows) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(part, pa.int32())], names=[*batch.schema.names, "part"])

    shape = "host string, path string, verdict string, key string, part int"
    placed = urls.withColumn("turn", F.pmod(F.xxhash64("_id"), F.lit(1 << 30)).cast("int")).mapInArrow(deal, f"_id {kind}, host string, path string, key string, part int")
    active = rules.mapInArrow(spread, shape).withColumn("_id", F.lit(None).cast(kind))
    met = placed.withColumn("verdict", F.lit(None).cast("string")).unionByName(active)
    dealt = met.repartition(ranges, "part").sortWithinPartitions("part", "key", F.col("verdict").isNull(), "path", "verdict")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue: list[pa.RecordBatch] = []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                queue.append(batch)
                c = {n: batch.column(n).to_pylist() for n in ("part", "key", "path", "host", "verdict")}
                for part, key, path, host, verdict in zip(*c.values()):
                    yield part, key, path, host + path, verdict

        found: list[tuple[str | None, str] | None] = []

        def out(batch: pa.RecordBatch) -> pa.RecordBatch:
            own = np.flatnonzero([f is not None for f in found])
            taken = batch.take(pa.array(own))
            rule, verdict = ([found[i][k] for i in own] for k in (0, 1))
            found.clear()
            columns = [taken.column(c) for c in ("_id", "host", "path")]
            texts = [pa.array(x, pa.string()) for x in (rule, verdict)]
            return pa.RecordBatch.from_arrays([*columns, *texts], names=[id_col, "host", "path", "rule", "verdict"])

        for result in sweep(rows(), default):
            found.append(result)
            if len(found) == queue[0].num_rows:
                yield out(queue.pop(0))

    return dealt.mapInArrow(join, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")


def _bounds(keys: DataFrame, ranges: int) -> list[str]:
    """Ascending boundaries that cut the keys into `ranges` of about equal rows (they only decide who does the work)."""
    joined = F.concat_ws("\0", "key", "path")
    total = keys.count()
    wanted = SAMPLED_PER_RANGE * ranges
    sample = keys if total <= wanted else keys.sample(min(1.0, 1.2 * wanted / total), seed=7)
    found = sorted(r[0] for r in sample.select(joined.alias("k")).limit(2 * wanted).collect())
    return [found[len(found) * i // ranges] for i in range(1, ranges)] if found else []
