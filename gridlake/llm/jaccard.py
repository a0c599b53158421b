"""N-gram Jaccard join: a grouped prefix join over sets of word shingles, and the components of its links.

A document's set is its distinct shingles as 64-bit hashes. Shingles have one order for all documents: those that
few hold first, frequent ones last, each by hash. Two sets with enough in common share a shingle in the first part
(prefix) of either. Documents with the same size and prefix form one group; only groups are joined on prefix
shingles, and pairs of groups are then expanded to their members, whose whole sets are compared.

As linked documents end up in one class, not all pairs are made: in every set of documents that share a prefix
shingle, each is compared with one pivot; classes are formed; and only pairs that share a prefix shingle across
two classes are compared after that, all of them. No link between two classes can be missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.components import components
from gridlake.llm.texts import WHITE, mix, slices, text_bytes, words_of
from gridlake.session import plan_bytes
from gridlake.sources.tables import settled

SHINGLE = 5
PERCENT = 80
FREQUENT = 32  # documents that hold a frequent shingle, at least; raised until FREQUENT_MOST hold
FREQUENT_MOST = 2_000_000  # frequent shingles that are broadcast, 8 bytes each
BUCKET_BYTES = 8 << 20  # input bytes per bucket of counted shingles
SET_BYTES = 2 << 20  # texts whose sets a task makes at once
STAR = 1000  # members of a star that one task compares with its centre; larger stars are split
PIVOTS = 4  # pivots a shingle's documents may get, by the shingle

_TURN = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64) for k in range(SHINGLE)], np.uint64)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending. Fewer words than `size` make one shingle, none make none."""
    w = words_of(texts, WHITE, fold=True)
    h, n = w.hashes(), len(w.start)
    sums = np.zeros(max(0, n - size + 1), np.uint64)
    for k in range(size):
        sums += mix(h[k : k + len(sums)] + _TURN[k])
    sums = mix(sums)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(sums[a : b - size + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for k in range(a, b):
                whole = mix(np.array([whole ^ mix(h[k : k + 1] + _TURN[k - a])[0]], np.uint64))[0]
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """A set of n has this many shingles less its smallest overlap, and one more."""
    return n - (percent * n + 99) // 100 + 1


def _count_key(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and low half of a hash, as one number; equal hashes have equal keys, few others do."""
    return ((((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))


class _Order:
    """The common order of shingles, from the keys of the frequent ones (ascending)."""

    def __init__(self, frequent: np.ndarray, buckets: int):
        self.frequent, self.buckets = frequent, buckets

    def is_frequent(self, h: np.ndarray) -> np.ndarray:
        if not len(self.frequent):
            return np.zeros(len(h), bool)
        key = _count_key(h, self.buckets)
        return self.frequent[np.minimum(np.searchsorted(self.frequent, key), len(self.frequent) - 1)] == key

    def prefixes(self, sets: list[np.ndarray], percent: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each set, its first shingles in the common order and whether they are frequent."""
        flags = self.is_frequent(np.concatenate(sets)) if sets else np.zeros(0, bool)
        out, at = [], 0
        for s in sets:
            f = flags[at : at + len(s)]
            at += len(s)
            p = prefix_length(len(s), percent) if len(s) else 0
            by = np.argsort(f, kind="stable")[:p] if f.any() else slice(0, p)
            out.append((s[by], f[by]))
        return out


def _node(s: np.ndarray) -> int:
    """A set's own hash, as a signed long: equal sets have equal hashes."""
    total = np.array([len(s)], np.uint64)
    total += np.sum(mix(s + np.uint64(0x632BE59BD9B4E019)), dtype=np.uint64)
    return int(mix(total ^ np.bitwise_xor.reduce(mix(s))).view(np.int64)[0])


def _group(prefix: np.ndarray, n: int) -> int:
    """The hash of a size and a prefix."""
    total = np.array([n], np.uint64)
    total += np.sum(mix(mix(prefix) + np.uint64(n)), dtype=np.uint64)
    return int(mix(total).view(np.int64)[0])


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for part in slices(batches, "_text", SET_BYTES):
        yield part, shingle_sets(text_bytes(part.column("_text")), size)


def frequent_order(docs: DataFrame, size: int, buckets: int) -> _Order:
    """Counts the documents of every shingle (by bucket and half a hash) and takes the frequent ones.

    A slice of texts sends, for each bucket, its shingles as four bytes each, and counts only where above one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, size):
            h = np.concatenate(sets)
            if not len(h):
                continue
            key, times = np.unique(_count_key(h, buckets), return_counts=True)
            bucket = (key >> np.uint64(32)).astype(np.int32)
            low = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            edge = np.concatenate([np.flatnonzero(np.diff(bucket, prepend=-1)), [len(key)]])
            single = times == 1
            rows = [(int(bucket[a]), low[a:b][single[a:b]].tobytes(), low[a:b][~single[a:b]].tobytes(), times[a:b][~single[a:b]].astype(np.uint32).tobytes()) for a, b in zip(edge[:-1], edge[1:])]
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "once", "more", "times"])

    def add(table: pa.Table) -> pa.Table:
        read = lambda c: np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint32)
        more, times = read("more"), read("times")
        once, n = np.unique(read("once"), return_counts=True)
        own = (n >= FREQUENT) | np.isin(once, more)
        low, place = np.unique(np.concatenate([once[own], more]), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate([n[own], times]), minlength=len(low)).astype(np.int64)
        own = total >= FREQUENT
        key = np.uint64(table.column("bucket")[0].as_py()) << np.uint64(32) | low[own].astype(np.uint64)
        return pa.table({"key": pa.array(key.view(np.int64)), "n": pa.array(total[own])})

    counted = docs.mapInArrow(count, "bucket int, once binary, more binary, times binary")
    found = settled(counted.groupBy("bucket").applyInArrow(add, "key long, n long"), "frequent")
    sizes = {r[0]: r[1] for r in found.groupBy(F.floor(F.log2("n")).alias("b")).count().collect()}
    least, kept = max(sizes, default=0) + 1, 0
    while least - 1 in range(0, 64) and least > 0 and kept + sizes.get(least - 1, 0) <= FREQUENT_MOST:
        least -= 1
        kept += sizes.get(least, 0)
    rows = found.filter(F.col("n") >= (1 << least)).select("key").toPandas()["key"].to_numpy() if kept else np.zeros(0, np.int64)
    return _Order(np.sort(rows.astype(np.int64).view(np.uint64)), buckets)


def shared_prefixes(docs: DataFrame, order: _Order, size: int, percent: int) -> DataFrame:
    """`token`, `grp` and `pos` (the token's place in the group's order) of each prefix shingle that two groups or
    more share, without repeats.

    Rows are dealt by shingle, those of a frequent one further by group, and read in order as a stream.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = spark.sparkContext.broadcast(order)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # groups of this task that have been sent; a bounded memory, for speed alone
        for _, sets in _sets(batches, size):
            tokens, groups, salts, places = [], [], [], []
            for s, (prefix, frequent) in zip(sets, source.value.prefixes(sets, percent)):
                if not len(s) or (group := _group(prefix, len(s))) in sent:
                    continue
                if len(sent) < 1_000_000:
                    sent.add(group)
                tokens.append(prefix)
                groups.append(np.full(len(prefix), group, np.int64))
                salts.append(np.where(frequent, 1 + group % 1024, 0).astype(np.int32))
                places.append(np.arange(len(prefix), dtype=np.int32))
            if tokens:
                columns = [np.concatenate(tokens).view(np.int64), *map(np.concatenate, (groups, salts, places))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "grp", "salt", "pos"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of sorted rows, the first of each (token, grp); a lone group of a token is held until another comes."""
        held, sent = None, False  # the last row, and whether it has been given out
        names = ("token", "grp", "salt", "pos")
        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in names]
            if held is not None:
                rows = [np.append(h, r) for h, r in zip(held, rows)]
            if not len(rows[0]):
                continue
            new = np.ones(len(rows[0]), bool)
            new[1:] = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
            token, group, salt, pos = (r[new] for r in rows)
            same = token[1:] == token[:-1]
            out = np.append(False, same) | np.append(same, False) | (salt > 0)
            out[0] |= sent  # its token was shared before
            belongs = bool(out[-1])
            out[0] &= not sent
            yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (token, group, pos)], names=["token", "grp", "pos"])
            held, sent = [x[-1] for x in (token, group, salt, pos)], belongs

    rows = docs.mapInArrow(emit, "token long, grp long, salt int, pos int")
    dealt = rows.repartition(partitions, "token", "salt").sortWithinPartitions("token", "salt", "grp")
    return settled(dealt.mapInArrow(shared, "token long, grp long, pos int"), "prefixes")


def described(docs: DataFrame, order: _Order, size: int, percent: int, kind: str) -> DataFrame:
    """A narrow row per document: `_id`, `_hash` of its text, size `n` of its set, hash `node` of its set, group `grp`."""
    source = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, size):
            prefixes = source.value.prefixes(sets, percent)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_id"), part.column("_hash"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) for s in sets], pa.int64()),
                    pa.array([_group(p, len(s)) for s, (p, _) in zip(sets, prefixes)], pa.int64()),
                ],
                names=["_id", "_hash", "n", "node", "grp"],
            )

    return settled(docs.mapInArrow(run, f"_id {kind}, _hash long, n long, node long, grp long"), "sets")


def _near(n: Column | str, m: Column | str, percent: int) -> Column:
    """Whether sets of these sizes can reach the similarity at all."""
    n, m = (F.col(x) if isinstance(x, str) else x for x in (n, m))
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Of `centre`, `node` pairs those whose sets are similar, as links `u`, `v`.

    Members come to their centre's task with their texts, the centre first; a centre with many members is copied
    to several tasks. `texts` has `node` and `_text`.
    """
    partitions = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stars = settled(pairs.groupBy("centre").agg(F.count("*").alias("k")).withColumn("splits", F.ceil(F.col("k") / STAR).cast("int")), "stars")
    members = pairs.join(stars, "centre").select(
        "centre", F.pmod(F.xxhash64("node"), F.col("splits")).cast("int").alias("split"), F.lit(1).alias("role"), "node"
    )
    centres = stars.select("centre", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split"), F.lit(0).alias("role"), F.col("centre").alias("node"))
    rows = members.union(centres).join(texts, "node")
    dealt = rows.repartition(partitions, "centre", "split").sortWithinPartitions("centre", "split", "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, own = None, None
        for part, sets in _sets(batches, size):
            links = []
            for c, role, node, s in zip(part.column("centre").to_pylist(), part.column("role").to_pylist(), part.column("node").to_pylist(), sets):
                if role == 0:
                    centre, own = c, s
                elif c != centre:
                    raise ValueError("a centre's text is missing")
                else:
                    common = len(np.intersect1d(own, s, assume_unique=True))
                    if 100 * common >= percent * (len(own) + len(s) - common):
                        links.append((c, node))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["u", "v"])

    return settled(dealt.mapInArrow(compare, "u long, v long"), "links")


def similar_classes(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """For every row `id_col`, `n_shingles` and `component_id`: the smallest id that links reach, its own included.

    Two documents link when 100 * common shingles >= percent * shingles of either. Null and empty texts, and texts
    without words, have no shingles and link with nothing: their component is their own id. Equal sets link. Rows
    with the same id and text are one document and come out as often as they go in; a null id does not count as
    smallest (null only where all ids of a component are null). An empty table gives no rows; other columns are
    ignored, whatever their names. Sets and groups are told apart by 64-bit hashes.
    """
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    given = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    buckets = max(8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(plan_bytes(given) // BUCKET_BYTES, 1 << 24))
    order = frequent_order(given.select("_text"), size, buckets)
    keyed = given.withColumn("_hash", F.xxhash64("_text"))
    sets = described(keyed, order, size, percent, kind)
    full = sets.filter("n > 0")
    nodes = settled(
        full.groupBy("node").agg(F.first("grp").alias("grp"), F.first("n").alias("n"), F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_hash")).alias("at")),
        "nodes",
    )
    shared = shared_prefixes(given.select("_text"), order, size, percent)
    # Grouped sides are written before they are joined: only then can Spark split the rows of a hot key.
    groups = settled(nodes.groupBy("grp").agg(F.min("node").alias("node"), F.first("n").alias("n"), F.count("*").alias("members")), "groups")
    crowded = groups.filter("members > 1").select("grp")

    # Texts of all documents that may be compared, once per distinct set.
    asked = settled(shared.select("grp").union(crowded).distinct(), "asked")
    wanted = nodes.join(asked, "grp", "left_semi").select("node", F.col("at._id").alias("w_id"), F.col("at._hash").alias("w_hash"))
    texts = settled(
        keyed.join(wanted, (F.col("_hash") == F.col("w_hash")) & F.col("_id").eqNullSafe(F.col("w_id"))).groupBy("node").agg(F.min("_text").alias("_text")),
        "texts",
    )

    # Pairs of groups: each group of a shared shingle with the shingle's pivot, expanded to members; and each member
    # of a group with one of them.
    # The pivot is the group with the fewest rarer shingles before the shared one: of copies with changes of their
    # own, the one that is nearest to all.
    turn = F.xxhash64("grp", F.pmod("token", F.lit(PIVOTS)))
    pivots = settled(shared.groupBy("token").agg(F.min(F.struct("pos", turn.alias("turn"), "grp"))["grp"].alias("pivot")), "pivots")
    sizes = groups.select("grp", "n", "node")
    group_pairs = shared.join(pivots, "token").filter("grp <> pivot").select("grp", "pivot").distinct()
    near = group_pairs.join(sizes.select("grp", "n"), "grp").join(
        sizes.select(F.col("grp").alias("pivot"), F.col("n").alias("m"), F.col("node").alias("centre")), "pivot"
    ).filter(_near("n", "m", percent))
    expanded = near.select("grp", "centre").join(nodes.select("grp", "node"), "grp").select("centre", "node")
    inside = nodes.join(groups.filter("members > 1").select("grp", F.col("node").alias("centre")), "grp").filter("node <> centre").select("centre", "node")
    tested = settled(expanded.union(inside).distinct(), "pairs")
    links = verified(tested, texts, size, percent)
    classes = settled(components(links), "classes")

    # Whatever still shares a prefix shingle, or a group, across two classes: all such pairs.
    buckets_of = shared.join(nodes.select("grp", "node", "n"), "grp").select("token", "node", "n", "pos").union(
        nodes.join(crowded, "grp", "left_semi").select(F.col("grp").alias("token"), "node", "n", F.lit(0).alias("pos"))
    )
    placed = buckets_of.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b").select("token")
    rows = settled(placed.join(mixed, "token", "left_semi"), "mixed")
    other = rows.select("token", *(F.col(c).alias(f"o_{c}") for c in ("node", "n", "pos", "component")))
    # At the first shingle that two sets share, all they have in common is still to come in both.
    least = percent * (F.col("n") + F.col("o_n"))
    enough = ((100 + percent) * (F.col("n") - F.col("pos")) >= least) & ((100 + percent) * (F.col("o_n") - F.col("o_pos")) >= least)
    across = rows.join(other, "token").filter((F.col("component") < F.col("o_component")) & enough)
    rest = across.select(F.col("node").alias("centre"), F.col("o_node").alias("node")).distinct()
    done = tested.union(tested.select(F.col("node").alias("centre"), F.col("centre").alias("node")))
    late = verified(settled(rest.join(done, ["centre", "node"], "left_anti"), "pairs"), texts, size, percent)
    ties = classes.select(F.col("node").alias("u"), F.col("component").alias("v"))
    final = settled(components(ties.union(late)), "classes")

    # The smallest id of each class; a set without links is a class of its own.
    own = nodes.select("node", "at").join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = own.groupBy("component").agg(F.min("at")["_id"].alias("component_id"))
    answer = own.select("node", "component").join(smallest, "component").select("node", "component_id")
    joined = sets.join(answer, "node", "left")
    return joined.select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"),
    )


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows, with all their columns, whose id is the smallest of their class; texts without words all stay.

    Ids are taken to be unique: rows that share an id stay or go by whether one of them is its class's first. Where
    all ids of a class are null, its rows stay.
    """
    classes = similar_classes(docs, id_col, text, size, percent)
    first = classes.filter(F.col(f"`{id_col}`").eqNullSafe(F.col("component_id"))).select(F.col(f"`{id_col}`").alias("own")).distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))  # no name of ours meets the input's
    kept = rows.join(first, F.col("row")[id_col].eqNullSafe(F.col("own")), "left_semi")
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))
