"""Line dedup by pairwise alignment: documents that share a run of lines are aligned with patience diff."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.texts import WHITE, joined, mix, slices, span_hashes, text_bytes, words_of
from gridlake.sources.tables import settled

MIN_WORDS = 8  # of a run of lines that brings documents together, and of a block that is deleted
RARE = 1000  # later documents that meet one copy of their earlier one; where more do, it is copied. No result hangs on it


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned equal places of two sequences, ascending in both: common ends, then unique common values in their
    longest increasing order, and the same between any two of these."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {x: j for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1}
        unique = [(i, at_b[x]) for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x in at_b]
        tails, last, before = [], [], {}
        for i, j in unique:  # longest increasing run of places in b
            at = bisect_left(tails, j)
            tails[at:at + 1] = [j]
            last[at:at + 1] = [(i, j)]
            before[i, j] = last[at - 1] if at else None
        anchors, pair = [], last[-1] if last else None
        while pair:
            anchors.append(pair)
            pair = before[pair]
        if anchors:
            anchors.reverse()
            out += anchors
            starts = [(a0, b0), *((i + 1, j + 1) for i, j in anchors)]
            todo += [(i, x, j, y) for (i, j), (x, y) in zip(starts, [*anchors, (a1, b1)])]
    return sorted(out)


def common_blocks(early: list[int], late: list[int], words: list[int], least: int) -> list[int]:
    """Lines of the later document in aligned blocks of at least `least` words. Lines within a block follow each
    other in both documents."""
    out, block, held = [], [], 0
    for i, j in [*patience(early, late), (-1, -1)]:
        if block and (i, j) != (block[-1][0] + 1, block[-1][1] + 1):
            if held >= least:
                out += [y for _, y in block]
            block, held = [], 0
        if j >= 0:
            block.append((i, j))
            held += words[j]
    return out


def aligned_lines(early: list[int], late: list[int], words: list[int], runs: list[tuple[int, int]], least: int) -> set[int]:
    """Lines of the later document that alignments with the earlier one take, in blocks of at least `least` words.

    `runs` (first line, lines) are runs of the later document that the earlier one holds too. The two are aligned as
    a whole first. For each run that this has not taken (crossed order, lines held twice) they are aligned again from
    the run's place on in both, as far as they go on alike; lines already taken stay in.
    """
    gone = set(common_blocks(early, late, words, least))
    places: dict[int, list[int]] = {}
    met: dict[tuple[int, ...], int] = {}
    for j, size in sorted(runs):
        if gone.issuperset(range(j, j + size)):
            continue
        if not places:
            for i, x in enumerate(early):
                places.setdefault(x, []).append(i)
        run = tuple(late[j : j + size])
        if run not in met:
            met[run] = next(i for i in places[run[0]] if tuple(early[i : i + size]) == run)
        i, n = met[run], size
        while i + n < len(early) and j + n < len(late) and early[i + n] == late[j + n]:
            n += 1
        gone.update(j + y for y in common_blocks(early[i : i + n], late[j : j + n], words[j : j + n], least))
    return gone


def short_runs(first: np.ndarray, words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The shortest runs of lines of one text that reach `least` words, from each line on and up to each line: starts
    and ends, without repeats. A line of `least` words is a run by itself.

    Text d has the lines first[d]:first[d+1], each with a word or more. Cut any block of `least` words or more at
    both ends, as long as it holds a given line and as many words: what is left is one of these runs. So the runs
    that two texts share cover just the lines of the blocks that they share.
    """
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    n, count = len(words), np.diff(first)
    end = np.searchsorted(total, total[:-1] + least)
    start = np.searchsorted(total, total[1:] - least, "right") - 1
    on = np.flatnonzero(end <= np.repeat(first[1:], count))
    up = np.flatnonzero(start >= np.repeat(first[:-1], count))
    both = np.unique(np.concatenate([on * (n + 1) + end[on], start[up] * (n + 1) + up + 1]))
    return both // (n + 1), both % (n + 1)


def run_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of line hashes; that of a single line is the line's own."""
    out = hashes[start]
    for k in range(1, int((end - start).max(initial=0))):
        more = np.flatnonzero(start + k < end)
        out[more] = mix(mix(out[more]) + hashes[start[more] + k])
    return out


def line_table(docs: DataFrame, kind: str, least: int) -> DataFrame:
    """`_id`, `_hash`; for each line with a word, its hash, its words and its place among the text's lines; and for
    each run of these lines that brings documents together, its hash `keys`, its first line `from` and its lines `size`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            texts = text_bytes(part.column("_text"))
            buf, origin = joined(texts)
            w = words_of(texts, WHITE, fold=False)
            end = np.flatnonzero(buf == 10)
            start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
            count = np.searchsorted(w.start, end) - np.searchsorted(w.start, start)
            text = np.searchsorted(origin, start, "right") - 1
            place = np.arange(len(start)) - np.searchsorted(start, origin[:-1])[text]
            keep = count > 0
            first = np.concatenate([[0], np.cumsum(np.bincount(text[keep], minlength=len(texts)))]).astype(np.int32)
            hashes, words = span_hashes(buf, start, end, fold=False)[keep], count[keep].astype(np.int32)
            a, b = short_runs(first, words, least)
            keys = run_hashes(hashes, a, b).view(np.int64)
            ahead = np.searchsorted(a, first).astype(np.int32)
            inside = (a - first[text[keep][a]]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(first), pa.array(x)) for x in (hashes.view(np.int64), words, place[keep].astype(np.int32))]
            lists += [pa.ListArray.from_arrays(pa.array(ahead), pa.array(x)) for x in (keys, inside, (b - a).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_hash"), *lists], names=["_id", "_hash", "lines", "words", "places", "keys", "from", "size"])

    lists = "lines array<long>, words array<int>, places array<int>, keys array<long>, from array<int>, size array<int>"
    rows = docs.mapInArrow(run, f"_id {kind}, _hash long, {lists}")
    return settled(rows.filter("size(lines) > 0").dropDuplicates(["_id", "_hash"]), "lines")


def repeated_lines(docs: DataFrame, id_col: str, text: str, least: int, rare: int) -> DataFrame:
    """`_id`, `_hash` and `gone`, the places of the lines to delete, of every document that loses some."""
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    keyed = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text")).withColumn("_hash", F.xxhash64("_text"))
    lines = line_table(keyed, kind, least)
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id"), F.col("_hash"))
    runs = lines.filter("size(keys) > 0").select(order.alias("at"), "keys", "from", "size")
    # A row of `lines` is a whole document, so its runs are made distinct in place. Written holders leave the hot
    # runs' rows to a plain join of two shuffles (or a broadcast by measured size), which Spark can split.
    once = runs.select("at", F.explode(F.array_distinct("keys")).alias("key"))
    holders = settled(once.groupBy("key").agg(F.count("*").alias("n"), F.min("at").alias("first")).filter("n > 1").drop("n"), "holders")
    spans = F.transform("keys", lambda k, i: F.struct(k.alias("key"), F.get("from", i).alias("from"), F.get("size", i).alias("size")))
    held = runs.select("at", F.explode(spans).alias("x")).select("at", "x.key", F.struct("x.from", "x.size").alias("run"))
    met = held.join(holders, "key").filter("at <> first")
    pairs = settled(met.groupBy("at", "first").agg(F.collect_list("run").alias("runs")), "pairs")  # runs of one document

    # An earliest document that very many meet is copied, and those that meet it are dealt to its copies.
    copies = F.ceil(F.count("*") / F.lit(rare)).cast("int").alias("copies")
    stars = settled(pairs.groupBy("first").agg(copies), "stars")
    side = lines.select(order.alias("at"), "lines", "words", "places")
    centres = side.select(F.col("at").alias("first"), F.col("lines").alias("early")).join(stars, "first")
    centres = centres.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    dealt = pairs.join(stars, "first").withColumn("copy", F.pmod(F.xxhash64("at"), F.col("copies")).cast("int"))
    aligned = dealt.join(side, "at").join(centres.select("first", "copy", "early"), ["first", "copy"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, places = [], []
            c = [batch.column(n) for n in ("early", "lines", "words", "places")]
            for i in range(batch.num_rows):
                early, late, words, at = (x[i].values.to_pylist() for x in c)
                shared = [(r["from"], r["size"]) for r in batch.column("runs")[i].as_py()]
                gone = aligned_lines(early, late, words, shared, least)
                own.append(i)
                places.append([at[j] for j in gone])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n).take(pa.array(own, pa.int64())) for n in ("_id", "_hash")), pa.array(places, pa.list_(pa.int32()))],
                names=["_id", "_hash", "gone"],
            )

    sides = aligned.select("at._id", "at._hash", "early", "lines", "words", "places", "runs")
    found = sides.mapInArrow(align, f"_id {kind}, _hash long, gone array<int>")
    gone = found.select("_id", "_hash", F.explode("gone").alias("place"))
    return gone.groupBy("_id", "_hash").agg(F.collect_set("place").alias("gone"))


def without_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: str | None = "n_chars",
    least: int = MIN_WORDS, rare: int = RARE,
) -> DataFrame:
    """All columns of the rows, without the blocks of lines that an earlier document holds.

    Earlier is the smaller id (nulls last, then by the text's hash). From each line on and up to each line, the
    shortest run of lines that reaches `least` words (one long line, or several short ones; lines without a word do
    not count) brings each document that holds it together with the earliest one, however many hold it. The two are
    aligned by patience diff, and aligned blocks of `least` words or more are deleted from the later document; where
    the alignment has not taken such a run (lines in crossed order, or twice in a text), the two are aligned again from
    there on, until all are taken. Nothing is deleted but what an alignment took. So a document loses just the lines of
    all blocks of `least` words or more that any earlier document holds, every line keeps its earliest place, and the
    number of pairs is at most twice the number of lines. `rare` only deals the work: an earliest document that more
    than so many meet is copied.

    A document that loses all its words is left out; others keep the rest as it is (`length` is set, if there is such a
    column). Rows with the same id and text are one document and stay as often as they come; null and empty texts stay;
    an empty table gives no rows. Output columns are those of the input, whatever their names.
    """
    gone = repeated_lines(docs, id_col, text, least, rare)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))  # no name of ours meets the input's
    own = F.col("row")[text]
    same = F.col("row")[id_col].eqNullSafe(F.col("_id")) & (F.xxhash64(own) == F.col("_hash"))
    # A place counts from 0; lines are those between line feeds.
    rest = F.array_join(F.filter(F.split(own, "\n", -1), lambda _, i: ~F.array_contains("gone", i)), "\n")
    cut = rows.join(gone, same, "left").select("row", F.when(F.col("gone").isNotNull(), rest).alias("rest"))
    kept = cut.filter(F.col("rest").isNull() | ~F.col("rest").rlike(r"\A[\x20\x09-\x0D]*\z"))
    columns = {text: F.coalesce("rest", own)}
    if length in docs.columns:
        kind = docs.schema[length].dataType
        columns[length] = F.when(F.col("rest").isNull(), F.col("row")[length]).otherwise(F.length("rest").cast(kind))
    return kept.select(*(columns.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
