"""Benchmark decontamination: an FM-index per shard of training texts, searched backwards for benchmark phrases."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridlake.llm.suffixes import suffix_array
from gridlake.llm.texts import NOT_ALNUM, Words, cover, runs, slices, text_bytes, words_of
from gridlake.sources.tables import settled

WINDOW = 10  # words of a phrase; an item of fewer words is one phrase
SHARD_BYTES = 4 << 20  # text of one shard, or one longer text
SAMPLED = 8  # every so many positions of a shard, the suffix array's value is kept
PASS_WORDS = 1_000_000  # benchmark words that one pass over the texts takes; more make further passes


@dataclass
class Phrases:
    """The distinct phrases of some benchmark items, as numbers of words."""

    words: np.ndarray  # hashes of the benchmark's words, ascending; the number of a word is its place here
    by_length: dict[int, np.ndarray]  # a row of word numbers per phrase
    items: dict[int, list[list[int]]]  # for each phrase, the items that hold it
    names: list[str]  # item ids as text


def phrases(texts: list[str | None], names: list[str], window: int = WINDOW) -> Phrases:
    w = words_of([(t or "").encode() for t in texts], NOT_ALNUM, fold=True)
    words, number = np.unique(w.hashes(), return_inverse=True)
    holders: dict[tuple[int, ...], dict[int, None]] = {}
    for item, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist())):
        for i in range(a, max(a + 1, b - window + 1) if b > a else a):
            holders.setdefault(tuple(number[i : min(i + window, b)].tolist()), {})[item] = None
    lengths = sorted({len(p) for p in holders})
    rows = {n: [p for p in holders if len(p) == n] for n in lengths}
    return Phrases(
        words, {n: np.array(r, np.int64) for n, r in rows.items()},
        {n: [list(holders[p]) for p in r] for n, r in rows.items()}, names,
    )


class WaveletTree:
    """Ranks of symbols in a sequence: one level of bits per binary digit, the highest first.

    On each level symbols keep their order, zeros before ones; `ones[level][i]` counts the ones before place i.
    """

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (sequence >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(bit) - self.ones[-1][-1]))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        begin = np.zeros_like(at)
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            one = ((symbol >> level) & 1).astype(bool)
            ones, zeros = self.ones[i], self.zeros[i]
            at = np.where(one, zeros + ones[at], at - ones[at])
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
        return at - begin

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before."""
        symbol, begin = np.zeros_like(at), np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros):
            one = ones[at + 1] > ones[at]
            at = np.where(one, zeros + ones[at], at - ones[at])
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
            symbol = symbol * 2 + one
        return symbol, at - begin


class FmIndex:
    """An FM-index of many texts of symbols 1.., text d at positions first[d]:first[d+1].

    Texts end in marks of their own, which sort before all symbols, so no phrase reaches across two texts. Marks
    are not kept in rows: row r stands for the suffix `order[r]`, and the mark rows come before all others.
    """

    def __init__(self, symbols: np.ndarray, first: np.ndarray, alphabet: int, sampled: int = SAMPLED):
        n, texts = len(symbols), len(first) - 1
        order, _ = suffix_array(symbols, first)
        # Rows 0..texts-1 are the marks, in the order of their texts; the symbol before a mark is its text's last.
        rows = np.concatenate([first[1:], order])
        at_start = np.zeros(n + 1, bool)
        at_start[first[:-1]] = True
        begins = np.concatenate([first[1:] == first[:-1], at_start[order]])
        before = np.where(begins, 0, np.append(symbols, 0)[np.maximum(rows - 1, 0)])
        self.texts, self.tree = texts, WaveletTree(before, alphabet)
        counts = np.bincount(symbols, minlength=alphabet)
        counts[0] = texts
        self.smaller = np.concatenate([[0], np.cumsum(counts)])
        keep = begins | (rows % sampled == 0)
        keep[:texts] = False
        self.kept = np.concatenate([[0], np.cumsum(keep)]).astype(np.int32)
        self.values = rows[keep]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges low:high of the suffixes that begin with each pattern (equal length), from its last symbol on."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.smaller[-1])
        alive = np.arange(len(patterns))
        for column in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[alive, column]
            both = self.smaller[np.tile(c, 2)] + self.tree.rank(np.tile(c, 2), np.concatenate([low[alive], high[alive]]))
            low[alive], high[alive] = both[: len(c)], both[len(c) :]
            alive = alive[low[alive] < high[alive]]
        high[np.setdiff1d(np.arange(len(patterns)), alive)] = 0
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of rows: steps back through the text until a sampled one is met."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        while True:
            todo = todo[self.kept[rows[todo] + 1] == self.kept[rows[todo]]]
            if not len(todo):
                return self.values[self.kept[rows]] + steps
            symbol, rank = self.tree.symbol_and_rank(rows[todo])
            rows[todo] = self.smaller[symbol] + rank
            steps[todo] += 1


@dataclass
class Hits:
    """Word spans (text, start, end; words of the shard) that phrases occupy, and for each the number of its phrase;
    `holders` lists the items of each phrase that occurs, so an occurrence of a phrase of many items is one row."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    phrase: np.ndarray
    holders: list[list[int]]


def find(p: Phrases, w: Words) -> Hits:
    """All occurrences of the phrases in a shard.

    A word that the benchmark lacks can be in no phrase, so it only parts the texts; runs of benchmark words
    shorter than the shortest phrase hold none. What is left is indexed.
    """
    none = np.zeros(0, np.int64)
    if not p.by_length or not len(w.start):
        return Hits(none, none, none, none, [])
    hashes = w.hashes()
    place = np.searchsorted(p.words, hashes)
    known = p.words[np.minimum(place, len(p.words) - 1)] == hashes
    at_text = np.zeros(len(hashes) + 1, bool)
    at_text[w.first] = True
    # A run also ends where a text does.
    begin, end = np.flatnonzero(known & (at_text[:-1] | ~np.append(False, known[:-1]))), np.flatnonzero(known & (at_text[1:] | ~np.append(known[1:], False))) + 1
    wide = end - begin >= min(p.by_length)
    begin, end = begin[wide], end[wide]
    first = np.concatenate([[0], np.cumsum(end - begin)])
    if not first[-1]:
        return Hits(none, none, none, none, [])
    source = np.repeat(begin - first[:-1], end - begin) + np.arange(first[-1])
    used, symbol = np.unique(place[source], return_inverse=True)
    index = FmIndex(symbol + 1, first, len(used) + 1)
    starts, ends, phrases_met, holders = [], [], [], []
    for length, rows in p.by_length.items():
        number = np.searchsorted(used, rows)
        inside = (used[np.minimum(number, len(used) - 1)] == rows).all(axis=1)
        which = np.flatnonzero(inside)
        low, high = index.search(number[which] + 1)
        count = high - low
        found = np.repeat(low - np.concatenate([[0], np.cumsum(count)])[:-1], count) + np.arange(count.sum())
        start = source[index.locate(found)]
        met = count > 0
        phrases_met.append(np.repeat(len(holders) + np.cumsum(met) - 1, count))
        holders += [p.items[length][i] for i in which[met].tolist()]
        starts.append(start)
        ends.append(start + length)
    start, end, phrase = (np.concatenate(x) for x in (starts, ends, phrases_met))
    return Hits(np.searchsorted(w.first, start, "right") - 1, start, end, phrase, holders)


def merged(w: Words, hits: Hits) -> tuple[np.ndarray, np.ndarray]:
    """The hit words of a shard as disjoint spans; no span reaches across texts."""
    hit = cover(len(w.start), hits.start, hits.end)
    begin, end = runs(hit)
    inner = w.first[1:-1]
    inner = inner[(inner > 0) & (inner < len(hit))]
    inner = inner[hit[inner - 1] & hit[inner]]  # both sides hit: cut here
    return np.sort(np.concatenate([begin, inner])), np.sort(np.concatenate([end, inner]))


def block_count(benchmark: DataFrame, text: str) -> int:
    """Blocks of at most about PASS_WORDS words: a word and its separator are two characters or more."""
    size = benchmark.agg(F.sum(F.length(F.col(f"`{text}`")))).first()[0] or 0
    return max(1, -(-int(size) // (2 * PASS_WORDS)))


def benchmark_passes(benchmark: DataFrame, id_col: str, text: str, window: int, blocks: int) -> Iterator[Broadcast]:
    """The phrases of each block of the benchmark, as a broadcast variable that is made when asked for."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text"))
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(phrases([r.text for r in rows], [r.id for r in rows], window))


CARRIED = "_spans array<struct<start: bigint, end: bigint>>, _items array<string>, _words bigint"


def _search(source: Broadcast, keep: list[str]):
    """A pass: adds the spans and items of one block of the benchmark to what earlier passes have found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = source.value
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for part in slices(batches, "_text", SHARD_BYTES):
            w = words_of(text_bytes(part.column("_text")), NOT_ALNUM, fold=True)
            hits = find(p, w)
            begin, end = merged(w, hits)
            text = np.searchsorted(w.first, begin, "right") - 1
            spans = [list(x or []) for x in part.column("_spans").to_pylist()]
            for d, a, b in zip(text.tolist(), (begin - w.first[text]).tolist(), (end - w.first[text]).tolist()):
                spans[d].append({"start": a, "end": b})
            items = [set(x or []) for x in part.column("_items").to_pylist()]
            names = [[p.names[i] for i in h if p.names[i] is not None] for h in hits.holders]
            for d, i in np.unique(np.column_stack([hits.text, hits.phrase]), axis=0).tolist():
                items[d].update(names[i])
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in keep), pa.array(spans, span_type),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(np.diff(w.first), pa.int64()),
                ],
                names=[*keep, "_spans", "_items", "_words"],
            )

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """For every row `id_col`, `n_words`, `spans` (merged word spans that benchmark phrases occupy, end exclusive)
    and `items` (ids, as text and sorted, of the benchmark items with a phrase in the text).

    Null and empty texts have no words, no spans and no items; null item ids hit but are not listed. Rows are
    searched one by one: repeated rows and null ids come out as often as they go in; an empty benchmark hits
    nothing; other columns are ignored, whatever their names. No shuffle. A benchmark of any size is taken in blocks
    of bounded size, one pass and one broadcast at a time.
    """
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    found = docs.select(
        F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text"),
        F.expr("CAST(NULL AS array<struct<start: bigint, end: bigint>>)").alias("_spans"),
        F.expr("CAST(NULL AS array<string>)").alias("_items"),
    )
    blocks = block_count(benchmark, item_text)
    for i, source in enumerate(benchmark_passes(benchmark, item_id, item_text, window, blocks)):
        last = i == blocks - 1
        keep, kinds = ["_id"] if last else ["_id", "_text"], {"_id": kind, "_text": "string"}
        found = found.mapInArrow(_search(source, keep), ", ".join(f"{c} {kinds[c]}" for c in keep) + f", {CARRIED}")
        if not last:  # what a block found is written, so that only one block is held at a time
            found = settled(found, "searched")
            source.destroy()
    spans = F.col("_spans")
    if blocks > 1:  # spans of several passes may overlap
        spans = F.aggregate(
            F.array_sort("_spans"), F.expr("CAST(array() AS array<struct<start: bigint, end: bigint>>)"),
            lambda done, s: F.when(
                (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
                F.concat(
                    F.slice(done, 1, F.size(done) - 1),
                    F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))),
                ),
            ).otherwise(F.concat(done, F.array(s))),
        )
    return found.select(F.col("_id").alias(id_col), F.col("_words").alias("n_words"), spans.alias("spans"), F.col("_items").alias("items"))


def without_benchmark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", length: str | None = "n_chars",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """All rows and columns, with the hit spans taken out of the text (and `length`, if there is such a column, set).

    A span goes from its first word's first character to its last word's last. Taking it out may bring words
    together that form a phrase anew, so a text is searched again until nothing is hit. Null texts stay null. With a
    benchmark of several blocks, each round searches the texts that the round before has cut for all blocks, one
    broadcast at a time, and cuts once at the merged spans: the result does not depend on the blocks.
    """
    length = length if length in docs.columns else None
    blocks = block_count(benchmark, item_text)
    if blocks == 1:
        source = next(benchmark_passes(benchmark, item_id, item_text, window, 1))
        return docs.mapInArrow(_remover(source, text, length), docs.schema)
    others = [c for c in docs.columns if c != text]
    row = F.struct(F.lit(0).alias("n"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)))
    left, done = docs.select(row.alias("row"), F.col(f"`{text}`").alias("_text")), []
    kinds = StructType([*left.schema.fields, *StructType.fromDDL(CARRIED).fields])
    while True:
        spans, items = (F.lit(None).cast(kinds[c].dataType).alias(c) for c in ("_spans", "_items"))
        found = left.select("row", "_text", spans, items)
        for source in benchmark_passes(benchmark, item_id, item_text, window, blocks):
            found = settled(found.mapInArrow(_search(source, ["row", "_text"]), kinds), "searched")
            source.destroy()
        done.append(found.filter("size(_spans) = 0").select("row", "_text", F.lit(len(done) > 0).alias("cut")))
        hit = found.filter("size(_spans) > 0").select("row", "_text", "_spans")
        if hit.isEmpty():
            break
        left = settled(hit.mapInArrow(_cut, left.schema), "cut")
    columns = {c: F.col(f"row.c{i}") for i, c in enumerate(others)} | {text: F.col("_text")}
    if length is not None:
        columns[length] = F.when(F.col("cut"), F.length("_text").cast(docs.schema[length].dataType)).otherwise(columns[length])
    return reduce(DataFrame.union, done).select(*(columns[c].alias(c) for c in docs.columns))


def _without(old: bytes, zero: int, w: Words, begin: np.ndarray, end: np.ndarray) -> bytes:
    """A text that starts at `zero` of the words' buffer, without some spans of words."""
    cuts = [(int(w.start[a]) - zero, int(w.end[b - 1]) - zero) for a, b in zip(begin, end)]
    edges = [0, *(x for cut in cuts for x in cut), len(old)]
    return b"".join(old[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Takes the spans of several passes, which may overlap, out of their texts."""
    for part in slices(batches, "_text", SHARD_BYTES):
        texts = text_bytes(part.column("_text"))
        w = words_of(texts, NOT_ALNUM, fold=True)
        new = []
        for d, spans in enumerate(part.column("_spans").to_pylist()):
            first = int(w.first[d])
            held = cover(int(w.first[d + 1]) - first, *(np.array([s[k] for s in spans]) for k in ("start", "end")))
            begin, end = runs(held)
            new.append(_without(texts[d], int(w.origin[d]), w, begin + first, end + first))
        kind = part.schema.field("_text").type
        yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(new, pa.binary()).cast(kind)], names=["row", "_text"])


def _remover(source: Broadcast, text: str, length: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = source.value
        for part in slices(batches, text, SHARD_BYTES):
            texts = text_bytes(part.column(text))
            changed: dict[int, bytes] = {}
            todo = list(range(len(texts)))
            while todo:
                w = words_of([changed.get(i, texts[i]) for i in todo], NOT_ALNUM, fold=True)
                begin, end = merged(w, find(p, w))
                owner = np.searchsorted(w.first, begin, "right") - 1
                again = []
                for d in np.unique(owner).tolist():
                    mine = owner == d
                    changed[todo[d]] = _without(changed.get(todo[d], texts[todo[d]]), int(w.origin[d]), w, begin[mine], end[mine])
                    again.append(todo[d])
                todo = again
            if changed:
                columns = {n: part.column(n) for n in part.schema.names}
                nulls = part.column(text).is_null().to_pylist()
                new = [None if null else changed.get(i, t) for i, (t, null) in enumerate(zip(texts, nulls))]
                columns[text] = pa.array(new, pa.binary()).cast(part.schema.field(text).type)
                if length is not None:
                    old = part.column(length).to_pylist()
                    sizes = [len(changed[i].decode("utf-8", "replace")) if i in changed else n for i, n in enumerate(old)]
                    columns[length] = pa.array(sizes, part.schema.field(length).type)
                part = pa.RecordBatch.from_arrays(list(columns.values()), schema=part.schema)
            yield part

    return run

