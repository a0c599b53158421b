"""Periodic runs of words: suffix classes united by descending common prefix, over ordered position sets.

Suffixes that share a prefix of some length form a class. Taken from the longest shared prefixes down, classes are
united as in Kruskal's algorithm, and each class keeps its positions in order. Two positions that become neighbours
in a class when it is united at length l share exactly l words; if they lie d <= l words apart, the stretch from the
first on, l + d words long, has smallest period d (a smaller one would have put a position between them earlier). The
seed whose left neighbours differ begins the run, so every run comes from one seed and needs no extension.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.suffixes import neighbour_lcp, suffix_array
from gridlake.llm.texts import WHITE, cover, mix, slices, text_bytes, words_of

BLOCK = 1024  # positions in a block of an ordered set, up to twice as many before it is cut
MIN_LENGTH = 12  # words of the shortest run, fixed value of the contract

Plan = Callable[[list, np.ndarray], list[tuple[int, int, int] | None]]


class Positions:
    """An ordered set of positions in blocks, so that adding one moves few others however large the set is."""

    def __init__(self, position: int):
        self.blocks, self.last, self.size = [[position]], [position], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, x: int) -> tuple[int, int]:
        """Add x, which is not in the set; its neighbours before and after it (-1 where there is none)."""
        at = min(bisect_left(self.last, x), len(self.blocks) - 1)
        block = self.blocks[at]
        i = bisect_left(block, x)
        before = block[i - 1] if i else self.last[at - 1] if at else -1
        after = block[i] if i < len(block) else self.blocks[at + 1][0] if at + 1 < len(self.blocks) else -1
        block.insert(i, x)
        if i + 1 == len(block):
            self.last[at] = x
        if len(block) > 2 * BLOCK:
            self.blocks[at : at + 1] = [block[:BLOCK], block[BLOCK:]]
            self.last[at : at + 1] = [block[BLOCK - 1], block[-1]]
        self.size += 1
        return before, after


def seeds(order: np.ndarray, lcp: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(p, q, l) of positions p < q that become neighbours in a class united at l >= `least`, where q - p <= l.

    Classes are united by decreasing common prefix of suffixes next to each other in `order`. The smaller class is
    added to the larger, so a position moves a logarithmic number of times.
    """
    slots = np.flatnonzero(lcp >= least)
    slots = slots[np.argsort(-lcp[slots], kind="stable")]
    parent: dict[int, int] = {}
    sets: dict[int, Positions] = {}

    def root(x: int) -> int:
        if x not in parent:
            parent[x], sets[x] = x, Positions(x)
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    found = []
    for x, y, length in zip(order[slots - 1].tolist(), order[slots].tolist(), lcp[slots].tolist()):
        large, small = root(x), root(y)
        if sets[large].size < sets[small].size:
            large, small = small, large
        parent[small] = large
        into = sets[large]
        pending = None  # a pair with the last added position, unless the next one falls between
        for position in sets.pop(small):
            before, after = into.add(position)
            if pending and position > pending[1]:
                found.append(pending)
            if before >= 0 and (pending is None or before != pending[0]) and position - before <= length:
                found.append((before, position, length))
            pending = (position, after, length)
        if pending:
            found.append(pending)
    return [x for x in found if 0 < x[1] - x[0] <= x[2]]


def runs_of(symbols: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (position, length, period) of all runs of many texts, by position, then period.

    Text d holds symbols[first[d]:first[d+1]]; no two texts may share a symbol. A run of period d and length n comes
    from a common prefix of n - d words, which is at least d, so prefixes of under min_length / 2 words need no class.
    """
    order, levels = suffix_array(symbols, first)
    pairs = seeds(order, neighbour_lcp(order, levels, first), (min_length + 1) // 2)
    if not pairs:
        return np.empty((0, 3), np.int64)
    p, q, common = np.array(pairs, np.int64).T
    begins = np.isin(p, first)  # the first word of a text has nothing before it
    begins[~begins] = symbols[p[~begins] - 1] != symbols[q[~begins] - 1]
    found = np.stack([p, common + q - p, q - p], 1)[begins & (common + q - p >= min_length)]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def planted(ids: list, n_words: np.ndarray) -> list[tuple[int, int] | None]:
    """The contract's repetition of each document: words from `a` on repeat with period `p`; None for most."""
    out: list[tuple[int, int] | None] = []
    for key, n in zip(ids, n_words.tolist()):
        h = 1 if key is None else zlib.crc32(str(key).encode())
        if h % 10 or not n:
            out.append(None)
            continue
        g = h // 10
        a = g % n
        out.append((a, 1 + (n - a) // (3 + g % 8)))
    return out


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, plan: Callable | None = None
) -> DataFrame:
    """For every row `id_col`, `runs` (start, length, period of each run, by start, then period) and `collapsed`, the
    text's words joined by one space without those that a run holds after its first period.

    Words are maximal runs of characters other than ASCII white space; whole texts are read. `plan` may name, for
    lists of ids and word counts, a place and a period from which on a text's words repeat (`planted`, of the query).
    A null or empty text has no words, no runs and an empty `collapsed`. Rows are judged one by one: repeated rows and
    null ids come out as often as they go in; an empty table gives no rows; other columns are ignored, whatever their
    names. No shuffle; a task holds one slice of texts, or one longer text.
    """
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            texts = text_bytes(part.column("_text"))
            w = words_of(texts, WHITE, fold=False)
            counts, source = np.diff(w.first), np.arange(len(w.start))
            words = [t.split() for t in texts]
            if plan:
                for d, (n, made) in enumerate(zip(counts.tolist(), plan(part.column("_id").to_pylist(), counts))):
                    if made:
                        begin, period = made
                        at = begin + np.arange(n - begin) % period
                        source[w.first[d] + begin : w.first[d + 1]] = w.first[d] + at
                        own = words[d]
                        words[d] = own[:begin] + [own[i] for i in at.tolist()]
            symbols = mix(w.hashes()[source] + mix(w.text_no().astype(np.uint64)))
            found = runs_of(symbols, w.first, min_length)
            position, length, period = found.T
            gone = cover(len(source), position + period, position + length)
            text_of = np.searchsorted(w.first, position, "right") - 1
            edges = np.searchsorted(text_of, np.arange(len(texts) + 1))
            spans = pa.StructArray.from_arrays(
                [pa.array(position - w.first[text_of]), pa.array(length), pa.array(period)], fields=list(run_type.value_type)
            )
            some = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.first]) > 0
            for d in np.flatnonzero(some).tolist():
                keep = ~gone[w.first[d] : w.first[d + 1]]
                words[d] = [words[d][i] for i in np.flatnonzero(keep).tolist()]
            collapsed = pa.array([b" ".join(x) for x in words], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), spans), collapsed.cast(pa.string())],
                names=[id_col, "runs", "collapsed"],
            )

    pair = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    return pair.mapInArrow(
        judge, f"`{id_col}` {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
