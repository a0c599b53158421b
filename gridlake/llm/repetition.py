"""Quality rules on a text's own repetition: suffix array, longest-common-prefix intervals, spans, limits."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.suffixes import neighbour_lcp, suffix_array
from gridlake.llm.texts import WHITE, cover, mix, runs, slices, text_bytes, words_of

SYMBOLS = b"#*$%&|<>"  # fixed value of the contract


@dataclass(frozen=True)
class Limits:
    """`min_repeat`: words a repeated substring must have to count; the others are limits on one text."""

    min_words: int = 50
    max_window_pct: int = 50  # percent of words in three-word windows that occur twice
    min_repeat: int = 8
    max_covered_pct: int = 30  # percent of words inside repeated substrings
    max_longest: int = 400  # words of the longest repeated substring
    max_symbols_pct: int = 30  # symbols per 100 words
    max_dup_lines_pct: int = 50


COLUMNS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "n_covered": "long", "longest_repeat": "long", "base_failed": "boolean", "kept": "boolean",
}


def _duplicate_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and lines with a word."""
    lines = [x for x in text.split(b"\n") if x.strip(WHITE)]
    return len(lines) - len(set(lines)), len(lines)


def measures(texts: list[bytes], limits: Limits) -> dict[str, np.ndarray]:
    """COLUMNS for a slice of texts.

    The texts share one suffix array: symbols are salted by text, so no repeat reaches across two texts.
    A suffix lies in the deepest longest-common-prefix interval given by the larger of its two neighbouring
    values; that is the longest substring at its place that occurs elsewhere. Every maximal repeat is such a
    substring at each of its places, so the union of these spans is the union of all maximal repeats.
    """
    w = words_of(texts, WHITE, fold=False)
    n, text = len(w.start), w.text_no()
    order, levels = suffix_array(mix(w.hashes() + mix(text.astype(np.uint64))), w.first)
    lcp = neighbour_lcp(order, levels, w.first)
    deepest = np.zeros(n, np.int64)
    deepest[order] = np.maximum(lcp, np.append(lcp[1:], 0)) if n else 0

    def per_text(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[w.first[1:]] - sums[w.first[:-1]]

    def covered(least: int) -> np.ndarray:
        at = np.flatnonzero(deepest >= least)
        return per_text(cover(n, at, at + deepest[at]))

    starts = np.concatenate([[0], np.cumsum((w.buf & 0xC0) != 0x80)])
    symbol = np.concatenate([[0], np.cumsum(np.isin(w.buf, list(SYMBOLS)))])
    lines = np.array([_duplicate_lines(t) for t in texts], np.int64).reshape(-1, 2)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, text, deepest)
    out = {
        "n_words": np.diff(w.first),
        "word_chars": per_text(starts[w.end] - starts[w.start]),
        "n_symbols": symbol[w.origin[1:]] - symbol[w.origin[:-1]],
        "n_dup_lines": lines[:, 0],
        "n_repeat_words": covered(3),
        "n_covered": covered(limits.min_repeat),
        "longest_repeat": longest,
    }
    words = out["n_words"]
    out["base_failed"] = (words < limits.min_words) | (100 * out["n_repeat_words"] > limits.max_window_pct * words)
    out["kept"] = ~(
        out["base_failed"]
        | (100 * out["n_covered"] > limits.max_covered_pct * words)
        | (longest > limits.max_longest)
        | (100 * out["n_symbols"] > limits.max_symbols_pct * words)
        | (100 * out["n_dup_lines"] > limits.max_dup_lines_pct * lines[:, 1])
    )
    return out


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """`id_col` and COLUMNS of every row, from whole texts, without a shuffle.

    A null or empty text has no words and fails. Rows are judged one by one: repeated rows and null ids come
    out as often as they go in; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            found = measures(text_bytes(part.column("_text")), limits)
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), *(pa.array(found[c]) for c in COLUMNS)], names=[id_col, *COLUMNS]
            )

    pair = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    return pair.mapInArrow(judge, f"`{id_col}` {kind}, " + ", ".join(f"{c} {t}" for c, t in COLUMNS.items()))


def keep_good(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows whose text is kept, with all their columns, without a shuffle."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            yield part.filter(pa.array(measures(text_bytes(part.column(text)), limits)["kept"]))

    return docs.mapInArrow(keep, docs.schema)


def repeat_spans(text: str, min_repeat: int = Limits.min_repeat) -> list[tuple[int, int]]:
    """Word spans of one text that its repeated substrings of `min_repeat` words or more cover, merged."""
    w = words_of([text.encode()], WHITE, fold=False)
    order, levels = suffix_array(w.hashes(), w.first)
    lcp = neighbour_lcp(order, levels, w.first)
    deepest = np.zeros(len(order), np.int64)
    deepest[order] = np.maximum(lcp, np.append(lcp[1:], 0)) if len(order) else 0
    at = np.flatnonzero(deepest >= min_repeat)
    return list(zip(*(x.tolist() for x in runs(cover(len(order), at, at + deepest[at])))))
