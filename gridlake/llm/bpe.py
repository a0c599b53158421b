"""Byte-level BPE: exact encoding by backtracking over longest matches, decoding by an offset table.

The vocabulary file is read on the driver and broadcast (its size does not depend on the data); each Python
worker builds its tables once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm.texts import slices

# Fixed value: how byte-level BPE of this family cuts a text into pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters whose class is newer than the tokenizers library's tables, as ranges. Texts with one of them are
# cut by the library itself; on all others the two agree (tests/llm checks every character).
NEWER = "[՘֋֌࢏౜೜₏₝-₟꟎-꯿\U00010000-\U0010ffff]"
EARLY_BYTES = bytes(range(0xD5))  # UTF-8 of texts in Latin, Greek and Cyrillic has no other bytes
CACHED = 300_000  # pre-tokens and pairs remembered by a worker before it starts anew


def byte_of_char() -> dict[str, int]:
    """The family's printable stand-in for each byte: itself where printable, else the next free code from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Pieces(dict):
    """Ids by pre-token, encoded when first asked for; a bounded memory that starts anew when full."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= CACHED:
            self.clear()
        ids = self[piece] = self.vocabulary.encode_piece(piece.encode())
        return ids


class Vocabulary:
    """Tables of one vocabulary file."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, byte = spec["model"], byte_of_char()
        to_bytes = lambda s: bytes(byte[c] for c in s)
        self.id_of = {to_bytes(t): i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*self.id_of.values(), *self.special.values()])
        self.bytes_of = [b""] * size
        for t, i in self.id_of.items():
            self.bytes_of[i] = t
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()
        # A merge ranks by its place in the file; single bytes come before all merges.
        self.rank = [-1] * size
        self.halves: list[tuple[int, int] | None] = [None] * size
        self.merged: dict[tuple[int, int], int] = {}
        for place, merge in enumerate(model["merges"]):
            left, right = (self.id_of[to_bytes(x)] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            whole = self.id_of[self.bytes_of[left] + self.bytes_of[right]]
            self.merged[left, right] = whole
            if self.halves[whole] is None:
                self.halves[whole], self.rank[whole] = (left, right), place
        self.matcher = ahocorasick.Automaton()
        for t, i in self.id_of.items():
            self.matcher.add_word(t.decode("latin-1"), i)
        self.matcher.make_automaton()
        self.size = [len(t) for t in self.bytes_of]
        self.offset = np.zeros(size + 1, np.int64)
        np.cumsum(self.size, out=self.offset[1:])
        self.lengths = np.array(self.size, np.int32)
        self.blob = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.pattern = regex.compile(PRE_TOKEN)
        self.newer = regex.compile(NEWER)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.library = None
        self.source = source
        self.fits: dict[tuple[int, int], bool] = {}
        self.prefix: dict[int, int | None] = {}
        self.pieces = _Pieces(self)

    # Cutting

    def pre_tokens(self, text: str) -> list[str]:
        early = text.isascii() or not text.encode().translate(None, EARLY_BYTES)
        if early or self.newer.search(text) is None:
            return self.pattern.findall(text)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.source).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def parts(self, text: str) -> Iterator[tuple[int | None, str]]:
        """The text cut at special strings: (their id, string), or (None, ordinary text)."""
        for x in self.at_special.split(text) if any(s in text for s in self.special) else [text]:
            if x:
                yield self.special.get(x), x

    # Encoding

    def shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        if token not in self.prefix:
            t = self.bytes_of[token]
            self.prefix[token] = next((self.id_of[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.id_of), None)
        return self.prefix[token]

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE leaves tokens a and b side by side: the pair-compatibility table, filled on demand."""
        found = self.fits.get((a, b))
        if found is None:
            if len(self.fits) >= CACHED:
                self.fits.clear()
            found = self.fits[a, b] = self._compatible(a, b)
        return found

    def _compatible(self, a: int, b: int) -> bool:
        # Undo merges on either side of the seam, the latest first. If a merge across the seam ranks before one
        # that was undone, BPE would have taken it, and the two tokens would not have come about.
        undone = len(self.rank)
        while True:
            across = self.merged.get((a, b))
            if across is not None and self.rank[across] < undone:
                return False
            left, right = self.rank[a], self.rank[b]
            if left < 0 and right < 0:
                return True
            # Of two equal merges the one on the left came first, so the right one is undone first; a merge
            # across the seam then has to rank before it or, for the left one, before or with it.
            if left > right:
                undone, a = left, self.halves[a][1]
            else:
                undone, b = right + 1, self.halves[b][0]

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Token ids of one pre-token, as merging by rank gives them.

        Longest matches are taken from left to right; where two do not fit, the search goes back to the longest
        shorter token that does. A place that led nowhere is not tried again, so time is linear in the length.
        """
        text, fits, size = piece.decode("latin-1"), self.fits, self.size
        out: list[int] = []
        at, last, dead = 0, None, None
        matches = self.matcher.iter_long(text)
        while at < len(text):
            if matches is None:
                matches = self.matcher.iter_long(text, at)
            token = next(matches)[1]
            longest = True
            while True:
                end = at + size[token]
                if (dead is None or end not in dead) and (last is None or fits.get((last, token)) or self.compatible(last, token)):
                    out.append(token)
                    at, last = end, token
                    break
                longest, token = False, self.shorter(token)
                if token is None:  # nothing fits here: the token before has to be shorter
                    dead = dead or set()
                    dead.add(at)
                    token = out.pop()
                    last = out[-1] if out else None
                    at -= size[token]
            if not longest:
                matches = None
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for special, part in self.parts(text):
            if special is not None:
                out.append(special)
            else:
                out.extend(chain.from_iterable(map(self.pieces.__getitem__, self.pre_tokens(part))))
        return out

    # Decoding

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of many id lists at once (list d is ids[first[d]:first[d+1]]), and where each begins."""
        size = self.lengths[ids]
        end = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size, out=end[1:])
        source = np.repeat((self.offset[ids] - end[:-1]).astype(np.int32), size)
        source += np.arange(end[-1], dtype=np.int32)
        return self.blob[source], end[first]


_loaded: dict[int, Vocabulary] = {}


def load(source: Broadcast) -> Vocabulary:
    """A worker's tables for a broadcast file, built once."""
    key = hash(source.value)
    if key not in _loaded:
        _loaded[key] = Vocabulary(source.value)
    return _loaded[key]


def broadcast_file(spark: SparkSession, path: str) -> Broadcast:
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _ids(vocabulary: Vocabulary, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The token ids of texts in one array, and where each text's begin."""
    ids = [np.array(vocabulary.encode(t or ""), np.int32) for t in texts]
    return np.concatenate(ids), np.concatenate([[0], np.cumsum([len(x) for x in ids])])


def _texts(vocabulary: Vocabulary, ids: np.ndarray, first: np.ndarray) -> pa.Array:
    data, begin = vocabulary.decode(ids, first)
    whole = data.tobytes()
    return pa.array([whole[a:b].decode("utf-8", "replace") for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())], pa.string())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """For every row `id_col` and `ids`, the token ids of its whole text, without begin or end tokens.

    `path` is the vocabulary file on the driver. Special strings inside a text become their ids. A null or empty
    text has no ids (an empty array). Rows are encoded one by one: repeated rows and null ids come out as often as
    they go in, an empty table gives no rows, other columns are ignored, whatever their names. No shuffle.
    With `decoded` the text of the ids is added as `decode` gives it, in the same task and with the same tables.
    """
    source = broadcast_file(docs.sparkSession, path)
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    names = [id_col, "ids", *(["decoded"] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(source)
        for part in slices(batches, "_text"):
            ids, first = _ids(vocabulary, part.column("_text").to_pylist())
            columns = [part.column("_id"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))]
            if decoded:
                columns.append(_texts(vocabulary, ids, first))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    pair = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    return pair.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids: str = "ids") -> DataFrame:
    """For every row `id_col`, `ids` and `decoded`, the text of its ids, special tokens included.

    Null ids are an empty list. Bytes that are no valid UTF-8 (of ids that come from no text) become U+FFFD.
    """
    source = broadcast_file(encoded.sparkSession, path)
    kind = encoded.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(source)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = part.column("_ids")
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                sizes = [len(x) if (x := s.values) is not None else 0 for s in lists]
                texts = _texts(vocabulary, flat, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("_id"), lists, texts], names=[id_col, "ids", "decoded"])

    pair = encoded.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{ids}`").alias("_ids"))
    return pair.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string")
