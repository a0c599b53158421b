"""SentencePiece BPE: exact encoding by a table of each prefix's last token, decoding by an offset table.

Merging always takes the best adjacent pair (highest score of the joined piece, then leftmost). A sequence of pieces
is what merging leaves if and only if merging leaves each two neighbours of it as they are: until the first merge
across a seam, a span changes as it would alone, whatever stands beside it. So every prefix of a text has one last
token, and the token that ends at a place is the one piece that merging can make and that is compatible with the last
token of the prefix before it. Aho-Corasick names the pieces that end at each place; ids are read off backwards.

The model file is read on the driver and broadcast (its size does not depend on the data); each Python worker builds
its tables once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm.texts import slices

SPACE = "▁"  # how a space stands in a piece
REMEMBERED = 300_000  # cuts of text, and pairs, remembered by a worker before it starts anew
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values of the file format
BPE = 2
REPLACEMENT = "�".encode()


class _Cuts(dict):
    """Ids by cut of a text, encoded when first asked for; a bounded memory that starts anew when full."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces

    def __missing__(self, cut: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[cut] = self.pieces.encode_cut(cut)
        return ids


class Pieces:
    """Tables of one model file: a BPE model with byte fallback and without a normalisation of its own."""

    def __init__(self, source: bytes):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto.FromString(source)
        spec, rules = model.trainer_spec, model.normalizer_spec
        kinds = [p.type for p in model.pieces]
        known = spec.model_type == BPE and spec.byte_fallback and not spec.treat_whitespace_as_suffix
        plain = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        if not known or not plain or {USER_DEFINED, UNUSED} & set(kinds) or kinds.count(BYTE) != 256:
            raise ValueError("not a BPE model with byte fallback, plain normalisation and ordinary pieces")
        self.prefixed = rules.add_dummy_prefix
        self.end = next((i for i, p in enumerate(model.pieces) if p.piece == spec.eos_piece), None)
        self.kinds = kinds
        self.string = [p.piece for p in model.pieces]
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.matcher = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            if self.merge(piece) == [piece]:
                self.matcher.add_word(piece, (i, len(piece)))
        self.matcher.make_automaton()
        self.unknown = spec.unk_surface.encode()
        self.bytes_of = [self._surface(i) for i in range(len(kinds))]
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int32)
        self.offset = np.concatenate([[0], np.cumsum(self.lengths)])
        self.blob = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.odd = np.array([k in (UNKNOWN, CONTROL) for k in kinds])
        self.at = re.compile(self._cut_pattern())
        self.fits: dict[tuple[int, int], bool] = {}
        self.cuts = _Cuts(self)

    def _surface(self, i: int) -> bytes:
        kind, piece = self.kinds[i], self.string[i]
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        return b"" if kind == CONTROL else self.unknown if kind == UNKNOWN else piece.replace(SPACE, " ").encode()

    def _cut_pattern(self) -> str:
        """How a text (with plain spaces) is cut where no merge can reach across.

        No merge joins two characters that stand side by side in no piece. Cuts are made before a run of spaces and
        around line feeds, where the vocabulary allows it; else the whole text is one cut.
        """
        before_space = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id_of)
        feed = any("\n" in p for p in self.id_of)
        if before_space:
            return "(?s).+" if feed else "[^\n]+|\n"
        return " +[^ ]*|[^ ]+" if feed else " +[^ \n]*|[^ \n]+|\n"

    # Encoding

    def merge(self, text: str) -> list[str]:
        """The pieces that merging leaves, by its definition; for single pieces and pairs of them."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = score.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _string(self, token: int) -> str:
        return self.string[token] if token >= 0 else chr(-token - 1)

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging leaves tokens a and b side by side: the pair-compatibility table, filled on demand."""
        found = self.fits.get((a, b))
        if found is None:
            if len(self.fits) >= REMEMBERED:
                self.fits.clear()
            left, right = self._string(a), self._string(b)
            found = self.fits[a, b] = self.merge(left + right) == [left, right]
        return found

    def encode_cut(self, cut: str) -> tuple[int, ...]:
        """Ids of one cut, from the table of each prefix's last token. A character without a piece is -1 - code point."""
        text = cut.replace(" ", SPACE)
        last: list[int | None] = [None] * (len(text) + 1)
        size = [1] * (len(text) + 1)
        done = 0  # places up to here have their last token
        fits, id_of = self.fits, self.id_of

        def alone(at: int) -> None:
            # Merging leaves the character by itself: it has no piece that the automaton could have named.
            if text[at - 1] in id_of:
                raise ValueError(f"no last token at {at} of {text!r}")
            last[at] = -1 - ord(text[at - 1])

        for end, (token, length) in self.matcher.iter(text):
            end += 1
            while done < end - 1:
                done += 1
                if last[done] is None:
                    alone(done)
            if last[end] is None:
                begin = end - length
                if not begin or fits.get((last[begin], token)) or self.compatible(last[begin], token):
                    last[end], size[end] = token, length
        while done < len(text):
            done += 1
            if last[done] is None:
                alone(done)
        out: list[int] = []
        at = len(text)
        while at:
            token = last[at]
            if token >= 0:
                out.append(token)
            else:
                out += [self.byte_id[b] for b in reversed(chr(-token - 1).encode())]
            at -= size[at]
        return tuple(reversed(out))

    def encode(self, text: str, end: bool = False) -> list[int]:
        if text:
            text = text.replace(SPACE, " ")
            text = " " + text if self.prefixed else text
        out = list(chain.from_iterable(map(self.cuts.__getitem__, self.at.findall(text))))
        if end:
            out.append(self.end)
        return out

    # Decoding

    def decode_one(self, ids: list[int]) -> str:
        """The text of any ids: bytes in a row are read as UTF-8, one replacement character for each that fails."""
        out, run, first, seen = b"", b"", True, False

        def flush() -> bytes:
            text, at, done = run, 0, b""
            while at < len(text):
                lead = text[at]
                size = 1 if lead < 0x80 else 2 if lead >> 5 == 6 else 3 if lead >> 4 == 14 else 4 if lead >> 3 == 30 else 0
                try:
                    text[at : at + size].decode()
                    ok = 0 < size <= len(text) - at
                except UnicodeDecodeError:
                    ok = False
                done += text[at : at + size] if ok else REPLACEMENT
                at += size if ok else 1
            return done

        for i in ids:
            kind = self.kinds[i]
            if kind == BYTE:
                run += self.bytes_of[i]
                continue
            out, run = out + flush(), b""
            first = first and not seen and not out
            piece = self.bytes_of[i]
            seen = False
            if first and self.prefixed and kind == NORMAL and self.string[i].startswith(SPACE):
                piece, seen = piece[1:], True
            out += piece
        return (out + flush()).decode()

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[str]:
        """The texts of many id lists at once (list d is ids[first[d]:first[d+1]])."""
        size = self.lengths[ids]
        end = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        source = np.repeat(self.offset[ids] - end[:-1], size)
        source += np.arange(end[-1])
        whole = self.blob[source].tobytes()
        odd = np.concatenate([[0], np.cumsum(self.odd[ids])])
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            # The end id alone changes nothing; other marks inside, or bytes that are no text, go the long way.
            tail = b > a and ids[b - 1] == self.end
            try:
                if odd[b] - odd[a] > tail:
                    raise ValueError
                text = whole[end[a] : end[b]].decode()
            except ValueError:
                out.append(self.decode_one(ids[a:b].tolist()))
                continue
            begins = self.prefixed and b > a and self.kinds[ids[a]] == NORMAL
            out.append(text[1:] if begins and text.startswith(" ") else text)
        return out


_loaded: dict[int, Pieces] = {}


def load(source: Broadcast) -> Pieces:
    """A worker's tables for a broadcast file, built once."""
    key = hash(source.value)
    if key not in _loaded:
        _loaded[key] = Pieces(source.value)
    return _loaded[key]


def broadcast_model(spark: SparkSession, path: str) -> Broadcast:
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", end: bool = True, decoded: bool = False
) -> DataFrame:
    """For every row `id_col` and `ids`, the piece ids of its whole text, with the end id last if `end`.

    `path` is the model file on the driver. Strings of control pieces inside a text are ordinary text. A null or empty
    text has the end id only. Rows are encoded one by one: repeated rows and null ids come out as often as they go in,
    an empty table gives no rows, other columns are ignored, whatever their names. No shuffle.
    With `decoded` the text of the ids is added as `decode` gives it, in the same task and with the same tables.
    """
    source = broadcast_model(docs.sparkSession, path)
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    names = [id_col, "ids", *(["decoded"] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(source)
        for part in slices(batches, "_text"):
            lists = [np.array(pieces.encode(t or "", end), np.int32) for t in part.column("_text").to_pylist()]
            first = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
            ids = np.concatenate(lists)
            columns = [part.column("_id"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))]
            if decoded:
                columns.append(pa.array(pieces.decode(ids, first), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    pair = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    return pair.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids: str = "ids") -> DataFrame:
    """For every row `id_col`, `ids` and `decoded`, the text of its ids; null ids are an empty list.

    Begin and end ids have no text, the unknown id has the model's mark for it; bytes that are no valid UTF-8 (of ids
    that come from no text) become U+FFFD. Rows are decoded one by one, as many as go in; an empty table gives none.
    """
    source = broadcast_model(encoded.sparkSession, path)
    kind = encoded.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(source)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = part.column("_ids")
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = [len(x) if (x := s.values) is not None else 0 for s in lists]
                texts = pieces.decode(flat, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), lists, pa.array(texts, pa.string())], names=[id_col, "ids", "decoded"]
                )

    pair = encoded.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{ids}`").alias("_ids"))
    return pair.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string")
