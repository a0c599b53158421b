"""License scans: Aho-Corasick over words for notices and identifier tags, a shunting-yard parser for expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.texts import NOT_ALNUM, WHITE, slices, text_bytes, words_of

# Fixed values of the contract: phrases that make base labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "eclipse public license": "epl",
    "all rights reserved": "proprietary",
}
TAGS = ["spdx license identifier", "license expression"]
# How freely a family may be used, 0 to 1; a family holds every identifier that begins with its name.
FREEDOM = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "zlib": 1.0, "cc0": 1.0, "unlicense": 1.0, "cc-by": 0.8,
    "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "gpl": 0.25, "agpl": 0.1, "proprietary": 0.0,
}
UNKNOWN = 0.5
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_FOLD = bytes(0x20 if b in NOT_ALNUM else b + 32 if 65 <= b <= 90 else b for b in range(256))
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+_-]*)")


def freedom(label: str) -> float:
    if " with " in label:  # an exception takes away half of what binds
        return (1 + freedom(label.split(" with ")[0])) / 2
    return next((v for k, v in FREEDOM.items() if label == k or label.startswith(k + "-")), UNKNOWN)


def postfix(text: str) -> list[str]:
    """The expression that a text begins with, lower-cased, operators after operands (shunting-yard).

    It ends at the first token that cannot follow. A trailing operator and an open bracket are dropped.
    """
    out, waiting, operand, at = [], [], False, 0
    while match := _TOKEN.match(text, at):
        token = match[1].lower()
        if token == "(" and not operand:
            waiting.append(token)
        elif token == ")" and operand and "(" in waiting:
            while (op := waiting.pop()) != "(":
                out.append(op)
        elif token in PRECEDENCE and operand:
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = False
        elif token not in PRECEDENCE and token not in "()" and not operand:
            out.append(token.rstrip("."))
            operand = True
        else:
            break
        at = match.end()
    while waiting and not operand:  # what waits for an operand that never came; an open bracket says nothing of it
        operand = waiting.pop() != "("
    return out + [op for op in reversed(waiting) if op != "("]


def evaluate(rpn: list[str]) -> tuple[float, set[str]]:
    """Freedom and labels: `and` binds by both sides, `or` lets one take the freer (the left if equal)."""
    stack: list[tuple[float, set[str]]] = []
    for token in rpn:
        if token not in PRECEDENCE:
            stack.append((freedom(token), {token}))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "or":
            stack.append(left if left[0] >= right[0] else right)
        elif token == "and":
            stack.append((min(left[0], right[0]), left[1] | right[1]))
        else:
            labels = {f"{a} with {b}" for a in left[1] for b in right[1]}
            stack.append((min(map(freedom, labels)), labels))
    return stack[-1] if stack else (0.0, set())


def matcher() -> ahocorasick.Automaton:
    """All phrases, each between spaces; values are (kind, label, words)."""
    kinds: dict[str, list[tuple[str, str]]] = {}
    for kind, phrases in (("base", BASE), ("notice", NOTICES), ("tag", {t: "" for t in TAGS})):
        for phrase, label in phrases.items():
            kinds.setdefault(phrase, []).append((kind, label))
    found = ahocorasick.Automaton()
    for phrase, means in kinds.items():
        found.add_word(f" {phrase} ", (len(phrase) + 2, phrase.count(" ") + 1, means))
    found.make_automaton()
    return found


def scan_text(automaton: ahocorasick.Automaton, text: bytes) -> tuple[int, list[tuple[str, str, int, int]], float]:
    """Words; (kind, label, first word, word after the last) of each place; the score."""
    words = text.translate(_FOLD).split()
    line = " " + b" ".join(words).decode("utf-8", "replace") + " "
    places, word, seen, own = [], 0, 0, None
    for end, (size, count, means) in automaton.iter(line):
        start = end + 1 - size
        # Phrases are met by their ends; a longer one may begin before the last.
        word = word + line.count(" ", seen, start) if start >= seen else word - line.count(" ", start, seen)
        seen = start
        for kind, label in means:
            if kind != "tag":
                places.append((kind, label, word, word + count))
                continue
            own = own or words_of([text], NOT_ALNUM, fold=True)
            rest = text[int(own.end[word + count - 1]) :].split(b"\n", 1)[0].lstrip(WHITE)
            if rest[:1] in (b":", b"="):
                labels = evaluate(postfix(rest[1:].decode("utf-8", "replace")))[1]
                places += [("tag", x, word, word + count) for x in sorted(labels)]
    scores = [freedom(label) for _, label, _, _ in places]
    return len(words), places, min(scores, default=0.0)


PLACES = "array<struct<kind: string, label: string, start: bigint, end: bigint>>"


def license_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row `id_col`, `n_words`, `places` (kind base, notice or tag; label; word span, end exclusive) and
    `score`: the freedom of the least free licence named, 0 to 1, and 0 where none is.

    A tag's labels are those that its expression leaves: of `or` the freer side, of `and` both, with an exception
    the licence and its exception as one label. A null or empty text has no words and no places. Rows are scanned one
    by one: repeated rows and null ids come out as often as they go in, an empty table gives no rows, other columns
    are ignored, whatever their names. No shuffle.
    """
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = matcher()
        for part in slices(batches, "_text"):
            found = [scan_text(automaton, t) for t in text_bytes(part.column("_text"))]
            places = [[{"kind": k, "label": x, "start": a, "end": b} for k, x, a, b in p] for _, p, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_id"), pa.array([n for n, _, _ in found], pa.int64()), pa.array(places, arrow),
                    pa.array([s for _, _, s in found], pa.float64()),
                ],
                names=[id_col, "n_words", "places", "score"],
            )

    pair = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    return pair.mapInArrow(scan, f"`{id_col}` {kind}, n_words long, places {PLACES}, score double")
