"""Secret scans: all rules as one minimised deterministic automaton over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.texts import code_points, joined, slices, text_bytes

LANE_BYTES = 512  # texts are cut into lanes of about this size, at places where the automaton is at its start
MOST_RULES = 64  # of one automaton: a state's marks are the bits of one number
FEW_LANES = 16  # lanes left that are run one by one


@dataclass(frozen=True)
class Rule:
    """A secret is `head` and then one or more bytes of `tail`, as many as follow; `least` is on the tail's length.

    Both are patterns of ASCII bytes: literals, classes, groups, `|`, `?`, `*`, `+`, and `\\x20` for a space.
    Matches are leftmost and do not overlap within a rule; a match whose tail is too short is dropped afterwards.
    """

    kind: str
    head: str
    tail: str
    least: int


def either_case(pattern: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.islower() else c for c in pattern)


# Fixed values of the contract: the three base rules.
BASE = [
    Rule("assign", f"({either_case('password|passwd|secret|token|api_?key')})[\"']?\\x20*[:=]\\x20*[\"']?", "[A-Za-z0-9+/_.=-]", 8),
    Rule("access", "AKIA", "[A-Z0-9]", 12),
    Rule("hex", "", "[0-9a-f]", 32),
]
MORE = [
    Rule("forge", "gh[oprsu]_", "[A-Za-z0-9]", 36),
    Rule("chat", "xox[abprs]-", "[A-Za-z0-9-]", 10),
    Rule("claims", "eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+[.]", "[A-Za-z0-9_-]", 16),
    Rule("private", "-----BEGIN\\x20([A-Z]+\\x20)?PRIVATE\\x20KEY", "-", 5),
]


class _Nfa:
    """A pattern as states with byte moves and free moves, read by recursive descent."""

    def __init__(self, pattern: str):
        self.text, self.at = pattern, 0
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []
        self.into: dict[int, list[tuple[frozenset[int] | None, int]]] | None = None
        self.start, self.end = self._either()
        if self.at != len(pattern):
            raise ValueError(f"cannot read {pattern!r} from {self.at}")

    def _state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def _either(self) -> tuple[int, int]:
        start, end = self._state(), self._state()
        while True:
            s, e = self._sequence()
            self.free[start].append(s)
            self.free[e].append(end)
            if self.text[self.at : self.at + 1] != "|":
                return start, end
            self.at += 1

    def _sequence(self) -> tuple[int, int]:
        start = end = self._state()
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            s, e = self._repeated()
            self.free[end].append(s)
            end = e
        return start, end

    def _repeated(self) -> tuple[int, int]:
        s, e = self._single()
        mark = self.text[self.at : self.at + 1]
        if not mark or mark not in "?*+":
            return s, e
        self.at += 1
        start, end = self._state(), self._state()
        self.free[start].append(s)
        self.free[e].append(end)
        if mark in "*+":
            self.free[e].append(s)
        if mark in "?*":
            self.free[start].append(end)
        return start, end

    def _single(self) -> tuple[int, int]:
        if self.text[self.at] == "(":
            self.at += 1
            inner = self._either()
            if self.text[self.at : self.at + 1] != ")":
                raise ValueError(f"a group is open in {self.text!r}")
            self.at += 1
            return inner
        start, end = self._state(), self._state()
        self.moves[start].append((self._class() if self.text[self.at] == "[" else frozenset([self._byte()]), end))
        return start, end

    def _byte(self) -> int:
        c = self.text[self.at]
        self.at += 1
        if c == "\\":
            code = self.text[self.at + 1 : self.at + 3]
            if self.text[self.at] != "x" or len(code) != 2:
                raise ValueError(f"only \\xHH may be escaped in {self.text!r}")
            self.at += 3
            return int(code, 16)
        if c in "?*+.^$" or ord(c) > 127:
            raise ValueError(f"{c!r} is not supported outside a class in {self.text!r}")
        return ord(c)

    def _class(self) -> frozenset[int]:
        close = self.text.index("]", self.at)
        body, found, i = self.text[self.at + 1 : close], set(), 0
        self.at = close + 1
        while i < len(body):
            if body[i + 1 : i + 2] == "-" and i + 2 < len(body):
                found |= set(range(ord(body[i]), ord(body[i + 2]) + 1))
                i += 3
            else:
                found.add(ord(body[i]))
                i += 1
        return frozenset(found)

    def backwards(self) -> dict[int, list[tuple[frozenset[int] | None, int]]]:
        """For each state, the moves that lead to it (None for a free move) and where they come from."""
        if self.into is None:
            self.into = {}
            for s, moves in enumerate(self.moves):
                for b, to in [*moves, *((None, to) for to in self.free[s])]:
                    self.into.setdefault(to, []).append((b, s))
        return self.into

    def closure(self, states: list[int]) -> tuple[int, ...]:
        """The states and all that free moves reach, in order of priority, without repeats."""
        seen: dict[int, None] = {}
        todo = list(reversed(states))
        while todo:
            s = todo.pop()
            if s not in seen:
                seen[s] = None
                todo.extend(reversed(self.free[s]))
        return tuple(seen)


class _Search:
    """Leftmost search for one rule, as a deterministic step over sets of threads ordered by where they began.

    While a match is under way (its tail is being read), later beginnings are cut; when it ends, the byte that
    ended it is read again from the start. As a match can only grow by its tail, no other byte is read twice.
    """

    def __init__(self, rule: Rule):
        self.nfa = _Nfa(f"{rule.head}({rule.tail})+")
        self.home = self.nfa.closure([self.nfa.start])
        tail = _Nfa(rule.tail).moves
        self.tail = frozenset().union(*(b for moves in tail for b, _ in moves))
        self.known: dict[tuple[tuple[int, ...], int], tuple[int, ...]] = {}

    def accepts(self, threads: tuple[int, ...]) -> bool:
        return self.nfa.end in threads

    def step(self, threads: tuple[int, ...], byte: int) -> tuple[int, ...]:
        key = (threads, byte)
        if key not in self.known:
            self.known[key] = self._step(threads, byte)
        return self.known[key]

    def _step(self, threads: tuple[int, ...], byte: int) -> tuple[int, ...]:
        after: dict[int, None] = {}
        for s in threads:
            reached = [to for bytes_, to in self.nfa.moves[s] if byte in bytes_]
            if not reached:
                continue
            states = self.nfa.closure(reached)
            if self.nfa.end in states:
                if after:
                    raise ValueError("a rule's match could be overtaken by one that began earlier")
                return states
            after.update(dict.fromkeys(states))
        if self.accepts(threads):
            return self.step(self.home, byte)
        after.update(dict.fromkeys(self.home))
        return tuple(after)


@dataclass
class Automaton:
    """`table[state * classes + byte_class[b]]` is the next state times classes; `marks[state]` has a bit per rule
    whose match goes on there. `resets[a, b]` tells that the two classes lead from any state to the start."""

    rules: list[Rule]
    byte_class: np.ndarray
    classes: int
    table: np.ndarray
    marks: np.ndarray
    resets: np.ndarray


def compile_rules(rules: list[Rule]) -> Automaton:
    """Subset construction over all rules at once, then minimisation by partition refinement."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules make one automaton")
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(rules) <= 8 * np.dtype(t).itemsize)
    searches = [_Search(r) for r in rules]
    groups: dict[tuple[bool, ...], int] = {}
    sets = {b for s in searches for moves in s.nfa.moves for b, _ in moves}
    byte_class = np.array([groups.setdefault(tuple(b in s for s in sets), len(groups)) for b in range(256)], np.uint8)
    sample = [int(np.argmax(byte_class == c)) for c in range(len(groups))]
    home = tuple(s.home for s in searches)
    number, rows, todo = {home: 0}, [], [home]
    for state in todo:
        row = []
        for byte in sample:
            to = tuple(s.step(threads, byte) for s, threads in zip(searches, state))
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        rows.append(row)
    moves = np.array(rows)
    marks = np.array([sum(1 << i for i, (s, t) in enumerate(zip(searches, state)) if s.accepts(t)) for state in todo], kind)
    # States are told apart by their marks, then by where their moves lead, until nothing new is told apart.
    part = np.unique(marks, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([part, part[moves]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == part.max():
            break
        part = finer
    first = np.array([int(np.argmax(part == p)) for p in range(part.max() + 1)])
    swap = np.arange(len(first))
    swap[[0, part[0]]] = swap[[part[0], 0]]  # the start is state 0
    first = first[swap]
    small = np.argsort(swap)[part[moves[first]]]
    classes = len(groups)
    resets = np.array([[(small[small[:, a], b] == 0).all() for b in range(classes)] for a in range(classes)])
    feed = byte_class[10]
    if not (small[:, feed] == 0).all():
        raise ValueError("rules must not hold a line feed: it keeps texts apart")
    dtype = np.uint16 if len(first) * classes < 1 << 16 else np.int32
    return Automaton(rules, byte_class, classes, (small * classes).astype(dtype).ravel(), marks[first], resets)


def _scan(a: Automaton, buf: np.ndarray) -> np.ndarray:
    """The marks after each byte. Every byte is read once; many lanes take a step at a time."""
    c = a.byte_class[buf]
    n = len(c)
    cut = 2 + np.flatnonzero(a.resets[c[:-1], c[1:]])
    at = np.searchsorted(cut, np.arange(LANE_BYTES, n, LANE_BYTES))
    start = np.unique(np.concatenate([[0], cut[at[at < len(cut)]]]))
    start = start[start < n]
    length = np.diff(start, append=n)
    by = np.argsort(-length, kind="stable")
    start, length = start[by], length[by]
    left = np.searchsorted(-length, -np.arange(int(length[0]) if n else 0), "left")  # lanes longer than t
    state = np.zeros(len(start), a.table.dtype)
    out = np.zeros(n, a.marks.dtype)
    marks = np.repeat(a.marks, a.classes) if len(a.marks) * a.classes < 1 << 20 else None
    for t in range(len(left)):
        k = left[t]
        if k < FEW_LANES:
            table, flags = a.table.tolist(), a.marks.tolist()
            for lane in range(k):
                s = int(state[lane])
                first = int(start[lane]) + t
                found = [0] * (int(length[lane]) - t)
                for i, x in enumerate(c[first : first + len(found)].tobytes()):
                    s = table[s + x]
                    found[i] = flags[s // a.classes]
                out[first : first + len(found)] = found
            break
        place = start[:k] + t
        state = a.table[state[:k] + c[place]]
        out[place] = marks[state] if marks is not None else a.marks[state // a.classes]
    return out


def _head_start(nfa: _Nfa, text: bytes, at: int, least: int) -> int:
    """The smallest start >= `least` from which the head reads exactly up to `at`: its moves taken backwards."""
    back = nfa.backwards()

    def close(states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for b, s in back.get(todo.pop(), []):
                if b is None and s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    now, best = close({nfa.end}), at
    for i in range(at, least - 1, -1):
        if nfa.start in now:
            best = i
        if i == least:
            break
        now = close({s for x in now for b, s in back.get(x, []) if b is not None and text[i - 1] in b})
        if not now:
            break
    return best


def find_spans(a: Automaton, texts: list[bytes]) -> list[list[tuple[str, int, int]]]:
    """For each text its secrets as (kind, start, end) in bytes, by start and then by the order of the rules."""
    buf, origin = joined(texts)
    marks = _scan(a, buf)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for r, rule in enumerate(a.rules):
        on = np.flatnonzero(marks & marks.dtype.type(1 << r))
        if not len(on):
            continue
        breaks = np.flatnonzero(np.diff(on) > 1)
        begin, end = on[np.concatenate([[0], breaks + 1])], on[np.append(breaks, len(on) - 1)] + 1
        if not rule.head:  # nothing before the tail: short runs need no start
            begin, end = begin[(wide := end - begin >= rule.least)], end[wide]
        head = _Nfa(rule.head)
        done = 0
        for b, e, d in zip(begin.tolist(), end.tolist(), (np.searchsorted(origin, begin, "right") - 1).tolist()):
            zero = int(origin[d])
            start = zero + _head_start(head, texts[d], b - zero, max(done - zero, 0)) if rule.head else b
            done = e
            if e - b >= rule.least:
                found[d].append((start - zero, r, e - zero))
    return [[(a.rules[r].kind, s, e) for s, r, e in sorted(f)] for f in found]


SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", more: list[Rule] = MORE) -> DataFrame:
    """For every row `id_col` and `spans`: its secrets by start and then by the order of the rules.

    Start and end are code points, end exclusive. A null or empty text has no spans (an empty array). Rows are
    scanned one by one: repeated rows and null ids come out as often as they go in, an empty table gives no rows,
    other columns are ignored, whatever their names. No shuffle; a task holds one text, or several up to a
    bounded slice.
    """
    automaton = compile_rules([*BASE, *more])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            texts = text_bytes(part.column("_text"))
            spans = []
            for t, found in zip(texts, find_spans(automaton, texts)):
                if found and not t.isascii():
                    point = code_points(t)
                    found = [(k, int(point[s]), int(point[e])) for k, s, e in found]
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
            yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(spans, arrow)], names=[id_col, "spans"])

    pair = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    return pair.mapInArrow(scan, f"`{id_col}` {kind}, spans {SPANS}")
