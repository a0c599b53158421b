"""Conversation structure repair: the cheapest edits that make roles alternate, decided by one integer minimum.

A path's weight is a single integer. Its high digits are the path's cost, its low digits the audit letters: a field of
three base-8 digits per row, left-aligned and padded with zeros, so that of two audits of equal cost the one that is
less as text is the smaller number. (At most two inserts and one edit fall on a row. Inserts stand before a row's
edit, so no field is a proper prefix of another; the inserts after the last row make a field of their own, whose zero
end padding puts the shorter audit first.) The weights of a step add up, so the ordinary minimum over a layered graph
decides everything.

Rows of a long conversation are dealt to many tasks: each segment of rows becomes a small matrix of such weights
(state before it, state after it), and the matrices of a conversation are folded in order. Texts take no part in that;
they are read once more, next to the finished audit, and leave the task as they come.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.texts import WHITE, slices
from gridlake.sources.tables import settled

SEGMENT = 512  # rows of a conversation that one matrix holds
REMEMBERED = 20_000  # segments of few rows whose matrix a worker remembers
FLUSH = 1 << 14  # bits of undecided audit that a fold keeps before it looks for a common beginning

START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"  # a row's class is the place of its role's initial here, else OTHER
OTHER = 3
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
LETTERS = str.maketrans({"0": "", "1": "D", "2": "I", "3": "K", "4": "R"})  # digits in the order of the letters
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
FIELD = 9  # bits of a row's three digits
NAMES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5  # an undeleted truncated row adds this


def _inserted(state: int, costs: Costs) -> list[tuple[int, int, list[int]]]:
    """State, cost and letters after none, one or two inserted turns; more than two never help."""
    out = [(state, 0, [])]
    for _ in range(2):
        now, cost, letters = out[-1]
        out.append((next(x for x in FOLLOWS[now] if x != SYSTEM), cost + costs.insert, [*letters, INSERT]))
    return out


def _field(letters: list[int]) -> int:
    return sum(x << (3 * (2 - i)) for i, x in enumerate(letters))


def steps(costs: Costs) -> list[list[tuple[int, int, int, int]]]:
    """For each row code (class + 4 * fault) the edges (state before, state after, cost, field), cheapest per pair."""
    table = []
    for code in range(16):
        kind, fault = code % 4, code // 4
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for state in FOLLOWS:
            for now, cost, letters in _inserted(state, costs):
                edits = [(now, costs.delete, DELETE)]
                if fault in (FINE, TRUNCATED):
                    more = costs.truncated if fault == TRUNCATED else 0
                    for then in FOLLOWS[now]:
                        if kind != OTHER and then == kind + 1:
                            edits.append((then, more, KEEP))
                        if then != SYSTEM:
                            edits.append((then, costs.rerole + more, REROLE))
                for then, extra, letter in edits:
                    weight = (cost + extra, _field([*letters, letter]))
                    best[state, then] = min(best.get((state, then), weight), weight)
        table.append([(a, b, cost, field) for (a, b), (cost, field) in sorted(best.items())])
    return table


def endings(costs: Costs) -> list[tuple[int, int]]:
    """For each state the cost and field of the inserts that complete the conversation."""
    out = []
    for state in FOLLOWS:
        done = [(c, _field(x)) for now, c, x in _inserted(state, costs) if now in (START, ASSISTANT)]
        out.append(min(done))
    return out


def matrix(codes: bytes, table: list) -> list[int | None]:
    """Least weight from each state to each (4 x 4, None where there is no way); cost stands above all fields."""
    width = FIELD * len(codes)
    out: list[int | None] = []
    for begin in FOLLOWS:
        now: list[int | None] = [None] * 4
        now[begin] = 0
        for i, code in enumerate(codes):
            after: list[int | None] = [None] * 4
            shift = FIELD * (len(codes) - 1 - i)
            for a, b, cost, field in table[code]:
                if now[a] is not None:
                    weight = now[a] + (cost << width) + (field << shift)
                    if after[b] is None or weight < after[b]:
                        after[b] = weight
            now = after
        out += now
    return out


class Fold:
    """The weights of all ways from the start through the segments so far, by the state they end in."""

    def __init__(self):
        self.weights: list[int | None] = [0, None, None, None]
        self.width, self.cost, self.decided = 0, 0, []

    def add(self, entries: list[int | None], rows: int) -> None:
        more = FIELD * rows
        low, width = (1 << more) - 1, self.width + more
        after: list[int | None] = [None] * 4
        for a, weight in enumerate(self.weights):
            for b in range(4):
                entry = entries[4 * a + b]
                if weight is not None and entry is not None:
                    whole = (weight << more) + ((entry >> more) << width) + (entry & low)
                    if after[b] is None or whole < after[b]:
                        after[b] = whole
        self.weights, self.width = after, width
        if width > FLUSH:
            self._flush()

    def _flush(self) -> None:
        """Take off the least cost and the fields in which all ways agree."""
        low = (1 << self.width) - 1
        known = [x for x in self.weights if x is not None]
        apart = 0
        for x in known:
            apart |= (x ^ known[0]) & low
        keep = -(-apart.bit_length() // FIELD) * FIELD
        least = min(x >> self.width for x in known)
        common = (known[0] & low) >> keep
        if self.width > keep:
            self.decided.append(format(common, "o").zfill((self.width - keep) // 3).translate(LETTERS))
        rest = (1 << keep) - 1
        self.weights = [None if x is None else (((x >> self.width) - least) << keep) + (x & rest) for x in self.weights]
        self.width, self.cost = keep, self.cost + least

    def finish(self, ends: list[tuple[int, int]]) -> tuple[int, str]:
        """Cost and audit of the best way to a complete conversation."""
        width = self.width + FIELD
        best = min((x << FIELD) + (c << width) + f for x, (c, f) in zip(self.weights, ends) if x is not None)
        audit = format(best & ((1 << width) - 1), "o").zfill(width // 3).translate(LETTERS)
        return self.cost + (best >> width), "".join([*self.decided, audit])


def illegal_pairs(classes: list[int]) -> int:
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(classes, classes[1:]))


def wrapped(n: int) -> int:
    """As a 64-bit integer."""
    return (n + (1 << 63)) % (1 << 64) - (1 << 63)


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def _rows(df: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    """The columns all steps use. A row that is not present only names its conversation."""
    here = F.coalesce(F.col(f"`{present}`"), F.lit(False)) if present else F.lit(True)
    return df.select(
        F.col(f"`{conv}`").alias("conv"),
        F.when(here, F.col(f"`{turn}`").cast("long")).alias("turn"),
        F.when(here, F.coalesce(F.col(f"`{role}`"), F.lit(" "))).alias("role"),
        F.when(here, F.coalesce(F.col(f"`{text}`"), F.lit(" "))).alias("text"),
    )


def _light(rows: DataFrame) -> DataFrame:
    """Distinct rows without texts: digest of role and text, class and fault, and how often the row is there."""
    solid = F.rtrim("text", F.lit(WHITE.decode()))
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    kind = F.when(F.length("role") == 0, OTHER).otherwise(F.when(initial > 0, initial - 1).otherwise(OTHER))
    fault = (
        F.when(F.length(solid) == 0, BLANK)
        .when(~F.right(solid, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
        .otherwise(FINE)
    )
    code = F.when(F.col("role").isNotNull(), kind + 4 * fault).cast("int")
    digest = F.when(F.col("role").isNotNull(), _digest(F.col("role"), F.col("text")))
    return rows.select("conv", "turn", digest.alias("digest"), code.alias("code")).groupBy("conv", "turn", "digest", "code").count()


SEGMENTS = (
    "part int, seg int, codes binary, weights array<binary>, first_turn long, last_turn long, n_turns long, low long, high long"
)
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _segments(light: DataFrame, kind: str, costs: Costs) -> DataFrame:
    """Rows in order, in many partitions, as segments with their matrices."""
    table = steps(costs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered: dict[bytes, list] = {}
        part, schema = TaskContext.get().partitionId(), None
        done: list[dict] = []
        now: dict | None = None

        def weights(codes: bytes) -> list:
            found = remembered.get(codes)
            if found is None:
                found = [None if x is None else x.to_bytes((x.bit_length() + 7) // 8, "big") for x in matrix(codes, table)]
                if len(codes) <= 16:
                    if len(remembered) >= REMEMBERED:
                        remembered.clear()
                    remembered[codes] = found
            return found

        def begin(conv, seg: int) -> dict:
            return {"conv": conv, "part": part, "seg": seg, "codes": bytearray(), "turns": [None, None, 0, None, None]}

        def close(x: dict) -> None:
            x["codes"] = bytes(x["codes"])
            x["weights"] = weights(x["codes"])
            x |= dict(zip(("first_turn", "last_turn", "n_turns", "low", "high"), x.pop("turns")))
            done.append(x)

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            names = ["conv", "part", "seg", "codes", "weights", "first_turn", "last_turn", "n_turns", "low", "high"]
            types = [schema, pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.binary()), *[pa.int64()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names)

        for batch in batches:
            schema = batch.schema.field("conv").type
            for conv, turn, code, repeat, count in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "code", "repeat", "n"))):
                if now is None or conv != now["conv"]:
                    if now is not None:
                        close(now)
                    now = begin(conv, 0)
                if code is None:
                    continue  # names its conversation only
                turns = now["turns"]
                if turn is not None:
                    if turn != turns[1]:
                        turns[2] += 1
                    turns[0] = turn if turns[0] is None else turns[0]
                    turns[1] = turns[4] = turn
                    turns[3] = turn if turns[3] is None else turns[3]
                again = code if code // 4 == BLANK else code % 4 + 4 * DUPLICATE
                codes = bytes([again if repeat else code]) + bytes([again]) * (count - 1)
                at = 0
                while at < len(codes):
                    if len(now["codes"]) == SEGMENT:
                        close(now)
                        last = turn
                        now = begin(conv, now["seg"] + 1)
                        now["turns"] = [last, last, int(last is not None), last, last]
                    take = SEGMENT - len(now["codes"])
                    now["codes"] += codes[at : at + take]
                    at += take
            if len(done) >= 1000:
                yield batch_of(done)
                done = []
        if now is not None:
            close(now)
        if done:
            yield batch_of(done)

    placed = light.repartitionByRange("conv", F.col("turn").asc_nulls_first(), "digest").sortWithinPartitions(
        "conv", F.col("turn").asc_nulls_first(), "digest"
    )
    return placed.select("conv", "turn", "code", "repeat", "n").mapInArrow(cut, f"conv {kind}, {SEGMENTS}")


def _fold(segments: DataFrame, kind: str, costs: Costs) -> DataFrame:
    """One row per conversation: REPORT, from its segments in order."""
    ends = endings(costs)
    names = [x.split()[0] for x in REPORT.split(", ")]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, schema, rows = None, None, []
        way, faults, illegal, last_class, turns = Fold(), [0] * 4, 0, None, [None, None, 0, None]

        def report() -> tuple:
            cost, audit = way.finish(ends)
            gaps = 0 if turns[0] is None else wrapped(turns[1] - turns[0] + 1 - turns[2])
            return now[0], gaps, *faults[1:], illegal, cost, audit

        def batch_of() -> pa.RecordBatch:
            types = [schema, *[pa.int64()] * 6, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["conv", *names])

        for batch in batches:
            schema = batch.schema.field("conv").type
            for r in batch.to_pylist():
                if now is None or r["conv"] != now[0]:
                    if now is not None:
                        rows.append(report())
                    now = (r["conv"],)
                    way, faults, illegal, last_class, turns = Fold(), [0] * 4, 0, None, [None, None, 0, None]
                codes = r["codes"]
                if not codes:
                    continue
                classes = [c % 4 for c in codes]
                illegal += illegal_pairs(classes if last_class is None else [last_class, *classes])
                last_class = classes[-1]
                for c in codes:
                    faults[c // 4] += 1
                way.add([None if x is None else int.from_bytes(x, "big") for x in r["weights"]], len(codes))
                if r["low"] is not None:
                    turns[0] = r["low"] if turns[0] is None else turns[0]
                    turns[2] += r["n_turns"] - (turns[3] is not None and turns[3] == r["first_turn"])
                    turns[1] = r["high"]
                    turns[3] = r["last_turn"]
            if len(rows) >= 1000:
                yield batch_of()
                rows = []
        if now is not None:
            rows.append(report())
        if rows:
            yield batch_of()

    met = segments.repartition("conv").sortWithinPartitions("conv", "part", "seg")
    return met.mapInArrow(fold, f"conv {kind}, {REPORT}")


def plan_repair(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """`conv` and REPORT for every conversation of `_rows`."""
    kind = rows.schema["conv"].dataType.simpleString()
    light = settled(_light(rows).withColumnRenamed("count", "n"), "conversation_rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    earliest = (
        light.filter("code IS NOT NULL").groupBy("conv", "digest").agg(F.min(place).alias("earliest"))
        .withColumnsRenamed({"conv": "_conv", "digest": "_digest"})
    )
    marked = light.join(earliest, light["conv"].eqNullSafe(F.col("_conv")) & (light["digest"] == F.col("_digest")), "left")
    repeat = F.coalesce(~place.eqNullSafe(F.col("earliest")), F.lit(False))
    ready = settled(marked.select("conv", "turn", "digest", "code", "n", repeat.alias("repeat")), "conversation_marks")
    return _fold(_segments(ready, kind, costs), kind, costs)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """For each conversation its report, then each repaired turn as (letter, role, text); rows come in order."""

    def turns(row: tuple | None) -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state = next(x for x in FOLLOWS[state] if x != SYSTEM)
            at += 1
            yield "I", NAMES[state], ""
        if row is None:
            return
        letter, (role, text) = audit[at], row
        at += 1
        if letter == "D":
            return
        if letter == "K":
            state = INITIALS.index(role[0]) + 1
        else:
            state = next(x for x in FOLLOWS[state] if x != SYSTEM)
            role = NAMES[state]
        yield letter, role, text

    audit, at, state, open_ = "", 0, START, False
    for batch in batches:
        for part in slices(iter([batch]), "text"):
            names = ("report", "role", "text")
            for report, role, text in zip(*(part.column(c).to_pylist() for c in names)):
                if report is not None:
                    if open_:
                        yield from turns(None)
                    audit, at, state, open_ = report["audit"], 0, START, True
                    yield (report,)
                else:
                    yield from turns((role, text))
    if open_:
        yield from turns(None)


@dataclass(frozen=True)
class Repair:
    """`report`: a row per conversation; `turns`: the repaired conversations, a row per turn."""

    report: DataFrame
    turns: DataFrame


def repair_conversations(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    present: str | None = None, costs: Costs = Costs(),
) -> Repair:
    """The cheapest edits that make each conversation's role initials read `(s?(ua)+)?`.

    Keep, rerole to user or assistant, delete (required for blank and duplicate rows), or insert an empty user or
    assistant turn anywhere; of equally cheap edits those whose initials (`audit`) are least in ASCII order.
    `report` has `conv`, the counts of faults and gaps, `cost`, `audit` and `repaired_sha256` (of `role:text`, joined by
    newlines); `turns` has `conv`, `position`, `edit`, `role` and `text`.

    A null role or text is one space. Rows are taken by turn, null first; rows of one turn by the digest of role and
    text, so equal rows stand together and all but the first are duplicates. Null is a conversation of its own. A row
    whose `present` is not true is no row, but its conversation is reported (zeros, empty audit). An empty table gives
    no rows; other columns are ignored, whatever their names. `gaps` is a 64-bit number and wraps.

    Only the last step, which hashes or returns a conversation's texts in order, takes one conversation in one task,
    and there row by row; besides, a task holds the audit, one letter per row, which is part of the result.
    """
    rows = _rows(df, conv, turn, role, text, present)
    kind = rows.schema["conv"].dataType.simpleString()
    report = settled(plan_repair(rows, costs), "conversation_reports")
    named = [x.split()[0] for x in REPORT.split(", ")]
    blank = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("digest", "binary"))]
    heads = report.select("conv", F.struct("conv", *named).alias("report"), *blank)
    none = F.lit(None).cast(heads.schema["report"].dataType).alias("report")
    bodies = rows.filter("role IS NOT NULL").select(
        "conv", none, "turn", "role", "text", _digest(F.col("role"), F.col("text")).alias("digest")
    )
    met = (
        heads.unionByName(bodies).repartition("conv")
        .sortWithinPartitions("conv", F.col("report").isNull(), F.col("turn").asc_nulls_first(), "digest")
        .select("report", "role", "text")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, now, sha, count = [], None, None, 0
        for x in _walk(batches):
            if len(x) == 1:
                if now is not None:
                    rows.append(now | {"repaired_sha256": sha.hexdigest()})
                if len(rows) >= 1000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
                now, sha, count = x[0], hashlib.sha256(), 0
            else:
                sha.update(f"{chr(10) if count else ''}{x[1]}:{x[2]}".encode())
                count += 1
        if now is not None:
            rows.append(now | {"repaired_sha256": sha.hexdigest()})
            yield pa.RecordBatch.from_pylist(rows, schema)

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, now, count = [], 0, None, 0
        for x in _walk(batches):
            if len(x) == 1:
                now, count = x[0]["conv"], 0
                continue
            rows.append((now, count, *x))
            count, size = count + 1, size + len(x[2])
            if size > 1 << 22 or len(rows) >= 10_000:
                yield turn_batch(rows)
                rows, size = [], 0
        if rows:
            yield turn_batch(rows)

    conv_type = _arrow_type(report, "conv")
    schema = pa.schema(
        [("conv", conv_type), *[(c, pa.int64()) for c in named[:-1]], ("audit", pa.string()), ("repaired_sha256", pa.string())]
    )
    turn_types = [conv_type, pa.int64(), pa.string(), pa.string(), pa.string()]

    def turn_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), turn_types)]
        return pa.RecordBatch.from_arrays(columns, names=["conv", "position", "edit", "role", "text"])

    return Repair(
        met.mapInArrow(hashed, f"conv {kind}, {REPORT}, repaired_sha256 string"),
        met.mapInArrow(repaired, f"conv {kind}, position long, edit string, role string, text string"),
    )


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def damaged(df: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of `conv_id:turn` (nulls: one space) modulo 20; `present` is false for dropped rows."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = (
        F.when(fault == 1, "")
        .when(fault == 2, F.translate(said("text"), ".!?", ""))
        .otherwise(said("text"))
    )
    role = F.when(fault == 4, "user").otherwise(said("role"))
    copies = F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")
    return df.select("conv_id", "turn", role.alias("role"), text.alias("text"), (fault != 0).alias("present"), copies).drop("copy")

