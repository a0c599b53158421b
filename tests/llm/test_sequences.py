"""Periodic runs, conversation repair and SentencePiece, against direct definitions and the library."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from gridlake.llm import pieces, queries
from gridlake.llm.conversations import Fold, damaged, endings, matrix, repair_conversations, steps
from gridlake.llm.conversations import Costs
from gridlake.llm.periodic import Positions, periodic_runs, runs_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Periodic runs


def plain_runs(words, least=12):
    n, out = len(words), []
    for period in range(1, n // 2 + 1):
        i = 0
        while i + period < n:
            if words[i] != words[i + period]:
                i += 1
                continue
            j = i
            while j + period < n and words[j] == words[j + period]:
                j += 1
            length = j - i + period
            if length >= max(least, 2 * period):
                part = words[i : i + length]
                if not any(part[r:] == part[: length - r] for r in range(1, period)):
                    out.append((i, length, period))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_their_definition():
    rng = random.Random(1)
    for _ in range(1500):
        k, n = rng.choice([1, 2, 2, 3, 5]), rng.randint(0, 60)
        words = []
        while len(words) < n:
            words += [rng.randint(0, k) for _ in range(rng.randint(1, 8))] * rng.choice([1, 1, 2, 5])
        least = rng.choice([12, 4, 7])
        found = runs_of(np.array(words[:n], np.uint64), np.array([0, n]), least)
        assert [tuple(r) for r in found.tolist()] == plain_runs(words[:n], least)


def test_ordered_positions():
    rng = random.Random(2)
    numbers = rng.sample(range(100_000), 9000)
    for order in (numbers, sorted(numbers), sorted(numbers, reverse=True)):
        held, seen = Positions(order[0]), {order[0]}
        for x in order[1:40] if order is numbers else order[1:]:
            before, after = held.add(x)
            if order is numbers:
                assert (before, after) == (max((y for y in seen if y < x), default=-1), min((y for y in seen if y > x), default=-1))
            seen.add(x)
        assert list(held) == sorted(seen) and held.size == len(seen)


def contract_words(key, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(key).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_periodic_run_query(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.QUERIES["op11_periodic_runs"](spark, folder).collect()
    assert Counter(r.doc_id for r in found) == Counter(texts.keys())
    for r in found:
        words = contract_words(r.doc_id, texts[r.doc_id])
        if len(words) > 1500:
            continue  # the direct count takes time with the square of the words
        runs = plain_runs(words)
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        assert r.n_runs == len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (None if best[0] is None else 1000 * best[1] // best[2])
        assert r.runs_sha256 == sha("".join(f"{s},{n},{p}\n" for s, n, p in runs))
        assert r.collapsed_sha256 == sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def test_periodic_runs_of_odd_rows(spark, odd):
    found = periodic_runs(odd).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in odd.collect())
    assert all(r.runs == [] and r.collapsed == "" for r in found if r.doc_id in (3, 4, 5))
    assert periodic_runs(odd.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "é b\n" * 200_000)], "doc_id long, text string")
    only = periodic_runs(same).first()
    assert [tuple(x) for x in only.runs] == [(0, 400_000, 2)] and only.collapsed == "é b"


# Conversations


def plain_repair(rows):
    """By conversation the report and repaired turns, from costs and audits as they are defined."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            said = " " if conv is None else conv, " " if turn is None else turn
            k = zlib.crc32(f"{said[0]}:{said[1]}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            mine += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
        digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        faults, seen = [], set()
        for _, role, text in mine:
            solid = text.strip(" \t\n\r\x0b\f")
            faults.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[1][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}
        name = {"u": "user", "a": "assistant"}
        best = {}
        for i in range(len(mine), -1, -1):
            for inserts in (3, 2, 1, 0):
                for last in follows:
                    ways = [(0, "", ())] if i == len(mine) and last in ("", "a") else []
                    for then in follows[last]:
                        if inserts < 3 and then in name and (i, then, inserts + 1) in best:
                            c, a, t = best[i, then, inserts + 1]
                            ways.append((5 + c, "I" + a, (f"{name[then]}:", t)))
                        if i < len(mine) and faults[i] not in ("b", "d") and (i + 1, then, 0) in best:
                            c, a, t = best[i + 1, then, 0]
                            c += 5 if faults[i] == "t" else 0
                            if then == initials[i]:
                                ways.append((c, "K" + a, (f"{mine[i][1]}:{mine[i][2]}", t)))
                            if then in name:
                                ways.append((c + 1, "R" + a, (f"{name[then]}:{mine[i][2]}", t)))
                    if i < len(mine) and (i + 1, last, 0) in best:
                        c, a, t = best[i + 1, last, 0]
                        ways.append((2 + c, "D" + a, t))
                    if ways:
                        best[i, last, inserts] = min(ways, key=lambda w: w[:2])
        cost, audit, chain = best[0, "", 0]
        repaired = []
        while chain:
            repaired.append(chain[0])
            chain = chain[1]
        counts = [faults.count(x) for x in "bdt"]
        out[conv] = (gaps, *counts, illegal, cost, audit, sha("\n".join(repaired))), repaired
    return out


def conversation_rows():
    rng = random.Random(3)
    rows = []
    for conv in range(150):
        for t in range(rng.choice([0, 1, 2, 3, 5, 8, 13, 30]) if conv % 50 else 1300):
            turn = None if rng.random() < 0.05 else t + (rng.randint(0, 3) if rng.random() < 0.1 else 0)
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "u", "x", "", None]) if conv % 3 else ["user", "assistant"][t % 2]
            text = rng.choice(["Yes.", "No!", "hm", "ok?", "", "\t ", None, "éç.  \n"]) if conv % 4 == 0 else f"text {t}." + rng.choice(["", "x"])
            rows.append((None if conv == 7 else conv, turn, role, text))
    rng.shuffle(rows)
    return rows


def test_repair_equals_its_definition(spark):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS conv", "'x' AS code", "0 AS n")
    repair = repair_conversations(damaged(df), present="present")
    want = plain_repair(rows)
    found = repair.report.collect()
    assert len(found) == len(want) and all(tuple(r[1:]) == want[r.conv][0] for r in found)
    turns = {conv: [] for conv in want}
    for r in sorted(repair.turns.collect(), key=lambda r: r.position):
        turns[r.conv].append(f"{r.role}:{r.text}")
    assert turns == {conv: t for conv, (_, t) in want.items()}


def test_repair_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain_repair(rows)
    found = queries.QUERIES["op12_conversation_repair"](spark, folder).collect()
    assert {r.conv_id: tuple(r[1:]) for r in found} == {k: v for k, (v, _) in want.items()}
    kind = "conv_id long, turn long, role string, text string"
    assert repair_conversations(spark.createDataFrame([], kind)).report.count() == 0


def test_repair_without_rows_and_of_one_turn(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    kind = "conv_id long, turn long, role string, text string"
    rows = [(dropped, 0, "user", "Yes.")] + [(-1, 5, "user", f"Same turn {i}.") for i in range(40)] + [(-2, None, "user", "Yes.")] * 30
    found = {r.conv: r for r in repair_conversations(damaged(spark.createDataFrame(rows, kind)), present="present").report.collect()}
    assert tuple(found[dropped][1:]) == (0, 0, 0, 0, 0, 0, "", sha(""))
    assert {c: tuple(r[1:]) for c, r in found.items()} == {c: v for c, (v, _) in plain_repair(rows).items()}


def test_undecided_ways_are_kept_whole():
    rng = random.Random(4)
    table, ends = steps(Costs()), endings(Costs())
    for sequence in (bytes([3]) * 6000, bytes(rng.choice([0, 1, 2, 3, 6, 9, 13]) for _ in range(6000))):
        cut, whole = Fold(), Fold()
        for at in range(0, 6000, 100):
            cut.add([x for x in matrix(sequence[at : at + 100], table)], 100)
        whole.add(matrix(sequence, table), 6000)
        assert cut.finish(ends) == whole.finish(ends)


# SentencePiece


def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def own():
    with open(MODEL, "rb") as f:
        return pieces.Pieces(f.read())


def test_pieces_equal_the_library():
    sp, tables, rng = library(), own(), random.Random(6)
    points = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    vocabulary = list(tables.id_of)
    mixed = ["".join(rng.choice(vocabulary).replace("▁", rng.choice([" ", "▁"])) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    letters = ["".join(rng.choice("aeithnsor  =-#*_.\n/▁<s></s>\0é漢😀") for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    spaces = [x for n in range(120) for x in (" " * n, "x" + " " * n + "y", "▁" * n + " a")]
    texts = [*points, *mixed, *letters, *spaces, "the " * 100_000 + "=" * 2000, ""]
    for text, want in zip(texts, sp.encode(texts, add_eos=True, num_threads=4)):
        assert tables.encode(text, True) == want, text[:100]
    ids = [sp.encode(t, add_eos=True) for t in [*mixed, *letters, *spaces]]
    first = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    assert tables.decode(np.concatenate(ids), first) == [sp.decode(x) for x in ids]


def test_any_ids_decode_as_in_the_library():
    sp, tables, rng = library(), own(), random.Random(7)
    for _ in range(6000):
        kinds = [rng.randint(0, 31_999), rng.randint(0, 5), rng.randint(3, 258), 259 + rng.randint(0, 20)]
        ids = [rng.choice(kinds) for _ in range(rng.randint(0, 9))]
        assert tables.decode(np.array(ids, np.int64), np.array([0, len(ids)])) == [sp.decode(ids)], ids


def test_piece_query_and_odd_rows(spark, folder, odd):
    sp = library()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.QUERIES["op13_sentencepiece_round_trip"](spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = sp.encode(texts[r.doc_id] or "", add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids)))
    rows = odd.collect()
    encoded = pieces.encode(odd, MODEL)
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == Counter((r.doc_id, tuple(sp.encode(r.text or "", add_eos=True))) for r in rows)
    assert pieces.encode(odd.limit(0), MODEL).count() == 0
    back = pieces.decode(encoded.unionByName(spark.createDataFrame([(99, None)], encoded.schema)), MODEL)
    assert Counter((r.doc_id, r.decoded) for r in back.collect()) == Counter([(r.doc_id, r.text or "") for r in rows] + [(99, "")])
    assert back.filter(F.col("ids").isNull()).count() == 1
