"""The pipeline against plain Python, stage by stage, over a small planted table."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_joins import plain_classes, shared_blocks
from test_scans import plain_hits
from tokenizers import Tokenizer

import corpus_pipeline

WHITE_WORD = "[^\x20\x09-\x0D]+"


def repeated_windows(words, size):
    found = Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return {j for i in range(len(words) - size + 1) if found[tuple(words[i : i + size])] > 1 for j in range(i, i + size)}


def is_good(text):
    """The base rules, and the limits that README and `Limits` state."""
    words = re.findall(WHITE_WORD, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(WHITE_WORD, x)]
    longest = next((n - 1 for n in range(1, len(words) + 1) if not repeated_windows(words, n)), 0)
    return (
        len(words) >= 50 and 100 * len(repeated_windows(words, 3)) <= 50 * len(words)
        and 100 * len(repeated_windows(words, 8)) <= 30 * len(words) and longest <= 400
        and 100 * sum(c in "#*$%&|<>" for c in text) <= 30 * len(words)
        and 100 * (len(lines) - len(set(lines))) <= 50 * len(lines)
    )


def plain_quality(rows, bench):
    return [(i, t) for i, t in rows if is_good(t)]


def plain_lines(rows, bench):
    gone, out = shared_blocks(rows), []
    for i, text in rows:
        rest = "\n".join(x for p, x in enumerate(text.split("\n")) if p not in gone[i])
        if rest.strip() or not gone[i]:
            out.append((i, rest))
    return out


def plain_near(rows, bench):
    first = {i for i, _, least in plain_classes(rows) if i == least}
    return [(i, t) for i, t in rows if i in first]


def plain_decontaminated(rows, bench):
    out = []
    for i, text in rows:
        while hit := plain_hits(text, bench)[1]:
            at = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))]
            held = set()
            for w in hit:
                held |= set(range(at[w][0], at[w + 1][0] if w + 1 in hit else at[w][1]))
            text = "".join(c for p, c in enumerate(text) if p not in held)
        out.append((i, text))
    return out


def plain_tokens(rows, bench):
    library, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), []
    for i, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((i, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    return out


PLAIN = [plain_quality, plain_lines, plain_near, plain_decontaminated, plain_tokens]


@pytest.fixture(scope="module")
def planted():
    """Documents with copies, near copies, shared passages, benchmark phrases, repetition and odd texts."""
    rng = random.Random(21)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("", "n", "r's", "é")]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    lines = lambda k: [" ".join(words(rng.randint(3, 25))) for _ in range(k)]
    bench = [(f"i{k}", " ".join(words(rng.choice([4, 10, 13])))) for k in range(6)]
    bench += [("inner", "Alpha beta, gamma"), ("outer", "zeta eta theta iota"), ("none", ""), ("null", None)]
    verse = ["short lines of", "one verse", "that many documents", "hold in full"]
    texts = ["\n".join(lines(rng.randint(6, 12))) for _ in range(30)]
    texts += [texts[3], texts[4] + "\n" + " ".join(words(60)), "\n".join(lines(5) + texts[7].split("\n")[2:6] + lines(2))]
    texts += ["\n".join(lines(5) + verse + lines(1)) for _ in range(4)]
    base = words(160)
    for k in range(4):  # one line each, so that only the near-duplicate stage can tell
        copy = list(base)
        copy[10 * k + 5] = f"changed{k}"
        texts.append(" ".join(copy))
    texts += [" ".join([*base[:80], *words(80)]), " ".join(words(70) + words(5) * 20), "\n".join(lines(1) * 12), " ".join(words(49)), " ".join(words(50))]
    for _, phrase in bench[:6]:
        texts.append(" ".join([*words(40), phrase.upper() if rng.random() < 0.5 else phrase + ".", *words(30)]))
    texts += [" ".join([*words(60), "zeta eta alpha BETA gamma theta iota", *words(9)]), " ".join(words(60)) + " # $" * 20, None, "", " \n\t", " ".join(words(60)) + "<|endoftext|> 漢字 😀"]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(3 * i + 1, texts[k]) for i, k in enumerate(order)], bench


def test_stages_and_run_equal_plain_python(spark, planted, tmp_path):
    rows, bench = planted
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text"))
    docs.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), rows
    for k, ((name, stage), plain) in enumerate(zip(corpus_pipeline.STAGES, PLAIN, strict=True)):
        before, left = left, plain(left, bench)
        assert left != before, f"nothing is planted for {name}"
        found = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert found.columns == docs.columns
            found.write.parquet(f"{tmp_path}/{name}")
            docs = spark.read.parquet(f"{tmp_path}/{name}")
            assert all(r.n_chars == len(r.text) for r in docs.collect())
            assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(left), name
        else:
            assert sorted(map(tuple, found.collect())) == sorted(left)
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(left)
