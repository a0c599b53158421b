"""Operators that compare rows, and the pipeline, against direct computations."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from compare import differences, engine
from pyspark.sql import functions as F

import corpus_pipeline
from gridlake.llm import queries
from gridlake.llm.components import components
from gridlake.llm.decontamination import without_benchmark
from gridlake.llm.jaccard import one_of_each_class, similar_classes
from gridlake.llm import line_dedup
from gridlake.llm.line_dedup import patience, without_repeated_lines
from gridlake.llm.repetition import keep_good
from gridlake.llm.resampling import importance_resample, kth_largest, measured_buckets
from gridlake.llm.url_rules import judge_urls


def written(df, tmp_path, name):
    df.write.parquet(str(tmp_path / name))
    return df.sparkSession.read.parquet(str(tmp_path / name))


# URLs


def test_url_query_equals_sql(spark, folder):
    for name, sql in queries.SQL.items():
        assert differences(queries.QUERIES[name](spark, folder), engine(folder), sql) is None


def test_urls_against_all_rules(spark):
    rng = random.Random(3)
    hosts = ["org", "example.org", "a.example.org", "notexample.org", "com", "x.com", "EXAMPLE.org", "", ".org", "a..org", "org:80"]
    paths = ["", "/", "/a", "/a/b", "/ab", "/a/b?x", "#f", "/é", "/b/c"]
    rules = {(rng.choice(hosts[:6]), rng.choice(paths[:6]), rng.choice(["allow", "block"])) for _ in range(25)}
    rows = [(i if i % 7 else None, f"http://{rng.choice(hosts)}{rng.choice(paths)}") for i in range(500)]
    rows += [(1, None), (2, ""), (3, "org/a"), *[(4, "http://x.com/a")] * 700]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("mine"))
    want = Counter()
    for i, url in rows:
        host, path = "", ""
        if url and "://" in url:
            host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: (len(r[0]), len(r[1]), r[2]), default=None)
        want[i, host, path, best and best[0] + best[1], best[2] if best else "allow"] += 1
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("com", None, "allow")], "host string, path string, verdict string")
    assert Counter(map(tuple, judge_urls(pages, table).collect())) == want
    assert judge_urls(pages.limit(0), table).count() == 0
    assert judge_urls(pages, table.limit(0)).filter("rule IS NULL AND verdict = 'allow'").count() == len(rows)


# Jaccard


def plain_classes(rows):
    sets = []
    for _, text in rows:
        words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append(frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset())
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    at = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in at[x])
        for j, k in common.items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
        for x in s:
            at[x].append(i)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].append(doc_id)
    least = {c: min((x for x in v if x is not None), default=None) for c, v in ids.items()}
    return Counter((doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows))


def test_jaccard_query_equals_direct_join(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert Counter(map(tuple, queries.QUERIES["op7_ngram_jaccard_join"](spark, folder).collect())) == plain_classes(rows)


@pytest.mark.parametrize("batch", ["10000", "7"])
def test_jaccard_of_copies_passages_and_odd_rows(spark, odd, tmp_path, batch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    bases = [rng.choices(words, k=rng.randint(3, 120)) for _ in range(15)]
    passage = rng.choices(words, k=60)
    rows = []
    for i in range(500):
        text = rng.choices(words, k=rng.randint(0, 40)) + passage if i % 3 == 0 else list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i + 100, " ".join(text).upper() if i % 5 == 0 else "  ".join(text)))
    docs = written(spark.createDataFrame(rows, "doc_id long, text string").union(odd.select("doc_id", "text")), tmp_path, "docs")
    rows = [tuple(r) for r in docs.collect()]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert Counter(map(tuple, similar_classes(docs.withColumn("_hash", F.lit(1))).collect())) == plain_classes(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert similar_classes(docs.limit(0)).count() == 0
    one = one_of_each_class(docs.filter("doc_id >= 100"))
    assert {r.doc_id for r in one.collect()} == {c for (_, n, c) in plain_classes([r for r in rows if r[0] and r[0] >= 100])}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 3), (200, 200), (300, 301), (301, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# Lines


def test_patience_aligns():
    assert patience([1, 2, 3, 4], [1, 9, 3, 4]) == [(0, 0), (2, 2), (3, 3)]
    assert patience([1, 2, 3], [3, 1, 2]) == [(0, 1), (1, 2)]
    assert patience([], [1]) == patience([1], [2]) == []
    rng = random.Random(8)
    for _ in range(300):
        a, b = ([rng.randint(0, 9) for _ in range(rng.randint(0, 12))] for _ in range(2))
        found = patience(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))


def first_holders(rows, least=8):
    """The smallest id that holds each line of `least` words or more."""
    first = {}
    for doc_id, text in sorted(set(rows)):
        for line in text.split("\n"):
            if len(line.split()) >= least:
                first.setdefault(line, doc_id)
    return first


@pytest.mark.parametrize("rare", [1000, 2])
def test_lines_stay_once(spark, tmp_path, rare):
    rng = random.Random(6)
    line = lambda n: " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(n))
    shared = [line(12) for _ in range(6)]
    rows = []
    for i in range(60):
        lines = [line(rng.randint(1, 20)) for _ in range(4)]
        lines.insert(rng.randint(0, 4), rng.choice(shared))
        rows.append((i, "\n".join(lines)))
    rows += [(100, rows[3][1]), (101, "short\nlines"), (102, "short\nlines"), (103, ""), (104, "\n")]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text")), tmp_path, "lines")
    got = {r.doc_id: r for r in without_repeated_lines(docs, rare=rare).collect()}
    first = first_holders(rows)
    want = {i: "\n".join(x for x in t.split("\n") if first.get(x, i) == i) for i, t in rows}
    assert 100 not in got and set(got) == set(want) - {100}
    for i, r in got.items():
        assert r.text == want[i] and r.n_chars == len(r.text)


@pytest.mark.parametrize("copies", [3, 4, 9])
def test_copies_with_short_lines_go_whole_at_any_size(spark, tmp_path, copies):
    text = "one two\na b c d e f g h i j\nthree four five\nk l m n o p q r s t\nsix"
    other = "u0 u1 u2\na b c d e f g h i j\nu3 u4"
    rows = [*((i, text) for i in range(copies)), (50, other)]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string"), tmp_path, "copies")
    got = dict(map(tuple, without_repeated_lines(docs, rare=4).collect()))
    assert got == {0: text, 50: "u0 u1 u2\nu3 u4"}


def test_passages_of_short_lines_are_found(spark, tmp_path):
    verse = "\n".join(f"line {i} of the verse\n" for i in range(10))  # no line has eight words
    rows = [(i, f"own {i}\n{verse}\nend {i}") for i in range(5)] + [(9, "a b c\nline 3 of the verse\nline 5 of the verse")]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string"), tmp_path, "verse")
    got = dict(map(tuple, without_repeated_lines(docs).collect()))
    assert got[0] == rows[0][1] and got[9] == rows[5][1]
    assert all(got[i].split() == ["own", str(i), "end", str(i)] for i in range(1, 5))


def shared_blocks(rows, least=8):
    """Of each text, the places of the lines in a block of `least` words that a text of a smaller id holds."""
    gone, seen = {}, set()
    for doc_id, text in sorted(rows):
        lines = [(p, x) for p, x in enumerate(text.split("\n")) if x.split()]
        own, gone[doc_id] = set(), set()
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                block = tuple(x for _, x in lines[a:b])
                if sum(len(x.split()) for x in block) >= least:
                    own.add(block)
                    gone[doc_id] |= {p for p, _ in lines[a:b] if block in seen}
        seen |= own
    return gone


def test_blocks_go_whatever_their_order(spark, tmp_path):
    rng = random.Random(12)
    a, b, c = ("\n".join(f"{x}{k} {x}{k} {x}{k}" for k in range(4)) for x in "abc")  # 12 words each in short lines
    long = "p q r s t u v w x"
    rows = [
        (0, f"{a}\n{b}\n{c}"), (1, f"{c}\nmine\n{b}\nmine too\n{a}"),  # crossed
        (2, f"{long}\nlone 2"), (3, f"{long}\n1\n{long}\n2\n{long}"), (4, f"{long}\n3\n{long}\n1"),  # held twice
        (5, f"{long}\ntail"), (6, f"head\n{long}\ntail"), (7, f"head\n{long}"),  # what the earliest holder lacks
    ]
    for i in range(10, 150):
        rows.append((i, "\n".join(" ".join([rng.choice("abcdef")] * rng.choice([0, 1, 2, 3, 5, 9])) for _ in range(rng.randint(1, 12)))))
    docs = written(spark.createDataFrame(rows, "doc_id long, text string"), tmp_path, "blocks")
    want = {}
    for i, gone in shared_blocks(rows).items():
        rest = "\n".join(x for p, x in enumerate(dict(rows)[i].split("\n")) if p not in gone)
        if rest.strip() or not gone:
            want[i] = rest
    assert want[1] == "mine\nmine too" and want[3] == "1\n2" and 7 not in want
    assert dict(map(tuple, without_repeated_lines(docs, rare=5).collect())) == want


def test_only_alignments_take_lines(monkeypatch):
    late, words = [1, 2, 9, 5, 6, 8, 1, 2], [5] * 8
    runs = [(0, 2), (3, 2), (6, 2)]
    early = [5, 6, 7, 1, 2, 3]
    assert line_dedup.aligned_lines(early, late, words, runs, 8) == {0, 1, 3, 4, 6, 7}  # crossed, and held twice
    assert line_dedup.aligned_lines([4] * 5, [4, 4, 3, 4, 4], [4] * 5, [(0, 2), (3, 2)], 8) == {0, 1, 3, 4}
    monkeypatch.setattr(line_dedup, "common_blocks", lambda *_: [])
    assert line_dedup.aligned_lines(early, late, words, runs, 8) == set()


def test_columns_may_have_any_name(spark):
    text = "a b c d e f g h i"
    rows = [(1, text, 1, "x", 2, 3, 4), (2, f"own\n{text}", 5, "y", 6, 7, 8), (3, f"{text}\n\u0085", 9, "z", 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _gone int, _rest string, _own_id int, _own_hash int, _own int")
    found = {r.doc_id: tuple(r) for r in without_repeated_lines(docs).collect()}
    assert found == {1: rows[0], 2: (2, "own", *rows[1][2:]), 3: (3, "\u0085", *rows[2][2:])}
    assert one_of_each_class(docs).columns == docs.columns and [r.doc_id for r in one_of_each_class(docs).collect()] == [1]


def test_lines_of_odd_rows(spark, odd):
    out = without_repeated_lines(odd)
    assert out.columns == odd.columns
    # The text of id 1 stays (twice); the same text goes from id 2 and from the null id.
    assert Counter(r.doc_id for r in out.collect()) == Counter([1, 1, 3, None, 4, 5, 6, 7, 8])
    assert without_repeated_lines(odd.limit(0)).count() == 0


# Decontamination


def test_cuts_do_not_depend_on_benchmark_blocks(spark, monkeypatch):
    items, rows = [], []
    for i in range(6):
        outer, inner = ([f"{c}{i}x{k}" for k in range(8)] for c in "op")
        items += [(2 * i, " ".join(outer)), (2 * i + 1, " ".join(inner)), (20 + i, " ".join([*inner[4:], f"q{i}"]))]
        # The outer phrase forms when the inner one is gone; the third overlaps the inner one.
        rows.append((i, "é, " + " ".join(["start", *outer[:3], *inner, *outer[3:], "end"]), 0))
        rows.append((10 + i, " ".join(["Start", *inner, f"q{i}.", "end"]), 0))
    rows += [(30, None, None), (31, "", 0), (32, "clean text", 10), (32, "clean text", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = Counter([(i, "é, start  end", 13) for i in range(6)] + [(10 + i, "Start . end", 11) for i in range(6)] + rows[12:])
    for words in (1_000_000, 300):
        monkeypatch.setattr("gridlake.llm.decontamination.PASS_WORDS", words)
        out = without_benchmark(docs, bench)
        assert Counter(map(tuple, out.collect())) == want and out.columns == docs.columns


# Resampling


def test_weights_tell_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"  # enough labels for the bigrams of both halves
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = importance_resample(docs, labels.filter("doc_id % 2 = 0"))
    rows = scored.join(labels.filter("doc_id % 2 = 1"), "doc_id").select("quality", F.col("log_weight").alias("w")).collect()
    good, bad = ([r.w for r in rows if r.quality == q] for q in (1, 0))
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > 0.97


def test_resampling_weights_equal_a_plain_model(spark):
    """Counters of unigrams and bigrams; with so many buckets no two of these share one."""
    rng, buckets = random.Random(4), 1 << 22
    texts = {i: " ".join(rng.choice(["ab", "c", "Ab", "d\te", "ü", "f\n"]) for _ in range(rng.randrange(12))) for i in range(60)}
    texts |= {60: None, 61: " \x0b "}
    good = [i for i in texts if i % 3 == 0 or i == 60]
    labels = spark.createDataFrame([(i, int(i in good)) for i in texts], "doc_id long, quality int")
    rows = importance_resample(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4), labels, buckets=buckets).collect()

    def grams(i):
        words = re.findall("[^\x20\x09-\x0D]+", texts[i] or "")
        return words + list(zip(words, words[1:]))

    raw, shown = (Counter(g for i in ids for g in grams(i)) for ids in (texts, good))
    ratio = {g: math.log((shown[g] + 1) / (shown.total() + buckets)) - math.log((raw[g] + 1) / (raw.total() + buckets)) for g in raw}
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_grams == len(grams(r.doc_id)) and abs(r.log_weight - sum(ratio[g] for g in grams(r.doc_id))) < 1e-9
    keys = sorted((r.key for r in rows), reverse=True)
    assert {r.doc_id for r in rows if r.kept} == {r.doc_id for r in rows if r.key >= keys[len(good) - 1]}


def test_model_grows_with_the_texts():
    sizes = [0, 1, 10**6, 10**8, 5 * 10**8, 3 * 10**10, 10**14]
    assert [measured_buckets(s).bit_length() - 1 for s in sizes] == [14, 14, 14, 15, 16, 19, 25]


def test_resampling_takes_the_largest_keys(spark, folder, odd):
    rows = queries.QUERIES["op10_importance_resampling"](spark, folder).collect()
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    k = round(labels.filter("quality = 1").count() / labels.count() * len(rows))
    assert {r.doc_id for r in rows if r.kept} == {r.doc_id for r in sorted(rows, key=lambda r: -r.key)[:k]}
    none = labels.limit(0)
    assert importance_resample(odd, none).filter("kept AND log_weight = 0").count() == odd.count()
    assert importance_resample(odd.limit(0), labels).count() == 0
    some = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (7, None), (4, 0)], "doc_id long, quality int")
    assert Counter(r.doc_id for r in importance_resample(odd, some, share=0.5).collect()) == Counter(r.doc_id for r in odd.collect())


def test_kth_largest(spark):
    rng = random.Random(9)
    values = [rng.randint(-(2**63), 2**63 - 1) for _ in range(200)] + [0, 0, -1, -1, 5]
    table = spark.createDataFrame([(v,) for v in values], "x long")
    for k in (1, 2, 100, len(values)):
        assert kth_largest(table, "x", k) == sorted(values, reverse=True)[k - 1]
    assert kth_largest(table, "x", len(values) + 1) is None


# Pipeline


def test_pipeline_takes_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
    result = corpus_pipeline.run(spark, folder)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    ids = [r.doc_id for r in result.collect()]
    assert len(ids) == len(set(ids)) and set(ids) <= {r.doc_id for r in keep_good(docs).collect()}
    left = without_benchmark(one_of_each_class(without_repeated_lines(keep_good(docs))), bench)
    want = {r.doc_id: r.h for r in left.select("doc_id", F.sha2("text", 256).alias("h")).collect()}
    assert {r.doc_id: r.decoded_sha256 for r in result.collect()} == want


def test_pipeline_of_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0, name
