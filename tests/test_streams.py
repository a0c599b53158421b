"""Streams over several landed files: late rows, corrections, replays."""

from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from gridlake.queries import QUERIES
from gridlake.sources.loading import upsert
from gridlake.streaming import streams

SCHEMA = "id long, ts timestamp_ntz, kind string, value double"
START = datetime(2025, 1, 1)


def land(spark, folder, number, data):
    """One file per batch, in order of arrival."""
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{folder}/{number}")


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def event(i, minutes, value, kind="a"):
    return (i, START + timedelta(minutes=minutes), kind, float(value))


def test_hourly_mean_waits_for_late_rows(spark, tmp_path):
    folder = f"{tmp_path}/in"
    land(spark, folder, 0, [event(0, 10, 1), event(1, 70, 5)])
    land(spark, folder, 1, [event(2, 50, 3), event(3, 130, 7)])  # 50 is late but in time
    land(spark, folder, 2, [event(4, 400, 9)])
    means = streams.stream_mean(stream(spark, folder), "ts", "value", late="1 hour")
    streams.append_to(means, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = {r.ts: (r["mean"], r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {
        START: (2.0, 2), START + timedelta(hours=1): (5.0, 1), START + timedelta(hours=2): (7.0, 1)}


def test_late_rows_are_kept_beside_the_means(spark, tmp_path):
    folder = f"{tmp_path}/in"
    land(spark, folder, 0, [event(0, 10, 1), event(1, 200, 5)])
    land(spark, folder, 1, [event(2, 50, 3), event(3, 130, 7), event(4, 400, 9)])  # no window is closed yet
    land(spark, folder, 2, [event(5, 290, 2), event(6, 350, float("nan")), event(7, 110, 4)])  # 110 is behind 200 - 60
    land(spark, folder, 3, [event(8, 20, 8), event(9, 500, 1), event(10, 390, 6)])  # 20 is behind 400 - 60
    query = streams.stream_mean_and_late(stream(spark, folder), "ts", "value", f"{tmp_path}/state", f"{tmp_path}/cp")
    query.awaitTermination()
    late = streams.read_late(spark, f"{tmp_path}/state", stream(spark, folder).schema)
    assert {(r.id, r.batch) for r in late.collect()} == {(7, 2), (8, 3)}
    got = {r.ts: (r["mean"], r.n) for r in streams.read_means(spark, f"{tmp_path}/state", "ts").collect()}
    means = streams.stream_mean(stream(spark, folder), "ts", "value", late="1 hour")
    streams.append_to(means, f"{tmp_path}/out", f"{tmp_path}/cp2").awaitTermination()
    assert got == {r.ts: (r["mean"], r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got[START] == (2.0, 2) and got[START + timedelta(hours=2)] == (7.0, 1)


def test_streamed_upsert_equals_batches_in_order(spark, tmp_path):
    folder, table = f"{tmp_path}/in", f"{tmp_path}/table"
    batches = [
        [event(0, 0, 1), event(1, 0, 2), event(2, 1500, 3)],
        [event(3, 0, 9), event(4, 3000, 4)],
        [event(5, 1500, 8, "b"), event(6, 1500, 7)],
    ]

    def run():
        keyed = stream(spark, folder).select("ts", F.to_date("ts").alias("day"), "kind", "value", "id")
        streams.stream_upsert(keyed, table, f"{tmp_path}/cp", ["ts", "day"], ["value"], "id", "day").awaitTermination()

    land(spark, folder, 0, batches[0])
    run()
    for i in (1, 2):
        land(spark, folder, i, batches[i])
    run()  # goes on where it stopped
    expected = None
    for data in batches:
        batch = spark.createDataFrame(data, SCHEMA).select("ts", F.to_date("ts").alias("day"), "kind", "value", "id")
        target = expected if expected is not None else batch.drop("id").limit(0)
        expected = upsert(target, batch, ["ts", "day"], ["value"], "id")
    got = spark.read.parquet(table).select(*expected.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_freshness_state_is_the_newest_per_source(spark, tmp_path):
    folder = f"{tmp_path}/in"
    land(spark, folder, 0, [event(0, 10, 1), event(1, 5, 1, "b")])
    land(spark, folder, 1, [event(2, 90, 1)])
    state = streams.stream_freshness(stream(spark, folder), "kind", "ts")
    streams.latest_to(state, f"{tmp_path}/out", f"{tmp_path}/cp", "kind").awaitTermination()
    got = {r.kind: r.latest for r in streams.read_latest(spark, f"{tmp_path}/out", "kind").collect()}
    assert got == {"a": START + timedelta(minutes=90), "b": START + timedelta(minutes=5)}


def test_freshness_state_is_compacted(spark, tmp_path):
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"
    land(spark, folder, 0, [event(0, 5, 1, "b")])
    for i in range(1, 6):
        land(spark, folder, i, [event(i, 10 * i, 1)])
    state = streams.stream_freshness(stream(spark, folder), "kind", "ts")
    streams.latest_to(state, out, f"{tmp_path}/cp", "kind", whole_every=2).awaitTermination()
    got = {r.kind: r.latest for r in streams.read_latest(spark, out, "kind").collect()}
    assert got == {"a": START + timedelta(minutes=50), "b": START + timedelta(minutes=5)}
    kept = sorted(int(p.name.partition("=")[2]) for p in Path(out).iterdir())
    assert kept[0] >= 2 and len(kept) <= 4  # "b" came in batch 0, which is gone


def test_silent_sources_are_emitted_and_come_back(spark, tmp_path):
    folder = f"{tmp_path}/in"

    def states():
        found = streams.stream_silence(stream(spark, folder), "kind", "ts", 120 * 60, 30 * 60)
        streams.latest_to(found, f"{tmp_path}/out", f"{tmp_path}/cp", "kind").awaitTermination()
        rows = streams.read_latest(spark, f"{tmp_path}/out", "kind").collect()
        return {r.kind: (r.latest - START, r.silent) for r in rows}

    minutes = lambda m: timedelta(minutes=m)
    land(spark, folder, 0, [event(0, 10, 1), event(1, 5, 1, "b"), event(2, 8, 1, None)])
    assert states() == {"a": (minutes(10), False), "b": (minutes(5), False)}
    land(spark, folder, 1, [event(3, 155, 1), event(4, 100, 1)])
    assert states() == {"a": (minutes(155), False), "b": (minutes(5), False)}  # the watermark is at its limit, not past it
    land(spark, folder, 2, [event(5, 156, 1)])
    assert states() == {"a": (minutes(156), False), "b": (minutes(5), True)}  # no row of b came
    land(spark, folder, 3, [event(6, 300, 1), event(7, 200, 1, "b"), event(8, 130, 1, "c")])
    assert states() == {"a": (minutes(300), False), "b": (minutes(200), False), "c": (minutes(130), True)}  # back; c fell silent at once
    land(spark, folder, 4, [event(9, 900, 1, "c")])
    assert states() == {"a": (minutes(300), True), "b": (minutes(200), True), "c": (minutes(900), False)}


def test_a_bucket_of_many_sources_tells_each_of_its_own(spark, tmp_path):
    folder = f"{tmp_path}/in"
    found = streams.stream_silence(stream(spark, folder), "kind", "ts", 120 * 60, 30 * 60, buckets=2)
    minutes = lambda m: timedelta(minutes=m)

    def states():
        streams.latest_to(found, f"{tmp_path}/out", f"{tmp_path}/cp", "kind").awaitTermination()
        rows = streams.read_latest(spark, f"{tmp_path}/out", "kind").collect()
        return {r.kind: (r.latest - START, r.silent) for r in rows}

    land(spark, folder, 0, [event(i, i, 1, f"s{i}") for i in range(10)])
    assert states() == {f"s{i}": (minutes(i), False) for i in range(10)}
    land(spark, folder, 1, [event(10, 155, 1, "s0")])  # the watermark is at 125, so those before 5 fall silent
    assert states() == {f"s{i}": (minutes(i or 155), 0 < i < 5) for i in range(10)}
    land(spark, folder, 2, [event(11, 150, 1, "s1"), event(12, 157, 1, "s0")])  # s1 is back, 5 and 6 fall silent
    assert states() == {f"s{i}": (minutes({0: 157, 1: 150}.get(i, i)), 1 < i < 7) for i in range(10)}


def test_sources_of_other_types(spark, tmp_path):
    folder = f"{tmp_path}/in"
    for kind in ("int", "double", "date", "timestamp", "timestamp_ntz", "decimal(9,2)", "binary"):
        value = {"int": "1", "double": "1.5", "decimal(9,2)": "1.25", "binary": "'x'"}.get(kind, "'2024-02-03'")
        key = f"CAST({value} AS {kind}) AS k"
        at = f"{folder}/{kind[:6]}{len(kind)}"
        for i in range(2):
            spark.sql(f"SELECT {key}, TIMESTAMP_NTZ '2025-01-0{i + 1}' AS ts").write.parquet(f"{at}/{i}")
        rows = spark.readStream.schema(spark.read.parquet(f"{at}/0").schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/*")
        found = streams.stream_silence(rows, "k", "ts", 3600)
        streams.latest_to(found, f"{at}-out", f"{at}-cp", "k").awaitTermination()
        got = streams.read_latest(spark, f"{at}-out", "k").selectExpr(f"k <=> {key.removesuffix(' AS k')} AS same", "latest", "silent")
        assert [tuple(r) for r in got.collect()] == [(True, START + timedelta(days=1), False)], kind


def test_a_part_in_many_files_is_one_batch(spark, tmp_path):
    """Users of their own in each file: a file must not push the watermark past the rows of the next one."""
    start, hours = datetime(2024, 1, 1), 30 * 24
    rows = [(u * 1000 + h, start + timedelta(hours=h, minutes=u), u, float(h)) for u in range(8) for h in range(0, hours - 48 * (u % 2), 5)]
    table = f"{tmp_path}/events.parquet"
    for u in range(8):  # each file is to be a partition of its own, as large ones are
        spark.createDataFrame([r for r in rows if r[2] == u], "event_id long, ts timestamp_ntz, user_id long, value double").coalesce(1).write.mode("append").parquet(table)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert spark.read.parquet(table).rdd.getNumPartitions() >= 8
        got = {r.user_id: (r.latest, r.silent) for r in QUERIES["stream_silence"](spark, str(tmp_path)).collect()}
        late = {(r.event_id, r.batch) for r in QUERIES["stream_late_rows"](spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert got == {u: (max(r[1] for r in rows if r[2] == u), u % 2 == 1) for u in range(8)}
    batch = lambda r: 4 * (r[0] % 7) // 7
    newest = {b: max(r[1] for r in rows if batch(r) <= b) for b in range(4)}
    behind = lambda r: r[1].replace(minute=0) + timedelta(hours=1) <= newest[batch(r) - 2] - timedelta(hours=480)
    assert late == {(r[0], batch(r)) for r in rows if batch(r) >= 2 and behind(r)} and late
