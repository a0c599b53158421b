"""Payloads, constraints, upserts, incremental windows, chunk audits, and round trips through storage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalar import truncate
from gridlake.operators import aggregates, time_windows
from gridlake.operators.quality import dedupe_first
from gridlake.plans import daily
from gridlake.plans.monthly import refresh
from gridlake.queries.quality import KEY, KEY_SQL, keyed
from gridlake.queries.registry import Tables, presented, query
from gridlake.queries.roles import props_k
from gridlake.session import child_names, work_dir
from gridlake.sources import payloads, tables
from gridlake.sources.loading import enforce_constraints, mark_constraints, upsert, upsert_partitions
from gridlake.sources.schemas import CONSUMPTION_PAYLOAD, FACTS, MIX_FIELDS, MIX_PAYLOAD, WEATHER_PAYLOAD

START, END = date(2024, 1, 1), date(2024, 2, 9)


def stamp_text(col: str = "ts") -> Column:
    return F.col(col).cast("string")


def point(value: Column) -> Column:
    return F.struct(
        stamp_text().alias("start_date"), stamp_text().alias("end_date"), stamp_text().alias("updated_date"),
        value.cast("double").alias("value"),
    )


def consumption_documents(t: Tables) -> DataFrame:
    """One nested document per event: a block of two values, an empty block, a block of one."""
    none = F.array_except(F.array(point(F.col("value"))), F.array(point(F.col("value"))))
    blocks = F.array(
        F.struct(F.col("event_type").alias("type"), F.array(point(F.col("value")), point(props_k())).alias("values")),
        F.struct(F.lit("NONE").alias("type"), none.alias("values")),
        F.struct(F.lit("ID").alias("type"), F.array(point(F.col("value") / 2)).alias("values")),
    )
    return t.events.select("event_id", F.to_json(F.struct(blocks.alias("short_term"))).alias("json"))


@query(
    """SELECT event_id, event_type AS type, ts AS start_date, value FROM events
    UNION ALL SELECT event_id, event_type, ts, CAST(json_extract_string(props, '$.k') AS DOUBLE) FROM events
    UNION ALL SELECT event_id, 'ID', ts, value / 2 FROM events"""
)
def flatten_blocks(t: Tables) -> DataFrame:
    docs = payloads.parse(consumption_documents(t), "json", CONSUMPTION_PAYLOAD)
    rows = payloads.flatten_blocks(docs, "short_term", "values", "type", ["event_id"])
    return rows.select("event_id", "type", F.col("start_date").cast("timestamp_ntz").alias("start_date"), "value")


@query("SELECT 3 * count(*) AS points FROM events")
def count_points(t: Tables) -> DataFrame:
    docs = payloads.parse(consumption_documents(t), "json", CONSUMPTION_PAYLOAD)
    return aggregates.count_points(docs, "short_term", "values")


@query(
    """SELECT event_id, ts AS start_date,
    CASE event_type WHEN 'signup' THEN NULL WHEN 'click' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) ELSE value END AS price
    FROM events WHERE event_type <> 'error'"""
)
def flatten_prices(t: Tables) -> DataFrame:
    """Documents of every shape: nested blocks, flat points, a value in place of a price, a null price, no date."""
    stamp, value, k = stamp_text().alias("start_date"), F.col("value").alias("price"), props_k().cast("double").alias("value")
    null_price = F.lit(None).cast("double").alias("price")
    kind = F.col("event_type")

    def document(items: Column) -> Column:
        return F.to_json(F.struct(items.alias("prices"), F.struct(F.lit(1).alias("a")).alias("meta")), {"ignoreNullFields": "false"})

    json = (
        F.when(kind == "purchase", document(F.array(F.struct(F.array(F.struct(stamp, value)).alias("values")))))
        .when(kind == "click", document(F.array(F.struct(stamp, k))))
        .when(kind == "signup", document(F.array(F.struct(stamp, null_price, k))))
        .when(kind == "error", document(F.array(F.struct(F.lit(None).cast("string").alias("start_date"), value))))
        .otherwise(document(F.array(F.struct(stamp, value))))
    )
    rows = payloads.flatten_prices(t.events.select("event_id", json.alias("json")), "json", keep=["event_id"])
    return rows.dropna(subset=["start_date"]).select(
        "event_id", F.col("start_date").cast("timestamp_ntz").alias("start_date"), "price"
    )


@query(
    """SELECT event_id, ts AS time, value AS temperature, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS wind FROM events
    UNION ALL SELECT event_id, ts + INTERVAL 1 HOUR, NULL, CAST(json_extract_string(props, '$.k') AS DOUBLE) + 1 FROM events"""
)
def zip_arrays(t: Tables) -> DataFrame:
    """Parallel arrays of three, two and three elements."""
    k = props_k().cast("double")
    hourly = F.struct(
        F.array(*[(F.col("ts") + F.expr(f"INTERVAL {i} HOURS")).cast("string") for i in range(3)]).alias("time"),
        F.array("value", F.lit(None).cast("double")).alias("temperature_2m"),
        F.array(k, k + 1, k + 2).alias("windspeed_10m"),
        F.array(k, k, k).alias("cloud_cover"),
    )
    docs = payloads.parse(
        t.events.select("event_id", F.to_json(F.struct(hourly.alias("hourly"))).alias("json")), "json", WEATHER_PAYLOAD
    )
    arrays = {"time": "hourly.time", "temperature": "hourly.temperature_2m", "wind": "hourly.windspeed_10m"}
    rows = payloads.zip_arrays(docs, arrays, ["event_id"])
    return rows.withColumn("time", F.col("time").cast("timestamp_ntz"))


@query(
    """SELECT event_id, ts AS date_heure, value AS consommation, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS gaz,
    NULL::DOUBLE AS pompage FROM events UNION ALL SELECT event_id, ts, NULL, NULL, NULL FROM events"""
)
def records_to_rows(t: Tables) -> DataFrame:
    """Two records per document; the second has the stamp only, and no record has every field."""
    records = F.array(
        F.struct(stamp_text().alias("date_heure"), F.col("value").cast("string").alias("consommation"), props_k().alias("gaz")),
        F.struct(
            stamp_text().alias("date_heure"), F.lit(None).cast("string").alias("consommation"),
            F.lit(None).cast("string").alias("gaz"),
        ),
    )
    docs = payloads.parse(
        t.events.select("event_id", F.to_json(F.struct(records.alias("results"))).alias("json")), "json", MIX_PAYLOAD
    )
    rows = payloads.records_to_rows(docs, "results", {c: c for c in ["date_heure", *MIX_FIELDS]}, ["event_id"])
    return rows.select(
        "event_id", F.col("date_heure").cast("timestamp_ntz").alias("date_heure"),
        *[F.col(c).try_cast("double").alias(c) for c in ("consommation", "gaz", "pompage")],
    )


@query(
    f"""WITH d AS ({KEY_SQL}), n AS (SELECT event_id, user_id, hour, event_type, CASE WHEN event_type <> 'error' THEN value END AS value FROM d),
    k AS (SELECT *, count(*) OVER (PARTITION BY user_id, hour, event_type) AS c FROM n)
    SELECT event_id, CASE WHEN value IS NULL THEN 'null value' WHEN c > 1 THEN 'duplicate key' END AS reason FROM k"""
)
def constraints(t: Tables) -> DataFrame:
    rows = keyed(t).withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    return mark_constraints(rows, ["value"], KEY).select("event_id", "reason")


@query(f"WITH d AS ({KEY_SQL}) SELECT event_id FROM d QUALIFY count(*) OVER (PARTITION BY user_id, hour, event_type) = 1")
def constraints_good(t: Tables) -> DataFrame:
    good, _ = enforce_constraints(keyed(t), ["value"], KEY)
    return good.select("event_id")


UPSERT_SQL = """
d AS (SELECT event_id, user_id, date_trunc('day', ts) AS day, event_type, value FROM events),
target AS (SELECT user_id, day, event_type, arg_min(value, event_id) AS value, min(event_id) AS first_id FROM d
  WHERE day < TIMESTAMP '2024-01-20' GROUP BY 1, 2, 3),
batch AS (SELECT user_id, day, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE arg_max(value * 2, event_id) END AS value,
  min(event_id) AS first_id FROM d WHERE day >= TIMESTAMP '2024-01-10' GROUP BY 1, 2, 3)
"""
UPSERT_KEY = ["user_id", "day", "event_type"]


def upsert_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    """A table of events by user, day and type, and a batch that overlaps it by ten days."""
    day = truncate(t.events, "ts", "day")
    rows = t.events.select("event_id", "user_id", day.alias("day"), "event_type", "value")
    target = dedupe_first(rows.filter(F.col("day") < F.lit("2024-01-20").cast("timestamp_ntz")), UPSERT_KEY, ["event_id"])
    batch = rows.filter(F.col("day") >= F.lit("2024-01-10").cast("timestamp_ntz")).select(
        *UPSERT_KEY,
        F.when(F.col("event_type") != "error", F.col("value") * 2).alias("value"),
        F.col("event_id").alias("first_id"),
        F.col("event_id").alias("seq"),
    )
    return target.select(*UPSERT_KEY, "value", F.col("event_id").alias("first_id")), batch


@query(
    f"""WITH {UPSERT_SQL} SELECT user_id, day, event_type, CASE WHEN b.user_id IS NOT NULL THEN b.value ELSE t.value END AS value,
    coalesce(t.first_id, b.first_id) AS first_id FROM target t FULL JOIN batch b USING (user_id, day, event_type)"""
)
def upsert_partial(t: Tables) -> DataFrame:
    """Only `value` may change; `first_id` stays as first inserted."""
    target, batch = upsert_sides(t)
    return upsert(target, batch, UPSERT_KEY, ["value"], "seq")


@query(
    f"""WITH {UPSERT_SQL}, last AS (SELECT user_id, day, event_type, max(event_id) AS last_id FROM d
      WHERE day >= TIMESTAMP '2024-01-10' GROUP BY 1, 2, 3)
    SELECT user_id, day, event_type, CASE WHEN b.user_id IS NOT NULL THEN b.value ELSE t.value END AS value,
    coalesce(last_id, t.first_id) AS first_id FROM target t FULL JOIN batch b USING (user_id, day, event_type)
    LEFT JOIN last USING (user_id, day, event_type)"""
)
def upsert_full(t: Tables) -> DataFrame:
    """Every column outside the key changes."""
    target, batch = upsert_sides(t)
    return upsert(target, batch, UPSERT_KEY, ["value", "first_id"], "seq")


@query(
    f"""WITH {UPSERT_SQL} SELECT user_id, CAST(day AS DATE) AS day, event_type,
    CASE WHEN b.user_id IS NOT NULL THEN b.value ELSE t.value END AS value,
    coalesce(t.first_id, b.first_id) AS first_id FROM target t FULL JOIN batch b USING (user_id, day, event_type)"""
)
def upsert_table(t: Tables) -> DataFrame:
    """The partial upsert in a stored table that is partitioned by day: only touched days are rewritten."""
    target, batch = upsert_sides(t)
    folder = work_dir(t.spark, "upsert")
    by_day = F.col("day").cast("date")
    first = target.withColumn("day", by_day).withColumn("seq", F.lit(0))
    for number, rows in enumerate([first, batch.withColumn("day", by_day)]):
        upsert_partitions(t.spark, f"{folder}/table", rows, UPSERT_KEY, ["value"], "seq", "day", number, f"{folder}/staged")
    return t.spark.read.parquet(f"{folder}/table").select(*UPSERT_KEY, "value", "first_id")


@query(
    """SELECT event_id, ts FROM events WHERE ts >= (SELECT CAST(max(ts) AS DATE) FROM events) - INTERVAL 6 DAY
    AND ts < (SELECT CAST(max(ts) AS DATE) FROM events) + INTERVAL 1 DAY"""
)
def incremental_window(t: Tables) -> DataFrame:
    """The last seven dates in the data."""
    return time_windows.recent_window(t.events.select("event_id", "ts"), "ts", 7)


def newest(t: Tables) -> Column:
    return t.events.agg(F.max("ts").alias("m")).select("m").scalar()


@query(
    """WITH a AS (SELECT date_trunc('day', max(ts)::TIMESTAMPTZ AT TIME ZONE 'Europe/Paris') AS today FROM events)
    SELECT event_id, ts FROM events, a WHERE ts::TIMESTAMPTZ >= (today - INTERVAL 7 DAY) AT TIME ZONE 'Europe/Paris'
    AND ts::TIMESTAMPTZ < today AT TIME ZONE 'Europe/Paris'"""
)
def paris_window(t: Tables) -> DataFrame:
    """Seven whole Paris days that end with the day before the newest stamp."""
    return time_windows.recent_window(t.events.select("event_id", "ts"), "ts", 7, "yesterday", newest(t))


@query(
    """SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY AND ts <= (SELECT max(ts) FROM events)"""
)
def sliding_window(t: Tables) -> DataFrame:
    return time_windows.recent_window(t.events.select("event_id", "ts"), "ts", 7, "now", newest(t))


@query("SELECT event_id, ts FROM events WHERE ts >= (SELECT CAST(max(ts) AS DATE) FROM events) - INTERVAL 20 DAY")
def cutoff_window(t: Tables) -> DataFrame:
    return time_windows.recent(t.events.select("event_id", "ts"), "ts", newest(t), 20)


@query(
    """WITH p AS (SELECT event_id, date_trunc('day', ts::TIMESTAMPTZ AT TIME ZONE 'Europe/Paris') AS d FROM events)
    SELECT event_id, CAST(d AS DATE) AS local_day, (d AT TIME ZONE 'Europe/Paris') AT TIME ZONE 'UTC' AS day_start,
    ((d + INTERVAL 1 DAY) AT TIME ZONE 'Europe/Paris') AT TIME ZONE 'UTC' AS day_end FROM p"""
)
def local_days(t: Tables) -> DataFrame:
    return time_windows.local_day_bounds(t.events.select("event_id", "ts"), "ts").drop("ts")


CHUNK_SQL = """
c AS (SELECT CAST(i AS INTEGER) AS chunk, DATE '2024-01-01' + CAST(7 * i AS INTEGER) AS chunk_start,
  least(DATE '2024-01-01' + CAST(7 * i + 7 AS INTEGER), DATE '2024-02-10') AS chunk_end FROM range(0, 6) r(i)),
n AS (SELECT CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS INTEGER) AS chunk, count(*) AS rows,
  min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1)
"""


@query(
    f"""WITH {CHUNK_SQL} SELECT chunk, chunk_start, chunk_end, coalesce(rows, 0) AS rows,
    CAST(48 * date_diff('day', chunk_start, chunk_end) AS BIGINT) AS expected,
    coalesce(rows, 0) >= 48 * date_diff('day', chunk_start, chunk_end) AS complete
    FROM c LEFT JOIN n USING (chunk) WHERE chunk_end = chunk_start + 7"""
)
def chunk_coverage(t: Tables) -> DataFrame:
    """Seven-day chunks, the short last one left out."""
    return time_windows.chunk_coverage(t.events, "ts", START, END, 7, 48, drop_short=True)


@query(
    """WITH c AS (SELECT m AS chunk, CAST(DATE '1995-01-15' AS DATE) AS s, DATE '2001-12-20' AS e,
      CAST(DATE '1995-01-01' + INTERVAL 1 MONTH * m AS DATE) AS f FROM range(0, 84) r(m)),
    b AS (SELECT CAST(chunk AS INTEGER) AS chunk, greatest(f, s) AS chunk_start, least(CAST(f + INTERVAL 1 MONTH AS DATE), e + 1) AS chunk_end FROM c),
    n AS (SELECT CAST(year(o_orderdate) * 12 + month(o_orderdate) - (1995 * 12 + 1) AS INTEGER) AS chunk, count(*) AS rows
      FROM orders WHERE o_orderdate >= DATE '1995-01-15' AND o_orderdate < DATE '2001-12-21' GROUP BY 1)
    SELECT chunk, chunk_start, chunk_end, coalesce(rows, 0) AS rows,
    CAST(5 * date_diff('day', chunk_start, chunk_end) AS BIGINT) AS expected,
    coalesce(rows, 0) >= 5 * date_diff('day', chunk_start, chunk_end) AS complete FROM b LEFT JOIN n USING (chunk)"""
)
def chunk_coverage_months(t: Tables) -> DataFrame:
    return time_windows.chunk_coverage(t.orders, "o_orderdate", date(1995, 1, 15), date(2001, 12, 20), "month", 5)


@query(f"WITH {CHUNK_SQL} SELECT chunk, chunk_start, chunk_end FROM c WHERE chunk NOT IN (SELECT chunk FROM n)")
def failed_chunks(t: Tables) -> DataFrame:
    chunks = time_windows.chunk_table(t.spark, START, END, 7).select("chunk", "chunk_start", "chunk_end")
    landed = t.events.select(time_windows.chunk_index(F.col("ts"), START, 7).alias("chunk"))
    return time_windows.failed_chunks(chunks, landed)


@query(
    f"""WITH {CHUNK_SQL} SELECT chunk, chunk_start, chunk_end, coalesce(rows, 0) AS rows, first_ts, last_ts,
    CAST(sum(coalesce(rows, 0)) OVER (ORDER BY chunk) AS BIGINT) AS running_rows FROM c LEFT JOIN n USING (chunk)"""
)
def load_report(t: Tables) -> DataFrame:
    return time_windows.load_report(t.events, "ts", START, END, 7)


@query(
    """WITH c AS (SELECT * FROM (VALUES (0, DATE '2024-01-10', DATE '2024-01-17'), (1, DATE '2024-01-17', DATE '2024-01-21')) AS c(chunk, a, b)),
    n AS (SELECT chunk, a, b, count(ts) AS rows, min(ts) AS first_ts, max(ts) AS last_ts FROM c LEFT JOIN events ON ts >= a AND ts < b GROUP BY chunk, a, b)
    SELECT CAST(chunk AS INTEGER) AS chunk, a AS chunk_start, b AS chunk_end, rows, first_ts, last_ts,
      CAST(sum(rows) OVER (ORDER BY chunk) AS BIGINT) AS running_rows FROM n
    UNION ALL SELECT NULL, NULL, NULL, count(*), min(ts), max(ts), NULL FROM events WHERE ts < DATE '2024-01-10' OR ts >= DATE '2024-01-21'"""
)
def load_report_strays(t: Tables) -> DataFrame:
    """Asked for eleven days; whatever else was returned is reported too."""
    return time_windows.load_report(t.events, "ts", date(2024, 1, 10), date(2024, 1, 20), 7)


# Requests of a backfill: the third asks again for a day of the second, days lie between the third and the fourth, and
# the last one brings nothing.
REQUESTS = [
    (1, date(2024, 1, 1), date(2024, 1, 8)), (2, date(2024, 1, 8), date(2024, 1, 15)), (3, date(2024, 1, 14), date(2024, 1, 22)),
    (4, date(2024, 1, 25), date(2024, 2, 1)), (5, date(2030, 1, 1), date(2030, 1, 4)),
]
REQUESTS_SQL = ", ".join(f"({n}, DATE '{a}', DATE '{b}')" for n, a, b in REQUESTS)


@query(
    f"""WITH a AS (SELECT * FROM (VALUES {REQUESTS_SQL}) AS a(request, asked_from, asked_to)),
    r AS (SELECT event_id, ts, CASE WHEN event_id % 51 = 0 THEN NULL WHEN event_id % 50 = 0 THEN 2 WHEN event_id % 53 = 0 THEN 9
      ELSE CAST(1 + floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS INTEGER) END AS request FROM events),
    j AS (SELECT r.*, coalesce(ts >= asked_from AND ts < asked_to, FALSE) AS inside FROM r LEFT JOIN a USING (request)),
    b AS (SELECT request, count(*) AS rows, min(ts) AS first_ts, max(ts) AS last_ts, count(*) FILTER (NOT inside) AS strays FROM j GROUP BY 1),
    o AS (SELECT j.request, j.event_id, min(a.request) AS other FROM j JOIN a ON NOT inside AND ts >= asked_from AND ts < asked_to
      AND a.request IS DISTINCT FROM j.request GROUP BY ALL),
    e AS (SELECT request, count(*) AS elsewhere, min(other) AS elsewhere_of FROM o GROUP BY 1),
    d AS (SELECT request, CAST(unnest(generate_series(asked_from, asked_to - 1, INTERVAL 1 DAY)) AS DATE) AS day FROM a),
    h AS (SELECT request, count(*) AS holes, min(day) AS first_hole FROM d
      WHERE NOT EXISTS (SELECT 1 FROM j WHERE inside AND j.request = d.request AND CAST(ts AS DATE) = day) GROUP BY 1),
    s AS (SELECT request, count(*) AS shared FROM d WHERE day IN (SELECT day FROM d GROUP BY 1 HAVING count(*) > 1) GROUP BY 1),
    k AS (SELECT request FROM a UNION SELECT request FROM b)
    SELECT CAST(k.request AS INTEGER) AS request, asked_from, asked_to, coalesce(rows, 0) AS rows, first_ts, last_ts, coalesce(strays, 0) AS strays,
      coalesce(elsewhere, 0) AS elsewhere, CAST(elsewhere_of AS INTEGER) AS elsewhere_of, coalesce(holes, 0) AS holes,
      CAST(first_hole AS TIMESTAMP) AS first_hole, coalesce(shared, 0) AS shared
    FROM k LEFT JOIN a ON k.request = a.request LEFT JOIN b ON k.request IS NOT DISTINCT FROM b.request
    LEFT JOIN e ON k.request IS NOT DISTINCT FROM e.request LEFT JOIN h ON k.request = h.request LEFT JOIN s ON k.request = s.request"""
)
def load_report_requests(t: Tables) -> DataFrame:
    """Events as a backfill brought them: some under another request's number, some under none or an unknown one."""
    asked = t.spark.createDataFrame(REQUESTS, "request int, asked_from date, asked_to date")
    number = (
        F.when(F.col("event_id") % 51 == 0, None).when(F.col("event_id") % 50 == 0, 2).when(F.col("event_id") % 53 == 0, 9)
        .otherwise(1 + time_windows.chunk_index(F.col("ts"), START, 7))
    )
    return time_windows.load_report_requests(t.events.select("ts", number.cast("int").alias("request")), "ts", "request", asked)


@query(
    """SELECT user_id, CAST(ts AS DATE) AS day, event_type, max(event_id) AS last_id, -arg_max(value, event_id) AS value
    FROM events GROUP BY ALL"""
)
def upsert_corrected(t: Tables) -> DataFrame:
    """The same batch number landed twice, the second time with corrected values."""
    folder = work_dir(t.spark, "corrected")
    rows = t.events.select("user_id", F.col("ts").cast("date").alias("day"), "event_type", F.col("event_id").alias("last_id"), "value", F.col("event_id").alias("seq"))
    for sign in (1, -1):
        batch = rows.withColumn("value", sign * F.col("value"))
        upsert_partitions(t.spark, f"{folder}/table", batch, UPSERT_KEY, ["last_id", "value"], "seq", "day", 0, f"{folder}/staged")
    return t.spark.read.parquet(f"{folder}/table").select(*UPSERT_KEY, "last_id", "value")


@query(
    """SELECT user_id, CAST(ts AS DATE) AS day, event_type, max(event_id) AS last_id, -arg_max(value, event_id) AS value
    FROM events GROUP BY ALL"""
)
def upsert_corrected_repeats(t: Tables) -> DataFrame:
    """The same, with every row of the batch there twice: equal rows must not hide that the values changed."""
    folder = work_dir(t.spark, "corrected-repeats")
    rows = t.events.select("user_id", F.col("ts").cast("date").alias("day"), "event_type", F.col("event_id").alias("last_id"), "value", F.col("event_id").alias("seq"))
    for sign in (1, -1):
        batch = rows.withColumn("value", sign * F.col("value"))
        upsert_partitions(
            t.spark, f"{folder}/table", batch.unionAll(batch), UPSERT_KEY, ["last_id", "value"], "seq", "day", 0, f"{folder}/staged"
        )
    return t.spark.read.parquet(f"{folder}/table").select(*UPSERT_KEY, "last_id", "value")


def damaged_documents(docs: DataFrame, json: str = "json", number: str = "event_id") -> DataFrame:
    """Two in ten documents cut short, and one each an error page, an error object, an empty answer and none."""
    text, kind = F.col(json), F.col(number) % 10
    return docs.withColumn(
        json,
        F.when(kind.isin(1, 2), F.substr(text, F.lit(1), (F.length(text) * kind / 3).cast("int")))
        .when(kind == 4, "<html>503</html>").when(kind == 5, '{"error": "quota"}').when(kind == 6, "").when(kind != 7, text),
    )


DAMAGE_SQL = """CASE event_id % 10 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'not JSON' WHEN 4 THEN 'not JSON'
  WHEN 5 THEN 'unexpected shape' WHEN 6 THEN 'empty document' WHEN 7 THEN 'no document' END"""


@query(
    f"""WITH d AS (SELECT *, {DAMAGE_SQL} AS reason FROM events)
    SELECT event_id, event_type AS type, ts AS start_date, value, NULL AS reason FROM d WHERE reason IS NULL
    UNION ALL SELECT event_id, event_type, ts, CAST(json_extract_string(props, '$.k') AS DOUBLE), NULL FROM d WHERE reason IS NULL
    UNION ALL SELECT event_id, 'ID', ts, value / 2, NULL FROM d WHERE reason IS NULL
    UNION ALL SELECT event_id, NULL, NULL, NULL, reason FROM d WHERE reason IS NOT NULL"""
)
def corrupt_documents(t: Tables) -> DataFrame:
    """Rows of the good documents, and one row with the reason for each that could not be read."""
    docs = payloads.parse(damaged_documents(consumption_documents(t)), "json", CONSUMPTION_PAYLOAD, "bad")
    rows = payloads.flatten_blocks(docs, "short_term", "values", "type", ["event_id"], bad="bad")
    return rows.select(
        "event_id", "type", F.col("start_date").cast("timestamp_ntz").alias("start_date"), "value", "bad.reason"
    )


def price_documents(t: Tables) -> DataFrame:
    """A document per event with one flat point; errors have no date, sign-ups no readable one."""
    date_text = F.when(F.col("event_type") == "signup", "soon").when(F.col("event_type") != "error", stamp_text())
    point_of = F.struct(date_text.alias("start_date"), F.col("value").alias("price"))
    return t.events.select("event_id", F.to_json(F.struct(F.array(point_of).alias("prices"))).alias("json"))


@query(
    f"""WITH d AS (SELECT *, {DAMAGE_SQL} AS reason FROM events)
    SELECT event_id, ts AS start_date, value AS price, NULL AS reason FROM d WHERE reason IS NULL AND event_type NOT IN ('error', 'signup')
    UNION ALL SELECT event_id, NULL, value, NULL FROM d WHERE reason IS NULL AND event_type IN ('error', 'signup')
    UNION ALL SELECT event_id, NULL, NULL, reason FROM d WHERE reason IS NOT NULL"""
)
def corrupt_prices(t: Tables) -> DataFrame:
    rows = payloads.flatten_prices(damaged_documents(price_documents(t)), "json", keep=["event_id"], bad="bad")
    return rows.select(
        "event_id", F.col("start_date").try_cast("timestamp_ntz").alias("start_date"), "price", "bad.reason"
    )


@query(
    f"""WITH d AS (SELECT *, event_id % 3 AS run, {DAMAGE_SQL} AS reason FROM events),
    c AS (SELECT 'fact_consommation' AS source, run, coalesce(reason, CASE WHEN event_type = 'click' THEN 'null type' END) AS reason, event_id AS seq FROM d),
    p AS (SELECT 'fact_prix_marche' AS source, run, coalesce(reason, CASE WHEN event_type IN ('error', 'signup') THEN 'null date_heure' END) AS reason, event_id AS seq FROM d)
    SELECT source, run, reason, seq FROM c WHERE reason IS NOT NULL UNION ALL SELECT source, run, reason, seq FROM p WHERE reason IS NOT NULL"""
)
def quarantine(t: Tables) -> DataFrame:
    """Three runs of two sources, one run repeated: unread documents, null keys and undated prices are all kept."""
    root = work_dir(t.spark, "quarantine")
    block = F.struct(F.when(F.col("event_type") != "click", F.col("event_type")).alias("type"), F.array(point(F.col("value"))).alias("values"))
    consumption = t.events.select("event_id", F.to_json(F.struct(F.array(block).alias("short_term"))).alias("json"))
    for run in (0, 1, 2, 2):
        for name, docs in (("fact_consommation", consumption), ("fact_prix_marche", price_documents(t))):
            own = damaged_documents(docs).filter(F.col("event_id") % 3 == run).withColumnRenamed("event_id", "seq")
            daily.land(t.spark, FACTS[name], daily.READERS[name](own), root, run)
    return daily.read_quarantine(t.spark, root).select("source", "run", "reason", "seq")


@query(
    """WITH d AS (SELECT event_id, ts + INTERVAL 1 DAY * (31 * (event_id % 12)) AS moment, event_id % 12 IN (3, 4) AS corrected, value FROM events),
    f AS (SELECT moment, bool_or(corrected) AS corrected, arg_max(CASE WHEN corrected THEN 2 * value ELSE value END,
      CASE WHEN corrected THEN 1000000000 ELSE 0 END + event_id) AS v FROM d GROUP BY 1)
    SELECT date_trunc('month', moment)::TIMESTAMP AS mois, half_up(avg(v), 0) AS consommation_moyenne_mw, half_up(max(v), 0) AS pic_mw,
    half_up(min(v), 0) AS creux_mw, bool_or(corrected) AS rewritten FROM f GROUP BY 1"""
)
def gold_refreshed(t: Tables) -> DataFrame:
    """A year is landed, then corrections to some months: gold of all months, and which states were written again."""
    root, spark = work_dir(t.spark, "gold-refresh"), t.spark
    at = (F.col("ts") + F.make_dt_interval((31 * (F.col("event_id") % 12)).cast("int"))).cast("string")
    value = F.struct(at.alias("start_date"), at.alias("end_date"), at.alias("updated_date"), F.col("factor").alias("value"))
    block = F.struct(F.lit("REALISED").alias("type"), F.array(value).alias("values"))

    def months() -> dict[str, list[str]]:
        path = f"{root}/gold_state/month_stats"
        return {c: child_names(spark, f"{path}/{c}") for c in child_names(spark, path) if c.startswith("part=")}

    before: dict[str, list[str]] = {}
    for run, (factor, own) in enumerate([(1, F.lit(True)), (2, (F.col("event_id") % 12).isin(3, 4))]):
        before = months() if run else {}
        docs = t.events.filter(own).withColumn("factor", factor * F.col("value")).select(
            F.col("event_id").alias("seq"), F.to_json(F.struct(F.array(block).alias("short_term"))).alias("json")
        )
        daily.land(spark, FACTS["fact_consommation"], daily.consumption_rows(docs), root, run)
        gold, _ = refresh(spark, root, lambda m: daily.read_facts(spark, root, m))
    written = [(c.partition("=")[2], files != before.get(c)) for c, files in months().items()]
    marks = spark.createDataFrame(written, "month string, rewritten boolean")
    monthly = gold["consommation_mensuelle"]
    return presented(monthly.join(marks, F.date_format("mois", "yyyy-MM") == F.col("month")).drop("month"))


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderstatus = 'P' THEN '' ELSE 'a \"b\", c' END AS note FROM orders")
def csv_roundtrip(t: Tables) -> DataFrame:
    """NULL, empty and quoted text, stamps and doubles through CSV."""
    status = F.col("o_orderstatus")
    note = F.when(status == "P", "").when(status != "O", 'a "b", c')
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", note.alias("note"))
    path = work_dir(t.spark, "csv")
    tables.write_csv(rows, path)
    return tables.read_csv(t.spark, path, rows.schema)


@query(
    """SELECT o_orderkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders"""
)
def publish_roundtrip(t: Tables) -> DataFrame:
    """A result table partitioned by month, replaced and read back."""
    rows = t.orders.select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "month").alias("month"))
    return tables.publish(rows, work_dir(t.spark, "publish"), ["month"])


@query("SELECT o_custkey, count(*) AS orders, max(o_orderdate) AS latest FROM orders GROUP BY 1")
def publish_versions(t: Tables) -> DataFrame:
    """A result table brought up to date from its own last version: orders of even keys, then the others."""
    path = work_dir(t.spark, "versions")
    early = F.col("o_orderkey") % 2 == 0
    counted = lambda rows: rows.groupBy("o_custkey").agg(F.count("*").alias("orders"), F.max("o_orderdate").alias("latest"))
    tables.publish_version(counted(t.orders.filter(early)), path)
    both = tables.read_version(t.spark, path).unionByName(counted(t.orders.filter(~early)))
    tables.publish_version(both.groupBy("o_custkey").agg(F.sum("orders").alias("orders"), F.max("latest").alias("latest")), path)
    return tables.read_version(t.spark, path)


@query("SELECT event_type, max(ts) AS latest FROM events GROUP BY 1")
def latest_by_type(t: Tables) -> DataFrame:
    return presented(t.events.groupBy("event_type").agg(F.max("ts").alias("latest")))
