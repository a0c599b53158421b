"""The daily run on hand-made payloads: two runs, with corrections, a failed source, and all layers."""

import json
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridlake.plans import analysis, daily, monthly
from gridlake.plans.gold import gold
from gridlake.plans.silver import silver
from gridlake.sources.loading import upsert_partitions
from gridlake.sources.schemas import FACTS
from gridlake.sources.tables import settled


def docs(spark, *payloads, **extra):
    rows = [(i, json.dumps(p), *[v[i] for v in extra.values()]) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, ", ".join(["seq long", "json string", *[f"{c} string" for c in extra]]))


def consumption(*points, kind="REALISED"):
    values = [
        {"start_date": s, "end_date": s, "updated_date": "2026-01-05T12:00:00+01:00", "value": v} for s, v in points
    ]
    return {"short_term": [{"type": kind, "values": values}, {"type": "ID", "values": []}]}


PAGE = """<html><head>
<meta content="  Un titre d&#8217;essai &amp; plus " property="og:title"/>
<meta property='article:published_time' content='2026-01-04T00:30:00+01:00'>
<meta name="description" content="R&eacute;sum&eacute;"></head><body></body></html>"""


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("daily"))
    hours = ["2026-01-05T10:00:00+01:00", "2026-01-05T10:15:00+01:00", "2026-01-05T13:00:00+01:00"]
    weather = {
        "hourly": {
            "time": ["2026-01-05T09:00", "2026-01-05T12:00", "2026-01-05T13:00"],
            "temperature_2m": [1.0, 3.0, None],
            "windspeed_10m": [10.0, 20.0],
            "cloud_cover": [5.0, 6.0, 7.0],
        }
    }
    sources = {
        "fact_consommation": docs(
            spark,
            consumption((hours[0], 100.0), (hours[1], 110.0)),
            consumption((hours[0], 120.0), (hours[2], 90.0)),
            consumption((hours[0], 1.0), kind="D-1"),
        ),
        "fact_meteoid": docs(spark, weather, weather, region=["Bretagne", "Corse"]),
        "fact_prix_marche": docs(
            spark,
            {"prices": [{"values": [{"start_date": hours[0], "price": 50.5}, {"start_date": None, "price": 1}]}], "x": 1},
            {"prices": [{"start_date": hours[2], "value": 60}, {"start_date": hours[1], "price": None, "value": 9}]},
        ),
        "fact_consommation_regionale": docs(
            spark,
            {"results": [
                {"date_heure": hours[0], "region": "Bretagne", "code_insee_region": "53",
                 "consommation_brute_electricite_rte": 5.0, "statut_rte": "Consolidé"},
                {"date_heure": hours[0], "region": "Normandie", "statut_rte": "Temps réel"},
            ]},
            {"results": [{"date_heure": hours[0], "region": "Bretagne", "code_insee_region": "99",
                          "consommation_brute_electricite_rte": 7.0, "statut_rte": "Consolidé"}]},
        ),
        "fact_actualites": spark.createDataFrame([(0, "https://s/a-b-c", PAGE), (1, "https://s/x", "<p>")], "seq long, url string, html string"),
        "fact_eco2mix": docs(
            spark,
            {"results": [
                {"date_heure": hours[0], "consommation": 100, "nucleaire": "70.5", "gaz": "ND", "taux_co2": 30},
                {"date_heure": hours[1], "consommation": 0, "taux_co2": 30},
                {"date_heure": hours[2], "consommation": 90, "taux_co2": -1},
            ]},
        ),
    }
    as_of = F.lit(datetime(2026, 1, 6))
    first = daily.run(spark, sources, base, as_of, 0)
    v1 = kept(spark, base)
    again = {
        "fact_consommation": docs(spark, consumption((hours[1], 111.0), ("2026-01-05T14:00:00+01:00", 80.0))),
        "fact_consommation_regionale": sources["fact_consommation_regionale"],
        "fact_actualites": spark.createDataFrame(
            [(0, "https://s/a-b-c", PAGE.replace("titre", "texte").replace("sum", "vis"))],
            "seq long, url string, html string",
        ),
        "fact_meteoid": sources["fact_meteoid"],
        "fact_eco2mix": sources["fact_eco2mix"],
    }
    second = daily.run(spark, again, base, as_of, 1)
    return {"v1": v1, "v2": kept(spark, base), "root": base}, first, second


def kept(spark, base):
    """The facts as they are now, apart from the stored tables."""
    tables = {}
    for name, f in FACTS.items():
        rows = [tuple(r) for r in daily.read_fact(spark, f, base).collect()]
        tables[name] = spark.createDataFrame(rows, f.schema)
    return tables


def fact(spark, base, version, name):
    return base[version][name]


def test_first_run_lands_every_source(spark, runs):
    base, (_, _, errors, rejected), _ = runs
    assert errors == {}
    assert rejected == {name: {} for name in FACTS} | {
        "fact_prix_marche": {"null date_heure": 1}, "fact_actualites": {"null titre": 1}}
    conso = {(r.start_date.hour, r.start_date.minute, r.type): r.value_mw for r in fact(spark, base, "v1", "fact_consommation").collect()}
    assert conso == {(9, 0, "REALISED"): 120.0, (9, 15, "REALISED"): 110.0, (12, 0, "REALISED"): 90.0, (9, 0, "D-1"): 1.0}
    prices = {r.date_heure.hour * 100 + r.date_heure.minute: r.prix_eur_mwh for r in fact(spark, base, "v1", "fact_prix_marche").collect()}
    assert prices == {900: 50.5, 915: None, 1200: 60.0}
    assert fact(spark, base, "v1", "fact_meteoid").count() == 4  # cut to the shortest array
    region = fact(spark, base, "v1", "fact_consommation_regionale").filter("region = 'Bretagne'").first()
    assert (region.code_insee_region, region.consommation_brute_electricite_mw) == ("53", 7.0)  # code of the first row
    mix = {r.date_heure.minute: r for r in fact(spark, base, "v1", "fact_eco2mix").collect() if r.date_heure.hour == 9}
    assert (mix[0].nucleaire, mix[0].gaz, mix[0].pompage) == (70.5, None, None)


def test_news_keeps_title_and_date_of_first_landing(spark, runs):
    base, _, _ = runs
    before, after = (fact(spark, base, v, "fact_actualites").collect() for v in ("v1", "v2"))
    assert len(before) == len(after) == 1
    assert before[0].titre == after[0].titre == "Un titre d’essai & plus"
    assert str(after[0].date_publication) == "2026-01-04"
    assert (before[0].contenu_resume, after[0].contenu_resume) == ("Résumé", "Révisé")


def test_second_run_updates_and_survives_a_missing_source(spark, runs):
    base, _, (gold, report, errors, _) = runs
    assert list(errors) == ["fact_prix_marche"]
    values = {r.value_mw for r in fact(spark, base, "v2", "fact_consommation").filter("type = 'REALISED'").collect()}
    assert values == {120.0, 111.0, 90.0, 80.0}
    lags = {r.source: (r.lag_hours, r.empty) for r in report.collect()}
    assert lags["fact_consommation"] == (11.0, False)
    assert lags["fact_actualites"] == (48.0, False)
    assert set(gold) == {
        "consommation_mensuelle", "top_pics_nationaux", "consommation_regions_cles", "correlations",
        "mix_energetique_moyen", "correlations_saisonnieres",
    }
    month = gold["consommation_mensuelle"].collect()
    assert [(r.consommation_moyenne_mw, r.pic_mw, r.creux_mw) for r in month] == [(100.0, 120.0, 80.0)]


def test_gold_of_touched_months_equals_a_full_rebuild(spark, runs):
    base, _, (published, *_) = runs
    whole = gold(silver(base["v2"]))
    assert set(whole) == set(published)
    for name, table in whole.items():
        assert published[name].columns == table.columns, name
        assert sorted(map(str, published[name].collect())) == sorted(map(str, table.collect())), name


def test_only_touched_months_are_rebuilt(spark, tmp_path):
    root, f = str(tmp_path / "facts"), FACTS["fact_consommation"]

    def land(run, *points):
        daily.land(spark, f, daily.consumption_rows(docs(spark, consumption(*points))), root, run)

    def refresh():
        return monthly.refresh(spark, root, lambda months: daily.read_facts(spark, root, months))

    def rows(tables, name):
        return sorted(map(str, tables[name].collect()))

    land(0, ("2026-01-05T10:00:00Z", 1.0), ("2026-02-05T10:00:00Z", 5.0), ("2026-02-06T10:00:00Z", 7.0))
    assert refresh()[1] == ["2026-01", "2026-02"]
    assert refresh()[1] == []  # nothing has landed since
    land(1, ("2026-02-05T10:00:00Z", 9.0))
    land(2, ("2026-03-05T10:00:00Z", 2.0))
    january = Path(root, "gold_state", "month_stats", "part=2026-01")
    before = sorted(p.name for p in january.iterdir())
    tables, months = refresh()
    assert months == ["2026-02", "2026-03"] and sorted(p.name for p in january.iterdir()) == before
    whole = gold(silver(daily.read_facts(spark, root)))
    for name in whole:
        assert rows(tables, name) == rows(whole, name), name
    assert [r.pic_mw for r in tables["consommation_mensuelle"].orderBy("mois").collect()] == [1.0, 9.0, 2.0]


def test_silver_joins_exact_and_by_hour(spark, runs):
    base, *_ = runs
    layer = silver({n: fact(spark, base, "v1", n) for n in FACTS if n != "fact_prix_marche"} | {
        "fact_prix_marche": fact(spark, base, "v1", "fact_prix_marche")})
    exact = {r.date_heure.minute + 60 * r.date_heure.hour: r for r in layer["conso_meteo_prix"].collect()}
    assert exact[9 * 60 + 15].temperature_moyenne_nationale is None
    by_hour = {r.date_heure.minute + 60 * r.date_heure.hour: r for r in layer["conso_meteo_prix_carbone"].collect()}
    assert by_hour[9 * 60 + 15].temperature_moyenne_nationale == 1.0
    assert by_hour[9 * 60 + 15].prix_eur_mwh is None
    assert by_hour[9 * 60].taux_co2 == 30 and by_hour[12 * 60].taux_co2 is None  # gate drops -1
    assert layer["dim_region"].count() == 2
    assert layer["consommation_regionale"].count() == 1


def test_study_runs_over_the_facts(spark, runs):
    base, *_ = runs
    facts = {n: fact(spark, base, "v1", n) for n in FACTS}
    hourly = analysis.hourly_base(facts)
    assert [(r.date_heure.hour, r.consommation_mw) for r in hourly.orderBy("date_heure").collect()] == [
        (9, 115.0), (10, None), (11, None), (12, 90.0)]
    for name, table in analysis.study(settled(analysis.clean_base(hourly), "base")).items():
        assert table.count() >= 1, name
    regional = analysis.regional_base(facts, silver(facts)["dim_region"])
    assert {n: t.count() for n, t in analysis.study_regions(regional).items()} == {"means": 1, "key_regions": 1, "share": 1}


def test_constraints_hold_after_landing(spark, runs):
    base, *_ = runs
    broken = daily.check_sources({n: fact(spark, base, "v1", n) for n in FACTS})
    assert {n: d.count() for n, d in broken.items()} == {n: 0 for n in FACTS}


def test_windows_read_only_their_months(spark, tmp_path, capsys):
    root, f = str(tmp_path / "facts"), FACTS["fact_consommation"]
    stamps = ["2025-12-31T23:30:00Z", "2026-01-01T00:00:00Z", "2026-01-31T23:59:00Z", "2026-02-01T00:00:00Z"]
    rows = daily.consumption_rows(docs(spark, consumption(*[(s, float(i)) for i, s in enumerate(stamps)])))
    daily.land(spark, f, rows, root, 0)
    january = daily.read_fact(spark, f, root, date(2026, 1, 1), date(2026, 2, 1))
    assert {r.value_mw for r in january.collect()} == {1.0, 2.0}
    assert {r.value_mw for r in daily.read_fact(spark, f, root, until=date(2026, 1, 1)).collect()} == {0.0}
    assert {r.value_mw for r in daily.newest_rows(spark, f, root).collect()} == {3.0}
    january.explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if line.startswith("PartitionFilters")]
    assert filters and "2026-01" in filters[0]
    (tmp_path / "none").mkdir()
    assert daily.newest_rows(spark, f, str(tmp_path / "none")).count() == 0


def test_rejected_rows_are_counted_and_corrections_of_a_number_land(spark, tmp_path):
    root, name = str(tmp_path / "facts"), "fact_consommation"
    stamp = "2026-01-05T10:00:00+01:00"

    def land(value):
        rows = daily.consumption_rows(docs(spark, consumption((stamp, value), (None, 5.0))))
        return daily.land(spark, FACTS[name], rows, root, 0)

    def landed():
        return [r.value_mw for r in daily.read_fact(spark, FACTS[name], root).collect()]

    assert land(float("nan")) == {"null start_date": 1, "null value_mw": 1}  # NaN is missing, and this is required
    assert landed() == []
    for value in (1.0, 99.0, 99.0):
        assert land(value) == {"null start_date": 1}
        assert landed() == [value]


def test_unreadable_documents_and_rejected_rows_are_kept(spark, tmp_path):
    root, name = str(tmp_path / "facts"), "fact_consommation"
    good = json.dumps(consumption(("2026-01-05T10:00:00Z", 1.0), (None, 5.0)))
    texts = [good, good[:50], "", None, '{"error": "quota"}', "[]", good + "x", '{"short_term": [{"type": "ID"}]}']
    rows = spark.createDataFrame(list(enumerate(texts)), "seq long, json string")

    def quarantined():
        return Counter((r.source, r.run, r.reason, r.seq, r.text) for r in daily.read_quarantine(spark, root).collect())

    def fields(value):
        return json.dumps({"start_date": None, "end_date": None, "updated_date": "2026-01-05T11:00:00.000Z", "value_mw": value, "type": "REALISED"}, separators=(",", ":"))

    counts = daily.land(spark, FACTS[name], daily.consumption_rows(rows), root, 3)
    assert counts == {"null start_date": 1, "not JSON": 2, "empty document": 1, "no document": 1, "unexpected shape": 3}
    want = Counter({
        (name, 3, "null start_date", 0, fields(5.0)): 1, (name, 3, "not JSON", 1, good[:50]): 1, (name, 3, "not JSON", 6, good + "x"): 1,
        (name, 3, "empty document", 2, ""): 1, (name, 3, "no document", 3, None): 1, (name, 3, "unexpected shape", 5, "[]"): 1,
        (name, 3, "unexpected shape", 4, texts[4]): 1, (name, 3, "unexpected shape", 7, '{"type":"ID"}'): 1,
    })
    assert quarantined() == want
    daily.land(spark, FACTS[name], daily.consumption_rows(rows), root, 3)  # the same again adds nothing
    assert quarantined() == want
    daily.land(spark, FACTS[name], daily.consumption_rows(rows.filter("seq < 2")), root, 3)  # corrected
    assert {k[2] for k in quarantined()} == {"null start_date", "not JSON"}
    daily.land(spark, FACTS[name], daily.consumption_rows(rows.filter("seq = 2")), root, 4)
    assert {k[1:3] for k in quarantined()} == {(3, "null start_date"), (3, "not JSON"), (4, "empty document")}
    assert [r.value_mw for r in daily.read_fact(spark, FACTS[name], root).collect()] == [1.0]


def test_every_reader_reports_an_outage(spark, tmp_path):
    root = str(tmp_path / "facts")
    for name, reader in daily.READERS.items():
        broken = docs(spark, {}, {}, region=["Bretagne", "Corse"]).withColumn("json", F.lit('{"broken json'))
        assert daily.land(spark, FACTS[name], reader(broken), root, 0) == {"not JSON": 2}
    assert daily.read_quarantine(spark, root, "fact_eco2mix").count() == 2


def test_corrected_batch_of_repeated_rows_lands(spark, tmp_path):
    for value in (1.0, 99.0):
        batch = spark.createDataFrame([(1, "2026-01", value, 0), (1, "2026-01", value, 0)], "k long, part string, v double, seq long")
        upsert_partitions(spark, f"{tmp_path}/table", batch, ["k", "part"], ["v"], "seq", "part", 1, f"{tmp_path}/staged")
    assert [r.v for r in spark.read.parquet(f"{tmp_path}/table").collect()] == [99.0]
