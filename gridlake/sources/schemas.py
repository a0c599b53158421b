"""Declared schemas: payloads at the edge and the six fact tables with their keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


TEXT, NUMBER, STAMP, DAY = StringType(), DoubleType(), TimestampType(), DateType()

# Payload and table field names of the sources.
MIX_SOURCES = ["nucleaire", "eolien", "solaire", "hydraulique", "gaz", "charbon", "fioul", "bioenergies"]
MIX_FIELDS = ["consommation", *MIX_SOURCES, "pompage", "ech_physiques", "taux_co2"]

CONSUMPTION_PAYLOAD = _struct(
    short_term=ArrayType(
        _struct(
            type=TEXT,
            values=ArrayType(_struct(start_date=TEXT, end_date=TEXT, updated_date=TEXT, value=NUMBER)),
        )
    )
)
WEATHER_PAYLOAD = _struct(
    hourly=_struct(
        time=ArrayType(TEXT),
        temperature_2m=ArrayType(NUMBER),
        windspeed_10m=ArrayType(NUMBER),
        cloud_cover=ArrayType(NUMBER),
    )
)
REGIONAL_PAYLOAD = _struct(
    results=ArrayType(
        _struct(
            date_heure=TEXT,
            date=TEXT,
            code_insee_region=TEXT,
            region=TEXT,
            consommation_brute_electricite_rte=NUMBER,
            statut_rte=TEXT,
        )
    )
)
MIX_PAYLOAD = _struct(results=ArrayType(_struct(date_heure=TEXT, **{c: TEXT for c in MIX_FIELDS})))


KEY_BUCKETS = 64


@dataclass(frozen=True)
class Fact:
    """A landed table: schema, primary key, required columns, and what an upsert may change."""

    name: str
    schema: StructType
    key: list[str]
    updates: list[str]
    required: list[str] = field(default_factory=list)
    stamp: str = "date_heure"

    def must_have(self) -> list[str]:
        return list(dict.fromkeys([*self.key, *self.required]))

    def by_month(self) -> bool:
        return self.stamp in self.key

    def partition(self) -> Column:
        """Storage partition of a row, which must follow from the key: its month, else a bucket of the key."""
        if self.by_month():
            return F.date_format(self.stamp, "yyyy-MM")
        return F.format_string("b%02d", F.pmod(F.xxhash64(*self.key), F.lit(KEY_BUCKETS)))

    def decimal_schema(self) -> StructType:
        """The same table with exact decimals instead of doubles, for readers that need them."""
        return StructType(
            [
                StructField(f.name, DecimalType(18, 6) if f.dataType == NUMBER else f.dataType, True)
                for f in self.schema
            ]
        )


FACTS = {
    f.name: f
    for f in [
        Fact(
            "fact_consommation",
            _struct(start_date=STAMP, end_date=STAMP, updated_date=STAMP, value_mw=NUMBER, type=TEXT),
            key=["start_date", "type"],
            updates=["end_date", "updated_date", "value_mw"],
            required=["end_date", "updated_date", "value_mw"],
            stamp="start_date",
        ),
        Fact(
            "fact_meteoid",
            _struct(
                date_heure=STAMP, region=TEXT, temperature_2m=NUMBER, windspeed_10m=NUMBER, cloud_cover_total=NUMBER
            ),
            key=["date_heure", "region"],
            updates=["temperature_2m", "windspeed_10m", "cloud_cover_total"],
        ),
        Fact(
            "fact_prix_marche",
            _struct(date_heure=STAMP, prix_eur_mwh=NUMBER),
            key=["date_heure"],
            updates=["prix_eur_mwh"],
        ),
        Fact(
            "fact_consommation_regionale",
            _struct(
                date_heure=STAMP,
                code_insee_region=TEXT,
                region=TEXT,
                consommation_brute_electricite_mw=NUMBER,
                statut_rte=TEXT,
            ),
            key=["date_heure", "region"],
            updates=["consommation_brute_electricite_mw", "statut_rte"],
        ),
        Fact(
            "fact_actualites",
            _struct(url_source=TEXT, date_publication=DAY, titre=TEXT, contenu_resume=TEXT),
            key=["url_source"],
            updates=["contenu_resume"],
            required=["date_publication", "titre"],
            stamp="date_publication",
        ),
        Fact(
            "fact_eco2mix",
            _struct(date_heure=STAMP, **{c: NUMBER for c in MIX_FIELDS}),
            key=["date_heure"],
            updates=list(MIX_FIELDS),
        ),
    ]
}
