"""Duplicates over authored blocks of eight postings, one block for each order.

Each block holds every branch of a reducer once, under a company of its own.
Which row loses to which is stated by hand; the SQL twins repeat that for each
order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.catalogue.base import query, spread, table
from postlode.operators import dedup

SIZE = 8
SCHEMA = "source string, title string, location string, country_iso string, external_id string, url string, description string, employment_type string, days int, requisition string, company string"


def row(source: str, title: str, place: str | None = "Berlin", country: str | None = "de", external: str | None = None, url: str | None = None, text: str | None = "text", kind: str | None = "INTERN", days: int = 10, requisition: str | None = None, company: str = "Co {} GmbH") -> tuple:
    return source, title, place, country, external, url, text, kind, days, requisition, company


#: By external id, by address, and by title and place; a better row takes the place of the one it meets, with its keys.
CASCADE = [
    row("a", "Praktikum Data", external="x", url="https://j.example/{}/1"),
    row("a", "Other title", "Ulm", external="x", text=None),
    row("b", "Third title", "Kiel", url="https://J.example/{}/1?utm_source=q", text=None),
    row("c", "Data Internship", days=30),
    row("d", "Fourth title", "Bonn", url="https://j.example/{}/1/", text=None, kind=None),
    row("e", "Buyer Steel", text=None),
    row("f", "Steel Buyer (m/w/d)"),
    row("g", "Buyer Steel", "Hamburg"),
]
CASCADE_LOST = [(1, 0, "external_id"), (2, 0, "url"), (0, 3, "company+title+location"), (4, 3, "url"), (5, 6, "company+title+location")]
#: A bulk source takes the place of another; countries that contradict, one source, and other employers do not meet.
SOURCES = [
    row("board", "Buyer Steel", company="Acme {} GmbH"),
    row("bulk:x", "Steel Buyer", company="ACME {}"),
    row("feed", "Buyer Steel", country="fr", company="Acme {}"),
    row("bulk:x", "Buyer Steel", company="Acme {}"),
    row("board", "Buyer Steel", company="Other {}"),
    row("list", "Buyer Steel", country=None, company="Acme {}", text=None),
    row("board", "Buyer Copper", company="Acme {}"),
    row("feed", "Buyer Copper", company="Acme {}", text=None),
]
SOURCES_LOST = [(0, 1), (5, 1), (7, 6)]
#: Of one requisition the described row stays; other languages and equal titles are its mirrors, contradicting countries are not.
MIRRORS = [
    row("s", "Praktikum und Daten", text=None, requisition="{}-1"),
    row("s", "Internship and Data", requisition="{}-1"),
    row("s", "Praktikum und Daten", country="fr", text=None, requisition="{}-1"),
    row("s", "Internship and Purchasing", text=None, requisition="{}-1"),
    row("s", "Data Internship and", text=None, kind=None, requisition="{}-1"),
    row("s", "Praktikum und Daten", requisition="{}-2"),
    row("t", "Internship and Data", requisition="{}-1"),
    row("s", "Internship and Data"),
]
MIRRORS_LOST = [(0, 1), (4, 1)]
#: The first posting for any place goes with the first for a place, and so on; the third finds none.
ANYWHERE = [row("s", "Buyer", p) for p in ("any", "Ulm", "any", "Bonn", "any")] + [row("s", "Seller", p) for p in ("Kiel", "any", "Kiel")]
ANYWHERE_LOST = [(0, 1), (2, 3), (6, 5)]


def block(spark: SparkSession, sf_dir: str, rows: list[tuple]) -> DataFrame:
    """Eight postings for each order; `{}` stands for its key."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [f.split()[1] for f in SCHEMA.split(", ")]
    key = F.col("o_orderkey").cast("string")
    value = lambda x, kind: F.replace(F.lit(x), F.lit("{}"), key) if isinstance(x, str) and "{}" in x else F.lit(x).cast(kind)
    made = [F.struct(F.lit(i).alias("at"), *[value(x, k).alias(n) for x, k, n in zip(r, kinds, names, strict=True)]) for i, r in enumerate(rows)]
    flat = spread(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey").select("o_orderkey", F.inline(F.array(*made)))
    ordinal = F.col("o_orderkey") * SIZE + F.col("at")
    return flat.withColumns({"id": ordinal, "_ord": ordinal, "posted_at": F.date_sub(F.lit("2024-01-01").cast("date"), F.col("days"))}).drop("o_orderkey", "at", "days")


def lost(pairs: list[tuple]) -> str:
    """The stated pairs of each order as SQL."""
    tier = ", tier" if len(pairs[0]) == 3 else ""
    values = ", ".join(f"({a}, {b}{f', {chr(39)}{t[0]}{chr(39)}' if t else ''})" for a, b, *t in pairs)
    return f"SELECT o_orderkey * {SIZE} + l AS loser, o_orderkey * {SIZE} + w AS winner{tier} FROM orders, (VALUES {values}) v(l, w{tier})"


@query(lost(CASCADE_LOST))
def dedup_cascade_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.cascade(block(spark, sf_dir, CASCADE))


@query(lost(SOURCES_LOST))
def dedup_sources_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.cross_source(block(spark, sf_dir, SOURCES))


@query(lost(MIRRORS_LOST))
def dedup_mirrors_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.mirrors(block(spark, sf_dir, MIRRORS))


@query(lost(ANYWHERE_LOST))
def dedup_anywhere_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.wildcard_pairs(block(spark, sf_dir, ANYWHERE), F.col("location") == "any")


@query(f"SELECT o_orderkey * {SIZE} + i AS id FROM orders, range({SIZE}) r(i) WHERE i NOT IN ({', '.join(str(x[0]) for x in CASCADE_LOST)})")
def dedup_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = block(spark, sf_dir, CASCADE)
    return dedup.survivors(rows, dedup.cascade(rows)).select("id")


@query("SELECT size, count(*) AS components FROM orders, (VALUES (5), (2)) v(size) GROUP BY 1")
def dedup_component_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows one task of the cascade has to replay, and how often."""
    return dedup.component_sizes(block(spark, sf_dir, CASCADE))
