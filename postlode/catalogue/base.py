"""Registration of queries, and documents seen as postings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.functions.text import ACCENTED, PLAIN
from postlode.rules import Area, Reason, mentions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """rows dealt out by columns that tell them apart: a narrow table is read by few tasks, however much each row then makes of it."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as postings: the first words are the title, the language stands for the country."""
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    return d.select(
        i.alias("id"), i.alias("_ord"), "source", F.substring_index("text", " ", 8).alias("title"), F.concat(F.lit("co"), i % 37).alias("company"), F.concat(F.lit("https://jobs.example/"), i % 300, F.when(i % 3 == 0, "?utm_source=x").otherwise("")).alias("url"),
        F.col("lang").alias("country_iso"), F.concat(F.lit("city"), i % 5).alias("location"), F.col("text").alias("description"), F.when(i % 4 == 0, F.concat(F.lit("r"), i % 50)).alias("external_id"), F.when(i % 5 == 0, "INTERN").when(i % 5 == 1, "FULL_TIME").alias("employment_type"),
        F.date_sub(F.lit("2024-01-01").cast("date"), (i % 700).cast("int")).alias("posted_at"), F.concat(F.lit("q"), F.floor(i / 2)).alias("requisition"),
    )


#: The same view for the SQL twins; `fold` folds as functions.text.fold does.
P = """WITH p AS (SELECT doc_id AS id, source, array_to_string(string_split(text, ' ')[1:8], ' ') AS title, 'co' || (doc_id % 37) AS company, 'https://jobs.example/' || (doc_id % 300) || CASE WHEN doc_id % 3 = 0 THEN '?utm_source=x' ELSE '' END AS url, lang AS country_iso, 'city' || (doc_id % 5) AS location, text AS description, CASE WHEN doc_id % 5 = 0 THEN 'INTERN' WHEN doc_id % 5 = 1 THEN 'FULL_TIME' END AS employment_type, DATE '2024-01-01' - CAST(doc_id % 700 AS INTEGER) AS posted_at FROM documents)"""


def fold_sql(c: str) -> str:
    return f"translate(replace(lower(coalesce({c}, '')), 'ß', 'ss'), '{ACCENTED}', '{PLAIN}')"


def mentions_sql(c: str, terms: list[str]) -> str:
    return f"regexp_matches({fold_sql(c)}, '\\b(?:{'|'.join(terms)})\\b')"


STUDENT, SENIOR = ["the", "la", "de", "der", "die"], ["inthe", "ouwh", "enge"]
PRIMARY, RELATED, WEAK, OTHER = ["ering", "tion", "ent", "aire", "cion"], ["edly", "anst", "ung", "ment"], ["onth", "hend", "eau"], ["thing"]
SKILLS = {"ering": ["ering", "eringer"], "tion": ["tion", "tions"], "hend": ["hend"], "ung": ["ung", "ungen"], "absent": ["zzyzx"]}
AREA = Area({"primary": (PRIMARY, 3.0, 1.0), "related": (RELATED, 2.0, 0.5), "weak": (WEAK, 1.0, 0.5)}, {"thing": ["onth"]})
AREA_SQL = f"(CASE WHEN {mentions_sql('title', PRIMARY)} THEN 3.0 ELSE 0 END + CASE WHEN {mentions_sql('description', PRIMARY)} THEN 1.0 ELSE 0 END + CASE WHEN {mentions_sql('title', RELATED)} THEN 2.0 ELSE 0 END + CASE WHEN {mentions_sql('description', RELATED)} THEN 0.5 ELSE 0 END + CASE WHEN {mentions_sql('title', ['hend', 'eau'])} OR ({mentions_sql('title', ['onth'])} AND NOT {mentions_sql('title', ['thing'])}) THEN 1.0 ELSE 0 END + CASE WHEN {mentions_sql('description', WEAK)} THEN 0.5 ELSE 0 END)::DOUBLE"


def area() -> Column:
    return AREA.score(F.col("title"), F.col("description"))


def stages() -> list[tuple[str, Column]]:
    student = mentions(F.col("title"), STUDENT) | (F.col("employment_type") == "INTERN")
    return [("typed", F.coalesce(student, F.lit(False))), ("in_area", area() >= 1.5), ("in_country", F.col("country_iso").isin("en", "de"))]


STAGES_SQL = [("typed", f"({mentions_sql('title', STUDENT)} OR coalesce(employment_type = 'INTERN', FALSE))"), ("in_area", f"{AREA_SQL} >= 1.5"), ("in_country", "country_iso IN ('en', 'de')")]


def reasons() -> list[Reason]:
    return [
        Reason("senior", mentions(F.col("title"), SENIOR), hard=True),
        Reason("full_time", F.col("employment_type") == "FULL_TIME"),
        Reason("experience", F.col("description").rlike(r"\b[0-9]+ (?:years|ans|Jahre)")),
        Reason("symbols", F.col("description").rlike(r"[#$%]{3}")),
        Reason("stale", F.datediff(F.lit("2024-01-01").cast("date"), F.col("posted_at")) / 30.44 > 12),
    ]


REASON_SQL = f"CASE WHEN {mentions_sql('title', SENIOR)} THEN 'senior' WHEN employment_type = 'FULL_TIME' THEN 'full_time' WHEN regexp_matches(description, '\\b[0-9]+ (?:years|ans|Jahre)') THEN 'experience' WHEN regexp_matches(description, '[#$%]{{3}}') THEN 'symbols' WHEN (DATE '2024-01-01' - posted_at) / 30.44 > 12 THEN 'stale' END"
SCORE_PARTS = {
    "skills": f"CASE WHEN {mentions_sql('description', ['ering'])} THEN 1.0 ELSE 0 END + CASE WHEN {mentions_sql('description', ['hend'])} THEN 1.0 ELSE 0 END",
    "language": "CASE WHEN country_iso = 'en' THEN 1.5 WHEN country_iso = 'fr' THEN -0.5 ELSE 0 END",
    "penalty": f"CASE WHEN {mentions_sql('title', SENIOR)} THEN -3.0 ELSE 0 END",
}
SCORE_PARTS_SQL = " + ".join([AREA_SQL, *SCORE_PARTS.values()])
DECAY_SQL = "pow(0.5, least(greatest(DATE '2024-01-01' - posted_at, 0), 3650) / 365.0)"


def components() -> dict[str, Column]:
    return {
        "area": area(),
        "skills": F.when(mentions(F.col("description"), ["ering"]), 1.0).otherwise(0.0) + F.when(mentions(F.col("description"), ["hend"]), 1.0).otherwise(0.0),
        "language": F.when(F.col("country_iso") == "en", 1.5).when(F.col("country_iso") == "fr", -0.5).otherwise(0.0),
        "penalty": F.when(mentions(F.col("title"), SENIOR), -3.0).otherwise(0.0),
    }


def now() -> Column:
    return F.lit("2024-01-01 00:00:00").cast("timestamp")
