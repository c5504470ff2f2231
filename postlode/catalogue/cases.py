"""Authored postings that reach every branch of the text rules, spread over the rows of `orders`.

The verdicts are stated by hand beside each text. A query applies an operator
to the texts; its SQL twin holds the stated verdicts, so the two agree only if
the operator reads every text as a person does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.catalogue.base import query, spread, table
from postlode.functions import applicability, extract, money, seasons
from postlode.operators import filters

#: (title, description, employment type, months since it was posted, why it is dropped).
POSTINGS = [
    ("Praktikum Einkauf", "Fluent German is required for this role.", None, 1, "german_required"),
    ("Internship Supply Chain", "Sehr gute Deutschkenntnisse sind erforderlich.", None, 1, "german_required"),
    ("Internship Supply Chain", "German would be a plus for daily life.", None, 1, None),
    ("Intern Data", "No German needed, we speak English.", None, 1, None),
    ("Intern Sales", "You are a native speaker of Polish.", None, 1, "native_language"),
    ("Intern Sales", "Ideally you are a native speaker of Polish.", None, 1, None),
    ("Praktikum Produktion", "A valid work permit is needed before the first day.", None, 1, "visa_blocked"),
    ("Praktikum Produktion", "We help you if a valid work permit is missing.", None, 1, None),
    ("Masterarbeit Logistik", "You write about stocks.", None, 1, "thesis_title"),
    ("Bachelor Thesis Lightweight Steel", "You write about steel.", None, 1, "thesis_title"),
    ("Werkstudent Controlling", "You check invoices.", None, 1, "werkstudent_puro"),
    ("Werkstudent / Praktikum Controlling", "You check invoices.", None, 1, None),
    ("Intern Strategy", "You are a master student of economics.", None, 1, "master_required"),
    ("Intern Strategy", "You study for a bachelor's or master degree.", None, 1, None),
    ("Intern Public Affairs", "Only for EU citizens.", None, 1, "eu_citizenship_required"),
    ("Intern Public Affairs", "Open to non EU citizens as well.", None, 1, None),
    ("Intern Brand", "You are enrolled at a Dutch university.", None, 1, "nl_enrolment_required"),
    ("Intern Brand", "You are enrolled at a German university.", None, 1, "de_enrolment_required"),
    ("Intern Brand", "You are enrolled at a university in Germany.", None, 1, "de_enrolment_required"),
    ("Intern Brand", "You are enrolled at a European university.", None, 1, "eu_enrolment_required"),
    ("Intern Brand", "You are enrolled at a university and work in the office.", None, 1, None),
    ("PhD Internship Batteries", "You test cells.", None, 1, "phd_position"),
    ("Internship Quality 12 months", "You test parts.", None, 1, "duration_over_6m"),
    ("Internship Quality 3 to 6 months", "You test parts.", None, 1, None),
    ("Intern Planning", "This internship lasts 12 months.", None, 1, "duration_conflict"),
    ("Intern Planning", "This is a one year internship.", None, 1, "duration_conflict"),
    ("Intern Planning", "The internship takes 6 to 12 months.", None, 1, None),
    ("Intern Planning", "You can start your internship within 12 months.", None, 1, None),
    ("Business Analyst", "You steer projects.", "FULL_TIME", 1, "full_time_permanent"),
    ("Business Analyst Intern", "You steer projects.", "FULL_TIME", 1, None),
    ("Hiwi Werkstoffkunde", "You run the furnace.", None, 1, "job_type_non_internship"),
    ("Buyer", "This is a permanent contract.", None, 1, "job_type_non_internship"),
    ("Erasmus+ Traineeship Hotel", "You welcome guests.", None, 1, "erasmus_program"),
    ("Spontaneous Application", "Send us your papers.", None, 1, "spontaneous_pool"),
    ("Initiativbewerbung Praktikum", "Send us your papers.", None, 1, "spontaneous_pool"),
    ("Intern Purchasing", "You bring at least 2 years of professional experience.", None, 1, "experience_required"),
    ("Intern Purchasing", "We were founded 180 years ago and have much experience.", None, 1, None),
    ("Intern Purchasing", "0-2 years of experience are fine.", None, 1, None),
    ("Intern Finance", "You are a recent graduate.", None, 1, "recent_graduate"),
    ("Intern Finance", "You are enrolled or a recent graduate.", None, 1, None),
    ("Intern Marketing", "You write texts.", None, 14, "stale_posting"),
    ("Intern Marketing", "You write texts.", None, 11, None),
    ("Intern Marketing", None, None, None, None),
]

#: (text, lowest, highest, period, currency), None where no pay is stated.
PAY = [
    ("Salary: 2.117 € per month", (2117.0, 2117.0, "month", "EUR")),
    ("Gehalt 17,50 €/Stunde", (17.5, 17.5, "hour", "EUR")),
    ("We pay EUR 1,200 - 1,400 to interns", (1200.0, 1400.0, "month", "EUR")),
    ("Annual salary 60.000 EUR", (5000.0, 5000.0, "month", "EUR")),
    ("Bruttojahresgehalt: 36.000 €", (3000.0, 3000.0, "month", "EUR")),
    ("Compensation 80000 EUR", (80000.0, 80000.0, None, "EUR")),
    ("Vergütung: 1.400,50 Euro", (1400.5, 1400.5, "month", "EUR")),
    ("A pay of €54,000/year", (4500.0, 4500.0, "month", "EUR")),
    ("Pay $20 per hour or $3000 per month", (20.0, 20.0, "hour", "USD")),
    ("Pay 900 EUR, later a salary of 1100 EUR per month", (1100.0, 1100.0, "month", "EUR")),
    ("Stundenlohn 15 EUR", (15.0, 15.0, "hour", "EUR")),
    ("Founded with 500 employees", None),
    ("We need 3 years of experience", None),
    ("Sales of 300 EUR", None),
    ("", None),
]

#: (text, kind, start, end, conflict with a start from 2027-01 to 2027-09).
STARTS = [
    ("Beginn: ab sofort für 6 Monate", "immediate", None, None, "IMMEDIATE"),
    ("Praktikum ab 1. März 2027 für 6 Monate", "start", "2027-03", "2027-08", None),
    ("Sommersemester 2027", "semester", "2027-04", "2027-09", None),
    ("WiSe 2026/27 in Berlin", "semester", "2026-10", "2027-03", "TOO_EARLY"),
    ("from March to August 2027", "range", "2027-03", "2027-08", None),
    ("November - February 2026", "range", "2026-11", "2027-02", "TOO_EARLY"),
    ("ab 01.10.2027", "start", "2027-10", None, "TOO_LATE"),
    ("start date: 2027-02", "start", "2027-02", None, None),
    ("ab September", "ambiguous_start", None, None, None),
    ("our team likes you immediately", "immediate", None, None, None),
    ("Sommersemester or ab Mai 2027", "semester", None, None, None),
    ("a wise choice for your career", None, None, None, None),
]

#: (text, demand for German).
GERMAN = [
    ("Fluent German is a must", "required"), ("German (C1)", "required"), ("German language skills are an advantage", "preferred"), ("good to have: some German lessons", "plus"),
    ("German not required", "none"), ("We love tea", None), ("German is nice to have. In the office fluent German is spoken", "required"), ("Deutschkenntnisse von Vorteil", "preferred"),
]


def lit(x: object) -> str:
    """A value as SQL."""
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'" if isinstance(x, str) else repr(x)


def stated(verdicts: list, of: str = "VARCHAR") -> str:
    """The stated verdict of an order's case as SQL; lists count from 1."""
    return f"([{', '.join(map(lit, verdicts))}]::{of}[])[(o_orderkey % {len(verdicts)})::INT + 1]"


def cases(spark: SparkSession, sf_dir: str, rows: list[tuple], schema: str) -> DataFrame:
    """Each order as one of the authored rows, in turn. The few rows are a literal; no table is joined."""
    fields = [f.split() for f in schema.split(", ")]
    made = F.array(*[F.struct(*[F.lit(x).cast(kind).alias(name) for x, (name, kind) in zip(row, fields, strict=True)]) for row in rows])
    picked = spread(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey").select(F.col("o_orderkey").alias("id"), F.get(made, (F.col("o_orderkey") % len(rows)).cast("int")).alias("c"))
    return picked.select("id", "c.*")


def case_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cases(spark, sf_dir, [x[:4] for x in POSTINGS], "title string, description string, employment_type string, months int")
    day = F.lit("2024-01-01").cast("date")
    return rows.withColumn("posted_at", F.date_sub(day, (F.col("months") * 30.44).cast("int"))).drop("months")


def case_reasons() -> list:
    return applicability.ladder(F.lit("2024-01-01").cast("date"))


@query(f"SELECT o_orderkey AS id, {stated([x[4] for x in POSTINGS])} AS reason FROM orders")
def applicability_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of twenty reasons for each authored posting."""
    return filters.with_reason(case_postings(spark, sf_dir), case_reasons()).select("id", "reason")


@query(f"SELECT o_orderkey AS id FROM orders WHERE coalesce({stated([x[4] for x in POSTINGS])} NOT IN ({', '.join(map(lit, applicability.HARD))}), TRUE)")
def applicability_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays when the reasons that remove for good have removed."""
    return filters.hard_removals(filters.with_reason(case_postings(spark, sf_dir), case_reasons()), case_reasons()).select("id")


COUNTS = ", ".join(f"count(*) FILTER (WHERE reason = '{r}') AS {r}" for r in applicability.REASONS)


@query(f"WITH r AS (SELECT o_orderkey % 4 AS source, {stated([x[4] for x in POSTINGS])} AS reason FROM orders) SELECT source, count(*) AS total, {COUNTS}, count(*) FILTER (WHERE reason IS NULL) AS applicable FROM r GROUP BY 1")
def applicability_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reasons as columns by source, in one pass."""
    found = filters.with_reason(case_postings(spark, sf_dir), case_reasons()).withColumn("source", F.col("id") % 4)
    return filters.reason_matrix(found, "source", applicability.REASONS)


PAY_SQL = ", ".join(f"{stated([p and p[i] for _, p in PAY], of)} AS {name}" for i, (name, of) in enumerate((("low", "DOUBLE"), ("high", "DOUBLE"), ("period", "VARCHAR"), ("currency", "VARCHAR"))))


@query(f"SELECT * FROM (SELECT o_orderkey AS id, {PAY_SQL} FROM orders) WHERE low IS NOT NULL")
def salary_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    pay = cases(spark, sf_dir, [(t,) for t, _ in PAY], "text string").select("id", money.salary(F.col("text")).alias("s")).where("s IS NOT NULL")
    return pay.select("id", F.round("s.min", 6).alias("low"), F.round("s.max", 6).alias("high"), "s.period", "s.currency")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_totalprice > 6000 AND o_orderkey % 3 = 0 THEN 'month' WHEN o_totalprice > 6000 AND o_orderkey % 3 = 1 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'year' WHEN o_orderkey % 3 = 2 THEN 'hour' ELSE 'month' END AS period, CASE WHEN o_orderkey % 5 <> 0 THEN round(CASE WHEN o_totalprice > 6000 AND o_orderkey % 3 = 0 THEN o_totalprice / 12 ELSE o_totalprice END, 4) END AS low, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 3 = 0 THEN 'annual' END AS declared FROM orders")
def salary_structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices as structured pay of a year, of no stated period, and of an hour; every fifth is 0, which is no evidence."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 5 == 0, 0.0).otherwise(F.col("o_totalprice").cast("double")).alias("low"), F.when(F.col("o_orderkey") % 3 == 0, "YEAR").when(F.col("o_orderkey") % 3 == 2, "hourly").alias("period"))
    pay = money.salary(F.lit(""), F.col("low"), F.lit(None).cast("double"), F.col("period"), F.lit("eur"))
    return rows.select("id", pay.alias("s")).select("id", "s.period", F.round("s.min", 4).alias("low"), money.salary_period(F.col("s")).alias("declared"))


START_SQL = ", ".join(f"{stated([x[i] for x in STARTS])} AS {name}" for i, name in ((1, "kind"), (2, "start"), (3, "ends"), (4, "conflict")))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cases(spark, sf_dir, [(x[0],) for x in STARTS], "text string")
    return rows.select("id", seasons.season_hits(F.col("text")).alias("hits")).select("id", "hits", seasons.season(F.col("hits")).alias("hit"))


@query(f"SELECT o_orderkey AS id, {START_SQL} FROM orders")
def start_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The start that counts of each text, and whether it is too early, too late or at once."""
    return hits(spark, sf_dir).select("id", "hit.kind", "hit.start", F.col("hit.end").alias("ends"), seasons.start_conflict(F.col("hit"), "2027-01", "2027-09").alias("conflict"))


LABELS = ["at once", "2027-03", "SoSe 2027", "WiSe 2026/27", "2027-03/2027-08", "2026-11/2027-02", "2027-10", "2027-02", "month without year", "at once", "SoSe", None]


@query(f"SELECT label, count(*) AS n FROM (SELECT {stated(LABELS)} AS label FROM orders) WHERE label IS NOT NULL GROUP BY 1")
def start_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many postings start when."""
    return hits(spark, sf_dir).select(seasons.season_label(F.col("hit")).alias("label")).where("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n"))


@query(f"SELECT count(*) FILTER (WHERE i = 0) AS at_once_with_context, count(*) FILTER (WHERE i IN (4, 8)) AS ambiguous FROM (SELECT o_orderkey % {len(STARTS)} AS i FROM orders)")
def start_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = F.coalesce((F.col("hit.kind") == "immediate") & F.col("hit.context"), F.lit(False))
    return hits(spark, sf_dir).agg(F.count_if(told).alias("at_once_with_context"), F.count_if(seasons.start_is_ambiguous(F.col("hits"))).alias("ambiguous"))


@query(f"SELECT o_orderkey AS id, {stated([x[1] for x in GERMAN])} AS demand FROM orders")
def language_demands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark, sf_dir, [(x[0],) for x in GERMAN], "text string").select("id", applicability.language_demand(F.col("text")).alias("demand"))


#: (title, description, country, place, deadline in days, signals against, flags, readiness).
APPLICATIONS = [
    ("Praktikum Einkauf", "English is our language. " * 10, "de", "Berlin", None, "", "no_deadline", "ready"),
    ("Praktikum Einkauf", "Fluent German is required.", "de", "Berlin", 1, "german_required,deadline", "short_description", "verify"),
    ("Senior Buyer", "We offer visa support.", "fr", "", 30, "deadline,senior_title", "no_location,short_description,no_language", "verify"),
    ("Intern Sales", "No visa sponsorship.", "es", "Madrid", None, "wa_no_sponsorship", "no_deadline,short_description,no_language", "verify"),
    ("Intern Sales", "English speakers with a visa.", "es", "Madrid", None, "wa_unclear", "no_deadline,short_description", "verify"),
    ("Intern Sales", "English. Apply by 2024-01-20", "es", "Madrid", None, "deadline", "deadline_textual,short_description", "verify"),
]


@query(f"SELECT o_orderkey AS id, {stated([x[5] for x in APPLICATIONS])} AS problems, {stated([x[6] for x in APPLICATIONS])} AS flags, {stated([x[7] for x in APPLICATIONS])} AS readiness FROM orders")
def application_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands against applying, what the data lack, and whether it is ready."""
    today = F.lit("2024-01-01").cast("date")
    rows = cases(spark, sf_dir, [x[:5] for x in APPLICATIONS], "title string, description string, country_iso string, location string, days int").withColumns({"employment_type": F.lit(None).cast("string"), "posted_at": today, "employer": F.date_add(today, F.col("days"))})
    kind = extract.deadline_kind(F.col("employer"), F.col("description"), F.lit(None).cast("date"))
    due = extract.deadline_date(F.col("employer"), F.col("description"), F.lit(None).cast("date"))
    found = rows.withColumns({"problems": applicability.possible_problems(today, kind, due), "flags": applicability.quality_flags(today, kind), "fit": applicability.candidate_fit()})
    return found.select("id", F.array_join("problems.key", ",").alias("problems"), F.array_join("flags", ",").alias("flags"), applicability.readiness(F.col("problems")).alias("readiness"))
