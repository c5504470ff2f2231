"""Detectors with a firing row and a counter-case each, places, lookups, tracker and enrichment."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from postlode.functions import extract, places, sentences
from postlode.functions import requirements as req
from postlode.operators import enrichment, lookups, tracker

#: (detector of the columns T, D and E: title, description and employment type or code; a row; what it finds)
CASES = [
    (lambda T, D, E: req.is_student_role(T, D, E), ("Praktikum Senior VP", None, None), True),
    (lambda T, D, E: req.is_student_role(T, D, E), ("Graduate Trainee internship", None, "INTERN"), False),
    (lambda T, D, E: req.is_student_role(T, D, E), ("Senior Manager", "you lead an internship", None), False),
    (lambda T, D, E: req.is_student_role(T, D, E), ("Data", None, "working-student"), True),
    (lambda T, D, E: req.is_student_role(T, D, E), ("International Sales", None, None), False),
    (lambda T, D, E: req.is_thesis(T), ("Masterarbeit Robotik", None, None), True),
    (lambda T, D, E: req.is_thesis(T), ("Mitarbeiter Labor", None, None), False),
    (lambda T, D, E: req.is_only_working_student(T), ("Werkstudent IT", None, None), True),
    (lambda T, D, E: req.is_only_working_student(T), ("Werkstudent oder Praktikum", None, None), False),
    (lambda T, D, E: req.requires_master(T, D), ("Intern", "You are a master student", None), True),
    (lambda T, D, E: req.requires_master(T, D), ("Intern", "Bachelor or Master degree; Scrum Master", None), False),
    (lambda T, D, E: req.requires_phd(T, D), ("PhD position", None, None), True),
    (lambda T, D, E: req.requires_phd(T, D), ("Phdx", "graduate", None), False),
    (lambda T, D, E: req.requires_citizenship(D), ("x", "Only EU citizens may apply.", None), True),
    (lambda T, D, E: req.requires_citizenship(D), ("x", "Non EU citizens are welcome.", None), False),
    (lambda T, D, E: req.requires_enrolment(D), ("x", "You are enrolled at a German university", None), True),
    (lambda T, D, E: req.requires_enrolment(D), ("x", "You are enrolled. We speak German", None), False),
    (lambda T, D, E: req.requires_experience(D), ("x", "3+ years of experience needed", None), True),
    (lambda T, D, E: req.requires_experience(D), ("x", "0-2 years experience. We have 20 years.", None), False),
    (lambda T, D, E: req.requires_experience(D), ("x", "2 years of experience are a plus", None), False),
    (lambda T, D, E: req.requires_native(D), ("x", "Native speaker of German", None), True),
    (lambda T, D, E: req.requires_native(D), ("x", "Native speaker or fluent", None), False),
    (lambda T, D, E: req.requires_permit(D), ("x", "A valid work permit is needed", None), True),
    (lambda T, D, E: req.requires_permit(D), ("x", "We help you if you need a valid work permit", None), False),
    (lambda T, D, E: req.targets_graduates(D), ("x", "For recent graduates of physics", None), True),
    (lambda T, D, E: req.targets_graduates(D), ("x", "recent graduates or enrolled students", None), False),
    (lambda T, D, E: req.longer_than(T), ("Internship 12 months", None, None), True),
    (lambda T, D, E: req.longer_than(T), ("Internship 3-12 months", None, None), False),
    (lambda T, D, E: req.job_type(T, D), ("Hiwi", None, None), "hiwi"),
    (lambda T, D, E: req.job_type(T, D), ("Intern", "unbefristet", None), None),
    (lambda T, D, E: req.work_authorization(D), ("x", "We cannot sponsor a visa", None), "no_sponsorship"),
    (lambda T, D, E: req.work_authorization(D), ("x", "We offer visa support", None), "support"),
    (lambda T, D, E: req.work_authorization(D), ("x", "visa", None), "unclear"),
    (lambda T, D, E: req.work_authorization(D), (None, None, None), "no_vocab"),
    (lambda T, D, E: req.work_auth_requirement(D), ("x", "You have the right to work in Germany", None), "right_to_work_required"),
    (lambda T, D, E: req.student_type(T, D, E)["type"], ("Praktikum", "Pflichtpraktikum", None), "mandatory_internship"),
    (lambda T, D, E: req.student_type(T, D, E)["type"], ("Werkstudent", "voluntary internship", None), "unclear"),
    (lambda T, D, E: req.student_type(T, D, E)["type"], ("Manager", None, None), None),
    (lambda T, D, E: places.infer_country(T, D, E), ("Bonn, NRW, Germany", None, "am"), "de"),
    (lambda T, D, E: places.infer_country(T, D, E), ("Munich (Germany)", None, None), "de"),
    (lambda T, D, E: places.infer_country(T, D, E), ("Spain - Madrid", None, None), "es"),
    (lambda T, D, E: places.infer_country(T, D, E), ("Walldorf, DE, 69190", None, None), "de"),
    (lambda T, D, E: places.infer_country(T, D, E), ("New Germany Street", None, None), None),
    (lambda T, D, E: places.infer_country(T, D, E), ("Paris", None, "FR"), "fr"),
    (lambda T, D, E: places.city(T, {"munich": "muenchen"}), ("80331 Munich, DE", None, None), "muenchen"),
    (lambda T, D, E: places.country_mismatch(T, E, {"vienna": "at"}, ("de",)), ("Vienna, x", None, "de"), True),
    (lambda T, D, E: places.country_mismatch(T, E, {"vienna": "at"}, ("de",)), ("Unknown", None, "de"), False),
    (lambda T, D, E: places.matches_country(E, F.lit(True), "remote"), (None, None, None), True),
    (lambda T, D, E: places.matches_country(E, F.lit(None), places.parse_country_spec("de,fr")), (None, None, "fr"), True),
    (lambda T, D, E: req.salary_category(T), ("Werkstudent", None, None), "working_student"),
]


def test_cases(spark):
    for column, row, expected in CASES:
        found = spark.createDataFrame([row], "t string, d string, e string").select(column(F.col("t"), F.col("d"), F.col("e"))).first()[0]
        assert found == expected, (row, expected, found)


def test_country_spec_refuses_unknown_codes():
    assert places.parse_country_spec("Europe") >= {"de", "fr"}
    with pytest.raises(ValueError):
        places.parse_country_spec("de,zz")


def test_lookups(spark):
    rows = spark.createDataFrame([(1, "ACME"), (2, "Béta"), (3, "Beta"), (4, None)], "id long, company string")
    aliases = spark.createDataFrame([("beta", "Beta SE"), ("beta", "Other"), ("", "Nobody")], "alias string, name string")
    named = {r.id: r.company for r in lookups.rename_by_alias(rows, "company", aliases.limit(1)).collect()}
    assert named == {1: "ACME", 2: "Beta SE", 3: "Beta SE", 4: None}
    assert [r[0] for r in rows.orderBy("id").select(lookups.contains_any(F.col("company"), ["CM", "x"])).collect()] == [1.0, 0.0, 0.0, 0.0]
    quality = spark.createDataFrame([("Acme", 4.2, None), ("Beta", 3.0, "award"), ("Gone", 5.0, None)], "company string, score double, award string")
    policy = spark.createDataFrame([("acme", "unclear"), ("Beta", "none")], "company string, state string")
    assert [tuple(r)[:2] for r in lookups.sweet_spot(rows, quality, policy).collect()] == [("ACME", 1)]
    salary = spark.createDataFrame([("a", None), ("a", 5.0), ("b", None)], "c string, salary double")
    found = lookups.estimate_salary(salary, F.col("c"), spark.createDataFrame([("a", "2000")], "category string, estimate string")).collect()
    assert sorted((r.c, r.salary, r.estimate) for r in found if r.salary is None) == [("a", None, "2000"), ("b", None, None)]
    declared = spark.createDataFrame([("A", "x"), ("B", "x"), ("C", None), ("D", "x"), ("E", "x")], "company string, tenant string")
    seen = spark.createDataFrame([("A", "x"), ("B", "y"), ("E", "x"), ("E", "z")], "company string, tenant string")
    assert {r.company: r.status for r in lookups.tenant_consistency(declared, seen).collect()} == {"A": "consistent", "B": "drift", "C": "dynamic", "D": "not_found", "E": "multi"}
    now = spark.createDataFrame([("p", "1", "A"), ("p", "2", "B"), ("p", "3", "C")], "provider string, id string, company string")
    old = spark.createDataFrame([("p", "1", "Z"), ("p", "9", "Y"), ("p", "2", "B")], "provider string, id string, company string")
    assert [(r.id, list(r.companies)) for r in lookups.id_collisions(now, old).collect()] == [("1", ["A", "Z"])]
    posts = spark.createDataFrame([(1, "agg.de", "b", "de", ["x", "y"]), (2, "www.acme.de", "b", "de", ["x", "y"]), (3, "agg.de", "c", "de", ["x"])], "id long, host string, bag string, country_iso string, words array<string>")
    assert list(map(tuple, lookups.official_twins(posts, ("agg.de",)).collect())) == [(1, 2)]


def test_tracker(spark):
    at = lambda d, h=0: dt.datetime(2024, 1, d, h)
    log = spark.createDataFrame([(1, "a", "applied", at(1)), (2, "b", "applied", at(1)), (3, "b", "rejected", at(3)), (4, "a", "note", at(1))], "message_id long, job_id string, event_type string, ts timestamp")
    fresh = spark.createDataFrame([(4, "a", "offer", at(9)), (5, "c", "applied", at(9)), (5, "c", "applied", at(9))], log.schema)
    both = tracker.append_events(log, fresh)
    assert both.count() == 5 and tracker.append_events(both, fresh).count() == 5
    assert {r.job_id: r.status for r in tracker.status(both).collect()} == {"a": "applied", "b": "rejected", "c": "applied"}
    today = F.lit("2024-01-12").cast("date")
    assert [r.job_id for r in tracker.followups(both, today).collect()] == ["a"]
    week = tracker.weekly(both, F.lit("2024-01-05").cast("date")).first()
    assert (week.events, week.applied, week.answered, week.response_rate) == (4, 2, 1, 0.5)
    guard = tracker.guards(spark.createDataFrame([("A", dt.date(2024, 1, 1)), ("A", dt.date(2023, 1, 1)), ("B", dt.date(2023, 1, 1))], "company string, rejected date"), today)
    assert {r.company: r.active for r in guard.collect()} == {"A": True, "B": False}
    due = spark.createDataFrame([(1, dt.date(2024, 1, 15)), (2, dt.date(2024, 1, 11)), (3, dt.date(2024, 3, 1))], "id long, deadline date")
    assert [r.id for r in tracker.reminders(due, today).collect()] == [1]
    told = spark.createDataFrame([("Unfortunately not", None), ("x", "Applied"), ("hello", " ")], "t string, e string")
    assert [r[0] for r in told.select(tracker.event_type(F.col("t"), F.col("e"))).collect()] == ["rejected", "applied", "note"]


def test_markdown_tables(spark):
    text = ["# Log", "| Company | Date |", "|---|:--|", "| A | 2024 |", "| B | x |", "", "| Else | y |", "text | no"]
    lines = spark.createDataFrame([("f", i, t) for i, t in enumerate(text)], "file string, line int, text string")
    assert [(r.line, list(r.cells)) for r in tracker.markdown_tables(lines, "Company").orderBy("line").collect()] == [(3, ["A", "2024"]), (4, ["B", "x"])]


def test_enrichment(spark):
    rows = spark.createDataFrame([(i, float(i)) for i in range(5)], "id long, score double")
    records = spark.createDataFrame([(4, True), (3, False)], "id long, ok boolean")
    assert {r.id: r.state for r in enrichment.plan(rows, records, 3).collect()} == {4: "seen", 3: "retry", 2: "new"}
    seen = spark.createDataFrame([("u", "h", "u", "h", None), ("v", "h", "u", "h", None), ("u", "g", "u", "h", "g"), ("u", "g", "u", "h", None)], "a string, b string, c string, d string, e string")
    assert [r[0] for r in seen.select(enrichment.classify_seen(*[F.col(c) for c in "abcde"])).collect()] == ["unchanged", "url_changed", "pending", "changed"]
    posts = spark.createDataFrame([(1, "short", None), (2, "x" * 700, 5.0)], "id long, description string, salary double")
    found = spark.createDataFrame([(1, "a longer text", 9.0), (2, "y" * 900, 1.0)], "id long, found_description string, found_salary double")
    assert {r.id: (r.description[:2], r.salary, r.description_source) for r in enrichment.fill(posts, found).collect()} == {1: ("a ", 9.0, "hydration"), 2: ("xx", 5.0, None)}
    verdicts = spark.createDataFrame([(1, "alive", dt.datetime(2024, 1, 1)), (1, "hard_dead", dt.datetime(2024, 1, 2))], "id long, state string, checked_at timestamp")
    now = F.lit("2024-01-02 10:00:00").cast("timestamp")
    assert {r.id: (r.liveness, r.recheck) for r in enrichment.merge_liveness(posts, verdicts, now).collect()} == {1: ("hard_dead", False), 2: (None, True)}
    assert [r.id for r in enrichment.remove_dead(posts, verdicts).collect()] == [2]
    picked = enrichment.sample(spark.range(100), [("even", F.col("id") % 2 == 0, 3), ("any", F.lit(True), 4)]).collect()
    assert sorted(r.bucket for r in picked) == ["any"] * 4 + ["even"] * 3 and all(r.id % 2 for r in picked if r.bucket == "any")
    ranked = spark.createDataFrame([(1, 1, "good", "why", 2.0, {"a": 2.0}), (2, 1, "odd", " ", 2.0, {"a": 1.0})], "id long, rank int, label string, justification string, score double, score_breakdown map<string,double>")
    assert sorted(map(tuple, enrichment.violations(ranked, ["good"]).collect())) == [(1, "rank_repeats"), (2, "breakdown"), (2, "justification"), (2, "label"), (2, "rank_repeats")]


def plain_evidence(text, pattern, unless):
    """By Python's own expressions: the sentence around each match, and what stands ahead of it."""
    import re

    ends = [m.end() for m in re.finditer(r"[.!?;](?=\s)", text or "") if not re.search(r"(?:^|[\s(])(?:ggf|e\.g)\.$", text[: m.end()])]
    for a, b in zip([0, *ends], [*ends, len(text or "")], strict=True):
        for m in re.finditer(pattern, (text or "")[a:b]):
            if not re.search(unless, text[a : a + m.start()]):
                return a + m.start(), m[0]
    return None


def test_evidence_is_where_a_loop_finds_it(spark):
    rnd = random.Random(3)
    words = ["permit", "permits", "if", "so", "ggf.", "end.", "what?", "e.g.", "ä😀;", "x.y", "\n", "a"]
    texts = [None, "", ".", "permit", "if permit. permit"] + [" ".join(rnd.choices(words, k=rnd.randrange(1, 40))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = df.select("i", sentences.evidence(sentences.sentences(F.col("t")), "permits?", "if").alias("e"), F.array_join(sentences.sentences(F.col("t")), "").alias("whole")).collect()
    assert {r.i: r.e and tuple(r.e) for r in found} == {i: plain_evidence(t, "permits?", "if") for i, t in enumerate(texts)}
    assert {r.i: r.whole for r in found} == {i: t or "" for i, t in enumerate(texts)}


@pytest.mark.parametrize(
    ("text", "state", "term"),
    [
        ("We cannot offer visa sponsorship.", "no_sponsorship", "cannot offer visa"),
        ("Good pay. We help with your visa; a valid work permit is fine.", "support", "help with your visa"),
        ("Send your papers, ggf. eine gültige Arbeitserlaubnis.", "unclear", "Arbeitserlaubnis"),
        ("Send papers ggf. by mail. A valid work permit is needed.", "existing_required", "valid work permit"),
        ("If applicable, a valid work permit.", "unclear", "work permit"),
        ("Nothing of the kind.", None, None),
        (None, None, None),
    ],
)
def test_work_authorization_rests_on_words(spark, text, state, term):
    found = spark.createDataFrame([(text,)], "t string").select(sentences.work_authorization_evidence(F.col("t")).alias("e")).first().e
    assert (found and found.state, found and found.term) == (state, term)
    assert found is None or text[found.at : found.at + len(term)] == term


def test_agreement_gates_and_rechecks(spark):
    rows = [("A 3-party agreement must be signed by your university.", "live", "2024-01-01 12:00:00"), ("External agreements cannot be accepted.", "live", "2023-12-31 11:00:00"), ("An agreement. It is signed by the school.", "Unknown ", "2024-01-01 12:00:00"), (None, "live", None)]
    df = spark.createDataFrame(rows, "t string, s string, at string")
    found = df.select(sentences.agreement_gate(F.col("t"))["state"].alias("gate"), sentences.needs_recheck(F.col("s"), F.col("at").cast("timestamp"), F.lit("2024-01-01 12:00:00").cast("timestamp")).alias("again")).collect()
    assert [tuple(r) for r in found] == [("university_signs", False), ("employer_agreement_only", True), (None, True), (None, True)]


def test_texts_without_the_words_of_a_pattern_are_not_cut(spark, monkeypatch):
    """The plain search ahead of the patterns changes no verdict, whatever the case of letters, and spares the cutting."""
    bits = ["EU C\u0131t\u0130zens", "non", "3 year\u017f exper\u0131ence", "5 Jahre Erfahrung", "plus", "NATIVE SPEA\u212aER", "gültige Arbeitserlaubnis", "valid work permit", "if", "no v\u0130sa", "we offer relocation", "sponsor", "Wer\u212aſtudent", "intern", "MASTER'S degree", "Ph. D", "the\u017fis", "unbefristete", "Apply by 01.02.2024", "bis zum 2024-13-01", "hiwi", ". ", "! ", "\n", "senior"]
    rnd = random.Random(4)
    rows = [(i, rnd.choice([None, "", rnd.choice(bits)]), rnd.choice([None, " ".join(rnd.choices(bits, k=rnd.randint(0, 7)))])) for i in range(600)]
    table = spark.createDataFrame([*rows, *[(900 + i, None, b) for i, b in enumerate(bits)]], "id long, t string, d string")

    def flags():
        t, d = F.col("t"), F.col("d")
        return table.select("id", req.is_student_role(t, d, F.lit(None).cast("string")), req.requires_master(t, d), req.requires_phd(t, d), req.requires_citizenship(d), req.requires_experience(d), req.requires_native(d), req.requires_permit(d), req.work_authorization(d), req.job_type(t, d), extract.deadline(d))

    spared = sorted(map(tuple, flags().collect()), key=lambda r: r[0])
    assert flags()._jdf.queryExecution().optimizedPlan().toString().lower().count("contains(") > 20
    for module in (req, extract):
        monkeypatch.setattr(module, "marked", lambda c, *marks: F.lit(True))
    assert spared == sorted(map(tuple, flags().collect()), key=lambda r: r[0])
    assert all(len({r[k] for r in spared}) > 1 for k in range(1, 11))
