"""Records between runs, registries, keys and evidence on small rows."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from postlode.catalogue import cases
from postlode.functions import applicability, keys, money, places, seasons, spans
from postlode.operators import benchmarks, evidence, filters, health, keyed, registry, running, stores, tracker
from postlode.sources import boards, readers
from postlode.streaming import ledger


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("x")).first().x


@pytest.mark.parametrize(("text", "pattern"), [("a-b--c", "-+"), ("", "x"), (None, "x"), ("xx", "x"), ("none", "x"), ("x at both ends x", "x"), ("äöx ßx", "x")])
def test_spans_are_where_the_matches_are(spark, text, pattern):
    import re

    found = one(spark, text, spans.spans(F.col("t"), pattern))
    assert [(s.at, s.term) for s in found] == [(m.start(), m[0]) for m in re.finditer(pattern, text or "")]


def test_text_around_a_span(spark):
    s = spans.spans(F.col("t"), "mid")[0]
    row = spark.createDataFrame([("0123mid789",)], "t string").select(spans.before(F.col("t"), s, 2), spans.after(F.col("t"), s, 2), spans.around(F.col("t"), s, 9, 1)).first()
    assert tuple(row) == ("23", "78", "0123mid7")


def test_every_reason_has_a_case():
    assert {x[4] for x in cases.POSTINGS} - {None} == set(applicability.REASONS) and len(applicability.REASONS) == 20
    assert set(applicability.HARD) < set(applicability.REASONS)


def test_ladder_of_null_and_empty_rows(spark):
    rows = spark.createDataFrame([(1, None, None, None, None), (2, "", "", "", dt.date(2023, 12, 1))], "id int, title string, description string, employment_type string, posted_at date")
    assert [r.reason for r in filters.with_reason(rows, applicability.ladder(F.lit("2024-01-01").cast("date"))).collect()] == [None, None]


def test_policy_blocks(spark):
    rows = spark.createDataFrame([("Intern", "", None, None, p) for p in ("candidate_must_have_authorization", "unclear", None)], "title string, description string, employment_type string, posted_at date, policy string")
    assert [r.reason for r in filters.with_reason(rows, applicability.ladder(F.current_date(), F.col("policy"))).collect()] == ["visa_blocked", None, None]


def test_candidate_fit(spark):
    rows = spark.createDataFrame([("Werkstudent Einkauf", "English team, fluent German required. We offer visa support.", "PART_TIME", "de", "Berlin"), ("Buyer", None, None, None, None)], "title string, description string, employment_type string, country_iso string, location string")
    first, second = ({s.key: (s.kind, s.detail) for s in r.fit} for r in rows.select(applicability.candidate_fit().alias("fit")).collect())
    assert first == {"germany": ("ok", None), "student_type": ("ok", "PART_TIME"), "english": ("ok", None), "location_known": ("ok", None), "description_known": ("ok", None), "german": ("warn", "required"), "work_auth": ("ok", "support"), "student_subtype": ("info", "working_student")}
    assert second == {"germany": ("info", None), "student_type": ("info", None), "english": ("info", None), "location_known": ("warn", None), "description_known": ("info", None), "work_auth": ("info", "no_vocab")}


def test_hits_are_in_order_of_what_they_say(spark):
    text = "immediately, ab 1.3.2027, April - June 2027, SoSe 2027"
    assert [h.kind for h in one(spark, text, seasons.season_hits(F.col("t")))] == ["semester", "range", "start", "immediate"]
    assert one(spark, None, seasons.season_hits(F.col("t"))) == []


@pytest.mark.parametrize(("text", "expected"), [("cafÃ©", "café"), ("café", "café"), ("QualitÃ¤t fÃ¼r", "Qualität für"), ("Ã la carte", "Ã la carte"), ("plain", "plain"), ("", ""), (None, None), ("Ã© and 語", "Ã© and 語")])
def test_mojibake(spark, text, expected):
    assert one(spark, text, keys.repaired(F.col("t"))) == expected


def test_references(spark):
    import base64

    assert one(spark, " ab-12.3 ", keys.reference(F.col("t"))) == "AB123"
    assert one(spark, base64.b64encode(b"10000-12/7").decode(), keys.decoded_reference(F.col("t"))) == "1000012"
    assert one(spark, "!!", keys.decoded_reference(F.col("t"))) is None and one(spark, None, keys.reference(F.col("t"))) is None
    assert one(spark, "it’s", keys.apostrophes(F.col("t"))) == "it's"


def test_employers_places_and_guards(spark):
    row = spark.createDataFrame([("Robert Bosch GmbH", "bosch", "Acme", "Remote", "feed")], "a string, b string, c string, place string, source string").select(
        keys.same_employer(F.col("a"), F.col("b")), keys.same_employer(F.col("a"), F.col("c")), keys.same_employer(F.lit("GmbH"), F.col("b")), keys.guarded_location(F.col("place"), F.col("source"), {"feed": "remote"}), keys.guarded_location(F.col("place"), F.col("a"), {"feed": "remote"})
    )
    assert tuple(row.first()) == (True, False, False, None, "Remote")
    assert one(spark, "Munich, BY", keys.city_alias_key(F.col("t"), {"munich": "munchen"})) == "munchen"


def test_world_of_countries(spark):
    names = places.iso_countries(spark)
    assert len(set(names.values())) >= 240 and names["norwegen"] == "no" and names["japan"] == "jp" and names["osterreich"] == "at"


def test_lines_keep_what_is_no_record(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"kind":"a","n":1}\nnot json\n{"kind":"b","n":2}\n')
    lines = stores.read_lines(spark, str(tmp_path), "kind string, n long").cache()
    assert tuple(stores.line_counts(lines).first()) == (2, 1)
    assert [r["_bad"] for r in lines.where("_bad IS NOT NULL").collect()] == ["not json"]
    lines.unpersist()


def test_outputs_are_whole(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a "quoted", one', ["x"])], "id long, title string, tags array<string>")
    for _ in range(2):
        stores.save_outputs(rows, str(tmp_path), ["id", "title"])
    assert spark.read.json(str(tmp_path / "json")).count() == 1
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv")).first().title == 'a "quoted", one'


def test_latest_and_times(spark):
    rows = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), (None, 1, "none")], "k string, at int, v string")
    assert sorted((str(r.k), r.v) for r in stores.latest(rows, ["k"], ["at"]).collect()) == [("None", "none"), ("k", "new")]
    assert one(spark, "2024-03-01T10:00:00Z", stores.to_iso(stores.from_iso(F.col("t")))) == "2024-03-01T10:00:00Z"


def test_ledger_takes_each_key_once(spark, tmp_path):
    path = str(tmp_path / "ledger")
    write = ledger.append_new(path, ["k"], ["at"], buckets=4)
    first = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 1, "x"), (None, 1, "y")], "k string, at int, v string")
    for _ in range(2):
        write(first, 0)
    write(spark.createDataFrame([("b", 0, "again"), ("c", 1, "z")], "k string, at int, v string"), 1)
    found = {(r.k, r.v) for r in spark.read.parquet(path).where("k IS NOT NULL").collect()}
    assert found == {("a", "early"), ("b", "x"), ("c", "z")}


def test_running_sums_of_a_hot_value(spark):
    rows = [(v, i) for i, v in enumerate([5] * 400 + list(range(300)))]
    found = running.running_sums(spark.createDataFrame(rows, "v int, i int").repartition(7), F.col("v"), {"n": F.lit(1), "total": F.col("v")}).collect()
    seen = sorted((r.n, r.v, r.total) for r in found)
    values = sorted(v for v, _ in rows)
    assert [x[:2] for x in seen] == list(enumerate(values)) and [x[2] for x in seen] == [sum(values[:i]) for i in range(len(values))]


def test_inversions_against_pairs(spark):
    rows = [(i, float(i * 7 % 10), i * 3 % 4) for i in range(60)]
    found = {r.id: r.outranked for r in benchmarks.inversions(spark.createDataFrame(rows, "id int, score double, label int")).collect()}
    assert found == {i: sum(lo < label and s > score for _, s, lo in rows) for i, score, label in rows}


def test_series_without_good_or_with_one_run(spark):
    runs = [("a", 1, "error", 0), ("b", 1, "ok", 5), ("c", 1, "ok", 1), ("c", 2, "ok", 9), ("c", 3, "error", 0), ("c", 4, "timeout", 0)]
    frame = spark.createDataFrame([(s, dt.datetime(2024, 1, d), st, n) for s, d, st, n in runs], "series string, at timestamp, status string, collected long")
    found = {r.series: (r.runs, r.ok_runs, r.last_status, r.last_ok_collected, r.prior_median, r.prior_ok, r.failures) for r in health.last_runs(frame, "series", ["at"]).collect()}
    assert found == {"a": (1, 0, "error", None, None, 0, 1), "b": (1, 1, "ok", 5, None, 0, 0), "c": (4, 2, "timeout", 9, 1, 2, 2)}


def test_summary_of_series(spark):
    rows = [("a", 2, "error", None), ("a", 1, "ok", 4), ("a", 0, "ok", 7), ("b", 1, None, 3), (None, 1, "ok", None)]
    found = health.summary(spark.createDataFrame(rows, "series string, at int, status string, collected long"), "series", ["at"])
    assert {tuple(r) for r in found.collect()} == {("a", 3, 2, "error", 5.5), ("b", 1, 0, None, None), (None, 1, 1, "ok", None)}
    assert health.summary(found.select("series", F.lit(1).alias("at"), F.lit("ok").alias("status"), F.lit(1).alias("collected")).limit(0), "series", ["at"]).count() == 0


def test_pages_and_titles(spark):
    row = spark.createDataFrame([("Buyer Steel", "We look for a buyer of steel parts")], "t string, p string").select(registry.title_match(F.col("t"), F.col("p")).alias("m")).first()
    assert row.m == 1.0
    assert one(spark, "This position has been filled", registry.page_kind(F.lit(200), F.lit(1.0), F.col("t"))) == "soft_dead"
    assert one(spark, "x", registry.page_kind(F.lit(404), F.lit(1.0), F.col("t"))) == "dead"
    assert one(spark, "x", registry.page_kind(F.lit(200), F.lit(0.7), F.col("t"))) == "live"


def test_evidence_of_odd_pages(spark):
    post = {"@type": "JobPosting", "title": " ", "identifier": "7", "baseSalary": {"value": 3000, "currency": " eur "}, "jobLocation": {"@type": "TELECOMMUTE", "address": {"addressLocality": "Bonn"}}, "validThrough": "2024-02-30"}
    html = f'<script type="application/ld+json">{json.dumps([post])}</script><script type="application/ld+json">broken</script>'
    found = one(spark, html, evidence.fields(F.get(readers.job_ld(F.col("t")), F.lit(0))))
    assert (found.title, found.identifier, found.valid_through, found.salary.min, found.salary.currency, found.location.city, found.location.telecommute) == (None, "7", None, 3000.0, "EUR", "Bonn", True)
    assert one(spark, "no script", evidence.fields(F.get(readers.job_ld(F.col("t")), F.lit(0)))).title is None


def test_damaged_structured_data(spark):
    page = lambda text: f'<script type="application/ld+json">{text}</script>'
    long = "We look for somebody who counts parts. " * 4
    said = lambda text, least=20: one(spark, page(text), readers.job_description(F.col("t"), least))
    assert said('{"@type": "JobPosting", "description": "first line\nand\ta second one"}') == "first line and a second one"
    assert said('{"@type": "JobPosting", "description": "a path C:\\dir and \\u0041 quote \\"x\\""}') == 'a path C:dir and A quote "x"'
    assert said('{"@graph": [[{"@type": "Thing"}], {"@type": ["Thing", "JobPosting"], "description": "in a graph of things"}]}') == "in a graph of things"
    assert said('[{"@graph": [{"@type": "JobPosting", "description": "in a graph of an array"}]}]') == "in a graph of an array"
    assert said('{"@type": "JobPosting", "description": 5}') is None and said('{"@type": "JobPosting", "description": ') is None and said('{"@type": "Organization", "description": "some text about a firm"}') is None
    two = page('{"@type": "JobPosting", "description": "short"}') + page(json.dumps({"@type": "JobPosting", "description": f"<p>{long}</p>"}))
    assert one(spark, two, readers.job_description(F.col("t"))) == long.strip() and one(spark, None, readers.job_description(F.col("t"))) is None


def test_words_for_pay_and_starts(spark):
    pay = lambda t: one(spark, t, money.salary(F.col("t")))
    assert pay("Your salary is 2000 per month").min == 2000.0 and pay("Bruttojahresgehalt: 42.000,50 €").declared == "year"
    assert pay("Stundenlohn von 14,50 €").declared == "hour" and pay("An hourly rate of 15 €").min == 15.0
    assert pay("Bewerbung bis 31.12.2024, Gehalt nach Tarif") is None and pay("Vergütung 1.2345 €") is None and pay("Haltung 12 €") is None
    context = lambda t: one(spark, t, seasons.season(seasons.season_hits(F.col("t"))))["context"]
    assert not context("Unsere Marke startet sofort durch") and context("Die Stelle ist ab sofort frei") and context("sofort, für sechs Monate")


def test_reader_scores(spark):
    found = spark.createDataFrame([("4,5",), ("6",), ("x",), (None,)], "t string").select(tracker.stated_score(F.col("t")).alias("s")).select("s", tracker.score_verdict(F.col("s")).alias("v")).collect()
    assert [tuple(r) for r in found] == [(4.5, "good"), (None, None), (None, None), (None, None)]


def test_slices_by_lines(spark, tmp_path):
    head = "title,company,url,ats_id,location,country_iso,description,employment_type,posted_at\n"
    (tmp_path / "a.csv").write_text(head + "T,C,https://a/1,1,,,one line,,\n")
    (tmp_path / "b.csv").write_text(head + 'T,C,https://b/1,1,,,"two\nlines",,\n')
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    expected = spark.createDataFrame([("a", "a.csv", "", 1), ("b", "b.csv", "", 1)], "ats string, csv string, sha256 string, rows long")
    plain, whole = readers.one_line_slices(spark, paths, expected)
    assert (plain, whole) == (paths[:1], paths[1:])
    assert readers.bulk(spark, plain, lines=True).unionByName(readers.bulk(spark, whole)).count() == 2
    assert readers.slice_errors(spark, paths, expected, most_bytes=10).count() == 0


def test_boards_read_landed_pages(spark, tmp_path):
    pages = {
        "arbeitnow": {"data": [{"slug": "s1", "title": "Praktikum A", "company_name": "Co"}, {"slug": None, "title": "Praktikum B", "company_name": "Co"}, {"slug": "s3", "title": "Senior C", "company_name": "Co"}]},
        "remoteok": [{"legal": "note"}, {"slug": "x", "position": "Intern D", "company": "Co", "location": "Berlin, Germany"}],
    }
    for source, page in pages.items():
        (tmp_path / f"{source}.json").write_text(json.dumps(page))
    found = boards.read_board(spark, str(tmp_path / "arbeitnow.json"), "arbeitnow").collect()
    assert sorted((r.title, r.url, r.country_iso) for r in found) == [("Praktikum A", "https://www.arbeitnow.com/jobs/s1", "de"), ("Senior C", "https://www.arbeitnow.com/jobs/s3", "de")]
    assert tuple(boards.counted(spark, str(tmp_path / "arbeitnow.json"), "arbeitnow").first()) == (3, 2, 1)
    assert [(r.title, r.remote, r.country_iso) for r in boards.read_board(spark, str(tmp_path / "remoteok.json"), "remoteok").collect()] == [("Intern D", True, "de")]


def test_feeds_by_flavour(spark, tmp_path):
    item = "<item><title>Praktikum X (Aachen, DE, 52074)</title><link>https://a/1</link><description>Germany</description><pubDate>Fri, 01 Mar 2024 10:00:00 +0000</pubDate></item>"
    (tmp_path / "f.xml").write_text(f"<rss><channel>{item}<item><title>No link</title></item></channel></rss>")
    read = lambda flavour: [(r.title, r.location, r.description, r.external_id) for r in boards.read_feed(spark, str(tmp_path / "f.xml"), "feed", "Acme", flavour).collect()]
    assert read("plain") == [("Praktikum X (Aachen, DE, 52074)", None, "Germany", "https://a/1")]
    assert read("titled") == [("Praktikum X", "Aachen, DE, 52074", "Germany", "https://a/1")]
    assert read("country") == [("Praktikum X (Aachen, DE, 52074)", "Germany", None, "https://a/1")]


def test_listings_of_cards(spark):
    card = '<li><h2><a href="/jobs/7">Intern <b>Data</b></a></h2><p>Institute, for Steel, Bonn</p><time>01.03.2024</time></li>'
    pages = spark.createDataFrame([(f"<ul>{card}{card}<li>nothing</li></ul><a href='?page=3'>3</a><a href='?page=2'>2</a><a href='?page=3'>n</a>",), (None,)], "html string")
    fields = {"title": "<h2>(.*?)</h2>", "url": 'href="([^"]+)"', "company": "<p>(.*?)</p>", "posted_at": "<time>(.*?)</time>"}
    found = boards.listing(pages, "<li>.*?</li>", fields, "board", base="https://b.example", last_comma=True).collect()
    assert [(r.title, r.url, r.company, r.location, str(r.posted_at.date())) for r in found] == [("Intern Data", "https://b.example/jobs/7", "Institute, for Steel", "Bonn", "2024-03-01")]
    assert [r.p for r in pages.select(boards.page_numbers(F.col("html")).alias("p")).collect()] == [[2, 3], []]


def test_odd_dates_types_and_slugs(spark):
    today = F.lit("2024-03-05").cast("date")
    days = spark.createDataFrame([("March 1",), ("October 24",), ("soon",), (None,)], "t string").select(boards.day_without_year(F.col("t"), today).alias("d")).collect()
    assert [r.d for r in days] == [dt.date(2024, 3, 1), dt.date(2023, 10, 24), None, None]
    assert one(spark, " DEU ", boards.alpha_2(F.col("t"))) == "de" and one(spark, "xyz", boards.alpha_2(F.col("t"))) is None
    assert one(spark, "Lever", boards.known_type(F.col("t"), ("lever",))) == "lever" and one(spark, "odd", boards.known_type(F.col("t"), ("lever",))) is None
    urls = spark.createDataFrame([("https://a/jobs/praktikum-in-bonn/",)], "loc string")
    assert [(r.title, r.external_id) for r in boards.sitemap_postings(urls, "map", "Board").collect()] == [("praktikum in bonn", "praktikum-in-bonn")]
    assert [one(spark, t, boards.intern_candidate(F.col("t"))) for t in ("Praktikum IT", "Duales Studium Praktikum", "Buyer", None)] == [True, False, False, False]


def test_keyed_store_takes_batches_in_any_order(spark, tmp_path):
    """Buckets split, batches come twice, a generation that is not whole does not count; a key with a third of the rows."""
    rnd = random.Random(4)
    schema = "k string, ok boolean, at int, v string"
    rows = [(rnd.choice([None, *map(str, range(90)), *["hot"] * 45]), rnd.random() < 0.5, rnd.randrange(50), rnd.choice(["x", "y", None])) for _ in range(900)]
    store = keyed.KeyedStore(str(tmp_path / "store"), schema, ("k",), ("ok", "at"), rows_a_bucket=20, files_a_bucket=6)
    assert store.read(spark).count() == 0
    for i in (0, 1, 1, 2, 0):
        store.upsert(spark.createDataFrame([(*r, 1) for r in rows[i * 300 : (i + 1) * 300]], schema + ", more int").repartition(3))
    (tmp_path / "store" / "generation-9-9" / "_bucket=0").mkdir(parents=True)
    best = {}
    for k, ok, at, v in rows:
        best[k] = max(best.get(k, ()), (ok, at, v or ""))
    assert {r.k: (r.ok, r.at, r.v or "") for r in store.read(spark).collect()} == best
    assert store.buckets(spark) > 1


def test_keyed_store_writes_met_buckets_alone(spark, tmp_path):
    store = keyed.KeyedStore(str(tmp_path / "store"), "k long, at long", ("k",), ("at",), rows_a_bucket=10)
    store.upsert(spark.range(200).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("at")))
    files = lambda: {p for p in (tmp_path / "store").rglob("*.parquet")}
    before, one = files(), spark.createDataFrame([(7, 2)], "k long, at long")
    store.upsert(one)
    added = files() - before
    assert len(added) == 1 and before <= files()
    store.upsert(one)
    assert not files() - before - added and sorted(map(tuple, store.read(spark).where("k IN (7, 8)").collect())) == [(7, 2), (8, 1)]
