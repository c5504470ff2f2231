"""Operators on small rows written for them, with a counter-case beside each case."""

from __future__ import annotations

import datetime as dt
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from postlode.functions import extract, money, seasons, text
from postlode.operators import dedup, filters, health, residents, scoring, similarity, snapshots
from postlode.operators.components import components
from postlode.rules import Area, Reason, first_reason
from postlode.sources import readers
from postlode.streaming import ledger


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(("url", "canonical"), [("HTTPS://A.de/x/?utm_source=1&id=5#top", "https://a.de/x/?id=5"), ("https://a.de/x/?ref=1", "https://a.de/x"), ("https://a.de/?pid=1&gclid=2&b=3", "https://a.de/?pid=1&b=3"), ("https://a.de//", "https://a.de"), (None, "")])
def test_canonical_url(spark, url, canonical):
    assert one(spark, url, text.canonical_url) == canonical


@pytest.mark.parametrize(("title", "bag"), [("Praktikum im Bereich Straße (m/w/d)", "strasse student working"), ("Internship for the Strasse", "strasse student working"), ("Pflichtpraktikum", "pflichtpraktikum"), (None, "")])
def test_title_bag(spark, title, bag):
    assert one(spark, title, text.title_bag) == bag


@pytest.mark.parametrize(("raw", "amount"), [("1.234,50 €", 1234.5), ("1,234.5", 1234.5), ("1.500", 1500.0), ("12,5", 12.5), ("x", None)])
def test_amount(spark, raw, amount):
    assert one(spark, raw, text.parse_amount) == amount


@pytest.mark.parametrize(("raw", "day"), [("2024-03-01T10:00:00Z", "2024-03-01"), ("Fri, 01 Mar 2024 10:00:00 +0000", "2024-03-01"), ("01.03.2024", "2024-03-01"), ("soon", None)])
def test_parse_time(spark, raw, day):
    found = one(spark, raw, text.parse_time)
    assert (found and str(found.date())) == day


def test_area_zeroing(spark):
    area = Area({"a": (["data", "operations"], 3.0, 1.0), "b": (["digital"], 2.0, 0.5)}, {"nurse": ["operations"]})
    rows = spark.createDataFrame([("operations nurse", None), ("operations", None), ("operations nurse data", "digital"), ("none", "nothing")], "t string, d string")
    assert [r[0] for r in rows.select(area.score(F.col("t"), F.col("d"))).collect()] == [0.0, 3.0, 3.5, 0.0]


def test_first_reason_follows_order_and_null_is_no_evidence(spark):
    reasons = [Reason("old", F.col("a") > 5), Reason("far", F.col("b") > 5)]
    rows = spark.createDataFrame([(9, 9), (None, 9), (1, 1), (None, None)], "a int, b int")
    assert [r[0] for r in rows.select(first_reason(reasons)).collect()] == ["old", "far", None, None]


def test_funnel_and_assessability(spark):
    rows = spark.createDataFrame([(1, "x" * 700), (2, " "), (3, "Log in to view"), (None, "short")], "n int, d string")
    assert filters.funnel(rows, [("a", F.col("n") > 1), ("b", F.col("n") > 2)]).first().asDict() == {"collected": 4, "a": 2, "b": 1}
    assert [r[0] for r in rows.select(filters.assessability(F.col("d"))).collect()] == [None, "empty", "login_wall", "short"]


def test_breakdown_sums_to_score_and_decay_is_neutral_without_date(spark):
    rows = spark.createDataFrame([(1, dt.datetime(2023, 1, 1)), (2, None), (3, dt.datetime(2030, 1, 1))], "id long, posted timestamp")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    found = scoring.with_score(rows, {"a": F.lit(2.0), "b": F.lit(1.25)}, scoring.freshness(F.col("posted"), now)).collect()
    assert [r.score for r in found] == [1.63, 3.25, 3.25]
    assert all(abs(sum(r.score_breakdown.values()) - r.score) < 1e-9 for r in found)


def job(i, keys, description=True, kind=True, source="s", posted="0"):
    return {"_ord": i, "keys": [("t", k) for k in keys], "has_description": description, "has_type": kind, "source": source, "posted_key": posted}


def test_fold_is_not_components():
    assert dedup.fold([job(0, "x"), job(1, "xy"), job(2, "y")]) == [(1, 0, "t")]


def test_fold_preference_is_not_an_order():
    x, y = dict(description=True, kind=False), dict(description=False, kind=True)
    assert dedup.fold([job(0, "k", **x), job(1, "k", **y)]) == [(0, 1, "t")]
    assert dedup.fold([job(0, "k", **y), job(1, "k", **x)]) == [(0, 1, "t")]


def test_fold_by_component_equals_fold_of_all():
    rnd = random.Random(5)
    for _ in range(300):
        rows = [job(i, sorted({rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 3))}), rnd.random() < 0.5, rnd.random() < 0.5, posted=str(rnd.randint(0, 3))) for i in range(rnd.randint(2, 12))]
        group = {r["_ord"]: r["_ord"] for r in rows}
        for _, (a, b) in itertools.product(range(12), itertools.combinations(rows, 2)):
            if set(a["keys"]) & set(b["keys"]):
                group[a["_ord"]] = group[b["_ord"]] = min(group[a["_ord"]], group[b["_ord"]])
        parts = [dedup.fold([r for r in rows if group[r["_ord"]] == g]) for g in set(group.values())]
        assert sorted(x for p in parts for x in p) == sorted(dedup.fold(rows))


POSTING = "_ord long, id string, external_id string, source string, company string, title string, location string, url string, description string, employment_type string, posted_at date, country_iso string, requisition string"


def posting(i, **more):
    row = dict(id=f"i{i}", external_id=None, source="s", company="Acme", title=f"T{i}", location="Berlin", url=f"https://a/{i}", description="d", employment_type="INTERN", posted_at=dt.date(2024, 1, 1), country_iso=None, requisition=None) | more
    return (i, *(row[f.split()[0]] for f in POSTING.split(", ")[1:]))


def test_cascade_and_survivors(spark):
    rows = spark.createDataFrame([posting(0, external_id="e"), posting(1, external_id="e"), posting(2, url="https://a/9?utm_x=1"), posting(3, url="https://a/9", posted_at=dt.date(2023, 1, 1)), posting(4, company="Other", external_id="e"), posting(5)], POSTING)
    removed = dedup.cascade(rows)
    assert sorted(map(tuple, removed.collect())) == [(1, 0, "external_id"), (2, 3, "url")]
    left = dedup.survivors(rows, removed)
    assert [r._ord for r in left.orderBy("_ord").collect()] == [0, 3, 4, 5]
    assert dedup.cascade(left).count() == 0


def test_mirrors(spark):
    rows = spark.createDataFrame([posting(0, title="Praktikum Daten", requisition="q"), posting(1, title="Internship and Data", requisition="q", description=None), posting(2, title="Praktikum Daten", requisition="q", company="B"), posting(3, title="Praktikum Daten", requisition=None)], POSTING)
    assert list(map(tuple, dedup.mirrors(rows).collect())) == [(1, 0)]


def test_cross_source_and_wildcard(spark):
    rows = spark.createDataFrame([posting(0, title="Data", source="a"), posting(1, title="Data", source="bulk:x", company="Acme GmbH"), posting(2, title="Data", source="c", company="Else"), posting(3, title="Data", source="c", country_iso="fr")], POSTING)
    assert sorted(map(tuple, dedup.cross_source(rows).collect())) == [(0, 1), (3, 1)]
    four = spark.createDataFrame([posting(0, title="X", location="any"), posting(1, title="X", location="any"), posting(2, title="X", location="A"), posting(3, title="X", location="B")], POSTING)
    assert sorted(map(tuple, dedup.wildcard_pairs(four, F.col("location") == "any").collect())) == [(0, 2), (1, 3)]


def outranks(new, old):
    if new[0] != old[0]:
        return new[0]
    if (new[1] and not old[1]) or (new[2] and not old[2]):
        return True
    return new[1:3] == old[1:3] and (new[3] or 99) < (old[3] or 99)


def plain_cross_source(rows):
    """(loser, winner) by scanning all residents for each (_ord, bucket, source, country, bulk, described, typed, posted)."""
    removed, residents = [], []
    for row in sorted(rows):
        i = next((i for i, r in enumerate(residents) if r[1] == row[1] and r[2] and r[2] != row[2] and (not r[3] or not row[3] or r[3] == row[3])), None)
        if i is None:
            residents.append(row)
        elif outranks(row[4:], residents[i][4:]):
            removed.append((residents[i][0], row[0]))
            residents.append(row)
            del residents[i]
        else:
            removed.append((row[0], residents[i][0]))
    return sorted(removed)


@pytest.mark.parametrize("alike", [True, False])
def test_cross_source_equals_plain_fold(spark, alike):
    """Buckets below and above the bound, so that some are replayed whole and others in ranges; x has half of the rows."""
    rnd = random.Random(9)
    sources = ["a", "b", "bulk:c", ""] if not alike else ["a", "b", "c"]
    made = [(i, rnd.choice("xxxyz"), rnd.choice(sources), rnd.choice(["", "de", "fr", "DE"]), alike or rnd.random() < 0.6, alike or rnd.random() < 0.7, None if alike else rnd.choice([None, 1, 2, 3])) for i in range(600)]
    rows = spark.createDataFrame([posting(i, title="Data", company=who, source=s, country_iso=c, description="d" if d else None, employment_type="t" if t else None, posted_at=p and dt.date(2024, 1, p)) for i, who, s, c, d, t, p in made], POSTING)
    expected = plain_cross_source([(i, who, s, c.lower(), s.startswith("bulk:"), d, t, p) for i, who, s, c, d, t, p in made])
    for most_rows in (1000, 90):
        assert sorted(map(tuple, dedup.cross_source(rows.repartition(3), most_rows=most_rows).collect())) == expected


def test_cross_source_of_a_hot_bucket_meets_kinds_not_rows():
    """A source whose rows never meet makes one queue of any length: twice the rows, twice the work."""
    held, rank = residents.Residents(), residents.Rank(False, True, False, "1")
    for i in range(200_000):
        assert held.meet("a", "de", i, rank) is None
    assert list(map(len, held.queues.values())) == [200_000]
    assert held.meet("b", "", 200_000, rank) == (200_000, 0)


def test_components(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(1, 30)] + [(100, 101)], "a long, b long")
    found = {r.node: r.component for r in components(edges).collect()}
    assert found == {i: 1 for i in range(1, 31)} | {100: 100, 101: 100}


def runs(spark, *series):
    rows = [(name, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i, s, c) for name, states in series for i, (s, c) in enumerate(states)]
    return spark.createDataFrame(rows, "series string, at timestamp, n int, status string, collected long")


def test_alerts(spark):
    ok = lambda *n: [("ok", x) for x in n]
    found = health.alerts(health.last_runs(runs(spark, ("drop", ok(10, 10, 10, 4)), ("three", ok(10, 10, 4)), ("even", ok(10, 4, 10, 4, 4)), ("zero", [*ok(5, 5, 5), ("empty", 0)]), ("reg", [*ok(1, 1, 1), ("error", 0)]), ("rec", [*ok(1), ("error", 0), ("timeout", 0)])), "series", ["at", "n"]))
    assert {r.series: list(r.alerts) for r in found.collect()} == {"drop": ["drop"], "three": [], "even": ["drop"], "zero": ["zero_return"], "reg": ["regression"], "rec": ["recurring_error"]}


def test_stale_series_has_no_other_alert(spark):
    old = runs(spark, ("old", [("ok", 1), ("error", 0), ("error", 0)]))
    new = runs(spark, ("new", [("ok", 1)])).withColumn("at", F.expr("at + INTERVAL 60 HOURS"))
    found = health.alerts(health.last_runs(old.unionByName(new), "series", ["at"]))
    assert {r.series: list(r.alerts) for r in found.collect()} == {"old": ["stale"], "new": []}


def test_rollup_twice_is_once(spark):
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), "a", 2), (dt.date(2024, 1, 1), "a", 3), (dt.date(2024, 1, 2), "b", 1)], "d date, type string, n int")
    rolled = health.rollup(rows, F.col("d"), "type", ["n"])
    again = health.merge_rollup(rolled, rolled, "type")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rolled.collect()))


def test_lifecycle_merge_twice_is_once(spark):
    day = lambda d: F.lit(d).cast("date")
    known = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string").select("id", "v", day("2024-01-01").alias("first_seen"), day("2024-01-01").alias("last_seen"), F.lit(True).alias("active"))
    run = spark.createDataFrame([(2, "B"), (3, "c")], "id long, v string")
    once = snapshots.merge_lifecycle(known, run, "id", day("2024-01-02"), ["v"])
    twice = snapshots.merge_lifecycle(once, run, "id", day("2024-01-02"), ["v"])
    rows = sorted((r.id, r.v, str(r.first_seen), str(r.last_seen), r.active) for r in once.collect())
    assert rows == [(1, "a", "2024-01-01", "2024-01-01", False), (2, "B", "2024-01-01", "2024-01-02", True), (3, "c", "2024-01-02", "2024-01-02", True)]
    assert rows == sorted((r.id, r.v, str(r.first_seen), str(r.last_seen), r.active) for r in twice.collect())


def test_run_cover(spark):
    a, b = list("abcdefgh"), list("xxabcdefghyy")
    assert similarity.cover(a, a) == (1.0, 1.0)
    assert similarity.cover(a, b) == (8 / 12, 0.0)
    assert similarity.cover(list("abc"), list("abc")) == (0.0, 1.0)
    rows = spark.createDataFrame([(a, a), (a, list("zzz"))], "a array<string>, b array<string>").withColumn("f", similarity.run_cover("a", "b"))
    assert [r[0] for r in rows.select(similarity.verdict(F.col("f"))).collect()] == ["reuse", "regenerate"]


def test_text_pairs_equal_brute_force(spark):
    rnd = random.Random(5)
    some = lambda n, k: [f"w{int(k * rnd.random() ** 2)}" for _ in range(n)]
    queries = [(i, some(rnd.randint(3, 25), 90)) for i in range(12)] + [(12, []), (13, ["a"] * 7)]
    passage = queries[0][1][:3] + [f"p{i}" for i in range(8)]
    queries.append((14, passage))
    texts = [(i, some(rnd.randint(1, 60), 90)) for i in range(150)] + [(150 + i, [*some(30, 90), *passage, *some(30, 90)]) for i in range(60)] + [(210, []), (211, ["b", *["a"] * 8])]
    schema = "id long, words array<string>"
    expected = {}
    for (i, a), (j, b) in itertools.product(queries, texts):
        found = similarity.cover(a, b)
        if found[0] or found[1] >= similarity.EDITS:
            expected[i, j] = (len(set(a) & set(b)), *found)
    assert all((14, 150 + i) in expected for i in range(60)) and (13, 211) in expected and (12, 210) in expected
    rows = similarity.text_pairs(spark.createDataFrame(queries, schema), spark.createDataFrame(texts, schema)).collect()
    assert len(rows) == len(expected)
    assert {(r.left_id, r.right_id): (r.shared, *r.found) for r in rows} == expected


def test_language_level(spark):
    texts = ["Fluent German required", "German is a plus", "basic knowledge of German", "We speak French", None, "German. fluent" + " " * 80 + "German"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] and r[0].level for r in rows.select(extract.language_level(F.col("t"))).collect()]
    assert found == ["fluent", "optional", "basic", None, None, "fluent"]


def test_extractors(spark):
    rows = spark.createDataFrame([("Salary: 60.000 EUR, apply by 31.12.2024, for 3-6 months from March 2025",), ("nothing",), (None,)], "t string")
    t = F.col("t")
    found = rows.select(money.salary(t).alias("s"), extract.deadline(t).alias("d"), extract.duration_months(t).alias("m"), seasons.season_hits(t)["start"].alias("w")).collect()
    assert (found[0].s.min, found[0].s.currency, found[0].s.period, found[0].s.provenance) == (60000.0, "EUR", None, "unit_unconfirmed")
    assert (found[0].d, found[0].m, found[0].w) == (dt.date(2024, 12, 31), 3, ["2025-03"])
    assert [(r.s, r.d, r.m, r.w) for r in found[1:]] == [(None, None, None, []), (None, None, None, [])]


def test_readers(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title> Intern </title><link>https://a/1</link><description>&lt;b&gt;Hi&lt;/b&gt; you</description><pubDate>Fri, 01 Mar 2024 10:00:00 +0000</pubDate><guid>7</guid></item><item><title></title><link>https://a/2</link></item></channel></rss>")
    rss = readers.rss(spark, str(tmp_path / "f.xml"), "feed", "Acme").collect()
    assert [(r.id, r.title, r.description, str(r.posted_at.date())) for r in rss] == [("Acme|feed:7", "Intern", "Hi you", "2024-03-01")]
    (tmp_path / "b.json").write_text(json.dumps({"jobs": [{"t": "A", "u": "https://b/1", "c": {"n": "Co"}, "at": 1700000000000}, {"t": "", "u": "https://b/2", "c": {"n": "Co"}}]}))
    board = readers.json_board(spark, str(tmp_path / "b.json"), "$.jobs", {"title": ["$.name", "$.t"], "url": ["$.u"], "company": ["$.c.n"], "posted_at": ["$.at"]}, "board").collect()
    assert [(r.title, r.company, r.posted_at.year, len(r.id)) for r in board] == [("A", "Co", 2023, 16)]
    (tmp_path / "l.md").write_text("# Jobs\n\n## [Dev](https://c/1)\nAcme, Berlin\n\n## [Ops](https://c/2)\nBeta | Köln\n")
    assert [(r.title, r.company, r.location) for r in readers.markdown_listing(spark, str(tmp_path / "l.md"), "md").collect()] == [("Dev", "Acme", "Berlin"), ("Ops", "Beta", "Köln")]


def test_bulk_and_its_manifest(spark, tmp_path):
    import hashlib

    body = "title,company,url,ats_id,location,country_iso,description,employment_type,posted_at\nIntern,Acme,https://a/1,5,Berlin,de,\"two\nlines\",INTERN,2024-01-01\n,Acme,https://a/2,6,,,,,\n"
    (tmp_path / "lever.csv").write_text(body)
    made = {"schema_version": "1", "by_ats": {"lever": {"csv": "lever.csv", "sha256": hashlib.sha256(body.encode()).hexdigest(), "rows": 2}}}
    (tmp_path / "m.json").write_text(json.dumps(made))
    expected = readers.manifest(spark, str(tmp_path / "m.json"), "1")
    paths = [str(tmp_path / "lever.csv")]
    assert readers.slice_errors(spark, paths, expected).count() == 0
    assert readers.slice_errors(spark, paths, expected.withColumn("rows", F.lit(3))).count() == 1
    assert [(r.id, r.source, r.description) for r in readers.bulk(spark, paths).collect()] == [("Acme|bulk:lever:5", "bulk:lever", "two\nlines")]
    with pytest.raises(ValueError):
        readers.manifest(spark, str(tmp_path / "m.json"), "2")


def test_html(spark):
    page = '<html><head><title> T </title></head><body><script>x</script><a href="/j/1">One <b>job</b></a><!-- c --> a &amp; b<script type="application/ld+json">{"@graph": [{"@type": "JobPosting", "title": "X"}, {"@type": "Thing"}]}</script></body></html>'
    rows = spark.createDataFrame([(page,), (None,)], "h string")
    h = F.col("h")
    found = rows.select(readers.html_title(h).alias("t"), readers.links(h).alias("l"), readers.html_text(h).alias("x"), F.size(readers.job_ld(h)).alias("n"), F.try_variant_get(F.get(readers.job_ld(h), F.lit(0)), "$.title", "string").alias("jt")).collect()
    assert (found[0].t, found[0].l[0].href, found[0].l[0].text, found[0].x, found[0].n, found[0].jt) == ("T", "/j/1", "One job", "One job a & b", 1, "X")
    assert (found[1].t, found[1].l, found[1].x, found[1].n) == (None, [], "", 0)


def test_ledger_appends_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "id long, v string")
    rows.coalesce(1).write.parquet(str(tmp_path / "run1"))
    write = ledger.append_new(str(tmp_path / "ledger"), ["id"])
    stream = ledger.read_runs(spark, str(tmp_path / "run1"), "id long, v string")
    ledger.into(stream, write, str(tmp_path / "cp")).start().awaitTermination()
    write(rows, 1)
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 2
