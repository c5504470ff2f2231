"""Queries over further profiles, structured evidence, keys and addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.catalogue.base import AREA, DECAY_SQL, OTHER, PRIMARY, RELATED, SENIOR, STUDENT, WEAK, P, fold_sql, mentions_sql, now, postings, query, table
from postlode.catalogue.on_postings import BAG_SQL, LABELLED, SCORED, labelled, scored
from postlode.functions import keys
from postlode.functions import requirements as req
from postlode.operators import benchmarks, dedup, evidence, profiles, scoring, snapshots
from postlode.sources import readers


def when(condition: str, points: float) -> str:
    return f"CASE WHEN {condition} THEN {points} ELSE 0.0 END"


def block_sql(terms: list[str], in_title: float, in_description: float) -> str:
    """A block's score as SQL: each term of the title, and any of the description once."""
    titles = " + ".join(f"({mentions_sql('title', [t])})::INT" for t in terms)
    return f"({titles}) * {in_title} + {when(mentions_sql('description', terms), in_description)}"


SECOND = profiles.Materials(PRIMARY, RELATED, WEAK, ["ering", "tion"], ["ung"], STUDENT, SENIOR, "en", "city1")
TECHNICAL = f"{mentions_sql('title', PRIMARY)} OR {mentions_sql('title', RELATED)}"
SECOND_SQL = {
    "materials": block_sql(PRIMARY, 2.5, 1.0),
    "adjacent": block_sql(RELATED, 1.25, 0.5),
    "context": f"CASE WHEN {TECHNICAL} THEN {block_sql(WEAK, 0.75, 0.5)} ELSE 0.0 END",
    "area": f"{when(mentions_sql('title', ['ering', 'tion']), 3.0)} + {when(mentions_sql('title', ['ung']), 2.0)}",
    "type": when(mentions_sql("title", STUDENT), 1.0),
    "location": when("country_iso = 'en'", 1.0) + " + " + when("contains(location, 'city1')", 0.5),
    "penalties": when(mentions_sql("title", SENIOR), -1.0),
}
FUNCTIONS = {"brand": ["ment", "hend"], "people": ["aire"]}
THIRD = profiles.Abroad(AREA, ["ering", "hend"], ["cion"], STUDENT, SENIOR, ["ouse"], PRIMARY, FUNCTIONS, ["fr", "es"], ["co3", "co5"], ("people",))
GATED = f"({mentions_sql('title', ['ment', 'hend'])} AND NOT {mentions_sql('title', PRIMARY)})"
TITLE_AREA = f"2.0 * ({when(mentions_sql('title', PRIMARY), 3.0)} + {when(mentions_sql('title', RELATED), 2.0)} + {when(mentions_sql('title', ['hend', 'eau']) + ' OR (' + mentions_sql('title', ['onth']) + ' AND NOT ' + mentions_sql('title', OTHER) + ')', 1.0)})"
FREE = f"NOT {mentions_sql('title', STUDENT)}"
THIRD_SQL = {
    "area": TITLE_AREA,
    "skills": f"{when(mentions_sql('description', ['ering']), 1.0)} + {when(mentions_sql('description', ['hend']), 1.0)}",
    "type": when(mentions_sql("title", STUDENT), 1.0),
    "location": when("country_iso IN ('fr', 'es')", 1.0),
    "interest": when("company IN ('co3', 'co5')", 0.5),
    "penalties": f"{when(FREE + ' AND ' + mentions_sql('title', SENIOR), -3.0)} + {when(FREE + ' AND ' + mentions_sql('title', ['ouse']), -1.0)} + " + when("coalesce(employment_type = 'FULL_TIME', FALSE)", -0.5),
    "fn": when(f"{mentions_sql('title', ['aire'])} OR {GATED}", -2.5),
    "core": when(mentions_sql("title", ["cion"]), 1.5),
}


def _decay() -> Column:
    return scoring.freshness(F.col("posted_at").cast("timestamp"), now())


def score_sql(parts: dict[str, str]) -> str:
    return f"round(({' + '.join(f'({p})' for p in parts.values())}) * {DECAY_SQL}, 2)"


@query(f"{P} SELECT id, {score_sql(SECOND_SQL)} AS score, {', '.join(f'round({p}, 2)::DOUBLE AS {n}' for n, p in SECOND_SQL.items())} FROM p")
def score_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scoring.with_score(postings(spark, sf_dir), SECOND.components(), _decay())
    return found.select("id", "score", *[F.col("score_breakdown")[n].alias(n) for n in SECOND_SQL])


@query(f"{P} SELECT id, {score_sql(THIRD_SQL)} AS score, {', '.join(f'round({p}, 2)::DOUBLE AS {n}' for n, p in THIRD_SQL.items())} FROM p")
def score_abroad(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scoring.with_score(postings(spark, sf_dir), THIRD.components(), _decay())
    return found.select("id", "score", *[F.col("score_breakdown")[n].alias(n) for n in THIRD_SQL])


@query(f"{P} SELECT id, score FROM (SELECT *, {score_sql(SECOND_SQL)} AS score FROM p) ORDER BY score DESC, lower(title), lower(company), id LIMIT 100")
def rank_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.ranked(postings(spark, sf_dir), SECOND.components(), _decay(), 100).select("id", "score")


@query(f"{P} SELECT id, score FROM (SELECT *, {score_sql(THIRD_SQL)} AS score FROM p WHERE country_iso <> 'de') ORDER BY score DESC, lower(title), lower(company), id LIMIT 100")
def rank_abroad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third profile over the postings of other countries alone."""
    return profiles.ranked(profiles.abroad(postings(spark, sf_dir)), THIRD.components(), _decay(), 100).select("id", "score")


@query(f"{SCORED}, t AS (SELECT id, round(({SECOND_SQL['area']}) * {DECAY_SQL}, 2) AS new FROM p) SELECT s.id, CASE WHEN s.id % 3 = 0 THEN new ELSE score END AS score FROM s JOIN t ON t.id = s.id")
def rescore_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third posting has a new description and is scored anew, here by its area alone; the others keep their score."""
    rows = scored(spark, sf_dir)
    changed = rows.where("id % 3 = 0").select("id", F.lit("a new text").alias("description"))
    return profiles.rescored(rows, changed, {"area": SECOND.components()["area"]}, _decay()).select("id", "score")


@query(f"{P} SELECT id, 'penalty' AS component, -3.0::DOUBLE AS value FROM p WHERE {mentions_sql('title', SENIOR)} UNION ALL SELECT id, 'language', -0.5::DOUBLE FROM p WHERE country_iso = 'fr'")
def score_penalties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What costs a posting points, apart from its age."""
    return profiles.penalties(scored(spark, sf_dir)).where("component <> 'decay'").select("id", "component", "value")


@query(f"{LABELLED} SELECT a.id, a.label, a.score, count(b.id) AS outranked FROM l a LEFT JOIN l b ON b.label < a.label AND b.score > a.score GROUP BY ALL")
def label_inversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmarks.inversions(labelled(spark, sf_dir)).select("id", "label", "score", "outranked")


@query(f"{LABELLED} SELECT * FROM (SELECT id, score, 'high' AS kind FROM l WHERE label = 0 ORDER BY score DESC, id LIMIT 6) UNION ALL SELECT * FROM (SELECT id, score, 'low' AS kind FROM l WHERE label = 1 ORDER BY score, id LIMIT 6)")
def label_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad postings with high scores, and good ones with low scores."""
    rows = labelled(spark, sf_dir)
    high, low = benchmarks.extremes(rows, [0]), benchmarks.extremes(rows, [1], best=False)
    return high.select("id", "score", F.lit("high").alias("kind")).unionByName(low.select("id", "score", F.lit("low").alias("kind")))


@query(f"{SCORED} SELECT id, source, row_number() OVER (PARTITION BY source ORDER BY score DESC, id) AS rank_within FROM s")
def ranks_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmarks.ranks_within(scored(spark, sf_dir), "source", [F.desc("score"), F.asc("id")]).select("id", "source", "rank_within")


@query(f"{SCORED} SELECT posted_at AS day, count(*) AS n, round(avg(score), 4) AS mean_score, round(avg(score) FILTER (WHERE quality = 1), 4) AS answered_mean FROM s JOIN labels ON doc_id = id GROUP BY 1")
def outcomes_rescored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes by day under today's scores; the labels stand for answers."""
    rows = scored(spark, sf_dir)
    told = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("answered"))
    outcomes = rows.select("id", F.col("posted_at").alias("day")).join(told, "id")
    return benchmarks.rescored_outcomes(outcomes, rows.select("id", "score"))


#: A page with structured data for each order: every field comes from a column, some are missing or contradict.
PAGE = """
<html><script type="application/ld+json">{"@type":"JobPosting","title":"Buyer %1$s","identifier":%2$s,"datePosted":"%3$sT08:00:00+01:00","validThrough":"%4$s",
"employmentType":%5$s,"baseSalary":%6$s,"jobLocation":%7$s,"hiringOrganization":{"name":"%8$s"},"description":"<p>Orders &amp; parts</p>"}</script></html>"""


def page_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with the structured data of their page, read from its HTML, and the posting's own columns."""
    k, price = F.col("o_orderkey"), F.format_string("%.2f", F.col("o_totalprice").cast("double"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    ident = F.when(k % 4 == 0, F.concat(F.lit('{"value":"R'), k, F.lit('"}'))).when(k % 4 == 1, F.lit('"other"')).otherwise(F.lit("null"))
    kind = F.when(k % 3 == 0, F.lit('["INTERN","OTHER"]')).when(k % 3 == 1, F.lit('"FULL_TIME"')).otherwise(F.lit("null"))
    pay = F.when(k % 5 == 0, F.concat(F.lit('{"currency":"eur","value":{"minValue":'), price, F.lit(',"unitText":"MONTH"}}'))).when(k % 5 == 1, F.lit('{"currency":"EUR","value":0}')).otherwise(F.lit("null"))
    place = F.when(k % 2 == 0, F.concat(F.lit('[{"address":{"addressLocality":"City'), k % 7, F.lit('","addressCountry":{"name":"de"}}}]'))).otherwise(F.lit("null"))
    html = F.format_string(PAGE, k, ident, day, F.when(k % 6 == 0, "soon").otherwise(day), kind, pay, place, F.when(k % 9 == 0, "Elsewhere").otherwise("Acme"))
    post = F.get(readers.job_ld(html), F.lit(0))
    rows = table(spark, sf_dir, "orders").select(k.alias("id"), evidence.fields(post).alias("found"))
    return rows.withColumns({"title": F.concat(F.lit("Buyer "), "id"), "company": F.lit("Acme GmbH"), "external_id": F.concat(F.lit("R"), "id"), "location": F.concat(F.lit("City"), F.col("id") % 3)})


@query("SELECT o_orderkey AS id, 'Buyer ' || o_orderkey AS title, CASE WHEN o_orderkey % 4 = 0 THEN 'R' || o_orderkey WHEN o_orderkey % 4 = 1 THEN 'other' END AS identifier, CAST(o_orderdate AS DATE) AS date_posted, CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderdate AS DATE) END AS valid_through, CASE WHEN o_orderkey % 3 = 0 THEN 'INTERN' WHEN o_orderkey % 3 = 1 THEN 'FULL_TIME' END AS employment_type, CASE WHEN o_orderkey % 5 = 0 THEN round(o_totalprice, 2)::DOUBLE END AS pay, CASE WHEN o_orderkey % 5 = 0 THEN 'EUR month' END AS unit, CASE WHEN o_orderkey % 2 = 0 THEN 'City' || (o_orderkey % 7) END AS city, CASE WHEN o_orderkey % 2 = 0 THEN 'de' END AS country, 'Orders & parts' AS description FROM orders")
def jsonld_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of structured data, read from pages."""
    f = F.col("found")
    unit = F.when(f["salary"].isNotNull(), F.concat_ws(" ", f["salary"]["currency"], f["salary"]["period"]))
    named = {"identifier": f["identifier"], "date_posted": f["date_posted"], "valid_through": f["valid_through"], "employment_type": f["employment_type"], "pay": f["salary"]["max"], "unit": unit, "city": f["location"]["city"], "country": f["location"]["country"], "description": f["description"]}
    return page_posts(spark, sf_dir).select("id", f["title"].alias("title"), *[c.alias(n) for n, c in named.items()])


@query("SELECT o_orderkey AS id, o_orderkey % 4 = 0 OR o_orderkey % 9 <> 0 AS same, o_orderkey % 4 = 1 AS contradicts, CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN o_orderkey % 7 = o_orderkey % 3 THEN 'confirmed' ELSE 'conflict' END END AS place, CASE WHEN o_orderkey % 3 = 2 THEN 'missing' WHEN o_orderkey % 3 = 0 THEN 'conflict' ELSE 'match' END AS type FROM orders")
def jsonld_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether structured data speak of a posting, and what they contradict; titles agree, employers do not always."""
    f, none = F.col("found"), F.lit(None).cast("string")
    student = req.is_student_role(F.col("title"), none, none)
    return page_posts(spark, sf_dir).select(
        "id", evidence.speaks_of(f, F.col("title"), F.col("company"), F.col("external_id"), F.lit("https://acme.example/jobs")).alias("same"), evidence.contradicts(f, F.col("title"), F.col("external_id")).alias("contradicts"),
        evidence.location_relation(f, F.col("location")).alias("place"), evidence.type_relation(f["employment_type"], student).alias("type"),
    )


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 > 0 THEN 'Team' || (o_orderkey % 3) END AS department, CASE WHEN o_orderkey % 2 = 0 THEN 'https://a.example/' || o_orderkey END AS apply_url, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE o_orderkey % 4 = 0 END AS is_remote, CASE WHEN o_orderkey % 4 = 3 THEN 'missing' WHEN (o_orderkey % 4 = 0) = (o_orderkey % 5 < 2) THEN CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 5 > 1 THEN 'match' ELSE 'conflict' END WHEN o_orderkey % 4 = 0 THEN CASE WHEN o_orderkey % 5 = 2 THEN 'conflict' ELSE 'match' END ELSE 'conflict' END AS remote FROM orders")
def raw_field_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that boards keep beside a posting, and whether the flag for remote work agrees with the words."""
    k = F.col("o_orderkey")
    raw = F.format_string('{"department":"%s","apply_url":"%s","is_remote":%s}', F.when(k % 3 > 0, F.concat(F.lit("Team"), k % 3)).otherwise(" "), F.when(k % 2 == 0, F.concat(F.lit("https://a.example/"), k)).otherwise("ftp://a.example/x"), F.when(k % 4 == 3, "null").when(k % 4 == 0, "true").otherwise("false"))
    words = F.when(k % 5 == 0, "remote work").when(k % 5 == 1, "hybrid").when(k % 5 == 2, "on-site").otherwise("at a desk")
    rows = table(spark, sf_dir, "orders").select(k.alias("id"), evidence.raw_fields(raw).alias("raw"), words.alias("words"))
    return rows.select("id", "raw.department", "raw.apply_url", "raw.is_remote", evidence.remote_relation(F.col("raw.is_remote"), F.col("words")).alias("remote"))


@query("SELECT doc_id AS id, text FROM documents")
def mojibake_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text once decoded wrongly and then repaired: it is what it was. Texts that are right stay, too."""
    docs = table(spark, sf_dir, "documents")
    broken = F.when(F.col("doc_id") % 2 == 0, F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")).otherwise(F.col("text"))
    return docs.select(F.col("doc_id").alias("id"), keys.repaired(broken).alias("text"))


LANGUAGE_SQL = ", ".join(f"struct_pack(n := -len(list_filter(w, lambda x: x IN ({', '.join(repr(x) for x in own)}))), code := '{code}')" for code, own in keys.LANGUAGE_WORDS.items())


@query(f"WITH t AS (SELECT doc_id AS id, regexp_extract_all({fold_sql('text')}, '[a-z]+') AS w FROM documents), b AS (SELECT id, list_sort([{LANGUAGE_SQL}])[1] AS best FROM t) SELECT id, CASE WHEN best.n < 0 THEN best.code END AS language FROM b")
def text_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), keys.language_of(F.col("text")).alias("language"))


TRANSLATED = f"array_to_string(list_sort(list_distinct(list_transform(string_split({BAG_SQL}, ' '), lambda w: CASE w WHEN 'nicht' THEN 'that' WHEN 'dass' THEN 'which' ELSE w END))), ' ')"


@query(f"{P} SELECT id, {TRANSLATED} AS bag FROM p")
def translated_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with some words of one language in another."""
    return postings(spark, sf_dir).select("id", keys.translated_bag(F.col("title"), {"nicht": "that", "dass": "which"}).alias("bag"))


@query(f"{P} SELECT id, CASE WHEN bag <> '' THEN sha256(company || chr(31) || bag || chr(31) || location) END AS key FROM (SELECT *, {BAG_SQL} AS bag FROM p)")
def cross_source_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spark, sf_dir).select("id", keys.cross_source_key(F.col("company"), F.col("title"), F.col("location")).alias("key"))


@query(f"{P}, n AS (SELECT *, row_number() OVER (PARTITION BY {BAG_SQL}, location = 'city0' ORDER BY id) AS n, {BAG_SQL} AS bag, location = 'city0' AS anywhere FROM p) SELECT a.id AS loser, b.id AS winner, a.source AS loser_source, b.source AS winner_source, a.url AS loser_url, b.url AS winner_url FROM n a JOIN n b ON a.bag = b.bag AND a.n = b.n WHERE a.anywhere AND NOT b.anywhere")
def merge_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each merge of postings for any place joined."""
    rows = postings(spark, sf_dir)
    removed = dedup.wildcard_pairs(rows.withColumn("company", F.lit("co")), F.col("location") == "city0")
    return snapshots.provenance(removed, rows).select("loser", "winner", "loser_source", "winner_source", "loser_url", "winner_url")


BOARDS = [keys.Board("org_board", "example.org", r"^https?://[^/]+/([a-z]+)/", r"/(\d+)(?:[/?#]|$)", r"/old/"), keys.Board("com_board", "com", r"^https?://([^./]+)\.", r"-(\d+)\.html")]


def host_sql(c: str) -> str:
    return f"lower(regexp_extract({c}, '(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"


ORG, COM = "(h = 'example.org' OR ends_with(h, '.example.org'))", "(h = 'com' OR ends_with(h, '.com'))"


@query(f"WITH a AS (SELECT page_id, url, {host_sql('url')} AS h FROM pages) SELECT page_id, CASE WHEN {ORG} THEN 'org_board' WHEN {COM} THEN 'com_board' END AS board, nullif(CASE WHEN {ORG} THEN lower(regexp_extract(url, '(?i)^https?://[^/]+/([a-z]+)/', 1)) WHEN {COM} THEN lower(regexp_extract(url, '(?i)^https?://([^./]+)\\.', 1)) END, '') AS slug, nullif(CASE WHEN {ORG} THEN regexp_extract(url, '/(\\d+)(?:[/?#]|$)', 1) WHEN {COM} THEN regexp_extract(url, '-(\\d+)\\.html', 1) END, '') AS job_id, CASE WHEN {ORG} AND regexp_matches(url, '/old/') THEN 'legacy_dead' WHEN {ORG} AND regexp_matches(url, '/(\\d+)(?:[/?#]|$)') OR {COM} AND regexp_matches(url, '-(\\d+)\\.html') THEN 'current' END AS status FROM a")
def url_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board, tenant and job that an address names, and whether its form is alive."""
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", keys.board_of(u, BOARDS).alias("board"), keys.slug_of(u, BOARDS).alias("slug"), keys.job_id_of(u, BOARDS).alias("job_id"), keys.format_status(u, BOARDS).alias("status"))


@query("SELECT page_id, url, 'board:tenant-' || page_id % 9 AS tenant, page_id % 9 = 3 AS trial FROM pages")
def url_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses out of the redirects that carry them, and keys of tenants."""
    wrapped = F.concat(F.lit("https://r.example/out?id=1&url="), F.url_encode("url"))
    slug = F.concat(F.lit("Tenant-"), F.col("page_id") % 9, F.lit("/"))
    rows = table(spark, sf_dir, "pages")
    return rows.select("page_id", keys.unwrapped(F.when(F.col("url").rlike("^https?://"), wrapped).otherwise(F.col("url"))).alias("url"), keys.tenant_key(F.lit("Board"), slug).alias("tenant"), keys.trial_slug(F.when(F.col("page_id") % 9 == 3, "acme-QA").otherwise("acme-quality")).alias("trial"))


DAMAGED = '<script type="application/ld+json">{"@graph":[{"@type":"WebPage"},{"@type":["Thing","JobPosting"],"description":"<p>Page\n\tof %1$s</p> in C:\\dir, %2$s"}]}</script>'


@query("SELECT page_id, CASE WHEN length('Page of ' || u || ' in C:dir, ' || w) >= 120 THEN 'Page of ' || u || ' in C:dir, ' || w END AS description FROM (SELECT page_id, coalesce(regexp_extract(url, '^[\\w:/.-]*'), '') AS u, array_to_string(list_transform(range(1 + page_id % 9), lambda i: 'and counts parts ' || i), '; ') AS w FROM pages)")
def jsonld_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions from structured data with raw line ends and a backslash that escapes nothing, if they are long enough."""
    words = F.array_join(F.transform(F.sequence(F.lit(0), (F.col("page_id") % 9).cast("int")), lambda i: F.concat(F.lit("and counts parts "), i.cast("string"))), "; ")
    html = F.format_string(DAMAGED, F.regexp_extract(F.coalesce("url", F.lit("")), r"^[\w:/.-]*", 0), words)
    return table(spark, sf_dir, "pages").select("page_id", readers.job_description(html).alias("description"))
