"""Queries over documents seen as postings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.catalogue.base import AREA_SQL, DECAY_SQL, REASON_SQL, SCORE_PARTS, SCORE_PARTS_SQL, SKILLS, STAGES_SQL, P, area, components, fold_sql, mentions_sql, now, postings, query, reasons, stages, table
from postlode.functions import extract, money, sentences
from postlode.functions.text import FUNCTION_WORDS, canonical_url, title_bag
from postlode.operators import benchmarks, dedup, filters, lookups, scoring, similarity, snapshots
from postlode.plans.refresh import Plan
from postlode.rules import mentions


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.with_score(postings(spark, sf_dir), components(), scoring.freshness(F.col("posted_at").cast("timestamp"), now()))


SCORED = f"{P}, s AS (SELECT *, round(({SCORE_PARTS_SQL}) * {DECAY_SQL}, 2) AS score FROM p)"
LABELLED = f"{SCORED}, l AS (SELECT s.*, labels.quality AS label FROM s JOIN labels ON s.id = labels.doc_id)"


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return scored(spark, sf_dir).join(labels, "id")


@query(f"{SCORED}, c AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY score DESC, lower(title), lower(company), id) AS company_rank FROM s) SELECT row_number() OVER (ORDER BY score DESC, lower(title), lower(company), id) AS rank, id, company, company_rank, score FROM c WHERE company_rank <= 2 ORDER BY rank LIMIT 100")
def rank_topk_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.top_capped(scored(spark, sf_dir).drop("description", "score_breakdown")).select("rank", "id", "company", "company_rank", "score")


@query(f"{SCORED}, t AS (SELECT * FROM s ORDER BY score DESC, lower(title), lower(company), id LIMIT 100), c AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY score DESC, lower(title), lower(company), id) AS company_rank FROM t) SELECT id, company, company_rank, score FROM c WHERE company_rank > 2")
def company_cap_hidden(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.hidden_by_cap(scored(spark, sf_dir).drop("description", "score_breakdown")).select("id", "company", "company_rank", "score")


@query(f"{SCORED} SELECT id, score FROM s")
def score_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("id", "score")


#: The parts of a score as rows; what decay takes is a part too.
PARTS_SQL = [("area", AREA_SQL), *[(n, SCORE_PARTS[n]) for n in ("skills", "language", "penalty")]]
BREAKDOWN = f"{P}, q AS (SELECT *, {', '.join(f'round({c}, 2) AS {n}' for n, c in PARTS_SQL)} FROM p), d AS (SELECT *, round(round((area + skills + language + penalty) * {DECAY_SQL}, 2) - (area + skills + language + penalty), 2) AS decay FROM q), b AS (UNPIVOT (SELECT id, area, skills, language, penalty, decay FROM d) ON area, skills, language, penalty, decay INTO NAME component VALUE value)"


@query(f"{BREAKDOWN} SELECT id, component, value, row_number() OVER (PARTITION BY id ORDER BY abs(value) DESC, component) AS place FROM b WHERE value <> 0")
def score_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.signals(scored(spark, sf_dir))


@query(f"{P} SELECT source, count(*) AS collected, " + ", ".join(f"count(*) FILTER (WHERE {' AND '.join(c for _, c in STAGES_SQL[: i + 1])}) AS {n}" for i, (n, _) in enumerate(STAGES_SQL)) + f", count(*) FILTER (WHERE {' AND '.join(c for _, c in STAGES_SQL)} AND ({REASON_SQL}) IS NULL) AS eligible FROM p GROUP BY source")
def filter_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.funnel(postings(spark, sf_dir), [*stages(), ("eligible", filters.first_reason(reasons()).isNull())], ["source"])


@query(f"{P} SELECT id, {REASON_SQL} AS reason FROM p")
def reason_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.with_reason(postings(spark, sf_dir), reasons()).select("id", "reason")


@query(f"{P} SELECT coalesce({REASON_SQL}, 'none') AS reason, count(*) AS n FROM p GROUP BY 1")
def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.with_reason(postings(spark, sf_dir), reasons()).groupBy(F.coalesce("reason", F.lit("none")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"{P} SELECT id FROM p WHERE coalesce({REASON_SQL}, '') <> 'senior'")
def hard_removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.hard_removals(filters.with_reason(postings(spark, sf_dir), reasons()), reasons()).select("id")


@query(f"{P} SELECT id, {AREA_SQL} AS area_score, {AREA_SQL} >= 1.5 AS matches FROM p")
def area_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spark, sf_dir).select("id", area().alias("area_score")).withColumn("matches", F.col("area_score") >= 1.5)


@query(f"{P} SELECT id, CASE WHEN trim(description) = '' THEN 'empty' WHEN regexp_matches(description, '(?i)\\b(?:sign in|log in) to (?:view|continue)\\b') THEN 'login_wall' WHEN length(trim(description)) < 600 THEN 'short' END AS assessability FROM p")
def assessability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spark, sf_dir).select("id", filters.assessability(F.col("description")).alias("assessability"))


SECRETS = {"password": r"(?i)\b(?:password|passwd|pwd)\s*[:=]\s*[^ ]+", "key": r"\b(?:AKIA|sk_live_|ghp_|sk-)[A-Za-z0-9]{8,}", "private_path": r"/(?:home|Users|root)/[a-z]+", "email": r"[A-Za-z0-9._]+@[A-Za-z0-9.]+\.[a-z]{2,}"}


@query("SELECT doc_id AS id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{n}' END" for n, p in SECRETS.items()) + "], lambda x: x IS NOT NULL), ',') AS found FROM documents WHERE " + " OR ".join(f"regexp_matches(text, '{p}')" for p in SECRETS.values()))
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filters.finds(F.col("text"), SECRETS)
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.array_join(found, ",").alias("found")).where("found <> ''")


SKILL_SQL = " UNION ALL ".join(f"SELECT '{n}' AS skill, {mentions_sql('title', t)} AS in_title, {mentions_sql('description', t)} AS in_description FROM p" for n, t in SKILLS.items())


@query(f"{P}, k AS ({SKILL_SQL}) SELECT skill, count(*) FILTER (WHERE in_title) AS by_title, count(*) FILTER (WHERE in_description AND NOT in_title) AS by_description, count(*) FILTER (WHERE in_title OR in_description) AS demand, round(count(*) FILTER (WHERE in_title OR in_description) / count(*), 4) AS share FROM k GROUP BY skill")
def skill_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.demand(postings(spark, sf_dir), SKILLS)


@query("SELECT source, count(*) AS postings, count(*) FILTER (WHERE length(text) > 0) AS described, CAST(floor(median(length(text))) AS BIGINT) AS median_length, count(*) FILTER (WHERE length(text) < 600) AS short FROM documents GROUP BY source")
def provider_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("text")
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("postings"), F.count_if(n > 0).alias("described"), F.floor(F.median(n)).cast("long").alias("median_length"), F.count_if(n < 600).alias("short"))


@query(f"{SCORED} SELECT min(score) AS min_score, median(score) AS median_score, max(score) AS max_score, count(*) AS n FROM s")
def score_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).agg(F.min("score").alias("min_score"), F.median("score").alias("median_score"), F.max("score").alias("max_score"), F.count("*").alias("n"))


@query(f"{LABELLED}, x AS (SELECT a.score > b.score AS good, a.score < b.score AS bad FROM l a JOIN l b ON a.label > b.label) SELECT count(*) AS pairs, count(*) FILTER (WHERE good) AS concordant, count(*) FILTER (WHERE bad) AS discordant, count(*) FILTER (WHERE NOT good AND NOT bad) AS tied, round(count(*) FILTER (WHERE good) / count(*), 6) AS concordance, round((count(*) FILTER (WHERE good) - count(*) FILTER (WHERE bad)) / count(*), 6) AS tau FROM x")
def label_concordance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmarks.concordance(labelled(spark, sf_dir))


@query(f"{LABELLED}, x AS (SELECT a.source, a.score > b.score AS good, a.score < b.score AS bad FROM l a JOIN l b ON a.label > b.label AND a.source = b.source) SELECT source, count(*) AS pairs, count(*) FILTER (WHERE good) AS concordant, count(*) FILTER (WHERE bad) AS discordant FROM x GROUP BY source")
def concordance_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmarks.concordance(labelled(spark, sf_dir), "source").where("pairs > 0").select("source", "pairs", "concordant", "discordant")


@query(f"{LABELLED} SELECT score, count(*) AS n, count(DISTINCT label) AS labels, count(DISTINCT label) > 1 AS mixed FROM l GROUP BY score HAVING count(*) > 1")
def score_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmarks.tie_groups(labelled(spark, sf_dir))


@query(f"{LABELLED} SELECT label, count(*) AS n, round(avg(score), 4) AS mean_score, min(score) AS min_score, max(score) AS max_score FROM l GROUP BY label")
def mean_score_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmarks.by_label(labelled(spark, sf_dir))


@query(f"{BREAKDOWN} SELECT component, quality AS label, round(avg(value), 4) AS mean_value FROM b JOIN labels ON labels.doc_id = b.id GROUP BY component, quality")
def component_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmarks.component_profile(labelled(spark, sf_dir))


@query(f"{LABELLED} SELECT CASE WHEN score >= 4 THEN 3 WHEN score >= 2 THEN 2 WHEN score >= 1 THEN 1 ELSE 0 END AS band, count(*) AS n, sum(label)::BIGINT AS positives, round(avg(label), 4) AS share FROM l GROUP BY 1")
def score_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmarks.bands(labelled(spark, sf_dir), [1.0, 2.0, 4.0])


@query(f"{LABELLED}, t AS (SELECT * FROM l ORDER BY score DESC, id LIMIT 50) SELECT count(*) AS k, sum(label)::BIGINT AS positives, round(avg(label), 4) AS share FROM t")
def precision_at_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmarks.precision_at(labelled(spark, sf_dir).select("id", "score", "label"), 50)


BAG_SQL = "array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(regexp_replace(regexp_replace({0}, '\\b(?:[mfwd](?:/[mfwd]){{1,2}}|mwd|x|[mw]/[mw]/div\\.?|all genders?|any gender|alle geschlechter)\\b', ' ', 'g'), '\\b(?:werkstudent(?:en?|in)?|praktikant(?:en?|in)?|praktikums?|internships?|interns?)\\b', 'working student', 'g'), '[a-z0-9]+'), lambda x: x NOT IN ({1})))), ' ')".format(fold_sql("title"), ", ".join(f"'{w}'" for w in FUNCTION_WORDS))


@query(f"{P}, b AS (SELECT id, {BAG_SQL} AS bag FROM p) SELECT bag, count(*) AS n, min(id) AS first_id FROM b WHERE bag <> '' GROUP BY bag HAVING count(*) > 1")
def title_bag_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spark, sf_dir).select("id", title_bag(F.col("title")).alias("bag")).where("bag <> ''").groupBy("bag").agg(F.count("*").alias("n"), F.min("id").alias("first_id")).where("n > 1")


@query(f"{P}, b AS (SELECT source, {BAG_SQL} AS bag FROM p) SELECT bag, count(DISTINCT source) AS sources FROM b WHERE bag <> '' GROUP BY bag HAVING count(DISTINCT source) > 1")
def residual_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spark, sf_dir).select("source", title_bag(F.col("title")).alias("bag")).where("bag <> ''").groupBy("bag").agg(F.count_distinct("source").alias("sources")).where("sources > 1")


@query(f"{P}, c AS (SELECT id, title, company FROM p WHERE id % 3 <> 0), v AS (SELECT id, title, company FROM p WHERE id % 3 <> 1), f AS (SELECT * FROM c WHERE id NOT IN (SELECT id FROM v)) SELECT f.id, coalesce(f.title IN (SELECT title FROM v WHERE title IS NOT NULL), FALSE) AS reseen FROM f")
def reposts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = postings(spark, sf_dir).select("id", "title")
    return snapshots.reseen(rows.where("id % 3 <> 0"), rows.where("id % 3 <> 1"), "id", "title").select("id", "reseen")


@query()
def dedup_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.cascade(postings(spark, sf_dir))


WORD_OF = "regexp_matches(title, '(?i)(?:^|[^\\pL\\pM\\pN_])(?:{})(?:$|[^\\pL\\pM\\pN_])')"
GERMAN_SQL, ENGLISH_SQL = WORD_OF.format("der|die|das|und|praktik[\\pL\\pM\\pN_]+|werkstudent[\\pL\\pM\\pN_]*"), WORD_OF.format("the|and|intern[\\pL\\pM\\pN_]*|working student")
MIRROR_SQL = f"""{P}, m AS (SELECT *, {BAG_SQL} AS bag, CASE WHEN {GERMAN_SQL} AND NOT {ENGLISH_SQL} THEN 'de' WHEN {ENGLISH_SQL} AND NOT {GERMAN_SQL} THEN 'en' END AS language, id // 2 AS requisition FROM p),
w AS (SELECT *, first_value(id) OVER o AS winner, first_value(bag) OVER o AS wbag, first_value(language) OVER o AS wlanguage, first_value(country_iso) OVER o AS wcountry, first_value(employment_type) OVER o AS wtype FROM m WINDOW o AS (PARTITION BY requisition ORDER BY coalesce(description, '') <> '' DESC, coalesce(employment_type, '') <> '' DESC, posted_at NULLS LAST, id))
SELECT id AS loser, winner FROM w WHERE id <> winner AND coalesce(country_iso = wcountry, TRUE) AND coalesce(employment_type = wtype, TRUE) AND (bag = wbag OR coalesce(language <> wlanguage, FALSE))"""


@query(MIRROR_SQL)
def dedup_mirrors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.mirrors(postings(spark, sf_dir).withColumn("source", F.lit("board")).withColumn("company", F.lit("co")))


@query()
def dedup_cross_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.cross_source(postings(spark, sf_dir).withColumns({"location": F.lit("Berlin"), "company": F.lit("Acme GmbH")}))


@query(f"{P}, n AS (SELECT id, bag, anywhere, row_number() OVER (PARTITION BY bag, anywhere ORDER BY id) AS n FROM (SELECT id, {BAG_SQL} AS bag, location = 'city0' AS anywhere FROM p)) SELECT a.id AS loser, b.id AS winner FROM n a JOIN n b ON a.bag = b.bag AND a.n = b.n WHERE a.anywhere AND NOT b.anywhere")
def dedup_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.wildcard_pairs(postings(spark, sf_dir).withColumn("company", F.lit("co")), F.col("location") == "city0")


@query()
def refresh_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = Plan(stages(), reasons(), components(), scoring.freshness(F.col("posted_at").cast("timestamp"), now()))
    return plan.ranking(postings(spark, sf_dir)).drop("score_breakdown")


@query()
def jd_similarity_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """benchmark items against the documents that share a run of words or enough words with them."""
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), similarity.words(F.col("text")).alias("words"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), similarity.words(F.col("text")).alias("words"))
    pairs = similarity.text_pairs(items, docs)
    return pairs.select("left_id", "right_id", "shared", F.round("found.coverage", 6).alias("coverage"), F.round("found.rest_jaccard", 6).alias("rest_jaccard"), similarity.verdict(F.col("found")).alias("verdict"))


@query()
def salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pay that documents state."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("id"), money.salary(F.col("text")).alias("s")).where("s IS NOT NULL").select("id", "s.*")


@query()
def language_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    qualifiers = {"fluent": r"\b(?:der|the)\b", "basic": r"\b(?:und|and)\b"}
    level = extract.language_level(F.col("text"), r"\b(?:nicht|that)\b", qualifiers=qualifiers, soft=r"\b(?:of|sich)\b")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), level["level"].alias("level"))


URL_SQL = "lower(regexp_replace(CASE WHEN length({k}) > 0 THEN {b} || '?' || array_to_string({k}, '&') ELSE {b} END, '/+$', ''))"
TRACKING_SQL = "list_filter(string_split(regexp_replace(u, '^[^?]*\\??', ''), '&'), lambda x: x <> '' AND NOT regexp_matches(lower(string_split(x, '=')[1]), '^utm_') AND lower(string_split(x, '=')[1]) NOT IN ('gclid','fbclid','msclkid','dclid','twclid','ttclid','li_fat_id','igshid','mc_cid','mc_eid','ref','referrer','referer','source','spm','_ga','_gl','_hsenc','_hsmi'))"
CANONICAL = f"WITH a AS (SELECT page_id, regexp_replace(trim(coalesce(url, '')), '#.*$', '') AS u FROM pages), b AS (SELECT page_id, regexp_extract(u, '^[^?]*') AS base, {TRACKING_SQL} AS kept FROM a), c AS (SELECT page_id, {URL_SQL.format(k='kept', b='base')} AS canonical FROM b)"


@query(f"{CANONICAL} SELECT page_id, canonical FROM c")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", canonical_url(F.col("url")).alias("canonical"))


@query(f"{CANONICAL} SELECT regexp_replace(regexp_replace(canonical, '^https?://(?:www\\.|m\\.|blog\\.)?', ''), '/.*$', '') AS site, count(*) AS pages, count(DISTINCT canonical) AS canonical_urls FROM c GROUP BY 1")
def url_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "pages").select(canonical_url(F.col("url")).alias("canonical"))
    site = F.regexp_replace(F.regexp_replace("canonical", r"^https?://(?:www\.|m\.|blog\.)?", ""), "/.*$", "")
    return made.groupBy(site.alias("site")).agg(F.count("*").alias("pages"), F.count_distinct("canonical").alias("canonical_urls"))


CLAIM, CONDITION = " (?:the|die|une|los|der|le) [a-z]+", " (?:and|und|et|y|de) "
PIECES_SQL = r"string_split(regexp_replace(text, '([.!?;])(\s)', '\1' || chr(1) || '\2', 'g'), chr(1))"
EVIDENCE_SQL = f"""WITH s AS (SELECT doc_id, unnest({PIECES_SQL}) AS x, generate_subscripts({PIECES_SQL}, 1) AS i FROM documents WHERE text <> ''),
l AS (SELECT *, coalesce(sum(length(x)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead, regexp_extract(x, '(?s)^(.*?){CLAIM}', 1) AS lead FROM s),
f AS (SELECT doc_id, min(i) AS i FROM l WHERE regexp_matches(x, '{CLAIM}') AND NOT regexp_matches(lead, '{CONDITION}') GROUP BY 1)
SELECT d.doc_id, CAST(l.ahead + length(l.lead) AS INTEGER) AS at, regexp_extract(l.x, '{CLAIM}') AS term FROM documents d LEFT JOIN f USING (doc_id) LEFT JOIN l ON l.doc_id = f.doc_id AND l.i = f.i"""


@query(EVIDENCE_SQL)
def sentence_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document the first claim that no condition stands ahead of in its sentence, with its place."""
    found = sentences.evidence(sentences.sentences(F.col("text")), CLAIM, CONDITION)
    return table(spark, sf_dir, "documents").select("doc_id", found.alias("e")).select("doc_id", "e.at", "e.term")
