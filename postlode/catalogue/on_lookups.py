"""Queries over dimensions, applications and incremental runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.catalogue.base import P, fold_sql, postings, query, table
from postlode.functions import extract, places
from postlode.functions import requirements as req
from postlode.operators import enrichment, lookups, similarity, tracker
from postlode.shared import stored

NAMES = {"nation_0": "aa", "nation_1": "bb", "nation_2": "cc", "nation_3": "dd"}


@query("SELECT c_custkey, CASE n_nationkey WHEN 0 THEN 'aa' WHEN 1 THEN 'bb' WHEN 2 THEN 'cc' WHEN 3 THEN 'dd' END AS iso FROM customer JOIN nation ON n_nationkey = c_nationkey")
def country_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries from places written three ways: name last, name first, and in brackets."""
    joined = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    name = F.concat(F.lit("Nation_"), F.col("n_nationkey"))
    place = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("Town, State, "), name)).when(F.col("c_custkey") % 3 == 1, F.concat(name, F.lit(", Town"))).otherwise(F.concat(F.lit("Town ("), name, F.lit(")")))
    return joined.select("c_custkey", places.infer_country(place, F.lit(None).cast("string"), F.lit(None).cast("string"), NAMES).alias("iso"))


@query(f"WITH a AS (SELECT {fold_sql('n_name')} AS k, n_name || ' Ltd' AS name FROM nation WHERE n_nationkey % 2 = 0) SELECT s_suppkey, coalesce(name, n_name) AS company FROM supplier JOIN nation ON n_nationkey = s_nationkey LEFT JOIN a ON k = {fold_sql('n_name')}")
def company_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    aliases = nation.where("n_nationkey % 2 = 0").select(F.upper("n_name").alias("alias"), F.concat("n_name", F.lit(" Ltd")).alias("name"))
    rows = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("company"))
    return lookups.rename_by_alias(rows, "company", aliases)


@query("WITH s AS (SELECT l_suppkey % 7 AS company, list_sort(list(DISTINCT l_partkey % 3)) AS tenants FROM lineitem GROUP BY 1), d AS (SELECT unnest(range(9)) AS company), e AS (SELECT company, CASE WHEN company = 7 THEN NULL ELSE company % 4 END AS tenant FROM d) SELECT e.company, tenant, CASE WHEN tenant IS NULL THEN 'dynamic' WHEN tenants IS NULL THEN 'not_found' WHEN list_contains(tenants, tenant) AND len(tenants) > 1 THEN 'multi' WHEN list_contains(tenants, tenant) THEN 'consistent' ELSE 'drift' END AS status FROM e LEFT JOIN s ON s.company = e.company")
def tenant_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as seven companies; of the declared ones the eighth has no tenant of its own, and the ninth is never seen."""
    seen = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 7).alias("company"), (F.col("l_partkey") % 3).alias("tenant"))
    declared = spark.range(9).select(F.col("id").alias("company"), F.when(F.col("id") != 7, F.col("id") % 4).alias("tenant"))
    return lookups.tenant_consistency(declared, seen)


@query("WITH a AS (SELECT l_partkey, l_suppkey, l_shipdate >= TIMESTAMP '1998-01-01' AS now FROM lineitem), g AS (SELECT l_partkey AS id, count(DISTINCT l_suppkey) AS companies, count(*) FILTER (WHERE now) AS n FROM a GROUP BY 1) SELECT id, companies FROM g WHERE n > 0 AND companies > 1")
def id_collisions_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.lit("p").alias("provider"), F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("company"), "l_shipdate")
    recent = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return lookups.id_collisions(rows.where(recent), rows.where(~recent)).select("id", F.size("companies").cast("long").alias("companies"))


@query("SELECT user_id AS job_id, arg_max(event_type, (ts, event_id)) AS status, count(*) AS events FROM (SELECT *, CASE event_type WHEN 'view' THEN 'saved' WHEN 'purchase' THEN 'applied' WHEN 'error' THEN 'rejected' END AS e FROM events) WHERE e IS NOT NULL GROUP BY 1".replace("arg_max(event_type,", "arg_max(e,"))
def application_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracker.status(log(spark, sf_dir)).select("job_id", "status", "events")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a log of applications."""
    kind = F.when(F.col("event_type") == "view", "saved").when(F.col("event_type") == "purchase", "applied").when(F.col("event_type") == "error", "rejected").otherwise("note")
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("message_id"), F.col("user_id").alias("job_id"), kind.alias("event_type"), "ts")


@query("WITH g AS (SELECT user_id AS job_id, max(ts) FILTER (WHERE event_type = 'purchase') AS applied, max(ts) AS last FROM events GROUP BY 1) SELECT job_id FROM g WHERE applied = last AND DATE '2024-03-01' - CAST(applied AS DATE) >= 10")
def application_followups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracker.followups(log(spark, sf_dir), F.lit("2024-03-01").cast("date")).select("job_id")


@query("WITH e AS (SELECT * FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-20' - 7 AND CAST(ts AS DATE) <= DATE '2024-01-20') SELECT count(*) AS events, count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS applied, count(DISTINCT CASE WHEN event_type = 'error' THEN user_id END) AS answered, round(count(DISTINCT CASE WHEN event_type = 'error' THEN user_id END) / count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END), 4) AS response_rate FROM e")
def application_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracker.weekly(log(spark, sf_dir), F.lit("2024-01-20").cast("date"))


@query("WITH r AS (SELECT o_custkey AS company, max(CAST(o_orderdate AS DATE)) AS rejected FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT company, rejected, rejected + 30 AS until, rejected + 30 >= DATE '2001-07-01' AS active FROM r")
def company_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("company"), F.to_date("o_orderdate").alias("rejected"))
    return tracker.guards(rows, F.lit("2001-07-01").cast("date"))


@query("WITH t AS (SELECT o_orderkey AS id, o_totalprice AS score FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 500) SELECT id, CASE WHEN id % 3 = 0 THEN 'new' WHEN id % 3 = 1 THEN 'seen' ELSE 'retry' END AS state FROM t")
def enrichment_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score"))
    records = rows.where("id % 3 <> 0").select("id", (F.col("id") % 3 == 1).alias("ok"))
    return enrichment.plan(rows, records, 500).select("id", "state")


@query("WITH v AS (SELECT user_id AS id, arg_max(event_type, (ts, event_id)) AS s FROM events GROUP BY 1) SELECT o_orderkey AS id, s AS liveness FROM orders LEFT JOIN v ON v.id = o_orderkey")
def liveness_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    verdicts = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("id")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("state"), F.max("ts").cast("timestamp").alias("checked_at"))
    return enrichment.merge_liveness(rows, verdicts, F.lit("2024-02-01").cast("timestamp")).select("id", "liveness")


@query("SELECT doc_id AS id FROM documents WHERE length(trim(text)) < 600 AND doc_id % 2 = 0")
def hydration_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = postings(spark, sf_dir).select("id", "description")
    return enrichment.candidates(rows, rows.where("id % 2 = 0")).select("id")


@query(f"{P} SELECT count(*) AS rows, count(title) AS titles, count(employment_type) AS types, round(count(employment_type) / count(*), 4) AS type_share FROM p")
def field_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spark, sf_dir).agg(F.count("*").alias("rows"), F.count("title").alias("titles"), F.count("employment_type").alias("types"), F.round(F.count("employment_type") / F.count("*"), 4).alias("type_share"))


@query()
def requirement_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every detector over every document."""
    t, d, e = F.col("title"), F.col("description"), F.col("employment_type")
    return postings(spark, sf_dir).select(
        "id", req.is_student_role(t, d, e).alias("student"), req.requires_master(t, d).alias("master"), req.requires_phd(t, d).alias("phd"), req.requires_citizenship(d).alias("citizenship"), req.requires_experience(d).alias("experience"), req.requires_native(d).alias("native"), req.requires_permit(d).alias("permit"),
        req.targets_graduates(d).alias("graduates"), req.longer_than(t).alias("long"), req.work_authorization(d).alias("authorization"), req.job_type(t, d).alias("job_type"), extract.deadline(d).alias("deadline"), extract.duration_months(d).alias("months"), extract.work_mode(F.lit(None).cast("boolean"), d).alias("mode"),
    )


TOKENS_SQL = f"regexp_extract_all({fold_sql('text')}, '[a-z0-9]+')"


@query(f"WITH i AS (SELECT item_id AS id, w, \"at\" FROM (SELECT item_id, unnest(t) AS w, unnest(range(len(t))) AS \"at\" FROM (SELECT item_id, {TOKENS_SQL} AS t FROM benchmark))), k AS (SELECT DISTINCT unnest({TOKENS_SQL}) AS w FROM documents), c AS (SELECT id, w, count(*) AS n, min(\"at\") AS \"at\" FROM i WHERE w NOT IN (SELECT w FROM k) GROUP BY id, w) SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, \"at\") AS place FROM c QUALIFY place <= 8")
def distinctive_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), similarity.words(F.col("text")).alias("words"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), similarity.words(F.col("text")).alias("words"))
    return similarity.distinctive(items, docs)


#: Words as operators.similarity.words has them, for the SQL twin.
TWIN_HOSTS = ("src1", "src2", "src7")
TWIN_SQL = f"""WITH d AS (SELECT doc_id, source IN {TWIN_HOSTS} AS ours, lang, list_distinct(regexp_extract_all({fold_sql('text')}, '[a-z0-9]+')) AS w FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL),
p AS (SELECT a.doc_id AS id, b.doc_id AS twin, len(list_intersect(a.w, b.w)) AS shared, len(a.w) + len(b.w) AS words FROM d a JOIN d b ON a.lang = b.lang AND a.ours AND NOT b.ours AND 2 * least(len(a.w), len(b.w)) >= greatest(len(a.w), len(b.w)))
SELECT id, min(twin) AS twin FROM p WHERE words = 0 OR 2 * shared >= words - shared GROUP BY id"""


@query(TWIN_SQL)
def official_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of three sources with a document of another that has half their words; all of a language have one title."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("host"), F.lit("title").alias("bag"), F.col("lang").alias("country_iso"), similarity.words(F.col("text")).alias("words"))
    return lookups.official_twins(docs, TWIN_HOSTS)


STRATA_SQL = """{first} AS (WITH s AS (SELECT source, count(*) AS size FROM {rows} GROUP BY source), a AS (SELECT *, least({total}, sum(size) OVER ()) AS want, sum(size) OVER () AS everything FROM s),
q AS (SELECT source, (want * size // everything)::BIGINT AS quota, want * size % everything AS rest, size, want FROM a),
k AS (SELECT source, quota + CASE WHEN rest > 0 AND row_number() OVER (ORDER BY rest DESC, size DESC, source NULLS LAST) <= want - sum(quota) OVER () THEN 1 ELSE 0 END AS quota FROM q)
SELECT d.doc_id, d.source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('1:' || doc_id), doc_id) AS n FROM {rows}) d JOIN k ON k.source IS NOT DISTINCT FROM d.source WHERE d.n <= k.quota)"""
SAMPLE_SQL = f"WITH {STRATA_SQL.format(first='one', rows='documents', total=150)}, rest AS (SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM one)), {STRATA_SQL.format(first='two', rows='rest', total=40)} SELECT doc_id, source, 'first' AS part FROM one UNION ALL SELECT doc_id, source, 'refill' FROM two"


@query(SAMPLE_SQL)
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """150 documents in proportion to their sources, and a refill of 40 that shares none with them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    first = stored(enrichment.stratified_sample(docs, "source", 150, "doc_id"), "sample")
    refill = enrichment.stratified_sample(docs, "source", 40, "doc_id", taken=first)
    return first.withColumn("part", F.lit("first")).unionByName(refill.withColumn("part", F.lit("refill")))
