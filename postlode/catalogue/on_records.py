"""Queries over records that stay between runs, registries, and what applications led to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.catalogue.base import query, spread, table
from postlode.catalogue.on_lookups import log
from postlode.catalogue.on_postings import SCORED, scored
from postlode.functions import applicability, keys, places
from postlode.operators import enrichment, filters, keyed, lookups, registry, scoring, snapshots, stores, tracker
from postlode.rules import first_reason
from postlode.shared import folder
from postlode.sources import boards as boards_of
from postlode.sources import readers

STATUS_SQL = "CASE event_type WHEN 'view' THEN 'saved' WHEN 'purchase' THEN 'applied' WHEN 'error' THEN 'rejected' ELSE 'note' END"


@query("SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(DISTINCT ts) AS runs FROM events GROUP BY 1")
def seen_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.seen_history(table(spark, sf_dir, "events"), "user_id", "ts")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1")
def latest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last record of each key, by time and then by number."""
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return stores.latest(rows, ["user_id"], ["ts", "event_id"]).select("user_id", "event_type", "value")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN -1.0::DOUBLE ELSE o_totalprice::DOUBLE END AS price FROM orders")
def store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store after the same fresh records came in twice."""
    known = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("double").alias("price"))
    fresh = known.where("id % 3 = 0").withColumn("price", F.lit(-1.0))
    return stores.upserted(stores.upserted(known, fresh, "id"), fresh, "id")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY 1")
def store_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed store after all events came in as three batches out of order of time, one of them twice."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts")
    kinds = F.coalesce("event_type", F.lit(""))
    batches = [events.where(kinds == "view"), events.where(kinds == "purchase"), events.where(~kinds.isin("view", "purchase"))]
    store = keyed.KeyedStore(folder(spark, "events"), ", ".join(f"{name} {kind}" for name, kind in events.dtypes), ("user_id",), ("ts", "event_id"))
    for batch in [*batches, batches[1]]:
        store.upsert(batch)
    return store.read(spark)


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 5 = 0")
def archived_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return stores.archived(known, known.where("id % 5 <> 0"), "id")


@query("SELECT count(*) AS n FROM events WHERE ts > (SELECT median(ts) FROM events)")
def new_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records after the one that was read last, here the middle one."""
    rows = table(spark, sf_dir, "events")
    last = rows.agg(F.median(F.unix_micros(F.col("ts").cast("timestamp"))).alias("last"))
    return stores.new_since(rows.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp"))).join(F.broadcast(last)), "at", F.col("last")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) WHEN o_orderkey % 3 = 0 THEN DATE '2020-01-01' END AS posted FROM orders")
def dates_carried_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of the run before where a run has none."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 2 == 0, F.to_date("o_orderdate")).alias("posted"))
    before = rows.where("id % 3 = 0").select("id", F.lit("2020-01-01").cast("date").alias("posted"))
    return stores.previous_dates(rows, before, "id", ["posted"])


@query("SELECT event_type AS kind, count(*) AS n, count(*) FILTER (WHERE value >= 5) AS ok, round(count(*) FILTER (WHERE value >= 5) / count(*), 4) AS share FROM events GROUP BY 1")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), (F.col("value") >= 5).alias("ok"))
    return stores.summary(rows)


@query(f"WITH e AS (SELECT user_id AS job_id, ts, {STATUS_SQL} AS s FROM events), f AS (SELECT job_id, max(ts) FILTER (WHERE s = 'applied') AS applied, max(ts) FILTER (WHERE s = 'rejected') AS heard FROM e GROUP BY 1) SELECT job_id, CASE WHEN heard >= applied THEN 'answered' WHEN DATE '2024-02-08' - CAST(applied AS DATE) >= 10 THEN 'overdue' ELSE 'waiting' END AS state, DATE '2024-02-08' - CAST(applied AS DATE) AS waiting FROM f WHERE applied IS NOT NULL")
def response_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracker.response_status(log(spark, sf_dir), F.lit("2024-02-08").cast("date"))


@query(f"{SCORED}, r AS (SELECT id, row_number() OVER (ORDER BY score DESC, lower(title), lower(company), id) AS rank FROM s), e AS (SELECT user_id AS id, arg_max(s, (ts, event_id)) AS status FROM (SELECT *, {STATUS_SQL} AS s FROM events) WHERE s <> 'note' GROUP BY 1) SELECT CASE WHEN rank <= 10 THEN 10 WHEN rank <= 30 THEN 30 WHEN rank <= 100 THEN 100 END AS band, count(*) AS n, count(*) FILTER (WHERE status IN ('applied', 'rejected')) AS applied, count(*) FILTER (WHERE status = 'rejected') AS answered FROM r LEFT JOIN e ON e.id = r.id WHERE rank <= 100 GROUP BY 1")
def ranking_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far down the ranking applications and answers come from."""
    top = scoring.top_capped(scored(spark, sf_dir).drop("description", "score_breakdown"), per_company=10**9)
    return tracker.feedback(top.select(F.col("id").alias("job_id"), "rank"), tracker.status(log(spark, sf_dir)))


@query("WITH a AS (SELECT doc_id, DATE '2024-01-01' - (DATE '2024-01-01' - CAST(doc_id % 700 AS INTEGER)) AS age FROM documents) SELECT CASE WHEN age <= 7 THEN 7 WHEN age <= 30 THEN 30 WHEN age <= 90 THEN 90 WHEN age <= 365 THEN 365 END AS band, count(*) AS n FROM a GROUP BY 1")
def freshness_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(tracker.freshness_bands(F.col("doc_id") % 700).alias("band"))
    return rows.groupBy("band").agg(F.count("*").alias("n"))


@query("WITH c AS (SELECT o_orderkey AS id, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0), t AS (SELECT id FROM c ORDER BY o_totalprice DESC, id LIMIT 200) SELECT count(*) AS n, count(*) FILTER (WHERE id % 5 = 1) AS new FROM t")
def top_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    return snapshots.new_among_top(rows.where("id % 5 <> 0"), rows.where("id % 5 <> 1"), "id", [F.desc("o_totalprice"), F.asc("id")], 200)


@query("WITH k AS (SELECT l_partkey, max((l_suppkey % 3 = 0)::INT) AS own, count(DISTINCT l_suppkey % 3) AS sources FROM lineitem GROUP BY 1) SELECT count(*) AS n, count(*) FILTER (WHERE sources = 1) AS alone FROM k WHERE own = 1")
def only_one_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that one group of suppliers has, and those that it alone has."""
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_suppkey") % 3).cast("string").alias("source"))
    return snapshots.only_in(rows, "0", "l_partkey")


def boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as companies on boards: two words and a slug that has one of them, or not."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("b"), k % 3).alias("ats"), F.when(k % 2 == 0, F.concat(F.lit("acme"), k % 20, F.lit("-jobs"))).otherwise(F.concat(F.lit("x"), k)).alias("slug"), F.concat(F.lit("Acme"), k % 20, F.lit(" Works "), k).alias("name"))


@query("WITH b AS (SELECT 'b' || s_suppkey % 3 AS ats, CASE WHEN s_suppkey % 2 = 0 THEN 'acme' || s_suppkey % 20 || '-jobs' ELSE 'x' || s_suppkey END AS slug, 'Acme' || s_suppkey % 20 || ' Works ' || s_suppkey AS name, s_suppkey AS k FROM supplier), q AS (SELECT 'acme' || i AS query FROM range(20) r(i) UNION ALL SELECT 'X' || i FROM range(1, 40) r(i)), e AS (SELECT query, ats, slug, min(name) AS name, 'exact' AS kind FROM q JOIN b ON lower(query) = slug OR lower(query) = lower(name) GROUP BY ALL), t AS (SELECT query, ats, slug, min(name) AS name, 'token' AS kind FROM q JOIN b ON k % 2 = 0 AND query = 'acme' || k % 20 WHERE query NOT IN (SELECT query FROM e) GROUP BY ALL) SELECT * FROM e UNION ALL SELECT * FROM t")
def registry_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that are a slug, and names that are a word of both name and slug."""
    words = spark.range(20).select(F.concat(F.lit(" acme"), "id").alias("query"))
    return registry.find(words.unionByName(spark.range(1, 40).select(F.concat(F.lit("X"), "id").alias("query"))), boards(spark, sf_dir))


@query("SELECT ats, CASE ats WHEN 'b0' THEN 'missing_rule' WHEN 'b9' THEN 'rule_without_entry' ELSE 'covered' END AS state FROM (SELECT DISTINCT 'b' || s_suppkey % 3 AS ats FROM supplier UNION SELECT 'b9')")
def registry_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([("b1",), ("b2",), ("b9",)], "ats string")
    return registry.coverage(boards(spark, sf_dir), rules)


@query("SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0 THEN n_name END AS entry FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def registry_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    known = registry.enabled(nation.select(F.col("n_name").alias("name"), (F.col("n_nationkey") % 2 == 0).alias("enabled")))
    rows = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.concat(F.lit(" "), F.upper("n_name")).alias("company"))
    return registry.resolved(rows, known).select("s_suppkey", "entry")


@query("WITH l AS (SELECT o_custkey AS company, max(CAST(o_orderdate AS DATE)) AS d FROM orders GROUP BY 1) SELECT company, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS tenants FROM orders JOIN l ON company = o_custkey AND CAST(o_orderdate AS DATE) = d GROUP BY 1")
def latest_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last run of each company saw; orders are its runs."""
    runs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("company"), F.to_date("o_orderdate").alias("at"), F.col("o_orderstatus").alias("tenant"))
    return registry.latest_tenants(runs).select("company", F.array_join("tenants", ",").alias("tenants"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'unreachable' WHEN event_type = 'click' AND value > 50 THEN 'stale_404_live_api' WHEN event_type = 'click' THEN 'http_not_found' WHEN event_type = 'view' AND value > 10 THEN 'valid' WHEN event_type = 'view' THEN 'branded_shell_no_jobs' ELSE 'http_error' END AS verdict FROM events")
def board_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as answers of boards: errors without one, 404, 200, and 403."""
    kind, value = F.col("event_type"), F.col("value")
    status = F.when(kind == "error", 0).when(kind == "click", 404).when(kind == "view", 200).otherwise(403)
    jobs = F.when((kind == "click") & (value > 50) | (kind == "view") & (value > 10), 3).otherwise(0)
    return table(spark, sf_dir, "events").select("event_id", keys.board_verdict(status, jobs, F.when(kind == "error", "timeout")).alias("verdict"))


WORLD = [("Lyon, France", "fr"), ("Tokio (Japan)", "jp"), ("Brasilien - Recife", "br"), ("US, MA, Chelmsford", "us"), ("Oslo, Norway", "no"), ("Neckarsulm, DE", "de"), ("Remseck am Neckar", None), ("Nairobi, Kenia", "ke"), ("Accra, Ghana", "gh"), ("", None)]


@query(f"SELECT o_orderkey AS id, ([{', '.join('NULL' if c is None else repr(c) for _, c in WORLD)}])[(o_orderkey % {len(WORLD)})::INT + 1] AS iso FROM orders")
def country_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries of ISO 3166 by their English and German names; the verdicts are stated by hand."""
    names, none = places.iso_countries(spark), F.lit(None).cast("string")
    where = F.get(F.array(*[F.lit(p) for p, _ in WORLD]), (F.col("o_orderkey") % len(WORLD)).cast("int"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), places.infer_country(where, none, none, names).alias("iso"))


@query("WITH r AS (SELECT doc_id AS id, doc_id % 50 AS rank FROM documents), n AS (SELECT rank, count(*) AS n FROM r GROUP BY 1) SELECT id, 'label' AS error FROM r WHERE id % 7 = 0 UNION ALL SELECT id, 'justification' FROM r WHERE id % 5 = 0 UNION ALL SELECT id, 'rank' FROM r WHERE rank < 1 UNION ALL SELECT id, 'rank_repeats' FROM r JOIN n USING (rank) WHERE n > 1 UNION ALL SELECT id, 'breakdown' FROM r WHERE id % 11 = 0")
def benchmark_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled ranking with unknown labels, missing reasons, repeated ranks, and scores that do not add up."""
    k = F.col("doc_id")
    parts = F.create_map(F.lit("a"), F.lit(1.0), F.lit("b"), F.when(k % 11 == 0, 3.0).otherwise(2.0))
    rows = table(spark, sf_dir, "documents").select(k.alias("id"), (k % 50).alias("rank"), F.when(k % 7 == 0, "odd").otherwise("good").alias("label"), F.when(k % 5 == 0, " ").otherwise("why").alias("justification"), F.lit(3.0).alias("score"), parts.alias("score_breakdown"))
    return enrichment.violations(rows, ["good", "bad"])


@query("SELECT o_orderkey AS id, o_totalprice::DOUBLE AS score FROM orders WHERE o_orderkey % 4 = 0 AND o_orderkey % 3 <> 0 ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def blind_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as postings: every fourth has no description, every third is shown."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("double").alias("score"), F.when(F.col("o_orderkey") % 4 == 0, " ").otherwise("text").alias("description"))
    return enrichment.blind_candidates(rows, rows.where("id % 3 = 0"), 100).select("id", "score")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'german_required' END ELSE 'old' END AS reason FROM orders")
def reasons_reassessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second posting has a new description, and its reason is found again."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit("Intern").alias("title"), F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("employment_type"), F.lit(None).cast("date").alias("posted_at"), F.lit("old").alias("reason"))
    changed = rows.where("id % 2 = 0").select("id", F.when(F.col("id") % 3 == 0, "Fluent German is required.").otherwise("You learn much.").alias("description"))
    return enrichment.reassessed(rows, changed, first_reason(applicability.ladder(F.lit("2024-01-01").cast("date")))).select("id", "reason")


@query("WITH a AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS s, o_orderpriority AS p FROM orders WHERE o_orderkey % 5 <> 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 > 0 THEN lower(o_orderstatus) END AS s, CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE o_orderpriority END AS p FROM orders WHERE o_orderkey % 5 <> 1), j AS (SELECT a.s AS s1, b.s AS s2, a.p AS p1, b.p AS p2 FROM a FULL JOIN b ON a.k = b.k), f AS (SELECT 'status' AS field, s1 AS x, s2 AS y FROM j UNION ALL SELECT 'priority', p1, p2 FROM j) SELECT field, CASE WHEN x IS NULL AND y IS NULL THEN 'neither' WHEN y IS NULL THEN 'only_first' WHEN x IS NULL THEN 'only_second' WHEN lower(trim(x)) = lower(trim(y)) THEN 'match' ELSE 'conflict' END AS relation, count(*) AS n FROM f GROUP BY 1, 2")
def readings_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two readings of the same fields, some missing, some different, some of one side alone."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    first = rows.where("k % 5 <> 0").withColumn("status", F.when(F.col("k") % 3 > 0, F.col("status")))
    second = rows.where("k % 5 <> 1").withColumns({"status": F.when(F.col("k") % 4 > 0, F.lower("status")), "priority": F.when(F.col("k") % 7 == 0, "x").otherwise(F.col("priority"))})
    return enrichment.compared(first, second, "k", ["status", "priority"])


@query("SELECT n_name AS company, count(*) AS n FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_nationkey % 3 > 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def missing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as employers: every third has a score, another third one that is none."""
    nation = table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("company"))
    raw = F.when(F.col("n_nationkey") % 3 == 0, "4.2").when(F.col("n_nationkey") % 3 == 1, "9")
    return lookups.missing_quality(rows, nation.select(F.upper("n_name").alias("company"), lookups.quality_score(raw).alias("score")))


@query("SELECT o_orderkey AS id, DATE '2001-01-01' - CAST(o_orderdate AS DATE) AS age FROM orders WHERE o_orderkey % 10 > 0 AND DATE '2001-01-01' - CAST(o_orderdate AS DATE) > 700 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 10 = 0")
def stale_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 10 > 0, F.to_date("o_orderdate")).alias("checked"))
    return lookups.stale_entries(dim, "checked", F.lit("2001-01-01").cast("date"), 700).select("id", "age")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'New York Steel' WHEN o_orderkey % 3 = 0 THEN 'York' WHEN o_orderkey % 5 = 0 THEN 'Steel' END AS known FROM orders")
def known_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest known name that is a whole word of a name: two words, one, or none; a part of a word never counts."""
    k = F.col("o_orderkey")
    named = F.when(k % 2 == 0, "The New York Steel Ltd").when(k % 3 == 0, "Old York Works").when(k % 5 == 0, "steel").otherwise("Yorkshire Steelworks")
    rows = table(spark, sf_dir, "orders").select(k.alias("id"), named.alias("company"))
    known = spark.createDataFrame([("York",), ("New York Steel",), ("Steel",), ("",)], "name string")
    return lookups.by_name(rows, "company", known, "name").select("id", "known")


@query("SELECT page_id AS id, CASE WHEN page_id % 3 = 0 THEN page_id % 2 = 0 WHEN page_id % 3 = 1 THEN TRUE END AS plausible FROM pages")
def plausible_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    provider, value = F.when(k % 3 == 0, "a").when(k % 3 == 1, "b").otherwise("c"), F.when(k % 2 == 0, F.concat(F.lit("R-"), k)).otherwise(F.concat(F.lit("x"), k))
    return table(spark, sf_dir, "pages").select(k.alias("id"), filters.plausible_id(provider, value, {"a": r"^R-\d+$", "b": r"^\S+$"}).alias("plausible"))


@query("WITH c AS (SELECT o_orderkey AS id, o_totalprice AS score, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 5 <> 0) SELECT id, CASE WHEN id % 5 = 1 THEN 'new' WHEN id % 2 = 0 AND score / 2 < 150000 THEN 'risen' ELSE 'deadline' END AS event FROM c WHERE score >= 150000 AND (id % 5 = 1 OR (id % 2 = 0 AND score / 2 < 150000) OR d - DATE '1998-01-01' BETWEEN 0 AND 200)")
def radar_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as postings: new ones, ones whose score doubled, ones whose day is near."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("double").alias("score"), F.to_date("o_orderdate").alias("deadline"))
    before = rows.where("id % 5 <> 1").withColumn("score", F.when(F.col("id") % 2 == 0, F.col("score") / 2).otherwise(F.col("score")))
    return snapshots.radar(rows.where("id % 5 <> 0"), before, "id", 150_000, 200, F.lit("1998-01-01").cast("date"))


@query("SELECT o_orderkey AS id FROM orders ORDER BY CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END DESC NULLS LAST, CAST(o_orderdate AS DATE) DESC, o_orderkey LIMIT 50")
def budget_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice")).alias("score"), F.to_date("o_orderdate").alias("added"))
    return rows.orderBy(*snapshots.budget_order()).limit(50).select("id")


#: An item of each board by the order's number: the fields differ, the posting is the same.
ITEMS = [
    '{"referenznummer":"R%1$d","stellenangebotsTitel":" Praktikum %1$d ","firma":"Co%2$d","arbeitszeitVollzeit":true,"datumErsteVeroeffentlichung":"%3$s","stellenlokationen":[{"adresse":{"plz":"10115","ort":"Berlin","land":"DEUTSCHLAND"}}]}',
    '{"id":"R%1$d","title":"Praktikum %1$d","employer":{"name":"Co%2$d"},"creationDate":%4$d,"locationMap":{"FR":["Lyon","Paris"]},"translations":{"en":{"description":"<b>Text</b>"}}}',
    '{"slug":"R%1$d","title":"Praktikum %1$d","company_name":"Co%2$d","remote":true,"created_at":%5$d,"job_types":["INTERN"],"location":"Bonn"}',
    '{"slug":"R%1$d","position":"Praktikum %1$d","company":"Co%2$d","date":"%3$sT00:00:00Z","location":"Madrid, Spain"}',
    '{"public_slug":"R%1$d","title":"Praktikum %1$d","company":"Co%2$d","countries":["AT"],"posted_at":"%3$s","location":"Wien"}',
    '{"id_icims":"R%1$d","title":"Praktikum %1$d","company_name":"Co%2$d","job_path":"/en/jobs/%1$d","country_code":"DEU","posted_date":"%6$s"}',
    '{"legal":"no position %1$d"}',
]


@query("SELECT o_orderkey AS k, (['direct:bundesagentur','direct:eures','arbeitnow','remoteok','freehire','amazon_jobs'])[(o_orderkey % 7)::INT + 1] AS source, 'Co' || o_custkey AS company, 'R' || o_orderkey AS external_id, (['10115 Berlin, Deutschland','FR (Lyon, Paris)','Bonn','Madrid, Spain','Wien',NULL])[(o_orderkey % 7)::INT + 1] AS location, (['de','fr','de','es','at','de'])[(o_orderkey % 7)::INT + 1] AS country_iso, (['FULL_TIME',NULL,'INTERN',NULL,NULL,NULL])[(o_orderkey % 7)::INT + 1] AS employment_type, CAST(o_orderdate AS DATE) AS posted FROM orders WHERE o_orderkey % 7 < 6")
def board_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items in the shapes of six boards, read by each board's map; the seventh is a note that is no posting."""
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    seconds = F.unix_date(day) * F.lit(86_400).cast("long")
    filled = F.array(*[F.format_string(t, k, "o_custkey", F.date_format(day, "yyyy-MM-dd"), seconds * 1000, seconds, F.date_format(day, "MMMM d, yyyy")) for t in ITEMS])
    rows = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey").select((k % 7).alias("kind"), F.get(filled, (k % 7).cast("int")).alias("item"))
    parts = [readers.posting(rows.where(F.col("kind") == i), fields(F.col("item")), F.lit(source)) for i, (source, (fields, _)) in enumerate(boards_of.JSON_BOARDS.items())]
    notes = readers.posting(rows.where("kind = 6"), boards_of.remoteok(F.col("item")), F.lit("remoteok"))
    whole = readers.union(*parts, notes)
    return whole.select(F.regexp_extract("title", r"(\d+)$", 1).cast("long").alias("k"), "source", "company", "external_id", "location", "country_iso", "employment_type", F.to_date("posted_at").alias("posted"))
