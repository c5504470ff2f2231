"""Queries over events, orders, pages and conversations: series, snapshots, lifecycles, logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.catalogue.base import query, table
from postlode.operators import health, scoring, snapshots, tracker
from postlode.sources import readers

RUNS = "WITH r AS (SELECT user_id AS series, ts AS tm, event_id, CASE WHEN event_type = 'error' THEN 'error' WHEN value < 5 THEN 'empty' ELSE 'ok' END AS status, CAST(floor(value) AS BIGINT) AS collected FROM events)"


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as runs of series: an error fails, a small value is an empty run."""
    status = F.when(F.col("event_type") == "error", "error").when(F.col("value") < 5, "empty").otherwise("ok")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("series"), F.col("ts").cast("timestamp").alias("at"), "event_id", status.alias("status"), F.floor("value").cast("long").alias("collected"))


LAST = f"{RUNS}, w AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY tm DESC, event_id DESC) AS back, sum(CASE WHEN status = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY series ORDER BY tm DESC, event_id DESC ROWS UNBOUNDED PRECEDING) AS fine_after, CASE WHEN status = 'ok' THEN sum(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY series ORDER BY tm DESC, event_id DESC ROWS UNBOUNDED PRECEDING) END AS ok_back FROM r), g AS (SELECT series, count(*) AS runs, count(*) FILTER (WHERE status = 'ok') AS ok_runs, max(tm) AS last_at, max(status) FILTER (WHERE back = 1) AS last_status, max(collected) FILTER (WHERE ok_back = 1) AS last_ok_collected, list_sort(list(collected) FILTER (WHERE status = 'ok' AND ok_back > 1)) AS h, count(*) FILTER (WHERE back > 1 AND status = 'ok') AS prior_ok, count(*) FILTER (WHERE back > 1 AND status = 'ok' AND collected > 0) AS prior_filled, count(*) FILTER (WHERE fine_after = 0) AS failures FROM w GROUP BY series), m AS (SELECT *, h[len(h) // 2 + 1] AS prior_median, date_diff('second', last_at, (SELECT max(tm) FROM r)) / 3600.0 > 36 AS stale FROM g)"
ALERTS = {"drop": "ok_runs > 3 AND prior_median > 0 AND last_ok_collected / prior_median < 0.5", "zero_return": "last_status = 'empty' AND prior_filled >= 3", "regression": "last_status = 'error' AND prior_ok >= 3", "recurring_error": "failures >= 2"}


@query(f"{LAST} SELECT series, runs, ok_runs, last_status, prior_median, last_ok_collected, failures, CASE WHEN stale THEN 'stale' ELSE array_to_string(list_filter([{', '.join(f'CASE WHEN {c} THEN {chr(39)}{n}{chr(39)} END' for n, c in ALERTS.items())}], lambda x: x IS NOT NULL), ',') END AS alerts FROM m")
def series_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = health.alerts(health.last_runs(runs(spark, sf_dir), "series", ["at", "event_id"]))
    return found.select("series", "runs", "ok_runs", "last_status", "prior_median", "last_ok_collected", "failures", F.array_join("alerts", ",").alias("alerts"))


def _alert(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = health.alerts(health.last_runs(runs(spark, sf_dir), "series", ["at", "event_id"]))
        return found.where(F.array_contains("alerts", name)).select("series", "runs")

    run.__name__ = f"series_{name}"
    query(f"{LAST} SELECT series, runs FROM m WHERE " + ("stale" if name == "stale" else f"NOT stale AND {ALERTS[name]}"))(run)


for _name in (*ALERTS, "stale"):
    _alert(_name)


@query(f"{RUNS} SELECT series, count(*) AS runs, count(*) FILTER (WHERE status = 'ok') AS ok_runs, arg_max(status, (tm, event_id)) AS last_status, round(avg(collected) FILTER (WHERE status = 'ok'), 2) AS avg_ok FROM r GROUP BY series")
def series_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.summary(runs(spark, sf_dir), "series", ["at", "event_id"])


@query("WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1), w AS (SELECT *, lag(n, 6) OVER (ORDER BY day) AS nb, lag(errors, 6) OVER (ORDER BY day) AS eb FROM d) SELECT day, n, nb AS n_before, n - nb AS n_change, errors, eb AS errors_before, errors - eb AS errors_change FROM w ORDER BY day DESC LIMIT 1")
def run_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return health.drift(days, "day", ["n", "errors"])


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS records, sum(CAST(floor(value) AS BIGINT))::BIGINT AS sum_units FROM events GROUP BY 1, 2")
def metrics_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("units", F.floor("value").cast("long"))
    return health.rollup(rows, F.to_date("ts"), "event_type", ["units"])


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, count(*) AS events FROM events WHERE event_type <> 'click' GROUP BY user_id")
def event_replay_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where("event_type <> 'click'")
    return rows.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("status"), F.count("*").alias("events"))


@query("WITH e AS (SELECT *, CAST(ts AS DATE) AS d FROM events), m AS (SELECT max(d) AS last FROM e) SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM e, m WHERE d > last - 7 GROUP BY event_type")
def weekly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))
    last = events.agg(F.max("d").alias("last"))
    return events.join(F.broadcast(last)).where(F.col("d") > F.date_sub("last", 7)).groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("SELECT event_type, CASE WHEN age <= 7 THEN 'week' WHEN age <= 14 THEN 'fortnight' WHEN age <= 28 THEN 'month' ELSE 'old' END AS cadence, count(*) AS n FROM (SELECT event_type, DATE '2024-01-31' - CAST(ts AS DATE) AS age FROM events) GROUP BY 1, 2")
def cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = tracker.cadence(F.to_date("ts"), F.lit("2024-01-31").cast("date"))
    return table(spark, sf_dir, "events").groupBy("event_type", sent.alias("cadence")).agg(F.count("*").alias("n"))


@query("WITH f AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'F'), o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'O'), j AS (SELECT o.o_orderkey, o.d, max(f.d) AS latest FROM o LEFT JOIN f ON f.k = o.o_custkey AND f.d <= o.d GROUP BY 1, 2) SELECT o_orderkey, CASE WHEN d - latest <= 30 THEN latest END AS guard FROM j")
def asof_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each open order the customer's latest finished one on or before its day, if it is at most 30 days old."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("d"))
    left, right = orders.where("o_orderstatus = 'O'").select("o_orderkey", "k", "d"), orders.where("o_orderstatus = 'F'").select("k", F.col("d").alias("done"))
    return snapshots.asof_latest(left, right, "k", "d", "done", 30).select("o_orderkey", F.col("latest").alias("guard"))


@query("SELECT o_orderkey, round(CASE WHEN age <= 0 THEN 1.0 ELSE pow(0.5, least(age, 3650) / 365.0) END, 6) AS freshness FROM (SELECT o_orderkey, DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS age FROM orders)")
def freshness_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(scoring.freshness(day, F.lit("2002-01-01 00:00:00").cast("timestamp")), 6).alias("freshness"))


SNAPSHOTS = "WITH c AS (SELECT o_orderkey AS id, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0), v AS (SELECT o_orderkey AS id, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 5 <> 1)"


def two(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", "o_totalprice", "o_orderstatus")
    return rows.where("id % 5 <> 0"), rows.where("id % 5 <> 1")


@query(f"{SNAPSHOTS} SELECT id, 'new' AS change FROM c WHERE id NOT IN (SELECT id FROM v) UNION ALL SELECT id, 'gone' FROM v WHERE id NOT IN (SELECT id FROM c)")
def snapshot_new_gone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.new_and_gone(*two(spark, sf_dir), "id")


@query(f"{SNAPSHOTS} SELECT id, o_custkey IN (SELECT o_custkey FROM v) AS reseen FROM c WHERE id NOT IN (SELECT id FROM v)")
def snapshot_reseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.reseen(*two(spark, sf_dir), "id", "o_custkey").select("id", "reseen")


@query(f"{SNAPSHOTS}, a AS (SELECT id, row_number() OVER (ORDER BY o_totalprice DESC, id) AS now FROM c QUALIFY now <= 30), b AS (SELECT id, row_number() OVER (ORDER BY o_totalprice DESC, id) AS was FROM v QUALIFY was <= 30) SELECT coalesce(a.id, b.id) AS id, was, now, CASE WHEN was IS NULL THEN 'entered' WHEN now IS NULL THEN 'exited' ELSE 'moved' END AS change FROM a FULL JOIN b ON a.id = b.id WHERE was IS NULL OR now IS NULL OR abs(was - now) >= 5")
def top_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.movers(*two(spark, sf_dir), "id", [F.desc("o_totalprice"), F.asc("id")])


@query(f"{SNAPSHOTS} SELECT coalesce(c.id, v.id) AS id, coalesce(c.o_totalprice, v.o_totalprice) AS o_totalprice, CASE WHEN v.id IS NULL THEN DATE '2024-01-02' ELSE DATE '2024-01-01' END AS first_seen, CASE WHEN c.id IS NULL THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END AS last_seen, c.id IS NOT NULL AS active FROM v FULL JOIN c ON c.id = v.id")
def lifecycle_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, previous = two(spark, sf_dir)
    day = lambda d: F.lit(d).cast("date")
    known = previous.select("id", "o_totalprice", day("2024-01-01").alias("first_seen"), day("2024-01-01").alias("last_seen"), F.lit(True).alias("active"))
    return snapshots.merge_lifecycle(known, current, "id", day("2024-01-02"), ["o_totalprice"])


@query("SELECT c_custkey, max(CASE WHEN contains(lower(c_name), lower(x)) THEN 1.0 ELSE 0.0 END)::DOUBLE AS interest FROM customer, (SELECT unnest(['r#00000001', 'R#0000002', '7', 'absent']) AS x) GROUP BY c_custkey")
def company_interest_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a customer's name holds one of the listed names: a short list is an array, not a join."""
    names = F.array(*[F.lit(x.lower()) for x in ("r#00000001", "R#0000002", "7", "absent")])
    return table(spark, sf_dir, "customer").select("c_custkey", F.when(F.exists(names, lambda x: F.contains(F.lower("c_name"), x)), 1.0).otherwise(0.0).alias("interest"))


@query("WITH v AS (SELECT o_custkey, count(*) AS volume FROM orders GROUP BY 1) SELECT c_custkey, n_name, volume, c_acctbal FROM v JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal > 5000 AND volume >= 10 ORDER BY volume DESC, c_acctbal DESC, c_custkey LIMIT 50")
def sweet_spot(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("volume")).where("volume >= 10")
    good = table(spark, sf_dir, "customer").where("c_acctbal > 5000")
    joined = volume.join(good, F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", "n_name", "volume", "c_acctbal").orderBy(F.desc("volume"), F.desc("c_acctbal"), "c_custkey").limit(50)


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS owners, min(l_suppkey) AS first_owner FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1")
def id_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part ids that several suppliers use."""
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("owners"), F.min("l_suppkey").alias("first_owner")).where("owners > 1")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def followup_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select("o_orderkey").join(returned, "o_orderkey", "left_anti")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(100.0 * count(*) FILTER (WHERE l_tax > 0) / count(*), 2) AS taxed_percent, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus))")
def coverage_two_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill rates by two independent groupings in one pass."""
    rows = table(spark, sf_dir, "lineitem")
    sets = rows.groupingSets([[F.col("l_returnflag")], [F.col("l_linestatus")]], F.col("l_returnflag"), F.col("l_linestatus"))
    return sets.agg(F.count("*").alias("n"), F.round(100.0 * F.count_if(F.col("l_tax") > 0) / F.count("*"), 2).alias("taxed_percent"), F.count_distinct("l_suppkey").alias("suppliers"))


@query("SELECT conv_id, count(*) AS messages, count(*) FILTER (WHERE role = 'user') AS from_user, CASE WHEN max(CASE WHEN regexp_matches(text, '(?i)\\b(?:error|sorry|cannot)\\b') THEN 1 ELSE 0 END) = 1 THEN 'refused' WHEN max(turn) >= 4 THEN 'long' ELSE 'short' END AS kind, arg_max(role, turn) AS last_role FROM conversations GROUP BY conv_id")
def message_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = F.max(F.when(F.col("text").rlike(r"(?i)\b(?:error|sorry|cannot)\b"), 1).otherwise(0)) == 1
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("messages"), F.count_if(F.col("role") == "user").alias("from_user"), F.when(refused, "refused").when(F.max("turn") >= 4, "long").otherwise("short").alias("kind"), F.max_by("role", "turn").alias("last_role"))


@query("SELECT page_id, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS title FROM pages")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", readers.html_title(F.col("html")).alias("title"))


@query("WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href=\"[^\"]*\"[^>]*>.*?</a>')) AS t FROM pages) SELECT page_id, regexp_extract(t, '(?is)href=\"([^\"]*)\"', 1) AS href, trim(regexp_replace(t, '(?s)<[^>]*>', '', 'g')) AS text FROM a")
def link_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.inline(readers.links(F.col("html"))))


ENTITY_SQL = "regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<head\\b.*?</head\\s*>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
for _entity, _sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
    ENTITY_SQL = f"replace({ENTITY_SQL}, '{_entity}', '{_sign}')"


@query(f"SELECT page_id, trim(regexp_replace({ENTITY_SQL}, '[\\s\\x0B]+', ' ', 'g')) AS text FROM pages")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", readers.html_text(F.col("html")).alias("text"))


@query("SELECT page_id, sha256(html) AS content_hash, CASE WHEN page_id % 4 = 0 THEN 'new' WHEN page_id % 4 = 1 THEN 'changed' ELSE 'seen' END AS state FROM pages")
def change_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages against the stored hashes of an earlier run, of which a quarter is missing and a quarter differs."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.sha2("html", 256).alias("content_hash"))
    stored = pages.where("page_id % 4 <> 0").select("page_id", F.when(F.col("page_id") % 4 == 1, F.lit("old")).otherwise(F.col("content_hash")).alias("stored"))
    state = F.when(F.col("stored").isNull(), "new").when(F.col("stored") != F.col("content_hash"), "changed").otherwise("seen")
    return pages.join(stored, "page_id", "left").select("page_id", "content_hash", state.alias("state"))
