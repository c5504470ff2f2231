"""Streams over events and orders that land in turns, each held against a batch over all of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.catalogue.base import query, table
from postlode.catalogue.on_lookups import log
from postlode.operators import stores
from postlode.shared import folder
from postlode.streaming import ledger, states

#: The turns in which events land: before, between and after these days.
TURNS = ("2024-01-11", "2024-01-21")


def by_turns(rows: DataFrame, at: str) -> list[DataFrame]:
    """rows in three parts by time."""
    first, second = (F.lit(d).cast("timestamp") for d in TURNS)
    return [rows.where(F.col(at) < first), rows.where((F.col(at) >= first) & (F.col(at) < second)), rows.where(F.col(at) >= second)]


def in_turns(turns: Sequence[DataFrame], run: Callable[[DataFrame], DataFrame], key: Sequence[str] | None) -> DataFrame:
    """What a stream tells that starts anew from its checkpoint for each part that lands: the last row of each key, or all rows if no key is given."""
    spark = turns[0].sparkSession
    source, checkpoint, target = (folder(spark, name) for name in ("landed", "stream", "told"))
    beside, schema = states.stateful(spark), ", ".join(f"{name} {kind}" for name, kind in turns[0].dtypes)
    for number, turn in enumerate(turns):
        turn.write.parquet(f"{source}/turn={number}")
        stream = run(ledger.read_runs(beside, source, schema, files_at_once=100_000))
        ledger.changes(stream, target, checkpoint).start().awaitTermination()
    found = spark.read.schema(stream.schema).parquet(target)
    return stores.latest(found, key, ["version"]) if key else found


@query(
    "WITH r AS (SELECT o_orderkey AS id, o_totalprice, TIMESTAMP '2024-01-01' AS seen FROM orders WHERE o_orderkey % 5 <> 1 "
    "UNION ALL SELECT o_orderkey, o_totalprice, TIMESTAMP '2024-01-02' FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT o_orderkey, o_totalprice, TIMESTAMP '2024-01-03' FROM orders WHERE o_orderkey % 7 <> 0) "
    "SELECT id, max_by(o_totalprice, seen) AS o_totalprice, min(seen) AS first_seen, max(seen) AS last_seen, max(seen) = TIMESTAMP '2024-01-03' AS active FROM r GROUP BY id"
)
def stream_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in three runs, of which each leaves some out: gone ones by a timer, those that come back active again."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    left_out = {"2024-01-01": "id % 5 <> 1", "2024-01-02": "id % 5 <> 0", "2024-01-03": "id % 7 <> 0"}
    turns = [orders.where(kept).withColumn("at", F.lit(day).cast("timestamp")) for day, kept in left_out.items()]
    return in_turns(turns, lambda rows: states.lifecycles(rows, "id", "at", ["o_totalprice"]), ["id"]).drop("version")


@query(
    "WITH e AS (SELECT user_id AS job_id, event_id, ts, CASE event_type WHEN 'view' THEN 'saved' WHEN 'purchase' THEN 'applied' WHEN 'error' THEN 'rejected' ELSE 'note' END AS kind FROM events), "
    "g AS (SELECT job_id, arg_max(kind, (ts, event_id)) FILTER (WHERE kind <> 'note') AS status, max(ts) FILTER (WHERE kind <> 'note') AS since, count(*) FILTER (WHERE kind <> 'note') AS events, max(ts) FILTER (WHERE kind = 'applied') AS applied, max(ts) AS last FROM e GROUP BY 1) "
    "SELECT job_id, status, since, events, applied, coalesce(applied = last AND applied + INTERVAL 24 HOUR < (SELECT max(ts) FROM e) - INTERVAL 1 HOUR, false) AS overdue FROM g"
)
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log that lands in three turns: each job's status, and whether an application waits for more than a day."""
    events = log(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    return in_turns(by_turns(events, "ts"), lambda rows: states.replayed(rows, after=1, late="1 hour"), ["job_id"]).drop("version")


@query(
    "WITH a AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events), b AS (SELECT *, sum(CASE WHEN before IS NULL OR ts > before + INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM a) "
    "SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS \"end\", count(*) AS events, count(*) FILTER (WHERE event_type = 'error') AS errors FROM b GROUP BY user_id, n HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"
)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events in sessions that end after six hours without one; those that may still grow are not told."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    told = {"events": F.count("*"), "errors": F.count_if(F.col("event_type") == "error")}
    return in_turns(by_turns(events, "ts"), lambda rows: states.sessions(rows, "user_id", "ts", "6 hours", "1 hour", told), None)
