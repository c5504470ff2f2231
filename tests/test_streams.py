"""Streams with state against batches over the same rows, in turns and out of order."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from postlode.catalogue.on_streams import in_turns
from postlode.operators import keyed, snapshots, tracker
from postlode.streaming import ledger, states

START = dt.datetime(2024, 1, 1)
KINDS = ("saved", "applied", "interview", "rejected", "note", None)


def sql(row):
    return tuple(str(v) for v in row)


def events(spark, n, seed=5):
    """A log of which one job has a third, with repeated times, and null jobs, messages and types."""
    rng = random.Random(seed)
    rows = [(1 if rng.random() < 0.33 else rng.choice([None, *range(2, 40)]), i if rng.random() < 0.95 else None, rng.choice(KINDS), START + dt.timedelta(hours=rng.randrange(24 * 9))) for i in range(n)]
    return spark.createDataFrame(rows, "job_id long, message_id long, event_type string, ts timestamp")


def thirds(rows, at="ts"):
    days = [F.lit(START + dt.timedelta(days=d)) for d in (3, 6)]
    return [rows.where(F.col(at) < days[0]).repartition(3), rows.where((F.col(at) >= days[0]) & (F.col(at) < days[1])).repartition(2), rows.where(F.col(at) >= days[1]).repartition(3)]


def test_replay_equals_status_and_followups(spark):
    rows = events(spark, 600).cache()
    found = in_turns(thirds(rows), lambda s: states.replayed(s, after=2, late="1 hour"), ["job_id"]).cache()
    assert sorted(sql(r) for r in found.where("status IS NOT NULL").select("job_id", "status", "since", "events").collect()) == sorted(sql(r) for r in tracker.status(rows).select("job_id", "status", "since", "events").collect())
    newest = rows.agg(F.max("ts")).first()[0] - dt.timedelta(hours=1)
    by_job = {}
    for r in rows.collect():
        by_job.setdefault(r.job_id, []).append(r)
    overdue = set()
    for job, log in by_job.items():
        applied = max((r.ts for r in log if r.event_type == "applied"), default=None)
        if applied and applied == max(r.ts for r in log) and applied + dt.timedelta(days=2) < newest:
            overdue.add(job)
    assert {r.job_id for r in found.where("overdue").collect()} == overdue
    assert {r.job_id for r in found.collect()} == set(by_job)


def test_an_answer_takes_an_overdue_job_back(spark):
    rows = [("a", 1, "applied", 0), ("b", 2, "applied", 0), ("c", 3, "saved", 4), ("a", 4, "interview", 5), ("c", 5, "saved", 8)]
    log = spark.createDataFrame([(j, m, k, START + dt.timedelta(days=d)) for j, m, k, d in rows], "job_id string, message_id long, event_type string, ts timestamp")
    turns = [log.where(F.col("ts") == START + dt.timedelta(days=d)) for d in (0, 4, 5, 8)]
    found = {r.job_id: (r.status, r.overdue, r.version) for r in in_turns(turns, lambda s: states.replayed(s, after=2, late="1 hour"), ["job_id"]).collect()}
    assert found == {"a": ("interview", False, 3), "b": ("applied", True, 2), "c": ("saved", False, 2)}


def test_lifecycles_equal_merged_runs(spark):
    rng = random.Random(3)
    runs, known = [], None
    for day in range(3):
        rows = [(i, rng.choice([None, "x", "y"]), None if i % 4 == 0 else dt.date(2024, 1, 1 + i % 9)) for i in range(60) if rng.random() < 0.7]
        run = spark.createDataFrame(rows, "id long, title string, deadline date")
        at = F.lit(START + dt.timedelta(days=day))
        first = spark.createDataFrame([], "id long, title string, deadline date, first_seen timestamp, last_seen timestamp, active boolean")
        known = merge(known if known is not None else first, run, at)
        runs.append(run.withColumn("at", at).unionByName(run.where("id % 5 = 0").withColumn("at", at)))  # some rows come twice
    found = in_turns(runs, lambda s: states.lifecycles(s, "id", "at", ["title", "deadline"]), ["id"])
    columns = ["id", "title", "deadline", "first_seen", "last_seen", "active"]
    assert sorted(sql(r) for r in found.select(columns).collect()) == sorted(sql(r) for r in known.select(columns).collect())


def merge(known, run, at):
    return snapshots.merge_lifecycle(known, run, "id", at, ["title", "deadline"])


def test_gone_only_after_its_days(spark):
    days = [["gone", "still", "back", "always"], ["still", "always"], ["back", "always"]]
    runs = [spark.createDataFrame([(k, START + dt.timedelta(days=2 * d)) for k in keys], "id string, at timestamp") for d, keys in enumerate(days)]
    found = in_turns(runs, lambda s: states.lifecycles(s, "id", "at", [], gone_after=2 * states.DAY_MS), ["id"])
    assert {r.id: r.active for r in found.collect()} == {"gone": False, "still": True, "back": True, "always": True}


def test_no_rows_and_rows_without_a_time(spark):
    empty = spark.createDataFrame([("a", None)], "id string, at timestamp")
    assert in_turns([empty], lambda s: states.lifecycles(s, "id", "at", []), ["id"]).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_a_summary_is_the_same_in_any_portions(spark, seed):
    import pyarrow as pa

    rng = random.Random(seed)
    rows = [{"k": rng.choice([None, "a", "b"]), "at": rng.randrange(99), "o": rng.choice([None, 1, 2]), "v": rng.choice([None, "x", "y"]), "n": rng.choice([None, 3, 9]), "m": rng.choice([None, 3, 9]), "t": rng.choice([None, 1])} for _ in range(200)]
    summary = states.Summary(("o",), ("v",), ("n",), ("m",), ("t",))
    schema = pa.schema([("k", pa.string()), ("at", pa.int64()), ("o", pa.int64()), ("v", pa.string()), ("n", pa.int64()), ("m", pa.int64()), ("t", pa.int64())])
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 30], schema=schema) for i in range(0, 200, 30)] + [pa.RecordBatch.from_pylist([], schema=schema)]
    few = [r for b in states._combined(iter(batches), ["k"], "at", summary) for r in b.to_pylist()]
    assert len(few) <= 3 * 7

    def fold(part):
        found = {}
        for r in rng.sample(part, len(part)):
            found[r["k"]] = summary.merged(found.get(r["k"]), r)
        return found

    assert fold(few) == fold(rows)


@pytest.mark.parametrize(("most", "rows"), [(1000, 10), (15, 100)])
def test_batches_of_a_task_are_summed_up_together(spark, most, rows):
    import pyarrow as pa

    schema = pa.schema([("k", pa.int64()), ("at", pa.int64()), ("t", pa.int64())])
    batches = [pa.RecordBatch.from_pylist([{"k": i % 10, "at": b, "t": 1} for i in range(30)], schema=schema) for b in range(20)]
    few = [r for b in states._combined(iter(batches), ["k"], "at", states.Summary(total=("t",)), most=most) for r in b.to_pylist()]
    sums = [sum(r["t"] for r in few if r["k"] == k) for k in range(10)]
    assert sums == [60] * 10 and len(few) == rows


def test_sessions_in_a_stream_are_those_of_a_batch(spark):
    apart = F.expr("make_interval(0, 0, 0, 0, 0, 0, pmod(xxhash64(message_id, ts), 1000))")  # no two exactly a gap apart
    rows = events(spark, 400, seed=8).where("job_id > 1").withColumn("ts", F.col("ts") + apart).cache()
    told = {"n": F.count("*")}
    found = in_turns(thirds(rows), lambda s: states.sessions(s, "job_id", "ts", "5 hours", "1 hour", told), None)
    closed = rows.agg(F.max("ts")).first()[0] - dt.timedelta(hours=1)
    batch = states.sessions(rows, "job_id", "ts", "5 hours", "1 hour", told).where(F.col("end") <= F.lit(closed))
    assert sorted(sql(r) for r in found.collect()) == sorted(sql(r) for r in batch.collect()) and found.count() > 20


def test_a_store_follows_a_stream(spark, tmp_path):
    rows = spark.createDataFrame([("a", START), ("b", START), ("a", START + dt.timedelta(days=1))], "id string, at timestamp")
    store = keyed.KeyedStore(str(tmp_path / "store"), "id string, first_seen timestamp, last_seen timestamp, active boolean, version long", ("id",), ("version",))
    for day in range(2):
        rows.where(F.col("at") == START + dt.timedelta(days=day)).write.parquet(str(tmp_path / f"in/{day}"))
        told = states.lifecycles(ledger.read_runs(states.stateful(spark), str(tmp_path / "in"), "id string, at timestamp", 100), "id", "at", [])
        ledger.into(told, lambda batch, _: store.upsert(batch), str(tmp_path / "checkpoint")).start().awaitTermination()
    assert {r.id: (r.active, r.version) for r in store.read(spark).collect()} == {"a": (True, 2), "b": (False, 2)}


def test_keys_of_a_bucket_are_one_value_and_one_timer():
    from types import SimpleNamespace

    from pyspark.sql import Row

    asked, held, timers = [], [None], set()
    state = SimpleNamespace(get=lambda: asked.append("get") or held[0], update=lambda v: asked.append("update") or held.__setitem__(0, v))
    processor = states._Summaries(["k"], states.Summary(("o",), deadline=lambda kept: kept["o"]))
    processor.init(SimpleNamespace(getValueState=lambda *_: state, registerTimer=timers.add, deleteTimer=timers.remove))
    rows = [Row(k=float("nan") if i % 100 == 99 else i % 100, o=100 + i) for i in range(1000)]
    told = list(processor.handleInputRows((0,), iter(rows), None))
    assert len(told) == 100 and {r.o for r in told} == set(range(1000, 1100)) and asked == ["get", "update"] and timers == {1000}
    expired = timers.pop()
    due = list(processor.handleExpiredTimer((0,), SimpleNamespace(getCurrentWatermarkInMs=lambda: 1010), SimpleNamespace(getExpiryTimeInMs=lambda: expired)))
    assert sorted(r.o for r in due) == list(range(1000, 1010)) and all(r.due and r.version == 2 for r in due) and timers == {1010}
    back = list(processor.handleInputRows((0,), iter([Row(k=float("nan"), o=2000), Row(k=0, o=2000)]), None))
    assert [(r.due, r.version) for r in back] == [(False, 2), (False, 3)] and asked == ["get", "update"] * 3
