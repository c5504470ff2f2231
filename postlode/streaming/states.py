"""Streams with state of their own: summaries of keys with a deadline, lifecycles, replayed logs, sessions.

Times are event times. A row that is more than `late` older than the newest row
of the batches before is not taken any more, nor is a row without a time. What a
stream tells equals what a batch over the same rows tells, whatever order they
come in within `late`.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from postlode.operators.tracker import FOLLOWUP_DAYS, STATUS_EVENTS

DAY_MS = 86_400_000
#: Rows that a task holds while it sums up.
MOST_HELD = 100_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stateful(spark: SparkSession) -> SparkSession:
    """A session beside spark for streams of this module: state in RocksDB, sessions merged before they move. The settings of spark itself stay."""
    beside = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        beside.conf.set(name, spark.conf.get(name))
    beside.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    beside.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return beside


@dataclass(frozen=True)
class Summary:
    """What is kept of a key's rows: of bounded size, and the same in whatever order and portions they come.

    order, carried: of the last row by `order`, then by `carried`, nulls first.
    least, most, total: smallest values, greatest values and sums, without nulls.
    deadline: from what is kept, the time in ms after which the key is due; None for never.
    """

    order: tuple[str, ...] = ()
    carried: tuple[str, ...] = ()
    least: tuple[str, ...] = ()
    most: tuple[str, ...] = ()
    total: tuple[str, ...] = ()
    deadline: Callable[[Mapping], int | None] = lambda held: None

    @property
    def columns(self) -> list[str]:
        return [*self.order, *self.carried, *self.least, *self.most, *self.total]

    def merged(self, a: Mapping | None, b: Mapping) -> dict:
        if a is None:
            return {c: b[c] for c in self.columns}
        rank = lambda row: [(row[c] is not None, row[c]) for c in (*self.order, *self.carried)]
        last = max(a, b, key=rank)
        found = {c: last[c] for c in (*self.order, *self.carried)}
        for names, fold in ((self.least, min), (self.most, max), (self.total, sum)):
            for c in names:
                known = [row[c] for row in (a, b) if row[c] is not None]
                found[c] = fold(known) if known else None
        return found


def summaries(rows: DataFrame, key: Sequence[str], at: str, summary: Summary, late: str, buckets: int = 1024) -> DataFrame:
    """(key, columns of the summary, due, version): a row for each change of a key; the greatest version is its last.

    due: the deadline has passed, and nothing came that moved it. Tasks
    summarise what they read before rows move, so a key that holds most rows
    sends one row for each portion (see _combined). State is held by buckets of keys, as
    asking for each key on its own takes far longer than summing up. A stream
    keeps the number of buckets that it began with.
    """
    told = rows.where(F.col(at).isNotNull()).select(*key, at, *summary.columns)
    few = told.mapInArrow(partial(_combined, key=list(key), at=at, summary=summary), told.schema).withWatermark(at, late)
    types = {f.name: f.dataType.simpleString() for f in told.schema}
    kept = ", ".join(f"{c} {types[c]}" for c in summary.columns)
    found = ", ".join([*(f"{c} {types[c]}" for c in key), kept, "due boolean, version long"])
    few = few.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    return few.groupBy("_bucket").transformWithState(_Summaries(key, summary), found, "Append", "eventTime")


def _combined(batches: Iterator[pa.RecordBatch], key: list[str], at: str, summary: Summary, most: int = MOST_HELD) -> Iterator[pa.RecordBatch]:
    """One row for each key of a task's rows; where more than `most` rows are left of them, for each such portion."""
    held: list[pa.Table] = []
    for batch in batches:
        if batch.num_rows:
            held.append(_folded(pa.Table.from_batches([batch]), key, at, summary))
        if sum(t.num_rows for t in held) > most:
            held = [_folded(pa.concat_tables(held), key, at, summary)]
            if held[0].num_rows > most // 2:
                yield from held.pop().to_batches()
    if held:
        yield from _folded(pa.concat_tables(held), key, at, summary).to_batches()


def _folded(table: pa.Table, key: list[str], at: str, summary: Summary) -> pa.Table:
    schema = table.schema
    if ranks := [(c, "ascending") for c in (*summary.order, *summary.carried)]:
        table = table.take(pc.sort_indices(table, sort_keys=ranks, null_placement="at_start"))
    table = table.append_column("_row", pa.array(range(table.num_rows), pa.int64()))
    folds = {at: "max", **dict.fromkeys(summary.least, "min"), **dict.fromkeys(summary.most, "max"), **dict.fromkeys(summary.total, "sum")}
    groups = table.group_by(key, use_threads=False).aggregate([("_row", "max"), *folds.items()])
    last = table.take(groups["_row_max"])
    columns = [groups[f"{c}_{folds[c]}"].cast(schema.field(c).type) if c in folds else last[c] for c in schema.names]
    return pa.Table.from_arrays(columns, schema=schema)


class _Summaries(StatefulProcessor):
    """The summaries of a bucket of keys: read, changed and written as one value, with one timer for the earliest deadline."""

    def __init__(self, key: Sequence[str], summary: Summary) -> None:
        self.key, self.summary, self.found = list(key), summary, Row(*key, *summary.columns, "due", "version")

    def init(self, handle) -> None:
        self.handle, self.state = handle, handle.getValueState("summaries", "held binary, timer long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held, timer = self._read()
        new: dict[tuple, dict] = {}
        for row in map(Row.asDict, rows):
            one = _same(row[c] for c in self.key)
            if one not in new:
                old = held.get(one)
                new[one] = self.summary.merged(old and dict(zip(self.summary.columns, old[0], strict=True)), row)
            else:
                new[one] = self.summary.merged(new[one], row)
        for one, kept in new.items():
            _, before, due, version = held.get(one) or ((), None, False, 0)
            deadline = self.summary.deadline(kept)
            held[one] = tuple(kept[c] for c in self.summary.columns), deadline, due and deadline == before, version + 1
        self._write(held, timer)
        for one in new:
            yield self._told(one, held[one])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held, timer = self._read()
        now = timerValues.getCurrentWatermarkInMs()
        passed = [one for one, (_, deadline, due, _) in held.items() if deadline is not None and not due and deadline < now]
        for one in passed:
            kept, deadline, _, version = held[one]
            held[one] = kept, deadline, True, version + 1
        self._write(held, None if timer == expiredTimerInfo.getExpiryTimeInMs() else timer)
        for one in passed:
            yield self._told(one, held[one])

    def _told(self, one: tuple, entry: tuple) -> Row:
        kept, _, due, version = entry
        return self.found(*one, *kept, due, version)

    def _read(self) -> tuple[dict[tuple, tuple], int | None]:
        """Of each key what is kept, its deadline, whether it is due, and its version; and the timer that runs."""
        if not (found := self.state.get()):
            return {}, None
        return {_same(one): entry for one, entry in pickle.loads(zlib.decompress(bytes(found[0]))).items()}, found[1]

    def _write(self, held: dict[tuple, tuple], timer: int | None) -> None:
        first = min((deadline for _, deadline, due, _ in held.values() if deadline is not None and not due), default=None)
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)
        self.state.update((zlib.compress(pickle.dumps(held, pickle.HIGHEST_PROTOCOL), 1), first))

    def close(self) -> None:
        pass


def _same(key: Iterable) -> tuple:
    """A key's values, of which all that are not a number are one."""
    return tuple(math.nan if v != v else v for v in key)


def lifecycles(rows: DataFrame, key: str, at: str, values: Sequence[str], gone_after: int = 0, late: str = "1 second") -> DataFrame:
    """(key, values, first_seen, last_seen, active, version) of the rows of run after run, each seen at the time of its run.

    A key is active until a run comes more than gone_after ms and `late` after
    the last that had it, and again when it comes back; no run needs to be held
    against the table. Runs lie further apart than `late`. Of a key's rows in
    one run the greatest by values counts.
    """
    seen = F.unix_micros(F.col(at))
    told = rows.select(key, at, *values, seen.alias("_first"), seen.alias("_last"))
    summary = Summary(("_last",), tuple(values), ("_first",), deadline=lambda held: held["_last"] // 1000 + gone_after)
    found = summaries(told, [key], at, summary, late)
    return found.select(key, *values, F.timestamp_micros("_first").alias("first_seen"), F.timestamp_micros("_last").alias("last_seen"), (~F.col("due")).alias("active"), "version")


def replayed(events: DataFrame, after: int = FOLLOWUP_DAYS, late: str = "1 day") -> DataFrame:
    """(job_id, status, since, events, applied, overdue, version) of a log (job_id, message_id, event_type, ts).

    status, since and events are those of tracker.status; jobs without a status
    event have nulls and 0. A job is overdue once more than `after` days and
    `late` have passed since it was applied for and it has had no event since.
    """
    ts, sets = F.unix_micros("ts"), F.col("event_type").isin(*STATUS_EVENTS)
    told = events.select(
        "job_id", "ts", F.when(sets, ts).alias("_since"), F.when(sets, F.col("message_id")).alias("_message"), F.when(sets, F.col("event_type")).alias("status"),
        F.when(F.col("event_type") == "applied", ts).alias("_applied"), ts.alias("_last"), F.when(sets, 1).otherwise(0).cast("long").alias("events"),
    )
    overdue = lambda held: held["_applied"] // 1000 + after * DAY_MS if held["_applied"] is not None and held["_applied"] == held["_last"] else None
    summary = Summary(("_since", "_message"), ("status",), most=("_applied", "_last"), total=("events",), deadline=overdue)
    found = summaries(told, ["job_id"], "ts", summary, late)
    return found.select("job_id", "status", F.timestamp_micros("_since").alias("since"), "events", F.timestamp_micros("_applied").alias("applied"), F.col("due").alias("overdue"), "version")


def sessions(rows: DataFrame, by: str, at: str, gap: str, late: str, told: Mapping[str, Column]) -> DataFrame:
    """(by, start, end, told) of rows that follow each other within the gap; a stream tells a session once no row can join it any more.

    end is the last row's time plus the gap. Rows exactly a gap apart are joined
    by a stream and parted by a batch, as Spark does.
    """
    found = rows.where(F.col(at).isNotNull()).withWatermark(at, late).groupBy(F.session_window(at, gap).alias("_span"), by)
    return found.agg(*[c.alias(name) for name, c in told.items()]).select(by, F.col("_span.start").alias("start"), F.col("_span.end").alias("end"), *told)
