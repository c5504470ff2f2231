"""Postings of different sources that meet in one bucket, replayed in order of arrival.

A row meets the first resident of another source whose country does not
contradict its own: it goes with that resident, or takes its place at the end
of the order. What a run of rows does depends on the residents it finds, but
residents of one kind (source, country) leave first in, first out. So what the
ranges of a large bucket hand on is two numbers a kind: how many were placed,
and how many left. Ranges are replayed side by side from the residents that
these numbers give, until a pass hands on what it was given. Then each range
began as one task that goes through the whole bucket would have begun it.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlode.operators.running import running_sums
from postlode.shared import arrow_schema, drop_stored, stored, written

KIND = ("source", "country")
RANK = ("bulk", "described", "typed", "posted")


#: Rows of a bucket up to which its residents are looked through one by one.
FEW = 64


def takes_over(new: tuple, other: tuple) -> bool:
    """Of two (bulk, described, typed, posted): a bulk row beats others; then a trait that the other lacks counts, then the earlier date. Not an order: two rows can each beat the other."""
    if new[0] != other[0]:
        return new[0]
    if new[1] > other[1] or new[2] > other[2]:
        return True
    return new[:3] == other[:3] and new[3] < other[3]


class Rank(NamedTuple):
    """What decides between two rows that meet."""

    bulk: bool
    described: bool
    typed: bool
    posted: str

    def takes_over(self, other: Rank) -> bool:
        return takes_over(self, other)


def of_few(rows: Sequence[tuple]) -> list[tuple]:
    """(loser, winner) of the rows (row, source, country, rank) of one small bucket, as Residents has them."""
    lost, residents = [], []
    for new in rows:
        row, source, country, rank = new
        for at, (other, theirs, place, held) in enumerate(residents):
            if theirs and theirs != source and (not country or not place or place == country):
                if takes_over(rank, held):
                    del residents[at]
                    residents.append(new)
                    lost.append((other, row))
                else:
                    lost.append((row, other))
                break
        else:
            residents.append(new)
    return lost


class Residents:
    """Of one bucket, the rows that stay so far. Rows of one kind (source, country) wait in one queue, so only heads are looked at."""

    def __init__(self, held: Iterable[tuple] = ()) -> None:
        """held: (source, country, row, rank) of rows that are there already, in order of their rows."""
        self.queues: dict[tuple[str, str], deque[tuple[int, Rank]]] = {}
        self.left: Counter[tuple[str, str]] = Counter()
        self.placed: list[tuple[str, str, int, Rank]] = []
        for source, country, row, rank in held:
            self.queues.setdefault((source, country), deque()).append((row, rank))

    def meet(self, source: str, country: str, row: int, rank: Rank) -> tuple[int, int] | None:
        """(loser, winner) of the row and the first resident of another source whose country does not contradict; without one it stays.

        Residents without a source are never met.
        """
        kinds = (k for k in self.queues if k[0] and k[0] != source and (not country or not k[1] or k[1] == country))
        kind = min(kinds, key=lambda k: self.queues[k][0][0], default=None)
        lost = None
        if kind is not None:
            lost, other = self.queues[kind][0]
            if not rank.takes_over(other):
                return row, lost
            self.queues[kind].popleft()
            self.left[kind] += 1
            if not self.queues[kind]:
                del self.queues[kind]
        self.queues.setdefault((source, country), deque()).append((row, rank))
        self.placed.append((source, country, row, rank))
        return None if kind is None else (lost, row)


def bucket_fold(rows: DataFrame, keys: Sequence[str], most_rows: int = 50_000) -> DataFrame:
    """(loser, winner) of rows (keys, source, country, bulk, described, typed, posted, _ord): within equal keys each meets, in order, the residents before it.

    Keys are not null and `_ord` is different for all rows. A bucket of up to
    most_rows is gone through by one task, as one of many that it sorts; larger
    ones are cut into ranges of that many rows. Rows are read several times.
    """
    large = stored(rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > most_rows).select(*keys), "large")
    if large.isEmpty():
        return whole_buckets(rows, keys)
    return whole_buckets(rows.join(large.hint("merge"), list(keys), "left_anti"), keys).unionByName(in_ranges(rows.join(large.hint("merge"), list(keys), "left_semi"), keys, most_rows))


def whole_buckets(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The fold of buckets that one task each goes through."""
    kind = rows.schema["_ord"].dataType.simpleString()
    schema = f"loser {kind}, winner {kind}"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, few, many = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.select(list(keys))
            begins = np.zeros(batch.num_rows, bool)
            begins[0] = own.slice(0, 1).to_pylist() != last
            for c in own.columns:
                begins[1:] |= pc.not_equal(c.slice(1), c.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            last, removed = own.slice(batch.num_rows - 1).to_pylist(), []
            order, source, country, *rank = (batch.column(c).to_pylist() for c in ("_ord", *KIND, *RANK))
            for begun, *row in zip(begins.tolist(), order, source, country, zip(*rank, strict=True), strict=True):
                if begun:
                    removed += of_few(few)
                    few, many = [], None
                if many is None:
                    few.append(row)
                    if len(few) > FEW:
                        many = Residents()
                        removed += [x for i, s, c, r in few if (x := many.meet(s, c, i, Rank(*r))) is not None]
                        few = []
                elif (found := many.meet(row[1], row[2], row[0], Rank(*row[3]))) is not None:
                    removed.append(found)
            yield _pairs(removed, out)
        yield _pairs(of_few(few), out)

    return rows.repartition(*keys).sortWithinPartitions(*keys, "_ord").select("_ord", *KIND, *RANK, *keys).mapInArrow(run, schema)


def _pairs(pairs: list[tuple], out: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], out.field(i).type) for i in range(2)], schema=out)


def in_ranges(rows: DataFrame, keys: Sequence[str], most_rows: int) -> DataFrame:
    """The fold of buckets of any size, by ranges of most_rows rows.

    Each pass replays the ranges whose first residents have changed. A pass
    more of the ranges is right for good, and mostly all are after a few: a
    bucket in which rows of a few kinds meet soon has nothing to hand on.
    """
    spark, at = rows.sparkSession, [*keys, "_range"]
    numbered = running_sums(rows.select(*keys, *KIND, *RANK, "_ord"), F.col("_ord"), {"_n": F.lit(1)}, keys)
    rows = stored(numbered.withColumn("_range", F.floor(F.col("_n") / most_rows).cast("int")).drop("_n"), "ranges")
    sizes = stored(rows.groupBy(*at).agg(F.count("*").alias("size")), "sizes")
    starts = rows.where("false").select(*at, *KIND, "_ord", *RANK)
    marks = sizes.select(*at, F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("hash"))
    events = stored(_replayed(rows, starts, at), "events")
    before: list[str] = []
    while True:
        with written() as paths:
            starts = stored(_starts(events, sizes, keys), "starts")
            found = starts.groupBy(*at).agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*KIND, "_ord")).alias("hash"))
            now = stored(sizes.select(*at).join(found, at, "left").fillna(0, ["n", "hash"]), "marks")
            changed = now.exceptAll(marks).select(*at)
            if changed.isEmpty():
                return events.where("event = 'lost'").select("loser", "winner")
            changed = stored(changed, "changed")
            again = _replayed(rows.join(changed, at, "left_semi"), starts.join(changed, at, "left_semi"), at)
            events = stored(events.join(changed, at, "left_anti").unionByName(again), "events")
        drop_stored(spark, before)
        marks, before = now, paths


def _starts(events: DataFrame, sizes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _range, source, country, _ord, rank): the residents that each range can meet at its beginning.

    A range of n rows has at most n residents leave, so of each kind it needs
    no more than the first n of those that ranges before it placed and left.
    """
    at, of = [*keys, "_range"], [*keys, *KIND]
    is_placed = F.col("event") == "placed"
    counts = events.where("event <> 'lost'").groupBy(*at, *KIND).agg(F.count_if(is_placed).alias("placed"), F.sum(F.when(is_placed, 0).otherwise(F.col("n"))).alias("gone"))
    grid = sizes.join(counts.select(*of).distinct(), list(keys)).join(counts, [*at, *KIND], "left").fillna(0, ["placed", "gone"])
    past = Window.partitionBy(*of).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.withColumns({c: F.coalesce(F.sum(c).over(past), F.lit(0)) for c in ("placed", "gone")})
    placed = events.where(is_placed).join(grid.select(*at, *KIND, "placed"), [*at, *KIND])
    placed = placed.select(*of, (F.col("placed") + F.col("n")).alias("_at"), F.col("loser").alias("_ord"), *RANK)
    upto = F.least("placed", F.col("gone") + F.col("size"))
    wanted = grid.where(upto > F.col("gone")).select(*at, *KIND, F.explode(F.sequence(F.col("gone"), upto - 1)).alias("_at"))
    return wanted.join(placed.hint("merge"), [*of, "_at"]).drop("_at").select(*at, *KIND, "_ord", *RANK)


def _replayed(rows: DataFrame, starts: DataFrame, at: Sequence[str]) -> DataFrame:
    """What each range does: (at, event, source, country, n, loser, winner, rank).

    `placed` is a row (in `loser`) that became the n-th resident of its kind in
    this range; `left` says that n of a kind went; `lost` is a pair.
    """
    kind = rows.schema["_ord"].dataType.simpleString()
    keyed = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in at)
    schema = f"{keyed}, event string, source string, country string, n long, loser {kind}, winner {kind}, bulk boolean, described boolean, typed boolean, posted string"
    out, names = arrow_schema(schema), [*KIND, "_ord", *RANK]

    def replay(own: pa.Table, held: pa.Table) -> pa.Table:
        listed = lambda t: [(s, c, i, Rank(*rank)) for s, c, i, *rank in zip(*(t.column(n).to_pylist() for n in names), strict=True)]
        if not own.num_rows:
            return out.empty_table()
        residents, made = Residents(listed(held.sort_by("_ord"))), []
        for source, country, row, rank in listed(own.sort_by("_ord")):
            if (found := residents.meet(source, country, row, rank)) is not None:
                made.append(("lost", None, None, None, *found, None, None, None, None))
        counts: Counter[tuple[str, str]] = Counter()
        for source, country, row, rank in residents.placed:
            made.append(("placed", source, country, counts[source, country], row, None, *rank))
            counts[source, country] += 1
        made += [("left", *k, n, None, None, None, None, None, None) for k, n in residents.left.items()]
        where = [own.column(k)[0].as_py() for k in at]
        columns = [[w] * len(made) for w in where] + [[m[i] for m in made] for i in range(len(out) - len(where))]
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(columns, out, strict=True)], schema=out)

    # columns of its own, as both sides may stem from one table
    starts = starts.select(*[F.col(c).alias(c) for c in [*at, *names]])
    return rows.groupBy(*at).cogroup(starts.groupBy(*at)).applyInArrow(replay, schema)
