"""The cascade of duplicates in parallel rounds.

A row founds a class if no earlier founder has one of its keys, else it joins
the class of the first of its keys that an earlier founder has. Founders are
thus the lexicographically first independent set of rows, found in rounds: a
row that is the first undecided one of each of its keys is a founder, and all
who share a key with it are decided too. The number of rounds is the depth of
dependency, not the size of a key's group.

Within a class the holder changes as rows arrive. `prefers` is no order, but a
run of rows acts on whatever holder it meets in a way that four small cases
describe, so a class is cut into ranges of rows that are summed up, chained and
replayed apart. No class, key or component has to meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.operators.components import components
from postlode.shared import arrow_schema, checkpointed, drop_stored, stored, written

TRAITS = ("has_description", "has_type", "posted_key")


class Holder(NamedTuple):
    """A row that holds a class, or asks to."""

    row: int
    described: bool
    typed: bool
    posted: str

    def kind(self) -> int:
        return 2 * self.described + self.typed


def beats(kind: int, other: int) -> bool:
    """Whether rows of a kind have a trait that those of the other lack."""
    return bool(kind & ~other)


def prefers(new: Holder, old: Holder) -> bool:
    """Whether a row takes the place of the one it meets. Not an order: two rows can each beat the other."""
    return beats(new.kind(), old.kind()) or new.kind() == old.kind() and new.posted < old.posted


class Passage:
    """What a run of rows makes of a holder of each kind: one that is fixed, or the earlier posted of it and a row of the run."""

    def __init__(self) -> None:
        self.fixed: list[Holder | None] = [None] * 4
        self.least: list[Holder | None] = [None] * 4

    def add(self, new: Holder) -> None:
        for kind in range(4):
            if (fixed := self.fixed[kind]) is not None:
                if prefers(new, fixed):
                    self.fixed[kind] = new
            elif beats(new.kind(), kind):
                self.fixed[kind] = new
            elif new.kind() == kind and ((least := self.least[kind]) is None or new.posted < least.posted):
                self.least[kind] = new

    def of(self, holder: Holder) -> Holder:
        """The holder after the run."""
        kind = holder.kind()
        if (fixed := self.fixed[kind]) is not None:
            return fixed
        least = self.least[kind]
        return least if least is not None and least.posted < holder.posted else holder


def _keys(shared: DataFrame) -> list[str]:
    """The columns that make a key: all but the row's, its place, its tier and the key's first row."""
    return [c for c in shared.columns if c not in ("_ord", "i", "tier", "least")]


def shared_keys(flat: DataFrame) -> DataFrame:
    """flat, (_ord, i, tier, key in one or more columns), of keys that several rows have, with the first of those rows as `least`.

    Rows move once, in ranges of (key, _ord), and the first of equal keys comes
    first. Only keys that a range begins or ends with can go on in others, two
    a range; what such keys have is added up apart.
    """
    keys, spark = _keys(flat), flat.sparkSession
    dealt = flat.select(*keys, "_ord", "i", "tier").repartitionByRange(*keys, "_ord").sortWithinPartitions(*keys, "_ord")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema) + f", least {flat.schema['_ord'].dataType.simpleString()}, at_edge int"
    out = arrow_schema(schema)
    found = stored(dealt.mapInArrow(lambda batches: _first_of_keys(batches, keys, out), schema), "shared")
    edges = found.where("at_edge > 0").drop("least")
    with written() as paths:
        least = stored(edges.groupBy(*keys).agg(F.min("_ord").alias("least"), F.max("_ord").alias("_most")).where("least < _most").drop("_most"), "least")
    more = stored(edges.where("at_edge = 1").join(least.hint("merge"), keys).drop("at_edge"), "edges")
    drop_stored(spark, paths)
    return found.where("at_edge = 0").drop("at_edge").unionByName(more)


def _first_of_keys(batches: Iterator[pa.RecordBatch], keys: Sequence[str], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and order, of keys with several rows, with the first (at_edge 0); 1 marks rows of the range's first and last key, 2 tells how a last key began whose rows are out."""
    first_open, kept, told = True, None, False

    def made(rows: pa.RecordBatch, least: pa.Array, at_edge: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(rows.column(c) for c in out.names[:-2]), least, pa.array(np.full(rows.num_rows, at_edge, np.int32))], schema=out)

    def edge(rows: pa.RecordBatch, at_edge: int) -> pa.RecordBatch:
        return made(rows, pa.nulls(rows.num_rows, out.field("least").type), at_edge)

    for batch in batches:
        if not batch.num_rows:
            continue
        # kept: rows of the last key so far; if that is known to be shared its first row, which is out already
        rows = batch if kept is None else pa.Table.from_batches([kept, batch]).combine_chunks().to_batches()[0]
        begins = np.zeros(rows.num_rows, bool)
        begins[0] = True
        for c in keys:
            begins[1:] |= pc.not_equal(rows.column(c).slice(1), rows.column(c).slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(begins)
        if first_open:
            n = starts[1] if len(starts) > 1 else rows.num_rows
            yield edge(rows.slice(int(told), n - told), 1)
            if n == rows.num_rows:
                kept, told = rows.slice(0, 1), True
                continue
            first_open, rows, starts, told = False, rows.slice(n), starts[1:] - n, False
        sizes = np.diff(np.append(starts, rows.num_rows))
        order = rows.column("_ord")
        shared = pc.not_equal(order.take(pa.array(starts)), order.take(pa.array(starts + sizes - 1))).to_numpy(zero_copy_only=False)
        chosen = np.repeat(shared, sizes)
        chosen[0] &= not told
        at, least = np.flatnonzero(chosen), np.repeat(starts, sizes)
        yield made(rows.take(pa.array(at)), order.take(pa.array(least[at])), 0)
        told = bool(shared[-1])
        kept = rows.slice(int(starts[-1]), 1) if told else rows.slice(int(starts[-1]))
    if kept is not None and not first_open:
        yield edge(kept, 2 if told else 1)


def founders(shared: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(_ord): the rows of (_ord, key) that share no key with an earlier founder.

    Whatever most_rounds leave undecided, as long chains of keys do, is decided
    component by component.
    """
    keys = _keys(shared)
    spark, alive, found, before = shared.sparkSession, shared.select("_ord", *keys), shared.select("_ord").where("false"), []
    for _ in range(most_rounds):
        with written() as paths:
            least = alive.groupBy(*keys).agg(F.min("_ord").alias("least"))
            seen = checkpointed(alive.join(least.hint("merge"), keys))
            first = checkpointed(seen.groupBy("_ord").agg(F.bool_and(F.col("_ord") == F.col("least")).alias("first")).where("first").select("_ord"))
            # rows of a key whose first undecided row is a founder, that row included
            decided = seen.join(first.withColumnRenamed("_ord", "_founder").hint("merge"), F.col("least") == F.col("_founder")).select("_ord").distinct()
            alive = checkpointed(seen.join(decided.hint("merge"), "_ord", "left_anti").select("_ord", *keys))
        drop_stored(spark, [*before, paths[0]])
        found, before = found.unionByName(first), paths[2:]
        if alive.isEmpty():
            return found
    return found.unionByName(_greedy(alive))


def _greedy(alive: DataFrame) -> DataFrame:
    """The founders of what is left: each component of rows is gone through in order by one task."""
    keys = _keys(alive)
    first = alive.groupBy(*keys).agg(F.min("_ord").alias("a"))
    group = components(alive.join(first.hint("merge"), keys).where("a <> _ord").select("a", F.col("_ord").alias("b")))
    rows = alive.groupBy("_ord").agg(F.collect_list(F.concat_ws("/", *keys)).alias("keys")).join(group.hint("merge"), F.col("_ord") == F.col("node"), "left")
    rows = rows.select(F.coalesce("component", "_ord").alias("component"), "_ord", "keys")
    out = arrow_schema(schema := f"_ord {alive.schema['_ord'].dataType.simpleString()}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        component, held = None, set()
        for batch in batches:
            kept = []
            for r in batch.to_pylist():
                if r["component"] != component:
                    component, held = r["component"], set()
                if held.isdisjoint(r["keys"]):
                    held.update(r["keys"])
                    kept.append(r["_ord"])
            yield pa.RecordBatch.from_arrays([pa.array(kept, out.field(0).type)], schema=out)

    return rows.repartition("component").sortWithinPartitions("component", "_ord").mapInArrow(run, schema)


def joined_classes(shared: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(_ord, founder, tier) of the rows that join a class, and of the founders (their tier is null); shared: as shared_keys() has it.

    Rows that are the first of all their keys are founders, and rows that share
    a key with them join a class. Only what that leaves, as a rule little, goes
    on in rounds.
    """
    keys, joins = _keys(shared), lambda met: met.groupBy("_ord").agg(F.min("i").alias("i"), F.min_by("tier", "i").alias("tier"), F.min_by("founder", "i").alias("founder"))
    status = stored(shared.groupBy("_ord").agg(F.bool_and(F.col("_ord") == F.col("least")).alias("first")), "status")
    first = status.where("first").select("_ord")
    met = shared.where("least < _ord").join(first.select(F.col("_ord").alias("founder")).hint("merge"), F.col("least") == F.col("founder")).select("_ord", "i", "tier", "founder")
    members = stored(joins(met), "joined")
    left = status.where("NOT first").select("_ord").join(members.hint("merge"), "_ord", "left_anti")
    if status.where("NOT first").count() > members.count():
        later = checkpointed(founders(shared.join(left.hint("merge"), "_ord", "left_semi"), most_rounds - 1))
        held = shared.join(later.hint("merge"), "_ord").select(*keys, F.col("_ord").alias("founder"))
        more = shared.join(held.hint("merge"), keys).where("founder < _ord").select("_ord", "i", "tier", "founder")
        members, first = joins(members.unionByName(more)), first.unionByName(later)
    return members.select("_ord", "founder", "tier").unionByName(first.select("_ord", F.col("_ord").alias("founder"), F.lit(None).cast(shared.schema["tier"].dataType).alias("tier")))


def replayed(rows: DataFrame) -> DataFrame:
    """(loser, winner, tier) of rows (_ord, founder, tier, has_description, has_type, posted_key), class by class in order of _ord.

    Rows are dealt out in ranges of (founder, _ord). A task goes through the
    classes that begin in its range. What is left is the class that each range
    begins amid, and who holds it before.
    """
    kind, tier = (rows.schema[c].dataType.simpleString() for c in ("_ord", "tier"))
    dealt = rows.select("founder", "_ord", "tier", *TRAITS).repartitionByRange("founder", "_ord").sortWithinPartitions("founder", "_ord")
    schema = f"loser {kind}, winner {kind}, tier {tier}, founder {kind}, has_description boolean, has_type boolean, posted_key string"
    out = arrow_schema(schema)
    found = stored(dealt.mapInArrow(lambda batches: _own_classes(batches, out), schema), "folded")
    lost, rest = found.where("founder IS NULL"), found.where("founder IS NOT NULL")
    return lost.select("loser", "winner", "tier").unionByName(_chained(rest.select(F.col("loser").alias("_ord"), "founder", "tier", *TRAITS)))


def _own_classes(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """What the classes that begin in a range lose; with their founder, rows of the class before and the holder of the last class."""
    holder, before, begun = None, None, False

    def undecided(rows: pa.RecordBatch) -> pa.RecordBatch:
        none = pa.nulls(rows.num_rows, out.field("winner").type)
        return pa.RecordBatch.from_arrays([rows.column("_ord"), none, *(rows.column(c) for c in out.names[2:])], schema=out)

    for batch in batches:
        if not batch.num_rows:
            continue
        if not begun and batch.column("founder")[0] != batch.column("_ord")[0]:
            before = batch.column("founder")[0]
        begun = True
        if before is not None:
            others = pc.not_equal(batch.column("founder"), before).to_numpy(zero_copy_only=False)
            n = int(others.argmax()) if others.any() else batch.num_rows
            yield undecided(batch.slice(0, n))
            batch = batch.slice(n)
            if not batch.num_rows:
                continue
            before = None
        if holder is not None:
            batch = pa.Table.from_batches([holder, batch]).combine_chunks().to_batches()[0]
        losers, winners, last = _folded(batch)
        newer = pa.array(np.maximum(losers, winners))
        lost = [batch.column("_ord").take(pa.array(losers)), batch.column("_ord").take(pa.array(winners)), batch.column("tier").take(newer)]
        yield pa.RecordBatch.from_arrays(lost + [pa.nulls(len(losers), f.type) for f in list(out)[3:]], schema=out)
        holder = batch.slice(last, 1)
    if holder is not None:
        yield undecided(holder)


def _folded(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, int]:
    """(losers, winners, holder of the last class) as places among rows sorted by class and order: the n-th rows of all classes at once."""
    founder, posted = rows.column("founder"), rows.column("posted_key").dictionary_encode()
    kind = 2 * _flags(rows.column("has_description")) + _flags(rows.column("has_type"))
    rank = np.empty(len(posted.dictionary), np.int64)
    rank[pc.sort_indices(posted.dictionary).to_numpy()] = np.arange(len(rank))
    date = rank[posted.indices.to_numpy()]
    begins = np.flatnonzero(np.concatenate([[True], pc.not_equal(founder.slice(1), founder.slice(0, len(founder) - 1)).to_numpy(zero_copy_only=False)]))
    sizes = np.diff(np.append(begins, rows.num_rows))
    by_size = np.argsort(-sizes, kind="stable")
    last, begins, sizes = int(np.argmax(by_size == len(sizes) - 1)), begins[by_size], sizes[by_size]
    holders, losers, winners = begins.copy(), [begins[:0]], [begins[:0]]
    # classes come largest first, so those with an n-th row come first
    for n, classes in enumerate(np.searchsorted(-sizes, -np.arange(1, sizes[0]), side="left"), 1):
        new, old = begins[:classes] + n, holders[:classes]
        better = (kind[new] & ~kind[old] != 0) | (kind[new] == kind[old]) & (date[new] < date[old])
        holders[:classes], lost = np.where(better, new, old), np.where(better, old, new)
        losers.append(lost)
        winners.append(holders[:classes].copy())
    return np.concatenate(losers), np.concatenate(winners), int(holders[last])


def _flags(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def _chained(rows: DataFrame) -> DataFrame:
    """As replayed(), of classes that go on over several ranges, each range from the holder that the ranges before it leave: one row a range."""
    kind, tier_kind = (rows.schema[c].dataType.simpleString() for c in ("_ord", "tier"))
    ranged = checkpointed(rows.select("_ord", "founder", "tier", *TRAITS).repartitionByRange("founder", "_ord").withColumn("_range", F.spark_partition_id()))
    holder = f"struct<row:{kind},described:boolean,typed:boolean,posted:string>"
    ends = f"_range int, founder {kind}, fixed array<{holder}>, least array<{holder}>"
    ends_out = arrow_schema(ends)
    ordered = ranged.sortWithinPartitions("founder", "_ord").select("_range", "founder", "_ord", "tier", *TRAITS)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first and the last class of a range: no other goes on beyond it."""
        parts: list[tuple] = []
        for batch in batches:
            for at, founder, row, _, *traits in _rows(batch):
                if not parts or parts[-1][1] != founder:
                    parts[1:] = []
                    parts.append((at, founder, Passage()))
                parts[-1][2].add(Holder(row, *traits))
        plain = lambda holders: [h and h._asdict() for h in holders]
        made = [(a, f, plain(p.fixed), plain(p.least)) for a, f, p in parts]
        yield _batch(made, ends_out)

    starts = f"_range int, founder {kind}, start {holder}"
    starts_out = arrow_schema(starts)

    def chained(group: pa.Table) -> pa.Table:
        """The holder with which each range of a class begins."""
        made, current = [], None
        for r in group.sort_by("_range").to_pylist():
            passage = Passage()
            for name in ("fixed", "least"):
                setattr(passage, name, [h and Holder(**h) for h in r[name]])
            if current is not None:
                made.append((r["_range"], r["founder"], current._asdict()))
                current = passage.of(current)
            else:
                current = _opened(passage)
        return pa.Table.from_batches([_batch(made, starts_out)])

    begun = ordered.mapInArrow(summed, ends).groupBy("founder").applyInArrow(chained, starts)
    # one row a range at most, whatever the rows
    met = ranged.join(F.broadcast(checkpointed(begun)), ["_range", "founder"], "left").sortWithinPartitions("founder", "_ord").select("_range", "founder", "_ord", "tier", *TRAITS, "start")
    out = arrow_schema(schema := f"loser {kind}, winner {kind}, tier {tier_kind}")

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        founder, current = None, None
        for batch in batches:
            removed = []
            for _, own, row, tier, described, typed, posted, start in _rows(batch):
                if own != founder:
                    founder, current = own, Holder(**start) if start else None
                new = Holder(row, described, typed, posted)
                if current is None:
                    current = new
                elif prefers(new, current):
                    removed.append((current.row, row, tier))
                    current = new
                else:
                    removed.append((row, current.row, tier))
            yield _batch(removed, out)

    return met.mapInArrow(replay, schema)


def _opened(passage: Passage) -> Holder:
    """The holder after a class's first range, whose first row is its founder.

    It is what the range makes of a holder that lacks everything: a founder with
    a trait beats that, and one without is the first that is posted.
    """
    fixed = passage.fixed[0]
    return fixed if fixed is not None else passage.least[0]


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)


def fold_apart(keyed: DataFrame, flat: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(loser, winner, tier): the fold over all rows; keyed: (_ord, traits), flat: (_ord, i, tier, key in one or more columns)."""
    with written() as paths:
        classes = joined_classes(shared_keys(flat), most_rounds)
        members = stored(classes.join(keyed.select("_ord", *TRAITS).hint("merge"), "_ord"), "members")
    drop_stored(keyed.sparkSession, paths[:-1])
    found = replayed(members)
    drop_stored(keyed.sparkSession, paths[-1:])
    return found
