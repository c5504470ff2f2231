"""Exact repeats of word runs, by fixed-block anchors.

Documents are packed into batches, which are written once. Non-overlapping
blocks of every document are the index; every rolling window of the same
length probes it. A run of `window` words holds exactly one whole block of its
own document (a block has (window + 1) / 2 words), and if the run occurs
elsewhere, a rolling window there equals that block. So only runs around a
block that was hit are extended to their full length and compared, and runs
that prove equal merge into maximal repeats.

Blocks, windows and runs travel as sorted arrays of hashes, one row for each
pair of hash range and group of batches. Groups grow with the number of ranges,
so that a row holds thousands of hashes at any size of the input, and beyond
LEVEL_RANGES ranges rows are dealt out in two levels. A group sends each
different hash once, however often its texts hold it, and a range's arrays fit
a task because the number of ranges follows the input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.shared import arrow_schema, shared_folder, slices, wrote


U = np.uint64
#: Bytes of text in a batch, in a group of batches at most, and in a range of hashes.
BATCH_BYTES, GROUP_BYTES, RANGE_BYTES = 3 << 20, 24 << 20, 12 << 20
#: Hashes that a row should hold, ranges that one level of dealing out makes at most, and hashes that a task of the second level holds.
ROW_HASHES, LEVEL_RANGES, CHUNK_HASHES = 4096, 4096, 2 << 20
#: Tasks that share the ranges at most, each taking some of them one after another.
MOST_TASKS = 1 << 15
#: Bits of a hash that travel below its range.
KEPT = 48
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(29))) * U(0xA0761D6478BD642F)
    return x ^ (x >> U(32))


def word_places(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start and end."""
    gap = np.concatenate([[True], SPACE[np.frombuffer(blob, np.uint8)], [True]])
    turns = np.flatnonzero(gap[1:] != gap[:-1])
    return turns[::2], turns[1::2]


def word_hashes(blob: bytes, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time."""
    padded = blob + bytes(8)
    eights = np.ndarray((len(blob) + 1,), "<u8", padded, strides=(1,))
    size = ends - starts
    out = mixed(size.astype(U) + U(seed))
    at = np.arange(len(starts))
    k = 0
    while len(at):
        left = size[at] - k
        load = eights[starts[at] + k]
        part = left < 8
        load[part] &= (U(1) << (left[part].astype(U) * U(8))) - U(1)
        out[at] = mixed(out[at] ^ load)
        k += 8
        at = at[left > 8]
    return out


@lru_cache(4)
def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** k and base ** -k modulo 2 ** 64 for k up to n."""
    up, down = np.full(n + 1, base, U), np.full(n + 1, pow(base, -1, 1 << 64), U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def window_hashes(hashes: np.ndarray, starts: np.ndarray, length: int, seed: int) -> np.ndarray:
    """The hash of `length` words from each of starts."""
    up, down = powers((0x9E3779B97F4A7C15 + 2 * seed) | 1, 1 << max(10, int(len(hashes)).bit_length()))
    sums = np.concatenate([[U(0)], np.cumsum(hashes * up[: len(hashes)])])
    return mixed((sums[starts + length] - sums[starts]) * down[starts])


class Batch:
    """Words of a batch of documents and the bounds of each document in words."""

    def __init__(self, blob: bytes, lengths: np.ndarray):
        self.blob = blob
        self.starts, self.ends = word_places(blob)
        self.stops = np.cumsum(lengths + 1)  # one byte parts documents
        self.bounds = np.searchsorted(self.starts, np.concatenate([[0], self.stops]))
        self.first = np.repeat(self.bounds[:-1], np.diff(self.bounds))
        self.last = np.repeat(self.bounds[1:], np.diff(self.bounds))

    def hashes(self, seed: int) -> np.ndarray:
        return word_hashes(self.blob, self.starts, self.ends, seed)

    def rolling(self, length: int) -> np.ndarray:
        at = np.arange(len(self.starts))
        return at[at + length <= self.last]

    def anchors(self, length: int) -> np.ndarray:
        at = self.rolling(length)
        return at[(at - self.first[at]) % length == 0]


def packed(docs: DataFrame, text_col: str, group_bytes: int, buckets: int) -> DataFrame:
    """(group_id, batch_id, rows, lengths, blob): documents in batches, bucketed by their group in the shared folder.

    The table leaves the catalogue at once; its files stay for the plans that read them.
    """
    spark = docs.sparkSession
    others = [docs[c] for c in docs.columns if c != text_col] or [F.lit(0).alias("none")]
    named = docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"), F.struct(*others).alias("_row"))
    schema = f"group_id long, batch_id long, rows array<{named.schema['_row'].dataType.simpleString()}>, lengths binary, blob binary"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, group, held = TaskContext.get().partitionId(), 0, 0, 0
        for batch in slices(batches, "_text", BATCH_BYTES):
            if not batch.num_rows:
                continue
            texts = batch.column("_text").to_pylist()
            lengths = np.array(list(map(len, texts)), "<i8")
            if held and held + int(lengths.sum()) > group_bytes:
                group, held = group + 1, 0
            held += int(lengths.sum())
            blob = zstandard.compress(b"\n".join([*texts, b""]), 3)
            row = batch.column("_row").cast(out.field("rows").type.value_type)
            rows = pa.ListArray.from_arrays(pa.array([0, len(row)], pa.int32()), row).cast(out.field("rows").type)
            yield pa.RecordBatch.from_arrays([pa.array([part << 32 | group], pa.int64()), pa.array([part << 32 | n], pa.int64()), rows, pa.array([lengths.tobytes()]), pa.array([blob])], schema=out)
            n += 1

    name = f"postlode_batches_{uuid.uuid4().hex}"
    wrote(path := f"{shared_folder(spark)}/{name}")
    written = named.mapInArrow(run, schema).write.option("path", path)
    written.bucketBy(buckets, "group_id").saveAsTable(name)
    batches = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return batches


def _read(batch: pa.RecordBatch, i: int) -> Batch:
    return Batch(zstandard.decompress(batch.column("blob")[i].as_py()), np.frombuffer(batch.column("lengths")[i].as_py(), "<i8"))


#: Hashes of a range, dealt out: groups and how many hashes of each, 48 bits of each hash below the range
#: (32 that differ, and 16 that hardly change from one to the next), further bits, and two marks.
HASHES = "range int, groups binary, counts binary, low binary, high binary, further binary, anchor binary, twice binary"


class Hashes:
    """Hashes of one range in arrays: owner (a group), kept bits, further bits (none or 32), marks."""

    def __init__(self, owner: np.ndarray, kept: np.ndarray, further: np.ndarray, anchor: np.ndarray, twice: np.ndarray):
        self.owner, self.kept, self.further, self.anchor, self.twice = owner, kept, further, anchor, twice

    def row(self, number: int, at: slice | np.ndarray) -> tuple:
        """The places `at`, in order of owner, as a row of HASHES."""
        owner, kept = self.owner[at], self.kept[at]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        counts = np.diff(np.concatenate([first, [len(owner)]]))
        further = self.further[at].tobytes() if len(self.further) else b""
        return number, owner[first].astype("<i8").tobytes(), counts.astype("<i4").tobytes(), kept.astype("<u4").tobytes(), (kept >> U(32)).astype("<u2").tobytes(), further, np.packbits(self.anchor[at]).tobytes(), np.packbits(self.twice[at]).tobytes()

    @classmethod
    def of(cls, table: pa.Table | pa.RecordBatch) -> Hashes:
        """All rows of a table, which are of one range."""
        of = lambda name: table.column(name).to_pylist()
        whole = lambda name, kind: np.frombuffer(b"".join(of(name)), kind)
        sizes = [len(x) // 4 for x in of("low")]
        marks = lambda name: np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(of(name), sizes, strict=True)])
        kept = whole("high", "<u2").astype(U) << U(32) | whole("low", "<u4")
        return cls(np.repeat(whole("groups", "<i8"), whole("counts", "<i4")), kept, whole("further", "<u4"), marks("anchor"), marks("twice"))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True) if rows else [()] * len(schema), schema, strict=True)], schema=schema)


def _top(h: np.ndarray, bits: int) -> np.ndarray:
    """What is kept of whole hashes: the bits of a first level of `bits` bits, and KEPT bits below them."""
    lost = max(0, 64 - bits - KEPT)
    return h >> U(lost) << U(lost)


def _whole(number: int, kept: np.ndarray, bits: int) -> np.ndarray:
    """Hashes from the number of their range (of `bits` bits) and the bits kept."""
    return (U(number) << U(64 - bits) if bits else U(0)) | (kept << U(64 - KEPT)) >> U(bits)


def _dealt(h: np.ndarray, further: np.ndarray, anchor: np.ndarray, group: int, bits: int) -> Iterator[tuple]:
    """A row for each range that has some of a group's hashes: each different hash once, marked if it came twice."""
    order = np.lexsort((further, h)) if len(further) else np.argsort(h)
    h, anchor, further = h[order], anchor[order], further[order] if len(further) else further
    differ = h[1:] != h[:-1]
    new = np.flatnonzero(np.concatenate([[True], differ | (further[1:] != further[:-1]) if len(further) else differ]))
    twice = np.diff(np.concatenate([new, [len(h)]])) > 1
    anchor, h, further = np.maximum.reduceat(anchor.astype(np.uint8), new), h[new], further[new] if len(further) else further
    hashes = Hashes(np.full(len(h), group), (h << U(bits)) >> U(64 - KEPT), further, anchor, twice)
    cuts = [0, *(np.searchsorted(h, np.arange(1, 1 << bits, dtype=U) << U(64 - bits)).tolist() if bits else ()), len(h)]
    return (hashes.row(r, slice(a, b)) for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b)


def _by_group(batches: DataFrame, find: Callable[[Batch, pa.RecordBatch, int], tuple[np.ndarray, np.ndarray, np.ndarray]], bits: int) -> DataFrame:
    """HASHES of what `find` gives (hashes, further bits, anchor) for each batch, together for batches of a group that come one after another."""
    out = arrow_schema(HASHES)

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        group = None

        def flush() -> Iterator[pa.RecordBatch]:
            if sum(len(x[0]) for x in held):
                yield _table(list(_dealt(*map(np.concatenate, zip(*held, strict=True)), group, bits)), out)
            held.clear()

        for batch in incoming:
            for i, own in enumerate(batch.column("group_id").to_pylist()):
                if own != group:
                    yield from flush()
                    group = own
                held.append(find(_read(batch, i), batch, i))
        yield from flush()

    return batches.mapInArrow(run, HASHES)


def _ranged(hashes: DataFrame, bits: int, first: int) -> DataFrame:
    """hashes with the rows of each of 2 ** bits ranges together in a partition; those of 2 ** first ranges are dealt out again where these are fewer."""
    tasks = min(bits, MOST_TASKS.bit_length() - 1)
    if bits == first:
        return hashes.repartitionById(1 << bits, "range")
    out, more, spread = arrow_schema(HASHES), bits - first, max(0, tasks - first)

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, number = 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                all_hashes = Hashes.of(pa.Table.from_batches(held))
                fine = (all_hashes.kept >> U(KEPT - more)).astype(np.int64)
                all_hashes.kept = all_hashes.kept << U(64 - KEPT + more) >> U(64 - KEPT)
                order = np.argsort(fine, kind="stable")
                cuts = np.searchsorted(fine[order], np.arange((1 << more) + 1)).tolist()
                yield _table([all_hashes.row(number << more | r, order[a:b]) for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b], out)
            held.clear()

        for batch in incoming:
            for i, own in enumerate(batch.column("range").to_pylist()):
                if own != number or size >= CHUNK_HASHES:
                    yield from flush()
                    number, size = own, 0
                held.append(batch.slice(i, 1))
                size += len(batch.column("low")[i].as_py()) // 4
        yield from flush()

    # dealing out again needs rows of one range together, but not all of them
    part = F.shiftleft("range", spread) + F.pmod(F.xxhash64("groups"), F.lit(1 << spread)).cast("int")
    fine = hashes.repartitionById(1 << first + spread, part).mapInArrow(run, HASHES)
    return fine.repartitionById(1 << tasks, F.shiftright("range", bits - tasks)).sortWithinPartitions("range")


def _found_again(hashes: DataFrame, anchors: bool, bits: int) -> DataFrame:
    """(group_id, hashes, further): whole hashes of each group that came twice or more in all; with `anchors`, those of blocks alone."""
    schema = "group_id long, hashes binary, further binary"
    out = arrow_schema(schema)

    def again(number: int, x: Hashes) -> pa.RecordBatch:
        order = np.lexsort((x.further, x.kept)) if len(x.further) else np.argsort(x.kept, kind="stable")
        kept, further = x.kept[order], x.further[order] if len(x.further) else x.further
        differ = kept[1:] != kept[:-1]
        same = np.cumsum(np.concatenate([[True], differ | (further[1:] != further[:-1]) if len(further) else differ])) - 1
        many = np.bincount(same, 1 + x.twice[order]) > 1
        found = order[many[same] & x.anchor[order].astype(bool) if anchors else many[same]]
        found = found[np.argsort(x.owner[found], kind="stable")]
        own, first = np.unique(x.owner[found], return_index=True)
        cuts, whole = [*first.tolist(), len(found)], _whole(number, x.kept[found], bits).astype("<u8")
        further = x.further[found] if len(x.further) else x.further
        return _table([(g, whole[a:b].tobytes(), further[a:b].tobytes()) for g, a, b in zip(own.tolist(), cuts, cuts[1:], strict=False)], out)

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number = None
        for batch in incoming:
            ranges = batch.column("range").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(ranges[1:] != ranges[:-1]) + 1).tolist(), len(ranges)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if held and ranges[a] != number:
                    yield again(number, Hashes.of(pa.Table.from_batches(held)))
                    held.clear()
                if a < b:
                    number = int(ranges[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield again(number, Hashes.of(pa.Table.from_batches(held)))

    return hashes.mapInArrow(run, schema)


def _answers(column: pa.ChunkedArray | pa.Array, i: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column[i].values) if column[i].is_valid else b"", kind)


def _among(h: np.ndarray, other: np.ndarray, wanted: np.ndarray, wanted_other: np.ndarray) -> np.ndarray:
    """Which (h, other) are among the wanted."""
    order = np.argsort(wanted)
    wanted, wanted_other = np.append(wanted[order], U(0)), np.append(wanted_other[order], np.uint32(0))
    out, at = np.zeros(len(h), bool), np.searchsorted(wanted[:-1], h)
    left = np.flatnonzero((at < len(order)) & (wanted[at] == h))
    at = at[left]
    while len(left):  # once, unless wanted ones differ in the further bits alone
        out[left] |= wanted_other[at] == other[left]
        at += 1
        on = (at < len(order)) & (wanted[at] == h[left]) & ~out[left]
        left, at = left[on], at[on]
    return out


def remove_repeats(docs: DataFrame, text_col: str = "text", window: int = 35) -> DataFrame:
    """docs with text_col's repeated words taken out, and n_words, n_removed and spans.

    A run of `window` words of one row is a repeat if the same words start
    anywhere else in the table, in the same row too; each word that a repeat
    covers goes. The words that stay are joined by one space. spans are the
    maximal repeats as (first word, word after the last). Null and empty texts
    become empty; rows that repeat an id are rows of their own; columns besides
    the text pass through unchanged, unless they have the name of a new one,
    which takes their place. Tables without rows or without repeats pass whole.

    Runs are compared by two independent hashes of 32 bits and of 48 bits and
    those of the first level of ranges, 80 to 92 in all, not word by word: that
    any two of 10 ** 12 different runs, in ranges of all 92 bits, are taken for
    equal has a chance of one in ten thousand.
    """
    spark, block = docs.sparkSession, (window + 1) // 2
    docs = docs.drop("n_words", "n_removed", "spans")
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // RANGE_BYTES, 1)
    bits = (wanted - 1).bit_length()
    first = min(bits, LEVEL_RANGES.bit_length() - 1)
    group_bytes = min(GROUP_BYTES, max(BATCH_BYTES, 6 * ROW_HASHES << first))
    # with fewer buckets than shuffle partitions Spark would shuffle the batches for the joins; tasks read a bucket batch by batch
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // GROUP_BYTES)
    batches = packed(docs, text_col, group_bytes, min(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))))
    none = np.zeros(0, "<u4")

    def windows(words: Batch, batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = words.rolling(block)
        return _top(window_hashes(words.hashes(1), at, block, 1), first), none, (at - words.first[at]) % block == 0

    def run_hashes(words: Batch, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        other = window_hashes(words.hashes(2), at, window, 2) >> U(32)
        return _top(window_hashes(words.hashes(1), at, window, 1), first), other.astype("<u4")

    def runs(words: Batch, batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The runs of full length around each block that was hit."""
        anchors = words.anchors(block)
        h = _top(window_hashes(words.hashes(1), anchors, block, 1), first)
        hit = anchors[np.isin(h, _answers(batch.column("hits"), i, "<u8"))]
        at = (hit[:, None] - np.arange(block - 1, -1, -1)).ravel()
        at = at[np.repeat(words.first[hit], block) <= at]
        at = at[at + window <= words.last[at]]
        return *run_hashes(words, at), np.zeros(len(at), bool)

    texts = batches.select("group_id", "lengths", "blob")
    hits = _found_again(_ranged(_by_group(texts, windows, first), bits, first), True, bits).groupBy("group_id").agg(F.collect_list("hashes").alias("hits"))
    around = _by_group(texts.join(hits, "group_id"), runs, first)
    again = _found_again(_ranged(around, bits, first), False, bits).groupBy("group_id").agg(F.collect_list("hashes").alias("hashes"), F.collect_list("further").alias("further"))
    others = [f for f in docs.schema if f.name != text_col]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), f"`{text_col}` string, n_words long, n_removed long, spans array<struct<first:int,after:int>>"])
    out = arrow_schema(schema)

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            for i in range(batch.num_rows):
                words = _read(batch, i)
                cover = np.zeros(len(words.starts) + 1, np.int64)
                wanted = _answers(batch.column("hashes"), i, "<u8")
                if len(wanted) and len(at := words.rolling(window)):
                    at = at[_among(*run_hashes(words, at), wanted, _answers(batch.column("further"), i, "<u4"))]
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + window, -1)
                gone = np.cumsum(cover)[:-1] > 0
                texts, removed, spans = [], [], []
                stops = [0, *words.stops.tolist()]
                for a, b, x, y in zip(words.bounds.tolist(), words.bounds[1:].tolist(), stops, stops[1:], strict=False):
                    own = words.blob[x:y].split()
                    mask = gone[a:b]
                    removed.append(int(mask.sum()))
                    turns = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))).tolist() if removed[-1] else []
                    kept = [w for s, e in zip([0, *turns[1::2]], [*turns[::2], len(own)], strict=True) for w in own[s:e]] if turns else own
                    texts.append(b" ".join(kept))
                    spans.append([{"first": s, "after": e} for s, e in zip(turns[::2], turns[1::2], strict=True)])
                fields = batch.column("rows")[i].values.flatten()[: len(others)]
                made = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(np.diff(words.bounds), pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, out.field("spans").type)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*fields, *made], out, strict=True)], schema=out)

    return batches.join(again, "group_id", "left").select("rows", "lengths", "blob", "hashes", "further").mapInArrow(run, schema)
