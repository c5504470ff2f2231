"""SimHash near-duplicates: exact comparison of fingerprints in tiles.

Only distinct fingerprints are compared. Two of them that differ in at most r
bits agree in some of b > r bands of bits, b - r of them at least, so all links
are found inside the groups of equal bands. A group is cut into tiles of
bounded size by population count, every pair of tiles whose counts come within
the radius is compared by exclusive-or and bit counts, and a comparison returns
no more than the edges of a spanning forest, none of whose nodes has many.
Min-label rounds over those edges give the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlode.operators.components import components
from postlode.shared import arrow_schema, checkpointed, slices, stored


LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Edges of a node of a spanning tree, besides that to the node above.
FANOUT = 4


def fingerprint(text: str, shingle: int = 4) -> int:
    """A bit is 1 if it is set in over half the hashes of the word shingles; without words it is 0."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: len(words) - k].tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], 42) for a, b in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=True)]
    bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        some = np.array(hashes[i : i + (1 << 16)], "<u8")
        bits += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, row: Column | None = None) -> DataFrame:
    """(id, fp): the fingerprint's 64 bits as a signed long, for each row; null texts count as empty. With `row`, that binary too."""
    more = [] if row is None else [row.alias("row")]
    named = docs.select(F.col(id_col).alias("id"), *more, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"id {named.schema['id'].dataType.simpleString()}, {'row binary, ' if more else ''}fp long"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fps = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).cast(out.field(c).type) for c in out.names[:-1]), pa.array(fps.view(np.int64))], schema=out)

    return named.mapInArrow(run, schema)


def forest(a: np.ndarray, b: np.ndarray, radius: int, labels: np.ndarray, block: int = 512) -> None:
    """Joins labels (of a, then of b; of a alone if b is a) where fingerprints link; a and b are in order of population count."""
    same = a is b
    pa_, pb = np.bitwise_count(a).astype(np.int64), np.bitwise_count(b).astype(np.int64)
    shift = 0 if same else len(a)
    for i in range(0, len(a), block):
        rows = a[i : i + block]
        first = np.searchsorted(pb, pa_[i] - radius)
        last = np.searchsorted(pb, pa_[min(i + block, len(a)) - 1] + radius, "right")
        for j in range(max(first, i) if same else first, last, 4 * block):
            cols = b[j : min(j + 4 * block, last)]
            near = np.bitwise_count(rows[:, None] ^ cols[None, :]) <= radius
            x, y = np.nonzero(near)
            if len(x):
                link(labels, x + i, y + j + shift)


def link(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Makes labels equal along the pairs (x, y); labels point to places with labels of their own until they stay."""
    while True:
        lx, ly = labels[x], labels[y]
        differ = lx != ly
        if not differ.any():
            return
        x, y, lx, ly = x[differ], y[differ], lx[differ], ly[differ]
        np.minimum.at(labels, np.maximum(lx, ly), np.minimum(lx, ly))
        while (labels != (up := labels[labels])).any():
            labels[:] = up


def band_masks(radius: int, n: int, tile: int) -> list[int]:
    """Masks of which fingerprints within the radius share one at least: of radius + 1 bands, one each, or of three bands more, three each, if else n fingerprints would make groups over a tile."""
    equal = 1 if n >> 64 // (radius + 1) <= tile else 3
    count = radius + equal
    edges = [64 * i // count for i in range(count + 1)]
    bands = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(x) for x in combinations(bands, equal)]


def _cells(distinct: DataFrame, radius: int, tile: int, masks: list[int]) -> DataFrame:
    """(cell, part, fp): part 0 is compared within itself and with part 1; both hold a tile."""
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    bands = [F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(signed)]
    rows = distinct.select("fp", F.explode(F.array(*bands)).alias("b")).select("fp", "b.*", F.bit_count("fp").alias("pop"))
    pops = rows.groupBy("band", "value", "pop").agg(F.count("*").alias("n"))
    # of a large group, how many tiles each population count has
    tiles = F.map_from_entries(F.collect_list(F.struct("pop", F.ceil(F.col("n") / tile).cast("int").alias("k"))))
    large = pops.groupBy("band", "value").agg(F.sum("n").alias("n"), tiles.alias("tiles")).where(F.col("n") > tile).drop("n")
    rows = rows.join(large, ["band", "value"], "left").withColumn("t", F.expr("pmod(xxhash64(fp), tiles[pop])::int"))
    small = rows.where("tiles is null").select(F.concat_ws(",", "band", "value").alias("cell"), F.lit(0).alias("part"), "fp")
    place = lambda p, t: F.concat_ws(",", "band", "value", p, t)
    # tile (p, t) meets each tile (q, u) with p <= q <= p + radius; of equal counts, those with t <= u
    first = F.expr(f"flatten(transform(filter(sequence(pop, pop + {radius}), q -> tiles[q] IS NOT NULL), q -> transform(sequence(if(q = pop, t, 0), tiles[q] - 1), u -> struct(pop AS p, t AS t, q AS q, u AS u))))")
    second = F.expr(f"flatten(transform(filter(sequence(pop - {radius}, pop), p -> tiles[p] IS NOT NULL), p -> transform(filter(sequence(0, tiles[p] - 1), v -> p < pop OR v < t), v -> struct(p AS p, v AS t, pop AS q, t AS u))))")
    hot = rows.where("tiles is not null").select("band", "value", "fp", F.explode(F.concat(F.transform(first, lambda c: F.struct(F.lit(0).alias("part"), c.alias("c"))), F.transform(second, lambda c: F.struct(F.lit(1).alias("part"), c.alias("c"))))).alias("x"))
    return small.unionByName(hot.select(F.concat_ws(",", place("x.c.p", "x.c.t"), "x.c.q", "x.c.u").alias("cell"), "x.part", "fp"))


def tree_edges(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places to join so that those of equal labels hang together: each to one of FANOUT times fewer, no place many times."""
    order = np.argsort(labels, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(labels[order]) != 0]))
    sizes = np.diff(np.concatenate([starts, [len(order)]]))
    rank = np.arange(len(order)) - np.repeat(starts, sizes)
    lower = np.flatnonzero(rank > 0)
    return order[lower], order[lower - rank[lower] + (rank[lower] - 1) // FANOUT]


def links(distinct: DataFrame, radius: int = 4, tile: int = 4096) -> DataFrame:
    """(a, b): edges between distinct fingerprints that connect just those the links connect."""
    cells = _cells(distinct, radius, tile, band_masks(radius, distinct.count(), tile))
    schema = "a long, b long"
    out = arrow_schema(schema)

    def compare(part: np.ndarray, fps: np.ndarray) -> np.ndarray:
        fps = fps.view(np.uint64)
        a, b = (x[np.argsort(np.bitwise_count(x), kind="stable")] for x in (fps[part == 0], fps[part == 1]))
        everything = np.concatenate([a, b])
        labels = np.arange(len(everything))
        forest(a, a, radius, labels)
        if len(b):
            forest(a, b, radius, labels)
        x, y = tree_edges(labels)
        return np.stack([everything[x], everything[y]]).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; a cell that a batch cuts is carried on."""
        held: list[tuple[np.ndarray, ...]] = []
        cell = None
        found: list[np.ndarray] = []

        def flush() -> None:
            if held and sum(len(h[0]) for h in held) > 1:
                found.append(compare(*(np.concatenate(x) for x in zip(*held, strict=True))))
            held.clear()

        def edges() -> pa.RecordBatch:
            both = np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], schema=out)

        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("cell").dictionary_encode()
            codes, names = names.indices.to_numpy(zero_copy_only=False), names.dictionary.to_pylist()
            part, fps = batch.column("part").to_numpy(zero_copy_only=False), batch.column("fp").to_numpy(zero_copy_only=False)
            bounds = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
            for i, j in zip(bounds, bounds[1:], strict=False):
                if (name := names[codes[i]]) != cell:
                    flush()
                    cell = name
                held.append((part[i:j], fps[i:j]))
            yield edges()
        flush()
        yield edges()

    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, schema)


def _rooted(classes: DataFrame, radius: int, tile: int) -> DataFrame:
    """(fp, least, root) of distinct fingerprints (fp, least): those of one component have one root."""
    classes = stored(classes, "classes")
    roots = components(links(classes.select("fp"), radius, tile))
    return checkpointed(classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("root")))


def representatives(docs: DataFrame, row: Column, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, shingle: int = 4, tile: int = 4096) -> DataFrame:
    """(row): of each component of near-duplicates the row first by id, rows without one last, and then by `row`, a binary that tells rows apart.

    Components are of rows, not of ids: rows that repeat an id with texts of
    different components are in all of these.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle, row), "fingerprints")
    rooted = _rooted(prints.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("least")), radius, tile)
    return rooted.groupBy("root").agg(F.min("least").alias("least")).select("least.row")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, shingle: int = 4, tile: int = 4096) -> DataFrame:
    """(id, fp, component_id): one row for each row of docs.

    component_id is the smallest id among the rows whose fingerprints are
    linked, directly or by a chain, by at most `radius` differing bits. Rows
    without words have fingerprint 0 and link as any other. Rows with a null
    id join by their fingerprint but are never a component's id, unless no row has one.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    rooted = _rooted(prints.groupBy("fp").agg(F.min("id").alias("least")), radius, tile)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(named, F.col("fp") == F.col("_fp")).select(F.col("id").alias(id_col), "fp", "component_id")
