"""Ranked lexical search over a bit-sliced impact index.

The index has a row for each block of documents. A posting's impact is a whole
number, how much a term adds to a document's score before the term's weight,
and a block stores the impacts of its postings slice by slice: all their lowest
bits, all the next, and so on, each as one run of bits. For a query, each
term's part of every slice is spread over the block's documents as a bitmap;
weights are multiplied in by shifts and additions, and terms are added up, with
carries from slice to slice, for all documents of the block at once. The best k
are found from the highest slice down: as long as a slice has k candidates or
more, others are out; where it has fewer, these are in.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlode.shared import arrow_schema, slices, stored

#: A term is a run of ASCII letters and digits and of anything beyond ASCII; A-Z become a-z.
SIGNS = bytes(i + 32 if 65 <= i <= 90 else i if i > 127 or chr(i).isalnum() else 32 for i in range(256))
#: Documents of a block, and its postings, at most (a longer document is a block of its own).
BLOCK, POSTINGS = 4096, 1 << 21
#: Queries that meet a block in one row; those that are worked on together; chunks up to which they are broadcast.
CHUNK, TOGETHER, BROADCAST = 1024, 64, 8


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(SIGNS).split()


def statistics(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(documents that have a term, all their terms with repeats)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = [len(terms(t)) for batch in slices(batches, "text") for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([sum(map(bool, sizes))], pa.int64()), pa.array([sum(sizes)], pa.int64())], names=["n", "l"])

    n, total = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    return n or 0, total or 0


class _Block:
    """Postings of some documents, in order of reading."""

    def __init__(self) -> None:
        self.ids: list = []
        self.sizes: list[int] = []
        self.numbers: dict[bytes, int] = {}
        self.term: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.postings = 0

    def add(self, doc_id: object, words: list[bytes]) -> None:
        counts, numbers = Counter(words), self.numbers
        self.ids.append(doc_id)
        self.sizes.append(len(words))
        self.term.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in counts), np.int64, len(counts)))
        self.times.append(np.fromiter(counts.values(), np.int64, len(counts)))
        self.postings += len(counts)

    def row(self, n: int, total: int) -> list:
        """[ids, words, df, places, bits, slices] with documents in order of id, null last."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] if self.ids[i] is not None else 0))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        lengths = np.array([25 + 75 * s * n // total for s in self.sizes], np.int64)
        doc = np.repeat(np.arange(len(order)), list(map(len, self.term)))
        term, times = np.concatenate(self.term), np.concatenate(self.times)
        impact = 1_000_000_000 * times // (1000 * times + 8 * lengths[doc])
        by_term = np.lexsort((place[doc], term))
        impact, bits = impact[by_term], int(impact.max()).bit_length()
        cut = np.stack([np.packbits((impact >> j & 1).astype(np.uint8), bitorder="little") for j in range(bits)])
        return [[self.ids[i] for i in order], list(self.numbers), np.bincount(term), place[doc][by_term].astype(np.uint16).tobytes(), bits, cut.tobytes()]


def build(docs: DataFrame, n: int, total: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all documents that have a term; n and total: see statistics().

    A row is a block: ids, words, df (the block's documents that hold each
    word), places of the postings word by word, and the slices of their
    impacts, bits of them. Repeated rows are documents of their own.
    """
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"ids array<{named.schema['id'].dataType.simpleString()}>, words array<binary>, df array<int>, places binary, bits int, slices binary"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()

        def flush() -> pa.RecordBatch:
            nonlocal block
            values, block = block.row(n, total), _Block()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, out, strict=True)], schema=out)

        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if words := terms(text):
                    block.add(doc_id, words)
                    if len(block.ids) >= BLOCK or block.postings >= POSTINGS:
                        yield flush()
        if block.ids:
            yield flush()

    return named.mapInArrow(run, schema)


def add(total: list[int], more: list[int], shift: int = 0) -> None:
    """total += more << shift for every document: bitmaps by rising significance, added with carries."""
    total.extend([0] * (shift + len(more) - len(total)))
    carry = 0
    for j, x in enumerate(more, shift):
        s = total[j]
        either = s ^ x
        total[j] = either ^ carry
        carry = s & x | either & carry
    j = shift + len(more)
    while carry:
        if j == len(total):
            total.append(0)
        s = total[j]
        total[j], carry = s ^ carry, s & carry
        j += 1


def times(bitmaps: list[int], factor: int) -> list[int]:
    """The bitmaps of every document's number times a factor."""
    product: list[int] = []
    for j in range(factor.bit_length()):
        if factor >> j & 1:
            add(product, bitmaps, j)
    return product


def best(total: list[int], k: int) -> Iterator[tuple[int, int]]:
    """(place, score) of the k documents with the largest scores above 0; of equal ones those that come first."""
    open_, sure = 0, 0
    for s in total:
        open_ |= s
    for s in reversed(total):
        over = open_ & s
        if (n := over.bit_count()) >= k:
            open_ = over
        else:
            sure, k, open_ = sure | over, k - n, open_ ^ over
    while k and open_:
        lowest = open_ & -open_
        sure, open_, k = sure | lowest, open_ ^ lowest, k - 1
    while sure:
        place = (sure & -sure).bit_length() - 1
        yield place, sum((s >> place & 1) << j for j, s in enumerate(total))
        sure &= sure - 1


class _Open:
    """A block's row as it is read."""

    def __init__(self, ids: pa.Scalar, words: pa.Scalar, df: pa.Scalar, places: pa.Scalar, bits: pa.Scalar, cut: pa.Scalar):
        self.ids, self.words = ids.values, words.values
        ends = np.cumsum(df.values.to_numpy())
        self.bounds = np.concatenate([[0], ends]).tolist()
        self.places = np.frombuffer(places.as_buffer(), np.uint16)
        self.slices = np.frombuffer(cut.as_buffer(), np.uint8).reshape(bits.as_py(), -1)

    def bitmaps(self, word: int) -> list[int]:
        """A word's slices, spread over the places of the block's documents."""
        a, b = self.bounds[word : word + 2]
        own = np.unpackbits(self.slices[:, a >> 3 : (b + 7) >> 3], axis=1, bitorder="little")[:, a & 7 : (a & 7) + b - a]
        spread = np.zeros((len(own), len(self.ids)), np.uint8)
        spread[:, self.places[a:b]] = own
        return [int.from_bytes(x.tobytes(), "little") for x in np.packbits(spread, axis=1, bitorder="little")]


def _query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(query, item, term, times): a query is a row of items, whatever its id."""
    named = items.select(F.col(id_col).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"query long, item {named.schema['item'].dataType.simpleString()}, term binary, times int"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text"):
            rows = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows += [(row, item, w, n) for w, n in Counter(terms(text)).items()]
                row += 1
            values = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, out, strict=True)], schema=out)

    return named.mapInArrow(run, schema)


def search(index: DataFrame, items: DataFrame, n: int, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item id, rank, doc_id, score): for each row of items its k best documents with a score above 0, equal ones by id.

    Each block meets all queries, a chunk of them at a time; a task keeps the k
    best of each query over its blocks, so few rows meet in the ranking. A few
    chunks are broadcast; more are joined by their number. Null texts and texts
    without a known term give no rows; an item that is twice in items has its
    rows twice. A null doc_id ranks last among equal scores.
    """
    asked = stored(_query_terms(items, id_col, text_col), "queries")
    known = index.select(F.explode(F.arrays_zip("words", "df")).alias("x")).select(F.col("x.words").alias("term"), "x.df")
    df = known.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weighed = asked.join(df, "term").select("query", "item", "term", (weight * F.col("times")).alias("factor")).where("factor > 0")
    chunks = max(1, -(-asked.select("query").distinct().count() // CHUNK))
    grouped = weighed.groupBy(F.expr(f"cast(pmod(xxhash64(query), {chunks}) as int)").alias("chunk")).agg(F.collect_list(F.struct("query", "term", "factor")).alias("queries"))
    grouped = stored(grouped, "chunks")
    if chunks <= BROADCAST:  # BROADCAST * CHUNK queries at most
        grouped = F.broadcast(grouped)
    blocks = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).join(grouped, "chunk")
    kind = index.schema["ids"].dataType.elementType.simpleString()
    schema = f"query long, doc_id {kind}, score long"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Open(*(batch.column(c)[i] for c in ("ids", "words", "df", "places", "bits", "slices")))
                asked_terms = pa.table(dict(zip(("query", "term", "factor"), batch.column("queries")[i].values.flatten(), strict=True)))
                word = pc.index_in(asked_terms.column("term").combine_chunks(), value_set=block.words)
                rows = asked_terms.append_column("word", word).filter(pc.is_valid(word)).sort_by("query")
                _answer(block, rows, k, held)
        rows = [(query, doc_id, -score) for query, found in held.items() for score, _, doc_id in found]
        values = zip(*rows, strict=True) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, out, strict=True)], schema=out)

    found = blocks.select("ids", "words", "df", "places", "bits", "slices", "queries").mapInArrow(run, schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("query", "item").distinct(), "query").select(F.col("item").alias(id_col), "rank", "doc_id", "score")


def _answer(block: _Open, rows: pa.Table, k: int, held: dict[int, list[tuple]]) -> None:
    """Puts the k best documents of each query, of those held and those of the block, in `held`."""
    queries, words, factors = (rows.column(c).to_pylist() for c in ("query", "word", "factor"))
    cache: dict[tuple[int, int], list[int]] = {}
    total: list[int] = []
    done = 0
    for i, (query, word, factor) in enumerate(zip(queries, words, factors, strict=True)):
        if (word, factor) not in cache:
            cache[word, factor] = times(block.bitmaps(word), factor)
        add(total, cache[word, factor])
        if i + 1 == len(queries) or queries[i + 1] != query:
            found = [(-score, block.ids[place].as_py()) for place, score in best(total, k)]
            held[query] = heapq.nsmallest(k, [*held.get(query, []), *((s, (x is None, x if x is not None else 0), x) for s, x in found)], key=lambda r: r[:2])
            total, done = [], done + 1
            if done % TOGETHER == 0:
                cache.clear()
