"""Phrase collocations by vertical positional lists.

The words of a block of documents get places, and each word the list of its
places. A phrase's list is the merge-join of two lists: places p of its first
words that have the list of its last words at p + 1, so the adjacent word's
postings count only where what ends in that word is frequent too. The lengths
of a phrase's lists over all blocks are its exact frequency. Level by level
only phrases that are frequent over all blocks are extended, and lists never
leave their block: between levels, counts alone are added up.

A phrase is named by where it first occurs, (block, place) in one number, which
needs no dictionary and no hash, so frequencies are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlode.shared import arrow_schema, drop_stored, slices, stored, written

#: UTF-8 never holds this byte: it stands for the marks and line ends between pieces.
END = 0xFF
SIGNS = bytes(END if i in b".,;:!?\n\x0b\x0c\r" else i + 32 if 65 <= i <= 90 else i for i in range(256))
#: Bits of a name that hold the place within its block.
PLACE = 28
#: Lists of a row of a block, at most.
PART = 1 << 14
LISTS = "block long, n long, firsts array<int>, k array<int>, places binary"


def tokens(text: str | None) -> list[bytes]:
    """The words of a text with A-Z in lower case, and an END after each piece; null texts have none."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(SIGNS) + bytes([END])
    return raw.replace(bytes([END]), bytes([32, END, 32])).split()


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Block:
    """Words of one language, as numbers in order; 0 is END."""

    def __init__(self) -> None:
        self.numbers = _Numbers({bytes([END]): 0})
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)
        if self.size >> PLACE:
            raise ValueError("a text has too many words for one block")

    def lists(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The words, how many places each has, and the places, word by word."""
        numbers = np.concatenate(self.parts)
        order = np.argsort(numbers, kind="stable").astype(np.int32)
        counts = np.bincount(numbers, minlength=len(self.numbers))
        return list(self.numbers)[1:], counts[1:], order[counts[0] :]


def _parts(schema: pa.Schema, block: int, n: int, k: np.ndarray, places: np.ndarray, *more: np.ndarray | list) -> pa.RecordBatch:
    """A block's lists as rows of PART lists at most, so that no row is large; its words are counted in the first."""
    ends = np.cumsum(k)
    begins, rows = ends - k, []
    for i in range(0, len(k), PART):
        j = min(i + PART, len(k))
        rows.append((block, 0 if i else n, places[begins[i:j]], k[i:j], places[begins[i] : ends[j - 1]].tobytes(), *(m if isinstance(m, str) else m[i:j] for m in more)))
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(columns, schema, strict=True)], schema=schema)


def word_lists(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most_words: int = 1 << 21) -> DataFrame:
    """(block, n, firsts, k, places, lang, words): the lists of all words of a block, PART of them a row; n: its words, k: the lengths of its lists.

    A block holds documents of one language that one task read, about
    most_words words; a document's pieces stay in one block.
    """
    named = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"{LISTS}, lang string, words array<binary>"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, blocks = TaskContext.get().partitionId(), 0, {}

        def row(lang: str) -> pa.RecordBatch:
            nonlocal made
            words, k, places = blocks.pop(lang).lists()
            made += 1
            return _parts(out, (task << 13) + made, len(places), k, places, lang, words)

        for batch in slices(batches, "text"):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if len(words := tokens(text)) > 1:
                    block = blocks.setdefault(lang, _Block())
                    block.add(words)
                    if block.size >= most_words:
                        yield row(lang)
            if sum(b.size for b in blocks.values()) >= 4 * most_words:  # many languages: their blocks are smaller
                yield from map(row, list(blocks))
        yield from map(row, list(blocks))

    return named.mapInArrow(run, schema)


def extend(firsts: np.ndarray, k: np.ndarray, places: np.ndarray, first: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lists of phrases one word longer: (names of their first words, names of their last words, lengths, places).

    firsts, k and places are the lists of a block; the frequent ones are given
    by the first of their places and their names.
    """
    owner = np.full(len(k), -1, np.int64)
    by_first = np.argsort(firsts, kind="stable")
    owner[by_first[np.searchsorted(firsts, first, sorter=by_first)]] = np.arange(len(first))
    of = np.repeat(owner, k)
    at, of = places[of >= 0], of[of >= 0]
    order = np.argsort(at, kind="stable")
    at, of = at[order], of[order]
    meet = np.flatnonzero(at[1:] == at[:-1] + 1)
    pair = of[meet] * max(1, len(first)) + of[meet + 1]
    order = np.argsort(pair, kind="stable")
    pair, at = pair[order], at[meet][order]
    bounds = np.flatnonzero(np.concatenate([np.ones(min(1, len(pair)), bool), pair[1:] != pair[:-1]]))
    head, tail = np.divmod(pair[bounds], max(1, len(first)))
    return name[head], name[tail], np.diff(np.append(bounds, len(pair))), at


def _longer(lists: DataFrame, frequent: DataFrame) -> DataFrame:
    """The lists, by block, of the phrases that are one word longer than the frequent ones."""
    schema = f"{LISTS}, a array<long>, b array<long>"
    out = arrow_schema(schema)

    def run(own: pa.Table, names: pa.Table) -> pa.Table:
        if not own.num_rows or not names.num_rows:
            return out.empty_table()
        firsts, k = (own.column(c).combine_chunks().flatten().to_numpy() for c in ("firsts", "k"))
        a, b, k, places = extend(firsts, k, np.frombuffer(b"".join(own.column("places").to_pylist()), np.int32), names.column("at").to_numpy() & ((1 << PLACE) - 1), names.column("name").to_numpy())
        return pa.Table.from_batches([_parts(out, own.column("block")[0].as_py(), 0, k, places, a, b)], out)

    names = frequent.select(F.expr(f"shiftright(at, {PLACE})").alias("block"), "at", "name")
    return lists.select("block", "n", "firsts", "k", "places").groupBy("block").cogroup(names.groupBy("block")).applyInArrow(run, schema)


def _frequent(lists: DataFrame, key: list[str], least: int) -> DataFrame:
    """(at, name, f, key...) of the lists whose phrases have `least` places in all blocks; at: block and first place."""
    arrays = [c for c in key if c != "lang"]
    rows = lists.select("block", *[c for c in key if c == "lang"], F.explode(F.arrays_zip("firsts", "k", *arrays)).alias("x"))
    rows = rows.select(F.expr(f"shiftleft(block, {PLACE}) + x.firsts").alias("at"), "x.k", *[c if c == "lang" else f"x.{c}" for c in key])
    same = Window.partitionBy(*key)
    return rows.select("at", F.min("at").over(same).alias("name"), F.sum("k").over(same).alias("f"), *key).where(F.col("f") >= least)


def _kept(df: DataFrame, name: str, drop: list[str]) -> tuple[DataFrame, list[str]]:
    """df as a written table and its folder; the folders that only it read are deleted."""
    with written() as paths:
        table = stored(df, name)
    drop_stored(df.sparkSession, drop)
    return table, paths


def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, longest: int = 4, most_words: int = 1 << 21) -> tuple[list[DataFrame], DataFrame]:
    """([phrases of one word, of two, ...], (lang, n)): all phrases with `least` occurrences in their language, and words by language.

    A table of phrases holds name, lang, f, words, pre and suf (frequencies of
    its beginnings and ends by length) and inside (length and name of each
    shorter phrase of two words or more in it). Null texts have no words; a
    null language is `und`; repeated rows count as often as they occur.
    """
    lists, path = _kept(word_lists(docs, text_col, lang_col, most_words), "lists", [])
    totals, _ = _kept(lists.groupBy("lang").agg(F.sum("n").alias("n")), "totals", [])
    found: list[DataFrame] = []
    for length in range(1, longest + 1):
        frequent, own = _kept(_frequent(lists, ["lang", "words"] if length == 1 else ["a", "b"], least), "frequent", [])
        first, f = frequent.where("at = name"), F.array("f")
        if length == 1:
            new = first.select("name", "lang", "f", F.array(F.col("words").cast("string")).alias("words"), f.alias("pre"), f.alias("suf"), F.expr("cast(array() as array<struct<length:int,name:bigint>>)").alias("inside"))
        else:
            # a phrase is its first words and its last, which both are frequent phrases of one word less
            head = found[-1].select(F.col("name").alias("a"), "lang", "words", "pre", F.col("inside").alias("inside_a"))
            tail = found[-1].select(F.col("name").alias("b"), F.col("words").alias("ends"), "suf", F.col("inside").alias("inside_b"))
            part = lambda c: F.struct(F.lit(length - 1).alias("length"), F.col(c).alias("name"))  # noqa: B023, E731
            inside = F.array_union(F.array_union("inside_a", "inside_b"), F.array(part("a"), part("b")) if length > 2 else F.array())
            new = first.join(head, "a").join(tail, "b").select("name", "lang", "f", F.concat("words", F.slice("ends", -1, 1)).alias("words"), F.concat("pre", f).alias("pre"), F.concat("suf", f).alias("suf"), inside.alias("inside"))
        found.append(_kept(new, "phrases", [])[0])
        if length < longest:
            lists, path = _kept(_longer(lists, frequent), "lists", [*path, *own])
        else:
            drop_stored(docs.sparkSession, [*path, *own])
    return found, totals


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, longest: int = 4, share: int = 80, most: int = 2000, most_words: int = 1 << 21) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `most` best phrases of two words or more.

    a is the phrase's frequency, l and r those of the two parts of its weakest
    cut, score 2,000,000 a / (l + r) rounded down. A phrase inside a longer one
    that holds `share` percent of its occurrences is left out. Equal scores go
    by a, then by the phrase's bytes. An empty table gives no rows.
    """
    found, totals = phrases(docs, text_col, lang_col, least, longest, most_words)
    longer = [p.select("f", F.explode("inside").alias("x")).select("x.length", "x.name", "f") for p in found[2:]]
    candidates = [p.withColumn("length", F.lit(i)) for i, p in enumerate(found[1:], 2)]
    rows = reduce(DataFrame.unionByName, candidates)
    if longer:
        around = reduce(DataFrame.unionByName, longer).groupBy("length", "name").agg(F.max("f").alias("around"))
        rows = rows.join(around, ["length", "name"], "left").where(F.coalesce(100 * F.col("around") < share * F.col("f"), F.lit(True)))
    # 2,000,000 a may pass 64 bits
    cuts = F.expr("transform(sequence(1, length - 1), k -> struct((cast(2000000 as decimal(38,0)) * f) div (pre[k - 1] + suf[length - k - 1]) AS score, k AS k, pre[k - 1] AS l, suf[length - k - 1] AS r))")
    rows = rows.select("lang", F.concat_ws(" ", "words").alias("phrase"), F.col("f").alias("a"), F.array_min(cuts).alias("cut"))
    rows = rows.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
