"""Language identification by nearest centroids.

A text is a vector of letter n-grams: counts damped by a logarithm, weighted by
how few training texts hold the n-gram, and of length one. Each language has
several centroids, since it is written in more than one way. The language of
the centroid with the largest cosine is predicted; a text farther from it than
its members are is marked as rejected.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlode.shared import arrow_schema, slices, stored

#: N-grams of one to three letters fall into so many dimensions by a multiplicative hash.
DIMENSIONS = 1 << 14
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
#: Letters of a text that are looked at together; n-grams across the border count.
PIECE = 1 << 20
UNKNOWN = "und"


@functools.cache
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The dimensions of the n-grams of a whole text, in lower case, and their counts; none without a letter.

    Anything but letters is one gap between words; texts begin and end in one.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    counts, tail, some = np.zeros(DIMENSIONS, np.int64), np.zeros(1, np.uint32), False
    for i in range(0, len(points) + 1, PIECE):
        piece = points[i : i + PIECE]
        piece = np.where(letters()[piece], piece, 0)
        some |= bool(piece.any())
        known = len(tail)
        run = np.concatenate([tail, piece, np.zeros(int(i + PIECE > len(points)), np.uint32)])
        kept = np.concatenate([np.ones(known, bool), (run[known:] != 0) | (run[known - 1 : -1] != 0)])
        run = run[kept].astype(np.uint64)
        # each n-gram counts where its last letter stands
        hashes, total = [], np.zeros(len(run), np.uint64)
        for n in range(3):
            total = total + np.concatenate([np.zeros(min(n, len(run)), np.uint64), run[: len(run) - n]]) * MIX[n]
            mixed = (total + np.uint64(n + 1)) * MIX[0]
            hashes.append((mixed ^ (mixed >> np.uint64(29))) * MIX[1] >> np.uint64(64 - 14))
        at = np.arange(len(run)) >= known
        for n, h in enumerate(hashes):
            counts += np.bincount(h[at & (np.arange(len(run)) >= n) & ((run != 0) | (n > 0))].astype(np.int64), minlength=DIMENSIONS)
        tail = run[-2:].astype(np.uint32)
    found = np.flatnonzero(counts) if some else np.zeros(0, np.int64)
    return found, counts[found]


def weights(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Damped counts times rarity, as a vector of length one."""
    v = (1 + np.log(counts)) * rarity
    return v / (np.sqrt((v * v).sum()) or 1.0)


@dataclass(frozen=True)
class Model:
    """One column of `centroids` (dimension, centroid) for each centroid, in order of language; reach: how far its members are."""

    langs: list[str]
    centroids: np.ndarray
    reach: np.ndarray
    rarity: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected). Without a letter, or without a learnt language: und, 0, true. Ties go to the first by code point."""
        at, counts = grams(text or "")
        if not len(at) or not self.langs:
            return UNKNOWN, 0.0, True
        cosines = weights(counts, self.rarity[at]) @ self.centroids[at]
        i = int(cosines.argmax())
        cosine = float(min(1.0, max(0.0, cosines[i])))
        return self.langs[i], cosine, bool(1 - cosine > self.reach[i])


def clustered(vectors: np.ndarray, clusters: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, each of length one; which one each vector is nearest to), by spherical k-means from far-apart vectors."""
    mean = vectors.sum(0)
    chosen = [int((vectors @ mean).argmax())]
    near = vectors @ vectors[chosen[0]]
    while len(chosen) < min(clusters, len(vectors)) and near.min() < 1 - 1e-9:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centers = vectors[chosen]
    for _ in range(rounds):
        own = (vectors @ centers.T).argmax(1)
        used = np.unique(own)
        centers = np.stack([vectors[own == i].sum(0) for i in used])
        centers /= np.sqrt((centers * centers).sum(1))[:, None]
    return centers, (vectors @ centers.T).argmax(1)


def training_sample(docs: DataFrame, learn: Column, per_language: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, h, text): at most per_language different texts of each language among the rows that `learn` admits.

    Texts are taken by a hash, so repeated rows and their order do not matter.
    A first cut by the hash leaves few more than are wanted, so no task ranks
    the rows of a whole language. Null texts and languages are left out.
    """
    rows = docs.where(learn).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.withColumn("h", F.xxhash64("text"))
    # different texts by a sketch whose relative error is a hundredth; a fifth more than wanted is cut out
    sizes = stored(rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.01).alias("n")), "languages").withColumnRenamed("lang", "_lang")
    share = F.least(F.lit(1.0), F.lit(1.2 * per_language) / F.col("n"))
    cut = rows.join(sizes, F.col("lang") == F.col("_lang")).where(F.expr(f"pmod(h, {1 << 40}L)") < share * (1 << 40))
    different = cut.groupBy("lang", "h").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("h")
    return different.withColumn("_i", F.row_number().over(order)).where(F.col("_i") <= per_language).drop("_i")


def train(docs: DataFrame, learn: Column, per_language: int = 500, clusters: int = 4, slack: float = 1.25, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Centroids from a sample of the rows that `learn` admits (see training_sample).

    Each language is clustered by a task of its own, from per_language texts at
    most; the driver gets the centroids and how many texts hold each dimension.
    A centroid's reach is the distance that 99 of 100 members keep, times slack.
    """
    sample = training_sample(docs, learn, per_language, text_col, lang_col)
    schema = "lang string, h long, at array<int>, k array<int>"
    out = arrow_schema(schema)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [grams(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang").cast(pa.string()), batch.column("h"), pa.array([a for a, _ in found], out.field("at").type), pa.array([k for _, k in found], out.field("k").type)], schema=out)

    texts = stored(sample.mapInArrow(counted, schema).where("size(at) > 0"), "language_sample")
    n = texts.count()
    held = np.zeros(DIMENSIONS)
    for r in texts.select(F.explode("at").alias("at")).groupBy("at").agg(F.count("*").alias("n")).collect():  # DIMENSIONS rows at most
        held[r["at"]] = r["n"]
    rarity = np.log((1 + n) / (1 + held)) + 1
    made = "lang string, i int, center binary, reach double"
    made_out = arrow_schema(made)

    def cluster(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("h")
        vectors = np.zeros((rows.num_rows, DIMENSIONS))
        for row, at, k in zip(vectors, rows.column("at").to_pylist(), rows.column("k").to_pylist(), strict=True):
            row[at] = weights(np.array(k), rarity[at])
        centers, own = clustered(vectors, clusters)
        far = 1 - (vectors * centers[own]).sum(1)
        reach = [float(np.quantile(far[own == i], 0.99)) * slack if (own == i).any() else 0.0 for i in range(len(centers))]
        values = [[rows.column("lang")[0].as_py()] * len(centers), range(len(centers)), [c.tobytes() for c in centers], reach]
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(values, made_out, strict=True)], schema=made_out)

    found = sorted(texts.groupBy("lang").applyInArrow(cluster, made).collect(), key=lambda r: (r["lang"], r["i"]))
    centers = np.array([np.frombuffer(r["center"]) for r in found]).reshape(-1, DIMENSIONS)
    return Model([r["lang"] for r in found], np.ascontiguousarray(centers.T), np.array([r["reach"] for r in found]), rarity)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, cosine, rejected): one row for each row of docs; null texts, and texts without a letter, are und."""
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"id {named.schema['id'].dataType.simpleString()}, lang string, cosine double, rejected boolean"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            values = zip(*found, strict=True) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(out.field("id").type), *(pa.array(v, f.type) for v, f in zip(values, list(out)[1:], strict=True))], schema=out)

    return named.mapInArrow(run, schema).withColumnRenamed("id", id_col)
