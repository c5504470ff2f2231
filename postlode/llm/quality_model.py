"""A quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.llm.training import labelled_sample
from postlode.shared import arrow_schema, slices

STATISTICS = ("words", "bytes", "word_length", "longest_word", "different_words", "stuttered_words", "short_words", "upper", "digits", "stops", "cries", "symbols", "bars", "other_marks", "beyond_ascii", "lines", "line_words", "repeated_lines", "packed", "single_sign_words", "repeated_pairs")
UPPER, DIGIT = [*range(65, 91)], [*range(48, 58)]
MARKS = [i for i in [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)] if chr(i) not in ".,!?#*$%&|<>"]


def statistics(text: str) -> list[float]:
    """STATISTICS of a whole text, mostly as shares of its words, bytes or lines."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = max(1, len(words)), max(1, len(raw))
    lengths = list(map(len, words))
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    total = max(1, len(lines))
    of = lambda signs: float(count[[ord(c) for c in signs]].sum())
    return [
        math.log1p(len(words)), math.log1p(len(raw)), sum(lengths) / n, math.log1p(max(lengths, default=0)),
        len(set(words)) / n, sum(map(bytes.__eq__, words, words[1:])) / n, sum(x <= 3 for x in lengths) / n,
        count[UPPER].sum() / size, count[DIGIT].sum() / size, of(".,?") / n, of("!") / n, of("#*$%&<>") / n, of("|") / n, count[MARKS].sum() / n, count[128:].sum() / size,
        math.log1p(len(lines)), math.log1p(len(words) / total), 1 - len(set(lines)) / total, len(zlib.compress(raw, 1)) / size,
        lengths.count(1) / n, 1 - len(set(zip(words, words[1:], strict=False))) / n,
    ]


@dataclass(frozen=True)
class Trees:
    """All trees in flat arrays: a row goes left where its statistic is at most the threshold; leaves point to themselves."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of statistics."""
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 1.0) -> Trees:
    """Boosted trees for the logistic loss; splits are sought over histograms of quantile bins."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T] if len(x) else [np.zeros(0)] * x.shape[1]
    code = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], axis=1) if len(x) else np.zeros(x.shape, int)
    base = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    f = np.full(len(y), base)
    roots, feature, threshold, left, right, value = [], [], [], [], [], []
    spread = np.arange(x.shape[1]) * bins

    def leaf(v: float) -> int:
        i = len(feature)
        for column, what in ((feature, 0), (threshold, math.inf), (left, i), (right, i), (value, v)):
            column.append(what)
        return i

    for _ in range(trees if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-f))
        g, h = p - y, p * (1 - p)
        roots.append(leaf(0.0))
        open_nodes = [(roots[-1], np.arange(len(y)))]
        for level in range(depth + 1):
            following = []
            for node, rows in open_nodes:
                sg, sh = g[rows].sum(), h[rows].sum()
                value[node] = -rate * sg / (sh + ridge)
                best = (1e-6, -1, -1)
                if level < depth:
                    places = (code[rows] + spread).ravel()
                    hg = np.bincount(places, np.repeat(g[rows], x.shape[1]), spread[-1] + bins).reshape(-1, bins).cumsum(1)[:, :-1]
                    hh = np.bincount(places, np.repeat(h[rows], x.shape[1]), spread[-1] + bins).reshape(-1, bins).cumsum(1)[:, :-1]
                    gain = hg**2 / (hh + ridge) + (sg - hg) ** 2 / (sh - hh + ridge) - sg**2 / (sh + ridge)
                    gain[(hh < least) | (sh - hh < least)] = -1
                    k = int(gain.argmax())
                    best = max(best, (float(gain.flat[k]), k // (bins - 1), k % (bins - 1)))
                if best[1] < 0 or best[2] >= len(edges[best[1]]):
                    f[rows] += value[node]
                    continue
                goes = code[rows, best[1]] <= best[2]
                feature[node], threshold[node] = best[1], float(edges[best[1]][best[2]])
                left[node], right[node] = leaf(0.0), leaf(0.0)
                following += [(left[node], rows[goes]), (right[node], rows[~goes])]
            open_nodes = following
    arrays = (np.array(v, kind) for v, kind in ((roots, int), (feature, int), (threshold, float), (left, int), (right, int), (value, float)))
    return Trees(*arrays, depth, base)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, keep..., stats array<double>): the statistics of each whole text; null texts count as empty."""
    named = docs.select(F.col(id_col).alias("id"), *keep, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    fields = [f for f in named.schema if f.name != "text"]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in fields), "stats array<double>"])
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            stats = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name).cast(out.field(f.name).type) for f in fields), pa.array(stats, out.field("stats").type)], schema=out)

    return named.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_class: int = 8000) -> Trees:
    """Trees from the statistics of at most per_class labelled documents of each class (see labelled_sample).

    The score is brought to the odds of all labelled rows, whatever the
    sample's. Without rows of both classes every document gets the same score.
    """
    sample, counts = labelled_sample(docs, labels, label_col, per_class, id_col, text_col)
    rows = sorted(document_statistics(sample, "id", "text", ("label",)).collect(), key=lambda r: str(r["id"]))
    x, y = np.array([r["stats"] for r in rows]).reshape(-1, len(STATISTICS)), np.array([r["label"] for r in rows])
    model = fit(x, y)
    if len(counts) == 2 and 0 < y.sum() < len(y):  # the odds in the sample, brought to the odds of all labelled rows
        shift = math.log(counts[1] / counts[0]) - math.log(y.sum() / (len(y) - y.sum()))
        model = Trees(model.roots, model.feature, model.threshold, model.left, model.right, model.value, model.depth, model.base + shift)
    return model


def score(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): one row for each row of docs, 0 to 1; null and empty texts are scored by their statistics too."""
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"id {named.schema['id'].dataType.simpleString()}, score double"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = np.array([statistics(t) for t in batch.column("text").to_pylist()]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(out.field("id").type), pa.array(model.score(x))], schema=out)

    return named.mapInArrow(run, schema).withColumnRenamed("id", id_col)
