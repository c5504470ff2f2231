"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has the probability of a
logistic model over the words the model knows (none, without such a word), and
the document's is the noisy-or of its sentences' and of a leak, which stands
for labels that no sentence explains. The leak counts once for a document, so
long clean documents do not add up to toxic ones. Training sees labels of
documents only; the trained model then names the sentences that made a
document toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.llm.training import labelled_sample
from postlode.shared import arrow_schema, slices

#: Besides whole words, their beginnings of so many letters are features: stems take many endings.
STEMS = (4, 5, 6, 7)
SENTENCE = re.compile(r"[^.!?\n]+")
TOKEN = re.compile(r"[^\W\d_]+")


def traits(word: str) -> list[str]:
    """A word's features: itself, marked as whole, and its stems."""
    return [word + "$", *(word[:k] for k in STEMS if len(word) >= k)]


@dataclass(frozen=True)
class Model:
    """Weights of words, the bias of a sentence that has some of them, and the leak of every document, as a logit."""

    weights: dict[str, float]
    bias: float
    leak: float

    def known(self, word: str, cache: dict[str, frozenset[str]]) -> frozenset[str]:
        """The features of a word that have a weight."""
        if len(cache) > 1 << 19:
            cache.clear()
        cache[word] = found = frozenset(t for t in traits(word) if t in self.weights)
        return found

    def logits(self, text: str, cache: dict[str, frozenset[str]]) -> Iterator[tuple[int, int, float]]:
        """(start, end, logit) of each sentence with a feature of the model; cache: features of words met before."""
        # lower case can be longer, but has the same sentences: no character becomes or ceases to be an end of one
        for m, lower in zip(SENTENCE.finditer(text), SENTENCE.findall(text.lower()), strict=True):
            hit: set[str] = set()
            for word in TOKEN.findall(lower):
                if found := cache[word] if word in cache else self.known(word, cache):
                    hit |= found
            if hit:
                yield m.start(), m.end(), self.bias + math.fsum(self.weights[t] for t in hit)

    def score(self, text: str, cache: dict[str, frozenset[str]], threshold: float = 0.5) -> tuple[float, list[dict]]:
        """The noisy-or of the sentences and the leak, and the sentences at or over the threshold; an empty text has the leak."""
        found = list(self.logits(text, cache))
        none = math.fsum([_softplus(self.leak), *(_softplus(z) for _, _, z in found)])
        bad = [{"start": a, "end": b, "score": 1 / (1 + math.exp(-z))} for a, b, z in found if z >= math.log(threshold / (1 - threshold))]
        return -math.expm1(-none), bad


def _softplus(z: float) -> float:
    return max(z, 0.0) + math.log1p(math.exp(-abs(z)))


class Bags:
    """Documents as bags of (words of a sentence, how many such sentences), in flat arrays."""

    def __init__(self, bags: list[list[tuple[tuple[int, ...], int]]], n_words: int):
        self.n, self.n_words = len(bags), n_words
        self.bag = np.array([i for i, b in enumerate(bags) for _ in b], np.int64)
        self.times = np.array([n for b in bags for _, n in b], float)
        flat = [words for b in bags for words, _ in b]
        self.kinds = len(flat)
        self.row = np.repeat(np.arange(len(flat)), list(map(len, flat)))
        self.word = np.array([w for words in flat for w in words], np.int64)

    def loss(self, theta: np.ndarray, labels: np.ndarray, weight: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
        """The negative log-likelihood of the labels and its gradient; theta: weights, bias, leak."""
        z = theta[-2] + np.bincount(self.row, theta[self.word], self.kinds)
        p, leak = 1 / (1 + np.exp(-np.clip(z, -40, 40))), 1 / (1 + np.exp(-theta[-1]))
        none = np.bincount(self.bag, self.times * np.logaddexp(0, z), self.n) + np.logaddexp(0, theta[-1])
        some = np.maximum(-np.expm1(-none), 1e-12)
        pull = np.where(labels == 1, -np.exp(-none) / some, 1.0) * weight
        g = self.times * p * pull[self.bag]
        grad = np.concatenate([np.bincount(self.word, g[self.row], self.n_words), [g.sum(), leak * pull.sum()]]) / weight.sum()
        grad[:-2] += ridge * theta[:-2]
        value = (weight * np.where(labels == 1, -np.log(some), none)).sum() / weight.sum() + ridge * (theta[:-2] ** 2).sum() / 2
        return float(value), grad


def fit_noisy_or(bags: list[list[tuple[tuple[int, ...], int]]], labels: np.ndarray, weight: np.ndarray, n_words: int, rounds: int = 400, rate: float = 0.1, ridge: float = 2e-4) -> tuple[np.ndarray, float, float]:
    """Weights, bias and leak for bags of (words of a sentence, how many such sentences), by Adam on the documents' likelihood."""
    data = Bags(bags, n_words)
    theta = np.zeros(n_words + 2)
    theta[-2:] = -2.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        _, grad = data.loss(theta, labels, weight, ridge)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta[:-2], float(theta[-2]), float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_class: int = 3000, most_words: int = 512, least_gain: float = 24.0, least_share: float = 0.01) -> Model:
    """A model from at most per_class labelled documents of each class (see labelled_sample).

    The words and stems whose documents differ most by class, by the likelihood ratio
    (at least least_gain, in a share of at least least_share of one class's
    documents, most_words at most), are the features. Texts that repeat in the
    sample count once, so that a page copied often is not evidence many times
    over. Spark counts words over the sample, and the driver gets the sample's sentences in terms
    of those words alone. Without rows of both classes every document gets the
    same small probability.
    """
    sample, counts = labelled_sample(docs, labels, label_col, per_class, id_col, text_col)
    if len(counts) < 2:
        return Model({}, 0.0, math.log(1e3 if counts.get(1) else 1e-3))
    sample = sample.groupBy("text").agg(F.min_by("label", "id").alias("label"), F.min("id").alias("id")).persist()
    try:
        return _trained(sample, counts, most_words, least_gain, least_share)
    finally:
        sample.unpersist()


def _trained(sample: DataFrame, counts: dict[int, int], most_words: int, least_gain: float, least_share: float) -> Model:
    """train() over the different texts (text, label, id) of its sample."""

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [sorted({x for w in set(TOKEN.findall(t.lower())) for x in traits(w)}) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("label").to_numpy(), list(map(len, found))), pa.int32()), pa.array([w for x in found for w in x], pa.string())], names=["label", "word"])

    classes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        return Model({}, 0.0, math.log(1e-3))
    words = sample.mapInArrow(words_of, "label int, word string").groupBy("word").agg(F.sum("label").cast("double").alias("p"), F.sum(1 - F.col("label")).cast("double").alias("n"))
    total = classes[0] + classes[1]
    part = lambda k, of, all_k: F.when(k > 0, k * F.log(k * total / (of * all_k))).otherwise(0.0)
    p, n, k = F.col("p"), F.col("n"), F.col("p") + F.col("n")
    gain = 2 * (part(p, k, classes[1]) + part(n, k, classes[0]) + part(classes[1] - p, total - k, classes[1]) + part(classes[0] - n, total - k, classes[0]))
    words = words.select("*", F.round(gain, 6).alias("gain")).where((F.col("gain") >= least_gain) & (F.greatest(p / classes[1], n / classes[0]) >= least_share) & (k >= 3))
    chosen = [r["word"] for r in words.orderBy(F.desc("gain"), "word").limit(most_words).collect()]
    place = {w: i for i, w in enumerate(chosen)}
    schema = "id string, label int, sentences binary"
    out = arrow_schema(schema)

    def bags_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            packed = []
            for t in batch.column("text").to_pylist():
                kinds = Counter(found for s in SENTENCE.findall(t.lower()) if (found := tuple(sorted({place[x] for w in TOKEN.findall(s) for x in traits(w) if x in place}))))
                packed.append(np.array([x for words, k in sorted(kinds.items()) for x in (k, len(words), *words)], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.string()), batch.column("label"), pa.array(packed)], schema=out)

    rows = sorted(sample.mapInArrow(bags_of, schema).collect(), key=lambda r: (len(r["id"]), r["id"]))
    bags = []
    for r in rows:
        numbers, bag, i = np.frombuffer(r["sentences"], "<i4").tolist(), [], 0
        while i < len(numbers):
            k, size = numbers[i : i + 2]
            bag.append((tuple(numbers[i + 2 : i + 2 + size]), k))
            i += 2 + size
        bags.append(bag)
    y = np.array([r["label"] for r in rows])
    weight = np.where(y == 1, counts[1] / classes[1], counts[0] / classes[0])
    weights, bias, leak = fit_noisy_or(bags, y, weight / weight.mean(), len(chosen))
    return Model({w: float(x) for w, x in zip(chosen, weights, strict=True) if abs(x) > 1e-3}, bias, leak)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, keep..., text, score, offending): one row for each row of docs.

    offending are the sentences (start, end in characters, score) that alone
    reach 0.5. Null texts stay null; they and empty ones have the leak's score.
    """
    named = docs.select(F.col(id_col).alias("_id"), *keep, F.col(text_col).alias("_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema), "score double, offending array<struct<start:int,end:int,score:double>>"])
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, frozenset[str]] = {}
        for batch in slices(batches, "_text"):
            found = [model.score(t or "", cache) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(batch.columns, out, strict=False)), pa.array([s for s, _ in found], pa.float64()), pa.array([b for _, b in found], out.field("offending").type)], schema=out)

    return named.mapInArrow(run, schema).withColumnsRenamed({"_id": id_col, "_text": text_col})
