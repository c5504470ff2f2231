"""Languages, ranked search and phrases against plain versions; samples, draws and scratch folders that are the same at every run."""

from __future__ import annotations

import math
import os
import random
import threading
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_operators import DOCS, corpus

import corpus_pipeline
from postlode import shared
from postlode.llm import collocations, impact_index, language_id, mixing, queries, training

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
CLASHING = ("id", "text_", "block", "name", "f", "k", "term", "query", "item", "lang_", "h", "n", "rank", "words", "label")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3).withColumns({c: F.lit("x") for c in CLASHING})


# --- phrases


def pieces_of(text):
    out, piece, word = [], [], ""
    for c in (text or "") + "\n":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c in ".,;:!?\n\x0b\x0c\r \t":
            piece += [word] * bool(word)
            word = ""
            if c not in " \t":
                out.append(piece)
                piece = []
        else:
            word += c
    return out


def plain_collocations(rows, least, longest, share, most):
    """rows: (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in pieces_of(text):
            n[lang] += len(piece)
            for k in range(1, longest + 1):
                f[lang].update(tuple(piece[i : i + k]) for i in range(len(piece) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        found = []
        for p, a in candidates.items():
            around = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= share * a for b in around):
                continue
            score, _, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:most], 1)]
    return Counter(out)


def phrase_rows():
    rnd = random.Random(5)
    text = lambda: " ".join(rnd.choice("the of And ab ß é a.b c, x".split()) + rnd.choice(["", "", ".", "\n", "\t"]) for _ in range(rnd.randint(0, 60)))
    rows = [(i, text(), rnd.choice(["en", "en", "de", None, "und"]), "s", 0) for i in range(60)]
    return [*rows, (1, None, "en", None, 0), (2, "", None, None, 0), (None, "a a a a a a a a a", "en", "s", 0), (9, "so so so so", "fr", None, 0), rows[3], (7, "the of " * 3000, "de", "s", 0)]


@pytest.mark.parametrize("partitions", [1, 4])
@pytest.mark.parametrize("most_words", [40, 1 << 22])
def test_collocations(spark, partitions, most_words):
    rows = phrase_rows()
    table = spark.createDataFrame(rows, DOCS).repartition(partitions).withColumns({c: F.lit("x") for c in CLASHING})
    found = collocations.collocations(table, least=4, most=25, most_words=most_words).collect()
    assert Counter(map(tuple, found)) == plain_collocations([(r[2], r[1]) for r in rows], 4, 4, 80, 25) and len(found) > 30


def test_collocations_of_large_counts_and_no_rows(spark, docs):
    assert collocations.collocations(docs.where("false")).count() == 0
    assert collocations.collocations(docs.select("doc_id", F.lit(None).cast("string").alias("text"), "lang")).count() == 0
    cut = spark.sql("SELECT (cast(2000000 as decimal(38,0)) * 9000000000000000) div (9000000000000000L + 9000000000000001L) AS x").first().x
    assert cut == 2_000_000 * 9 * 10**15 // (18 * 10**15 + 1)


def test_collocations_leave_no_lists_behind(spark):
    with shared.written() as paths:
        collocations.collocations(spark.createDataFrame(phrase_rows(), DOCS), least=4).count()
    assert {p.split("/postlode-")[1].split("-")[0] for p in paths if os.path.exists(p.removeprefix("file:"))} == {"totals", "phrases"}


# --- ranked search


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(0, 1 << 20)), min_size=1, max_size=40), st.integers(0, 30_000), st.integers(1, 12))
def test_bitmap_arithmetic(rows, factor, k):
    sliced = lambda numbers: [sum((n >> j & 1) << i for i, n in enumerate(numbers)) for j in range(max(numbers).bit_length())]
    x, y = [a for a, _ in rows], [b for _, b in rows]
    total = impact_index.times(sliced(y), factor)
    impact_index.add(total, sliced(x))
    expected = [a + b * factor for a, b in rows]
    read = lambda bitmaps, i: sum((b >> i & 1) << j for j, b in enumerate(bitmaps))
    assert [read(total, i) for i in range(len(rows))] == expected
    ranked = sorted((i for i, s in enumerate(expected) if s), key=lambda i: (-expected[i], i))[:k]
    assert sorted(impact_index.best(total, k)) == sorted((i, expected[i]) for i in ranked)


def terms_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            out += [word] * bool(word)
            word = ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    return out


def plain_search(docs, items, k=10):
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for doc_id, bag in bags:
            m = 100 - 75 + (75 * sum(bag.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in terms_of(text) if t in bag)
            if score:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("partitions", [1, 6])
def test_impact_index(spark, partitions):
    rnd = random.Random(2)
    words = ["alpha", "Beta", "γάμμα", "d4", "e", "ß", "the", "THE", "rare1", "rare2"]
    docs = [(i, rnd.choice([" ", "-", " "]).join(rnd.choices(words, [3, 3, 2, 2, 1, 1, 9, 9, 0.1, 0.1], k=rnd.randint(1, 30)))) for i in range(200)]
    docs += [(500, None), (501, ""), (502, "--- ..."), (None, "alpha beta"), (None, "alpha beta"), (3, docs[3][1]), (503, "the " * 70_000 + "d4"), (504, "rare3")]
    items = [(1, "the alpha, alpha BETA"), (2, None), (3, "unknown"), (4, "rare1 rare3 γάμμα!"), (4, "d4"), (None, "the"), (6, "")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(partitions).withColumns({c: F.lit("x") for c in CLASHING})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in CLASHING})
    n, total = impact_index.statistics(table)
    found = impact_index.search(impact_index.build(table, n, total), asked, n).collect()
    assert Counter(map(tuple, found)) == plain_search(docs, items)
    assert impact_index.search(impact_index.build(table.where("false"), 0, 0), asked, 0).count() == 0
    assert impact_index.search(impact_index.build(table, n, total), asked.where("false"), n).count() == 0


def test_many_queries_go_by_chunks(spark, monkeypatch):
    """Chunks over the bound of a broadcast are joined by their number."""
    table = spark.createDataFrame([(i, f"w{i % 7} w{i % 3} x{i}") for i in range(50)], "doc_id long, text string")
    asked = [(i, f"w{i % 7} x{i} w1") for i in range(40)]
    monkeypatch.setattr(impact_index, "CHUNK", 5)
    monkeypatch.setattr(impact_index, "BROADCAST", 2)
    n, total = impact_index.statistics(table)
    found = impact_index.search(impact_index.build(table, n, total), spark.createDataFrame(asked, "item_id long, text string"), n)
    assert Counter(map(tuple, found.collect())) == plain_search([tuple(r) for r in table.collect()], asked)


# --- languages


def plain_grams(text):
    """Letters one by one; the same hash, in whole numbers."""
    run = [0]
    for c in text.lower():
        c = ord(c) if c.isalpha() else 0
        if c or run[-1]:
            run.append(c)
    run += [0] * bool(run[-1])
    counts = Counter()
    mix, full = [int(x) for x in language_id.MIX], (1 << 64) - 1
    for i in range(1, len(run)):
        for n in (1, 2, 3):
            if i - n + 1 < 0 or n == 1 and not run[i]:
                continue
            total = sum(run[i - j] * mix[j] for j in range(n)) & full
            mixed = (total + n) * mix[0] & full
            counts[((mixed ^ mixed >> 29) * mix[1] & full) >> 50] += 1
    return counts if any(run) else Counter()


@pytest.mark.parametrize("piece", [3, 1 << 20])
def test_grams(monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE", piece)
    for text in ["", " ", "12 --", "a", "Ab", "the cat", "  Ünïcode, straße!  x ", "日本語 テキスト", "½²", "İstanbul ΣΑΣ", "a1b2" * 7]:
        at, counts = language_id.grams(text)
        assert dict(zip(at.tolist(), counts.tolist(), strict=True)) == plain_grams(text), text


def test_nearest_centroid(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    model = language_id.train(docs, F.col("doc_id") % 3 != 0, per_language=60, clusters=3)
    again = language_id.train(docs.repartition(7), F.col("doc_id") % 3 != 0, per_language=60, clusters=3)
    assert model.langs == again.langs == sorted(model.langs) and np.allclose(model.centroids, again.centroids)
    assert Counter(model.langs) == {"de": 3, "en": 3, "es": 3, "fr": 3}
    rows = [(r.doc_id, r.text) for r in docs.limit(40).collect()] + [(None, None), (7, ""), (7, "123 !"), (8, "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in (*CLASHING, "lang", "cosine")})
    found = Counter((r.doc_id, r.lang, round(r.cosine, 9), r.rejected) for r in language_id.identify(table, model).collect())
    expected = Counter()
    for doc_id, text in rows:
        v = {a: (1 + math.log(k)) * model.rarity[a] for a, k in plain_grams(text or "").items()}
        norm = math.sqrt(math.fsum(x * x for x in v.values()))
        cosines = [math.fsum(x * model.centroids[a, i] for a, x in v.items()) / norm if v else 0.0 for i in range(len(model.langs))]
        i = max(range(len(cosines)), key=lambda j: (cosines[j], -j))
        expected[(doc_id, model.langs[i], round(cosines[i], 9), 1 - cosines[i] > model.reach[i]) if v else (doc_id, "und", 0.0, True)] += 1
    assert found == expected


def test_clusters_are_stable():
    rnd = np.random.default_rng(1)
    groups = np.abs(rnd.normal(0, 0.05, (30, 8))) + np.repeat(np.eye(8)[:3], 10, axis=0)
    vectors = groups / np.sqrt((groups**2).sum(1))[:, None]
    centers, own = language_id.clustered(vectors, 3)
    assert len(centers) == 3 and all(len(set(own[i : i + 10])) == 1 for i in (0, 10, 20)) and len(set(own)) == 3
    assert len(language_id.clustered(np.repeat(vectors[:1], 5, axis=0), 4)[0]) == 1


def test_held_out_languages(spark):
    found = queries.op11_language_id(spark, LARGER).join(spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.count("*").alias("n")).first()
    assert r.n > 200 and r.right > 0.98


def test_languages_reject_what_is_far(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    model = language_id.train(docs, F.lit(True), per_language=60)
    assert model.predict("Ωμέγα άλφα βήτα γάμμα δέλτα " * 9)[2] and model.predict(None) == ("und", 0.0, True)
    assert not model.predict(docs.where("lang = 'en' AND n_chars > 800").first().text)[2]


def test_languages_without_rows(spark, docs):
    model = language_id.train(docs.where("false"), F.lit(True))
    assert model.predict("some text") == ("und", 0.0, True)
    assert language_id.identify(docs.where("false"), model).count() == 0
    assert {r.lang for r in language_id.identify(docs, language_id.train(docs, F.lit(True))).collect()} == {"en", "und"}
    sample = language_id.training_sample(docs, F.lit(True), 5)
    assert sample.count() == 5 and sample.select("text").distinct().count() == 5


# --- the same at every run


def test_sample_of_repeated_ids_does_not_depend_on_order(spark):
    rows = [(i, f"text {i} {j}") for i in range(200) for j in range(3)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(5, None), (None, 1)], "doc_id long, toxic int")
    samples = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        found, counts = training.labelled_sample(spark.createDataFrame(rows, "doc_id long, text string").repartition(seed * 2), labels, "toxic", 60)
        samples.append(sorted((r.id, r.text, r.label) for r in found.collect()))
    assert samples[0] == samples[1] and len({i for i, _, _ in samples[0]}) == len(samples[0]) == 120 and set(counts) == {0, 1}


def test_every_source_comes_near_its_target(spark):
    found = mixing.mix(spark.read.parquet(f"{LARGER}/documents.parquet"))
    off = found.groupBy("source").agg((F.abs(F.sum(F.col("copies") * F.col("size")) - F.max("target")) / F.max("target")).alias("off")).collect()
    assert len(off) == 20 and max(r.off for r in off) < 0.1


def test_pipelines_at_once(spark):
    counts, one = [], corpus_pipeline.run(spark, SF).count()
    threads = [threading.Thread(target=lambda: counts.append(corpus_pipeline.run(spark, SF).count())) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert counts == [one, one]


def test_checkpoints_can_be_dropped(spark):
    with shared.written() as paths:
        kept = shared.checkpointed(spark.range(5))
        with shared.written() as inner:
            shared.stored(kept, "x")
    assert len(paths) == 2 and inner == paths[1:] and kept.count() == 5
    places = [p.removeprefix("file:") for p in paths]
    assert all(map(os.path.exists, places))
    shared.drop_stored(spark, paths)
    assert not any(map(os.path.exists, places))
