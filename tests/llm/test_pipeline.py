"""The stages of the corpus pipeline: what each keeps, changes and returns, against plain versions."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict, namedtuple

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import LIBRARY, plain_components, plain_fingerprint, plain_repeats, plain_targets, words

import corpus_pipeline
from postlode.llm import queries
from postlode.shared import WRITTEN

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def plain_stage(name, rows, model):
    """The rows of a stage by loops over rows (doc_id, text, lang, source, n_chars)."""
    if name == "toxicity":
        return [r for r in rows if model.score(r.text or "", {})[0] < 0.5]
    if name == "near_duplicates":
        label = plain_components([r.doc_id for r in rows], [plain_fingerprint(r.text) for r in rows], 4)
        first = {}
        for r, x in sorted(zip(rows, label, strict=True), key=lambda p: p[0].doc_id):
            first.setdefault(x, r)
        return list(first.values())
    if name == "substring_dedup":
        return [type(r)(r.doc_id, text, r.lang, r.source, len(text)) for r, (_, _, text) in zip(rows, plain_repeats([r.text for r in rows], 35), strict=True)]
    if name == "mixing":
        sizes = defaultdict(int)
        for r in rows:
            sizes[r.source] += len(words(r.text))
        targets = plain_targets(sizes)
        rate = {s: min(3.0, targets[s] / n) if n else 0.0 for s, n in sizes.items()}
        draw = {r.doc_id: int(hashlib.md5(f"1:{r.doc_id}".encode()).hexdigest()[:13], 16) for r in rows}
        copies = lambda r, turn: math.floor(rate[r.source]) + ((draw[r.doc_id] + turn * 2783377641436328) % (1 << 52) / (1 << 52) < rate[r.source] % 1)
        taken = {(s, turn): 0 for s in sizes for turn in range(64)}
        for r in rows:
            for turn in range(64):
                taken[r.source, turn] += copies(r, turn) * len(words(r.text))
        turns = {s: min(range(64), key=lambda t: (abs(taken[s, t] - targets[s]), t)) for s in sizes}  # noqa: B023
        return [r for r in rows for _ in range(copies(r, turns[r.source]))]
    ids = {t: LIBRARY.encode(t or "", add_special_tokens=False).ids for t in {r.text for r in rows}}
    return [(r.doc_id, r.source, len(ids[r.text]), tuple(ids[r.text])) for r in rows]


def test_stages_against_plain_versions(spark, tmp_path):
    Row = namedtuple("Row", corpus_pipeline.COLUMNS)
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    model = queries.toxicity.train(docs, spark.read.parquet(f"{LARGER}/labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        given = [Row(*r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()]
        stage(spark, docs, LARGER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        expected = plain_stage(name, given, model)
        if name == "bpe":
            found = [(r.doc_id, r.source, r.n_tokens, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in docs.collect()]
        else:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
            found = [tuple(r) for r in docs.collect()]
        assert Counter(found) == Counter(map(tuple, expected)), name
        assert len(found) and (name not in ("toxicity", "near_duplicates") or len(found) < len(given))


def test_run_leaves_the_stages_alone(spark):
    """Only what the last stage reads stays in the shared folder."""
    known = set(WRITTEN)
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert [p.split("/postlode-")[-1].rsplit("-", 1)[0] for p in WRITTEN if p not in known] == [corpus_pipeline.STAGES[-2][0]]


@pytest.mark.parametrize("index", range(5))
def test_stages_of_empty_and_odd_tables(spark, index):
    """Empty tables, null texts and sources, and repeated rows, through every stage."""
    name, stage = corpus_pipeline.STAGES[index]
    rows = [(1, None, "en", None, 0), (1, None, "en", None, 0), (2, "", None, "a", 0), (None, "some words of a text", "en", "a", 20), (3, "some words of a text", "en", "a", 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("x"))
    assert stage(spark, docs.where("false"), SF).count() == 0
    found = stage(spark, docs, SF).collect()
    assert len(found) == {"toxicity": 5, "near_duplicates": 2, "substring_dedup": 5, "bpe": 5}.get(name, len(found))


def test_stage_of_near_copies_with_odd_ids(spark):
    rows = [(1, "one two three four five", "en", "a", 1), (1, "one two three four five", "en", "a", 1), (2, "one two three four five", "en", "a", 1), (3, "quite another text of words", "en", "a", 1), (None, "without id", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, SF)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]


def test_stage_of_near_copies_keeps_one_row_of_each_text(spark):
    texts = ["one two three four five", "quite another text of words", "some third thing that is written here", "the fourth text is not like those above"]
    rows = [(1, texts[0], "en", "a", 1), (1, texts[1], "en", "a", 1), (2, texts[1], "en", "b", 1), (None, texts[0], "en", "a", 1), (None, texts[2], "en", "a", 1), (None, texts[2], "en", "b", 1), (0, texts[3], "en", "a", 1), (1, texts[3], "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    runs = {tuple(sorted(map(str, corpus_pipeline.keep_one_of_near_copies(spark, docs.repartition(n), SF).collect()))) for n in (1, 5)}
    assert len(runs) == 1
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, SF).collect()
    assert sorted((r.text, r.doc_id) for r in kept) == sorted(zip(texts, (1, 1, None, 0), strict=True))


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_runs(spark, name):
    found = queries.QUERIES[name](spark, SF)
    if name in ("op12_impact_index", "op13_collocations"):
        assert found.count() > 0
        return
    table = "pages" if name in ("op4_url_filter", "op7_warc") else "documents"
    assert found.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
