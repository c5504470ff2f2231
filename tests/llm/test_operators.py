"""Training-data operators against plain versions on small tables with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlode import shared
from postlode.llm import bpe, mixing, mpeg_ts, quality_model, quality_rules, simhash, substring_dedup, toxicity, url_filter, warc

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PATH = public_tokenizers.path("word_bpe_49k.json")


def corpus():
    """Rows with every odd case: no text, no id, no source, repeats, copies, a very long text."""
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdeèß") for _ in range(rnd.randint(1, 6)))
    texts = [" ".join(word() for _ in range(rnd.randint(1, 120))) for _ in range(40)]
    passage = " ".join(word() for _ in range(50))
    texts += [t + "\n" + passage + " " + word() for t in texts[:6]] + [texts[0], texts[0], passage, passage + " " + passage]
    texts += [None, "", " \t\n", "a", "same same same same", "x" * 70_000, " ".join(word() for _ in range(20_000)), "l1\nl1\n\nl2\nl1", "a b c a b c a b c", "Ünïcode # $ |\u00a0\u2028 wide"]
    rows = [(i, t, "en", "abc"[i % 3] if i % 7 else None, None) for i, t in enumerate(texts)]
    return [*rows, rows[3], (None, "no id at all", None, "a", None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    # columns whose names the operators use inside must do no harm
    return spark.createDataFrame(corpus(), DOCS).repartition(3).withColumns({"host": F.lit(1), "label": F.lit("x"), "id": F.lit(2), "fp": F.lit(3), "size": F.lit(4), "batch_id": F.lit(5), "n_words": F.lit(6), "score": F.lit(7), "_row": F.lit(8), "_text": F.lit(9), "_id": F.lit(10), "source_size": F.lit(11), "target": F.lit(12)})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def words(t):
    return WORDS.findall(t or "")


def test_quality_rules(docs, empty):
    found = quality_rules.quality_rules(docs).collect()
    assert len(found) == len(corpus())
    expected = Counter()
    for i, t, *_ in corpus():
        w = words(t)
        n = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if n[x] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        expected[i, len(w), sum(map(len, w)), sum((t or "").count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found) == expected
    assert quality_rules.quality_rules(empty).count() == 0


def test_bad_host_fails_its_documents_and_a_small_one_is_shrunk(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "no" if i % 10 else good, "en", "bad", 0) for i in range(200)] + [(1000 + i, good if i % 20 else "no", "en", f"h{i % 5}", 0) for i in range(400)] + [(5000, "no", "en", "tiny", 0), (5001, good, "en", "tiny", 0)]
    found = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert not found[0].kept and found[1001].kept and found[5001].kept and not found[5000].kept
    assert abs(found[5001].host_rate - 0.5) > 0.01


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        share = (total - sum(3 * sizes[s] for s in stopped)) / (sum(weight[s] for s in order if s not in stopped) or math.inf)
        over = {s for s in order if s not in stopped and share * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in stopped else share * weight[s] for s in order}
        stopped |= over


def test_mixing(spark, docs, empty):
    found = mixing.mix(docs).collect()
    sizes = Counter()
    for _, t, _, s, _ in corpus():
        sizes[s] += len(words(t))
    targets = plain_targets(sizes)
    assert len(found) == len(corpus())
    for r in found:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, targets[r.source])
        rate = r.target / r.source_size
        assert math.floor(rate) <= r.copies <= min(3, math.floor(rate) + 1)
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r.copies for r in found)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_mixing_many_sources_meets_targets(spark):
    rnd = random.Random(3)
    rows = [(i, "w " * rnd.randint(1, 30), "en", rnd.choice(["a", "b", "tiny", None] + ["big"] * 9), 0) for i in range(6000)]
    found = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    taken, target = Counter(), {}
    for r in found:
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
    assert all(abs(taken[s] - t) < 0.06 * t for s, t in target.items())


def test_more_sources_than_ranges_are_numbered_by_code_point(spark):
    names = [f"s{i}" for i in range(500)] + ["Z", "é", "", None]
    found = mixing.numbered_sources(spark.createDataFrame([(n,) for n in names], "source string")).collect()
    assert [r.source for r in sorted(found, key=lambda r: r["rank"])] == [*sorted(n for n in names if n is not None), None]
    assert sorted(r["rank"] for r in found) == list(range(len(names)))


def test_toxicity(spark, docs, empty):
    rnd = random.Random(11)
    fill = lambda n: " ".join(rnd.choice(["the", "of", "and", "in", "that", "house", "garden", "river"]) for _ in range(n))
    rows, labels = [], []
    for i in range(600):
        bad = rnd.random() < 0.2
        sentences = [fill(8) for _ in range(rnd.randint(2, 40))]
        if bad:
            sentences[rnd.randrange(len(sentences))] = f"you {rnd.choice(['oaf', 'oaf', 'dolt'])} {fill(3)}"
        rows.append((i, ". ".join(sentences), "en", "s", 0))
        labels.append((i, int(bad != (rnd.random() < 0.02))))
        if i < 5:
            labels.append((i, labels[-1][1]))
    frame, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame([*labels, (None, 1), (9999, None)], "doc_id long, toxic int")
    model = toxicity.train(frame, known)
    found = {r.doc_id: r for r in toxicity.score(frame, model).collect()}
    right = sum((found[i].score >= 0.5) == bool(re.search("oaf|dolt", t)) for i, t, *_ in rows)
    assert right >= 595
    for i, t, *_ in rows:
        for x in found[i].offending:
            assert re.search("oaf|dolt", t[x.start : x.end])
    assert any(found[i].offending for i in found)
    assert model == toxicity.train(frame.repartition(7), known)
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == len(corpus()) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.train(empty, known.where("false")).weights == {}
    assert model.score("the house. " * 5000, {})[0] < 0.5  # length alone is no evidence


def test_noisy_or_is_fitted_by_its_gradient():
    """The gradient against differences of the likelihood, and the fit against a search without gradients."""
    rnd = random.Random(17)
    bags = [[(tuple(sorted(rnd.sample(range(5), rnd.randint(1, 3)))), rnd.randint(1, 3)) for _ in range(rnd.randint(0, 4))] for _ in range(60)]
    y = np.array([int(any(0 in words for words, _ in b) or rnd.random() < 0.1) for b in bags])
    weight = np.array([rnd.choice([0.5, 1.0, 2.0]) for _ in bags])

    def plain_loss(theta):
        total = 0.0
        for b, label, w in zip(bags, y, weight, strict=True):
            none = 1 - 1 / (1 + math.exp(-theta[-1]))
            for words, k in b:
                none *= (1 - 1 / (1 + math.exp(-theta[-2] - sum(theta[i] for i in words)))) ** k
            total -= w * math.log(1 - none if label else none)
        return total / weight.sum() + 0.05 * sum(v * v for v in theta[:-2]) / 2

    data, rng = toxicity.Bags(bags, 5), np.random.default_rng(3)
    for _ in range(5):
        theta = rng.normal(size=7)
        value, grad = data.loss(theta, y, weight, 0.05)
        assert math.isclose(value, plain_loss(theta), rel_tol=1e-9)
        for i, step in enumerate(np.eye(7) * 1e-6):
            assert math.isclose(grad[i], (plain_loss(theta + step) - plain_loss(theta - step)) / 2e-6, rel_tol=1e-4, abs_tol=1e-7)
    weights, bias, leak = toxicity.fit_noisy_or(bags, y, weight, 5, ridge=0.05)
    best = plain_loss(np.array([*weights, bias, leak]))
    assert all(plain_loss(np.array([*weights, bias, leak]) + rng.normal(size=7) * scale) > best - 1e-5 for scale in (0.01, 0.1, 1.0) for _ in range(100))


def test_noisy_or():
    model = toxicity.Model({"bad$": 2.0}, -1.0, -3.0)
    p, leak = 1 / (1 + math.exp(-1)), 1 / (1 + math.exp(3))
    assert math.isclose(model.score("bad a. fine. so bad", {})[0], 1 - (1 - p) ** 2 * (1 - leak))
    assert math.isclose(model.score("", {})[0], leak)
    assert [t["start"] for t in model.score("bad a. fine. so bad", {})[1]] == [0, 12]


def test_toxicity_of_capitals_beside_a_letter_that_grows():
    model = toxicity.Model({"bad$": 2.0}, -1.0, -3.0)
    plain, bad = model.score("so BAD. fine", {})
    score, grown = model.score("\u0130\u0130. so BAD. fine", {})
    assert score == plain and [(x["start"], x["end"]) for x in grown] == [(3, 10)] and [(x["start"], x["end"]) for x in bad] == [(0, 6)]


def plain_repeats(texts, n):
    starts = Counter()
    for t in texts:
        w = words(t)
        starts.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for t in texts:
        w = words(t)
        gone = {j for i in range(len(w) - n + 1) if starts[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("window", [35, 6, 3])
def test_substring_dedup(docs, empty, window):
    found = substring_dedup.remove_repeats(docs, window=window).collect()
    rows = corpus()
    expected = Counter((i, *x) for (i, *_), x in zip(rows, plain_repeats([r[1] for r in rows], window), strict=True))
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in found) == expected
    for r in found:
        assert sum(s.after - s.first for s in r.spans) == r.n_removed
    assert {r.lang for r in found} == {"en", None} and {r.batch_id for r in found} == {5}
    if window == 35:
        assert substring_dedup.remove_repeats(empty, window=window).count() == 0


@pytest.mark.parametrize(("levels", "chunk", "tasks"), [(4096, 1 << 20, 1 << 15), (4, 50, 1 << 15), (2, 1 << 20, 8), (1, 7, 1)])
def test_substring_dedup_in_many_batches(spark, monkeypatch, levels, chunk, tasks):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    for name, value in (("BATCH_BYTES", 100), ("GROUP_BYTES", 300), ("RANGE_BYTES", 300), ("ROW_HASHES", 1), ("LEVEL_RANGES", levels), ("CHUNK_HASHES", chunk), ("MOST_TASKS", tasks)):
        monkeypatch.setattr(substring_dedup, name, value)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup.remove_repeats(frame, window=9).collect()}
    assert [found[i] for i in range(60)] == plain_repeats(texts, 9)


def test_substring_dedup_where_little_or_nothing_repeats(spark):
    rnd = random.Random(5)
    text = lambda n: " ".join(f"{rnd.getrandbits(40):x}" for _ in range(n))
    long, passage = [text(200) for _ in range(50)], text(40)
    for texts in (long, ["too short"] * 9, [long[0]], [*long, long[7]], [f"{long[0]} {passage}", *long[1:], f"a {passage}"]):
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup.remove_repeats(frame).collect()}
        assert [found[i] for i in range(len(texts))] == plain_repeats(texts, 35)
    only = substring_dedup.remove_repeats(frame.select("text"))
    assert only.columns == ["text", "n_words", "n_removed", "spans"] and only.agg(F.sum("n_removed")).first()[0] == 80
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("postlode")]


def test_url_filter(spark):
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"), ("block", "b.a.org/x"), ("allow", "a.org/xyz1"), ("block", "net/")]
    urls = ["http://example.org/es/1", "https://A.Example.ORG/en/12?x", "http://notexample.org/es/1", "http://org", "http://x.com/de/", "http://com/fr/#y", "ftp://b.a.org/xyz1", "http://q.b.a.org/x", "no url", "", None, "http://net", "http://net/", "http:///path", "a://b://c.net/d", "http://É.net/é?q", "http://x.example.org./es/"] + [f"http://hot.example.org/es/{i}" for i in range(300)]
    rnd = random.Random(1)
    urls += ["http://" + ".".join(rnd.choice(["a", "b", "org", "example", "com", "net"]) for _ in range(rnd.randint(1, 4))) + rnd.choice(["", "/", "/es/", "/en/1", "/x", "/xyz1"]) for _ in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3).withColumns({"host": F.lit(1), "rule": F.lit(2)})
    for ranges in (1, 50_000):
        found = {r.page_id: r for r in url_filter.apply_rules(pages, rules, rows_per_range=ranges).collect()}
        assert len(found) == len(urls)
        for i, u in enumerate(urls):
            host = path = ""
            if u and "://" in u:
                m = re.match(r"([^/?#]*)([^?#]*)", u.split("://", 1)[1], re.S)
                host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]
            fit = [(len(r), len(r.split("/", 1)[0]), r, v) for v, r in rules if (host == (h := r.split("/", 1)[0]) or host.endswith("." + h)) and path.startswith("/" + r.split("/", 1)[1])]
            best = max(fit, default=(0, 0, None, "allow"))
            assert (found[i].host, found[i].path, found[i].rule, found[i].verdict) == (host, path, best[2], best[3]), u
    assert url_filter.apply_rules(pages.where("false"), rules).count() == 0
    assert {r.verdict for r in url_filter.apply_rules(pages, [], default="block").collect()} == {"block"}


def test_url_rules_that_are_equal(spark):
    """Equal rules: the first of a sequence, the verdict first by code point of a table; hosts in capitals are the same host."""
    pages = spark.createDataFrame([(1, "http://x.org/a/b"), (2, "http://x.org/a"), (3, "http://x.org/c")], "page_id long, url string").withColumns({"key": F.lit("k"), "salt": F.lit(1), "part": F.lit(2), "kind": F.lit(3), "verdict": F.lit("v")})
    rules = [("block", "x.org/a"), ("allow", "X.ORG/a"), ("allow", "org/c"), ("block", "x.org/a/b")]
    read = lambda found: {r.page_id: (r.rule, r.verdict) for r in found.collect()}
    expected = {1: ("x.org/a/b", "block"), 2: ("x.org/a", "block"), 3: ("org/c", "allow")}
    assert read(url_filter.apply_rules(pages, rules)) == expected
    table = spark.createDataFrame(rules, "verdict string, rule string")
    assert read(url_filter.apply_rules(pages, table)) == expected | {2: ("x.org/a", "allow")}


LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(["<|endoftext|>", "<|startoftext|>", "'s", "'ll", " ", "Σ", "İ", "e\u0301", "the", "\u0085"])), max_size=40))
def test_bpe_equals_library(parts):
    text = "".join(parts)
    tool = bpe.tokenizer(PATH)
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    packed = tool.encode([text])[0]
    assert np.frombuffer(packed, "<u4").tolist() == ids
    assert tool.decode(packed).decode() == LIBRARY.decode(ids, skip_special_tokens=False)


def test_bpe_frames(docs, empty):
    found = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    expected = Counter()
    for i, t, *_ in corpus():
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        expected[i, np.array(ids, "<u4").tobytes(), LIBRARY.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, bytes(r.ids), r.decoded) for r in found) == expected
    assert bpe.encode(empty, PATH, keep=("source",)).count() == 0


@pytest.mark.parametrize("together", [1, 24, 1000])
def test_segment_tree_merges_leftmost_lowest(monkeypatch, together):
    monkeypatch.setattr(bpe.Bpe, "TOGETHER", together)
    tool = bpe.tokenizer(PATH)
    rnd = random.Random(4)
    pieces = ["".join(rnd.choice("thesanio") for _ in range(rnd.choice([1, 2, 3, 9, 200, 1000]))) for _ in range(60)]
    assert [np.frombuffer(x, "<u4").tolist() for x in tool.merge(pieces)] == [LIBRARY.encode(p, add_special_tokens=False).ids for p in pieces]


def test_bpe_of_every_code_point():
    """Each by itself after a mark, after a letter, before a letter and after a digit, many to a text."""
    tool = bpe.tokenizer(PATH)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 4000):
        text = " ".join(x for c in points[i : i + 4000] for x in (f":{c}", f"a{c}", f"{c}a", f"1{c}"))
        assert np.frombuffer(tool.encode([text])[0], "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, hex(ord(points[i]))


def test_bpe_of_long_pieces_and_a_full_cache():
    rnd = random.Random(6)
    tool = bpe.Bpe(PATH, most_cached=2000)
    texts = ["".join(rnd.choice("etaoinsé") for _ in range(30_000)), *(" ".join(f"{rnd.getrandbits(50):x}" for _ in range(50)) for _ in range(5))]
    for t in [*texts, texts[1]]:
        assert np.frombuffer(tool.encode([t])[0], "<u4").tolist() == LIBRARY.encode(t, add_special_tokens=False).ids
        assert tool.cached < 60_000 and max(map(len, tool.cache)) <= tool.LONG


def plain_fingerprint(t):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    k = min(4, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(len(w) - k + 1)] if w else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(ids, fps, radius):
    label = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i, j in ((i, j) for i in range(len(ids)) for j in range(i)):
            if label[i] != label[j] and (fps[i] ^ fps[j]).bit_count() <= radius:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    return label


@pytest.mark.parametrize("tile", [4096, 3])
def test_simhash(docs, empty, tile):
    found = simhash.near_duplicates(docs, tile=tile).collect()
    rows = corpus()
    fps = [plain_fingerprint(r[1]) for r in rows]
    label = plain_components([r[0] for r in rows], fps, 4)
    least = {x: min((r[0] for r, y in zip(rows, label, strict=True) if y == x and r[0] is not None), default=None) for x in label}
    expected = Counter((r[0], f, least[x]) for r, f, x in zip(rows, fps, label, strict=True))
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in found) == expected
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("tile", [4096, 20, 4])
def test_links_lose_no_component(spark, tile):
    rnd = random.Random(9)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(30):
            fps.add(x)
            for _ in range(rnd.choice([1, 3, 6])):
                x ^= 1 << rnd.randrange(64)
    fps = sorted(fps)
    frame = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(frame, 4, tile).collect()]
    place, label = {x: i for i, x in enumerate(fps)}, np.arange(len(fps))
    simhash.link(label, np.array([place[a] for a, _ in edges]), np.array([place[b] for _, b in edges]))
    expected = plain_components(fps, fps, 4)
    pairs = {(a, b) for a, b in zip(label.tolist(), expected, strict=True)}
    assert len(pairs) == len(set(expected)) == len(set(label.tolist()))


def test_bands_share_a_mask_within_the_radius():
    rnd = random.Random(8)
    for n, count in ((1000, 5), (1 << 40, 35)):
        masks = simhash.band_masks(4, n, 4096)
        assert len(masks) == count and all(0 < m < 1 << 64 for m in masks)
        for _ in range(2000):
            x = sum(1 << i for i in rnd.sample(range(64), 4))
            assert any(not x & m for m in masks)


def test_simhash_of_a_hot_band_and_of_many_fingerprints(spark, monkeypatch):
    """Fingerprints that agree in one band, over a tile, and the masks for many of them: as by comparing all pairs."""
    rnd = random.Random(12)
    fps = {rnd.getrandbits(50) << 14 for _ in range(3000)}
    fps |= {x ^ 1 << 14 + rnd.randrange(50) ^ 1 << 14 + rnd.randrange(50) for x in rnd.sample(sorted(fps), 400)}
    fps = np.array(sorted(fps), np.uint64)
    label = np.arange(len(fps))
    for i in range(0, len(fps), 500):
        x, y = np.nonzero(np.bitwise_count(fps[i : i + 500, None] ^ fps[None, :]) <= 4)
        simhash.link(label, x + i, y)
    frame = spark.createDataFrame([(x,) for x in fps.view(np.int64).tolist()], "fp long")
    for many in (0, 1 << 40):
        masks = simhash.band_masks(4, many, 256)
        monkeypatch.setattr(simhash, "band_masks", lambda *_, masks=masks: masks)
        edges = simhash.links(frame, 4, 256).collect()
        degree = Counter(v for e in edges for v in e)
        assert max(degree.values(), default=0) <= (simhash.FANOUT + 1) * len(masks) * 9
        found = np.arange(len(fps))
        at = lambda v: np.searchsorted(fps, np.array(v, np.int64).view(np.uint64))
        simhash.link(found, at([e.a for e in edges]), at([e.b for e in edges]))
        assert (found == label).all()
        monkeypatch.undo()


def test_simhash_keeps_ids_of_text(spark):
    frame = spark.createDataFrame([("b", "one two three four five"), ("a", "one two three four five"), ("c", None), (None, "")], "doc_id string, text string")
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame).collect()}
    assert found == {"a": "a", "b": "a", "c": "c", None: "c"}


def pages(spark):
    rows = [(5, "http://a/1", "same"), (3, "http://a/2", "same"), (9, None, "same"), (1, "http://a/\r\nX: y", None), (2, "u", ""), (4, "é" * 50_000, "ü" * 3000), (4, "é", "ü" * 3000), (7, "u", "other"), (8, "u", "same"), (None, "u", "same"), (10, "u", "x" * 2500)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "id": F.lit(2), "first": F.lit(3)})


@pytest.mark.parametrize(("least", "chunk"), [(0, 1 << 20), (3, 1000)])
def test_warc(spark, least, chunk):
    rows, frame = pages(spark)
    table = warc.write_records(frame, min_bytes=least, chunk_bytes=chunk)
    found = warc.read_records(table.repartition(3)).collect()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    expected = Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        to = first[h or ""] if len(raw) >= least and first[h or ""] != i else None
        expected["" if i is None else str(i), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if to is None else "revisit", to and str(to)] += 1
    assert Counter(map(tuple, found)) == expected
    assert table.groupBy().agg(F.max("chunk_no")).first()[0] == (0 if chunk > 9000 else 5)
    assert warc.read_records(warc.write_records(frame.where("false"))).count() == 0


def test_warc_keeps_long_urls_whole(spark):
    urls = ["http://a/" + "x" * (3 << 20) + end for end in "bcd"]
    rows = [(1, urls[0], "y" * 2500), (2, urls[1], "y" * 2500), (3, urls[2], "")]
    table = warc.write_records(spark.createDataFrame(rows, "page_id long, url string, html string"), chunk_bytes=1000)
    assert [tuple(r)[:2] + (r.record_type,) for r in warc.read_records(table).orderBy("id").collect()] == [("1", 2500, "response"), ("2", 2500, "revisit"), ("3", 0, "response")]
    chunks = table.orderBy("record_id", "chunk_no").collect()
    assert max(len(c.data) for c in chunks) <= warc.HEADER_BYTES + 1004
    readers = {}
    for c in chunks:
        readers.setdefault(c.record_id, warc.Reader()).feed(bytes(c.data))
    assert {r.fields["X-Page-Id"]: r.fields["WARC-Target-URI"] for r in readers.values()} == {str(i): u for i, u, _ in rows}


def test_warc_records_have_what_the_format_asks_for(spark):
    rows = [("a b\r\nX: y", "http://a/1", "same"), ("b", "http://a/2", "same"), ("c%20", None, "other")]
    table = warc.write_records(spark.createDataFrame(rows, "page_id string, url string, html string"), date="2024-05-06T07:08:09Z")
    fields = {}
    for c in table.collect():
        reader = warc.Reader()
        reader.feed(bytes(c.data))
        fields[reader.result()[0]] = reader.fields
    assert set(fields) == {"a b\r\nX: y", "b", "c%20"} and {f["WARC-Date"] for f in fields.values()} == {"2024-05-06T07:08:09Z"}
    first, second = fields["a b\r\nX: y"], fields["b"]
    assert second["WARC-Refers-To"] == first["WARC-Record-ID"] and second["WARC-Refers-To-Target-URI"] == "http://a/1"
    assert [r.refers_to for r in warc.read_records(table).orderBy("id").collect()] == [None, "a b\r\nX: y", None]


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_warc_header_over_pieces_of_any_size(size):
    digest = warc.base32(hashlib.sha1(b"a\r\n\r\nb").digest())
    data = warc.header("1", "http://a", digest, 6, None) + warc.HTTP + b"a\r\n\r\nb\r\n\r\n"
    reader = warc.Reader()
    for i in range(0, len(data), size):
        reader.feed(data[i : i + size])
    assert reader.result() == ("1", 6, digest, "response", None)


def test_warc_notices_damage(spark):
    table = warc.write_records(pages(spark)[1], chunk_bytes=1000)
    for bad in (table.where("NOT (chunk_no = 1)"), table.withColumn("data", F.when(F.col("chunk_no") == 1, F.overlay("data", F.lit(b"zz"), F.lit(5))).otherwise(F.col("data")))):
        with pytest.raises(Exception, match="out of order|damaged"):
            warc.read_records(bad).collect()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=2000), st.integers(1, 700), st.integers(1, 5))
def test_transport_stream_round_trip(payload, unit, every):
    media = mpeg_ts.mux(payload, unit, every)
    assert len(media) % 188 == 0
    back, index, errors = mpeg_ts.demux(media)
    assert back == payload and errors == 0
    assert index == [(k * 3600, k * unit, k % every == 0) for k in range(max(1, -(-len(payload) // unit)))]


def test_transport_stream_counts_lost_packets_and_refuses_damage():
    media = mpeg_ts.mux(bytes(range(256)) * 40, 5000)
    lost = media[: 188 * 10] + media[188 * 11 :]
    with pytest.raises(ValueError, match="damaged"):
        mpeg_ts.demux(lost)
    packets = [media[i : i + 188] for i in range(0, len(media), 188)]
    del packets[2 + 28 : 2 + 56]  # a whole elementary packet of 28
    assert mpeg_ts.demux(b"".join(packets))[2] == 1
    twice = [packets[0], packets[1], *[p for x in packets[2:] for p in (x, x)]]
    assert mpeg_ts.demux(b"".join(twice)) == mpeg_ts.demux(b"".join(packets))
    with pytest.raises(ValueError, match="table"):
        mpeg_ts.demux(media[:20] + b"\x07" + media[21:])
    with pytest.raises(ValueError, match="sync"):
        mpeg_ts.demux(b"\0" + media[1:])


def test_stored_tables_can_be_dropped(spark):
    before = list(shared.WRITTEN)
    media = mpeg_ts.store_media(spark.createDataFrame([("x", "text")], "doc_id string, text string"))
    assert media.first().doc_id == "x"
    new = [p for p in shared.WRITTEN if p not in before]
    shared.drop_stored(spark, new)
    assert len(new) == 1 and shared.WRITTEN == before
    with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_EXIST|not found"):
        spark.read.parquet(new[0])


def test_media_columns(docs, empty):
    found = mpeg_ts.read_media(mpeg_ts.store_media(docs)).collect()
    expected = Counter()
    for i, t, *_ in corpus():
        raw = (t or "").encode()
        padded = raw.ljust(max(1, -(-len(raw) // 64)) * 64, b"\0")
        expected[i, len(raw), padded, zlib.crc32(padded[-64:])] += 1
    assert Counter((r.doc_id, r.n_bytes, bytes(r.payload), zlib.crc32(bytes(r.payload)[-64:])) for r in found) == expected
    assert all(r.continuity_errors == 0 and r.pts_index[0].random_access for r in found)
    assert mpeg_ts.read_media(mpeg_ts.store_media(empty)).count() == 0


def test_quality_model(spark, docs, empty):
    rnd = random.Random(13)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9)))
    rows, labels = [], []
    for i in range(800):
        good = rnd.random() < 0.8
        w = [word() for _ in range(rnd.randint(5, 150))]
        rows.append((i, " ".join(w) if good else " ".join(x + "!!" for x in w).upper() if i % 2 else " ".join(w[0] for _ in w), "en", "s", 0))
        labels.append((i, int(good)))
    frame, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame([*labels, (None, 1), (4, None)], "doc_id long, quality int")
    model = quality_model.train(frame, known)
    scores = {r.doc_id: r.score for r in quality_model.score(frame, model).collect()}
    held_out = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((scores[i] >= 0.3) == bool(labels[i][1]) for i in held_out) >= 0.97 * len(held_out)
    odd = quality_model.score(docs, model).collect()
    assert len(odd) == len(corpus()) and all(0 <= r.score <= 1 for r in odd)
    assert quality_model.score(empty, model).count() == 0
    one_class = quality_model.train(frame, known.where("quality = 1"))
    assert {r.score for r in quality_model.score(frame.limit(5), one_class).collect()}.__len__() == 1


def plain_split(x, g, h, least=1.0, ridge=1.0):
    """(gain, feature, threshold) of the best split over every value of every feature."""
    best = (0.0, None, None)
    for k in range(x.shape[1]):
        for cut in sorted(set(x[:, k]))[:-1]:
            left = x[:, k] <= cut
            if h[left].sum() >= least and h[~left].sum() >= least:
                gain = g[left].sum() ** 2 / (h[left].sum() + ridge) + g[~left].sum() ** 2 / (h[~left].sum() + ridge) - g.sum() ** 2 / (h.sum() + ridge)
                best = max(best, (gain, k, cut), key=lambda b: b[0])
    return best


def test_trees_split_where_an_exhaustive_search_does():
    """With a bin for each value: the first tree's nodes against every split, level by level, leaves against Newton steps."""
    rng = np.random.default_rng(7)
    x = rng.integers(0, 30, size=(400, 4)).astype(float)
    y = ((x[:, 2] > 11) & (x[:, 0] < 20) | (rng.random(400) < 0.1)).astype(int)
    model = quality_model.fit(x, y, trees=1, depth=2, rate=0.15, bins=4000)
    g, h = 1 / (1 + math.exp(-model.base)) - y, np.full(len(y), (p := 1 / (1 + math.exp(-model.base))) * (1 - p))
    nodes = [(model.roots[0], np.arange(len(y)), 0)]
    while nodes:
        node, rows, level = nodes.pop()
        gain, k, cut = plain_split(x[rows], g[rows], h[rows])
        if level == 2 or k is None:
            assert model.left[node] == node
            assert math.isclose(model.value[node], -0.15 * g[rows].sum() / (h[rows].sum() + 1))
            continue
        goes = x[rows, model.feature[node]] <= model.threshold[node]
        parts = [plain_gain for plain_gain in (g[rows][goes], g[rows][~goes])]
        hs = [h[rows][goes], h[rows][~goes]]
        own = sum(a.sum() ** 2 / (b.sum() + 1) for a, b in zip(parts, hs, strict=True)) - g[rows].sum() ** 2 / (h[rows].sum() + 1)
        assert math.isclose(own, gain, rel_tol=1e-9)
        assert model.feature[node] == k and (goes == (x[rows, k] <= cut)).all()
        nodes += [(model.left[node], rows[goes], level + 1), (model.right[node], rows[~goes], level + 1)]


def test_trees_follow_their_arrays():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(500, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(int)
    model = quality_model.fit(x, y, trees=40)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    for row in x[:20]:
        total = model.base
        for node in model.roots:
            while model.left[node] != node:
                node = model.left[node] if row[model.feature[node]] <= model.threshold[node] else model.right[node]
            total += model.value[node]
        assert math.isclose(model.score(row[None])[0], 1 / (1 + math.exp(-total)))
