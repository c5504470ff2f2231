"""The steps that a cascade's rows take, against loops, with keys and classes that go on over batches and ranges."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postlode import shared
from postlode.catalogue import on_dedup
from postlode.functions.text import FUNCTION_WORDS, GENDER_TAGS, STUDENT_MARKERS, TRACKING, canonical_url, fold, identity, place_key, title_bag
from postlode.operators import cascade, components, dedup, lookups, residents, setjoin

SHARED = pa.schema([("key", pa.string()), ("_ord", pa.int64()), ("i", pa.int32()), ("tier", pa.int8()), ("least", pa.int64()), ("at_edge", pa.int32())])
FOLDED = pa.schema([("loser", pa.int64()), ("winner", pa.int64()), ("tier", pa.int8()), ("founder", pa.int64()), ("has_description", pa.bool_()), ("has_type", pa.bool_()), ("posted_key", pa.string())])


def cut(rnd, rows, names, most):
    """rows in batches of a few, some empty."""
    at = 0
    while at < len(rows):
        n = rnd.randint(0, most)
        part = rows[at : at + n]
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in part], schema=pa.schema([SHARED.field(c) if c in SHARED.names else FOLDED.field(c) for c in names]))
        at += n


@pytest.mark.parametrize("seed", range(6))
def test_firsts_of_keys_equal_a_loop(seed):
    rnd = random.Random(seed)
    rows = sorted((f"k{rnd.randint(0, 1 if seed == 5 else 12)}", rnd.randint(0, 60)) for _ in range(90))
    rows = [(k, o, n, 0) for n, (k, o) in enumerate(rows)]
    orders = {k: {o for q, o, *_ in rows if q == k} for k, *_ in rows}
    expected = sorted((k, o, n, min(orders[k])) for k, o, n, _ in rows if len(orders[k]) > 1)
    found, bounds = [], sorted(rnd.sample(range(len(rows)), 4))
    for a, b in zip([0, *bounds], [*bounds, len(rows)], strict=True):
        for batch in cascade._first_of_keys(cut(rnd, rows[a:b], SHARED.names[:4], 7), ["key"], SHARED):
            found += batch.to_pylist()
    begun = {k: {r["_ord"] for r in found if r["key"] == k and r["at_edge"]} for k in orders}
    got = [(r["key"], r["_ord"], r["i"], r["least"]) for r in found if r["at_edge"] == 0]
    got += [(r["key"], r["_ord"], r["i"], min(begun[r["key"]])) for r in found if r["at_edge"] == 1 and len(begun[r["key"]]) > 1]
    assert sorted(got) == expected and len(expected) > 30


@pytest.mark.parametrize("seed", range(4))
def test_classes_in_a_range_equal_a_loop(seed):
    rnd, rows = random.Random(seed), []
    for _ in range(25):
        founder = len(rows)
        rows += [(founder, founder + n, rnd.randint(0, 3)) for n in range(rnd.choice([1, 2, 3, 30]))]
    rows = [(*r, rnd.random() < 0.5, rnd.random() < 0.5, str(rnd.randint(0, 4))) for r in rows]
    names = ["founder", "_ord", "tier", "has_description", "has_type", "posted_key"]

    def loop(own):
        lost, founder, current = [], None, None
        for f, o, t, *traits in own:
            new = cascade.Holder(o, *traits)
            if f != founder:
                founder, current = f, new
            elif cascade.prefers(new, current):
                lost.append((current.row, o, t))
                current = new
            else:
                lost.append((o, current.row, t))
        return sorted(lost)

    at = next(n for n in range(3, len(rows)) if rows[n][0] != rows[n][1])
    found = [r for part in (rows[:at], rows[at:]) for b in cascade._own_classes(cut(rnd, part, names, 9), FOLDED) for r in b.to_pylist()]
    lost = [(r["loser"], r["winner"], r["tier"]) for r in found if r["founder"] is None]
    rest = sorted((tuple(r["loser" if n == "_ord" else n] for n in names) for r in found if r["founder"] is not None), key=lambda r: r[:2])
    assert sorted(lost + loop(rest)) == loop(rows) and len(rest) < len(rows) / 2


def test_each_row_moves_once_to_find_shared_keys(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(cascade, "stored", lambda df, name: (seen.append((name, df._jdf.queryExecution().executedPlan().toString())), shared.stored(df, name))[1])
    rows = [(o, 0, 0, f"k{o // 3}") for o in range(30)] + [(o, 1, 1, "hot") for o in range(20)] + [(99, 0, 0, "one"), (99, 1, 1, "one")]
    found = cascade.shared_keys(spark.createDataFrame(rows, "_ord long, i int, tier int, key string").repartition(3))
    expected = [(f"k{o // 3}", o, 0, o // 3 * 3) for o in range(30)] + [("hot", o, 1, 0) for o in range(20)]
    assert sorted((r.key, r._ord, r.i, r.least) for r in found.collect()) == sorted(expected)
    plan = dict(seen)["shared"].split("Initial Plan")[-1]
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan


def test_what_is_written_leaves_no_shuffle(spark):
    made = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    for write in (lambda df: shared.stored(df, "test"), shared.checkpointed):
        assert write(made).count() == 10
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    before = folders.size()
    shared.stored(spark.range(5000).repartition("id"), "test")
    assert spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size() <= before


ODD = ["", " ", "x", "X-Ray", "m/w/d", "(M/F/X)", "mwd", "all gender", "alle Geschlechter", "Praktikum", "PRAKTIKANTIN", "interns", "Internal", "werkstudenten", "the", "über", "ß", "Straße", "12345", " 1234 ", "Ulm", "New  York", "a\tb", "\n", "\x0b", "12345\tUlm", "co", "GmbH", "İ", "é", " ", "\x00", "/", "//", "#", "?", "?a=1", "&utm_source=z", "ref=1", "https://J.example/", "/\n", "/\u0085", "\r", ","]


def test_keys_of_odd_texts_stay_as_the_patterns_have_them(spark):
    """Texts that miss what a pattern needs are not given to it; the keys are those of the patterns."""
    rnd = random.Random(3)
    texts = [*ODD, None, *["".join(rnd.choice(ODD) + rnd.choice(["", " "]) for _ in range(rnd.randint(1, 5))) for _ in range(1500)]]
    c, empty = F.col("t"), F.coalesce(F.col("t"), F.lit(""))
    u = F.regexp_replace(F.trim(empty), "#.*$", "")
    name = lambda p: F.lower(F.substring_index(p, "=", 1))
    kept = F.filter(F.split(F.regexp_replace(u, r"^[^?]*\??", ""), "&"), lambda p: (p != "") & ~name(p).rlike("^utm_") & ~name(p).isin(TRACKING))
    base = F.regexp_extract(u, r"^[^?]*", 0)
    url = F.lower(F.regexp_replace(F.when(F.size(kept) > 0, F.concat(base, F.lit("?"), F.array_join(kept, "&"))).otherwise(base), "/+$", ""))
    words = lambda t: F.array_distinct(F.regexp_extract_all(t, F.lit("[a-z0-9]+"), F.lit(0)))
    without = lambda t, no: F.array_sort(F.array_except(words(t), F.array(*map(F.lit, no))))
    bag = F.array_join(without(F.regexp_replace(F.regexp_replace(fold(empty), GENDER_TAGS, " "), STUDENT_MARKERS, "working student"), FUNCTION_WORDS), " ")
    place = F.trim(F.regexp_replace(F.regexp_replace(fold(F.substring_index(empty, ",", 1)), r"^\s*\d{4,5}\s+", ""), r"\s+", " "))
    telling = without(fold(empty), ("gmbh", "ag", "se", "inc", "ltd", "co", "kg", "group", "the"))
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for plain, own in ((url, canonical_url(c)), (bag, title_bag(c)), (place, place_key(c)), (telling, identity(c))):
        assert rows.where(~plain.eqNullSafe(own)).select("t", plain, own).collect() == []


def test_a_key_counts_whatever_its_column(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "b"), (2, None)], "_ord long, external_id string").selectExpr("_ord", "external_id", "'a' AS id", "'s' AS source", "'Co' AS company", "'T' AS title", "'Ulm' AS location", "'u' AS url")
    listed = {r._ord: [(k.tier, k.key) for k in r["keys"]] for r in rows.select("_ord", dedup.candidate_keys().alias("keys")).collect()}
    flat = dedup.flat_keys(dedup.keyed_rows(rows))
    assert sorted((r._ord, dedup.TIERS[r.tier]) for r in flat.collect()) == sorted((o, t) for o, keys in listed.items() for t, _ in keys)
    assert flat.select("key", "digest").distinct().count() == len({k for keys in listed.values() for _, k in keys})


@pytest.mark.parametrize("seed", range(4))
def test_few_residents_equal_queues_of_many(seed):
    rnd = random.Random(seed)
    rows = [(n, rnd.choice(["", "a", "b", "c"]), rnd.choice(["", "de", "fr"]), (rnd.random() < 0.2, rnd.random() < 0.5, rnd.random() < 0.5, str(rnd.randint(0, 3)))) for n in range(60)]
    queues = residents.Residents()
    expected = [x for n, s, c, r in rows if (x := queues.meet(s, c, n, residents.Rank(*r))) is not None]
    assert residents.of_few(rows) == expected and len(expected) > 20


def test_cross_source_sorts_nothing_to_add_it_up(spark, monkeypatch):
    seen, plan = [], lambda df: df._jdf.queryExecution().executedPlan().toString()
    for module in (dedup, residents):
        monkeypatch.setattr(module, "stored", lambda df, name: (seen.append(plan(df)), shared.stored(df, name))[1])
    found = dedup.cross_source(on_dedup.block(spark, "/root/testdata/sf0.001", on_dedup.SOURCES))
    assert len(seen) > 2 and not [p for p in [*seen, plan(found)] if "SortAggregate" in p]
    assert sum(p.count("RegExpReplace") + p.count("regexp_replace") for p in seen[1:]) == 0


def test_rounds_of_blocks_move_a_bounded_part(spark, monkeypatch):
    rnd, moved, dealt = random.Random(2), [], setjoin._dealt
    made = lambda n: [(i, rnd.choice(["hot", "hot", "b"]), sorted({f"w{int(30 * rnd.random() ** 2)}" for _ in range(rnd.randint(0, 8))})) for i in range(n)]
    left, right = made(90), made(120)
    total = sum(len(x[2]) for x in left + right)
    words = lambda df: df.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("n")).first().n

    def watched(*args):
        for x, y in dealt(*args):
            moved.append(words(x) + words(y))
            yield x, y

    monkeypatch.setattr(setjoin, "_dealt", watched)
    tables = [spark.createDataFrame(x, "key long, g string, words array<string>").repartition(3) for x in (left, right)]
    pairs = setjoin.similar_sets(*tables, 0.5, within=("g",), most=(40, 40, 40), most_moved=1)
    expected = [(i, j, len(set(a) & set(b))) for i, g, a in left for j, h, b in right if g == h and (2 * len(set(a) & set(b)) >= len(set(a) | set(b)))]
    assert sorted(map(tuple, pairs.collect())) == sorted(expected) and len(expected) > 40
    assert len(moved) > 2 and max(moved) < 2 * total < sum(moved)


def test_twins_drop_words_before_sets_meet(spark, monkeypatch):
    seen, own = [], setjoin.similar_hashed
    rows = [(1, "agg.de", "t", "de", ["a", "b"]), (2, "x.de", "t", "de", ["a", "b", "c"]), (3, "agg.de", "t", "de", ["z"])]
    with shared.written() as paths:
        monkeypatch.setattr(lookups, "similar_hashed", lambda *x: (seen.extend(p for p in paths if p in shared.WRITTEN), own(*x))[1])
        found = lookups.official_twins(spark.createDataFrame(rows, "id long, host string, bag string, country_iso string, words array<string>"), ("agg.de",))
    assert [tuple(r) for r in found.collect()] == [(1, 2)]
    assert sorted(p.split("postlode-")[1].split("-")[0] for p in seen) == ["ids", "sets", "sets"]


def test_components_compute_edges_once_and_leave_one_table(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(components, "stored", lambda df, name: (seen.append(df._jdf.queryExecution().executedPlan().toString()), shared.stored(df, name))[1])
    edges = spark.createDataFrame([(n, n + 1) for n in range(0, 40, 2)] + [(3, 8), (5, 5)], "a long, b long")
    with shared.written() as paths:
        found = components.components(edges)
    expected = {n: n // 2 * 2 for n in range(42) if n < 40} | {8: 2, 9: 2}
    assert {r.node: r.component for r in found.collect()} == expected
    assert len(seen) > 3 and not [p for p in seen if "Union" in p]
    assert len([p for p in paths if p in shared.WRITTEN]) == 1


def test_survivors_add_nothing_up(spark):
    rows = on_dedup.block(spark, "/root/testdata/sf0.001", on_dedup.CASCADE)
    removed = spark.createDataFrame([(0, 1)], "loser long, winner long")
    assert "Aggregate" not in dedup.survivors(rows, removed)._jdf.queryExecution().executedPlan().toString()


def test_a_cascade_leaves_only_what_its_result_reads(spark):
    with shared.written() as paths:
        removed = dedup.cascade(on_dedup.block(spark, "/root/testdata/sf0.001", on_dedup.CASCADE))
    left = [p.rsplit("/", 1)[-1] for p in paths if p in shared.WRITTEN]
    assert removed.count() == 5 * spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    assert sum(p.startswith("postlode-") for p in left) == 1 and len(left) <= 3
