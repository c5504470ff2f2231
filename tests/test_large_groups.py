"""Operators whose groups can be large, against loops, with a group of a third of all rows that no task may hold alone."""

from __future__ import annotations

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from postlode.operators import benchmarks, cascade, dedup, enrichment, lookups, residents, setjoin, snapshots, tracker
from postlode.operators.running import running
from postlode.shared import checkpointed

KEYED = "_ord long, has_description boolean, has_type boolean, posted_key string, keys array<struct<tier:string,key:string>>"


def keyed_rows(n, keys, seed, hot=0.0):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        own = rnd.sample(range(keys), rnd.randint(0, min(3, keys)))
        own = [("hot", "hot")] * (rnd.random() < hot) + [(f"t{k % 3}", f"k{k}") for k in own]
        rows.append((i, rnd.random() < 0.5, rnd.random() < 0.5, str(rnd.randint(0, 9)), own))
    return rows


def plain_fold(rows):
    return sorted(dedup.fold([{"_ord": i, "source": "s", "has_description": d, "has_type": t, "posted_key": p, "keys": keys} for i, d, t, p, keys in rows]))


def folded(spark, rows, partitions, most_rounds=50):
    keyed = checkpointed(spark.createDataFrame(rows, KEYED).repartition(partitions))
    flat = keyed.select("_ord", F.posexplode("keys").alias("i", "k")).select("_ord", "i", "k.*")
    return cascade.fold_apart(keyed, checkpointed(flat), most_rounds)


@pytest.mark.parametrize("case", [(60, 12, 0.0, 50), (400, 300, 0.3, 50), (300, 90, 0.0, 1)])
def test_cascade_apart_equals_fold(spark, case):
    n, keys, hot, rounds = case
    rows = keyed_rows(n, keys, n, hot)
    found = folded(spark, random.Random(1).sample(rows, len(rows)), 5, rounds)
    expected = plain_fold(rows)
    assert sorted(map(tuple, found.collect())) == expected and len(expected) > 20


def test_a_chain_of_keys_is_decided_after_the_rounds(spark):
    rows = [(i, False, False, "1", [("t", f"k{i}"), ("t", f"k{i + 1}")]) for i in range(40)]
    assert sorted(map(tuple, folded(spark, rows, 3, most_rounds=2).collect())) == plain_fold(rows)


def test_a_hot_key_is_in_many_tasks(spark):
    rows = keyed_rows(6000, 9000, 4, hot=0.4)
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one partition
    try:
        found = folded(spark, rows, 6).withColumn("task", F.spark_partition_id())
        assert sorted((r.loser, r.winner, r.tier) for r in found.collect()) == plain_fold(rows)
        largest = found.where("tier = 'hot'").groupBy("task").agg(F.count("*").alias("n")).orderBy(F.desc("n")).first().n
        assert largest < 0.35 * found.where("tier = 'hot'").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_passages_chain_like_rows():
    rnd = random.Random(3)
    made = lambda i: cascade.Holder(i, rnd.random() < 0.5, rnd.random() < 0.5, str(rnd.randint(0, 4)))
    for _ in range(400):
        holder, run = made(0), [made(i) for i in range(1, rnd.randint(2, 9))]
        cut, expected = rnd.randint(0, len(run)), holder
        for new in run:
            expected = new if cascade.prefers(new, expected) else expected
        for part in (run[:cut], run[cut:]):
            passage = cascade.Passage()
            for new in part:
                passage.add(new)
            holder = passage.of(holder)
        assert holder == expected


@pytest.mark.parametrize("least", [0.176, 0.5, 1.0])
def test_similar_sets_equal_brute_force(spark, least):
    rnd = random.Random(8)
    word = lambda: f"w{int(40 * rnd.random() ** 2)}"
    made = lambda n: [(i, rnd.choice(["hot", "hot", "b", None]), [word() for _ in range(rnd.choice([0, 1, 2, 5, 9, 14]))]) for i in range(n)]
    left, right = [*made(70), (100, "hot", None), (101, "hot", ["the"] * 3)], [*made(90), (100, "hot", []), (101, "hot", ["the", "the"]), (102, "hot", ["the", None])]
    tables = [spark.createDataFrame(x, "id long, g string, words array<string>").repartition(3).withColumn("key", F.col("id")) for x in (left, right)]
    found = {(r.left_key, r.right_key): r.shared for r in setjoin.similar_sets(*tables, least, within=("g",)).collect()}
    expected = {}
    for i, g, a in left:
        for j, h, b in right:
            a_, b_ = ({w for w in x or [] if w is not None} for x in (a, b))
            if g is not None and g == h and (len(a_ & b_) / len(a_ | b_) if a_ | b_ else 1.0) >= least:
                expected[i, j] = len(a_ & b_)
    assert found == expected and (101, 101) in found and (100, 100) in found
    assert setjoin.similar_sets(tables[0].where("false"), tables[1], least, within=("g",)).count() == 0


@pytest.mark.parametrize("most", [(60, 40, 20), (10**6, 30, 30), (8, 8, 8)])
def test_blocks_of_sets_meet_once(spark, most):
    """Groups that are cut on either side, on both, and that share a cell; pairs are judged where they meet, so no words move with a pair."""
    rnd = random.Random(9)
    made = lambda n, groups: [(i, rnd.choice(groups), sorted({f"w{int(30 * rnd.random() ** 2)}" for _ in range(rnd.randint(0, 8))})) for i in range(n)]
    left, right = made(60, ["hot", "hot", "b", "c", "left alone"]), made(80, ["hot", "hot", "b", "c", "right alone"])
    tables = [spark.createDataFrame(x, "key long, g string, words array<string>").repartition(3) for x in (left, right)]
    pairs = setjoin.similar_sets(*tables, 0.5, within=("g",), most=most)
    expected = [(i, j, len(set(a) & set(b))) for i, g, a in left for j, h, b in right if g == h and (2 * len(set(a) & set(b)) >= len(set(a) | set(b)))]
    assert sorted(map(tuple, pairs.collect())) == sorted(expected) and len(expected) > 40
    assert "array_intersect" not in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_copies_of_a_hot_title_are_one_set(spark):
    """A third of all rows are copies of one posting: pairs are of sets, not of rows."""
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["agg.de", "www.acme.de", "x.agg.de", "other.com"]), "engineer", "de", ["same", "words", "here"] if i % 3 == 0 else [f"w{rnd.randint(0, 30)}" for _ in range(6)]) for i in range(900)]
    rows += [(2000, "agg.de", None, "de", ["same"]), (2001, "b.de", "engineer", "fr", ["same", "words", "here"]), (2002, "agg.de", "engineer", "de", None), (2003, None, "engineer", "de", ["same", "words", "here"])]
    table = spark.createDataFrame(rows, "id long, host string, bag string, country_iso string, words array<string>")
    found = {r.id: r.twin for r in lookups.official_twins(table, ("agg.de",)).collect()}
    ours = lambda h: h is not None and (h == "agg.de" or h.endswith(".agg.de"))
    expected = {}
    for i, h, bag, c, a in rows:
        if ours(h) and bag is not None:
            for j, k, other, d, b in rows:
                x, y = set(a or []), set(b or [])
                if k is not None and not ours(k) and (bag, c) == (other, d) and (len(x & y) / len(x | y) if x | y else 1.0) >= 0.5:
                    expected[i] = min(j, expected.get(i, j))
    assert found == expected and len(found) > 150


def grouped(n, seed):
    rnd = random.Random(seed)
    return [(i, rnd.choice(["hot", "hot", "b", "c", None]), rnd.randint(0, 40), rnd.choice([None, 1, 5, 9])) for i in range(n)]


@pytest.mark.parametrize("largest", [False, True])
def test_running_within_groups(spark, largest):
    rows = grouped(500, 6)
    found = running(spark.createDataFrame(rows, "id long, g string, o int, v int").repartition(5), [F.col("o"), F.col("id")], {"x": F.col("v")}, ["g"], largest)
    expected = {}
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (str(r[1]), r[2], r[0])), key=lambda r: r[1]):
        seen = []
        for r in group:
            expected[r[0]] = max(seen, default=None) if largest else sum(seen)
            seen += [r[3]] * (r[3] is not None)
    assert {r.id: r.x for r in found.collect()} == expected and found.columns == ["id", "g", "o", "v", "x"]


def test_ranks_and_asof_of_a_hot_key(spark):
    rows = grouped(300, 7)
    table = spark.createDataFrame(rows, "id long, g string, o int, v int").repartition(4)
    ranked = benchmarks.ranks_within(table, "g", [F.desc("o"), F.col("id")])
    expected = {}
    for g in {r[1] for r in rows}:
        expected |= {r[0]: i for i, r in enumerate(sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], r[0])), 1)}
    assert {r.id: r.rank_within for r in ranked.collect()} == expected
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    left = [(i, g, day(o)) for i, g, o, _ in rows if i % 2]
    right = [(g, day(o)) for i, g, o, _ in rows if i % 2 == 0]
    found = snapshots.asof_latest(spark.createDataFrame(left, "id long, g string, t date"), spark.createDataFrame(right, "g string, r date"), "g", "t", "r", 3)
    best = lambda g, t: max((r for h, r in right if g is not None and h == g and r <= t), default=None)
    assert {r.id: r.latest for r in found.collect()} == {i: (b if (b := best(g, t)) and (t - b).days <= 3 else None) for i, g, t in left}


@pytest.mark.parametrize("total", [0, 7, 60, 10_000])
def test_quotas_by_largest_remainder(spark, total):
    rows = grouped(200, 8)
    table = spark.createDataFrame(rows, "id long, g string, o int, v int")
    sizes = {g: sum(r[1] == g for r in rows) for g in {r[1] for r in rows}}
    want = min(total, len(rows))
    quota = {g: want * n // len(rows) for g, n in sizes.items()}
    order = sorted((g for g in sizes if want * sizes[g] % len(rows)), key=lambda g: (-(want * sizes[g] % len(rows)), -sizes[g], g is None, g or ""))
    for g in order[: want - sum(quota.values())]:
        quota[g] += 1
    assert {r.g: r.quota for r in enrichment.quotas(table, "g", total).collect()} == quota
    first = enrichment.stratified_sample(table, "g", total)
    again = enrichment.stratified_sample(table.repartition(7), "g", total)
    assert sorted(r.id for r in first.collect()) == sorted(r.id for r in again.collect()) and first.count() == want
    refill = enrichment.stratified_sample(table, "g", 20, taken=first)
    assert refill.count() == min(20, len(rows) - want) and not refill.join(first, "id").count()


def test_events_of_a_repeated_message_do_not_depend_on_order(spark):
    schema = "message_id long, job_id string, event_type string, ts timestamp"
    rows = [(i, "j", t, dt.datetime(2024, 1, d)) for i in range(30) for d, t in ((2, "rejected"), (1, "offer"), (1, "applied"))]
    found = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        found.append(sorted(map(tuple, tracker.append_events(spark.createDataFrame([], schema), spark.createDataFrame(rows, schema).repartition(seed)).collect())))
    assert found[0] == found[1] and all(r[2] == "applied" for r in found[0]) and len(found[0]) == 30


@pytest.mark.parametrize(("seed", "most_rows"), [(1, 1), (2, 40)])
def test_ranges_of_a_bucket_equal_one_replay(spark, seed, most_rows):
    """Piles of one source that another then takes over row by row, in ranges of one row and of many."""
    rnd = random.Random(seed)
    n = 24 if most_rows == 1 else 600
    rank = lambda i, s: residents.Rank(s == "bulk", i > n // 3 and rnd.random() < 0.7, rnd.random() < 0.5, rnd.choice("0123"))
    rows = [(("hot", "x", "y")[min(rnd.randrange(6), 2)], s, rnd.choice(["", "de", "fr"]), *rank(i, s), i) for i in range(n) for s in [rnd.choice("aaab") if i < n // 3 else rnd.choice(["a", "b", "bulk", ""])]]
    df = checkpointed(spark.createDataFrame(rows, "k string, source string, country string, bulk boolean, described boolean, typed boolean, posted string, _ord long").repartition(5))
    expected = []
    for key in {r[0] for r in rows}:
        held = residents.Residents()
        expected += [found for _, s, c, *r, i in sorted((r for r in rows if r[0] == key), key=lambda r: r[-1]) if (found := held.meet(s, c, i, residents.Rank(*r))) is not None]
    assert len(expected) > n // 4
    assert sorted(map(tuple, residents.bucket_fold(df, ["k"], most_rows).collect())) == sorted(expected)
