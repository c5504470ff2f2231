"""Joins of rows that an array was exploded into: their size is not what Spark takes it for, so none of them is a broadcast."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postlode.catalogue import on_dedup as q
from postlode.operators import cascade, components, dedup, residents, running

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """The plans of all that is written on the way to a result."""
    seen = []
    for module in (cascade, components, dedup, residents, running):
        for name in ("checkpointed", "stored"):
            if hasattr(module, name):
                monkeypatch.setattr(module, name, lambda df, *rest, _own=getattr(module, name): (seen.append(plan(df)), _own(df, *rest))[1])
    return seen


def test_mirrors_meet_their_winner_by_a_merge(spark):
    assert "BroadcastExchange" not in plan(dedup.mirrors(q.block(spark, SF, q.MIRRORS)))


def test_cross_source_broadcasts_nothing(spark, plans):
    found = dedup.cross_source(q.block(spark, SF, q.SOURCES))
    assert not [p for p in [*plans, plan(found)] if "BroadcastExchange" in p]


def test_a_cascade_broadcasts_starts_of_ranges_alone(spark, plans):
    rows = q.block(spark, SF, q.CASCADE)
    removed = dedup.cascade(rows)
    assert not [p for p in plans if "BroadcastExchange" in p]
    assert plan(removed).count("BroadcastExchange") == 1
    assert plan(dedup.survivors(rows, removed)).count("BroadcastExchange") == 1


def test_components_broadcast_nothing(spark, plans):
    dedup.component_sizes(q.block(spark, SF, q.CASCADE))
    assert plans and not [p for p in plans if "BroadcastExchange" in p]


def test_running_values_of_many_groups_broadcast_one_row_a_range(spark):
    rows = spark.range(20_000).select(F.col("id"), F.floor(F.col("id") / 4).alias("g"))
    found = running.running_sums(rows, F.col("id"), {"n": F.lit(1)}, ["g"])
    assert found.where(F.col("n") != F.col("id") % 4).isEmpty() and found.count() == 20_000
    assert plan(found).count("BroadcastExchange") == 1 and "_past" in plan(found)


def test_blocks_are_dealt_out_before_they_grow(spark):
    assert q.block(spark, SF, q.CASCADE).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
