"""What changed between two snapshots, and the table of all postings ever seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlode.operators.running import running


def new_and_gone(current: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """(key, change): `new` or `gone`."""
    both = current.select(key, F.lit(1).alias("now"), F.lit(0).alias("before")).unionByName(previous.select(key, F.lit(0).alias("now"), F.lit(1).alias("before")))
    found = both.groupBy(key).agg(F.max("now").alias("now"), F.max("before").alias("before"))
    return found.where("now <> before").select(key, F.when(F.col("now") == 1, "new").otherwise("gone").alias("change"))


def reseen(current: DataFrame, previous: DataFrame, id_col: str, key: str) -> DataFrame:
    """New ids of current, and whether a row with their key was there before under another id."""
    fresh = current.join(previous.select(id_col).distinct(), id_col, "left_anti")
    known = previous.select(F.col(key).alias("_known")).where(F.col("_known").isNotNull()).distinct()
    return fresh.join(known, F.col(key) == F.col("_known"), "left").withColumn("reseen", F.col("_known").isNotNull()).drop("_known")


def movers(current: DataFrame, previous: DataFrame, id_col: str, order: list[Column], top: int = 30, least: int = 5) -> DataFrame:
    """(id, was, now, change) among the first `top` of both: entered, exited, or moved by at least `least`.

    A full order needs one task for ranks, so the `top` rows are cut first.
    """
    rank = lambda df, name: df.orderBy(*order).limit(top).select(id_col, F.row_number().over(Window.orderBy(*order)).alias(name))
    both = rank(current, "now").join(rank(previous, "was"), id_col, "full_outer")
    change = F.when(F.col("was").isNull(), "entered").when(F.col("now").isNull(), "exited").when(F.abs(F.col("was") - F.col("now")) >= least, "moved")
    return both.select(id_col, "was", "now", change.alias("change")).where("change IS NOT NULL")


def merge_lifecycle(known: DataFrame, run: DataFrame, key: str, at: Column, values: list[str]) -> DataFrame:
    """The table of all rows after a run: first_seen, last_seen, active, and the newest values.

    Applying a run twice changes nothing.
    """
    old, new = known.alias("old"), run.select(key, *values).alias("new")
    seen = F.col(f"new.{key}").isNotNull()
    picked = [F.when(seen, F.col(f"new.{v}")).otherwise(F.col(f"old.{v}")).alias(v) for v in values]
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    return joined.select(F.coalesce(f"new.{key}", f"old.{key}").alias(key), *picked, F.coalesce("old.first_seen", at).alias("first_seen"), F.when(seen, at).otherwise(F.col("old.last_seen")).alias("last_seen"), seen.alias("active"))


def asof_latest(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, within_days: int) -> DataFrame:
    """left with `latest`: the latest right_time at or before left_time and at most so many days older, by `by`.

    The union is dealt out in ranges of key and time, and the latest time of the
    ranges before is carried on, so no pairs are made and no key meets in one task.
    A null key matches nothing.
    """
    rows = left.withColumns({"_t": F.col(left_time), "_left": F.lit(1)}).unionByName(right.select(by, F.col(right_time).alias("_t"), F.col(right_time).alias("_r"), F.lit(0).alias("_left")), allowMissingColumns=True)
    found = running(rows, [F.col("_t"), F.col("_left")], {"latest": F.col("_r")}, [by], largest=True).where("_left = 1")
    fresh = F.datediff(F.col("_t"), F.col("latest")) <= within_days
    return found.withColumn("latest", F.when(fresh & F.col(by).isNotNull(), F.col("latest"))).drop("_t", "_left", "_r")


def new_among_top(current: DataFrame, previous: DataFrame, id_col: str, order: list[Column], top: int) -> DataFrame:
    """(n, new): of the first `top` rows, how many there are and how many the previous snapshot did not have."""
    first = current.orderBy(*order).limit(top).select(id_col)
    known = previous.select(F.col(id_col).alias("_known")).distinct()
    return first.join(known, F.col(id_col) == F.col("_known"), "left").agg(F.count("*").alias("n"), F.count_if(F.col("_known").isNull()).alias("new"))


def only_in(rows: DataFrame, source: str, key: str) -> DataFrame:
    """(n, alone): keys of one source, and those of them that no other source has."""
    keys = rows.groupBy(key).agg(F.max((F.col("source") == source).cast("int")).alias("_own"), F.count_distinct("source").alias("_sources")).where("_own = 1")
    return keys.agg(F.count("*").alias("n"), F.count_if(F.col("_sources") == 1).alias("alone"))


def provenance(removed: DataFrame, rows: DataFrame) -> DataFrame:
    """What each merge of removed (loser, winner) joined: ids, companies, titles, sources and addresses of both sides; rows have `_ord`."""
    side = lambda name: rows.select(F.col("_ord").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("id", "company", "title", "source", "url")])
    return removed.join(side("loser"), "loser").join(side("winner"), "winner")


def radar(current: DataFrame, previous: DataFrame, id_col: str, least: float, within_days: int, today: Column) -> DataFrame:
    """(id, event) worth a look: a good posting that is new, one whose score rose to good, one whose deadline is near.

    rows: id, score, deadline. A posting has its first event alone.
    """
    before = previous.select(F.col(id_col).alias("_id"), F.col("score").alias("_score"))
    joined = current.join(before, F.col(id_col) == F.col("_id"), "left")
    left, good = F.datediff("deadline", today), F.col("score") >= least
    event = F.when(good & F.col("_id").isNull(), "new").when(good & (F.col("_score") < least), "risen").when(good & left.between(0, within_days), "deadline")
    return joined.select(id_col, event.alias("event")).where("event IS NOT NULL")


def budget_order(score: str = "score", added: str = "added", id_col: str = "id") -> list[Column]:
    """What a bounded list shows first: rows with a score by it, the newest first among equals, then by id."""
    return [F.desc_nulls_last(score), F.desc_nulls_last(added), F.asc(id_col)]
