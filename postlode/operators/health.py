"""Alerts over the runs of many series: (series..., at, status, collected)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: History that each alert asks for, and its threshold.
DROP_HISTORY, DROP_SHARE = 3, 0.5
ZERO_HISTORY, REGRESSION_HISTORY, FAILURES, STALE_HOURS = 3, 3, 2, 36
FAILED = ("error", "timeout")


def last_runs(runs: DataFrame, series: str, order: list[str]) -> DataFrame:
    """One row for each series: its last run beside figures of the runs before it.

    Aggregates alone: the last runs first, then counts of the runs before them,
    and a median from counts of equal values. No series' history meets in one
    row or one sort, so a hot series costs no more than its share.
    """
    at, ok, failed = F.struct(*order), F.col("status") == "ok", F.col("status").isin(*FAILED)
    ends = runs.groupBy(series).agg(
        F.count("*").alias("runs"), F.count_if(ok).alias("ok_runs"), F.max("at").alias("last_at"),
        F.max_by("status", at).alias("last_status"), F.max_by("collected", at).alias("last_collected"), F.max_by("collected", F.when(ok, at)).alias("last_ok_collected"),
        F.max(at).alias("_last"), F.max(F.when(ok, at)).alias("_last_ok"), F.max(F.when(~failed, at)).alias("_last_fine"),
    )
    placed = runs.join(ends.select(series, "_last", "_last_ok", "_last_fine"), series).withColumn("_at", at)
    prior = ok & (F.col("_at") < F.col("_last"))
    counts = placed.groupBy(series).agg(F.count_if(prior).alias("prior_ok"), F.count_if(prior & (F.col("collected") > 0)).alias("prior_filled"), F.count_if(F.col("_last_fine").isNull() | (F.col("_at") > F.col("_last_fine"))).alias("failures"))
    # the upper middle of the values before the last good run: the first one that over half of them do not pass
    values = placed.where(ok & (F.col("_at") < F.col("_last_ok"))).groupBy(series, "collected").agg(F.count("*").alias("_n"))
    upto, whole = Window.partitionBy(series).orderBy("collected"), Window.partitionBy(series)
    ranked = values.select(series, "collected", F.sum("_n").over(upto).alias("_upto"), F.floor(F.sum("_n").over(whole) / 2).alias("_half"))
    median = ranked.where("_upto > _half").groupBy(series).agg(F.min("collected").alias("prior_median"))
    return ends.drop("_last", "_last_ok", "_last_fine").join(counts, series, "left").join(median, series, "left")


def alerts(last: DataFrame) -> DataFrame:
    """last_runs with an array `alerts` of drop, zero_return, regression, recurring_error, and stale.

    The median of an even history is its upper middle. A series whose last run
    lies over 36 hours behind the newest of all is stale, and has no others.
    """
    newest = last.agg(F.max("last_at").alias("_newest"))
    late = (F.unix_micros("_newest") - F.unix_micros("last_at")) / F.lit(3600e6) > STALE_HOURS
    drop = (F.col("ok_runs") > DROP_HISTORY) & (F.col("prior_median") > 0) & (F.col("last_ok_collected") / F.col("prior_median") < DROP_SHARE)
    zero = (F.col("last_status") == "empty") & (F.col("prior_filled") >= ZERO_HISTORY)
    regression = F.col("last_status").isin(*FAILED) & (F.col("prior_ok") >= REGRESSION_HISTORY)
    named = {"drop": drop, "zero_return": zero, "regression": regression, "recurring_error": F.col("failures") >= FAILURES}
    found = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in named.items()]))
    # one row with one time is joined, whatever the number of series
    return last.join(F.broadcast(newest)).withColumn("alerts", F.when(late, F.array(F.lit("stale"))).otherwise(found)).drop("_newest")


def summary(runs: DataFrame, series: str, order: list[str]) -> DataFrame:
    """(series, runs, ok_runs, last_status, avg_ok): how many runs there were and went well, the last one's status, and what good ones collected on average.

    runs: series, status, collected, and the columns of `order`, in which runs followed each other.
    """
    ok = F.col("status") == "ok"
    last, average = F.max_by("status", F.struct(*order)), F.round(F.avg(F.when(ok, F.col("collected"))), 2)
    return runs.groupBy(series).agg(F.count("*").alias("runs"), F.count_if(ok).alias("ok_runs"), last.alias("last_status"), average.alias("avg_ok"))


def drift(runs: DataFrame, order: str, values: list[str], offset: int = 6) -> DataFrame:
    """The last run's values and their change against the run `offset` before it; one row for each day is expected."""
    recent = runs.orderBy(F.desc(order)).limit(offset + 1)
    w = Window.orderBy(order)
    rows = recent.select(order, *[c for v in values for c in (F.col(v), F.lag(v, offset).over(w).alias(f"{v}_before"))])
    last = rows.orderBy(F.desc(order)).limit(1)
    return last.select(order, *[c for v in values for c in (F.col(v), F.col(f"{v}_before"), (F.col(v) - F.col(f"{v}_before")).alias(f"{v}_change"))])


def rollup(records: DataFrame, day: Column, kind: str, sums: list[str]) -> DataFrame:
    """Records by day and kind: their number and the sums of their figures."""
    return records.groupBy(day.alias("day"), kind).agg(F.count("*").alias("records"), *[F.sum(c).alias(f"sum_{c}") for c in sums])


def merge_rollup(known: DataFrame, fresh: DataFrame, kind: str) -> DataFrame:
    """Known days stay as they are, so that rolling up twice is rolling up once."""
    return known.unionByName(fresh.join(known.select("day", kind), ["day", kind], "left_anti"))
