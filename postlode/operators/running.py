"""Sums and maxima over all rows before a row, without one task that sees every row of a group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlode.shared import checkpointed


def running(df: DataFrame, order: Column | Sequence[Column], values: dict[str, Column], by: Sequence[str] = (), largest: bool = False) -> DataFrame:
    """df with, for each of `values`, its sum (or largest) over the rows before a row in `order`, within equal `by`.

    The first row of a group has 0 (or null). Rows are dealt out in ranges of
    (by, order) and added up within, so a group can be of any size; of each
    group only one row a range, with what the ranges before it add up to, meets
    in one task. Rows that are equal in `by` and `order` lie in one range and
    come one after another. A null in `by` is a value.
    """
    orders = [order] if isinstance(order, Column) else list(order)
    how = F.max if largest else F.sum
    first = (lambda x: x) if largest else (lambda x: F.coalesce(x, F.lit(0)))
    both = F.greatest if largest else (lambda a, b: a + b)
    ranged = checkpointed(df.repartitionByRange(*by, *orders).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy(*by, "_range").agg(*[how(x).alias(f"_{name}") for name, x in values.items()])
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = totals.withColumn("_past", F.count("*").over(before)).select(*[F.col(b).alias(f"_by_{b}") for b in by], F.col("_range").alias("_of"), "_past", *[how(f"_{name}").over(before).alias(f"_{name}") for name in values])
    within = Window.partitionBy(*by, "_range").orderBy(*orders).rowsBetween(Window.unboundedPreceding, -1)
    own = ranged.withColumns({name: first(how(x).over(within)) for name, x in values.items()})
    same = reduce(Column.__and__, [F.col(b).eqNullSafe(F.col(f"_by_{b}")) for b in by], F.col("_range") == F.col("_of"))
    # a range goes on with one group at most, so this is one row a range, however many groups there are
    joined = own.join(F.broadcast(ranges.where("_past > 0").drop("_past")), same, "left").withColumns({name: both(first(F.col(f"_{name}")), F.col(name)) for name in values})
    return joined.drop("_range", "_of", *[f"_by_{b}" for b in by], *[f"_{name}" for name in values])


def running_sums(df: DataFrame, order: Column | Sequence[Column], sums: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """df with, for each of `sums`, its total over the rows before a row in `order` and in its group, 0 for the first."""
    return running(df, order, sums, by)
